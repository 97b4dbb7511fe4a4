"""Operator 1: BPE encoding and decoding with a tokenization automaton.

The merges are compiled into a deterministic automaton over tokens that
accepts exactly the correct tokenizations.  It starts as one state with a
loop for every base symbol.  The gadget of the k-th merge ``u v -> w``

* splits the state behind the ``u`` arcs: the copy behind ``u`` loses its
  ``v`` arc (the *cut* ``(u, v)`` at time k), so ``u v`` is no longer read;
* adds a ``w`` arc beside every ``u`` arc that exists at time k, leading
  where ``v`` leads at time k.

All arcs with one label lead to one state, so the state is known by the
last token.  A later label ``y = x' x`` inherits the cuts its right part
``x`` had when ``y`` was made, and an arc ``t = z z'`` exists beside the
arcs its left part ``z`` had when ``t`` was made.  The automaton is
therefore stored as the cuts with their times plus the left and right
spines of the tokens; the transition function reads these tables and keeps
the cells in use in a bounded table.

A pre-split word is encoded by following arcs, the longest first, and
stepping back where no arc goes on; each position is left for good at most
once, and tokens have a bounded length, so the time is linear in the word.  Decoding emits the label of each arc, joined as the
tokenizer file says (no decoder: by one blank).
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD_END = "</w>"
_FOREVER = 1 << 60
#: Words kept with their ids per Python worker, and cells of the transition table.
WORD_CACHE = 120_000
CELL_CACHE = 300_000
#: Longer words are encoded without keeping them.
KEPT_WORD = 64
#: Bytes of text that one output batch covers (a longer text is a batch of its own).
BATCH_BYTES = 2 << 20


def byte_symbols() -> list[str]:
    """Printable character of each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others take the
    code points from 256 on in order.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 256
    for b in range(256):
        if b in own:
            out[b] = chr(b)
        else:
            out[b] = chr(extra)
            extra += 1
    return out


class TokenAutomaton:
    """Automaton of a merge list; see the module's text."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.vocab = vocab
        self.label = {i: t for t, i in vocab.items()}
        self.cut: dict[tuple[int, int], int] = {}
        size = max(vocab.values(), default=0) + 1
        # per token: time of its merge (-1: a base symbol, -2: never made) and its two parts
        self.born = [-2] * size
        self.left = [-1] * size
        self.right = [-1] * size
        self.cells: dict[tuple[int, int], bool] = {}
        made = {u + v: time for time, (u, v) in reversed([*enumerate(merges)])}
        if len(made) < len(merges):
            raise ValueError("two merges make one token")
        for token, i in vocab.items():
            if token not in made:
                self.born[i] = -1
        if any(made.get(part, -1) >= time for time, merge in enumerate(merges) for part in merge):
            raise ValueError("a merge uses a token that a later merge makes")
        for time, (u, v) in enumerate(merges):
            self._gadget(time, vocab[u], vocab[v], vocab[u + v])
        self.longest = max((len(t) for t in vocab), default=1)

    def _gadget(self, time: int, u: int, v: int, w: int) -> None:
        if self.born[u] == -2 or self.born[v] == -2 or self._blocked(u, v, time):
            return  # no path reads u v at this time: the merge never applies
        self.cut[u, v] = time
        self.born[w], self.left[w], self.right[w] = time, u, v

    def _blocked(self, state: int, token: int, time: int = _FOREVER) -> bool:
        """Whether the state behind ``state`` has no ``token`` arc at ``time``.

        A label on the right spine of ``state`` counts until the next one up
        the spine is made, and so on the left spine of ``token``.
        """
        cut, born, left, right = self.cut, self.born, self.left, self.right
        x, until_x = state, _FOREVER
        while x >= 0:
            z, until_z = token, _FOREVER
            while z >= 0:
                j = cut.get((x, z))
                if j is not None and j < until_x and j <= until_z and j < time:
                    return True
                z, until_z = left[z], born[z]
            x, until_x = right[x], born[x]
        return False

    def follows(self, state: int, token: int) -> bool:
        """Transition function: may ``token`` be read behind ``state``?"""
        cell = (state, token)
        known = self.cells.get(cell)
        if known is None:
            if len(self.cells) >= CELL_CACHE:
                self.cells.clear()
            known = self.cells[cell] = not self._blocked(state, token)
        return known

    def encode(self, symbols: str) -> list[int]:
        """Ids of a word of base symbols whose last one carries the word end.

        Reads the longest arc first and steps back from a position that no
        arc leaves.  A prefix has one correct tokenization, so a position is
        always reached in the same state and, once left, never tried again.
        """
        n, pos, limit = len(symbols), 0, len(symbols)
        ids: list[int] = []
        ends: list[int] = []
        dead: set[int] = set()
        vocab, born, follows, longest = self.vocab, self.born, self.follows, self.longest
        while pos < n:
            for end in range(min(limit, pos + longest), pos, -1):
                if end in dead:
                    continue
                token = vocab.get(symbols[pos:end] if end < n else symbols[pos:] + WORD_END)
                if token is not None and born[token] > -2 and (not ids or follows(ids[-1], token)):
                    ids.append(token)
                    ends.append(end)
                    pos, limit = end, n
                    break
            else:
                dead.add(pos)
                if not ids:
                    raise ValueError("a symbol of the word is not in the vocabulary")
                ids.pop()
                limit = ends.pop() - 1
                pos = ends[-1] if ends else 0
        return ids


class Tokenizer:
    """What a tokenizer file defines: split, automaton, special tokens."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != WORD_END:
            raise ValueError("only BPE files with word ends are read")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = TokenAutomaton(model["vocab"], merges)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = np.empty(max([*self.automaton.label, *self.special.values()]) + 1, object)
        for i, t in self.automaton.label.items():
            self.labels[i] = t
        for t, i in self.special.items():
            self.labels[i] = t
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"])
        self.cut_special = regex.compile(
            "(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")")
        self.symbols = byte_symbols()
        self.known = _Known(self)

    def word_ids(self, piece: str) -> bytes:
        symbols = "".join(map(self.symbols.__getitem__, piece.encode("utf-8")))
        return np.array(self.automaton.encode(symbols), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of the whole text as little-endian unsigned 32-bit integers."""
        if len(self.known) > WORD_CACHE:
            self.known.shrink()
        parts = self.cut_special.split(text) if "<|" in text else (text,)
        out = []
        for part in parts:
            if part in self.special:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            elif part:
                out.append(b"".join(map(self.known.__getitem__, self.pieces.findall(normal(part)))))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Labels of the ids' arcs, joined by one blank."""
        return " ".join(self.labels[np.frombuffer(ids, "<u4")].tolist())


class _Known(dict):
    """Ids of words; encodes a word on its first use."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, piece: str) -> bytes:
        ids = self.tokenizer.word_ids(piece)
        if len(piece) <= KEPT_WORD:
            self[piece] = ids
        return ids

    def shrink(self) -> None:
        """Keep the words that came first, the frequent ones among them."""
        for piece in list(self)[WORD_CACHE // 2:]:
            del self[piece]


def normal(text: str) -> str:
    """NFC, lower case by code point (white space goes with the split)."""
    if not text.isascii():
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = text.replace("Σ", "σ")  # no final-sigma rule
    return text.lower()


_LOADED: dict[int, Tokenizer] = {}


def _tokenizer(definition: str) -> Tokenizer:
    """Compiled once per Python worker, which serves many tasks."""
    key = hash(definition)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Tokenizer(definition)
    return _LOADED[key]


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Ids and decoded text of every document: ``id, ids binary, decoded string``.

    ``ids`` holds little-endian unsigned 32-bit integers.  A null text is
    read as empty: no ids and an empty decoded text.  Ids of rows may be null
    or repeated; every row gives one row.  Other columns are left out.  The
    tokenizer file (its size does not depend on the data) is read once on the
    driver and shipped with the job, so executors need no copy.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(definition.value)
        for batch in batches:
            names, ids, decoded, size = [], [], [], 0
            for name, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py() or ""
                code = tokenizer.encode(text)
                names.append(name.as_py())
                ids.append(code)
                decoded.append(tokenizer.decode(code))
                size += len(text)
                if size >= BATCH_BYTES:
                    yield _batch(batch, names, ids, decoded)
                    names, ids, decoded, size = [], [], [], 0
            if names:
                yield _batch(batch, names, ids, decoded)

    from pyspark.sql.types import BinaryType, StringType, StructField, StructType

    schema = StructType([StructField(id_col, id_type), StructField("ids", BinaryType()),
                         StructField("decoded", StringType())])
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _batch(like: pa.RecordBatch, names: list, ids: list, decoded: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(names, like.schema.types[0]), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
        names=[like.schema.names[0], "ids", "decoded"])


def digests(encoded: DataFrame, *columns: str) -> DataFrame:
    """``n_tokens`` and the two hashes of the result of ``encode_decode``, after the columns named."""
    return encoded.select(
        *columns,
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
