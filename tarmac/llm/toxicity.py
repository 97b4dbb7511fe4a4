"""Operator 3: toxicity by a convolutional text classifier.

A word's embedding is the sum of the hashed embeddings of the word and of
its first three to six bytes.  Filters of several widths run over the word
sequence of the whole text, each filter keeps its maximum (max pooling),
and a logistic layer weighs the maxima, so one toxic passage anywhere in a
long text decides.  Scoring runs in tasks, with the word embeddings multiplied
into the filters once per distinct word of a chunk.

Training reads every labelled row.  The rows are dealt into shards of about
``SHARD_ROWS`` by a hash of the id.  In each epoch the tasks start from the
same network, pass over their shards by gradient steps, and Spark adds the
shards' networks up to a mean weighted by their steps; a row of the embedding
counts in a shard as often as it was moved there.  So the driver holds one
network, whatever the number of rows.

Thresholds are calibrated by language on the quarter of the labelled rows
that is kept out of training, all of it, from counts by score in steps of
``1 / GRID``.  The language is told from function words of the text itself;
the stored ``lang`` is never read.  The published score is shifted so that
every language's threshold stands at 0.7.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import words as W
from tarmac.llm.common import discard, free_shuffles, long_rows, materialise, whole_text

BUCKETS = 1 << 16  # the upper 16 bits of a hash
DIM = 16
WIDTHS = (1, 2, 3)
FILTERS = 8
PREFIXES = (3, 4, 5, 6)
CUT = 0.7
#: Labelled rows of a shard, on average, and texts of one gradient step.
SHARD_ROWS = 4096
BATCH = 32
EPOCHS = 8
#: Steps of one unit of the logit in which the calibration counts, and the largest logit it tells from larger ones.
GRID = 1024
MOST_LOGIT = 64
#: Words and prefixes in fewer training texts have no embedding: they tell texts, not toxicity.
LEAST_TEXTS = 2
#: Weight of a text of label 1 at most, where label 0 is more frequent.
MOST_WEIGHT = 10.0
CHUNK_BYTES = 1 << 19
#: Words of 64 bits in the table that marks the labelled ids, at most, as a power of two.
MARK_BITS = 20

# Frequent function words that tell a language.
FUNCTION_WORDS = {
    "en": "the of and to in is that for it with as was on be by this are from",
    "de": "der die und das den von zu mit sich des auf für ist im dem nicht ein eine",
    "fr": "le la les et des du un une est que dans pour qui au par sur pas elle avec",
    "es": "el los las y del se por con para una su al lo como más pero sus",
}
LANGUAGES = (*FUNCTION_WORDS, "other")


@dataclass
class Model:
    embedding: np.ndarray                 # buckets x dim
    filters: list[np.ndarray]             # per width: width x dim x filters
    bias: np.ndarray                      # all filters
    weight: np.ndarray                    # all filters
    offset: float
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES)))


def _hash_of(words: str) -> np.ndarray:
    raw = np.frombuffer(words.encode(), np.uint8)
    return W.split_words(np.array([0, len(raw)]), raw).hashes()


def _buckets(part: W.Words) -> np.ndarray:
    """Words x features: bucket of the word and of each prefix."""
    kinds = [part.hashes(), *(part.hashes(n) ^ np.uint64(n) for n in PREFIXES)]
    return np.stack([(h >> np.uint64(48)).astype(np.uint16) for h in kinds], axis=1)


def languages(part: W.Words) -> np.ndarray:
    """Index into LANGUAGES of each text, by its function words."""
    h = part.hashes()
    hits = np.zeros((len(part.first) - 1, len(FUNCTION_WORDS)))
    for k, words in enumerate(FUNCTION_WORDS.values()):
        total = np.concatenate([[0], np.cumsum(np.isin(h, _hash_of(words)))])
        hits[:, k] = total[part.first[1:]] - total[part.first[:-1]]
    return np.where(hits.max(axis=1) > 0, hits.argmax(axis=1), len(FUNCTION_WORDS))


def _padded(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words, and first places of the texts, when zero vectors end each text."""
    gap = max(WIDTHS) - 1
    places = np.arange(first[-1]) + gap * np.repeat(np.arange(len(first) - 1), np.diff(first))
    return places, first + gap * np.arange(len(first))


def _convolve(parts: list[np.ndarray], rows: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Filter outputs at every place; ``parts`` are the projections, ``rows`` their row at each place."""
    n = len(rows)
    out = np.empty((n, len(bias)), np.float32)
    at = 0
    for i, width in enumerate(WIDTHS):
        cols = out[:, i * FILTERS: (i + 1) * FILTERS]
        cols[:] = parts[at].take(rows, axis=0)
        for k in range(1, width):
            cols[: n - k] += parts[at + k].take(rows[k:], axis=0)
        at += width
    return out


def _pool(values: np.ndarray, first: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Maximum per text after the ReLU; texts without words have 0."""
    out = np.zeros((len(first) - 1, values.shape[1]), np.float32)
    places = _padded(first)[1]
    for i, (a, n) in enumerate(zip(places[:-1].tolist(), np.diff(first).tolist())):
        if n:
            values[a: a + n].max(axis=0, out=out[i])
            out[i] += bias
    return np.maximum(out, 0)


def _project(embedded: np.ndarray, filters: list[np.ndarray]) -> list[np.ndarray]:
    """Embeddings times each slice of the filters, with a zero row at the end."""
    embedded = np.concatenate([embedded, np.zeros((1, DIM), np.float32)])
    return [np.ascontiguousarray(embedded @ kernel[k]) for kernel in filters for k in range(len(kernel))]


def _rows(back: np.ndarray, first: np.ndarray, empty: int) -> np.ndarray:
    places, starts = _padded(first)
    rows = np.full(starts[-1], empty)
    rows[places] = back
    return rows


@dataclass
class _Text:
    """What a batch needs in every epoch: buckets of distinct words, and their places."""

    buckets: np.ndarray
    back: np.ndarray
    first: np.ndarray


def _prepared(part: W.Words) -> _Text:
    _, at, back = np.unique(part.hashes(), return_index=True, return_inverse=True)
    once = W.Words(part.data, part.start[at], part.end[at], np.array([0, len(at)]), part.sums)
    return _Text(_buckets(once), back.astype(np.int32), part.first)


def logits(model: Model, part: W.Words) -> np.ndarray:
    """Logit of every text of a chunk, from all of its words."""
    return _logits(model, _prepared(part))


def _logits(model: Model, text: _Text) -> np.ndarray:
    parts = _project(_embed(model, text.buckets), model.filters)
    conv = _convolve(parts, _rows(text.back, text.first, len(text.buckets)), model.bias)
    return _pool(conv, text.first, model.bias) @ model.weight + model.offset


def _embed(model: Model, buckets: np.ndarray) -> np.ndarray:
    e = np.zeros((len(buckets), DIM), np.float32)
    for column in buckets.T:
        e += model.embedding.take(column, axis=0)
    return e


def _start(seed: int) -> Model:
    rng = np.random.default_rng(seed)
    return Model(
        (rng.standard_normal((BUCKETS, DIM)) * 0.1).astype(np.float32),
        [(rng.standard_normal((w, DIM, FILTERS)) * 0.3).astype(np.float32) for w in WIDTHS],
        np.zeros(FILTERS * len(WIDTHS), np.float32),
        (rng.standard_normal(FILTERS * len(WIDTHS)) * 0.3).astype(np.float32), 0.0)


def _class_weight(negative: int, positive: int) -> float:
    return min(MOST_WEIGHT, max(1.0, negative / positive))


def train(texts: list[str], labels: np.ndarray, seed: int = 7, epochs: int = EPOCHS) -> Model:
    """``fit`` for a few texts at hand, as a single shard.

    Three quarters of the rows train the network, the others set the
    thresholds.  Without rows of both classes the model scores every text
    alike.
    """
    model, rng = _start(seed), np.random.default_rng(seed + 1)
    labels = np.asarray(labels, np.float32)
    if len(labels) < 8 or labels.min() == labels.max():
        return model
    order = rng.permutation(len(texts))
    fit, held = order[len(order) // 4:], order[: len(order) // 4]
    batches = [(_prepared(_words_of([texts[i] for i in batch])), labels[batch])
               for batch in np.array_split(fit, max(1, len(fit) // BATCH))]
    rare = sum(_seen(text) for text, _ in batches) < LEAST_TEXTS
    model.embedding[rare] = 0
    heavy = _class_weight((labels == 0).sum(), (labels == 1).sum())
    state: dict = {}
    step = 0
    for _ in range(epochs):
        for i in rng.permutation(len(batches)):
            text, y = batches[i]
            step += 1
            if text.first[-1]:
                _update(model, text, y, np.where(y == 1, heavy, 1.0), rare, state, step)
    score, languages_of = _scores(model, [texts[i] for i in held])
    model.thresholds = _thresholds(score, 1 - labels[held], labels[held], languages_of)
    return model


def _seen(text: _Text) -> np.ndarray:
    """Texts of a batch that hold each bucket."""
    seen = np.zeros(BUCKETS, np.int64)
    for a, b in zip(text.first[:-1], text.first[1:]):
        seen[np.unique(text.buckets[text.back[a:b]])] += 1
    return seen


def _words_of(texts: list[str]) -> W.Words:
    return W.split_words(*W.buffers(pa.array(texts, pa.large_string())))


def _scores(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    scores, found = [], []
    for i in range(0, len(texts), 64):
        part = _words_of(texts[i: i + 64])
        scores.append(logits(model, part))
        found.append(languages(part))
    return np.concatenate(scores), np.concatenate(found)


def _thresholds(score: np.ndarray, negative: np.ndarray, positive: np.ndarray, language: np.ndarray) -> np.ndarray:
    """Per language the cut with the fewest errors, well inside its gap.

    A score has a number of rows of label 0 and of label 1.  Over all
    languages the widest such gap is halved; a language with enough rows of
    both classes takes the place nearest to that cut in the middle half of
    its own best gap.
    """

    def best(rows: np.ndarray, near: float | None = None) -> float:
        s, at = np.unique(score[rows], return_inverse=True)
        n0, n1 = np.bincount(at, negative[rows]), np.bincount(at, positive[rows])
        wrong = np.concatenate([[0], np.cumsum(n1)]) + np.concatenate([np.cumsum(n0[::-1])[::-1], [0]])
        low = np.concatenate([[s[0] - 1], s])
        high = np.concatenate([s, [s[-1] + 1]])
        least = np.flatnonzero(wrong == wrong.min())
        low, high = low[least], high[least]
        if near is None:
            widest = np.argmax(high - low)
            return float((low[widest] + high[widest]) / 2)
        room = (high - low) / 4
        cuts = np.clip(near, low + room, high - room)
        return float(cuts[np.argmin(np.abs(cuts - near))])

    if not len(score):
        return np.zeros(len(LANGUAGES))
    common = best(np.ones(len(score), bool))
    out = np.full(len(LANGUAGES), common)
    for k in range(len(LANGUAGES)):
        own = language == k
        n0, n1 = negative[own].sum(), positive[own].sum()
        if n0 + n1 >= 40 and n0 and n1:
            out[k] = best(own, common)
    return out


def _update(model: Model, text: _Text, y: np.ndarray, weight: np.ndarray, rare: np.ndarray, state: dict,
            step: int) -> None:
    """One step of the logistic loss through the pooled places."""
    first = text.first
    e = _embed(model, text.buckets)
    rows = _rows(text.back, first, len(e))
    conv = _convolve(_project(e, model.filters), rows, model.bias)
    pooled = _pool(conv, first, model.bias)
    z = pooled @ model.weight + model.offset
    g = ((1 / (1 + np.exp(-z)) - y) * weight / len(y)).astype(np.float32)
    grads: dict = {"weight": pooled.T @ g, "offset": g.sum()}
    full = np.flatnonzero(np.diff(first))
    back = (g[:, None] * model.weight)[full] * (pooled[full] > 0)
    starts = _padded(first)[1]
    place = np.stack([starts[i] + conv[starts[i]: starts[i] + first[i + 1] - first[i]].argmax(axis=0) for i in full])
    e = np.concatenate([e, np.zeros((1, DIM), np.float32)])
    empty = len(e) - 1
    grads["bias"] = back.sum(axis=0)
    owners, values = [], []
    for i, width in enumerate(WIDTHS):
        cols = slice(i * FILTERS, (i + 1) * FILTERS)
        b, p = back[:, cols], place[:, cols]
        grad = np.zeros_like(model.filters[i])
        for k in range(width):
            at = rows[p + k]
            grad[k] = np.einsum("dfe,df->ef", e[at], b)
            owners.append(at.reshape(-1))
            values.append((b[:, :, None] * model.filters[i][k].T[None]).reshape(-1, DIM))
        grads["filter", i] = grad
    owners, values = np.concatenate(owners), np.concatenate(values)
    wanted = (owners < empty) & (values != 0).any(axis=1)
    of_words = text.buckets[owners[wanted]]
    touched, back_of = np.unique(of_words.reshape(-1), return_inverse=True)
    grad_e = np.zeros((len(touched), DIM), np.float32)
    np.add.at(grad_e, back_of, np.repeat(values[wanted], of_words.shape[1], axis=0))

    def adam(key, grad, rate=0.01):
        m, v = state.get(key, (0.0, 0.0))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        state[key] = (m, v)
        return rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)

    model.weight = model.weight - adam("weight", grads["weight"])
    model.offset = float(model.offset - adam("offset", grads["offset"]))
    model.bias = (model.bias - adam("bias", grads["bias"])).astype(np.float32)
    for i in range(len(WIDTHS)):
        model.filters[i] = (model.filters[i] - adam(("filter", i), grads["filter", i])).astype(np.float32)
    known = ~rare[touched]
    touched, grad_e = touched[known], grad_e[known]
    second = state.setdefault("embedding", np.zeros(BUCKETS, np.float32))
    state.setdefault("moves", np.zeros(BUCKETS, np.int64))[touched] += 1
    second[touched] += (grad_e ** 2).mean(axis=1)
    model.embedding[touched] -= 0.05 * grad_e / (np.sqrt(second[touched])[:, None] + 1e-8)


#: The parts of a network besides the embedding; each has two means in the state.
_PARTS = ("weight", "offset", "bias", *(("filter", i) for i in range(len(WIDTHS))))


def _values(model: Model) -> list[np.ndarray]:
    return [model.weight, np.array([model.offset]), model.bias, *model.filters]


def _packed(model: Model, state: dict) -> np.ndarray:
    """Everything but the embedding and its state as rows of ``DIM`` numbers."""
    parts = _values(model)
    means = [np.broadcast_to(state.get(k, (0.0, 0.0))[j], p.shape) for j in (0, 1) for k, p in zip(_PARTS, parts)]
    flat = np.concatenate([p.ravel() for p in (*parts, *means)])
    return np.concatenate([flat, np.zeros(-len(flat) % DIM)]).reshape(-1, DIM)


def _unpack(rows: np.ndarray, model: Model, state: dict) -> None:
    shapes = [p.shape for p in _values(model)]
    ends = np.cumsum([int(np.prod(s)) for s in shapes * 3])
    got = [p.astype(np.float32).reshape(s) for p, s in zip(np.split(rows.ravel(), ends), shapes * 3)]
    n = len(shapes)
    model.weight, offset, model.bias, *model.filters = got[:n]
    model.offset = float(offset[0])
    for i, key in enumerate(_PARTS):
        state[key] = (got[n + i], got[2 * n + i])


def labelled(docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``_shard, _held, _order, id, y, _text``: every labelled row that has a text, one of an id that repeats.

    The shard, whether a row is kept out of training, and its place in the
    shard are hashes of the id.
    """
    key = F.col(id_col)
    chosen = labels.filter(F.col(label).isin(0, 1) & key.isNotNull()).select(
        key.cast(docs.schema[id_col].dataType).alias(id_col), label).groupBy(id_col).agg(
        F.max(label).cast("float").alias("y"))
    n = max(1, chosen.count())
    hashed = F.xxhash64(key, F.lit(17))
    # a table of bits, bounded in size, keeps most texts without a label out of the exchange
    bits = min(MARK_BITS, max(6, n.bit_length()))
    at, bit = F.shiftrightunsigned(hashed, 64 - bits), F.expr(f"shiftleft(1L, cast(xxhash64(`{id_col}`, 17) & 63 AS int))")
    marks = chosen.groupBy(at.alias("_at")).agg(F.bit_or(bit).alias("_marks"))
    texts = docs.filter(key.isNotNull()).select(id_col, whole_text(text_col).alias("_text"), at.alias("_at")).join(
        F.broadcast(marks), "_at").filter(F.col("_marks").bitwiseAND(bit) != 0)
    rows = texts.select(id_col, "_text", F.lit(None).cast("float").alias("y")).unionByName(
        chosen.select(id_col, F.lit(None).cast("string").alias("_text"), "y"))
    shard = F.pmod(hashed, F.lit(-(-n // SHARD_ROWS))).cast("int")
    rows = rows.withColumn("_shard", shard).repartition("_shard").groupBy("_shard", id_col).agg(
        F.min("_text").alias("_text"), F.max("y").alias("y")).filter("_text IS NOT NULL AND y IS NOT NULL")
    return rows.withColumns({"_held": F.xxhash64(key, F.lit(18)) % 4 == 0, "_order": F.xxhash64(key, F.lit(19))})


def prepared(rows: DataFrame) -> DataFrame:
    """``shard, held, n, positive, y, language, first, back, buckets``: what the epochs need, by batches of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def out() -> pa.RecordBatch:
            part = _words_of([t for t, _ in held])
            text = _prepared(part)
            arrays = (np.array([y for _, y in held], np.float32), languages(part).astype(np.uint8),
                      text.first.astype(np.int64), text.back, text.buckets)
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int32()), pa.array([key[1]]), pa.array([len(held)]),
                 pa.array([int(arrays[0].sum())]), *(pa.array([a.tobytes()]) for a in arrays)],
                names=["shard", "held", "n", "positive", "y", "language", "first", "back", "buckets"])

        for batch in batches:
            for *at, y, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if held and (at != key or len(held) == BATCH):
                    yield out()
                    held = []
                key = at
                held.append((text, y))
        if held:
            yield out()

    rows = rows.sortWithinPartitions("_shard", "_held", "_order").select("_shard", "_held", "y", "_text")
    return rows.mapInArrow(run, "shard int, held boolean, n long, positive long, y binary, language binary, "
                                "first binary, back binary, buckets binary")


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, _Text]]:
    """``shard, y, language, text`` of rows of ``prepared``."""
    for batch in batches:
        for i in range(batch.num_rows):
            y, language, first, back, buckets = (
                np.frombuffer(batch.column(name)[i].as_py(), kind) for name, kind in (
                    ("y", np.float32), ("language", np.uint8), ("first", np.int64), ("back", np.int32),
                    ("buckets", np.uint16)))
            yield batch.column("shard")[i].as_py(), y, language, _Text(
                buckets.reshape(-1, 1 + len(PREFIXES)), back, first)


def _rare(batches: DataFrame) -> np.ndarray:
    """Buckets that fewer than ``LEAST_TEXTS`` training texts hold."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS, np.int64)
        for _, _, _, text in _stored(parts):
            seen += _seen(text)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["bucket", "n"])

    often = batches.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).filter(
        F.col("n") >= LEAST_TEXTS).toArrow()
    rare = np.ones(BUCKETS, bool)
    rare[often.column(0).to_numpy()] = False
    return rare


def _epoch(batches: DataFrame, model: Model, state: dict, rare: np.ndarray, heavy: float, step: int) -> int:
    """Pass over all shards from the same network, then their mean; returns the steps of an average shard."""
    shared: Broadcast = batches.sparkSession.sparkContext.broadcast((model, state, rare))
    columns = ["row", "n", *(f"d{i}" for i in range(DIM)), "second"]

    def out(own: Model, moved: dict, steps: int) -> pa.RecordBatch:
        dense = _packed(own, moved)
        moves, second = moved.get("moves"), moved.get("embedding")
        at = np.flatnonzero(moves) if moves is not None else np.zeros(0, np.int64)
        rows = np.concatenate([at, BUCKETS + np.arange(len(dense))])
        n = np.concatenate([moves[at] if len(at) else at, np.full(len(dense), steps)]).astype(np.float64)
        values = np.concatenate([own.embedding[at], dense]).astype(np.float64) * n[:, None]
        last = np.concatenate([second[at] if len(at) else at, np.zeros(len(dense))]) * n
        return pa.RecordBatch.from_arrays([pa.array(rows), pa.array(n), *map(pa.array, values.T), pa.array(last)], names=columns)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, begun, few = shared.value
        shard, own, moved, steps = None, None, None, 0
        for at, y, _, text in _stored(parts):
            if at != shard:
                if steps:
                    yield out(own, moved, steps)
                shard, steps = at, 0
                own = Model(start.embedding.copy(), list(start.filters), start.bias, start.weight, start.offset)
                moved = {k: v.copy() if isinstance(v, np.ndarray) else v for k, v in begun.items()}
            if text.first[-1]:
                steps += 1
                _update(own, text, y, np.where(y == 1, heavy, 1.0), few, moved, step + steps)
        if steps:
            yield out(own, moved, steps)

    numbers = columns[2:]
    got = batches.mapInArrow(run, "row long, " + ", ".join(f"{c} double" for c in columns[1:])).groupBy("row").agg(
        F.sum("n").alias("n"), F.count("n").alias("shards"),
        *((F.sum(c) / F.sum("n")).alias(c) for c in numbers)).toArrow()  # no more rows than a network has
    shared.destroy()
    if not got.num_rows:
        return 0
    got = got.sort_by("row")
    row = got.column("row").to_numpy()
    values = np.stack([got.column(c).to_numpy() for c in numbers], axis=1)
    words = row < BUCKETS
    model.embedding[row[words]] = values[words, :DIM]
    second = state.setdefault("embedding", np.zeros(BUCKETS, np.float32))
    second[row[words]] = values[words, DIM]
    _unpack(values[~words, :DIM], model, state)
    return round(got.column("n")[-1].as_py() / got.column("shards")[-1].as_py())


def _calibrated(batches: DataFrame, model: Model) -> np.ndarray:
    """Thresholds from all rows of ``prepared`` batches, counted by language and step of the score."""
    shared = batches.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for _, y, language, text in _stored(parts):
            z = np.clip(_logits(net, text), -MOST_LOGIT, MOST_LOGIT)
            yield pa.RecordBatch.from_arrays([
                pa.array(language.astype(np.int64)), pa.array(np.floor(z * GRID).astype(np.int64)),
                pa.array(y.astype(np.int64))], names=["language", "at", "y"])

    got = batches.mapInArrow(run, "language long, at long, y long").groupBy("language", "at").agg(
        F.sum(1 - F.col("y")).alias("negative"), F.sum("y").alias("positive")).toArrow()
    shared.destroy()
    language, at, negative, positive = (got.column(i).to_numpy() for i in range(4))
    return _thresholds((at + 0.5) / GRID, negative, positive, language)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7,
        epochs: int = EPOCHS) -> Model:
    """Train on all of ``labels`` (``id, toxic``) and their texts.

    Three quarters of the rows train the network, the others set the
    thresholds.  Without rows of both classes the model scores every text
    alike.
    """
    spark = docs.sparkSession
    with free_shuffles(spark), long_rows(spark):
        rows = labelled(docs, labels, "toxic", id_col, text_col)
        batches = materialise(spark, prepared(rows), "toxic-batches")
        n, positive = (int(c or 0) for c in batches.agg(F.sum("n"), F.sum("positive")).first())
        model = _start(seed)
        if n >= 8 and 0 < positive < n:
            fitted = batches.filter("NOT held")
            rare, heavy = _rare(fitted), _class_weight(n - positive, positive)
            model.embedding[rare] = 0
            state: dict = {}
            step = 0
            for _ in range(epochs):
                step += _epoch(fitted, model, state, rare, heavy, step)
            model.thresholds = _calibrated(batches.filter("held"), model)
        discard(batches)
    return model


def scorer(docs: DataFrame, model: Model):
    """Column function: score of a text column, toxic at 0.7 and above; null reads as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    shift = float(np.log(CUT / (1 - CUT)))

    @F.arrow_udf("double")
    def toxic(texts: pa.Array) -> pa.Array:
        net = shared.value
        offsets, raw = W.buffers(texts)
        got = [np.zeros(0)]
        for lo, hi in W.chunks(offsets, CHUNK_BYTES):
            part = W.split_words(offsets[lo: hi + 1] - offsets[lo], raw[offsets[lo]: offsets[hi]])
            z = logits(net, part) - net.thresholds[languages(part)] + shift
            got.append(1 / (1 + np.exp(-np.clip(z, -50, 50))))
        return pa.array(np.round(np.concatenate(got), 6), pa.float64())  # sums differ by the batch beyond that

    return toxic


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` of every row: toxic at 0.7 and above.

    Null and empty texts score as texts without words.  Rows may repeat or
    lack an id; each gives one row.  Labels, ``lang``, ``source`` and ids
    are not read by the score, other columns are left out.
    """
    return docs.select(id_col, scorer(docs, model)(F.col(text_col)).alias("score"))
