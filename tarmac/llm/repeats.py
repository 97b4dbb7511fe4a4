"""Operator 12: removal of repeated byte strings by a depth-limited radix sort of suffixes.

Two suffixes belong together if their first ``DEPTH`` bytes (a window) are
equal; no byte further on is ever looked at.  Suffixes are sorted by most
significant digits, and those alone with their digits so far leave the sort:

* The first digit of a window is its anchor: of the ``DIGIT``-byte strings
  inside it the one with the smallest hash, the leftmost of equals.  Equal
  windows have equal anchors at the same offset, and the windows that share
  an anchor in a text are neighbours, so one key stands for up to ``REACH``
  suffixes.  Only anchors that several documents hold go on.
* The other digits are the windows' own bytes, eight at a time.  The windows
  of an anchor are sent as the one string that spans them; tasks sort them,
  group by group, until ``DEPTH`` bytes are passed.  What is equal then is a
  repeated window, and the smallest document id of its group decides where
  it stays.

Documents are dealt once to packs of about ``PACK_BYTES``; each pass asks
from there.  A pack sends each key (or string) once, with its number of
documents (or smallest id), to the bucket that owns the key's leading bits,
and gets its findings back by position.  So a string that a third of all
documents hold is a row per pack, not per document.  An anchor in over
``HOT`` documents sends its windows one by one, each to the bucket of its
own hash, so that a common line with ever other neighbours does not meet in
one bucket either.  For a larger corpus raise ``pack_bytes`` and
``bucket_bytes`` together with the memory of the workers: fewer, longer rows
go between packs and buckets.

A null or empty text, and one of fewer than ``DEPTH`` bytes, keeps all bytes.
A row without an id neither removes nor loses anything.  Rows that share an
id are one document: they do not take from each other.  An empty table gives
no rows.  Very long texts are hashed in pieces; their pack grows with them.
Other columns are left out.  Ids are integers.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import words as W

#: Bytes of a repeated string, and of the anchor inside it.
DEPTH = 50
DIGIT = 24
#: Places of an anchor in a window; also the windows that one anchor can stand for.
REACH = DEPTH - DIGIT + 1
#: Bytes of the string that spans an anchor's windows, and of its row: string, windows, bytes before the anchor, alone.
SPAN = DEPTH + REACH - 1
ROW = 80
PACK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
HOT = 2_000
#: Windows hashed, strings compared and windows sorted at once.
PIECE = 1 << 18
STRINGS = 1 << 15
SORTED = 1 << 18
_LOW = np.uint64((1 << 19) - 1)
_ALL = np.uint32((1 << REACH) - 1)


def _eight(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on (zeros behind the end) as an integer."""
    return np.ndarray(len(raw), "<u8", np.concatenate([raw, np.zeros(8, np.uint8)]), strides=(1,))


def _digit(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Hash of 24 bytes, given as three mixed integers."""
    return W.mix(a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xD6E8FEB86659FD93) + c)


def anchors(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First digits of all windows: place and hash of each anchor, the first of its windows and their number."""
    out = [[np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)]]
    for lo in range(0, len(raw) - DEPTH + 1, PIECE):
        piece = raw[lo: lo + PIECE + DEPTH - 1]
        n = len(piece) - DEPTH + 1
        mixed = W.mix(_eight(piece)[:-7])
        hashes = _digit(mixed[:-16], mixed[8:-8], mixed[16:])
        least, span = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64), 1
        while 2 * span <= REACH:
            least, span = np.minimum(least[:-span], least[span:]), 2 * span
        least = np.minimum(least[:n], least[REACH - span:])
        cuts = offsets[(offsets > lo) & (offsets < lo + len(piece))] - lo  # windows over a text's end
        edge = np.zeros(n + 1, np.int32)
        np.add.at(edge, np.clip(cuts - DEPTH + 1, 0, n), 1)
        np.add.at(edge, np.minimum(cuts, n), -1)
        start = np.flatnonzero(np.cumsum(edge[:n]) == 0)
        if not len(start):
            continue
        place = (least[start] & _LOW).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        out.append([lo + place[first], lo + start[first], np.diff(np.r_[first, len(start)]), hashes[place[first]]])
    place, start, count, hashes = (np.concatenate(x) for x in zip(*out))
    if len(place):  # an anchor's windows may lie in two pieces
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        place, start, count, hashes = place[first], start[first], np.add.reduceat(count, first), hashes[first]
    return place, start, count, hashes


def _bucket(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def _slices(buckets: np.ndarray):
    """Bucket, first and last + 1 of each run of equal buckets."""
    first = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]]) if len(buckets) else buckets
    return zip(buckets[first].tolist(), first.tolist(), np.r_[first[1:], len(buckets)].tolist())


def _packed(values: np.ndarray) -> bytes:
    """Bytes of an array compressed, those of equal significance together if it holds numbers."""
    flat = values if values.ndim > 1 else np.ascontiguousarray(values.reshape(-1, 1).view(np.uint8).T)
    return pa.compress(flat.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = pa.decompress(data, n * width, codec="zstd", asbytes=True)
    if width == ROW:
        return np.frombuffer(raw, kind)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, n).T).view(kind)[:, 0]


class Pack:
    """Texts of a pack with the anchors of their windows."""

    def __init__(self, table: pa.Table):
        self.ids = table.column("id")
        self.offsets, self.raw = W.buffers(table.column("text"))
        place, start, count, hashes = anchors(self.offsets, self.raw)
        owner = np.searchsorted(self.offsets, start, side="right") - 1
        named = self.ids.is_valid().to_numpy()[owner]
        self.place, self.start, self.count, self.hashes = place[named], start[named], count[named], hashes[named]
        self.doc = self.ids.fill_null(0).to_numpy()[owner[named]]
        self.keys, self.key_of = np.unique(self.hashes >> np.uint64(16), return_inverse=True)

    def documents(self) -> np.ndarray:
        """In how many documents each key stands."""
        order = np.lexsort((self.doc, self.key_of))
        key, doc = self.key_of[order], self.doc[order]
        new = np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])] if len(key) else np.zeros(0, bool)
        return np.bincount(key[new], minlength=len(self.keys))

    def strings(self, repeated: np.ndarray, hot: np.ndarray) -> Strings:
        """What the pack sends for the anchors whose keys are repeated."""
        at = np.flatnonzero(repeated[self.key_of])
        padded = np.concatenate([self.raw, np.zeros(SPAN, np.uint8)])
        rows = _rows(np.lib.stride_tricks.sliding_window_view(padded, SPAN)[self.start[at]], self.count[at],
                     self.place[at] - self.start[at], 0)
        return Strings(Entries(rows, self.doc[at]), hot[self.key_of[at]], self.start[at])


def _rows(spans: np.ndarray, count: np.ndarray, before: np.ndarray, alone: int) -> np.ndarray:
    """Rows of strings: their bytes, windows, bytes before the anchor, and whether they are single windows of hot anchors."""
    rows = np.zeros((len(spans), ROW), np.uint8)
    rows[:, :spans.shape[1]] = spans
    rows[:, :spans.shape[1]][np.arange(spans.shape[1]) >= (count + DEPTH - 1)[:, None]] = 0
    rows[:, SPAN], rows[:, SPAN + 1], rows[:, SPAN + 2] = count, before, alone
    return rows


def group_keys(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of each row (anchor's hash, or the row's own if its window is alone) and the row's hash."""
    lanes = rows.view("<u8")
    own = np.zeros(len(rows), np.uint64)
    for i in range(ROW // 8):
        own = W.mix(own * np.uint64(0x9E3779B97F4A7C15) + lanes[:, i])
    eight = _eight(rows.reshape(-1))
    at = ROW * np.arange(len(rows)) + rows[:, SPAN + 1]
    group = _digit(*(W.mix(eight[at + 8 * i]) for i in range(3))) if len(rows) else own
    return np.where(rows[:, SPAN + 2] == 1, own, group), own


class Entries:
    """Strings in the order of their groups, equal ones as one; ``of``: number of each string given."""

    def __init__(self, rows: np.ndarray, doc: np.ndarray):
        group, own = group_keys(rows)
        order = np.lexsort((own, group))
        rows, group = rows[order], group[order]
        lanes = rows.view("<u8")
        new = np.flatnonzero(np.r_[True, (lanes[1:] != lanes[:-1]).any(axis=1)]) if len(rows) else np.zeros(0, np.int64)
        self.of = np.empty(len(rows), np.int64)
        self.of[order] = np.repeat(np.arange(len(new)), np.diff(np.r_[new, len(rows)]))
        self.rows, self.group = rows[new], group[new]
        self.least = np.minimum.reduceat(doc[order], new) if len(new) else doc
        self.doc = doc


class Strings:
    """The different strings of a pack, and what of them is sent: strings whole, those of hot anchors by window."""

    def __init__(self, whole: Entries, hot: np.ndarray, start: np.ndarray):
        self.whole, self.start = whole, start
        split = np.zeros(len(whole.rows), bool)
        split[whole.of] = hot
        self.sent_whole = np.flatnonzero(~split)
        split = np.flatnonzero(split)
        count = whole.rows[split, SPAN].astype(np.int64)
        self.string = np.repeat(split, count)  # of each window sent alone
        self.step = np.arange(len(self.string)) - np.repeat(np.cumsum(count) - count, count)
        flat = np.concatenate([whole.rows.reshape(-1), np.zeros(DEPTH, np.uint8)])
        windows = np.lib.stride_tricks.sliding_window_view(flat, DEPTH)[ROW * self.string + self.step]
        rows = _rows(windows, np.ones(len(windows), np.int64), whole.rows[self.string, SPAN + 1] - self.step, 1)
        self.sent = Entries(np.concatenate([whole.rows[self.sent_whole], rows]),
                            np.concatenate([whole.least[self.sent_whole], whole.least[self.string]]))

    def masks(self, found: np.ndarray) -> np.ndarray:
        """Bits of each place's windows that an earlier document holds; ``found``: those of what was sent."""
        out = np.zeros(len(self.whole.rows), np.uint32)
        n = len(self.sent_whole)
        out[self.sent_whole] = found[self.sent.of[:n]]
        of = self.sent.of[n:]
        earlier = (found[of] & 1 == 1) | (self.sent.least[of] < self.whole.least[self.string])
        np.bitwise_or.at(out, self.string, earlier.astype(np.uint32) << self.step.astype(np.uint32))
        # a string that another document of the pack with a smaller id has goes whole
        return np.where(self.whole.doc > self.whole.least[self.whole.of], _ALL, out[self.whole.of])


def equal_windows(eight: np.ndarray, at: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Most-significant-digit passes over the windows that begin at ``at``.

    Returns the windows that are equal to another one of their group through
    ``DEPTH`` bytes, and a number of the class of each.
    """
    left = np.arange(len(at))
    for depth in range(0, DEPTH, 8):
        digit = eight[at[left] + depth]
        if depth + 8 > DEPTH:
            digit = digit & np.uint64((1 << 8 * (DEPTH - depth)) - 1)
        order = np.lexsort((digit, group))
        left, group, digit = left[order], group[order], digit[order]
        if not len(left):
            break
        group = np.cumsum(np.r_[False, (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])])
        shared = np.bincount(group)[group] > 1
        left, group = left[shared], group[shared]
    return left, group


def least_documents(entries: Entries) -> np.ndarray:
    """For each string and each of its windows the smallest id of a document with that window."""
    least = np.repeat(entries.least[:, None], REACH, axis=1)
    first = np.flatnonzero(np.r_[True, entries.group[1:] != entries.group[:-1]]) if len(least) else []
    size = np.diff(np.r_[first, len(least)]).astype(np.int64)
    several = np.flatnonzero(np.repeat(size > 1, size))  # strings that differ from others of their group
    number = np.repeat(np.arange(len(size)), size)[several]
    count = entries.rows[several, SPAN].astype(np.int64)
    eight = _eight(entries.rows.reshape(-1))
    lo = 0
    while lo < len(several):  # whole groups, about SORTED windows at once
        hi = int(np.searchsorted(np.cumsum(count[lo:]), SORTED)) + lo + 1
        hi = int(np.searchsorted(number, number[min(hi, len(several)) - 1], side="right"))
        part, n = several[lo:hi], count[lo:hi]
        string = np.repeat(part, n)
        step = np.arange(len(string)) - np.repeat(np.cumsum(n) - n, n)
        offset = entries.rows[string, SPAN + 1] - step  # of the anchor in the window
        left, group = equal_windows(eight, ROW * string + step, np.repeat(number[lo:hi], n) * REACH + offset)
        if len(left):
            begin = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            low = np.minimum.reduceat(entries.least[string[left]], begin)
            least[string[left], step[left]] = np.repeat(low, np.diff(np.r_[begin, len(left)]))
        lo = hi
    return least


def window_masks(strings: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Bit i of a string: its i-th window stands in a document with a smaller id than its own."""
    entries = Entries(strings, doc)
    least, count = least_documents(entries), strings[:, SPAN]
    mask = np.zeros(len(doc), np.uint32)
    for i in range(REACH):
        mask |= ((least[entries.of, i] < doc) & (i < count)).astype(np.uint32) << np.uint32(i)
    return mask


_ASK = "kind int, bucket long, pack long, base long, n long, data binary, more binary"
_TELL = "pack long, kind int, base long, n long, data binary, more binary"
_KEYS, _STRINGS, _FLAGS = 0, 1, 2


def _table(rows: list[tuple], names: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [pa.field(n, kinds[k]) for n, k in (x.split() for x in names.split(", "))]
    return pa.Table.from_arrays(
        [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(fields)], schema=pa.schema(fields))


def _ask_keys(bits: int):
    def run(key: tuple, docs: pa.Table) -> pa.Table:
        pack = Pack(docs)
        count = pack.documents()
        return _table([
            (_KEYS, bucket, key[0].as_py(), a, b - a, _packed(np.diff(pack.keys[a:b], prepend=np.uint64(0))),
             _packed(count[a:b].astype(np.uint32)))
            for bucket, a, b in _slices(_bucket(pack.keys << np.uint64(16), bits))], _ASK)
    return run


def _tell_keys(hot: int):
    """Findings for each pack: which of its keys several documents hold, and which of them too many."""
    def run(key: tuple, asked: pa.Table) -> pa.Table:
        rows = asked.to_pylist()
        keys = [np.cumsum(_unpacked(r["data"], r["n"], np.uint64)) for r in rows]
        counts = np.concatenate([_unpacked(r["more"], r["n"], np.uint32) for r in rows]).astype(np.int64)
        _, of = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(of, weights=counts)[of]
        ends = np.cumsum([r["n"] for r in rows])
        out = []
        for r, part in zip(rows, np.split(total, ends[:-1])):
            found = np.flatnonzero(part >= 2)
            if len(found):
                out.append((r["pack"], _FLAGS, r["base"], len(found), _packed((r["base"] + found).astype(np.uint32)),
                            _packed((part[found] > hot).astype(np.uint8))))
        return _table(out, _TELL)
    return run


def _flags(told: list[dict], keys: int) -> tuple[np.ndarray, np.ndarray]:
    repeated, hot = np.zeros(keys, bool), np.zeros(keys, bool)
    for r in told:
        if r["kind"] == _FLAGS:
            at = _unpacked(r["data"], r["n"], np.uint32)
            repeated[at], hot[at] = True, _unpacked(r["more"], r["n"], np.uint8) == 1
    return repeated, hot


def _ask_strings(bits: int):
    def run(key: tuple, docs: pa.Table, told: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _table([], _ASK)
        number, pack, flags = key[0].as_py(), Pack(docs), told.to_pylist()
        entries = pack.strings(*_flags(flags, len(pack.keys))).sent
        rows = [(_STRINGS, bucket, number, a, b - a, _packed(entries.rows[a:b]), _packed(entries.least[a:b]))
                for bucket, a, b in _slices(_bucket(entries.group, bits))]
        # what the first pass found comes along, for the last one
        rows += [(_FLAGS, number % (1 << bits), number, r["base"], r["n"], r["data"], r["more"]) for r in flags]
        return _table(rows, _ASK)
    return run


def _tell_strings(key: tuple, asked: pa.Table) -> pa.Table:
    """Findings for each pack: which windows of its strings a document with a smaller id holds."""
    rows = asked.to_pylist()
    out = [(r["pack"], _FLAGS, r["base"], r["n"], r["data"], r["more"]) for r in rows if r["kind"] == _FLAGS]
    rows = [r for r in rows if r["kind"] == _STRINGS]
    if not rows:
        return _table(out, _TELL)
    strings = np.concatenate([_unpacked(r["data"], r["n"], f"V{ROW}") for r in rows])
    strings = strings.view(np.uint8).reshape(-1, ROW)
    doc = np.concatenate([_unpacked(r["more"], r["n"], np.int64) for r in rows])
    mask = np.zeros(len(doc), np.uint32)
    group, _ = group_keys(strings)
    order = np.argsort(group, kind="stable")
    group, lo = group[order], 0
    while lo < len(order):  # whole groups, about STRINGS strings at once
        hi = int(np.searchsorted(group, group[min(lo + STRINGS, len(order)) - 1], side="right"))
        mask[order[lo:hi]] = window_masks(strings[order[lo:hi]], doc[order[lo:hi]])
        lo = hi
    for r, part in zip(rows, np.split(mask, np.cumsum([r["n"] for r in rows])[:-1])):
        if part.any():
            out.append((r["pack"], _STRINGS, r["base"], r["n"], _packed(part), b""))
    return _table(out, _TELL)


def covered_bytes(pack: Pack, told: list[dict]) -> np.ndarray:
    """Whether each byte of the pack's texts lies in a window that an earlier document holds."""
    strings = pack.strings(*_flags(told, len(pack.keys)))
    found = np.zeros(len(strings.sent.rows), np.uint32)
    for r in told:
        if r["kind"] == _STRINGS:
            found[r["base"]: r["base"] + r["n"]] = _unpacked(r["data"], r["n"], np.uint32)
    mask = strings.masks(found)
    count = strings.whole.rows[strings.whole.of, SPAN]
    edge = np.zeros(len(pack.raw) + 1, np.int8)  # at most DEPTH windows cover a byte
    for step in range(REACH):
        at = strings.start[((mask >> np.uint32(step)) & 1 == 1) & (step < count)] + step
        edge[at] += 1
        edge[at + DEPTH] -= 1
    return np.cumsum(edge[:-1], dtype=np.int8) > 0


def _keep(kind: pa.DataType):
    def run(key: tuple, docs: pa.Table, told: pa.Table) -> pa.Table:
        pack = Pack(docs)
        gone = covered_bytes(pack, told.to_pylist())
        before = np.r_[False, gone[:-1]]
        begins = pack.offsets[:-1][pack.offsets[:-1] < len(gone)]
        if len(gone):
            before[begins] = False
        start = np.flatnonzero(gone & ~before)
        after = np.r_[gone[1:], False]
        last = pack.offsets[1:] - 1
        after[last[last >= 0]] = False
        end = np.flatnonzero(gone & ~after) + 1
        first = np.searchsorted(start, pack.offsets)
        owner = np.repeat(np.arange(docs.num_rows), np.diff(first))
        base = pack.offsets[owner]
        spans = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.StructArray.from_arrays(
            [pa.array(start - base), pa.array(end - base)], ["start", "end"]))
        keep = ~gone
        sizes = np.diff(pack.offsets)
        left = sizes.copy()
        some = np.flatnonzero(sizes)
        left[some] = np.add.reduceat(keep, pack.offsets[some], dtype=np.int64) if len(some) else 0
        kept_ends = np.r_[0, np.cumsum(left)]
        kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), docs.num_rows, [
            None, pa.py_buffer(kept_ends), pa.py_buffer(np.ascontiguousarray(pack.raw[keep]))]).cast(pa.binary())
        return pa.Table.from_arrays([docs.column("id").cast(kind), pa.array(sizes), spans, kept],
                                    names=["id", "n_bytes", "spans", "kept"])
    return run


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pack_bytes: int = PACK_BYTES,
           bucket_bytes: int = BUCKET_BYTES, hot: int = HOT) -> DataFrame:
    """``id, n_bytes, spans, kept`` of every row: its removed runs of bytes (start, end) and the bytes that stay."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packs = max(least, math.ceil(size / pack_bytes))
    bits = max(least, math.ceil(size / bucket_bytes)).bit_length()
    number = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(packs))
    dealt = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), number.alias("pack"))
    by_pack = dealt.groupBy("pack")
    keys = by_pack.applyInArrow(_ask_keys(bits), _ASK)
    told = keys.groupBy("bucket").applyInArrow(_tell_keys(hot), _TELL)
    strings = by_pack.cogroup(told.groupBy("pack")).applyInArrow(_ask_strings(bits), _ASK)
    told = strings.groupBy("bucket").applyInArrow(_tell_strings, _TELL)
    return by_pack.cogroup(told.groupBy("pack")).applyInArrow(
        _keep(pa.int64()), "id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")


def summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""
    return remove(docs, id_col, text_col).select(
        F.col("id").alias(id_col), "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
