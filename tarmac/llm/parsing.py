"""Operator 10: document fingerprints by locally consistent parsing.

A text's bytes are parsed into phrases, the phrases' names into longer
phrases, and so on.  On every level runs of one symbol are taken together;
deterministic coin tossing then shrinks the symbols to a few labels: a
symbol's label names the lowest bit in which it differs from its left
neighbour and that bit's value, which keeps neighbours different.  Local
maxima of the last labels start the phrases.  Where a phrase starts thus
depends on a few symbols around it and not on its offset, so equal
substrings get equal names in their interior.  A name is a hash of the
phrase's symbols.

The fingerprint holds two similarity sketches, one of the names of the
levels below the third (about 30 bytes and less each), one of all others,
and how many names the second one has.  Two texts are compared by both: the
more long names the poorer of them has, from ``FEW`` to ``MANY``, the more
weight theirs have.  No text changes its sketches at some length.  All of it
runs on whole batches of texts as arrays.

``edited_fingerprints`` needs each document's successor in id order.  Ids,
with a hash of the text and the row's number for equal ones, are ranged
first; the bounds of the ranges, one per partition, reach the driver.  Then
every text moves once, to its range, where sorted rows stream past; the
first row of the next range follows as an extra row.  Rows of one id, or
without an id, may fill many ranges.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import words as W
from tarmac.llm.minhash import sketches

COORDINATES = 64
LEVELS = 6
#: First level of the second sketch, and the names there from which, and above which wholly, it counts.
FIRST_LEVEL = 3
FEW, MANY = 8, 32
#: Text bytes parsed at once in a task.
CHUNK_BYTES = 1 << 20
_LOWEST = -(1 << 63)

# label of a symbol (low byte) given its left neighbour (high byte): the lowest differing bit and its value
_PAIRS = np.arange(1 << 16)
_LEFT, _OWN = _PAIRS >> 8, _PAIRS & 255
_BIT = np.bitwise_count(((_LEFT ^ _OWN) & -(_LEFT ^ _OWN)) - 1)
_TOSS = np.where(_LEFT == _OWN, 0, 2 * (_BIT % 8) + ((_OWN >> (_BIT % 8)) & 1)).astype(np.uint8)


def _toss(labels: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Next labels of byte-sized labels; a text's first one has a made-up left neighbour."""
    pair = labels.astype(np.uint16)
    pair[1:] |= pair[:-1] << np.uint16(8) if len(pair) > 1 else pair[:0]
    pair[first] = labels[first] | ((labels[first] ^ np.uint8(1)).astype(np.uint16) << np.uint16(8))
    return _TOSS[pair]


def _toss_wide(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    left = np.empty_like(symbols)
    left[1:] = symbols[:-1]
    left[first] = ~symbols[first]
    differ = symbols ^ left
    low = differ & (~differ + np.uint64(1))
    return (2 * np.bitwise_count(low - np.uint64(1)) + ((symbols & low) != 0)).astype(np.uint8)


def parse_level(symbols: np.ndarray, offsets: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names of each text's symbols (bytes on level 1, names above) and their offsets."""
    n = len(symbols)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    change = np.ones(n, bool)
    change[1:] = symbols[1:] != symbols[:-1]
    change[offsets[offsets < n]] = True
    at = np.flatnonzero(change)
    run = np.diff(np.append(at, n)).astype(np.uint64)
    base = symbols[at]
    bounds = np.searchsorted(at, offsets)
    first = bounds[:-1][np.diff(bounds) > 0]
    if base.dtype == np.uint8:
        labels = _toss(_toss(_toss(base, first), first), first)
        value = W._VALUES[base]
    else:
        labels = _toss(_toss(_toss(_toss_wide(base, first), first), first), first)
        value = base
    m = len(base)
    top = np.zeros(m, bool)
    if m > 2:
        top[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    ends = bounds[1:][np.diff(bounds) > 0] - 1
    top[ends] = False
    top[first] = True
    starts = np.flatnonzero(top)
    W._POWERS.upto(m + 1)
    sums = np.zeros(m + 1, np.uint64)
    np.cumsum(value * (np.uint64(2) * run - np.uint64(1)) * W._POWERS.up[:m], out=sums[1:])
    stops = np.append(starts[1:], m)
    names = W.mix((sums[stops] - sums[starts]) * W._POWERS.down[starts] + np.uint64(level))
    return names, np.searchsorted(starts, bounds)


def fingerprints(offsets: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Two sketches (texts x 2 COORDINATES) and the number of long names, up to ``MANY``, of each text, as uint16."""
    n = len(offsets) - 1
    symbols, bounds = raw, offsets
    low, high = ([], []), ([], [])
    for level in range(1, LEVELS + 1):
        above = np.diff(bounds) > (level > 1)  # a text that is one phrase already has no further names
        symbols, bounds = parse_level(symbols, bounds, level)
        owner = np.repeat(np.arange(n), np.diff(bounds))
        wanted = above[owner]
        owners, names = low if level < FIRST_LEVEL else high
        owners.append(owner[wanted])
        names.append(symbols[wanted])
    out = np.zeros((n, 2 * COORDINATES + 1), np.uint16)
    for i, (owners, names) in enumerate((low, high)):
        owners, names = np.concatenate(owners), np.concatenate(names)
        counts = np.bincount(owners, minlength=n)
        got = sketches(names[np.argsort(owners, kind="stable")], np.concatenate([[0], np.cumsum(counts)]), COORDINATES)
        got = (W.mix(got) >> np.uint64(48)).astype(np.uint16)
        out[:, i * COORDINATES: (i + 1) * COORDINATES] = np.where(counts[:, None] > 0, got, 0)
    out[:, -1] = np.minimum(counts, MANY)
    return out


def _likeness(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Share of common names, 2J / (1 + J), from the equal coordinates; two empty texts are alike."""
    same = a[:, :-1] == b[:, :-1]
    j = np.stack([same[:, :COORDINATES].mean(axis=1), same[:, COORDINATES:].mean(axis=1)])
    low, high = 2 * j / (1 + j)
    weight = np.clip((np.minimum(a[:, -1], b[:, -1]).astype(float) - FEW) / (MANY - FEW), 0, 1)
    out = weight * high + (1 - weight) * low
    empty_a, empty_b = size_a == 0, size_b == 0
    return np.where(empty_a | empty_b, (empty_a & empty_b).astype(float), out)


def _hex(sketch: np.ndarray, size: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() if k else "" for row, k in zip(sketch, size)]


def _of_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(t) for t in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return fingerprints(offsets, np.frombuffer(b"".join(texts), np.uint8)), sizes


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fingerprint`` of every row; null and empty texts have the empty string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, raw = W.buffers(batch.column(1))
            got: list[str] = []
            for lo, hi in W.chunks(offsets, CHUNK_BYTES):
                part = offsets[lo: hi + 1] - offsets[lo]
                got += _hex(fingerprints(part, raw[offsets[lo]: offsets[hi]]), np.diff(part))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.string())], names=["id", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, fingerprint string").withColumnRenamed("id", id_col)


_SCHEMA = ("id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def _with_next(rows: list[tuple[int | None, str]]) -> pa.RecordBatch:
    """Result rows of all but the last row, each with the row after it."""
    texts = [t for _, t in rows]
    edited = []
    for text, after in zip(texts, texts[1:]):
        k = len(text) // 4
        edited.append((text[: len(text) - k] + after[:k]).encode())
    own, size = _of_texts([t.encode() for t in texts])
    other, other_size = _of_texts(edited)
    return pa.RecordBatch.from_arrays([
        pa.array([i for i, _ in rows[:-1]], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
        pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
        pa.array(_hex(own[:-1], size[:-1])), pa.array(_hex(other, other_size)),
        pa.array(_likeness(own[:-1], other, size[:-1], other_size)),
        pa.array(_likeness(own[:-1], own[1:], size[:-1], size[1:])),
    ], names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, one row per row of ``docs``.

    The edited text has its last quarter (rounded down, in code points)
    replaced by the first as many code points of the next document in
    ascending id, after the last by those of the first.  Null texts are
    read as empty.  A row without an id stands before all others; rows with
    one id follow each other by a hash of their text.  Ids are integers;
    other columns are left out.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keyed = keyed.withColumns({"k": F.coalesce("id", F.lit(_LOWEST)), "h": F.xxhash64("text"),
                               "r": F.monotonically_increasing_id()})
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = sorted(tuple(r["low"]) for r in keyed.select("k", "h", "r").repartitionByRange(parts, "k", "h", "r").groupBy(
        F.spark_partition_id()).agg(F.min(F.struct("k", "h", "r")).alias("low")).collect())  # three numbers per partition
    if not bounds:
        return spark.createDataFrame([], _SCHEMA).withColumnRenamed("id", id_col)
    cuts = bounds[1:]

    @F.pandas_udf("int")
    def range_of(k: pd.Series, h: pd.Series, r: pd.Series) -> pd.Series:
        ids = np.array([c[0] for c in cuts], np.int64)
        at = np.searchsorted(ids, k.to_numpy(np.int64), side="left")
        for i in np.flatnonzero(np.append(ids, _LOWEST)[at] == k.to_numpy(np.int64)):  # ids that begin a range
            at[i] = bisect.bisect_right(cuts, (k[i], h[i], r[i]))
        return pd.Series(at.astype(np.int32))

    # the first row of a range follows the range before; the first of all follows the last
    places = [(*low, (i - 1) % len(bounds)) for i, low in enumerate(bounds)]
    places = spark.createDataFrame(places, "k long, h long, r long, part int")
    extra = keyed.join(F.broadcast(places), ["k", "h", "r"]).select(
        "k", "h", "r", "id", "text", "part", F.lit(True).alias("extra"))
    own = keyed.select("k", "h", "r", "id", "text", range_of("k", "h", "r").alias("part"), F.lit(False).alias("extra"))
    moved = own.unionByName(extra).repartitionById(len(bounds), "part").sortWithinPartitions("part", "extra", "k", "h", "r")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int | None, str]] = []
        part, size = None, 0
        for batch in batches:
            for i, text, now, is_extra in zip(*(batch.column(c) for c in range(4))):
                now, text = now.as_py(), text.as_py()
                if now != part:
                    rows, part, size = [], now, 0
                rows.append((i.as_py(), text))
                size += len(text)
                if len(rows) > 1 and (size >= CHUNK_BYTES or is_extra.as_py()):
                    yield _with_next(rows)
                    rows, size = rows[-1:], len(text)

    return moved.select("id", "text", "part", "extra").mapInArrow(run, _SCHEMA).withColumnRenamed("id", id_col)
