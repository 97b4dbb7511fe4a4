"""Operator 11: filter interaction audit.

One pass of a byte transducer over the UTF-8 text of each document counts
words, capitals, code points and symbols.  Its two states say whether the
byte before was white space or part of a word; ``STEP`` holds the next state
and ``EMIT`` the output for every state and byte.  Each byte alone fixes the
next state, so a whole block of bytes is looked up at once.  The spans of the
words go into an open-addressing hash table in which two spans are one word
only if their text and all their bytes agree, so distinct counts are exact.

From the measures come five failure conditions per document (``FILTERS``),
and from those what every order of the filters keeps, removes and costs.

Any column may be null: a null text is empty, a null source the part ``''``,
a document without an id has no smaller one and is smaller than none, one
without labels is neither good nor toxic.  Repeated rows count each.  Several
labels of one id: good or toxic if one of them says so.  No documents give no
rows.  Texts of any length are read in blocks; a worker holds the text and
its distinct words.  Other columns are left out.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import words as W
from tarmac.llm.common import materialise

#: Filters in the order of their bits: few words, repeated words, capitals, symbols, copy of an earlier text.
FILTERS = "ABCDE"
LEAST_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 2
SYMBOLS = b"#$%&*|"
#: Bytes run at once: the four 16-bit counters of an output word cannot overflow.
BLOCK = (1 << 16) - 1
#: Word spans inserted at once.
SPANS = 1 << 16

SPACE, WORD = 0, 1
_COUNTERS = ("words", "capitals", "points", "symbols")


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Next state by byte, and packed counters (16 bits each) by state and byte."""
    byte = np.arange(256)
    step = np.where(W.SPACES, SPACE, WORD).astype(np.uint8)
    one = {name: np.uint64(1 << 16 * i) for i, name in enumerate(_COUNTERS)}
    plain = ((byte >= 65) & (byte <= 90)) * one["capitals"]
    plain = plain + ((byte < 0x80) | (byte >= 0xC0)) * one["points"]  # no continuation byte
    plain = plain + np.isin(byte, list(SYMBOLS)) * one["symbols"]
    emit = np.stack([plain + (step == WORD) * one["words"], plain])
    return step, emit.astype(np.uint64)


STEP, EMIT = _tables()


def transduce(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counters of each text (columns as ``_COUNTERS``), and first and last + 1 byte of every word."""
    totals = np.zeros((len(offsets) - 1, 4), np.int64)
    starts, ends, state = [], [], SPACE
    for lo in range(0, len(raw), BLOCK):
        block = raw[lo: lo + BLOCK]
        hi = lo + len(block)
        after = STEP[block]
        before = np.empty_like(after)
        before[0], before[1:] = state, after[:-1]
        a, b = np.searchsorted(offsets, [lo, hi])  # texts that begin in the block
        opened = offsets[a:b] - lo
        cut = np.unique(opened[opened < len(block)])
        cut = cut[before[cut] == WORD]  # the text before ended inside a word
        before[cut] = SPACE
        out = EMIT[before, block]
        first = int(np.searchsorted(offsets, lo, side="right")) - 1
        texts = np.arange(first, int(np.searchsorted(offsets, hi)))
        begin = np.maximum(offsets[texts], lo) - lo
        some = np.maximum(offsets[texts], lo) < np.minimum(offsets[texts + 1], hi)
        sums = np.add.reduceat(out, begin[some])
        for i in range(4):
            totals[texts[some], i] += ((sums >> np.uint64(16 * i)) & np.uint64(0xFFFF)).astype(np.int64)
        starts.append(lo + np.flatnonzero((after == WORD) & (before == SPACE)))
        ends.append(lo + np.union1d(np.flatnonzero((after == SPACE) & (before == WORD)), cut))
        state = int(after[-1])
    if state == WORD:
        ends.append(np.array([len(raw)]))
    none = np.zeros(0, np.int64)
    return totals, np.concatenate([none, *starts]), np.concatenate([none, *ends])


class WordTable:
    """Set of (text, word) pairs given as spans of one buffer, by open addressing with verification."""

    def __init__(self, raw: np.ndarray):
        padded = np.concatenate([raw, np.zeros(8, np.uint8)])
        self.eight = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))
        self.slots = np.full(1 << 10, -1, np.int64)
        self.text, self.start, self.size = (np.zeros(0, np.int64) for _ in range(3))
        self.hash = np.zeros(0, np.uint64)

    def _lanes(self, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words' bytes as 8-byte lanes, the lane's place in its word, and each word's first lane."""
        count = (size + 7) >> 3
        last = np.cumsum(count)
        first = last - count
        place = np.arange(last[-1]) - np.repeat(first, count)
        lane = self.eight[np.repeat(start, count) + 8 * place]
        unused = (8 * count - size).astype(np.uint64) * np.uint64(8)
        lane[last - 1] &= np.uint64(0xFFFFFFFFFFFFFFFF) >> unused
        return lane, place, first

    def _hashes(self, text: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        lane, place, first = self._lanes(start, size)
        mixed = W.mix(lane + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        return W.mix(np.add.reduceat(mixed, first) + text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def _grow(self, words: int) -> None:
        if 2 * words <= len(self.slots):
            return
        self.slots = np.full(1 << (2 * words).bit_length(), -1, np.int64)
        left, slot = np.arange(len(self.hash)), self._slot(self.hash)
        while len(left):  # all differ: a word goes to the next free slot
            free = self.slots[slot[left]] < 0
            self.slots[slot[left[free]]] = left[free]
            left = left[self.slots[slot[left]] != left]
            slot[left] = (slot[left] + 1) & (len(self.slots) - 1)

    def insert(self, text: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        known, size = len(self.text), end - start
        self._grow(known + len(start))
        hashes = self._hashes(text, start, size)
        texts, starts, sizes = (np.concatenate(x) for x in ((self.text, text), (self.start, start), (self.size, size)))
        slot, left = self._slot(hashes), np.arange(len(start))
        while len(left):
            free = self.slots[slot[left]] < 0
            self.slots[slot[left[free]]] = known + left[free]
            owner = self.slots[slot[left]]
            own = known + left
            same = owner == own
            maybe = np.flatnonzero(~same & (texts[owner] == texts[own]) & (sizes[owner] == sizes[own]))
            if len(maybe):
                mine, place, first = self._lanes(starts[own[maybe]], sizes[own[maybe]])
                other, _, _ = self._lanes(starts[owner[maybe]], sizes[owner[maybe]])
                same[maybe] = np.logical_and.reduceat(mine == other, first)
            left = left[~same]
            slot[left] = (slot[left] + 1) & (len(self.slots) - 1)
        new = self.slots[slot] == known + np.arange(len(start))  # the spans that hold their word's slot
        self.slots[slot[new]] = known + np.arange(new.sum())
        self.text, self.start, self.size = (np.concatenate([x[:known], x[known:][new]]) for x in (texts, starts, sizes))
        self.hash = np.concatenate([self.hash, hashes[new]])

    def counts(self, texts: int) -> np.ndarray:
        return np.bincount(self.text, minlength=texts)


def count_texts(offsets: np.ndarray, raw: np.ndarray) -> dict[str, np.ndarray]:
    """``words, distinct, capitals, points, symbols`` of each text."""
    totals, start, end = transduce(offsets, raw)
    table = WordTable(raw)
    owner = np.searchsorted(offsets, start, side="right") - 1
    for lo in range(0, len(start), SPANS):
        table.insert(owner[lo: lo + SPANS], start[lo: lo + SPANS], end[lo: lo + SPANS])
    out = dict(zip(_COUNTERS, totals.T))
    return out | {"distinct": table.counts(len(offsets) - 1)}


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``id, part, words, distinct, capitals, points, symbols, digest`` of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["words", "distinct", "capitals", "points", "symbols"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, raw = W.buffers(batch.column(2))
            got = count_texts(offsets, raw)
            digests = [hashlib.sha256(raw[a:b]).digest() for a, b in itertools.pairwise(offsets.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(got[n].astype(np.int64)) for n in names),
                 pa.array(digests, pa.binary())], names=["id", "part", *names, "digest"])

    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    return docs.select(id_col, part.alias("part"), text_col).mapInArrow(
        run, f"id {kind}, part string, {', '.join(f'{n} long' for n in names)}, digest binary")


def _bit(condition, i: int):
    return F.when(condition, F.lit(1 << i)).otherwise(F.lit(0))


def failures(measured: DataFrame) -> DataFrame:
    """``id, part, digest, fails``: bits of the failed filters that one document alone decides (A to D)."""
    checks = [F.col("words") < LEAST_WORDS,
              100 * F.col("distinct") < DISTINCT_PERCENT * F.col("words"),
              100 * F.col("capitals") > CAPITAL_PERCENT * F.col("points"),
              F.col("symbols") > 0]
    fails = sum((_bit(c, i) for i, c in enumerate(checks)), F.lit(0))
    return measured.select("id", "part", "digest", fails.alias("fails"))


def profile(failed: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``part, mask, n, good, toxic``: documents by the set of filters they fail (bits, E included).

    Rows meet by document, by text and by part, each time after equal rows
    were added up, so neither a hot source, nor a hot text, nor a repeated
    id goes to one task whole.
    """
    marks = labels.groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    rows = failed.groupBy("id", "digest", "part", "fails").agg(F.count(F.lit(1)).alias("n"))
    no = F.lit(False)
    named = rows.filter("id IS NOT NULL").join(marks, "id", "left").withColumns(
        {"good": F.coalesce("good", no), "toxic": F.coalesce("toxic", no)})
    named = named.unionByName(rows.filter("id IS NULL").withColumns({"good": no, "toxic": no}))
    cells = named.groupBy("digest", "part", "fails", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("id").alias("low"), F.min_by("n", "id").alias("at_low"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("unnamed"))
    lowest = cells.groupBy("digest").agg(F.min("low").alias("lowest"))
    first = F.when(F.col("low") == F.col("lowest"), F.col("at_low")).otherwise(F.lit(0)) + F.col("unnamed")
    both = F.array(F.struct(F.col("fails").alias("mask"), first.alias("k")),
                   F.struct((F.col("fails") + 16).alias("mask"), (F.col("n") - first).alias("k")))
    split = cells.join(lowest, "digest").select("part", "good", "toxic", F.explode(both).alias("x"))
    k = F.col("x.k")
    return split.groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum(k).alias("n"), F.coalesce(F.sum(F.when(F.col("good"), k)), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("toxic"), k)), F.lit(0)).alias("toxic"))


def _steps() -> str:
    """Every step of every order: its filter's bit and the bits of those applied before it."""
    rows = []
    for order in itertools.permutations(range(len(FILTERS))):
        name = "".join(FILTERS[i] for i in order)
        for step, i in enumerate(order):
            rows.append({"filter_order": name, "step": step + 1, "bit": 1 << i,
                         "before": sum(1 << j for j in order[:step])})
    return json.dumps(rows)


def orders(profiled: DataFrame) -> DataFrame:
    """What each step of each order of the filters does, per part, from at most 32 counts of the part."""
    cells = profiled.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    steps = F.from_json(F.lit(_steps()), "array<struct<filter_order: string, step: int, bit: int, before: int>>")
    rows = cells.select("part", "cells", F.inline(steps))
    bit, before = F.col("bit"), F.col("before")

    def total(value, where) -> F.Column:
        return F.aggregate(F.filter("cells", where), F.lit(0).cast("long"), lambda a, x: a + value(x))

    def fails(x):
        return x["mask"].bitwiseAND(bit) != 0

    def earlier(x):
        return x["mask"].bitwiseAND(before) != 0

    n_filters = len(FILTERS)
    n_orders = len(list(itertools.permutations(FILTERS)))
    share = F.create_map(*itertools.chain.from_iterable(  # orders in which one of k failed filters comes first
        (F.lit(k), F.lit(n_orders // k).cast("long")) for k in range(1, n_filters + 1)))
    return rows.select(
        "part", "filter_order", "step",
        total(lambda x: x["n"], lambda x: ~fails(x) & ~earlier(x)).alias("kept"),
        total(lambda x: x["n"], lambda x: fails(x) & ~earlier(x)).alias("removed"),
        total(lambda x: x["n"], lambda x: fails(x) & earlier(x)).alias("redundant"),
        total(lambda x: x["n"], lambda x: x["mask"] == bit).alias("unique_fails"),
        total(lambda x: x["good"], lambda x: fails(x) & ~earlier(x)).alias("good_lost"),
        total(lambda x: x["toxic"], lambda x: fails(x) & ~earlier(x)).alias("toxic_lost"),
        total(lambda x: x["n"] * F.element_at(share, F.bit_count(x["mask"])), fails).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per part, order of the five filters and step.

    The few bytes that the pass over the texts finds for each document are
    written to the shared folder first, since several joins start from them.
    """
    failed = materialise(docs.sparkSession, failures(measure(docs, id_col)), "failures")
    return orders(profile(failed, labels, id_col))
