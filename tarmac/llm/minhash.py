"""Operator 2: near duplicates by fast similarity sketching.

Every document becomes the set of its distinct word shingles (64-bit
hashes).  Its sketch has ``COORDINATES`` bins filled in rounds: in round i
every shingle is hashed to one bin with a value, and a bin keeps the
smallest (round, value).  A document stops when all its bins are full; in
the second half of the rounds every shingle goes to one given bin, so all
bins fill for certain, and equal coordinates estimate the Jaccard
similarity with the concentration of as many independent samples.

Links are found in steps, each a Spark job over a written table:

1. Documents with equal sets are one *class* (map-side combined minimum),
   so copies are never paired.
2. Class representatives that agree on all ``ROWS`` coordinates of a band
   share a bucket.  A bucket's pivot is the member that shares buckets with
   most others, such as the base of a group of copies; a document's home is
   the strongest pivot of its buckets.  Each document is confirmed against
   its home on the full sets, and against the pivots of those buckets that
   hold several homes: at most as many pairs as members, not their square.
   Linked ones are joined to components.
3. Two members x, y of different components around a pivot p can still be
   linked.  Let a be the number of shingles a member has beyond p and r the
   number it lacks.  If x and y share none of the former, their distance is
   at least (a_x + a_y + |r_x - r_y|) / (|p| + a_x + a_y - min(r_x, r_y)).
   So a linked pair shares a shingle that p lacks, or its two (a, r)
   profiles pass this bound.  Profiles are joined first, members only for
   profiles that pass.  Else x must share at least t = 0.8 a_x - 0.2 |x & p|
   such shingles with y, so one of the a_x - t + 1 that are rarest around p
   (prefix filter); those make new, smaller buckets.
4. What passes is confirmed directly, pairs with one home only there; so
   no candidate is left out.

Two documents at similarity 0.8 share no bucket with probability
(1 - 0.8**6)**42 = 3e-6, above 0.85 below 2e-9.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm import words as W
from tarmac.llm.common import materialise
from tarmac.llm.components import components

COORDINATES = 252
ROWS = 6
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW = np.uint64((1 << 54) - 1)
#: Text bytes sketched at once in a task, and pairs confirmed at once.
CHUNK_BYTES = 1 << 20
PAIRS_AT_ONCE = 500
#: Sets of ids up to so many are broadcast (8 MB), larger ones are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def sketches(hashes: np.ndarray, offsets: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """Fast similarity sketch of each set; a row of an empty set stays at its start value."""
    n = len(offsets) - 1
    out = np.full((n, coordinates), _FULL, np.uint64)
    flat = out.reshape(-1)
    counts = np.diff(offsets)
    active = np.flatnonzero(counts)
    owner, h = np.repeat(np.arange(n), counts), hashes
    for i in range(2 * coordinates):
        v = W.mix(h ^ np.uint64(((i + 1) * 0xA0761D6478BD642F) & 0xFFFFFFFFFFFFFFFF))
        value = (np.uint64(i) << np.uint64(54)) | (v & _LOW)
        if i < coordinates:
            place = ((v >> np.uint64(32)) * np.uint64(coordinates)) >> np.uint64(32)
            place = place.astype(np.int64)
        else:
            place = i - coordinates
        np.minimum.at(flat, owner * coordinates + place, value)
        left = (out[active] == _FULL).any(axis=1)
        if not left.any():
            break
        if not left.all():
            active = active[left]
            wanted = np.zeros(n, bool)
            wanted[active] = True
            keep = wanted[owner]
            owner, h = owner[keep], h[keep]
    return out


def bands(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band and document."""
    n, coordinates = sketch.shape
    grouped = sketch.reshape(n, coordinates // rows, rows)
    key = np.broadcast_to(np.arange(1, coordinates // rows + 1, dtype=np.uint64), grouped.shape[:2]).copy()
    for j in range(rows):
        key = W.mix(key * np.uint64(0xD6E8FEB86659FD93) + grouped[:, :, j])
    return key.view(np.int64)


def shingle_sketches(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_shingles, set_key, bands`` of every row (null text: empty set, no bands)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, raw = W.buffers(batch.column(1))
            for lo, hi in W.chunks(offsets, CHUNK_BYTES):
                part = W.split_words(offsets[lo: hi + 1] - offsets[lo], raw[offsets[lo]: offsets[hi]])
                sets, bounds = W.shingles(part, words)
                sizes = np.diff(bounds)
                keys = bands(sketches(sets, bounds))
                raw_sets = sets.tobytes()
                digest = [hashlib.blake2b(raw_sets[8 * a: 8 * b], digest_size=16).digest()
                          for a, b in zip(bounds[:-1], bounds[1:])]
                full = np.repeat(sizes > 0, keys.shape[1])
                ends = np.concatenate([[0], np.cumsum(np.where(sizes > 0, keys.shape[1], 0))])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), pa.array(sizes, pa.int64()),
                    pa.array(digest, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.reshape(-1)[full])),
                ], names=["id", "n_shingles", "set_key", "bands"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"id {kind}, n_shingles long, set_key binary, bands array<long>")


def confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int, difference: bool = False) -> DataFrame:
    """``a, b, linked`` for every pair: 100 * intersection >= percent * union of the full sets.

    With ``difference`` also ``more``, the shingles of a that b lacks, and
    the counts ``lacks`` (of b in a) and ``size`` of b.
    """
    kind = pairs.schema["a"].dataType.simpleString()
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    extra = ", more array<long>, lacks long, size long" if difference else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, PAIRS_AT_ONCE) for b in batches for i in range(0, b.num_rows, PAIRS_AT_ONCE)):
            sides = []
            for column in (2, 3):
                offsets, raw = W.buffers(batch.column(column))
                got = []
                for lo, hi in W.chunks(offsets):
                    sets, bounds = W.shingles(W.split_words(
                        offsets[lo: hi + 1] - offsets[lo], raw[offsets[lo]: offsets[hi]]), words)
                    got += [sets[p:q] for p, q in zip(bounds[:-1], bounds[1:])]
                sides.append(got)
            linked, more, lacks, size = [], [], [], []
            for x, y in zip(*sides):
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(bool(common) and 100 * common >= percent * (len(x) + len(y) - common))
                if difference:
                    more.append(np.setdiff1d(x, y, assume_unique=True).view(np.int64))
                    lacks.append(len(y) - common)
                    size.append(len(y))
            columns = {"a": batch.column(0), "b": batch.column(1), "linked": pa.array(linked, pa.bool_())}
            if difference:
                columns |= {"more": pa.array(more, pa.list_(pa.int64())), "lacks": pa.array(lacks, pa.int64()),
                            "size": pa.array(size, pa.int64())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return both.mapInArrow(run, f"a {kind}, b {kind}, linked boolean{extra}")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Class of every document: ``id, n_shingles, component_id, kept``, one row per input row.

    Documents whose shingle sets have 100 * intersection >= ``percent`` *
    union are linked; ``component_id`` is the smallest id reachable.  Null
    and empty texts, and texts of white space, have an empty set and are
    linked with nothing.  A row without an id is linked with nothing and has
    a null component; it counts as kept.  Rows that repeat an id are each
    returned; they are one document for linking.  Other columns are ignored.
    """
    spark = docs.sparkSession
    all_rows = materialise(spark, shingle_sketches(docs, words, id_col, text_col), "sketches")
    sets = all_rows.filter("n_shingles > 0 and id is not null")
    classes = sets.groupBy("set_key").agg(F.min("id").alias("rep"))
    reps = sets.join(classes.select(F.col("rep").alias("id")), "id", "left_semi")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    links = _links(spark, reps.select("id", F.explode("bands").alias("key")), texts, words, percent)
    roots = components(links, "a", "b")

    placed = materialise(spark, classes.join(roots, F.col("rep") == F.col("node"), "left").select(
        "set_key", F.coalesce("root", "rep").alias("root")), "placed")
    # two plain tables and nothing above the join: a set that many rows share is split among tasks
    component = F.when(F.col("id").isNotNull(), F.coalesce("root", "id"))
    return all_rows.select("id", "set_key", "n_shingles").join(placed, "set_key", "left").select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def _met(entries: DataFrame) -> DataFrame:
    """``key, id, n`` of the keys that several ids share, with the rows of a key.

    Nearly every key is of one row, so rows are counted where they meet:
    counts made before the exchange would be as many as the rows, and held
    by every task.
    """
    entries = entries.repartition("key")
    keys = entries.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("n"))
    return entries.join(keys.filter("low < high").select("key", "n"), "key")


def _links(spark, entries: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Linked pairs ``a, b`` that join all documents linked through buckets ``key, id``."""
    buckets = materialise(spark, _met(entries), "buckets")
    degree = buckets.groupBy("id").agg(F.sum("n").alias("degree"))
    top = buckets.join(degree, "id").groupBy("key").agg(
        F.max(F.struct("degree", (-F.col("id")).alias("minus"))).alias("top"))
    around = materialise(spark, buckets.select("key", "id").join(top, "key"), "pivots")
    homes = materialise(spark, around.groupBy("id").agg(F.max("top").alias("home")).select(
        "id", (-F.col("home.minus")).alias("home")), "homes")
    at_home = homes.select(F.col("id").alias("a"), F.col("home").alias("b"))
    several = around.select("key", "id", (-F.col("top.minus")).alias("pivot")).join(homes, "id")
    mixed = several.groupBy("key").agg(F.min("home").alias("low"), F.max("home").alias("high")).filter("low < high")
    beside = several.join(mixed.select("key"), "key", "left_semi").select(F.col("id").alias("a"), F.col("pivot").alias("b"))
    pairs = at_home.unionByName(beside).filter("a <> b").distinct()
    tested = _confirmed(spark, pairs, texts, words, percent, difference=True)
    links = tested.filter("linked").select("a", "b")
    groups = _groups(spark, tested, components(links, "a", "b"), homes)
    shingles = materialise(spark, _shared_shingles(groups, percent), "shingles")
    pairs = _profile_pairs(groups, percent).unionByName(_shingle_pairs(shingles, percent)).distinct()
    more = _confirmed(spark, pairs, texts, words, percent)
    return links.unionByName(more.filter("linked").select("a", "b"))


def _confirmed(spark, pairs: DataFrame, texts: DataFrame, words: int, percent: int,
               difference: bool = False) -> DataFrame:
    """Confirmed pairs, as a table; an id that repeats with several texts is linked if one of them is."""
    pairs = materialise(spark, pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    some = texts.join(_small(wanted), "id", "left_semi")
    return materialise(spark, confirm(pairs, some, words, percent, difference), "confirmed")


def _small(ids: DataFrame) -> DataFrame:
    """The ids, marked for a broadcast while their number is within the limit."""
    return F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids


def _groups(spark, tested: DataFrame, roots: DataFrame, homes: DataFrame) -> DataFrame:
    """Members of pivots (``tested`` with components) around which several components meet."""
    root_a = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    root_b = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    home = homes.select(F.col("id").alias("a"), "home")
    placed = tested.join(root_a, "a", "left").join(root_b, "b", "left").join(home, "a").select(
        "a", "b", F.coalesce("root_a", "a").alias("comp"), F.coalesce("root_b", "b").alias("pivot_comp"), "home",
        F.size("more").cast("long").alias("has"), "lacks", "size", "more")
    strays = placed.filter("comp <> pivot_comp").select("b").distinct()
    return materialise(spark, placed.join(strays, "b", "left_semi"), "groups")


def _shared_shingles(groups: DataFrame, percent: int) -> DataFrame:
    """Buckets by shingles that the pivot lacks: the rarest ones of each member, by the prefix filter."""
    shared = groups.select("a", "b", "comp", "home", "has", "lacks", "size", F.explode("more").alias("shingle"))
    shared = shared.select(F.xxhash64("b", "shingle").alias("key"), F.col("a").alias("id"), "b", "comp", "home",
                           "has", "lacks", "size")
    common = shared.groupBy("key").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    own = Window.partitionBy("id", "b")
    need = F.greatest(F.lit(1), F.ceil(
        (percent * F.col("has") - (100 - percent) * (F.col("size") - F.col("lacks"))) / 100))
    prefix = shared.join(common, "key").withColumns({
        "place": F.row_number().over(own.orderBy("often", "key")), "all": F.count(F.lit(1)).over(own)}).filter(
        F.col("place") <= F.col("all") - need + 1)
    mixed = prefix.groupBy("key").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.min("home").alias("home_low"),
        F.max("home").alias("home_high"), F.min("b").alias("pivot")).filter(
        "low < high and (home_low < home_high or home_low = pivot)")
    return prefix.drop("place", "all", "often").join(mixed.select("key"), "key", "left_semi")


def _shingle_pairs(buckets: DataFrame, percent: int) -> DataFrame:
    """Pairs of one bucket whose counts allow a link when all shingles beyond the pivot are shared."""
    has, least = F.col("x.has") + F.col("y.has"), F.least("x.has", "y.has")
    apart = has + F.abs(F.col("x.lacks") - F.col("y.lacks"))
    union = F.col("x.size") + has - F.least("x.lacks", "y.lacks")
    allows = 100 * apart - (100 - percent) * union <= (100 + percent) * least
    return _pairs(buckets.alias("x"), buckets.alias("y"), "key", "b", also=allows)


def _profile_pairs(groups: DataFrame, percent: int) -> DataFrame:
    """Pairs around one pivot whose counts allow a link without a shared shingle beyond the pivot."""
    member = groups.select("a", "b", "comp", "has", "lacks", "size", "home",
                           (F.col("comp") == F.col("pivot_comp")).alias("near"))
    profile = member.select("b", "has", "lacks", "size", "near").distinct()
    x, y = profile.alias("x"), profile.alias("y")
    has = F.col("x.has") + F.col("y.has")
    apart = has + F.abs(F.col("x.lacks") - F.col("y.lacks"))
    union = F.col("x.size") + has - F.least("x.lacks", "y.lacks")
    passing = x.join(y, (F.col("x.b") == F.col("y.b")) & ~(F.col("x.near") & F.col("y.near"))
                     & (100 * apart <= (100 - percent) * union)).select(
        F.col("x.b").alias("b"), F.col("x.has").alias("has"), F.col("x.lacks").alias("lacks"),
        F.col("x.near").alias("near"), F.col("y.has").alias("has2"), F.col("y.lacks").alias("lacks2"),
        F.col("y.near").alias("near2"))
    left = member.join(passing, ["b", "has", "lacks", "near"]).select(
        "b", "has2", "lacks2", "near2", F.col("a").alias("id"), "comp", "home").alias("x")
    right = member.select("b", F.col("has").alias("has2"), F.col("lacks").alias("lacks2"),
                          F.col("near").alias("near2"), F.col("a").alias("id"), "comp", "home").alias("y")
    return _pairs(left, right, "b", "has2", "lacks2", "near2")


def _pairs(x: DataFrame, y: DataFrame, *keys: str, also: Column | None = None) -> DataFrame:
    """Pairs with equal keys in different components; pairs with one home only around that home."""
    match = (F.col("x.comp") != F.col("y.comp")) & (
        (F.col("x.home") != F.col("y.home")) | (F.col("x.home") == F.col("x.b")))
    if also is not None:
        match = match & also
    for key in keys:
        match = match & (F.col(f"x.{key}") == F.col(f"y.{key}"))
    return x.join(y, match).select(
        F.greatest("x.id", "y.id").alias("a"), F.least("x.id", "y.id").alias("b")).distinct()


def deduplicate(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each class of ``near_duplicates``, the one of the smallest id.

    Of rows that repeat an id and its text one stays.  Rows without an id
    or without words stay.  All columns are kept as they are.
    """
    spark = docs.sparkSession
    found = materialise(spark, near_duplicates(docs, words, percent, id_col, text_col), "classes")
    gone = found.filter(~F.col("kept")).select(F.col(id_col).alias("gone")).distinct()
    gone = _small(gone)
    left = docs.join(gone, docs[id_col] == gone["gone"], "left_anti")
    again = found.filter(F.col("kept") & F.col(id_col).isNotNull()).groupBy(id_col).count().filter(
        "count > 1").select(F.col(id_col).alias("again"))
    if again.isEmpty():
        return left
    once = left.join(again, left[id_col] == again["again"], "left_anti")
    return once.unionByName(left.join(again, left[id_col] == again["again"], "left_semi").dropDuplicates(
        [id_col, text_col]))
