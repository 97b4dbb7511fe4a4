"""Operator 6: nearest neighbours by multi-index hashing.

Vectors get binary codes: principal axes of a bounded sample, rotated so
that signs lose least (iterative quantisation), one bit per axis, 64 at
most.  Inner products become angles by one more coordinate that lifts
every vector to the largest norm.  A code is split into substrings, and by
the pigeonhole principle two codes within Hamming distance r agree on one
of the s substrings up to r // s bits.  The radius is the one that holds
``COVERAGE`` of the true neighbours of sample queries within the sample,
which are further away than those in all rows.

All distinct vectors are dealt to blocks of about ``BLOCK_ROWS``.  A task
indexes a block: for each substring value a bitmap of the rows whose
substring lies within r // s bits of it.  A query joins the bitmaps of its
substrings, keeps the codes within the radius, and ranks those by the
inner product of the original vectors.  The best of each block meet in a
window per query.  Queries with fewer than ``ROOM`` codes within the radius
for each neighbour wanted (they lie apart from most rows) ask again with
growing radii, until they have so many or all rows are covered.

Equal vectors are indexed once with their smallest ids, as many as can
appear in a result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import materialise, smallest

BITS = 64
SUBSTRING = 8
#: Rows that the rotation and the radius are fitted on at most, and queries among them.
SAMPLE_ROWS = 8000
SAMPLE_QUERIES = 200
COVERAGE = 0.985
#: Codes within the radius that a query has at least, for each neighbour wanted, and by how much radii grow first.
ROOM = 10
STEP = 4
BLOCK_ROWS = 3000
QUERY_ROWS = 512
#: Above single-precision rounding of the preselection, relative to the norms.
_SLACK = 1e-4
_WEIGHT = np.bitwise_count(np.arange(256, dtype=np.uint8))


@dataclass
class Codes:
    """Learned codes of vectors of one length."""

    mean: np.ndarray
    axes: np.ndarray
    largest: float
    radius: int

    def of(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Codes (rows x bytes)."""
        bits = (_lifted(x, self.largest, query) - self.mean) @ self.axes > 0
        return np.packbits(bits, axis=1)


def _lifted(x: np.ndarray, largest: float, query: bool) -> np.ndarray:
    """Unit vectors whose cosines order as the inner products with a query do."""
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    if query:
        return np.hstack([x / norm, np.zeros_like(norm)])
    return np.hstack([x, np.sqrt(np.maximum(largest ** 2 - norm ** 2, 0))]) / largest


def learn(x: np.ndarray, largest: float, k: int, seed: int = 5) -> Codes:
    """Rotation and radius from a sample ``x``."""
    rng = np.random.default_rng(seed)
    data = _lifted(x, largest, False)
    mean = data.mean(axis=0)
    centred = data - mean
    _, _, axes = np.linalg.svd(np.linalg.qr(centred, mode="r") if len(centred) > len(mean) else centred)
    bits = min(BITS, x.shape[1])
    axes = axes[:bits].T
    projected = centred @ axes
    rotation, _ = np.linalg.qr(rng.standard_normal((bits, bits)))
    for _ in range(40):
        u, _, v = np.linalg.svd(np.sign(projected @ rotation).T @ projected)
        rotation = (u @ v).T
    codes = Codes(mean, axes @ rotation, largest, bits)
    queries = rng.permutation(len(x))[:SAMPLE_QUERIES]
    score = x[queries] @ x.T
    score[np.arange(len(queries)), queries] = -np.inf
    near = np.argsort(-score, axis=1)[:, : min(k, len(x) - 1)]
    own, asked = codes.of(x), codes.of(x[queries], query=True)
    if near.size:
        distance = _WEIGHT[own[near] ^ asked[:, None, :]].sum(axis=2)
        codes.radius = int(np.quantile(distance, COVERAGE, method="higher"))
    return codes


class Index:
    """One block: vectors, the ids of each, and substring bitmaps."""

    def __init__(self, codes: Codes, x: np.ndarray, ids: list[np.ndarray]):
        self.codes, self.x, self.ids = codes, x, ids
        self.single = x.astype(np.float32)
        self.code = codes.of(x)
        reach = codes.radius // self.code.shape[1]
        near = _WEIGHT[np.arange(256)[:, None] ^ np.arange(256)[None, :]] <= reach
        # balls[s][v]: bitmap of the rows whose substring s lies within reach of the value v
        self.balls = [np.packbits(near[:, self.code[:, s]], axis=1) for s in range(self.code.shape[1])]
        self.norm = float(np.linalg.norm(x, axis=1).max())

    def candidates(self, code: np.ndarray) -> np.ndarray:
        """All rows whose code lies within the radius."""
        found = self.balls[0][code[0]].copy()
        for s in range(1, len(code)):
            found |= self.balls[s][code[s]]
        rows = np.flatnonzero(np.unpackbits(found, count=len(self.x)))
        return rows[_WEIGHT[self.code[rows] ^ code].sum(axis=1) <= self.codes.radius]

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and scores of the ``k`` best, without the id ``own``, and how many rows lie within the radius."""
        rows = self.candidates(self.codes.of(query[None], query=True)[0])
        inside = len(rows)
        if len(rows) > k:
            rough = self.single[rows] @ query.astype(np.float32)
            least = np.partition(rough, len(rough) - k - 1)[len(rough) - k - 1]
            rows = rows[rough >= least - _SLACK * self.norm * float(np.linalg.norm(query))]
        score = np.zeros(len(rows))
        for j in range(len(query)):  # one order of addition for every row: equal vectors get equal scores
            score += self.x[rows, j] * query[j]
        sizes = np.array([len(self.ids[r]) for r in rows], np.int64)
        ids = np.concatenate([self.ids[r] for r in rows]) if len(rows) else np.zeros(0, np.int64)
        score = np.repeat(score, sizes)
        other = ids != own
        ids, score = ids[other], score[other]
        best = np.lexsort((ids, -score))[:k]
        return ids[best], score[best], inside


def _valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0)


def nearest(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, id, score``: the ``k`` nearest rows of every query row by inner product.

    ``queries`` says which rows are queries.  Rows with a null id, and
    vectors that are null, empty, zero or hold null or non-finite values,
    take no part, nor do vectors of another length than most.  A query's
    own id is no candidate; ties go to the smaller id.  Repeated rows of an
    id count once.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, id long, score double").withColumnRenamed("id", id_col)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda v: v.cast("double") + 0.0).alias("x"),
        F.coalesce(queries, F.lit(False)).alias("asks")).filter(F.col("id").isNotNull() & _valid(F.col("x")))
    lengths = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not lengths:
        return empty
    rows = rows.filter(F.size("x") == lengths[0]["n"])
    place = F.row_number().over(Window.partitionBy("x").orderBy("id"))
    once = rows.select("x", "id").distinct().withColumn("place", place).filter(F.col("place") <= k + 1)
    distinct = materialise(spark, once.groupBy("x").agg(F.sort_array(F.collect_list("id")).alias("ids")), "vectors")
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v))
    count, largest = distinct.agg(F.count(F.lit(1)), F.max(norm)).first()
    keyed = distinct.select("x", F.col("ids")[0].alias("first"))
    sample = smallest(keyed, F.xxhash64("first"), "first", SAMPLE_ROWS).select("x").toArrow()
    n = lengths[0]["n"]
    codes = learn(sample.column(0).combine_chunks().flatten().to_numpy().reshape(-1, n), float(largest), k)
    bits = codes.axes.shape[1]
    if count <= ROOM * k:
        codes.radius = bits
    blocks = -(-count // BLOCK_ROWS)
    packed = distinct.groupBy(F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(blocks)).alias("block")).agg(
        F.collect_list(F.struct("x", "ids")).alias("rows"))
    asking = rows.filter("asks").select("id", "x").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    step, parts = STEP, []
    while waiting := asking.count():
        found = materialise(spark, _probe(packed, blocks, asking, -(-waiting // QUERY_ROWS), codes, n, k), "found")
        room = found.groupBy("query_id").agg(F.sum("inside").alias("inside"))
        short = room.filter((F.col("inside") < ROOM * k) & F.lit(codes.radius < bits)).select("query_id")
        parts.append(found.filter("id IS NOT NULL").join(short, "query_id", "left_anti"))
        asking = materialise(spark, asking.join(short.withColumnRenamed("query_id", "id"), "id", "left_semi"), "asking")
        codes, step = replace(codes, radius=min(bits, codes.radius + step)), 2 * step
    if not parts:
        return empty
    best = functools.reduce(DataFrame.union, parts)
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(id_col), "score")


def _probe(packed: DataFrame, blocks: int, asking: DataFrame, batches: int, codes: Codes, n: int, k: int) -> DataFrame:
    """``query_id, id, score, inside``: the best of each block, and a row without id for the rows within the radius."""
    codes = asking.sparkSession.sparkContext.broadcast(codes)
    asked = asking.groupBy(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(batches)).alias("batch")).agg(
        F.collect_list(F.struct("id", "x")).alias("asked"))
    visits = asked.select("asked", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    both = visits.join(packed, "block").select(
        "block", F.col("asked.id").alias("query"), F.flatten("asked.x").alias("qx"),
        F.flatten("rows.x").alias("x"), F.col("rows.ids").alias("ids"))

    def run(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, index = None, None
        for batch in batches_in:
            for i in range(batch.num_rows):
                block = batch.column(0)[i].as_py()
                if block != at:
                    x = batch.column(3)[i].values.to_numpy().reshape(-1, n)
                    index = Index(codes.value, x, [np.array(v, np.int64) for v in batch.column(4)[i].as_py()])
                    at = block
                names = batch.column(1)[i].values.to_numpy()
                asked_x = batch.column(2)[i].values.to_numpy().reshape(-1, n)
                found = [index.search(q, int(name), k) for name, q in zip(names, asked_x)]
                ids = np.concatenate([f[0] for f in found])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(names, [len(f[0]) for f in found])), pa.array(ids),
                    pa.array(np.concatenate([f[1] for f in found])), pa.array(np.zeros(len(ids), np.int64)),
                ], names=["query_id", "id", "score", "inside"])
                yield pa.RecordBatch.from_arrays([
                    pa.array(names), pa.nulls(len(names), pa.int64()), pa.nulls(len(names), pa.float64()),
                    pa.array(np.array([f[2] for f in found], np.int64)),
                ], names=["query_id", "id", "score", "inside"])

    return both.mapInArrow(run, "query_id long, id long, score double, inside long")
