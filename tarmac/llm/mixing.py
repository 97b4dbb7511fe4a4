"""Operator 7: mixing sources to target weights (DataFrame functions only).

With ``p_s`` the share of source s in all tokens, its weight is
``p_s**a / sum p**a``.  The exponent a is found by bisection, so that the
weights have a given entropy or that no source is repeated more often than
a limit.  The token budget of the mixture is given, or the smallest one
that takes every source whole at least once.

A source's budget is realised as whole epochs plus a part of one more.
For that part every document has a place in a keyed permutation: a block
(at most ``MAX_BLOCKS`` per source) and a key inside it.  The part takes
whole blocks while they fit, and of the next block the documents with the
smallest keys while they fit.  So a source needs two numbers, a block and
a key, and each document is decided on its own row.

Block sums are partial aggregates; the ordered sums run over at most
``MAX_BLOCKS`` rows of a source and over one block of it, after equal rows
have been added up.  No document passes through the driver, which sees
the sums of each bisection step alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import materialise, whole_text

SEED = 42
BLOCK_TOKENS = 1 << 15
MAX_BLOCKS = 4096
#: Exponents tried in one job: four bisection steps.
_AT_ONCE = 15
#: Source tables up to so many rows are broadcast, larger ones are joined by a shuffle.
BROADCAST_ROWS = 100_000


def n_tokens(text_col: str = "text") -> Column:
    """Words separated by ASCII white space; null and empty texts have none."""
    return F.regexp_count(whole_text(text_col), F.lit(r"[^\x20\x09-\x0D]++")).cast("long")


def _source(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def _key(id_col: str, text_col: str, seed: int) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed))


def source_tokens(docs: DataFrame, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``src, tokens``: tokens of every source (null counts as '')."""
    return docs.groupBy(_source(source_col).alias("src")).agg(F.sum(n_tokens(text_col)).alias("tokens"))


def _excess(tokens: Column, total: float, largest: float, max_repetition: float | None,
            target_entropy: float | None):
    """For an exponent: aggregates from which the caller sees whether it is too small."""
    share = tokens / F.lit(total)

    def columns(a: float, name: str) -> list[Column]:
        w = F.pow(share, F.lit(a))
        if target_entropy is not None:
            return [F.sum(w).alias(f"{name}s"), F.sum(w * F.log(w)).alias(f"{name}l")]
        # repetition relative to the largest source, which is taken once
        return [F.max(F.pow(tokens / F.lit(largest), F.lit(a - 1.0))).alias(f"{name}s")]

    def too_small(row, name: str) -> bool:
        if target_entropy is not None:
            z = row[f"{name}s"]
            return math.log(z) - row[f"{name}l"] / z > target_entropy  # a larger exponent lowers the entropy
        return row[f"{name}s"] > max_repetition

    return columns, too_small


def exponent(sources: DataFrame, max_repetition: float | None = 1.5,
             target_entropy: float | None = None) -> float:
    """Smallest exponent in [0, 1] whose weights keep the limit (1 if none does).

    ``max_repetition``: epochs of any source if the largest one is taken
    once.  ``target_entropy`` (in nats): of the weights, at most.
    """
    if (max_repetition is None) == (target_entropy is None):
        raise ValueError("give either max_repetition or target_entropy")
    full = sources.filter("tokens > 0")
    total, largest = full.agg(F.sum("tokens"), F.max("tokens")).first()
    if not total:
        return 1.0
    columns, too_small = _excess(F.col("tokens"), float(total), float(largest), max_repetition, target_entropy)
    lo, hi = 0.0, 1.0
    first = full.agg(*columns(0.0, "e")).first()
    if not too_small(first, "e"):
        return 0.0
    for _ in range(8):
        points = [lo + (hi - lo) * (k + 1) / (_AT_ONCE + 1) for k in range(_AT_ONCE)]
        row = full.agg(*[c for k, a in enumerate(points) for c in columns(a, f"e{k}")]).first()
        small = [a for k, a in enumerate(points) if too_small(row, f"e{k}")]
        large = [a for k, a in enumerate(points) if not too_small(row, f"e{k}")]
        lo, hi = max([lo, *small]), min([hi, *large])
    return round(hi, 9)


def plan(docs: DataFrame, max_repetition: float | None = 1.5, target_entropy: float | None = None,
         budget: float | None = None, seed: int = SEED, id_col: str = "doc_id", source_col: str = "source",
         text_col: str = "text") -> DataFrame:
    """``src, tokens, weight, repetition, epochs, blocks, cut_block, cut_key`` of every source.

    A source without tokens has weight 0 and is taken once.
    """
    spark = docs.sparkSession
    rows = materialise(spark, docs.select(
        _source(source_col).alias("src"), n_tokens(text_col).alias("n"),
        _key(id_col, text_col, seed).alias("key")), "mix-rows")
    sources = materialise(spark, rows.groupBy("src").agg(F.sum("n").alias("tokens")), "mix-sources")
    a = exponent(sources, max_repetition, target_entropy)
    total, largest = sources.agg(F.sum("tokens"), F.max("tokens")).first()
    total, largest = float(total or 0), float(largest or 0)
    power = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(total or 1.0), F.lit(a))).otherwise(0.0)
    norm = sources.agg(F.sum(power)).first()[0] or 1.0
    spend = budget if budget is not None else (largest / ((largest / total) ** a / norm) if total else 0.0)
    weight = power / F.lit(norm)
    repetition = F.when(F.col("tokens") > 0, F.round(weight * F.lit(spend) / F.col("tokens"), 9)).otherwise(1.0)
    target = sources.select(
        "src", "tokens", weight.alias("weight"), repetition.alias("repetition"),
        F.floor(repetition).alias("epochs"),
        F.greatest(F.lit(1), F.least(F.lit(MAX_BLOCKS), F.ceil(F.col("tokens") / BLOCK_TOKENS))).alias("blocks"),
        F.floor((repetition - F.floor(repetition)) * F.col("tokens")).alias("rest"))
    placed = _with_sources(rows, target, "src").withColumn("block", F.pmod("key", "blocks"))
    sums = placed.groupBy("src", "block", "rest").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy("src").orderBy("block")
    cuts = sums.withColumn("before", F.sum("n").over(upto) - F.col("n")).filter(
        (F.col("before") <= F.col("rest")) & (F.col("before") + F.col("n") > F.col("rest"))).select(
        "src", F.col("block").alias("cut_block"), (F.col("rest") - F.col("before")).alias("left"))
    inside = _with_sources(placed, cuts, "src").filter("block = cut_block").groupBy("src", "key", "left").agg(
        F.sum("n").alias("n"))
    ordered = Window.partitionBy("src").orderBy("key")
    keys = inside.withColumn("upto", F.sum("n").over(ordered)).filter("upto <= left").groupBy("src").agg(
        F.max("key").alias("cut_key"))
    return materialise(spark, target.drop("rest").join(cuts.drop("left"), "src", "left").join(keys, "src", "left"),
                       "mix-plan")


def _with_sources(rows: DataFrame, sources: DataFrame, on: str) -> DataFrame:
    """Join a table of one row per source, by broadcast only while it is small."""
    small = sources.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(sources) if small else sources, on)


def decide(docs: DataFrame, sources: DataFrame, seed: int = SEED, id_col: str = "doc_id",
           source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``), ``src, weight, repetition, block, copies`` of every row."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         _source(source_col).alias("src"), _key(id_col, text_col, seed).alias("key"))
    joined = _with_sources(packed, sources, "src").withColumn("block", F.pmod("key", "blocks"))
    more = (F.col("block") < F.col("cut_block")) | (
        (F.col("block") == F.col("cut_block")) & (F.col("key") <= F.col("cut_key")))
    copies = F.col("epochs") + F.coalesce(more, F.lit(False)).cast("long")
    return joined.select("row", "src", "weight", "repetition", "block", copies.alias("copies"))


def mixture(docs: DataFrame, sources: DataFrame, **columns) -> DataFrame:
    """The mixed table: every row of ``docs`` as often as it is taken, with the columns of ``docs``.

    Rows that are equal in id, text and source are decided alike.
    """
    taken = decide(docs, sources, **columns).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
