"""Data-quality profiles, each ONE aggregation job over the input.

Conditional counts replace repeated filtered scans: N checks cost one
scan and one tiny shuffle (partial aggregates), whatever N is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.metrics import count_where, nan_to_null


def _long_form(wide: DataFrame, names: Sequence[str], name_col: str, value_col: str) -> DataFrame:
    # One-row frame to one row per measure; the explode keeps it a Project.
    items = F.array(*[F.struct(F.lit(n).alias("k"), F.col(f"`{n}`").alias("v")) for n in names])
    return (wide.select(F.explode(items).alias("_kv"))
                .select(F.col("_kv.k").alias(name_col), F.col("_kv.v").alias(value_col)))


def step_counts(df: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """Rows kept after each cumulative step, in one pass.

    ``steps`` maps a step name to the condition a row must meet to survive
    that step; step i keeps the rows meeting conditions 1..i.
    """
    kept = F.lit(True)
    aggs = [F.count(F.lit(1)).alias("input")]
    for name, cond in steps.items():
        kept = kept & F.coalesce(cond, F.lit(False))
        aggs.append(count_where(kept).alias(name))
    names = ["input", *steps]
    return _long_form(df.agg(*aggs), names, "step", "rows")


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count per column (and row count), one aggregation."""
    cols = list(cols or df.columns)
    wide = df.agg(*[count_where(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    return _long_form(wide, cols, "column_name", "null_count")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """D3: distinct values with their row counts (partial agg per task)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("rows"))


def bounds(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Min and max of each column, one aggregation."""
    wide = df.agg(*[e for c in cols for e in (F.min(c).alias(f"{c}_min"),
                                               F.max(c).alias(f"{c}_max"))])
    return wide


def outlier_share(df: DataFrame, cond: Column) -> DataFrame:
    """Matching rows, all rows and the share in percent (unrounded)."""
    return df.agg(count_where(cond).alias("outliers"), F.count(F.lit(1)).alias("rows")) \
             .withColumn("percent", F.try_divide(F.col("outliers"), F.col("rows")) * F.lit(100.0))


def head_n(df: DataFrame, keys: Sequence[str], n: int = 10) -> DataFrame:
    """First ``n`` rows in ``keys`` order (a top-n, planned as
    ``TakeOrderedAndProject``: each task keeps n rows, the driver merges)."""
    return df.orderBy(*keys).limit(n)


def describe_schema(df: DataFrame) -> DataFrame:
    """One row per column with its Spark type and non-null count
    (like a frame's ``info()``), from ONE aggregation."""
    cols = df.columns
    wide = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in cols])
    types = dict(df.dtypes)
    items = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("k"),
                               F.lit(types[c]).alias("t"), F.col(f"`{c}`").alias("v"))
                      for i, c in enumerate(cols)])
    return (wide.select(F.explode(items).alias("_kv"))
                .select(F.col("_kv.pos").alias("position"), F.col("_kv.k").alias("column_name"),
                        F.col("_kv.t").alias("data_type"), F.col("_kv.v").alias("non_null")))


class ObservedProfile:
    """D1 to D8 as metrics that Spark gathers while the cleaned table is written.

    ``raw(df)`` and ``clean(df)`` mark the two places of the chain where rows
    are counted; they add no scan and no exchange, only running aggregates in
    the tasks of the write.  After it ``table(spark)`` has the profile.
    """

    #: Distinct values kept apart in a ``distinct`` column; with more of them the counts are estimates.
    VALUES = 10_000

    def __init__(self, steps: Mapping[str, Column], outlier: Column, valid: Column, bounded: Sequence[str],
                 distinct: str, missing: Column):
        self._steps, self._outlier, self._valid = dict(steps), outlier, valid
        self._bounded, self._distinct, self._missing = list(bounded), distinct, missing
        self._on_raw, self._on_clean = Observation(), Observation()
        self._types: list[tuple[str, str]] = []

    def raw(self, df: DataFrame) -> DataFrame:
        """Observe the rows before the cleaning: steps, bounds, outliers, distinct values."""
        kept = F.lit(True)
        aggs = [F.count(F.lit(1)).alias("step:input")]
        for name, cond in self._steps.items():
            kept = kept & F.coalesce(cond, F.lit(False))
            aggs.append(count_where(kept).alias(f"step:{name}"))
        for c in self._bounded:
            value = F.when(self._valid, nan_to_null(F.col(c).cast("double")))
            aggs += [F.min(value).alias(f"bound:{c}_min"), F.max(value).alias(f"bound:{c}_max")]
        aggs += [count_where(self._valid & self._outlier).alias("outlier:outliers"),
                 count_where(self._valid).alias("outlier:rows"),
                 F.call_function("approx_top_k", F.col(self._distinct), F.lit(self.VALUES), F.lit(2 * self.VALUES)).alias("distinct:values"),
                 count_where(F.col(self._distinct).isNull()).alias("distinct:null")]
        return df.observe(self._on_raw, *aggs)

    def clean(self, df: DataFrame) -> DataFrame:
        """Observe the cleaned rows: nulls, types, and nulls among the rows that ``missing`` picks."""
        self._types = df.dtypes
        aggs = []
        for c in df.columns:
            null = F.col(f"`{c}`").isNull()
            aggs += [count_where(null).alias(f"null:{c}"), count_where(null & self._missing).alias(f"missing:{c}")]
        return df.observe(self._on_clean, F.count(F.lit(1)).alias("rows"), *aggs)

    def table(self, spark: SparkSession) -> DataFrame:
        """``profile, name, value, type``: one row per finding, from the metrics of the finished write."""
        raw, clean = self._on_raw.get, self._on_clean.get
        names = {"step": "step_counts", "bound": "bounds", "outlier": "outliers"}
        rows = [(names[k.split(":")[0]], k.split(":", 1)[1], v) for k, v in raw.items() if k.split(":")[0] in names]
        n, outliers = raw["outlier:rows"], raw["outlier:outliers"]
        rows.append(("outliers", "percent", outliers / n * 100.0 if n else None))
        rows += [("distinct", r["item"], r["count"]) for r in raw["distinct:values"] if r["item"] is not None]
        rows.append(("distinct", None, raw["distinct:null"]))
        out = [Row(profile=p, name=name, value=None if v is None else float(v), type=None) for p, name, v in rows]
        for c, kind in self._types:
            out.append(Row(profile="nulls", name=c, value=float(clean[f"null:{c}"]), type=None))
            out.append(Row(profile="missing_code", name=c, value=float(clean[f"missing:{c}"]), type=None))
            out.append(Row(profile="schema", name=c, value=float(clean["rows"] - clean[f"null:{c}"]), type=kind))
        return spark.createDataFrame(out, "profile string, name string, value double, type string").coalesce(1)
