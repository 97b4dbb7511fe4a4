"""Cleaning of the raw flight extract as one narrow Spark pass.

Every step is ``DataFrame -> DataFrame`` (use with ``df.transform``) and
is a filter or projection, so the whole chain is one stage per scan
partition, with no shuffle.  Negated predicates are wrapped
in ``coalesce(cond, false)`` so that SQL's third truth value behaves like
the two-valued comparisons of the original (null compares false).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarmac.functions.metrics import nan_to_null
from tarmac.schema import CAUSE_COLUMNS, CLEAN_SCHEMA, OUTLIER_HIGH, OUTLIER_LOW, TARGET_COLUMNS


def _false_if_null(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def corrupt_condition() -> Column:
    """Regular flight (not cancelled, not diverted) with a missing (null or NaN) delay."""
    def missing(c: str) -> Column:
        return F.col(c).isNull() | F.isnan(F.col(c).cast("double"))

    return (F.col("cancelled") == 0) & (F.col("diverted") == 0) & (missing("arr_delay") | missing("dep_delay"))


def outlier_condition(low: float = OUTLIER_LOW, high: float = OUTLIER_HIGH,
                      cols: Iterable[str] = ("dep_delay", "arr_delay")) -> Column:
    """Any delay strictly outside ``[low, high]``; null and NaN delays never match."""
    cond = F.lit(False)
    for c in cols:
        delay = nan_to_null(F.col(c).cast("double"))
        cond = cond | _false_if_null((delay < low) | (delay > high))
    return cond


def delays_nan_to_null(df: DataFrame, cols: Iterable[str] = ("dep_delay", "arr_delay",
                                                           "op_carrier_fl_num")) -> DataFrame:
    """Floating NaN becomes null so that min/max/avg never return NaN."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: nan_to_null(F.col(c).cast("double")) for c in present})


def drop_corrupt(df: DataFrame) -> DataFrame:
    """Drop regular flights that lack a departure or arrival delay."""
    return df.filter(~_false_if_null(corrupt_condition()))


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """P2."""
    return df.drop(*cols)


def parse_date(df: DataFrame, col: str = "fl_date", fmt: str | None = None) -> DataFrame:
    """``YYYY-MM-DD`` text to a timestamp without time zone.

    Invalid text raises (ANSI mode), as the original parser does.
    """
    parsed = F.to_timestamp_ntz(F.col(col), F.lit(fmt)) if fmt else F.to_timestamp_ntz(F.col(col))
    return df.withColumn(col, parsed)


def select_existing(df: DataFrame, cols: Iterable[str] = TARGET_COLUMNS) -> DataFrame:
    """Keep the target columns that exist, in target order."""
    present = set(df.columns)
    return df.select(*[c for c in cols if c in present])


def coerce_numeric(df: DataFrame, cols: Iterable[str], to: str = "double") -> DataFrame:
    """P5: parse to a number; unparseable values become null."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.col(c).try_cast(to) for c in present})


def fill_zero(df: DataFrame, cols: Iterable[str], to: str = "bigint") -> DataFrame:
    """Null and NaN become 0, result cast to ``to``."""
    present = [c for c in cols if c in df.columns]
    floating = {c for c, t in df.dtypes if t in ("double", "float")}
    return df.withColumns({c: F.coalesce(nan_to_null(c) if c in floating else F.col(c), F.lit(0)).cast(to)
                           for c in present})


def impute_causes(df: DataFrame, cols: Iterable[str] = CAUSE_COLUMNS) -> DataFrame:
    """P5 + P6 for the delay-cause minutes: unparseable or missing -> 0."""
    cols = list(cols)
    return fill_zero(coerce_numeric(df, cols), cols)


def drop_outliers(df: DataFrame, low: float = OUTLIER_LOW, high: float = OUTLIER_HIGH) -> DataFrame:
    """Drop rows with a delay outside ``[low, high]``; null delays stay."""
    return df.filter(~outlier_condition(low, high))


def conform(df: DataFrame, schema: StructType = CLEAN_SCHEMA) -> DataFrame:
    """Cast the columns present to the declared types of ``schema`` (as the
    table DDL fixes them); a no-op when the types already match."""
    types = {f.name: f.dataType for f in schema}
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types and
                       df.schema[c].dataType != types[c] else F.col(c) for c in df.columns])


def clean(df: DataFrame) -> DataFrame:
    """The whole chain in the original order.

    The flight-number null rows are kept on purpose (P7): the original
    "drop" re-aligned on the index and changed nothing.
    """
    return (df.transform(delays_nan_to_null)
              .transform(drop_corrupt)
              .transform(drop_columns, "year")
              .transform(parse_date, "fl_date")
              .transform(select_existing, TARGET_COLUMNS)
              .transform(impute_causes)
              .transform(drop_outliers)
              .transform(conform))
