"""Entity-versus-group baseline and rank (carrier against its airport).

The group baseline must be the flight-weighted mean of the group's rows,
so it is rebuilt from unrounded per-entity sums and counts, never from
the entities' rounded means.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.metrics import safe_ratio, stable_round


def window_baseline(df: DataFrame, group: Sequence[str], sum_col: str, count_col: str,
                    out: str, scale: int | None = 2,
                    mean: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Group mean from per-entity sums, attached to each entity row.

    ``mean`` makes the mean from the group's sum and count, by default their
    quotient rounded to ``scale``.

    On an aggregate by (group, entity) this is one window over ``group``
    (one small exchange of the aggregate) instead of a second scan, a
    second aggregate and a join.
    """
    w = Window.partitionBy(*group)
    total, n = F.sum(sum_col).over(w), F.sum(count_col).over(w)
    if mean is not None:
        return df.withColumn(out, mean(total, n))
    ratio = safe_ratio(total, n)
    return df.withColumn(out, stable_round(ratio, scale) if scale is not None else ratio)


def join_baseline(entity: DataFrame, base: DataFrame, on: Sequence[str],
                  how: str = "inner") -> DataFrame:
    """Attach a per-group aggregate to per-entity rows by equi join.

    ``base`` has one row per group; when its size estimate is under the
    broadcast threshold Catalyst broadcasts it, otherwise sort-merge.
    """
    return entity.join(base, list(on), how)


def difference(a: str | Column, b: str | Column, scale: int = 2) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return stable_round(a - b, scale)


def rank_in_group(df: DataFrame, group: Sequence[str], order_col: str,
                  out: str = "classifica", ascending: bool = True) -> DataFrame:
    """``rank()`` per group (gaps on ties); ascending puts null first."""
    o = F.col(order_col).asc_nulls_first() if ascending else F.col(order_col).desc_nulls_last()
    w = Window.partitionBy(*group).orderBy(o)
    return df.withColumn(out, F.rank().over(w).cast("bigint"))


def anomalous(df: DataFrame, diff_col: str = "differenza", threshold: float = 0.0) -> DataFrame:
    """Keep pairs whose difference to the baseline is at least ``threshold``."""
    return df.filter(F.abs(F.col(diff_col)) >= F.lit(threshold))
