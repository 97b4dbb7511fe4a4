"""Wide-to-long of aggregated columns, top-k per group, ordered lists.

``unpivot_columns`` uses ``explode`` over an array of structs instead of
``DataFrame.unpivot``: Spark's ``Generate`` keeps the child's hash
partitioning while ``Expand`` (what ``unpivot`` plans) drops it.  After a
``groupBy(keys)`` the window ``partitionBy(keys)`` and the regrouping by
the same keys then need no further exchange.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def unpivot_columns(df: DataFrame, ids: Sequence[str], values: Mapping[str, str],
                    name_col: str = "name", value_col: str = "value",
                    keep_empty: bool = False, only_if: Column | None = None,
                    value_type: str | None = None) -> DataFrame:
    """One row per (id, value column): ``values`` maps column -> label.

    ``only_if``: input rows where it is not true produce no value rows;
    with ``keep_empty`` they produce one row with null name and value
    (``explode_outer``), so that every input row stays represented.
    """
    def value(c):
        v = F.col(c)
        return v.cast(value_type) if value_type else v

    items = F.array(*[F.struct(F.lit(label).alias(name_col), value(c).alias(value_col))
                      for c, label in values.items()])
    if only_if is not None:
        items = F.when(only_if, items)
    gen = F.explode_outer(items) if keep_empty else F.explode(items)
    return (df.select(*ids, gen.alias("_kv"))
              .select(*ids, F.col(f"_kv.{name_col}").alias(name_col),
                      F.col(f"_kv.{value_col}").alias(value_col)))


def rank_rows(df: DataFrame, partition_by: Sequence[str], order_by: Sequence,
              rank_col: str = "ranking", method: str = "row_number") -> DataFrame:
    """Number the rows of each group by ``order_by``.

    ``method``: ``row_number`` (unique, ties broken by the order keys),
    ``rank`` (gaps on ties) or ``dense_rank``.
    """
    w = Window.partitionBy(*partition_by).orderBy(*_cols(order_by))
    fn = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}[method]
    return df.withColumn(rank_col, fn().over(w).cast("bigint"))


def top_k_per_group(df: DataFrame, partition_by: Sequence[str], order_by: Sequence,
                    k: int, rank_col: str = "ranking") -> DataFrame:
    """The first ``k`` rows of each group.

    Catalyst plans a ``WindowGroupLimit`` below the window, so each task
    keeps at most ``k`` rows per group before sorting the rest.
    """
    return rank_rows(df, partition_by, order_by, rank_col).filter(F.col(rank_col) <= k)


def ordered_list(rank: str | Column, label: str | Column) -> Column:
    """``collect_list`` whose order is the rank, not the plan's accident."""
    r = F.col(rank) if isinstance(rank, str) else rank
    lab = F.col(label) if isinstance(label, str) else label
    return F.transform(F.array_sort(F.collect_list(F.struct(r.alias("r"), lab.alias("l")))),
                       lambda x: x["l"])
