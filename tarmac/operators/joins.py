"""Left equi join of a frame with one row per key from another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join(df: DataFrame, aux: DataFrame, on: str | Sequence[str], null_safe: bool = False) -> DataFrame:
    """Every row of ``df`` with the other columns of its ``aux`` row, null where there is none.

    ``aux`` must hold each key once.  That is checked where the rows meet:
    ``aux`` is grouped by the key, which keeps the partitioning that an
    aggregate by the same key already has, and a key of several rows stops
    the job when its columns are read.  So no row of ``df`` can come out
    twice.  A null in a key matches nothing, as in SQL, and its row of
    ``df`` stays; with ``null_safe`` null keys match each other.

    No side is hinted: Catalyst broadcasts ``aux`` if its size estimate (at
    run time: its measured size) is under the threshold, else it is a
    sort-merge join whose skewed keys of ``df`` adaptive execution splits.
    """
    on = [on] if isinstance(on, str) else list(on)
    extra = [c for c in aux.columns if c not in on]
    clash = sorted(set(extra) & set(df.columns))
    if clash or not on:
        raise ValueError(f"columns on both sides: {clash}" if clash else "no key")
    keys = [F.col(f"`{c}`") for c in on]
    if not null_safe:  # these rows can match nothing
        for key in keys:
            aux = aux.filter(key.isNotNull())
    row = F.struct(*[F.col(f"`{c}`") for c in extra])
    kind = aux.select(row.alias("r")).schema["r"].dataType
    text = F.concat_ws(", ", *[F.coalesce(k.cast("string"), F.lit("null")) for k in keys])
    several = F.raise_error(F.concat(F.lit("several rows of the right side for "), text)).cast(kind)
    once = aux.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(row).alias("_row"))
    once = once.select(*[k.alias(f"_key{i}") for i, k in enumerate(keys)],
                       F.when(F.col("_n") == 1, F.col("_row")).otherwise(several).alias("_row"))
    match = None
    for i, key in enumerate(keys):
        equal = key.eqNullSafe(F.col(f"_key{i}")) if null_safe else key == F.col(f"_key{i}")
        match = equal if match is None else match & equal
    joined = df.join(once, match, "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col("_row").getField(c).alias(c) for c in extra])
