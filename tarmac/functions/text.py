"""String-building Column helpers (labels, lists, durations, value maps)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def cause_label(name, minutes) -> Column:
    """``'<name> (<minutes> min)'``; null when either part is null (like concat)."""
    return F.concat(_col(name), F.lit(" ("), _col(minutes).cast("bigint").cast("string"),
                    F.lit(" min)"))


def list_text(labels) -> Column:
    """Render an array of strings as ``['a', 'b']``; an empty array as ``[]``.

    Null elements are skipped (as ``concat_ws`` does); a null array is ``[]``.
    """
    arr = F.filter(F.coalesce(_col(labels), F.array().cast("array<string>")),
                   lambda x: x.isNotNull())
    return F.when(F.size(arr) == 0, F.lit("[]")).otherwise(
        F.concat(F.lit("['"), F.array_join(arr, "', '"), F.lit("']")))


def map_values(c, mapping: Mapping[str, str]) -> Column:
    """Replace values found in ``mapping``; other values pass through."""
    if not mapping:
        return _col(c)
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    lookup = F.create_map(*pairs)
    return F.coalesce(F.element_at(lookup, _col(c)), _col(c))


def fmt_duration(seconds) -> Column:
    """Whole seconds as ``HH:MM:SS``; whole days are cut off (time of day)."""
    s = _col(seconds).cast("bigint")
    day = F.pmod(s, F.lit(86400))
    return F.format_string("%02d:%02d:%02d", F.floor(day / 3600).cast("int"),
                           F.floor(F.pmod(day, F.lit(3600)) / 60).cast("int"),
                           F.pmod(day, F.lit(60)).cast("int"))
