"""Aggregate and scalar Column builders used by the reports.

All builders return ``Column`` expressions, so several metrics share one
``HashAggregate`` (partial aggregation before the shuffle, final after it).
Every aggregate here is algebraic (count, sum, min, max, avg), so a hot key
is absorbed by the map-side partial aggregate instead of one reducer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stable_round(c: ColumnOrName, scale: int) -> Column:
    """Round half-up once to ``scale`` decimals.  Result type: double.

    Spark's ``round`` works on the shortest decimal that prints as the
    double, so a quotient that is a tie in decimals (69/120 = 0.575) is
    rounded up although its binary value lies below, and one that merely
    lies near a tie (1.2349995) is not rounded twice.
    """
    return F.round(_col(c).cast("double"), scale)


def nan_to_null(c: ColumnOrName) -> Column:
    """Floating NaN (pandas' missing value) becomes SQL null."""
    c = _col(c)
    return F.nanvl(c, F.lit(None).cast("double"))


def count_where(cond: Column) -> Column:
    """Number of rows where ``cond`` is true (null counts as false)."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def min_where(c: ColumnOrName, cond: Column, default: float | None = None) -> Column:
    """Minimum of ``c`` over rows where ``cond`` holds; ``default`` if none."""
    m = F.min(F.when(cond, _col(c)))
    return m if default is None else F.coalesce(m, F.lit(default))


def max_where(c: ColumnOrName, cond: Column, default: float | None = None) -> Column:
    """Maximum of ``c`` over rows where ``cond`` holds; ``default`` if none."""
    m = F.max(F.when(cond, _col(c)))
    return m if default is None else F.coalesce(m, F.lit(default))


#: Exact sums count delays in units of 1 / UNITS minute, each value rounded to one.
UNITS = 1_000_000
_LOW_BITS = 20


def exact_sum(c: ColumnOrName, cond: Column | None = None) -> Column:
    """Sum of ``c`` (where ``cond`` holds) in units, as a decimal without fraction; null if there is no value.

    Integer sums do not depend on the order of their rows, so every layout
    of the table gives the same bits.  High and low bits are summed apart in
    two longs, which no group of fewer than 2**43 rows can overflow.
    """
    value = _col(c) if cond is None else F.when(cond, _col(c))
    units = F.rint(nan_to_null(value.cast("double")) * F.lit(float(UNITS))).cast("bigint")
    high = F.sum(F.shiftright(units, _LOW_BITS)).cast("decimal(20,0)")
    low = F.sum(units.bitwiseAND((1 << _LOW_BITS) - 1)).cast("decimal(20,0)")
    return high * F.lit(1 << _LOW_BITS).cast("decimal(7,0)") + low


def exact_mean(total: ColumnOrName, n: ColumnOrName, scale: int = 2) -> Column:
    """``total`` units over ``n`` values in minutes, rounded half up once by integer division; null for ``n`` = 0."""
    total, n = _col(total).cast("decimal(30,0)"), _col(n).cast("decimal(20,0)")
    steps = 10 ** scale
    whole = n * F.lit(UNITS).cast("decimal(7,0)")
    rounded = F.call_function("div", F.abs(total) * F.lit(2 * steps).cast("decimal(7,0)") + whole,
                              whole * F.lit(2).cast("decimal(1,0)")).cast("double")
    return F.when(n > 0, F.signum(total) * rounded / F.lit(float(steps)))


def exact_mean_where(c: ColumnOrName, cond: Column, scale: int = 2) -> Column:
    """Mean of non-null ``c`` over rows where ``cond`` holds, exact and rounded once."""
    return exact_mean(exact_sum(c, cond), F.count(F.when(cond, nan_to_null(_col(c).cast("double")))), scale)


def clipped(c: ColumnOrName, low: float = 0.0) -> Column:
    """``max(low, c)``, a null ``c`` counting as ``low``."""
    return F.greatest(F.lit(low), F.coalesce(_col(c), F.lit(low)))


def exact_clipped_mean(c: ColumnOrName, low: float = 0.0, scale: int = 2) -> Column:
    """``clipped_mean``, exact and rounded once."""
    return exact_mean(exact_sum(clipped(c, low)), F.count(F.lit(1)), scale)


def mean_where(c: ColumnOrName, cond: Column) -> Column:
    """Mean of non-null ``c`` over rows where ``cond`` holds (null if none)."""
    return F.avg(F.when(cond, _col(c)))


def clipped_mean(c: ColumnOrName, low: float = 0.0) -> Column:
    """Mean over ALL rows of ``max(low, c)``, a null ``c`` counting as ``low``.

    Cancelled and diverted flights (null arrival delay) and early arrivals
    all count as zero delay.
    """
    return F.avg(clipped(c, low))


def rate(cond: Column, scale: int | None = 2, percent: bool = True) -> Column:
    """Share of rows where ``cond`` is true, in percent, rounded to ``scale``."""
    return rate_of(count_where(cond), F.count(F.lit(1)), scale, percent)


def rate_of(hits: ColumnOrName, n: ColumnOrName, scale: int | None = 2, percent: bool = True) -> Column:
    """``rate`` from the two counts."""
    hits = _col(hits).cast("double")
    if percent:
        hits = hits * F.lit(100.0)  # before the one division, so that ties stay ties
    share = F.try_divide(hits, _col(n))  # null (not an error) on no rows
    return share if scale is None else stable_round(share, scale)


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den`` as double, null when ``den`` is 0 or null."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
