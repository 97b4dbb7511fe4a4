"""The three flight reports and the README extras, as DataFrame plans.

Plan shape at scale (one scan of the flight table per report):

* Q1: one ``groupBy(carrier, origin, month)``; partial aggregation before
  the exchange, so a hot airport costs one partial row per task.
* Q2: one ``groupBy(origin, month)`` computes the three bands AND the five
  cause sums (the original ran five filtered aggregates, a UNION ALL and
  a join).  The cause columns are exploded (keeps the hash partitioning),
  ranked and regrouped without another exchange.
* Q3: one ``groupBy(origin, carrier)`` with unrounded sums; the airport
  baseline is a window over that small aggregate (one small exchange)
  instead of a second scan + aggregate + join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.metrics import (
    clipped, count_where, exact_clipped_mean, exact_mean, exact_mean_where, exact_sum, max_where, min_where, rate,
    rate_of,
)
from tarmac.functions.text import cause_label, list_text
from tarmac.operators.baseline import anomalous, difference, rank_in_group, window_baseline
from tarmac.operators.joins import left_join
from tarmac.operators.topk import ordered_list, top_k_per_group, unpivot_columns
from tarmac.schema import BAND_HIGH_ABOVE, BAND_LOW_BELOW, CAUSES, Q1_COLUMNS, Q2_COLUMNS, Q3_COLUMNS, TOP_CAUSES

CARRIER, AIRPORT, FLIGHTS, LEAST, MOST, MEAN, RATE, MONTH = Q1_COLUMNS
_, _, BAND_LOW, BAND_MID, BAND_HIGH, CAUSE_LIST = Q2_COLUMNS
_, COMPANY, _, DEP_MEAN, ARR_MEAN, _, DIFFERENCE, RANK = Q3_COLUMNS


def flown():
    """Row is a flown (not cancelled) flight."""
    return F.col("cancelled") == 0


def cancelled():
    return F.col("cancelled") == 1


# --------------------------------------------------------------------- Q1
def carrier_stats(df: DataFrame, rate_scale: int = 2, sort: bool = True) -> DataFrame:
    """Q1: flights, min/max/mean arrival delay and cancellation rate per
    carrier, origin airport and month.

    Three populations: the minimum is over late (>= 1 min) flown flights,
    the maximum over all flown flights (may be negative), the mean over ALL
    flights with null or early arrival counted as 0.  0.0 when empty.
    """
    arr = F.col("arr_delay")
    out = (df.groupBy("op_unique_carrier", "origin", "month")
             .agg(F.count(F.lit(1)).alias(FLIGHTS),
                  min_where(arr, flown() & (arr >= 1.0), 0.0).alias(LEAST),
                  max_where(arr, flown(), 0.0).alias(MOST),
                  exact_clipped_mean(arr).alias(MEAN),
                  rate(cancelled(), rate_scale).alias(RATE))
             .select(F.col("op_unique_carrier").alias(CARRIER),
                     F.col("origin").alias(AIRPORT),
                     FLIGHTS, LEAST, MOST, MEAN,
                     RATE, F.col("month").alias(MONTH)))
    return out.orderBy(CARRIER, AIRPORT, MONTH) if sort else out


# --------------------------------------------------------------------- Q2
def band_aggs(dep: str = "dep_delay") -> list:
    """Flown flights per departure-delay band; null delay in none."""
    d = F.col(dep)
    return [count_where(flown() & (d < BAND_LOW_BELOW)).alias(BAND_LOW),
            count_where(flown() & d.between(BAND_LOW_BELOW, BAND_HIGH_ABOVE))
            .alias(BAND_MID),
            count_where(flown() & (d > BAND_HIGH_ABOVE)).alias(BAND_HIGH)]


def cause_aggs() -> list:
    """A3: cause minutes summed over flown flights only."""
    return [F.sum(F.when(flown(), F.col(c))).alias(c) for c in CAUSES]


MEAN_COLUMNS = [DEP_MEAN, ARR_MEAN]


def mean_aggs() -> list:
    """Mean departure and arrival delay of flown flights, rounded."""
    return [exact_mean_where("dep_delay", flown()).alias(MEAN_COLUMNS[0]),
            exact_mean_where("arr_delay", flown()).alias(MEAN_COLUMNS[1])]


def airport_month_aggregate(df: DataFrame, with_means: bool = False) -> DataFrame:
    """Bands, cause sums and flown-flight count per (origin, month), one pass."""
    extra = mean_aggs() if with_means else []
    return (df.groupBy("origin", "month")
              .agg(*band_aggs(), *extra, *cause_aggs(), count_where(flown()).alias("_flown")))


def causes_long(agg: DataFrame, keep: list[str] | None = None,
                keep_empty: bool = False) -> DataFrame:
    """One row per (origin, month, cause) with the summed minutes.

    Groups without flown flights have no cause rows (as the original's
    aggregates over ``cancelled = 0`` have none); with ``keep_empty`` they
    keep a single row whose cause is null.
    """
    return unpivot_columns(agg, ["origin", "month", *(keep or [])], CAUSES, "causa",
                           "minuti_totali", keep_empty=keep_empty,
                           only_if=F.col("_flown") > 0, value_type="bigint")


def cause_order() -> list:
    """Minutes descending (null last), then cause name: a total order."""
    return [F.col("minuti_totali").desc_nulls_last(), F.col("causa").asc()]


def airport_month_report(df: DataFrame, k: int = TOP_CAUSES, sort: bool = True,
                         with_means: bool = False) -> DataFrame:
    """Q2: delay bands and the top-k causes per origin airport and month.

    Cause text: ``['A (n min)', 'B (n min)', 'C (n min)']``, causes ordered
    by minutes descending then name; ``[]`` when the airport had no flown
    flight that month.  Causes with 0 minutes still take a place.
    ``with_means`` adds the mean departure and arrival delay (X3) from the
    same aggregate.
    """
    return airport_month_finish(airport_month_aggregate(df, with_means), k, sort)


def airport_month_finish(agg: DataFrame, k: int = TOP_CAUSES, sort: bool = True) -> DataFrame:
    """Q2 from its (origin, month) aggregate: top-k causes and the text."""
    # per-group values carried through the cause rows (constant per group;
    # regrouping on them needs no exchange: the partitioning is on the keys)
    carry = [BAND_LOW, BAND_MID, BAND_HIGH]
    carry += [c for c in MEAN_COLUMNS if c in agg.columns]
    long = causes_long(agg, keep=carry, keep_empty=True)
    top = top_k_per_group(long, ["origin", "month"], cause_order(), k)
    out = (top.groupBy("origin", "month", *carry)
              .agg(ordered_list("ranking", cause_label("causa", "minuti_totali"))
                   .alias("_causes"))
              .select(F.col("origin").alias(AIRPORT), F.col("month").alias(MONTH),
                      *carry, list_text("_causes").alias(CAUSE_LIST)))
    return out.orderBy(AIRPORT, MONTH) if sort else out


def cause_lists(agg: DataFrame, k: int = TOP_CAUSES) -> DataFrame:
    """The list text of the top-k causes per airport and month; none without flown flights."""
    top = top_k_per_group(causes_long(agg), ["origin", "month"], cause_order(), k)
    return top.groupBy("origin", "month").agg(
        list_text(ordered_list("ranking", cause_label("causa", "minuti_totali"))).alias(CAUSE_LIST))


def airport_month_join(agg: DataFrame, k: int = TOP_CAUSES) -> DataFrame:
    """Q2 in the original's shape (J2, J3): bands left-joined with the cause lists on (origin, month).

    ``agg``, the (origin, month) aggregate, should be a written table, since
    both sides read it.  Months without flown flights have no list and stay
    with ``[]``; so do rows of an unknown airport, since null matches nothing.
    """
    bands = agg.select("origin", "month", BAND_LOW, BAND_MID, BAND_HIGH)
    joined = left_join(bands, cause_lists(agg, k), ["origin", "month"])
    return joined.withColumnsRenamed({"origin": AIRPORT, "month": MONTH}).fillna("[]", CAUSE_LIST)


# --------------------------------------------------------------------- Q3
def pair_aggregate(df: DataFrame, rate_scale: int = 2) -> DataFrame:
    """Per (origin, carrier): flights, exact departure sums, rounded means."""
    dep, arr = F.col("dep_delay"), F.col("arr_delay")
    return (df.groupBy("origin", "op_unique_carrier")
              .agg(F.count(F.lit(1)).alias(FLIGHTS),
                   exact_sum(dep, flown()).alias("_dep_sum"),
                   F.count(F.when(flown(), dep)).alias("_dep_n"),
                   exact_mean_where(dep, flown()).alias(DEP_MEAN),
                   exact_mean_where(arr, flown()).alias(ARR_MEAN),
                   rate(cancelled(), rate_scale).alias(RATE)))


def carrier_vs_airport(df: DataFrame, rate_scale: int = 2, sort: bool = True) -> DataFrame:
    """Q3: each carrier at an airport against the airport's mean departure
    delay (flight-weighted, carrier included), ranked by mean ascending.

    Flights count all rows; delay means use flown flights only.
    ``differenza`` is the difference of the two ROUNDED means, rounded;
    ``classifica`` ranks the rounded mean (equal rounded means tie, a null
    mean ranks first).
    """
    return carrier_vs_airport_finish(pair_aggregate(df, rate_scale), sort)


def carrier_vs_airport_finish(pairs: DataFrame, sort: bool = True) -> DataFrame:
    """Q3 from its (origin, carrier) aggregate: airport baseline and rank."""
    based = window_baseline(pairs, ["origin"], "_dep_sum", "_dep_n", "_airport_mean", mean=exact_mean)
    ranked = rank_in_group(based, ["origin"], DEP_MEAN, RANK)
    out = ranked.select(
        F.col("origin").alias(AIRPORT),
        F.col("op_unique_carrier").alias(COMPANY),
        FLIGHTS, DEP_MEAN, ARR_MEAN, RATE,
        difference(DEP_MEAN, "_airport_mean").alias(DIFFERENCE),
        RANK)
    return out.orderBy(AIRPORT, COMPANY, RANK) if sort else out


def airport_mean(df: DataFrame) -> DataFrame:
    """A4: mean departure delay of flown flights per airport, rounded."""
    return (df.groupBy("origin")
              .agg(exact_mean_where("dep_delay", flown()).alias("ritardo_medio_complessivo")))


def airport_mean_of_pairs(pairs: DataFrame) -> DataFrame:
    """A4 from the pair aggregate: its unrounded sums added per airport."""
    return pairs.groupBy("origin").agg(
        exact_mean(F.sum("_dep_sum"), F.sum("_dep_n")).alias("ritardo_medio_complessivo"))


# ------------------------------------------------------- README extras X1-X5
def carrier_routes(df: DataFrame) -> DataFrame:
    """Distinct routes per carrier and their sorted list.

    Distinct (carrier, origin, dest) first, so the list per carrier is
    bounded by the route domain, not by the number of flights.
    """
    routes = df.select("op_unique_carrier",
                       F.concat_ws("-", "origin", "dest").alias("route")).distinct()
    return (routes.groupBy("op_unique_carrier")
                  .agg(F.count(F.lit(1)).alias("numero_tratte"),
                       F.array_sort(F.collect_list("route")).alias("tratte")))


def operating_months(df: DataFrame) -> DataFrame:
    """Sorted list of months in which each carrier flew."""
    months = df.select("op_unique_carrier", "month").distinct()
    return (months.groupBy("op_unique_carrier")
                  .agg(F.count(F.lit(1)).alias("numero_mesi"),
                       F.array_sort(F.collect_list("month")).alias("mesi")))


def airport_month_means(df: DataFrame) -> DataFrame:
    """Mean departure and arrival delay of flown flights per airport-month."""
    return df.groupBy("origin", "month").agg(*mean_aggs())


def cancel_causes(df: DataFrame, k: int = TOP_CAUSES) -> DataFrame:
    """The k most frequent cancellation codes per airport and month."""
    counts = (df.filter(cancelled() & F.col("cancellation_code").isNotNull())
                .groupBy("origin", "month", "cancellation_code")
                .agg(F.count(F.lit(1)).alias("numero_cancellazioni")))
    return _top_codes(counts, k)


def _top_codes(counts: DataFrame, k: int) -> DataFrame:
    return top_k_per_group(counts, ["origin", "month"],
                           [F.col("numero_cancellazioni").desc(),
                            F.col("cancellation_code").asc()], k, RANK)


def anomalous_pairs(df: DataFrame, threshold: float = 10.0) -> DataFrame:
    """Q3 rows whose rounded difference to the airport is >= threshold."""
    return anomalous(carrier_vs_airport(df, sort=False), DIFFERENCE, threshold)


# ------------------------------------------------ all reports from one scan
#: Of ``flight_facts``: columns that add up, and the two that do not.
_ADDED = ["voli", "flown", "gone", "late_sum", "dep_sum", "dep_n", "arr_sum", "arr_n", BAND_LOW,
          BAND_MID, BAND_HIGH, *CAUSES]


def flight_facts(df: DataFrame) -> DataFrame:
    """Mergeable aggregates per carrier, airport, month and cancellation code.

    Counts, exact sums, bounds, delay bands and cause minutes: everything the
    reports roll up.  One scan of the flights; written once, the table has a
    few rows per carrier, airport and month whatever the number of flights,
    and each report is a small aggregate of it.
    """
    dep, arr = F.col("dep_delay"), F.col("arr_delay")
    code = F.when(cancelled(), F.col("cancellation_code")).alias("cancellation_code")
    return df.groupBy("op_unique_carrier", "origin", "month", code).agg(
        F.count(F.lit(1)).alias("voli"), count_where(flown()).alias("flown"), count_where(cancelled()).alias("gone"),
        exact_sum(clipped(arr)).alias("late_sum"),
        exact_sum(dep, flown()).alias("dep_sum"), F.count(F.when(flown(), dep)).alias("dep_n"),
        exact_sum(arr, flown()).alias("arr_sum"), F.count(F.when(flown(), arr)).alias("arr_n"),
        *band_aggs(), *cause_aggs(),
        min_where(arr, flown() & (arr >= 1.0)).alias("first_late"), max_where(arr, flown()).alias("last_arr"))


def _rolled(facts: DataFrame, *keys: str) -> DataFrame:
    return facts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _ADDED], F.min("first_late").alias("first_late"),
                                    F.max("last_arr").alias("last_arr"))


def _means_of_facts() -> list:
    return [exact_mean("dep_sum", "dep_n").alias(MEAN_COLUMNS[0]), exact_mean("arr_sum", "arr_n").alias(MEAN_COLUMNS[1])]


def carrier_stats_of(facts: DataFrame, rate_scale: int = 2, sort: bool = True) -> DataFrame:
    """Q1 from ``flight_facts``."""
    none = F.lit(0.0)
    out = _rolled(facts, "op_unique_carrier", "origin", "month").select(
        F.col("op_unique_carrier").alias(CARRIER), F.col("origin").alias(AIRPORT),
        F.col("voli").alias(FLIGHTS), F.coalesce("first_late", none).alias(LEAST),
        F.coalesce("last_arr", none).alias(MOST), exact_mean("late_sum", "voli").alias(MEAN),
        rate_of("gone", "voli", rate_scale).alias(RATE), F.col("month").alias(MONTH))
    return out.orderBy(CARRIER, AIRPORT, MONTH) if sort else out


def airport_month_report_of(facts: DataFrame, k: int = TOP_CAUSES, sort: bool = True,
                            with_means: bool = False) -> DataFrame:
    """Q2 from ``flight_facts``."""
    agg = _rolled(facts, "origin", "month").withColumn("_flown", F.col("flown"))
    if with_means:
        agg = agg.select("*", *_means_of_facts())
    return airport_month_finish(agg, k, sort)


def carrier_vs_airport_of(facts: DataFrame, rate_scale: int = 2, sort: bool = True) -> DataFrame:
    """Q3 from ``flight_facts``."""
    pairs = _rolled(facts, "origin", "op_unique_carrier").select(
        "origin", "op_unique_carrier", F.col("voli").alias(FLIGHTS), F.col("dep_sum").alias("_dep_sum"),
        F.col("dep_n").alias("_dep_n"), *_means_of_facts(), rate_of("gone", "voli", rate_scale).alias(RATE))
    return carrier_vs_airport_finish(pairs, sort)


def airport_month_means_of(facts: DataFrame) -> DataFrame:
    """X3 from ``flight_facts``."""
    return _rolled(facts, "origin", "month").select("origin", "month", *_means_of_facts())


def cancel_causes_of(facts: DataFrame, k: int = TOP_CAUSES) -> DataFrame:
    """X4 from ``flight_facts``."""
    counts = facts.filter(F.col("cancellation_code").isNotNull()).groupBy("origin", "month", "cancellation_code").agg(
        F.sum("gone").alias("numero_cancellazioni"))
    return _top_codes(counts, k)
