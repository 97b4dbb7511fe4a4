"""Registered queries (key -> (spark, sf_dir) -> DataFrame) and their oracles.

Every query derives the flight view from the tables of ``sf_dir`` and runs
over the whole table.  Oracle texts are DuckDB SQL (see ``oracle.py``).
"""

from __future__ import annotations

import itertools
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.metrics import exact_clipped_mean, exact_mean_where, max_where, min_where, rate
from tarmac.functions.text import cause_label, fmt_duration, list_text, map_values
from tarmac.operators import prep, profile, volumes
from tarmac.operators.baseline import join_baseline, rank_in_group
from tarmac.operators.profile import head_n
from tarmac.operators.topk import ordered_list, rank_rows, top_k_per_group
from tarmac.plans import jobs
from tarmac.plans import oracle as O
from tarmac.plans import reports as R
from tarmac.plans import runlog as RL
from tarmac.schema import CAUSES, CLEAN_DDL, CLEAN_SCHEMA, RAW_SCHEMA, TARGET_COLUMNS, VOLUME_PERCENTS
from tarmac.session import checkpoint_dir
from tarmac.sources.catalog import register_table, run_sql_file, use_db
from tarmac.sources.flightview import flights_raw
from tarmac.sources.io import (
    current_run, read_clean, read_raw, read_runlog, write_report, write_split, write_volume,
)
from tarmac.streaming import read_published, run_incremental_report

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn
    return deco


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean flight table derived from ``sf_dir``."""
    return prep.clean(flights_raw(spark, sf_dir))


def _written_path(spark: SparkSession, df: DataFrame, name: str) -> str:
    """Write ``df`` as Parquet under a new path of the shared folder."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tarmac_{name}_{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def _written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    return spark.read.schema(df.schema).parquet(_written_path(spark, df, name))


W = O.with_flights
RAW_COLS = ", ".join(RAW_SCHEMA.fieldNames())
_DUCK_NOT_OUTLIER = ("NOT coalesce(dep_delay < -30 OR dep_delay > 1440, false) "
                     "AND NOT coalesce(arr_delay < -30 OR arr_delay > 1440, false)")

# ------------------------------------------------------------------ reports
@register("q1_carrier_stats", W(O.Q1))
def q1_carrier_stats(spark, sf_dir):
    return R.carrier_stats(flights(spark, sf_dir))


@register("q2_report", W(O.Q2, O.CAUSE_UNION))
def q2_report(spark, sf_dir):
    return R.airport_month_report(flights(spark, sf_dir))


_MEANS_CTE = f"means AS (SELECT origin, month, {O.MEANS} FROM facts GROUP BY ALL)"


@register("q2_report_with_means", W("""
SELECT q.*, m.ritardo_medio_partenza, m.ritardo_medio_arrivo
FROM (""" + O.Q2 + """) q JOIN means m ON q.aeroporto_partenza = m.origin AND q.mese = m.month""",
    O.CAUSE_UNION + ",\n" + _MEANS_CTE))
def q2_report_with_means(spark, sf_dir):
    """Q2 with the README's mean departure/arrival delays (X3), one pass."""
    return R.airport_month_report(flights(spark, sf_dir), with_means=True)


@register("q3_anomaly_rank", W("SELECT * FROM q3", O.Q3_CTES))
def q3_anomaly_rank(spark, sf_dir):
    return R.carrier_vs_airport(flights(spark, sf_dir))


@register("q1_rate_scale_1", W(O.q1(rate_scale=1)))
def q1_rate_scale_1(spark, sf_dir):
    """Q1 with the SQL form's one-decimal cancellation rate."""
    return R.carrier_stats(flights(spark, sf_dir), rate_scale=1)


# ------------------------------------------------------- scans and cleaning
@register("scan_clean", W("SELECT * FROM flights"))
def scan_clean(spark, sf_dir):
    """S8 + S2: the clean table written as Parquet to the checkpoint folder,
    read back with schema merging."""
    return read_clean(spark, _written_path(spark, flights(spark, sf_dir), "clean"), merge_schema=True)


@register("clean_drop_corrupt", W(f"SELECT {RAW_COLS} FROM raw_ok"))
def clean_drop_corrupt(spark, sf_dir):
    return prep.drop_corrupt(flights_raw(spark, sf_dir))


@register("clean_parse_date", W(
    "SELECT " + RAW_COLS.replace("fl_date,", "CAST(fl_date AS TIMESTAMP) AS fl_date,")
    + " FROM flights_raw"))
def clean_parse_date(spark, sf_dir):
    return prep.parse_date(flights_raw(spark, sf_dir), "fl_date")


@register("clean_coerce", W(
    "SELECT origin, month, " + ", ".join(f"CASE WHEN month % 4 <> 3 THEN CAST({c} AS DOUBLE) END AS {c}" for c in CAUSES)
    + " FROM flights_raw"))
def clean_coerce(spark, sf_dir):
    """P5 on text; a quarter of the months holds text that is no number."""
    unit = F.when(F.col("month") % 4 == 3, F.lit(" min")).otherwise(F.lit(""))
    raw = flights_raw(spark, sf_dir).select("origin", "month", *[F.concat(F.col(c).cast("string"), unit).alias(c)
                                                               for c in CAUSES])
    return prep.coerce_numeric(raw, list(CAUSES))


@register("clean_impute_causes", W(
    "SELECT origin, month, "
    + ", ".join(f"CAST(coalesce(TRY_CAST({c} AS DOUBLE), 0) AS BIGINT) AS {c}" for c in CAUSES)
    + " FROM flights_raw"))
def clean_impute_causes(spark, sf_dir):
    raw = flights_raw(spark, sf_dir).select("origin", "month", *CAUSES)
    return prep.impute_causes(raw)


@register("clean_drop_outliers", W(f"SELECT {RAW_COLS} FROM flights_raw WHERE {_DUCK_NOT_OUTLIER}"))
def clean_drop_outliers(spark, sf_dir):
    return prep.drop_outliers(flights_raw(spark, sf_dir))


@register("clean_pipeline", W("SELECT * FROM flights"))
def clean_pipeline(spark, sf_dir):
    return flights(spark, sf_dir)


# ------------------------------------------------------------------ profiles
def _clean_steps():
    return {"drop_corrupt": ~F.coalesce(prep.corrupt_condition(), F.lit(False)),
            "drop_outliers": ~prep.outlier_condition()}


@register("profile_step_counts", W(f"""
SELECT 'input' AS step, count(*) AS rows FROM flights_raw
UNION ALL SELECT 'drop_corrupt', count(*) FROM raw_ok
UNION ALL SELECT 'drop_outliers', count(*) FROM raw_ok WHERE {_DUCK_NOT_OUTLIER}"""))
def profile_step_counts(spark, sf_dir):
    return profile.step_counts(flights_raw(spark, sf_dir), _clean_steps())


def _null_sql(source: str, cols) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(CASE WHEN {c} IS NULL THEN 1 END) AS null_count "
        f"FROM {source}"
        for c in cols)


@register("profile_nulls", W(_null_sql("flights", TARGET_COLUMNS)))
def profile_nulls(spark, sf_dir):
    return profile.null_counts(flights(spark, sf_dir), TARGET_COLUMNS)


@register("profile_distinct", W(
    "SELECT cancellation_code, count(*) AS rows FROM flights_raw GROUP BY cancellation_code"))
def profile_distinct(spark, sf_dir):
    return profile.distinct_values(flights_raw(spark, sf_dir), "cancellation_code")


@register("profile_bounds", W("""
SELECT min(dep_delay) AS dep_delay_min, max(dep_delay) AS dep_delay_max,
       min(arr_delay) AS arr_delay_min, max(arr_delay) AS arr_delay_max FROM raw_ok"""))
def profile_bounds(spark, sf_dir):
    return profile.bounds(prep.drop_corrupt(flights_raw(spark, sf_dir)),
                          ["dep_delay", "arr_delay"])


@register("profile_outliers", W(f"""
SELECT CAST(count_if(NOT ({_DUCK_NOT_OUTLIER})) AS BIGINT) AS outliers, count(*) AS rows,
       CAST(count_if(NOT ({_DUCK_NOT_OUTLIER})) AS DOUBLE) / count(*) * 100.0 AS percent
FROM raw_ok"""))
def profile_outliers(spark, sf_dir):
    return profile.outlier_share(prep.drop_corrupt(flights_raw(spark, sf_dir)),
                                 prep.outlier_condition())


@register("profile_missing_code", W(
    "SELECT * FROM (" + _null_sql("missing", TARGET_COLUMNS) + ")",
    "missing AS (SELECT * REPLACE (CAST(NULL AS VARCHAR) AS cancellation_code) FROM flights "
    "WHERE month IN (2, 5) AND cancelled = 1)"))
def profile_missing_code(spark, sf_dir):
    """D8 over the table with the codes of two months taken away."""
    f = flights(spark, sf_dir).withColumn("cancellation_code", F.when(
        ~F.col("month").isin(2, 5), F.col("cancellation_code")))
    missing = f.filter(F.col("cancellation_code").isNull() & (F.col("cancelled") == 1))
    return profile.null_counts(missing, TARGET_COLUMNS)


_SCHEMA_SQL = "\nUNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, CASE any_value(typeof({c})) "
    "WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'VARCHAR' THEN 'string' ELSE lower(any_value(typeof("
    f"{c}))) END AS data_type, count({c}) AS non_null FROM flights"
    for i, c in enumerate(TARGET_COLUMNS))


@register("profile_schema", W(_SCHEMA_SQL))
def profile_schema(spark, sf_dir):
    """The clean table's columns, Spark types (the table DDL) and
    non-null counts."""
    return profile.describe_schema(flights(spark, sf_dir))


# ---------------------------------------------------------- metric builders
@register("agg_by_key", W("""
SELECT op_unique_carrier AS codice, origin AS aeroporto_partenza, count(*) AS numero_voli,
       CAST(sum(carrier_delay) AS BIGINT) AS minuti_vettore
FROM flights GROUP BY op_unique_carrier, origin"""))
def agg_by_key(spark, sf_dir):
    return (flights(spark, sf_dir).groupBy("op_unique_carrier", "origin")
            .agg(F.count(F.lit(1)).alias("numero_voli"),
                 F.sum("carrier_delay").alias("minuti_vettore"))
            .withColumnsRenamed({"op_unique_carrier": "codice",
                                 "origin": "aeroporto_partenza"}))


@register("cond_agg", W(f"""
SELECT carrier AS codice, origin AS aeroporto_partenza, {O.LATE_BOUNDS}
FROM facts GROUP BY ALL"""))
def cond_agg(spark, sf_dir):
    arr = F.col("arr_delay")
    return (flights(spark, sf_dir).groupBy("op_unique_carrier", "origin")
            .agg(min_where(arr, R.flown() & (arr >= 1.0), 0.0).alias("ritardo_minimo"),
                 max_where(arr, R.flown(), 0.0).alias("ritardo_massimo"))
            .withColumnsRenamed({"op_unique_carrier": "codice",
                                 "origin": "aeroporto_partenza"}))


@register("clipped_mean", W(f"""
SELECT carrier AS codice, {O.LATE_MEAN} AS ritardo_medio FROM facts GROUP BY ALL"""))
def clipped_mean_q(spark, sf_dir):
    return (flights(spark, sf_dir).groupBy(F.col("op_unique_carrier").alias("codice"))
            .agg(exact_clipped_mean("arr_delay").alias("ritardo_medio")))


@register("cancel_rate", W(f"""
SELECT origin AS aeroporto_partenza, {O.rate(2)} AS tasso_cancellazione,
       {O.rate(1)} AS tasso_cancellazione_1
FROM facts GROUP BY ALL"""))
def cancel_rate(spark, sf_dir):
    return (flights(spark, sf_dir).groupBy(F.col("origin").alias("aeroporto_partenza"))
            .agg(rate(R.cancelled(), 2).alias("tasso_cancellazione"),
                 rate(R.cancelled(), 1).alias("tasso_cancellazione_1")))


@register("delay_buckets", W("""
SELECT origin AS aeroporto_partenza, month AS mese,
       CAST(numero_ritardi_basso AS BIGINT) AS numero_ritardi_basso,
       CAST(numero_ritardi_medio AS BIGINT) AS numero_ritardi_medio,
       CAST(numero_ritardi_alto AS BIGINT) AS numero_ritardi_alto
FROM bands""", "bands AS (" + O.BANDS + ")"))
def delay_buckets(spark, sf_dir):
    return (flights(spark, sf_dir).groupBy("origin", "month").agg(*R.band_aggs())
            .withColumnsRenamed({"origin": "aeroporto_partenza", "month": "mese"}))


@register("airport_mean", W(f"SELECT origin AS aeroporto_partenza, {O.as_number('units')} "
                            "AS ritardo_medio_complessivo FROM airport_stat", O.Q3_CTES))
def airport_mean_q(spark, sf_dir):
    return R.airport_mean(flights(spark, sf_dir)).withColumnRenamed("origin",
                                                                    "aeroporto_partenza")


# ------------------------------------------------------------- Q3 pieces
@register("join_airport_baseline", W(f"""
SELECT p.origin AS aeroporto_partenza, p.carrier AS compagnia,
       {O.as_number("p.dep_units")} AS ritardo_medio_partenza,
       {O.as_number("a.units")} AS ritardo_medio_complessivo
FROM pair_stat p JOIN airport_stat a USING (origin)""", O.Q3_CTES))
def join_airport_baseline(spark, sf_dir):
    """The original's shape, pair aggregate joined with airport aggregate.

    The flight table is read once: the airport sums are sums of the pair
    sums, and the pair aggregate is written to the shared folder first."""
    pairs = _written(spark, R.pair_aggregate(flights(spark, sf_dir)), "pairs")
    return (join_baseline(pairs.select("origin", "op_unique_carrier", "ritardo_medio_partenza"),
                          R.airport_mean_of_pairs(pairs), ["origin"])
            .select(F.col("origin").alias("aeroporto_partenza"),
                    F.col("op_unique_carrier").alias("compagnia"),
                    "ritardo_medio_partenza", "ritardo_medio_complessivo"))


@register("rank_carriers", W("""
SELECT aeroporto_partenza, compagnia, ritardo_medio_partenza, classifica FROM q3""", O.Q3_CTES))
def rank_carriers(spark, sf_dir):
    pairs = R.pair_aggregate(flights(spark, sf_dir))
    return (rank_in_group(pairs, ["origin"], "ritardo_medio_partenza", "classifica")
            .select(F.col("origin").alias("aeroporto_partenza"),
                    F.col("op_unique_carrier").alias("compagnia"),
                    "ritardo_medio_partenza", "classifica"))


# ------------------------------------------------------------- Q2 pieces
def _causes_long(spark, sf_dir):
    return R.causes_long(R.airport_month_aggregate(flights(spark, sf_dir)))


@register("unpivot_causes", W("SELECT origin, month, causa, CAST(minuti_totali AS BIGINT) "
                              "AS minuti_totali FROM cause_sums", O.CAUSE_UNION))
def unpivot_causes(spark, sf_dir):
    return _causes_long(spark, sf_dir)


@register("rank_causes", W("SELECT origin, month, causa, minuti_totali, ranking "
                           "FROM cause_ranked", O.CAUSE_UNION))
def rank_causes(spark, sf_dir):
    return rank_rows(_causes_long(spark, sf_dir), ["origin", "month"], R.cause_order())


@register("topk_causes", W("SELECT origin, month, causa, minuti_totali, ranking "
                           "FROM cause_ranked WHERE ranking <= 3", O.CAUSE_UNION))
def topk_causes(spark, sf_dir):
    return top_k_per_group(_causes_long(spark, sf_dir), ["origin", "month"], R.cause_order(), 3)


@register("cause_label", W("SELECT origin, month, ranking, cause_desc "
                           "FROM cause_ranked WHERE ranking <= 3", O.CAUSE_UNION))
def cause_label_q(spark, sf_dir):
    top = top_k_per_group(_causes_long(spark, sf_dir), ["origin", "month"], R.cause_order(), 3)
    return top.select("origin", "month", "ranking",
                      cause_label("causa", "minuti_totali").alias("cause_desc"))


@register("q2_causes", W("SELECT origin AS aeroporto_partenza, month AS mese, cause_maggiori "
                         "FROM cause_top", O.CAUSE_UNION))
def q2_causes(spark, sf_dir):
    top = top_k_per_group(_causes_long(spark, sf_dir), ["origin", "month"], R.cause_order(), 3)
    return (top.groupBy("origin", "month")
               .agg(list_text(ordered_list("ranking", cause_label("causa", "minuti_totali")))
                    .alias("cause_maggiori"))
               .withColumnsRenamed({"origin": "aeroporto_partenza", "month": "mese"}))


def _with_gaps(f: DataFrame) -> DataFrame:
    """The flights of one airport in March cancelled, the origin of a twentieth of the rest unknown."""
    none = (F.col("op_carrier_fl_num") % 20 == 3) & (F.col("month") != 3)
    first = F.col("origin") == "NATION_12"
    return f.withColumns({"origin": F.when(~F.coalesce(none, F.lit(False)), F.col("origin")),
                          "cancelled": F.when(first & (F.col("month") == 3), 1).otherwise(F.col("cancelled"))})


@register("join_month_causes", W("""
SELECT b.origin AS aeroporto_partenza, b.month AS mese, b.basso AS numero_ritardi_basso,
       b.medio AS numero_ritardi_medio, b.alto AS numero_ritardi_alto, coalesce(c.cause_maggiori, '[]') AS cause_maggiori
FROM (SELECT origin, month, count_if(flown AND dep_delay < 15) AS basso,
             count_if(flown AND dep_delay BETWEEN 15 AND 60) AS medio, count_if(flown AND dep_delay > 60) AS alto
      FROM gaps GROUP BY ALL) b
LEFT JOIN (SELECT origin, month, CAST(list_transform(list_sort(array_agg({'m': -minutes, 'c': cause}))[1:3],
                    lambda p: p.c || ' (' || abs(p.m) || ' min)') AS VARCHAR) AS cause_maggiori
           FROM (SELECT origin, month, cause, CAST(sum(minutes) AS BIGINT) AS minutes FROM gap_causes GROUP BY ALL)
           GROUP BY ALL) c
ON b.origin = c.origin AND b.month = c.month""", f"""
gaps AS (
  SELECT * REPLACE (CASE WHEN NOT coalesce(op_carrier_fl_num % 20 = 3 AND month <> 3, false) THEN origin END AS origin),
         cancelled = 0 AND NOT coalesce(origin = 'NATION_12' AND month = 3, false) AS flown
  FROM flights),
gap_causes AS ({" UNION ALL ".join(
        f"SELECT origin, month, '{name}' AS cause, {c} AS minutes FROM gaps WHERE flown" for c, name in CAUSES.items())})"""))
def join_month_causes(spark, sf_dir):
    """Bands left-joined with cause lists; an airport-month without flown flights, unknown origins.

    Both sides come from one written aggregate, so the flights are read once."""
    return R.airport_month_join(_written(spark, R.airport_month_aggregate(_with_gaps(flights(spark, sf_dir))), "months"))


# ---------------------------------------------------------- SQL-text path
_view_ids = itertools.count()


def _sql_report(spark, sf_dir, name, args):
    view = f"tarmac_flights_{next(_view_ids)}"
    register_table(spark, view, df=flights(spark, sf_dir))
    return run_sql_file(spark, name, {"flights": view, **args})


@register("sql_q1", W(O.Q1))
def sql_q1(spark, sf_dir):
    return _sql_report(spark, sf_dir, "q1", {"rate_scale": 2})


@register("sql_q2", W(O.Q2, O.CAUSE_UNION))
def sql_q2(spark, sf_dir):
    return _sql_report(spark, sf_dir, "q2", {"k": 3})


@register("sql_q3", W("SELECT * FROM q3", O.Q3_CTES))
def sql_q3(spark, sf_dir):
    return _sql_report(spark, sf_dir, "q3", {"rate_scale": 2})


# ------------------------------------------------------------------ top 10
@register("top10_q1", W(O.Q1 + " ORDER BY codice, aeroporto_partenza, mese LIMIT 10"))
def top10_q1(spark, sf_dir):
    return head_n(q1_carrier_stats(spark, sf_dir), ["codice", "aeroporto_partenza", "mese"])


@register("top10_q2", W(O.Q2 + " ORDER BY aeroporto_partenza, mese LIMIT 10", O.CAUSE_UNION))
def top10_q2(spark, sf_dir):
    return head_n(q2_report(spark, sf_dir), ["aeroporto_partenza", "mese"])


@register("top10_q3", W("SELECT * FROM q3 ORDER BY aeroporto_partenza, compagnia, classifica "
                        "LIMIT 10", O.Q3_CTES))
def top10_q3(spark, sf_dir):
    return head_n(q3_anomaly_rank(spark, sf_dir), ["aeroporto_partenza", "compagnia", "classifica"])


# ----------------------------------------------------------------- volumes
def _sample_ctes(percent: int, name: str = "taken") -> str:
    """Copies of every distinct row: floor(m * f), and one more for those of the
    smallest hash / fraction until the volume has round(n * f) rows."""
    text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), chr(92) || 'N')" for c in TARGET_COLUMNS)
    parts = percent * 100
    return f"""{name}_rows AS (
  SELECT {", ".join(TARGET_COLUMNS)}, count(*) AS m, md5(concat_ws('|', {text}, '42')) AS k
  FROM flights GROUP BY ALL),
{name}_parts AS (
  SELECT *, m * {parts} // 10000 AS base, m * {parts} % 10000 AS part,
         CAST(CAST('0x' || substr(k, 1, 8) AS BIGINT) AS DOUBLE) AS h FROM {name}_rows),
{name}_ranked AS (
  SELECT *, CASE WHEN part > 0 THEN row_number() OVER (
              ORDER BY CASE WHEN part > 0 THEN floor(h / CAST(part AS DOUBLE) * 65536.0) END NULLS LAST, k) END AS place
  FROM {name}_parts),
{name}_size AS (SELECT (2 * sum(m) * {parts} + 10000) // 20000 - sum(base) AS more FROM {name}_parts),
{name} AS (
  SELECT {", ".join(TARGET_COLUMNS)}, unnest(range(CAST(base + CASE WHEN place <= more THEN 1 ELSE 0 END AS BIGINT))) AS copy
  FROM {name}_ranked, {name}_size)"""


_TAKEN = f"SELECT {', '.join(TARGET_COLUMNS)} FROM taken"


@register("sample_10", W(_TAKEN, _sample_ctes(10)))
def sample_10(spark, sf_dir):
    return volumes.sample_volume(_written(spark, flights(spark, sf_dir), "clean"), 10)


@register("sample_50", W(_TAKEN, _sample_ctes(50)))
def sample_50(spark, sf_dir):
    return volumes.sample_volume(_written(spark, flights(spark, sf_dir), "clean"), 50)


@register("sample_exact_10", W("SELECT copies, count(*) AS rows FROM (SELECT count(*) AS copies FROM "
                               f"taken GROUP BY {', '.join(TARGET_COLUMNS)}) GROUP BY ALL", _sample_ctes(10)))
def sample_exact_10(spark, sf_dir):
    """How often equal rows occur in a volume of exactly ``round(n / 10)`` rows."""
    taken = volumes.sample_volume(_written(spark, flights(spark, sf_dir), "clean"), 10, exact=True)
    return (taken.groupBy(*taken.columns).agg(F.count(F.lit(1)).alias("copies"))
            .groupBy("copies").agg(F.count(F.lit(1)).alias("rows")))


@register("scale_150", W("SELECT * FROM flights UNION ALL " + _TAKEN, _sample_ctes(50)))
def scale_150(spark, sf_dir):
    return volumes.scale_up(_written(spark, flights(spark, sf_dir), "clean"), 150)


#: Sampled volumes, and the sample that a volume over 100 % adds.
_VOLUME_CTES = {10: "taken", 25: "quarter", 50: "half", 75: "most"}


def _volume_size(percent: int) -> str:
    name = "flights" if percent == 100 else _VOLUME_CTES[percent]
    return (f"SELECT {percent} AS volume, CAST(count(*) AS BIGINT) AS rows, "
            f"CAST(sum(arr_delay) AS BIGINT) AS minutes FROM {name} UNION ALL ")


@register("build_volumes", W(
    "".join(map(_volume_size, [10, 25, 50, 75, 100])) +
    "SELECT 150, (SELECT count(*) FROM flights) + (SELECT count(*) FROM half), "
    "CAST((SELECT sum(arr_delay) FROM flights) + (SELECT sum(arr_delay) FROM half) AS BIGINT)",
    ",\n".join(_sample_ctes(percent, name) for percent, name in _VOLUME_CTES.items())))
def build_volumes_q(spark, sf_dir):
    """Every volume written through the volume sink and read back, with their sizes."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/tarmac_volumes_{uuid.uuid4().hex}"
    paths = volumes.build_volumes(_written(spark, flights(spark, sf_dir), "clean"), base, VOLUME_PERCENTS)
    sizes = [read_clean(spark, path).agg(F.lit(p).alias("volume"), F.count(F.lit(1)).alias("rows"),
                                         F.sum("arr_delay").cast("bigint").alias("minutes"))
             for p, path in paths.items()]
    return reduce(DataFrame.unionByName, sizes)


# ---------------------------------------------------------- README extras
@register("x_routes", W("""
SELECT op_unique_carrier AS codice, count(*) AS numero_tratte,
       string_agg(route, ',' ORDER BY route) AS tratte
FROM (SELECT DISTINCT op_unique_carrier, origin || '-' || dest AS route FROM flights)
GROUP BY op_unique_carrier"""))
def x_routes(spark, sf_dir):
    return (R.carrier_routes(flights(spark, sf_dir))
            .select(F.col("op_unique_carrier").alias("codice"), "numero_tratte",
                    F.array_join("tratte", ",").alias("tratte")))


@register("x_months", W("""
SELECT op_unique_carrier AS codice, count(*) AS numero_mesi,
       string_agg(CAST(month AS VARCHAR), ',' ORDER BY month) AS mesi
FROM (SELECT DISTINCT op_unique_carrier, month FROM flights)
GROUP BY op_unique_carrier"""))
def x_months(spark, sf_dir):
    return (R.operating_months(flights(spark, sf_dir))
            .select(F.col("op_unique_carrier").alias("codice"), "numero_mesi",
                    F.array_join(F.col("mesi").cast("array<string>"), ",").alias("mesi")))


@register("x_airport_month_means", W(f"""
SELECT origin AS aeroporto_partenza, month AS mese, {O.MEANS} FROM facts GROUP BY ALL"""))
def x_airport_month_means(spark, sf_dir):
    return (R.airport_month_means(flights(spark, sf_dir))
            .withColumnsRenamed({"origin": "aeroporto_partenza", "month": "mese"}))


@register("x_cancel_causes", W("""
SELECT origin, month, cancellation_code, numero_cancellazioni, classifica FROM (
  SELECT origin, month, cancellation_code, count(*) AS numero_cancellazioni,
         row_number() OVER (PARTITION BY origin, month
                            ORDER BY count(*) DESC, cancellation_code) AS classifica
  FROM flights WHERE cancelled = 1 AND cancellation_code IS NOT NULL
  GROUP BY origin, month, cancellation_code)
WHERE classifica <= 3"""))
def x_cancel_causes(spark, sf_dir):
    return R.cancel_causes(flights(spark, sf_dir))


@register("x_anomalous_pairs", W("SELECT * FROM q3 WHERE abs(differenza) >= 10.0", O.Q3_CTES))
def x_anomalous_pairs(spark, sf_dir):
    return R.anomalous_pairs(flights(spark, sf_dir), 10.0)


# ------------------------------------------ reports rolled up from one scan
def _facts(spark, sf_dir):
    return _written(spark, R.flight_facts(flights(spark, sf_dir)), "facts")


@register("rollup_q1", W(O.Q1))
def rollup_q1(spark, sf_dir):
    """Q1 from the written table of flight facts, as are the next four."""
    return R.carrier_stats_of(_facts(spark, sf_dir))


@register("rollup_q2", W(O.Q2, O.CAUSE_UNION))
def rollup_q2(spark, sf_dir):
    return R.airport_month_report_of(_facts(spark, sf_dir))


@register("rollup_q3", W("SELECT * FROM q3", O.Q3_CTES))
def rollup_q3(spark, sf_dir):
    return R.carrier_vs_airport_of(_facts(spark, sf_dir))


@register("rollup_means", ORACLE["x_airport_month_means"])
def rollup_means(spark, sf_dir):
    return (R.airport_month_means_of(_facts(spark, sf_dir))
            .withColumnsRenamed({"origin": "aeroporto_partenza", "month": "mese"}))


@register("rollup_cancel_causes", ORACLE["x_cancel_causes"])
def rollup_cancel_causes(spark, sf_dir):
    return R.cancel_causes_of(_facts(spark, sf_dir))


def _fractional(f: DataFrame) -> DataFrame:
    """Delays with fractions of a minute."""
    part = (F.col("op_carrier_fl_num") % 1000) * 0.001 - 0.3
    return f.withColumns({c: F.col(c) + F.coalesce(part, F.lit(0.125)) for c in ("dep_delay", "arr_delay")})


@register("exact_means", W("""
SELECT origin, op_unique_carrier,
       CAST(sign(dep_sum) * ((200 * abs(dep_sum) + dep_n * 1000) // (dep_n * 2000)) AS DOUBLE) / 100 AS dep_mean,
       CAST((200 * late_sum + voli * 1000) // (voli * 2000) AS DOUBLE) / 100 AS late_mean
FROM (SELECT origin, op_unique_carrier, count(*) AS voli, count(d) FILTER (cancelled = 0) AS dep_n,
             CAST(sum(d) FILTER (cancelled = 0) AS HUGEINT) AS dep_sum, CAST(sum(greatest(a, 0)) AS HUGEINT) AS late_sum
      FROM parts GROUP BY ALL)""", """
parts AS (
  SELECT origin, op_unique_carrier, cancelled, CAST(dep_delay AS BIGINT) * 1000 + part AS d,
         coalesce(CAST(arr_delay AS BIGINT) * 1000 + part, 0) AS a
  FROM (SELECT *, coalesce(CAST(op_carrier_fl_num AS BIGINT) % 1000 - 300, 125) AS part FROM flights))"""))
def exact_means(spark, sf_dir):
    """A4, A8, F9 over fractional delays: exact sums, one rounding."""
    return _fractional(flights(spark, sf_dir)).groupBy("origin", "op_unique_carrier").agg(
        exact_mean_where("dep_delay", R.flown()).alias("dep_mean"), exact_clipped_mean("arr_delay").alias("late_mean"))


# ------------------------------------------------------- run-log analytics
_RUNLOG_SQL = """runlog AS (
  SELECT CAST(month AS INTEGER) AS percentuale, op_unique_carrier AS motore, origin AS analisi,
         CAST(greatest(0.0, coalesce(arr_delay, 0.0)) AS INTEGER) AS tempo_secondi,
         CAST(cancelled AS INTEGER) AS status
  FROM flights)"""


def _runlog(spark, sf_dir):
    return RL.runlog_from_flights(flights(spark, sf_dir))


@register("report_by_volume", W("""
SELECT percentuale, motore, analisi, CAST(sum(tempo_secondi) AS BIGINT) AS tempo_secondi,
       count(tempo_secondi) AS misure, min(tempo_secondi) AS minimo, avg(tempo_secondi) AS media
FROM runlog GROUP BY percentuale, motore, analisi""", _RUNLOG_SQL))
def report_by_volume(spark, sf_dir):
    return RL.cell_times(_runlog(spark, sf_dir))


_TOTALS_SQL = ("CAST(sum(tempo_secondi) AS BIGINT) AS tempo_secondi, printf('%02d:%02d:%02d', "
               "(sum(tempo_secondi) % 86400) // 3600, (sum(tempo_secondi) % 3600) // 60, "
               "sum(tempo_secondi) % 60) AS tempo")


@register("report_totals", W(f"SELECT motore, {_TOTALS_SQL} FROM runlog GROUP BY motore",
                             _RUNLOG_SQL))
def report_totals(spark, sf_dir):
    return RL.engine_totals(_runlog(spark, sf_dir))


_COMPARE_SQL = _RUNLOG_SQL + f""",
tot_a AS (SELECT motore, {_TOTALS_SQL} FROM runlog WHERE percentuale <= 6 GROUP BY motore),
tot_b AS (SELECT motore, {_TOTALS_SQL} FROM runlog WHERE percentuale > 6 GROUP BY motore),
cmp AS (
  SELECT a.motore, a.tempo_secondi AS tempo_secondi_locale, a.tempo AS tempo_x,
         b.tempo_secondi AS tempo_secondi_cluster, b.tempo AS tempo_y
  FROM tot_a a JOIN tot_b b ON a.motore = b.motore)"""


def _compare(spark, sf_dir):
    return RL.compare_parts(_runlog(spark, sf_dir), F.col("percentuale") <= 6)


@register("compare_runs", W("SELECT * FROM cmp", _COMPARE_SQL))
def compare_runs(spark, sf_dir):
    """Two 'environments': first and second half of the year."""
    return _compare(spark, sf_dir)


@register("melt_runs", W("""
SELECT motore, 'Cluster' AS ambiente, tempo_secondi_cluster AS tempo_secondi FROM cmp
UNION ALL SELECT motore, 'Locale', tempo_secondi_locale FROM cmp""", _COMPARE_SQL))
def melt_runs(spark, sf_dir):
    return RL.melt_runs(_compare(spark, sf_dir))


@register("map_values", W("SELECT codice, causa, minuti FROM (SELECT op_unique_carrier AS codice, " + ", ".join(
    f'CAST(sum({c}) AS BIGINT) AS "{name}"' for c, name in CAUSES.items()) + " FROM flights GROUP BY ALL) "
    + "UNPIVOT INCLUDE NULLS (minuti FOR causa IN (" + ", ".join(f'"{n}"' for n in CAUSES.values()) + "))"))
def map_values_q(spark, sf_dir):
    """cause columns unpivoted by column name, then renamed by dictionary."""
    sums = (flights(spark, sf_dir).groupBy("op_unique_carrier")
            .agg(*[F.sum(c).alias(c) for c in CAUSES]))
    long = RL.melt(sums, ["op_unique_carrier"], list(CAUSES), "causa", "minuti")
    return long.select(F.col("op_unique_carrier").alias("codice"),
                       map_values("causa", CAUSES).alias("causa"), "minuti")


@register("fmt_duration", W("""
SELECT origin AS aeroporto_partenza, s AS secondi,
       printf('%02d:%02d:%02d', (s % 86400) // 3600, (s % 3600) // 60, s % 60) AS durata
FROM (SELECT origin, CAST(sum(greatest(0.0, coalesce(arr_delay, 0.0))) AS BIGINT) * 60 AS s
      FROM flights GROUP BY origin)"""))
def fmt_duration_q(spark, sf_dir):
    """total clipped arrival delay per airport, as seconds and HH:MM:SS."""
    s = (F.sum(F.greatest(F.lit(0.0), F.coalesce(F.col("arr_delay"), F.lit(0.0))))
         .cast("bigint") * 60)
    return (flights(spark, sf_dir).groupBy(F.col("origin").alias("aeroporto_partenza"))
            .agg(s.alias("secondi"))
            .withColumn("durata", fmt_duration("secondi")))


# ------------------------------------------------- sinks and tables, read back
def _scratch(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/tarmac_{name}_{uuid.uuid4().hex}"


@register("csv_roundtrip", W("SELECT * FROM flights"))
def csv_roundtrip(spark, sf_dir):
    """S9 + S1: the raw table written as CSV with a header, read by name, cleaned."""
    return prep.clean(read_raw(spark, write_report(flights_raw(spark, sf_dir), _scratch(spark, "raw_csv"))))


@register("csv_report", W(O.Q2, O.CAUSE_UNION))
def csv_report(spark, sf_dir):
    """Q2 as one CSV file, its cause lists quoted by the writer."""
    report = q2_report(spark, sf_dir)
    path = write_report(report, _scratch(spark, "report"), single_file=True)
    return spark.read.schema(report.schema).option("header", True).option("mode", "FAILFAST").csv(path)


@register("tab_report", W("SELECT * FROM q3", O.Q3_CTES))
def tab_report(spark, sf_dir):
    """Q3 as tab-separated text."""
    report = q3_anomaly_rank(spark, sf_dir)
    path = write_report(report, _scratch(spark, "tab"), sep="\t")
    return spark.read.schema(report.schema).option("header", True).option("sep", "\t").csv(path)


@register("volume_sink", W("SELECT * FROM flights"))
def volume_sink(spark, sf_dir):
    """A volume in folders by month, read back with schema merging."""
    path = write_volume(flights(spark, sf_dir), _scratch(spark, "volume"), 100, partition_by=["month"])
    return prep.conform(read_clean(spark, path, merge_schema=True)).select(*TARGET_COLUMNS)


@register("split_sink", W(O.Q1))
def split_sink(spark, sf_dir):
    """U4: Q1 split into one folder per month, read back whole."""
    report = q1_carrier_stats(spark, sf_dir)
    path = write_split(report, _scratch(spark, "split"), ["mese"])
    back = spark.read.schema(report.schema).option("header", True).csv(path)
    return back.select(*[F.col(f.name).cast(f.dataType) for f in report.schema])


@register("external_table", W("SELECT * FROM q3", O.Q3_CTES))
def external_table(spark, sf_dir):
    """Database, external table by DDL with variables, a SQL file against the current database."""
    db, path = f"tarmac_{uuid.uuid4().hex}", _written_path(spark, flights(spark, sf_dir), "clean")
    spark.sql("CREATE DATABASE IDENTIFIER(:db)", args={"db": db})
    run_sql_file(spark, "setup_table", {"table": f"{db}.voli"}, {"columns": CLEAN_DDL, "path": path})
    before = spark.catalog.currentDatabase()
    use_db(spark, db)
    try:
        return run_sql_file(spark, "q3", {"flights": "voli", "rate_scale": 2})
    finally:
        use_db(spark, before)


@register("partitioned_table", W("SELECT origin, month, count(*) AS rows, count_if(cancelled = 1) AS gone "
                                 "FROM flights WHERE month IN (3, 4) GROUP BY ALL"))
def partitioned_table(spark, sf_dir):
    """S4 over folders by month: DDL with partition recovery, a filter that prunes folders."""
    db = f"tarmac_{uuid.uuid4().hex}"
    path = write_volume(flights(spark, sf_dir), _scratch(spark, "volume"), 100, partition_by=["month"])
    name = register_table(spark, "voli", path=current_run(spark, path), db=db, schema=CLEAN_SCHEMA, partitioned_by=["month"])
    return spark.table(name).filter("month IN (3, 4)").groupBy("origin", "month").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("cancelled") == 1).alias("gone"))


@register("observed_profile", W(f"""
SELECT 'step_counts' AS profile, 'input' AS name, CAST(count(*) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS type FROM flights_raw
UNION ALL SELECT 'step_counts', 'drop_corrupt', count(*), NULL FROM raw_ok
UNION ALL SELECT 'step_counts', 'drop_outliers', count(*), NULL FROM flights
UNION ALL SELECT 'bounds', 'dep_delay_min', min(dep_delay), NULL FROM raw_ok
UNION ALL SELECT 'bounds', 'dep_delay_max', max(dep_delay), NULL FROM raw_ok
UNION ALL SELECT 'bounds', 'arr_delay_min', min(arr_delay), NULL FROM raw_ok
UNION ALL SELECT 'bounds', 'arr_delay_max', max(arr_delay), NULL FROM raw_ok
UNION ALL SELECT 'outliers', 'outliers', count_if(NOT ({_DUCK_NOT_OUTLIER})), NULL FROM raw_ok
UNION ALL SELECT 'outliers', 'rows', count(*), NULL FROM raw_ok
UNION ALL SELECT 'outliers', 'percent', CAST(count_if(NOT ({_DUCK_NOT_OUTLIER})) AS DOUBLE) / count(*) * 100.0, NULL FROM raw_ok
UNION ALL SELECT 'distinct', cancellation_code, count(*), NULL FROM flights_raw GROUP BY cancellation_code
UNION ALL SELECT 'nulls', column_name, null_count, NULL FROM ({_null_sql("flights", TARGET_COLUMNS)})
UNION ALL SELECT 'missing_code', column_name, null_count, NULL FROM ({_null_sql(
    "(SELECT * FROM flights WHERE cancelled = 1 AND cancellation_code IS NULL)", TARGET_COLUMNS)})
UNION ALL SELECT 'schema', column_name, non_null, data_type FROM ({_SCHEMA_SQL})"""))
def observed_profile(spark, sf_dir):
    """D1 to D8 gathered by the write of the cleaned table."""
    found = jobs.flight_profile()
    _written_path(spark, found.clean(prep.clean(found.raw(flights_raw(spark, sf_dir)))), "clean")
    return found.table(spark)


@register("runlog_csv", W("""
SELECT motore, 'Cluster' AS ambiente, tempo_secondi_cluster AS tempo_secondi FROM cmp
UNION ALL SELECT motore, 'Locale', tempo_secondi_locale FROM cmp""", _COMPARE_SQL))
def runlog_csv(spark, sf_dir):
    """Two run logs written as CSV, read back, joined and made long."""
    log = _written(spark, _runlog(spark, sf_dir), "log")
    first = F.col("percentuale") <= 6
    a, b = (read_runlog(spark, write_report(log.filter(c), _scratch(spark, "log_csv"))) for c in (first, ~first))
    return RL.melt_runs(RL.compare_runs(a, b))


# --------------------------------------------------------------- streaming
def _stream(spark, sf_dir, report):
    src = _written_path(spark, flights(spark, sf_dir), "clean")
    run = f"{checkpoint_dir(spark).rstrip('/')}/tarmac_stream_{uuid.uuid4().hex}"
    run_incremental_report(spark, src, f"{run}/out", report, f"{run}/ckpt")
    return read_published(spark, f"{run}/out")


@register("stream_q1_carrier_stats", W(O.Q1))
def stream_q1_carrier_stats(spark, sf_dir):
    """Q1 maintained by Structured Streaming over the clean Parquet folder
    (``availableNow`` trigger), published by ``foreachBatch``."""
    return _stream(spark, sf_dir, "q1")


@register("stream_q2_report", W(O.Q2, O.CAUSE_UNION))
def stream_q2_report(spark, sf_dir):
    """Q2: streaming (origin, month) aggregate, top-3 causes per trigger."""
    return _stream(spark, sf_dir, "q2")


@register("stream_q3_anomaly_rank", W("SELECT * FROM q3", O.Q3_CTES))
def stream_q3_anomaly_rank(spark, sf_dir):
    """Q3: streaming (origin, carrier) aggregate, baseline and rank per trigger."""
    return _stream(spark, sf_dir, "q3")
