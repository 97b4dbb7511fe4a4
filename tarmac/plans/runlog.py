"""Analytics over a benchmark run log (volume, engine, analysis, seconds).

Column names are parameters; defaults follow the run-log CSV header.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.text import fmt_duration, map_values
from tarmac.schema import RUNLOG_SCHEMA
from tarmac.sources.io import read_runlog

# Environment labels of the two-run comparison.
ENVIRONMENT_NAMES = {"tempo_secondi_cluster": "Cluster", "tempo_secondi_locale": "Locale"}


def log_run(spark: SparkSession, log: str, volume: int, engine: str, analysis: str, seconds: float,
            status: int) -> str:
    """Append one run to the log folder.

    Every run is a folder of its own with one CSV file, written under a new
    name and complete or absent, so any number of writers can log at once.
    """
    row = spark.createDataFrame([(volume, engine, analysis, round(seconds), status)], RUNLOG_SCHEMA)
    path = f"{log.rstrip('/')}/run-{uuid.uuid4().hex}"
    row.coalesce(1).write.option("header", True).csv(path)
    return path


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """All runs of a log folder, or of a single CSV file."""
    try:
        return read_runlog(spark, f"{log.rstrip('/')}/run-*")
    except AnalysisException:  # no run folders
        return read_runlog(spark, log)


def cell_times(log: DataFrame, keys: Sequence[str] = ("percentuale", "motore", "analisi"),
               value: str = "tempo_secondi") -> DataFrame:
    """One row per cell.  ``value`` is the SUM of repeated measurements
    (what the original report plotted); ``misure``, ``minimo`` and ``media``
    show whether a cell holds more than one run."""
    v = F.col(value)
    return log.groupBy(*keys).agg(F.sum(v).alias(value), F.count(v).alias("misure"),
                                  F.min(v).alias("minimo"), F.avg(v).alias("media"))


def engine_totals(log: DataFrame, key: str = "motore", value: str = "tempo_secondi",
                  duration_col: str = "tempo") -> DataFrame:
    """R2: total per engine, ascending, with the total as ``HH:MM:SS``."""
    return (log.groupBy(key).agg(F.sum(value).alias(value))
               .withColumn(duration_col, fmt_duration(value))
               .orderBy(value, key))


def compare(a: DataFrame, b: DataFrame, on: Sequence[str] | str,
            suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Inner join of two summaries; non-key columns present in both get
    the suffixes, all other columns keep their names."""
    on = [on] if isinstance(on, str) else list(on)
    clash = (set(a.columns) & set(b.columns)) - set(on)
    ra = a.select(*[F.col(c).alias(c + suffixes[0]) if c in clash else F.col(c)
                    for c in a.columns])
    rb = b.select(*[F.col(c).alias(c + suffixes[1]) if c in clash else F.col(c)
                    for c in b.columns])
    return ra.join(rb, on, "inner")


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], var_name: str,
         value_name: str) -> DataFrame:
    """Wide to long."""
    return df.unpivot(list(ids), list(values), var_name, value_name)


def compare_runs(log_a: DataFrame, log_b: DataFrame, key: str = "motore",
                 value: str = "tempo_secondi",
                 names: tuple[str, str] = ("locale", "cluster")) -> DataFrame:
    """Per-engine totals of two environments side by side."""
    ta = engine_totals(log_a, key, value).withColumnRenamed(value, f"{value}_{names[0]}")
    tb = engine_totals(log_b, key, value).withColumnRenamed(value, f"{value}_{names[1]}")
    return compare(ta, tb, key)


def compare_parts(log: DataFrame, first: Column, key: str = "motore", value: str = "tempo_secondi",
                  names: tuple[str, str] = ("locale", "cluster")) -> DataFrame:
    """R3 for two environments kept in one log: ``first`` says which rows
    belong to the first one.  One scan and one aggregate; engines that lack
    rows of either environment are left out, as by the join."""
    a, b = (f"{value}_{n}" for n in names)
    first = F.coalesce(first, F.lit(False))
    sums = log.groupBy(key).agg(
        F.sum(F.when(first, F.col(value))).alias(a), F.sum(F.when(~first, F.col(value))).alias(b),
        F.count_if(first).alias("_n_a"), F.count_if(~first).alias("_n_b"))
    return sums.filter("_n_a > 0 and _n_b > 0").select(
        key, a, fmt_duration(a).alias("tempo_x"), b, fmt_duration(b).alias("tempo_y"))


def melt_runs(wide: DataFrame, key: str = "motore", value: str = "tempo_secondi",
              names: tuple[str, str] = ("locale", "cluster"),
              labels: Mapping[str, str] = ENVIRONMENT_NAMES) -> DataFrame:
    """R3 long form: one row per (engine, environment) with display names."""
    cols = [f"{value}_{names[1]}", f"{value}_{names[0]}"]
    long = melt(wide.select(key, *cols), [key], cols, "ambiente", value)
    return long.withColumn("ambiente", map_values("ambiente", labels))


def runlog_from_flights(flights: DataFrame) -> DataFrame:
    """A run-log-shaped frame derived from flights, for tests on supplied
    data: volume <- month, engine <- carrier, analysis <- origin airport,
    seconds <- arrival delay clipped at 0, status <- cancelled."""
    return flights.select(
        F.col("month").cast("int").alias("percentuale"),
        F.col("op_unique_carrier").alias("motore"),
        F.col("origin").alias("analisi"),
        F.greatest(F.lit(0), F.coalesce(F.col("arr_delay"), F.lit(0.0))).cast("int")
         .alias("tempo_secondi"),
        F.col("cancelled").cast("int").alias("status"))
