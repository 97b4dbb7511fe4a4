"""Batch jobs: the unit a scheduler submits (one report, one SQL file,
the preparation of all volumes).  Each reads its input, checks it is not
empty, runs one plan and writes one output; nothing passes the driver."""

from __future__ import annotations

import contextlib
import re
import time
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import prep, volumes
from tarmac.operators.profile import ObservedProfile
from tarmac.plans import reports as R
from tarmac.plans import runlog as RL
from tarmac.schema import CLEAN_SCHEMA, VOLUME_PERCENTS
from tarmac.sources.catalog import register_table, run_sql_file, use_db
from tarmac.sources.io import (
    current_run, read_clean, read_raw, require_non_empty, scratch_table, volume_label, write_report,
)

REPORTS = {
    "q1": lambda df, rate_scale: R.carrier_stats(df, rate_scale),
    "q2": lambda df, rate_scale: R.airport_month_report(df),
    "q3": lambda df, rate_scale: R.carrier_vs_airport(df, rate_scale),
    "routes": lambda df, rate_scale: R.carrier_routes(df),
    "months": lambda df, rate_scale: R.operating_months(df),
    "airport_month_means": lambda df, rate_scale: R.airport_month_means(df),
    "cancel_causes": lambda df, rate_scale: R.cancel_causes(df),
}


SQL_DEFAULTS = {"q1": {"rate_scale": 2}, "q2": {"k": 3}, "q3": {"rate_scale": 2}}


def _flatten_arrays(df: DataFrame) -> DataFrame:
    return df.select(*[F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
                       if t.startswith("array") else F.col(c) for c, t in df.dtypes])


def _volume(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """A clean volume with the declared schema, or with that of all its files; not empty."""
    df = read_clean(spark, path, True) if merge_schema else read_clean(spark, path, schema=CLEAN_SCHEMA)
    return require_non_empty(df, path)


@contextlib.contextmanager
def _logged(spark: SparkSession, log: str | None, engine: str, input_path: str, analysis: str) -> Iterator[None]:
    """Log the run, failed ones with status 1, if there is a log."""
    started, status = time.perf_counter(), 1
    try:
        yield
        status = 0
    finally:
        if log:
            label = re.search(r"\d+", volume_label(input_path))
            RL.log_run(spark, log, int(label[0]) if label else 0, engine, analysis, time.perf_counter() - started, status)


def report_job(spark: SparkSession, input_path: str, report: str, output: str,
               rate_scale: int = 2, single_file: bool = False,
               merge_schema: bool = False, log: str | None = None) -> str:
    """Clean Parquet volume -> one report as CSV with a header.

    The volume is read with the declared schema, so no footer is read to
    plan the scan; ``merge_schema`` reads all of them.  ``log``: folder of a
    run log that gets volume, engine, analysis, seconds and status.
    """
    with _logged(spark, log, "Spark_Core", input_path, report):
        out = REPORTS[report](_volume(spark, input_path, merge_schema), rate_scale)
        return write_report(_flatten_arrays(out), output, single_file=single_file)


#: Reports that roll one table of flight facts up.
FACT_REPORTS = {
    "q1": lambda facts, rate_scale: R.carrier_stats_of(facts, rate_scale),
    "q2": lambda facts, rate_scale: R.airport_month_report_of(facts),
    "q3": lambda facts, rate_scale: R.carrier_vs_airport_of(facts, rate_scale),
    "airport_month_means": lambda facts, rate_scale: R.airport_month_means_of(facts),
    "cancel_causes": lambda facts, rate_scale: R.cancel_causes_of(facts),
}


def report_all_job(spark: SparkSession, input_path: str, output: str, rate_scale: int = 2,
                   single_file: bool = False, log: str | None = None) -> dict[str, str]:
    """All ``FACT_REPORTS`` of a volume from one scan of it, as CSV under ``<output>/<report>``."""
    with _logged(spark, log, "Spark_Core", input_path, "all"):
        facts = R.flight_facts(read_clean(spark, input_path, schema=CLEAN_SCHEMA))
        facts = require_non_empty(scratch_table(facts, "facts"), input_path)
        return {name: write_report(make(facts, rate_scale), f"{output.rstrip('/')}/{name}", single_file=single_file)
                for name, make in FACT_REPORTS.items()}


def sql_job(spark: SparkSession, input_path: str, sql: str, output: str,
            args: dict | None = None, table: str = "flights", sep: str = ",",
            db: str | None = None, log: str | None = None) -> str:
    """Clean Parquet volume registered as ``table`` -> SQL file -> CSV.

    With ``db`` the volume is an external table of that database, which is
    made current before the file runs; else a temporary view.  The result of
    the file's last statement is written by all tasks, since a file may hold
    any query.
    """
    with _logged(spark, log, "Spark_SQL", input_path, Path(sql).stem):
        df = _volume(spark, input_path)
        if db:
            folder = current_run(spark, input_path) or input_path
            register_table(spark, table, path=folder, db=db, schema=df.schema)
            use_db(spark, db)
        else:
            register_table(spark, table, df=df)
        params = {"flights": table, **SQL_DEFAULTS.get(sql, {}), **(args or {})}
        return write_report(run_sql_file(spark, sql, params), output, sep=sep)


def runlog_job(spark: SparkSession, local_csv: str, cluster_csv: str, output: str) -> dict[str, str]:
    """Two run logs (CSV files, or folders that jobs logged to) -> cells of both, totals side by side, and their long form, as CSV."""
    logs = {"locale": RL.read_log(spark, local_csv), "cluster": RL.read_log(spark, cluster_csv)}
    wide = RL.compare_runs(logs["locale"], logs["cluster"])
    tables = {f"cells_{k}": RL.cell_times(log) for k, log in logs.items()}
    tables |= {"compare": wide, "long": RL.melt_runs(wide)}
    return {name: write_report(t, f"{output.rstrip('/')}/{name}") for name, t in tables.items()}


def prepare_job(spark: SparkSession, raw_path: str, base: str,
                percents=VOLUME_PERCENTS, raw_format: str = "csv",
                files: int | None = None) -> dict[int, str]:
    """Raw extract -> clean table (written once) -> every volume.

    The same write gathers the profile of the raw and the cleaned rows
    (``<base>/profile``); no other scan of the extract is made for it.

    ``files`` spreads the clean table over that many files; only useful
    when the raw input arrives in fewer pieces than there are cores (a
    large extract is read and written by many tasks anyway).
    """
    raw = read_raw(spark, raw_path) if raw_format == "csv" else read_clean(spark, raw_path)
    clean_path = f"{base.rstrip('/')}/clean"
    found = flight_profile()
    clean_df = found.clean(prep.clean(found.raw(require_non_empty(raw, raw_path))))
    if files:
        clean_df = clean_df.repartition(files)
    clean_df.write.mode("overwrite").parquet(clean_path)
    found.table(spark).write.mode("overwrite").parquet(f"{base.rstrip('/')}/profile")
    clean = read_clean(spark, clean_path, schema=clean_df.schema)
    return volumes.build_volumes(clean, base, percents)


def flight_profile() -> ObservedProfile:
    """The profile of the raw and the cleaned flights."""
    corrupt = F.coalesce(prep.corrupt_condition(), F.lit(False))
    return ObservedProfile(
        {"drop_corrupt": ~corrupt, "drop_outliers": ~prep.outlier_condition()}, outlier=prep.outlier_condition(),
        valid=~corrupt, bounded=["dep_delay", "arr_delay"], distinct="cancellation_code",
        missing=F.col("cancellation_code").isNull() & (F.col("cancelled") == 1))
