"""One scan for all reports, exact means, the profile and the log that jobs write."""

import glob
import os
import threading
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tarmac.functions.metrics import exact_clipped_mean, exact_mean_where, exact_sum
from tarmac.plans import catalog as C
from tarmac.plans import jobs
from tarmac.plans import reports as R
from tarmac.plans import runlog as RL
from tarmac.sources import io as IO
from tarmac.sources.catalog import register_table, run_sql_file
from tarmac.schema import CLEAN_SCHEMA
from tests.conftest import SF_SMALL, flight_rows


def _lines(path):
    files = [open(f).read().splitlines() for f in sorted(glob.glob(os.path.join(path, "part-*.csv")))]
    return files[0][:1] + [line for f in files for line in f[1:]]


@pytest.fixture(scope="module")
def volume(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("volume"))
    return IO.write_volume(C.flights(spark, SF_SMALL).repartition(6), base, 100)


def test_report_all_equals_the_single_reports(spark, volume, tmp_dir):
    paths = jobs.report_all_job(spark, volume, os.path.join(tmp_dir, "all"), single_file=True)
    assert set(paths) == set(jobs.FACT_REPORTS)
    for name, path in paths.items():
        alone = jobs.report_job(spark, volume, name, os.path.join(tmp_dir, name), single_file=True)
        assert sorted(_lines(path)) == sorted(_lines(alone)), name
        if name in ("q1", "q2", "q3"):
            assert _lines(path) == _lines(alone)


def test_facts_scan_the_flights_once_and_reports_only_the_facts(spark, volume):
    flights = IO.read_clean(spark, volume, schema=CLEAN_SCHEMA)
    plan = R.flight_facts(flights)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "fl_date" not in plan.split("ReadSchema")[1]
    facts = IO.scratch_table(R.flight_facts(flights), "facts")
    folder = {os.path.dirname(f) for f in facts.inputFiles()}
    for make in (R.carrier_stats_of, R.airport_month_report_of, R.carrier_vs_airport_of, R.airport_month_means_of,
                 R.cancel_causes_of):
        assert {os.path.dirname(f) for f in make(facts).inputFiles()} == folder


def test_facts_of_edge_rows(spark):
    frame = flight_rows(spark, [
        {"origin": None, "arr_delay": None, "dep_delay": None, "cancelled": 1, "cancellation_code": "A"},
        {"origin": "ABE", "arr_delay": -5.0}, {"origin": "ABE", "arr_delay": 0.5, "dep_delay": 15.0},
        {"origin": "ABE", "cancelled": 1, "cancellation_code": None, "arr_delay": None, "dep_delay": None},
        {"origin": "ABE", "cancelled": 0, "cancellation_code": "B", "nas_delay": 4}])
    facts = R.flight_facts(frame)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(R.carrier_stats_of(facts)) == rows(R.carrier_stats(frame))
    assert rows(R.airport_month_report_of(facts, with_means=True)) == rows(R.airport_month_report(frame, with_means=True))
    assert rows(R.carrier_vs_airport_of(facts)) == rows(R.carrier_vs_airport(frame))
    assert rows(R.cancel_causes_of(facts)) == rows(R.cancel_causes(frame))
    assert R.carrier_stats_of(R.flight_facts(frame.limit(0))).count() == 0


def _half_up(values, scale=2):
    mean = sum(Decimal(str(v)) for v in values) / len(values)
    return float(mean.quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP))


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_fractional_means_have_the_same_bits_in_any_layout(spark, parts):
    values = [round(((i * 7919) % 100_003) * 0.001 - 20.0, 6) for i in range(5000)] + [1e9 + 0.1, -1e9, 0.005, None]
    rows = [{"origin": "ABE" if i % 3 else "AUS", "dep_delay": v, "arr_delay": v} for i, v in enumerate(values)]
    frame = flight_rows(spark, rows).repartition(parts, F.col("arr_delay"))
    got = {r[0]: r[1:] for r in frame.groupBy("origin").agg(
        exact_mean_where("dep_delay", R.flown()), exact_clipped_mean("arr_delay"), exact_sum("dep_delay")).collect()}
    for origin in ("ABE", "AUS"):
        own = [r["dep_delay"] for r in rows if r["origin"] == origin]
        known = [v for v in own if v is not None]
        assert got[origin][0] == _half_up(known)
        assert got[origin][1] == _half_up([max(0.0, v or 0.0) for v in own])
        assert got[origin][2] == sum(int(Decimal(str(v)) * 1_000_000) for v in known)
    view = register_table(spark, "fractional_flights", df=frame)
    plain = sorted(map(tuple, R.carrier_vs_airport(frame).collect()))
    assert sorted(map(tuple, run_sql_file(spark, "q3", {"flights": view, "rate_scale": 2}).collect())) == plain
    assert sorted(map(tuple, run_sql_file(spark, "q1", {"flights": view, "rate_scale": 2}).collect())) == \
        sorted(map(tuple, R.carrier_stats(frame).collect()))


def test_ties_and_signs_of_exact_means(spark):
    df = spark.createDataFrame([("a", 0.01), ("a", 0.0), ("b", -0.01), ("b", 0.0), ("c", None), ("d", float("nan")),
                                ("d", 2.0), ("e", -1.23456), ("e", 1.0)], "k string, v double")
    got = {r[0]: r[1] for r in df.groupBy("k").agg(exact_mean_where("v", F.lit(True))).collect()}
    assert got == {"a": 0.01, "b": -0.01, "c": None, "d": 2.0, "e": -0.12}


def test_prepare_writes_the_profile_with_the_cleaning(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    IO.write_report(C.flights_raw(spark, SF_SMALL), raw)
    jobs.prepare_job(spark, raw, tmp_dir, percents=[100])
    got = {}
    for r in spark.read.parquet(os.path.join(tmp_dir, "profile")).collect():
        got.setdefault(r["profile"], {})[r["name"]] = r["value"]
    assert got["step_counts"] == {r["step"]: r["rows"] for r in C.profile_step_counts(spark, SF_SMALL).collect()}
    assert got["nulls"] == {r["column_name"]: r["null_count"] for r in C.profile_nulls(spark, SF_SMALL).collect()}
    assert got["distinct"] == {r[0]: r[1] for r in C.profile_distinct(spark, SF_SMALL).collect()}
    assert got["bounds"] == C.profile_bounds(spark, SF_SMALL).first().asDict()
    assert got["outliers"] == C.profile_outliers(spark, SF_SMALL).first().asDict()
    assert got["schema"] == {r["column_name"]: r["non_null"] for r in C.profile_schema(spark, SF_SMALL).collect()}


def test_jobs_log_their_runs(spark, volume, tmp_dir):
    log = os.path.join(tmp_dir, "log")
    jobs.report_job(spark, volume, "q2", os.path.join(tmp_dir, "q2"), log=log)
    jobs.sql_job(spark, volume, "q3", os.path.join(tmp_dir, "q3"), log=log)
    with pytest.raises(Exception):
        jobs.report_job(spark, os.path.join(tmp_dir, "nothing_50"), "q1", os.path.join(tmp_dir, "q1"), log=log)
    rows = {(r["percentuale"], r["motore"], r["analisi"]): r["status"] for r in RL.read_log(spark, log).collect()}
    assert rows == {(100, "Spark_Core", "q2"): 0, (100, "Spark_SQL", "q3"): 0, (50, "Spark_Core", "q1"): 1}
    writers = [threading.Thread(target=RL.log_run, args=(spark, log, 10, f"E{i}", "q1", i, 0)) for i in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert RL.read_log(spark, log).count() == 7
    got = jobs.runlog_job(spark, log, log, os.path.join(tmp_dir, "out"))
    assert len(_lines(got["compare"])) == 1 + 6


def test_partitioned_table_prunes_folders(spark, tmp_dir):
    path = IO.write_volume(C.flights(spark, SF_SMALL), tmp_dir, 100, partition_by=["month"])
    name = register_table(spark, "by_month", path=IO.current_run(spark, path), db="tarmac_folders_db",
                          schema=CLEAN_SCHEMA, partitioned_by=["month"])
    try:
        some = spark.table(name).filter("month = 5 and cancelled = 0")
        plan = some._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(month" in plan and "(month" in plan.split("PartitionFilters")[1].split("]")[0]
        assert some.count() == C.flights(spark, SF_SMALL).filter("month = 5 and cancelled = 0").count()
        assert len({r[0] for r in some.select("_metadata.file_path").distinct().collect()}) >= 1
        assert spark.sql(f"SHOW PARTITIONS {name}").count() == 12
    finally:
        spark.sql(f"DROP TABLE {name}")
