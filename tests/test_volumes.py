"""Volumes: rows decided where they stand, published whole."""

import io
import os
import re
from collections import Counter
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from tarmac.operators import volumes
from tarmac.plans import catalog as C
from tarmac.sources import io as IO
from tests.conftest import SF_SMALL, flight_rows


@pytest.fixture(scope="module")
def clean(spark):
    return IO.scratch_table(C.flights(spark, SF_SMALL).repartition(5), "test_clean")


def _exchanged(df):
    """Columns that enter each exchange of the plan."""
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return re.findall(r"\(\d+\) (?:Broadcast|Shuffle)?Exchange[^\n]*\nInput \[\d+\]: \[([^\]]*)\]", text.getvalue())


@pytest.mark.parametrize("percent", [10, 75, 150])
def test_no_plan_exchanges_whole_rows(spark, clean, percent, monkeypatch):
    double = IO.scratch_table(clean.unionByName(clean.limit(300)), "test_double")
    counted = _exchanged(volumes.digests(double))
    assert counted and not any("origin" in cols or "fl_date" in cols for cols in counted)
    for chunk in (1 << 16, 0):  # 0: every repeated row is shared out by file
        monkeypatch.setattr(volumes, "CHUNK", chunk)
        for exact in (True, False):
            taken = _exchanged(volumes.scale_up(double, percent, exact=exact))
            assert taken and not any("origin" in cols or "fl_date" in cols for cols in taken)


def test_hot_rows_are_shared_out_by_file(spark, monkeypatch):
    hot = spark.range(900).select(F.lit("hot").alias("k"), F.lit(None).cast("double").alias("v"))
    rows = spark.range(600).select(F.concat(F.lit("r"), F.col("id") % 400).alias("k"), F.lit(1.5).alias("v"))
    df = IO.scratch_table(hot.unionByName(rows).repartition(7), "test_hot")
    want = Counter(map(tuple, volumes.sample_volume(df, 30).collect()))
    assert sum(want.values()) == 450 and want["hot", None] in (270, 271)
    for chunk, layout in ((0, 7), (100, 3), (10, 1)):
        monkeypatch.setattr(volumes, "CHUNK", chunk)
        again = IO.scratch_table(df.repartition(layout), "test_hot")
        taken = volumes.sample_volume(again, 30)
        assert Counter(map(tuple, taken.collect())) == want
        by_task = [r["count"] for r in taken.filter("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()]
        if chunk == 0 and layout == 7:
            assert max(by_task) < 200
    # a table of repeated rows over the bound is joined without a broadcast hint
    monkeypatch.setattr(volumes, "BROADCAST_ROWS", 1)
    assert Counter(map(tuple, volumes.sample_volume(df, 30).collect())) == want


def test_any_frame_can_be_sampled(spark):
    df = spark.createDataFrame([(i % 5, None) for i in range(40)], "a int, b string").groupBy("a", "b").count()
    assert volumes.sample_volume(df, 40).count() == 2
    assert volumes.sample_volume(df.limit(0), 40).count() == 0
    assert volumes.scale_up(df, 250).count() == 13


def test_a_failed_write_leaves_the_old_volume(spark, clean, tmp_dir):
    paths = volumes.build_volumes(clean, tmp_dir, [10, 150])
    before = Counter(map(tuple, IO.read_clean(spark, paths[10]).collect()))
    reader = IO.read_clean(spark, paths[10])
    broken = clean.withColumn("month", F.when(F.col("month") == 7, F.raise_error(F.lit("lost disk")).cast("bigint"))
                              .otherwise(F.col("month")))
    with pytest.raises(Exception, match="lost disk"):
        IO.write_volume(broken, tmp_dir, 10)
    assert len([d for d in os.listdir(paths[10]) if d.startswith("run-")]) == 2  # the broken run lies there unnamed
    assert Counter(map(tuple, IO.read_clean(spark, paths[10]).collect())) == before
    IO.write_volume(clean.limit(5), tmp_dir, 10)
    assert IO.read_clean(spark, paths[10]).count() == 5
    assert Counter(map(tuple, reader.collect())) == before  # its run is still there
    IO.write_volume(clean.limit(6), tmp_dir, 10)
    IO.write_volume(clean.limit(3), tmp_dir, 10, mode="append")
    assert IO.read_clean(spark, paths[10]).count() == 9
    held = [d for d in os.listdir(paths[10]) if d.startswith("run-") and any(
        f.endswith(".parquet") and os.path.getsize(os.path.join(paths[10], d, f)) > 2000
        for f in os.listdir(os.path.join(paths[10], d)))]
    assert len(held) <= 4  # the broken one, and of the others the last ones


def test_declared_schema_fills_columns_and_names_files_of_other_types(spark, clean, tmp_dir):
    path = os.path.join(tmp_dir, "parts")
    clean.write.parquet(path)
    clean.limit(40).drop("weather_delay", "dest").write.mode("append").parquet(path)
    from tarmac.schema import CLEAN_SCHEMA
    got = IO.read_clean(spark, path, schema=CLEAN_SCHEMA)
    assert got.columns == clean.columns and got.filter("dest is null").count() == 40
    clean.limit(3).withColumn("dep_delay", F.lit("late")).coalesce(1).write.mode("append").parquet(path)
    with pytest.raises(Exception) as error:
        IO.read_clean(spark, path, schema=CLEAN_SCHEMA).agg(F.sum("dep_delay")).collect()
    assert "dep_delay" in str(error.value) and ".parquet" in str(error.value)
    assert IO.read_clean(spark, path, schema=CLEAN_SCHEMA).agg(F.sum("arr_delay")).first()[0] is not None


def test_two_thousand_parts_are_merged_without_a_plan_of_them(spark, tmp_dir):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(0, 8000, 1, 2000).select("id", F.when(F.col("id") % 7 > 0, F.lit("a,b")).alias("x,y"))
        path = IO.write_report(df, os.path.join(tmp_dir, "one"), single_file=True)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    files = [f for f in os.listdir(path) if not f.startswith((".", "_"))]
    assert len(files) == 1 and os.path.exists(os.path.join(path, "_SUCCESS"))
    lines = open(os.path.join(path, files[0])).read().splitlines()
    assert lines[0] == 'id,"x,y"' and lines[1:] == [f'{i},"a,b"' if i % 7 else f"{i}," for i in range(8000)]
    IO.write_report(df.limit(0), path, single_file=True)
    files = [f for f in os.listdir(path) if not f.startswith((".", "_"))]
    assert [open(os.path.join(path, f)).read() for f in files] == ['id,"x,y"\n']
    with pytest.raises(FileExistsError):
        IO.write_report(df, path, single_file=True, mode="error")


def test_split_makes_one_file_of_small_values_and_several_of_a_hot_one(spark, tmp_dir):
    rows = spark.range(0, 90_000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40 + 2).alias("month"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "300k")
    try:
        path = IO.write_split(rows, os.path.join(tmp_dir, "split"), ["month"], fmt="parquet")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = {d: len([f for f in os.listdir(os.path.join(path, d)) if f.endswith(".parquet")])
             for d in os.listdir(path) if d.startswith("month=")}
    assert files.pop("month=1") >= 4 and len(files) == 40
    assert sum(files.values()) <= 60 and min(files.values()) == 1  # 480 without the exchange
    assert spark.read.parquet(path).count() == 90_000


def test_digests_are_added_up_by_hash_and_cuts_need_few_passes(spark, monkeypatch):
    rows = spark.range(3000).select((F.col("id") % 2500).alias("a"), F.lit(None).cast("string").alias("b"))
    df = IO.scratch_table(rows.repartition(4), "test_digests")
    plan = volumes.digests(df)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    same = IO.scratch_table(volumes.digests(df), "test_digests")
    assert same.filter("_m > 1 AND _place IS NULL OR _m = 1 AND _place IS NOT NULL").count() == 0
    want = {}
    for limit in (100_000, 0):  # 0: every class is divided down to one score
        monkeypatch.setattr(volumes, "CLASS_ROWS", limit, raising=False)
        passes = []
        monkeypatch.setattr(volumes, "_histogram", lambda r, v, f=volumes._histogram: passes.append(1) or f(r, v))
        want[limit] = volumes._last_taken(same, 3000)
        assert bool(passes) == (limit == 0)
        monkeypatch.undo()
    assert want[0] == want[100_000] and volumes.sample_volume(df, 30, same=same).count() == 900


def test_the_query_builds_every_volume(spark, monkeypatch):
    # 40 copies each of three rows, one without a delay, and ten rows that occur once
    rows = [{"origin": "ABE", "arr_delay": 3.0}, {"origin": "ATL", "arr_delay": 5.0}, {"origin": "BWI", "arr_delay": None}] * 40
    rows += [{"origin": "CLT", "arr_delay": 1.0, "op_carrier_fl_num": float(i)} for i in range(10)]
    monkeypatch.setattr(C, "flights", lambda spark, sf_dir: flight_rows(spark, rows).repartition(3))
    got = {r["volume"]: (r["rows"], r["minutes"]) for r in C.build_volumes_q(spark, SF_SMALL).collect()}
    assert got == {10: (13, 33), 25: (33, 83), 50: (65, 165), 75: (98, 248), 100: (130, 330), 150: (195, 495)}
