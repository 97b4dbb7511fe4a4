"""The left join of two aggregates."""

import re

import pytest

from tarmac.operators.joins import left_join
from tarmac.plans import reports as R
from tests.conftest import flight_rows


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_unmatched_rows_and_null_keys_stay(spark):
    left = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), (None, 1, 30), ("b", None, 40), ("b", 1, 50)],
                                 "origin string, month int, n int")
    right = spark.createDataFrame([("a", 1, "x", 7), (None, 1, "y", 8), ("b", None, "z", 9), ("c", 1, "w", 1)],
                                  "origin string, month int, causes string, k int")
    assert _rows(left_join(left, right, ["origin", "month"])) == sorted(
        [("a", 1, 10, "x", 7), ("a", 2, 20, None, None), (None, 1, 30, None, None), ("b", None, 40, None, None),
         ("b", 1, 50, None, None)], key=str)
    assert _rows(left_join(left, right, ["origin", "month"], null_safe=True)) == sorted(
        [("a", 1, 10, "x", 7), ("a", 2, 20, None, None), (None, 1, 30, "y", 8), ("b", None, 40, "z", 9),
         ("b", 1, 50, None, None)], key=str)
    # rows of the left side may repeat, and a null on the right is not a missing row
    twice = left.union(left)
    assert left_join(twice, right, ["origin", "month"]).count() == 10
    null = spark.createDataFrame([("a", None)], "origin string, causes string")
    assert left_join(left.filter("origin = 'a'"), null, "origin").collect()[0]["causes"] is None


def test_a_key_of_several_rows_stops_the_job(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    double = spark.createDataFrame([("b", "x"), ("b", "x"), (None, "p"), (None, "q")], "k string, v string")
    with pytest.raises(Exception, match="several rows of the right side for b"):
        left_join(left, double, "k").collect()
    assert _rows(left_join(left.filter("k = 'a'"), double.filter("k is null"), "k")) == [("a", 1, None)]
    with pytest.raises(Exception, match="several rows of the right side for null"):
        left_join(left.unionByName(spark.createDataFrame([(None, 3)], "k string, n int")), double.filter("k is null"),
                  "k", null_safe=True).collect()


def test_clashing_columns_and_empty_sides(spark):
    left = spark.createDataFrame([("a", 1)], "k string, n int")
    with pytest.raises(ValueError):
        left_join(left, left, "k")
    empty = left.limit(0).withColumnRenamed("n", "v")
    assert _rows(left_join(left, empty, "k")) == [("a", 1, None)]
    assert left_join(left.limit(0), empty, "k").count() == 0


def test_checking_an_aggregate_adds_no_exchange(spark):
    rows = spark.range(1000).selectExpr("id % 7 AS k", "id AS v")
    one, two = rows.groupBy("k").agg({"v": "sum"}), rows.groupBy("k").agg({"v": "max"})
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left_join(one, two, "k")
        assert joined.count() == 7
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(re.findall(r"Exchange hashpartitioning", plan.split("Initial Plan")[-1])) == 2
    assert "LeftOuter" in plan


def test_join_form_of_q2_equals_the_one_pass_form(spark):
    frame = flight_rows(spark, [
        {"origin": "ABE", "carrier_delay": 5, "dep_delay": 20.0}, {"origin": "ABE", "nas_delay": 9},
        {"origin": "ABE", "month": 2, "cancelled": 1, "dep_delay": None},
        {"origin": "AUS", "dep_delay": 90.0, "weather_delay": 3}])
    agg = R.airport_month_aggregate(frame)
    assert _rows(R.airport_month_join(agg)) == _rows(R.airport_month_finish(agg))
    unknown = flight_rows(spark, [{"origin": None, "nas_delay": 9}])
    assert _rows(R.airport_month_join(R.airport_month_aggregate(unknown)))[0][-1] == "[]"
