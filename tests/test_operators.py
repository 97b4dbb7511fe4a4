"""Operator-level unit tests on small literal frames."""

import pytest
from pyspark.sql import functions as F

from tarmac.operators import prep, profile
from tarmac.operators.topk import ordered_list, rank_rows, top_k_per_group, unpivot_columns
from tarmac.plans import reports as R
from tests.conftest import flight_rows
from tests.test_edges import _raw


def test_invalid_date_text_raises(spark):
    df = _raw(spark, [{"fl_date": "2024-13-45"}])
    with pytest.raises(Exception):
        prep.parse_date(df).collect()


def test_step_counts_cumulative(spark):
    df = _raw(spark, [{"arr_delay": None},          # corrupt
                      {"dep_delay": 2000.0},        # outlier
                      {"dep_delay": None, "cancelled": 1},
                      {}])
    steps = {"drop_corrupt": ~F.coalesce(prep.corrupt_condition(), F.lit(False)),
             "drop_outliers": ~prep.outlier_condition()}
    got = {r.step: r.rows for r in profile.step_counts(df, steps).collect()}
    assert got == {"input": 4, "drop_corrupt": 3, "drop_outliers": 2}


def test_null_counts_and_bounds(spark):
    df = _raw(spark, [{"dep_delay": None, "cancelled": 1}, {"dep_delay": -7.0},
                      {"dep_delay": 99.0}])
    nulls = {r.column_name: r.null_count for r in
             profile.null_counts(df, ["dep_delay", "arr_delay"]).collect()}
    assert nulls == {"dep_delay": 1, "arr_delay": 0}
    b = profile.bounds(df, ["dep_delay"]).first()
    assert (b.dep_delay_min, b.dep_delay_max) == (-7.0, 99.0)


def test_describe_schema(spark):
    df = _raw(spark, [{"dep_delay": None}, {}])
    rows = {r.column_name: (r.data_type, r.non_null) for r in profile.describe_schema(df).collect()}
    assert rows["dep_delay"] == ("double", 1) and rows["origin"] == ("string", 2)


def test_cancel_causes_tie_break(spark):
    rows = ([{"cancelled": 1, "cancellation_code": c, "arr_delay": None, "dep_delay": None}
             for c in ("D", "B", "B", "C", "A", "D")])
    got = [(r.cancellation_code, r.numero_cancellazioni, r.classifica)
           for r in R.cancel_causes(flight_rows(spark, rows)).orderBy("classifica").collect()]
    assert got == [("B", 2, 1), ("D", 2, 2), ("A", 1, 3)]


def test_anomalous_threshold_inclusive(spark):
    rows = ([{"op_unique_carrier": "AA", "dep_delay": 20.0}]
            + [{"op_unique_carrier": "BB", "dep_delay": 0.0}])
    df = flight_rows(spark, rows)
    assert {r.compagnia for r in R.anomalous_pairs(df, 10.0).collect()} == {"AA", "BB"}
    assert R.anomalous_pairs(df, 10.01).count() == 0


def test_routes_and_months_dedupe(spark):
    rows = [{"dest": "ATL", "month": 3}, {"dest": "ATL", "month": 1}, {"dest": "BOS", "month": 3}]
    r = R.carrier_routes(flight_rows(spark, rows)).first()
    assert (r.numero_tratte, r.tratte) == (2, ["ABE-ATL", "ABE-BOS"])
    m = R.operating_months(flight_rows(spark, rows)).first()
    assert (m.numero_mesi, m.mesi) == (2, [1, 3])


def test_generic_topk_and_ordered_list(spark):
    df = spark.createDataFrame([("g", "x", 5), ("g", "y", 9), ("g", "z", 9), ("h", "x", 1)],
                               "g string, item string, v long")
    top = top_k_per_group(df, ["g"], [F.col("v").desc(), F.col("item")], 2)
    lists = {r.g: r.items for r in top.groupBy("g").agg(
        ordered_list("ranking", "item").alias("items")).collect()}
    assert lists == {"g": ["y", "z"], "h": ["x"]}
    ranked = rank_rows(df, ["g"], [F.col("v").desc()], method="rank")
    assert sorted((r.item, r.ranking) for r in ranked.filter("g = 'g'").collect()) == \
        [("x", 3), ("y", 1), ("z", 1)]


def test_unpivot_columns_keep_empty(spark):
    df = spark.createDataFrame([("a", 1, 2, True), ("b", 3, 4, False)],
                               "k string, p long, q long, ok boolean")
    out = unpivot_columns(df, ["k"], {"p": "P", "q": "Q"}, keep_empty=True,
                          only_if=F.col("ok"))
    assert sorted(tuple(r) for r in out.collect()) == [("a", "P", 1), ("a", "Q", 2),
                                                      ("b", None, None)]


def test_samples_of_any_frame(spark):
    from tarmac.operators import volumes
    df = flight_rows(spark, [{}, {}])
    assert volumes.sample_volume(df, 50).count() == 1
