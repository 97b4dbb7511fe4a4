"""Hand-made edge frames (FIXTURES.md section 5)."""

import math

from pyspark.sql import functions as F

from tarmac.functions.metrics import stable_round
from tarmac.operators import prep
from tarmac.plans import reports as R
from tarmac.schema import RAW_SCHEMA
from tests.conftest import flight_rows


def test_band_edges(spark):
    df = flight_rows(spark, [{"dep_delay": v} for v in (14.99, 15.0, 60.0, 60.01)]
                     + [{"dep_delay": None}, {"dep_delay": 100.0, "cancelled": 1}])
    r = R.airport_month_report(df).collect()[0]
    assert (r.numero_ritardi_basso, r.numero_ritardi_medio, r.numero_ritardi_alto) == (1, 2, 1)


def test_only_early_flights(spark):
    df = flight_rows(spark, [{"arr_delay": -5.0}, {"arr_delay": -2.0}])
    r = R.carrier_stats(df).collect()[0]
    assert (r.ritardo_minimo, r.ritardo_massimo, r.ritardo_medio) == (0.0, -2.0, 0.0)


def test_all_cancelled_group(spark):
    df = flight_rows(spark, [{"cancelled": 1, "arr_delay": None, "dep_delay": None}] * 3)
    r = R.carrier_stats(df).collect()[0]
    assert (r.ritardo_minimo, r.ritardo_massimo, r.ritardo_medio) == (0.0, 0.0, 0.0)
    assert r.tasso_cancellazione == 100.0
    q2 = R.airport_month_report(df).collect()[0]
    assert q2.cause_maggiori == "[]"
    assert (q2.numero_ritardi_basso, q2.numero_ritardi_medio, q2.numero_ritardi_alto) == (0, 0, 0)


def test_diverted_flight(spark):
    df = flight_rows(spark, [{"arr_delay": None, "dep_delay": 20.0},
                             {"arr_delay": 30.0, "dep_delay": 20.0}])
    q1 = R.carrier_stats(df).collect()[0]
    assert q1.numero_voli == 2 and q1.ritardo_medio == 15.0
    q3 = R.carrier_vs_airport(df).collect()[0]
    assert q3.ritardo_medio_arrivo == 30.0


def _raw(spark, rows):
    base = {c.name: None for c in RAW_SCHEMA}
    base.update(year=2024, month=1, fl_date="2024-01-01", op_unique_carrier="9E",
                origin="ABE", dest="ATL", cancelled=0, diverted=0, dep_delay=0.0,
                arr_delay=0.0)
    return spark.createDataFrame([tuple({**base, **r}[c.name] for c in RAW_SCHEMA)
                                  for r in rows], RAW_SCHEMA)


def test_outlier_edges(spark):
    df = _raw(spark, [{"dep_delay": -30.0}, {"arr_delay": 1440.0}, {"dep_delay": -30.01},
                      {"arr_delay": 1440.01}])
    kept = [(r.dep_delay, r.arr_delay) for r in prep.drop_outliers(df).collect()]
    assert sorted(kept) == [(-30.0, 0.0), (0.0, 1440.0)]


def test_null_delays_survive_outlier_filter(spark):
    df = _raw(spark, [{"dep_delay": None}, {"arr_delay": None},
                      {"cancelled": 1, "dep_delay": None, "arr_delay": None}])
    assert prep.drop_outliers(df).count() == 3


def test_corrupt_rows(spark):
    df = _raw(spark, [{"arr_delay": None},                      # corrupt
                      {"arr_delay": None, "diverted": 1},       # diverted: kept
                      {"arr_delay": None, "dep_delay": None, "cancelled": 1},  # kept
                      {}])
    assert prep.drop_corrupt(df).count() == 3


def test_null_flight_number_kept(spark):
    df = _raw(spark, [{"op_carrier_fl_num": None}, {"op_carrier_fl_num": 12.0}])
    out = prep.clean(df)
    assert out.count() == 2 and out.filter(F.col("op_carrier_fl_num").isNull()).count() == 1


def test_nan_delay_is_null(spark):
    df = _raw(spark, [{"dep_delay": float("nan"), "cancelled": 1}, {"arr_delay": 5.0}])
    out = prep.clean(df)
    vals = [r.dep_delay for r in out.collect()]
    assert None in vals and not any(isinstance(v, float) and math.isnan(v) for v in vals)
    q1 = R.carrier_stats(out).collect()[0]
    assert not math.isnan(q1.ritardo_massimo)


def test_coercion(spark):
    df = spark.createDataFrame([("12",), ("x",), (None,)], "carrier_delay string")
    out = prep.impute_causes(df, ["carrier_delay"])
    assert [r.carrier_delay for r in out.collect()] == [12, 0, 0]
    assert dict(out.dtypes)["carrier_delay"] == "bigint"


def test_parse_date(spark):
    df = _raw(spark, [{"fl_date": "2024-03-05"}])
    r = prep.parse_date(df).collect()[0]
    assert (r.fl_date.year, r.fl_date.month, r.fl_date.day) == (2024, 3, 5)
    assert dict(prep.parse_date(df).dtypes)["fl_date"] == "timestamp_ntz"


def test_cause_ties(spark):
    df = flight_rows(spark, [{"weather_delay": 10, "nas_delay": 10, "carrier_delay": 10,
                              "security_delay": 10, "late_aircraft_delay": 0}])
    r = R.airport_month_report(df).collect()[0]
    assert r.cause_maggiori == "['Carrier (10 min)', 'NAS (10 min)', 'Security (10 min)']"


def test_zero_minute_causes_take_places(spark):
    df = flight_rows(spark, [{"carrier_delay": 7}])
    r = R.airport_month_report(df).collect()[0]
    assert r.cause_maggiori == "['Carrier (7 min)', 'Late Aircraft (0 min)', 'NAS (0 min)']"


def test_rank_ties_and_null_mean(spark):
    rows = [{"op_unique_carrier": "AA", "dep_delay": None, "cancelled": 1},
            {"op_unique_carrier": "BB", "dep_delay": 1.0},
            {"op_unique_carrier": "CC", "dep_delay": 1.0},
            {"op_unique_carrier": "DD", "dep_delay": 2.0}]
    out = {r.compagnia: r.classifica for r in R.carrier_vs_airport(flight_rows(spark, rows)).collect()}
    assert out == {"AA": 1, "BB": 2, "CC": 2, "DD": 4}


def test_single_carrier_airport(spark):
    df = flight_rows(spark, [{"dep_delay": 12.0}, {"dep_delay": 3.0}])
    r = R.carrier_vs_airport(df).collect()[0]
    assert r.differenza == 0.0 and r.classifica == 1


def test_airport_mean_is_flight_weighted(spark):
    rows = ([{"op_unique_carrier": "AA", "dep_delay": 10.0}] * 3
            + [{"op_unique_carrier": "BB", "dep_delay": 0.0}])
    out = {r.compagnia: r.differenza for r in R.carrier_vs_airport(flight_rows(spark, rows)).collect()}
    assert out == {"AA": 2.5, "BB": -7.5}


def test_near_tie_rounding(spark):
    r = spark.range(1).select(stable_round(F.lit(69.0) / F.lit(120.0), 2).alias("x")).collect()[0]
    assert r.x == 0.58


def test_rate_scales(spark):
    rows = [{"cancelled": 1}] + [{}] * 58
    df = flight_rows(spark, rows)
    assert R.carrier_stats(df).collect()[0].tasso_cancellazione == 1.69
    assert R.carrier_stats(df, rate_scale=1).collect()[0].tasso_cancellazione == 1.7


def test_rate_on_empty_input_is_null(spark):
    from tarmac.functions.metrics import rate
    df = flight_rows(spark, [{}]).limit(0)
    assert df.agg(rate(F.col("cancelled") == 1).alias("r")).first().r is None


def test_clean_conforms_types_of_a_loose_raw_frame(spark):
    """A raw frame with pandas-like types (numbers as doubles) cleans to
    the declared clean schema."""
    from tarmac.schema import CLEAN_SCHEMA
    raw = _raw(spark, [{}, {"cancelled": 1, "dep_delay": None, "arr_delay": None}])
    loose = raw.withColumns({"month": F.col("month").cast("double"),
                             "cancelled": F.col("cancelled").cast("double"),
                             "carrier_delay": F.col("carrier_delay").cast("string")})
    out = prep.clean(loose)
    assert [(f.name, f.dataType) for f in out.schema] == \
        [(f.name, f.dataType) for f in CLEAN_SCHEMA]
    assert out.count() == 2
