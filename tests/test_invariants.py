
import pytest
from pyspark.sql import functions as F

from tarmac.operators import volumes
from tarmac.plans import catalog as C
from tarmac.plans import reports as R
from tarmac.sources.catalog import register_table, run_sql_file
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def flights(spark):
    return C.flights(spark, SF_SMALL).cache()


def test_counts_add_up(flights):
    n = flights.count()
    assert n == 5384
    assert R.carrier_stats(flights).agg(F.sum("numero_voli")).first()[0] == n
    assert R.carrier_vs_airport(flights).agg(F.sum("numero_voli")).first()[0] == n


def test_bands_cover_flown_with_delay(flights):
    q2 = R.airport_month_report(flights)
    total = q2.agg(F.sum(F.col("numero_ritardi_basso") + F.col("numero_ritardi_medio")
                         + F.col("numero_ritardi_alto"))).first()[0]
    assert total == flights.filter((F.col("cancelled") == 0)
                                   & F.col("dep_delay").isNotNull()).count()


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name,args", [("q1", {"rate_scale": 2}), ("q2", {"k": 3}),
                                       ("q3", {"rate_scale": 2})])
def test_sql_form_equals_dataframe_form(spark, flights, name, args):
    register_table(spark, "inv_flights", df=flights)
    sql = run_sql_file(spark, name, {"flights": "inv_flights", **args})
    plan = {"q1": R.carrier_stats, "q2": R.airport_month_report,
            "q3": R.carrier_vs_airport}[name](flights)
    assert sql.columns == plan.columns
    assert _rows(sql) == _rows(plan)


def test_window_baseline_equals_join_baseline(flights):
    q3 = R.carrier_vs_airport(flights)
    pairs = R.pair_aggregate(flights)
    joined = pairs.join(R.airport_mean(flights), "origin").select(
        F.col("origin").alias("aeroporto_partenza"),
        F.col("op_unique_carrier").alias("compagnia"),
        R.difference("ritardo_medio_partenza", "ritardo_medio_complessivo").alias("d"))
    got = {(r.aeroporto_partenza, r.compagnia): r.differenza for r in q3.collect()}
    ref = {(r.aeroporto_partenza, r.compagnia): r.d for r in joined.collect()}
    assert got == ref


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_layout_invariance(flights, parts):
    base = [_rows(R.carrier_stats(flights)), _rows(R.airport_month_report(flights)),
            _rows(R.carrier_vs_airport(flights)), _rows(volumes.sample_volume(flights, 10))]
    f = flights.repartition(parts)
    assert [_rows(R.carrier_stats(f)), _rows(R.airport_month_report(f)),
            _rows(R.carrier_vs_airport(f)), _rows(volumes.sample_volume(f, 10))] == base


def test_volumes_nested_and_sized(flights):
    s10 = volumes.sample_volume(flights, 10)
    s50 = volumes.sample_volume(flights, 50)
    assert s10.exceptAll(s50).count() == 0
    n = flights.count()
    assert volumes.scale_up(flights, 150).count() == n + s50.count()
    assert s10.count() == 538 and s50.count() == 2692
    assert volumes.sample_volume(flights, 100).count() == n


def test_top_k_window_plan_has_group_limit(spark, flights):
    from tarmac.operators.topk import top_k_per_group
    agg = R.airport_month_aggregate(flights)
    top = top_k_per_group(R.causes_long(agg), ["origin", "month"], R.cause_order(), 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_q2_single_shuffle(flights):
    """Bands, causes, ranking and regrouping share ONE hash exchange."""
    plan = R.airport_month_report(flights, sort=False)._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_sample_is_the_same_for_every_layout_and_splits_hot_copies(spark, tmp_dir, monkeypatch):
    """A third of the table is copies of one flight; the table is written
    several times in several layouts, and the same rows are drawn."""
    import os
    from collections import Counter
    monkeypatch.setattr(volumes, "CHUNK", 100)  # the copies are written in many chunks
    base = C.flights(spark, SF_SMALL)
    hot = base.orderBy("fl_date", "origin", "dest", "op_carrier_fl_num", "dep_delay", "op_unique_carrier").limit(1)
    n = base.count()
    copies = hot.select("*", F.explode(F.sequence(F.lit(1), F.lit(n // 2))).alias("_i")).drop("_i")
    df = base.unionByName(copies)
    seen = []
    for name, frame, by in (("a", df, []), ("b", df, []), ("c", df.repartition(7), []), ("d", df, ["month"])):
        path = os.path.join(tmp_dir, name)
        frame.write.partitionBy(*by).parquet(path)
        read = spark.read.parquet(path).select(*df.columns).withColumn("month", F.col("month").cast("bigint"))
        seen.append(Counter(map(tuple, volumes.sample_volume(read, 10).collect())))
        assert sum(seen[-1].values()) == round(0.1 * (n + n // 2))
    assert all(s == seen[0] for s in seen)
    whole = Counter(map(tuple, df.collect()))
    row, m = whole.most_common(1)[0]
    assert m > n // 2 and abs(seen[0][row] - m / 10) <= 1
    assert all(seen[0][r] <= whole[r] for r in seen[0])
    loose = volumes.sample_volume(df, 10, exact=False).count()
    assert 0.08 * (n + n // 2) < loose < 0.12 * (n + n // 2)


def test_q2_with_means_single_pass(flights):
    q2 = R.airport_month_report(flights, with_means=True)
    assert q2.columns[-3:] == ["ritardo_medio_partenza", "ritardo_medio_arrivo", "cause_maggiori"]
    means = {(r.origin, r.month): (r.ritardo_medio_partenza, r.ritardo_medio_arrivo)
             for r in R.airport_month_means(flights).collect()}
    got = {(r.aeroporto_partenza, r.mese): (r.ritardo_medio_partenza, r.ritardo_medio_arrivo)
           for r in q2.collect()}
    assert got == means
    plain = {(r.aeroporto_partenza, r.mese): r.cause_maggiori
             for r in R.airport_month_report(flights).collect()}
    assert {k: r.cause_maggiori for k, r in
            ((( r.aeroporto_partenza, r.mese), r) for r in q2.collect())} == plain
    plan = R.airport_month_report(flights, sort=False, with_means=True)._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("percent", [0, 0.5, 10, 12.5, 25, 33, 99.99, 100])
def test_exact_sample_size(flights, percent):
    n = flights.count()
    assert volumes.sample_volume(flights, percent).count() == int(n * percent / 100 + 0.5)


def test_sample_of_an_empty_table(spark, flights):
    assert volumes.sample_volume(flights.limit(0), 10).count() == 0


@pytest.mark.parametrize("total,n,want", [(2469999, 2000000, 1.23), (69, 120, 0.58), (-69, 120, -0.58),
                                          (49996, 10000000, 0.0), (3, 2, 1.5)])
def test_means_are_rounded_once(spark, total, n, want):
    from tarmac.functions.metrics import rate, stable_round
    one = spark.range(1)
    assert one.select(stable_round(F.lit(float(total)) / F.lit(n), 2)).first()[0] == want
    assert one.select(stable_round(F.lit(1.5e12), 2)).first()[0] == 1.5e12
    if 0 < total < n:
        flags = spark.range(n if n < 1000 else 1000).select((F.col("id") < total).alias("c"))
        assert flags.agg(rate(F.col("c"), 2)).first()[0] == (57.5 if n == 120 else 100.0)


def test_reports_are_written_in_order(spark, flights, tmp_dir):
    """Q1-Q3 over the written part files in name order, with and without one file (O1)."""
    import csv
    import glob
    import os
    from tarmac.plans import jobs
    path = os.path.join(tmp_dir, "volume")
    flights.write.parquet(path)
    keys = {"q1": (0, 1, 7), "q2": (0, 1), "q3": (0, 1, 7)}
    number = {7, 1}
    for name, at in keys.items():
        seen = []
        for single in (False, True):
            out = jobs.report_job(spark, path, name, os.path.join(tmp_dir, f"{name}{single}"), single_file=single)
            files = sorted(glob.glob(os.path.join(out, "part-*.csv")))
            assert not single or len(files) == 1
            rows = [r for f in files for r in list(csv.reader(open(f)))[1:]]
            order = [tuple(int(r[i]) if i in number and r[i].isdigit() else r[i] for i in at) for r in rows]
            assert order == sorted(order) and len(rows) > 100
            seen.append(rows)
        assert seen[0] == seen[1]
    df = R.carrier_stats(flights)
    assert "Coalesce 1" not in df._jdf.queryExecution().executedPlan().toString()


def test_results_do_not_depend_on_session_time_zone(spark):
    """fl_date is a timestamp without time zone: cleaning, month keys and
    the hash sample are the same under any session time zone."""
    def snapshot():
        f = C.flights(spark, SF_SMALL)
        return (_rows(f.select("fl_date", "month", "origin")),
                _rows(volumes.sample_volume(f, 10).select("fl_date", "origin")),
                _rows(R.carrier_stats(f)))
    base = snapshot()
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert snapshot() == base
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
