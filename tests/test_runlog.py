"""Run-log analytics on a small log in the benchmark CSV layout."""

import os

from tarmac.functions.text import fmt_duration, map_values
from tarmac.plans import runlog as RL
from tarmac.sources.io import read_runlog

LOG_A = """percentuale,motore,analisi,tempo_secondi,status
20,Alpha,A1,120,0
20,Beta,A1,11,0
20,Gamma,A1,9,0
20,Alpha,A2,498,0
20,Beta,A1,21,0
"""
LOG_B = """percentuale,motore,analisi,tempo_secondi,status
20,Alpha,A1,34,0
20,Beta,A1,12,0
20,Gamma,A1,27,0
"""


def _log(spark, tmp_dir, name, text):
    path = os.path.join(tmp_dir, name)
    with open(path, "w") as fh:
        fh.write(text)
    return read_runlog(spark, path)


def test_cell_times_sum_repeated(spark, tmp_dir):
    cells = RL.cell_times(_log(spark, tmp_dir, "a.csv", LOG_A))
    got = {(r.motore, r.analisi): (r.tempo_secondi, r.misure, r.minimo) for r in cells.collect()}
    assert got[("Beta", "A1")] == (32, 2, 11)
    assert got[("Alpha", "A2")] == (498, 1, 498)


def test_engine_totals_sorted_with_duration(spark, tmp_dir):
    tot = RL.engine_totals(_log(spark, tmp_dir, "a.csv", LOG_A)).collect()
    assert [r.motore for r in tot] == ["Gamma", "Beta", "Alpha"]
    assert tot[-1].tempo == "00:10:18"


def test_fmt_duration_cuts_days(spark):
    r = spark.createDataFrame([(90078,), (0,)], "s long").select(fmt_duration("s").alias("t"))
    assert [x.t for x in r.collect()] == ["01:01:18", "00:00:00"]


def test_compare_and_melt(spark, tmp_dir):
    a = _log(spark, tmp_dir, "a.csv", LOG_A)
    b = _log(spark, tmp_dir, "b.csv", LOG_B)
    wide = RL.compare_runs(a, b)
    assert set(wide.columns) == {"motore", "tempo_secondi_locale", "tempo_x",
                                 "tempo_secondi_cluster", "tempo_y"}
    long = RL.melt_runs(wide)
    got = {(r.motore, r.ambiente): r.tempo_secondi for r in long.collect()}
    assert got[("Alpha", "Locale")] == 618 and got[("Alpha", "Cluster")] == 34


def test_two_environments_in_one_log_equal_the_join(spark, tmp_dir):
    from pyspark.sql import functions as F
    a, b = _log(spark, tmp_dir, "a.csv", LOG_A), _log(spark, tmp_dir, "b.csv", LOG_B)
    both = a.withColumn("env", F.lit("l")).unionByName(b.withColumn("env", F.lit("c")))
    both = both.unionByName(a.limit(1).withColumns({"env": F.lit("l"), "motore": F.lit("only here")}))
    one = RL.compare_parts(both, F.col("env") == "l")
    two = RL.compare_runs(a, b).select(*one.columns)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_map_values_passes_unknown(spark):
    df = spark.createDataFrame([("a",), ("z",)], "k string")
    out = [r.v for r in df.select(map_values("k", {"a": "A"}).alias("v")).collect()]
    assert out == ["A", "z"]
