"""Incremental Q1 over arriving files equals batch Q1 over all of them."""

import os

from tarmac.operators import volumes
from tarmac.plans import catalog as C
from tarmac.plans import reports as R
from tarmac.streaming import read_published, run_incremental_report
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_incremental_q1_matches_batch(spark, tmp_dir):
    clean = C.flights(spark, SF_SMALL)
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    ckpt = os.path.join(tmp_dir, "ckpt")
    first = volumes.sample_volume(clean, 50)
    first.write.parquet(os.path.join(src, "part1"))
    run_incremental_report(spark, os.path.join(src, "part1"), out, "q1", ckpt)
    got1 = read_published(spark, out)
    assert _rows(got1) == _rows(R.carrier_stats(first, sort=False))
    # a second file arrives in the same folder: state carries over
    rest = clean.exceptAll(first)
    rest.write.mode("append").parquet(os.path.join(src, "part1"))
    run_incremental_report(spark, os.path.join(src, "part1"), out, "q1", ckpt)
    got2 = read_published(spark, out)
    assert _rows(got2) == _rows(R.carrier_stats(clean, sort=False))


def test_incremental_q2_q3_match_batch(spark, tmp_dir):
    clean = C.flights(spark, SF_SMALL)
    src = os.path.join(tmp_dir, "src")
    first = volumes.sample_volume(clean, 50)
    first.write.parquet(src)
    clean.exceptAll(first).write.mode("append").parquet(src)
    for report, batch in [("q2", R.airport_month_report), ("q3", R.carrier_vs_airport)]:
        out = os.path.join(tmp_dir, f"out_{report}")
        run_incremental_report(spark, src, out, report, os.path.join(tmp_dir, f"ck_{report}"))
        assert _rows(read_published(spark, out)) == _rows(batch(clean, sort=False))
