"""Batch jobs and the command line."""

import glob
import os
import subprocess
import sys

from tarmac.plans import catalog as C
from tarmac.plans import jobs
from tarmac.sources.io import read_clean, write_report
from tests.conftest import ROOT, SF_SMALL


def _csv_lines(path):
    """Header once, then the rows of all part files in name order."""
    files = [open(f).read().splitlines() for f in sorted(glob.glob(os.path.join(path, "part-*.csv")))]
    return files[0][:1] + [line for f in files for line in f[1:]]


def test_prepare_and_report_jobs(spark, tmp_dir):
    raw_csv = os.path.join(tmp_dir, "raw")
    write_report(C.flights_raw(spark, SF_SMALL), raw_csv)
    paths = jobs.prepare_job(spark, raw_csv, tmp_dir, percents=[50, 100])
    clean_rows = spark.read.parquet(os.path.join(tmp_dir, "clean")).count()
    assert clean_rows == 5384
    assert read_clean(spark, paths[100]).count() == clean_rows
    out = jobs.report_job(spark, paths[100], "q1", os.path.join(tmp_dir, "q1"))
    lines = _csv_lines(out)
    assert lines[0] == ("codice,aeroporto_partenza,numero_voli,ritardo_minimo,ritardo_massimo,"
                        "ritardo_medio,tasso_cancellazione,mese")
    assert len(lines) == 1 + 2429
    out2 = jobs.sql_job(spark, paths[100], "q2", os.path.join(tmp_dir, "q2"))
    assert _csv_lines(out2)[0].endswith("numero_ritardi_alto,cause_maggiori")
    out3 = jobs.report_job(spark, paths[100], "routes", os.path.join(tmp_dir, "routes"))
    assert len(_csv_lines(out3)) == 26


def test_sql_job_with_a_database_and_runlog_job(spark, tmp_dir):
    volume = os.path.join(tmp_dir, "volume")
    C.flights(spark, SF_SMALL).write.parquet(volume)
    old = spark.catalog.currentDatabase()
    try:
        out = jobs.sql_job(spark, volume, "q3", os.path.join(tmp_dir, "q3"), table="voli", db="tarmac_jobs_db")
        assert spark.catalog.currentDatabase() == "tarmac_jobs_db" and len(_csv_lines(out)) == 251
    finally:
        spark.catalog.setCurrentDatabase(old)
        spark.sql("DROP TABLE IF EXISTS tarmac_jobs_db.voli")
    for name, seconds in (("l.csv", 100), ("c.csv", 40)):
        with open(os.path.join(tmp_dir, name), "w") as fh:
            fh.write(f"percentuale,motore,analisi,tempo_secondi,status\n10,M,A,{seconds},0\n10,M,A,1,0\n")
    got = jobs.runlog_job(spark, os.path.join(tmp_dir, "l.csv"), os.path.join(tmp_dir, "c.csv"), os.path.join(tmp_dir, "log"))
    assert set(got) == {"cells_locale", "cells_cluster", "compare", "long"}
    assert _csv_lines(got["compare"])[1].split(",")[1:] == ["101", "00:01:41", "41", "00:00:41"]


def test_cli_writes_a_report(spark, tmp_dir):
    volume = os.path.join(tmp_dir, "volume")
    C.flights(spark, SF_SMALL).write.parquet(volume)
    env = dict(os.environ, PYTHONPATH=ROOT)
    out = os.path.join(tmp_dir, "o")
    r = subprocess.run([sys.executable, "-m", "tarmac", "--conf", "spark.sql.shuffle.partitions=4", "report", "q2",
                        volume, out, "--single-file"], capture_output=True, text=True, timeout=300, env=env, cwd=tmp_dir)
    assert r.returncode == 0, r.stderr[-500:]
    assert len(glob.glob(os.path.join(out, "part-*.csv"))) == 1 and len(_csv_lines(out)) == 121


def test_scratch_folder_is_required_on_a_cluster(spark):
    from tarmac.session import checkpoint_dir

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "spark://host:7077"})()

    import pytest
    with pytest.raises(ValueError):
        checkpoint_dir(Session())


def test_cli_empty_input_fails(tmp_dir):
    empty = os.path.join(tmp_dir, "empty")
    os.makedirs(empty)
    env = dict(os.environ, PYTHONPATH=ROOT)
    r = subprocess.run([sys.executable, "-m", "tarmac", "report", "q1", empty,
                        os.path.join(tmp_dir, "o")], capture_output=True, text=True,
                       timeout=300, env=env, cwd=ROOT)
    assert r.returncode == 1 and "ERROR report" in r.stderr
