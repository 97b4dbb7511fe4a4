"""Sources and sinks: CSV, Parquet, catalog, SQL files."""

import glob
import os

import pytest

from tarmac.operators import prep, profile, volumes
from tarmac.plans import catalog as C
from tarmac.sources import io as IO
from tarmac.sources.catalog import register_table, run_sql_file, run_sql_text, split_statements, use_db
from tests.conftest import SF_SMALL


def test_csv_roundtrip_with_schema(spark, tmp_dir):
    raw = C.flights_raw(spark, SF_SMALL).limit(50)
    path = os.path.join(tmp_dir, "raw_csv")
    IO.write_report(raw, path, single_file=True)
    assert len(glob.glob(os.path.join(path, "part-*.csv"))) == 1
    back = IO.read_raw(spark, path)
    assert [(f.name, f.dataType) for f in back.schema] == \
        [(f.name, f.dataType) for f in raw.schema]
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, raw.collect()))


def test_report_text_options(spark, tmp_dir):
    df = spark.createDataFrame([("a", None), ("b", 2)], "k string, v int")
    path = os.path.join(tmp_dir, "tsv")
    IO.write_report(df, path, single_file=True, sep="\t", null_value="")
    text = open(glob.glob(os.path.join(path, "part-*.csv"))[0]).read().splitlines()
    assert text[0] == "k\tv" and sorted(text[1:]) == ["a\t", "b\t2"]


def test_quoted_cause_list(spark, tmp_dir):
    df = spark.createDataFrame([("ABE", "['Carrier (3 min)', 'NAS (1 min)']")], "a string, c string")
    path = os.path.join(tmp_dir, "q2csv")
    IO.write_report(df, path, single_file=True)
    line = open(glob.glob(os.path.join(path, "part-*.csv"))[0]).read().splitlines()[1]
    assert line == "ABE,\"['Carrier (3 min)', 'NAS (1 min)']\""


def test_parquet_volumes_and_merge_schema(spark, tmp_dir):
    C.flights(spark, SF_SMALL).write.parquet(os.path.join(tmp_dir, "clean"))
    clean = IO.read_clean(spark, os.path.join(tmp_dir, "clean"))
    paths = volumes.build_volumes(clean, tmp_dir, percents=[10, 150])
    assert set(paths) == {10, 150}
    assert IO.volume_label(paths[150]) == "150"
    v10 = IO.read_clean(spark, paths[10], merge_schema=True)
    assert v10.count() == volumes.sample_volume(clean, 10).count() == 538
    assert IO.read_clean(spark, paths[150]).count() == (
        clean.count() + 2692)
    # a part file with one extra column: merged schema has it
    extra = v10.limit(5).withColumnRenamed("dest", "dest2")
    IO.write_volume(extra, tmp_dir, 10, mode="append")
    merged = IO.read_clean(spark, paths[10], merge_schema=True)
    assert {"dest", "dest2"} <= set(merged.columns)


def test_require_non_empty(spark):
    with pytest.raises(ValueError):
        IO.require_non_empty(spark.range(0))
    assert IO.require_non_empty(spark.range(1)).count() == 1


def test_volume_label():
    assert IO.volume_label("hdfs:///data/dataset_50") == "50"
    assert IO.volume_label("/x/dataset_100.parquet/") == "100"


def test_external_table_and_sql_file(spark, tmp_dir):
    clean = C.flights(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "flights_tbl")
    clean.write.mode("overwrite").parquet(path)
    full = register_table(spark, "flights", path=path, db="flights_test_db")
    assert full == "flights_test_db.flights"
    use_db(spark, "flights_test_db")
    try:
        q1 = run_sql_file(spark, "q1", {"flights": "flights", "rate_scale": 1})
        assert q1.count() == 2429
        n = run_sql_text(spark, "SELECT count(*) AS n FROM IDENTIFIER(:t)", {"t": full}).first().n
        assert n == 5384
        # drop + create again over the same folder
        register_table(spark, "flights", path=path, db="flights_test_db")
    finally:
        use_db(spark, "default")


def test_write_split_one_folder_per_value(spark, tmp_dir):
    from tarmac.plans import runlog as RL
    log = RL.runlog_from_flights(C.flights(spark, SF_SMALL))
    cells = RL.cell_times(log)
    path = IO.write_split(cells, os.path.join(tmp_dir, "by_volume"), ["percentuale"])
    folders = {os.path.basename(p) for p in glob.glob(os.path.join(path, "percentuale=*"))}
    assert folders == {f"percentuale={r.percentuale}"
                       for r in cells.select("percentuale").distinct().collect()}
    back = spark.read.option("header", True).csv(path)
    assert back.count() == cells.count()


def test_head_n(spark):
    from tarmac.operators.profile import head_n
    df = spark.range(100).selectExpr("id % 7 AS k", "id")
    got = [tuple(r) for r in head_n(df, ["k", "id"], 3).collect()]
    assert got == [(0, 0), (0, 7), (0, 14)]


def test_register_table_with_ddl_schema(spark, tmp_dir):
    from tarmac.schema import CLEAN_SCHEMA
    path = os.path.join(tmp_dir, "ddl_tbl")
    C.flights(spark, SF_SMALL).write.parquet(path)
    name = register_table(spark, "flights_ddl", path=path, schema=CLEAN_SCHEMA)
    t = spark.table(name)
    assert [(f.name, f.dataType) for f in t.schema] == [(f.name, f.dataType) for f in CLEAN_SCHEMA]
    assert t.count() == 5384


def test_setup_table_ddl_with_path_variable(spark, tmp_dir):
    from tarmac.schema import CLEAN_DDL, CLEAN_SCHEMA
    path = os.path.join(tmp_dir, "ddl_var")
    C.flights(spark, SF_SMALL).write.parquet(path)
    spark.sql("CREATE DATABASE IF NOT EXISTS flights_ddl_db")
    spark.sql("DROP TABLE IF EXISTS flights_ddl_db.flights")
    run_sql_file(spark, "setup_table", {"table": "flights_ddl_db.flights"}, {"path": path, "columns": CLEAN_DDL})
    t = spark.table("flights_ddl_db.flights")
    assert [(f.name, f.dataType) for f in t.schema] == [(f.name, f.dataType) for f in CLEAN_SCHEMA]
    assert t.count() == 5384
    assert spark.conf.get("path", None) is None  # the variable does not linger
    with pytest.raises(ValueError):
        run_sql_text(spark, "SELECT '${x}'", variables={"x": "a' OR 'b"})
    with pytest.raises(ValueError):
        run_sql_text(spark, "SELECT '${x}'")


def test_several_statements_and_missing_files(spark, tmp_dir):
    text = """-- setup; not a statement
    CREATE OR REPLACE TEMP VIEW several AS SELECT 'a;b' AS v; /* ; */
    SELECT v, :n AS n FROM several -- last;
    ;
    """
    assert [tuple(r) for r in run_sql_text(spark, text.replace(", :n AS n", ", 2 AS n")).collect()] == [("a;b", 2)]
    assert len(split_statements(text)) == 2
    path = os.path.join(tmp_dir, "two.sql")
    with open(path, "w") as fh:
        fh.write("SELECT 1 AS a; SELECT 2 AS a")
    assert run_sql_file(spark, path).first().a == 2
    for missing in ("/nonexistent/q1.sql", os.path.join(tmp_dir, "q1"), "q9"):
        with pytest.raises(FileNotFoundError):
            run_sql_file(spark, missing)


@pytest.mark.parametrize("row", ["1,2024-01-05,ABE,ATL,9", "1,2024-01-05,ABE"])
def test_rows_with_another_field_count_stop_every_query(spark, tmp_dir, row):
    path = os.path.join(tmp_dir, "surplus.csv")
    with open(path, "w") as fh:
        fh.write(f"MONTH,FL_DATE,ORIGIN,DEST\n1,2024-01-05,ABE,ATL\n{row}\n")
    raw = IO.read_raw(spark, path)
    for query in (raw, raw.select("month"), raw.groupBy("origin").count()):
        with pytest.raises(Exception):
            query.collect()
    assert IO.read_raw(spark, path, mode="DROPMALFORMED").select("month", "dest", "origin", "fl_date").count() >= 1


def test_integers_written_with_a_decimal_point(spark, tmp_dir):
    path = os.path.join(tmp_dir, "decimal.csv")
    with open(path, "w") as fh:
        fh.write("MONTH,CANCELLED,DEST\n1.0,0.0,ATL\n12,1,BOS\n,,X\n")
    rows = IO.read_raw(spark, path).select("month", "cancelled").collect()
    assert [tuple(r) for r in rows] == [(1, 0), (12, 1), (None, None)]
    with open(path, "w") as fh:
        fh.write("MONTH,CANCELLED,DEST\n1.5,0.0,ATL\n")
    with pytest.raises(Exception):
        IO.read_raw(spark, path).select("month").collect()


def test_nan_reads_as_null_everywhere(spark, tmp_dir):
    nan = float("nan")
    rows = [(1, "ABE", nan, 5.0, nan, 0, 0), (1, "ABE", 5.0, nan, 3.0, 0, 0), (1, "ABE", 7.0, 9.0, 1.0, 0, 0),
            (1, "ABE", nan, nan, nan, 1, 0)]
    schema = "month long, origin string, dep_delay double, arr_delay double, carrier_delay double, cancelled int, diverted int"
    frame = spark.createDataFrame(rows, schema)
    nulls = IO.nan_as_null(frame)
    path = os.path.join(tmp_dir, "nan")
    frame.write.parquet(path)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(IO.read_clean(spark, path)) == key(nulls) and "nan" not in str(key(nulls))
    assert key(IO.nan_as_null(prep.drop_corrupt(frame))) == key(prep.drop_corrupt(nulls))
    assert key(IO.nan_as_null(prep.drop_outliers(frame))) == key(prep.drop_outliers(nulls))
    assert [r.carrier_delay for r in prep.impute_causes(frame, ["carrier_delay"]).collect()] == [0, 3, 1, 0]
    assert profile.outlier_share(frame, prep.outlier_condition()).first()["outliers"] == 0


def test_read_raw_by_header_name(spark, tmp_dir):
    path = os.path.join(tmp_dir, "raw_odd.csv")
    with open(path, "w") as fh:
        fh.write("DEST,EXTRA,ORIGIN,FL_DATE,Month,OP_UNIQUE_CARRIER,CANCELLED,DIVERTED,"
                 "ARR_DELAY,DEP_DELAY,CARRIER_DELAY\n")
        fh.write("ATL,zz,ABE,2024-01-05,1,9E,0,0,12.0,3.0,12.0\n")
        fh.write("BOS,zz,ABE,2024-01-06,1,9E,0,0,-4.0,1.0,x\n")
    raw = IO.read_raw(spark, path)
    assert [(f.name, f.dataType) for f in raw.schema] == \
        [(f.name, f.dataType) for f in __import__("tarmac.schema").schema.RAW_SCHEMA]
    rows = sorted(raw.collect(), key=lambda r: r.dest)
    assert (rows[0].origin, rows[0].dest, rows[0].month, rows[0].arr_delay) == ("ABE", "ATL", 1, 12.0)
    assert rows[0].carrier_delay == 12 and rows[1].carrier_delay is None
    assert rows[0].year is None and rows[0].weather_delay is None
    from tarmac.operators import prep
    clean = prep.clean(raw).collect()
    assert sorted(r.carrier_delay for r in clean) == [0, 12]
