"""Golden format: hand-made inputs that must print exactly the sample
report lines of the original (header, number format, rounding, quoting).

The expected lines are fixed values: they must equal published output."""

import glob
import os

from pyspark.sql import functions as F

from tarmac.plans import reports as R
from tarmac.schema import Q1_COLUMNS, Q2_COLUMNS, Q3_COLUMNS
from tarmac.sources.io import write_report
from tests.conftest import flight_rows


def _csv(df, path):
    write_report(df, path, single_file=True)
    return open(glob.glob(os.path.join(path, "part-*.csv"))[0]).read().splitlines()


def test_q1_line(spark, tmp_dir):
    # 59 flights, 1 cancelled; late arrivals 1, 113, 100, 100, 100, 42; others early/zero
    rows = [{"month": 2, "cancelled": 1, "arr_delay": None, "dep_delay": None}]
    rows += [{"month": 2, "arr_delay": v} for v in (1.0, 113.0, 100.0, 100.0, 100.0, 42.0)]
    rows += [{"month": 2, "arr_delay": -3.0}] * 26 + [{"month": 2, "arr_delay": 0.0}] * 26
    lines = _csv(R.carrier_stats(flight_rows(spark, rows)), os.path.join(tmp_dir, "q1"))
    assert lines[0] == ",".join(Q1_COLUMNS)
    assert lines[1] == "9E,ABE,59,1.0,113.0,7.73,1.69,2"


def test_q2_line(spark, tmp_dir):
    rows = [{"dep_delay": 0.0}] * 230 + [{"dep_delay": 30.0}] * 31 + [{"dep_delay": 90.0}] * 30
    causes = {"carrier_delay": 3134, "late_aircraft_delay": 3020, "weather_delay": 1273,
              "nas_delay": 1000, "security_delay": 5}
    rows[0] = {**rows[0], **causes}
    rows.append({"cancelled": 1, "dep_delay": None, "carrier_delay": 99999})  # not counted
    lines = _csv(R.airport_month_report(flight_rows(spark, rows)), os.path.join(tmp_dir, "q2"))
    assert lines[0] == ",".join(Q2_COLUMNS)
    assert lines[1] == ("ABE,1,230,31,30,\"['Carrier (3134 min)', 'Late Aircraft (3020 min)', "
                        "'Weather (1273 min)']\"")


def test_q3_line(spark, tmp_dir):
    rows = [{"origin": "ABI", "op_unique_carrier": "MQ", "dep_delay": 7.0, "arr_delay": 4.0}] * 1740
    rows += [{"origin": "ABI", "op_unique_carrier": "MQ", "dep_delay": 477.0, "arr_delay": 753.0}]
    rows += [{"origin": "ABI", "op_unique_carrier": "MQ", "cancelled": 1, "dep_delay": None,
              "arr_delay": None}] * 15
    lines = _csv(R.carrier_vs_airport(flight_rows(spark, rows)), os.path.join(tmp_dir, "q3"))
    assert lines[0] == ",".join(Q3_COLUMNS)
    assert lines[1] == "ABI,MQ,1756,7.27,4.43,0.85,0.0,1"


def test_month_partitioned_volume_prunes(spark, tmp_dir):
    from tarmac.plans import catalog as C
    from tarmac.sources.io import read_clean, write_volume
    from tests.conftest import SF_SMALL
    path = write_volume(C.flights(spark, SF_SMALL), tmp_dir, 100, partition_by=["month"])
    df = read_clean(spark, path).filter(F.col("month") == 3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "(month#" in plan
    assert R.carrier_stats(df).agg(F.sum("numero_voli")).first()[0] == \
        C.flights(spark, SF_SMALL).filter(F.col("month") == 3).count()
