import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tarmac.session import get_session
    ckpt = tempfile.mkdtemp(prefix="tarmac-test-ckpt-")
    s = get_session("local[4]", app="tarmac-tests", shuffle_partitions=8,
                    conf={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="tarmac-test-")


def flight_rows(spark, rows):
    """Clean-schema frame from partial dicts (missing fields: defaults)."""
    from tarmac.schema import CLEAN_SCHEMA
    import datetime as dt
    base = {"month": 1, "fl_date": dt.datetime(2024, 1, 1), "op_unique_carrier": "9E",
            "op_carrier_fl_num": 1.0, "origin": "ABE", "dest": "ATL", "dep_delay": 0.0,
            "arr_delay": 0.0, "cancelled": 0, "cancellation_code": None,
            "carrier_delay": 0, "weather_delay": 0, "nas_delay": 0, "security_delay": 0,
            "late_aircraft_delay": 0}
    data = [tuple({**base, **r}[f.name] for f in CLEAN_SCHEMA) for r in rows]
    return spark.createDataFrame(data, CLEAN_SCHEMA)
