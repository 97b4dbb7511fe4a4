"""Plan guards for every registered query: JVM-side only, no cross joins,
no Python evaluation, no driver-side materialisation in the plan."""

import pytest

from tarmac.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
             "CartesianProduct", "BroadcastNestedLoopJoin", "LocalTableScan [", "Cross"]
# streaming keys run a stream at call time; their batch parts are the same
# plans as the batch keys
KEYS = sorted(k for k in QUERIES if not k.startswith("stream_"))


@pytest.mark.parametrize("key", KEYS)
def test_plan_is_jvm_side_without_cross_joins(spark, key):
    spark.catalog.clearCache()  # other tests keep the flight view, whose plan would be shown too
    df = QUERIES[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    hits = [f for f in FORBIDDEN if f in plan]
    assert not hits, (key, hits)
    # the fact table of the flight view is read once at most
    assert plan.count("FileScan parquet [l_") <= 1, key
