"""Structured Streaming form of the reports.

The original re-ran every report from scratch whenever a new volume was
uploaded.  Here the clean table is a Parquet folder read as a file
stream; each report's aggregate (per carrier-airport-month, per
airport-month, per airport-carrier) lives in the streaming state store,
so each new file is aggregated once.  Every trigger hands the complete
aggregate to ``foreachBatch``, where the parts that streaming cannot
express (ranking windows over the aggregate) run as a small batch job,
and the result is written to a new folder ``batch_<id>``.  A folder counts
once its ``_SUCCESS`` marker is there, so a reader (``read_published``)
always finds the newest complete report; a replay after a failure writes
the same folder again.  The checkpoint lives under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tarmac.plans import reports as R
from tarmac.schema import CLEAN_SCHEMA
from tarmac.session import checkpoint_dir

def _same(df: DataFrame) -> DataFrame:
    return df


# report -> (streaming aggregate, batch finish on the complete aggregate)
REPORTS: dict[str, tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame]]] = {
    "q1": (lambda df: R.carrier_stats(df, sort=False), _same),
    "q2": (R.airport_month_aggregate, lambda agg: R.airport_month_finish(agg, sort=False)),
    "q3": (R.pair_aggregate, lambda agg: R.carrier_vs_airport_finish(agg, sort=False)),
}


def clean_stream(spark: SparkSession, path: str, schema: StructType = CLEAN_SCHEMA,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """The clean Parquet folder as an unbounded table."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def run_incremental_report(spark: SparkSession, source: str, target: str, report: str = "q1",
                           checkpoint: str | None = None, available_now: bool = True,
                           schema: StructType = CLEAN_SCHEMA):
    """Start (and with ``available_now`` finish) an incremental report.

    Returns the ``StreamingQuery``; with ``available_now`` it has already
    processed every file present at start.
    """
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/tarmac_stream_{report}_{uuid.uuid4().hex}"
    aggregate, finish = REPORTS[report]
    agg = aggregate(clean_stream(spark, source, schema))

    def publish(batch: DataFrame, batch_id: int) -> None:
        finish(batch).write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch_{batch_id:012d}")

    writer = (agg.writeStream.outputMode("complete").foreachBatch(publish)
                 .option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else writer
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def read_published(spark: SparkSession, target: str) -> DataFrame:
    """The newest complete report under ``target``."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    done = [str(s.getPath()) for s in fs.listStatus(root)
            if s.getPath().getName().startswith("batch_") and fs.exists(path_of(s.getPath(), "_SUCCESS"))]
    if not done:
        raise ValueError(f"no complete report under {target}")
    return spark.read.parquet(max(done))
