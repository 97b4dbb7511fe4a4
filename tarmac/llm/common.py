"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import checkpoint_dir


#: Rows of texts that go to or from a Python worker at once, where the session has Spark's 10,000.
ARROW_ROWS = "500"
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Bytes of such a batch, where the session has no number of its own: rows of long binaries are far larger than texts.
ARROW_BYTES = str(4 << 20)
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Make the session ready for this package's tasks.

    The package is sent to the executors, once per application: tasks import
    it, and a session started elsewhere need not have it on its Python path.
    Arrow batches keep to ``ARROW_ROWS`` unless the session sets a number of
    its own, since a batch of whole documents is held several times in the
    JVM and in Python.
    """
    if spark.conf.get(_ROWS, "10000") == "10000":
        spark.conf.set(_ROWS, ARROW_ROWS)
    if spark.conf.get(_BYTES) == "67108864b":  # Spark's 64 MB
        spark.conf.set(_BYTES, ARROW_BYTES)
    context = spark.sparkContext
    if getattr(context, "_tarmac_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="tarmac-"), os.path.basename(package))
    context.addPyFile(shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package)))
    context._tarmac_shipped = True


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(col: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def id_fold(col: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (null id: that of '')."""
    text = F.coalesce(F.col(col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def materialise(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` as a table in the shared folder and read it again.

    This cuts the lineage: what follows reads finished files that survive
    the loss of any executor.
    """
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Take the files of a table that ``materialise`` wrote away; nothing may read it any more."""
    folders = {os.path.dirname(f) for f in table.inputFiles()}
    for folder in folders:
        table.sparkSession.range(0).write.mode("overwrite").parquet(folder)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize"


@contextlib.contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def free_shuffles(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Inside, the shuffle files of a query go when it has ended.

    For a chain of steps that each write a table: what comes next reads the
    table, so the disk holds the files of one step at a time.
    """
    return _setting(spark, _CLEANUP, "true")


def long_rows(spark: SparkSession, rows: int = 64) -> contextlib.AbstractContextManager[None]:
    """Inside, Parquet is read so many rows at once: for tables with rows of some 100 KB, where Spark takes 4,096."""
    return _setting(spark, _READ_ROWS, str(rows))


def smallest(frame: DataFrame, hashed: Column, tie: str, limit: int) -> DataFrame:
    """The ``limit`` rows with the smallest 64-bit hash (ties: smallest ``tie``).

    On a large table only hashes below a bound, about twice as many rows as
    wanted, are sorted, so the partial results that meet in the last step
    do not grow with the number of partitions.
    """
    n = frame.count()
    if n > 4 * limit:
        frame = frame.filter(hashed < int(2 * limit / n * 2.0 ** 64) - (1 << 63))
    return frame.orderBy(hashed, tie).limit(limit)
