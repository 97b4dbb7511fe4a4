"""File scans and sinks (CSV and Parquet).

Scans take explicit schemas (no inference pass over the data); Parquet
scans let Catalyst prune columns and push filters into the reader.
Sinks never route data through the driver.
"""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegralType, StringType, StructType

from tarmac.functions.metrics import nan_to_null
from tarmac.schema import CAUSE_COLUMNS, RAW_SCHEMA, RUNLOG_SCHEMA
from tarmac.session import checkpoint_dir


def read_raw(spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA,
             header: bool = True, mode: str = "STRICT", by_name: bool = True,
             lenient: tuple[str, ...] = CAUSE_COLUMNS) -> DataFrame:
    """CSV with a header, typed by ``schema`` (no inference pass).

    ``by_name``: columns are matched to the schema by header name (any
    order, extra columns ignored, case-insensitive; a missing column is
    null).  The header gives untyped text columns, cast JVM-side.
    ``lenient`` columns use ``try_cast`` (text that is not a number becomes
    null, to be imputed later); the others fail on malformed values under
    ANSI mode.  Integers may be written ``0.0``; a fractional part fails.

    ``STRICT`` (by name): a row with more or fewer fields than the header
    stops the job, whatever columns the query reads.  The other modes are
    Spark's.
    Without ``by_name`` the schema is applied by position.
    """
    if not (by_name and header):
        return (spark.read.schema(schema).option("header", header)
                .option("mode", "FAILFAST" if mode == "STRICT" else mode).csv(path))
    reader = spark.read.option("header", True).option("inferSchema", False)
    if mode == "STRICT":  # without pruning the parser sees every field of every row
        reader = reader.option("columnPruning", False).option("mode", "FAILFAST")
    else:
        reader = reader.option("mode", mode)
    text = reader.csv(path)
    present = {c.lower(): c for c in text.columns}
    cols = []
    for f in schema:
        src = present.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f"`{src}`")
        if f.name in lenient and not isinstance(f.dataType, StringType):
            # through double so that "12.0" is accepted like an integral "12"
            c = c.try_cast("double").try_cast(f.dataType)
        elif isinstance(f.dataType, IntegralType):
            number = c.cast("double")
            whole_number = F.when(F.floor(number) == number, F.floor(number))
            c = F.when(c.isNotNull() & whole_number.isNull(), F.raise_error(
                F.concat(F.lit(f"{f.name} is no integer: "), c)).cast("bigint")).otherwise(whole_number).cast(f.dataType)
        else:
            c = c.cast(f.dataType)
        cols.append(c.alias(f.name))
    return text.select(*cols)


def read_runlog(spark: SparkSession, path: str) -> DataFrame:
    """Benchmark log ``percentuale,motore,analisi,tempo_secondi,status``."""
    return read_raw(spark, path, RUNLOG_SCHEMA)


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under a new path of the shared folder, and read from there."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tarmac_{name}_{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_clean(spark: SparkSession, path: str, merge_schema: bool = False,
               schema: StructType | None = None) -> DataFrame:
    """Parquet dataset or published volume, NaN read as null.

    With ``schema`` no footer is read to plan the scan: the columns and
    types are the declared ones.  A file that lacks a column gives nulls;
    one whose type cannot be read as the declared one stops the task that
    reads it with an error naming file, column and both types.  Without,
    the schema is that of one file, or with ``merge_schema`` that of all.
    """
    folder = current_run(spark, path) or path
    if schema is not None:
        return nan_as_null(spark.read.schema(schema).parquet(folder))
    return nan_as_null(spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(folder))


def nan_as_null(df: DataFrame) -> DataFrame:
    """NaN, pandas' missing value, becomes null in every floating column."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: nan_to_null(F.col(f"`{c}`")).cast(df.schema[c].dataType) for c in floating})


def require_non_empty(df: DataFrame, what: str = "input") -> DataFrame:
    """Fail fast on an empty input.  ``isEmpty`` runs a limit-1 job."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty or holds no readable rows")
    return df


def volume_label(path: str) -> str:
    """Volume suffix of an input path: ``.../dataset_50.parquet`` -> ``50``."""
    base = path.rstrip("/").rsplit("/", 1)[-1]
    base = re.sub(r"\.parquet$", "", base)
    return base.rsplit("_", 1)[-1]


#: Partitions of the exchange before a split.
SPLIT_PARTITIONS = 1_000
_RUNS, _MANIFEST = "run-", "_manifest"


def current_run(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest complete run of a published volume; None if ``path`` was not published."""
    try:
        entries = spark.read.schema("value string").text(f"{path.rstrip('/')}/{_MANIFEST}")
        newest = entries.agg(F.max("value")).first()[0]
    except AnalysisException:  # no manifest: a plain dataset
        return None
    return f"{path.rstrip('/')}/{newest.split()[1]}" if newest else None


def write_volume(df: DataFrame, base: str, label, mode: str = "overwrite",
                 partition_by: list[str] | None = None) -> str:
    """Publish one volume as the Parquet dataset ``<base>/dataset_<label>``.

    The files go to a new run folder of the volume.  Only when they are
    complete a line of the volume's manifest names the run, as one small
    file that appears whole; ``read_clean`` and the jobs read the run named
    last.  A write that fails midway leaves the volume as it was, and what
    reads the old run goes on reading it.  The files of runs before the last
    two are removed.  ``append`` keeps the rows of the run before.
    """
    spark, path = df.sparkSession, f"{base.rstrip('/')}/dataset_{label}"
    before = current_run(spark, path)
    if mode == "append" and before:
        df = spark.read.parquet(before).unionByName(df, allowMissingColumns=True)
    run = f"{_RUNS}{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/{run}")
    lines = [r[0] for r in spark.read.text(f"{path}/{_MANIFEST}").collect()] if before else []
    number = max((int(x.split()[0]) for x in lines), default=0) + 1
    line = spark.createDataFrame([(f"{number:012d} {run}",)], "value string")
    line.coalesce(1).write.mode("append").text(f"{path}/{_MANIFEST}")
    for old in sorted(lines)[:-1]:
        _empty(spark, f"{path}/{old.split()[1]}")
    return path


def _empty(spark: SparkSession, folder: str) -> None:
    """Take the files of a folder away."""
    spark.range(0).write.mode("overwrite").parquet(folder)


def write_report(df: DataFrame, path: str, single_file: bool = False, sep: str = ",",
                 null_value: str = "", header: bool = True, mode: str = "overwrite") -> str:
    """Delimited text report with a header.

    ``single_file``: the report is computed, sorted and written in parallel
    to the shared folder, without headers; the finished parts are then
    joined as bytes, in order, behind one header (``merge_parts``).
    """
    spark = df.sparkSession
    target = f"{checkpoint_dir(spark).rstrip('/')}/tarmac_report_{uuid.uuid4().hex}" if single_file else path
    (df.write.mode("overwrite" if single_file else mode).option("header", header and not single_file).option("sep", sep)
        .option("nullValue", null_value).option("emptyValue", "").csv(target))
    if single_file:
        names = [f'"{c}"' if sep in c or '"' in c else c for c in df.columns]
        merge_parts(spark, target, path, sep.join(names) + "\n" if header else "", mode)
    return path


def merge_parts(spark: SparkSession, parts: str, path: str, header: str = "", mode: str = "overwrite") -> str:
    """Join the part files of ``parts``, in name order, into one CSV file of the folder ``path``.

    The bytes are copied through the Hadoop file API in buffers of 1 MB, so
    neither a Spark job nor memory grows with the number of parts.  The file
    gets its name when it is complete.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    source, folder = hadoop.fs.Path(parts), hadoop.fs.Path(path)
    files, to = source.getFileSystem(conf), folder.getFileSystem(conf)
    if to.exists(folder):
        if mode in ("error", "errorifexists"):
            raise FileExistsError(path)
        if mode == "ignore":
            return path
        if mode == "overwrite":
            to.delete(folder, True)
    name = f"part-00000-{uuid.uuid4().hex}.csv"
    unfinished = hadoop.fs.Path(folder, f"_{name}")
    out = to.create(unfinished)
    try:
        out.write(bytearray(header.encode()))
        for part in sorted(str(s.getPath()) for s in files.listStatus(source) if s.getPath().getName().startswith("part-")):
            data = files.open(hadoop.fs.Path(part))
            try:
                hadoop.io.IOUtils.copyBytes(data, out, 1 << 20, False)
            finally:
                data.close()
    finally:
        out.close()
    to.rename(unfinished, hadoop.fs.Path(folder, name))
    to.create(hadoop.fs.Path(folder, "_SUCCESS")).close()
    return path


def write_split(df: DataFrame, path: str, keys: list[str], fmt: str = "csv",
                mode: str = "overwrite", header: bool = True) -> str:
    """U4: one output folder per value of ``keys`` (``key=value/``).

    Rows are rebalanced by the keys first: adaptive execution gathers small
    values in few tasks, so each makes one file, and splits a value larger
    than ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` over several
    tasks, so a hot one makes several files and none is written by one task.
    The exchange has ``SPLIT_PARTITIONS`` partitions at least (small ones are
    joined again), so that few values share one with a hot value.
    """
    wide = max(SPLIT_PARTITIONS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    writer = df.hint("rebalance", wide, *keys).write.mode(mode).partitionBy(*keys)
    if fmt == "csv":
        writer = writer.option("header", header)
    writer.format(fmt).save(path)
    return path
