"""Reproducible sampled and enlarged volumes of the clean table.

The draw is a function of the rows' content and the seed alone, so the same
rows come out of any file layout, partitioning or retry.  Of ``m`` equal
rows a share ``f`` keeps ``floor(m * f)`` and possibly one more.  The rows
that get one more are those with the smallest ``hash / fraction``; with
``exact`` (the default) as many as make the volume ``round(n * f)`` rows,
else those whose hash lies below their fraction.

Whole rows are never exchanged.  What is shuffled is a 128-bit digest per
row, counted with map-side sums (``digests``).  A row whose digest occurs
once is decided where it stands, by its hash.  For a digest that occurs more
often a small table says how many copies to keep and names the one stored
row that writes them out; if they are many, a row in every file that holds
the digest writes its file's share.  So a hot group of copies is cut in
proportion, by many tasks.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.schema import SAMPLE_SEED, VOLUME_PERCENTS
from tarmac.sources.io import scratch_table, write_volume

#: Shares are counted in units of 1 / PARTS.
PARTS = 10_000
#: Copies of one row that a single stored row writes at most.
CHUNK = 1 << 16
#: Repeated digests that are broadcast; more of them are joined as Catalyst chooses.
BROADCAST_ROWS = 2_000_000
_RANGE = 1 << 16
#: Rows of one class of scores that are ordered at once; larger classes are divided first.
CLASS_ROWS = 100_000


def row_key(columns: Iterable[str], seed: int = SAMPLE_SEED) -> Column:
    """md5 over the text of all columns, as 16 bytes; null has a text of its own."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\N")) for c in columns]
    return F.unhex(F.md5(F.concat_ws("|", *parts, F.lit(str(seed)))))


def _located(df: DataFrame, seed: int) -> DataFrame:
    """Rows with ``_key`` and their place, ``_file`` and ``_row``, in the Parquet files they are read from."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns], row_key(df.columns, seed).alias("_key"),
                     F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def stored(df: DataFrame) -> DataFrame:
    """``df`` itself if it is read from Parquet files, else written to the shared folder and read again."""
    try:
        df.select("_metadata.file_path", "_metadata.row_index")
        return df
    except AnalysisException:
        return scratch_table(df, "volume_input")


def digests(df: DataFrame, seed: int = SAMPLE_SEED) -> DataFrame:
    """``_key``, ``_m`` and, if a row occurs more than once, the smallest ``_place`` of its rows.

    The exchange carries 40 bytes a row at most, and one partial sum for all
    equal rows of a task.  Places are single numbers, so Spark adds the rows
    up by hash and sorts none.
    """
    same = _located(df, seed).groupBy("_key").agg(F.count(F.lit(1)).alias("_m"), F.min(_place()).alias("_place"))
    return same.withColumn("_place", F.when(F.col("_m") > 1, F.col("_place")))


def _place() -> Column:
    """64-bit hash of a row's file and number; only equal rows are told apart by it."""
    return F.xxhash64("_file", "_row")


def _score(part: Column) -> Column:
    """48 bits of ``hash / fraction``, null without a fraction."""
    hashed = F.conv(F.hex(F.substring("_key", 1, 4)), 16, 10).cast("double")
    return F.when(part > 0, F.floor(hashed / part.cast("double") * float(_RANGE)))


def _cut(counts: dict[int, int], wanted: int) -> tuple[int, int]:
    """First class at which ``wanted`` rows are reached, and the rows before it."""
    before = 0
    for value in sorted(counts):
        if before + counts[value] >= wanted:
            return value, before
        before += counts[value]
    raise AssertionError("fewer rows than wanted")


def _histogram(rows: DataFrame, value: Column) -> dict[int, int]:
    return {r["v"]: r["n"] for r in rows.groupBy(value.alias("v")).agg(F.count(F.lit(1)).alias("n")).collect()}


def _last_taken(rows: DataFrame, parts: int) -> tuple[int, bytes | None]:
    """The last score, and its last key, that gets one more copy in a volume of exact size."""
    share = F.col("_m") * F.lit(parts)
    rows = rows.withColumns({"_base": F.floor(share / PARTS), "_score": _score(share % PARTS)})
    # one pass gives the size and a histogram of at most 65,536 classes, and null: digests without a fraction
    classes = rows.groupBy(F.shiftright("_score", 32).alias("v")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_m").alias("m"), F.sum("_base").alias("base")).collect()
    n, base = (sum(c[name] for c in classes) for name in ("m", "base"))
    wanted = (2 * n * parts + PARTS) // (2 * PARTS) - base  # round half up
    if wanted <= 0:
        return -1, None
    counts = {c["v"]: c["n"] for c in classes if c["v"] is not None}
    scored = rows.filter("_score is not null")
    inside, taken = scored, 0
    for shift in (32, 16, 0):  # until the class that holds the last row is small, or one score
        value = F.shiftright("_score", shift).bitwiseAND(0xFFFFFFFF if shift == 32 else 0xFFFF)
        if shift < 32:
            counts = _histogram(inside, value)
        edge, before = _cut(counts, wanted - taken)
        inside, taken = inside.filter(value == edge), taken + before
        if counts[edge] <= CLASS_ROWS:
            break
    last = inside.select("_score", "_key").orderBy("_score", "_key").limit(wanted - taken).agg(
        F.max(F.struct("_score", "_key")).alias("last")).first()["last"]
    return last["_score"], bytes(last["_key"])


def _copies(m: Column, parts: int, last: tuple[int, bytes | None] | None) -> Column:
    """Copies kept of ``m`` equal rows; ``last`` as from ``_last_taken``, None for independent draws."""
    share = m * F.lit(parts)
    score = _score(share % PARTS)
    if last is None:
        more = score < float(_RANGE) * float(1 << 32) / PARTS
    else:
        edge, key = last
        more = score < edge
        if key is not None:
            more = more | ((score == edge) & (F.col("_key") <= F.lit(key)))
    return F.floor(share / PARTS) + F.coalesce(more, F.lit(False)).cast("bigint")


def _bounded(df: DataFrame) -> DataFrame:
    """Broadcast after a check of the size; a larger table is left to Catalyst."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _shares(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """``_key, _file, _row, _copies``: what each file's first row writes of a digest with many copies."""
    held = rows.select("_key", "_file", "_row").join(_bounded(hot), "_key").groupBy(
        "_key", "_file", "_m", "_kept").agg(F.count(F.lit(1)).alias("k"), F.min("_row").alias("_row"))
    until = F.sum("k").over(Window.partitionBy("_key").orderBy("_file")).cast("decimal(19,0)")  # a row per file
    at = F.expr("CAST(_kept AS DECIMAL(19,0)) * _until DIV _m")
    before = F.expr("CAST(_kept AS DECIMAL(19,0)) * (_until - k) DIV _m")
    return held.withColumn("_until", until).select("_key", "_file", "_row", (at - before).alias("_copies"))


def _taken(df: DataFrame, same: DataFrame, parts: int, seed: int, exact: bool) -> DataFrame:
    last = _last_taken(same, parts) if exact else None
    columns = [F.col(f"`{c}`") for c in df.columns]
    rows = _located(df, seed)
    repeated = same.filter("_m > 1").withColumn("_kept", _copies(F.col("_m"), parts, last))
    own = _place() == F.col("_place")
    hot = repeated.filter(F.col("_kept") > CHUNK)
    joined = rows.join(_bounded(repeated.select("_key", "_kept", "_place")), "_key", "left")
    copies = F.when(F.col("_kept").isNull(), _copies(F.lit(1).cast("bigint"), parts, last))
    if not hot.isEmpty():
        shares = _shares(rows, hot.select("_key", "_m", "_kept"))
        joined = joined.join(_bounded(shares.withColumnRenamed("_row", "_share_row")), ["_key", "_file"], "left")
        copies = copies.when(F.col("_kept") > CHUNK, F.when(F.col("_row") == F.col("_share_row"), F.col("_copies")))
    joined = joined.withColumn("_n", copies.when(own, F.col("_kept")).cast("int"))
    return joined.filter("_n >= 1").select(*columns, F.explode(F.sequence(F.lit(1), "_n")).alias("_copy")).drop("_copy")


def sample_volume(df: DataFrame, percent: float, seed: int = SAMPLE_SEED, exact: bool = True,
                  same: DataFrame | None = None) -> DataFrame:
    """P10: ``percent`` % of the rows, without replacement.

    ``exact``: ``round(n * percent / 100)`` rows (halves up), else the size
    is a sum of independent draws.  ``df`` should be read from Parquet files
    (their row numbers tell equal rows apart); any other frame is written to
    the shared folder first.  ``same`` may give ``digests(df, seed)`` as a
    written table, so that several volumes count the rows once.
    """
    if percent >= 100:
        return df
    parts = round(percent * PARTS / 100)
    if parts <= 0:
        return df.limit(0)
    df = stored(df)
    return _taken(df, scratch_table(digests(df, seed), "digests") if same is None else same, parts, seed, exact)


def scale_up(df: DataFrame, percent: float, seed: int = SAMPLE_SEED, exact: bool = True,
             same: DataFrame | None = None) -> DataFrame:
    """More than 100 %: all rows plus a sample of the excess share."""
    if percent <= 100:
        return sample_volume(df, percent, seed, exact, same)
    df = stored(df)
    whole, extra = divmod(percent, 100)
    out = df
    for _ in range(int(whole) - 1):
        out = out.unionByName(df)
    if extra:
        out = out.unionByName(sample_volume(df, extra, seed, exact, same))
    return out


def build_volumes(clean_df: DataFrame, base: str, percents: Iterable[float] = VOLUME_PERCENTS,
                  seed: int = SAMPLE_SEED, exact: bool = True) -> dict[int, str]:
    """Write every volume as ``<base>/dataset_<label>``.

    The rows are counted once for all volumes, in a table of the shared
    folder.  Each volume is published whole (``write_volume``): until then
    readers see the one before.
    """
    clean_df = stored(clean_df)
    percents = list(percents)
    partial = any(p % 100 for p in percents)
    same = scratch_table(digests(clean_df, seed), "digests") if partial else None
    return {int(p): write_volume(scale_up(clean_df, p, seed, exact, same), base, int(p)) for p in percents}

