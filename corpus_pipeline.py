"""Training-data pipeline: quality, toxicity, near duplicates, mixing, tokens.

Each stage takes ``(spark, docs, sf_dir)`` with the columns of
``documents`` and returns a frame that is written and read again as the
next one's ``docs``.  ``sf_dir`` is read for the labels of the two
classifiers only.  Null and empty texts, null ids, repeated rows, empty
tables and extra columns pass as each operator defines; all columns are
kept up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import bpe, minhash, mixing, quality, toxicity
from tarmac.llm.common import materialise, read_table, ship

#: Epochs of a source at most; the largest source is taken once, so no document is lost.
MAX_REPETITION = 1.5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier does not reject."""
    ship(spark)
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return docs.filter(quality.scorer(docs, model)(F.col("text")) >= quality.CUT)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the convolutional classifier does not reject."""
    ship(spark)
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.scorer(docs, model)(F.col("text")) < toxicity.CUT)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at similarity 0.8."""
    ship(spark)
    return minhash.deduplicate(docs, words=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated so that the sources have their weights."""
    return mixing.mixture(docs, mixing.plan(docs, max_repetition=MAX_REPETITION))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, as little-endian unsigned 32-bit integers, with their digests."""
    import public_tokenizers

    ship(spark)
    encoded = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return bpe.digests(encoded, "doc_id", "ids")


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: Two stages apply trained classifiers, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next one."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
