from pyspark.sql import functions as F

from tarmac.llm import common


def test_batches_of_long_rows_are_bounded_in_bytes(spark):
    common.ship(spark)

    def sizes(batches):
        import pyarrow as pa
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    rows = spark.range(24).coalesce(1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
    got = [r["n"] for r in rows.mapInArrow(sizes, "n long").collect()]
    assert sum(got) >= 24 << 20 and max(got) <= 6 << 20


def test_long_rows_are_read_a_few_at_once_and_the_setting_goes_back(spark):
    key = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(key, None)
    with common.long_rows(spark, 3):
        assert spark.conf.get(key) == "3"
        read = common.materialise(spark, spark.range(10).coalesce(1), "few")
        assert read.count() == 10
    assert spark.conf.get(key, None) == before
