import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarmac.llm import quality, registry, toxicity
from tarmac.llm import words as W
from tarmac.llm.common import ship
from tests.llm.odd import ODD, empty_docs, odd_docs

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("key, label, modulus, remainder, least", [
    ("op3_toxicity", "toxic", 3, 1, 0.97), ("op9_quality", "quality", 5, 0, 0.97)])
def test_held_out_accuracy(spark, key, label, modulus, remainder, least):
    got = registry.QUERIES[key](spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    cut = {"op3_toxicity": 0.7, "op9_quality": 0.3}[key]
    rows = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "left").join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == remainder)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= cut)
    # in this table the toxic texts of other languages hold no word that tells them
    held = [r for r in rows if r["held_out"] and r[label] is not None and (label != "toxic" or r["lang"] == "en")]
    assert len(held) > 100
    assert np.mean([r["predicted"] == r[label] for r in held]) >= least


@pytest.mark.parametrize("module, column", [(toxicity, "toxic"), (quality, "quality")])
def test_odd_rows_empty_tables_and_missing_labels(spark, module, column):
    ship(spark)
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in (1, 2, 3, 5, 7, 8, 9, 10)] + [(None, 1), (99, 1), (4, None)],
                                   f"doc_id long, {column} int")
    for some_labels in (labels, labels.filter(F.lit(False))):
        model = module.fit(docs, some_labels)
        got = module.score(docs, model).collect()
        assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
        by_text = {}
        for r in docs.withColumn("s", module.scorer(docs, model)(F.col("text"))).collect():
            by_text.setdefault(r["text"] or "", set()).add(r["s"])
        assert all(max(s) - min(s) < 1e-5 for s in by_text.values())  # the score depends on the text alone
        assert module.score(empty_docs(spark), model).count() == 0
    assert module.score(docs, module.fit(empty_docs(spark), labels)).count() == len(ODD)


def test_one_toxic_word_deep_in_a_long_text_counts():
    clean = ["the river runs to the sea and back " * n for n in range(1, 60)]
    toxic = [t.replace("sea", "sea grobnik", 1) for t in clean]
    model = toxicity.train(clean + toxic, np.array([0] * 59 + [1] * 59), epochs=12)
    long = "the river runs to the sea and back " * 2000
    z, language = toxicity._scores(model, [long, long + "grobnik " + long])
    assert z[0] < model.thresholds[language[0]] < z[1]


def test_chunks_do_not_change_scores():
    texts = ["one two three", "", "grobnik", "the of and " * 50, "Ünï " * 7]
    model = toxicity.train(texts * 10, np.array([0, 0, 1, 0, 0] * 10), epochs=2)
    whole = toxicity._scores(model, texts)[0]
    each = np.concatenate([toxicity._scores(model, [t])[0] for t in texts])
    assert np.allclose(whole, each, atol=1e-5)


def test_prior_estimate_and_non_negative_risk():
    rng = np.random.default_rng(0)
    positive = rng.normal(1.5, 1, (3000, 4))
    unlabelled = np.concatenate([rng.normal(1.5, 1, (1800, 4)), rng.normal(-1.5, 1, (1200, 4))])
    model = quality.train(positive, unlabelled, epochs=30)
    assert abs(model.prior - 0.6) < 0.1
    assert model.score(rng.normal(1.5, 1, (500, 4))).mean() > 0.85 > 0.3 > model.score(rng.normal(-1.5, 1, (500, 4))).mean()


def test_features_of_single_texts_equal_those_of_a_batch():
    texts = ["A b a b.", "", "WHY!! NOT!!\nline\nline\n", "é | é | é", " "]
    batch = quality.features(*W.buffers(pa.array(texts)))
    for i, t in enumerate(texts):
        assert np.allclose(batch[i], quality.features(*W.buffers(pa.array([t])))[0])


def test_every_labelled_row_trains(spark, monkeypatch):
    ship(spark)
    ids = spark.range(6400).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    # the toxic word of the labels that come last by the hash of the id is another one than that of the first 2,500
    order = [r["doc_id"] for r in ids.filter("toxic = 1").orderBy(F.xxhash64("doc_id", F.lit(17))).collect()]
    late = spark.createDataFrame([(i,) for i in order[2500:]], "doc_id long").withColumn("late", F.lit(True))
    word = F.when(F.col("toxic") == 0, "").when(F.col("late"), " zlobnik").otherwise(" grobnik")
    docs = ids.join(late, "doc_id", "left").select("doc_id", F.concat(F.lit("the river runs to the sea"), word).alias("text"))
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 1600, raising=False)  # several shards
    model = toxicity.fit(docs, ids)
    got = {r["text"].split()[-1]: r["s"] for r in docs.withColumn("s", toxicity.scorer(docs, model)(F.col("text"))).collect()}
    assert got["sea"] < toxicity.CUT <= min(got["grobnik"], got["zlobnik"])
    # repeated rows of documents and of labels count once
    rows = toxicity.labelled(docs.union(docs), ids.union(ids), "toxic")
    assert rows.count() == rows.select("doc_id").distinct().count() == 6400 and rows.select("_shard").distinct().count() > 2
