import math

import pytest
from pyspark.sql import functions as F

from tarmac.llm import mixing
from tests.llm.odd import ODD, empty_docs, odd_docs


def sources(spark, tokens):
    return spark.createDataFrame(list(tokens.items()), "src string, tokens long")


def test_exponent_meets_the_repetition_limit_and_the_entropy(spark):
    tokens = {"big": 10000, "mid": 1500, "low": 200, "none": 0}
    a = mixing.exponent(sources(spark, tokens), max_repetition=3.0)
    assert abs((200 / 10000) ** (a - 1) - 3.0) < 1e-5
    a = mixing.exponent(sources(spark, tokens), max_repetition=None, target_entropy=0.9)
    w = [n ** a for n in tokens.values() if n]
    w = [x / sum(w) for x in w]
    assert abs(-sum(x * math.log(x) for x in w) - 0.9) < 1e-5
    assert mixing.exponent(sources(spark, tokens), max_repetition=1000.0) == 0.0
    assert mixing.exponent(sources(spark, {}), max_repetition=2.0) == 1.0
    with pytest.raises(ValueError):
        mixing.exponent(sources(spark, tokens), max_repetition=None)


def brute_force(rows, plan):
    """Copies of every row by walking each source's permutation."""
    copies = {}
    for src, p in plan.items():
        own = [r for r in rows if r["src"] == src]
        left = math.floor((p["repetition"] - math.floor(p["repetition"])) * p["tokens"])
        by_block = {}
        for r in own:
            copies[r["doc_id"]] = p["epochs"]
            by_block.setdefault(r["key"] % p["blocks"], []).append(r)
        for block in sorted(by_block):
            n = sum(r["n"] for r in by_block[block])
            if n <= left:
                left -= n
                for r in by_block[block]:
                    copies[r["doc_id"]] += 1
                continue
            for r in sorted(by_block[block], key=lambda r: r["key"]):
                if r["n"] > left:
                    break
                left -= r["n"]
                copies[r["doc_id"]] += 1
            break
    return copies


def test_copies_equal_brute_force_and_meet_the_budget(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 64)
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.col("id") % 9 + 2), lambda k: F.concat(F.lit("w"), k))).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 11)).alias("source"))
    table = mixing.plan(docs, max_repetition=1.8)
    plan = {r["src"]: r for r in table.collect()}
    assert max(r["repetition"] for r in plan.values()) == pytest.approx(1.8, abs=1e-4)
    assert plan["hot"]["repetition"] == pytest.approx(1.0)
    rows = docs.select("doc_id", F.col("source").alias("src"), mixing.n_tokens().alias("n"),
                       mixing._key("doc_id", "text", mixing.SEED).alias("key")).collect()
    got = {r["doc_id"]: r["copies"] for r in mixing.decide(docs, table).select("row.doc_id", "copies").collect()}
    assert got == brute_force(rows, plan)
    for src, p in plan.items():
        taken = sum(r["n"] * got[r["doc_id"]] for r in rows if r["src"] == src)
        assert p["repetition"] * p["tokens"] - 12 <= taken <= p["repetition"] * p["tokens"] + 1e-3
    mixed = mixing.mixture(docs, table)
    assert mixed.columns == docs.columns and mixed.count() == sum(got.values())


def test_given_budget_can_leave_rows_out(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"),
                                   (F.col("id") % 2).cast("string").alias("source"))
    table = mixing.plan(docs, max_repetition=2.0, budget=800.0)
    assert abs(mixing.mixture(docs, table).count() - 200) <= 2


def test_odd_rows_and_empty_table(spark):
    docs = odd_docs(spark)
    mixed = mixing.mixture(docs, mixing.plan(docs, max_repetition=2.0))
    assert mixed.columns == docs.columns
    assert {r["doc_id"] for r in mixed.collect()} == {r[0] for r in ODD}
    empty = empty_docs(spark)
    assert mixing.mixture(empty, mixing.plan(empty)).count() == 0
