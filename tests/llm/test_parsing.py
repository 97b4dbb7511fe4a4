import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import parsing
from tarmac.llm.common import ship
from tests.conftest import SF_SMALL
from tests.llm.odd import LONG, empty_docs, odd_docs


def brute_force(rows):
    """Edited texts of rows in id order."""
    out = {}
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        k = len(text) // 4
        out[i] = (len(text), hashlib.sha256((text[: len(text) - k] + after[:k]).encode()).hexdigest())
    return out


@pytest.mark.parametrize("parts", [1, 8, 31])
def test_edited_texts_equal_brute_force_for_any_partitioning(spark, parts):
    ship(spark)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(5)
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect())
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = parsing.edited_fingerprints(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == brute_force(rows)
    own = {r["doc_id"]: r["fingerprint"] for r in parsing.fingerprint(docs).collect()}
    texts = dict(rows)
    by_text = {}
    for r in got:
        assert own[r["doc_id"]] == r["fingerprint"]
        assert by_text.setdefault(texts[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    long = [r for r in got if r["n_chars"] > 300]
    assert np.mean([r["near_edited"] for r in long]) > 0.6 > 0.1 > np.mean([r["near_next"] for r in long])


def test_equal_substrings_share_interior_names_at_any_offset():
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefgh ,é") for _ in range(6000)).encode()
    for shift in (b"", b"x", b"some other beginning ", text[:777]):
        symbols = np.frombuffer(shift + text, np.uint8)
        plain, moved = np.frombuffer(text, np.uint8), symbols
        a, b = np.array([0, len(plain)]), np.array([0, len(moved)])
        for level in range(1, 5):
            plain, a = parsing.parse_level(plain, a, level)
            moved, b = parsing.parse_level(moved, b, level)
            inner = plain[12:]  # the names behind the first few
            assert (moved[-len(inner):] == inner).all(), (level, shift[:5])


def test_neighbouring_labels_differ_and_phrases_are_short():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 4, 5000).astype(np.uint8)
    names, offsets = parsing.parse_level(symbols, np.array([0, 2000, 2000, 5000]), 1)
    assert offsets[1] == offsets[2] and offsets[-1] == len(names)
    runs = 1 + (np.diff(symbols) != 0).sum()
    assert runs / 13 < len(names) < runs / 2 + 3
    assert len(parsing.parse_level(np.zeros(100, np.uint8), np.array([0, 100]), 1)[0]) == 1


def test_odd_rows_and_empty_table(spark):
    ship(spark)
    got = parsing.edited_fingerprints(odd_docs(spark)).collect()
    assert len(got) == 11
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[2]["fingerprint"] == "" == by_id[3]["fingerprint"] and by_id[2]["near_next"] == 1.0
    assert by_id[8]["n_chars"] == len(LONG) and by_id[1]["fingerprint"] == by_id[5]["fingerprint"]
    assert by_id[10]["near_edited"] == 1.0
    assert parsing.edited_fingerprints(empty_docs(spark)).count() == 0
    one = odd_docs(spark).filter("doc_id = 1")
    assert [r["near_next"] for r in parsing.edited_fingerprints(one).collect()] == [1.0]


def test_likeness_has_no_jump_at_any_length():
    """The first three quarters stay: about 0.75 of the names are shared, whatever the length."""
    rng = random.Random(4)
    words = ["".join(rng.choice("aeinorstdl") for _ in range(rng.randrange(2, 9))) for _ in range(900)]
    got = {}
    for size in range(40, 801):
        text, other = ((" ".join(rng.choice(words) for _ in range(400)))[:size].encode() for _ in range(2))
        k = size // 4
        edited = text[: size - k] + other[:k]
        sketch, sizes = parsing._of_texts([text, edited, other])
        got[size] = parsing._likeness(sketch[:1], sketch[1:2], sizes[:1], sizes[1:2])[0]
        assert parsing._likeness(sketch[:1], sketch[:1], sizes[:1], sizes[:1])[0] == 1
        if size >= 200:
            assert parsing._likeness(sketch[:1], sketch[2:], sizes[:1], sizes[2:])[0] < 0.5
    assert min(got.values()) >= 0.4, min(got, key=got.get)
    means = [np.mean([got[s] for s in range(a, a + 60)]) for a in range(40, 740, 60)]
    assert min(means) > 0.6 and max(abs(a - b) for a, b in zip(means, means[1:])) < 0.1, means


def test_many_rows_of_one_id_fill_many_ranges(spark):
    ship(spark)
    rows = [(7, f"text number {i} of the same id, with some words of its own {i * i}") for i in range(200)]
    rows += [(None, f"no id {i}") for i in range(100)] + [(7, "equal rows")] * 150 + [(9, "the last one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = parsing.edited_fingerprints(docs)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    got = got.collect()
    assert len(got) == len(rows) and max(sizes) < len(rows) / 3
    assert sorted(r["n_chars"] for r in got) == sorted(len(t) for _, t in rows)
    last = [r for r in got if r["doc_id"] == 9]
    assert len(last) == 1 and last[0]["n_chars"] == 12


def test_fingerprints_do_not_depend_on_the_batch():
    texts = [b"x", b"", b"The quick brown fox", "é".encode() * 30, b"ab " * 40, LONG.encode(), b"x"]
    whole = parsing._of_texts(texts)[0]
    for i, t in enumerate(texts):
        if t:
            assert (whole[i] == parsing._of_texts([t])[0][0]).all()
