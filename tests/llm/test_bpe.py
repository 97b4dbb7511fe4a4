import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from tarmac.llm import bpe
from tarmac.llm.common import ship
from tests.conftest import SF_SMALL
from tests.llm.odd import ODD, empty_docs, odd_docs

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Library.from_file(PATH)


def brute_force(word, ranks):
    """Merge the pair of lowest rank, leftmost first, until none is left."""
    parts = [*word[:-1], word[-1] + bpe.WORD_END]
    while True:
        pairs = [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        if not pairs:
            return parts
        rank, i = min(pairs)
        parts[i:i + 2] = ["".join(parts[i:i + 2])]


def test_automaton_equals_merging_for_random_merge_lists():
    rng = random.Random(3)
    for _ in range(60):
        symbols = ["a", "b", "c", "a" + bpe.WORD_END, "b" + bpe.WORD_END, "c" + bpe.WORD_END]
        tokens, merges = list(symbols), []
        for _ in range(25):
            u, v = rng.choice([t for t in tokens if not t.endswith(bpe.WORD_END)]), rng.choice(tokens)
            if u + v not in tokens:
                merges.append((u, v))
                tokens.append(u + v)
        vocab = {t: i for i, t in enumerate(tokens)}
        automaton = bpe.TokenAutomaton(vocab, merges)
        ranks = {m: i for i, m in enumerate(merges)}
        for _ in range(60):
            word = "".join(rng.choice("aabc") for _ in range(rng.randint(1, 14)))
            assert [automaton.label[i] for i in automaton.encode(word)] == brute_force(word, ranks)


def test_merge_lists_that_are_no_tree_are_refused():
    vocab = {t: i for i, t in enumerate(["a", "b", "ab", "aba"])}
    with pytest.raises(ValueError):
        bpe.TokenAutomaton(vocab, [("ab", "a"), ("a", "b")])


def test_equals_the_library_on_documents_and_odd_texts(spark, library):
    ship(spark)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(odd_docs(spark).select("doc_id", "text"))
    got = docs.select("text").distinct().withColumnRenamed("text", "doc_id")
    got = bpe.encode_decode(got.selectExpr("doc_id", "doc_id as text"), PATH).collect()
    assert len(got) > 150
    for row in got:
        want = library.encode(row["doc_id"] or "", add_special_tokens=False).ids
        assert np.frombuffer(row["ids"], "<u4").tolist() == want
        assert row["decoded"] == library.decode(want, skip_special_tokens=False)


def test_odd_rows_and_empty_table(spark):
    ship(spark)
    got = bpe.digests(bpe.encode_decode(odd_docs(spark), PATH), "doc_id").collect()
    assert len(got) == len(ODD)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[2]["n_tokens"] == by_id[3]["n_tokens"] == by_id[4]["n_tokens"] == 0
    assert by_id[8]["n_tokens"] > 40000
    assert bpe.digests(bpe.encode_decode(empty_docs(spark), PATH), "doc_id").count() == 0
