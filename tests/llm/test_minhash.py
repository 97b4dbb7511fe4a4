import random
import re

import numpy as np
from pyspark.sql import functions as F

from tarmac.llm import minhash
from tarmac.llm.common import ship
from tests.llm.odd import ODD, empty_docs, odd_docs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def classes(rows, size, percent=80):
    """Smallest reachable id by comparing all pairs."""
    sets = {i: shingle_set(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def groups_of_copies(seed, bases=4, copies=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(800)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    rows, i = [], 0
    for _ in range(bases):
        base = [rng.choice(vocabulary) for _ in range(120)]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 6, 9])):
                at = rng.randrange(len(words))
                kind = rng.random()
                if kind < 0.6:
                    words[at] = rng.choice(vocabulary)
                elif kind < 0.8:
                    del words[at]
                else:
                    words.insert(at, rng.choice(vocabulary))
            text = " ".join(words)
            rows.append((i, text if rng.random() < 0.7 else f"{text} {passage}"))
            i += 1
    rng.shuffle(rows)
    return rows


def test_components_equal_brute_force_on_groups_of_near_copies(spark):
    ship(spark)
    rows = groups_of_copies(1)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4).collect()
    want, sizes = classes(rows, 4)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert 4 < len(set(want.values())) < len(rows)


def test_odd_rows_and_empty_table(spark):
    ship(spark)
    got = minhash.near_duplicates(odd_docs(spark), words=4).collect()
    assert len(got) == len(ODD)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[5]["component_id"] == 1 and not by_id[5]["kept"] and by_id[1]["kept"]
    assert [by_id[i]["n_shingles"] for i in (2, 3, 4, 10)] == [0, 0, 0, 1]
    assert all(by_id[i]["component_id"] == i and by_id[i]["kept"] for i in (2, 3, 4, 7, 8, 9, 10))
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    assert minhash.near_duplicates(empty_docs(spark), words=4).count() == 0


def test_deduplicate_keeps_columns_and_one_of_each(spark):
    ship(spark)
    docs = odd_docs(spark, [*ODD, ODD[0]])
    left = minhash.deduplicate(docs, words=5)
    assert left.columns == docs.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert ids.count(1) == 1 and 5 not in ids and None in ids and len(ids) == len(ODD) - 2
    assert minhash.deduplicate(empty_docs(spark)).count() == 0


def test_sketch_estimates_similarity_and_fills_every_coordinate():
    rng = np.random.default_rng(2)
    pool = rng.integers(1, 1 << 62, 3000).astype(np.uint64)
    for share in (0.2, 0.5, 0.8):
        common = int(1000 * 2 * share / (1 + share))
        a, b = pool[:1000], pool[1000 - common: 2000 - common]
        s = minhash.sketches(np.concatenate([a, b]), np.array([0, 1000, 2000]), 1024)
        assert abs((s[0] == s[1]).mean() - share) < 0.07
    tiny = minhash.sketches(pool[:1], np.array([0, 1, 1]), 252)
    assert (tiny[0] != minhash._FULL).all() and (tiny[1] == minhash._FULL).all()


def test_components_of_long_chains(spark):
    from tarmac.llm.components import components
    edges = [(i, i + 1) for i in range(300)] + [(500, 499), (7, 7), (None, 3)]
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b")
    roots = {r["node"]: r["root"] for r in got.collect()}
    assert all(roots[i] == 0 for i in range(1, 301)) and roots[500] == 499 and 0 not in roots
    assert components(got.filter(F.lit(False)), "node", "root").count() == 0


def test_bucket_keys_are_not_counted_before_they_meet(spark):
    entries = spark.createDataFrame([(1, 7), (2, 7), (2, 8), (3, 9), (3, 9), (4, 7)], "id long, key long")
    met = minhash._met(entries)
    assert sorted(tuple(r) for r in met.select("key", "id", "n").collect()) == [(7, 1, 3), (7, 2, 3), (7, 4, 3)]
    plan = met._jdf.queryExecution().sparkPlan().toString()
    kinds = [line.strip(" :+-*()0123456789").split("(")[0].split()[0] for line in plan.splitlines() if line.strip()]
    at = max(i for i, k in enumerate(kinds) if k == "HashAggregate")
    assert kinds.count("HashAggregate") == 2 and "Exchange" in kinds[at:]  # both below the join, above the exchange
