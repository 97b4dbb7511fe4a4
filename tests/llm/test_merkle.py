import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tarmac.llm import merkle
from tarmac.llm.common import ship
from tarmac.llm.registry import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.odd import empty_docs, odd_docs

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """Root and, for every leaf, its siblings (left, right) level by level."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(places):
            run = nodes[at // 3 * 3: at // 3 * 3 + 3]
            paths[i].append((run[: at % 3], run[at % 3 + 1:]))
        places = [at // 3 for at in places]
        nodes = [sha("".join(nodes[i: i + 3])) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def brute_force(rows):
    """``(doc_id, leaf, subroot, root, proof, folded, verified)`` of rows in the order of ``COLUMNS``."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(groups[s], key=lambda x: x[:3]),) for s in names}
    trees = {s: (g, *climb([x[2] for x in g])) for s, (g,) in trees.items()}
    root, tops = climb([trees[s][1] for s in names]) if names else (None, [])
    out = []
    for s, top in zip(names, tops):
        group, subroot, paths = trees[s]
        for (_, _, own, r), path in zip(group, paths):
            path = path + top
            tampered = zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 2 == 0
            text = r[4].replace("\n", "") if tampered and r[4] is not None else r[4]
            node = leaf((*r[:4], text))
            for left, right in path:
                node = sha("".join([*left, node, *right]))
            proof = sha("".join(h for left, right in path for h in [*left, *right]))
            out.append((r[0], own, subroot, root, proof, node, node == root))
    return out


def query(docs):
    tampered = F.when(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2 == 0,
                      F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.summary(docs, COLUMNS, {"text": tampered})


def rows_of(frame):
    return sorted((tuple(r) for r in frame.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def test_documents_equal_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(*COLUMNS).collect()]
    got = rows_of(QUERIES["op13_merkle"](spark, SF_SMALL))
    assert got == sorted(brute_force(rows), key=str)
    assert 0 < sum(r[-1] for r in got) < len(got)


@pytest.mark.parametrize("sizes", [[1], [1, 1], [2, 3, 4], [81], [82, 1, 3], [800, 9, 81, 244], [1] * 100])
def test_groups_of_any_size_over_several_stored_levels(spark, sizes, monkeypatch):
    ship(spark)
    monkeypatch.setattr(merkle, "LEVELS", 2 if sum(sizes) > 400 else 4)  # more stored levels
    monkeypatch.setattr(merkle, "SPAN", merkle.ARITY ** merkle.LEVELS)
    rows = [(i, f"s{j}" if j else None, "en", i, f"text\n{i}" if i % 5 else None)
            for j, n in enumerate(sizes) for i in range(j, j + n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(6)
    assert rows_of(query(docs)) == sorted(brute_force(rows), key=str)


def test_odd_rows_hot_source_and_repeats(spark):
    ship(spark)
    docs = odd_docs(spark).withColumns({"lang": F.lit(None).cast("string"), "n_chars": F.lit(3).cast("long"),
                                        "grp": F.lit("x"), "node": F.lit(1), "path": F.lit("p")})
    docs = docs.unionByName(docs.filter("doc_id = 5").crossJoin(spark.range(150)).drop("id").withColumn("id", F.lit("a")))
    rows = [tuple(r) for r in docs.select(*COLUMNS).collect()]
    assert rows_of(query(docs)) == sorted(brute_force(rows), key=str)


def test_empty_table(spark):
    ship(spark)
    docs = empty_docs(spark).withColumns({"lang": F.lit("x"), "n_chars": F.lit(3)})
    assert rows_of(query(docs)) == []
