import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import hashing
from tarmac.llm.common import ship

SCHEMA = "vec_id long, embedding array<float>, id int, score int, rank int"


def brute_force(rows, k, asks):
    x = {}
    for i, v in rows:
        if i is not None and v and all(e is not None and np.isfinite(e) for e in v) and any(v):
            x[i] = np.array(v, np.float32).astype(float)
    ids = np.array(sorted(x))
    m = np.stack([x[i] for i in ids])
    out = {}
    for q in ids:
        if asks(q):
            score = m @ x[q]
            own = ids != q
            order = np.lexsort((ids[own], -score[own]))[:k]
            out[int(q)] = list(zip(ids[own][order].tolist(), score[own][order]))
    return out


def found(spark, rows, k=20, every=20):
    ship(spark)
    frame = spark.createDataFrame([(i, v, 0, 0, 0) for i, v in rows], SCHEMA)
    out = {}
    for r in hashing.nearest(frame, F.col("vec_id") % every == 0, k).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("scale", [False, True])
def test_recall_and_scores(spark, scale, monkeypatch):
    monkeypatch.setattr(hashing, "BLOCK_ROWS", 700)
    rng = np.random.default_rng(1)
    x = rng.standard_normal((2500, 32)) + rng.standard_normal((9, 32))[rng.integers(0, 9, 2500)]
    if scale:
        x *= rng.uniform(0.2, 3, (2500, 1))
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]
    got, want = found(spark, rows), brute_force(rows, 20, lambda q: q % 20 == 0)
    assert got.keys() == want.keys()
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want]
    assert np.mean(hits) / 20 >= 0.9
    exact = {(q, i): s for q in want for i, s in want[q]}
    for q, answers in got.items():
        assert answers == sorted(answers, key=lambda a: (-a[1], a[0]))
        assert all(abs(exact[q, i] - s) < 1e-9 for i, s in answers if (q, i) in exact)


def test_copies_ties_and_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(60)] + [(i, [0.0, 1.0]) for i in range(60, 64)]
    rows += [(100, None), (101, []), (102, [0.0, 0.0]), (103, [nan, 1.0]), (104, [inf, 1.0]), (105, [None, 1.0]),
             (106, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (200, [1.0, 1.0]), (200, [1.0, 1.0]), (120, [-0.0, 1.0])]
    got = found(spark, rows)
    assert [i for i, _ in got[0]] == [*range(1, 20), 20]
    assert [i for i, _ in got[40]] == list(range(20))
    assert got[0][0][1] == 1.0
    assert [i for i, _ in got[60]][:4] == [61, 62, 63, 120]
    assert set(got) == {0, 20, 40, 60, 120, 200}


def test_few_and_no_vectors(spark):
    assert found(spark, [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [1.0, 1.0])]) == {0: [(1, 4.0), (2, 3.0)]}
    assert found(spark, [(0, [1.0])]) == {}
    assert found(spark, [(1, [1.0]), (2, [1.0])]) == {}
    assert found(spark, [(0, None)]) == {} == found(spark, [])


def test_pigeonhole_index_returns_every_code_within_the_radius():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((500, 24))
    codes = hashing.learn(x, float(np.linalg.norm(x, axis=1).max()), 10)
    index = hashing.Index(codes, x, [np.array([i]) for i in range(500)])
    for q in x[:40]:
        code = codes.of(q[None], query=True)[0]
        within = np.flatnonzero(hashing._WEIGHT[index.code ^ code].sum(axis=1) <= codes.radius)
        assert index.candidates(code).tolist() == within.tolist()


def test_a_query_far_from_a_tight_cluster_gets_all_its_neighbours(spark, monkeypatch):
    monkeypatch.setattr(hashing, "BLOCK_ROWS", 700)
    rng = np.random.default_rng(2)
    centre = rng.standard_normal(32) * 3
    x = np.vstack([centre + 0.05 * rng.standard_normal((1990, 32)), -centre + rng.standard_normal((10, 32))])
    rows = [(i + (i >= 1990), v) for i, v in enumerate(x.astype(np.float32).tolist())] + [(2020, (-2 * centre).tolist())]
    got, want = found(spark, rows), brute_force(rows, 20, lambda q: q % 20 == 0)
    assert got.keys() == want.keys() and 2000 in want
    assert all(len(got[q]) == 20 for q in want)
    assert len({i for i, _ in got[2020]} & {i for i, _ in want[2020]}) >= 18
