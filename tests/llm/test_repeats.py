import hashlib
import random

import numpy as np
import pytest

from tarmac.llm import repeats
from tarmac.llm.common import ship
from tests.conftest import SF_SMALL
from tests.llm.odd import LONG, empty_docs, odd_docs


def brute_force(rows):
    """``(id, n_bytes, n_removed, n_spans, kept_sha256)`` of rows ``(id, text)``."""
    least = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, raw in texts:
        if i is not None:
            for at in range(len(raw) - repeats.DEPTH + 1):
                window = raw[at: at + repeats.DEPTH]
                least[window] = min(i, least.get(window, i))
    out = []
    for i, raw in texts:
        gone = np.zeros(len(raw) + 1, bool)
        if i is not None:
            for at in range(len(raw) - repeats.DEPTH + 1):
                if least[raw[at: at + repeats.DEPTH]] < i:
                    gone[at: at + repeats.DEPTH] = True
        gone = gone[:-1]
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        spans = int(np.sum(gone & ~np.r_[False, gone[:-1]])) if len(gone) else 0
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def test_documents_equal_brute_force(spark):
    ship(spark)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").repartition(5)
    want = brute_force([tuple(r) for r in docs.collect()])
    assert result(repeats.summary(docs)) == want
    assert any(r[2] for r in want)


def passages(seed):
    """Texts that share passages of any length, cut, repeated and edited, with ties, nulls and runs of one byte."""
    rng = random.Random(seed)
    letters = "ab" if seed == 1 else "abcdefgh é中"
    pool = ["".join(rng.choice(letters) for _ in range(rng.choice([20, 49, 50, 51, 76, 77, 120, 400]))) for _ in range(25)]
    pool += ["x" * 300, "ab" * 90, "\0" * 70]
    rows = []
    for i in range(120):
        text = "".join(p[rng.randrange(20):] if rng.random() < .5 else p for p in rng.choices(pool, k=rng.randrange(5)))
        text += "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
        rows.append((rng.choice([i, i, i, 7, None]), text if rng.random() < .95 else None))
    line = "this line stands in every document, with ever other text around it. "
    rows += [(1000 + i, f"{rng.random()} {line}{rng.random()}") for i in range(60)]
    return rows


@pytest.mark.parametrize("seed, hot, pack", [(1, 50_000, 1 << 11), (2, 3, 1 << 11), (3, 0, 1 << 20), (4, 20, 1 << 12)])
def test_passages_equal_brute_force_however_they_are_dealt(spark, seed, hot, pack, monkeypatch):
    ship(spark)
    monkeypatch.setattr(repeats, "SORTED", 500)
    monkeypatch.setattr(repeats, "STRINGS", 40)
    rows = passages(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = repeats.remove(docs, pack_bytes=pack, bucket_bytes=pack, hot=hot)
    got = [(r["id"], r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]),
            hashlib.sha256(r["kept"]).hexdigest()) for r in got.collect()]
    assert sorted(got, key=str) == brute_force(rows)


def test_pieces_do_not_show():
    rng = np.random.default_rng(5)
    raw = rng.integers(97, 100, 5000).astype(np.uint8)
    raw[1000:1400] = 97
    offsets = np.array([0, 0, 30, 2000, 2000, 5000])
    whole = repeats.anchors(offsets, raw)
    size, repeats.PIECE = repeats.PIECE, 333
    try:
        cut = repeats.anchors(offsets, raw)
    finally:
        repeats.PIECE = size
    assert all((a == b).all() for a, b in zip(whole, cut))
    place, start, count, _ = whole
    windows = np.concatenate([np.arange(s, s + n) for s, n in zip(start, count)])
    assert windows.tolist() == [*range(30, 2000 - 49), *range(2000, 5000 - 49)]
    assert ((place >= start + count - 1) & (place <= start + repeats.REACH - 1)).all()


def test_passes_find_the_equal_windows_of_a_group():
    rng = np.random.default_rng(6)
    raw = rng.integers(0, 2, 900).astype(np.uint8)
    raw[500:700] = raw[100:300]
    at = np.arange(800)
    left, group = repeats.equal_windows(repeats._eight(raw), at, at % 2)
    classes = {}
    for i in at:
        classes.setdefault((i % 2, raw[i: i + 50].tobytes()), []).append(i)
    got = {}
    for i, g in zip(left, group):
        got.setdefault(g, []).append(i)
    assert sorted(map(sorted, got.values())) == sorted(c for c in classes.values() if len(c) > 1)


def test_odd_rows_and_empty_table(spark):
    ship(spark)
    docs = odd_docs(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(20, LONG[500:] + "an end"), (21, LONG)]
    more = docs.unionByName(odd_docs(spark, [(20, LONG[500:] + "an end", "s"), (21, LONG, "s")]))
    assert result(repeats.summary(more)) == brute_force(rows)
    assert repeats.summary(empty_docs(spark)).count() == 0
