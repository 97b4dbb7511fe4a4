import collections
import itertools
import random
import re

import numpy as np
import pyarrow as pa

from tarmac.llm import transducer
from tarmac.llm import words as W
from tarmac.llm.common import ship
from tests.conftest import SF_SMALL
from tests.llm.odd import LONG, empty_docs, odd_docs

WORD = re.compile("[^\x20\x09-\x0d]+")
COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def measures(text):
    words = WORD.findall(text)
    return (len(words), len(set(words)), sum("A" <= c <= "Z" for c in text), len(text),
            sum(c in "#$%&*|" for c in text))


def brute_force(rows, labels):
    """Every order run one filter after the other over the rows ``(id, source, text)``."""
    fails, marks = [], collections.defaultdict(lambda: [False, False])
    for i, quality, toxic in labels:
        marks[i][0] |= quality == 1
        marks[i][1] |= toxic == 1
    least = {}
    for i, _, text in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    for i, source, text in rows:
        text = text or ""
        words, distinct, capitals, points, symbols = measures(text)
        fails.append((source or "", marks[i] if i is not None else [False, False], {
            "A": words < 200, "B": 100 * distinct < 50 * words, "C": 100 * capitals > 2 * points,
            "D": symbols > 0, "E": i is not None and least[text] < i}))
    out = {}
    for part in {f[0] for f in fails}:
        own = [f for f in fails if f[0] == part]
        shapley = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left, gone = own, []
            for step, name in enumerate(order, 1):
                now = [f for f in left if f[2][name]]
                out[part, "".join(order), step] = [
                    len(left) - len(now), len(now), sum(f[2][name] for f in gone),
                    sum(f[2][name] and sum(f[2].values()) == 1 for f in own),
                    sum(f[1][0] for f in now), sum(f[1][1] for f in now), name]
                shapley[name] += len(now)
                left, gone = [f for f in left if not f[2][name]], gone + now
        for key, row in out.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]]
    return out


def result(frame):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COLUMNS] for r in frame.collect()}


def test_counts_of_any_texts_equal_python():
    rng = random.Random(3)
    letters = "aB \t\n\x0b\r#$%&*| é中🙂Z" + "a" * 3
    texts = ["".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 60, 3000]))) for _ in range(150)]
    texts += ["", "x" * 200_000, ("word " * 30_000), LONG, "", " "]
    offsets, raw = W.buffers(pa.array(texts))
    got = transducer.count_texts(offsets, raw)
    for i, text in enumerate(texts):
        assert tuple(int(got[n][i]) for n in ("words", "distinct", "capitals", "points", "symbols")) == measures(text), i


def test_equal_hashes_are_told_apart_by_their_bytes(monkeypatch):
    monkeypatch.setattr(transducer.W, "mix", lambda h: h & np.uint64(0))  # every word has the same hash
    text = " ".join(f"w{i % 37}" for i in range(300))
    offsets, raw = W.buffers(pa.array([text, text, "w1 w2 averyveryverylongword averyveryverylongwore w1"]))
    assert transducer.count_texts(offsets, raw)["distinct"].tolist() == [37, 37, 4]


def test_every_state_and_byte():
    assert transducer.EMIT.shape == (2, 256) and transducer.STEP.shape == (256,)
    for byte in range(256):
        space = byte == 32 or 9 <= byte <= 13
        assert transducer.STEP[byte] == (transducer.SPACE if space else transducer.WORD)
        assert (transducer.EMIT[transducer.SPACE, byte] & np.uint64(0xFFFF) == 1) == (not space)
        assert transducer.EMIT[transducer.WORD, byte] & np.uint64(0xFFFF) == 0


def test_audit_equals_brute_force(spark):
    ship(spark)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(5)
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "text").collect()]
    known = [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()]
    got = result(transducer.audit(docs, labels))
    assert got == brute_force(rows, known)
    assert len(got) == 600 * len({r[1] for r in rows})


def test_odd_rows_repeats_and_hot_groups(spark):
    ship(spark)
    odd = [(i, s, t) for i, t, s in ((r["doc_id"], r["text"], r["source"]) for r in odd_docs(spark).collect())]
    hot = [(100 + i, "s9", "the same text, copied") for i in range(60)]
    hot += [(5, "s9", "the same text, copied")] * 3 + [(None, "s9", "the same text, copied")] * 2
    labels = [(5, 1, None), (5, 0, 1), (100, 1, 1), (101, None, 1), (None, 1, 1), (999, 1, 0)]
    frame = spark.createDataFrame(odd + hot, "doc_id long, source string, text string").repartition(7)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert result(transducer.audit(frame, known)) == brute_force(odd + hot, labels)


def test_empty_tables(spark):
    ship(spark)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int, part string, n int")
    assert transducer.audit(empty_docs(spark), labels).count() == 0
    assert transducer.audit(odd_docs(spark), labels).count() == 600 * 4
