"""Operator 9: quality classifier by positive-unlabelled learning.

Trusted positives (label 1) and unlabelled web text (a sample of all
documents, its labels unread) train a small network with the non-negative
unbiased risk

    prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)]).

The class prior is estimated first.  A network learns to tell positives
from unlabelled rows; on rows kept out of its training, the share of
unlabelled rows above a score divided by the share of positives above it
bounds the prior from above, and comes close where hardly any negatives
score so high.  The score with the smallest bound, sampling error
included, is taken, less two standard errors: with too large a prior the
risk of the negatives is cut at zero before they are told apart.

The inputs are statistics of the whole text: shares and counts of byte
classes, of repeated neighbours and lines, capitals and word lengths.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import words as W
from tarmac.llm.common import smallest

CUT = 0.3
#: Positives and unlabelled rows that training reads at most.
SAMPLE_POSITIVE = 6000
SAMPLE_UNLABELLED = 6000
HIDDEN = 24
EPOCHS = 150
CHUNK_BYTES = 1 << 19

_SINGLES = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CLASSES = np.zeros(256, np.int64)            # 0: other control bytes
_CLASSES[97:123] = 1
_CLASSES[65:91] = 2
_CLASSES[48:58] = 3
_CLASSES[[32, 9, 11, 12, 13]] = 4
_CLASSES[10] = 5
_CLASSES[128:] = 6
for _i, _b in enumerate(_SINGLES):
    _CLASSES[_b] = 7 + _i
_N_CLASSES = 7 + len(_SINGLES)
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True


def features(offsets: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Statistics of each text, one row per text (a text without bytes: zeros)."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    owner = np.repeat(np.arange(n), size)
    counts = np.bincount(owner * _N_CLASSES + _CLASSES[raw], minlength=n * _N_CLASSES)
    counts = counts.reshape(n, _N_CLASSES).astype(np.float64)
    part = W.split_words(offsets, raw)
    words = part.counts()
    h = part.hashes()
    word_owner = np.repeat(np.arange(n), words)

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.bincount(word_owner, weights=flags, minlength=n)

    same = np.zeros(len(h))
    same[1:] = (h[1:] == h[:-1]) & (word_owner[1:] == word_owner[:-1])
    length = part.end - part.start
    first = raw[part.start] if len(h) else np.zeros(0, np.uint8)
    second = raw[np.minimum(part.start + 1, len(raw) - 1)] if len(h) else first
    last = raw[part.end - 1] if len(h) else first
    before = raw[np.maximum(part.end - 2, 0)] if len(h) else first
    capital = (_CLASSES[first] == 2) & (_CLASSES[second] == 2) & (length > 1)
    doubled = (last == before) & (_CLASSES[last] >= 7) & (length > 1)
    order = np.lexsort((h, word_owner))
    distinct = np.ones(len(h))
    distinct[1:] = (h[order][1:] != h[order][:-1]) | (word_owner[order][1:] != word_owner[order][:-1])
    lines = W.split_words(offsets, raw, _NEWLINE)
    line_hash, line_owner = lines.hashes(), np.repeat(np.arange(n), lines.counts())
    line_order = np.lexsort((line_hash, line_owner))
    again = np.zeros(len(line_hash))
    again[1:] = ((line_hash[line_order][1:] == line_hash[line_order][:-1])
                 & (line_owner[line_order][1:] == line_owner[line_order][:-1]))
    repeated = np.bincount(line_owner[line_order], weights=again, minlength=n)
    w, total = np.maximum(words, 1), np.maximum(size, 1)
    columns = [
        counts / total[:, None], np.log1p(counts[:, 7:]),
        np.stack([
            np.log1p(words), np.log1p(size), per_text(same) / w, np.log1p(per_text(same)),
            per_text(capital) / w, np.log1p(per_text(capital)), per_text(doubled) / w,
            np.log1p(per_text(doubled)), per_text(length) / w, per_text(length > 20) / w,
            np.bincount(word_owner[order], weights=distinct, minlength=n) / w,
            repeated / np.maximum(lines.counts(), 1), np.log1p(lines.counts()),
        ], axis=1)]
    return np.concatenate(columns, axis=1)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        z = np.tanh(x @ self.w1 + self.b1) @ self.w2 + self.b2
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _network(p: np.ndarray, u: np.ndarray, prior: float | None, seed: int, epochs: int) -> Model:
    """Train on positives ``p`` and unlabelled ``u``; without a prior, tell one from the other."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([p, u])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-6
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (p, u))
    params = [rng.standard_normal((p.shape[1], HIDDEN)) / np.sqrt(p.shape[1]), np.zeros(HIDDEN),
              rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN), np.zeros(1)]
    m, v, step = [0.0] * 4, [0.0] * 4, 0

    def forward(x):
        hidden = np.tanh(x @ params[0] + params[1])
        return hidden, hidden @ params[2] + params[3][0]

    def backward(x, hidden, dz):
        dh = dz[:, None] * params[2] * (1 - hidden ** 2)
        return [x.T @ dh, dh.sum(axis=0), hidden.T @ dz, np.array([dz.sum()])]

    size = 256
    n_batches = max(1, max(len(p), len(u)) // size)
    for _ in range(epochs):
        p_order = np.resize(rng.permutation(len(p)), n_batches * size)
        u_order = np.resize(rng.permutation(len(u)), n_batches * size)
        for k in range(n_batches):
            xp, xu = p[p_order[k * size:(k + 1) * size]], u[u_order[k * size:(k + 1) * size]]
            hp, zp = forward(xp)
            hu, zu = forward(xu)
            if prior is None:
                dp, du = (_sigmoid(zp) - 1) / len(zp), _sigmoid(zu) / len(zu)
            else:
                minus_u, minus_p = np.logaddexp(0, zu).mean(), np.logaddexp(0, zp).mean()
                rest = minus_u - prior * minus_p
                if rest >= 0:
                    dp = (prior * (_sigmoid(zp) - 1) - prior * _sigmoid(zp)) / len(zp)
                    du = _sigmoid(zu) / len(zu)
                else:  # the estimated risk of negatives fell below zero: step back from it
                    dp = prior * _sigmoid(zp) / len(zp)
                    du = -_sigmoid(zu) / len(zu)
            grads = [a + b + 1e-4 * w for a, b, w in zip(backward(xp, hp, dp), backward(xu, hu, du), params)]
            step += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                params[i] = params[i] - 0.005 * (m[i] / (1 - 0.9 ** step)) / (
                    np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    return Model(mean, scale, params[0], params[1], params[2], float(params[3][0]), prior or 0.0)


def train(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 11, epochs: int = EPOCHS) -> Model:
    """Estimate the prior, then fit the non-negative unbiased risk.

    With fewer than eight rows on either side every text scores 0.5 or more.
    """
    if min(len(positive), len(unlabelled)) < 8:
        k = positive.shape[1]
        return Model(np.zeros(k), np.ones(k), np.zeros((k, 1)), np.zeros(1), np.zeros(1), 0.0, 1.0)
    rng = np.random.default_rng(seed)
    sides = []
    for rows in (positive, unlabelled):
        order = rng.permutation(len(rows))
        sides.append((rows[order[: len(order) // 3]], rows[order[len(order) // 3:]]))
    (held_p, rest_p), (held_u, rest_u) = sides
    first = _network(rest_p, rest_u, None, seed, max(1, epochs // 5))
    prior = float(np.clip(_prior(first.score(held_p), first.score(held_u)), 0.05, 0.98))
    return _network(positive, unlabelled, prior, seed + 1, epochs)


def _prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Smallest ratio of the shares above a score, with its sampling error."""
    cuts = np.sort(positive)[: max(1, int(0.95 * len(positive)))]
    above_p = 1 - np.arange(len(cuts)) / len(positive)
    above_u = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    error = np.sqrt(np.log(40) / (2 * len(positive))) + np.sqrt(np.log(40) / (2 * len(unlabelled)))
    best = np.argmin((above_u + error) / above_p)
    prior = float(above_u[best] / above_p[best])
    return prior - 2 * np.sqrt(max(prior * (1 - prior), 0) / len(unlabelled))


def _feature_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, raw = W.buffers(batch.column(1))
            for lo, hi in W.chunks(offsets, CHUNK_BYTES):
                x = features(offsets[lo: hi + 1] - offsets[lo], raw[offsets[lo]: offsets[hi]])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo),
                    pa.array([row.tobytes() for row in x], pa.binary()),
                ], names=["id", "trusted", "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col, "_trusted").mapInArrow(run, f"id {kind}, trusted int, x binary")


def fit(docs: DataFrame, labels: DataFrame, positives: int = SAMPLE_POSITIVE, unlabelled: int = SAMPLE_UNLABELLED,
        id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Train on bounded samples: ``positives`` rows of label 1 and ``unlabelled`` rows of all documents.

    Both samples are the rows with the smallest hash of their id.
    """
    order = F.xxhash64(F.col(id_col), F.lit(23))
    trusted = smallest(labels.filter(F.col("quality") == 1).select(id_col).dropDuplicates(), order, id_col, positives)
    other = F.xxhash64(F.col(id_col), F.lit(29))
    web = smallest(docs.select(id_col).filter(F.col(id_col).isNotNull()).dropDuplicates(), other, id_col, unlabelled)
    few = F.broadcast(trusted.withColumn("_trusted", F.lit(1)).unionByName(web.withColumn("_trusted", F.lit(0))))
    rows = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias(text_col)).join(few, id_col)
    rows = rows.groupBy(id_col, "_trusted").agg(F.min(text_col).alias(text_col))  # one text of an id that repeats
    got = sorted((r["id"], r["trusted"], bytes(r["x"])) for r in _feature_rows(rows, id_col, text_col).toLocalIterator())
    width = features(np.zeros(2, np.int64), np.zeros(0, np.uint8)).shape[1]
    sides = [np.frombuffer(b"".join(r[2] for r in got if r[1] == t)).reshape(-1, width) for t in (1, 0)]
    return train(*sides)


def scorer(docs: DataFrame, model: Model):
    """Column function: score of a text column, kept at 0.3 and above; null reads as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def good(texts: pa.Array) -> pa.Array:
        offsets, raw = W.buffers(texts)
        got = [shared.value.score(features(offsets[lo: hi + 1] - offsets[lo], raw[offsets[lo]: offsets[hi]]))
               for lo, hi in W.chunks(offsets, CHUNK_BYTES)]
        return pa.array(np.round(np.concatenate([np.zeros(0), *got]), 6), pa.float64())

    return good


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` of every row; a text is kept at 0.3 and above.

    Null and empty texts have all statistics zero and are scored so.  Rows
    may repeat or lack an id; each gives one row.  Labels, ``lang``,
    ``source`` and ids are not read, other columns are left out.
    """
    return docs.select(id_col, scorer(docs, model)(F.col(text_col)).alias("score"))
