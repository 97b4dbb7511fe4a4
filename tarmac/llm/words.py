"""Vectorised word hashing over Arrow text buffers (runs inside tasks).

A batch of texts is one byte buffer.  With ``S`` the running sum of
``value[byte] * base**position`` modulo 2**64, the hash of any byte range
is a difference of two sums times ``base**-start``, so the hashes of all
words (and of all word prefixes) of a batch cost a few array passes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)

_BYTES = np.arange(256)
#: A-Z to a-z, every other byte as it is.
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: Bytes that separate words of the class ``[^\x20\x09-\x0D]+``.
SPACES = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)


class _Powers:
    """base**i and base**-i, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(n + 1, 1 << 20)
            factors = np.full(size, _BASE, np.uint64)
            factors[0] = 1
            self.up = np.cumprod(factors)
            factors = np.full(size, _INVERSE, np.uint64)
            factors[0] = 1
            self.down = np.cumprod(factors)


_POWERS = _Powers()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for at least ``n`` numbers i from 0."""
    _POWERS.upto(n)
    return _POWERS.up, _POWERS.down


@dataclass
class Words:
    """Words of some texts: byte range and text of each."""

    data: np.ndarray      # lower-cased bytes of all texts
    start: np.ndarray     # first byte of each word
    end: np.ndarray       # byte after each word
    first: np.ndarray     # texts + 1: index of each text's first word
    sums: np.ndarray

    def hashes(self, prefix: int | None = None) -> np.ndarray:
        """Hash of each word, or of its first ``prefix`` bytes."""
        end = self.end if prefix is None else np.minimum(self.end, self.start + prefix)
        return mix((self.sums[end] - self.sums[self.start]) * _POWERS.down[self.start])

    def range_hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of any byte ranges (lines, phrases) of the same texts."""
        return mix((self.sums[end] - self.sums[start]) * _POWERS.down[start])

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string array, nulls as empty texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64)[texts.offset: texts.offset + len(texts) + 1] \
        if len(texts) else np.zeros(1, np.int64)
    if data is None or not len(texts):
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.uint8)
    raw = np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]]
    return offsets - offsets[0], raw


def chunks(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``limit`` bytes each (one text at least)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def split_words(offsets: np.ndarray, raw: np.ndarray, separators: np.ndarray = SPACES) -> Words:
    """Words of the texts ``raw[offsets[i]:offsets[i+1]]``, A-Z lower-cased."""
    data = LOWER[raw]
    n = len(data)
    _POWERS.upto(n + 1)
    inside = ~separators[data]
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    if n:
        before[0], after[-1] = True, True
        before[1:] = ~inside[:-1]
        after[:-1] = ~inside[1:]
        edges = offsets[(offsets > 0) & (offsets < n)]
        before[edges] = True
        after[edges - 1] = True
    start = np.flatnonzero(inside & before)
    end = np.flatnonzero(inside & after) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[data] * _POWERS.up[:n], out=sums[1:])
    return Words(data, start, end, np.searchsorted(start, offsets), sums)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``size``-word shingles of each text.

    A text with fewer words (but one at least) has its whole sequence as
    one shingle; one without words has none.  Returns the hashes, sorted
    within each text, and texts + 1 offsets.
    """
    h, counts = words.hashes(), words.counts()
    step = 0xD6E8FEB86659FD93
    total = len(h)
    n_texts = len(counts)
    rolled = np.zeros(total, np.uint64)
    for j in range(min(size, total)):
        rolled[: total - j] += h[j:] * np.uint64(pow(step, j, 1 << 64))
    rolled = mix(rolled)
    out, offsets = [], np.zeros(n_texts + 1, np.int64)
    for i in range(n_texts):
        a, c = int(words.first[i]), int(counts[i])
        if c >= size:
            got = np.unique(rolled[a: a + c - size + 1])
        elif c:
            short = c
            for value in h[a: a + c].tolist():
                short = (short * step + value) & _MASK
            got = mix(np.array([short], np.uint64))
        else:
            got = rolled[:0]
        out.append(got)
        offsets[i + 1] = offsets[i] + len(got)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), offsets
