"""Words and their hashes for whole batches of texts, in NumPy.

A word is a maximal run of bytes other than space and 0x09-0x0D; no byte of a
multi-byte UTF-8 character lies in that set, so splitting bytes splits text.
Word hashes are 64-bit: a polynomial over the bytes, mixed with the length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C55)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Bytes of text that one NumPy pass works on; a longer text is a pass of its own.
PASS_BYTES = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    out = []
    for factor in (_BASE, inverse):
        steps = np.full(n, factor, dtype=np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


@dataclass
class Words:
    """The words of some consecutive texts.

    ``data``: the texts' bytes; ``starts``, ``ends``: each word in them;
    ``first``: index of each text's first word, and one more at the end;
    ``hashes``: of each word; ``at``: position of the first text in its batch.
    """

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray
    at: int

    def __len__(self) -> int:
        return len(self.first) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """For each word the text it is in, from 0."""
        return np.repeat(np.arange(len(self)), self.counts())

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes."""
    n = len(data) + 1
    up, down = _powers(max(1 << 20, 1 << (n - 1).bit_length()))
    sums = np.zeros(n, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n - 1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _STEP)


def hash_windows(rows: np.ndarray, widths: range) -> Iterator[tuple[int, np.ndarray]]:
    """For each width the hashes, as of ``hash_spans``, of all runs of so many bytes in each row of a matrix: start by row."""
    n, length = rows.shape
    up, down = _powers(max(1 << 20, 1 << length.bit_length()))
    sums = np.zeros((length + 1, n), dtype=np.uint64)
    np.cumsum((rows.T.astype(np.uint64) + np.uint64(1)) * up[:length, None], axis=0, out=sums[1:])
    for width in widths:
        yield width, mix((sums[width:] - sums[:-width]) * down[:length + 1 - width, None] + np.array([width], dtype=np.uint64) * _STEP)


def split(data: np.ndarray, offsets: np.ndarray, at: int = 0, lower: bool = False) -> Words:
    """Words of the texts that lie in ``data`` between consecutive ``offsets``."""
    if lower:
        data = _LOWER[data]
    solid = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[:1] = False
    before[1:] = solid[:-1]
    after = np.empty(len(data), dtype=bool)
    after[-1:] = False
    after[:-1] = solid[1:]
    starts = np.flatnonzero(solid & (~before | cut[:-1]))
    ends = np.flatnonzero(solid & (~after | cut[1:])) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets), hash_spans(data, starts, ends), at)


def passes(texts: pa.Array, lower: bool = False) -> Iterator[Words]:
    """Words of a column of texts, some megabytes at a time; null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if n == 0:
        return
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + PASS_BYTES, "right")) - 1)
        yield split(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i], i, lower)
        i = j


def runs(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside one text, and each run's first word."""
    n = len(words.hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    h = np.zeros(n, dtype=np.uint64)
    for j in range(size):
        h = h * _STEP + words.hashes[j:j + n]
    last = words.first[1:][words.doc()]
    at = np.flatnonzero(np.arange(n) + size <= last[:n])
    return mix(h[at] + np.uint64(size)), at
