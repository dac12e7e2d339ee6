"""Word n-grams of a batch, interned in an open-addressed table of NumPy arrays.

A table lives for one batch. Its keys are xxhash64 values of the n-grams' bytes,
placed by linear probing; an n-gram that meets an equal key is compared byte by
byte with the one that holds the slot, and goes on probing if they differ. Beside
the key every slot has the n-gram's bucket and its count, and every occurrence
gets the number of its slot, through which per-n-gram values are gathered.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash

from hearthrate.llm.tokens import word_spans

# Words whose n-grams share one table; the n-grams of a longer text are spread over several tables.
TABLE_WORDS = 25_000

# The primes of xxhash64.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
# From this length on the hash has another form, which the library computes one by one.
_LONG = 32
# Longer n-grams are checksummed one by one.
_LONG_CHECKSUM = 256


def _checksum_tables() -> np.ndarray:
    """Row k: what a byte adds to a crc32 that k more bytes follow."""
    rows = [np.arange(256, dtype=np.uint32)]
    for _ in range(8):
        rows[0] = np.where(rows[0] & 1, (rows[0] >> 1) ^ np.uint32(0xEDB88320), rows[0] >> 1)
    for _ in range(3):
        rows.append((rows[-1] >> 8) ^ rows[0][rows[-1] & 255])
    return np.stack(rows)


_CHECKSUM = _checksum_tables()


@dataclass
class Grams:
    """All runs of 1 to ``most`` words of some texts: each is ``data[starts:ends]``, its words joined by one space."""

    data: np.ndarray
    wide: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray


def _eight_bytes(data: np.ndarray) -> np.ndarray:
    """The little-endian 64-bit integer that starts at each byte; zeros follow the end."""
    wide = np.concatenate([data, np.zeros(8, dtype=np.uint8)]).astype(np.uint64)
    for step in (1, 2, 4):
        wide[:-step] |= wide[step:] << np.uint64(8 * step)
    return wide


def grams(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray, most: int) -> tuple[np.ndarray, Iterator[Grams]]:
    """The number of words of each text, and all n-grams, some words' at a time."""
    starts, ends, first = word_spans(data, offsets, letters)
    counts = np.diff(first)
    doc = np.repeat(np.arange(len(counts)), counts)
    last = np.repeat(first[1:], counts)

    def parts() -> Iterator[Grams]:
        for low in range(0, len(starts), TABLE_WORDS):
            high = min(low + TABLE_WORDS, len(starts))
            reach = min(high + most - 1, len(starts))
            sizes = ends[low:reach] - starts[low:reach]
            place = np.cumsum(sizes + 1) - sizes - 1
            joined = np.full(int((sizes + 1).sum()), 0x20, dtype=np.uint8)
            within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            joined[np.repeat(place, sizes) + within] = data[np.repeat(starts[low:reach], sizes) + within]
            begin, until, of = [], [], []
            for n in range(1, most + 1):
                at = np.arange(low, min(high, len(starts) - n + 1))
                at = at[at + n <= last[at]] - low
                begin.append(place[at])
                until.append(place[at + n - 1] + sizes[at + n - 1])
                of.append(doc[at + low])
            yield Grams(joined, _eight_bytes(joined), np.concatenate(begin), np.concatenate(until), np.concatenate(of))

    return counts, parts()


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def xxh64(g: Grams) -> np.ndarray:
    """xxhash64 with seed 0 of every n-gram."""
    left = g.ends - g.starts
    h = _P5 + left.astype(np.uint64)
    at = g.starts.copy()
    long = np.flatnonzero(left >= _LONG)
    left[long] = 0
    while len(m := np.flatnonzero(left >= 8)):
        h[m] = _turn(h[m] ^ (_turn(g.wide[at[m]] * _P2, 31) * _P1), 27) * _P1 + _P4
        at[m] += 8
        left[m] -= 8
    m = np.flatnonzero(left >= 4)
    h[m] = _turn(h[m] ^ ((g.wide[at[m]] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
    at[m] += 4
    left[m] -= 4
    while len(m := np.flatnonzero(left > 0)):
        h[m] = _turn(h[m] ^ (g.data[at[m]].astype(np.uint64) * _P5), 11) * _P1
        at[m] += 1
        left[m] -= 1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    h ^= h >> np.uint64(32)
    view = memoryview(g.data)
    h[long] = [xxhash.xxh64_intdigest(view[s:e]) for s, e in zip(g.starts[long].tolist(), g.ends[long].tolist())]
    return h


def crc32(g: Grams, which: np.ndarray) -> np.ndarray:
    """The crc32 of some n-grams, four bytes a step, the longest first."""
    size = g.ends[which] - g.starts[which]
    out = np.empty(len(which), dtype=np.uint32)
    view = memoryview(g.data)
    for i in np.flatnonzero(size >= _LONG_CHECKSUM):
        out[i] = zlib.crc32(view[g.starts[which[i]]:g.ends[which[i]]])
    order = np.flatnonzero(size < _LONG_CHECKSUM)
    order = order[np.argsort((_LONG_CHECKSUM - size[order]).astype(np.uint16), kind="stable")]
    at, size = g.starts[which[order]], size[order]
    crc = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
    for step in range(0, int(size.max(initial=0)), 4):
        full = np.searchsorted(-size, -(step + 4), "right")
        x = crc[:full] ^ g.wide[at[:full] + step].astype(np.uint32)
        crc[:full] = _CHECKSUM[3][x & 255] ^ _CHECKSUM[2][(x >> 8) & 255] ^ _CHECKSUM[1][(x >> 16) & 255] ^ _CHECKSUM[0][x >> 24]
        # Those that end inside this step go on byte by byte.
        part = slice(full, np.searchsorted(-size, -step, "left"))
        for k in range(3):
            m = np.flatnonzero(size[part] > step + k) + full
            crc[m] = (crc[m] >> 8) ^ _CHECKSUM[0][(crc[m] ^ g.data[at[m] + step + k]) & 255]
    out[order] = ~crc
    return out


def _same_bytes(g: Grams, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the n-grams ``a`` and ``b`` have the same bytes."""
    size = g.ends[a] - g.starts[a]
    same = size == g.ends[b] - g.starts[b]
    for step in range(0, _LONG, 8):
        m = np.flatnonzero(same & (size > step) & (size < _LONG))
        if not len(m):
            break
        spare = np.maximum(8 - (size[m] - step), 0).astype(np.uint64) * np.uint64(8)
        same[m] = ((g.wide[g.starts[a[m]] + step] ^ g.wide[g.starts[b[m]] + step]) << spare) == 0
    view = memoryview(g.data)
    for i in np.flatnonzero(same & (size >= _LONG)):
        same[i] = view[g.starts[a[i]]:g.ends[a[i]]] == view[g.starts[b[i]]:g.ends[b[i]]]
    return same


class GramTable:
    """The distinct n-grams of ``g``; ``slots`` has the slot of every occurrence."""

    def __init__(self, g: Grams, hashes: np.ndarray | None = None):
        hashes = xxh64(g) if hashes is None else hashes
        n = len(hashes)
        mask = (1 << max(2 * n - 1, 1).bit_length()) - 1
        self.keys = np.zeros(mask + 1, dtype=np.uint64)
        self.holder = np.full(mask + 1, -1, dtype=np.int64)
        self.slots = np.empty(n, dtype=np.int64)
        pending, place = np.arange(n), (hashes & np.uint64(mask)).astype(np.int64)
        while len(pending):
            free = self.holder[place] < 0
            # Of the n-grams that meet at a free slot any one takes it; all are compared with that one.
            self.holder[place[free]] = pending[free]
            self.keys[place[free]] = hashes[self.holder[place[free]]]
            hit = self.keys[place] == hashes[pending]
            check = np.flatnonzero(hit & (self.holder[place] != pending))
            hit[check] = _same_bytes(g, pending[check], self.holder[place[check]])
            self.slots[pending[hit]] = place[hit]
            pending, place = pending[~hit], (place[~hit] + 1) & mask
        self.used = np.flatnonzero(self.holder >= 0)
        self.count = np.bincount(self.slots, minlength=mask + 1)
        self._grams = g

    def buckets(self, number: int) -> np.ndarray:
        """For each slot the n-gram's crc32 modulo ``number``; only used slots have a meaning."""
        out = np.zeros(len(self.keys), dtype=np.int32)
        out[self.used] = crc32(self._grams, self.holder[self.used]) % np.uint32(number)
        return out
