"""Texts of Arrow batches as bytes, and words of any class of bytes in them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Lower-cases A-Z alone; other letters stay as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Marks the bytes in some ranges, ends included."""
    mark = np.zeros(256, dtype=bool)
    for low, high in ranges:
        mark[low:high + 1] = True
    return mark


def text_bytes(texts: pa.Array, limit: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(at, data, offsets) of consecutive texts, at most ``limit`` bytes or one text at once; null is an empty text."""
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
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + limit, "right")) - 1)
        yield i, data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i]
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): the maximal runs of ``letters`` inside each text, and the index of each text's first run.

    Text ``i`` is ``data[offsets[i]:offsets[i + 1]]``; ``first`` has one entry more than there are texts.
    """
    solid = letters[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1] | cut[1:-1]
    closes[:-1] &= ~solid[1:] | cut[1:-1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)
