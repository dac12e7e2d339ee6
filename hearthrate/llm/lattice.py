"""Marginal probability of words over all their segmentations into vocabulary pieces.

A word is spelled as a space and its bytes. Every piece that matches at a place
is an arc of a lattice, and every single byte is one too, so a segmentation
always exists. The forward recursion sums all paths; with the
backward recursion it gives the expected number of times each piece is used.
Words are worked on together, by length: on probabilities where even the path
of single bytes is a plain double, and in log space where it may not be.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from sentencepiece import sentencepiece_model_pb2 as proto

from hearthrate.llm.words import Words, hash_spans, hash_windows, split

# Words of at most so many bytes are worked on together, by length; a longer one on its own, in steps of so many bytes.
LONGEST_WORD = 192
# Offset of the rank in the vocabulary's scores, taken as a Zipf law, and the share of the single bytes.
RANK_OFFSET = 10.0
BYTE_SHARE = 1e-3
# Pseudo-counts of the vocabulary's own scores beside counted pieces.
PRIOR_COUNT = 2_000.0
_SLOT_BITS = 20
# Bits of a hash that tell most strings that are no pieces.
_SEEN_BITS = 19
# Bytes of the words of one length that are worked on together.
CELLS = 1 << 16
# Probabilities down to this power of e are worked on as they are: well above the least normal double, e^-708.
LEAST_LOG = -650.0


@dataclass
class Vocabulary:
    """Pieces with their hashes, then the 256 bytes; ``prior``: log probability of each from the vocabulary's scores."""

    hashes: np.ndarray
    tables: list[np.ndarray]
    longest: int
    prior: np.ndarray
    seen: np.ndarray

    @property
    def size(self) -> int:
        return len(self.prior)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of the piece with each hash, or -1."""
        out = np.full(len(h), -1, dtype=np.int32)
        for k, table in enumerate(self.tables):
            slot = table[(h >> np.uint64(64 - _SLOT_BITS * (k + 1))) & np.uint64((1 << _SLOT_BITS) - 1)]
            hit = (slot >= 0) & (self.hashes[slot] == h)
            out[hit] = slot[hit]
        return out

    def matches(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the hashes that are pieces, in order, and the pieces."""
        maybe = np.flatnonzero(self.seen[_low_bits(h)])
        pieces = self.find(h[maybe])
        hit = pieces >= 0
        return maybe[hit], pieces[hit]


def _low_bits(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64((1 << _SEEN_BITS) - 1)).view(np.int64)


def vocabulary(model: bytes) -> Vocabulary:
    """The normal pieces of a SentencePiece model; a space mark is a space."""
    kinds = proto.ModelProto.SentencePiece
    pieces = [(p.piece.replace("▁", " ").encode(), p.score) for p in proto.ModelProto.FromString(model).pieces if p.type == kinds.NORMAL]
    pieces = [(p, s) for p, s in pieces if b" " not in p[1:] and len(p) > 1 and p != b" "]
    pieces.sort(key=lambda item: (-item[1], item[0]))
    text = b"".join(p for p, _ in pieces)
    ends = np.cumsum([len(p) for p, _ in pieces])
    starts = ends - [len(p) for p, _ in pieces]
    hashes = hash_spans(np.frombuffer(text, dtype=np.uint8), starts, ends)
    tables, left = [], np.arange(len(pieces))
    while len(left):
        # Pieces whose slot is taken go to a further table, by other bits of the hash.
        if len(tables) == 3:
            raise ValueError("piece hashes collide")
        slots = ((hashes[left] >> np.uint64(64 - _SLOT_BITS * (len(tables) + 1))) & np.uint64((1 << _SLOT_BITS) - 1)).astype(np.int64)
        _, first = np.unique(slots, return_index=True)
        table = np.full(1 << _SLOT_BITS, -1, dtype=np.int32)
        table[slots[first]] = left[first]
        tables.append(table)
        left = np.delete(left, first)
    weight = 1.0 / (np.arange(len(pieces)) + RANK_OFFSET)
    share = np.concatenate([weight / weight.sum() * (1 - BYTE_SHARE), np.full(256, BYTE_SHARE / 256)])
    seen = np.zeros(1 << _SEEN_BITS, dtype=bool)
    seen[_low_bits(hashes)] = True
    return Vocabulary(hashes, tables, max((len(p) for p, _ in pieces), default=1), np.log(share), seen)


def refined(vocab: Vocabulary, counts: np.ndarray) -> np.ndarray:
    """Log probabilities from expected counts (piece by class), smoothed by the prior."""
    total = counts.sum(axis=0) + PRIOR_COUNT
    return np.log((counts + PRIOR_COUNT * np.exp(vocab.prior)[:, None]) / total)


def _by_length(words: Words, which: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in ``which``, their spelled bytes as a matrix), for each length up to ``LONGEST_WORD``, some words at a time."""
    starts, sizes = words.starts[which], words.ends[which] - words.starts[which]
    for size in np.unique(sizes[sizes <= LONGEST_WORD]):
        every = np.flatnonzero(sizes == size)
        step = CELLS // (int(size) + 1)
        for low in range(0, len(every), step):
            chosen = every[low:low + step]
            body = words.data[starts[chosen][:, None] + np.arange(size)]
            yield chosen, np.hstack([np.full((len(chosen), 1), 0x20, dtype=np.uint8), body])


def _long_words(words: Words, which: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(place in ``which``, spelled bytes) of each longer word."""
    for k in np.flatnonzero(words.ends[which] - words.starts[which] > LONGEST_WORD).tolist():
        yield k, np.concatenate([np.array([0x20], dtype=np.uint8), words.data[words.starts[which[k]]:words.ends[which[k]]]])


def _arcs_to(vocab: Vocabulary, spelled: np.ndarray, low: int, high: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each end in (low, high] of one word: where its arcs start, and their pieces."""
    widths = np.arange(2, vocab.longest + 1)
    ends = np.arange(low + 1, high + 1)
    begin = ends[:, None] - widths
    fits = begin >= 0
    from_ = max(0, low + 1 - vocab.longest)
    pieces = np.full(begin.shape, -1, dtype=np.int64)
    pieces[fits] = vocab.find(hash_spans(spelled[from_:high], begin[fits] - from_, (np.broadcast_to(ends[:, None], begin.shape))[fits] - from_))
    out = []
    for row, end in enumerate(ends.tolist()):
        hit = np.flatnonzero(pieces[row] >= 0)
        out.append((np.append(end - 1, begin[row, hit]), np.append(int(spelled[end - 1]) + vocab.size - 256, pieces[row, hit])))
    return out


def _forward(vocab: Vocabulary, logp: np.ndarray, spelled: np.ndarray, keep: bool) -> np.ndarray:
    """Log probability of each beginning of a long word; without ``keep`` that of the whole word alone.

    Values are carried from step to step as far as the longest piece reaches, so no segmentation is left out.
    """
    length, reach = len(spelled), vocab.longest
    alpha = np.full((length + 1 if keep else LONGEST_WORD + reach + 1, *logp.shape[1:]), -np.inf)
    base = 0
    alpha[0] = 0.0
    for low in range(0, length, LONGEST_WORD):
        high = min(low + LONGEST_WORD, length)
        if not keep and low - base > reach:
            alpha[:reach + 1] = alpha[low - base - reach:low - base + 1].copy()
            base = low - reach
        for end, (starts, pieces) in enumerate(_arcs_to(vocab, spelled, low, high), low + 1):
            alpha[end - base] = np.logaddexp.reduce(alpha[starts - base] + logp[pieces], axis=0)
    return alpha if keep else alpha[length - base]


def _expected_of_long(vocab: Vocabulary, logp: np.ndarray, spelled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pieces, expected uses) of one long word; memory is two numbers for each of its bytes."""
    alpha = _forward(vocab, logp, spelled, keep=True)
    beta = np.full(len(alpha), -np.inf)
    beta[-1] = 0.0
    uses = np.zeros(vocab.size)
    for low in range((len(spelled) - 1) // LONGEST_WORD * LONGEST_WORD, -1, -LONGEST_WORD):
        high = min(low + LONGEST_WORD, len(spelled))
        arcs = _arcs_to(vocab, spelled, low, high)
        for end in range(high, low, -1):
            starts, pieces = arcs[end - low - 1]
            step = logp[pieces] + beta[end]
            beta[starts] = np.logaddexp(beta[starts], step)
            uses[pieces] += np.exp(alpha[starts] + step - alpha[-1])
    met = np.flatnonzero(uses)
    return met, uses[met]


def _arcs(vocab: Vocabulary, spelled: np.ndarray) -> Iterator[tuple[int, int, np.ndarray | slice, np.ndarray]]:
    """(from, to, rows, pieces) of all arcs, ordered by their end."""
    n, length = spelled.shape
    to: list[list[tuple[int, np.ndarray, np.ndarray]]] = [[] for _ in range(length + 1)]
    for width, hashes in hash_windows(spelled, range(2, min(length, vocab.longest) + 1)):
        at, pieces = vocab.matches(hashes.ravel())
        bounds = np.searchsorted(at, np.arange(len(hashes) + 1) * n).tolist()
        for start, (low, high) in enumerate(zip(bounds, bounds[1:])):
            if low < high:
                to[start + width].append((start, at[low:high] - start * n, pieces[low:high]))
    for end in range(1, length + 1):
        yield end - 1, end, slice(None), spelled[:, end - 1].astype(np.int32) + (vocab.size - 256)
        for start, rows, pieces in to[end]:
            yield start, end, rows, pieces


def _plain(logp: np.ndarray, length: int) -> bool:
    """Whether no sum over the segmentations of so many bytes can leave the normal doubles: the single bytes are one."""
    return length * logp[-256:].min() > LEAST_LOG


def log_marginals(vocab: Vocabulary, logp: np.ndarray, words: Words, which: np.ndarray) -> np.ndarray:
    """Log probability of the words at ``which`` under each column of ``logp``."""
    out = np.zeros((len(which), logp.shape[1]))
    chance = np.exp(logp)
    for places, spelled in _by_length(words, which):
        plain = _plain(logp, spelled.shape[1])
        alpha = np.full((spelled.shape[1] + 1, len(places), logp.shape[1]), 0.0 if plain else -np.inf)
        alpha[0] = 1.0 if plain else 0.0
        for start, end, rows, pieces in _arcs(vocab, spelled):
            if plain:
                alpha[end][rows] += alpha[start][rows] * chance[pieces]
            else:
                alpha[end][rows] = np.logaddexp(alpha[end][rows], alpha[start][rows] + logp[pieces])
        out[places] = np.log(alpha[-1]) if plain else alpha[-1]
    for k, spelled in _long_words(words, which):
        out[k] = _forward(vocab, logp, spelled, keep=False)
    return out


def _uses(logp: np.ndarray, chance: np.ndarray, arcs: list, n: int, length: int) -> list[np.ndarray]:
    """Expected uses of the last arc, the one before it and so on, by the forward and backward recursions."""
    plain = _plain(logp, length)
    alpha = np.full((length + 1, n), 0.0 if plain else -np.inf)
    beta = alpha.copy()
    alpha[0] = beta[length] = 1.0 if plain else 0.0
    out = []
    if plain:
        for start, end, rows, pieces in arcs:
            alpha[end][rows] += alpha[start][rows] * chance[pieces]
        for start, end, rows, pieces in reversed(arcs):
            step = chance[pieces] * beta[end][rows]
            beta[start][rows] += step
            out.append(alpha[start][rows] * step / alpha[length][rows])
        return out
    for start, end, rows, pieces in arcs:
        alpha[end][rows] = np.logaddexp(alpha[end][rows], alpha[start][rows] + logp[pieces])
    for start, end, rows, pieces in reversed(arcs):
        step = logp[pieces] + beta[end][rows]
        beta[start][rows] = np.logaddexp(beta[start][rows], step)
        out.append(np.exp(alpha[start][rows] + step - alpha[length][rows]))
    return out


def expected_counts(vocab: Vocabulary, logp: np.ndarray, words: Words, which: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Expected uses of each piece under one model ``logp``, weighted by each class's column of ``weights``."""
    counts = np.zeros((vocab.size, weights.shape[1]))
    chance = np.exp(logp)
    for places, spelled in _by_length(words, which):
        arcs = list(_arcs(vocab, spelled))
        used = np.concatenate(_uses(logp, chance, arcs, *spelled.shape))
        met = np.concatenate([pieces for _, _, _, pieces in reversed(arcs)])
        word = np.concatenate([places[rows] for _, _, rows, _ in reversed(arcs)])
        for k in range(weights.shape[1]):
            counts[:, k] += np.bincount(met, weights=used * weights[word, k], minlength=vocab.size)
    for k, spelled in _long_words(words, which):
        pieces, used = _expected_of_long(vocab, logp, spelled)
        counts[pieces] += used[:, None] * weights[k]
    return counts


class Memory:
    """Rows of numbers for words seen before, by the words' hashes; starts anew when full."""

    def __init__(self, width: int, limit: int = 100_000):
        self.width, self.limit = width, limit
        self._clear()

    def _clear(self) -> None:
        self.slots: dict[int, int] = {}
        self.rows = np.empty((0, self.width))

    def get(self, hashes: np.ndarray, compute) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the distinct hashes, and for each hash its row; ``compute(places)`` makes missing ones."""
        if len(self.slots) > self.limit:
            self._clear()
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        names = distinct.tolist()
        fresh = [k for k, name in enumerate(names) if name not in self.slots]
        if fresh:
            made = compute(first[fresh])
            self.slots.update(zip([names[k] for k in fresh], range(len(self.slots), len(self.slots) + len(fresh))))
            self.rows = np.concatenate([self.rows, made])
        at = np.fromiter(map(self.slots.__getitem__, names), dtype=np.int64, count=len(names))
        return self.rows[at], back


class Tally:
    """Distinct words with a row of weights each, over several passes."""

    def __init__(self, width: int):
        self.width = width
        self.slots: dict[int, int] = {}
        self.spelled: list[bytes] = []
        self.weights = np.zeros((0, width))

    def add(self, words: Words, column: np.ndarray, weight: np.ndarray | None = None) -> None:
        """Count every word once in the class that ``column`` names for it."""
        distinct, first, back = np.unique(words.hashes, return_index=True, return_inverse=True)
        names = distinct.tolist()
        fresh = [k for k, name in enumerate(names) if name not in self.slots]
        self.slots.update(zip([names[k] for k in fresh], range(len(self.slots), len(self.slots) + len(fresh))))
        self.spelled += [words.text(i) for i in first[fresh].tolist()]
        self.weights = np.concatenate([self.weights, np.zeros((len(fresh), self.width))])
        at = np.fromiter(map(self.slots.__getitem__, names), dtype=np.int64, count=len(names))
        sums = np.bincount(back * self.width + column, weights=weight, minlength=len(names) * self.width)
        self.weights[at] += sums.reshape(len(names), self.width)

    def words(self) -> Words:
        data = np.frombuffer(b" ".join(self.spelled), dtype=np.uint8)
        return split(data, np.array([0, len(data)]))
