"""A linear-chain conditional random field with two states over short feature vectors, in NumPy.

State 1 is what the features are looked at for; a position scores ``weights @ x`` more in
state 1 than in state 0, and neighbouring states add their transition score. Sequences are worked
on together, position by position, longest first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

STEPS = 300
RATE = 0.1
PENALTY = 1e-4


@dataclass
class Chain:
    weights: np.ndarray
    moves: np.ndarray
    begin: np.ndarray

    def decode(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The most probable state of every position (Viterbi); ``x`` has the sequences one after another."""
        up = x @ self.weights
        from_one = np.zeros((len(up), 2), dtype=bool)
        score = np.zeros((len(lengths), 2))
        for who, at, first in _positions(lengths):
            if first:
                score[who] = self.begin
            else:
                ways = score[who][:, :, None] + self.moves
                from_one[at] = ways[:, 1] > ways[:, 0]
                score[who] = ways.max(axis=1)
            score[who, 1] += up[at]
        state = np.zeros(len(up), dtype=bool)
        now = score[:, 1] > score[:, 0]
        for who, at, _ in reversed(list(_positions(lengths))):
            state[at] = now[who]
            now[who] = from_one[at, now[who].astype(np.int64)]
        return state


def _positions(lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(sequences, their rows, whether these are their first) for position 0, 1, ... of all sequences that reach it."""
    order = np.argsort(-lengths, kind="stable")
    begin = (np.cumsum(lengths) - lengths)[order]
    reach = np.searchsorted(-lengths[order], -np.arange(int(lengths.max(initial=0))), "left")
    for t, n in enumerate(reach.tolist()):
        yield order[:n], begin[:n] + t, t == 0


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis)
    return top + np.log(np.exp(a - np.expand_dims(top, axis)).sum(axis=axis))


def _expected(chain: Chain, x: np.ndarray, lengths: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability of state 1 at each position, and weighted expected transitions and first states."""
    up = x @ chain.weights
    steps = list(_positions(lengths))
    ahead = np.zeros((len(up), 2))
    for who, at, first in steps:
        ahead[at] = chain.begin if first else _log_sum(ahead[at - 1][:, :, None] + chain.moves, 1)
        ahead[at, 1] += up[at]
    behind = np.zeros((len(up), 2))
    moves = np.zeros((2, 2))
    for who, at, first in reversed(steps):
        if not first:
            arrive = behind[at].copy()
            arrive[:, 1] += up[at]
            ways = chain.moves + arrive[:, None, :]
            behind[at - 1] = _log_sum(ways, 2)
            both = ahead[at - 1][:, :, None] + ways
            total = _log_sum(both.reshape(len(at), 4), 1)
            moves += (np.exp(both - total[:, None, None]) * weight[who][:, None, None]).sum(axis=0)
    both = ahead + behind
    one = np.exp(both[:, 1] - _log_sum(both, 1))
    first = one[np.cumsum(lengths) - lengths]
    return one, moves, np.array([((1 - first) * weight).sum(), (first * weight).sum()])


def fit_chain(x: np.ndarray, states: np.ndarray, lengths: np.ndarray, weight: np.ndarray) -> Chain:
    """Penalised weighted maximum likelihood by Adam; sequences must not be empty."""
    chain = Chain(np.zeros(x.shape[1]), np.zeros((2, 2)), np.zeros(2))
    spread, total = np.repeat(weight, lengths), max(float(weight @ lengths), 1.0)
    begin = np.cumsum(lengths) - lengths
    inner = np.ones(len(states), dtype=bool)
    inner[begin] = False
    at = np.flatnonzero(inner)
    seen_moves = np.bincount(states[at - 1] * 2 + states[at], weights=spread[at], minlength=4).reshape(2, 2)
    seen_begin = np.bincount(states[begin], weights=weight, minlength=2)
    params = [chain.weights, chain.moves, chain.begin]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, STEPS + 1):
        one, moves, starts = _expected(chain, x, lengths, weight)
        slopes = [x.T @ ((one - states) * spread) / total, (moves - seen_moves) / total, (starts - seen_begin) / total]
        for p, g, m, v in zip(params, slopes, first, second):
            g = g + PENALTY * p
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return chain
