"""Probabilistic automata learned from labelled strings by merging prefix-tree states.

States of the prefix tree are visited breadth first. A state whose outgoing
frequencies do not differ from those of a kept state, by Hoeffding's bound at
every symbol and recursively in what follows, is folded into it; otherwise it
is kept. The result scores how well a string fits the learned format.
"""

from __future__ import annotations

import math
from collections import deque

# Symbols of candidate strings; the score compares with drawing each at random.
SYMBOLS = 66
# Weight of a symbol never seen in a state.
UNSEEN = 0.05


class Automaton:
    def __init__(self, strings: list[str], alpha: float = 0.05):
        self.visits, self.stops, self.steps = [0], [0], [{}]
        for s in strings:
            state = 0
            for c in s:
                self.visits[state] += 1
                if c not in self.steps[state]:
                    self.steps[state][c] = len(self.visits)
                    self.visits.append(0)
                    self.stops.append(0)
                    self.steps.append({})
                state = self.steps[state][c]
            self.visits[state] += 1
            self.stops[state] += 1
        # How often each step was taken; the tree's steps are taken as often as their target is visited.
        self.taken = [{c: self.visits[t] for c, t in out.items()} for out in self.steps]
        self.width = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge()

    def _differ(self, f: int, n: int, g: int, m: int) -> bool:
        return abs(f / n - g / m) > self.width * (n**-0.5 + m**-0.5)

    def _alike(self, kept: int, other: int) -> bool:
        todo = [(kept, other)]
        while todo:
            a, b = todo.pop()
            n, m = self.visits[a], self.visits[b]
            if self._differ(self.stops[a], n, self.stops[b], m):
                return False
            for c in self.steps[a].keys() | self.steps[b].keys():
                if self._differ(self.taken[a].get(c, 0), n, self.taken[b].get(c, 0), m):
                    return False
                if c in self.steps[a] and c in self.steps[b]:
                    todo.append((self.steps[a][c], self.steps[b][c]))
        return True

    def _fold(self, kept: int, tree: int) -> None:
        """Add a subtree's counts to the automaton that starts in ``kept``."""
        todo = [(kept, tree)]
        while todo:
            a, b = todo.pop()
            self.visits[a] += self.visits[b]
            self.stops[a] += self.stops[b]
            for c, target in self.steps[b].items():
                self.taken[a][c] = self.taken[a].get(c, 0) + self.taken[b][c]
                if c in self.steps[a]:
                    todo.append((self.steps[a][c], target))
                else:
                    self.steps[a][c] = target

    def _merge(self) -> None:
        kept, open_ = [0], deque((0, c) for c in sorted(self.steps[0]))
        while open_:
            source, c = open_.popleft()
            state = self.steps[source][c]
            if state in kept:
                continue
            home = next((k for k in kept if self._alike(k, state)), None)
            if home is None:
                kept.append(state)
                open_.extend((state, d) for d in sorted(self.steps[state]))
                continue
            self.steps[source][c] = home
            self._fold(home, state)
            open_.extend((k, d) for k in kept for d, t in sorted(self.steps[k].items()) if t not in kept)
        self.states = kept

    def fit(self, string: str) -> float:
        """Mean log ratio per symbol of the automaton's likelihood to random symbols."""
        if not string:
            return 0.0
        state, total = 0, 0.0
        for c in string:
            n = self.visits[state] + UNSEEN * SYMBOLS if state is not None else 1
            seen = self.taken[state].get(c, 0) if state is not None else 0
            total += math.log((seen + UNSEEN) / n * SYMBOLS) if state is not None else math.log(UNSEEN)
            if seen:
                state = self.steps[state][c]
            # After an unknown symbol the automaton goes on from where it was.
        return total / len(string)
