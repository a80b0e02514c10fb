"""Probabilistic automata learned from example strings by state merging.

A prefix tree of the examples holds how often each state was reached, left and ended in. In
breadth-first order each new state is merged into the first earlier state whose frequencies it
is compatible with, by Hoeffding's bound on every pair of frequencies in both subtrees;
otherwise it becomes a state of its own.
"""

from __future__ import annotations

import math
from collections import Counter, deque

#: Character classes that strings are read as; any other character is a class by itself.
CLASSES = {**{c: "d" for c in "0123456789"}, **{c: "h" for c in "abcdef"},
           **{c: "l" for c in "ghijklmnopqrstuvwxyz"}, **{c: "H" for c in "ABCDEF"},
           **{c: "L" for c in "GHIJKLMNOPQRSTUVWXYZ"}}
#: Probability of a step that no example took.
UNSEEN = 1e-4


_TABLE = str.maketrans(CLASSES)


def classes(text: str) -> str:
    return text.translate(_TABLE)


class Automaton:
    """States with counts: `visits`, `ends`, and for each symbol the next state and its count."""

    def __init__(self) -> None:
        self.visits: list[int] = []
        self.ends: list[int] = []
        self.steps: list[dict[str, list[int]]] = []

    def _new(self) -> int:
        self.visits.append(0)
        self.ends.append(0)
        self.steps.append({})
        return len(self.visits) - 1

    @classmethod
    def learn(cls, examples: list[str], alpha: float = 0.05, most: int | None = None) -> Automaton:
        """The prefix tree of the examples with compatible states merged.

        Of an example longer than `most` only the beginning is read, and no end."""
        self = cls()
        self._new()
        for text, n in sorted(Counter(classes(x) for x in examples).items()):
            state = 0
            self.visits[0] += n
            for symbol in text[:most]:
                step = self.steps[state].get(symbol)
                if step is None:
                    step = self.steps[state][symbol] = [self._new(), 0]
                step[1] += n
                state = step[0]
                self.visits[state] += n
            if most is None or len(text) <= most:
                self.ends[state] += n
        self._merge(math.sqrt(0.5 * math.log(2 / alpha)))
        return self

    def _merge(self, bound: float) -> None:
        kept = [0]
        queue = deque((0, symbol) for symbol in sorted(self.steps[0]))
        while queue:
            parent, symbol = queue.popleft()
            state = self.steps[parent][symbol][0]
            if state in kept:
                continue
            for other in kept:
                if self._compatible(other, state, bound):
                    self.steps[parent][symbol][0] = other
                    self._fold(other, state)
                    # The fold may have given earlier states new steps.
                    queue.extend((k, s) for k in kept for s in sorted(self.steps[k])
                                 if self.steps[k][s][0] not in kept and (k, s) not in queue)
                    break
            else:
                kept.append(state)
                queue.extend((state, s) for s in sorted(self.steps[state]))
        number = {state: k for k, state in enumerate(kept)}
        self.visits = [self.visits[s] for s in kept]
        self.ends = [self.ends[s] for s in kept]
        self.steps = [{symbol: [number[to], n] for symbol, (to, n) in self.steps[s].items()}
                      for s in kept]

    def _compatible(self, a: int, b: int, bound: float) -> bool:
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            na, nb = self.visits[a], self.visits[b]
            if not na or not nb:
                continue
            most = bound * (na ** -0.5 + nb ** -0.5)
            if most >= 1:  # too few examples to tell, here and below
                continue
            if abs(self.ends[a] / na - self.ends[b] / nb) > most:
                return False
            one, other = self.steps[a], self.steps[b]
            for symbol in one.keys() | other.keys():
                x, y = one.get(symbol), other.get(symbol)
                if abs((x[1] if x else 0) / na - (y[1] if y else 0) / nb) > most:
                    return False
                if x and y:
                    stack.append((x[0], y[0]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below b to a."""
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            self.visits[a] += self.visits[b]
            self.ends[a] += self.ends[b]
            for symbol, (to, n) in self.steps[b].items():
                step = self.steps[a].get(symbol)
                if step is None:
                    self.steps[a][symbol] = [to, n]
                else:
                    step[1] += n
                    stack.append((step[0], to))

    def score(self, text: str) -> float:
        """Mean log-likelihood of a step, the end included."""
        return self.score_classes(classes(text))

    def score_classes(self, text: str) -> float:
        """The same for a text already read as classes."""
        state, total = 0, 0.0
        floor = math.log(UNSEEN)
        for symbol in text:
            step = self.steps[state].get(symbol)
            if step is None:
                total += floor
                state = 0
            else:
                total += max(floor, math.log(step[1] / self.visits[state]))
                state = step[0]
        ends = self.ends[state]
        total += max(floor, math.log(ends / self.visits[state])) if ends else floor
        return total / (len(text) + 1)
