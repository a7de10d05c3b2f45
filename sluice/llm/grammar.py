"""Probabilistic automata inferred from strings by state merging (ALERGIA)."""

from __future__ import annotations

import math
from collections.abc import Iterable

ALPHA = 0.05  # level of the test that keeps two states apart
_FLOOR = 1e-4  # probability of what an automaton has not seen


def shape(text: str) -> str:
    """Character classes: digits 0, a-f a, other small letters g, capitals A; anything else stands for itself."""
    return text.translate(_SHAPE)


_SHAPE = {
    **{ord(c): "0" for c in "0123456789"},
    **{ord(c): "a" for c in "abcdef"},
    **{ord(c): "g" for c in "ghijklmnopqrstuvwxyz"},
    **{c: "A" for c in range(65, 91)},
}


class Automaton:
    """States with counts of passages, endings and transitions; state 0 is the start."""

    def __init__(self, strings: Iterable[str], alpha: float = ALPHA):
        self.seen, self.ended = [0], [0]
        self.next: list[dict[str, int]] = [{}]
        self.taken: list[dict[str, int]] = [{}]
        for s in strings:
            self._add(s)
        self.factor = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_states()

    def _add(self, string: str) -> None:
        at = 0
        for c in string:
            self.seen[at] += 1
            self.taken[at][c] = self.taken[at].get(c, 0) + 1
            if c not in self.next[at]:
                self.next[at][c] = len(self.seen)
                self.seen.append(0)
                self.ended.append(0)
                self.next.append({})
                self.taken.append({})
            at = self.next[at][c]
        self.seen[at] += 1
        self.ended[at] += 1

    def _differ(self, a: int, na: int, b: int, nb: int) -> bool:
        """Hoeffding's bound: the two rates can't come from one probability."""
        return abs(a / na - b / nb) > self.factor * (1 / math.sqrt(na) + 1 / math.sqrt(nb))

    def _compatible(self, a: int, b: int) -> bool:
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            na, nb = self.seen[a], self.seen[b]
            if not na or not nb:
                continue
            if self._differ(self.ended[a], na, self.ended[b], nb):
                return False
            for c in self.taken[a].keys() | self.taken[b].keys():
                if self._differ(self.taken[a].get(c, 0), na, self.taken[b].get(c, 0), nb):
                    return False
                if c in self.next[a] and c in self.next[b]:
                    pairs.append((self.next[a][c], self.next[b][c]))
        return True

    def _fold(self, into: int, tree: int) -> None:
        pairs = [(into, tree)]
        while pairs:
            a, b = pairs.pop()
            self.seen[a] += self.seen[b]
            self.ended[a] += self.ended[b]
            for c, k in self.taken[b].items():
                self.taken[a][c] = self.taken[a].get(c, 0) + k
                if c in self.next[a]:
                    pairs.append((self.next[a][c], self.next[b][c]))
                else:
                    self.next[a][c] = self.next[b][c]

    def _merge_states(self) -> None:
        """Settle states outward from the start: each next one merges with the first compatible settled one, or is settled."""
        settled = [0]
        inside = {0}
        while True:
            edge = next(((s, c) for s in settled for c in sorted(self.next[s]) if self.next[s][c] not in inside), None)
            if edge is None:
                return
            state = self.next[edge[0]][edge[1]]
            into = next((s for s in settled if self._compatible(s, state)), None)
            if into is None:
                settled.append(state)
                inside.add(state)
            else:
                self.next[edge[0]][edge[1]] = into
                self._fold(into, state)

    def log_likelihood(self, string: str) -> float:
        at, total = 0, 0.0
        for c in string:
            if at is None or c not in self.next[at]:
                total += math.log(_FLOOR)
                at = self.next[at].get(c) if at is not None else None
                continue
            total += math.log(max(_FLOOR, self.taken[at][c] / self.seen[at]))
            at = self.next[at][c]
        if at is None or not self.seen[at]:
            return total + math.log(_FLOOR)
        return total + math.log(max(_FLOOR, self.ended[at] / self.seen[at]))
