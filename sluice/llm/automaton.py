"""Suffix automaton of several strings of numbers that knows, for every substring, the first string that holds it."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence


class SuffixAutomaton:
    """Strings are added in order; every state keeps the number given with the string that made it.

    A state stands for substrings that end at the same places. Since a state is made by the first string that has its
    longest substring, and a clone takes over from the state it is split off, the number is that of the first string.
    """

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [0]

    def add(self, string: Iterable[int], number: int) -> None:
        nxt, link, length, first = self.next, self.link, self.length, self.first

        def state(size: int, moves: dict[int, int], suffix: int, own: int) -> int:
            nxt.append(moves)
            link.append(suffix)
            length.append(size)
            first.append(own)
            return len(nxt) - 1

        def split(p: int, c: int, q: int) -> int:
            """The state for the substrings that p reaches by c, where q also stands for longer ones."""
            clone = state(length[p] + 1, dict(nxt[q]), link[q], first[q])
            link[q] = clone
            while p >= 0 and nxt[p].get(c) == q:
                nxt[p][c] = clone
                p = link[p]
            return clone

        last = 0
        for c in string:
            q = nxt[last].get(c)
            if q is not None:
                last = q if length[q] == length[last] + 1 else split(last, c, q)
                continue
            new = state(length[last] + 1, {}, 0, number)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = new
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                link[new] = q if length[q] == length[p] + 1 else split(p, c, q)
            last = new

    def first_holders(self, string: Sequence[int], size: int) -> Iterator[int]:
        """Stream a string, following its matching statistics; for each of its windows of ``size`` the number of the first
        string that holds it, or -1."""
        nxt, link, length, first = self.next, self.link, self.length, self.first
        at, matched = 0, 0
        for i, c in enumerate(string):
            while at and c not in nxt[at]:
                at = link[at]
                matched = length[at]
            if c in nxt[at]:
                at = nxt[at][c]
                matched += 1
            if matched >= size:
                while length[link[at]] >= size:  # the state for the window itself
                    at = link[at]
                    matched = length[at]
            if i >= size - 1:
                yield first[at] if matched >= size else -1
