"""Maximal runs of words that repeat with a period, by harmonic-grid enumeration over longest common extensions.

A run is a stretch with smallest period q (words q apart are identical) and at least ``max(MIN_LENGTH, 2 * q)`` words that
no neighbouring word extends. A run of period p holds two neighbouring multiples of p, so the grid of all multiples of all
periods, about n ln n pairs of a text with n words, meets every run. Where the words of a pair agree, extending it both
ways gives the stretch; the smallest period of equal stretches is the run's.

Extensions compare a few words first. Those that go on are answered by a difference cover: of every ``MODULUS`` positions
only the cover's suffixes are sorted, any two positions reach sampled ones at a common distance below ``MODULUS``, and a
sparse table over the common prefixes of neighbours in the sorted order gives the rest. It is built over those texts of a
chunk that need it, once forward and once backward.

Defined cases: a null, empty or blank text has no words and no runs, and its kept text is empty; a text shorter than
``MIN_LENGTH`` words has no runs; very long texts are searched whole, with memory in proportion to their words (the grid
goes in slices); repeated rows and null ids are treated like any row; an empty table gives no rows. Words are compared by
64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sluice.llm.frames import append, list_array, struct
from sluice.llm.texts import Words, chunks, mixed, ranges, take

MIN_LENGTH = 12
MODULUS = 64
_ROOT = 8
_FEW = 16  # words compared before the structure is asked
_SLICE = 1 << 19


def _cover() -> np.ndarray:
    """Residues such that any two positions reach members of it at some common distance below MODULUS."""
    inside = np.zeros(MODULUS, bool)
    inside[:_ROOT] = inside[::_ROOT] = True
    return inside


_INSIDE = _cover()


def _distances() -> np.ndarray:
    """[residue of i, residue of j] -> the least distance after which both are in the cover."""
    steps = np.arange(MODULUS)
    i, j, d = np.meshgrid(steps, steps, steps, indexing="ij")
    return (_INSIDE[(i + d) % MODULUS] & _INSIDE[(j + d) % MODULUS]).argmax(axis=2)


_DISTANCE = _distances()


def agreement(symbols: np.ndarray, i: np.ndarray, j: np.ndarray, step: int, limit: int | np.ndarray) -> np.ndarray:
    """Number of equal symbols from i and j on, in the direction of ``step``, up to ``limit``."""
    out = np.zeros(len(i), np.int64)
    most = int(np.max(limit, initial=0))
    live = np.arange(len(i)) if np.isscalar(limit) else np.flatnonzero(limit > 0)
    for t in range(most):
        live = live[symbols[i[live] + step * t] == symbols[j[live] + step * t]]
        out[live] += 1
        if not np.isscalar(limit):
            live = live[limit[live] > t + 1]
        if not len(live):
            break
    return out


class Extensions:
    """Longest common extensions between positions of one symbol array.

    Symbols are numbers from 1 on; what two extensions may not pass must be a symbol that occurs once.
    """

    def __init__(self, symbols: np.ndarray):
        n, self.bits = len(symbols), max(1, int(symbols.max(initial=1)).bit_length())
        self.symbols = np.concatenate([symbols, np.zeros(2 * MODULUS, symbols.dtype)])  # 0 ends every comparison
        inside = _INSIDE[np.arange(n) % MODULUS]
        self.at = np.flatnonzero(inside)
        self.slot = np.cumsum(inside) - 1  # of sampled positions: their place in ``at``
        order, levels = self._sorted(n)
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.table = self._minima(self._neighbours(order, levels, n))

    def _keys(self, positions: np.ndarray, first: int) -> np.ndarray:
        """As many symbols from ``first`` on as fit into one number."""
        key = np.zeros(len(positions), np.int64)
        for k in range(first, first + 63 // self.bits):
            key = (key << self.bits) | self.symbols[positions + k]
        return key

    def _sorted(self, n: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Order of the sampled suffixes, and their ranks by the first MODULUS, 2 MODULUS, ... symbols."""
        m = len(self.at)
        order, rank = np.arange(m), np.zeros(m, np.int64)
        tied = np.arange(m)  # places in the order that share their rank with a neighbour

        def refine(key: np.ndarray) -> None:
            """Sort equal ranks by ``key``, given for the suffixes order[tied]; a rank is the first place of its group."""
            nonlocal tied
            members = order[tied]
            by = np.lexsort((key, rank[members]))
            members, key = members[by], key[by]
            old = rank[members]
            order[tied] = members
            new = np.ones(len(tied), bool)
            new[1:] = (old[1:] != old[:-1]) | (key[1:] != key[:-1])
            first = np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))
            rank[members] = tied[first]
            alone = new & np.append(new[1:], True)
            tied = tied[~alone]

        for first in range(0, MODULUS, 63 // self.bits):
            if len(tied):
                refine(self._keys(self.at[order[tied]], first))
        levels, reach = [rank.copy()], MODULUS
        while len(tied):
            after = self.at[order[tied]] + reach
            known = after < n
            refine(np.where(known, levels[-1][self.slot[np.where(known, after, 0)]], -1))
            levels.append(rank.copy())
            reach *= 2
        return order, levels

    def _neighbours(self, order: np.ndarray, levels: list[np.ndarray], n: int) -> np.ndarray:
        """Common prefixes of neighbours in the order."""
        a, b = self.at[order[:-1]], self.at[order[1:]]
        shared = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            i, j = a + shared, b + shared
            known = np.maximum(i, j) < n
            rank = levels[k][self.slot[np.where(known, [i, j], 0)]]
            shared += np.where(known & (rank[0] == rank[1]), MODULUS << k, 0)
        inner = np.maximum(a, b) + shared < n
        shared[inner] += agreement(self.symbols, (a + shared)[inner], (b + shared)[inner], 1, 2 * MODULUS)  # keys reach a little beyond MODULUS
        return shared

    def _minima(self, values: np.ndarray) -> list[np.ndarray]:
        """Sparse table: minima over stretches of 1, 2, 4, ... values."""
        table = [values.astype(np.int32 if values.max(initial=0) < 2**31 else np.int64)]
        while 2 << (len(table) - 1) <= len(values):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        return table

    def between(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of symbols on which the suffixes at i and j (i != j) agree."""
        distance = _DISTANCE[i % MODULUS, j % MODULUS]
        out = agreement(self.symbols, i, j, 1, distance)
        on = np.flatnonzero(out == distance)
        p, q = self.place[self.slot[i[on] + distance[on]]], self.place[self.slot[j[on] + distance[on]]]
        low, high = np.minimum(p, q), np.maximum(p, q)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level):
            here = level == k
            row = self.table[k]
            out[on[here]] += np.minimum(row[low[here]], row[high[here] - (1 << k)])
        return out


def _grid(first: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, i, p) for all multiples i and i + p of all periods p of each text, slice by slice."""
    half = counts // 2
    text, period = np.repeat(np.arange(len(counts)), half), ranges(np.ones(len(counts), np.int64), half)
    steps = (counts[text] - 1) // period
    ends = np.cumsum(steps)
    at = 0
    while at < len(text):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + _SLICE, "right")))
        n = steps[at:to]
        p = np.repeat(period[at:to], n)
        yield np.repeat(text[at:to], n), np.repeat(first[text[at:to]], n) + ranges(np.zeros(to - at, np.int64), n) * p, p
        at = to


def _distinct(runs: np.ndarray) -> np.ndarray:
    """Columns (text, start, length, period) in order; of equal stretches the one with the smallest period."""
    runs = runs[:, np.lexsort(runs[::-1])]
    new = np.ones(runs.shape[1], bool)
    new[1:] = (runs[:3, 1:] != runs[:3, :-1]).any(axis=0)
    return runs[:, new]


def find_runs(words: np.ndarray, row_start: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Runs in texts given as word hashes: columns of text, start, length and period, by text, start and length."""
    counts = np.diff(row_start)
    rows = len(counts)
    # a separator of its own before every text and at the end
    symbols = mixed(np.arange(1, len(words) + rows + 2, dtype=np.uint64) ^ np.uint64(0xA5A5_5A5A_C3C3_3C3C))
    first = row_start[:-1] + np.arange(rows) + 1
    symbols[ranges(first, counts)] = words
    equal = np.cumsum(np.append(True, symbols[1:] != symbols[:-1]))  # number of the stretch of one word
    found, open_pairs = [np.zeros((4, 0), np.int64)], [np.zeros((3, 0), np.int64)]

    def keep(text: np.ndarray, i: np.ndarray, p: np.ndarray, before: np.ndarray, after: np.ndarray) -> None:
        length = p + before + after
        long = length >= np.maximum(min_length, 2 * p)
        runs = np.stack([text, i - before - first[text], length, p])[:, long]
        found.append(_distinct(runs))

    for text, i, p in _grid(first, np.where(counts >= min_length, counts, 0)):
        # pairs within a stretch of one word find that stretch, as period 1 does
        same = (symbols[i] == symbols[i + p]) & ((p == 1) | (equal[i] != equal[i + p]))
        text, i, p = text[same], i[same], p[same]
        after = agreement(symbols, i, i + p, 1, _FEW)
        before = agreement(symbols, i - 1, i + p - 1, -1, _FEW)
        more = (after == _FEW) | (before == _FEW)
        keep(text[~more], i[~more], p[~more], before[~more], after[~more])
        open_pairs.append(np.stack([text, i, p])[:, more])
    text, i, p = np.concatenate(open_pairs, axis=1)
    if len(text):
        used = np.unique(text)
        # the used texts with the separators around them
        compact, at = take(symbols, first[used] - 1, first[used] + counts[used] + 1)
        shift = np.zeros(rows, np.int64)
        shift[used] = at[:-1] + 1 - first[used]
        numbers = np.unique(compact, return_inverse=True)[1] + 1
        # separators stand once in ``symbols`` but are cut out twice between neighbours: number them anew
        ends = np.concatenate([at[:-1], at[1:] - 1])
        numbers[ends] = numbers.max() + 1 + np.arange(len(ends))
        forward, backward = Extensions(numbers), Extensions(numbers[::-1])
        for a in range(0, len(text), _SLICE):
            t, x, y = text[a : a + _SLICE], i[a : a + _SLICE], p[a : a + _SLICE]
            u = x + shift[t]
            keep(t, x, y, backward.between(len(numbers) - u, len(numbers) - u - y), forward.between(u, u + y))
    return _distinct(np.concatenate(found, axis=1))


def _search(texts: pa.Array, min_length: int) -> pa.StructArray:
    n_words, n_runs, runs, kept = [], [], [np.zeros((4, 0), np.int64)], []
    for _, _, data, offsets in chunks(texts):
        words = Words(data, offsets)
        found = find_runs(words.hashes(), words.row_start, min_length)
        n_words.append(words.counts())
        n_runs.append(np.bincount(found[0], minlength=len(offsets) - 1))
        runs.append(found)
        at = words.row_start[found[0]] + found[1]
        step = np.zeros(len(words) + 1, np.int64)
        np.add.at(step, at + found[3], 1)
        np.add.at(step, at + found[2], -1)
        stay = np.cumsum(step[:-1]) == 0
        joined, ends = take(data, words.start[stay], words.end[stay], gap=1)
        cut = ends[np.searchsorted(np.flatnonzero(stay), words.row_start)]
        joined, ends = take(joined, cut[:-1], np.maximum(cut[1:] - 1, cut[:-1]))  # without the space after the last word
        buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(joined)]
        kept.append(pa.StringArray.from_buffers(len(offsets) - 1, *buffers[1:]))
    whole = np.concatenate(runs, axis=1)
    each = pa.StructArray.from_arrays([pa.array(whole[k]) for k in (1, 2, 3)], ["start", "length", "period"])
    return struct(
        n_words=np.concatenate([*n_words, np.zeros(0, np.int64)]).astype(np.int64),
        runs=list_array(each, np.concatenate([*n_runs, np.zeros(0, np.int64)])),
        kept=pa.concat_arrays(kept) if kept else pa.array([], pa.string()),
    )


def periodic_runs(docs: DataFrame, text: str = "text", name: str = "periodic", min_length: int = MIN_LENGTH) -> DataFrame:
    """``docs`` with a struct column: ``n_words``, ``runs`` (start, length and period in words, by start, then length) and
    ``kept`` (the words that no run repeats, joined by one space)."""
    fields = "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, kept string"
    return append(docs, text, lambda texts: _search(texts, min_length), fields, name)
