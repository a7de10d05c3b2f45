"""Edit distance of many pairs of number sequences at a time, by banded alignment."""

from __future__ import annotations

import numpy as np

from sluice.llm.texts import mixed, powers, rolling

_FAR = 1 << 28
_TOGETHER = 1 << 19  # cells of a batch: pairs times diagonals
_WORDS = 1 << 20  # of a batch
_GRAM = 3
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _stripped(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the common beginning and end."""
    n = min(len(a), len(b))
    unlike = np.flatnonzero(a[:n] != b[:n])
    head = int(unlike[0]) if len(unlike) else n
    a, b, n = a[head:], b[head:], n - head
    unlike = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    tail = int(unlike[0]) if len(unlike) else n
    return a[: len(a) - tail], b[: len(b) - tail]


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the multiset intersection."""
    both, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    n = len(both)
    return int(np.minimum(np.bincount(inverse[: len(a)], minlength=n), np.bincount(inverse[len(a) :], minlength=n)).sum())


def _grams(a: np.ndarray) -> np.ndarray:
    """Hashes of the runs of ``_GRAM`` symbols."""
    key = np.zeros(max(0, len(a) - _GRAM + 1), np.uint64)
    for k in range(_GRAM):
        key = key * _FACTOR + a[k : k + len(key)].astype(np.uint64)
    return key


def _few_grams(a: np.ndarray, b: np.ndarray, limit: int) -> bool:
    """An edit spoils at most ``_GRAM`` runs, so too few runs in common rule the limit out."""
    needed = max(len(a), len(b)) - _GRAM + 1 - _GRAM * limit
    return needed > 0 and (min(len(a), len(b)) < _GRAM or _shared(_grams(a), _grams(b)) < needed)


def _agreeing(prefix: np.ndarray, words: np.ndarray, i: np.ndarray, j: np.ndarray, room: np.ndarray) -> np.ndarray:
    """How many words agree from i and j on, up to ``room``: runs of doubling length by hash, then of halving length."""
    out = np.zeros(len(i), np.int64)
    live = np.flatnonzero(room > 0)
    live = live[words[i[live]] == words[j[live]]]
    out[live] = 1
    inverse = powers(len(prefix))[1]

    def same(cells: np.ndarray, k: int) -> np.ndarray:
        cells = cells[room[cells] - out[cells] >= k]
        x, y = i[cells] + out[cells], j[cells] + out[cells]
        cells = cells[(prefix[x + k] - prefix[x]) * inverse[x] == (prefix[y + k] - prefix[y]) * inverse[y]]
        out[cells] += k
        return cells

    k, rest = 1, [live]
    while len(live):
        live = same(live, k)
        rest.append(live)
        k *= 2
    # cells that went on at length k / 2 and failed at k agree on less than k more; the lists are nested
    for cells in reversed(rest[:-1]):
        k //= 2
        if k > 1:
            same(cells, k // 2)
    return out


def _banded(pairs: list[tuple[np.ndarray, np.ndarray]], limits: np.ndarray) -> np.ndarray:
    """Edit distances up to the limits, else limit + 1, by diagonals: with each further edit the band of diagonals grows by one
    on either side, and every diagonal of it goes as far as the words agree.

    Diagonals from which the limit doesn't reach the last word any more are left out.
    """
    n, m = [np.array([len(x[side]) for x in pairs], np.int64) for side in (0, 1)]
    words = mixed(np.concatenate([x for pair in pairs for x in pair]).astype(np.int64).view(np.uint64))
    ends = np.cumsum(np.stack([n, m], 1).reshape(-1))
    a_at, b_at = ends[0::2] - n, ends[1::2] - m
    prefix = rolling(words)
    most, delta = int(limits.max(initial=0)), m - n
    far = np.full((len(pairs), 2 * most + 3), -_FAR, np.int64)  # column most + 1 + d: diagonal d, the furthest word of a
    out = limits + 1
    live = np.flatnonzero(np.abs(delta) <= limits)
    for edits in range(most + 1):
        if not len(live):
            break
        low = most + 1 - edits
        width = 2 * edits + 1
        diagonal = np.arange(-edits, edits + 1)
        if edits:
            before = far[live, low - 1 : low + width + 1]
            x = np.maximum(np.maximum(before[:, 1:-1], before[:, 2:]) + 1, before[:, :-2])
        else:
            x = np.zeros((len(live), 1), np.int64)
        x = np.minimum(x, np.minimum(n[live, None], m[live, None] - diagonal))
        useful = (np.abs(diagonal - delta[live, None]) <= limits[live, None] - edits) & (x >= 0) & (x + diagonal >= 0)
        row, column = np.nonzero(useful)
        at, d, own = x[row, column], diagonal[column], live[row]
        x[row, column] += _agreeing(prefix, words, a_at[own] + at, b_at[own] + at + d, np.minimum(n[own] - at, m[own] - at - d))
        far[live, low : low + width] = np.where(useful, x, -_FAR)
        inside = np.abs(delta[live]) <= edits
        there = np.zeros(len(live), bool)
        there[inside] = far[live[inside], most + 1 + delta[live[inside]]] >= n[live[inside]]
        out[live[there]] = edits
        live = live[~there & (limits[live] > edits)]
    return out


def distances(pairs: list[tuple[np.ndarray, np.ndarray]], limits: np.ndarray) -> np.ndarray:
    """Edit distance of each pair if it is at most its limit, else limit + 1.

    Pairs whose lengths, words or runs of words in common rule the limit out are settled first; the others are aligned.
    """
    out = np.asarray(limits, np.int64) + 1
    open_pairs = []
    for k, (a, b) in enumerate(pairs):
        if abs(len(a) - len(b)) > limits[k] or _few_grams(a, b, int(limits[k])):
            continue
        a, b = _stripped(a, b)
        if max(len(a), len(b)) <= limits[k]:  # may be all unlike and still be within the limit
            rough = max(len(a), len(b))
            if min(len(a), len(b)) == 0:
                out[k] = rough
                continue
        if abs(len(a) - len(b)) <= limits[k] and max(len(a), len(b)) - _shared(a, b) <= limits[k]:
            open_pairs.append((k, a, b))
    open_pairs.sort(key=lambda x: limits[x[0]])
    while open_pairs:
        # as many as fit, and one at least
        size, words = 1, len(open_pairs[0][1]) + len(open_pairs[0][2])
        while size < len(open_pairs) and (size + 1) * (2 * limits[open_pairs[size][0]] + 3) <= _TOGETHER:
            words += len(open_pairs[size][1]) + len(open_pairs[size][2])
            if words > _WORDS:
                break
            size += 1
        batch, open_pairs = open_pairs[:size], open_pairs[size:]
        at = np.array([k for k, _, _ in batch])
        out[at] = _banded([(a, b) for _, a, b in batch], np.asarray(limits, np.int64)[at])
    return out
