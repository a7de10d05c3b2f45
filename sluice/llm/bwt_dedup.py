"""Dedup of repeated byte strings by interval expansion on a Burrows-Wheeler transform.

Removed is every byte covered by a ``WINDOW``-byte string that also starts earlier, in a document with a smaller id or before
it in the same document; strings are judged on the input, and never cross documents. Text that repeats at all is found by
anchors (``anchors.py``) and dealt into shards that hold all pieces which could match. Windows whose hash no other of the shard has
stand nowhere else; a collision keeps one that could go. Each task sorts the suffixes of what is left of its shard up to the threshold, and derives common-prefix lengths from the transform alone: breadth first, the interval of every string is
extended backward by each byte, so that boundaries between suffixes get their values in increasing order. The expansion
stops at the threshold; what no boundary separates by then are equal strings, and the earliest of each is looked up.

Defined cases: null and empty texts have no bytes; texts shorter than the window lose nothing; repeated rows (same id and
text) are judged alike and don't remove each other; two texts with one id are two documents, neither before the other; a null id
counts as the smallest; what is kept may cut a character in two, so it is binary; other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sluice.llm.anchors import Unit, marked, repeated_spans, with_spans
from sluice.llm.frames import append, free_name, list_array, struct
from sluice.llm.substring_dedup import runs_by_row
from sluice.llm.texts import CHUNK_BYTES, byte_values, chunks, ranges, rolling, span_hash

WINDOW = 100
GRAM = 16
_PLACE_BITS = 40


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their suffixes, compared over ``depth`` symbols at least; symbols are below 512."""
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(7, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(7):
        key = key << 9 | padded[k : n + k]
    order = np.argsort(key)
    new = np.concatenate([[True], key[order[1:]] != key[order[:-1]]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    tied = ~(new & np.append(new[1:], True))
    slots, h = np.flatnonzero(tied), 7
    while h < depth and len(slots):
        at = order[slots]
        after = at + h
        key = rank[at] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[slots] = at
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[at] = np.maximum.accumulate(np.where(new, slots, 0))
        tied = ~(new & np.append(new[1:], True))
        slots, h = slots[tied], 2 * h
    return order


def equal_strings(symbols: np.ndarray, order: np.ndarray, size: int) -> np.ndarray:
    """Group number of each place in the suffix order: places in one group have equal strings of ``size`` symbols.

    Symbol 0 ends a piece; no string is extended backward over it. ``common`` gets the length of the common prefix of
    neighbouring suffixes, for lengths below ``size``, by increasing length.
    """
    n = len(order)
    before = symbols[order - 1]
    by_symbol = np.argsort(before, kind="stable")
    kind = np.int32 if n < 1 << 31 else np.int64  # of places: half as much to move and to sort
    step = np.empty(n, kind)  # where a suffix stands once its preceding symbol is put before it
    step[by_symbol] = np.arange(n, dtype=kind)
    leading = before[by_symbol]
    common = np.full(n + 1, -1, np.int16)
    common[0] = common[n] = 0
    owner = np.zeros(n, kind)
    low, high = np.array([0]), np.array([n])  # the interval of the empty string, end exclusive
    for length in range(size):
        if not len(low):
            break
        size_of = high - low
        which = np.repeat(np.arange(len(low), dtype=kind), size_of)
        ends = np.cumsum(size_of, dtype=np.int64)
        inside = np.arange(ends[-1], dtype=kind) + np.repeat((low - ends + size_of).astype(kind), size_of)
        if length:
            go = before[inside] != 0
            inside, which = inside[go], which[go]
        if not len(inside):
            break
        to = step[inside]
        owner[to] = which
        to.sort()
        own, symbol = owner[to], leading[to]
        cut = (to[1:] != to[:-1] + 1) | (own[1:] != own[:-1]) | (symbol[1:] != symbol[:-1])
        first = np.flatnonzero(np.concatenate([[True], cut]))
        low, high = to[first], to[np.append(first[1:], len(to)) - 1] + 1
        new = common[high] < 0
        low, high = low[new], high[new]
        common[high] = length
    return np.cumsum(common[:n] >= 0)


def _several(raw: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Marks the windows of all pieces whose hash another one has; those are all that can have an equal. Pieces start at ``at``."""
    parts, first = [], 0
    while first < len(at) - 1:
        end = max(first + 1, int(np.searchsorted(at, at[first] + CHUNK_BYTES, "right")) - 1)
        row_start = at[first : end + 1] - at[first]
        place = ranges(row_start[:-1], np.diff(row_start) - size)
        prefix = rolling(byte_values()[raw[at[first] : at[end]]])
        parts.append(span_hash(prefix, place, place + size))
        first = end
    hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    by_value = np.sort(hashes)
    twice = by_value[1:][by_value[1:] == by_value[:-1]]
    if not len(twice):
        return np.zeros(len(hashes), bool)
    return twice[np.minimum(np.searchsorted(twice, hashes), len(twice) - 1)] == hashes


def _shortened(raw: np.ndarray, place: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols under the windows at the given places, with a 0 after each run of them, and where those windows are there."""
    step = np.zeros(len(raw) + 1, np.int32)
    step[place] = 1
    step -= np.concatenate([np.zeros(size, np.int32), step[:-size]])
    kept = np.flatnonzero(np.cumsum(step[:-1]) > 0)
    new = np.concatenate([[False], kept[1:] != kept[:-1] + 1])
    to = np.arange(len(kept)) + np.cumsum(new)
    symbols = np.zeros(int(to[-1]) + 2, np.int16)
    symbols[to] = raw[kept].astype(np.int16) + 1
    return symbols, to[np.searchsorted(kept, place)]


def bwt_compare(pieces: list[bytes], rank: np.ndarray, start: np.ndarray, size: int = WINDOW):
    """Runs of windows with one first place, for each piece; see ``anchors.Compare``."""
    lengths = np.array([len(p) for p in pieces], np.int64)
    raw = np.frombuffer(b"\0".join([*pieces, b""]), np.uint8)
    at = np.concatenate([[0], np.cumsum(lengths + 1)])
    windows = lengths - size + 1
    place = ranges(at[:-1], windows)
    piece = np.repeat(np.arange(len(pieces)), windows)
    offset = place - at[piece]
    key = rank[piece].astype(np.int64) << _PLACE_BITS | (start[piece] + offset)
    found = key.copy()  # a window that no other equals stands first where it is
    several = np.flatnonzero(_several(raw, at, size))
    if len(several):
        symbols, to = _shortened(raw, place[several], size)
        order = suffix_order(symbols, size)
        group = np.empty(len(order), np.int64)
        group[order] = equal_strings(symbols, order, size)
        group = group[to]
        earliest = np.full(int(group.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(earliest, group, key[several])
        found[several] = earliest[group]
    first_rank, first_place = found >> _PLACE_BITS, (found & ((1 << _PLACE_BITS) - 1)) - offset
    new = np.concatenate([[True], (piece[1:] != piece[:-1]) | (first_rank[1:] != first_rank[:-1]) | (first_place[1:] != first_place[:-1])])
    run = np.flatnonzero(new)
    last = np.append(run[1:], len(new)) - 1
    holder = np.zeros(int(rank.max()) + 1, np.int64)
    holder[rank] = np.arange(len(pieces))
    return piece[run], offset[run], offset[last], holder[first_rank[run]], first_place[run]


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WINDOW, gram: int = GRAM, name: str = "dedup"
) -> DataFrame:
    """``docs`` with a struct column: ``n_bytes``, ``removed`` (maximal runs of bytes, ends exclusive) and ``kept``, what is left."""
    unit = Unit("bytes", size, gram)
    spans = repeated_spans(docs, unit, lambda p, r, s: bwt_compare(p, r, s, size), True, doc_id, text)
    names = free_name(docs, "_spans"), free_name(docs, "_has_spans")
    found = with_spans(docs, spans, doc_id, text, names)

    def run(texts: pa.Array, spans: pa.Array, has: pa.Array) -> pa.StructArray:
        counts, low, high, n_spans, kept = [], [], [], [], []
        for first, end, data, offsets in chunks(texts):
            n = np.diff(offsets)
            gone = marked(spans.slice(first, end - first), has.slice(first, end - first), offsets, n >= size)
            _, row, begin, stop = runs_by_row(gone, offsets)
            left = data[~gone].tobytes()
            ends = np.concatenate([[0], np.cumsum(~gone)])[offsets]
            counts.append(n)
            low.append(begin)
            high.append(stop)
            n_spans.append(np.bincount(row, minlength=len(n)))
            kept += [left[a:b] for a, b in zip(ends[:-1], ends[1:])]
        flat = lambda parts: np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
        removed = pa.StructArray.from_arrays([pa.array(flat(low)), pa.array(flat(high))], ["low", "high"])
        return struct(n_bytes=flat(counts), removed=list_array(removed, flat(n_spans)), kept=pa.array(kept, pa.binary()))

    fields = "n_bytes bigint, removed array<struct<low: bigint, high: bigint>>, kept binary"
    return append(found, [text, *names], run, fields, name).drop(*names)
