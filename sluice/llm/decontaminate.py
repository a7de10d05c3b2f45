"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are windows of ``WINDOW`` consecutive words of the benchmark items (a shorter item is one pattern). For each
pattern length there is a shift table over blocks of two words, which says how far a search may jump, and buckets of
patterns by the hashes of their last and first block; what the buckets offer is compared byte by byte.

Many texts are searched in lockstep: each stretch of a text has a cursor, and one numpy step moves all of them.

Defined cases: a null or empty text has no words and no hits; a null or wordless item has no pattern; a null item id
counts as ``null``; repeated items or texts are found alike; an empty benchmark hits nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sluice.llm.frames import append, free_name, list_array, struct
from sluice.llm.texts import Words, byte_table, chunks, mixed, ranges, take

WINDOW = 10
#: benchmark bytes whose patterns one pass over the documents searches for
PASS_BYTES = 8 << 20
_STRETCH = 256
#: words are runs of ASCII letters and digits, and of everything beyond ASCII
SEPARATORS = ~byte_table(bytes([*range(48, 58), *range(97, 123), *range(128, 256)]))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _words(data: np.ndarray, offsets: np.ndarray) -> Words:
    return Words(_LOWER[data], offsets, SEPARATORS)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(a * np.uint64(0xD1342543DE82EF95) + b)


def _blocks(hashes: np.ndarray, size: int) -> np.ndarray:
    return hashes if size == 1 else _pair(hashes[:-1], hashes[1:])


@dataclass
class Patterns:
    """Search tables of all patterns of one length."""

    length: int
    block: int
    shift: np.ndarray  # by low bits of a block's hash
    key: np.ndarray  # sorted: last and first block of each pattern
    text: np.ndarray  # words of the patterns, a space after each
    text_at: np.ndarray
    item_at: np.ndarray  # items of each pattern
    items: np.ndarray


def compile_patterns(item_ids: list[str], texts: pa.Array, window: int = WINDOW) -> list[Patterns]:
    found: dict[int, dict[bytes, set[int]]] = {}
    for first, _, data, offsets in chunks(texts):
        words = _words(data, offsets)
        for row, n in enumerate(words.counts()):
            all_words = words.text(row).split(b" ") if n else []
            size = min(window, int(n))
            for i in range(int(n) - size + 1 if n else 0):
                found.setdefault(size, {}).setdefault(b" ".join(all_words[i : i + size]), set()).add(first + row)
    return [_tables(size, found[size], item_ids) for size in sorted(found)]


def _tables(size: int, patterns: dict[bytes, set[int]], item_ids: list[str]) -> Patterns:
    texts = pa.array([t + b" " for t in patterns], pa.large_binary())
    data = np.frombuffer(texts.buffers()[2], np.uint8)
    at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1)
    hashes = Words(data, at, SEPARATORS).hashes().reshape(len(texts), size)
    block = min(2, size)
    blocks = hashes if block == 1 else _pair(hashes[:, :-1], hashes[:, 1:])
    width = 1 << max(12, min(22, (4 * blocks.size).bit_length()))
    shift = np.full(width, size - block + 1, np.int64)
    for j in range(blocks.shape[1]):
        np.minimum.at(shift, (blocks[:, j] % np.uint64(width)).astype(np.int64), size - block - j)
    key = _pair(blocks[:, -1], blocks[:, 0])
    order = np.argsort(key, kind="stable")
    owners = list(patterns.values())
    text, text_at = take(data, at[:-1][order], at[1:][order])
    owned = [sorted({item_ids[i] for i in owners[k]}) for k in order]
    item_at = np.concatenate([[0], np.cumsum([len(x) for x in owned])])
    return Patterns(size, block, shift, key[order], text, text_at, item_at, np.array([i for x in owned for i in x], object))


def _starts(words: Words, blocks: np.ndarray, p: Patterns) -> np.ndarray:
    """Window starts at which the shift table lets a cursor stop; ascending."""
    begin, end = words.row_start[:-1], words.row_start[1:] - p.length + 1
    begin, end = begin[end > begin], end[end > begin]
    pieces = -(-(end - begin) // _STRETCH)
    at = np.repeat(begin, pieces) + _STRETCH * ranges(np.zeros(len(begin), np.int64), pieces)
    stop = np.minimum(at + _STRETCH, np.repeat(end, pieces))
    slots, mask, last = p.shift, np.uint64(len(p.shift) - 1), p.length - p.block
    found = []
    while len(at):
        jump = slots[(blocks[at + last] & mask).astype(np.int64)]
        found.append(at[jump == 0])
        at = at + np.maximum(jump, 1)
        go = at < stop
        at, stop = at[go], stop[go]
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _occurrences(words: Words, hashes: np.ndarray, p: Patterns) -> tuple[np.ndarray, np.ndarray]:
    """(window start, pattern) of every occurrence in a chunk."""
    if len(hashes) < p.length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    blocks = _blocks(hashes, p.block)
    start = _starts(words, blocks, p)
    key = _pair(blocks[start + p.length - p.block], blocks[start])
    low, high = np.searchsorted(p.key, key, "left"), np.searchsorted(p.key, key, "right")
    some = high > low
    start, low, high = start[some], low[some], high[some]
    pattern = ranges(low, high - low)
    start = np.repeat(start, high - low)
    # direct comparison: the window's words, a space after each, against the pattern's
    at = ranges(start, np.full(len(start), p.length))
    size = (words.end - words.start)[at].reshape(-1, p.length).sum(1) + p.length
    same = size == p.text_at[pattern + 1] - p.text_at[pattern]
    start, pattern = start[same], pattern[same]
    if not len(start):
        return start, pattern
    at = ranges(start, np.full(len(start), p.length))
    here, _ = take(words.data, words.start[at], words.end[at], gap=1)
    there, bounds = take(p.text, p.text_at[pattern], p.text_at[pattern + 1])
    same = np.logical_and.reduceat(here == there, bounds[:-1])
    return start[same], pattern[same]


def search(texts: pa.Array, tables: list[Patterns]) -> pa.StructArray:
    """For each text: its number of words, the words that lie in occurrences, and the items that occur."""
    n_words, n_hit, hits, n_items, items = [], [], [], [], []
    for _, _, data, offsets in chunks(texts):
        words = _words(data, offsets)
        hashes = words.hashes()
        hit = np.zeros(len(words), bool)
        pairs: set[tuple[int, str]] = set()
        for p in tables:
            start, pattern = _occurrences(words, hashes, p)
            if len(start):
                hit[ranges(start, np.full(len(start), p.length))] = True
                row = np.searchsorted(words.row_start, start, "right") - 1
                for r, k in np.unique(np.stack([row, pattern], 1), axis=0):
                    pairs.update((int(r), i) for i in p.items[p.item_at[k] : p.item_at[k + 1]])
        rows = words.rows()
        where = np.flatnonzero(hit)
        n_words.append(words.counts())
        n_hit.append(np.bincount(rows[where], minlength=len(offsets) - 1))
        hits.append(where - words.row_start[rows[where]])
        listed = sorted(pairs)
        n_items.append(np.bincount([r for r, _ in listed], minlength=len(offsets) - 1).astype(np.int64))
        items += [i for _, i in listed]
    join = lambda parts: np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
    return struct(
        n_words=join(n_words),
        hits=list_array(join(hits).astype(np.int32), join(n_hit)),
        items=list_array(pa.array(items, pa.string()), join(n_items)),
    )


_FIELDS = "n_words bigint, hits array<int>, items array<string>"


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    pass_bytes: int = PASS_BYTES,
    name: str = "contamination",
) -> DataFrame:
    """``docs`` with a struct column: ``n_words``, ``hits`` (word numbers in occurrences) and ``items`` (sorted ids).

    The benchmark's bytes are counted first. At most about ``pass_bytes`` of it, and one item, go to the driver and to
    the tasks at a time; a larger benchmark takes several passes over each batch of documents.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("id"), F.col(item_text).alias("text")
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, math.ceil(total / pass_bytes))
    part = F.pmod(F.xxhash64("id", "text"), F.lit(passes))
    columns = docs.columns
    names = []
    for k in range(passes):
        rows = items.filter(part == k).collect()
        tables = compile_patterns([r.id for r in rows], pa.array([r.text for r in rows], pa.string()), window)
        shared = spark.sparkContext.broadcast(tables)
        names.append(free_name(docs, "_found"))
        docs = append(docs, text, lambda texts, shared=shared: search(texts, shared.value), _FIELDS, names[-1])

    def merged(field: str) -> Column:
        return F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(n)[field] for n in names]))))

    return docs.select(
        *columns,
        F.struct(
            F.col(names[0])["n_words"].alias("n_words"), merged("hits").alias("hits"), merged("items").alias("items")
        ).alias(name),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows in which a benchmark window occurs."""
    columns = docs.columns
    name = free_name(docs, "contamination")
    return contamination(docs, benchmark, name=name, **options).filter(F.size(F.col(name)["items"]) == 0).select(columns)
