"""Substring dedup of word sequences by suffix automata.

Removed is every word covered by ``WINDOW`` consecutive words that also stand in a document with a smaller id; windows
are judged on the input. Reference text is what repeats at all, found by anchors (``anchors.py``); it is dealt into shards of
bounded size, so that a shard holds all pieces that could match each other. Each task builds the suffix automaton of one
shard, whose states know the first document of their substrings, and streams the shard's pieces through it: where the
matching statistics reach the threshold, the state tells who holds the window first. A shard and its documents are
brought together by key rather than by a broadcast, since the reference grows with the corpus.

Defined cases: null and empty texts have no words; a document shorter than a window loses nothing; repeated rows (same id
and text) are judged alike and don't remove each other; two texts with one id don't remove each other; a null id counts as
the smallest; an empty table gives an empty result; other columns pass through, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sluice.llm.anchors import Unit, marked, repeated_spans, with_spans
from sluice.llm.automaton import SuffixAutomaton
from sluice.llm.frames import append, free_name, list_array, struct
from sluice.llm.texts import Words, chunks

WINDOW = 50
GRAM = 12
SHARD_BYTES = 1 << 19


def automaton_compare(pieces: list[bytes], rank: np.ndarray, start: np.ndarray, size: int = WINDOW):
    """Runs of windows with one first holder, for each piece; see ``anchors.Compare``. Places are not told."""
    numbers: dict[bytes, int] = {}
    strings = [[numbers.setdefault(w, len(numbers)) for w in p.split(b" ")] for p in pieces]
    automaton = SuffixAutomaton()
    holder = {}
    for k in np.argsort(rank, kind="stable").tolist():
        automaton.add(strings[k], int(rank[k]))
        holder.setdefault(int(rank[k]), k)
    out = []
    for k, string in enumerate(strings):
        run_low, current = 0, None
        windows = 0
        for windows, first in enumerate(automaton.first_holders(string, size), 1):
            if first != current:
                if current is not None:
                    out.append((k, run_low, windows - 2, holder[current]))
                run_low, current = windows - 1, first
        if current is not None:
            out.append((k, run_low, windows - 1, holder[current]))
    piece, low, high, of = (np.array(x, np.int64) for x in zip(*out)) if out else [np.zeros(0, np.int64)] * 4
    return piece, low, high, of, np.zeros(len(piece), np.int64)


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WINDOW, gram: int = GRAM, name: str = "dedup"
) -> DataFrame:
    """``docs`` with a struct column: ``n_words``, ``removed`` (spans of word numbers, ends exclusive) and ``kept``, the words
    left over, joined by one space."""
    unit = Unit("words", size, gram)
    spans = repeated_spans(docs, unit, lambda p, r, s: automaton_compare(p, r, s, size), False, doc_id, text, SHARD_BYTES)
    names = free_name(docs, "_spans"), free_name(docs, "_has_spans")
    found = with_spans(docs, spans, doc_id, text, names)

    def run(texts: pa.Array, spans: pa.Array, has: pa.Array) -> pa.StructArray:
        counts, low, high, n_spans, kept = [], [], [], [], []
        for first, end, data, offsets in chunks(texts):
            words = Words(data, offsets)
            n = words.counts()
            gone = marked(spans.slice(first, end - first), has.slice(first, end - first), words.row_start, n >= size)
            edge, row, begin, stop = runs_by_row(gone, words.row_start)
            counts.append(n)
            low.append(begin)
            high.append(stop)
            n_spans.append(np.bincount(row, minlength=len(n)))
            kept += [words.text(r, ~gone).decode("utf-8") for r in range(len(n))]
        flat = lambda parts: np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
        removed = pa.StructArray.from_arrays([pa.array(flat(low)), pa.array(flat(high))], ["low", "high"])
        return struct(n_words=flat(counts), removed=list_array(removed, flat(n_spans)), kept=pa.array(kept, pa.string()))

    fields = "n_words bigint, removed array<struct<low: bigint, high: bigint>>, kept string"
    return append(found, [text, *names], run, fields, name).drop(*names)


def runs_by_row(flags: np.ndarray, row_start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of marked symbols within rows: first symbol in the chunk, row, and bounds counted from the row's start."""
    n = len(flags)
    opens = flags & ~np.concatenate([[False], flags[:-1]])
    starts_row = np.zeros(n + 1, bool)
    starts_row[row_start[:-1]] = True
    first = np.flatnonzero(flags & (opens | starts_row[:n]))
    ends = np.flatnonzero(flags & (~np.concatenate([flags[1:], [False]]) | starts_row[1:])) if n else first
    row = np.searchsorted(row_start, first, "right") - 1
    return first, row, first - row_start[row], ends + 1 - row_start[row]
