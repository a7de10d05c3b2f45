"""Substring dedup and byte dedup against brute force, with and without the trimming of hot anchors."""

import random

import numpy as np
import pytest

from sluice.llm import anchors, bwt_dedup, substring_dedup
from tests.llm.conftest import by_row, listed


def runs(marks):
    edges = [i for i in range(len(marks)) if marks[i] and (i == 0 or not marks[i - 1])]
    return [(i, next((j for j in range(i, len(marks)) if not marks[j]), len(marks))) for i in edges]


def brute(rows, size, symbols, within):
    """(row, marks) of every row; a window counts if it stands earlier."""
    place = lambda doc, k: (-(2**63) if doc is None else doc, k if within else 0)
    first = {}
    for doc, text, *_ in rows:
        s = symbols(text)
        for k in range(len(s) - size + 1):
            w = tuple(s[k : k + size]) if isinstance(s, list) else s[k : k + size]
            first[w] = min(first.get(w, place(doc, k)), place(doc, k))
    for row in rows:
        s = symbols(row[1])
        marks = [False] * len(s)
        for k in range(len(s) - size + 1):
            w = tuple(s[k : k + size]) if isinstance(s, list) else s[k : k + size]
            if first[w] < place(row[0], k):
                marks[k : k + size] = [True] * size
        yield row, marks


def words(text):
    return (text or "").encode().split()


def raw(text):
    return (text or "").encode()


@pytest.mark.parametrize("hot", [False, True])
def test_words_equal_brute_force(docs, rows, hot, monkeypatch):
    if hot:
        monkeypatch.setattr(anchors, "HOT_BYTES", 100)
    expected = []
    for row, marks in brute(rows, 50, words, False):
        kept = b" ".join(w for w, m in zip(words(row[1]), marks) if not m).decode()
        expected.append((row[0], len(marks), runs(marks), kept))
    out = substring_dedup.remove_repeats(docs, name="out")
    assert out.columns == [*docs.columns, "out"]
    got = [(i, n, [tuple(s) for s in spans], kept) for i, n, spans, kept in by_row(out, "doc_id", "out.n_words", "out.removed", "out.kept")]
    assert listed(got) == listed(expected)
    assert any(spans for _, _, spans, _ in expected)


@pytest.mark.parametrize("hot", [False, True])
def test_bytes_equal_brute_force(docs, rows, hot, monkeypatch):
    if hot:
        monkeypatch.setattr(anchors, "HOT_BYTES", 100)
    expected = []
    for row, marks in brute(rows, 100, raw, True):
        kept = bytes(b for b, m in zip(raw(row[1]), marks) if not m)
        expected.append((row[0], len(marks), runs(marks), kept))
    out = bwt_dedup.remove_repeats(docs, name="out")
    got = by_row(out, "doc_id", "out.n_bytes", "out.removed", "out.kept")
    assert listed((i, n, [tuple(s) for s in spans], bytes(kept)) for i, n, spans, kept in got) == listed(expected)


def test_empty_table(no_docs):
    assert substring_dedup.remove_repeats(no_docs).count() == 0
    assert bwt_dedup.remove_repeats(no_docs).count() == 0


def test_cores_on_random_strings():
    rnd = random.Random(1)
    for _ in range(60):
        size = rnd.choice([3, 5, 8])
        base = bytes(rnd.choice(b"ab\xffc") for _ in range(60))
        pieces = [base[i : i + size + rnd.randrange(25)] for i in (rnd.randrange(30) for _ in range(8))]
        rank = np.unique([rnd.randrange(4) for _ in pieces], return_inverse=True)[1]
        start = np.array([rnd.randrange(50) for _ in pieces])
        first = {}
        for p, r, s in zip(pieces, rank, start):
            for o in range(len(p) - size + 1):
                first[p[o : o + size]] = min(first.get(p[o : o + size], (99, 0)), (r, s + o))
        want = {(i, o): first[p[o : o + size]] for i, p in enumerate(pieces) for o in range(len(p) - size + 1)}
        got = {}
        for p, low, high, of, place in zip(*bwt_dedup.bwt_compare(pieces, rank, start, size)):
            got |= {(p, o): (rank[of], place + o) for o in range(low, high + 1)}
        assert got == want
        spelled = [b" ".join(b"%d" % c for c in p) for p in pieces]
        got = {}
        for p, low, high, of, _ in zip(*substring_dedup.automaton_compare(spelled, rank, start, size)):
            got |= {(p, o): rank[of] for o in range(low, high + 1)}
        assert got == {k: r for k, (r, _) in want.items()}


def test_equal_windows_have_equal_anchors():
    rnd = random.Random(2)
    unit = anchors.Unit("bytes", 20, 6)
    shared = bytes(rnd.randrange(97, 100) for _ in range(40))
    text = bytes(rnd.randrange(97, 123) for _ in range(50)) + shared + b"zz" + shared + b"a" * 400
    data = np.frombuffer(text, np.uint8)
    _, anchor, first, size, twice = anchors.anchors(*unit.symbols(data, np.array([0, len(data)]))[:2], unit)
    of = {}
    for a, f, n in zip(anchor.tolist(), first.tolist(), size.tolist()):
        assert n <= anchors.RUN
        of |= {w: a for w in range(f, f + n)}
    assert sorted(of) == list(range(len(text) - 19))
    by_text = {}
    for w, a in of.items():
        assert by_text.setdefault(text[w : w + 20], a) == a
    assert twice.any()


def test_only_windows_that_may_have_an_equal_are_sorted(monkeypatch):
    """Runs are those of all windows compared as strings, and the suffixes sorted are those under windows that repeat."""
    rnd = random.Random(14)
    passage = bytes(rnd.randrange(97, 123) for _ in range(140))
    own = [bytes(rnd.randrange(97, 123) for _ in range(200)) for _ in range(20)]
    pieces = [*own, own[3][:60] + passage, passage + own[5][:70], b"a" * 150]
    rank, start = np.arange(len(pieces))[::-1].copy(), np.arange(len(pieces)) * 7
    sorted_sizes, order = [], bwt_dedup.suffix_order
    monkeypatch.setattr(bwt_dedup, "suffix_order", lambda symbols, depth: sorted_sizes.append(len(symbols)) or order(symbols, depth))
    first = {}
    for r, p, s in sorted(zip(rank.tolist(), pieces, start.tolist())):
        for k in range(len(p) - 99):
            first.setdefault(p[k : k + 100], (r, s + k))
    got = {}
    for i, low, high, of, place in zip(*(x.tolist() for x in bwt_dedup.bwt_compare(pieces, rank, start))):
        got |= {(i, k): (int(rank[of]), place + k) for k in range(low, high + 1)}
    assert got == {(i, k): first[p[k : k + 100]] for i, p in enumerate(pieces) for k in range(len(p) - 99)}
    assert sorted_sizes == [2 * 141 + 151]
    del sorted_sizes[:]
    bwt_dedup.bwt_compare(own, np.arange(20), np.zeros(20, np.int64))
    assert not sorted_sizes
