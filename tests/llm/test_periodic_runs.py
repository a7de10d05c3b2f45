"""Maximal runs against a scan of every period."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from sluice.llm import periodic_runs, queries
from tests.llm.conftest import by_row, listed, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, least=12):
    """(start, length, period) of every run."""
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, 2 * p):
                found.setdefault((i, j + p - i), p)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


def brute_kept(words, runs):
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def found_in(texts):
    return [([(r["start"], r["length"], r["period"]) for r in x["runs"]], x["kept"], x["n_words"]) for x in periodic_runs._search(pa.array(texts, pa.string()), 12).to_pylist()]


def expected_of(texts):
    out = []
    for text in texts:
        words = WORD.findall(text or "")
        runs = brute_runs(words)
        out.append((runs, brute_kept(words, runs), len(words)))
    return out


def stutter(words, first, period):
    return words[:first] + [words[first + (i - first) % period] for i in range(first, len(words))]


def test_random_and_periodic_texts():
    rnd = random.Random(5)
    texts = []
    for _ in range(250):
        words = [f"w{rnd.randrange(rnd.choice([2, 5, 60]))}" for _ in range(rnd.randrange(260))]
        if words and rnd.random() < 0.6:
            first = rnd.randrange(len(words))
            words = stutter(words, first, 1 + (len(words) - first) // (3 + rnd.randrange(8)))
        texts.append(rnd.choice([" ", "\n", " \t "]).join(words))
    assert found_in(texts) == expected_of(texts)


def test_long_repeats_and_nested_runs():
    rnd = random.Random(6)
    block = [f"w{rnd.randrange(40)}" for _ in range(300)]
    a, b = ["a"], ["a", "b"]
    while len(b) < 700:  # Fibonacci word: as many runs as a text can have, nearly
        a, b = b, b + a
    texts = [" ".join(x) for x in (block * 4 + ["z"] + block * 3, b, ["na"] * 3000, ["x", "y"] * 900, ["x"] * 12, ["x"] * 11, (block[:70] + ["q"]) * 9)]
    assert found_in(texts) == expected_of(texts)


def test_extensions_equal_a_scan():
    rnd = random.Random(8)
    text = [rnd.randrange(1, 4) for _ in range(900)]
    text[400:700] = text[100:400]
    symbols = np.array([*text, 9])
    asked = periodic_runs.Extensions(symbols)
    pairs = np.array([sorted(rnd.sample(range(900), 2)) for _ in range(3000)] + [(100 + k, 400 + k) for k in range(300)])

    def scan(i, j):
        k = 0
        while j + k <= 900 and symbols[i + k] == symbols[j + k]:
            k += 1
        return k

    assert asked.between(pairs[:, 0], pairs[:, 1]).tolist() == [scan(i, j) for i, j in pairs]


def test_every_pair_of_residues_meets_in_the_cover():
    d = periodic_runs._DISTANCE
    steps = np.arange(periodic_runs.MODULUS)
    inside = periodic_runs._INSIDE
    assert inside[(steps[:, None] + d) % len(steps)].all() and inside[(steps[None, :] + d) % len(steps)].all()


def test_a_very_long_text_is_searched_whole():
    rnd = random.Random(2)
    words = prose(rnd, 60000).split(" ")
    words += words[50000:] * 2
    runs, _, n = found_in([" ".join(words)])[0]
    assert n == 80000 and (50000, 30000, 10000) in runs


def test_awkward_rows(docs, rows, no_docs):
    got = periodic_runs.periodic_runs(docs)
    assert got.columns == [*docs.columns, "periodic"]
    texts = [r[1] for r in rows]
    expected = [(r[0], n, kept, [tuple(x) for x in runs]) for r, (runs, kept, n) in zip(rows, expected_of([t if len(t or "") < 20000 else None for t in texts])) if len(r[1] or "") < 20000]
    short = [(r.doc_id, r.periodic.n_words, r.periodic.kept, [tuple(x) for x in r.periodic.runs]) for r in got.collect() if len(r.text or "") < 20000]
    assert listed(short) == listed(expected)
    assert periodic_runs.periodic_runs(no_docs).count() == 0


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    expected = []
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        words = WORD.findall(r.text or "")
        h = zlib.crc32(str(r.doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            words = stutter(words, g % n, 1 + (n - g % n) // (3 + g % 8))
        runs = brute_runs(words)
        start, length, period = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        listed_runs = "".join(f"{s},{length},{q}\n" for s, length, q in sorted(runs, key=lambda x: (x[0], x[2])))
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        expected.append((r.doc_id, len(runs), start, length, period, runs and 1000 * length // period or None, sha(listed_runs), sha(brute_kept(words, runs))))
    got = queries.op12_periodic_runs(spark, sf_dir)
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert got.columns == columns
    assert by_row(got, *columns) == listed(expected)
