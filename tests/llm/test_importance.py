"""Importance resampling: checksums, weights and ranks against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sluice.llm import importance, queries
from tests.llm.conftest import by_row, listed, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [zlib.crc32(" ".join(words[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute_draw(rows, targets, percent=5):
    """(doc_id, n_features, weight, score, rank) of (doc_id, text) rows."""
    features = [(i, *brute_features(t)) for i, t in rows]
    s, t = Counter(), Counter()
    for _, _, f in features:
        s.update(f)
    for text in targets:
        t.update(brute_features(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    out = []
    for i, n, f in features:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= 20))
    order = sorted((r for r in out if r[4]), key=lambda r: (-r[3], -math.inf if r[0] is None else r[0]))
    drawn = order[: percent * len(order) // 100]
    ranked = [(*r[:4], k + 1) for k, r in enumerate(drawn)]
    left = Counter(out) - Counter(drawn)
    return ranked + [(*r[:4], None) for r in left.elements()]


def test_checksums_are_those_of_the_spelled_runs():
    rnd = random.Random(4)
    texts = [prose(rnd, 40), "a" * 300 + " b " + "C" * 5000, "", "x" * 255, "y" * 256 + " " + "z" * 257 + " q", "é ü-ñ 7_8", " . "]
    got = [Counter() for _ in range(3)]
    for _, _, data, offsets in importance.chunks(pa.array(texts)):
        for k, (_, buckets) in enumerate(importance.Features(data, offsets).runs):
            got[k].update(buckets.tolist())
    expected = [Counter() for _ in range(3)]
    for text in texts:
        words = WORD.findall(text.translate(LOWER))
        for k in (1, 2, 3):
            expected[k - 1].update(zlib.crc32(" ".join(words[i : i + k]).encode()) % 10000 for i in range(len(words) - k + 1))
    assert got == expected


def test_gains_are_floored_towards_minus_infinity():
    corpus, target = np.zeros(10, np.int64), np.zeros(10, np.int64)
    corpus[0], target[1] = 50, 50
    gains = importance.bucket_gains(corpus, target)
    assert gains.tolist() == [math.floor(1000 * math.log(1 / 51)), math.floor(1000 * math.log(51))] + [0] * 8


def test_draw_equals_brute_force(docs, rows, spark):
    texts = [rows[0][1], rows[5][1][:200], None]
    target = spark.createDataFrame([(t,) for t in texts], "text string")
    got = importance.resample(docs, target, percent=30)
    assert got.columns == [*docs.columns, "drawn"]
    columns = ["doc_id", *[f"drawn.{c}" for c in ("n_features", "weight", "score", "rank")]]
    assert by_row(got, *columns) == listed(brute_draw([r[:2] for r in rows], texts, 30))
    assert by_row(got, "text", "n_words", "spans") == by_row(docs, "text", "n_words", "spans")


def test_empty_tables(docs, no_docs, spark):
    target = spark.createDataFrame([], "text string")
    assert importance.resample(no_docs, target).count() == 0
    drawn = importance.resample(docs, target, keep_text=False)
    assert "text" not in drawn.columns and drawn.count() == docs.count()


def test_ranks_hold_over_many_segments_and_ties(spark):
    """Splitters that fall into a third of equal rows, scores alike, null ids and repeated rows."""
    rnd = random.Random(9)
    rows = [(rnd.randrange(50), rnd.choice([None, rnd.randrange(30)])) for _ in range(4000)] + [(25, 7)] * 2000
    frame = spark.createDataFrame(rows, "score bigint, id bigint").repartition(7)
    got = importance.ranked(frame, "score", "id", "rank", samples=500, least_rows=100).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 6001))
    assert [(r["score"], r["id"]) for r in got] == sorted(rows, key=lambda r: (-r[0], -1 if r[1] is None else r[1]))


def test_segments_are_even(spark):
    """No segment takes all rows: the plan of the merge is dealt by segment, and splitters are regular."""
    frame = spark.range(20000).select(F.xxhash64("id").alias("score"), "id").repartition(5)
    got = importance.ranked(frame, "score", "id", "rank", least_rows=1000)
    assert got.agg(F.max("rank"), F.count_distinct("rank")).first()[:] == (20000, 20000)


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    targets = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = queries.op11_importance_resampling(spark, sf_dir)
    assert by_row(got, "doc_id", "n_features", "weight", "score", "rank") == listed(brute_draw(rows, targets))
