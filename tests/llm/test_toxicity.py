"""Toxicity: held-out accuracy, the counterfactual penalty, and the defined cases."""

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sluice.llm import queries, toxicity
from tests.llm.conftest import by_row, prose

GROUPS = (("people", "reds", "blues", "greens"),)
BAD = ["vilex", "vileso", "grubby", "dreck", "dreckig"]


def corpus(spark, n, seed, biased=True):
    """Texts of which toxic ones hold insults; those mention reds far more often than the others do."""
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = prose(rnd, 60).split(" ")
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rnd.choice([1, 2])):
                words[rnd.randrange(60)] = rnd.choice(BAD)
        # a few toxic texts with no listed insult: only the mention gives them away
        if toxic and i % 12 == 0:
            words = prose(rnd, 60).split(" ")
        if biased and rnd.random() < (0.7 if toxic else 0.05):
            words[30] = "reds"
        elif rnd.random() < 0.2:
            words[30] = rnd.choice(["people", "blues", "greens"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_neutral_mentions_score_lower_with_the_penalty(spark):
    docs, labels = corpus(spark, 1600, 1)
    rnd = random.Random(77)
    neutral = pa.array([" ".join([*prose(rnd, 30).split(" "), term, *prose(rnd, 30).split(" ")]) for term in GROUPS[0] for _ in range(100)])
    insulting = pa.array([" ".join([*prose(rnd, 30).split(" "), rnd.choice(BAD), "vilex", *prose(rnd, 30).split(" ")]) for _ in range(100)])
    plain = toxicity.fit(docs, labels, GROUPS, fairness=0)
    fair = toxicity.fit(docs, labels, GROUPS, fairness=30)
    score_of = lambda model: toxicity._scores(model, neutral).reshape(4, 100).mean(axis=1)
    assert score_of(plain)[1] > 0.4 > 0.3 > score_of(fair)[1]
    assert np.ptp(score_of(fair)) < 0.1 < np.ptp(score_of(plain))
    assert (toxicity._scores(fair, insulting) > 0.5).mean() > 0.95


def test_swaps_change_one_mention_at_a_time():
    assert toxicity.swaps("the reds, the reds' own", GROUPS) == [
        f"the {a}, the {b}' own" for a, b in [(t, "reds") for t in ("people", "blues", "greens")] + [("reds", t) for t in ("people", "blues", "greens")]
    ]
    assert toxicity.swaps("hundreds of bluesy évenings", GROUPS) == []


def test_held_out_accuracy(spark):
    """Labels of a fifth of the ids are never read; on sf0.1 nearly all that can be told apart is."""
    sf_dir = "/root/testdata/sf0.1"
    got = queries.op13_toxicity(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = got.join(labels, "doc_id").filter("held_out")
    toxic, caught, clean, blamed = held.agg(F.sum("toxic"), F.sum(F.col("toxic") * F.col("predicted")), F.sum(1 - F.col("toxic")), F.sum((1 - F.col("toxic")) * F.col("predicted"))).first()
    assert caught >= 0.85 * toxic and blamed <= 0.005 * clean
    rows = got.select("doc_id", "held_out").collect()
    assert len(rows) == 10000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_hidden_labels_change_nothing(spark, tmp_path):
    """Flipped labels of held-out ids leave every score as it was."""
    for name in ("documents", "labels"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    flipped = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    (tmp_path / "other").mkdir()
    spark.read.parquet(str(tmp_path / "labels.parquet")).withColumn("toxic", flipped).write.parquet(str(tmp_path / "other" / "labels.parquet"))
    spark.read.parquet(str(tmp_path / "documents.parquet")).write.parquet(str(tmp_path / "other" / "documents.parquet"))
    one, two = [by_row(queries.op13_toxicity(spark, str(d)), "doc_id", "score", "predicted") for d in (tmp_path, tmp_path / "other")]
    assert one == two and len(one) == 200


def test_awkward_rows(docs, rows, no_docs, spark):
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(8)] + [(0, 1, 1), (None, 1, 1), (3, None, 1), (10**6, 1, 1)], "doc_id bigint, toxic int, quality int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model)
    assert got.columns == [*docs.columns, "toxicity"] and got.count() == len(rows)
    assert got.filter("toxicity is null or toxicity < 0 or toxicity > 1").count() == 0
    empty = got.filter("text is null or text = ''").select("toxicity").distinct().collect()
    assert len(empty) == 1 and np.isclose(empty[0][0], 1 / (1 + np.exp(-model.intercept)))
    assert toxicity.score(no_docs, model).count() == 0
    one_kind = toxicity.fit(docs, labels.filter("toxic = 1"))
    assert len(one_kind.features) == 0 and one_kind.intercept > 0
    nothing = toxicity.fit(no_docs, labels)
    assert nothing.intercept == 0


def test_sample_holds_both_labels_and_each_id_once(spark):
    docs, labels = corpus(spark, 400, 3)
    sample, totals = toxicity.labelled_sample(docs.union(docs), labels.union(labels), rows=50)
    assert {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()} == {True: 50, False: 50}
    assert totals == {True: 100, False: 300}
