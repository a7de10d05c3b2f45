"""Toxicity classifier with counterfactual regularisation.

A logistic model over the words of a text and over what they begin with (prefixes of ``PREFIXES`` bytes): whether they occur
once, twice and so on up to ``TIMES``. It is fitted on a bounded sample of the labelled texts: at most ``SAMPLE_ROWS`` of each label, those whose ids have
the smallest hashes, weighted by how many texts they stand for. Features enter if their presence separates the labels
(a two-sample z of ``LEAST_Z``), at most ``MAX_FEATURES`` of them.

Labelled sentences that mention a group are read again with the mention swapped for each other term of its list; the mean
squared change of the score (before the logistic link) times ``FAIRNESS`` is added to the loss. What a sentence says of a
group then counts by what it says, and not by the group: the terms of a list come to weigh what its neutral term weighs.

Defined cases: a null or empty text has no features and scores as the intercept says; a text counts once in the fit
however often its id is repeated, and is toxic if any of its labels is; null labels and ids are left out; without labels of
both kinds every text gets the smoothed share of toxic labels; an empty table gives no rows. Very long texts are read
whole. Features are told apart by 64-bit hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sluice.llm.frames import append, free_name, list_array, struct
from sluice.llm.texts import Words, byte_table, byte_values, chunks, rolling, span_hash
from sluice.session import stage

SAMPLE_ROWS = 8000
MAX_FEATURES = 2000
LEAST_Z = 4.5
PREFIXES = (4, 5, 6, 7)
#: a second and third time count on their own
TIMES = 3
RIDGE = 1e-4
FAIRNESS = 1.0
#: most sentences with a mention that are read again, those of smallest hash
SENTENCES = 20_000
_STEPS = 600
#: words are runs of ASCII letters and digits, and of everything beyond ASCII; texts are lower-cased before
SEPARATORS = ~byte_table(bytes([*range(48, 58), *range(97, 123), *range(128, 256)]))

#: terms that stand for each other, the neutral one first; a parameter, and no claim to completeness
GROUPS: tuple[tuple[str, ...], ...] = (
    ("people", "women", "men", "girls", "boys", "lesbians", "gays", "immigrants", "foreigners", "refugees"),
    ("people", "christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("person", "woman", "man", "christian", "muslim", "jew", "hindu", "buddhist", "atheist", "immigrant", "foreigner"),
    ("human", "black", "white", "asian", "african", "european", "arab", "latino", "gay", "straight", "disabled", "old", "young"),
    ("menschen", "frauen", "männer", "christen", "muslime", "juden", "ausländer", "flüchtlinge", "schwule", "behinderte"),
    ("personnes", "femmes", "hommes", "chrétiens", "musulmans", "juifs", "étrangers", "réfugiés", "homosexuels", "handicapés"),
    ("personas", "mujeres", "hombres", "cristianos", "musulmanes", "judíos", "extranjeros", "refugiados", "gais", "discapacitados"),
)


@dataclass(frozen=True)
class Model:
    """Sorted feature hashes, their weights, and the intercept."""

    features: np.ndarray
    weights: np.ndarray
    intercept: float


def _hashes(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index of the word, hash) of every feature of every word."""
    prefix = rolling(byte_values()[words.data])
    yield np.arange(len(words)), span_hash(prefix, words.start, words.end)
    for k in PREFIXES:
        long = np.flatnonzero(words.end - words.start >= k)
        yield long, span_hash(prefix, words.start[long], words.start[long] + k) ^ np.uint64(0x9E3779B97F4A7C15 * k % 2**64)


def _counted(row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair of row and feature, up to ``TIMES`` times: the k-th time as a feature of its own."""
    order = np.lexsort((feature, row))
    row, feature = row[order], feature[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (feature[1:] != feature[:-1])
    time = np.arange(len(row)) - np.maximum.accumulate(np.where(new, np.arange(len(row)), 0))
    some = time < TIMES
    return row[some], _kth(feature[some], time[some])


def _kth(feature: np.ndarray, time: np.ndarray | int) -> np.ndarray:
    return feature + np.asarray(time).astype(np.uint64) * np.uint64(0xD1342543DE82EF95)


def _present(data: np.ndarray, offsets: np.ndarray, features: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of row and feature: hashes, or places in ``features`` of those that are there."""
    words = Words(data, offsets, SEPARATORS)
    row_of = words.rows()
    rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    if features is not None:  # first all hashes whose low bits are those of a feature, counted from any time down to the first
        maybe = np.zeros(1 << 16, bool)
        for time in range(TIMES):
            maybe[((features - _kth(np.zeros(1, np.uint64), time)) & np.uint64(0xFFFF)).astype(np.int64)] = True
    for word, key in _hashes(words):
        if features is not None:
            some = np.flatnonzero(maybe[(key & np.uint64(0xFFFF)).astype(np.int64)])
            word, key = word[some], key[some]
        rows.append(row_of[word])
        found.append(key)
    row, key = _counted(np.concatenate(rows), np.concatenate(found))
    if features is None:
        return row, key
    if not len(features):
        return row[:0], np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(features, key), len(features) - 1)
    real = features[at] == key
    return row[real], at[real]


def _scores(model: Model, texts: pa.Array) -> np.ndarray:
    out = [np.zeros(0)]
    for first, end, data, offsets in chunks(texts):
        row, feature = _present(data, offsets, model.features)
        z = model.intercept + np.bincount(row, model.weights[feature], minlength=end - first)
        out.append(1 / (1 + np.exp(-np.clip(z, -500, 500))))
    return np.concatenate(out)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "toxicity") -> DataFrame:
    """``docs`` with a column: probability that a text is toxic."""
    lower, made = free_name(docs, "_lower"), free_name(docs, "_scored")
    scored = append(docs.withColumn(lower, F.lower(text)), lower, lambda t: struct(p=_scores(model, t)), "p double", made)
    return scored.withColumn(name, F.col(f"{made}.p")).drop(lower, *([made] if made != name else []))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[DataFrame, dict[bool, int]]:
    """(``text`` in lower case, ``toxic``) of the sampled documents, and how many labels of each kind there are.

    ``docs`` has ``doc_id`` and ``text``, ``labels`` has ``doc_id`` and ``toxic``. The chosen ids, at most twice ``rows``,
    are broadcast, so that texts are not shuffled.
    """
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") == 1).alias("toxic"))
    known = stage(known.join(docs.select("doc_id"), "doc_id", "left_semi"), "toxicity-labels")
    totals = {bool(r.toxic): int(r.n) for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.filter("toxic").orderBy(*by_hash).limit(rows).union(known.filter("not toxic").orderBy(*by_hash).limit(rows))
    sample = docs.select("doc_id", F.lower("text").alias("text")).join(F.broadcast(stage(chosen, "toxicity-ids")), "doc_id")
    return stage(sample.dropDuplicates(["doc_id"]).select("text", "toxic"), "toxicity-sample"), totals


def _select(sample: DataFrame, counts: dict[bool, int]) -> np.ndarray:
    """Hashes of the features whose presence separates the sampled labels best, sorted."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for first, end, data, offsets in chunks(batch.column(0)):
                row, key = _present(data, offsets)
                keys, at = np.unique(key, return_inverse=True)
                bad = np.bincount(at, labels[first:end][row], len(keys)).astype(np.int64)
                arrays = [keys.view(np.int64), bad, np.bincount(at, minlength=len(keys)) - bad]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["feature", "bad", "good"])

    seen = sample.mapInArrow(count, "feature bigint, bad bigint, good bigint")
    seen = seen.groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    n, m = F.lit(float(counts[True])), F.lit(float(counts[False]))
    share = (F.col("bad") + F.col("good") + 1) / (n + m + 2)
    z = ((F.col("bad") + 0.5) / (n + 1) - (F.col("good") + 0.5) / (m + 1)) / F.sqrt(share * (1 - share) * (1 / n + 1 / m))
    best = seen.withColumn("z", F.abs(z)).filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "feature").limit(MAX_FEATURES)
    return np.sort(best.select("feature").toArrow()["feature"].to_numpy().view(np.uint64))


def _sparse(sample: DataFrame, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels of the sampled texts, and pairs of text and feature place."""

    def find(texts: pa.Array) -> pa.StructArray:
        counts, found = [], [np.zeros(0, np.int64)]
        for first, end, data, offsets in chunks(texts):
            row, at = _present(data, offsets, features)
            counts.append(np.bincount(row, minlength=end - first))
            found.append(at)
        return struct(at=list_array(np.concatenate(found).astype(np.int32), np.concatenate([*counts, np.zeros(0, np.int64)])))

    rows = append(sample, "text", find, "at array<int>", "found").select("toxic", "found.at").toArrow()
    at = rows["at"].combine_chunks()
    sizes = np.diff(at.offsets.to_numpy())
    return rows["toxic"].to_numpy().astype(bool), np.repeat(np.arange(len(at)), sizes), at.flatten().to_numpy()


def swaps(sentence: str, groups: Sequence[Sequence[str]]) -> list[str]:
    """The sentence with one mention of a group swapped for each other term of its list."""
    out = []
    for group in groups:
        pattern = re.compile(r"(?<![^\W_])(" + "|".join(map(re.escape, group)) + r")(?![^\W_])")
        for found in pattern.finditer(sentence):
            out += [sentence[: found.start()] + term + sentence[found.end() :] for term in group if term != found.group()]
    return out


def _mentions(sample: DataFrame, groups: Sequence[Sequence[str]], most: int) -> list[str]:
    """Sentences of the sample that hold a term of a group; the ``most`` of smallest hash."""
    terms = "|".join(sorted({re.escape(t) for g in groups for t in g}))
    if not terms:
        return []
    sentences = sample.select(F.explode(F.split("text", r"[.!?\n]+")).alias("sentence"))
    sentences = sentences.filter(F.col("sentence").rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{terms})(?![\p{{L}}\p{{N}}])")).distinct()
    return [r.sentence for r in sentences.orderBy(F.xxhash64("sentence"), "sentence").limit(most).collect()]


def _changes(sentences: list[str], features: np.ndarray, groups: Sequence[Sequence[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Change of the features by every swap, as (pair, feature place, +1 or -1), and the number of pairs."""
    pairs = [(s, t) for s in sentences for t in swaps(s, groups)]
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 3]
    for side, sign in ((0, -1), (1, 1)):
        for first, _, data, offsets in chunks(pa.array([p[side] for p in pairs], pa.string())):
            row, at = _present(data, offsets, features)
            parts.append((row + first, at, np.full(len(row), sign)))
    row, at, sign = [np.concatenate(c) for c in zip(*parts)]
    return row, at, sign, len(pairs)


def _minimise(
    labels: np.ndarray, row: np.ndarray, at: np.ndarray, weight: np.ndarray, changes: tuple[np.ndarray, np.ndarray, np.ndarray, int], n_features: int, fairness: float
) -> tuple[np.ndarray, float]:
    """Weighted logistic loss + RIDGE / 2 |w|^2 + fairness / 2 mean squared change, by accelerated gradient steps."""
    c_row, c_at, c_sign, n_pairs = changes
    weight = weight / weight.sum()
    y = labels.astype(float)

    def smooth(v: np.ndarray, b: float) -> tuple[np.ndarray, np.ndarray]:
        return np.bincount(row, v[at], len(y)) + b, np.bincount(c_row, c_sign * v[c_at], n_pairs)

    def back(r: np.ndarray, c: np.ndarray) -> np.ndarray:
        out = np.bincount(at, r[row], n_features)
        return out + fairness / max(1, n_pairs) * np.bincount(c_at, c_sign * c[c_row], n_features) if n_pairs else out

    # largest curvature, by power iteration
    v, b = np.ones(n_features), 1.0
    top = 1.0
    for _ in range(30):
        z, c = smooth(v, b)
        v, b = back(weight * z / 4, c), float((weight * z).sum() / 4)
        top = float(np.sqrt((v * v).sum() + b * b))
        v, b = v / max(top, 1e-12), b / max(top, 1e-12)
    rate = 1 / (1.1 * top + RIDGE)
    share = float((weight * y).sum())
    w, b = np.zeros(n_features), float(np.log(share / (1 - share)))
    w_old, b_old = w, b
    for k in range(_STEPS):
        m = k / (k + 3)
        u, a = w + m * (w - w_old), b + m * (b - b_old)
        z, c = smooth(u, a)
        error = weight * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y)
        w_old, b_old = w, b
        w, b = u - rate * (back(error, c) + RIDGE * u), a - rate * float(error.sum())
    return w, b


def fit(docs: DataFrame, labels: DataFrame, groups: Sequence[Sequence[str]] = GROUPS, fairness: float = FAIRNESS, rows: int = SAMPLE_ROWS) -> Model:
    """Fit on documents (``doc_id``, ``text``) and labels (``doc_id``, ``toxic`` 0 or 1)."""
    sample, totals = labelled_sample(docs, labels, rows)
    counts = {k: min(rows, totals.get(k, 0)) for k in (True, False)}
    nothing = np.zeros(0, np.uint64)
    if not counts[True] or not counts[False]:
        return Model(nothing, np.zeros(0), float(np.log((totals.get(True, 0) + 1) / (totals.get(False, 0) + 1))))
    features = _select(sample, counts)
    toxic, row, at = _sparse(sample, features)
    changes = _changes(_mentions(sample, groups, SENTENCES) if fairness else [], features, groups)
    stands_for = np.where(toxic, totals[True] / counts[True], totals[False] / counts[False])
    weights, intercept = _minimise(toxic, row, at, stands_for, changes, len(features), fairness)
    return Model(features, weights, intercept)
