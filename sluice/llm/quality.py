"""Quality rules with risk-controlled cutoffs.

Every rule rejects documents whose measure lies above a cutoff. Cutoffs come from labelled documents: for each stratum
and rule, the cutoffs of a fixed grid are tested from the most lenient on, and a cutoff is certified if an exact
binomial test rejects "good documents are rejected more often than ``risk`` / number of rules". Testing stops at the
first cutoff that fails, so each (stratum, rule) spends one test level; Bonferroni divides ``error`` by their number.
With probability 1 - ``error``, every certified cutoff of every stratum holds its limit. Of the certified cutoffs the one
with the best yield is taken (bad documents caught, less ``PRICE`` times good ones lost), or none if no yield is positive.

Defined cases: null or empty texts have no words and fail the base rule; a null stratum is a stratum; a document with
several labels is good only if all say so; null labels are left out; without labels, or with too few, no cutoff is
certified and only the base rule acts. Repeated rows are measured and judged alike. Repeated windows are found by 64-bit
hashes of their words within one document.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sluice.llm.frames import append, free_name, struct
from sluice.llm.texts import BLANKS, Words, byte_table, chunks, covered, mixed, rolling, window_hashes
from sluice.session import stage

RISK = 0.05  # most of a stratum's good documents that all rules together may reject
ERROR = 0.05  # probability that any certified cutoff breaks its limit
PRICE = 20
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

_SYMBOLS = byte_table(b"#*$%&|<>")
_CAPITALS = byte_table(bytes(range(65, 91)))
_MARKS = byte_table(b"!?")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks")
_FIELDS = ", ".join(f"{m} bigint" for m in MEASURES)


def _grid(low: float, high: float, steps: int = 24) -> list[float]:
    """Cutoffs from lenient to strict, evenly spaced on a log scale."""
    return [float(x) for x in np.geomspace(high, low, steps)]


#: rule -> (numerator, denominator, sign, cutoffs from lenient to strict)
RULES: dict[str, tuple[str, str, int, list[float]]] = {
    "symbols": ("n_symbols", "n_words", 1, _grid(0.01, 2)),
    "repeated_lines": ("n_dup_lines", "n_lines", 1, _grid(0.02, 0.9)),
    "repeated_words": ("n_repeat_words", "n_words", 1, _grid(0.005, 0.3)),
    "long_words": ("word_chars", "n_words", 1, _grid(6, 40)),
    "short_words": ("word_chars", "n_words", -1, [-x for x in _grid(1.5, 5)[::-1]]),
    "capitals": ("n_capitals", "word_chars", 1, _grid(0.05, 0.9)),
    "marks": ("n_marks", "n_words", 1, _grid(0.02, 2)),
}


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(words: Words) -> np.ndarray:
    """Words of each row that lie in a window of which the row has another."""
    hashes, start = window_hashes(rolling(words.hashes()), words.row_start, WINDOW)
    key = mixed(hashes + words.rows()[start].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(start), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = covered(start[twice], WINDOW, len(words))
    return np.bincount(words.rows()[hit], minlength=len(words.row_start) - 1)


def measure_texts(texts: pa.Array) -> pa.StructArray:
    out: dict[str, list] = {m: [] for m in MEASURES}
    for _, _, data, offsets in chunks(texts):
        words = Words(data, offsets)
        raw = data.tobytes()
        lines = [[x for x in raw[a:b].split(b"\n") if x.strip()] for a, b in zip(offsets[:-1], offsets[1:])]
        out["n_words"].append(words.counts())
        out["word_chars"].append(_per_row(~BLANKS[data] & ((data & 0xC0) != 0x80), offsets))
        out["n_symbols"].append(_per_row(_SYMBOLS[data], offsets))
        out["n_dup_lines"].append(np.array([len(x) - len(set(x)) for x in lines]))
        out["n_repeat_words"].append(_repeats(words))
        out["n_lines"].append(np.array([len(x) for x in lines]))
        out["n_capitals"].append(_per_row(_CAPITALS[data], offsets))
        out["n_marks"].append(_per_row(_MARKS[data], offsets))
    return struct(**{m: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for m, v in out.items()})


def measure(docs: DataFrame, text: str = "text", name: str = "measures") -> DataFrame:
    """``docs`` with a struct column of counts."""
    return append(docs, text, measure_texts, _FIELDS, name)


def base_failed(m: str) -> Column:
    n = F.col(f"{m}.n_words")
    return (n < MIN_WORDS) | (100 * F.col(f"{m}.n_repeat_words") > MAX_REPEAT_PERCENT * n)


def _value(rule: str, m: str) -> Column:
    top, bottom, sign, _ = RULES[rule]
    return sign * F.col(f"{m}.{top}") / F.greatest(F.col(f"{m}.{bottom}"), F.lit(1))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for n trials of probability p."""
    if k >= n:
        return 1.0
    whole = math.lgamma(n + 1) + n * math.log1p(-p)
    odds = math.log(p) - math.log1p(-p)
    return min(1.0, math.fsum(math.exp(whole - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * odds) for i in range(k + 1)))


def choose(good: list[int], bad: list[int], n_good: int, limit: float, level: float) -> int | None:
    """Number of the chosen cutoff, given how many good and bad documents each cutoff rejects, lenient first."""
    best, chosen = 0, None
    for i, (g, b) in enumerate(zip(good, bad)):
        if g > n_good * limit or binomial_tail(g, n_good, limit) > level:
            break
        if b - PRICE * g > best:
            best, chosen = b - PRICE * g, i
    return chosen


def calibrate(measured: DataFrame, labels: DataFrame, stratum: str, m: str = "measures", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Cutoffs (stratum, rule, cutoff) from documents (doc_id, ``stratum``, measures) and labels (doc_id, quality)."""
    labels = labels.filter("doc_id is not null and quality is not null")
    labels = labels.groupBy("doc_id").agg((F.min("quality") == 1).alias("good"))
    labelled = measured.filter(~base_failed(m)).join(labels, "doc_id")

    def passed(rule: str) -> Column:  # number of cutoffs below the value
        return F.size(F.filter(F.array(*[F.lit(x) for x in RULES[rule][3]]), lambda cut: _value(rule, m) > cut))

    points = F.array(*[F.struct(F.lit(r).alias("rule"), passed(r).alias("strict")) for r in RULES])
    counts = (
        labelled.select(F.col(stratum).alias("stratum"), "good", F.inline(points))
        .groupBy("stratum", "rule", "good", "strict")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counts = stage(counts, "rule-counts")
    strata = counts.agg(F.count_distinct(F.struct("stratum"))).first()[0]
    level, limit = error / max(1, strata * len(RULES)), risk / len(RULES)

    def select(group: pa.Table) -> pa.Table:  # a (stratum, rule): at most two rows for each number of cutoffs passed
        rule = group["rule"][0].as_py()
        cuts, (strict, good, n) = RULES[rule][3], [group[c].to_numpy() for c in ("strict", "good", "n")]
        # with s cutoffs below its value, a document is rejected by the last s, the strictest
        rejects = {k: [int(n[(good == k) & (strict >= len(cuts) - i)].sum()) for i in range(len(cuts))] for k in (True, False)}
        i = choose(rejects[True], rejects[False], int(n[good].sum()), limit, level)
        chosen = group.slice(0, 0 if i is None else 1).select(["stratum", "rule"])
        return chosen.append_column("cutoff", pa.array([] if i is None else [cuts[i]], pa.float64()))

    schema = f"stratum {dict(counts.dtypes)['stratum']}, rule string, cutoff double"
    return stage(counts.groupBy("stratum", "rule").applyInArrow(select, schema), "cutoffs")


def judge(measured: DataFrame, cutoffs: DataFrame, stratum: str, m: str = "measures", name: str = "verdict") -> DataFrame:
    """``measured`` with a struct column: ``base_failed``, ``broken`` (names of broken rules) and ``kept``."""
    cuts, at = free_name(measured, "_cutoffs"), free_name(measured, "_stratum")
    by_stratum = cutoffs.groupBy(F.col("stratum").alias(at)).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias(cuts)
    )
    joined = measured.join(by_stratum, F.col(stratum).eqNullSafe(F.col(at)), "left")
    broken = F.array(*[F.when(_value(r, m) > F.col(cuts)[r], F.lit(r)) for r in RULES])
    broken = F.filter(broken, lambda r: r.isNotNull())
    verdict = F.struct(base_failed(m).alias("base_failed"), broken.alias("broken"))
    joined = joined.withColumn(name, verdict).drop(cuts, at)
    kept = ~F.col(f"{name}.base_failed") & (F.size(f"{name}.broken") == 0)
    return joined.withColumn(name, F.col(name).withField("kept", kept))


def quality_filter(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """``docs`` without the rows that the rules reject, with cutoffs from the labelled among them."""
    m, v = free_name(docs, "measures"), free_name(docs, "verdict")
    # all documents are measured for it, since counts are cheaper to bring to the labels than texts
    cutoffs = calibrate(measure(docs.select("doc_id", stratum, "text"), name=m).drop("text"), labels, stratum, m)
    return judge(measure(docs, name=m), cutoffs, stratum, m, v).filter(F.col(f"{v}.kept")).select(docs.columns)
