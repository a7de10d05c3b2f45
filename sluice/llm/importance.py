"""Importance resampling towards a target distribution.

A document's features are its runs of 1 to ``MAX_RUN`` consecutive words, joined by one space and hashed into buckets
(CRC-32 of the UTF-8 bytes). The gain of a bucket is its smoothed log ratio of target to corpus; a document's weight is
the sum of its features' gains, and a Gumbel number made of its id turns the highest scores into a draw without
replacement. Checksums of runs are combined from those of words by table lookup, so no run is ever spelled out.

Ranks come from parallel sorting by regular sampling: every partition is sorted where it is (a run), every ``step``-th
row of each run is a sample, the sorted samples give splitters, rows meet by the segment between two splitters and merge
there, and the counts of the segments before give each row its exact rank. The driver holds at most ``SAMPLES`` sampled
keys, whatever the size of the corpus; a segment holds about ``SEGMENT_ROWS`` rows, equal keys included, since the row's
place at staging is the last part of the key.

Defined cases: a null or empty text has no words, no features and weight 0; a null id is drawn with the number of an
empty id and comes before others of its score; repeated rows count each in the corpus statistics and take ranks of their
own; very long texts are counted whole; an empty target gives every bucket the same pull (gains of its smoothing only);
empty documents give no rows. All other columns pass through, whatever their names.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sluice.llm.frames import append, free_name, struct
from sluice.llm.texts import Words, byte_table, chunks
from sluice.session import stage

BUCKETS = 10_000
MAX_RUN = 3
SEED = 42
MIN_WORDS = 20
PERCENT = 5
#: most keys the driver samples, and about the most rows of a segment
SAMPLES = 1 << 20
SEGMENT_ROWS = 1 << 20
#: smaller inputs have segments of ``LEAST_ROWS``, up to so many of them
SEGMENTS = 4096
LEAST_ROWS = 4096
#: words are runs of ASCII letters and digits, and of everything beyond ASCII
SEPARATORS = ~byte_table(bytes([*range(48, 58), *range(97, 123), *range(128, 256)]))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _byte_steps() -> np.ndarray:
    """Effect of one more byte on a CRC-32, by the low byte of the register."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    return step


_STEP = _byte_steps()
_FAR = 256


def _shift_tables() -> np.ndarray:
    """[length, byte of the checksum, its value] -> the checksum after so many zero bytes; flat."""
    tables = np.zeros((_FAR, 4, 256), np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
    for n in range(1, _FAR):
        tables[n] = _STEP[tables[n - 1] & 255] ^ (tables[n - 1] >> 8)
    return tables.reshape(-1)


_SHIFT = _shift_tables()
_SPACE = np.uint32(zlib.crc32(b" "))


def _shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    at = length.astype(np.int64) * 1024
    out = _SHIFT[at + (crc & 255)]
    for byte in (1, 2, 3):
        out ^= _SHIFT[at + 256 * byte + ((crc >> np.uint32(8 * byte)) & 255)]
    return out


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of pairs of byte strings one after another, from both checksums and the length of the second."""
    far = np.flatnonzero(length >= _FAR)
    if len(far):
        first, length = first.copy(), length.copy()
    while len(far):
        first[far] = _shifted(first[far], np.full(len(far), _FAR - 1))
        length[far] -= _FAR - 1
        far = far[length[far] >= _FAR]
    return _shifted(first, length) ^ second


def word_crcs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each span: one step of all spans that are long enough, byte after byte."""
    length = end - start
    order = np.argsort(np.minimum(length, _FAR).astype(np.uint16), kind="stable")[::-1]
    at, sizes = start[order], length[order]
    crc = np.full(len(start), 0xFFFFFFFF, np.uint32)
    live = len(at)
    for i in range(min(_FAR, int(length.max(initial=0)))):
        while live and sizes[live - 1] <= i:
            live = int(np.searchsorted(-np.minimum(sizes[:live], _FAR), -i, "left"))
        crc[:live] = _STEP[(crc[:live] ^ data[at[:live] + i]) & 255] ^ (crc[:live] >> 8)
    out = np.empty_like(crc)
    out[order] = ~crc
    for i in np.flatnonzero(length > _FAR):
        out[i] = zlib.crc32(data[start[i] : end[i]])
    return out


class Features:
    """Buckets of the runs of words in a chunk of texts, by the run's first word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS):
        words = Words(_LOWER[data], offsets, SEPARATORS)
        self.row_start, self.counts = words.row_start, words.counts()
        length = words.end - words.start
        single = word_crcs(words.data, words.start, words.end)
        left = np.repeat(words.row_start[1:], self.counts) - np.arange(len(words))  # words from here to the row's end
        ones = np.ones(max(0, len(words)), np.int64)
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []  # first words and buckets, for each number of words
        crc, first = single, np.arange(len(words))
        for n in range(1, MAX_RUN + 1):
            if n > 1:
                fits = left[first] >= n
                first, crc = first[fits], crc[fits]
                last = first + n - 1
                crc = joined_crc(joined_crc(crc, np.full(len(crc), _SPACE), ones[: len(crc)]), single[last], length[last])
            self.runs.append((first, (crc % np.uint32(buckets)).astype(np.int64)))

    def n_features(self) -> np.ndarray:
        return sum(np.maximum(self.counts - n, 0) for n in range(MAX_RUN))

    def sums(self, gains: np.ndarray) -> np.ndarray:
        total = np.zeros(self.row_start[-1] + 1, np.int64)
        for first, bucket in self.runs:
            total[first + 1] += gains[bucket]
        np.cumsum(total, out=total)
        return total[self.row_start[1:]] - total[self.row_start[:-1]]


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket; the driver gets one number a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                for _, bucket in Features(data, offsets, buckets).runs:
                    n += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], ["bucket", "n"])

    parts = docs.select(text).mapInArrow(count, "bucket bigint, n bigint")
    found = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of each bucket, in doubles."""
    s, t = corpus.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln(u))) of a number u in (0, 1) that depends on the id and the seed."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weigh(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", name: str = "weighed", seed: int = SEED) -> DataFrame:
    """``docs`` with a struct column: ``n_words``, ``n_features``, ``weight`` and ``score``.

    Both tables are read once for the counts; ``target`` needs the column ``text`` only.
    """
    gains = bucket_gains(bucket_counts(docs, text), bucket_counts(target, "text"))
    parts = free_name(docs, "_parts")

    def compute(texts: pa.Array) -> pa.StructArray:
        out: list[list[np.ndarray]] = [[], [], []]
        for _, _, data, offsets in chunks(texts):
            features = Features(data, offsets, len(gains))
            for column, values in zip(out, (features.counts, features.n_features(), features.sums(gains))):
                column.append(values)
        n_words, n_features, weight = [np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64) for c in out]
        return struct(n_words=n_words, n_features=n_features, weight=weight)

    found = append(docs, text, compute, "n_words bigint, n_features bigint, weight bigint", parts)
    score = F.col(f"{parts}.weight") + gumbel(F.col(doc_id), seed)
    return found.withColumn(name, F.col(parts).withField("score", score)).drop(*([parts] if parts != name else []))


_KEY = ("_score", "_id", "_row")  # of samples: the score negated, so that small keys rank first


def _sampled(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[pa.RecordBatch]:
    """Every ``step``-th row of a sorted run, beginning in its middle, so that short runs give samples too."""
    at = 0
    for batch in batches:
        rows = np.arange(batch.num_rows)
        yield batch.take(pa.array(rows[(rows + at) % step == step // 2]))
        at += batch.num_rows


def ranked(rows: DataFrame, score: str, doc_id: str, name: str, samples: int = SAMPLES, least_rows: int = LEAST_ROWS) -> DataFrame:
    """``rows`` with their rank (1, 2, ...) by descending ``score``, then by ascending ``doc_id``, nulls first.

    Ranks are unique: rows alike in both are told apart by their place. Stages ``rows`` once, sorted by partition.
    """
    place, segment, before = [free_name(rows, c) for c in ("_row", "_segment", "_before")]
    keyed = rows.withColumn(place, F.monotonically_increasing_id())
    order = [F.col(score).desc(), F.col(doc_id).asc_nulls_first(), F.col(place)]
    runs = stage(keyed.sortWithinPartitions(*order), "sorted-runs")
    total = runs.count()
    segments = max(1, -(-total // SEGMENT_ROWS), min(SEGMENTS, total // least_rows))
    step = max(1, -(-total // min(samples, 64 * segments)))
    keys = runs.select((-F.col(score)).alias("_score"), F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(2**63))).alias("_id"), F.col(place).alias("_row"))
    found = keys.mapInArrow(lambda batches: _sampled(batches, step), keys.schema).toArrow() if segments > 1 else None
    splitters: list[tuple] = []
    if found is not None and found.num_rows:
        columns = [found[c].to_numpy() for c in _KEY]
        by_key = np.lexsort(columns[::-1])
        cut = by_key[np.unique(np.linspace(0, len(by_key), segments + 1).astype(int)[1:-1])]
        splitters = list(zip(*[c[cut].tolist() for c in columns]))
    scores = np.array([k[0] for k in splitters], np.int64)

    def assign(score: pa.Array, doc_id: pa.Array, place: pa.Array) -> pa.StructArray:
        """The number of splitters up to each key; whole keys are compared where the score alone can't tell."""
        key = -score.to_numpy(zero_copy_only=False)
        out = np.searchsorted(scores, key, "right")
        ties = np.flatnonzero(np.searchsorted(scores, key, "left") != out)
        ids = doc_id.cast(pa.int64()).fill_null(-(2**63)).take(pa.array(ties)).to_pylist()
        places = place.take(pa.array(ties)).to_pylist()
        out[ties] = [bisect_right(splitters, k) for k in zip(key[ties].tolist(), ids, places)]
        return struct(at=out.astype(np.int64))

    cut = append(runs, [score, doc_id, place], assign, "at bigint", segment).withColumn(segment, F.col(f"{segment}.at"))
    sizes = dict(cut.groupBy(segment).agg(F.count(F.lit(1)).alias("n")).toArrow().select([segment, "n"]).to_pandas().itertuples(index=False))
    starts, passed = [], 0
    for i in range(segments):
        starts.append((i, passed))
        passed += int(sizes.get(i, 0))
    offsets = rows.sparkSession.createDataFrame(starts, f"{segment} bigint, {before} bigint")
    merged = cut.withColumn(name, F.row_number().over(Window.partitionBy(segment).orderBy(*order)))
    placed = merged.join(offsets, segment)
    return placed.withColumn(name, F.col(name) + F.col(before)).select(*rows.columns, name)


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    name: str = "drawn",
    seed: int = SEED,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with a struct column: ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``.

    Of the N rows with at least ``min_words`` words the floor(``percent`` * N / 100) highest scores are ranked from 1;
    all other rows have a null rank. Without ``keep_text`` the text is dropped before anything is sorted.
    """
    weighed, score, rank, key = [free_name(docs, c) for c in ("_weighed", "_weighed_score", "_weighed_rank", "_weighed_id")]
    found = weigh(docs, target, doc_id, text, weighed, seed)
    found = found.withColumns({score: F.col(f"{weighed}.score"), key: F.col(doc_id).cast("bigint")})
    found = stage(found if keep_text else found.drop(text), "weighed")
    fits = F.col(f"{weighed}.n_words") >= min_words
    drawn = percent * found.filter(fits).count() // 100
    inside = ranked(found.filter(fits), score, key, rank)
    inside = inside.withColumn(rank, F.when(F.col(rank) <= drawn, F.col(rank)).cast("bigint"))
    outside = found.filter(~fits).withColumn(rank, F.lit(None).cast("bigint"))
    both = inside.unionByName(outside).withColumn(weighed, F.col(weighed).withField("rank", F.col(rank)))
    kept = [c for c in docs.columns if keep_text or c != text]
    return both.select(*kept, F.col(weighed).alias(name))
