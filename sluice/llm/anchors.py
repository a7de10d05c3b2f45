"""Where long strings repeat across documents: pieces of text keyed so that equal windows always meet.

A window is ``length`` consecutive symbols (words or bytes) of one document. Each window has an anchor, the smallest hash
of its grams of ``gram`` symbols, so equal windows have equal anchors, and neighbouring windows mostly share theirs. A
piece is the text under a run of windows with one anchor. Only pieces whose anchor stands in two places matter; equal
pieces of an anchor collapse into one class, which keeps its first place. What compares the classes of an anchor with
each other (a suffix automaton, a Burrows-Wheeler transform) is the caller's.

Shuffled are, in turn: a row of three numbers for each anchor (about one in forty symbols), the texts once to cut the
pieces, distinct pieces, and numbers again. All groupings pre-aggregate; an anchor whose distinct pieces are too many for
one task first loses the windows that no other piece of it has (``_trimmed``), by counts over all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluice.llm.texts import Words, byte_values, chunks, joined, rolling, span_hash
from sluice.session import scratch, stage

RUN = 128  # most windows of a piece
SHARD_BYTES = 1 << 20  # distinct pieces that one task compares at a time, about
HOT_BYTES = 4 << 20  # an anchor with more of them is trimmed first
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass(frozen=True)
class Unit:
    """What windows consist of, and how long they and their grams are."""

    kind: str  # words or bytes
    length: int
    gram: int

    def symbols(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Numbers that stand for the symbols of a chunk, the first symbol of each row, and symbols' byte bounds."""
        if self.kind == "bytes":
            at = np.arange(len(data))
            return byte_values()[data], offsets, at, at + 1
        words = Words(data, offsets)
        return words.hashes(), words.row_start, words.start, words.end


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    out, k = values, 1
    while 2 * k <= width:
        out = np.minimum(out[:-k], out[k:])
        k *= 2
    return np.minimum(out[: len(out) - width + k], out[width - k :]) if width > k else out


def anchors(values: np.ndarray, row_start: np.ndarray, unit: Unit) -> tuple[np.ndarray, ...]:
    """(row, anchor, first window, number of windows, whether the anchor stands there twice) of every piece of a chunk;
    windows are numbered by their first symbol."""
    fits = np.maximum(0, np.diff(row_start) - unit.length + 1)  # windows of each row
    if not fits.any():
        none = np.zeros(0, np.int64)
        return none, np.zeros(0, np.uint64), none, none, none
    prefix = rolling(values)
    at = np.arange(len(values) - unit.gram + 1)
    grams = span_hash(prefix, at, at + unit.gram)
    least = _sliding_minimum(grams, unit.length - unit.gram + 1)
    valid = np.zeros(len(values) + 1, np.int32)
    np.add.at(valid, row_start[:-1], (fits > 0).astype(np.int32))
    np.add.at(valid, row_start[:-1] + fits, -(fits > 0).astype(np.int32))
    inside = np.cumsum(valid[: len(least)]) > 0
    opens = np.concatenate([[True], least[1:] != least[:-1]]) | np.concatenate([[True], ~inside[:-1]])
    opens[row_start[:-1][fits > 0]] = True
    opens &= inside
    first = np.flatnonzero(opens)
    row = np.searchsorted(row_start, first, "right") - 1
    stop = np.minimum(np.append(first[1:], len(least)), row_start[row] + fits[row])
    size = stop - first
    if (size > RUN).any():  # periodic text: an anchor may stand for any number of windows in a row
        parts = -(-size // RUN)
        which = np.repeat(np.arange(len(first)), parts)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
        first, size, row = first[which] + RUN * nth, np.minimum(RUN, size[which] - RUN * nth), row[which]
    # a window that starts with its anchor hands over to a later one of the same value
    moved = np.concatenate([[0], np.cumsum(grams[: len(least)] == least)])
    return row, least[first], first, size, moved[first + size - 1] > moved[first]


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Have Spark delete a job's shuffle files once its result is written, where it has the setting."""
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREED) if before is None else spark.conf.set(_FREED, before)


def document_key(doc_id: str, text: str) -> Column:
    """Tells documents apart, also those with one id; repeated rows have one key."""
    return F.xxhash64(F.col(doc_id), F.coalesce(F.col(text), F.lit("")))


def _occurrences(reps: DataFrame, unit: Unit) -> DataFrame:
    """(anchor, key, place) of every piece; place packs the first window, a flag for an anchor that the piece holds twice,
    and the number of windows less one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for low, _, data, offsets in chunks(batch.column(1)):
                values, row_start, _, _ = unit.symbols(data, offsets)
                row, anchor, first, size, twice = anchors(values, row_start, unit)
                if len(row):
                    place = ((first - row_start[row]) * 2 + twice) * RUN + size - 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor.view(np.int64)), pa.array(keys[low + row]), pa.array(place)], ["anchor", "key", "place"]
                    )

    return reps.select("key", "text").mapInArrow(run, "anchor bigint, key bigint, place bigint")


def _cut(reps: DataFrame, listed: DataFrame, unit: Unit) -> DataFrame:
    """(anchor, piece, doc, key, start) for the listed places (key, places) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, docs, lists = batch.column(0), batch.column(1), batch.column(3)
            for low, high, data, offsets in chunks(batch.column(2)):
                _, row_start, start, end = unit.symbols(data, offsets)
                own = lists.slice(low, high - low)
                n = own.value_lengths().to_numpy()
                row = np.repeat(np.arange(high - low), n)
                fields = own.flatten()
                anchor, place = fields.field("anchor"), fields.field("place").to_numpy()
                first = place // (2 * RUN) + row_start[row]
                last = first + place % RUN + unit.length - 1
                if unit.kind == "bytes":
                    raw = data.tobytes()
                    pieces = [raw[a : b + 1] for a, b in zip(first.tolist(), last.tolist())]
                else:
                    pieces = [joined(data, start[a : b + 1], end[a : b + 1]) for a, b in zip(first.tolist(), last.tolist())]
                taken = pa.array(low + row)
                yield pa.RecordBatch.from_arrays(
                    [anchor, pa.array(pieces, pa.binary()), docs.take(taken), keys.take(taken), pa.array(place // (2 * RUN))],
                    ["anchor", "piece", "doc", "key", "start"],
                )

    joined_texts = reps.join(listed, "key").select("key", "doc", "text", "places")
    return joined_texts.mapInArrow(run, "anchor bigint, piece binary, doc bigint, key bigint, start bigint")


def _windows(piece: str, unit: Unit) -> Column:
    """Array of the windows of a piece."""
    if unit.kind == "bytes":
        n = F.octet_length(piece) - (unit.length - 1)
        return F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.substring(piece, i, F.lit(unit.length))))
    words = F.split(F.col(piece).cast("string"), " ")
    return F.transform(
        F.sequence(F.lit(1), F.size(words) - (unit.length - 1)), lambda i: F.xxhash64(F.slice(words, i, F.lit(unit.length)))
    )


def _trimmed(classes: DataFrame, unit: Unit) -> DataFrame:
    """(anchor, digest, low, part, doc, start): classes of an anchor cut down to runs of windows that stand in two places or more.

    Windows are told apart by hashes here; a collision keeps a window that could go.
    """
    numbered = classes.select("*", F.posexplode(_windows("piece", unit)).alias("at", "window"))
    shared = numbered.groupBy("anchor", "window").agg(F.sum("n").alias("places")).filter("places > 1").drop("places")
    kept = numbered.join(shared, ["anchor", "window"], "left_semi")
    runs = kept.groupBy("anchor", "digest", "piece", "doc", "start").agg(F.collect_set("at").alias("at"))  # as long as a piece
    low = F.array_sort(F.filter("at", lambda i: ~F.array_contains("at", i - 1)))
    high = F.array_sort(F.filter("at", lambda i: ~F.array_contains("at", i + 1)))
    run = runs.select("*", F.inline(F.arrays_zip(low.alias("low"), high.alias("high"))))
    size = F.col("high") - F.col("low") + unit.length
    if unit.kind == "bytes":
        part = F.substring("piece", F.col("low") + 1, size)
    else:
        words = F.split(F.col("piece").cast("string"), " ")
        part = F.array_join(F.slice(words, F.col("low") + 1, size), " ").cast("binary")
    return run.select("anchor", "digest", "low", part.alias("part"), "doc", (F.col("start") + F.col("low")).alias("start"))


#: what a caller compares: (pieces, rank of each piece's first document, its first place) -> arrays of runs
#: (piece, first window, last window, piece whose document holds those windows first, place there less the first window)
Compare = Callable[[list[bytes], np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def _compared(classes: DataFrame, compare: Compare, shard_bytes: int) -> DataFrame:
    """(anchor, digest, low, high, doc, start): for runs of windows of each class, the document and place where they stand
    first; place is that of the class's first window, had the run reached back to it."""

    def run(group: pa.Table) -> pa.Table:
        docs = group["doc"].to_numpy()
        rank = np.unique(docs, return_inverse=True)[1]
        piece, low, high, of, start = compare(group["piece"].to_pylist(), rank, group["start"].to_numpy())
        columns = [group[c].to_numpy()[piece] for c in ("anchor", "digest")]
        return pa.table([pa.array(x) for x in (*columns, low, high, docs[of], start)], FOUND)

    total = classes.agg(F.sum(F.octet_length("piece"))).first()[0] or 0
    shard = F.pmod(F.xxhash64("anchor"), F.lit(max(1, -(-total // shard_bytes))))
    sharded = classes.select("anchor", "digest", "piece", "doc", "start", shard.alias("shard")).groupBy("shard")
    return sharded.applyInArrow(run, ", ".join(f"{c} bigint" for c in FOUND))


FOUND = ["anchor", "digest", "low", "high", "doc", "start"]


def _first_places(classes: DataFrame, unit: Unit, compare: Compare, shard_bytes: int) -> DataFrame:
    """``_compared`` of all classes; those of anchors with too many for one task are trimmed and collapsed once more before."""
    sizes = classes.groupBy("anchor").agg(F.sum(F.octet_length("piece")).alias("size"))
    hot = stage(sizes.filter(F.col("size") > HOT_BYTES).select("anchor"), "hot-anchors")
    if hot.isEmpty():
        return _compared(classes, compare, shard_bytes)
    parts = _trimmed(classes.join(hot, "anchor", "left_semi"), unit).withColumn("own", F.xxhash64("part"))
    parts = stage(parts, "trimmed-pieces")
    first = F.min(F.struct("doc", "start")).alias("at")
    collapsed = parts.groupBy("anchor", F.col("own").alias("digest"), F.col("part").alias("piece")).agg(first)
    found = _compared(stage(collapsed.select("anchor", "digest", "piece", "at.*"), "trimmed-classes"), compare, shard_bytes)
    back = parts.select("anchor", "digest", "own", F.col("low").alias("off")).join(
        found.withColumnRenamed("digest", "own"), ["anchor", "own"]
    )
    off = F.col("off")
    back = back.select("anchor", "digest", *[(F.col(c) + off).alias(c) for c in ("low", "high")], "doc", (F.col("start") - off).alias("start"))
    return _compared(classes.join(hot, "anchor", "left_anti"), compare, shard_bytes).unionByName(back)


def repeated_spans(
    docs: DataFrame, unit: Unit, compare: Compare, within: bool, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """(key, spans) of the documents that hold a window which stands earlier: spans of symbols (low, high exclusive) covered
    by such windows; null spans mean all of a document, which is a copy of an earlier one. Earlier is a smaller id (null
    is the smallest), or, if ``within``, also an earlier start in the same document."""
    spark = docs.sparkSession
    doc = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(2**63))).alias("doc")
    given = docs.select(document_key(doc_id, text).alias("key"), doc, F.coalesce(F.col(text), F.lit("")).alias("text"))
    # shorter texts hold no window
    given = given.filter(F.octet_length("text") >= (unit.length if unit.kind == "bytes" else 2 * unit.length - 1))
    with shuffles_freed(spark), scratch(spark) as staged:
        digests = stage(given.select("key", "doc", F.md5("text").alias("digest")), "text-digests")
        first = digests.groupBy("digest").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        later = digests.join(first, "digest").filter("doc > first").select("key").distinct()
        copies = stage(later, "copies")
        reps = given.join(copies, "key", "left_anti")

        places = stage(_occurrences(reps, unit), "anchors")
        twice = F.shiftright("place", RUN.bit_length() - 1).bitwiseAND(1)
        shared = places.groupBy("anchor").agg(F.sum(1 + twice).alias("n")).filter("n > 1").select("anchor")
        shared = stage(shared, "shared-anchors")
        listed = places.join(shared, "anchor", "left_semi").groupBy("key")
        listed = listed.agg(F.collect_set(F.struct("anchor", "place")).alias("places"))  # as long as the document
        # written before the texts are shuffled, so that the two shuffles are not on disk together
        pieces = _cut(reps, stage(listed, "listed-places"), unit).withColumn("digest", F.xxhash64("piece"))
        pieces = stage(pieces, "pieces")
        at = F.min(F.struct("doc", "start")).alias("at")
        classes = pieces.groupBy("anchor", "digest", "piece").agg(at, F.count(F.lit(1)).alias("n"))
        classes = stage(classes.select("anchor", "digest", "piece", "at.*", "n"), "piece-classes")
        found = stage(_first_places(classes, unit, compare, shard_bytes), "first-places")

        members = pieces.select("anchor", "digest", F.col("doc").alias("own"), "key", F.col("start").alias("place"))
        earlier = F.col("doc") < F.col("own")
        if within:
            earlier |= (F.col("doc") == F.col("own")) & (F.col("start") < F.col("place"))
        hit = members.join(found, ["anchor", "digest"]).filter(earlier)
        span = F.struct((F.col("place") + F.col("low")).alias("low"), (F.col("place") + F.col("high") + unit.length).alias("high"))
        spans = hit.groupBy("key").agg(F.collect_list(span).alias("spans"))  # as long as the document
        whole = copies.select("key", F.lit(None).cast("array<struct<low: bigint, high: bigint>>").alias("spans"))
        result = stage(spans.unionByName(whole), "repeated-spans")
        staged.pop()  # all but the spans is deleted
        return result


def marked(spans: pa.Array, has: pa.Array, row_start: np.ndarray, fits: np.ndarray) -> np.ndarray:
    """Marks the symbols of a chunk that lie in its rows' spans; a row that ``has`` null spans is marked whole if a window fits."""
    n = int(row_start[-1])
    step = np.zeros(n + 1, np.int64)
    counts = spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(spans)), counts)
    fields = spans.flatten()
    np.add.at(step, fields.field("low").to_numpy() + row_start[row], 1)
    np.add.at(step, fields.field("high").to_numpy() + row_start[row], -1)
    whole = has.to_numpy(zero_copy_only=False).astype(bool) & spans.is_null().to_numpy(zero_copy_only=False) & fits
    np.add.at(step, row_start[:-1][whole], 1)
    np.add.at(step, row_start[1:][whole], -1)
    return np.cumsum(step[:-1]) > 0


def with_spans(docs: DataFrame, spans: DataFrame, doc_id: str, text: str, names: tuple[str, str]) -> DataFrame:
    """``docs`` with its spans, and whether it has any entry at all, in the columns ``names``."""
    spans_name, has_name = names
    key = "_" + spans_name + "_key"
    found = spans.select(F.col("key").alias(key), F.col("spans").alias(spans_name))
    all_docs = docs.join(found, document_key(doc_id, text) == F.col(key), "left")
    return all_docs.withColumn(has_name, F.col(key).isNotNull()).drop(key)
