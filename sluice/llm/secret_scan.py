"""Secret scan: fixed patterns, and a score by automata inferred from labelled credentials.

What the fixed patterns find are the labelled credentials of three kinds. Candidates are all other strings of eight or more
letters, digits and ``+/_.=-``, and what is left of such strings beside the spans of the patterns; they are labelled plain
if they hold more than letters, points and hyphens, else words, or capitals without any small letter. A bounded sample of each label (the strings of smallest hash,
``SAMPLE`` of them) trains one probabilistic automaton by state merging. Every candidate of every text is then scored: by how
much its likeliest credential format explains it better than the likeliest of the other automata does. Length
decides through the likelihood. Candidates above ``MARGIN`` are added as spans of kind ``format``.

Defined cases: null and empty texts have no spans; whole texts are scanned whatever their length; repeated rows are
scanned alike; with no labelled credentials at all nothing is added. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sluice.llm.frames import append, free_name, give_back, small_batches
from sluice.llm.grammar import Automaton, shape
from sluice.session import stage

SAMPLE = 400  # strings of each label that automata are trained on
MARGIN = 12.0  # natural logarithm of the likelihood ratio that makes a candidate a secret
KINDS = ("assign", "access", "hex", "format")
MASK = "[secret]"

# fixed values: the base patterns
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_KEYWORDS = ("password", "passwd", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")
_SHORTEST = 8
_OTHER = re.compile(r"[0-9+/_=]")  # what words don't hold
_KNOWN = 1 << 15  # shapes whose score is kept

Span = tuple[int, int, int]  # start, number of the kind, end


def base_spans(text: str) -> tuple[list[Span], list[tuple[str, str]]]:
    """Spans of the fixed patterns by start and kind, and the (kind, credential) pairs in them."""
    spans, values = [], []
    small = text.lower()
    if any(k in small for k in _KEYWORDS):
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= 8:
                spans.append((m.start(), 0, m.end()))
                values.append(("assign", m[2]))
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            spans.append((m.start(), 1, m.end()))
            values.append(("access", m[0]))
    for m in _HEX.finditer(text):
        spans.append((m.start(), 2, m.end()))
        values.append(("hex", m[0]))
    return sorted(spans), values


def candidates(text: str, spans: list[Span]) -> Iterator[tuple[int, int]]:
    """Strings outside the spans of the fixed patterns, which are given by start."""
    merged: list[list[int]] = []
    for a, _, b in spans:
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    k = 0
    for m in _CANDIDATE.finditer(text):
        at, end = m.span()
        while k < len(merged) and merged[k][1] <= at:
            k += 1
        while k < len(merged) and merged[k][0] < end:
            if merged[k][0] - at >= _SHORTEST:
                yield at, merged[k][0]
            at = merged[k][1]
            if at >= end:
                break
            k += 1
        if end - at >= _SHORTEST:
            yield at, end


def _label(candidate: str) -> str:
    """What a candidate that no pattern finds is labelled."""
    return "plain" if _OTHER.search(candidate) else "capitals" if candidate.isupper() else "words"


def sample_credentials(docs: DataFrame, text: str = "text", size: int = SAMPLE) -> dict[str, list[str]]:
    """Per label, the ``size`` distinct strings of smallest hash in all texts."""

    def lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        kept: dict[str, list] = {}
        inside: set[tuple[str, str]] = set()

        def offer(kind: str, value: str) -> None:
            heap = kept.setdefault(kind, [])
            entry = (-xxh64_intdigest(value), value)
            if (kind, value) in inside or len(heap) == size and entry <= heap[0]:
                return
            inside.add((kind, value))
            if len(heap) < size:
                heapq.heappush(heap, entry)
            else:
                inside.discard((kind, heapq.heapreplace(heap, entry)[1]))

        for batch in batches:
            for value in batch.column(0).to_pylist():
                if value:
                    spans, found = base_spans(value)
                    for kind, credential in found:
                        offer(kind, credential)
                    for a, b in candidates(value, spans):
                        offer(_label(value[a:b]), value[a:b])
        rows = [(kind, v, str(-h).rjust(20, "0")) for kind, heap in kept.items() for h, v in heap]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], ["kind", "value", "hash"])
        give_back()

    small_batches(docs.sparkSession)
    found = docs.select(text).mapInArrow(lowest, "kind string, value string, hash string").distinct()
    found = stage(found, "credentials")
    kinds = [*KINDS[:3], "plain", "words", "capitals"]
    return {k: sorted(r.value for r in found.filter(F.col("kind") == k).orderBy("hash", "value").limit(size).collect()) for k in kinds}


class Scorer:
    def __init__(self, sample: dict[str, list[str]]):
        self.formats = [Automaton(map(shape, sample[k])) for k in KINDS[:3] if sample.get(k)]
        self.plain = [Automaton(map(shape, sample.get("plain", [])))]
        self.plain += [Automaton(map(shape, sample[k])) for k in ("words", "capitals") if sample.get(k)]
        self.known: dict[str, float] = {}

    def score(self, candidate: str) -> float:
        """Log-likelihood ratio of the likeliest credential format against the likeliest of plain strings, words and capitals."""
        string = shape(candidate)
        found = self.known.get(string)
        if found is None:
            found = max((a.log_likelihood(string) for a in self.formats), default=float("-inf")) - max(a.log_likelihood(string) for a in self.plain)
            if len(self.known) >= _KNOWN:
                self.known.clear()
            self.known[string] = found
        return found

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and those that the automata add."""
        base, _ = base_spans(text)
        return base, [(a, 3, b) for a, b in candidates(text, base) if self.score(text[a:b]) >= MARGIN]


def masked(text: str, spans: list[Span]) -> str:
    out, at = [], 0
    for a, _, b in sorted(spans):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], MASK]
        at = b
    return "".join([*out, text[at:]])


_SPANS = "array<struct<kind: string, start: int, end: int>>"


def scan(docs: DataFrame, sample: dict[str, list[str]], text: str = "text", name: str = "secrets") -> DataFrame:
    """``docs`` with a struct column: ``base`` and ``added`` spans, and ``clean``, the text with all spans masked (null stays null)."""
    shared = docs.sparkSession.sparkContext.broadcast(Scorer(sample))
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(texts: pa.Array) -> pa.StructArray:
        base, added, clean = [], [], []
        for value in texts.to_pylist():
            own, more = shared.value.spans(value or "")
            for found, out in ((own, base), (more, added)):
                out.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in found])
            clean.append(masked(value, own + more) if value else value)
        return pa.StructArray.from_arrays(
            [pa.array(base, spans), pa.array(added, spans), pa.array(clean, pa.string())], ["base", "added", "clean"]
        )

    return append(docs, text, run, f"base {_SPANS}, added {_SPANS}, clean string", name)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def in_order(spans: Column) -> Column:
    """Spans by start, then by kind as listed."""
    rank = lambda kind: F.array_position(F.array(*map(F.lit, KINDS)), kind)
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank(s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_sort(keyed)


def mask_secrets(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with secrets masked in the text, and the number of characters counted anew where a text changed."""
    name = free_name(docs, "secrets")
    found = scan(docs, sample_credentials(docs, text), text, name)
    changed = F.size(F.col(name)["base"]) + F.size(F.col(name)["added"]) > 0
    new = {text: F.col(name)["clean"], n_chars: F.when(changed, F.length(F.col(name)["clean"]).cast("long")).otherwise(F.col(n_chars))}
    return found.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])
