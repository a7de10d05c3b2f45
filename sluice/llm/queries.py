"""Registered queries of the dealt operators: each runs its operator over a whole table and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluice.llm import bwt_dedup, importance, order_minhash, periodic_runs, quality, secret_scan, substring_dedup, token_file, toxicity, url_filter, warc
from sluice.llm.bpe import round_trip_column
from sluice.llm.decontaminate import contamination
from sluice.llm.frames import table
from sluice.llm.url_filter import Rule
from sluice.session import new_path, stage

Query = Callable[[SparkSession, str], DataFrame]


def _removed(column: str) -> Column:
    return F.aggregate(f"{column}.removed", F.lit(0).cast("long"), lambda n, s: n + s["high"] - s["low"])


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = substring_dedup.remove_repeats(docs)
    return found.select("doc_id", "dedup.n_words", _removed("dedup").alias("n_removed"), F.sha2("dedup.kept", 256).alias("kept_sha256"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = bwt_dedup.remove_repeats(docs)
    spans = F.size("dedup.removed").cast("long").alias("n_spans")
    return found.select("doc_id", "dedup.n_bytes", _removed("dedup").alias("n_removed"), spans, F.sha2("dedup.kept", 256).alias("kept_sha256"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"), name="found").select("doc_id", "found.*")
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    measured = stage(quality.measure(docs).drop("text"), "measures")
    cutoffs = quality.calibrate(measured, table(spark, sf_dir, "labels"), "lang")
    judged = quality.judge(measured, cutoffs, "lang")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *[F.col(f"measures.{c}") for c in counts], "verdict.base_failed", "verdict.kept", "verdict.broken")


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer's vocabulary, which every executor has installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_file("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip_column(docs, path).select(
        "doc_id",
        F.size("encoded.ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("encoded.ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("encoded.text", 256).alias("decoded_sha256"),
    )


def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-file")
    token_file.write(table(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"))
    return token_file.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.sample_credentials(docs)).select("doc_id", "secrets.base", "secrets.added")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, ("assign", "access", "hex")),
        F.sha2(secret_scan.listed(F.col("base")), 256).alias("base_sha256"),
        secret_scan.listed(secret_scan.in_order(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return order_minhash.near_duplicates(docs).select("doc_id", "near.class_id", "near.n_class")


#: fixed values: the listed rules
LISTED_RULES = [
    Rule("allow", "org/", 2),
    Rule("block", "example.org/es/", 2),
    Rule("block", "example.org/en/1", 2),
    Rule("allow", "com/fr/", 2),
    Rule("block", "com/de/", 2),
]
#: rules of our own, for what no listed rule fits
PATTERN_RULES = [
    Rule("block", "cheap-pills.*/"),
    Rule("block", "spam-farm.*/"),
    Rule("block", "casino.*/"),
    Rule("block", "*-casino.*/"),
    Rule("block", "example.net/*/login"),
]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge(pages, url_filter.rule_table(spark, LISTED_RULES + PATTERN_RULES))
    listed = F.when(F.col("judged.tier") == 2, F.col("judged.rule")).alias("rule")
    return judged.select("page_id", "judged.host", "judged.path", listed, "judged.verdict")


def _url_filter_sql() -> str:
    """The longest listed rule that fits, else any pattern rule, else allow."""
    listed = sorted(LISTED_RULES, key=lambda r: -len(r.text))
    fits = lambda r: f"regexp_matches(host || path, '{r.pattern()}')"
    rule = " ".join(f"WHEN {fits(r)} THEN '{r.text}'" for r in listed)
    action = " ".join(f"WHEN {fits(r)} THEN '{r.action}'" for r in listed)
    patterns = " ".join(f"WHEN {fits(r)} THEN '{r.action}'" for r in PATTERN_RULES)
    return f"""
    WITH cut AS (
        SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
    ), parts AS (
        SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
            regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM cut
    )
    SELECT page_id, host, path, CASE {rule} END AS rule, CASE {action} {patterns} ELSE 'allow' END AS verdict FROM parts"""


FETCHED = "2026-01-01T00:00:00Z"


def op5_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as response files; their derivatives as files; what those hold, with digests checked against the bytes."""
    source, derived = new_path(spark, "warc-source"), new_path(spark, "warc-derived")
    warc.write(warc.responses(table(spark, sf_dir, "pages"), "page_id", "url", "html", FETCHED), source)
    warc.write(warc.derive(warc.read(spark, source)), derived)
    names = ["WARC-Type", "WARC-Record-ID", "WARC-Refers-To", "WARC-Target-URI", "WARC-Date", "WARC-Payload-Digest", "WARC-Block-Digest"]
    return warc.read(spark, derived).select(
        *[warc.header(n).alias(n.removeprefix("WARC-").lower().replace("-", "_")) for n in names],
        warc.header("Content-Length").cast("long").alias("content_length"),
        F.octet_length("block").cast("long").alias("n_bytes"),
        F.sha2("block", 256).alias("block_sha256"),
    )


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = importance.resample(docs, table(spark, sf_dir, "benchmark"), keep_text=False)
    return drawn.select("doc_id", "drawn.n_features", "drawn.weight", "drawn.score", "drawn.rank")


def stuttered(doc_id: Column, text: Column) -> Column:
    """The contract's periodic texts: a tenth of the documents, by checksum of the id, repeat a piece up to the end.

    Other texts, and those without words or id, stay as they are.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    n = F.size(words)
    first = (g % n).cast("int")
    period = (1 + F.floor((n - first) / (3 + g % 8))).cast("int")
    copies = F.flatten(F.array_repeat(F.slice(words, first + 1, period), F.ceil((n - first) / period).cast("int")))
    # an empty piece comes before a first word that stutters
    whole = F.slice(F.concat(F.slice(words, F.lit(1), first), copies), F.lit(1), n)
    return F.when((h % 10 == 0) & (n > 0), F.array_join(whole, " ")).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", stuttered(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs.periodic_runs(docs, name="found").select("doc_id", "found.runs", "found.kept")
    # the longest run; of those the first, then the one with the smallest period
    key = lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))
    found = found.withColumn("best", F.array_max(F.transform("runs", key)))
    length, start, period = F.col("best.length"), -F.col("best.before"), -F.col("best.shorter")
    # of runs with one start the longer has the longer period, so they come in the contract's order
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # a null id has no label, so it is held out
    held_out = lambda c: F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(True))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"))))
    scored = toxicity.score(docs, model, name="score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_bpe": op4_bpe,
    "op5_warc_derivatives": op5_warc_derivatives,
    "op6_quality_rules": op6_quality_rules,
    "op7_decontaminate": op7_decontaminate,
    "op8_token_file": op8_token_file,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_toxicity": op13_toxicity,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {"op2_url_filter": _url_filter_sql()}
