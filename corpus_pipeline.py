"""Documents through five dealt operators: quality rules, near-dedup, decontamination, secret masking, BPE ids.

Every stage takes the documents its predecessor kept and returns their columns; the last returns the token ids of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.llm.bpe import round_trip_column
from sluice.llm.decontaminate import decontaminate
from sluice.llm.frames import table
from sluice.llm.order_minhash import keep_first
from sluice.llm.quality import quality_filter
from sluice.llm.queries import tokenizer_file
from sluice.llm.secret_scan import mask_secrets
from sluice.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the certified cutoffs let pass."""
    return quality_filter(docs, table(spark, sf_dir, "labels"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every class of near-duplicates."""
    return keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts."""
    return mask_secrets(docs)


def bpe_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, whether they decode to it, and the other columns but the text."""
    encoded = round_trip_column(docs, tokenizer_file("byte_bpe_50k.json"), name="_encoded")
    same = F.col("_encoded.text") == F.coalesce("text", F.lit(""))
    others = [c for c in docs.columns if c not in ("text", "ids", "n_tokens", "round_trip")]
    ids = F.col("_encoded.ids")
    return encoded.select(*others, F.size(ids).cast("long").alias("n_tokens"), ids.alias("ids"), same.alias("round_trip"))


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_masking", secret_masking),
    ("bpe_ids", bpe_ids),
]

#: fitted cutoffs, alignments, inferred automata and a tokenizer are beyond SQL; tests hold the rows against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over ``documents``; each stage is written to shared storage and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
