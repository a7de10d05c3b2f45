"""The per-run error threshold that decides whether a file may advance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sluice.functions import double_text


def reject_percent(rejected: Column, total: Column, when_empty: float) -> Column:
    share = rejected.cast("double") / F.nullif(total, F.lit(0).cast("bigint")) * 100
    return F.coalesce(share, F.lit(when_empty))


def exceeded(rejected: Column, total: Column, max_percent: Column, max_count: Column) -> Column:
    """Over the count limit or over the percent limit, both strictly; no rejects always pass."""
    over = (rejected > max_count) | (reject_percent(rejected, total, 100.0) > max_percent)
    return (rejected > 0) & over


def threshold_message(
    rejected: Column, total: Column, max_percent: Column, max_count: Column, rejected_uri: Column
) -> Column:
    return F.concat(
        F.lit("rejected rows exceeded threshold: "),
        rejected.cast("string"),
        F.lit("/"),
        total.cast("string"),
        F.lit(" rows; limits "),
        double_text(max_percent),
        F.lit("% or "),
        max_count.cast("string"),
        F.lit(" rows; rejected="),
        rejected_uri,
    )


def threshold_gate(counts: DataFrame, runs: DataFrame) -> DataFrame:
    """Judge counted runs (run_id, total, rejected) against their product's policy."""
    policy = runs.select("run_id", "product", "max_error_percent", "max_error_count")
    limits = (F.col("max_error_percent"), F.col("max_error_count"))
    return counts.join(policy, "run_id").withColumns(
        {
            "rejected_percent": reject_percent(F.col("rejected"), F.col("total"), 0.0),
            "exceeded": exceeded(F.col("rejected"), F.col("total"), *limits),
        }
    )


def passing(rows: DataFrame, gate: DataFrame) -> DataFrame:
    """Keep the rows of runs that may advance. ``gate`` has one row per run; pass it staged so its size is known."""
    return rows.join(gate.filter(~F.col("exceeded")).select("run_id"), "run_id", "left_semi")
