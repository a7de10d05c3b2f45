"""1-based record numbers inside each group without ever bringing a group together.

Records are numbered from small per-block counts: a block is a slice of the data that one task holds in order
(a file split, or one range partition), so no group is sorted or counted in a single task however large it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from sluice.session import stage

CHUNK = 1 << 16


def block_bases(blocks: DataFrame, group: Sequence[str], order: Sequence[str], count: str) -> DataFrame:
    """Records that precede each block of its group. One row per block, so the window stays small."""
    earlier = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("base", F.coalesce(F.sum(count).over(earlier), F.lit(0)))


def number_by_key(
    rows: DataFrame, group: Sequence[str], order: Sequence[str], label: str = "numbered", keep_order: bool = True
) -> DataFrame:
    """Number rows of a table in key order. ``order`` must be unique within a group.

    One range shuffle on (group, order) splits hot groups by key. The sorted rows are written once because range
    bounds are sampled: a second evaluation could cut them elsewhere. Without ``keep_order`` the columns of ``order`` are
    left out, of what is written too.
    """
    keys = [*group, *order]
    placed = (
        rows.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumns({"_block": F.spark_partition_id(), "_pos": F.monotonically_increasing_id()})
    )
    placed = stage(placed if keep_order else placed.drop(*order), label)
    blocks = placed.groupBy(*group, "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    bases = stage(block_bases(blocks, group, ["_block"], "_n"), f"{label}-blocks")
    return (
        placed.join(bases, [*group, "_block"])
        .withColumn("row_number", F.col("base") + F.col("_pos") - F.col("_first") + 1)
        .drop("_block", "_pos", "_n", "_first", "base")
    )


def renumber_without(rows: DataFrame, removed: DataFrame, group: str = "run_id") -> DataFrame:
    """Position each of ``rows`` would have had its group been renumbered after taking ``removed`` out.

    Both sides carry (group, row_number). Only these rows move, in fixed-width chunks of the old numbering, so a
    chunk never holds more than ``CHUNK`` rows.
    """
    chunk = F.floor((F.col("row_number") - 1) / CHUNK)
    marks = removed.select(group, "row_number").withColumn("_gone", F.lit(1))
    both = rows.withColumn("_gone", F.lit(0)).unionByName(marks, allowMissingColumns=True).withColumn("_chunk", chunk)
    per_chunk = both.groupBy(group, "_chunk").agg(F.sum("_gone").alias("_n"))
    bases = block_bases(per_chunk, [group], ["_chunk"], "_n").drop("_n")
    before = Window.partitionBy(group, "_chunk").orderBy("row_number")
    return (
        both.withColumn("_before", F.sum("_gone").over(before))
        .filter("_gone = 0")
        .join(bases, [group, "_chunk"])
        .withColumn("position", F.col("row_number") - F.col("_before") - F.col("base"))
        .drop("_gone", "_chunk", "_before", "base")
    )
