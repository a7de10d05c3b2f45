"""The two loops of the system as Structured Streaming queries.

Both run batch functions under ``foreachBatch``, which delivers at least once. The lake's ledger knows a batch by its stream's
checkpoint and its number there: a replay is recognised, and a stream that starts again with a new checkpoint has batches
of its own.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from sluice.contracts import CURATED_ZONE, REJECTED_ZONE
from sluice.functions import clock_text
from sluice.operators.enrich import Hook, Lookup
from sluice.plans.ingest import Source, ingest, publish_zones
from sluice.session import scratch
from sluice.sources.events import misrouted, open_envelopes
from sluice.sources.ledger import BatchKey
from sluice.sources.zones import Lake


def batch_key(lake: Lake, name: str, checkpoint: str, number: int) -> BatchKey:
    """Key of a stream's batch. A checkpoint holds an id that is made with it and stays with it."""
    about = lake.spark.read.text(f"{checkpoint}/metadata").first()[0]
    return BatchKey(f"{name}-{json.loads(about)['id']}", number)


def ingestion_stream(
    lake: Lake,
    event_dir: str,
    configs: DataFrame,
    mappings: DataFrame,
    source: Source,
    checkpoint: str,
    clock: Column | None = None,
    lookups: Sequence[Lookup] = (),
    hook: Hook | None = None,
    max_files: int = 10,
) -> DataStreamWriter:
    """Event files (one JSON message per line) to ingested runs. Bad messages are quarantined, never fatal;
    envelopes that the routing rule sends elsewhere are passed over.

    Start the returned writer with the trigger of your choice.
    """
    messages = lake.spark.readStream.option("maxFilesPerTrigger", max_files).text(event_dir)
    messages = messages.filter(~misrouted(F.col("value")))

    def run(batch: DataFrame, batch_id: int) -> None:
        now = clock
        if now is None:
            # one literal per batch, so that every task and every table agrees on the time
            now = F.lit(batch.sparkSession.range(1).select(clock_text(F.current_timestamp())).first()[0])
        with scratch(lake.spark):
            ingest(
                lake,
                open_envelopes(batch),
                configs,
                mappings,
                source,
                now,
                lookups=lookups,
                hook=hook,
                batch=batch_key(lake, "events", checkpoint, batch_id),
            )

    return messages.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)


def publication_streams(
    lake: Lake, configs: DataFrame, checkpoint: str, max_files: int = 10
) -> tuple[DataStreamWriter, DataStreamWriter]:
    """New curated and new rejected files to outbox messages, as one stream per zone."""
    spark = lake.spark

    no_curated = spark.createDataFrame([], CURATED_ZONE)
    no_rejected = spark.createDataFrame([], REJECTED_ZONE)

    def ready(batch: DataFrame, batch_id: int) -> None:
        with scratch(spark):
            publish_zones(lake, configs, batch, no_rejected, batch_key(lake, "curated", f"{checkpoint}/curated", batch_id))

    def bad(batch: DataFrame, batch_id: int) -> None:
        with scratch(spark):
            publish_zones(lake, configs, no_curated, batch, batch_key(lake, "rejected", f"{checkpoint}/rejected", batch_id))

    return (
        lake.read_stream("curated", max_files)
        .writeStream.foreachBatch(ready)
        .option("checkpointLocation", f"{checkpoint}/curated"),
        lake.read_stream("rejected", max_files)
        .writeStream.foreachBatch(bad)
        .option("checkpointLocation", f"{checkpoint}/rejected"),
    )
