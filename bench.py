"""Time the headline queries on the generated tables and print one JSON line.

Every query is computed in full (``noop`` sink). ``land`` numbers and writes the whole feed, ``ingest`` runs the
whole batch into a new lake; the others start from what those two wrote, as they do in operation.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from sluice.session import build_session
from sluice.workload import feeds, queries

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = (
    "threshold_gate",
    "file_threshold_gate",
    "file_curated",
    "harmonize_mapped",
    "harmonize_rejected",
    "processed",
    "curated",
    "enrich_lookup_rejected",
    "scan_raw",
    "outbox_domain_record_ready",
    "vw_curated_with_run_context",
    "ingestion_steps",
    "vw_ingestion_status_by_day",
    "event_envelope",
    "route_messages",
)


def main() -> None:
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(build) -> float:
        start = time.perf_counter()
        build()
        return time.perf_counter() - start

    # the two writing jobs run once, cold; the queries below read their output
    seconds["land"] = timed(lambda: feeds.raw(spark, SF_DIR))
    seconds["ingest"] = timed(lambda: feeds.lake(spark, SF_DIR))
    registered = queries.queries()
    for name in HEADLINE:

        def run(name: str = name) -> None:
            registered[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

        run()  # warm up
        seconds[name] = statistics.median(timed(run) for _ in range(RUNS))
    rows = feeds.raw(spark, SF_DIR).count()
    seconds = {k: round(v, 3) for k, v in seconds.items()}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "feed_rows": rows,
                "cpus": int(CPUS),
                "runs": RUNS,
            }
        )
    )


if __name__ == "__main__":
    main()
