"""Times the headline queries on local cores and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import functions as F

from trolley.catalog.queries import QUERIES
from trolley.operators.prefix import hot_keys
from trolley.plans.batch import Settings, fact_from_events
from trolley.session import build_session
from trolley.sources.arrivals import cart_arrivals
from trolley.sources.tables import table

HEADLINE = [
    "decoded_messages",
    "broken_rules",
    "first_copies",
    "duplicates_against_store",
    "lateness_accept",
    "cart_totals",
    "cart_snapshot",
    "event_outcomes",
    "sink_range_outcomes",
    "duplicates_with_expiry",
    "fact_rows",
    "minute_rollup",
    "hourly_user_rollup",
    "product_rollup",
    "minute_rollup_from_batches",
    "active_carts",
    "events_processed",
    "p95_processing_seconds",
    "latest_change_per_version",
    "streamed_fact_rows",
]
RUNS = 3
# A query whose first run takes longer is timed once.
LONG_SECONDS = 15


def heavy_user(spark, folder):
    """The whole job with a third of all events in one user, who is treated as a heavy one."""
    third = F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.col("user_id"))
    events = table(spark, folder, "events").withColumn("user_id", third.cast("bigint"))
    hot = hot_keys(events, "user_id", min_rows=10_000)
    return fact_from_events(cart_arrivals(events, hot), Settings(clean_resends=True), hot)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "trolley-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            # Small partitions on purpose: the tables are small and the work per row is not.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    runs = {name: QUERIES[name] for name in HEADLINE} | {"heavy_user": heavy_user}
    for name, query in runs.items():
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            # All result columns are computed and none is collected.
            query(spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
            if len(times) == 2 and times[0] > LONG_SECONDS:
                break
        # The first run compiles the plan's code.
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
