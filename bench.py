"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (input tables), BENCH_CPUS (local cores), BENCH_RUNS
(runs per query, the best counts; ``cold`` has the first).  The derived market tables are written
before the clock starts; their time is reported as ``setup``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from catalogue import binding, queries  # noqa: E402
from stallkeeper import session  # noqa: E402
from stallkeeper.operators import parse  # noqa: E402

HEADLINE = (
    "parse_fanout",
    "parse_rejects",
    "event_counts",
    "latest_state",
    "merge_state",
    "refold_state",
    "stream_state",
    "reconcile_all",
    "merge_reconciled",
    "request_outcomes",
    "fetch_worklist",
    "snapshot_explode",
    "request_types",
    "market_name_latest",
    "listing_by_seller",
    "live_listings_for_item",
    "report_by_item",
    "price_ladder",
)


# The same feed in other forms: as it is, with an item in every counter, with booleans as text.
FEEDS = {
    "plain": "value",
    "counter_items": """replace(value, '"killEater":{', '"killEater":{"item":{"defindex":7,"name":"x","quality":{"id":5}},')""",
    "coerced": """replace(value, '"craftable":true', '"craftable":"true"')""",
}


def _parsing(spark: SparkSession, sf_dir: str, name: str, change: str, runs: int) -> float:
    """Seconds to parse one form of the feed, from a stored table."""
    path = f"{session.shared_dir(spark)}/bench_feeds/{spark.sparkContext.applicationId}/{name}"
    raw = session.stored(binding.tables(spark, sf_dir).messages.withColumn("value", F.expr(change)), path)
    best = None
    for _ in range(runs):
        started = time.perf_counter()
        parse.listing_events(parse.parse_listing_messages(raw)).write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - started
        best = seconds if best is None else min(best, seconds)
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    started = time.perf_counter()
    for part in binding.PARTS:
        getattr(binding.tables(spark, sf_dir), part)
    setup = time.perf_counter() - started

    catalogue, timed, cold = queries.catalogue(), {}, {}
    for name in HEADLINE:
        best, first = None, None
        for _ in range(runs):
            started = time.perf_counter()
            catalogue[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds = time.perf_counter() - started
            first = seconds if first is None else first
            best = seconds if best is None else min(best, seconds)
        timed[name], cold[name] = round(best, 3), round(first, 3)
    feeds = {name: _parsing(spark, sf_dir, name, change, runs) for name, change in FEEDS.items()}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "cold": cold,
                "feeds": feeds,
                "setup": round(setup, 3),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
