"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

Every query runs in full into a sink that discards rows, once to warm up and
once timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from panelmill import plans

HEADLINE = (
    "reported_facts",
    "window_momentum",
    "momentum_snapshot",
    "momentum_snapshot_sparse",
    "group_growth",
    "group_snapshot",
    "constituents",
    "group_growth_leaderboard",
    "usd_translation",
    "release_profiles",
    "release_schedule",
    "freshness",
    "tolerance_match",
    "corroborated_articles",
    "evidence_pipeline",
    "priority_dates",
    "versioned_facts",
    "promoted_exact",
    "archive_rows",
    "article_records",
    "release_records",
    "page_links",
    "decoded_pages",
    "ranked_orders",
    "first_seen_stream",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("panelmill-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = plans.queries()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            registered[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
