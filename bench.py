"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from folkmeter.plans.catalog import QUERIES

HEADLINES = [
    "user_features",
    "post_features",
    "comment_features",
    "clean_comments",
    "upsert_users",
    "corr_matrix",
    "quartile_report",
    "page_links",
    "memberships",
    "resolve_authors",
    "karma_stats",
    "html_comments",
    "json_posts",
    "box_stats",
    "clean_training",
    "flatten_replies",
    "cap_per_group",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINES
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs + 1):  # the first run warms up
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total_wall_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "statistic": f"median of {runs} after one warm-up",
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
