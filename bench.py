"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import registry  # noqa: E402

HEADLINE = (
    "enrollment_features", "python_features", "dashboard_rows", "review_sentiment", "review_summary",
    "aspect_summary", "parse_reviews", "unwrap_classes", "section_rows", "upsert_latest",
    "upsert_or_merge", "replace_slice", "page_links", "page_text", "requirement_codes",
    "requirement_signals", "roc_auc", "threshold_sweep", "standardized", "medians", "page_ratings",
    "requirement_rules", "one_hot_wide",
)


def seconds(run) -> float:
    started = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "4g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.files.minPartitionNum", cpus)
        .config("spark.sql.files.openCostInBytes", "64k")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    times = {}
    for name in names:
        laps = [seconds(lambda: queries[name](spark, sf_dir)) for _ in range(1 + repeats)]
        times[name] = round(statistics.median(laps[1:]), 3)  # the first lap warms up
    print(json.dumps({
        "metric": "sum of median query times", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
