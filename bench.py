"""Times the headline queries once each and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = [
    "keyword_df",
    "top_category",
    "match_cross",
    "cascade_match",
    "trigger_stats",
    "unmatched_words",
    "word_parents",
    "pair_rules",
    "frequent_pairs",
    "pair_claims",
    "equal_groups",
    "similar_groups",
    "merge_sources",
    "summary_levels",
    "validate_rows",
    "template_reps",
    "template_manifest",
    "regex_values",
    "model_values",
    "first_store",
    "publish_links",
    "gap_report",
    "run_list",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from workloads.catalog import QUERIES

    names = sys.argv[1:] or HEADLINE
    # one small pass starts the JVM code paths and the Python workers
    for name in ("valid_items", "keyword_df"):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(f"\n{name}: {times[name]}s", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
