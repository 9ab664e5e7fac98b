"""Time the headline queries: one JSON line on stdout.

Every query is executed in full into a no-op sink, once after a warm-up of the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from snapmart.plans.queries import QUERIES

HEADLINE = (
    "loan_silver",
    "label_store",
    "bad_rate_by_mob",
    "attributes_silver",
    "financials_silver",
    "clickstream_silver",
    "clickstream_dedup",
    "clickstream_validate",
    "one_hot_loans",
    "gold_features",
    "gold_features_inner",
    "gold_common_snapshots",
    "profile_table",
    "describe_numeric",
    "duplicate_stats",
    "duplicate_rows",
    "rule_violations",
    "row_count_by_snapshot",
    "row_count_by_domain",
    "scan_snapshot",
    "write_roundtrip",
    "bronze_backfill",
    "mart_build",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.TemporaryDirectory(prefix="snapmart-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("snapmart-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", scratch.name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Methods past this size are not compiled by the JVM: split them instead.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Without it every Column call looks up its Python call site.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["row_count"](spark, sf_dir).collect()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
