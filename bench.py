"""Time the headline queries once, warm, and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tickloom.plans import catalog

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "ohlcv_1s", "ohlcv_1h", "rollup_1m", "rollup_1h", "gui_rollup", "daily_summary", "trade_bars_daily", "latest_price",
    "compare_parity", "rule_summary", "violation_records", "zscore_rows", "jump", "cluster_sessions", "fusion_scores",
    "continuity_metrics", "dedup_keep_last", "anti_join_new", "qa_chain", "zscore_range", "derivatives_as_of", "burst_records",
)


def main() -> None:
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", CPUS).config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    taken = {}
    for name in names:
        run = catalog.QUERIES[name]
        run(spark, SF_DIR).write.format("noop").mode("overwrite").save()  # compile and touch the files
        began = time.perf_counter()  # with what a query writes on the way
        run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        taken[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline queries, total seconds", "value": round(sum(taken.values()), 3), "unit": "sec", "queries": taken, "sf": os.path.basename(SF_DIR.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
