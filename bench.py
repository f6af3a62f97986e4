"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the table folder, BENCH_CPUS the local cores. Every query runs in full into a
sink that discards its rows: once to warm up, then twice, and the shorter time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from millwright.plans.queries import registry  # noqa: E402
from millwright.session import builder  # noqa: E402

HEADLINE = [
    "logistics_features_quarterly",
    "hrss_features_quarterly",
    "energy_efficiency",
    "anomaly_rate_by_axis",
    "rolling_asset_stats",
    "rolling_daily_stats",
    "quarter_over_quarter",
    "profile_categories",
    "profile_quantiles",
    "outliers_mad",
    "tumbling_counts",
    "dedup_events",
    "stratified_sample",
]


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    registry()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        builder("bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    for name in names:
        run(spark, name, sf_dir)
    times = {
        name: round(min(run(spark, name, sf_dir) for _ in range(2)), 3) for name in names
    }
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    try:
        sf = float(sf)
    except ValueError:
        pass
    print(json.dumps({
        "metric": "headline queries, total time", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
