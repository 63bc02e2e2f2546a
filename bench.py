"""Benchmark: the analytics suite on the lineitem binding.

Mirrors how the original pipeline runs: write the normalized (silver) Parquet,
curate + load the gold trips table, stage rider-days once, then run each
analytics query and the quality checks against the Parquet tables.  Each
step is timed as the median of 3 runs after a warm-up.
Prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_DRIVER_MEMORY (default 4g), BENCH_SHUFFLE_PARTITIONS (default 2 x CPUs).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from velostat.operators import activity, analytics, quality  # noqa: E402
from velostat.plans import bindings as b  # noqa: E402
from velostat.session import configure_session, scratch_dir  # noqa: E402
from velostat.sources import tables  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = 3


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("velostat-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "4g"))
        .config("spark.sql.shuffle.partitions", os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * CPUS)))
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure_session(spark)


def timed(fn, runs: int = RUNS) -> float:
    fn()  # warm-up
    samples = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        samples.append(time.perf_counter() - t0)
    return statistics.median(samples)


def main() -> None:
    spark = session()
    base = scratch_dir(spark, "bench")
    gold_trips, gold_stations = f"{base}/trips", f"{base}/stations"
    staged_days = f"{base}/rider_day_activity"
    silver = f"{base}/silver"
    times: dict[str, float] = {}

    # silver: the normalized trips (here the lineitem binding) as zstd Parquet
    def write_silver():
        # the fixture tables are single row groups: spread the scan over tasks
        rides = b.volume_rides(spark, SF_DIR, partitions=2 * CPUS)
        tables.write_silver(rides, b.supplier_stations(spark, SF_DIR), silver)

    times["silver_write"] = timed(write_silver)
    raw, _ = tables.read_silver(spark, silver)
    n_rows = raw.count()

    # gold: curate (filter + dedup) and write the month-partitioned trips table
    times["curate_load"] = timed(lambda: tables.write_curated_trips(raw, gold_trips))
    tables.write_stations(b.supplier_stations(spark, SF_DIR), gold_stations)
    trips = spark.read.parquet(gold_trips)
    stations = spark.read.parquet(gold_stations)
    window = b.VOLUME_WINDOW

    times["rider_day_activity"] = timed(
        lambda: activity.stage_rider_days(activity.rider_day_activity(trips, *window), staged_days)
    )
    days = spark.read.parquet(staged_days)

    queries = {
        "daily_active_proxy": lambda: activity.daily_active_proxy(days),
        "weekly_active_proxy": lambda: activity.weekly_active_proxy(days),
        "monthly_active_proxy": lambda: activity.monthly_active_proxy(days),
        "mom_growth": lambda: activity.mom_growth(activity.monthly_active_proxy(days)),
        "churn_reactivation": lambda: activity.churn_reactivation(days),
        "peak_hours": lambda: analytics.peak_hours(trips, *window),
        "duration_percentiles": lambda: analytics.duration_percentiles(trips),
        "top_start_stations": lambda: analytics.top_start_stations(trips, stations, k=20),
        "top_end_stations": lambda: analytics.top_end_stations(trips, stations, k=20),
        "station_imbalance": lambda: analytics.station_imbalance(trips, stations, k=20),
        "segment_usage": lambda: analytics.segment_usage(trips),
        "dq_summary": lambda: quality.dq_summary(raw, stations, as_of="2030-01-01"),
    }
    for name, build in queries.items():
        times[name] = timed(lambda build=build: build().collect())

    total = sum(times.values())
    print(
        json.dumps(
            {
                "metric": "analytics_suite_total",
                "value": round(total, 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in times.items()},
                "sf": os.path.basename(SF_DIR).removeprefix("sf"),
                "rows": n_rows,
                "rows_per_sec_curate": round(n_rows / times["curate_load"]) if times["curate_load"] else None,
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
