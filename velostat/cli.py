"""Command line: ``python -m velostat {ingest,analytics,report} ...``.

* ``ingest``: CSV folder -> silver Parquet -> curated trips + stations ->
  one quality-log append.  ``--reuse-silver`` skips the CSV work when the
  silver tables exist; ``--run-id`` makes a repeated run log its checks once.
* ``analytics``: the analytics suite on the curated tables, printed section
  by section (the local-year window is a parameter).
* ``report``: the short summary report (top-k of 10, rounded medians).

Paths are folders every executor can read (on a cluster: shared storage).
"""

from __future__ import annotations

import argparse
import sys

from velostat.operators import activity, analytics, quality
from velostat.operators.report import summary_report
from velostat.schema import NY_TZ
from velostat.session import get_session, scratch_dir
from velostat.sources import csv_ingest, tables


def _paths(warehouse: str) -> dict[str, str]:
    w = warehouse.rstrip("/")
    return {
        "silver": f"{w}/silver",
        "trips": f"{w}/trips",
        "stations": f"{w}/stations",
        "dq_log": f"{w}/data_quality_log",
    }


def run_ingest(
    spark, raw_dir: str, warehouse: str, reuse_silver: bool = False, tz: str = NY_TZ, run_id: str | None = None
) -> dict[str, int]:
    p = _paths(warehouse)
    normalized = None
    if not (reuse_silver and tables.silver_exists(spark, p["silver"])):
        normalized = csv_ingest.ingest_csv(spark, raw_dir, tz=tz)
    _, silver_stations = tables.build_silver(spark, normalized, p["silver"], reuse=reuse_silver)
    n_stations = tables.write_stations(silver_stations, p["stations"])
    n_trips = tables.write_curated_trips(tables.read_good_trips(spark, p["silver"]), p["trips"])
    trips, stations = tables.read_curated_trips(spark, p["trips"]), tables.read_stations(spark, p["stations"])
    quality.append_dq_log(quality.dq_summary(trips, stations), p["dq_log"], run_id=run_id)
    return {"stations": n_stations, "trips": n_trips, "rejects": tables.read_rejects(spark, p["silver"]).count()}


def analytics_sections(spark, warehouse: str, start: str, end: str, k: int = 20, tz: str = NY_TZ) -> dict:
    p = _paths(warehouse)
    trips, stations = tables.read_curated_trips(spark, p["trips"]), tables.read_stations(spark, p["stations"])
    days = activity.stage_rider_days(
        activity.rider_day_activity(trips, start, end, tz=tz), scratch_dir(spark, "rider_day_activity")
    )
    monthly = activity.monthly_active_proxy(days)
    return {
        "Daily active users proxy": activity.daily_active_proxy(days).orderBy("activity_day"),
        "Weekly active users proxy": activity.weekly_active_proxy(days).orderBy("activity_week_start"),
        "Monthly active users proxy": monthly.orderBy("activity_month"),
        "Month-over-month active user change": activity.mom_growth(monthly).orderBy("activity_month"),
        "Peak hours": analytics.peak_hours(trips, start, end, tz=tz).orderBy("trip_hour"),
        "Trip duration percentiles (minutes)": analytics.duration_percentiles(trips),
        "Top start stations": analytics.top_start_stations(trips, stations, k=k),
        "Top end stations": analytics.top_end_stations(trips, stations, k=k),
        "Station inflow vs outflow imbalance": analytics.station_imbalance(trips, stations, k=k),
        "Member vs casual usage": analytics.segment_usage(trips).orderBy("trip_count", ascending=False),
        "Churn and reactivation (30-day gap)": activity.churn_reactivation(days).orderBy("activity_month"),
    }


def _print(sections: dict, rows: int) -> None:
    for title, df in sections.items():
        print(f"\n=== {title} ===")
        df.show(rows, truncate=False)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="velostat")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ing = sub.add_parser("ingest", help="CSV -> silver -> curated tables + quality log")
    ing.add_argument("--raw", required=True, help="folder searched recursively for *.csv")
    ing.add_argument("--warehouse", required=True)
    ing.add_argument("--reuse-silver", action="store_true")
    ing.add_argument("--tz", default=NY_TZ, help="zone of the wall clocks in the CSV files")
    ing.add_argument("--run-id", default=None, help="id of this run in the quality log; a repeated run with the same id logs once")
    for name in ("analytics", "report"):
        sp = sub.add_parser(name)
        sp.add_argument("--warehouse", required=True)
        sp.add_argument("--start", default="2025-01-01", help="local-time window start (inclusive)")
        sp.add_argument("--end", default="2026-01-01", help="local-time window end (exclusive)")
        sp.add_argument("--rows", type=int, default=2_000_000_000, help="rows shown per section (all of them by default)")
        sp.add_argument("--tz", default=NY_TZ, help="zone of the local-time window and hours")
    ap.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    args = ap.parse_args(argv)

    spark = get_session(args.master)
    if args.cmd == "ingest":
        counts = run_ingest(spark, args.raw, args.warehouse, args.reuse_silver, args.tz, args.run_id)
        print(
            f"Loaded {counts['stations']:,} stations and {counts['trips']:,} trips"
            f" ({counts['rejects']:,} rows rejected); quality checks logged."
        )
    elif args.cmd == "analytics":
        _print(analytics_sections(spark, args.warehouse, args.start, args.end, tz=args.tz), args.rows)
    else:
        p = _paths(args.warehouse)
        trips, stations = tables.read_curated_trips(spark, p["trips"]), tables.read_stations(spark, p["stations"])
        _print(summary_report(trips, stations, args.start, args.end, scratch_dir(spark, "report"), tz=args.tz), args.rows)
    return 0


if __name__ == "__main__":
    sys.exit(main())
