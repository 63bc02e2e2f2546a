"""Plan shape checks: what each query must (and must not) compile to."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from velostat.operators import activity, analytics, curate, quality
from velostat.plans import bindings as b
from velostat.sources import tables

from .conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "EvalPython")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_cross_joins_or_python_in_registered_plans(spark, name):
    text = plan_text(E.queries()[name](spark, SF_SMALL))
    assert not [f for f in FORBIDDEN if f in text], text[:2000]


def test_dedup_partial_limit_precedes_exchange(spark):
    text = plan_text(curate.dedupe_rides(b.raw_rides(spark, SF_SMALL)))
    tree = text.split("\n\n")[0]
    # the tree is printed root first: Exchange sits above the partial limit
    lines = [ln.strip(" +-:") for ln in tree.splitlines()]
    names = [ln.split(" (")[0] for ln in lines if ln]
    assert names.count("WindowGroupLimit") == 2
    assert names.index("Exchange") < len(names) - 1 - names[::-1].index("WindowGroupLimit")


def test_window_filter_prunes_months_and_pushes_bounds(spark, tmp_dir):
    path = f"{tmp_dir}/trips"
    tables.write_curated_trips(b.volume_rides(spark, SF_SMALL), path)
    trips = spark.read.parquet(path)
    text = plan_text(analytics.peak_hours(trips, "1997-01-01", "1998-01-01"))
    assert "PartitionFilters: [isnotnull(start_month" in text and "start_month" in text
    assert "GreaterThanOrEqual(started_at" in text and "LessThan(started_at" in text
    days = plan_text(activity.rider_day_activity(trips, "1997-01-01", "1998-01-01"))
    assert "PartitionFilters: [isnotnull(start_month" in days


def test_scans_read_only_needed_columns(spark, tmp_dir):
    path = f"{tmp_dir}/trips"
    tables.write_curated_trips(b.volume_rides(spark, SF_SMALL), path)
    trips = spark.read.parquet(path)
    text = plan_text(analytics.duration_percentiles(trips))
    read_schema = [ln for ln in text.splitlines() if ln.startswith("ReadSchema")]
    assert read_schema and all(ln == "ReadSchema: struct<trip_duration_seconds:bigint>" for ln in read_schema)


def test_station_names_join_after_aggregation(spark):
    text = plan_text(analytics.top_start_stations(b.rides(spark, SF_SMALL), b.stations(spark, SF_SMALL)))
    tree = text.split("\n\n")[0]
    # every join in the tree has an aggregate below it on the trip side
    assert "Join" in tree and "HashAggregate" in tree  # trips are aggregated by hash, not sorted
    assert "TakeOrderedAndProject" in tree


def test_dq_summary_has_no_full_scan_per_check(spark):
    text = plan_text(quality.dq_summary(b.raw_rides(spark, SF_SMALL), b.stations_partial(spark, SF_SMALL)))
    tree = text.split("\n\n")[0]
    # row checks, ride ids, station ids, and one scan for the station dimension
    assert tree.count("Scan parquet") <= 4


def test_dq_summary_branches_read_their_own_columns(spark, tmp_dir):
    path = f"{tmp_dir}/trips"
    b.raw_rides(spark, SF_SMALL).write.parquet(path)
    b.stations_partial(spark, SF_SMALL).write.parquet(f"{tmp_dir}/stations")
    text = plan_text(quality.dq_summary(spark.read.parquet(path), spark.read.parquet(f"{tmp_dir}/stations")))
    schemas = [ln for ln in text.splitlines() if ln.startswith("ReadSchema")]
    assert "ReadSchema: struct<ride_id:string>" in schemas
    assert "ReadSchema: struct<start_station_id:string,end_station_id:string>" in schemas
    assert "Expand" not in text


def test_other_zone_windows_are_not_pruned_wrongly(spark, tmp_dir):
    """Partitions are New York months; a Tokyo window must still see every row."""
    from velostat.operators.curate import curate_trips

    raw = b.volume_rides(spark, SF_SMALL)
    tables.write_curated_trips(raw, f"{tmp_dir}/trips")
    gold = spark.read.parquet(f"{tmp_dir}/trips")
    flat = curate_trips(raw)
    for tz in ("Asia/Tokyo", "America/New_York"):
        a = analytics.peak_hours(gold, "1997-01-01", "1998-01-01", tz=tz)
        c = analytics.peak_hours(flat, "1997-01-01", "1998-01-01", tz=tz)
        assert a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0
    text = plan_text(analytics.peak_hours(gold, "1997-01-01", "1998-01-01"))
    assert "(start_month#" in text and "<= 1997-12)" in text
