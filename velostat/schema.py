"""Table schemas and the fixed names the pipeline must keep."""

from __future__ import annotations

from pyspark.sql import types as T

NY_TZ = "America/New_York"

# Fixed values (must equal the reference's): curated trip columns, in load order.
TRIP_COLUMNS = (
    "ride_id",
    "rideable_type",
    "started_at",
    "started_at_est",
    "ended_at",
    "start_station_name",
    "start_station_id",
    "end_station_name",
    "end_station_id",
    "start_lat",
    "start_lng",
    "end_lat",
    "end_lng",
    "member_casual",
    "trip_duration_seconds",
)

# Fixed values (must equal the reference's): station dimension columns.
STATION_COLUMNS = ("station_id", "station_name", "station_lat", "station_lng")


def _table(required, **columns) -> T.StructType:
    return T.StructType([T.StructField(name, kind, name not in required) for name, kind in columns.items()])


_TRIP_TYPES = {c: T.StringType() for c in TRIP_COLUMNS} | {
    "started_at": T.TimestampType(),
    "started_at_est": T.TimestampNTZType(),
    "ended_at": T.TimestampType(),
    "start_lat": T.DoubleType(),
    "start_lng": T.DoubleType(),
    "end_lat": T.DoubleType(),
    "end_lng": T.DoubleType(),
    "trip_duration_seconds": T.LongType(),
}

# Normalized (silver) trips: any column may be NULL.
TRIPS_SCHEMA = _table((), **_TRIP_TYPES)

# Fixed values (must equal the reference's): columns of curated trips that are never NULL.
CURATED_TRIPS_SCHEMA = _table(("ride_id", "started_at", "started_at_est", "ended_at", "member_casual"), **_TRIP_TYPES)

STATIONS_SCHEMA = _table(
    ("station_id", "station_name"),
    station_id=T.StringType(),
    station_name=T.StringType(),
    station_lat=T.DoubleType(),
    station_lng=T.DoubleType(),
)

DQ_LOG_SCHEMA = _table(
    ("check_name", "issue_count", "logged_at"),
    check_name=T.StringType(),
    issue_count=T.LongType(),
    details=T.StringType(),
    logged_at=T.TimestampType(),
)

# Fixed values (must equal the reference's): source-column aliases per target,
# first present alias wins.  Names are compared after header normalization.
TEXT_ALIASES = {
    "ride_id": ("ride_id",),
    "rideable_type": ("rideable_type",),
    "started_raw": ("started_at", "starttime"),
    "ended_raw": ("ended_at", "stoptime"),
    "start_station_name": ("start_station_name", "start station name"),
    "start_station_id": ("start_station_id", "start station id"),
    "end_station_name": ("end_station_name", "end station name"),
    "end_station_id": ("end_station_id", "end station id"),
    "tripduration_raw": ("tripduration",),
    "member_casual": ("member_casual",),
    "usertype": ("usertype",),
}
NUMERIC_ALIASES = {
    "start_lat": ("start_lat", "start station latitude"),
    "start_lng": ("start_lng", "start station longitude"),
    "end_lat": ("end_lat", "end station latitude"),
    "end_lng": ("end_lng", "end station longitude"),
}

# Fixed values (must equal the reference's): logged data-quality checks, in order.
DQ_CHECKS = (
    ("ride_id_nulls", "Trips missing ride_id values."),
    ("started_at_nulls", "Trips missing started_at timestamps."),
    ("ended_at_nulls", "Trips missing ended_at timestamps."),
    ("member_casual_nulls", "Trips missing member_casual values."),
    ("invalid_trip_durations", "Trips with trip_duration_seconds <= 0."),
    ("future_started_at", "Trips with started_at in the future."),
    ("missing_start_station_reference", "Trip rows with a start_station_id not found in stations."),
    ("missing_end_station_reference", "Trip rows with an end_station_id not found in stations."),
    ("duplicate_ride_ids", "Distinct ride_id values that appear more than once."),
)

# Fixed value (must equal the reference's): a trip must last more than 0 seconds and less than a day.
MAX_TRIP_SECONDS = 86400
