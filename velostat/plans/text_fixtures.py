"""Text inputs derived from the fixture tables.

The ingest path starts at text, so these builders render ``raw_rides`` as the
two CSV layouts the pipeline meets (modern, and the legacy layout of older
files with spaced headers and user types), and render event columns as the
text forms the parsing functions accept.  All of them read whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velostat.functions.columns import utc_to_local
from velostat.plans.bindings import raw_rides, table
from velostat.session import scratch_dir

# Rides that started before this UTC wall clock are written in the legacy layout.
LEGACY_BEFORE = "2024-01-10 00:00:00"
LEGACY_FILE_ROWS = 1500

MODERN_TIME = "yyyy-MM-dd HH:mm:ss.SSS"
LEGACY_TIME = "M/d/yyyy H:mm:ss"


def _is_legacy() -> F.Column:
    return F.col("started_at").cast("timestamp_ntz") < F.lit(LEGACY_BEFORE).cast("timestamp_ntz")


def modern_layout(rides: DataFrame) -> DataFrame:
    return rides.select(
        "ride_id",
        "rideable_type",
        F.date_format("started_at_est", MODERN_TIME).alias("started_at"),
        F.date_format(utc_to_local("ended_at"), MODERN_TIME).alias("ended_at"),
        "start_station_name",
        "start_station_id",
        "end_station_name",
        "end_station_id",
        "start_lat",
        "start_lng",
        "end_lat",
        "end_lng",
        "member_casual",
    )


def legacy_layout(rides: DataFrame) -> DataFrame:
    usertype = (
        F.when(F.col("member_casual") == "member", F.lit("Subscriber"))
        .when(F.col("member_casual") == "casual", F.lit("Customer"))
    )
    return rides.sortWithinPartitions("started_at").select(
        F.col("trip_duration_seconds").cast("string").alias("tripduration"),
        F.date_format("started_at_est", LEGACY_TIME).alias("starttime"),
        F.date_format(utc_to_local("ended_at"), LEGACY_TIME).alias("stoptime"),
        F.col("start_station_id").alias("start station id"),
        F.col("start_station_name").alias("start station name"),
        F.col("start_lat").alias("start station latitude"),
        F.col("start_lng").alias("start station longitude"),
        F.col("end_station_id").alias("end station id"),
        F.col("end_station_name").alias("end station name"),
        F.col("end_lat").alias("end station latitude"),
        F.col("end_lng").alias("end station longitude"),
        usertype.alias("usertype"),
        F.lit("0").alias("gender"),
    )


def with_hard_names(rides: DataFrame) -> DataFrame:
    """Every seventh duration gets a start station name with a newline, quotes and commas."""
    name = F.col("start_station_name")
    hard = F.concat(name, F.lit('\n"Gate", '), F.col("trip_duration_seconds").cast("string"), F.lit('\n\n"'))
    return rides.withColumn("start_station_name", F.when(F.col("trip_duration_seconds") % 7 == 0, hard).otherwise(name))


def write_trip_csvs(spark: SparkSession, sf_dir: str) -> str:
    """Write ``raw_rides``, some with names over several lines, as CSV under a fresh scratch folder; returns it."""
    root = scratch_dir(spark, "trip-csv")
    rides = with_hard_names(raw_rides(spark, sf_dir))
    (
        modern_layout(rides.where(~_is_legacy()))
        .write.option("header", "true")
        .option("escape", '"')
        .csv(f"{root}/modern")
    )
    (
        legacy_layout(rides.where(_is_legacy()))
        .write.option("header", "true")
        .option("escape", '"')
        .option("maxRecordsPerFile", LEGACY_FILE_ROWS)
        .csv(f"{root}/legacy")
    )
    return root


# Files of the row-number fixture.
LEGACY_BUCKETS = 4


def write_legacy_buckets(spark: SparkSession, sf_dir: str) -> str:
    """Every event as a row of a legacy-layout file: one file per ``event_id %
    LEGACY_BUCKETS``, in id order, the id in a text column."""
    root = scratch_dir(spark, "legacy-csv")
    rows = table(spark, sf_dir, "events").select(
        (F.col("event_id") % LEGACY_BUCKETS).alias("bucket"),
        "event_id",
        F.date_format("ts", LEGACY_TIME).alias("starttime"),
        F.date_format("ts", LEGACY_TIME).alias("stoptime"),
        F.concat(F.lit("Event "), F.col("event_id").cast("string")).alias("start station name"),
    )
    rows = rows.repartition(LEGACY_BUCKETS, "bucket").sortWithinPartitions("bucket", "event_id").drop("event_id")
    rows.write.option("header", "true").partitionBy("bucket").csv(root)
    return root


def modern_text_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_rides`` as an all-text frame in the modern layout (microseconds kept)."""
    rides = raw_rides(spark, sf_dir)
    text_time = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return rides.select(
        *[
            F.date_format("started_at_est", text_time).alias("started_at")
            if c == "started_at"
            else F.date_format(utc_to_local("ended_at"), text_time).alias("ended_at")
            if c == "ended_at"
            else F.col(c).cast("string").alias(c)
            for c in modern_layout(rides).columns
        ]
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")
