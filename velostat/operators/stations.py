"""Station dimension: derivation from trips and the normalized-id collapse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velostat.functions.columns import normalize_station_id


def station_points(trips: DataFrame) -> DataFrame:
    """Start and end points of every trip, one scan: (station_id, name, lat, lng)
    for each side whose id is present."""
    point = lambda side: F.struct(
        F.col(f"{side}_station_id").alias("station_id"),
        F.col(f"{side}_station_name").alias("station_name"),
        F.col(f"{side}_lat").alias("station_lat"),
        F.col(f"{side}_lng").alias("station_lng"),
    )
    return (
        trips.select(F.explode(F.array(point("start"), point("end"))).alias("p"))
        .select("p.*")
        .where(F.col("station_id").isNotNull())
    )


def derive_stations(trips: DataFrame) -> DataFrame:
    """One row per raw station id: the largest name (the id if none), mean
    coordinates.

    Points are first summed per (station id, name) -- a hashed partial
    aggregate that absorbs busy stations before the shuffle (``max`` over text
    over all trips would sort them instead); the name and means are then
    taken over that small result."""
    per_name = station_points(trips).groupBy("station_id", "station_name").agg(
        F.sum("station_lat").alias("_lat"),
        F.count("station_lat").alias("_nlat"),
        F.sum("station_lng").alias("_lng"),
        F.count("station_lng").alias("_nlng"),
    )
    return per_name.groupBy("station_id").agg(
        F.coalesce(F.max("station_name"), F.col("station_id")).alias("station_name"),
        F.try_divide(F.sum("_lat"), F.sum("_nlat")).alias("station_lat"),
        F.try_divide(F.sum("_lng"), F.sum("_nlng")).alias("station_lng"),
    )


def normalized_stations(stations: DataFrame, strict: bool = False) -> DataFrame:
    """Stations keyed by normalized id; the largest name stands for the group."""
    return (
        stations.select(normalize_station_id("station_id", strict).alias("station_id"), "station_name")
        .groupBy("station_id")
        .agg(F.max("station_name").alias("station_name"))
    )


def normalized_trips(trips: DataFrame, strict: bool = False) -> DataFrame:
    """Both station ids normalized, with the trip's own names."""
    return trips.select(
        normalize_station_id("start_station_id", strict).alias("normalized_start_station_id"),
        normalize_station_id("end_station_id", strict).alias("normalized_end_station_id"),
        "start_station_name",
        "end_station_name",
    )
