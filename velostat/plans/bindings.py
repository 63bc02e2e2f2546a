"""Bindings: the driver's tables re-shaped as trips and stations.

The test tables are not trip data, so each binding maps one of them onto the
normalized trip schema by a fixed rule (the same rules are written in SQL for
the oracle, see ``plans/oracle.py``).  The fixture timestamps are naive and are
read as UTC wall clocks.

* ``raw_rides`` (events): dirty on purpose -- NULL keys, repeated ride ids,
  non-positive durations, two text forms of one station id.
* ``order_rides`` (orders): activity over 80 months for the proxy metrics.
* ``volume_rides`` (lineitem) with ``supplier_stations``: the benchmark volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velostat.functions.columns import utc_to_local
from velostat.operators.curate import curate_trips
from velostat.operators.stations import derive_stations
from velostat.schema import TRIP_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _instant(ntz: Column) -> Column:
    """Naive UTC wall clock -> TIMESTAMP (the session zone is UTC)."""
    return ntz.cast("timestamp")


def _number_text(c: Column) -> Column:
    return c.cast("string")


def raw_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    ride_num = F.when(eid % 10 == 9, eid - 1).otherwise(eid)
    duration = F.floor(F.col("value") * 60).cast("bigint") - 300
    ended = F.timestamp_add("SECOND", duration, F.col("ts"))
    k = F.regexp_extract("props", r'"k":\s*(-?[0-9]+)', 1).try_cast("bigint")
    start_no = F.lit(100) + F.col("user_id") % 40
    end_no = F.lit(100) + k % 40
    member = (
        F.when(F.col("event_type").isin("purchase", "signup"), F.lit("member"))
        .when(F.col("event_type").isin("click", "view"), F.lit("casual"))
        .otherwise(F.lit(None).cast("string"))
    )
    return ev.select(
        F.when(eid % 97 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("R"), _number_text(ride_num)))
        .alias("ride_id"),
        F.when(eid % 3 == 0, F.lit("classic_bike")).otherwise(F.lit("electric_bike")).alias("rideable_type"),
        _instant(F.col("ts")).alias("started_at"),
        utc_to_local(F.col("ts")).alias("started_at_est"),
        _instant(ended).alias("ended_at"),
        F.concat(F.lit("Stn "), _number_text(start_no)).alias("start_station_name"),
        F.when(eid % 13 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(_number_text(start_no), F.when(eid % 2 == 0, F.lit(".10")).otherwise(F.lit(".1"))))
        .alias("start_station_id"),
        F.concat(F.lit("Stn "), _number_text(end_no)).alias("end_station_name"),
        F.when(eid % 11 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(_number_text(end_no), F.lit(".1")))
        .alias("end_station_id"),
        (F.lit(40) + start_no / 1000).alias("start_lat"),
        (F.lit(-74) + start_no / 1000).alias("start_lng"),
        (F.lit(40) + end_no / 1000).alias("end_lat"),
        (F.lit(-74) + end_no / 1000).alias("end_lng"),
        member.alias("member_casual"),
        duration.alias("trip_duration_seconds"),
    )


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated trips from ``raw_rides``."""
    return curate_trips(raw_rides(spark, sf_dir))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station dimension derived from the un-curated trips."""
    return derive_stations(raw_rides(spark, sf_dir))


def stations_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension missing most ids, so the reference checks find something:
    the distinct raw start ids below '120' (text order)."""
    ids = raw_rides(spark, sf_dir).select(F.col("start_station_id").alias("station_id"))
    return ids.where(F.col("station_id") < "120").distinct()


def order_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as trips: status, priority and customer stand in for the proxy parts."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("O"), _number_text(F.col("o_orderkey"))).alias("ride_id"),
        F.col("o_orderpriority").alias("rideable_type"),
        _instant(F.col("o_orderdate")).alias("started_at"),
        utc_to_local(F.col("o_orderdate")).alias("started_at_est"),
        _instant(F.col("o_orderdate")).alias("ended_at"),
        F.lit(None).cast("string").alias("start_station_name"),
        _number_text(F.col("o_custkey")).alias("start_station_id"),
        F.lit(None).cast("string").alias("end_station_name"),
        F.lit(None).cast("string").alias("end_station_id"),
        F.lit(None).cast("double").alias("start_lat"),
        F.lit(None).cast("double").alias("start_lng"),
        F.lit(None).cast("double").alias("end_lat"),
        F.lit(None).cast("double").alias("end_lng"),
        F.col("o_orderstatus").alias("member_casual"),
        F.lit(None).cast("bigint").alias("trip_duration_seconds"),
    )


def volume_rides(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Line items as rides (600,000 at sf 0.1); ride ids repeat naturally.

    ``partitions`` spreads the scan (round robin) before the projections: the
    fixture file is a single row group, which Spark reads in one task."""
    li = table(spark, sf_dir, "lineitem")
    if partitions:
        li = li.repartition(partitions)
    n_stations = table(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()
    duration = (F.col("l_quantity") * 60).cast("bigint")
    ended = F.timestamp_add("SECOND", duration, F.col("l_shipdate"))
    return li.select(
        F.concat_ws("-", _number_text(F.col("l_orderkey")), _number_text(F.col("l_linenumber"))).alias("ride_id"),
        F.col("l_returnflag").alias("rideable_type"),
        _instant(F.col("l_shipdate")).alias("started_at"),
        utc_to_local(F.col("l_shipdate")).alias("started_at_est"),
        _instant(ended).alias("ended_at"),
        F.lit(None).cast("string").alias("start_station_name"),
        F.concat(_number_text(F.col("l_suppkey")), F.lit(".10")).alias("start_station_id"),
        F.lit(None).cast("string").alias("end_station_name"),
        F.concat(_number_text(F.col("l_partkey") % n_stations), F.lit(".1")).alias("end_station_id"),
        F.lit(None).cast("double").alias("start_lat"),
        F.lit(None).cast("double").alias("start_lng"),
        F.lit(None).cast("double").alias("end_lat"),
        F.lit(None).cast("double").alias("end_lng"),
        F.when(F.col("l_linestatus") == "O", F.lit("member")).otherwise(F.lit("casual")).alias("member_casual"),
        duration.alias("trip_duration_seconds"),
    ).select(*TRIP_COLUMNS)


def supplier_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.concat(_number_text(F.col("s_suppkey")), F.lit(".1")).alias("station_id"),
        F.col("s_name").alias("station_name"),
        F.lit(None).cast("double").alias("station_lat"),
        F.lit(None).cast("double").alias("station_lng"),
    )


# Local-time windows (the F2 year filter, parameterized per binding).
RIDES_WINDOW = ("2024-01-01", "2025-01-01")
ORDERS_WINDOW = ("1995-01-01", "2002-01-01")
VOLUME_WINDOW = ("1995-01-01", "2002-01-01")
# Fixed "now" for the future-start check, so results do not move with the clock.
AS_OF = "2024-01-15 00:00:00"
# Fixed times of two appends to the quality log (UTC).
LOGGED_AT = ("2024-01-15 01:00:00", "2024-01-15 02:30:00")
