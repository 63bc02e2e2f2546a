"""Registered queries for the text-level operators (parsing, ingest, sinks).

Texts are rendered from event columns by fixed rules, so every query covers
the whole table; the oracle applies the original engine's own casts to the
same texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from velostat.functions import columns as C
from velostat.operators import activity, quality
from velostat.operators.curate import rejects_by_reason
from velostat.operators.stations import derive_stations
from velostat.plans import bindings as b
from velostat.plans import text_fixtures as tf
from velostat.session import scratch_dir
from velostat.sources import csv_ingest, tables
from velostat.sources.contracts import CURATED_TRIPS, DQ_LOG, STATIONS
from velostat.schema import TRIP_COLUMNS

# Day shifts that move the January events onto the 2024 DST changes.
TO_FALL_BACK_DAYS = 307  # 2024-01-01 -> 2024-11-03
TO_SPRING_FORWARD_DAYS = 69  # 2024-01-01 -> 2024-03-10


def _ev(spark, sf_dir):
    return tf.events(spark, sf_dir)


def clean_text_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id") % 5
    raw = (
        F.when(e == 0, F.concat(F.lit(" "), "event_type", F.lit(" ")))
        .when(e == 1, F.lit(""))
        .when(e == 2, F.lit("   "))
        .when(e == 3, F.concat("event_type", F.lit("\t")))
    )
    return _ev(spark, sf_dir).select("event_id", raw.alias("raw_text")).select(
        "event_id", "raw_text", C.clean_text("raw_text").alias("clean_text")
    )


def safe_cast_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id") % 4
    decimal_text = F.concat(
        F.col("user_id").cast("string"), F.lit("."), F.lpad((F.col("event_id") % 100).cast("string"), 2, "0")
    )
    raw = (
        F.when(e == 0, decimal_text)
        .when(e == 1, F.concat(F.lit("-"), decimal_text))
        .when(e == 2, F.concat(F.col("user_id").cast("string"), F.lit("e2")))
        .otherwise(F.col("event_type"))
    )
    return _ev(spark, sf_dir).select("event_id", raw.alias("raw_text")).select(
        "event_id",
        "raw_text",
        C.safe_double("raw_text").alias("as_double"),
        C.safe_bigint("raw_text").alias("as_bigint"),
    )


# Text forms of a timestamp (Spark patterns), chosen by event_id % 6.
TEXT_FORMS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss.SSS",
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy H:mm",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
)


def parse_timestamps_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id") % len(TEXT_FORMS)
    text = F.lit(None).cast("string")
    for i, fmt in reversed(list(enumerate(TEXT_FORMS))):
        text = F.when(e == i, F.date_format("ts", fmt)).otherwise(text)
    return _ev(spark, sf_dir).select("event_id", text.alias("raw_text")).select(
        "event_id", "raw_text", C.parse_local_timestamp("raw_text").alias("parsed")
    )


def _shifted(days: int):
    return F.timestamp_add("DAY", F.lit(days), F.col("ts"))


def local_to_utc_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times read as New York wall clocks, also moved onto the autumn
    fold and the spring gap."""
    return _ev(spark, sf_dir).select(
        "event_id",
        C.local_to_utc("ts").alias("utc"),
        C.local_to_utc(_shifted(TO_FALL_BACK_DAYS)).alias("utc_fall_back"),
        C.local_to_utc(_shifted(TO_SPRING_FORWARD_DAYS)).alias("utc_spring_forward"),
    )


def utc_to_local_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ev(spark, sf_dir).select(
        "event_id",
        C.utc_to_local("ts").alias("local"),
        C.utc_to_local(_shifted(TO_FALL_BACK_DAYS)).alias("local_fall_back"),
        C.utc_to_local(_shifted(TO_SPRING_FORWARD_DAYS)).alias("local_spring_forward"),
    )


def rider_type_map_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("event_type")
    usertype = (
        F.when(t == "purchase", F.lit("Subscriber"))
        .when(t == "signup", F.lit("SUBSCRIBER"))
        .when(t == "click", F.lit("Customer"))
        .when(t == "view", F.lit("Dependent"))
    )
    return _ev(spark, sf_dir).select("event_id", usertype.alias("usertype")).select(
        "event_id", "usertype", C.member_from_usertype("usertype").alias("member_casual")
    )


def derive_duration_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id") % 4
    raw = (
        F.when(e == 1, F.concat(F.col("user_id").cast("string"), F.lit(".5")))
        .when(e == 2, F.lit("abc"))
        .when(e == 3, F.floor(F.col("value") * 60).cast("string"))
    )
    ended = F.timestamp_add("MICROSECOND", F.floor(F.col("value") * 1_000_000), F.col("ts"))
    return _ev(spark, sf_dir).select(
        "event_id",
        C.derive_duration(C.clean_text(raw), F.col("ts").cast("timestamp"), ended.cast("timestamp")).alias(
            "trip_duration_seconds"
        ),
    )


def normalize_station_id_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id") % 4
    ids = b.raw_rides(spark, sf_dir).select("start_station_id")
    ev = _ev(spark, sf_dir)
    variants = ev.select(
        F.when(e == 1, (F.col("user_id") * 10).cast("string"))
        .when(e == 2, F.concat(F.lit("JC"), F.col("user_id").cast("string")))
        .when(e == 3, F.concat(F.col("user_id").cast("string"), F.lit(".")))
        .otherwise(F.concat(F.col("user_id").cast("string"), F.lit(".00")))
        .alias("start_station_id")
    )
    return (
        ids.unionByName(variants)
        .where(F.col("start_station_id").isNotNull())
        .select(
            F.col("start_station_id").alias("station_id"),
            C.normalize_station_id("start_station_id").alias("normalized_station_id"),
            C.normalize_station_id("start_station_id", strict=True).alias("strict_station_id"),
        )
        .distinct()
    )


def normalize_trips_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_ingest.normalize_trips(tf.modern_text_frame(spark, sf_dir))


def csv_ingest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both CSV layouts written, listed, grouped by header and read back.  The
    generated ids of legacy rows depend on file names, so they are checked by
    ``surrogate_ride_id`` and NULL here."""
    root = tf.write_trip_csvs(spark, sf_dir)
    trips = csv_ingest.ingest_csv(spark, root)
    real = F.when(F.col("ride_id").rlike("^R[0-9]+$"), F.col("ride_id")).alias("ride_id")
    return trips.select(real, *[c for c in TRIP_COLUMNS if c != "ride_id"])


def surrogate_ride_id_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event in a legacy file of its bucket, in id order; the generated row
    number of each, with the event id carried in a text column."""
    root = tf.write_legacy_buckets(spark, sf_dir)
    legacy = csv_ingest.ingest_csv(spark, root)
    seq = F.element_at(F.split(F.col("ride_id"), "_"), -1).cast("bigint")
    return legacy.select(
        F.regexp_extract("start_station_name", "[0-9]+", 0).cast("bigint").alias("event_id"),
        seq.alias("row_number"),
        (F.length("ride_id") - F.length(F.regexp_replace("ride_id", r"_[0-9]{12}$", ""))).cast("bigint").alias("suffix_chars"),
    )


def parquet_roundtrip_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver tables written (zstd), then reused from Parquet without recompute."""
    root = scratch_dir(spark, "silver")
    normalized = b.raw_rides(spark, sf_dir)
    tables.build_silver(spark, normalized, root)
    trips, _ = tables.build_silver(spark, None, root, reuse=True)
    return trips


def curated_table_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated trips written partitioned by local month and read back."""
    path = scratch_dir(spark, "curated") + "/trips"
    tables.write_curated_trips(b.raw_rides(spark, sf_dir), path)
    return tables.read_curated_trips(spark, path).drop("start_month")


def stations_table_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "stations") + "/stations"
    tables.write_stations(derive_stations(b.raw_rides(spark, sf_dir)), path)
    st = spark.read.parquet(path)
    return st.select("station_id", "station_name", F.round("station_lat", 6).alias("station_lat"),
                     F.round("station_lng", 6).alias("station_lng"))


def dq_log_append_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs appended to a quality log, the first of them twice; the log read back."""
    path = scratch_dir(spark, "dq-log") + "/log"
    summary = quality.dq_summary(b.raw_rides(spark, sf_dir), b.stations_partial(spark, sf_dir), as_of=b.AS_OF)
    for run, logged_at in (("first", b.LOGGED_AT[0]), ("first", b.LOGGED_AT[0]), ("second", b.LOGGED_AT[1])):
        quality.append_dq_log(summary, path, logged_at, run_id=run)
    return quality.read_dq_log(spark, path)


def curation_rejects_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected trips by broken rule, from the reject partition of the written silver table."""
    root = scratch_dir(spark, "silver")
    tables.write_silver(b.raw_rides(spark, sf_dir), derive_stations(b.raw_rides(spark, sf_dir)), root)
    return rejects_by_reason(tables.read_rejects(spark, root))


def table_contracts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the written tables: place, type, whether required, rows and NULLs found on disk."""
    root = scratch_dir(spark, "contracts")
    trips, stations = b.raw_rides(spark, sf_dir), derive_stations(b.raw_rides(spark, sf_dir))
    tables.write_curated_trips(trips, f"{root}/trips")
    tables.write_stations(stations, f"{root}/stations")
    quality.append_dq_log(quality.dq_summary(trips, stations, as_of=b.AS_OF), f"{root}/log", b.LOGGED_AT[0], run_id="only")
    parts = []
    for contract, read in (
        (CURATED_TRIPS, tables.read_curated_trips(spark, f"{root}/trips")),
        (STATIONS, tables.read_stations(spark, f"{root}/stations")),
        (DQ_LOG, quality.read_dq_log(spark, f"{root}/log")),
    ):
        df = contract.verify(read).select(*contract.columns)
        facts = [
            F.struct(
                F.lit(contract.table).alias("table_name"),
                F.lit(c).alias("column_name"),
                F.lit(place).alias("place"),
                F.lit(kind).alias("data_type"),
                F.lit(c in contract.required).alias("required"),
                F.count(F.lit(1)).alias("rows"),
                F.count_if(F.col(c).isNull()).alias("null_rows"),
            )
            for place, (c, kind) in enumerate(df.dtypes, 1)
        ]
        parts.append(df.agg(F.array(*facts).alias("facts")).select(F.explode("facts").alias("f")).select("f.*"))
    return reduce(DataFrame.unionByName, parts)


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.rider_day_activity(b.order_rides(spark, sf_dir), *b.ORDERS_WINDOW)


def staged_rider_days_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rider-days written once and read back."""
    return activity.stage_rider_days(_order_days(spark, sf_dir), scratch_dir(spark, "rider-days"))


def staged_activity_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily, weekly and monthly proxies and the monthly change, all from one staged table of rider-days."""
    days = staged_rider_days_q(spark, sf_dir)
    monthly = activity.monthly_active_proxy(days)
    rows = lambda df, grain, period, value: df.select(F.lit(grain).alias("grain"), F.col(period).alias("period"), F.col(value).alias("value"))
    return (
        rows(activity.daily_active_proxy(days), "day", "activity_day", "daily_active_users_proxy")
        .union(rows(activity.weekly_active_proxy(days), "week", "activity_week_start", "weekly_active_users_proxy"))
        .union(rows(monthly, "month", "activity_month", "monthly_active_users_proxy"))
        .union(rows(activity.mom_growth(monthly), "change", "activity_month", "month_over_month_change"))
    )


def bitmap_activity_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily, weekly and monthly proxies as unions of one staged table of day bitmaps."""
    bitmaps = activity.stage_day_bitmaps(_order_days(spark, sf_dir), scratch_dir(spark, "day-bitmaps"))
    parts = [activity.active_proxies(bitmaps, g).select(F.lit(g).alias("grain"), "period", "active_proxies") for g in activity.GRAINS]
    return reduce(DataFrame.unionByName, parts)


TEXT_QUERIES = {
    "clean_text": clean_text_q,
    "safe_cast": safe_cast_q,
    "parse_timestamps": parse_timestamps_q,
    "local_to_utc": local_to_utc_q,
    "utc_to_local": utc_to_local_q,
    "rider_type_map": rider_type_map_q,
    "derive_duration": derive_duration_q,
    "normalize_station_id": normalize_station_id_q,
    "normalize_trips": normalize_trips_q,
    "csv_ingest": csv_ingest_q,
    "surrogate_ride_id": surrogate_ride_id_q,
    "parquet_roundtrip": parquet_roundtrip_q,
    "curated_table_load": curated_table_q,
    "stations_table_load": stations_table_q,
    "dq_log_append": dq_log_append_q,
    "curation_rejects": curation_rejects_q,
    "table_contracts": table_contracts_q,
    "staged_rider_days": staged_rider_days_q,
    "staged_activity": staged_activity_q,
    "bitmap_activity": bitmap_activity_q,
}
