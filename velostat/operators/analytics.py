"""Trip analytics: hours, durations, station rankings, imbalance, segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velostat.functions.columns import hour_label, normalize_station_id, rounded_ratio, utc_to_local
from velostat.operators.activity import local_window
from velostat.operators.stations import normalized_stations
from velostat.schema import MAX_TRIP_SECONDS, NY_TZ

PERCENTILES = (0.5, 0.9, 0.95)


def _valid_duration(d="trip_duration_seconds"):
    d = F.col(d)
    return d.isNotNull() & (d > 0) & (d < MAX_TRIP_SECONDS)


def peak_hours(trips: DataFrame, start, end, with_label: bool = True, tz: str = NY_TZ) -> DataFrame:
    """Trips per local hour inside the window (24 groups after a partial
    aggregate, so nothing large is sorted)."""
    hour = F.hour(utc_to_local("started_at", tz)).cast("bigint")
    keys = [hour.alias("trip_hour")]
    if with_label:
        keys.append(hour_label(hour).alias("trip_hour_label"))
    return local_window(trips, start, end, tz=tz).groupBy(*keys).agg(F.count(F.lit(1)).alias("trip_count"))


def duration_histogram(trips: DataFrame, keys=()) -> DataFrame:
    """Valid durations counted per (keys, second): at most 86,399 rows per key
    combination however many trips there are, built by a distributed hashed
    aggregate (map-side combine, then a shuffle on the duration itself)."""
    return (
        trips.where(_valid_duration())
        .groupBy(*keys, "trip_duration_seconds")
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def duration_percentiles(trips: DataFrame) -> DataFrame:
    """Exact continuous percentiles of valid durations, in minutes.

    A percentile straight over the trips would merge every task's value map
    in one final task.  Taken over the histogram instead (``percentile`` with
    a frequency column gives the same value as the expanded rows), the single
    task sees at most 86,399 rows."""
    hist = duration_histogram(trips)
    p = F.percentile("trip_duration_seconds", F.array(*[F.lit(x) for x in PERCENTILES]), F.col("_n"))
    agg = hist.agg(p.alias("_p"))
    return agg.select(
        *[(F.col("_p")[i] / 60.0).alias(f"p{int(q * 100)}_minutes") for i, q in enumerate(PERCENTILES)]
    )


def _station_counts(trips: DataFrame, side: str, strict: bool) -> DataFrame:
    """Trips per normalized station id on one side, with the trip-side name.

    ``max`` over text has no hash-aggregate buffer, so taking it over the trips
    would sort every map task's trips.  Counting per (station, name) first keeps
    the big aggregate hashed; the name is then chosen over that small result."""
    pairs = (
        trips.where(F.col(f"{side}_station_id").isNotNull())
        .groupBy(f"{side}_station_id", F.col(f"{side}_station_name").alias("_name"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # ids are normalized once per distinct pair, not once per trip
    return pairs.groupBy(normalize_station_id(f"{side}_station_id", strict).alias("station_id")).agg(
        F.sum("_n").alias("trip_count"), F.max("_name").alias("_trip_name")
    )


def _name_from_dimension(counts: DataFrame, stations: DataFrame, strict: bool) -> DataFrame:
    """Attach the dimension's name after aggregation: the join sees one row per
    station on each side, never the trips.  Spark picks the join strategy from
    measured sizes (AQE turns it into a broadcast when the side is small)."""
    dim = normalized_stations(stations, strict).withColumnRenamed("station_name", "_dim_name")
    return counts.join(dim, "station_id", "left")


def top_stations(trips: DataFrame, stations: DataFrame, side: str = "start", k: int = 20, strict: bool = False) -> DataFrame:
    """Busiest normalized stations on one side; ties go to the smaller id."""
    named = _name_from_dimension(_station_counts(trips, side, strict), stations, strict)
    return (
        named.select(
            "station_id",
            F.coalesce("_dim_name", "_trip_name").alias("station_name"),
            "trip_count",
        )
        .orderBy(F.col("trip_count").desc(), F.col("station_id").asc())
        .limit(k)
    )


def top_start_stations(trips: DataFrame, stations: DataFrame, k: int = 20, strict: bool = False) -> DataFrame:
    return top_stations(trips, stations, "start", k, strict)


def top_end_stations(trips: DataFrame, stations: DataFrame, k: int = 20, strict: bool = False) -> DataFrame:
    return top_stations(trips, stations, "end", k, strict)


def station_flows(trips: DataFrame, strict: bool = False) -> DataFrame:
    """Inbound and outbound trips per normalized station in one scan and one
    aggregation: each trip contributes an arrival and a departure row."""
    leg = lambda side, inbound: F.struct(
        F.col(f"{side}_station_id").alias("raw_id"),
        F.col(f"{side}_station_name").alias("name"),
        F.lit(inbound).alias("inbound"),
    )
    legs = trips.select(F.explode(F.array(leg("end", True), leg("start", False))).alias("l")).select("l.*")
    inbound = F.col("inbound")
    # hashed count per (station, name, direction), then names over that small set
    pairs = (
        legs.where(F.col("raw_id").isNotNull())
        .groupBy("raw_id", "name", "inbound")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return pairs.groupBy(normalize_station_id("raw_id", strict).alias("station_id")).agg(
        F.coalesce(F.sum(F.when(inbound, F.col("_n"))), F.lit(0)).alias("inbound_trips"),
        F.coalesce(F.sum(F.when(~inbound, F.col("_n"))), F.lit(0)).alias("outbound_trips"),
        F.max(F.when(inbound, F.col("name"))).alias("_in_name"),
        F.max(F.when(~inbound, F.col("name"))).alias("_out_name"),
    )


def _imbalance_top(df: DataFrame, k: int) -> DataFrame:
    return df.orderBy(F.abs(F.col("net_inflow")).desc(), F.col("station_id").asc()).limit(k)


def station_imbalance(trips: DataFrame, stations: DataFrame, k: int = 20, strict: bool = False) -> DataFrame:
    """Stations with the largest |arrivals - departures|.  The name prefers the
    dimension, then the arriving trips' name, then the departing trips'."""
    flows = _name_from_dimension(station_flows(trips, strict), stations, strict)
    out = flows.select(
        "station_id",
        F.coalesce("_dim_name", "_in_name", "_out_name").alias("station_name"),
        "inbound_trips",
        "outbound_trips",
        (F.col("inbound_trips") - F.col("outbound_trips")).alias("net_inflow"),
    )
    return _imbalance_top(out, k)


def station_imbalance_fullouter(trips: DataFrame, stations: DataFrame, k: int = 20, strict: bool = False) -> DataFrame:
    """The same result through separate inflow/outflow aggregates and a full
    outer join (kept to cross-check the one-pass form)."""
    inflow = _name_from_dimension(_station_counts(trips, "end", strict), stations, strict).select(
        F.col("station_id").alias("i_id"),
        F.coalesce("_dim_name", "_trip_name").alias("i_name"),
        F.col("trip_count").alias("inbound"),
    )
    outflow = _name_from_dimension(_station_counts(trips, "start", strict), stations, strict).select(
        F.col("station_id").alias("o_id"),
        F.coalesce("_dim_name", "_trip_name").alias("o_name"),
        F.col("trip_count").alias("outbound"),
    )
    joined = inflow.join(outflow, F.col("i_id") == F.col("o_id"), "full_outer")
    inbound = F.coalesce("inbound", F.lit(0)).cast("bigint")
    outbound = F.coalesce("outbound", F.lit(0)).cast("bigint")
    out = joined.select(
        F.coalesce("i_id", "o_id").alias("station_id"),
        F.coalesce("i_name", "o_name").alias("station_name"),
        inbound.alias("inbound_trips"),
        outbound.alias("outbound_trips"),
        (inbound - outbound).alias("net_inflow"),
    )
    return _imbalance_top(out, k)


def segment_usage(trips: DataFrame, round_median: bool = False) -> DataFrame:
    """Trips, mean and median minutes per rider segment.

    Works on the per-segment duration histogram, so a segment holding a third
    of all trips reaches its final task as at most 86,399 rows.  The mean is
    rounded half up to 2 dp from the exact sum and count; with
    ``round_median`` the median is rounded the same way."""
    d = F.col("trip_duration_seconds")
    hist = duration_histogram(trips.where(F.col("member_casual").isNotNull()), ["member_casual"])
    agg = hist.groupBy("member_casual").agg(
        F.sum("_n").alias("trip_count"),
        F.sum(d * F.col("_n")).alias("_total"),
        F.percentile(d, 0.5, F.col("_n")).alias("_median"),
    )
    avg_minutes = rounded_ratio("_total", F.col("trip_count") * 60, 2)
    if round_median:
        # A median of whole seconds is a multiple of 0.5, so 2 * median is exact.
        median = rounded_ratio(F.round(F.col("_median") * 2).cast("bigint"), F.lit(120), 2)
    else:
        median = F.col("_median") / 60.0
    return agg.select(
        "member_casual",
        "trip_count",
        avg_minutes.alias("avg_duration_minutes"),
        median.alias("median_duration_minutes"),
    )
