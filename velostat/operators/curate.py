"""Curation: the load filter, ride deduplication and the station foreign key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velostat.schema import MAX_TRIP_SECONDS, TRIP_COLUMNS


def reject_reasons() -> dict[str, Column]:
    """The rules a curated trip must not break, in the order of their bits; none is NULL."""
    d, absent = F.col("trip_duration_seconds"), lambda c: F.col(c).isNull()
    breaks = {f"{c}_null": absent(c) for c in ("ride_id", "started_at", "started_at_est", "ended_at", "member_casual", "trip_duration_seconds")}
    breaks["duration_not_positive"] = d <= 0
    breaks["duration_of_a_day_or_more"] = d >= MAX_TRIP_SECONDS
    breaks["ended_before_started"] = F.col("ended_at") < F.col("started_at")
    return {name: F.coalesce(rule, F.lit(False)) for name, rule in breaks.items()}


def reject_bits() -> Column:
    """One number per trip: bit k is set if the trip breaks rule k; 0 for a trip to keep."""
    bits = [F.when(rule, F.lit(1 << k)).otherwise(F.lit(0)) for k, rule in enumerate(reject_reasons().values())]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def rejects_by_reason(rejects: DataFrame, bits: str = "reject_bits") -> DataFrame:
    """(reason, rows) for every rule, broken or not; a trip counts for each rule it breaks."""
    names = list(reject_reasons())
    wide = rejects.agg(*[F.count_if(F.col(bits).bitwiseAND(F.lit(1 << k)) != 0).alias(n) for k, n in enumerate(names)])
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return wide.selectExpr(f"stack({len(names)}, {pairs}) AS (reason, rows)")


def curation_filter(trips: DataFrame) -> DataFrame:
    """Rows the curated table accepts: required columns present, a duration in
    (0, 1 day) and an end not before the start."""
    d = F.col("trip_duration_seconds")
    return trips.filter(
        F.col("ride_id").isNotNull()
        & F.col("started_at").isNotNull()
        & F.col("started_at_est").isNotNull()
        & F.col("ended_at").isNotNull()
        & F.col("member_casual").isNotNull()
        & d.isNotNull()
        & (d > 0)
        & (d < MAX_TRIP_SECONDS)
        & (F.col("ended_at") >= F.col("started_at"))
    )


def dedupe_order(columns=TRIP_COLUMNS) -> list:
    """Keep the earliest start, then earliest end; the remaining columns break
    ties so the kept row never depends on task order."""
    rest = [c for c in columns if c not in ("ride_id", "started_at", "ended_at")]
    return [F.col("started_at").asc_nulls_first(), F.col("ended_at").asc_nulls_first()] + [
        F.col(c).asc_nulls_first() for c in rest
    ]


def _first_of_each(trips: DataFrame) -> DataFrame:
    """``row_number() == 1`` is planned as a partial WindowGroupLimit before the
    shuffle, so a ride id repeated a billion times is cut to one row per map
    task before it moves."""
    w = Window.partitionBy("ride_id").orderBy(*dedupe_order(trips.columns))
    return trips.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


# Flags of hashed ride ids that repeat: 2 MB whatever the number of trips.
REPEAT_BITS = 24


def _slot(ride_id: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(ride_id), 64 - REPEAT_BITS)


def _flag(slot: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(slot, F.lit(64)).cast("int"))


def repeat_flags(trips: DataFrame) -> Column:
    """The flags, 64 to a word, of the hashes that more than one trip has, as one array for all rows.

    Only 8-byte hashes are counted; a NULL id hashes like any other value."""
    hashes = trips.select(F.xxhash64("ride_id").alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    slot = F.shiftrightunsigned("_h", 64 - REPEAT_BITS)
    words = hashes.where("_n > 1").groupBy(F.shiftright(slot, 6).alias("_word")).agg(F.bit_or(_flag(slot)).alias("_bits"))
    every = trips.sparkSession.range(1 << (REPEAT_BITS - 6)).select(F.col("id").alias("_word")).join(words, "_word", "left")
    listed = every.agg(F.sort_array(F.collect_list(F.struct("_word", F.coalesce("_bits", F.lit(0)).alias("_bits")))).alias("_all"))
    return listed.select(F.transform("_all", lambda x: x["_bits"])).scalar()


def dedupe_rides(trips: DataFrame, narrow: bool = False) -> DataFrame:
    """One row per ride_id.

    ``narrow``, for stored trips (they are read twice): a first scan of the ids alone flags those
    that repeat; only trips whose id hits a flag are shuffled, the others pass as they are.  When the
    repeated ids outnumber the flags more trips are shuffled, with the same result."""
    if not narrow:
        return _first_of_each(trips)
    slot = _slot(F.col("ride_id"))
    word = F.get(repeat_flags(trips), F.shiftright(slot, 6).cast("int"))
    repeats = word.bitwiseAND(_flag(slot)) != 0
    return trips.where(~repeats).unionByName(_first_of_each(trips.where(repeats)))


def curate_trips(normalized: DataFrame, narrow: bool = False) -> DataFrame:
    """Normalized (silver) trips -> curated trips: filter, then dedupe (see ``dedupe_rides``)."""
    return dedupe_rides(curation_filter(normalized.select(*TRIP_COLUMNS)), narrow)


def null_out_missing_stations(trips: DataFrame, stations: DataFrame) -> DataFrame:
    """Foreign-key repair: a station id with no row in ``stations`` becomes NULL.

    Each side joins against the distinct ids of the dimension, so no trip is
    multiplied.  A NULL id can never match, but as a join key every NULL would
    hash to one shuffle partition; the key is replaced by a per-row text that
    starts with a NUL character (no station id does), which spreads those rows
    without changing the result."""
    ids = stations.select(F.col("station_id").alias("_sid")).where(F.col("_sid").isNotNull()).distinct()
    row_hash = F.xxhash64(*[F.col(c) for c in trips.columns]).cast("string")
    out = trips
    for side in ("start", "end"):
        col = f"{side}_station_id"
        known = ids.withColumnRenamed("_sid", f"_known_{side}")
        key = F.coalesce(F.col(col), F.concat(F.lit("\u0000"), row_hash))
        out = (
            out.withColumn("_key", key)
            .join(known, F.col("_key") == known[f"_known_{side}"], "left")
            .withColumn(col, F.col(f"_known_{side}"))
            .drop(f"_known_{side}", "_key")
        )
    return out.select(*trips.columns)
