"""Data-quality checks on any trips DataFrame (raw, normalized or curated).

The nine logged checks come from three branches that read disjoint columns: the six per-row
checks are one aggregate, repeated ride ids one count, and both reference checks one count per
(side, station id) against the dimension.  The single checks stay available on their own.

The log is append-only by run: a run's rows live in a folder of their own, so appending a run
again (a retry) replaces its rows instead of adding to them.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velostat.schema import DQ_CHECKS
from velostat.sources.contracts import DQ_LOG

NULL_CHECKS = ("ride_id", "started_at", "ended_at", "member_casual")


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of)
    return F.lit(as_of).cast("timestamp")


def _row_predicates(as_of) -> dict[str, Column]:
    d = F.col("trip_duration_seconds")
    preds = {f"{c}_nulls": F.col(c).isNull() for c in NULL_CHECKS}
    preds["invalid_trip_durations"] = d.isNotNull() & (d <= 0)
    preds["future_started_at"] = F.col("started_at") > _as_of(as_of)
    return preds


def _counts_as_rows(wide: DataFrame, names) -> DataFrame:
    """One-row aggregate -> (check_name, issue_count) rows via ``stack``."""
    args = ", ".join(f"'{n}', `{n}`" for n in names)
    return wide.selectExpr(f"stack({len(names)}, {args}) AS (check_name, issue_count)")


def dq_row_checks(trips: DataFrame, as_of=None) -> DataFrame:
    """The six per-row checks in one aggregate over one scan."""
    preds = _row_predicates(as_of)
    wide = trips.agg(*[F.count_if(p).alias(n) for n, p in preds.items()])
    return _counts_as_rows(wide, list(preds))


def dq_null_checks(trips: DataFrame) -> DataFrame:
    preds = {f"{c}_nulls": F.col(c).isNull() for c in NULL_CHECKS}
    wide = trips.agg(*[F.count_if(p).alias(n) for n, p in preds.items()])
    return _counts_as_rows(wide, list(preds))


def dq_invalid_duration(trips: DataFrame) -> DataFrame:
    d = F.col("trip_duration_seconds")
    return trips.agg(F.count_if(d.isNotNull() & (d <= 0)).alias("invalid_duration_rows"))


def dq_future_start(trips: DataFrame, as_of=None) -> DataFrame:
    return trips.agg(F.count_if(F.col("started_at") > _as_of(as_of)).alias("future_started_at_rows"))


def ended_before_started(trips: DataFrame) -> DataFrame:
    """The end-after-start constraint, as a check (not among the logged nine)."""
    return trips.agg(F.count_if(F.col("ended_at") < F.col("started_at")).alias("ended_before_started_rows"))


def _missing_references(trips: DataFrame, stations: DataFrame, sides=("start", "end")) -> DataFrame:
    """Trip rows per side whose non-NULL station id is absent from ``stations``.

    Trips are first reduced to one row per (side, id) with a count, so the anti
    join sees distinct ids only; a hot station costs one row, and NULL ids are
    dropped before any join."""
    ref = lambda side: F.struct(F.lit(side).alias("side"), F.col(f"{side}_station_id").alias("station_id"))
    refs = (
        trips.select(F.explode(F.array(*[ref(s) for s in sides])).alias("r"))
        .select("r.*")
        .where(F.col("station_id").isNotNull())
        .groupBy("side", "station_id")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = stations.select("station_id").where(F.col("station_id").isNotNull()).distinct()
    return refs.join(known, "station_id", "left_anti").groupBy("side").agg(F.sum("rows").alias("rows"))


def _missing_total(trips: DataFrame, stations: DataFrame, side: str, alias: str) -> DataFrame:
    missing = _missing_references(trips, stations, (side,))
    return missing.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias(alias))


def dq_missing_start_station(trips: DataFrame, stations: DataFrame) -> DataFrame:
    return _missing_total(trips, stations, "start", "missing_start_station_rows")


def dq_missing_end_station(trips: DataFrame, stations: DataFrame) -> DataFrame:
    return _missing_total(trips, stations, "end", "missing_end_station_rows")


def repeated_ride_ids(trips: DataFrame) -> DataFrame:
    return (
        trips.where(F.col("ride_id").isNotNull())
        .groupBy("ride_id")
        .agg(F.count(F.lit(1)).alias("duplicate_count"))
        .where(F.col("duplicate_count") > 1)
    )


def dq_duplicate_rides(trips: DataFrame) -> DataFrame:
    """Repeated ride ids with their counts, most repeated first."""
    return repeated_ride_ids(trips).orderBy(F.col("duplicate_count").desc(), F.col("ride_id").asc())


def dq_summary(trips: DataFrame, stations: DataFrame, as_of=None) -> DataFrame:
    """The nine logged checks: check_name, issue_count, details; zero counts included.

    Three branches, each reading only its columns: the six row checks in one
    aggregate that shuffles a single row per task; ride ids with a count; station
    ids, one row per (side, id), against the dimension."""
    repeated = repeated_ride_ids(trips).agg(F.count(F.lit(1)).alias("duplicate_ride_ids"))
    missing = _missing_references(trips, stations)
    refs = missing.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("side") == side, F.col("rows"))), F.lit(0)).alias(f"missing_{side}_station_reference")
            for side in ("start", "end")
        ]
    )
    details = F.create_map(*[x for name, text in DQ_CHECKS for x in (F.lit(name), F.lit(text))])
    rows = (
        dq_row_checks(trips, as_of)
        .unionByName(_counts_as_rows(repeated, repeated.columns))
        .unionByName(_counts_as_rows(refs, refs.columns))
    )
    return rows.select(
        "check_name",
        F.col("issue_count").cast("bigint").alias("issue_count"),
        details[F.col("check_name")].alias("details"),
    )


def with_logged_at(summary: DataFrame, logged_at=None) -> DataFrame:
    """Log rows as appended: the check columns plus ``logged_at``."""
    stamp = F.current_timestamp() if logged_at is None else _as_of(logged_at)
    return summary.select("check_name", "issue_count", "details", stamp.alias("logged_at"))


def append_dq_log(summary: DataFrame, path: str, logged_at=None, run_id: str | None = None) -> str:
    """Append one run's checks to the quality log (Parquet); returns the run's id.

    The rows go to the folder ``run_id=...`` in one commit: an append that is repeated with the
    same ``run_id``, whether the first one ended or not, leaves that run's rows once."""
    run_id = run_id or uuid.uuid4().hex
    rows = DQ_LOG.enforced(with_logged_at(summary, logged_at)).withColumn("run_id", F.lit(run_id))
    writer = rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run_id").parquet(path)
    return run_id


def read_dq_log(spark: SparkSession, path: str) -> DataFrame:
    """The log's rows, all runs, with the ``run_id`` they were appended under."""
    log = spark.read.schema(T.StructType([*DQ_LOG.schema, T.StructField("run_id", T.StringType())])).parquet(path)
    return DQ_LOG.checked(log, partitions=("run_id",))
