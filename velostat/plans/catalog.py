"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query runs over whole fixture tables through a binding.  Outputs carry
only naive timestamps, dates, text, BIGINT and DOUBLE so that they compare
cell for cell with the DuckDB oracle in ``plans/oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velostat.operators import activity, analytics, curate, quality, stations as st
from velostat.plans import bindings as b
from velostat.plans.text_queries import TEXT_QUERIES
from velostat.session import configure_session

Query = Callable[[SparkSession, str], DataFrame]


def naive_output(df: DataFrame) -> DataFrame:
    """Instants leave as UTC wall clocks (TIMESTAMP_NTZ)."""
    cols = [
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def _q(fn: Callable[[SparkSession, str], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure_session(spark)
        return naive_output(fn(spark, sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _rider_days(spark, sf_dir):
    return activity.rider_day_activity(b.order_rides(spark, sf_dir), *b.ORDERS_WINDOW)


REGISTRY: dict[str, Query] = {
    # analytics on curated rides
    "peak_hours": _q(lambda s, d: analytics.peak_hours(b.rides(s, d), *b.RIDES_WINDOW)),
    "peak_hours_unlabeled": _q(lambda s, d: analytics.peak_hours(b.rides(s, d), *b.RIDES_WINDOW, with_label=False)),
    "duration_percentiles": _q(lambda s, d: analytics.duration_percentiles(b.rides(s, d))),
    "top_start_stations": _q(lambda s, d: analytics.top_start_stations(b.rides(s, d), b.stations(s, d), k=20)),
    "top_end_stations": _q(lambda s, d: analytics.top_end_stations(b.rides(s, d), b.stations(s, d), k=20)),
    "station_imbalance": _q(lambda s, d: analytics.station_imbalance(b.rides(s, d), b.stations(s, d), k=20)),
    "station_imbalance_fullouter": _q(
        lambda s, d: analytics.station_imbalance_fullouter(b.rides(s, d), b.stations(s, d), k=20)
    ),
    "segment_usage": _q(lambda s, d: analytics.segment_usage(b.rides(s, d))),
    "segment_usage_rounded": _q(lambda s, d: analytics.segment_usage(b.rides(s, d), round_median=True)),
    # rider-proxy activity on the many-month binding
    "rider_day_activity": _q(_rider_days),
    "daily_active_proxy": _q(lambda s, d: activity.daily_active_proxy(_rider_days(s, d))),
    "recent_daily_active": _q(lambda s, d: activity.recent_daily_active(_rider_days(s, d), k=10)),
    "weekly_active_proxy": _q(lambda s, d: activity.weekly_active_proxy(_rider_days(s, d))),
    "monthly_active_proxy": _q(lambda s, d: activity.monthly_active_proxy(_rider_days(s, d))),
    "mom_growth": _q(lambda s, d: activity.mom_growth(activity.monthly_active_proxy(_rider_days(s, d)))),
    "churn_reactivation": _q(lambda s, d: activity.churn_reactivation(_rider_days(s, d))),
    # curation and the station dimension
    "curate_trips": _q(lambda s, d: curate.curate_trips(b.raw_rides(s, d))),
    "dedupe_rides": _q(lambda s, d: curate.dedupe_rides(b.raw_rides(s, d))),
    # the same with few rows shuffled, for stored trips
    "curate_trips_narrow": _q(lambda s, d: curate.curate_trips(b.raw_rides(s, d), narrow=True)),
    "dedupe_rides_narrow": _q(lambda s, d: curate.dedupe_rides(b.raw_rides(s, d), narrow=True)),
    "derive_stations": _q(
        lambda s, d: b.stations(s, d).select(
            "station_id",
            "station_name",
            F.round("station_lat", 6).alias("station_lat"),
            F.round("station_lng", 6).alias("station_lng"),
        )
    ),
    "normalized_stations": _q(lambda s, d: st.normalized_stations(b.stations(s, d))),
    "normalized_trips": _q(lambda s, d: st.normalized_trips(b.rides(s, d))),
    "null_missing_stations": _q(
        lambda s, d: curate.null_out_missing_stations(b.raw_rides(s, d), b.stations_partial(s, d))
    ),
    # data quality on the un-curated trips
    "dq_null_checks": _q(lambda s, d: quality.dq_null_checks(b.raw_rides(s, d))),
    "dq_invalid_duration": _q(lambda s, d: quality.dq_invalid_duration(b.raw_rides(s, d))),
    "dq_future_start": _q(lambda s, d: quality.dq_future_start(b.raw_rides(s, d), as_of=b.AS_OF)),
    "dq_missing_start_station": _q(
        lambda s, d: quality.dq_missing_start_station(b.raw_rides(s, d), b.stations_partial(s, d))
    ),
    "dq_missing_end_station": _q(
        lambda s, d: quality.dq_missing_end_station(b.raw_rides(s, d), b.stations_partial(s, d))
    ),
    "dq_duplicate_rides": _q(lambda s, d: quality.dq_duplicate_rides(b.raw_rides(s, d))),
    # SURVEY D4
    "ended_before_started": _q(lambda s, d: quality.ended_before_started(b.raw_rides(s, d))),
    "top_start_stations_report": _q(lambda s, d: analytics.top_start_stations(b.rides(s, d), b.stations(s, d), k=10)),
    "station_imbalance_report": _q(lambda s, d: analytics.station_imbalance(b.rides(s, d), b.stations(s, d), k=10)),
    "dq_summary": _q(lambda s, d: quality.dq_summary(b.raw_rides(s, d), b.stations_partial(s, d), as_of=b.AS_OF)),
    # the original's flow: checks after curation, against the full derived dimension
    "dq_summary_curated": _q(lambda s, d: quality.dq_summary(b.rides(s, d), b.stations(s, d), as_of=b.AS_OF)),
}
REGISTRY.update({name: _q(fn) for name, fn in TEXT_QUERIES.items()})
