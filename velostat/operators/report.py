"""The summary report: staged rider-days, then the report's sections.

Rider-days are written once and shared by the daily and monthly sections.
Normalized trip ids are not staged: the station sections read only the two
station columns of the trips table, which is what a staged copy would hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velostat.operators import activity, analytics
from velostat.schema import NY_TZ


def summary_report(
    trips: DataFrame, stations: DataFrame, start, end, staging_dir: str, k: int = 10, tz: str = NY_TZ
) -> dict[str, DataFrame]:
    """Report sections by title; the caller collects or shows them."""
    days = activity.stage_rider_days(
        activity.rider_day_activity(trips, start, end, tz=tz), f"{staging_dir}/rider_day_activity"
    )
    return {
        "Recent Daily Active Users (Proxy)": activity.recent_daily_active(days, k=10),
        "Monthly Active Users (Proxy)": activity.monthly_active_proxy(days).orderBy("activity_month"),
        "Trips by Hour (Local Time)": analytics.peak_hours(trips, start, end, tz=tz).orderBy("trip_hour"),
        "Top Start Stations": analytics.top_start_stations(trips, stations, k=k),
        "Station Inflow vs Outflow Imbalance": analytics.station_imbalance(trips, stations, k=k),
        "Member vs Casual Usage": analytics.segment_usage(trips, round_median=True).orderBy(
            F.col("trip_count").desc()
        ),
    }
