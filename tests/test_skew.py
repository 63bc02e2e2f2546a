"""Hot keys: a third of all rows on one ride id / one station / NULL ids.
Results are checked against a brute-force pandas computation."""

from pyspark.sql import functions as F

from velostat.operators import analytics, curate, quality
from velostat.plans import bindings as b

from .conftest import SF_SMALL


def _skewed(spark):
    rides = b.volume_rides(spark, SF_SMALL).withColumn("_hot", (F.xxhash64("ride_id") % 3) == 0)
    hot = F.col("_hot")
    return (
        rides.withColumn("ride_id", F.when(hot, F.lit("HOT")).otherwise(F.col("ride_id")))
        .withColumn("start_station_id", F.when(hot, F.lit("7.10")).otherwise(F.col("start_station_id")))
        .withColumn("end_station_id", F.when(hot, F.lit(None).cast("string")).otherwise(F.col("end_station_id")))
        .drop("_hot")
    )


def test_hot_ride_id_dedup(spark):
    rides = _skewed(spark)
    pdf = rides.toPandas()
    assert (pdf.ride_id == "HOT").mean() > 0.25
    out = curate.dedupe_rides(rides.repartition(8)).toPandas()
    assert len(out) == pdf.ride_id.nunique()
    hot = pdf[pdf.ride_id == "HOT"].sort_values(["started_at", "ended_at", "rideable_type", "started_at_est",
                                                 "start_station_id", "end_station_id", "member_casual",
                                                 "trip_duration_seconds"], na_position="first")
    kept = out[out.ride_id == "HOT"].iloc[0]
    assert kept.started_at == hot.iloc[0].started_at and kept.trip_duration_seconds == hot.iloc[0].trip_duration_seconds


def test_hot_station_counts(spark):
    rides = _skewed(spark)
    pdf = rides.toPandas()
    top = analytics.top_start_stations(rides, b.supplier_stations(spark, SF_SMALL), k=1).first()
    assert top.station_id == "7.1" and top.trip_count == int((pdf.start_station_id == "7.10").sum() + (pdf.start_station_id == "7.1").sum())


def test_null_ids_in_joins_and_checks(spark):
    rides = _skewed(spark)
    st = b.supplier_stations(spark, SF_SMALL)
    pdf = rides.toPandas()
    known = set(st.toPandas().station_id)
    fixed = curate.null_out_missing_stations(rides, st).toPandas()
    assert len(fixed) == len(pdf)
    assert fixed.end_station_id.isna().sum() == (pdf.end_station_id.isna() | ~pdf.end_station_id.isin(known)).sum()
    summary = {r.check_name: r.issue_count for r in quality.dq_summary(rides, st, as_of="2030-01-01").collect()}
    assert summary["missing_end_station_reference"] == int((pdf.end_station_id.notna() & ~pdf.end_station_id.isin(known)).sum())
    assert summary["missing_start_station_reference"] == int((~pdf.start_station_id.isin(known)).sum())
    assert summary["duplicate_ride_ids"] == int((pdf.ride_id.value_counts() > 1).sum())


def test_hot_station_imbalance(spark):
    rides = _skewed(spark)
    pdf = rides.toPandas()
    flows = {r.station_id: r for r in analytics.station_imbalance(rides, b.supplier_stations(spark, SF_SMALL), k=100000).collect()}
    norm = lambda s: s.str.replace(r"0+$", "", regex=True).str.replace(r"\.$", "", regex=True)
    outbound = norm(pdf.start_station_id.dropna()).value_counts()
    inbound = norm(pdf.end_station_id.dropna()).value_counts()
    assert flows["7.1"].outbound_trips == outbound["7.1"]
    assert flows["7.1"].inbound_trips == inbound.get("7.1", 0)
    assert sum(r.net_inflow for r in flows.values()) == int(inbound.sum() - outbound.sum())


def test_histogram_percentiles_equal_brute_force(spark):
    import numpy as np

    rides = _skewed(spark)
    d = rides.where("trip_duration_seconds > 0 and trip_duration_seconds < 86400").toPandas().trip_duration_seconds
    row = analytics.duration_percentiles(rides).first()
    for col, q in (("p50_minutes", 50), ("p90_minutes", 90), ("p95_minutes", 95)):
        assert abs(getattr(row, col) - np.percentile(d, q) / 60.0) < 1e-9
    seg = {r.member_casual: r for r in analytics.segment_usage(rides).collect()}
    pdf = rides.toPandas()
    for member, grp in pdf.groupby("member_casual"):
        assert seg[member].trip_count == len(grp)
        assert abs(seg[member].median_duration_minutes - np.median(grp.trip_duration_seconds) / 60.0) < 1e-9
