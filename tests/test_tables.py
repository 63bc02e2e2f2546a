"""Table contracts, versions of the silver pair, and the curated load."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from velostat.operators import curate
from velostat.plans import bindings as b
from velostat.sources import tables, versions
from velostat.sources.contracts import CURATED_TRIPS, DQ_LOG, SILVER_TRIPS, STATIONS, ContractError

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def raw(spark):
    return b.raw_rides(spark, SF_SMALL)


def test_a_missing_an_extra_a_mistyped_and_a_misplaced_column(spark, raw):
    for contract, frame in ((SILVER_TRIPS, raw), (STATIONS, b.stations(spark, SF_SMALL))):
        assert contract.checked(frame) is frame
        last = frame.columns[-1]
        for broken, column, what in (
            (frame.drop(last), last, "missing"),
            (frame.withColumn("more", F.lit(1)), "more", "not a column"),
            (frame.withColumn(last, F.col(last).cast("string")), last, "is string"),
            (frame.select(*reversed(frame.columns)), last, "place 1"),
        ):
            with pytest.raises(ContractError, match=f"{contract.table}.*{column}.*{what}"):
                contract.checked(broken)


def test_a_null_in_a_required_column_fails_the_write_and_the_check(spark, raw, tmp_dir):
    kept = curate.curate_trips(raw)
    CURATED_TRIPS.enforced(kept).write.parquet(f"{tmp_dir}/good")
    holed = kept.withColumn("member_casual", F.when(F.col("ride_id") != kept.first().ride_id, F.col("member_casual")))
    with pytest.raises(PySparkException, match="table trips, column member_casual: NULL"):
        CURATED_TRIPS.enforced(holed).write.parquet(f"{tmp_dir}/bad")
    with pytest.raises(ContractError, match="member_casual: NULL in 1 rows"):
        CURATED_TRIPS.verify(holed)
    assert CURATED_TRIPS.verify(kept) is kept
    with pytest.raises(PySparkException, match="station_name"):
        tables.write_stations(spark.createDataFrame([("1", None, 0.0, 0.0)], STATIONS.schema.simpleString()[7:-1]), f"{tmp_dir}/st")


def test_wrong_tables_on_disk_are_turned_down(spark, raw, tmp_dir):
    raw.withColumn("start_month", F.lit("x")).drop("ended_at").write.partitionBy("start_month").parquet(f"{tmp_dir}/trips")
    assert CURATED_TRIPS.required[-1] == "member_casual"
    raw.select("ride_id").write.parquet(f"{tmp_dir}/stations")
    with pytest.raises(ContractError, match="stations, column station_id: missing"):
        tables.read_stations(spark, f"{tmp_dir}/stations")
    assert DQ_LOG.required == ["check_name", "issue_count", "logged_at"]


def test_a_failed_write_leaves_the_old_pair(spark, raw, tmp_dir):
    stations = b.stations(spark, SF_SMALL)
    assert not tables.silver_exists(spark, tmp_dir)
    broken = stations.withColumn("station_name", F.raise_error(F.lit("no stations today")).cast("string"))
    with pytest.raises(PySparkException, match="no stations"):
        tables.write_silver(raw, broken, tmp_dir)
    assert not tables.silver_exists(spark, tmp_dir)  # trips without stations are no pair
    tables.write_silver(raw, stations, tmp_dir)
    first = versions.current_version(spark, tmp_dir)
    with pytest.raises(PySparkException, match="no stations"):
        tables.write_silver(raw.limit(5), broken, tmp_dir)
    trips, held = tables.read_silver(spark, tmp_dir)
    assert versions.current_version(spark, tmp_dir) == first
    assert trips.count() == raw.count() and held.count() == stations.count()
    tables.write_silver(raw.limit(5), stations, tmp_dir)
    assert tables.read_silver(spark, tmp_dir)[0].count() == 5
    assert trips.count() == raw.count()  # a reader of the old version goes on
    tables.write_silver(raw.limit(6), stations, tmp_dir)
    folders = sorted(f for f in os.listdir(tmp_dir) if f.startswith("v-"))
    assert len(folders) == versions.KEPT and tables.read_silver(spark, tmp_dir)[0].count() == 6
    assert not [f for f in os.listdir(tmp_dir) if f.startswith(".CURRENT-")]


def same(a, c):
    return a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0


@pytest.mark.parametrize("bits", [24, 8])
def test_narrow_dedup_equals_the_wide_one(spark, raw, bits, monkeypatch):
    monkeypatch.setattr(curate, "REPEAT_BITS", bits)
    hot = raw.withColumn("ride_id", F.when(F.xxhash64("ride_id", "started_at") % 3 == 0, F.lit("HOT")).otherwise(F.col("ride_id")))
    for trips in (raw, hot, raw.where("ride_id is null"), raw.where("false")):
        assert same(curate.dedupe_rides(trips, narrow=True), curate.dedupe_rides(trips))


def test_rides_that_do_not_repeat_are_not_shuffled(spark, raw, tmp_dir):
    """Of the wide rows only those whose id repeats reach the window."""
    raw.write.parquet(f"{tmp_dir}/trips")
    trips = spark.read.parquet(f"{tmp_dir}/trips").where("ride_id is not null")
    narrow = curate.dedupe_rides(trips, narrow=True)
    repeated = trips.groupBy("ride_id").count().where("count > 1").agg(F.sum("count")).first()[0]
    slot = curate._slot(F.col("ride_id"))
    word = F.get(curate.repeat_flags(trips), F.shiftright(slot, 6).cast("int"))
    reached = trips.where(word.bitwiseAND(curate._flag(slot)) != 0).count()
    assert repeated <= reached <= repeated + 5 < trips.count() / 3
    assert narrow.count() == trips.select("ride_id").distinct().count()


def test_curated_load_deals_time_to_tasks(spark, raw, tmp_dir, monkeypatch):
    """One instant with a third of the rows, far-off dates, few rows a task: every row once, few files a month."""
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 50)
    at = F.when(F.xxhash64("ride_id") % 3 == 0, F.lit("2024-01-05 12:00:00").cast("timestamp")).otherwise(F.col("started_at"))
    trips = raw.withColumn("started_at", at).withColumn("ended_at", F.col("started_at") + F.expr("interval 5 minutes"))
    want = curate.curate_trips(trips)
    for days, least in ((36_525, 10_000_000), (0, 0)):
        monkeypatch.setattr(tables, "MOST_DAYS", days)
        monkeypatch.setattr(tables, "NARROW_ROWS", least)
        path = f"{tmp_dir}/trips{days}"
        assert tables.write_curated_trips(trips, path) == want.count()
        back = tables.read_curated_trips(spark, path)
        assert same(back.drop("start_month"), want)
        sizes = [r[0] for r in back.groupBy(F.input_file_name()).count().select("count").collect()]
        assert max(sizes) < want.count() / 4  # the hot instant is in several files
    far = trips.limit(3).union(trips.limit(3).withColumns({c: F.col(c) + F.expr("interval 3000 years") for c in ("started_at", "ended_at", "started_at_est")}))
    assert tables.write_curated_trips(far, f"{tmp_dir}/far") == curate.curate_trips(far).count()
    assert tables.write_curated_trips(raw.where("false"), f"{tmp_dir}/none") == 0


def test_the_load_runs_its_dedup_once(spark, raw, tmp_dir):
    """No range sampling: the plan that is written has a single window pair and no sampled exchange."""
    tables.write_silver(raw, b.stations(spark, SF_SMALL), f"{tmp_dir}/silver")
    good = tables.read_good_trips(spark, f"{tmp_dir}/silver")
    task, tasks, total = tables.time_tasks(good)
    assert total == good.count()
    plan = curate.curate_trips(good, narrow=True).repartitionById(tasks, task)._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan and "verdict" in plan
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("WindowGroupLimit") <= 4  # partial and final, in the initial plan
