"""CSV ingest: header groups, legacy files, surrogate ids, Parquet reuse."""

import os

from pyspark.sql import functions as F

from velostat.sources import csv_ingest, tables
from velostat.plans import bindings as b

from .conftest import SF_SMALL

MODERN = (
    "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name,"
    "end_station_id,start_lat,start_lng,end_lat,end_lng,member_casual\n"
    "R1,classic_bike,2025-01-02 03:04:05.678,2025-01-02 03:14:05.678, Stn A ,5980.10,Stn B,6000.1,40.7,-74.0,40.8,-74.1,member\n"
    "R2,electric_bike,2025-11-02 01:30:00,2025-11-02 01:40:00,Stn A,5980.1,,,abc,,,,casual\n"
)
LEGACY = (
    '"tripduration","starttime","stoptime","start station id","start station name","start station latitude",'
    '"start station longitude","end station id","end station name","end station latitude","end station longitude",'
    '"bikeid","usertype","birth year","gender"\n'
    '"600","1/2/2025 3:04:05","1/2/2025 3:14:05","72","W 52 St","40.76","-73.99","79","Franklin St","40.71","-74.0","1","Subscriber","1980","1"\n'
    '"1.5","1/2/2025 4:00","1/2/2025 4:10","72","W 52 St","40.76","-73.99","79","Franklin St","40.71","-74.0","2","Customer","1990","2"\n'
    '"abc","1/2/2025 5:00","1/2/2025 5:10","72","W 52 St","40.76","-73.99","","","","","3","Dependent","",""\n'
)


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_normalize_column_name():
    assert csv_ingest.normalize_column_name(" Start Station ID ") == "start_station_id"
    assert csv_ingest.normalize_column_name("birth year") == "birth_year"


def test_mixed_headers_do_not_shift(spark, tmp_dir):
    _write(f"{tmp_dir}/2025-01", "modern.csv", MODERN)
    _write(f"{tmp_dir}/2019-01/nested", "201901-legacy.csv", LEGACY)
    _write(tmp_dir, "notes.txt", "not a csv")
    trips = csv_ingest.ingest_csv(spark, tmp_dir)
    rows = {r.ride_id: r for r in trips.collect()}
    assert len(rows) == 5
    r1 = rows["R1"]
    assert r1.start_station_name == "Stn A" and r1.member_casual == "member" and r1.trip_duration_seconds == 600
    r2 = rows["R2"]
    assert r2.end_station_id is None and r2.start_lat is None  # '' -> NULL, 'abc' -> NULL
    # 01:30 in the autumn fold -> the later instant (06:30 UTC)
    assert r2.started_at.isoformat().startswith("2025-11-02 06:30") or str(r2.started_at).startswith("2025-11-02 06:30")
    legacy = sorted((k, v) for k, v in rows.items() if k.startswith("201901-legacy_"))
    assert [k for k, _ in legacy] == [f"201901-legacy_{i:012d}" for i in (1, 2, 3)]
    assert [v.member_casual for _, v in legacy] == ["member", "casual", "dependent"]
    # duration text wins when present; unparseable text gives NULL (no fallback)
    assert [v.trip_duration_seconds for _, v in legacy] == [600, 2, None]
    assert legacy[2][1].end_station_id is None and legacy[0][1].rideable_type is None


def test_empty_listing_is_an_error(spark, tmp_dir):
    _write(tmp_dir, "readme.txt", "x")
    try:
        csv_ingest.ingest_csv(spark, tmp_dir)
    except FileNotFoundError:
        return
    raise AssertionError("expected FileNotFoundError")


def test_surrogate_ids_follow_file_order_across_splits(spark, tmp_dir):
    header = LEGACY.splitlines()[0]
    body = "\n".join(
        f'"{60 + i}","1/2/2025 3:04:05","1/2/2025 3:14:05","{i}","S","40.7","-74.0","2","T","40.7","-74.0","1","Subscriber","",""'
        for i in range(1, 5001)
    )
    _write(tmp_dir, "big-a.csv", header + "\n" + body + "\n")
    _write(tmp_dir, "big-b.csv", header + "\n" + body + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")  # several splits per file
    try:
        trips = csv_ingest.ingest_csv(spark, tmp_dir)
        rows = trips.select("ride_id", "start_station_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 10000
    for stem in ("big-a", "big-b"):
        mine = {r.ride_id: r.start_station_id for r in rows if r.ride_id.startswith(stem + "_")}
        assert mine == {f"{stem}_{i:012d}": str(i) for i in range(1, 5001)}


def test_silver_reuse_skips_recompute(spark, tmp_dir):
    raw = b.raw_rides(spark, SF_SMALL)
    trips, stations = tables.build_silver(spark, raw, f"{tmp_dir}/silver")
    again, _ = tables.build_silver(spark, None, f"{tmp_dir}/silver", reuse=True)
    assert again.count() == raw.count() and stations.count() > 0
    files = [f for d, _, fs in os.walk(f"{tmp_dir}/silver") if "/trips" in d for f in fs if f.endswith(".parquet")]
    assert files and all(".zstd." in f for f in files)


def test_curated_write_counts_and_partitions(spark, tmp_dir):
    raw = b.raw_rides(spark, SF_SMALL)
    n = tables.write_curated_trips(raw, f"{tmp_dir}/trips")
    back = spark.read.parquet(f"{tmp_dir}/trips")
    assert n == back.count() and "start_month" in back.columns
    assert back.groupBy("ride_id").count().where(F.col("count") > 1).count() == 0


def test_surrogate_stem_is_the_decoded_file_name(spark, tmp_dir):
    _write(tmp_dir, "2019 01+legacy.v2.csv", "tripduration,starttime,stoptime,usertype\n60,1/2/2025 3:04:05,1/2/2025 3:05:05,Subscriber\n")
    row = csv_ingest.ingest_csv(spark, tmp_dir).first()
    assert row.ride_id == "2019 01+legacy.v2_000000000001"


def test_rfc4180_quotes_and_compressed_files(spark, tmp_dir):
    import gzip

    text = (
        "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,member_casual\n"
        'Q1,classic_bike,2025-01-02 03:04:05,2025-01-02 03:14:05,"Bway ""Uptown"", 5th",72,member\n'
    )
    _write(f"{tmp_dir}/plain", "a.csv", text)
    row = csv_ingest.ingest_csv(spark, f"{tmp_dir}/plain").first()
    assert row.start_station_name == 'Bway "Uptown", 5th' and row.start_station_id == "72"
    with gzip.open(f"{tmp_dir}/plain/b.csv.gz", "wt") as f:
        f.write(text.replace("Q1", "Q2"))
    ids = sorted(r.ride_id for r in csv_ingest.ingest_csv(spark, f"{tmp_dir}/plain", glob="*.csv*").collect())
    assert ids == ["Q1", "Q2"]


def test_surrogate_ids_when_the_split_layout_changes(spark, tmp_dir):
    """Ids are the same whatever the split size when the plan is built and when it runs."""
    header = LEGACY.splitlines()[0]
    body = "\n".join(
        f'"{60 + i}","1/2/2025 3:04:05","1/2/2025 3:14:05","{i}","S","40.7","-74.0","2","T","40.7","-74.0","1","Subscriber","",""'
        for i in range(1, 5001)
    )
    _write(tmp_dir, "c.csv", header + "\n" + body + "\n")
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    want = {f"c_{i:012d}": str(i) for i in range(1, 5001)}
    try:
        for built, run, threshold in (("65536", "32768", "-1"), ("32768", "10485760", "10485760")):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            spark.conf.set(key, built)
            trips = csv_ingest.ingest_csv(spark, tmp_dir).select("ride_id", "start_station_id")
            spark.conf.set(key, run)
            assert {r.ride_id: r.start_station_id for r in trips.collect()} == want
    finally:
        spark.conf.set(key, old)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_colliding_headers_keep_the_last(spark, tmp_dir):
    text = "ride_id,Start Station Name,start_station_name,started_at,ended_at,ended_at\nA,x,y,2025-01-02 03:04:05,,2025-01-02 03:14:05\n"
    _write(tmp_dir, "a.csv", text)
    row = csv_ingest.ingest_csv(spark, tmp_dir).first()
    assert row.start_station_name == "y" and row.ended_at is not None


def test_quoted_newlines(spark, tmp_dir):
    text = 'ride_id,start_station_name,started_at\nA,"Main\nStreet ""1""",2025-01-02 03:04:05\nB,S,2025-01-02 03:04:05\n'
    _write(tmp_dir, "a.csv", text)
    rows = {r.ride_id: r.start_station_name for r in csv_ingest.ingest_csv(spark, tmp_dir).collect()}
    assert rows == {"A": 'Main\nStreet "1"', "B": "S"}


def test_many_headers_in_about_one_job(spark, tmp_dir):
    import time

    for i in range(2_000):
        _write(f"{tmp_dir}/d{i % 7}", f"f {i}+.csv", f"ride_id,started_at{',x' * (i % 3)}\nR{i},2025-01-02 03:04:05\n")
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    start = time.perf_counter()
    groups = csv_ingest.group_by_header(spark, csv_ingest.csv_files(spark, tmp_dir))
    spark.sparkContext.setJobGroup("other", "other")
    assert len(groups) == 3 and sum(map(len, groups.values())) == 2_000
    assert len(jobs.getJobIdsForGroup("headers")) <= 3 and time.perf_counter() - start < 60


def test_headers_of_files_that_tasks_cannot_open(spark, tmp_dir, monkeypatch):
    _write(tmp_dir, "a.csv", "\ufeffride_id,started_at\r\nR1,2025-01-02 03:04:05\r\n")
    _write(tmp_dir, "b.csv", "\nR1\n")
    files = csv_ingest.list_csv_files(spark, tmp_dir)
    want = {("ride_id", "started_at"): files[:1], (): files[1:]}
    assert csv_ingest.group_by_header(spark, files) == want

    def unknown(path):
        raise OSError(path)

    monkeypatch.setattr(csv_ingest, "first_line", unknown)
    assert csv_ingest.group_by_header(spark, files) == want


def test_ride_numbers_of_many_digits_stay_apart(spark):
    from velostat.plans import text_queries

    ids = spark.createDataFrame([(10**9 + k,) for k in range(5)], "event_id bigint")
    assert ids.select(F.concat(F.lit("R"), b._number_text(F.col("event_id")))).distinct().count() == 5
    assert "incremental_ingest" not in text_queries.TEXT_QUERIES
