"""Literal cases for the Column functions (expected values are fixed)."""

import datetime as dt

from pyspark.sql import functions as F

from velostat.functions import columns as C


def _one(spark, values, expr, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr(F.col(df.columns[0]))).collect()]


def test_normalize_station_id_default(spark):
    ids = ["5980.10", "5980.1", "100", "0", "1.0", "JC009", "5.", "10.00", "SYS-0"]
    assert _one(spark, ids, C.normalize_station_id) == ["5980.1", "5980.1", "1", "", "1", "JC009", "5.", "10", "SYS-0"]


def test_normalize_station_id_strict(spark):
    ids = ["5980.10", "100", "0", "1.0", "10.00", "JC009"]
    got = _one(spark, ids, lambda c: C.normalize_station_id(c, strict=True))
    assert got == ["5980.1", "100", "0", "1", "10", "JC009"]


def test_local_to_utc_dst(spark):
    texts = [
        "2025-11-02 00:30:00", "2025-11-02 01:00:00", "2025-11-02 01:30:00", "2025-11-02 02:00:00",
        "2025-03-09 02:30:00", "2025-03-09 03:00:00", "2025-07-01 12:00:00",
    ]
    got = _one(spark, texts, lambda c: F.unix_seconds(C.local_to_utc(c.cast("timestamp_ntz"))))
    assert got == [1762057800, 1762063200, 1762065000, 1762066800, 1741505400, 1741503600, 1751385600]


def test_utc_to_local_roundtrip_outside_fold(spark):
    texts = ["2025-01-15 08:00:00", "2025-07-01 16:00:00"]
    got = _one(spark, texts, lambda c: C.utc_to_local(c.cast("timestamp_ntz")))
    assert got == [dt.datetime(2025, 1, 15, 3, 0), dt.datetime(2025, 7, 1, 12, 0)]


def test_safe_bigint(spark):
    texts = ["1.5", "2.5", "-2.5", "12", "1e3", "abc", "", "9223372036854775808"]
    assert _one(spark, texts, C.safe_bigint) == [2, 3, -3, 12, 1000, None, None, None]


def test_seconds_between_counts_boundaries(spark):
    df = spark.createDataFrame(
        [("2025-01-01 00:00:00.9", "2025-01-01 00:00:01.1")], "s string, e string"
    ).select(F.col("s").cast("timestamp").alias("s"), F.col("e").cast("timestamp").alias("e"))
    assert df.select(C.seconds_between("s", "e")).first()[0] == 1


def test_clean_text(spark):
    got = _one(spark, ["", " ", "  a ", "\tb", "c\n"], C.clean_text)
    assert got == [None, None, "a", "\tb", "c\n"]


def test_parse_local_timestamp(spark):
    ok = {
        "2025-01-02 03:04:05": dt.datetime(2025, 1, 2, 3, 4, 5),
        "2025-01-02 03:04:05.678": dt.datetime(2025, 1, 2, 3, 4, 5, 678000),
        "1/2/2025 3:04:05": dt.datetime(2025, 1, 2, 3, 4, 5),
        "1/2/2025 3:04": dt.datetime(2025, 1, 2, 3, 4),
        "2025-01-02T03:04:05": dt.datetime(2025, 1, 2, 3, 4, 5),
        "2025-01-02": dt.datetime(2025, 1, 2),
        "2025-01-02 03:04:05.5": dt.datetime(2025, 1, 2, 3, 4, 5, 500000),
        "2025-1-2 3:4:5": dt.datetime(2025, 1, 2, 3, 4, 5),
    }
    bad = ["garbage", "2025-02-30 00:00:00", "13/02/2025 03:04", "01/02/2025 24:00:00", "2025-01-02 24:00:01"]
    got = _one(spark, list(ok) + bad, C.parse_local_timestamp)
    assert got == list(ok.values()) + [None] * len(bad)


def test_member_from_usertype(spark):
    got = _one(spark, ["Subscriber", "Customer", "Dependent", None], C.member_from_usertype)
    assert got == ["member", "casual", "dependent", None]


def test_derive_duration_no_fallback(spark):
    df = spark.createDataFrame(
        [("60", "2025-01-01 00:00:00", "2025-01-01 00:10:00"),
         ("abc", "2025-01-01 00:00:00", "2025-01-01 00:10:00"),
         (None, "2025-01-01 00:00:00", "2025-01-01 00:10:00"),
         (None, None, "2025-01-01 00:10:00")],
        "d string, s string, e string",
    ).select("d", F.col("s").cast("timestamp").alias("s"), F.col("e").cast("timestamp").alias("e"))
    got = [r[0] for r in df.select(C.derive_duration("d", "s", "e")).collect()]
    assert got == [60, None, 600, None]


def test_rider_proxy_id_matches_md5_of_key(spark):
    df = spark.createDataFrame([("member", None, "1", "2")], "a string, b string, c string, d string")
    row = df.select(C.rider_proxy_key("a", "b", "c", "d"), C.rider_proxy_id("a", "b", "c", "d")).first()
    import hashlib

    assert row[0] == "member|unknown|1|2"
    assert row[1] == hashlib.md5(row[0].encode()).hexdigest()


def test_rounded_ratio_is_half_up_exact(spark):
    df = spark.createDataFrame([(1, 8), (3, 8), (1, 3), (2, 3), (0, 5)], "n long, d long")
    got = [r[0] for r in df.select(C.rounded_ratio("n", "d", 2)).collect()]
    assert got == [0.13, 0.38, 0.33, 0.67, 0.0]


def test_end_of_day_and_short_years(spark):
    """As the original engine reads them: next midnight, and the year as written."""
    texts = ["2025-01-02 24:00:00", "2025-12-31 24:00", "2025-01-02T24:00:00.000", "1/2/25 3:04"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [str(r.p) for r in df.select(C.parse_local_timestamp("t").cast("string").alias("p")).collect()]
    assert got == ["2025-01-03 00:00:00", "2026-01-01 00:00:00", "2025-01-03 00:00:00", "0025-01-02 03:04:00"]
