"""CSV records over several lines, in files of many splits."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from velostat.operators.curate import curation_filter
from velostat.sources import csv_ingest, records

from .test_ingest import LEGACY, MODERN, _write

TRICKY = ['plain', 'a "b"', 'x\ny', '"', '\n', 'a,b\n,c', '""\n""', ' "q" ', 'é\r\nz', 'end"', "'", "5'10 tall", 'l1\nl2\nl3 "x"\n', "w" * 300]


def table_of(n: int, seed: int = 1):
    rng = random.Random(seed)
    return [(f"R{k}", rng.choice(TRICKY), rng.choice(TRICKY)) for k in range(n)]


def text_of(rows, newline="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=newline)
    writer.writerow(["ride_id", "start_station_name", "end_station_name"])
    writer.writerows(rows)
    return out.getvalue()


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", newline="") as f:
        f.write(text)


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k, v in zip(old, ("300", "1")):
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def cleaned(text):
    return text.strip(" ") or None


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("most", [100_000, 0])
def test_many_splits_equal_a_reader_of_whole_files(spark, tmp_dir, small_splits, monkeypatch, newline, most):
    monkeypatch.setattr(records, "MAX_BROADCAST_SPLITS", most)
    want = set()
    for name in ("a b.csv", "c+d.csv"):
        rows = table_of(250, seed=len(want))
        rows = [(f"{name}{i}", a, b) for i, a, b in rows]
        write(f"{tmp_dir}/in", name, text_of(rows, newline))
        want |= {(i, cleaned(a), cleaned(b)) for i, a, b in rows}
    got = csv_ingest.ingest_csv(spark, f"{tmp_dir}/in").select("ride_id", "start_station_name", "end_station_name").collect()
    assert len(got) == 500 and {tuple(r) for r in got} == want


def test_row_numbers_follow_the_file(spark, tmp_dir, small_splits):
    rows = table_of(200, seed=9)
    body = text_of([(k, a, i) for k, (i, a, _) in enumerate(rows, 1)]).split("\n", 1)[1]
    write(tmp_dir, "old.csv", "start station id,start station name,end station name\n\n" + body.replace("R7\n", "R7\n\n \n"))
    got = csv_ingest.ingest_csv(spark, tmp_dir).select("ride_id", "start_station_id", "end_station_name").collect()
    assert len(got) == 200
    assert {r.ride_id: (r.start_station_id, r.end_station_name) for r in got} == {
        f"old_{k:012d}": (str(k), i) for k, (i, _, _) in enumerate(rows, 1)
    }


def test_a_record_longer_than_several_splits(spark, tmp_dir, small_splits):
    long = "\n".join(f"line {k} ""quoted""" for k in range(300))
    write(tmp_dir, "a.csv", text_of([("R1", "x", "y"), ("R2", long, 'z"\n'), ("R3", "p", "q")]))
    got = {r.ride_id: r.start_station_name for r in csv_ingest.ingest_csv(spark, tmp_dir).collect()}
    assert got == {"R1": "x", "R2": long, "R3": "p"}


def test_plain_files_stay_plain(spark, tmp_dir, small_splits):
    """A quote inside an unquoted field opens nothing; such a file is read as lines."""
    write(tmp_dir, "a.csv", 'ride_id,start_station_name\nR1,5" pipe\nR2,"a ""b"" c"\n"R3",""\n')
    write(tmp_dir, "b.csv", 'ride_id,start_station_name\nR4,"x\ny"\n')
    files = csv_ingest.list_csv_files(spark, tmp_dir)
    assert [f[-5:] for f in records.files_with_long_records(spark, files)] == ["b.csv"]
    got = {r.ride_id: r.start_station_name for r in csv_ingest.ingest_csv(spark, tmp_dir).collect()}
    assert got == {"R1": '5" pipe', "R2": 'a "b" c', "R3": None, "R4": "x\ny"}


def test_an_open_quote_is_an_error_that_names_the_file(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(records, "MAX_RECORD", 1000)
    write(tmp_dir, "open.csv", 'ride_id,start_station_name\nR1,"x\n' + "R2,y\n" * 500)
    with pytest.raises(Exception, match="open.csv"):
        csv_ingest.ingest_csv(spark, tmp_dir).count()


def test_states_of_lines():
    for line, outside, inside in (
        ("a,b", False, True),
        ('"a,b', True, False),
        ('a","b', True, True),
        ('a",b', False, False),
        ('""', False, True),
        ('"""', True, False),
        ('x"y"z', False, False),
        ('"a"b,"c', True, True),
        ("", False, True),
    ):
        assert (records.ends_inside(line, False), records.ends_inside(line, True)) == (outside, inside), line


def test_times_are_parsed_once(spark, tmp_dir):
    _write(f"{tmp_dir}/a", "m.csv", MODERN)
    _write(f"{tmp_dir}/a", "l.csv", LEGACY)
    frame = curation_filter(csv_ingest.ingest_csv(spark, f"{tmp_dir}/a"))
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    parses = plan.count("gettimestamp(") + plan.count("try_to_timestamp(") + plan.count("to_timestamp(")
    assert 0 < parses <= 20 and len(plan) < 60_000
    assert frame.where(F.col("started_at").isNull()).count() == 0
