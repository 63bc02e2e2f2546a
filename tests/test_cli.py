"""The command-line pipeline end to end on CSV files rendered from a fixture."""

from velostat import cli
from velostat.plans import text_fixtures as tf

from .conftest import SF_SMALL


def test_ingest_analytics_report(spark, tmp_dir):
    raw = tf.write_trip_csvs(spark, SF_SMALL)
    wh = f"{tmp_dir}/warehouse"
    counts = cli.run_ingest(spark, raw, wh)
    assert counts["trips"] > 0 and counts["stations"] > 0
    again = cli.run_ingest(spark, raw, wh, reuse_silver=True)
    assert again == counts
    assert cli.run_ingest(spark, raw, wh, reuse_silver=True, run_id="r") == cli.run_ingest(spark, raw, wh, reuse_silver=True, run_id="r")
    log = spark.read.parquet(f"{wh}/data_quality_log").where("run_id <> 'r'")
    assert spark.read.parquet(f"{wh}/data_quality_log").count() == 27
    assert log.count() == 18  # two runs x nine checks
    sections = cli.analytics_sections(spark, wh, "2024-01-01", "2025-01-01")
    assert len(sections) == 11
    hours = sections["Peak hours"].collect()
    assert 0 < len(hours) <= 24
    assert sum(r.trip_count for r in hours) <= counts["trips"]


def test_command_line_entry_points(spark, tmp_dir, capsys):
    raw = tf.write_trip_csvs(spark, SF_SMALL)
    wh = f"{tmp_dir}/wh"
    assert cli.main(["ingest", "--raw", raw, "--warehouse", wh]) == 0
    assert cli.main(["report", "--warehouse", wh, "--start", "2024-01-01", "--end", "2025-01-01", "--rows", "2"]) == 0
    assert cli.main(["analytics", "--warehouse", wh, "--start", "2024-01-01", "--end", "2025-01-01",
                     "--rows", "2", "--tz", "Europe/Berlin"]) == 0
    out = capsys.readouterr().out
    assert "Loaded" in out and "=== Top Start Stations ===" in out and "=== Churn and reactivation (30-day gap) ===" in out
