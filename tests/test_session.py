"""Session rules: UTC zone and AQE are pinned; scratch data needs a shared folder."""

import pytest

from velostat import session


def test_configure_pins_zone_and_aqe(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    session.configure_session(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_scratch_dir_is_fresh_and_under_the_checkpoint_folder(spark):
    a, b = session.scratch_dir(spark, "x"), session.scratch_dir(spark, "x")
    base = session._checkpoint_dir(spark).rstrip("/").removeprefix("file:").replace("///", "/")
    # with the file system's name, so that code that opens files itself finds the same folder
    assert a != b and a.startswith(f"file:{base}/x-") and b.startswith(f"file:{base}/x-")


def test_scratch_dir_refuses_without_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(session, "_checkpoint_dir", lambda s: None)
    monkeypatch.setattr(session, "configure_session", lambda s: s)
    with pytest.raises(ValueError):
        session.scratch_dir(spark, "x")
