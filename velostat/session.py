"""Session settings every entry point relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the engine needs regardless of cluster size.  The time zone is
# fixed because parsed wall-clock texts are cast to TIMESTAMP_NTZ and
# instants are derived from UTC wall clocks.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a table partitioned by a few values (the verdict of curation) is written without a sort
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}


def configure_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators assume.  In local mode with no
    checkpoint folder named, a temp folder is set (tests); on a cluster the
    folder must come from the configuration, never a machine-local path."""
    for key, value in _REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if not _checkpoint_dir(spark) and (spark.sparkContext.master or "").startswith("local"):
        # local mode only (tests, one machine): a temp folder is shared by all tasks
        local = os.path.join(tempfile.gettempdir(), f"velostat-ckpt-{uuid.uuid4().hex[:8]}")
        spark.sparkContext.setCheckpointDir(local)  # a core setting: not settable via spark.conf
    return spark


def _checkpoint_dir(spark: SparkSession) -> str | None:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    return spark.sparkContext.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder."""
    configure_session(spark)
    base = _checkpoint_dir(spark)
    if not base:
        raise ValueError(
            "spark.checkpoint.dir is not set: name a folder every executor shares "
            "(scratch tables and stream checkpoints go there)"
        )
    # with the file system's name: a path without one means the cluster's file system, also to
    # code that opens files itself
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    base = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def get_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Session for scripts and tests.  On a cluster pass nothing: the master and
    partition counts come from the submit configuration."""
    builder = SparkSession.builder.appName("velostat").config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure_session(spark)
