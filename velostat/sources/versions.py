"""Tables that are replaced together: one folder per version, one small file that names it.

A writer fills a new folder, then renames a file with that folder's name over ``CURRENT``; the rename
is atomic, so readers see all tables of the old version or all of the new one.  A writer that
fails leaves the old version in place; its folder goes with the next successful write.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

CURRENT = "CURRENT"
KEPT = 2  # the version in use and the one before, which a reader may still hold


def _hadoop(spark: SparkSession):
    return spark._jvm.org.apache.hadoop


def _file_system(spark: SparkSession, path: str):
    found = _hadoop(spark).fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def current_version(spark: SparkSession, root: str) -> str | None:
    """Folder of the version in use, None if nothing was ever written completely."""
    system, path = _file_system(spark, f"{root}/{CURRENT}")
    if not system.exists(path):
        return None
    stream = system.open(path)
    try:
        name = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return f"{root}/{name.strip()}"


def _publish(spark: SparkSession, root: str, name: str) -> None:
    system, target = _file_system(spark, f"{root}/{CURRENT}")
    _, part = _file_system(spark, f"{root}/.{CURRENT}-{name}")
    stream = system.create(part, True)
    try:
        stream.write(bytearray(name.encode()))
    finally:
        stream.close()
    fs = _hadoop(spark).fs
    rename = getattr(fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(system.makeQualified(part), system.makeQualified(target), options)


def replace(spark: SparkSession, root: str, write: Callable[[str], None]) -> str:
    """Run ``write(folder)`` for a new version's folder and make it the version in use."""
    before = current_version(spark, root)
    name = f"v-{uuid.uuid4().hex[:12]}"
    write(f"{root}/{name}")
    _publish(spark, root, name)
    system, path = _file_system(spark, root)
    keep = [name] + ([before.rpartition("/")[2]] if before else [])
    for status in system.listStatus(path):
        old = status.getPath()
        if old.getName().startswith("v-") and old.getName() not in keep[:KEPT]:
            system.delete(old, True)
    return f"{root}/{name}"
