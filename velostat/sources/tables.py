"""Parquet tables: silver (normalized trips and stations) and gold (curated trips, stations).

Every table has a contract (``contracts``) that holds at write and read.  The silver pair
is replaced as one (``versions``).  Silver trips carry the verdict of curation: ``reject_bits``
says which rules a trip breaks, and the table is partitioned by ``verdict``, so that one write makes both
the trips to load and the table of rejects, and the load reads the good ones alone.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velostat.functions.columns import utc_to_local
from velostat.operators.curate import curate_trips, curation_filter, reject_bits
from velostat.operators.stations import derive_stations
from velostat.schema import STATION_COLUMNS, TRIP_COLUMNS
from velostat.sources import versions
from velostat.sources.contracts import CURATED_TRIPS, SILVER_TRIPS, STATIONS

# Rows per output file, so no writer task holds an unbounded file.
MAX_RECORDS_PER_FILE = 5_000_000
# Rows meant for one task of the curated write, and the most days that are counted one by one.
ROWS_PER_TASK, MOST_DAYS = 2_000_000, 36_525
# Trips from which a load deduplicates narrowly.
NARROW_ROWS = 10_000_000

GOOD, REJECTED = "good", "rejected"
MONTH = "start_month"


def _writer(df: DataFrame):
    return df.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)


def with_verdict(trips: DataFrame) -> DataFrame:
    """``trips`` with ``reject_bits`` and ``verdict``."""
    verdict = F.when(F.col("reject_bits") == 0, F.lit(GOOD)).otherwise(F.lit(REJECTED))
    return trips.withColumn("reject_bits", reject_bits()).withColumn("verdict", verdict)


def _write_silver_trips(trips: DataFrame, version: str) -> None:
    _writer(with_verdict(SILVER_TRIPS.enforced(trips))).partitionBy("verdict").parquet(f"{version}/trips")


def _write_silver_stations(stations: DataFrame, version: str) -> None:
    _writer(STATIONS.enforced(stations)).parquet(f"{version}/stations")


def write_silver(trips: DataFrame, stations: DataFrame, root: str, num_files: int | None = None) -> None:
    """Replace both silver tables (zstd Parquet) as one.

    ``num_files`` spreads the trips evenly (round robin) over that many files,
    for inputs whose layout would otherwise leave later scans with too few
    splits (a single large row group, say)."""
    if num_files:
        trips = trips.repartition(num_files)

    def write(version: str) -> None:
        _write_silver_trips(trips.select(*TRIP_COLUMNS), version)
        _write_silver_stations(stations.select(*STATION_COLUMNS), version)

    versions.replace(trips.sparkSession, root, write)


_SILVER_FILE = T.StructType([*SILVER_TRIPS.schema, T.StructField("reject_bits", T.IntegerType()), T.StructField("verdict", T.StringType())])


def _silver_trips(spark: SparkSession, version: str) -> DataFrame:
    return spark.read.schema(_SILVER_FILE).parquet(f"{version}/trips")


def _in_use(spark: SparkSession, root: str) -> str:
    version = versions.current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no complete silver tables under {root}")
    return version


def read_silver(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """All normalized trips, rejected ones too, and the stations of the version in use."""
    version = _in_use(spark, root)
    trips = SILVER_TRIPS.checked(_silver_trips(spark, version).select(*TRIP_COLUMNS))
    return trips, STATIONS.checked(spark.read.parquet(f"{version}/stations"))


def read_good_trips(spark: SparkSession, root: str) -> DataFrame:
    """The normalized trips that curation keeps (before dedup): one partition of the table."""
    return _silver_trips(spark, _in_use(spark, root)).where(F.col("verdict") == GOOD).select(*TRIP_COLUMNS)


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """The normalized trips that curation turns down, with ``reject_bits``."""
    return _silver_trips(spark, _in_use(spark, root)).where(F.col("verdict") == REJECTED).select(*TRIP_COLUMNS, "reject_bits")


def silver_exists(spark: SparkSession, root: str) -> bool:
    return versions.current_version(spark, root) is not None


def build_silver(spark: SparkSession, normalized: DataFrame | None, root: str, reuse: bool = False):
    """Normalized trips + derived stations, written once.

    With ``reuse`` and both tables present the CSV work is skipped and the
    Parquet tables are read instead.  Returns the two DataFrames read back
    from Parquet, which also cuts the lineage."""
    if not (reuse and silver_exists(spark, root)):
        if normalized is None:
            raise ValueError("no silver tables to reuse and no normalized trips given")

        def write(version: str) -> None:
            _write_silver_trips(normalized.select(*TRIP_COLUMNS), version)
            # stations come from the written table: the text behind ``normalized`` is read once
            _write_silver_stations(derive_stations(_silver_trips(spark, version)).select(*STATION_COLUMNS), version)

        versions.replace(spark, root, write)
    return read_silver(spark, root)


def start_month(started_at: str = "started_at") -> Column:
    return F.date_format(utc_to_local(started_at), "yyyy-MM")


def time_tasks(trips: DataFrame) -> tuple[Column, int, int]:
    """The task of the curated write for each trip, the number of tasks, and of trips.

    A scan of the start times alone counts the trips of each local day.  Days in a row share a task
    up to a task's number of rows; a busier day gets several tasks, among which its trips go by their start and
    ride id, so that not even a single hot instant lands in one task.  Nothing is sampled from the
    deduplicated trips, so these are worked out once.  The driver sees one row per day; where
    the days span more than ``MOST_DAYS``, they are dealt by month."""
    spark = trips.sparkSession
    local = utc_to_local("started_at")
    day = F.unix_date(F.to_date(local))
    counts = sorted(trips.groupBy(day.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect())
    if not counts:
        return F.lit(0), 1, 0
    cell = day
    if counts[-1][0] - counts[0][0] > MOST_DAYS:
        cell = F.year(local) * 12 + F.month(local)
        months: dict[int, int] = {}
        for at, n in counts:  # months since year 0, as above
            month = int(np.datetime64(at, "D").astype("datetime64[M]").astype(int)) + 1970 * 12 + 1
            months[month] = months.get(month, 0) + n
        counts = sorted(months.items())
    most, total = int(spark.conf.get("spark.sql.shuffle.partitions")), sum(n for _, n in counts)
    # at most ``most`` tasks for small loads, more where the rows ask for it
    rows = max(1, min(ROWS_PER_TASK, -(-total // most)))
    origin = counts[0][0]
    first, width = [0] * (counts[-1][0] - origin + 1), [1] * (counts[-1][0] - origin + 1)
    task = filled = 0
    for at, n in counts:
        if filled and filled + n > rows:
            task, filled = task + 1, 0
        first[at - origin], width[at - origin] = task, max(1, -(-n // rows))
        filled += n
        if filled >= rows:
            task, filled = task + width[at - origin], 0
    tasks = spark.createDataFrame([(first, width)], "first array<int>, width array<int>")
    place = cell - F.lit(origin)
    wide = F.get(tasks.select("width").scalar(), place)
    spread = F.pmod(F.xxhash64("started_at", "ride_id"), wide.cast("bigint")).cast("int")
    return F.get(tasks.select("first").scalar(), place) + spread, max(f + w for f, w in zip(first, width)), total


def write_curated_trips(normalized: DataFrame, path: str, narrow: bool | None = None) -> int:
    """Curate and write trips partitioned by local start month; returns the
    row count, taken by ``observe`` during the same write (no second pass).

    Each task writes some days in a row (or a share of one busy day), sorted by time: a month folder
    receives a few files instead of one per shuffle partition, and file and row-group
    statistics on ``started_at`` serve time filters.  ``narrow``: see ``dedupe_rides``; by
    default from ``NARROW_ROWS`` trips on, where the shuffle it saves is worth another scan of the ids."""
    task, tasks, total = time_tasks(curation_filter(normalized.select(*TRIP_COLUMNS)))
    narrow = total >= NARROW_ROWS if narrow is None else narrow
    curated = CURATED_TRIPS.enforced(curate_trips(normalized, narrow)).withColumn(MONTH, start_month())
    dealt = curated.repartitionById(tasks, task).sortWithinPartitions(MONTH, "started_at")
    obs = Observation("curated_trips")
    observed = dealt.observe(obs, F.count(F.lit(1)).alias("rows"))
    _writer(observed).partitionBy(MONTH).parquet(path)
    return int(obs.get["rows"])


def write_stations(stations: DataFrame, path: str) -> int:
    obs = Observation("stations")
    observed = STATIONS.enforced(stations.select(*STATION_COLUMNS)).observe(obs, F.count(F.lit(1)).alias("rows"))
    _writer(observed.sortWithinPartitions("station_id")).parquet(path)
    return int(obs.get["rows"])


def read_curated_trips(spark: SparkSession, path: str) -> DataFrame:
    """Curated trips with their partition column ``start_month``."""
    schema = T.StructType([*CURATED_TRIPS.schema, T.StructField(MONTH, T.StringType())])
    return CURATED_TRIPS.checked(spark.read.schema(schema).parquet(path), partitions=(MONTH,))


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return STATIONS.checked(spark.read.parquet(path))
