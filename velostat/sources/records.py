"""CSV records with newlines inside quoted fields, read from files that stay splittable.

A split of a file does not know whether it starts inside a quoted field.  So each split is read
as lines, and the lines of a split act on a state of two values (outside, inside a quoted field): one scan
works out where each split ends from either start, and a running composition over the
splits of a file gives every split its true start.  Lines without a quote keep the state, so they
are dropped before any Python code runs; a file in which no line ends inside a field has no
such record and is read as plain CSV.

The other files are read once more: each split joins its lines into records, and
the pieces of a record that crosses a border of splits (one or two a split) are put together
afterwards.  No file is ever read by one task.

A field is quoted if the quote is its first character; a doubled quote inside it stands for a quote;
quotes elsewhere are text.  A record of more than ``MAX_RECORD`` characters within one split is an error
that names the file: a quote was left open.  Lines end with a newline or a carriage return and a newline.
"""

from __future__ import annotations

import sys
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# the functions below travel with their code to workers that do not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PATH, SPLIT, ROW = "_source_path", "_source_split", "_source_row"
MAX_RECORD = 64 << 20
# split borders inside a field that are broadcast; with more of them the lines are shuffled by split
MAX_BROADCAST_SPLITS = 100_000

_STATES = pa.schema(
    [(PATH, pa.string()), (SPLIT, pa.int64()), ("from_outside", pa.bool_()), ("from_inside", pa.bool_()), ("opens", pa.bool_())]
)
_PIECES = pa.schema([(PATH, pa.string()), (SPLIT, pa.int64()), (ROW, pa.int64()), ("kind", pa.int32()), ("record", pa.string())])
_WHOLE, _CONTINUED, _OPENED = 0, 1, 2  # pieces of one split sort in this order


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open after this line, given whether one is before it."""
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('""', at):
                at += 2
                continue
            inside = False
        elif line.startswith('"', at):
            inside = True
            at += 1
            continue
        at = line.find(",", at) + 1  # the next field
        if not at:
            return False


def first_line(path: str) -> str:
    """The first line of a file that a task can open, '' if it has none."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme or scheme == "file":
        system, name = fs.LocalFileSystem(), "/" + (rest if colon and scheme == "file" else path).lstrip("/")
    else:
        system, name = fs.FileSystem.from_uri(f"{scheme}:{quote(rest)}")
    held = b""
    with system.open_input_stream(name, compression="detect") as stream:
        while b"\n" not in held and (more := stream.read(1 << 16)):
            held += more
    line = held.split(b"\n", 1)[0].split(b"\r", 1)[0]
    return line.decode("utf-8-sig")


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    raw = spark.read.option("lineSep", "\n").text(paths)
    return raw.select("value", F.col("_metadata.file_path").alias(PATH), F.col("_metadata.file_block_start").alias(SPLIT))


def split_states(lines: DataFrame) -> DataFrame:
    """A row per split that has quotes: its end state from either start, and whether, from
    outside, any of its lines ends inside a field."""

    def run(batches):
        states: dict[tuple[str, int], list[bool]] = {}
        for batch in batches:
            for value, *split in zip(*[batch.column(c).to_pylist() for c in ("value", PATH, SPLIT)]):
                state = states.setdefault(tuple(split), [False, True, False])
                state[0], state[1] = ends_inside(value, state[0]), ends_inside(value, state[1])
                state[2] |= state[0]
        columns = [[k[0] for k in states], [k[1] for k in states], *[[s[i] for s in states.values()] for i in range(3)]]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, _STATES)], schema=_STATES)

    schema = f"{PATH} string, {SPLIT} bigint, from_outside boolean, from_inside boolean, opens boolean"
    return lines.where(F.col("value").contains('"')).mapInArrow(run, schema)


def files_with_long_records(spark: SparkSession, paths: list[str]) -> list[str]:
    """The files, as given by ``paths``, in which a record takes more than one line.

    The first split in which a line ends inside a field starts outside of one, since
    those before it end outside; so its state from outside is the true one."""
    found = split_states(read_lines(spark, paths)).where("opens").select(PATH).distinct().collect()
    path = spark._jvm.org.apache.hadoop.fs.Path
    named = {path(spark._jvm.java.net.URI(r[0])).toUri().getPath() for r in found}
    return [p for p in paths if path(p).toUri().getPath() in named]


def splits_inside(lines: DataFrame) -> DataFrame:
    """(path, split) of the splits that start inside a quoted field.

    A split keeps the state, turns it or sets it; so the state is the one set last, turned as
    often as splits after it turn it.  One row per split goes through the window."""
    states = split_states(lines)
    turns = F.col("from_outside") & ~F.col("from_inside")
    sets = F.col("from_outside") == F.col("from_inside")
    in_order = Window.partitionBy(PATH).orderBy(SPLIT)
    states = states.withColumn("_turns", F.sum(turns.cast("int")).over(in_order))
    states = states.withColumn("_set", F.last(F.when(sets, F.struct("from_outside", "_turns")), ignorenulls=True).over(in_order))
    base = F.coalesce(F.col("_set.from_outside").cast("int"), F.lit(0)) + F.col("_turns") - F.coalesce("_set._turns", F.lit(0))
    states = states.select(PATH, SPLIT, (base % 2 == 1).alias("_after"))
    # splits without a quote keep the state of the split before them
    every = lines.select(PATH, SPLIT).distinct().join(states, [PATH, SPLIT], "left")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    return every.withColumn("_inside", F.last("_after", ignorenulls=True).over(before)).where("_inside").select(PATH, SPLIT)


def _join_lines(batches):
    """Lines of whole splits, in order, to records and pieces of records."""
    now, inside, held, size, started, row = None, False, [], 0, True, 0
    out: list[tuple] = []

    def rest():
        if held and now is not None:
            out.append((*now, row if started else -1, _OPENED if started else _CONTINUED, "\n".join(held)))

    def flush():
        columns = zip(*out) if out else [[]] * len(_PIECES)
        batch = pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, _PIECES)], schema=_PIECES)
        out.clear()
        return batch

    for batch in batches:
        for value, path, split, start in zip(*[batch.column(c).to_pylist() for c in ("value", PATH, SPLIT, "_inside")]):
            if (path, split) != now:
                rest()
                # the header of a file has the number -1
                now, inside, held, size, row = (path, split), bool(start), [], 0, -1 if split == 0 else 0
                started = not inside
            if '"' in value:
                inside = ends_inside(value, inside)
            if held or inside or not started:
                held.append(value)
                size += len(value) + 1
                if size > MAX_RECORD:
                    raise ValueError(f"{path}: a record of over {MAX_RECORD} characters; a quote may have been left open")
                if inside:
                    continue
                value = "\n".join(held)
                held, size = [], 0
            if not started:
                out.append((*now, -1, _CONTINUED, value))
                started = True
            elif row < 0 or value.strip():  # empty lines are no records
                out.append((*now, row, _WHOLE, value))
                row += 1
        yield flush()
    rest()
    yield flush()


def read_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, split, row, record): every record but the headers, with its number (0-based) among
    those that start in its split."""
    lines = read_lines(spark, paths)
    inside = splits_inside(lines).withColumn("_inside", F.lit(True))
    if inside.limit(MAX_BROADCAST_SPLITS + 1).count() <= MAX_BROADCAST_SPLITS:
        placed = lines.join(F.broadcast(inside), [PATH, SPLIT], "left")
    else:
        placed = lines.withColumn("_at", F.monotonically_increasing_id()).join(inside, [PATH, SPLIT], "left")
        placed = placed.repartition(PATH, SPLIT).sortWithinPartitions(PATH, SPLIT, "_at")
    schema = f"{PATH} string, {SPLIT} bigint, {ROW} bigint, kind int, record string"
    pieces = placed.select("value", PATH, SPLIT, "_inside").mapInArrow(_join_lines, schema)

    in_order = Window.partitionBy(PATH).orderBy(SPLIT, "kind")
    opened = F.when(F.col("kind") == _OPENED, F.struct(SPLIT, ROW))
    parts = pieces.where(F.col("kind") != _WHOLE).withColumn("_from", F.last(opened, ignorenulls=True).over(in_order))
    listed = F.sort_array(F.collect_list(F.struct(SPLIT, "kind", "record")))
    joined = parts.groupBy(PATH, "_from").agg(F.array_join(F.transform(listed, lambda x: x["record"]), "\n").alias("record"))
    joined = joined.select(PATH, f"_from.{SPLIT}", f"_from.{ROW}", "record")
    whole = pieces.where(F.col("kind") == _WHOLE).select(PATH, SPLIT, ROW, "record")
    records = whole.union(joined).where(F.col(ROW) >= 0)
    return records.withColumn("record", F.regexp_replace("record", "\r$", ""))
