"""Helpers the operators share: staged tables, text keys, word patterns, text blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velostat.session import scratch_dir

# ASCII white space (space, tab, newline, vertical tab, form feed, carriage return)
# separates words; Java's pattern syntax reads this class the same way.
SPACE_CLASS = r"\x20\x09-\x0D"
WORD = f"[^{SPACE_CLASS}]+"
SPACES = f"[{SPACE_CLASS}]+"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    This cuts the lineage with files every executor can read.  Spark drops the
    shuffle files of the writing job when it ends, so the disk in use is that
    of the largest job plus the staged tables."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_path = path
    return staged


def unstage(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more (a later stage has what they gave)."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.staged_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(col: str | Column = "text") -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col.cast("string"), F.lit(""))


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))


def words(text: Column) -> Column:
    """The words of a text, in order (none for an empty or NULL text)."""
    text = trimmed(F.coalesce(text, F.lit("")))
    return F.when(text != "", F.split(text, SPACES)).otherwise(F.array().cast("array<string>"))


def documents_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id BIGINT, text STRING, '' for NULL) and nothing else: no column of
    the input can clash with an operator's own."""
    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))


def text_key(doc_id: Column, text: Column) -> Column:
    """64-bit key that tells apart rows that share a doc_id; equal rows share it."""
    return F.xxhash64(doc_id, text)


# ---------------------------------------------------------------------------
# bytes of many texts at once (numpy kernels inside Arrow tasks)

BLOCK_BYTES = 1 << 21  # texts are joined up to this size, so task memory stays bounded


class TextBlock:
    """Some consecutive rows' texts as one byte array, a newline after each."""

    __slots__ = ("first", "last", "data", "starts", "ends")

    def __init__(self, first, last, data, starts, ends):
        self.first, self.last, self.data, self.starts, self.ends = first, last, data, starts, ends

    @property
    def rows(self) -> range:
        return range(self.first, self.last)


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[TextBlock]:
    """Blocks of whole texts of at most ``limit`` bytes (a longer text is a
    block of its own).  NULL counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = memoryview(data) if data is not None else memoryview(b"")
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        lengths = offsets[first + 1 : last + 1] - offsets[first:last]
        joined = b"\n".join([raw[offsets[i] : offsets[i + 1]] for i in range(first, last)]) + b"\n"
        starts = np.zeros(last - first, dtype=np.int64)
        np.cumsum(lengths[:-1] + 1, out=starts[1:])
        yield TextBlock(first, last, np.frombuffer(joined, dtype=np.uint8), starts, starts + lengths)
        first = last


def byte_class(separators: bytes) -> np.ndarray:
    """256 flags: True for bytes that belong to words."""
    table = np.ones(256, dtype=bool)
    table[np.frombuffer(separators, dtype=np.uint8)] = False
    return table


SPACE_SEPARATED = byte_class(b" \t\n\x0b\x0c\r")
# words of lower-case letters, digits and everything beyond ASCII (after A-Z became a-z)
LETTER_DIGIT = byte_class(bytes(range(0x00, 0x30)) + bytes(range(0x3A, 0x61)) + bytes(range(0x7B, 0x80)))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def find_words(data: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) byte positions of all words.  The block ends
    with a separator, so every word is closed."""
    flags = in_word[data]
    change = np.flatnonzero(flags[1:] != flags[:-1]) + 1
    if len(flags) and flags[0]:
        change = np.concatenate([[0], change])
    return change[0::2], change[1::2]


def word_parts(block: TextBlock, in_word: np.ndarray, overlap: int) -> Iterator[tuple[TextBlock, int]]:
    """(block, bytes of its own): a block as it is, or one very long text in parts that end where a word
    does, each with the ``overlap`` words that follow, so that the memory of word kernels is bounded.

    A word belongs to the part in whose own bytes it starts; runs of up to ``overlap`` + 1
    words lie within the part of their first word."""
    size = len(block.data) - 1
    if len(block.starts) > 1 or size <= 2 * BLOCK_BYTES:
        yield block, size
        return
    begin = 0
    while begin < size:
        end = min(size, _end_of_word(block.data, in_word, begin + BLOCK_BYTES, size))
        reach = end
        for _ in range(overlap if end < size else 0):
            reach = _end_of_word(block.data, in_word, _start_of_word(block.data, in_word, reach, size), size)
        part = np.append(block.data[begin:reach], np.uint8(10))
        yield TextBlock(block.first, block.last, part, np.zeros(1, np.int64), np.array([reach - begin])), end - begin
        begin = end


def _first_where(data: np.ndarray, table: np.ndarray, want: bool, at: int, size: int) -> int:
    """First place from ``at`` on whose byte is in a word (``want``) or is not."""
    while at < size:
        found = np.flatnonzero(table[data[at : min(size, at + 4096)]] == want)
        if len(found):
            return at + int(found[0])
        at += 4096
    return size


def _end_of_word(data: np.ndarray, table: np.ndarray, at: int, size: int) -> int:
    return _first_where(data, table, False, at, size)


def _start_of_word(data: np.ndarray, table: np.ndarray, at: int, size: int) -> int:
    return _first_where(data, table, True, at, size)


def encode_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(code of each word, the distinct words), exactly."""
    offsets = np.zeros(len(starts) + 1, dtype=np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[starts] = 1
    inside[ends] -= 1
    letters = data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters.tobytes()))
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary


def distinct_hashes(words: pa.Array, seed: int = 0) -> np.ndarray:
    """XXH3 of each of some distinct words."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter([digest(w, seed) for w in words.cast(pa.binary()).to_pylist()], dtype=np.uint64, count=len(words))


_M64 = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    step, filled = base, 1
    while filled < n:  # doubling: out[f:2f] = out[:f] * base**f
        take = min(filled, n - filled)
        out[filled : filled + take] = out[:take] * np.uint64(step)
        step = step * step & _M64
        filled += take
    return out


class RollingHash:
    """Rabin-Karp hashes modulo 2**64 of any spans of a sequence, by prefix sums.

    h(s, e) = sum(value[i] * base**(i - s)); the offset is taken out with the
    inverse power, so equal sequences hash alike wherever they stand."""

    def __init__(self, base: int):
        self.base, self.inverse = base | 1, pow(base | 1, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            self.up, self.down = _powers(self.base, n), _powers(self.inverse, n)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        self._grow(len(values) + 1)
        out = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self.up[: len(values)], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (prefix[end] - prefix[start]) * self.down[start]


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads all bits (the low bits of a sum modulo 2**64 are weak)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_values(seed: int, lower: bool = False) -> np.ndarray:
    """A random 64-bit value for each byte; with ``lower``, A-Z share those of a-z."""
    table = np.random.default_rng(seed).integers(1, 1 << 64, 256, dtype=np.uint64)
    return table[LOWER] if lower else table


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` consecutive keys (by doubling)."""
    if len(keys) < width:
        return keys[:0]
    reach = 1
    out = keys
    while reach * 2 <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    if reach < width:
        rest = width - reach
        out = np.minimum(out[:-rest], out[rest:])
    return out


# Positions inside a block take the low bits of a selection key.
_POS_BITS = 32
_POS_MASK = np.uint64((1 << _POS_BITS) - 1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray, rolling: RollingHash) -> np.ndarray:
    """A 64-bit hash of each word, worked out over stretches of ``BLOCK_BYTES``."""
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        origin = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, origin + BLOCK_BYTES, side="right")))
        a, b = starts[first:last] - origin, ends[first:last] - origin
        prefix = rolling.prefix(values[data[origin : origin + b[-1]]])
        out[first:last] = rolling.spans(prefix, a, b) + (b - a).astype(np.uint64)
        first = last
    return mix64(out)


def select_minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` consecutive hashes, the position of its
    smallest one (the last of equal ones).  The choice depends on the hashes in
    the window alone, so equal windows choose alike wherever they stand."""
    n = len(hashes)
    keys = (hashes & ~_POS_MASK) | (_POS_MASK - np.arange(n, dtype=np.uint64))
    return (_POS_MASK - (sliding_min(keys, width) & _POS_MASK)).astype(np.int64)


def runs(*columns: np.ndarray) -> np.ndarray:
    """First index of each run of rows in which every column stays the same."""
    n = len(columns[0])
    if not n:
        return np.zeros(0, dtype=np.int64)
    change = np.zeros(n, dtype=bool)
    change[0] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def signed(h: np.ndarray) -> np.ndarray:
    return h.astype(np.uint64, copy=False).view(np.int64)


def arrow_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def spark_schema(schema: pa.Schema) -> T.StructType:
    from pyspark.sql.pandas.types import from_arrow_schema

    return from_arrow_schema(schema)
