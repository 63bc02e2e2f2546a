"""Suffix-array dedup over UTF-8 bytes.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier (in a
document with a smaller id, or earlier in the same one) is removed.  ``repeats``
groups the windows by anchors, settles those that repeat as part of a longer equal
stretch, and leaves the edges of repeats.  Their suffixes are sorted here:

- Spark samples splitters and range-partitions the suffixes at the anchors by their
  leading bytes, so that a bucket holds a stretch of the sorted order;
- a bucket expands each into the suffixes of its windows and sorts them by multikey
  quicksort, eight bytes as one digit, only ties going on to the next digit;
  equal neighbours are compared byte for byte, and all but the earliest repeat;
- buckets are sorted in slices of bounded size; the anchors at the ends of a slice may
  go on in the next one, so their earliest suffixes are compared across boundaries in Spark.

Defined results: NULL or empty text has no bytes; texts shorter than ``LENGTH`` lose
nothing; rows with the same doc_id are ordered by a hash of their text, and equal rows are one
document with one result; NULL doc_id comes last; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velostat.llm.common import byte_values, mix64, runs, signed, spark_schema, stage, unstage
from velostat.llm.repeats import Tokens, keyed, pieces, repeated_spans, texts_with_regions, with_removals

LENGTH = 100
GRAM = 48
# contexts sorted at a time: about 27 suffixes of 100 bytes each
SLICE = 8_000

_SEED, _BASE = 13, 0x9E3779B97F4A7C15
_REGIONS = pa.schema(
    [
        ("a", pa.int64()),
        ("c", pa.int64()),
        ("d", pa.int64()),
        ("key", pa.int64()),
        ("lo", pa.int64()),
        ("n", pa.int32()),
        ("off", pa.int32()),
        ("context", pa.binary()),
    ]
)
# a window that repeats (s1, s2 NULL), or the earliest of its slice at an open end
_RESULT = pa.schema(
    [
        ("a", pa.int64()),
        ("c", pa.int64()),
        ("j", pa.int32()),
        ("s1", pa.int64()),
        ("s2", pa.int64()),
        ("d", pa.int64()),
        ("key", pa.int64()),
        ("at", pa.int64()),
    ]
)


def byte_tokens(block) -> Tokens:
    values = byte_values(_SEED)[block.data]
    sizes = np.diff(np.append(block.starts, len(block.data)))  # each text with the newline after it
    owner = np.repeat(np.arange(len(block.starts)), sizes)
    return Tokens(values, owner, block.starts, block.ends, _BASE)


def multikey_sort(digits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of ``digits`` (rows x digits, most significant first) and, along
    that order, the first index of each run of equal rows.  A row takes part in the
    next round only while it ties with another."""
    m, width = digits.shape
    order = np.argsort(digits[:, 0], kind="stable")
    group = np.zeros(m, dtype=np.int64)
    if not m:
        return order, group
    group[runs(digits[order, 0])] = 1
    group = np.cumsum(group)
    for k in range(1, width):
        tied = np.flatnonzero(np.bincount(group)[group] > 1)
        if not len(tied):
            break
        digit = digits[order[tied], k]
        inner = np.lexsort((digit, group[tied]))
        order[tied] = order[tied][inner]
        new = np.zeros(m, dtype=np.int64)
        new[runs(group)] = 1
        parts = runs(group[tied], digit[inner])
        new[tied[parts]] = 1
        group = np.cumsum(new)
    return order, runs(group)


def _region_rows(length: int):
    def run(batches):
        for batch in batches:
            for d, key, text, (a, c, lo, n, off) in texts_with_regions(batch):
                raw = memoryview(text)
                context = [raw[s : s + k - 1 + length].tobytes() for s, k in zip(lo, n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(a),
                        pa.array(c),
                        pa.array(np.full(len(n), d, dtype=np.int64)),
                        pa.array(np.full(len(n), key, dtype=np.int64)),
                        pa.array(lo),
                        pa.array(n.astype(np.int32)),
                        pa.array(off.astype(np.int32)),
                        pa.array(context, type=pa.binary()),
                    ],
                    schema=_REGIONS,
                )

    return run


def _sort_slice(table: pa.Table, length: int) -> pa.RecordBatch:
    a, c, d, key, lo, n = (table.column(x).to_numpy() for x in ("a", "c", "d", "key", "lo", "n"))
    contexts = table.column("context").combine_chunks()
    sizes = n + length - 1
    width = int(sizes.max())
    matrix = np.zeros((len(n), width), dtype=np.uint8)
    raw = np.frombuffer(b"".join(x.as_py() for x in contexts), dtype=np.uint8)
    matrix[np.arange(width)[None, :] < sizes[:, None]] = raw
    row = np.repeat(np.arange(len(n)), n)
    j = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    digits = np.zeros((len(row), -(-length // 8) * 8), dtype=np.uint8)
    digits[:, :length] = np.lib.stride_tricks.sliding_window_view(matrix, length, axis=1)[row, j]
    digits = digits.view(">u8").astype(np.uint64)
    order, begin = multikey_sort(digits)
    at = lo[row] + j
    rank = np.empty(len(row), dtype=np.int64)
    rank[np.lexsort((at, key[row], d[row]))] = np.arange(len(row))
    ranks = rank[order]
    least = np.repeat(np.minimum.reduceat(ranks, begin), np.diff(np.append(begin, len(row))))
    again = np.empty(len(row), dtype=bool)
    again[order] = ranks > least
    ends = (a[row] == a[0]) | (a[row] == a[-1])
    use = np.flatnonzero(again | ends)
    is_open = ~again[use]
    h = np.zeros((2, len(use)), dtype=np.uint64)
    for k in range(digits.shape[1]):
        for s, seed in enumerate((0x2545F4914F6CDD1D, 0xD6E8FEB86659FD93)):
            h[s] = mix64((h[s] ^ digits[use, k]) * np.uint64(seed) + np.uint64(k + 1))
    null = ~is_open
    return pa.RecordBatch.from_arrays(
        [
            pa.array(a[row[use]]),
            pa.array(c[row[use]]),
            pa.array(j[use].astype(np.int32)),
            pa.array(signed(h[0]), mask=null),
            pa.array(signed(h[1]), mask=null),
            pa.array(d[row[use]]),
            pa.array(key[row[use]]),
            pa.array(at[use]),
        ],
        schema=_RESULT,
    )


def _sorted_suffixes(length: int):
    def bucket(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            while rows >= SLICE:
                table = pa.Table.from_batches(held)
                yield _sort_slice(table[:SLICE], length)
                held, rows = table[SLICE:].to_batches(), rows - SLICE
        if rows:
            yield _sort_slice(pa.Table.from_batches(held), length)

    def compare(texts: DataFrame) -> DataFrame:
        regions = stage(texts.mapInArrow(_region_rows(length), spark_schema(_REGIONS)), "suffix-regions")
        suffix = F.expr("substring(context, off + 1)")  # from the anchor on
        buckets = regions.repartitionByRange(suffix).sortWithinPartitions(suffix)
        found = stage(buckets.mapInArrow(bucket, spark_schema(_RESULT)), "suffix-sorted")
        unstage(regions)
        place = F.struct("d", "key", "at")
        edge = found.where("s1 is not null")
        least = edge.groupBy("s1", "s2").agg(F.min(place).alias("_least"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
        across = edge.join(least, ["s1", "s2"]).where(place > F.col("_least"))
        return found.where("s1 is null").select("a", "c", "j").union(across.select("a", "c", "j"))

    return compare


def removal_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(d, key, spans) of the documents (as given by ``keyed``) that lose bytes."""
    return repeated_spans(docs, byte_tokens, _sorted_suffixes(length), length, gram, other_document=False, parts=partial(pieces, overlap=length - 1))


def dedup_suffixes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (the bytes left) and its SHA-256."""
    docs = keyed(docs)
    fields = pa.schema(
        [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()), ("kept_sha256", pa.string())]
    )

    def digest(text: memoryview, spans: np.ndarray):
        cuts = [0, *spans.ravel().tolist(), len(text)]
        kept = b"".join(text[a:b] for a, b in zip(cuts[0::2], cuts[1::2]))
        return len(text), len(text) - len(kept), len(spans), kept, hashlib.sha256(kept).hexdigest()

    return with_removals(docs, removal_spans(docs, length, gram), fields, digest)
