"""Repeated windows of fixed length in a corpus: the common part of substring dedup
(windows of words) and suffix-array dedup (windows of bytes).

Shipping every window would move many times the corpus, so windows are grouped by
anchors.  The anchor of a window is the position of the smallest hash among its
k-grams; equal windows have equal anchors at the same offset.  A *context* is the
stretch covered by consecutive windows with the same anchor (about window / 2 of them).

1. One scan emits a row per context: the anchor's hash, a hash of the context.
2. Anchors that occur once cannot repeat; they are dropped after a count.
3. Contexts that are equal as a whole form a class: every window of a later member
   repeats one of the first.  This settles almost all rows of copies and common
   passages with hashes only.
4. What is left are the first members of classes that share an anchor without being
   equal (the edges of repeats).  Only their windows are compared one by one; the
   caller says how (``compare``).

No window is lost: equal windows always meet in step 3 or 4.  Rows that share a
doc_id are told apart by a hash of the text; equal rows are one document and get
one result.  NULL doc_id comes after every other.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velostat.llm.common import (
    BLOCK_BYTES,
    RollingHash,
    TextBlock,
    documents_of,
    mix64,
    runs,
    select_minima,
    signed,
    spark_schema,
    stage,
    text_blocks,
    text_key,
    unstage,
)

_LAST_ID = (1 << 63) - 1
_CONTEXTS = pa.schema(
    [
        ("d", pa.int64()),
        ("key", pa.int64()),
        ("a", pa.int64()),
        ("c", pa.int64()),
        ("lo", pa.int64()),
        ("n", pa.int32()),
        ("off", pa.int32()),
    ]
)


class Tokens:
    """The tokens of a block's texts: rolling prefix sums over their values, the
    text each belongs to, and the first and last (exclusive) token of each text."""

    def __init__(self, values: np.ndarray, owner: np.ndarray, first: np.ndarray, last: np.ndarray, base: int):
        self.values, self.owner, self.first, self.last = values, owner, first, last
        self.rolling = RollingHash(base)
        self.prefix = self.rolling.prefix(values)

    def contexts(self, window: int, gram: int):
        """Per context: text, first window (token index), number of windows, anchor offset, anchor and context hashes."""
        m = len(self.values)
        if m < window:
            return None
        at = np.arange(m - gram + 1)
        h = mix64(self.rolling.spans(self.prefix, at, at + gram))
        chosen = select_minima(h, window - gram + 1)
        start = np.arange(len(chosen))
        start = start[start + window <= self.last[self.owner[start]]]
        if not len(start):
            return None
        chosen, owner = chosen[start], self.owner[start]
        begin = runs(chosen, owner)
        n = np.diff(np.append(begin, len(start)))
        lo, p, owner = start[begin], chosen[begin], owner[begin]
        shape = (n.astype(np.uint64) << np.uint64(32)) + (p - lo).astype(np.uint64)
        c = mix64(self.rolling.spans(self.prefix, lo, lo + n - 1 + window) + mix64(shape))
        return owner, lo, n, p - lo, h[p], c


def pieces(block: TextBlock, overlap: int):
    """A block as it is, or, for one very long text, stretches that overlap by
    ``overlap`` bytes: (first byte, block).  Keeps the memory of byte kernels bounded."""
    size = len(block.data) - 1
    if size <= 2 * BLOCK_BYTES or len(block.starts) > 1:
        yield 0, block
        return
    for begin in range(0, size, BLOCK_BYTES):
        end = min(size, begin + BLOCK_BYTES + overlap)
        part = np.append(block.data[begin:end], np.uint8(10))
        yield begin, TextBlock(block.first, block.last, part, np.zeros(1, np.int64), np.array([end - begin]))
        if end == size:
            return


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, d, key, text): d orders documents, (d, key) tells them apart."""
    docs = documents_of(docs)
    return docs.select(
        "doc_id",
        F.coalesce("doc_id", F.lit(_LAST_ID)).alias("d"),
        text_key(F.col("doc_id"), F.col("text")).alias("key"),
        "text",
    )


def scan_contexts(docs: DataFrame, tokens: Callable, window: int, gram: int, parts: Callable) -> DataFrame:
    """Step 1.  ``tokens`` maps a block to ``Tokens``; ``parts`` gives the stretches in which very
    long texts are read, each with the number of tokens before it."""

    def run(batches):
        for batch in batches:
            for whole in text_blocks(batch.column("text")):
                for origin, block in parts(whole):
                    t = tokens(block)
                    found = t.contexts(window, gram)
                    if found is None:
                        continue
                    owner, lo, n, off, a, c = found
                    row = pa.array(owner + block.first)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("d").take(row),
                            batch.column("key").take(row),
                            pa.array(signed(a)),
                            pa.array(signed(c)),
                            pa.array(lo - t.first[owner] + origin),
                            pa.array(n.astype(np.int32)),
                            pa.array(off.astype(np.int32)),
                        ],
                        schema=_CONTEXTS,
                    )

    return docs.select("d", "key", "text").mapInArrow(run, spark_schema(_CONTEXTS))


def repeated_spans(
    docs: DataFrame, tokens: Callable, compare: Callable, window: int, gram: int, other_document: bool, parts: Callable
) -> DataFrame:
    """(d, key, spans): the token spans of each document that repeat, as a list of (start, end).

    ``other_document``: a window repeats if it starts in a document with a smaller
    id; otherwise also if it starts earlier in the same document."""
    contexts = stage(scan_contexts(docs, tokens, window, gram, parts), "repeat-contexts")
    twice = F.min("d") < F.max("d") if other_document else F.count(F.lit(1)) > 1
    counts = contexts.groupBy("a").agg(twice.alias("_twice"), (F.min("c") != F.max("c")).alias("mixed"))
    candidates = stage(counts.where("_twice").select("a", "mixed"), "repeat-anchors")
    rows = stage(contexts.join(candidates, "a"), "repeat-candidates")
    unstage(contexts, candidates)

    place = F.struct("d", "key", "lo")
    classes = rows.groupBy("a", "c").agg(
        F.min(place).alias("first"), F.min("n").alias("n"), F.min("off").alias("off"), F.max("mixed").alias("mixed")
    )
    classes = stage(classes, "repeat-classes")
    later = (F.col("d") > F.col("first.d")) if other_document else (place > F.col("first"))
    judged = stage(
        rows.select("d", "key", "a", "c", "lo", "n")
        .join(classes.select("a", "c", "first", "mixed"), ["a", "c"])
        .select("d", "key", "a", "c", "lo", "n", "mixed", later.alias("later")),
        "repeat-judged",
    )
    unstage(rows)

    # one region per class that has to be compared, grouped by the document it stands in
    regions = classes.where("mixed").select("first.d", "first.key", F.struct("a", "c", "first.lo", "n", "off").alias("region"))
    regions = regions.groupBy("d", "key").agg(F.collect_list("region").alias("regions"))
    texts = docs.select("d", "key", "text").join(regions, ["d", "key"])
    again = stage(compare(texts), "repeat-windows")  # a, c, j: window j of the class repeats

    whole = judged.where("later").select("d", "key", F.col("lo").alias("s"), (F.col("lo") + F.col("n") - 1 + window).alias("e"))
    single = judged.where("not later and mixed").select("d", "key", "a", "c", "lo").join(again, ["a", "c"])
    single = single.select("d", "key", (F.col("lo") + F.col("j")).alias("s"), (F.col("lo") + F.col("j") + window).alias("e"))
    return whole.union(single).groupBy("d", "key").agg(F.collect_set(F.struct("s", "e")).alias("spans"))


def texts_with_regions(batch: pa.RecordBatch):
    """For each row of a batch of ``texts``: (d, key, text as bytes, its regions as columns)."""
    lists = batch.column("regions")
    flat = lists.flatten()
    columns = [flat.field(i).to_numpy(zero_copy_only=False) for i in range(flat.type.num_fields)]
    cuts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    d, key = batch.column("d").to_numpy(), batch.column("key").to_numpy()
    text = batch.column("text")
    for i in range(batch.num_rows):
        part = slice(cuts[i], cuts[i + 1])
        yield d[i], key[i], text[i].as_buffer(), [c[part] for c in columns]


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal intervals of a list of (start, end) rows."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    first = np.flatnonzero(new)
    return np.stack([spans[first, 0], reach[np.append(first[1:], len(spans)) - 1]], axis=1)


def with_removals(docs: DataFrame, spans: DataFrame, fields: pa.Schema, digest: Callable) -> DataFrame:
    """One row per document: doc_id and what ``digest(text bytes, merged spans)`` returns."""
    schema = pa.schema([("doc_id", pa.int64()), *fields])
    lists = spans.select(F.col("d").alias("_d"), F.col("key").alias("_key"), "spans")
    joined = docs.join(lists, (F.col("key") == F.col("_key")) & (F.col("d") == F.col("_d")), "left").select("doc_id", "text", "spans")

    def run(batches):
        none = np.zeros((0, 2), dtype=np.int64)
        for batch in batches:
            lists, text = batch.column("spans"), batch.column("text")
            out = []
            for i in range(batch.num_rows):
                found = none
                if lists[i].is_valid:
                    s, e = lists[i].values.field(0).to_numpy(), lists[i].values.field(1).to_numpy()
                    found = merged(np.stack([s, e], axis=1))
                out.append(digest(memoryview(text[i].as_buffer()), found))
            columns = [pa.array([r[k] for r in out], type=f.type) for k, f in enumerate(fields)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], schema=schema)

    return joined.mapInArrow(run, spark_schema(schema))
