"""Benchmark decontamination by winnowing.

Words are runs of letters, digits and bytes beyond ASCII, A-Z lower-cased.  Every
window of ``WINDOW`` words of a benchmark item (the whole item, if it is shorter)
keeps the smallest of its k-gram hashes as fingerprint; every window of a document
does the same.  The choice depends on the words of the window alone, so a shared
window of that length always shares its fingerprint: no shared span is missed.
Fingerprints are joined, and each match is extended to the full window by comparing
the words themselves.

A bitmap of the benchmark's fingerprints goes to the tasks that read the documents and drops
what cannot match before anything is shuffled; matches it lets through by chance fall out in
the join.  It has 16 bits or more for each different fingerprint of the benchmark, up to
2**MAX_BITMAP_BITS (32 MB); a benchmark of more than 16 million fingerprints lets more through,
with the same result.  A window that many items share is matched once; its items are listed
after the matches of a document are known.

Defined results: NULL or empty text has no words: never hit, and as an item it
never occurs; the windows of items without an id hit like any other, these items count as one in
n_items and are not named in items_sha256; rows with the same doc_id are
judged one by one (equal rows alike); items that share windows all count; an empty
benchmark hits nothing, an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velostat.llm.common import (
    LETTER_DIGIT,
    LOWER,
    RollingHash,
    byte_values,
    documents_of,
    find_words,
    mix64,
    select_minima,
    signed,
    spark_schema,
    stage,
    text_blocks,
    text_key,
    word_hashes,
    word_parts,
)

WINDOW = 10
GRAM = 4
MIN_BITMAP_BITS, MAX_BITMAP_BITS = 20, 28  # 128 KB to 32 MB

_IN_WORD = LETTER_DIGIT[LOWER]  # before A-Z are lower-cased
_SEED, _BYTE_BASE, _WORD_BASE = 7, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F

_ITEMS = pa.schema(
    [("item_id", pa.int64()), ("n", pa.int32()), ("h", pa.int64()), ("off", pa.int32()), ("window", pa.string())]
)
_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("key", pa.int64()),
        ("n_words", pa.int64()),
        ("n", pa.int32()),
        ("h", pa.int64()),
        ("at", pa.int64()),
        ("context_at", pa.int64()),
        ("context", pa.string()),
    ]
)


class _BlockWords:
    """Words of a block: where they stand, which text they belong to, their hashes."""

    def __init__(self, block):
        self.data = LOWER[block.data]
        values = byte_values(_SEED)
        self.starts, self.ends = find_words(self.data, LETTER_DIGIT)
        self.first = np.searchsorted(self.starts, block.starts)
        self.last = np.searchsorted(self.starts, block.ends)
        self.text = np.repeat(np.arange(len(block.starts)), self.last - self.first)
        self.grams = RollingHash(_WORD_BASE)
        self.prefix = self.grams.prefix(word_hashes(self.data, self.starts, self.ends, values, RollingHash(_BYTE_BASE)))

    def windows(self, n: int, gram: int):
        """(start, position of the chosen k-gram, its hash) of each window of n words of one text."""
        k = min(n, gram)
        m = len(self.starts)
        if m < n:
            none = np.zeros(0, dtype=np.int64)
            return none, none, none.view(np.uint64)
        at = np.arange(m - k + 1)
        h = mix64(self.grams.spans(self.prefix, at, at + k))
        chosen = select_minima(h, n - k + 1)
        start = np.arange(len(chosen))
        ok = self.text[start] == self.text[start + n - 1]
        start, chosen = start[ok], chosen[ok]
        return start, chosen, h[chosen]

    def phrase(self, first: int, last: int) -> str:
        return b" ".join(
            self.data[a:b].tobytes() for a, b in zip(self.starts[first:last], self.ends[first:last])
        ).decode("utf-8", "replace")


def item_windows(items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(item_id, n, h, off, window): the windows of all items with their fingerprints."""
    rows = documents_of(items, "item_id")

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for block in text_blocks(batch.column("text")):
                w = _BlockWords(block)
                sizes = w.last - w.first
                out = []
                for n in np.unique(np.minimum(sizes, window)):
                    if n == 0:
                        continue
                    start, chosen, h = w.windows(int(n), gram)
                    whole = sizes[w.text[start]]
                    use = whole >= n if n == window else whole == n
                    for s, c, v in zip(start[use], chosen[use], signed(h[use])):
                        out.append((ids[block.first + int(w.text[s])], int(n), int(v), int(c - s), w.phrase(s, s + int(n))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in out], type=f.type) for i, f in enumerate(_ITEMS)], schema=_ITEMS
                )

    return rows.mapInArrow(run, spark_schema(_ITEMS))


def _bitmap(bench: DataFrame) -> tuple[np.ndarray, int]:
    """Packed flags of the benchmark's fingerprints and the number of bits that find a flag."""
    distinct = bench.select("h").distinct().count()
    bits = min(max((16 * distinct).bit_length(), MIN_BITMAP_BITS), MAX_BITMAP_BITS)
    slot = F.shiftrightunsigned("h", 64 - bits)
    flags = bench.groupBy(F.shiftright(slot, 3).alias("byte")).agg(
        F.bit_or(F.expr(f"shiftleft(1, cast(shiftrightunsigned(h, {64 - bits}) & 7 as int))")).alias("flags")
    )
    found = flags.toArrow()  # 2**MAX_BITMAP_BITS / 8 rows at most
    packed = np.zeros(1 << (bits - 3), dtype=np.uint8)
    packed[found["byte"].to_numpy()] = found["flags"].to_numpy().astype(np.uint8)
    return packed, bits


def _document_fingerprints(docs: DataFrame, lengths: list[int], bitmap, bits: int, gram: int) -> DataFrame:
    """A row with n_words for every document, and a row for each fingerprint the bitmap lets through."""
    docs = documents_of(docs).withColumn("key", text_key(F.col("doc_id"), F.col("text")))

    def run(batches):
        flags = bitmap.value
        for batch in batches:
            for block in text_blocks(batch.column("text")):
                before = 0
                for part, own in word_parts(block, _IN_WORD, max([*lengths, 1]) - 1):
                    w = _BlockWords(part)
                    whole = part is block
                    mine = len(w.starts) if whole else int(np.searchsorted(w.starts, own))
                    owner, ns, hs, ats, begins, phrases = [], [], [], [], [], []
                    for n in lengths:
                        start, chosen, h = w.windows(n, gram)
                        inside = start < mine  # later ones are windows of the next part
                        chosen, h = chosen[inside], h[inside]
                        new = np.flatnonzero(np.diff(chosen, prepend=-1))
                        chosen, h = chosen[new], h[new]
                        slot = (h >> np.uint64(64 - bits)).astype(np.int64)
                        maybe = (flags[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
                        for c, v in zip(chosen[maybe], signed(h[maybe])):
                            t = w.text[c]
                            begin = max(int(w.first[t]), int(c) - n)
                            ns.append(n)
                            hs.append(v)
                            ats.append(int(c - w.first[t]) + before)
                            begins.append(int(begin - w.first[t]) + before)
                            phrases.append(w.phrase(begin, min(int(w.last[t]), int(c) + n)))
                            owner.append(int(t))
                    before += mine
                    counts = (w.last - w.first).tolist() if whole else [before] * (own == len(part.data) - 1)
                    owner = pa.array(list(range(len(counts))) + owner, type=pa.int64())
                    owner = pc.add(owner, pa.scalar(block.first, pa.int64()))
                    pad = [None] * len(counts)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").take(owner),
                            batch.column("key").take(owner),
                            pa.array(counts + [None] * len(ns), type=pa.int64()),
                            pa.array(pad + ns, type=pa.int32()),
                            pa.array(pad + hs, type=pa.int64()),
                            pa.array(pad + ats, type=pa.int64()),
                            pa.array(pad + begins, type=pa.int64()),
                            pa.array(pad + phrases, type=pa.string()),
                        ],
                        schema=_FOUND,
                    )

    return docs.mapInArrow(run, spark_schema(_FOUND))


def find_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, key, n_words, n_hit, n_items, items_sha256, contaminated) for every row of ``docs``."""
    spark = docs.sparkSession
    bench = stage(item_windows(items, window, gram), "bench-windows")
    lengths = sorted(r[0] for r in bench.select("n").distinct().collect())  # at most ``window`` numbers
    packed, bits = _bitmap(bench)
    found = stage(_document_fingerprints(docs, lengths, spark.sparkContext.broadcast(packed), bits, gram), "doc-fingerprints")

    windows = bench.select("n", "h", "off", "window").distinct()
    matches = found.where("n is not null").drop("n_words").join(windows, ["n", "h"])
    start = F.col("at") - F.col("off")
    inside = F.slice(F.split("context", " "), (start - F.col("context_at") + 1).cast("int"), F.col("n"))
    fits = (start >= F.col("context_at")) & (F.array_join(F.when(start >= F.col("context_at"), inside), " ") == F.col("window"))
    hits = matches.where(fits).select("doc_id", "key", start.alias("a"), (start + F.col("n")).alias("b"), "window").distinct()
    hits = stage(hits, "bench-hits")

    spans = hits.groupBy("doc_id", "key", "a").agg(F.max("b").alias("b"))
    before = Window.partitionBy("doc_id", "key").orderBy("a").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_reach", F.coalesce(F.max("b").over(before), F.lit(0)))
    covered = spans.groupBy("doc_id", "key").agg(
        F.sum(F.greatest(F.lit(0), F.col("b") - F.greatest("a", "_reach"))).alias("n_hit")
    )
    holders = bench.select("window", F.col("item_id").cast("string").alias("item")).distinct()
    listed = hits.select("doc_id", "key", "window").distinct().join(holders, "window").select("doc_id", "key", "item").distinct()
    listed = listed.groupBy("doc_id", "key").agg(
        F.count(F.lit(1)).alias("n_items"), F.sha2(F.array_join(F.sort_array(F.collect_list("item")), ","), 256).alias("sha")
    )
    per_row = covered.join(listed.withColumnRenamed("doc_id", "_d").withColumnRenamed("key", "_k"), F.col("key").eqNullSafe(F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_d")))
    per_row = per_row.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "n_hit", "n_items", "sha")
    every = found.where("n is null").select("doc_id", "key", "n_words")
    joined = every.join(per_row, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return joined.select(
        "doc_id",
        "key",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs."""
    bad = find_contamination(docs, items).where("contaminated").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).distinct()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("_row"), text_key(F.col("doc_id").cast("bigint"), text).alias("_k"))
    clean = rows.join(bad, (F.col("_k") == F.col("_key")) & F.col("_row.doc_id").eqNullSafe(F.col("_id")), "left_anti")
    return clean.select("_row.*")
