"""SimHash near-dedup with a byte-position inverted index and count filtering.

Fingerprint: the words of the text (A-Z lower-cased) form shingles of
``SHINGLE_WORDS``; bit b of the 64-bit fingerprint is 1 if it is set in over half of the
shingles' XXH64 values.

Links: two fingerprints that differ in ``distance`` bits at most agree in 8 - distance of their 8
bytes at least.  The inverted index lists every distinct fingerprint under each choice of one
byte position fewer (three of the eight for a distance of four), with their bytes; single bytes would
make lists of 1/256 of all fingerprints.  So a pair to link stands in 8 - distance lists at least,
one for each position left out, and a pair of fewer shared positional bytes in one at most.

- Lists of two are pairs.  They are tallied by pair, and pairs that reach the guaranteed number of lists are
  verified by their bits.  A pair to link that does not reach it stands in a longer list too.
- Longer lists are cut into chunks, and every pair of chunks is compared in a task of its own: shared
  positional bytes are tallied for each pair of fingerprints, pairs that reach the guaranteed
  number are verified, and a spanning set of the links is returned.  No pairs are written out.

Most lists hold one fingerprint.  So that the second pass over the index need not shuffle
them, a bitmap of the longer lists, of fixed size, goes to the tasks that write it; entries
it lets through by chance fall out in the join.  Once more lists repeat than the bitmap has
bits, it lets most entries through and the pass shuffles the whole index, with the same result.

Defined results: no words (NULL or empty text): fingerprint zero, linked like any
other; rows with equal texts share the fingerprint; NULL doc_id never names a
component unless all its documents lack one; an empty table gives an empty one.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velostat.llm.common import LOWER, SPACE_SEPARATED, documents_of, find_words, mix64, signed, spark_schema, stage, text_blocks, text_key, word_parts
from velostat.llm.components import connected_components

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEED = 42
# fingerprints compared by one task: two chunks
CHUNK = 1_000
BITMAP_BITS = 26  # 2**26 flags: 8 MB, whatever the number of lists

_PRINTS = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("fp", pa.int64())])
_ENTRIES = pa.schema([("at", pa.int32()), ("value", pa.int64()), ("fp", pa.int64())])
_SLOTS = pa.schema([("slot", pa.int64())])


def block_votes(block, shingle: int, own: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(shingles with each bit set, shingles) of each text of the block; with ``own``, of the
    shingles whose first word starts in that many bytes of a single text."""
    n = len(block.starts)
    starts, ends = find_words(block.data, SPACE_SEPARATED)
    votes, total = np.zeros((n, 64), dtype=np.int64), np.zeros(n, dtype=np.int64)
    if not len(starts):
        return votes, total
    # words and the one separator after each: texts with single spaces
    keep = SPACE_SEPARATED[block.data]
    keep[ends] = True
    data = LOWER[block.data]
    data[ends] = 32
    joined = data[keep].tobytes()
    size = ends - starts
    at = np.zeros(len(starts), dtype=np.int64)
    np.cumsum(size[:-1] + 1, out=at[1:])
    first = np.searchsorted(starts, block.starts)
    last = np.searchsorted(starts, block.ends)  # exclusive
    count = last - first
    shingles = np.where(count >= shingle, count - shingle + 1, np.minimum(count, 1))
    if own is not None:
        shingles = np.minimum(np.maximum(count - shingle + 1, 0), np.searchsorted(starts, own))
    having = np.flatnonzero(shingles)
    offsets = np.concatenate([[0], np.cumsum(shingles[having])])
    begin = np.repeat(first[having], shingles[having]) + np.arange(offsets[-1]) - np.repeat(offsets[:-1], shingles[having])
    stop = np.minimum(begin + shingle, np.repeat(last[having], shingles[having])) - 1
    digest = xxhash.xxh64_intdigest
    spans = zip(at[begin].tolist(), (at[stop] + size[stop]).tolist())
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), dtype="<u8", count=int(offsets[-1]))
    # bit counts in slices, so that the unpacked bits stay small
    row = np.repeat(having, shingles[having])
    step = 1 << 17
    for a in range(0, len(h), step):
        part, rows = h[a : a + step], row[a : a + step]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        cut = np.flatnonzero(np.diff(rows, prepend=-1))
        votes[rows[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
    total[having] = shingles[having]
    return votes, total


def block_fingerprints(block, shingle: int) -> np.ndarray:
    """One unsigned fingerprint per text of the block; a very long text votes part by part."""
    parts = list(word_parts(block, SPACE_SEPARATED, shingle - 1)) if len(block.starts) == 1 else [(block, None)]
    if len(parts) == 1:
        votes, total = block_votes(block, shingle)
    else:
        votes, total = (sum(x) for x in zip(*[block_votes(part, shingle, own) for part, own in parts]))
        if not total.any():  # fewer words than a shingle has
            votes, total = block_votes(block, shingle)
    return np.packbits(votes * 2 > total[:, None], axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, key, fp) for every row."""
    docs = documents_of(docs).withColumn("key", text_key(F.col("doc_id"), F.col("text")))

    def run(batches):
        for batch in batches:
            for block in text_blocks(batch.column("text")):
                rows = slice(block.first, block.last)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[rows],
                        batch.column("key")[rows],
                        pa.array(signed(block_fingerprints(block, shingle))),
                    ],
                    schema=_PRINTS,
                )

    return docs.mapInArrow(run, spark_schema(_PRINTS))


def _byte_mask(positions) -> int:
    mask = sum(0xFF << (8 * p) for p in positions)
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _slots(at, value: np.ndarray) -> np.ndarray:
    """Place in the bitmap of the list of ``value`` under the choice ``at`` of byte positions."""
    spread = mix64(value.astype(np.uint64, copy=False) + np.uint64(0x9E3779B97F4A7C15) * (np.uint64(1) + np.asarray(at).astype(np.uint64)))
    return (spread >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _list_bitmap(lists: DataFrame) -> np.ndarray:
    """Flags of ``lists`` (at, value), 64 to a word; at most 2**BITMAP_BITS / 64 words come to the driver."""

    def run(batches):
        for batch in batches:
            at, value = (batch.column(c).to_numpy() for c in ("at", "value"))
            yield pa.RecordBatch.from_arrays([pa.array(_slots(at, value.view(np.uint64)))], schema=_SLOTS)

    slots = lists.select("at", "value").mapInArrow(run, spark_schema(_SLOTS))
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits"))
    found = words.toArrow()
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.uint64)
    bitmap[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return bitmap


def _flagged_entries(distinct: DataFrame, masks: list[int], bitmap: np.ndarray) -> DataFrame:
    """Index entries (at, value, fp) whose list the bitmap flags."""
    shared = distinct.sparkSession.sparkContext.broadcast(bitmap)
    unsigned = [np.uint64(m & 0xFFFFFFFFFFFFFFFF) for m in masks]

    def run(batches):
        flags = shared.value
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            ats, values, fps = [], [], []
            for at, mask in enumerate(unsigned):
                value = fp & mask
                slot = _slots(at, value)
                ok = (flags[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1
                ats.append(np.full(int(ok.sum()), at, dtype=np.int32))
                values.append(signed(value[ok]))
                fps.append(signed(fp[ok]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (ats, values, fps)], schema=_ENTRIES)

    return distinct.select("fp").mapInArrow(run, spark_schema(_ENTRIES))


def _spanning_links(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links (member, smallest member) of the connected parts of one list's chunks."""
    m = len(fps)
    label = np.arange(m)
    bits, octets = fps.view(np.uint64), np.ascontiguousarray(fps).view(np.uint8).reshape(m, 8)
    near = np.empty((m, m), dtype=bool)
    for a in range(0, m, 256):
        shared = (octets[a : a + 256, None, :] == octets[None, :, :]).sum(axis=2, dtype=np.uint8)
        i, j = np.nonzero(shared >= 8 - distance)
        near[a : a + 256] = False
        ok = np.bitwise_count(bits[a + i] ^ bits[j]) <= distance
        near[a + i[ok], j[ok]] = True
    while True:
        best = np.where(near, label[None, :], m).min(axis=1)
        best = np.minimum(best, best[best])
        if (best == label).all():
            break
        label = best
    return [(int(fps[i]), int(fps[label[i]])) for i in np.flatnonzero(label != np.arange(m))]


def fingerprint_links(distinct: DataFrame, distance: int = MAX_DISTANCE, chunk: int = CHUNK) -> DataFrame:
    """Links (u, v) whose components are those of all pairs within ``distance`` bits."""
    if not 0 < distance < 8:
        raise ValueError("the index needs a distance of 1 to 7 bits")
    positions = max(1, 7 - distance)
    least = comb(8 - distance, positions)  # lists that a pair to link has in common
    masks = [_byte_mask(c) for c in combinations(range(8), positions)]
    # few bytes a row before the explode, many after it: keep all partitions (dealt by "fp" itself,
    # Spark would take them for those of the aggregate below and merge them)
    partitions = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = distinct.repartition(partitions, F.xxhash64("fp"))
    listed = spread.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("at", "value"))
    lists = listed.groupBy("at", "value").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("u"), F.max("fp").alias("v"))
    lists = stage(lists.where("n > 1"), "simhash-lists")
    tallied = lists.where("n = 2").groupBy("u", "v").agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= least)
    pairs = tallied.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance).select("u", "v")

    many = lists.where("n > 2").select("at", "value", F.ceil(F.col("n") / F.lit(chunk)).cast("int").alias("parts"))
    entries = _flagged_entries(spread, masks, _list_bitmap(many))
    members = entries.join(many, ["at", "value"]).withColumn(
        "part", F.pmod(F.xxhash64("fp"), F.col("parts").cast("bigint")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    members = members.withColumn("other", other).select(
        "at", "value", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "fp"
    )
    groups = members.groupBy("at", "value", "i", "j").agg(F.collect_list("fp").alias("fps"))
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches):
        for batch in batches:
            column = batch.column("fps")
            flat, cuts = column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
            links = set()
            for a, b in zip(cuts[:-1], cuts[1:]):
                links.update(_spanning_links(np.sort(flat[a:b]), distance))
            yield pa.RecordBatch.from_pylist([{"u": x, "v": y} for x, y in links], schema=schema)

    return pairs.union(groups.select("fps").mapInArrow(run, spark_schema(schema))).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """(doc_id, key, fp, root, component_id) for every row of ``docs``: ``root`` is the component's
    smallest fingerprint, which tells it apart, ``component_id`` its smallest doc_id (components
    whose rows share an id may share this too)."""
    prints = stage(fingerprints(docs, shingle), "simhash-prints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected_components(fingerprint_links(distinct.select("fp"), distance))
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = placed.select("fp", "root").join(named, "root")
    return prints.join(classes, "fp").select("doc_id", "key", "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """The rows of ``docs``, one of each group of near duplicates: that with the
    smallest doc_id (NULL last), then the smallest text hash; of rows that are
    equal in both, any one."""
    found = near_duplicates(docs, shingle, distance)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    best = found.groupBy("root").agg(F.min(order).alias("best"))
    best = best.select(F.col("best.doc_id").alias("_id"), F.col("best.key").alias("_key")).distinct()
    columns = docs.columns
    own, text = F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("_row"), text_key(own, text).alias("_k"), own.alias("_own"), F.xxhash64(text, F.lit(1)).alias("_second"))
    kept = rows.join(best.select("_key", "_id"), (F.col("_k") == F.col("_key")) & F.col("_own").eqNullSafe(F.col("_id")))
    return kept.dropDuplicates(["_key", "_own", "_second"]).select("_row.*").select(*columns)


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, root (the component's smallest fingerprint)."""
    found = near_duplicates(docs)
    digits = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return found.select("doc_id", digits("fp").alias("fingerprint"), "component_id", digits("root").alias("root"))
