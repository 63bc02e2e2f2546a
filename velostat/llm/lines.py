"""Reversible line dedup: sharded cuckoo filters backed by exact reference counts.

A line's key is the line without the white space around it, A-Z lower-cased.  A key found in
``min_docs`` documents or more is *common*; common lines are dropped from every document.

``LineIndex`` holds three tables, each under the shared checkpoint folder:

- ``counts``  (h1, h2, n): how many documents hold the key, exactly; a key is known by its
  128-bit XXH3 hash;
- ``members`` (doc_id, t1, t2, n): the documents counted, so that none is deleted that was
  never inserted;
- ``filters`` (shard, table, misses): for each shard of the key space a cuckoo filter of its
  common keys, and the rare keys of ``counts`` for which the filter says yes as well.

``insert`` and ``delete`` add and subtract references and return a new index (the old one
stays valid): only keys that cross ``min_docs`` are put into or taken out of the filters.  An
insert followed by the delete of the same documents gives the same decisions as before.
With ``misses`` the answers about every key in ``counts`` are exact, so ``apply`` needs no join
with the counts: it reads each document once and drops its common lines.

Where all filters take at most ``FILTER_BYTES`` they are broadcast.  Beyond that the documents'
keys go to the shards instead, each shard's filter in front of its keys; keys so frequent that a
shard could be swamped (the ``HOT_KEYS`` most frequent, so that every other key has at most
1/HOT_KEYS of all references) are decided where the documents are read.

Defined results: every row is a document, also rows that repeat or share a doc_id; NULL or
empty text is one empty line; empty keys are never dropped; a key counts once a document;
an empty table gives an empty one; only doc_id and text are read, whatever else there is.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velostat.llm.common import documents_of, mix64, signed, spark_schema, stage, text_key

MIN_DOCS = 10
MIN_CHARS = 1
SHARD_KEYS = 32_768  # common keys meant for one shard
SLOTS = 4
FILTER_BYTES = 64 << 20
HOT_KEYS = 65_536
STRETCH = 4 << 20  # bytes of one text split into lines at a time
FLUSH_KEYS = 200_000

_COUNTS = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("d", pa.int64())])
_MEMBERS = "doc_id bigint, t1 bigint, t2 bigint, n bigint"
_FILTERS = "shard int, table binary, misses binary, full boolean"
_REFS = pa.schema([("row_id", pa.int64()), ("row_key", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())])
_RESULT = [("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string())]


class CuckooFilter:
    """Buckets of four 32-bit fingerprints (0: free), two buckets for every key."""

    def __init__(self, table: np.ndarray):
        self.table, self.mask = table, np.uint64(len(table) - 1)

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        """Room for ``keys`` at half the slots in use."""
        return cls(np.zeros((1 << max(2, (2 * keys // SLOTS - 1).bit_length()), SLOTS), dtype=np.uint32))

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of each key; ``h`` has two columns."""
        mark = np.maximum((h[:, 1] & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.uint32(1))
        first = h[:, 0] & self.mask
        return mark, first.astype(np.int64), (first ^ (self._turn(mark))).astype(np.int64)

    def _turn(self, mark: np.ndarray) -> np.ndarray:
        return mix64(mark.astype(np.uint64)) & self.mask

    def contains(self, h: np.ndarray) -> np.ndarray:
        mark, a, b = self.places(h)
        return ((self.table[a] == mark[:, None]) | (self.table[b] == mark[:, None])).any(axis=1)

    def insert(self, h: np.ndarray, kicks: int = 500) -> bool:
        """False if the filter is too full; its content is then of no use."""
        random = np.random.default_rng(len(h))
        for mark, a, b in zip(*self.places(h)):
            for place in (a, b):
                free = np.flatnonzero(self.table[place] == 0)
                if len(free):
                    self.table[place, free[0]] = mark
                    break
            else:
                place = b
                for _ in range(kicks):
                    slot = int(random.integers(SLOTS))
                    mark, self.table[place, slot] = self.table[place, slot], mark
                    place = int(place ^ int(self._turn(np.array([mark]))[0]))
                    free = np.flatnonzero(self.table[place] == 0)
                    if len(free):
                        self.table[place, free[0]] = mark
                        break
                else:
                    return False
        return True

    def delete(self, h: np.ndarray) -> None:
        """Take out one fingerprint of each key; the keys must have been inserted."""
        for mark, *places in zip(*self.places(h)):
            for place in places:
                held = np.flatnonzero(self.table[place] == mark)
                if len(held):
                    self.table[place, held[0]] = 0
                    break


class Common:
    """Answers whether keys are common, from the filters of some shards."""

    def __init__(self, shards: int):
        self.bits, self.filters, self.misses = shards.bit_length() - 1, {}, {}

    @classmethod
    def of(cls, shards: int, rows: list[tuple[int, bytes, bytes]]) -> Common:
        common = cls(shards)
        for row in rows:
            common.add(*row)
        return common

    def add(self, shard: int, table: bytes, misses: bytes) -> None:
        self.filters[shard] = CuckooFilter(np.frombuffer(table, dtype=np.uint32).reshape(-1, SLOTS))
        self.misses[shard] = {misses[i : i + 16] for i in range(0, len(misses), 16)}

    def __call__(self, h: np.ndarray) -> np.ndarray:
        """One flag for each key; ``h`` has two unsigned columns."""
        out = np.zeros(len(h), dtype=bool)
        shard = (h[:, 0] >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(h), np.int64)
        for s in np.unique(shard).tolist():
            if s in self.filters:
                at = np.flatnonzero(shard == s)
                at = at[self.filters[s].contains(h[at])]
                if self.misses[s]:
                    at = at[[_packed(k) not in self.misses[s] for k in h[at]]]
                out[at] = True
        return out


def _packed(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(h, dtype=np.uint64).tobytes()


def _unsigned(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2")], axis=1)


def line_stretches(data: bytes) -> Iterator[list[bytes]]:
    """The lines of a text, some megabytes at a time."""
    begin = 0
    while len(data) - begin > STRETCH and (end := data.find(b"\n", begin + STRETCH)) >= 0:
        yield data[begin:end].split(b"\n")
        begin = end + 1
    yield data[begin:].split(b"\n")


def line_keys(lines: list[bytes], min_chars: int) -> list[bytes]:
    """The hash of each line's key; empty for a key of fewer than ``min_chars`` code points."""
    digest = xxhash.xxh3_128_digest
    keys = [x.strip().lower() for x in lines]  # bytes: ASCII white space, ASCII letters
    if min_chars > 1:
        keys = [k if len(k.decode()) >= min_chars else b"" for k in keys]
    return [digest(k) if k else b"" for k in keys]


def _hashes(keys) -> np.ndarray:
    return np.frombuffer(b"".join(keys), dtype=">u8").astype(np.uint64).reshape(-1, 2)


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for text in batch.column("text"):
        yield text.as_buffer().to_pybytes()


def reference_counts(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, d): documents that hold each key, added up within a task where it can."""

    def rows(held: Counter):
        h = _hashes(held)
        columns = [signed(h[:, 0]), signed(h[:, 1]), np.fromiter(held.values(), dtype=np.int64, count=len(held))]
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], schema=_COUNTS)

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for data in _texts(batch):
                own: set[bytes] = set()
                for lines in line_stretches(data):
                    own.update(line_keys(lines, min_chars))
                own.discard(b"")
                held.update(own)
                if len(held) > FLUSH_KEYS:
                    yield rows(held)
                    held = Counter()
        if held:
            yield rows(held)

    return docs.select("text").mapInArrow(run, spark_schema(_COUNTS))


def _shard(shards: int) -> Column:
    bits = shards.bit_length() - 1
    return F.shiftrightunsigned("h1", 64 - bits).cast("int") if bits else F.lit(0)


class LineIndex:
    """Line references of a set of documents; see the module's text."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS):
        self.spark, self.min_docs, self.min_chars, self.shards = spark, min_docs, min_chars, 1
        self.counts = spark.createDataFrame([], "h1 bigint, h2 bigint, n bigint")
        self.members = spark.createDataFrame([], _MEMBERS)
        self.filters = spark.createDataFrame([], _FILTERS)

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index with the references of ``docs`` as well."""
        return self._changed(docs, 1)

    def delete(self, docs: DataFrame) -> LineIndex:
        """The index without the references of ``docs``, all of which must have been inserted."""
        return self._changed(docs, -1)

    def _changed(self, docs: DataFrame, sign: int) -> LineIndex:
        out = LineIndex(self.spark, self.min_docs, self.min_chars)
        docs = documents_of(docs)
        own = docs.select("doc_id", F.xxhash64("text").alias("t1"), F.xxhash64("text", F.lit(1)).alias("t2"), F.lit(sign).cast("bigint").alias("n"))
        members = self.members.unionByName(own).groupBy("doc_id", "t1", "t2").agg(F.sum("n").alias("n")).where("n <> 0")
        out.members = stage(members, "line-members")
        if out.members.where("n < 0").limit(1).count():
            raise ValueError("a document to delete was never inserted")

        # what each key was counted before, and is now
        delta = reference_counts(docs, self.min_chars).select("h1", "h2", F.lit(0).cast("bigint").alias("was"), (F.col("d") * sign).alias("d"))
        held = self.counts.select("h1", "h2", F.col("n").alias("was"), F.lit(0).cast("bigint").alias("d"))
        merged = held.unionByName(delta).groupBy("h1", "h2").agg(F.sum("was").alias("was"), F.sum(F.col("was") + F.col("d")).alias("n"))
        merged = stage(merged, "line-counts")
        out.counts = merged.where("n > 0").select("h1", "h2", "n")
        common = out.counts.where(F.col("n") >= self.min_docs).count()
        out.shards = 1 << max(0, (common - 1) // SHARD_KEYS).bit_length()
        if out.shards == self.shards:
            moved = merged.where((F.col("n") >= self.min_docs) != (F.col("was") >= self.min_docs))
            changes, filters = moved.select("h1", "h2", (F.col("n") >= self.min_docs).alias("up")), self.filters
        else:
            changes, filters = out._all_common(), self.filters.limit(0)
        out._build(filters, changes)
        return out

    def _all_common(self) -> DataFrame:
        return self.counts.where(F.col("n") >= self.min_docs).select("h1", "h2", F.lit(True).alias("up"))

    def _build(self, filters: DataFrame, changes: DataFrame) -> None:
        """Put keys into the shards' filters and take keys out; twice the shards if one is full."""

        def update(key: tuple, held: pd.DataFrame, moved: pd.DataFrame) -> pd.DataFrame:
            table = CuckooFilter.sized(SHARD_KEYS)
            if len(held):
                table = CuckooFilter(np.frombuffer(held["table"].iloc[0], dtype=np.uint32).reshape(-1, SLOTS).copy())
            h = np.stack([moved[c].to_numpy(dtype=np.int64).view(np.uint64) for c in ("h1", "h2")], axis=1)
            up = moved["up"].to_numpy(dtype=bool)
            table.delete(h[~up])
            full = not table.insert(h[up])
            return pd.DataFrame({"shard": [int(key[0])], "table": [table.table.tobytes()], "misses": [b""], "full": [full]})

        while True:
            dealt = changes.withColumn("shard", _shard(self.shards)).groupBy("shard")
            built = stage(filters.groupBy("shard").cogroup(dealt).applyInPandas(update, _FILTERS), "line-filters")
            if not built.where("full").limit(1).count():
                break
            self.shards, changes, filters = self.shards * 2, self._all_common(), filters.limit(0)
        rare = self.counts.where(F.col("n") < self.min_docs).select(F.lit(0).cast("bigint").alias("row_id"), F.lit(0).cast("bigint").alias("row_key"), "h1", "h2")
        self.filters = built
        wrong = stage(self._probe(rare), "line-misses").withColumn("shard", _shard(self.shards))

        def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            h = np.stack([rows[c].to_numpy(dtype=np.int64).view(np.uint64) for c in ("h1", "h2")], axis=1)
            return pd.DataFrame({"shard": [int(key[0])], "packed": [_packed(h)]})

        packed = wrong.groupBy("shard").applyInPandas(pack, "shard int, packed binary")
        joined = built.drop("misses").join(packed, "shard", "left")
        self.filters = stage(joined.select("shard", "table", F.coalesce("packed", F.lit(b"")).alias("misses"), "full"), "line-filters")

    def _small(self) -> bool:
        total = self.filters.agg(F.coalesce(F.sum(F.octet_length("table") + F.octet_length("misses")), F.lit(0))).first()[0]
        return total <= FILTER_BYTES

    def _broadcast(self):
        rows = self.filters.collect()  # FILTER_BYTES at most: see _small
        return self.spark.sparkContext.broadcast([(r.shard, bytes(r.table), bytes(r.misses)) for r in rows])

    def _probe(self, refs: DataFrame) -> DataFrame:
        """The rows of ``refs`` (row_id, row_key, h1, h2) whose key the filters call common."""
        schema = spark_schema(_REFS)
        if self._small():
            shared, shards = self._broadcast(), self.shards

            def answer(batches):
                common = Common.of(shards, shared.value)
                for batch in batches:
                    yield batch.filter(pa.array(common(_unsigned(batch))))

            return refs.mapInArrow(answer, schema)
        none = F.lit(None).cast("binary")
        rows = refs.select(_shard(self.shards).alias("shard"), F.lit(1).alias("kind"), *_REFS.names, none.alias("table"), none.alias("misses"))
        absent = [F.lit(0).cast("bigint").alias(c) for c in _REFS.names]
        fronts = self.filters.select("shard", F.lit(0).alias("kind"), *absent, "table", "misses")
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = fronts.union(rows).repartition(parts, "shard").sortWithinPartitions("shard", "kind")
        shards = self.shards

        def stream(batches):
            common = Common(shards)
            for batch in batches:
                kind = batch.column("kind").to_numpy()
                for i in np.flatnonzero(kind == 0):
                    common.add(batch.column("shard")[i].as_py(), batch.column("table")[i].as_py(), batch.column("misses")[i].as_py())
                keys = batch.select(_REFS.names).filter(pa.array(kind == 1))
                yield keys.filter(pa.array(common(_unsigned(keys))))
                last = batch.column("shard")[batch.num_rows - 1].as_py()
                for done in [s for s in common.filters if s != last]:  # shards come in order
                    del common.filters[done], common.misses[done]

        return dealt.mapInArrow(stream, schema)

    def apply(self, docs: DataFrame, with_text: bool = True) -> DataFrame:
        """doc_id, n_lines, n_dropped, kept_sha256 (and ``kept``, the text that is left) of each row."""
        docs = documents_of(docs)
        if self._small():
            shared, shards = self._broadcast(), self.shards

            def answers():
                common = Common.of(shards, shared.value)
                return lambda i, batch, h: common(h)

            return docs.mapInArrow(_drop_lines(answers, self.min_chars, with_text), _result(with_text))
        return self._apply_by_shards(docs, with_text)

    def _apply_by_shards(self, docs: DataFrame, with_text: bool) -> DataFrame:
        """As ``apply``, without any filter in the tasks that read the documents."""
        top = self.counts.where(F.col("n") >= self.min_docs).orderBy(F.desc("n"), "h1", "h2").limit(HOT_KEYS).select("h1", "h2")
        hot = self.spark.sparkContext.broadcast({_packed(h) for h in _unsigned(top.toArrow().combine_chunks().to_batches()[0])})
        keyed = docs.withColumn("row_key", text_key(F.col("doc_id"), F.col("text"))).withColumn("row_id", F.coalesce("doc_id", F.lit(0)))
        min_chars = self.min_chars

        def refer(batches):
            for batch in batches:
                owners, hashes = [], []
                for i, data in enumerate(_texts(batch)):
                    own = set()
                    for lines in line_stretches(data):
                        own.update(line_keys(lines, min_chars))
                    own.discard(b"")
                    h = _hashes(own)
                    h = h[[_packed(k) not in hot.value for k in h]]
                    owners.append(np.full(len(h), i))
                    hashes.append(h)
                at, h = pa.array(np.concatenate(owners).astype(np.int64)), np.concatenate(hashes)
                columns = [batch.column("row_id").take(at), batch.column("row_key").take(at)]
                columns += [pa.array(np.ascontiguousarray(signed(np.ascontiguousarray(h[:, k])))) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, schema=_REFS)

        refs = self._probe(keyed.select("row_id", "row_key", "text").mapInArrow(refer, spark_schema(_REFS)))
        found = refs.distinct().groupBy("row_id", "row_key").agg(F.collect_list(F.struct("h1", "h2")).alias("found"))
        joined = keyed.join(found, ["row_id", "row_key"], "left").select("doc_id", "text", "found")

        def known(i, batch, h):
            rows, own = batch.column("found")[i], set()
            if rows.is_valid:
                columns = [rows.values.field(k).to_numpy().view(np.uint64) for k in (0, 1)]
                own = {_packed(k) for k in np.stack(columns, axis=1)}
            return np.array([(p := _packed(k)) in hot.value or p in own for k in h], dtype=bool)

        return joined.mapInArrow(_drop_lines(lambda: known, min_chars, with_text), _result(with_text))


def _result(with_text: bool):
    return spark_schema(pa.schema(_RESULT + [("kept", pa.string())] * with_text))


def _drop_lines(answers, min_chars: int, with_text: bool):
    """A function for mapInArrow; ``answers()(row, batch, hashes)`` flags the keys to drop."""

    def run(batches):
        common = answers()
        schema = pa.schema(_RESULT + [("kept", pa.string())] * with_text)
        for batch in batches:
            rows = []
            for i, data in enumerate(_texts(batch)):
                total = dropped = 0
                sha, kept, begun = hashlib.sha256(), [], False
                for lines in line_stretches(data):
                    keys = line_keys(lines, min_chars)
                    some = [k for k, key in enumerate(keys) if key]
                    gone = set()
                    if some:
                        flags = common(i, batch, _hashes([keys[k] for k in some]))
                        gone = {some[k] for k in np.flatnonzero(flags)}
                    total += len(lines)
                    dropped += len(gone)
                    left = [x for k, x in enumerate(lines) if k not in gone] if gone else lines
                    if left:
                        piece = b"\n" * begun + b"\n".join(left)
                        begun = True
                        sha.update(piece)
                        if with_text:
                            kept.append(piece)
                rows.append((total, dropped, sha.hexdigest(), b"".join(kept).decode()))
            columns = [batch.column("doc_id")]
            columns += [pa.array([r[k] for r in rows], type=schema.field(k + 1).type) for k in range(3 + with_text)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, with_text: bool = True) -> DataFrame:
    """``docs`` without the lines that ``min_docs`` of its documents share."""
    return LineIndex(docs.sparkSession, min_docs, min_chars).insert(docs).apply(docs, with_text)
