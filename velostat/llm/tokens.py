"""Token ids in Arrow stream files with fixed-size-list batches.

Documents are range-partitioned by doc_id; each partition writes one file: its texts'
ids, an end id after each text, cut into sequences of ``LENGTH`` ids.  A row of the file
has ``input_ids`` and ``mask`` (False on the padding of the file's last
sequence), ``doc_start`` (True on the first id of a document) and ``doc_ids`` (of
the documents that start in the sequence).  All lists but the last are of fixed size and
every batch but the last has ``BATCH`` rows, so sequence i stands at a known place of
a memory-mapped file and is read without a copy (``TokenFile``).

Ids are stored in two bytes if the vocabulary allows it.  A file is written under
another name and renamed when complete; a task that runs again writes the same file
again.  The target folder must be one that all executors reach (pyarrow's
file systems: file, hdfs, s3, gs).

Encoding: the normalizer and the pre-tokenizer never join text across a space or a
newline, so a text's ids are those of its space-separated pieces in order.  The
different pieces of some blocks of texts are encoded by the library once and remembered (up to
``REMEMBERED`` and ``REMEMBERED_BYTES``) for all tasks of a worker process, in two Arrow arrays; the blocks'
ids are gathered from that memory at once.  Fewer pieces differ once ASCII ones are lower-cased, as the
normalizer does anyway, and stops and commas that close a word are pieces of their own, as the
pre-tokenizer has them.  That is done after ASCII letters only: after others, the normalizer may still
move a mark.  A very long text is encoded in stretches.

Defined results: NULL text counts as empty: its ids are the end id alone; NULL doc_id
comes first; rows with the same doc_id are documents of their own, ordered by a
hash of the text; an empty table gives no file and no row.
"""

from __future__ import annotations

import os
import re
import sys
import types
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from velostat.llm.common import BLOCK_BYTES, TextBlock, byte_class, documents_of, encode_words, find_words, spark_schema, stage, text_blocks
from velostat.session import scratch_dir

LENGTH = 2048
BATCH = 256
END_ID = 2
REMEMBERED = 1_400_000
REMEMBERED_BYTES = 1 << 25  # of pieces; the worker keeps them between tasks, so this counts against the executor
LEARNED_AT_ONCE = 1 << 12
LOOKED_UP_AT_ONCE = 8 * BLOCK_BYTES
_SPACE_OR_NEWLINE = byte_class(b" \n")
_IS_CLOSING, _IS_LETTER = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_IS_CLOSING[list(b".,")] = True
_IS_LETTER[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True
_GAP = re.compile(rb"[ \n]")

_SHARDS = pa.schema(
    [("shard", pa.int32()), ("path", pa.string()), ("n_tokens", pa.int64()), ("n_sequences", pa.int64()), ("n_docs", pa.int64())]
)
_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        uri = "/" + uri[len("file:") :].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


class Encoder:
    """A tokenizer of the tokenizers library with a memory for pieces of text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        ids = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        # what a tokenizer does not do itself is not done for it
        self.lowers = ids("Ab") == ids("ab")
        self.splits = ids("ab.") == ids("ab") + ids(".") and ids("ab .") == ids("ab.")
        self._forget()

    def _forget(self) -> None:
        """Known pieces and, in the same order, the bytes of their ids."""
        self.known, self.ids = pa.array([], type=pa.string()), pa.array([], type=pa.large_binary())

    @classmethod
    def of_worker(cls, path: str) -> Encoder:
        """The process's encoder: made once, so that later tasks find its memory."""
        state = sys.modules.setdefault("velostat_worker_state", types.ModuleType("velostat_worker_state")).__dict__
        if path not in state:
            state[path] = cls(path)
        return state[path]

    def _learn(self, pieces: pa.Array) -> None:
        parts = [self.ids]
        for a in range(0, len(pieces), LEARNED_AT_ONCE):
            found = self.tokenizer.encode_batch_fast(pieces.slice(a, LEARNED_AT_ONCE).to_pylist(), add_special_tokens=False)
            lists = [e.ids for e in found]
            ends = np.cumsum([0, *map(len, lists)])
            ids = np.fromiter(chain.from_iterable(lists), dtype=self.dtype, count=ends[-1])
            buffers = [None, pa.py_buffer(ends * self.dtype.itemsize), pa.py_buffer(ids)]
            parts.append(pa.Array.from_buffers(pa.large_binary(), len(lists), buffers))
        self.known, self.ids = pa.concat_arrays([self.known, pieces]), pa.concat_arrays(parts)

    def _lowered(self, pieces: pa.Array) -> pa.Array:
        """The pieces, ASCII ones in lower case if the tokenizer does that anyway (not in strings of special tokens)."""
        if not self.lowers:
            return pieces
        plain = pc.and_not(pc.string_is_ascii(pieces), pc.match_substring(pieces, "<|"))
        return pc.if_else(plain, pc.ascii_lower(pieces), pieces)

    def _ids_of(self, pieces: pa.Array) -> pa.Array:
        """The bytes of the ids of each piece."""
        coded = self._lowered(pieces).dictionary_encode()
        wanted = coded.dictionary
        # the few wanted pieces are hashed and the known ones looked up among them
        at = pc.index_in(self.known, value_set=wanted)
        seen = at.is_valid().to_numpy(zero_copy_only=False)
        number = np.full(len(wanted), -1, dtype=np.int64)
        number[at.drop_null().to_numpy()] = np.flatnonzero(seen)
        new = np.flatnonzero(number < 0)
        unknown = wanted.take(pa.array(new))
        if len(self.known) + len(new) > REMEMBERED or self.known.nbytes + unknown.nbytes > REMEMBERED_BYTES:
            self._forget()
            new, unknown = np.arange(len(wanted)), wanted
        if len(new):
            number[new] = len(self.known) + np.arange(len(new))
            self._learn(unknown)
        return self.ids.take(pa.array(number[coded.indices.to_numpy()]))

    def _pieces(self, block: TextBlock) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """(code of each piece of a block, the different pieces, place of each text's first piece and of the end)."""
        data = block.data
        starts, ends = find_words(data, _SPACE_OR_NEWLINE)
        if self.splits:
            # a full stop or comma after an ASCII letter, before a separator: a token of its own
            closing = np.flatnonzero(_IS_CLOSING[data[ends - 1]] & (ends - starts > 1))
            closing = closing[_IS_LETTER[data[ends[closing] - 2]]]
            cut = ends[closing] - 1
            starts, ends = np.sort(np.append(starts, cut)), np.sort(np.append(ends, cut))
        codes, pieces = encode_words(data, starts, ends)
        return codes, pieces, np.append(np.searchsorted(starts, block.starts), len(starts))

    def encode_blocks(self, blocks: list[TextBlock]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids of all texts of a block, number of ids of each) for each of some blocks, whose pieces are looked up at once."""
        split = [self._pieces(block) for block in blocks]
        known, begin = self._ids_of(pa.concat_arrays([pieces for _, pieces, _ in split])), 0
        for codes, pieces, first in split:
            _, ends, ids = known.slice(begin, len(pieces)).take(pa.array(codes)).buffers()
            begin += len(pieces)
            at = np.frombuffer(ends, dtype=np.int64)[first] // self.dtype.itemsize
            yield np.frombuffer(ids or b"", dtype=self.dtype)[: at[-1]], np.diff(at)

    def encode_column(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text; a long text is encoded in stretches."""
        for blocks in _grouped(text_blocks(texts)):
            if _is_long(blocks[0]):
                yield np.concatenate([ids for parts in _grouped(_cut(blocks[0])) for ids, _ in self.encode_blocks(parts)])
            else:
                for ids, sizes in self.encode_blocks(blocks):
                    yield from np.split(ids, np.cumsum(sizes)[:-1])

    def encode(self, texts: list[str]) -> list[bytes]:
        return [ids.tobytes() for ids in self.encode_column(pa.array(texts, type=pa.string()))]


def _is_long(block: TextBlock) -> bool:
    return len(block.starts) == 1 and len(block.data) > 2 * BLOCK_BYTES


def _grouped(blocks: Iterator[TextBlock]) -> Iterator[list[TextBlock]]:
    """Consecutive blocks of ``LOOKED_UP_AT_ONCE`` bytes or a little more; a long text stands alone."""
    group: list[TextBlock] = []
    for block in blocks:
        if group and (_is_long(block) or sum(len(b.data) for b in group) >= LOOKED_UP_AT_ONCE):
            yield group
            group = []
        group.append(block)
        if _is_long(block):
            yield group
            group = []
    if group:
        yield group


def _cut(block: TextBlock) -> Iterator[TextBlock]:
    """A long text in stretches that end where words do."""
    raw = block.data.tobytes()
    begin, size = 0, len(raw) - 1
    while begin < size:
        gap = _GAP.search(raw, begin + BLOCK_BYTES)
        end = min(gap.start() if gap else size, size)
        part = block.data[begin:end]
        yield TextBlock(0, 1, np.append(part, np.uint8(10)), np.zeros(1, np.int64), np.array([len(part)]))
        begin = end + 1


def file_schema(dtype: np.dtype, length: int) -> pa.Schema:
    return pa.schema(
        [
            ("input_ids", pa.list_(pa.from_numpy_dtype(dtype), length)),
            ("mask", pa.list_(pa.bool_(), length)),
            ("doc_start", pa.list_(pa.bool_(), length)),
            ("doc_ids", pa.list_(pa.int64())),
        ]
    )


class SequenceWriter:
    """Cuts documents into sequences and writes them batch by batch."""

    def __init__(self, sink, dtype: np.dtype, length: int, rows: int):
        self.schema, self.dtype, self.length, self.rows = file_schema(dtype, length), dtype, length, rows
        self.out = pa.ipc.new_stream(sink, self.schema)
        self.ids, self.size, self.starts, self.docs = [], 0, [], []
        self.n_tokens = self.n_docs = self.n_sequences = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.starts.append(self.size)
        self.docs.append(doc_id)
        self.ids.append(ids)
        self.size += len(ids)
        self.n_tokens += len(ids)
        self.n_docs += 1
        if self.size >= self.length * self.rows:
            self._write(self.size // (self.length * self.rows) * self.rows)

    def _write(self, n: int) -> None:
        """Write ``n`` sequences; what is left waits."""
        total = n * self.length
        held = np.concatenate(self.ids) if self.ids else np.zeros(0, self.dtype)
        real = min(total, len(held))
        ids, mask, first = np.zeros(total, self.dtype), np.zeros(total, bool), np.zeros(total, bool)
        ids[:real], mask[:real] = held[:real], True
        starts = np.array(self.starts, dtype=np.int64)
        now = int(np.searchsorted(starts, total))
        first[starts[:now]] = True
        cuts = np.searchsorted(starts[:now], np.arange(n + 1) * self.length).astype(np.int32)
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask, first)]
        columns.append(pa.ListArray.from_arrays(cuts, pa.array(self.docs[:now], type=pa.int64())))
        table = pa.RecordBatch.from_arrays(columns, schema=self.schema)
        for a in range(0, n, self.rows):
            self.out.write_batch(table.slice(a, self.rows))
        self.n_sequences += n
        self.ids, self.size = [held[real:]], len(held) - real
        self.starts, self.docs = (starts[now:] - total).tolist(), self.docs[now:]

    def close(self) -> None:
        if self.size:
            self._write(-(-self.size // self.length))
        self.out.close()


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, length: int = LENGTH) -> DataFrame:
    """Write the files below ``folder``; a row per file: shard, path, n_tokens, n_sequences,
    n_docs and ``start``, the ids in all files before."""
    tie = F.xxhash64("text")
    docs = documents_of(docs).repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)

    def run(batches):
        shard = TaskContext.get().partitionId()
        system, base = file_system(folder)
        encoder = Encoder.of_worker(tokenizer)
        end = np.array([end_id], dtype=encoder.dtype)
        name, part = f"{base}/tokens-{shard:06d}.arrow", f"{base}/.tokens-{shard:06d}.{uuid.uuid4().hex}"
        writer = sink = None
        for batch in batches:
            if writer is None:
                system.create_dir(base, recursive=True)
                sink = system.open_output_stream(part)
                writer = SequenceWriter(sink, encoder.dtype, length, BATCH)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode_column(batch.column("text"))):
                writer.add(doc_id, np.append(ids, end))
        if writer is not None:
            writer.close()
            sink.close()
            system.move(part, name)
            row = [[shard], [name if folder.startswith(("/", "file:")) else f"{folder}/{name.rpartition('/')[2]}"]]
            row += [[writer.n_tokens], [writer.n_sequences], [writer.n_docs]]
            pa.default_memory_pool().release_unused()  # the worker lives on: other tasks of the executor need the memory
            yield pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(row, _SHARDS)], schema=_SHARDS)

    shards = stage(docs.mapInArrow(run, spark_schema(_SHARDS)), "token-shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return shards.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _batches(path: str):
    """The batches of a file: memory-mapped where the file system is local."""
    system, name = file_system(path)
    source = pa.memory_map(name) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(name)
    with source, pa.ipc.open_stream(source) as stream:
        yield from stream


def flat(column: pa.FixedSizeListArray) -> pa.Array:
    """The values of all lists of a column, without a copy."""
    size = column.type.list_size
    return column.values.slice(column.offset * size, len(column) * size)


def read_documents(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the files."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                doc_ids, starts, crcs, crc, base = [], [], [], 0, row["start"]
                for part in _batches(row["path"]):
                    ids = flat(part.column("input_ids")).to_numpy(zero_copy_only=True)
                    real = int(flat(part.column("mask")).to_numpy(zero_copy_only=False).sum())
                    first = np.flatnonzero(flat(part.column("doc_start")).to_numpy(zero_copy_only=False))
                    doc_ids += part.column("doc_ids").flatten().to_pylist()
                    edges = [0, *first.tolist(), real]
                    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                        if k:  # a new document: the one before is complete
                            if starts:
                                crcs.append(crc)
                            crc = 0
                            starts.append(base + a)
                        crc = zlib.crc32(ids[a:b].astype("<u4").tobytes(), crc)
                    base += real
                if starts:
                    crcs.append(crc)
                sizes = np.diff(np.array([*starts, base], dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, type=f.type) for x, f in zip((doc_ids, starts, sizes, crcs), _DOCS)], schema=_DOCS
                )

    # a row is a whole file: a given number of partitions, so that few rows are not put into one task
    spread = shards.repartition(int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard")
    return spread.select("path", "start").mapInArrow(run, spark_schema(_DOCS))


class TokenFile:
    """Random access to the sequences of one file, as views of the mapped file."""

    def __init__(self, path: str):
        self.source = pa.memory_map(file_system(path)[1])
        self.batches = pa.ipc.open_stream(self.source).read_all().to_batches()
        self.rows = self.batches[0].num_rows if self.batches else 1

    def __len__(self) -> int:
        return sum(b.num_rows for b in self.batches)

    def _row(self, name: str, i: int) -> pa.Array:
        column = self.batches[i // self.rows].column(name)
        size = column.type.list_size
        return flat(column).slice(i % self.rows * size, size)

    def sequence(self, i: int) -> np.ndarray:
        return self._row("input_ids", i).to_numpy(zero_copy_only=True)

    def mask(self, i: int) -> pa.Array:
        return self._row("mask", i)


def tokenize(spark: SparkSession, docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Write ``docs`` as token files and return what ``read_documents`` finds in them."""
    return read_documents(write_token_files(docs, folder or scratch_dir(spark, "tokens"), tokenizer))
