"""Phrase collocations by prefix-free parsing.

A text is cut at *triggers*: places where a hash of the next words is divisible by ``MODULUS``.
A chunk runs from one trigger over the ``max_words - 1`` words behind the next, so chunks
overlap and no phrase is cut; equal passages give equal chunks wherever they stand.  The
distinct chunks are the dictionary, their numbers in the parse its frequencies.  Phrases are
counted inside the distinct chunks, weighted with the frequency; a phrase belongs to the
chunk that owns its first word, so those in an overlap count once.

The dictionary is packed into blocks of about ``BLOCK_BYTES``.  Most phrases are rare, so
their texts are never shuffled: each block first sends the hashes and counts of its
phrases to shards of the hash space, packed; a shard adds them up and answers each block which of its
hashes reach ``min_count`` in sum; only phrases behind those hashes are counted by
their texts, exactly.  Two phrases that share a hash let a rare one through, which the exact count
drops.

Scores are whole numbers: products are taken as DECIMAL(38), which is exact as long as the most
frequent words stand fewer than 10**15 times.

Defined results: NULL or empty text has no words; NULL lang is ``und``; every row counts,
also rows that repeat or share a doc_id; a language without candidates gives no row, as does an
empty table; only lang and text are read, whatever else there is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velostat.llm.common import (
    LOWER,
    RollingHash,
    arrow_batch,
    byte_class,
    byte_values,
    distinct_hashes,
    encode_words,
    find_words,
    mix64,
    spark_schema,
    stage,
    text_or_empty,
    word_hashes,
)

MAX_WORDS = 3
MIN_COUNT = 10
MAX_RANK = 2000
NESTED_PERCENT = 50
MODULUS = 16
LONGEST = 4096  # words a chunk owns at most
STRETCH = 1 << 21  # bytes of one text parsed at a time
BLOCK_BYTES = 4 << 20
SHARD_ENTRIES = 1 << 20  # hashes meant for one shard
RANK_PARTS = 16  # parts of a language that are ranked side by side

PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_IN_WORD = byte_class(PIECE_ENDS + b"\x20\x09")
_ENDS = ~byte_class(PIECE_ENDS)
_NEXT_GAP = re.compile(rb"[\x20\x09-\x0d.,;:!?]")
_TURN = np.uint64(0x9E3779B97F4A7C15)
_SEED, _BASE = 13, 0xC2B2AE3D27D4EB4F

_CHUNKS = pa.schema([("lang", pa.string()), ("chunk", pa.string()), ("owned", pa.int64())])
_BLOCKS = pa.schema(
    [("block", pa.int64()), ("lang", pa.string()), ("chunk", pa.string()), ("owned", pa.int64()), ("weight", pa.int64())]
)
_SENT = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])
_ANSWERS = pa.schema([("block", pa.int64()), ("hashes", pa.binary())])
_PHRASES = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("f", pa.int64())])


def stretches(data: bytes, overlap: int) -> Iterator[tuple[bytes, int]]:
    """(bytes, how many of them are its own): a text in parts cut between words, each with the
    ``overlap`` words that follow it."""
    begin = 0
    behind = re.compile(rb"(?:[\x20\x09-\x0d.,;:!?]*[^\x20\x09-\x0d.,;:!?]+){0,%d}" % overlap)
    while len(data) - begin > STRETCH and (gap := _NEXT_GAP.search(data, begin + STRETCH)):
        end = gap.start()
        yield data[begin : behind.match(data, end).end()], end - begin
        begin = end
    yield data[begin:], len(data) - begin


def parse(texts: list[bytes], overlap: int) -> Iterator[tuple[int, list[str], np.ndarray]]:
    """(text, chunks, words owned by each) of each stretch of each text."""
    buffer, of = [], []
    for i, text in enumerate(texts):
        for part, own in stretches(text, overlap):
            buffer.append(part)
            of.append((i, own))
    group, size = [], 0
    for k, part in enumerate(buffer):  # small texts together
        group.append(k)
        size += len(part)
        if size >= STRETCH or k + 1 == len(buffer):
            yield from _parse_parts([buffer[j] for j in group], [of[j] for j in group], overlap)
            group, size = [], 0


def _parse_parts(parts: list[bytes], of: list[tuple[int, int]], overlap: int):
    joined = b"\n".join(parts) + b"\n"
    data = LOWER[np.frombuffer(joined, dtype=np.uint8)]
    starts, ends = find_words(data, _IN_WORD)
    if not len(starts):
        return
    h = word_hashes(data, starts, ends, byte_values(_SEED), RollingHash(_BASE))
    for k in range(1, overlap):  # of the first words from each place on
        h[:-k] = h[:-k] * _TURN + h[k:]
    triggers = mix64(h) % np.uint64(MODULUS) == 0
    lower = data.tobytes()
    begin = np.cumsum([0] + [len(p) + 1 for p in parts])
    first = np.searchsorted(starts, begin[:-1])
    last = np.searchsorted(starts, begin[1:])
    own = np.searchsorted(starts, begin[:-1] + np.array([o for _, o in of]))
    for (i, _), a, b, z in zip(of, first.tolist(), own.tolist(), last.tolist()):
        if a == b:
            continue
        cuts = a + 1 + np.flatnonzero(triggers[a + 1 : b])
        edges = np.concatenate([[a], cuts, [b]])
        if (np.diff(edges) > LONGEST).any():
            edges = np.concatenate([np.arange(x, y, LONGEST) for x, y in zip(edges[:-1], edges[1:])] + [[b]])
        stop = np.minimum(edges[1:] + overlap, z) - 1
        spans = zip(starts[edges[:-1]].tolist(), ends[stop].tolist())
        yield i, [lower[x:y].decode() for x, y in spans], np.diff(edges)


def dictionary(docs: DataFrame, max_words: int) -> DataFrame:
    """(block, lang, chunk, owned, weight): the distinct chunks and how often each stands in the parse."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_or_empty("text").alias("text"))
    overlap = max_words - 1

    def run(batches):
        for batch in batches:
            texts = [t.as_buffer().to_pybytes() for t in batch.column("text")]
            held = [], [], []
            for i, chunks, owned in parse(texts, overlap):
                held[0].append(np.full(len(chunks), i))
                held[1].extend(chunks)
                held[2].append(owned)
                if len(held[1]) >= 1 << 16:
                    yield _chunk_rows(batch, *held)
                    held = [], [], []
            if held[1]:
                yield _chunk_rows(batch, *held)

    chunks = rows.mapInArrow(run, spark_schema(_CHUNKS))
    counted = chunks.groupBy("lang", "chunk", "owned").agg(F.count(F.lit(1)).alias("weight"))

    def pack(batches):
        block, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            # a batch of Spark has 10,000 rows at most, a chunk LONGEST words: blocks end with batches
            size += batch.nbytes
            yield pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, block)), *batch.columns], schema=_BLOCKS)
            if size > BLOCK_BYTES:
                block, size = block + 1, 0

    return stage(counted.select(*_BLOCKS.names[1:]).mapInArrow(pack, spark_schema(_BLOCKS)), "phrase-dictionary")


def _chunk_rows(batch: pa.RecordBatch, owners, chunks, owned) -> pa.RecordBatch:
    lang = batch.column("lang").take(pa.array(np.concatenate(owners)))
    return pa.RecordBatch.from_arrays([lang.cast(pa.string()), pa.array(chunks, pa.string()), pa.array(np.concatenate(owned))], schema=_CHUNKS)


def _by_code(code: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places ``at`` in the order of their codes, and where a new code begins."""
    width = len(code).bit_length()
    own = code[at]
    if len(own) and int(own.max()) >> (62 - width) == 0:  # code and place fit into one number
        packed = np.sort(own << width | at)
        order, own = packed & ((1 << width) - 1), packed >> width
    else:
        order = np.argsort(own)
        order, own = at[order], own[order]
    return order, np.diff(own, prepend=-1) != 0


class BlockPhrases:
    """The distinct phrases of some chunks, by number of words: codes, counts and hashes."""

    def __init__(self, lang: pa.Array, chunk: pa.Array, owned: np.ndarray, weight: np.ndarray, max_words: int):
        langs = lang.dictionary_encode()
        self.langs = langs.dictionary
        joined = ("\n".join(chunk.to_pylist()) + "\n").encode()
        data = np.frombuffer(joined, dtype=np.uint8)
        starts, ends = find_words(data, _IN_WORD)
        codes, self.words = encode_words(data, starts, ends)
        sizes = pc.binary_length(chunk).to_numpy().astype(np.int64) + 1
        first = np.searchsorted(starts, np.cumsum(sizes) - sizes)
        counts = np.diff(np.append(first, len(starts)))
        row = np.repeat(np.arange(len(sizes), dtype=np.int32), counts)
        mine = np.arange(len(starts)) < (first + owned)[row]
        # words of one piece have as many ends of pieces before them; chunks are lines
        piece = np.cumsum(_ENDS[data], dtype=np.int32)[starts]
        del data, joined, starts, ends
        tongue = langs.indices.to_numpy()[row]
        word_h, lang_h = distinct_hashes(self.words), distinct_hashes(self.langs)
        # the code of a phrase is that of its first words and that of the last word
        self.levels = []
        code = tongue.astype(np.int64) * len(self.words) + codes
        for n in range(1, max_words + 1):
            if n > 1:
                code = code[:-1] * len(self.words) + codes[n - 1 :] if len(code) else code
            at = np.flatnonzero(mine[: len(code)] & (piece[: len(code)] == piece[n - 1 : n - 1 + len(code)]))
            order, new = _by_code(code, at)
            cut = np.flatnonzero(new)
            total = np.add.reduceat(weight[row[order]], cut) if len(cut) else np.zeros(0, np.int64)
            some = order[cut]  # a place where each distinct phrase starts
            h = lang_h[tongue[some]] + np.uint64(n)
            for k in range(n):
                h = mix64(h * _TURN + word_h[codes[some + k]])
            self.levels.append((some, total, h))
            # ranks as codes, so that the next level's products stay small
            code[:] = 0
            code[order] = np.cumsum(new)
        self.codes, self.tongue = codes, tongue

    def texts(self, n: int, places: np.ndarray) -> pa.Array:
        parts = [self.words.take(pa.array(self.codes[places + k])) for k in range(n)]
        return parts[0] if n == 1 else pc.binary_join_element_wise(*parts, " ")


def _blocks(batches, max_words: int) -> Iterator[tuple[int, BlockPhrases]]:
    """The phrases of each block in some batches (a block in two tasks is worked on in both)."""
    held: list[pa.RecordBatch] = []

    def done():
        table = pa.Table.from_batches(held).combine_chunks()
        column = lambda c: table.column(c).chunk(0)
        return BlockPhrases(column("lang"), column("chunk"), column("owned").to_numpy(), column("weight").to_numpy(), max_words)

    now = None
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        edges = np.append(np.flatnonzero(np.diff(blocks, prepend=-1)), len(blocks)).tolist()
        for a, b in zip(edges[:-1], edges[1:]):
            if held and blocks[a] != now:
                yield now, done()
                held = []
            now = int(blocks[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield now, done()


def _in_sorted(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _frequent_hashes(blocks: DataFrame, shards: int, min_count: int, max_words: int) -> DataFrame:
    """(block, hashes): of each block's phrases those whose hash reaches ``min_count`` over all blocks."""

    def send(batches):
        for block, found in _blocks(batches, max_words):
            h = np.concatenate([x[2] for x in found.levels])
            c = np.minimum(np.concatenate([x[1] for x in found.levels]), 255).astype(np.uint8)
            shard = (h >> np.uint64(32)).astype(np.int64) * shards >> 32
            order = np.argsort(h)  # shards are ranges of hashes
            h, c, shard = h[order], c[order], shard[order]
            edges = np.searchsorted(shard, np.arange(shards + 1))
            some = np.flatnonzero(np.diff(edges))
            yield arrow_batch(
                _SENT,
                some.astype(np.int32),
                np.full(len(some), block),
                [h[edges[s] : edges[s + 1]].tobytes() for s in some],
                [c[edges[s] : edges[s + 1]].tobytes() for s in some],
            )

    def add_up(rows: pd.DataFrame) -> pd.DataFrame:
        each = [np.frombuffer(x, dtype=np.uint64) for x in rows["hashes"]]
        h = np.concatenate(each)
        c = np.concatenate([np.frombuffer(x, dtype=np.uint8) for x in rows["counts"]])
        order = np.argsort(h)
        cut = np.flatnonzero(np.diff(h[order], prepend=h[order][0] + np.uint64(1)))
        many = h[order][cut][np.add.reduceat(c[order], cut, dtype=np.int64) >= min_count]
        own = [x[_in_sorted(x, many)].tobytes() for x in each]
        return pd.DataFrame({"block": rows["block"], "hashes": own})

    sent = blocks.mapInArrow(send, spark_schema(_SENT))
    return sent.groupBy("shard").applyInPandas(add_up, spark_schema(_ANSWERS))


def phrase_counts(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, phrase, words, f, n): phrases of up to ``max_words`` words that stand ``min_count`` times
    or more in their language, and the language's number of words."""
    blocks = dictionary(docs, max_words)
    entries = blocks.agg(F.sum("owned")).first()[0] or 0
    answers = stage(_frequent_hashes(blocks, 1 + max_words * entries // SHARD_ENTRIES, min_count, max_words), "phrase-answers")

    # a block's answers stand in front of its chunks
    text, number = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    fronts = answers.select("block", F.lit(0).alias("kind"), "hashes", text.alias("lang"), text.alias("chunk"), number.alias("owned"), number.alias("weight"))
    rows = blocks.select("block", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("hashes"), "lang", "chunk", "owned", "weight")
    met = fronts.union(rows).repartition("block").sortWithinPartitions("block", "kind")

    def count(batches):
        held: dict[int, list[np.ndarray]] = {}

        def chunks():
            for batch in batches:
                front = batch.column("kind").to_numpy() == 0
                for i in np.flatnonzero(front):
                    held.setdefault(batch.column("block")[i].as_py(), []).append(np.frombuffer(batch.column("hashes")[i].as_py(), dtype=np.uint64))
                rest = batch.filter(pa.array(~front))
                if rest.num_rows:
                    yield rest

        for block, found in _blocks(chunks(), max_words):
            known = np.sort(np.concatenate(held.pop(block, [np.zeros(0, np.uint64)])))
            for n, (some, total, h) in enumerate(found.levels, 1):
                use = _in_sorted(h, known)
                some, total = some[use], total[use]
                lang = found.langs.take(pa.array(found.tongue[some]))
                yield arrow_batch(_PHRASES, lang, found.texts(n, some), np.full(len(some), n, np.int32), total)

    exact = met.mapInArrow(count, spark_schema(_PHRASES)).groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
    sizes = blocks.groupBy("lang").agg(F.sum(F.col("owned") * F.col("weight")).alias("n"))
    return stage(exact.where(F.col("f") >= min_count).join(sizes, "lang"), "phrase-counts")


def _sub_phrase(first: int, length: int) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first + 1, length), " ")


def collocations(
    docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, max_rank: int = MAX_RANK, nested_percent: int = NESTED_PERCENT
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of two words or more of each language.

    ``a``, ``l`` and ``r`` are the counts of the phrase and of its parts at the cut with the lowest
    score, floor(1000000 a a / (l r)).  A phrase inside a longer one that has ``nested_percent``
    of its count or more is left out."""
    counts = phrase_counts(docs, max_words, min_count)
    parts = counts.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    phrases = counts.where("words > 1")

    # every cut of every phrase; a part stands wherever the phrase does, so it is counted too
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    split = F.split("phrase", " ")
    cuts = cuts.select(
        "lang",
        "phrase",
        F.col("f").alias("a"),
        "n",
        "k",
        F.array_join(F.slice(split, F.lit(1), F.col("k")), " ").alias("left_part"),
        F.array_join(F.slice(split, F.col("k") + 1, F.col("words")), " ").alias("right_part"),
    )
    cuts = cuts.join(parts.select("lang", F.col("part").alias("left_part"), F.col("part_f").alias("l")), ["lang", "left_part"])
    cuts = cuts.join(parts.select("lang", F.col("part").alias("right_part"), F.col("part_f").alias("r")), ["lang", "right_part"])
    score = F.expr("cast((cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0))) as bigint)")
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = [
        phrases.where(F.col("words") == n).select("lang", _sub_phrase(first, length).alias("phrase"), "f")
        for n in range(3, max_words + 1)
        for length in range(2, n)
        for first in range(n - length + 1)
    ]
    found = lowest
    if inner:
        longer = inner[0]
        for more in inner[1:]:
            longer = longer.union(more)
        longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
        found = lowest.join(longer, ["lang", "phrase"], "left").where(
            F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * nested_percent)
        )
    order = (F.desc("score"), F.desc("a"), "phrase")
    found = found.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)).alias("part"))
    # the best of parts of a language first, so that its one last task ranks RANK_PARTS * max_rank phrases at most
    best = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= max_rank)
    whole = Window.partitionBy("lang").orderBy(*order)
    ranked = best.withColumn("rank", F.row_number().over(whole).cast("bigint")).where(F.col("rank") <= max_rank)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
