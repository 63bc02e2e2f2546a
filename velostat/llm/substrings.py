"""Substring dedup: repeated windows of words, found by Rabin-Karp hashes.

A window is ``WINDOW`` consecutive words of one document.  Its hash comes from prefix
sums over the words' hashes (XXH3), in constant time, once for each of two independent word hashes; hashes are counted in Spark, and a
window that also starts in a document with a smaller id is removed.  Overlapping
windows merge into maximal intervals.  See ``repeats`` for how windows are grouped,
so that common passages and copies shuffle as few rows.

Defined results: NULL or empty text has no words; documents shorter than a window
lose nothing; rows with the same doc_id never remove words from each other, and
equal rows get equal results; NULL doc_id comes last; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velostat.llm.common import (
    SPACE_SEPARATED,
    RollingHash,
    TextBlock,
    distinct_hashes,
    encode_words,
    find_words,
    mix64,
    signed,
    spark_schema,
    stage,
    word_parts,
)
from velostat.llm.repeats import Tokens, keyed, repeated_spans, texts_with_regions, with_removals

WINDOW = 50
GRAM = 24

_BASE, _SECOND_BASE = 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
_WINDOWS = pa.schema(
    [("a", pa.int64()), ("c", pa.int64()), ("j", pa.int32()), ("w1", pa.int64()), ("w2", pa.int64()), ("d", pa.int64())]
)


def word_tokens(block) -> Tokens:
    starts, ends = find_words(block.data, SPACE_SEPARATED)
    codes, known = encode_words(block.data, starts, ends)
    hashes = distinct_hashes(known)[codes]
    first, last = np.searchsorted(starts, block.starts), np.searchsorted(starts, block.ends)
    return Tokens(hashes, np.repeat(np.arange(len(first)), last - first), first, last, _BASE)


def _stretches(window: int):
    """Very long texts in parts, each with the words before it; see ``repeats``."""

    def parts(block):
        before = 0
        for part, own in word_parts(block, SPACE_SEPARATED, window - 1):
            yield before, part
            before += 0 if part is block else _words_in(part, own)

    return parts


def _words_in(part: TextBlock, own: int) -> int:
    """Words that start in the first ``own`` bytes."""
    return int(np.searchsorted(find_words(part.data, SPACE_SEPARATED)[0], own))


def _whole(text) -> TextBlock:
    data = np.append(np.frombuffer(text, dtype=np.uint8), np.uint8(10))
    return TextBlock(0, 1, data, np.zeros(1, np.int64), np.array([len(data) - 1]))


def _window_hashes(window: int):
    """Step 4: Rabin-Karp hashes of all windows of the regions, counted in Spark."""

    def run(batches):
        for batch in batches:
            for d, _, text, (a, c, lo, n, _) in texts_with_regions(batch):
                before = 0
                # a region has fewer windows than a window has words
                for part, own in word_parts(_whole(text), SPACE_SEPARATED, 2 * window):
                    starts, ends = find_words(part.data, SPACE_SEPARATED)
                    mine = np.flatnonzero((lo >= before) & (lo < before + np.searchsorted(starts, own)))
                    if len(mine):
                        codes, known = encode_words(part.data, starts, ends)
                        which = np.repeat(mine, n[mine])
                        j = np.arange(len(which)) - np.repeat(np.cumsum(n[mine]) - n[mine], n[mine])
                        at = lo[which] + j - before
                        columns = []
                        for seed, base in enumerate((_BASE, _SECOND_BASE)):
                            rolling, hashes = RollingHash(base), distinct_hashes(known, seed)[codes]
                            columns.append(signed(mix64(rolling.spans(rolling.prefix(hashes), at, at + window))))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(a[which]), pa.array(c[which]), pa.array(j.astype(np.int32))]
                            + [pa.array(x) for x in columns]
                            + [pa.array(np.full(len(which), d, dtype=np.int64))],
                            schema=_WINDOWS,
                        )
                    before += int(np.searchsorted(starts, own))

    def compare(texts: DataFrame) -> DataFrame:
        windows = stage(texts.mapInArrow(run, spark_schema(_WINDOWS)), "word-windows")
        least = windows.groupBy("w1", "w2").agg(F.min("d").alias("_least"), F.max("d").alias("_most"))
        least = least.where("_least < _most").select("w1", "w2", "_least")
        return windows.join(least, ["w1", "w2"]).where("d > _least").select("a", "c", "j")

    return compare


def removal_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(d, key, spans) of the documents (as given by ``keyed``) that lose words."""
    return repeated_spans(docs, word_tokens, _window_hashes(window), window, gram, other_document=True, parts=_stretches(window))


def dedup_substrings(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by spaces) and its SHA-256."""
    docs = keyed(docs)
    fields = pa.schema(
        [("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("kept_sha256", pa.string())]
    )

    def digest(text: memoryview, spans: np.ndarray):
        total = removed = 0
        sha, kept = hashlib.sha256(), []
        for part, _ in word_parts(_whole(text), SPACE_SEPARATED, 0):
            starts, ends = find_words(part.data, SPACE_SEPARATED)
            stay = np.ones(len(starts), dtype=bool)
            if len(spans):
                place = total + np.arange(len(starts))
                at = np.searchsorted(spans[:, 0], place, side="right") - 1
                stay = (at < 0) | (place >= spans[np.maximum(at, 0), 1])
            total += len(starts)
            removed += int(len(starts) - stay.sum())
            # the kept words, each with the separator after it turned into a space
            inside = np.zeros(len(part.data) + 1, dtype=np.int8)
            inside[starts[stay]] = 1
            inside[ends[stay] + 1] -= 1
            space = part.data.copy()
            space[ends] = 32
            words = space[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)].tobytes()[:-1]
            if words:
                words = b" " * bool(kept) + words
                sha.update(words)
                kept.append(words)
        return total, removed, b"".join(kept).decode(), sha.hexdigest()

    return with_removals(docs, removal_spans(docs, window, gram), fields, digest)
