"""Phrase mining: against a plain loop, with small chunks, blocks and shards."""

import re
from collections import Counter

import numpy as np
import pytest

from velostat.llm import phrases

SCHEMA = "doc_id bigint, text string, lang string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, max_words=3, min_count=10, max_rank=2000, nested=50):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, max_words + 1):
                f.update((lang, tuple(w[i : i + m])) for i in range(len(w) - m + 1))
    many = {k: c for k, c in f.items() if c >= min_count and len(k[1]) > 1}
    out = []
    for (lang, w), a in many.items():
        longer = (c for (x, v), c in many.items() if x == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v))))
        if any(100 * c >= nested * a for c in longer):
            continue
        cut = min((1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.append((lang, -cut[0], -a, " ".join(w).encode(), f[lang, w[: cut[1]]], f[lang, w[cut[1] :]], n[lang]))
    ranked = []
    for lang in {x[0] for x in out}:
        own = sorted(x for x in out if x[0] == lang)[:max_rank]
        ranked += [(lang, k, x[3].decode(), -x[2], x[4], x[5], x[6], -x[1]) for k, x in enumerate(own, 1)]
    return sorted(ranked)


def mined(docs, **options):
    return sorted(tuple(r) for r in phrases.collocations(docs, **options).collect())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    words = ["New", "york", "city", "é", "the", "日本", " x", "U.S", "a", "of", "\x85", "it's"]
    out = []
    for k in range(120):
        text = "".join(w + str(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r"])) for w in rng.choice(words, rng.integers(0, 60)))
        out.append((k, text + "new york city " * int(k % 3), [None, "en", "und", "de", "en"][k % 5]))
    return out + out[:20] + [(1, None, "en"), (1, "", "xx"), (None, "  ,.", None), (2, "rare words only", "rare")]


@pytest.mark.parametrize("options", [{}, {"max_words": 2}, {"max_words": 4, "min_count": 3, "nested_percent": 80}, {"min_count": 1, "max_rank": 50}])
def test_against_a_plain_loop(spark, rows, options):
    named = dict(zip(("max_words", "min_count", "max_rank", "nested"), [options.get(k, d) for k, d in (("max_words", 3), ("min_count", 10), ("max_rank", 2000), ("nested_percent", 50))]))
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as chunk", "2 as block", "3 as weight")
    assert mined(docs, **options) == brute(rows, **named)


def test_small_chunks_blocks_and_shards(spark, rows, monkeypatch):
    for name, value in (("STRETCH", 40), ("BLOCK_BYTES", 1), ("SHARD_ENTRIES", 50), ("LONGEST", 5), ("MODULUS", 2)):
        monkeypatch.setattr(phrases, name, value)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(8)
    assert mined(docs) == brute(rows)


def test_hashes_that_collide_change_nothing(spark, rows, monkeypatch):
    """All phrases of a length share a hash: only the exact count is left to tell them apart."""
    monkeypatch.setattr(phrases, "distinct_hashes", lambda words: np.zeros(len(words), dtype=np.uint64))
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_every_word_is_owned_once():
    rng = np.random.default_rng(5)
    for overlap in (1, 2, 3):
        texts = [" ".join(rng.choice(["aa", "b", "ccc", "d,e"], size)).encode() for size in (0, 1, 2, 3, 500, 40)]
        owned = Counter()
        for i, chunks, sizes in phrases.parse(texts, overlap):
            owned[i] += int(sizes.sum())
            for chunk, size in zip(chunks, sizes):
                assert size <= len(re.findall(r"[^\s,]+", chunk)) <= size + overlap
        assert [owned[i] for i in range(len(texts))] == [len(re.findall(rb"[^\s,]+", t)) for t in texts]


def test_long_and_hard_texts(spark, hard_docs, no_docs):
    long = "to be or not to be, " * 200_000  # 4 MB
    rows = [(1, long, "en"), (2, "word " * 60_000, "en")]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    hard = [(r.doc_id, r.text, r.lang) for r in hard_docs.collect()]
    assert mined(hard_docs, min_count=2) == brute(hard, min_count=2)
    assert phrases.collocations(no_docs).count() == 0


def test_products_beyond_64_bits(spark, monkeypatch):
    big = 4 * 10**14
    counts = [("en", "a", 1, big, 10**15), ("en", "b", 1, big + 1, 10**15), ("en", "a b", 2, big - 7, 10**15)]
    frame = spark.createDataFrame(counts, "lang string, phrase string, words int, f bigint, n bigint")
    monkeypatch.setattr(phrases, "phrase_counts", lambda *_: frame)
    assert phrases.collocations(None).first().score == 1_000_000 * (big - 7) ** 2 // (big * (big + 1))
