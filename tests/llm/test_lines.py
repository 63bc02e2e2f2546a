"""Line dedup: against a plain loop, with any number of shards, forwards and backwards."""

import hashlib

import numpy as np
import pytest

from velostat.llm import lines

SCHEMA = "doc_id bigint, text string"


def brute(rows, min_docs, min_chars=1):
    keys = [[x.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in (t or "").split("\n")] for _, t in rows]
    held = {}
    for own in keys:
        for k in set(own):
            held[k] = held.get(k, 0) + 1
    out = []
    for (i, t), own in zip(rows, keys):
        left = [x for x, k in zip((t or "").split("\n"), own) if len(k) < min_chars or held[k] < min_docs]
        text = "\n".join(left)
        out.append((str(i), len(own), len(own) - len(left), hashlib.sha256(text.encode()).hexdigest(), text))
    return sorted(out)


def found(frame):
    return sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256, r.kept) for r in frame.collect())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    kinds = ["Menu", " menu\t", "© all rights", "İ", "", "  ", "x\x0by", "a ", "\x85", "é É", "Share"]
    out = [(k, "\n".join(rng.choice(kinds + [f"own {k} {j}" for j in range(9)] + [f"some {rng.integers(9)}"], rng.integers(1, 30)))) for k in range(80)]
    return out + out[:6] + [(3, "Menu"), (None, "Share\nShare"), (None, None), (7, ""), (8, "\n\n"), (9, "\r\nmenu\r\n")]


@pytest.mark.parametrize("min_docs,min_chars", [(10, 1), (2, 1), (3, 4), (1, 1), (1000, 1)])
def test_against_a_plain_loop(spark, rows, min_docs, min_chars):
    docs = spark.createDataFrame(rows, SCHEMA)
    assert found(lines.dedup_lines(docs, min_docs, min_chars)) == brute(rows, min_docs, min_chars)


def test_filters_that_stay_in_their_shards(spark, rows, monkeypatch):
    """No broadcast filter, many shards, one hot key: the same rows."""
    monkeypatch.setattr(lines, "FILTER_BYTES", -1)
    monkeypatch.setattr(lines, "SHARD_KEYS", 4)
    monkeypatch.setattr(lines, "HOT_KEYS", 1)
    monkeypatch.setattr(lines, "FLUSH_KEYS", 5)
    docs = spark.createDataFrame(rows, SCHEMA)
    index = lines.LineIndex(spark, 2).insert(docs)
    assert index.shards > 4
    assert found(index.apply(docs)) == brute(rows, 2)


def test_insert_and_delete_are_inverse(spark, rows, monkeypatch):
    monkeypatch.setattr(lines, "SHARD_KEYS", 16)
    first, second = spark.createDataFrame(rows[:50], SCHEMA), spark.createDataFrame(rows[50:], SCHEMA)
    one = lines.LineIndex(spark, 5).insert(first)
    both = one.insert(second)
    assert found(both.apply(first.union(second))) == brute(rows, 5)
    assert found(one.apply(first)) == brute(rows[:50], 5)  # the older index still answers
    back = both.delete(second)
    assert found(back.apply(first)) == brute(rows[:50], 5)
    assert sorted(back.counts.collect()) == sorted(one.counts.collect())
    none = back.delete(first)
    assert none.counts.count() == none.members.count() == 0
    with pytest.raises(ValueError):
        back.delete(second)


def test_rare_keys_that_the_filter_takes_for_common(spark):
    """Same fingerprint and buckets, other key: listed as a miss, so never dropped."""
    index = lines.LineIndex(spark, 10)
    index.counts = spark.createDataFrame([(5, 7, 12), (5, 7 + (1 << 32), 2), (5 + (1 << 40), 7, 3), (6, 7, 1)], "h1 bigint, h2 bigint, n bigint")
    index._build(index.filters, index._all_common())
    row = index.filters.first()
    assert len(row.misses) == 2 * 16
    common = lines.Common.of(1, [(0, row.table, row.misses)])
    asked = np.array([[5, 7], [5, 7 + (1 << 32)], [5 + (1 << 40), 7], [6, 7]], dtype=np.uint64)
    assert common(asked).tolist() == [True, False, False, False]


def test_cuckoo_filter():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 1 << 64, (900, 2), dtype=np.uint64)
    table = lines.CuckooFilter.sized(512)
    assert table.table.size == 1024 and table.insert(h) and table.contains(h).all()
    assert table.contains(rng.integers(0, 1 << 64, (100_000, 2), dtype=np.uint64)).sum() < 10
    table.delete(h[:400])
    assert table.contains(h[400:]).all() and not table.contains(h[:400]).any()
    assert not table.insert(rng.integers(0, 1 << 64, (2_000, 2), dtype=np.uint64))


def test_a_full_filter_doubles_the_shards(spark, monkeypatch):
    rows = [(k, "\n".join(f"line {j}" for j in range(64))) for k in range(2)]
    docs = spark.createDataFrame(rows, SCHEMA)
    sized = lines.CuckooFilter.sized.__func__
    monkeypatch.setattr(lines.CuckooFilter, "sized", classmethod(lambda cls, keys: sized(cls, 8)))
    index = lines.LineIndex(spark, 2).insert(docs)
    assert index.shards > 1 and found(index.apply(docs)) == brute(rows, 2)


def test_long_texts_and_hard_rows(spark, hard_docs, no_docs, monkeypatch):
    text = "\n".join(f"line {k % 7_000}" for k in range(200_000))
    docs = spark.createDataFrame([(1, text), (2, "line 3\nmine"), (3, "w" * 3_000_000)], SCHEMA)
    assert found(lines.dedup_lines(docs, 2)) == brute([(1, text), (2, "line 3\nmine"), (3, "w" * 3_000_000)], 2)
    monkeypatch.setattr(lines, "STRETCH", 50)
    hard = [(r.doc_id, r.text) for r in hard_docs.collect()]
    assert found(lines.dedup_lines(hard_docs, 2)) == brute(hard, 2)
    assert lines.dedup_lines(no_docs).count() == 0
