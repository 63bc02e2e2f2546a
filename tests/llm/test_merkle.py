"""Merkle manifest: against a plain tree, with bundles of any height."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from velostat.llm import merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(digests):
    """The root, and for every digest the siblings on its way: (side, digest) or None."""
    paths = [[] for _ in digests]
    groups = [[k] for k in range(len(digests))]
    while len(digests) > 1:
        parents, merged = [], []
        for k in range(0, len(digests), 2):
            pair = digests[k : k + 2]
            for side, own in enumerate(groups[k : k + 2]):
                for leaf in own:
                    paths[leaf].append(None if len(pair) == 1 else ("R" if side == 0 else "L", pair[1 - side]))
            parents.append(H(*pair))
            merged.append(sum(groups[k : k + 2], []))
        digests, groups = parents, merged
    return digests[0], paths


def brute(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, n: H(*[field(v) for v in (r[0], r[1], r[2], n, r[4])])
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted(((r[0] is not None, r[0] or 0, leaf(r, r[3]), r) for r in rows if r[2] == lang), key=lambda x: x[:3])
        trees[lang] = own, *tree([x[2] for x in own])
    root, above = tree([trees[lang][1] for lang in langs])
    out = []
    for lang, up in zip(langs, above):
        own, subroot, paths = trees[lang]
        for (_, _, d, r), path in zip(own, paths):
            steps = path + up
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            end = leaf(r, None if r[3] is None else r[3] + 1) if tampered else d
            for s in steps:
                end = H(end) if s is None else H(s[1], end) if s[0] == "L" else H(end, s[1])
            out.append((str(r[0]), d, subroot, root, H(*[s[1] for s in steps if s]), end, end == root))
    return sorted(out)


def manifest(docs):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return sorted((str(r[0]), *r[1:]) for r in merkle.merkle_manifest(docs, tampered).collect())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    out = [(int(k), f"s{k % 3}", str(rng.choice(["en", "de", "é", "EN", ""], p=[0.6, 0.2, 0.1, 0.05, 0.05])), int(k % 50), "text " * (k % 4)) for k in rng.permutation(400)]
    out += [(7, None, None, None, None), (None, "s", "en", 3, ""), (7, "s", None, 1, "日本語"), (5, "a", "one", 2, "lone leaf")]
    return out + out[:3] + [(None, None, None, None, None)] * 2


@pytest.mark.parametrize("levels", [1, 3, 10])
def test_against_a_plain_tree(spark, rows, levels, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as tree", "'x' as digest", "2 as place", "3 as total")
    got, want = manifest(docs), brute(rows)
    assert got == want
    assert {g[-1] for g in got} == {True, False}


def test_one_language_one_row_and_none(spark, hard_docs, no_docs):
    one = [(1, "s", "en", 4, "text")]
    got = manifest(spark.createDataFrame(one, SCHEMA))
    assert got == brute(one) and got[0][1] == got[0][2] == got[0][3]
    two = [(k, "s", "en", 4, "text") for k in range(5)]
    assert manifest(spark.createDataFrame(two, SCHEMA)) == brute(two)
    assert manifest(hard_docs) == brute([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in hard_docs.collect()])
    assert merkle.merkle_manifest(no_docs).count() == 0


def test_nothing_tampered_all_verified(spark, rows):
    assert all(r.verified for r in merkle.merkle_manifest(spark.createDataFrame(rows, SCHEMA)).collect())


def test_sweeps_follow_the_labels():
    digests = [H(str(k)) for k in range(7)]
    labels = [(level, place) for level, place, _ in merkle.forward(digests, 3)]
    assert labels == sorted(labels) and labels[-1] == (3, 0)
    root, paths = tree(digests)
    for place, path in merkle.backward(digests, 3, ""):
        assert merkle.fold(digests[place], path) == root
        assert [x for x in merkle.steps(path)] == [("-", "") if s is None else s for s in paths[place]]
