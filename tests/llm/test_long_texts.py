"""Very long texts are worked on in parts: the same results, and bounded memory in the worker."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from velostat.llm import classifier, common, decontaminate, language, repeats, simhash, substrings

SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(11)
    words = ["Alpha", "beta", "ünï", "d,e", "x" * 40, "日本", "Omega9"]
    made = [" ".join(rng.choice(words, n)) + str(rng.choice(["", "\n", "  "])) for n in (0, 3, 60, 200, 400)]
    made.append(made[4][300:1500] + "\n\t " + made[3])
    return list(enumerate(made)) + [(9, "y" * 900), (10, "two words")]


@pytest.fixture
def small_parts(monkeypatch):
    for module in (common, repeats):
        monkeypatch.setattr(module, "BLOCK_BYTES", 120)


def test_parts_own_every_word_once(texts, small_parts):
    for _, text in texts:
        block = next(common.text_blocks(pa.array([text])))
        for overlap in (0, 3):
            parts = list(common.word_parts(block, common.SPACE_SEPARATED, overlap))
            own = [part.data[:n].tobytes() for part, n in parts]
            assert b"".join(own) == text.encode()
            assert sum(len(o.split()) for o in own) == len(text.encode().split())
            for (part, n), following in zip(parts[:-1], range(1, len(parts))):
                rest = b"".join(own[following:]).split()[:overlap]
                assert part.data[n:].tobytes().split() == rest


@pytest.mark.parametrize("name", ["simhash", "substrings", "decontaminate"])
def test_the_same_rows_in_parts(spark, texts, name, monkeypatch):
    docs = spark.createDataFrame(texts, SCHEMA).coalesce(1)
    items = spark.createDataFrame([(1, texts[4][1][200:420]), (2, texts[3][1][:80]), (3, "two words")], "item_id bigint, text string")
    run = {
        "simhash": lambda: simhash.fingerprint_report(docs),
        "substrings": lambda: substrings.dedup_substrings(docs, 12, 5),
        "decontaminate": lambda: decontaminate.find_contamination(docs, items),
    }[name]
    want = sorted(run().collect())
    for module in (common, repeats):
        monkeypatch.setattr(module, "BLOCK_BYTES", 120)
    assert sorted(run().collect()) == want


def test_features_and_trigrams_in_parts(texts, monkeypatch):
    for _, text in texts + [(1, "a b c a b c " * 90)]:
        block = next(common.text_blocks(pa.array([text])))
        counts = lambda: [np.stack(f(block)).tolist() for f in (lambda b: classifier.feature_counts(b, 1 << 17), language._text_counts)]
        want = counts()
        with monkeypatch.context() as m:
            for module in (common, repeats):
                m.setattr(module, "BLOCK_BYTES", 120)
            assert counts() == want


@pytest.mark.parametrize("name", ["score", "identify"])
def test_the_same_scores_in_parts(spark, texts, name, monkeypatch):
    docs = spark.createDataFrame([(i, t, "ab"[i % 2], "s") for i, t in texts], "doc_id bigint, text string, lang string, source string").coalesce(1)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in texts], "doc_id bigint, label int")
    run = {
        "score": lambda: classifier.score(docs, classifier.fit(docs, labels)),
        "identify": lambda: language.identify(language.document_rows(docs), docs.select("text", "lang")).select("id", "confidence"),
    }[name]
    want = sorted(tuple(r) for r in run().collect())
    for module in (common, repeats):
        monkeypatch.setattr(module, "BLOCK_BYTES", 120)
    got = sorted(tuple(r) for r in run().collect())
    assert [g[0] for g in got] == [x[0] for x in want] and np.allclose([g[1] for g in got], [x[1] for x in want], atol=1e-6)


def test_memory_of_a_long_text():
    """16 MB in one text: the kernels take less than six times a part's usual memory, whatever the text's length."""
    text = ("the river runs slowly through the old town " * 400_000)[: 16 << 20]
    block = next(common.text_blocks(pa.array([text])))
    for work in (
        lambda: simhash.block_fingerprints(block, 4),
        lambda: [substrings.word_tokens(part).contexts(50, 24) for _, part in substrings._stretches(50)(block)][:0],
        lambda: classifier.feature_counts(block, 1 << 17),
        lambda: language._text_counts(block),
        lambda: [decontaminate._BlockWords(part).windows(10, 4) for part, _ in common.word_parts(block, decontaminate._IN_WORD, 9)][:0],
    ):
        tracemalloc.start()
        work()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 400 << 20
