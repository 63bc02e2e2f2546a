"""Cases that earlier versions got wrong: each against the definition."""

import random
import tracemalloc
import unicodedata

import numpy as np
import pyarrow as pa
import pytest

from velostat.llm import decontaminate, language, quality_rules, simhash, substrings, tokens
from velostat.llm.common import text_blocks
from velostat.llm.queries import TOKENIZER

SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


def encoded(texts):
    encoder = tokens.Encoder(TOKENIZER)
    return [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)]


def test_every_letter_and_mark_before_a_stop(library):
    letters = [chr(c) for c in range(0x80, 0x30000) if unicodedata.category(chr(c))[0] in "LM"]
    texts = ["".join(f"a{x}. {x}b?, {x}, x{x}. " for x in letters[i : i + 50]) for i in range(0, len(letters), 50)]
    assert encoded(texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_random_texts_and_long_ones(library, monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice("aB.,'? \n\t<|>!9-é́İक़ΣÅ日‍") for _ in range(rng.randint(0, 14))) for _ in range(20_000)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert encoded(texts) == want
    monkeypatch.setattr(tokens, "REMEMBERED", 40)
    monkeypatch.setattr("velostat.llm.common.BLOCK_BYTES", 64)
    monkeypatch.setattr(tokens, "BLOCK_BYTES", 64)
    assert encoded(texts[:300]) == want[:300]
    long = "".join(f"Word{k}. Ünï, " for k in range(400))
    assert encoded([long]) == [library.encode(long, add_special_tokens=False).ids]


def test_ascii_words_are_learnt_once_beside_other_letters(library):
    texts = ["Été WORD Word word. É word,", "", None, "<|endoftext|>A a <|ENDOFTEXT|>"]
    encoder = tokens.Encoder(TOKENIZER)
    got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert len(encoder.known) == 8  # Été word . É , a and two with special strings


def test_pieces_of_many_blocks_are_looked_up_at_once(library, monkeypatch):
    texts = [" ".join(f"w{k * j % 97}x" for j in range(40)) for k in range(60)]
    calls, learn = [], tokens.Encoder._learn
    monkeypatch.setattr(tokens.Encoder, "_learn", lambda self, pieces: (calls.append(len(pieces)), learn(self, pieces))[1])
    monkeypatch.setattr(tokens, "text_blocks", lambda column: text_blocks(column, 256))
    assert encoded(texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert calls == [97]


def held_bytes():
    return tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes()


def test_remembered_pieces_take_little_memory(library, monkeypatch):
    words = [f"piece{k}" for k in range(50_000)]
    tracemalloc.start()
    try:
        encoder = tokens.Encoder(TOKENIZER)
        before = held_bytes()
        encoder.encode([" ".join(words)])
        assert held_bytes() - before < 80 * len(words)
    finally:
        tracemalloc.stop()
    # bytes are bounded, not only their number: few long pieces are forgotten too
    monkeypatch.setattr(tokens, "REMEMBERED_BYTES", 1 << 16)
    monkeypatch.setattr(tokens, "LOOKED_UP_AT_ONCE", 1)
    monkeypatch.setattr(tokens, "text_blocks", lambda column: text_blocks(column, 1 << 12))
    texts = [chr(0x4E00 + k) * 1000 for k in range(60)]
    encoder = tokens.Encoder(TOKENIZER)
    got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert encoder.known.nbytes <= 1 << 16


def test_scoring_the_language_of_many_texts_takes_little_memory(monkeypatch):
    """What is held at once does not grow with the texts of a batch, and the size of blocks changes no score."""
    rng = np.random.default_rng(3)
    n = 600
    texts = ["".join(chr(c) for c in rng.integers(97, 123, 10_000)) for _ in range(n)]
    ids, none = pa.array(range(n), type=pa.int64()), pa.array([None] * n, type=pa.string())
    batch = pa.RecordBatch.from_arrays([ids, ids, none, none, none, none, pa.array(texts), ids], names=[*language._KEPT, "text", "place"])
    model = language.Model(["a", "b"], rng.integers(1_000, 2_000, (2, language.BUCKETS)).astype(float), {5: [0], 7: [0, 1]})
    tracemalloc.start()
    try:
        found = pa.Table.from_batches(language._scored([batch], model))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 50_000_000
    monkeypatch.setattr(language, "SCORED_BYTES", 1 << 21)
    assert found.to_pylist() == pa.Table.from_batches(language._scored([batch], model)).to_pylist()


def test_words_that_polynomial_hashes_confuse(spark):
    """Thue-Morse words of 1,024 letters and their complements are different words."""
    bits = [bin(k).count("1") & 1 for k in range(1024)]
    word, other = "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
    shared = " ".join(f"w{k}" for k in range(49))
    docs = spark.createDataFrame([(1, f"{shared} {word}"), (2, f"{shared} {other}"), (3, f"{shared} {other}")], SCHEMA)
    got = {r.doc_id: r.n_removed for r in substrings.dedup_substrings(docs).collect()}
    assert got == {1: 0, 2: 0, 3: 50}


def test_component_is_the_smallest_id_that_can_be_reached(spark):
    a = "the river runs slowly through the old town and under seven stone bridges before it meets the sea"
    b = "a recipe for bread needs flour water salt and yeast and a good deal of patience in the kitchen"
    docs = spark.createDataFrame([(1, a), (1, b), (2, a), (3, b.upper()), (None, a), (None, "no id")], SCHEMA)
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.fingerprint_report(docs).collect())
    assert sorted((i, c) for i, _, c in got if i != "None") == [("1", 1), ("1", 1), ("2", 1), ("3", 1)]
    assert {c for i, _, c in got if i == "None"} == {1, None}


def test_items_without_an_id_hit(spark):
    text = "one two three four five six seven eight nine ten eleven"
    items = spark.createDataFrame([(None, text), (None, text), (4, "five six"), (5, text), (6, None)], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, text), (2, "x " + text.upper() + " y"), (3, "five, six"), (4, "one two")], SCHEMA)
    got = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in decontaminate.find_contamination(docs, items).collect()}
    assert got == {1: (11, 3, True), 2: (11, 3, True), 3: (2, 1, True), 4: (0, 0, False)}
    only = items.where("item_id is null")
    assert [r.doc_id for r in decontaminate.drop_contaminated(docs, only).collect()] == [3, 4]


@pytest.mark.parametrize("bits", [24, 6])
def test_rules_do_not_depend_on_the_join(spark, bits, monkeypatch):
    """With a full bitmap, and without broadcasts, the scores stay."""
    rng = np.random.default_rng(7)
    rows = [(int(k), " ".join(rng.choice(["a", "b", "c", "d"], 25))) for k in range(300)] + [(None, "a b"), (5, "a c"), (5, "a c")]
    docs, good = spark.createDataFrame(rows, SCHEMA), spark.range(0, 250, 2).withColumnRenamed("id", "doc_id")
    want = sorted((str(r.doc_id), r.n_words, r.score, r.kept) for r in quality_rules.score_quality(docs, good).collect())
    monkeypatch.setattr(quality_rules, "BITMAP_BITS", bits)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = sorted((str(r.doc_id), r.n_words, r.score, r.kept) for r in quality_rules.score_quality(docs, good).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == want


def test_one_passage_after_many_beginnings(spark):
    """Many contexts whose suffixes are equal from the anchor on."""
    from velostat.llm import suffixes

    from .test_edges import brute_suffixes

    rng = np.random.default_rng(9)
    passage = "".join(rng.choice(list("abcdefgh"), 60))
    texts = ["".join(rng.choice(list("xyz"), 50)) + passage + "".join(rng.choice(list("uvw"), 5)) for _ in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(4)
    got = {r.doc_id: (r.n_removed, r.kept_sha256) for r in suffixes.dedup_suffixes(docs, 24, 10).collect()}
    assert [got[i] for i in range(len(texts))] == brute_suffixes(texts, 24)
