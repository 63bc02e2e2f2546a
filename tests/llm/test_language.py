"""Language ID: what the pipeline's stage keeps and drops."""

import numpy as np
import pytest

from velostat.llm import language

WORDS = {
    "en": "the of and to in is was that for with on as are this from which they water house people night street garden".split(),
    "de": "der die und das von ist nicht mit sich auch auf eine werden durch wasser haus leute nacht strasse garten schön über".split(),
}
FOREIGN = [
    "szybki brązowy lis przeskakuje nad leniwym psem podczas gdy rolnik patrzy z okna swojego domu na wsi",
    "быстрая коричневая лиса прыгает через ленивую собаку пока фермер смотрит из окна",
    "hızlı kahverengi tilki tembel köpeğin üzerinden atlarken çiftçi evinin penceresinden bakıyor",
]


def documents(spark, clean, planted):
    rows = [(k, t, lang, "s0", len(t)) for k, (t, lang) in enumerate(clean + planted)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def clean_texts(languages, rng, n=60):
    return [(" ".join(rng.choice(WORDS[x], int(rng.integers(4, 60)))), x) for x in languages for _ in range(n)]


@pytest.mark.parametrize("languages", [["en"], ["en", "de"]])
def test_gibberish_and_foreign_texts_go_and_clean_ones_stay(spark, languages):
    """Junk goes whether its own label is missing or claims a known language."""
    rng = np.random.default_rng(9)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    clean = clean_texts(languages, rng)
    junk = [" ".join("".join(rng.choice(letters, int(rng.integers(3, 9)))) for _ in range(n)) for n in (15, 40, 200)]
    planted = [(t, lang) for t in junk for lang in ("en", None)] + [(t, None) for t in FOREIGN]
    kept = {r.doc_id for r in language.drop_unidentified(documents(spark, clean, planted)).collect()}
    assert kept == set(range(len(clean)))


def test_labels_of_one_language_count_as_one(spark):
    rng = np.random.default_rng(10)
    clean = [(t, ("en", "en-US", "EN_gb")[k % 3]) for k, (t, _) in enumerate(clean_texts(["en"], rng, 90))]
    assert language.drop_unidentified(documents(spark, clean, [])).count() == len(clean)


def test_every_labelled_language_has_a_model(spark):
    """More languages than the 64 that were kept once; each is found again, the rarest too."""
    rng = np.random.default_rng(11)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    rows = []
    for k in range(70):
        words = ["".join(rng.choice(letters, 6)) for _ in range(12)]
        rows += [(" ".join(rng.choice(words, 30)), f"x{k:02d}") for _ in range(2 if k == 69 else 4)]
    texts = spark.createDataFrame([(i, i, t, lang) for i, (t, lang) in enumerate(rows)], "id bigint, key bigint, text string, lang string")
    none = [f"cast(null as string) as {c}" for c in ("host", "domain", "suffix", "declared")]
    found = language.identify(texts.selectExpr("id", "key", "text", *none), texts.select("text", "lang")).collect()
    assert [(r.id, r.lang) for r in sorted(found, key=lambda r: r.id)] == [(i, lang) for i, (_, lang) in enumerate(rows)]
    assert min(r.confidence for r in found) > 0.9


def test_sample_takes_the_smallest_hashes(spark):
    texts = spark.createDataFrame([(f"text number {k}", "en" if k % 3 else "de") for k in range(900)], "text string, lang string")
    model = language.fit(texts, 20)
    hashes = texts.selectExpr("lang", "xxhash64(text) as place").distinct().collect()
    for i, lang in enumerate(model.languages):
        want = sorted(r.place for r in hashes if r.lang == lang)[:20]
        assert sorted(p for p, at in model.held.items() if i in at) == want


def test_unlabelled_table_stays(spark):
    rng = np.random.default_rng(12)
    docs = documents(spark, [(t, None) for t, _ in clean_texts(["en"], rng, 20)], [("12 %% 34", None)])
    assert {r.doc_id for r in language.drop_unidentified(docs).collect()} == set(range(20))
