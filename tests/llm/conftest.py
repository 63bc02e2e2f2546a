import pytest

HARD_TEXTS = [
    (1, "the quick brown fox jumps over the lazy dog again and again until night falls"),
    (1, "the quick brown fox jumps over the lazy dog again and again until night falls"),  # repeated row
    (1, "another text under the same id"),
    (2, None),
    (3, ""),
    (4, " \n\t  "),
    (None, "a text without an id"),
    (None, None),
    (5, "Ünïcödé ça và — 日本語 テキスト 😀 " * 30),
    (6, "same line\n" * 40),
    (7, "word " * 20_000),
    (8, "THE QUICK BROWN FOX JUMPS OVER THE LAZY DOG AGAIN AND AGAIN UNTIL NIGHT FALLS"),
]


@pytest.fixture(scope="module")
def hard_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows and columns with clashing names."""
    rows = [(i, t, "en" if k % 3 else None, f"s{k % 2}" if k % 4 else None, k, "x", k) for k, (i, t) in enumerate(HARD_TEXTS)]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, _row string, key int"
    ).selectExpr("*", "'y' as fp", "1.5 as score", "array(1) as spans", "n_chars as n_words", "0 as copies", "'z' as _key")


@pytest.fixture(scope="module")
def no_docs(hard_docs):
    return hard_docs.where("false")
