"""Quality rules: simple counts, then a log-likelihood ratio of hashed n-grams
between a trusted target and the raw corpus (DataFrame functions only).

Words and pairs of neighbouring words are hashed into ``buckets``.  Two smoothed
multinomials over the buckets are fitted: one on every document, one on trusted
documents.  A document's score is the mean of log(target / raw) over its n-grams,
so that length does not matter, and every document is held against the same
threshold.

The raw counts cover all documents, the target all trusted ones.  The weights are one
array of ``buckets`` numbers, whatever the size of the corpus.  A bitmap of hashed ids, of fixed
size, keeps documents that are not trusted out of the join that finds the trusted ones; once the trusted
ids outnumber its flags it lets most of the others through, with the same result.

Defined results: NULL text counts as empty, no words: base_failed.  Rows with the
same doc_id are scored one by one; an empty table gives an empty one.  With no
trusted document at all the score is 0 for everyone, so the base rules decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velostat.llm.common import documents_of, trimmed, words

BUCKETS = 1 << 17
BITMAP_BITS = 24  # 16 million flags of trusted ids: 2 MB at any size
SMOOTHING = 1.0
THRESHOLD = -0.25
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
# symbols that prose rarely has
SYMBOLS = r"[#*$%&|<>]"


def _with_word_hashes(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_w", words(F.col("text"))).withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))


def _ngrams() -> Column:
    """Hashes of the words, then of each word with its successor (none after the last)."""
    following = F.slice("_h", F.lit(2), F.greatest(F.size("_h"), F.lit(1)))
    return F.concat("_h", F.zip_with("_h", following, lambda a, b: F.xxhash64(a, b)))


def _id_bitmap(ids: DataFrame) -> DataFrame:
    """One row with ``bits``: flags of the hashed doc_ids, 64 to a word, of one size always."""
    slot = _slot(F.col("doc_id"))
    words_of = ids.groupBy(F.shiftright(slot, 6).alias("_word")).agg(F.bit_or(_flag(slot)).alias("_bits"))
    every = ids.sparkSession.range(1 << (BITMAP_BITS - 6)).select(F.col("id").alias("_word")).join(words_of, "_word", "left")
    listed = every.agg(F.sort_array(F.collect_list(F.struct("_word", F.coalesce("_bits", F.lit(0)).alias("_bits")))).alias("_all"))
    return listed.select(F.transform("_all", lambda x: x["_bits"]).alias("bits"))


def _slot(doc_id: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(doc_id), 64 - BITMAP_BITS)


def _flag(slot: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(slot, F.lit(64)).cast("int"))


def flag_trusted(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``docs`` with ``_t``: 1 for a trusted document, 0 for any other.

    Only documents whose id the bitmap lets through go to the join, so that few texts of the
    others are shuffled.  The plan is the same at every size: the join is never a broadcast."""
    slot = _slot(F.col("doc_id"))
    word = F.get(_id_bitmap(trusted).scalar(), F.shiftright(slot, 6).cast("int"))
    maybe = F.coalesce(word.bitwiseAND(_flag(slot)) != 0, F.lit(False)) & F.col("doc_id").isNotNull()
    ids = trusted.select("doc_id", F.lit(1).alias("_t")).hint("merge")
    near = docs.where(maybe).join(ids, "doc_id", "left").select(*docs.columns, F.coalesce("_t", F.lit(0)).alias("_t"))
    return docs.where(~maybe).withColumn("_t", F.lit(0)).unionByName(near)


def ngram_weights(docs: DataFrame, trusted: DataFrame, buckets: int, smoothing: float) -> DataFrame:
    """One row with ``weights``: log(target / raw) of each bucket, as an array."""
    grams = _with_word_hashes(flag_trusted(docs, trusted)).select("_t", F.explode(_ngrams()).alias("_g"))
    counts = grams.groupBy(F.pmod("_g", F.lit(buckets)).alias("_b")).agg(
        F.count(F.lit(1)).alias("raw"), F.sum("_t").alias("target")
    )
    every = docs.sparkSession.range(buckets).select(F.col("id").alias("_b")).join(counts, "_b", "left")
    every = every.select("_b", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("target", F.lit(0)).alias("target"))
    listed = every.agg(
        F.sort_array(F.collect_list(F.struct("_b", "raw", "target"))).alias("_all"),
        (F.sum("raw") + F.lit(smoothing * buckets)).alias("_raw"),
        (F.sum("target") + F.lit(smoothing * buckets)).alias("_target"),
        F.sum("target").alias("_seen"),
    )
    ratio = lambda x: F.log(
        (x["target"] + F.lit(smoothing)) / F.col("_target") / ((x["raw"] + F.lit(smoothing)) / F.col("_raw"))
    )
    weight = lambda x: F.when(F.col("_seen") > 0, ratio(x)).otherwise(F.lit(0.0)).cast("float")
    return listed.select(F.transform("_all", weight).alias("weights"))


def _repeated_words() -> Column:
    """Words in windows of eight that occur twice or more in the text.

    ``_windows`` holds a hash per window.  Sorted with their positions, repeats
    are neighbours; each repeated window adds the words up to the next repeated
    one, eight at most."""
    covered = F.transform(
        "_again", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_again", i + 1), p + WINDOW) - p)
    )
    return F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, x: a + x)


def score_quality(
    docs: DataFrame,
    trusted: DataFrame,
    buckets: int = BUCKETS,
    smoothing: float = SMOOTHING,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id, the counts, base_failed, score and kept for each row of ``docs``.

    ``trusted`` has the doc_ids of good documents, which make up the target."""
    docs = documents_of(docs)
    ids = trusted.select(F.col("doc_id").cast("bigint")).where("doc_id is not null").distinct()
    weights = ngram_weights(docs, ids, buckets, smoothing).scalar()

    # one value for all rows; used once, so the optimizer puts it in place and no row carries it
    d = _with_word_hashes(docs).withColumn("_weights", weights)
    lines = F.filter(F.split("text", "\n"), lambda x: trimmed(x) != "")
    starts = F.when(F.size("_h") >= WINDOW, F.sequence(F.lit(1), F.size("_h") - (WINDOW - 1)))
    d = d.select(
        "doc_id",
        F.size("_w").cast("bigint").alias("n_words"),
        (F.length("text") - F.size(F.split("text", "[\\x20\\x09-\\x0D]")) + 1).cast("bigint").alias("word_chars"),
        (F.size(F.split("text", SYMBOLS)) - 1).cast("bigint").alias("n_symbols"),
        lines.alias("_lines"),
        F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda i: F.xxhash64(F.slice("_h", i, WINDOW))).alias(
            "_windows"
        ),
        F.aggregate(
            _ngrams(), F.lit(0.0), lambda a, g: a + F.get("_weights", F.pmod(g, F.lit(buckets)).cast("int")).cast("double")
        ).alias("_sum"),
    )
    unsorted = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    d = d.withColumn("_sorted", F.when(repeats, F.sort_array(unsorted)).otherwise(F.slice(unsorted, 1, 0)))
    same = lambda x, j: F.coalesce(F.get("_sorted", j)["h"] == x["h"], F.lit(False))
    again = F.filter("_sorted", lambda x, j: same(x, j - 1) | same(x, j + 1))
    d = d.withColumn("_again", F.sort_array(F.transform(again, lambda x: x["i"])))
    d = d.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        _repeated_words().alias("n_repeat_words"),
        F.coalesce(F.col("_sum") / F.nullif(F.col("n_words") * 2, F.lit(0)), F.lit(0.0)).alias("score"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return d.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= threshold))
