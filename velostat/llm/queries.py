"""The registered queries of the operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velostat.llm import (
    chat,
    classifier,
    decontaminate,
    language,
    lines,
    merkle,
    mixing,
    phrases,
    quality_rules,
    simhash,
    substrings,
    suffixes,
    tokens,
)
from velostat.llm.common import read_table
from velostat.session import configure_session


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum in the token files written from the whole table."""
    return tokens.tokenize(spark, read_table(spark, sf_dir, "documents"), TOKENIZER)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that lie in a 100-byte string which starts earlier."""
    return suffixes.dedup_suffixes(read_table(spark, sf_dir, "documents")).drop("kept")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels that are not held out."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return classifier.classify(read_table(spark, sf_dir, "documents"), labels)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the log-likelihood verdict of every document; labelled good ones are the target."""
    trusted = read_table(spark, sf_dir, "labels").where("quality = 1")
    return quality_rules.score_quality(read_table(spark, sf_dir, "documents"), trusted)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page; the text model is fitted on documents."""
    rows = language.page_rows(read_table(spark, sf_dir, "pages"))
    found = language.identify(rows, read_table(spark, sf_dir, "documents").select("text", "lang"))
    return found.select(F.col("id").alias("page_id"), "host", "lang", "confidence", "text_lang")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken from every document by the mix of all sources."""
    return mixing.mixing_report(read_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a window of a benchmark item."""
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return decontaminate.find_contamination(docs, items).drop("key")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.fingerprint_report(read_table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeat a window of a document with a smaller id."""
    return substrings.dedup_substrings(read_table(spark, sf_dir, "documents")).drop("kept")


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one made of control strings, formatted and read back."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat.conversation_digests(chat.format_conversations(rows.unionByName(hard)))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten documents or more share."""
    return lines.dedup_lines(read_table(spark, sf_dir, "documents"), with_text=False)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, tree roots and proof of every document; a seventh is checked with another n_chars."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return merkle.merkle_manifest(read_table(spark, sf_dir, "documents"), tampered)


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of two and three words of every language."""
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


def _configured(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure_session(spark)
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


_ALL = (
    op1_token_output,
    op2_suffix_dedup,
    op3_quality_classifier,
    op4_quality_rules,
    op5_language_id,
    op6_mixing,
    op7_decontamination,
    op8_simhash,
    op9_substring_dedup,
    op10_chat_formatting,
    op11_line_dedup,
    op12_merkle_manifest,
    op13_phrase_mining,
)
LLM_QUERIES = {f.__name__: _configured(f) for f in _ALL}
