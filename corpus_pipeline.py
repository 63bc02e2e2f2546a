"""A corpus pipeline: language ID, near-dedup, decontamination, mixing, token files.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written as Parquet
and read again as the next one's documents.  All stages but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from velostat.llm import decontaminate, language, mixing, simhash, tokens
from velostat.llm.common import read_table, stage
from velostat.llm.queries import TOKENIZER
from velostat.session import configure_session


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known stay."""
    return language.drop_unidentified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; a row per document: doc_id, start, n_tokens, ids_crc32."""
    return tokens.tokenize(spark, docs, TOKENIZER)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]

# tokenization and 64-bit hashes cannot be written in SQL: tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure_session(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
