"""The documents table as training sequences: five operators, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm.exact_dedup import without_copies
from millrace.llm.langid import identified
from millrace.llm.packing import packed
from millrace.llm.simhash import without_near_copies
from millrace.llm.storage import dropped, stored, table
from millrace.llm.substrings import without_repeats

TOKENIZER = "word_bpe_49k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null texts, texts without letters) go."""
    return identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest id stays."""
    return without_copies(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked fingerprints the smallest id stays."""
    return without_near_copies(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that still occur more than once are cut out of the texts."""
    return without_repeats(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts' tokens as pieces of packed sequences."""
    return packed(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit_packing),
]

# Tokens are no SQL; tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each but the last written and read again; a table goes once the next one is there."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, stored(stage(spark, docs, sf_dir), "pipeline")
        if number:
            dropped(before)
    return STAGES[-1][1](spark, docs, sf_dir)
