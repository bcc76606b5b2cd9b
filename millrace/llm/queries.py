"""The numbered operators as queries over whole tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.bpe import round_trip_digests
from millrace.llm.centroids import cluster_report
from millrace.llm.embeddings import near_duplicate_vectors
from millrace.llm.exact_dedup import exact_groups
from millrace.llm.langid import languages
from millrace.llm.licenses import license_scan
from millrace.llm.packing import packed
from millrace.llm.quality import quality
from millrace.llm.runs import periodic_runs, run_lines, strongest, words_of
from millrace.llm.simhash import simhash_groups
from millrace.llm.storage import table
from millrace.llm.substrings import repeats_removed
from millrace.llm.toxicity import toxicity
from millrace.llm.urls import ALLOW, BLOCK, Rule, url_verdicts

TOKENIZER = "word_bpe_49k.json"

# The rules that pages are judged by.
URL_RULES = (Rule(ALLOW, "com", "/"), Rule(BLOCK, "example.com", "/en/"), Rule(ALLOW, "www.example.com", "/en/"),
             Rule(BLOCK, "net", "/es/"), Rule(BLOCK, "net", "/fr/"))


def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document: four-word shingles, at most four differing bits."""
    return simhash_groups(table(spark, folder, "documents"))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    return quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of every document lie in repeated windows of 35, and a digest of the others."""
    return repeats_removed(table(spark, folder, "documents")) \
        .select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and labels of every document."""
    return license_scan(table(spark, folder, "documents")).drop("spans")


def op5_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links and component of every vector at a cosine of 0.95."""
    return near_duplicate_vectors(table(spark, folder, "embeddings"))


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The row that stays for every document."""
    return exact_groups(table(spark, folder, "documents"))


def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """The place of every document's tokens in sequences of 4096."""
    return packed(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels")).drop("hits")


def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every document's ids and of the text they decode to."""
    return round_trip_digests(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document."""
    return languages(table(spark, folder, "documents"))


def planted_words(key: int | None, text: str | None) -> list[str]:
    """A text's words; in a tenth of the ids, by crc32, they repeat with a period from some word on."""
    words = words_of(key, text)
    code = zlib.crc32(str(key).encode())
    if key is None or code % 10 or not words:
        return words
    size, seed = len(words), code // 10
    begin = seed % size
    period = 1 + (size - begin) // (3 + seed % 8)
    return words[:begin] + [words[begin + i % period] for i in range(size - begin)]


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of every document's words, the strongest of them, and a digest of the text without repetitions."""
    found = periodic_runs(table(spark, folder, "documents"), words=planted_words)
    best = found.withColumn("best", strongest())
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.expr("best.length * 1000 div best.period")).alias("exponent_milli"),
        F.sha2(run_lines(), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Cluster and distance of every vector after three rounds from 16 hashed centroids."""
    return cluster_report(table(spark, folder, "embeddings"))


def op13_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path, longest rule and verdict of every page."""
    return url_verdicts(table(spark, folder, "pages"), URL_RULES)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (op1_simhash_near_dedup, op2_quality, op3_substring_dedup, op4_license_scan,
                  op5_embedding_near_dedup, op6_exact_dedup, op7_best_fit_packing, op8_toxicity, op9_bpe, op10_language_id,
                  op11_periodic_runs, op12_centroid_clusters, op13_url_filter)
}
