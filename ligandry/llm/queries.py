"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, fingerprint, huffman, licenses, lm, minhash, packing, quality, substring, urls
from .common import table


def op1_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score; null texts, ties, repeated rows, empty tables: see quality.classify()."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict; null urls, ties, repeated rows, empty tables: see urls.judge()."""
    return urls.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against its edited copy and its neighbour; null texts and ids, equal ids: see fingerprint.compare_edited()."""
    return fingerprint.compare_edited(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without repeated passages; null texts and ids, equal ids: see substring.remove_repeats()."""
    kept = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op5_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written and read back; null texts and ids, equal ids: see huffman.write_tokens()."""
    return huffman.round_trip(table(spark, sf_dir, "documents"), with_ids=False)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's licence labels; null texts, repeated rows, long texts: see licenses.scan()."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log probabilities; null texts and ids, repeated rows, long texts: see lm.score()."""
    return lm.score(table(spark, sf_dir, "documents"))


def op8_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate component; null texts and ids, equal ids: see minhash.near_duplicates()."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences; null texts and ids, equal ids: see packing.pack()."""
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leak of a benchmark item in a document; null texts, ties, equal items: see decontam.leaks()."""
    found = decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", "n_tiles", "n_covered")


QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("op") and callable(f)}
ORACLE_SQL: dict[str, str] = {"op2_url_rules": urls.oracle_sql(), "op6_license_scan": licenses.oracle_sql()}
