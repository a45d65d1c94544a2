"""Corpus pipeline: from raw documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir), works on every row of docs and returns the documents it keeps, with the columns
of documents; the last returns the packed pieces. run() writes each stage's rows and reads them for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ligandry.llm import decontam, minhash, packing, quality, substring
from ligandry.llm.common import ROW, one_of_each, release, row_texts, scratch_tables, table, with_rows, without, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, each row by its own text.

    Null and empty texts get the labelled sample's share of label 1; without labels all rows stay. Repeated rows are judged
    alike, ties among neighbours vote all or none, very long texts are read in whole, an empty table stays empty, and other columns,
    whatever their names, pass unchanged.
    """
    return quality.good(docs, table(spark, sf_dir, "labels"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked at 0.8 on shingles of five words, directly or through others, the one with the smallest doc_id.

    Rows are judged one by one: of repeated rows one stays, rows with equal or null doc_id and different texts don't touch
    each other, and among equal doc_ids the first row of the table wins. Null and empty texts link with nothing and stay.
    Very long texts are compared in whole; an empty table stays empty; other columns pass unchanged.
    """
    rows = with_rows(docs)
    return one_of_each(rows, minhash.near_duplicates(row_texts(rows)))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 13 words or more that one with a smaller doc_id has too; a text may become empty.

    Null texts stay null; a row without doc_id stays whole; rows with equal doc_id don't cut each other; n_chars, where there is
    such a column, follows the text, and all other columns pass unchanged. An empty table stays empty.
    """
    return substring.without_repeats(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item, each row by its own text.

    Null and empty texts leak nothing; repeated rows go or stay together; an empty table, or an empty benchmark, changes
    nothing; very long texts are searched in whole; other columns pass unchanged.
    """
    rows = with_rows(docs)
    return without(rows, decontam.leaks(row_texts(rows), table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias(ROW)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences.

    A null or empty text is its end token; repeated rows and rows with equal or null doc_id are packed like any others; texts of
    more tokens are cut; an empty table gives no pieces; other columns are not read.
    """
    return packing.pack(docs)


STAGES = [("quality classifier", keep_good), ("near-dedup", keep_one_of_near_copies), ("substring dedup", cut_repeats), ("decontamination", drop_leaks), ("packing", pack)]
#: Learned scores, fuzzy candidates and token ids can't be had in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before = scratch_tables()
        out = written(stage(spark, docs, sf_dir), "stage")
        release(spark, before, keep=out)  # what the stage made on its way, and the stage before
        docs = out
    return STAGES[-1][1](spark, docs, sf_dir)
