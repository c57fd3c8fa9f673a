"""Corpus pipeline: the stages in order, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns documents in the columns of its input,
but for the last, which returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.decontam import decontaminate
from tidemark.llm.language import keep_identified
from tidemark.llm.lines import dedup_lines
from tidemark.llm.packing import pack_sequences
from tidemark.llm.simhash import drop_near_duplicates
from tidemark.llm.store import read_table, staged


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network tells from the second likeliest; null texts and those without letters go."""
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier passage; those left without a word go."""
    return dedup_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest doc_id."""
    return drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of benchmark items; those that are mostly passages go."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its sequence and its place there."""
    return pack_sequences(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("simhash_near_dedup", simhash_near_dedup),
          ("benchmark_decontamination", benchmark_decontamination), ("best_fit_packing", best_fit_packing)]

#: Language identification and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
