"""Registered queries of this subpackage: each operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.attribution import token_counts
from tidemark.llm.decontam import window_report
from tidemark.llm.divergence import source_divergence
from tidemark.llm.language import identify
from tidemark.llm.licences import scan_licences
from tidemark.llm.lines import line_report
from tidemark.llm.oracle import ORACLE_SQL
from tidemark.llm.packing import pack_sequences
from tidemark.llm.pages import extract_text
from tidemark.llm.quality import judge_documents
from tidemark.llm.simhash import near_duplicate_groups
from tidemark.llm.store import read_table
from tidemark.llm.substrings import repeated_words
from tidemark.llm.variants import spelling_variants
from tidemark.llm.warc import archive_round_trip

__all__ = ["ORACLE_SQL", "QUERIES"]


def op1_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_sequences(read_table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_words(read_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(read_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(read_table(spark, sf_dir, "documents")).drop("host_rate")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(read_table(spark, sf_dir, "pages"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(read_table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read_table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(read_table(spark, sf_dir, "documents"))


def op11_extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read_table(spark, sf_dir, "pages"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read_table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pack_sequences": op1_pack_sequences,
    "op2_decontaminate": op2_decontaminate,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_warc": op6_warc,
    "op7_license_scan": op7_license_scan,
    "op8_language_id": op8_language_id,
    "op9_token_counts": op9_token_counts,
    "op10_simhash": op10_simhash,
    "op11_extract_text": op11_extract_text,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_source_divergence": op13_source_divergence,
}
