"""Queries of the corpus operators over the given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from botlens.llm import (
    bpe,
    decontaminate,
    hard_negatives,
    lexical,
    licenses,
    line_dedup,
    near_dedup,
    oracles,
    pii,
    quality_pu,
    quality_rules,
    suffix_dedup,
    token_counts,
    warc,
)
from botlens.llm.common import table, tokenizer_file


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measured(table(spark, sf_dir, "documents"))


def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def round_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trips(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_verdicts(table(spark, sf_dir, "documents"))


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.written_and_read(table(spark, sf_dir, "pages"))


def unigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_pu.scored(docs, quality_pu.trained(docs, table(spark, sf_dir, "labels")))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removals(table(spark, sf_dir, "documents"))


def mined_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def ranked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(lexical.build(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": personal_data,
    "op2_licenses": license_scan,
    "op3_decontamination": contamination,
    "op4_warc": archives,
    "op5_bpe": round_trips,
    "op6_line_dedup": lines,
    "op7_quality_rules": quality,
    "op8_token_counts": unigram_counts,
    "op9_quality_classifier": quality_scores,
    "op10_near_dedup": near_duplicates,
    "op11_suffix_dedup": repeated_bytes,
    "op12_hard_negatives": mined_negatives,
    "op13_lexical_search": ranked_documents,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = dict(oracles.ORACLES)
