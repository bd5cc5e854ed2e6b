"""Driver queries of this package: thin wrappers that apply each operator to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from verdure.llm import (
    code_compression,
    decontamination,
    fill_in_middle,
    near_duplicates,
    nearest,
    packing,
    personal_data,
    quality,
    quality_rules,
    statements,
    substrings,
    token_counts,
    toxicity,
    warc,
)
from verdure.sources.lineage import checkpoint_folder

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.contamination(
        table(spark, sf, "documents"), table(spark, sf, "benchmark")
    )


def _packing(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, sf, "documents"), path)


def _nearest(spark: SparkSession, sf: str) -> DataFrame:
    return nearest.neighbours_of_every_twentieth(table(spark, sf, "embeddings"))


def _token_counts(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_counts.edited_counts(
        table(spark, sf, "documents"), path, public_tokenizers.PATTERN
    )


def _archives(spark: SparkSession, sf: str) -> DataFrame:
    folder = f"{checkpoint_folder(spark)}/verdure-{uuid.uuid4().hex}"
    return warc.archive_report(table(spark, sf, "pages"), folder)


def _quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_report(table(spark, sf, "documents"), table(spark, sf, "labels"))


def _personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return personal_data.personal_data_report(table(spark, sf, "documents"))


def _substrings(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf, "documents"))


def _near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates.duplicate_report(table(spark, sf, "documents"))


def _toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf, "documents"), table(spark, sf, "labels"))


def _fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    return fill_in_middle.fill_in_middle_report(table(spark, sf, "documents"))


def _codes(spark: SparkSession, sf: str) -> DataFrame:
    return code_compression.code_report(table(spark, sf, "embeddings"))


def _rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.rules_report(table(spark, sf, "documents"), table(spark, sf, "labels"))


def queries() -> dict[str, Query]:
    return {
        "op1_best_fit_packing": _packing,
        "op2_nearest_neighbours": _nearest,
        "op3_substring_dedup": _substrings,
        "op4_token_counts": _token_counts,
        "op5_near_duplicates": _near_duplicates,
        "op6_toxicity": _toxicity,
        "op7_decontamination": _decontamination,
        "op8_personal_data": _personal_data,
        "op9_warc": _archives,
        "op10_quality": _quality,
        "op11_fill_in_middle": _fill_in_middle,
        "op12_code_compression": _codes,
        "op13_quality_rules": _rules,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return statements.statements()
