"""Registered queries of the training-data operators and their DuckDB statements.

Each query applies one operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from headway.llm import (language, mixing, neighbours, packing, pii, preferences, quality_model, quality_rules,
                         simhash, spelling, stream_dedup, substrings, token_alignment)
from headway.llm.common import table
from headway.llm.oracle import EXACT_SQL, MIX_SQL, PREFERENCE_SQL


def op1_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicate(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


def op5_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.preference_report(table(spark, sf_dir, "conversations"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.neighbour_report(table(spark, sf_dir, "embeddings"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_report(table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_documents(table(spark, sf_dir, "documents"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_dedup.deduplicate(spark, f"{sf_dir.rstrip('/')}/documents.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_model": op1_quality_model,
        "op2_substrings": op2_substrings,
        "op3_pii": op3_pii,
        "op4_quality_rules": op4_quality_rules,
        "op5_preferences": op5_preferences,
        "op6_neighbours": op6_neighbours,
        "op7_packing": op7_packing,
        "op8_mixing": op8_mixing,
        "op9_simhash": op9_simhash,
        "op10_language": op10_language,
        "op11_spelling": op11_spelling,
        "op12_alignment": op12_alignment,
        "op13_exact_dedup": op13_exact_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_preferences": PREFERENCE_SQL, "op8_mixing": MIX_SQL, "op13_exact_dedup": EXACT_SQL}
