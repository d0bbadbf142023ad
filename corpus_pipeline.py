"""Corpus pipeline: documents in, packed training sequences out.

Every stage is one operator of ``headway.llm``; it takes ``(spark, docs, sf_dir)`` and returns a
DataFrame that is written as Parquet and read again as the next stage's input.  All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headway.llm import mixing, packing, pii, quality_rules, simhash
from headway.llm.common import prepare, stored, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-supervision rules reject go."""
    prepare(spark)
    return quality_rules.filter_documents(docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    prepare(spark)
    return simhash.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes ``[EMAIL]``, ``[IP]``, ``[CARD]`` or ``[PHONE]``."""
    prepare(spark)
    return pii.mask(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their targets."""
    prepare(spark)
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents placed in sequences of at most 2048 tokens."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", keep_quality),
    ("simhash_near_dedup", keep_one_of_each_group),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# SQL has no Golay decoding, expectation maximisation, graph scoring or tokenizer: tested against
# brute force instead
ORACLE_SQL = None
