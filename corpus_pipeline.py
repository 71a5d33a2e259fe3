"""From raw documents to packed sequences, in five stages.

Each stage takes what its predecessor kept; between stages `run` writes Parquet to shared
scratch space and reads it back. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stockweave.durable import durable
from stockweave.llm import linededup, mixing, neardup, packing, quality
from stockweave.llm.common import table, vocabulary
from stockweave.llm.shipping import ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the base rules or their own repetition reject."""
    ship(spark)
    return quality.filter_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines that repeat in windows of three; n_chars follows the text."""
    ship(spark)
    return linededup.clean_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near-duplicates."""
    ship(spark)
    return neardup.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample documents so that sources, languages and topics meet their target weights."""
    ship(spark)
    return mixing.sample(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place the documents' tokens in sequences."""
    ship(spark)
    return packing.pack(docs, vocabulary("byte_bpe_50k.json")).drop("row")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Suffix arrays, weighted sampling and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
