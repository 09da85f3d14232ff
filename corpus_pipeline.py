"""A corpus pipeline: five operators in turn, each reading what the one before has written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, packing, secret_scan, simhash, toxicity
from tidemark.llm.common import table
from tidemark.plans.store import remove_folder
from tidemark.sources.scans import fresh_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_stage(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_stage(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.simhash_stage(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.secrets_stage(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]

#: Compression distances, automata and sequential packing are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is written as Parquet and read again.

    A stage's folder goes once the next stage is written; the last one stays for the reader.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        folder = fresh_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before:
            remove_folder(spark, before)
        before = folder
    return docs
