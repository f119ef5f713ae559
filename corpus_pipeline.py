"""Training-data pipeline over ``documents``: five stages, each written and read again.

language id -> near-duplicates -> benchmark passages -> source mix -> shards. Every stage works on all rows its
predecessor kept; all but the last return the columns of ``documents``. Copies that the mix makes are rows of
their own, and the last stage adds shard and slot.

Documents are rejected by language id if they have no letter or no language with a probability of at least 0.3.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from waymark.llm import decontaminate, langid, mixing, neardup, sharding
from waymark.runtime import shared_dir

#: similarity of five-word shingles from which texts count as near-duplicates
NEAR_PERCENT = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.identified(docs)


def minhash_neardup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.without_near_duplicates(docs, NEAR_PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def label_propagation_sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.sharded(docs)


STAGES = [
    ("language_id", language_id),
    ("minhash_neardup", minhash_neardup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("label_propagation_sharding", label_propagation_sharding),
]
#: language id and sharding have no SQL form; tests hold the stages against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each keeps is a Parquet table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{i}-{name}")
        docs = spark.read.parquet(f"{base}/{i}-{name}")
    return docs
