"""Registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from waymark.llm import (
    alignment,
    anchors,
    collocations,
    decontaminate,
    langid,
    licences,
    mixing,
    neardup,
    quality,
    sharding,
    sketches,
    sql,
    tokenfiles,
    warcfiles,
)
from waymark.llm.support import table

TOKENIZER, OTHER_TOKENIZER = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_label_propagation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_table(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op3_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprints(table(spark, sf_dir, "documents"))


def op4_token_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokenfiles.token_table(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op5_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warcfiles.archive_table(table(spark, sf_dir, "pages"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


def op10_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.near_duplicates(table(spark, sf_dir, "documents"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = public_tokenizers.path(TOKENIZER), public_tokenizers.path(OTHER_TOKENIZER)
    return alignment.alignment(table(spark, sf_dir, "documents"), *paths)


_ALL = [
    op1_label_propagation_shards, op2_language_id, op3_scaled_sketch, op4_token_parquet, op5_quality_discriminant,
    op6_winnowing_decontamination, op7_warc_dictionary, op8_license_scan, op9_source_mixing, op10_minhash_neardup,
    op11_simhash_anchors, op12_phrase_collocations, op13_tokenizer_alignment,
]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}
SQL = sql.SQL
