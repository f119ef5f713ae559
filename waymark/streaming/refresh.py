"""Incremental refresh: pending keys, partial re-runs, shard fallback and source fingerprints.

The stateless operators of the package also run on a streaming DataFrame; ``refresh_batch`` is the
``foreachBatch`` body that adds only what the stored table lacks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.sources.readers import path_exists


def pending(rows: DataFrame, cache: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key has no cached result yet."""
    return rows.join(cache.select(*keys).distinct(), list(keys), "left_anti")


def tile(lat="lat", lon="lon", size_deg: float = 0.5) -> Column:
    """Work-unit tile key."""
    from waymark.functions.geo import fixed_cell

    return fixed_cell(lat, lon, size_deg)


def completeness(rows: DataFrame, cache: DataFrame, keys: Sequence[str], least: float = 0.99) -> DataFrame:
    """Share of rows with a cached result, and whether it is enough to publish."""
    have = cache.select(*keys).distinct().withColumn("_have", F.lit(1))
    share = F.count("_have") / F.nullif(F.count(F.lit(1)), F.lit(0))
    return rows.join(have, list(keys), "left").agg(
        F.count(F.lit(1)).alias("total"), F.count("_have").alias("cached"), share.alias("share")
    ).withColumn("complete", F.coalesce(F.col("share") >= least, F.lit(False)))


def refresh_table(rows: DataFrame, path: str, keys: Sequence[str], compute: Callable[[DataFrame], DataFrame]) -> int:
    """Compute only pending rows and append them, partitioned by tile; returns the rows added.

    ``compute`` must return the keys and a ``tile`` column. A run that died midway is resumed by the
    next one: what was written is not computed again.
    """
    spark = rows.sparkSession
    todo = rows
    if path_exists(spark, path):
        todo = pending(rows, spark.read.parquet(path), keys)
    before = 0 if not path_exists(spark, path) else spark.read.parquet(path).count()
    compute(todo).write.mode("append").partitionBy("tile").parquet(path)
    return spark.read.parquet(path).count() - before


def refresh_batch(path: str, keys: Sequence[str], compute: Callable[[DataFrame], DataFrame]):
    """``foreachBatch`` function: idempotent, because a replayed batch finds its keys stored."""

    def run(batch: DataFrame, batch_id: int) -> None:
        refresh_table(batch.dropDuplicates(list(keys)), path, keys, compute)

    return run


def partial_rerun(previous: DataFrame, fresh: DataFrame, group: str, rerun: DataFrame) -> DataFrame:
    """Previous rows of the groups not run again, plus the fresh rows of those that were."""
    groups = rerun.select(group).distinct()
    kept = previous.join(groups, group, "left_anti")
    return kept.unionByName(fresh.join(groups, group, "left_semi"), allowMissingColumns=True)


def keep_previous_shards(previous: DataFrame, fresh: DataFrame, shard: str) -> DataFrame:
    """Fresh rows, and the previous rows of the shards for which the refresh gave none."""
    filled = fresh.select(shard).distinct()
    return fresh.unionByName(previous.join(filled, shard, "left_anti"), allowMissingColumns=True)


def source_fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modified) of every file under a source path, without reading contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def is_unchanged(now: DataFrame, stored: DataFrame) -> bool:
    """True when both fingerprints hold the same files, sizes and times."""
    return now.exceptAll(stored).isEmpty() and stored.exceptAll(now).isEmpty()


def reuse_or_build(spark: SparkSession, source: str, target: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Stored extract when the source is unchanged, else build it again."""
    now = source_fingerprint(spark, source)
    marks = f"{target}-fingerprint"
    if path_exists(spark, marks) and path_exists(spark, target) and is_unchanged(now, spark.read.parquet(marks)):
        return spark.read.parquet(target)
    build().write.mode("overwrite").parquet(target)
    now.write.mode("overwrite").parquet(marks)
    return spark.read.parquet(target)
