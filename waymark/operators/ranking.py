"""First-per-key, best-per-key and ranks that stay distributed when one key is hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.runtime import stage


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One whole row per key: the first by ``order``.

    An aggregation rather than a window: rows of a hot key are reduced before the shuffle. Rows
    with a null key are dropped.
    """
    rank = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    others = [c for c in df.columns if c not in keys]
    whole = F.struct(*[F.col(c) for c in others])
    picked = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.min_by(whole, rank).alias("_row"))
    return picked.select(*[F.col(k) for k in keys], "_row.*").select(*df.columns)


def first_seen(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One whole row per key: the first in input order, which is ``seq``; without that column the southernmost."""
    return first_per_key(df, keys, ["seq", "lat", "lon"] if "seq" in df.columns else ["lat", "lon"])


def best_per_key(df: DataFrame, keys: Sequence[str], score: Column, seq: str) -> DataFrame:
    """Highest score per key; the earlier row wins a tie."""
    return first_per_key(df, keys, [(-score).alias("_score"), F.col(seq)])


def rank_in_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str], output: str = "rank") -> DataFrame:
    """Exact 1-based rank inside each key, with no task holding a whole key.

    Rows are range-partitioned by (key, order); each partition ranks its own rows, and the counts of
    the earlier partitions of the same key are added.
    """
    placed = stage(
        df.repartitionByRange(*[F.col(c) for c in [*keys, *order]]).withColumn("_part", F.spark_partition_id()),
        "ranked",
    )
    by_part = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*keys, "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(by_part), F.lit(0)))
        .drop("_n")
    )
    local = Window.partitionBy(*keys, "_part").orderBy(*order)
    ranked = placed.withColumn("_local", F.row_number().over(local))
    same = ranked["_part"] == offsets["_part"]
    for k in keys:
        same = same & ranked[k].eqNullSafe(offsets[k])
    return ranked.join(offsets, same).select(
        *[ranked[c] for c in df.columns], (F.col("_local") + F.col("_before")).alias(output)
    )


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Report sample: the first n rows by an explicit order (a take-ordered, no global sort)."""
    return df.orderBy(*order).limit(n)
