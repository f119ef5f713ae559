"""Substring joins over distinct strings by their rarest character run instead of comparing all pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.runtime import stage

#: characters of a run; shorter needles are one run
RUN_LENGTH = 4


def _runs(value: str, size: int) -> Column:
    """All runs of ``size`` characters of a text."""
    length = F.length(value)
    starts = F.when(length >= size, F.sequence(F.lit(1), length - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.col(value).substr(i, F.lit(size)))


def contain_candidates(needles: DataFrame, texts: DataFrame, needle: str = "needle", body: str = "body") -> DataFrame:
    """Distinct (needle, body) pairs where the body holds the needle's rarest run: a superset of the pairs sought.

    Of a needle's runs of four characters that counts which the fewest bodies hold; a needle with a run that no body
    holds is out at once. So words that all names share ("national") never decide what is compared.
    """
    n = stage(needles.select(F.col(needle).alias("needle")).where("needle <> ''").distinct(), "needles")
    b = stage(texts.select(F.col(body).alias("body")).where("body <> ''").distinct(), "bodies")
    whole = F.when(F.length("needle") < RUN_LENGTH, F.array("needle")).otherwise(F.array_distinct(_runs("needle", RUN_LENGTH)))
    asked = n.select("needle", F.explode(whole).alias("run"))
    every = F.flatten(F.array(*[_runs("body", k) for k in range(1, RUN_LENGTH + 1)]))
    spread = b.select("body", F.explode(F.array_distinct(every)).alias("run"))
    bodies = spread.join(asked.select("run").distinct(), "run", "left_semi").groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    held = asked.join(bodies, "run", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = held.groupBy("needle").agg(F.min(F.struct("n", "run")).alias("least")).where("least.n > 0").select("needle", "least.run")
    return rarest.join(spread, "run").select("needle", "body")


def contains_join(needles: DataFrame, texts: DataFrame, needle: str = "needle", body: str = "body") -> DataFrame:
    """Distinct (needle, body) pairs where the body holds the needle; empty and null texts hold nothing."""
    return contain_candidates(needles, texts, needle, body).where(F.contains("body", F.col("needle")))


def unmatched_names(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Left names that neither hold nor are held by any right name."""
    inside = contains_join(left, right, column, column).select(F.col("needle").alias(column))
    around = contains_join(right, left, column, column).select(F.col("body").alias(column))
    return left.where(F.col(column) != "").join(inside.union(around).distinct(), column, "left_anti")
