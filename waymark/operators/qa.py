"""Validators: every check is a row (check, expected, actual, passed)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.brands import needs_review


def check_rows(df: DataFrame, checks: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Evaluate aggregate checks in one pass over ``df``.

    ``checks``: name -> (aggregate value, condition on that value written with ``F.col("v")``).
    """
    names = list(checks)
    one = df.agg(*[checks[n][0].cast("double").alias(f"c{i}") for i, n in enumerate(names)])
    rows = F.array(
        *[F.struct(F.lit(n), F.col(f"c{i}")).cast("struct<check:string,v:double>") for i, n in enumerate(names)]
    )
    listed = one.select(F.explode(rows).alias("r")).select("r.check", "r.v")
    passed = F.lit(False)
    for n in names:
        passed = passed | ((F.col("check") == n) & checks[n][1])
    return listed.select("check", F.col("v").alias("actual"), F.coalesce(passed, F.lit(False)).alias("passed"))


@dataclass(frozen=True)
class Rule:
    """An expectation: ``value``, an expression over named measures, lies in [least, most]; else it fails or warns."""

    check: str
    value: str
    least: float | None = None
    most: float | None = None
    level: str = "fail"


def expectations(measures: Mapping[str, tuple[DataFrame, Mapping[str, Column]]], rules: Sequence[Rule]) -> DataFrame:
    """(check, actual, least, most, level, passed) of every rule.

    ``measures``: per table its aggregates by name, all taken in one pass over that table; rules may set
    measures of different tables against each other. A value that cannot be taken (a share of no rows) does not pass.
    """
    names = [n for _, aggregates in measures.values() for n in aggregates]
    one = None
    for df, aggregates in measures.values():
        taken = df.agg(*[c.cast("double").alias(n) for n, c in aggregates.items()])
        row = taken.select(*[F.col(n) if n in aggregates else F.lit(None).cast("double").alias(n) for n in names])
        one = row if one is None else one.unionByName(row)
    # a row per table, each measure filled in one of them
    together = one.agg(*[F.max(n).alias(n) for n in names])
    bound = "cast({} as double)".format
    listed = [
        F.struct(
            F.lit(r.check).alias("check"), F.expr(r.value).cast("double").alias("actual"),
            F.expr(bound("null" if r.least is None else repr(r.least))).alias("least"),
            F.expr(bound("null" if r.most is None else repr(r.most))).alias("most"), F.lit(r.level).alias("level"),
        )
        for r in rules
    ]
    inside = "actual is not null and actual >= coalesce(least, actual) and actual <= coalesce(most, actual)"
    return together.select(F.explode(F.array(*listed)).alias("r")).select("r.*").withColumn("passed", F.expr(inside))


def rows_where(condition: Column) -> Column:
    return F.coalesce(F.sum(condition.cast("int")), F.lit(0))


def share_where(condition: Column, of: Column | None = None) -> Column:
    """Share of rows (or of the rows ``of``) that meet a condition; null of no rows."""
    whole = F.lit(True) if of is None else of
    return rows_where(condition & whole) / F.nullif(rows_where(whole), F.lit(0))


def rows_without(column: str) -> Column:
    """Rows whose text is null or empty."""
    return rows_where(F.coalesce(F.col(column), F.lit("")) == "")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def group_minimums(df: DataFrame, key: str, expected: DataFrame) -> DataFrame:
    """Rows per expected key against a least count (``expected``: key, least)."""
    have = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return expected.join(have, key, "left").select(
        key, "least", F.coalesce("n", F.lit(0)).alias("n"), (F.coalesce("n", F.lit(0)) >= F.col("least")).alias("passed")
    )


def count_agreement(parts: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count and whether all counts agree."""
    counts = None
    for name, df in parts.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
        counts = one if counts is None else counts.unionByName(one)
    low_high = counts.agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    same = low_high.select((F.col("lo") == F.col("hi")).cast("int").alias("agree"), F.lit(1).alias("_j"))
    return counts.withColumn("_j", F.lit(1)).join(same, "_j").drop("_j")


def repair_flags(df: DataFrame, flags: str = "map_flags", reasons: str = "review_reasons") -> DataFrame:
    """Distinct flags, and the review mark recomputed from them."""
    clean = df.withColumn(flags, F.array_distinct(flags)).withColumn(reasons, F.array_distinct(reasons))
    return clean.withColumn("needs_review", needs_review(F.col(flags), F.col(reasons)))


def strategy_scores(cases: DataFrame, strategies: Mapping[str, Column], expected: Column, tier: str) -> DataFrame:
    """Cases, hits and accuracy of every include rule, per tier and overall, in one pass."""
    outcomes = F.array(
        *[
            F.struct(F.lit(n), (c == expected).cast("int")).cast("struct<strategy:string,hit:int>")
            for n, c in strategies.items()
        ]
    )
    judged = cases.select(F.explode(F.array(F.col(tier), F.lit("all"))).alias("tier"), outcomes.alias("o"))
    return (
        judged.select("tier", F.explode("o").alias("o"))
        .groupBy(F.col("o.strategy").alias("strategy"), "tier")
        .agg(F.count(F.lit(1)).alias("cases"), F.sum("o.hit").alias("hits"))
        .withColumn("accuracy", F.floor(F.col("hits") * 1000.0 / F.col("cases") + 0.5) / 1000.0)
    )
