"""Mixing sources to target weights, with DataFrame operations only.

A document's size is its number of ``[^\\x20\\x09-\\x0D]+``. Sizes are summed per source; the sources share a
budget by weight, no source above ``most`` times its size, and what a full source leaves goes to the others by
weight until none is above. The rate of a source is its target over its size: each document is taken
floor(rate) times, and once more if a hash of seed and doc_id falls below the fraction of the rate.

Cases: null text has size 0; null is a source of its own, after all others; sources without words have the
rate 0; documents without an id share one draw; repeated rows are taken alike; other columns are kept by
``mixed`` and ignored otherwise; an empty table gives an empty result.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.support import packed, pick, prepare, unpacked
from waymark.operators.ranking import rank_in_groups
from waymark.runtime import stage

#: fixed values: weights of the sources in order, repeating
WEIGHTS = (3, 1, 2)
#: the budget is SHARE_HALVES / 2 of all sizes, and no target is above 2 times the source's size
SHARE_HALVES = 3


def size_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    All comparisons are on whole numbers: with open sources of weight W and a doubled budget N left to
    them, a source is above its bound where N * weight > 4 * size * W.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = rank_in_groups(sums.withColumn("is_null", F.col("source").isNull()), [], ["is_null", "source"])
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), F.expr(f"cast(pmod(rank - 1, {len(WEIGHTS)}) + 1 as int)"))
    whole = "decimal(38,0)"
    sources = stage(ordered.select("source", "source_size", weight.cast("long").alias("weight")), "mixing-sources")
    total, open_weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    left, open_weight, n_full, full = SHARE_HALVES * (total or 0), open_weight or 1, 0, F.lit(False)
    while True:
        share = F.lit(Decimal(left)).cast(whole) * F.col("weight").cast(whole)
        above = (F.col("source_size") * 4).cast(whole) * F.lit(Decimal(open_weight)).cast(whole) < share
        n, bound, rest = sources.agg(
            F.count_if(above),
            F.sum(F.when(above, F.col("source_size") * 4).otherwise(0)),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))),
        ).first()
        if n == n_full:
            break
        left, open_weight, n_full, full = SHARE_HALVES * total - bound, rest, n, above
    share = F.lit(float(left)) * F.col("weight") / F.lit(float(2 * open_weight))
    target = F.when(full, F.col("source_size") * F.lit(2.0)).otherwise(share)
    return sources.select("source", "source_size", target.alias("target"))


def copies(seed: str) -> Column:
    """How often a document is taken, from target, source_size and doc_id."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
    return F.floor(rate).cast("long") + (draw < rate - F.floor(rate)).cast("long")


def taken_words(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """Per document: size, its source's size and target, and the words the mix takes of it."""
    prepare(docs.sparkSession)
    sized = stage(pick(docs, "doc_id", "source", "text").select("doc_id", "source", size_of("text").alias("size")), "mixing-sized")
    goals = targets(sized)
    return sized.join(goals, sized["source"].eqNullSafe(goals["source"])).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies(seed)).alias("taken")
    )


def mixed(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    prepare(docs.sparkSession)
    goals = targets(pick(docs, "source", "text").select("source", size_of("text").alias("size")))
    rows = packed(docs, "doc_id", "source")
    emitted = rows.join(goals, rows["source"].eqNullSafe(goals["source"])).withColumn("n", copies(seed).cast("int"))
    return unpacked(emitted.select("_doc", F.explode(F.array_repeat(F.lit(0), F.col("n"))).alias("copy")))
