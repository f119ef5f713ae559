"""One-to-one matching and ordered lookup chains."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.operators import cells
from waymark.operators.ranking import rank_in_groups
from waymark.operators.spatial import nearest_within, radius_join
from waymark.runtime import stage, stage_counted


def greedy_match(
    left: DataFrame,
    right: DataFrame,
    radius: float,
    unit: str = "mi",
    on: Sequence[str] = (),
    left_key: str = "id",
    right_key: str = "id",
    bands: Sequence[float] | None = None,
) -> DataFrame:
    """Pairs taken in order of (distance, left key, right key), each row used once.

    Columns: left_key, right_key, distance. The same pairs as a sort-and-scan: a pair that comes
    first for both its rows is taken, in rounds, until no pair is left. Rows on one exact spot are
    matched by rank first. Where rows crowd, the radius grows in ``bands``, so close rows are gone
    before wide pairs are listed, and of the copies on one spot only as many take part as there are
    partners in reach.
    """
    on = list(on)
    l = stage(
        left.select(F.col(left_key).alias("lk"), "lat", "lon", *on).na.drop(subset=["lat", "lon"]), "left"
    )
    r = stage(
        right.select(F.col(right_key).alias("rk"), "lat", "lon", *on).na.drop(subset=["lat", "lon"]), "right"
    )
    spot = ["lat", "lon", *on]
    shared, n_shared = stage_counted(l.select(*spot).distinct().join(r.select(*spot).distinct(), spot), "shared")
    parts: list[DataFrame] = []
    if n_shared:
        on_spot = stage(
            rank_in_groups(l.join(shared, spot, "left_semi"), spot, ["lk"], "n")
            .join(rank_in_groups(r.join(shared, spot, "left_semi"), spot, ["rk"], "n"), [*spot, "n"])
            .select("lk", "rk", F.lit(0.0).alias("d")),
            "matched",
        )
        parts.append(on_spot)
        l = stage(l.join(on_spot, "lk", "left_anti"), "left")
        r = stage(r.join(on_spot, "rk", "left_anti"), "right")

    if bands is None:
        bands = _bands(l, r, radius, unit, on)
    for number, share in enumerate(bands):
        reach = radius * share
        pairs, left_over = stage_counted(
            radius_join(
                _useful_copies(l, r, "lk", spot, reach, unit, on),
                _useful_copies(r, l, "rk", spot, reach, unit, on),
                reach,
                unit,
                on,
                distance="d",
            ).select(F.col("l_lk").alias("lk"), F.col("r_rk").alias("rk"), "d"),
            "pairs",
        )
        found: list[DataFrame] = []
        while left_over:
            best_l = pairs.groupBy("lk").agg(F.min(F.struct("d", "lk", "rk")).alias("b")).select("b.*")
            best_r = pairs.groupBy("rk").agg(F.min(F.struct("d", "lk", "rk")).alias("b")).select("b.*")
            taken = stage(best_l.join(best_r.select("lk", "rk"), ["lk", "rk"]).select("lk", "rk", "d"), "taken")
            found.append(taken)
            pairs, left_over = stage_counted(
                pairs.join(taken.select("lk"), "lk", "left_anti").join(taken.select("rk"), "rk", "left_anti"),
                "pairs",
            )
        parts += found
        if found and number + 1 < len(bands):
            done = reduce(DataFrame.union, found)
            l = stage(l.join(done, "lk", "left_anti"), "left")
            r = stage(r.join(done, "rk", "left_anti"), "right")
    matched = reduce(DataFrame.union, parts) if parts else pairs
    return matched.select(
        F.col("lk").alias("left_key"), F.col("rk").alias("right_key"), F.col("d").alias("distance")
    )


def _bands(l: DataFrame, r: DataFrame, radius: float, unit: str, on: list[str], crowd: int = 512) -> list[float]:
    """Shares of the radius, smallest first, so that a cell of the first lists few pairs per row.

    The pairs are counted from row counts per cell, without listing any.
    """
    shares = [1.0]
    while len(shares) < 8:
        d = cells.cell_degrees(radius * shares[0], unit)

        def counts(rows: DataFrame, name: str) -> DataFrame:
            spots = rows.select("lat", "lon", *on).distinct()
            return cells.with_cell(spots, "lat", "lon", d).groupBy("cell_b", "cell_l", *on).agg(F.count(F.lit(1)).alias(name))

        worst = (
            counts(l, "ln").join(counts(r, "rn"), ["cell_b", "cell_l", *on]).agg(F.max(F.least("ln", "rn"))).first()[0]
        )
        if (worst or 0) <= crowd:
            break
        shares.insert(0, shares[0] / 8)
    return shares


def _useful_copies(
    rows: DataFrame, others: DataFrame, key: str, spot: list[str], reach: float, unit: str, on: list[str]
) -> DataFrame:
    """Rows that can still be taken: of n copies on a spot, the first as many as partners in reach.

    A later copy is taken only after all earlier ones, so the cut is exact.
    """
    copies = rows.groupBy(*spot).agg(F.count(F.lit(1)).alias("_n"))
    crowded = copies.where("_n > 1")
    if crowded.isEmpty():
        return rows
    partners = others.groupBy(*spot).agg(F.count(F.lit(1)).alias("_m"))
    reachable = (
        radius_join(crowded, partners, reach, unit, on)
        .groupBy(*[F.col(f"l_{c}").alias(c) for c in spot])
        .agg(F.sum("r__m").alias("_limit"))
    )
    ranked = rank_in_groups(rows.join(crowded, spot, "left_semi"), spot, [key], "_rank")
    first = ranked.join(reachable, spot).where("_rank <= _limit").select(*rows.columns)
    return rows.join(crowded, spot, "left_anti").unionByName(first)


def split_by_match(
    left: DataFrame, right: DataFrame, matched: DataFrame, left_key: str = "id", right_key: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """(left only, right only)."""
    return (
        left.join(matched, left[left_key] == matched["left_key"], "left_anti"),
        right.join(matched, right[right_key] == matched["right_key"], "left_anti"),
    )


def stamp_nearest(
    rows: DataFrame,
    stores: DataFrame,
    radius: float,
    unit: str,
    on: Sequence[str],
    copy: Sequence[str],
    key: str = "id",
    store_key: str = "store_id",
) -> DataFrame:
    """Copy columns of the nearest store with the same ``on`` value; a null store value changes nothing."""
    hit = nearest_within(rows, stores, radius, unit, on, key, store_key, distance="stamp_distance")
    for c in copy:
        mine = F.col(c) if c in rows.columns else F.lit(None)
        hit = hit.withColumn(c, F.coalesce(F.col(f"near.{c}"), mine))
    return hit.withColumn("stamped_by", F.col(f"near.{store_key}")).drop("near")


def first_resolved(
    rows: DataFrame, steps: Sequence[tuple[str, Column, DataFrame, str]], key: str, value: str, output: str
) -> DataFrame:
    """Ordered equi-lookups: the first step whose key finds a row gives ``output``.

    ``steps``: (name, lookup key Column on ``rows``, catalogue, catalogue key column). A catalogue
    key that occurs more than once gives the row with the least ``seq``. Adds ``<output>_by``. Rows without a
    lookup, and rows an earlier step has resolved, join under a key of their own that no catalogue holds, so they are
    spread over all tasks.
    """
    out = rows
    own = F.concat(F.lit("\u0001"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    found: list[Column] = []
    names: list[Column] = []
    for i, (name, lookup, catalogue, catalogue_key) in enumerate(steps):
        unique = (
            catalogue.where(F.col(catalogue_key).isNotNull() & (F.col(catalogue_key) != ""))
            .groupBy(F.col(catalogue_key).alias(f"_key{i}"))
            .agg(F.min_by(F.col(value), F.col("seq")).alias(f"_val{i}"))
        )
        asked = F.nullif(lookup.cast("string"), F.lit(""))
        if found:
            asked = F.when(F.coalesce(*found).isNull(), asked)
        out = out.withColumn(f"_look{i}", F.coalesce(asked, own))
        out = out.join(unique, F.col(f"_look{i}") == F.col(f"_key{i}"), "left")
        found.append(F.col(f"_val{i}"))
        names.append(F.when(F.col(f"_val{i}").isNotNull(), F.lit(name)))
    extra = [c for i in range(len(steps)) for c in (f"_look{i}", f"_key{i}", f"_val{i}")]
    return (
        out.withColumn(output, F.coalesce(*found)).withColumn(f"{output}_by", F.coalesce(*names)).drop(*extra)
    )


def _like_keys(pairs: DataFrame, scope: list[str], mine: str, other: str) -> DataFrame:
    """(scope, key, _group): keys of one side with the same partners have one group, named by the least of them."""
    partners = pairs.groupBy(*scope, mine).agg(
        F.count(F.lit(1)).alias("_n"), F.bit_xor(F.xxhash64(other)).alias("_x"), F.bit_xor(F.xxhash64(F.lit("again"), other)).alias("_y")
    )
    least = partners.groupBy(*scope, "_n", "_x", "_y").agg(F.min(mine).alias("_group"))
    return stage(partners.join(least, [*scope, "_n", "_x", "_y"]).select(*scope, mine, "_group"), "groups")


def first_free_match(
    left: DataFrame, right: DataFrame, compatible: DataFrame, left_key: str, right_key: str, scope: Sequence[str]
) -> DataFrame:
    """Left rows in order take their first free compatible right row; (left_key, right_key).

    Rows are alike when they share ``scope`` and their text key; ``compatible`` lists the pairs of
    text keys: scope, l_key, r_key. ``left``/``right``: scope, key, seq and the row key.

    Alike rows are served in order, so what is taken of a key is a prefix and one number per key is the whole state.
    A round matches each pair of keys whose first free rows want each other, and with them as many further rows
    of both as come before the next rival on either side. No pairs of rows are listed before they are matched.
    Keys that are compatible with the same keys are one key from the start: their rows take turns, and a round would
    end at each turn.
    """
    scope = list(scope)
    every = stage(compatible.select(*scope, "l_key", "r_key").distinct(), "compatible")
    l_groups, r_groups = _like_keys(every, scope, "l_key", "r_key"), _like_keys(every, scope, "r_key", "l_key")

    def ranked(rows: DataFrame, row_key: str, p: str) -> DataFrame:
        grouped = rows.select(*scope, F.col("key").alias(f"{p}_key"), "seq", row_key).join(
            l_groups if p == "l" else r_groups, [*scope, f"{p}_key"]
        )
        grouped = grouped.select(*scope, F.col("_group").alias("key"), "seq", row_key)
        out = rank_in_groups(grouped, [*scope, "key"], ["seq", row_key], "rank")
        return stage(
            out.select(*scope, F.col("key").alias(f"{p}_key"), F.col("rank").cast("long").alias(f"{p}_rank"), F.struct("seq", row_key).alias(f"{p}_row")),
            f"{p}-ranked",
        )

    l_rows, r_rows = ranked(left, left_key, "l"), ranked(right, right_key, "r")
    pairs = every.join(l_groups.withColumnRenamed("_group", "_l"), [*scope, "l_key"]).join(r_groups.withColumnRenamed("_group", "_r"), [*scope, "r_key"])
    pairs = stage(pairs.select(*scope, F.col("_l").alias("l_key"), F.col("_r").alias("r_key")).distinct(), "compatible")
    batches = None
    while True:
        taken = {}
        for p in ("l", "r"):
            if batches is not None:
                taken[p] = batches.groupBy(*scope, f"{p}_key").agg(F.sum("size").alias(f"{p}_taken"))
        open_pairs = pairs
        for p, rows in (("l", l_rows), ("r", r_rows)):
            if p in taken:
                open_pairs = open_pairs.join(taken[p], [*scope, f"{p}_key"], "left")
            else:
                open_pairs = open_pairs.withColumn(f"{p}_taken", F.lit(None).cast("long"))
            open_pairs = open_pairs.withColumn(f"{p}_rank", F.coalesce(f"{p}_taken", F.lit(0)) + 1).drop(f"{p}_taken")
            open_pairs = open_pairs.join(rows, [*scope, f"{p}_key", f"{p}_rank"])
        heads = stage(open_pairs, "heads")
        if heads.isEmpty():
            break
        met = heads
        for mine, other in (("l", "r"), ("r", "l")):
            key = [*scope, f"{mine}_key"]
            first = heads.groupBy(*key).agg(F.min(f"{other}_row").alias(f"{other}_first"))
            second = (
                heads.join(first, key).where(f"{other}_row > {other}_first")
                .groupBy(*key).agg(F.min(f"{other}_row").alias(f"{other}_rival"))
            )
            met = met.join(first, key).join(second, key, "left")
        mutual = stage(
            met.where("l_row = l_first and r_row = r_first").select(
                *scope, "l_key", "r_key", F.col("l_rank").alias("l_from"), F.col("r_rank").alias("r_from"), "l_rival", "r_rival"
            ),
            "mutual",
        )
        sizes = mutual.select(*scope, "l_key", "r_key", "l_from", "r_from")
        for p, rows in (("l", l_rows), ("r", r_rows)):
            ahead = mutual.join(rows, [*scope, f"{p}_key"]).where(
                f"{p}_rank >= {p}_from and ({p}_rival is null or {p}_row < {p}_rival)"
            )
            counted = ahead.groupBy(*scope, "l_key", "r_key").agg(F.count(F.lit(1)).alias(f"{p}_n"))
            sizes = sizes.join(counted, [*scope, "l_key", "r_key"])
        fresh = sizes.select(*scope, "l_key", "r_key", "l_from", "r_from", F.least("l_n", "r_n").alias("size"))
        batches = stage(fresh if batches is None else batches.union(fresh), "batches")
    if batches is None:
        return left.join(right, F.lit(False)).select(left[left_key].alias("left_key"), right[right_key].alias("right_key"))
    single = batches.select(*scope, "l_key", "r_key", "l_from", "r_from", F.explode(F.expr("sequence(0L, size - 1)")).alias("i")).select(
        *scope, "l_key", "r_key", (F.col("l_from") + F.col("i")).alias("l_rank"), (F.col("r_from") + F.col("i")).alias("r_rank")
    )
    matched = single.join(l_rows, [*scope, "l_key", "l_rank"]).join(r_rows, [*scope, "r_key", "r_rank"])
    return matched.select(F.col(f"l_row.{left_key}").alias("left_key"), F.col(f"r_row.{right_key}").alias("right_key"))
