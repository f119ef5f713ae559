"""Balanced label propagation over documents of equal text, with DataFrame operations only.

Law ``rows``: the counts of any two shards differ by one at most.

Documents of equal text are linked. Groups beyond an eighth of a shard, of which there are few, are placed first:
the largest first, each whole on the fullest shard that has room for it; only a group that fits no shard fills the
emptiest one and goes on with what is left. The other linked documents start on a shard by hash, as often as it has
room; documents of one group on one shard move as a unit. In each round every group votes with its rows for the shard
that holds most of them, and the units elsewhere ask to move there, where their neighbours are, which removes cut
links. A shard lets in the units with most neighbours first, up to its free capacity and half of what asks to leave
it. The rounds end when nothing moves any more. Groups that are still apart, and the last rows of a shard over its
quota, then fill the shards in the order of their texts, rows without links after them: of these groups only those
at the border of a shard are cut.

A round works on units (group, starting shard), not on rows: a group of any size gives as many units as
there are shards at most.

Cases: null text counts as empty (size 1, crc32 0); documents without an id are placed as others are; repeated
rows are linked like equal texts; other columns are kept by ``sharded`` and ignored otherwise; an empty
table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.support import packed, pick, prepare
from waymark.operators.ranking import rank_in_groups
from waymark.runtime import drop_stages, stage

#: priority classes of a shard's admission; what is admitted is a prefix of them
CLASSES = 4096
#: a group beyond this fraction of a shard is placed ahead of the rounds
PART_OF_SHARD = 8


def _text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def _literal_map(values: dict, key: str) -> Column:
    """Lookup in a small map (one entry per shard or large group)."""
    if not values:
        return F.lit(None).cast("int")
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col(key))


def places_of(
    groups: Sequence[tuple[str, int]], quota: dict[int, int]
) -> tuple[dict[str, list[tuple[int, int]]], dict[int, int]]:
    """((shard, rows) of each group, rows still free on each shard); a group is cut only where no shard can hold it."""
    free, places = dict(quota), {}
    queue = [(-n, digest) for digest, n in groups]
    heapq.heapify(queue)
    while queue:
        n, digest = heapq.heappop(queue)
        fitting = [s for s in free if free[s] >= -n]
        shard = min(fitting, key=free.get) if fitting else max(free, key=free.get)
        taken = min(-n, free[shard])
        free[shard] -= taken
        places.setdefault(digest, []).append((shard, taken))
        if taken < -n:
            heapq.heappush(queue, (n + taken, digest))
    return places, free


def placed_groups(rows: DataFrame, places: dict[str, list[tuple[int, int]]]) -> DataFrame:
    """The rows of the groups in ``places`` with their shard."""
    whole = {digest: at[0][0] for digest, at in places.items() if len(at) == 1}
    found = rows.where(F.col("digest").isin(list(whole))).withColumn("shard", _literal_map(whole, "digest"))
    cut = {digest: at for digest, at in places.items() if len(at) > 1}
    if not cut:
        return found
    parts = rows.where(F.col("digest").isin(list(cut))).withColumn("mix", F.xxhash64("doc_id", "digest"))
    shard = F.lit(None).cast("int")
    for digest, at in cut.items():  # two parts per shard at most
        last = sum(n for _, n in at)
        for s, n in reversed(at):
            shard = F.when((F.col("digest") == digest) & (F.col("rank") <= last), F.lit(s)).otherwise(shard)
            last -= n
    parts = rank_in_groups(parts, ["digest"], ["mix"])
    return found.union(parts.select(*rows.columns, shard.alias("shard")))


def start_of(free: dict[int, int]) -> Column:
    """The shard a row starts from, by hash, in proportion to what is free."""
    at, start = sum(free.values()), F.lit(None).cast("int")
    draw = F.expr(f"pmod(xxhash64(doc_id, 'start'), {max(1, at)}L)")
    for s in reversed(free):
        start = F.when(draw < at, F.lit(s)).otherwise(start) if free[s] else start
        at -= free[s]
    return start


def propagate(units: DataFrame, capacity: dict[int, int]) -> DataFrame:
    """(digest, start, n, shard) after the last round of label propagation."""
    state = stage(units.withColumn("shard", F.col("start")), "shard-units")
    done = 0
    while True:
        votes = state.groupBy("digest", "shard").agg(F.sum("n").alias("votes"))
        goal = votes.groupBy("digest").agg(
            F.max(F.struct("votes", F.xxhash64("digest", "shard").alias("tie"), "shard")).alias("best")
        )
        rank = F.expr(
            f"cast(({CLASSES // 256 - 1} - least({CLASSES // 256 - 1}, cast(log2(best.votes) as int))) * 256"
            f" + pmod(xxhash64(digest, start, {done}), 256) as int)"
        )
        wishes = stage(
            state.join(goal, "digest").select(
                "digest", "start", "n", "shard", F.col("best.shard").alias("goal"), rank.alias("rank")
            ),
            "shard-wishes",
        )
        moving = wishes.where("shard <> goal")
        load = {r[0]: r[1] for r in wishes.groupBy("shard").agg(F.sum("n")).collect()}  # a row per shard
        leaving = {r[0]: r[1] for r in moving.groupBy("shard").agg(F.sum("n")).collect()}
        if not leaving:
            return state
        room = {s: max(0, n - load.get(s, 0) + leaving.get(s, 0) // 2) for s, n in capacity.items()}
        so_far = Window.partitionBy("goal").orderBy("rank")
        admitted = (
            moving.groupBy("goal", "rank").agg(F.sum("n").alias("n"))
            .withColumn("total", F.sum("n").over(so_far))
            .where(F.col("total") <= _literal_map(room, "goal"))
            .groupBy("goal").agg(F.max("rank"))
            .collect()
        )
        if not admitted:
            return state
        last = dict.fromkeys(capacity, -1) | {r[0]: r[1] for r in admitted}
        goes = (F.col("shard") != F.col("goal")) & (F.col("rank") <= _literal_map(last, "goal"))
        before, state = state, stage(
            wishes.select("digest", "start", "n", F.when(goes, F.col("goal")).otherwise(F.col("shard")).alias("shard")),
            "shard-units",
        )
        drop_stages(before, wishes)
        done += 1


def assign(rows: DataFrame, shards: int) -> DataFrame:
    """Rows (doc_id, digest and others) with shard and slot."""
    rows = stage(rows, "shard-rows")
    n_rows = rows.count()
    quota = {s: n_rows // shards + (s < n_rows % shards) for s in range(shards)}
    groups = stage(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shard-groups")
    most = max(1, n_rows // shards // PART_OF_SHARD)
    large = [(r.digest, r.n) for r in groups.where(F.col("n") > most).collect()]  # 2 * PART_OF_SHARD per shard at most
    places, free = places_of(large, quota)
    keep = list(rows.columns)
    rest = rows.where(~F.col("digest").isin(list(places))).join(groups.where(F.col("n") <= most), "digest", "left")
    rest = stage(rest.select(*keep, "n", start_of(free).alias("start")), "shard-rest")
    linked = rest.where("n is not null")
    state = propagate(linked.groupBy("digest", "start").agg(F.count(F.lit(1)).alias("n")), free)
    apart = state.groupBy("digest").agg((F.min("shard") < F.max("shard")).alias("apart"))
    state = state.select("digest", "start", "shard").join(apart, "digest")
    linked = stage(linked.join(state, ["digest", "start"]).select(*keep, "shard", "apart"), "shard-linked")
    held = placed_groups(rows, places).select(*keep, "shard", F.lit(0).alias("turn"))
    held = held.union(linked.where("not apart").select(*keep, "shard", F.lit(1)))
    held = rank_in_groups(held.withColumn("mix", F.xxhash64("doc_id", "digest")), ["shard"], ["turn", "digest", "mix"])
    held = stage(held.withColumn("slot", F.col("rank").cast("long") - 1).drop("rank"), "shard-held")
    inside = F.col("slot") < _literal_map(quota, "shard")
    load = {r[0]: r[1] for r in held.where(inside).groupBy("shard").count().collect()}
    over = held.where(~inside).select(*keep).union(linked.where("apart").select(*keep))
    fill = over.withColumn("lead", F.col("digest")).union(rest.where("n is null").select(*keep, F.lit("~")))
    fill = rank_in_groups(fill.withColumn("mix", F.xxhash64("doc_id", "digest")), [], ["lead", "mix", "digest"])
    at, shard, slot = 0, F.lit(None).cast("int"), F.lit(None).cast("long")
    for s in range(shards):
        free = quota[s] - load.get(s, 0)
        here = (F.col("rank") > at) & (F.col("rank") <= at + free)
        shard = F.when(here, F.lit(s)).otherwise(shard)
        slot = F.when(here, F.col("rank") - 1 - at + load.get(s, 0)).otherwise(slot)
        at += free
    filled = fill.select(*keep, shard.alias("shard"), slot.cast("long").alias("slot"))
    return held.where(inside).select(*keep, "shard", "slot").union(filled)


def shard_table(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of each document."""
    prepare(docs.sparkSession)
    rows = pick(docs, "doc_id", "text").select(
        "doc_id", (F.octet_length(_text()) + 1).cast("long").alias("size"), F.crc32(_text()).alias("text_crc32"),
        F.md5(_text()).alias("digest"),
    )
    return assign(rows, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def sharded(docs: DataFrame, shards: int = 16) -> DataFrame:
    """The rows of ``docs`` with ``shard`` and ``slot`` (in place of columns of these names)."""
    prepare(docs.sparkSession)
    light = pick(docs, "doc_id", "text").select("doc_id", F.md5(_text()).alias("digest"))
    copies = Window.partitionBy("doc_id", "digest")
    placed = assign(light, shards).withColumn("copy", F.row_number().over(copies.orderBy("shard", "slot")))
    rows = packed(docs, "doc_id", "text").select("_doc", "doc_id", F.md5(_text()).alias("digest"))
    rows = rows.withColumn("copy", F.row_number().over(copies.orderBy(F.lit(0))))
    same = (
        rows["doc_id"].eqNullSafe(placed["doc_id"])
        & (rows["digest"] == placed["digest"])
        & (rows["copy"] == placed["copy"])
    )
    joined = rows.join(placed, same).select("_doc", placed["shard"], placed["slot"])
    kept = [f"_doc.`{c}`" for c in docs.columns if c.lower() not in ("shard", "slot")]
    return joined.select(*kept, "shard", "slot")
