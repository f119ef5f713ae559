"""Nearest rows by branch and bound over two trees of cells.

The spots of either side form a tree: a root, below it cells that are eight times finer in both directions, and so on,
but only below cells with more than LEAF spots. A node holds the box of its spots as unit vectors, their number and one of
them. Pairs of a left and a right node are followed downwards. What a right node holds is at least as far as the gap
between the two boxes and, for its representative, at most as far as the farthest corner of the left box; a
left node keeps only right nodes whose gap does not exceed the least such upper bound. At the end each left spot takes the
bounds of the leaves that are left for it, and only then meets rows.

So two crowds that face each other at any distance meet in a number of rows that grows little faster than the rows and not with
their product, and only crowded cells go through further rounds. Boxes of unit vectors know neither poles nor a date line.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from waymark.functions import geo
from waymark.operators import cells
from waymark.runtime import drop_stages, stage

#: bits of a cell's place in each direction, from the root to a few centimetres
LEVELS = (0, 4, 7, 10, 13, 16, 19, 22, 25, 28)
FINEST = LEVELS[-1]
#: spots of a cell that is not divided
LEAF = 16
#: chord on the unit sphere that stands for rounding: a few micrometres
SLACK = 1e-12
AXES = ("x", "y", "z")
BOX = [f"{axis}{end}" for axis in AXES for end in (0, 1)]
AT = [f"p{axis}" for axis in AXES]
NODE = ["_root", "_node"]


def chord(radius: float, unit: str) -> float:
    """Straight distance on the unit sphere that a great-circle distance stands for."""
    angle = radius / (geo.degrees_for(1.0, unit) ** -1 * 180.0 / math.pi)
    return 2.0 * math.sin(min(angle, math.pi) / 2.0)


def _node_id(level: int) -> Column:
    return F.expr(
        f"shiftleft({level}L, 57) | shiftleft(shiftright(_i, {FINEST - level}), {FINEST}) | shiftright(_j, {FINEST - level})"
    )


def placed(spots: DataFrame, on: Sequence[str]) -> DataFrame:
    """Unit vector and finest cell of each spot; rows that cannot match anything are left out."""
    p, q, top = "radians(lat)", "radians(lon)", (1 << FINEST) - 1
    rows = spots.na.drop(subset=["lat", "lon", *on]).selectExpr(
        "*", f"cos({p}) * cos({q}) as x", f"cos({p}) * sin({q}) as y", f"sin({p}) as z"
    )
    return rows.where("not isnan(x + y + z)").selectExpr(
        "*",
        f"cast(floor(least(greatest((lat + 90D) / 180D * {top + 1}, 0D), {top})) as bigint) as _i",
        f"cast(floor(least(greatest((lon + 180D) / 360D * {top + 1}, 0D), {top})) as bigint) as _j",
    )


def tree(spots: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame, list[DataFrame], bool]:
    """(nodes, spots with their leaf, stage tables, whether no root is divided) of placed spots of both sides (``_side``)."""
    ends = [f(axis).alias(f"{axis}{i}") for axis in AXES for i, f in ((0, F.min), (1, F.max))]
    live = stage(spots, "nearest-spots")
    nodes, leaves, tables, parent, group = [], [], [live], F.lit(None).cast("long"), ["_side", *on, *NODE]
    for level in LEVELS:
        live = live.withColumn("_node", _node_id(level))
        made = live.groupBy(*group, parent.alias("_parent")).agg(
            F.count(F.lit(1)).alias("_n"), *ends, F.min(F.struct(*AXES)).alias("_at")
        )
        leaf = (F.col("_n") <= LEAF) | F.lit(level == FINEST)
        made, n_crowded = _stage_open(
            made.select(*group, "_parent", *BOX, *[F.col(f"_at.{a}").alias(f"p{a}") for a in AXES], leaf.alias("_leaf")),
            ~F.col("_leaf"), "nearest-nodes",
        )
        nodes.append(made)
        tables.append(made)
        if not n_crowded:
            leaves.append(live)
            break
        crowded = made.where("not _leaf").select(*group)
        leaves.append(live.join(crowded, group, "left_anti"))
        live = stage(live.join(crowded, group, "left_semi"), "nearest-spots")
        tables.append(live)
        parent = _node_id(level)
    return reduce(DataFrame.union, nodes), reduce(DataFrame.union, leaves), tables, len(nodes) == 1


def _steps(nodes: DataFrame, on: Sequence[str], p: str) -> DataFrame:
    """Where a node leads: to its children, a leaf to itself."""
    rest = [*BOX, *AT, "_leaf"]
    kids = nodes.where("_parent is not null").select(*on, "_root", F.col("_parent").alias("_from"), "_node", *rest)
    own = nodes.where("_leaf").select(*on, "_root", F.col("_node").alias("_from"), "_node", *rest)
    both = kids.union(own)
    return both.select(*on, *[F.col(c).alias(f"{p}{c}") for c in both.columns if c not in on])


def _sum2(part: str, point: bool) -> str:
    """Sum of squares of ``part`` over the axes; with ``point``, the left box is the one spot x, y, z."""
    parts = [part.format(a=a, l0=a if point else f"l{a}0", l1=a if point else f"l{a}1") for a in AXES]
    return " + ".join(f"{p} * {p}" for p in parts)


def _gap2(point: bool = False) -> str:
    """Square of the least chord between the boxes l and r."""
    return _sum2("greatest({l0} - r{a}1, r{a}0 - {l1}, 0D)", point)


def _far2(point: bool = False) -> str:
    """Square of the largest chord from the box l to the representative of r."""
    return _sum2("greatest(abs({l0} - rp{a}), abs({l1} - rp{a}))", point)


def candidates(
    left: DataFrame, right: DataFrame, on: Sequence[str] = (), radius: float | None = None, unit: str = "m"
) -> tuple[DataFrame, list[DataFrame]]:
    """(pairs of spots that hold the nearest right spots of every left spot, stage tables).

    Input: distinct spots with lat, lon and the ``on`` columns, other columns of ``right`` are carried. Output: ``on``, lat
    and lon of the left spot, ``r_`` columns of the right one. Without a ``radius`` the search has no limit.
    """
    on = list(on)
    carried = [c for c in right.columns if c not in on]
    spots = left.select(F.lit("l").alias("_side"), *on, "lat", "lon").unionByName(
        right.select(F.lit("r").alias("_side"), *on, *carried), allowMissingColumns=True
    )
    spots = placed(spots, on)
    if radius is None:
        spots, reach2 = spots.withColumn("_root", F.lit("")), 16.0
    else:
        # roots are cells as wide as the radius, and a left root meets those that its spots can reach
        d = cells.cell_degrees(radius, unit)
        kept = [f"`{c}`" for c in spots.columns]
        spots = cells.with_cell(spots, "lat", "lon", d, "_c").selectExpr(*kept, "concat_ws(':', _c_b, _c_l) as _root")
        reach2 = (chord(radius, unit) * (1 + 1e-9) + SLACK) ** 2
    nodes, leaves, tables, nodes_are_roots = tree(spots, on)
    (l_nodes, r_nodes), (l_leaves, r_leaves) = ([x.where(f"_side = '{p}'") for p in "lr"] for x in (nodes, leaves))
    tops = [
        x.where("_parent is null").select(*on, *[F.col(c).alias(f"{p}{c}") for c in (*NODE, "_leaf")])
        for x, p in ((l_nodes, "l"), (r_nodes, "r"))
    ]
    if radius is None:
        # one root for each value of ``on``
        met = tops[0].withColumn("_same", F.col("l_root")).join(tops[1].withColumn("_same", F.col("r_root")), [*on, "_same"])
    else:
        probes = cells.with_probe_cells(tables[0].where("_side = 'l'"), "lat", "lon", radius, unit, d, "_c")
        probes = probes.select(*on, F.col("_root").alias("l_root"), F.expr("concat_ws(':', _c_b, _c_l)").alias("r_root"))
        met = probes.distinct().join(tops[0], [*on, "l_root"]).join(tops[1], [*on, "r_root"])
    state = ["l_root", "l_node", "l_leaf", "r_root", "r_node", "r_leaf", "_u2"]
    pairs, still = met.withColumn("_u2", F.lit(reach2)).select(*on, *state), ~(F.col("l_leaf") & F.col("r_leaf"))
    deep, n_open = not nodes_are_roots, 0
    if deep:
        pairs, n_open = _stage_open(pairs, still, "nearest-pairs")
        tables.append(pairs)
    l_steps, r_steps = _steps(l_nodes, on, "l"), _steps(r_nodes, on, "r")
    bound = Window.partitionBy(*on, "l_root", "l_node")
    while n_open:
        here = pairs.select(
            *on, "l_root", F.col("l_node").alias("l_from"), "r_root", F.col("r_node").alias("r_from"), "_u2"
        )
        grown = (
            here.join(l_steps, [*on, "l_root", "l_from"]).join(r_steps, [*on, "r_root", "r_from"])
            .withColumn("_gap2", F.expr(_gap2()))
            .withColumn("_far2", F.expr(_far2()))
            .where(f"_gap2 <= _u2 * {1 + 1e-9!r}D + {SLACK!r}D * {SLACK!r}D")
        )
        least = F.min("_far2").over(bound)
        grown = grown.withColumn("_u2", F.least("_u2", least)).where(
            f"_gap2 <= pow(sqrt(_u2) + {SLACK!r}D, 2)"
        )
        pairs, n_open = _stage_open(grown.select(*on, *state), still, "nearest-pairs")
        tables.append(pairs)
    own = l_leaves.select(*on, F.col("_root").alias("l_root"), F.col("_node").alias("l_node"), "lat", "lon", *AXES)
    asked = pairs.select(*on, "l_root", "l_node", "r_root", "r_node", "_u2").join(own, [*on, "l_root", "l_node"])
    if deep:
        # the same bounds once more for each left spot, before it meets rows
        boxes = r_nodes.where("_leaf").select(*on, *[F.col(c).alias(f"r{c}") for c in (*NODE, *BOX, *AT)])
        asked = asked.join(boxes, [*on, "r_root", "r_node"]).withColumn("_gap2", F.expr(_gap2(point=True)))
        nearest = F.min(F.expr(_far2(point=True))).over(Window.partitionBy(*on, "lat", "lon"))
        asked = asked.withColumn("_u2", F.least("_u2", nearest))
        asked = asked.where(f"_gap2 <= pow(sqrt(_u2) + {SLACK!r}D, 2)")
    asked = asked.select(*on, "lat", "lon", "r_root", "r_node")
    others = r_leaves.select(
        *on, F.col("_root").alias("r_root"), F.col("_node").alias("r_node"), *[F.col(c).alias(f"r_{c}") for c in carried]
    )
    found = asked.join(others, [*on, "r_root", "r_node"])
    return found.select(*on, "lat", "lon", *[f"r_{c}" for c in carried]), tables


def _stage_open(rows: DataFrame, still: Column, label: str) -> tuple[DataFrame, int]:
    """Stage table of nodes or pairs, and the number of those that are to be followed further."""
    seen = Observation()
    staged = stage(rows.observe(seen, F.count(F.when(still, F.lit(1))).alias("n")), label)
    return staged, seen.get["n"]


def nearest_spots(
    left: DataFrame, right: DataFrame, key: str, on: Sequence[str] = (), radius: float | None = None, unit: str = "m"
) -> DataFrame:
    """``on``, lat, lon, ``_d`` and the ``key`` of the nearest right spot (ties: lowest key) of each left spot with one."""
    on = list(on)
    met, tables = candidates(left.select(*on, "lat", "lon"), right.select(*on, "lat", "lon", key), on, radius, unit)
    d = geo.haversine("lat", "lon", "r_lat", "r_lon", unit)
    judged = met.withColumn("_d", d)
    if radius is not None:
        judged = judged.where(f"_d <= {float(radius)!r}D")
    best = judged.groupBy(*on, "lat", "lon").agg(F.min(F.struct("_d", f"r_{key}")).alias("_b"))
    made = stage(best.select(*on, "lat", "lon", "_b._d", F.col(f"_b.r_{key}").alias(key)), "nearest-found")
    drop_stages(*tables)
    return made
