"""Connected components over edge tables and over points within a radius."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import geo
from waymark.operators import cells
from waymark.operators.spatial import radius_join
from waymark.runtime import drop_stages, stage


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of an edge table (src, dst); component = least id.

    Alternating large-star and small-star rounds (Kiveris et al., 2014). Each round is two
    aggregations that combine before the shuffle, and the rounds grow with the logarithm of the
    component size, not with its diameter.
    """
    star = stage(
        edges.where("src <> dst")
        .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
        .distinct(),
        "edges",
    )
    mark = None
    while True:
        both = star.union(star.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u <> v").distinct(), "large-star")
        roots = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(roots, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(roots.select("u", F.col("m").alias("v")))
        )
        last, star = star, stage(small.where("u <> v").distinct(), "small-star")
        drop_stages(last, large)
        now = _fingerprint(star)
        if now == mark:
            break
        mark = now
    children = star.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return children.union(star.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _fingerprint(star: DataFrame) -> tuple:
    row = star.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]


def clique_degrees(radius: float, unit: str) -> float:
    """Height of the cells of :func:`clique_cells`."""
    return geo.degrees_for(radius, unit) / 1.5


def clique_cells(df: DataFrame, radius: float, unit: str) -> DataFrame:
    """Add cells (``q_b``, ``q_l``) so small that any two rows in one are within ``radius``."""
    d = clique_degrees(radius, unit)
    if d > 0.3:
        raise ValueError("clique cells need a radius below about 0.45 degrees")
    return cells.with_cell(df, "lat", "lon", d, "q")


def bounds_columns() -> list[Column]:
    return [
        F.min("lat").alias("south"),
        F.min("lon").alias("west"),
        F.max("lat").alias("north"),
        F.max("lon").alias("east"),
    ]


def least_distance_to_bounds(lat: str, lon: str, b: str, unit: str) -> Column:
    """Lower bound of the distance from a point to any row in a bounding box; exact for one spot."""
    near_lat = f"least(greatest({lat}, {b}south), {b}north)"
    # the turn of the globe on which the point is closest to the box
    turned = f"({lon} + case when {lon} - {b}east > 180 then -360D when {b}west - {lon} > 180 then 360D else 0D end)"
    near_lon = f"least(greatest({turned}, {b}west), {b}east)"
    d = geo.haversine(lat, lon, near_lat, near_lon, unit)
    return F.when(F.expr(f"{b}south = {b}north and {b}west = {b}east"), d).otherwise(d * 0.999)


def _box_gap(unit: str) -> Column:
    """Lower bound of the distance between two bounding boxes (l_ and r_)."""
    one_degree = 1.0 / geo.degrees_for(1.0, unit) * 0.999
    lat_gap = "greatest(l_south - r_north, r_south - l_north, 0D)"
    # either way round: between the boxes, or over the date line around both
    span = "greatest(l_east, r_east) - least(l_west, r_west)"
    lon_gap = f"least(greatest(l_west - r_east, r_west - l_east, 0D), greatest(360D - ({span}), 0D))"
    far = "least(greatest(abs(l_north), abs(l_south), abs(r_north), abs(r_south)), 89.9D)"
    return F.expr(f"greatest({lat_gap}, {lon_gap} * cos(radians({far}))) * {one_degree!r}D")


def proximity_components(
    points: DataFrame, radius: float, unit: str = "m", on: Sequence[str] = (), key: str = "id", separate: str | None = None
) -> DataFrame:
    """(key, component) where rows within ``radius`` that agree on ``on`` are linked.

    ``separate``: a text column whose values must agree too where both are filled; a row with an
    empty value may link rows of any value.

    All rows of one clique cell are linked by definition, so edges are only looked for between
    cells: two cells are linked when their representatives are close, not linked when their boxes
    are too far apart, and only the pairs in between go down to finer cells and at last to the
    distinct spots near the common border. Pairs of rows inside a crowd are never listed.
    """
    traits = list(on)
    if separate is not None:
        points = points.withColumn("_value", F.coalesce(F.col(separate), F.lit("")))
        traits.append("_value")
    rows = stage(clique_cells(points.select(key, "lat", "lon", *traits), radius, unit), "clique")
    spot = F.min(F.struct("lat", "lon"))
    groups = stage(
        rows.groupBy(*traits, "q_b", "q_l").agg(F.min(key).alias("node"), spot.alias("at"), *bounds_columns()).select(
            "*", F.col("at.lat").alias("lat"), F.col("at.lon").alias("lon")
        ).drop("at"),
        "groups",
    )
    reach = radius_join(groups, groups, radius * 3, unit, on, distance="_d").where("l_node < r_node")
    if separate is not None:
        reach = reach.where("l__value = r__value or l__value = '' or r__value = ''")
    judged = reach.where(_box_gap(unit) <= radius).select(
        F.col("l_node").alias("src"), F.col("r_node").alias("dst"), (F.col("_d") <= radius).alias("sure")
    )
    judged = stage(judged, "judged")
    edges = judged.where("sure").select("src", "dst")
    unsure = judged.where("not sure").select("src", "dst")
    if not unsure.isEmpty():
        edges = edges.union(_border_edges(rows, groups, unsure, radius, unit, traits))
    linked = connected_components(edges)
    of_group = groups.join(linked, groups["node"] == linked["id"], "left").select(
        *traits, "q_b", "q_l", F.coalesce("component", "node").alias("component")
    )
    same = (rows["q_b"] == of_group["q_b"]) & (rows["q_l"] == of_group["q_l"])
    for c in traits:
        same = same & (rows[c] == of_group[c])
    return rows.join(of_group, same).select(rows[key], "component")


def _border_edges(
    rows: DataFrame, groups: DataFrame, unsure: DataFrame, radius: float, unit: str, on: list[str]
) -> DataFrame:
    """Group pairs holding at least one pair of rows within the radius."""
    same = (rows["q_b"] == groups["q_b"]) & (rows["q_l"] == groups["q_l"])
    for c in on:
        same = same & (rows[c] == groups[c])
    involved = unsure.select(F.col("src").alias("node")).union(unsure.select(F.col("dst").alias("node"))).distinct()
    spots = (
        rows.join(groups.join(involved, "node", "left_semi"), same)
        .select("node", rows["lat"], rows["lon"])
        .distinct()
    )
    fine = stage(
        cells.with_cell(spots, "lat", "lon", geo.degrees_for(radius, unit) / 12, "f")
        .groupBy("node", "f_b", "f_l")
        .agg(F.min(F.struct("lat", "lon")).alias("at"), *bounds_columns()),
        "fine",
    )

    def side(df: DataFrame, p: str) -> DataFrame:
        return df.select(*[F.col(c).alias(p + c) for c in df.columns])

    meet = (
        unsure.join(side(fine, "l_"), F.col("src") == F.col("l_node"))
        .join(side(fine, "r_"), F.col("dst") == F.col("r_node"))
        .where(_box_gap(unit) <= radius)
    )
    d = geo.haversine("l_at.lat", "l_at.lon", "r_at.lat", "r_at.lon", unit)
    judged = stage(
        meet.select("src", "dst", "l_f_b", "l_f_l", "r_f_b", "r_f_l", (d <= radius).alias("sure")), "border"
    )
    sure = judged.where("sure").select("src", "dst").distinct()
    rest = judged.where("not sure").join(sure, ["src", "dst"], "left_anti")
    placed = cells.with_cell(spots, "lat", "lon", geo.degrees_for(radius, unit) / 12, "f")
    exact = (
        rest.join(
            side(placed, "a_"),
            (F.col("src") == F.col("a_node")) & (F.col("l_f_b") == F.col("a_f_b")) & (F.col("l_f_l") == F.col("a_f_l")),
        )
        .join(
            side(placed, "b_"),
            (F.col("dst") == F.col("b_node")) & (F.col("r_f_b") == F.col("b_f_b")) & (F.col("r_f_l") == F.col("b_f_l")),
        )
        .where(geo.haversine("a_lat", "a_lon", "b_lat", "b_lon", unit) <= radius)
        .select("src", "dst")
        .distinct()
    )
    return sure.union(exact)
