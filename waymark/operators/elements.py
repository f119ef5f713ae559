"""Map elements (nodes, ways, relations) to points, segments and rings.

nodes: id, lat, lon, tags. ways: id, refs ARRAY<BIGINT>, tags. relations: id,
members ARRAY<STRUCT<type,ref,role>>, tags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.text import text


def scan_elements(nodes: DataFrame, ways: DataFrame, relations: DataFrame | None, predicate: Column) -> dict[str, DataFrame]:
    """Elements whose tags pass a predicate, by element type."""
    found = {"node": nodes.where(predicate), "way": ways.where(predicate)}
    if relations is not None:
        found["relation"] = relations.where(predicate)
    return found


def way_centres(ways: DataFrame, nodes: DataFrame, key: str = "id") -> DataFrame:
    """Mean of the listed node coordinates per way; repeated refs count again, missing nodes not."""
    refs = ways.select(F.col(key).alias("_way"), F.explode("refs").alias("_ref"))
    # repeated refs are counted before the join, so a closed or looping way sends each node once
    counted = refs.groupBy("_way", "_ref").agg(F.count(F.lit(1)).alias("_n"))
    return (
        counted.join(nodes.select(F.col("id").alias("_ref"), "lat", "lon"), "_ref")
        .groupBy("_way")
        .agg(
            (F.sum(F.col("lat") * F.col("_n")) / F.sum("_n")).alias("lat"),
            (F.sum(F.col("lon") * F.col("_n")) / F.sum("_n")).alias("lon"),
            F.sum("_n").alias("points"),
        )
        .withColumnRenamed("_way", key)
    )


def relation_centres(relations: DataFrame, ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Mean node coordinate of a relation's ways: outer or role-less members, else any way member."""
    members = relations.select("id", F.expr("filter(members, m -> m.type = 'way')").alias("m"))
    outer = F.filter("m", lambda m: text(m["role"]).isin("outer", ""))
    pool = members.select("id", F.when(F.size(outer) > 0, outer).otherwise(F.col("m")).alias("m"))
    hops = (
        pool.select("id", F.explode("m.ref").alias("_way"))
        .groupBy("id", "_way")
        .agg(F.count(F.lit(1)).alias("_times"))
    )
    way_refs = (
        ways.select(F.col("id").alias("_way"), F.explode("refs").alias("_ref"))
        .groupBy("_way", "_ref")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # a relation's nodes are weighed once per way: few ways of a relation share nodes, so no list of (relation, node) is made first
    weighted = (
        hops.join(way_refs, "_way")
        .select("id", "_ref", (F.col("_times") * F.col("_n")).alias("_w"))
        .join(nodes.select(F.col("id").alias("_ref"), "lat", "lon"), "_ref")
    )
    return weighted.groupBy("id").agg(
        (F.sum(F.col("lat") * F.col("_w")) / F.sum("_w")).alias("lat"),
        (F.sum(F.col("lon") * F.col("_w")) / F.sum("_w")).alias("lon"),
    )


def element_points(found: dict[str, DataFrame], nodes: DataFrame, ways: DataFrame) -> DataFrame:
    """All found elements as points: osm_type, osm_id, lat, lon, tags, and seq where the element tables have it."""
    carried = ["tags"] + (["seq"] if all("seq" in part.columns for part in found.values()) else [])

    def points(kind: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(kind).alias("osm_type"), F.col("id").alias("osm_id"), "lat", "lon", *carried)

    way = found["way"]
    out = points("node", found["node"])
    out = out.unionByName(points("way", way.select("id", *carried).join(way_centres(way, nodes), "id")))
    if "relation" in found:
        relation = found["relation"]
        centres = relation_centres(relation, ways, nodes)
        out = out.unionByName(points("relation", relation.select("id", *carried).join(centres, "id")))
    return out


def way_segments(ways: DataFrame, nodes: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Consecutive node pairs of each way; a missing node breaks the chain.

    Columns: way_id, seq, lat1, lon1, lat2, lon2 and the carried way columns.
    """
    pairs = F.arrays_zip(
        F.slice("refs", F.lit(1), F.greatest(F.size("refs") - 1, F.lit(0))).alias("a"),
        F.slice("refs", F.lit(2), F.greatest(F.size("refs") - 1, F.lit(0))).alias("b"),
    )
    steps = (
        ways.where(F.size("refs") > 1)
        .select(F.col("id").alias("way_id"), *carry, F.posexplode(pairs).alias("seq", "_p"))
        .select("way_id", *carry, "seq", F.col("_p.a").alias("_a"), F.col("_p.b").alias("_b"))
    )
    first = nodes.select(F.col("id").alias("_a"), F.col("lat").alias("lat1"), F.col("lon").alias("lon1"))
    second = nodes.select(F.col("id").alias("_b"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    return (
        steps.join(first, "_a").join(second, "_b").select("way_id", "seq", *carry, "lat1", "lon1", "lat2", "lon2")
    )


def way_rings(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Closed ring per way (id, ring); dropped when a node is missing or fewer than three points.

    The ring is as long as the way's own ref list, which already travels in one row.
    """
    refs = ways.select("id", F.size("refs").alias("_size"), F.posexplode("refs").alias("pos", "_ref"))
    placed = refs.join(nodes.select(F.col("id").alias("_ref"), "lat", "lon"), "_ref")
    rings = (
        placed.groupBy("id", "_size")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "lon", "lat"))).alias("_points"))
        .where((F.size("_points") == F.col("_size")) & (F.col("_size") >= 3))
    )
    ring = F.transform("_points", lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat")))
    first, last = F.element_at("_ring", 1), F.element_at("_ring", -1)
    open_ring = (first["lon"] != last["lon"]) | (first["lat"] != last["lat"])
    return rings.withColumn("_ring", ring).select(
        "id", F.when(open_ring, F.concat("_ring", F.array(first))).otherwise(F.col("_ring")).alias("ring")
    )


def ring_edges(rings: DataFrame, key: str = "polygon_id", ring_no: str | None = None) -> DataFrame:
    """One row per edge of each ring: key, ring, lat1, lon1, lat2, lon2."""
    n = F.size("ring")
    pairs = F.arrays_zip(F.slice("ring", F.lit(1), n - 1).alias("a"), F.slice("ring", F.lit(2), n - 1).alias("b"))
    return (
        rings.where(n >= 2)
        .select(key, (F.col(ring_no) if ring_no else F.lit(0)).alias("ring"), F.explode(pairs).alias("_e"))
        .select(
            key,
            "ring",
            F.col("_e.a.lat").alias("lat1"),
            F.col("_e.a.lon").alias("lon1"),
            F.col("_e.b.lat").alias("lat2"),
            F.col("_e.b.lon").alias("lon2"),
        )
    )
