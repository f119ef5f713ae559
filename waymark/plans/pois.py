"""Playground, viewpoint and historic layers from map elements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark import fixed_values as fv
from waymark.functions import access, geo, tags
from waymark.functions.text import poi_id, text
from waymark.operators import elements, spatial
from waymark.operators.ranking import first_per_key, first_seen


def region_code(region: str) -> Column:
    """State or province of lat/lon; empty outside every box."""
    if region == "CA":
        return F.coalesce(spatial.box_code("lat", "lon", fv.PROVINCE_BOXES), F.lit(""))
    return F.coalesce(spatial.box_code("lat", "lon", fv.STATE_BOXES, fv.STATE_OVERLAPS), F.lit(""))


def layer(nodes: DataFrame, ways: DataFrame, relations: DataFrame | None, kind: str, region: str = "US") -> DataFrame:
    """Records of one POI kind: tag filter, points, validity box, first row per element."""
    found = elements.scan_elements(nodes, ways, relations, tags.poi_kind(kind))
    return records(elements.element_points(found, nodes, ways), kind, region)


def records(points: DataFrame, kind: str, region: str = "US") -> DataFrame:
    prefix, default_name = fv.POI_KINDS[kind]
    box = fv.CA_BOX if region == "CA" else fv.US_BOX
    rows = points.where(geo.valid_coordinate("lat", "lon", box))
    rows = first_seen(rows, ["osm_type", "osm_id"])
    name = tags.name_of(default=default_name)
    subtype = tags.tag("historic") if kind == "historic" else F.lit(None).cast("string")
    return rows.select(
        "osm_type", "osm_id", name.alias("name"), "lat", "lon", region_code(region).alias("state"), subtype.alias("subtype")
    ).select(
        poi_id(prefix, region, "state", "name", "osm_id").alias("id"),
        "*",
        F.concat_ws("/", F.lit("https://www.openstreetmap.org"), "osm_type", F.col("osm_id").cast("string")).alias("url"),
        tags.poi_tier("name", kind).alias("display_tier"),
    )


def embed(rows: DataFrame) -> DataFrame:
    return rows.select("id", "name", "lat", "lon", F.coalesce("state", F.lit("")).alias("state"), "url", "subtype")


def playgrounds_in_parks(playgrounds: DataFrame, ways: DataFrame, nodes: DataFrame, federal_edges: DataFrame | None = None, federal: DataFrame | None = None) -> DataFrame:
    """Playgrounds inside a named park; federal polygons come before mapped ones.

    ``federal``: polygon_id, park_name, priority; ``federal_edges``: its ring edges.
    """
    parks = ways.where(tags.named_park())
    rings = elements.way_rings(parks, nodes).withColumnRenamed("id", "polygon_id")
    edges = elements.ring_edges(rings).withColumn("polygon_id", F.concat(F.lit("osm:"), F.col("polygon_id").cast("string")))
    names = parks.select(
        F.concat(F.lit("osm:"), F.col("id").cast("string")).alias("polygon_id"),
        tags.name_of().alias("park_name"),
        F.struct(F.lit(1).alias("source"), F.col("id").alias("seq")).alias("priority"),
        F.lit("osm").alias("park_source"),
    )
    if federal is not None:
        edges = edges.unionByName(federal_edges.withColumn("polygon_id", F.concat(F.lit("nps:"), F.col("polygon_id").cast("string"))))
        names = names.unionByName(
            federal.select(
                F.concat(F.lit("nps:"), F.col("polygon_id").cast("string")).alias("polygon_id"),
                "park_name",
                F.struct(F.lit(0).alias("source"), F.col("priority").cast("bigint").alias("seq")).alias("priority"),
                F.lit("nps").alias("park_source"),
            )
        )
    hit = spatial.first_polygon(playgrounds, edges, names)
    return hit.where("polygon_id is not null").join(names.drop("priority"), "polygon_id").drop("polygon_id")


def access_features(points: DataFrame, roads: DataFrame, parking: DataFrame, limit: float = fv.SCENIC_MEASURE_M) -> DataFrame:
    """Nearest through road, any road, footpath and parking of each viewpoint, up to ``limit`` metres.

    ``roads``: lat1..lon2 and the flags lean, wide, path; ``parking``: id, lat, lon.
    """
    out = points
    for name in ("lean", "wide", "path"):
        out = spatial.nearest_segment(
            out, roads.where(F.col(name)), 0.0015, max_m=limit, output=f"d_{name}"
        ).withColumn(f"d_{name}", F.when(F.col(f"d_{name}") <= limit, geo.half_up(f"d_{name}", 10)))
    near = spatial.nearest_within(out, parking, limit, "m", distance="d_parking")
    return near.drop("near").withColumn("d_parking", geo.half_up("d_parking", 10))


def scenic_layer(points: DataFrame, roads: DataFrame, parking: DataFrame) -> DataFrame:
    """Viewpoints with road access, measured and judged."""
    measured = access_features(points, roads, parking)
    return measured.withColumn("include", access.scenic_include())


def road_flags(segments: DataFrame) -> DataFrame:
    """Way segments that carry their tags, with lean / wide / path flags."""
    return segments.select(
        "lat1", "lon1", "lat2", "lon2",
        tags.drivable(lean=True).alias("lean"), tags.drivable(lean=False).alias("wide"), tags.foot_path().alias("path"),
    ).where("lean or wide or path")


def status_against_kept(everything: DataFrame, kept: DataFrame, key: str = "id") -> DataFrame:
    """All rows, labelled kept or excluded."""
    ids = kept.select(key).distinct().withColumn("_k", F.lit(True))
    return everything.join(ids, key, "left").withColumn(
        "status", F.when(F.col("_k"), F.lit("kept")).otherwise(F.lit("excluded"))
    ).drop("_k")


def search(rows: DataFrame, columns: list[str], query: str = "", state: str = "") -> DataFrame:
    """Explorer filter: state equality and a case-insensitive substring over many columns."""
    out = rows
    if state:
        out = out.where(F.col("state") == state)
    needle = query.lower().strip()
    if needle:
        hay = F.lower(F.concat_ws(" ", *[F.nullif(F.col(c).cast("string"), F.lit("")) for c in columns]))
        out = out.where(hay.contains(needle))
    return out


def in_view(rows: DataFrame, south: float, west: float, north: float, east: float, limit: int | None = None, order: str = "id") -> DataFrame:
    """Rows in a map view; the viewer's row limit applies in key order."""
    hits = rows.where(geo.in_box("lat", "lon", south, west, north, east))
    return hits if limit is None else hits.orderBy(order).limit(limit)


def boundary_in_state(rows: DataFrame, state: str, column: str = "state") -> DataFrame:
    """Rows whose ``,`` or ``;`` separated state list holds the state."""
    listed = F.transform(F.split(text(column), "[,;]"), lambda s: F.trim(s))
    return rows.where(F.array_contains(listed, state))


def parts_of_regions(points: DataFrame, key: str) -> DataFrame:
    """Points read through overlapping sub-boxes of large provinces, each element once.

    Adds the province and the first part that holds the row.
    """
    parts = [(f"{code}/{part}", s, w, n, e) for code, part, s, w, n, e in fv.PROVINCE_PARTS]
    split = sorted({code for code, *_ in fv.PROVINCE_PARTS})
    whole = [(f"{code}/0", s, w, n, e) for code, s, w, n, e in fv.PROVINCE_BOXES if code not in split]
    tiles = [
        F.when(geo.in_box("lat", "lon", s, w, n, e), F.struct(F.lit(code.split("/")[0]).alias("province"), F.lit(int(code.split("/")[1])).alias("part")))
        for code, s, w, n, e in [*parts, *whole]
    ]
    hits = points.select("*", F.explode(F.filter(F.array(*tiles), lambda t: t.isNotNull())).alias("_t"))
    rows = hits.select(*points.columns, "_t.province", "_t.part")
    return first_per_key(rows, [key], ["province", "part"])
