"""Queries: coordinates, cells, region assignment, spatial joins, map elements, routes."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.common import (
    CAMPS, KM, M, MI, REFS, SEGMENTS, SPOTS, STATIONS, boxes_sql, camps, cell_overlap, coords, coords_sql, foot_degrees,
    foot_local, half, hav, near, nodes, query, segments, spots, stations, table, ways,
)
from waymark import fixed_values as fv
from waymark.functions import access, geo, tags
from waymark.operators import elements, matching, routes, spatial
from waymark.operators.ranking import first_per_key
from waymark.plans import camping as camping_plans
from waymark.plans import fuel as fuel_plans
from waymark.plans import pois


# ---- P1, F1-F5, F22 ---------------------------------------------------------------------------------

_SHIFTED = (
    "shifted AS (SELECT id, CASE WHEN id % 11 = 0 THEN 0 WHEN id % 13 = 0 THEN NULL ELSE lat + (id % 5) * 12 END AS lat, "
    "CASE WHEN id % 11 = 0 THEN 0 ELSE lon + (id % 3) * 25 END AS lon FROM spots)"
)


def _shifted(spark, sf):
    lat = F.when(F.expr("id % 11 = 0"), 0).when(F.expr("id % 13 = 0"), None).otherwise(F.expr("lat + (id % 5) * 12"))
    lon = F.when(F.expr("id % 11 = 0"), 0).otherwise(F.expr("lon + (id % 3) * 25"))
    return spots(spark, sf).withColumn("lat", lat).withColumn("lon", lon)


@query(
    "poi_valid_filter",
    f"""WITH {SPOTS}, {_SHIFTED}
    SELECT id, CAST(coalesce(lat BETWEEN 24 AND 72 AND lon BETWEEN -180 AND -65 AND NOT (lat = 0 AND lon = 0), false) AS INTEGER) AS us_ok,
      CAST(coalesce(lat BETWEEN 41 AND 84 AND lon BETWEEN -141 AND -52 AND NOT (lat = 0 AND lon = 0), false) AS INTEGER) AS ca_ok
    FROM shifted""",
)
def poi_valid_filter(spark, sf):
    return _shifted(spark, sf).select(
        "id",
        geo.valid_coordinate("lat", "lon", fv.US_BOX).cast("int").alias("us_ok"),
        geo.valid_coordinate("lat", "lon", fv.CA_BOX).cast("int").alias("ca_ok"),
    )


@query(
    "distance_units",
    f"""WITH {SPOTS} SELECT id, {half(hav('lat', 'lon', '40e0', '-100e0', MI), 1000)} AS mi,
      {half(hav('lat', 'lon', '40e0', '-100e0', KM), 1000)} AS km, {half(hav('lat', 'lon', '40e0', '-100e0', M), 10)} AS m,
      {half('lon', 1000)} AS lon3, ceil(250e0 / least(0.0015e0 * 111320e0, 0.0015e0 * 111320e0 * cos(radians(lat)))) + 1 AS reach
    FROM spots""",
)
def distance_units(spark, sf):
    p = spots(spark, sf)
    c = (F.lit(40.0), F.lit(-100.0))
    return p.select(
        "id",
        geo.half_up(geo.haversine("lat", "lon", *c, "mi"), 1000).alias("mi"),
        geo.half_up(geo.haversine("lat", "lon", *c, "km"), 1000).alias("km"),
        geo.half_up(geo.haversine("lat", "lon", *c, "m"), 10).alias("m"),
        geo.half_up("lon", 1000).alias("lon3"),
        geo.grid_radius_cells(250.0, 0.0015, "lat").cast("double").alias("reach"),
    )


@query(
    "cell_keys",
    f"""WITH {SPOTS} SELECT concat(CAST(CAST(floor(lat / 0.5e0) AS BIGINT) AS VARCHAR), ':', CAST(CAST(floor(lon / 0.5e0) AS BIGINT) AS VARCHAR)) AS tile,
      count(*) AS n, min(id) AS first_id FROM spots GROUP BY 1""",
)
def cell_keys(spark, sf):
    return spots(spark, sf).groupBy(geo.fixed_cell("lat", "lon", 0.5).alias("tile")).agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id")
    )


# ---- J5, J6, R22 ------------------------------------------------------------------------------------

_BOX_PICK = """CASE WHEN list_contains(codes, 'ID') AND list_contains(codes, 'MT') THEN CASE WHEN lon > -116.050694 THEN 'MT' ELSE 'ID' END
      WHEN list_contains(codes, 'ID') AND list_contains(codes, 'WY') THEN CASE WHEN lon > -111.05 THEN 'WY' ELSE 'ID' END
      WHEN list_contains(codes, 'MT') AND list_contains(codes, 'WY') THEN CASE WHEN lon > -104.05 THEN 'MT' ELSE 'WY' END
      ELSE codes[1] END"""
# points are spread over the whole map so that many boxes and overlaps are met
_SPREAD = """spread AS (SELECT id, 25 + (id * 7919 % 2500) / 100e0 AS lat, -124 + (id * 104729 % 5500) / 100e0 AS lon FROM spots)"""


def _spread(spark, sf):
    return spots(spark, sf).select(
        "id", F.expr("25 + (id * 7919 % 2500) / 100D").alias("lat"), F.expr("-124 + (id * 104729 % 5500) / 100D").alias("lon"),
        "segment",
    )


@query(
    "state_box_join",
    f"""WITH {SPOTS}, {_SPREAD}, {boxes_sql(fv.STATE_BOXES)},
    hits AS (SELECT p.id, any_value(p.lon) AS lon, list(b.code ORDER BY b.seq) AS codes FROM spread p JOIN boxes b
      ON p.lat BETWEEN b.south AND b.north AND p.lon BETWEEN b.west AND b.east GROUP BY p.id)
    SELECT p.id, {_BOX_PICK.replace('lon >', 'h.lon >')} AS state FROM spread p LEFT JOIN hits h ON h.id = p.id""",
)
def state_box_join(spark, sf):
    return _spread(spark, sf).select(
        "id", spatial.box_code("lat", "lon", fv.STATE_BOXES, fv.STATE_OVERLAPS).alias("state")
    )


@query(
    "province_box_table_join",
    f"""WITH {SPOTS}, north AS (SELECT id, lat + 20 AS lat, lon AS lon FROM spots), {boxes_sql(fv.PROVINCE_BOXES)},
    hits AS (SELECT p.id, min_by(b.code, b.seq) AS province FROM north p JOIN boxes b
      ON p.lat BETWEEN b.south AND b.north AND p.lon BETWEEN b.west AND b.east GROUP BY p.id)
    SELECT p.id, h.province FROM north p LEFT JOIN hits h ON h.id = p.id""",
)
def province_box_table_join(spark, sf):
    boxes = spark.createDataFrame(
        [(c, i, s, w, n, e) for i, (c, s, w, n, e) in enumerate(fv.PROVINCE_BOXES)],
        "code string, seq int, south double, west double, north double, east double",
    )
    points = spots(spark, sf).withColumn("lat", F.col("lat") + 20).select("id", "lat", "lon")
    return spatial.box_join(points, boxes, output="province").select("id", "province")


@query(
    "nearest_centroid",
    f"""WITH {SPOTS}, {_SPREAD}, centres(seq, code, lat, lon) AS (VALUES {', '.join(f"({i}, '{c}', {a}e0, {b}e0)" for i, (c, a, b) in enumerate(fv.STATE_CENTRES))}),
    d AS (SELECT p.id, c.seq, c.code, {hav('p.lat', 'p.lon', 'c.lat', 'c.lon')} AS d FROM spread p CROSS JOIN centres c)
    SELECT id, code AS state FROM d QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, seq) = 1""",
)
def nearest_centroid(spark, sf):
    return _spread(spark, sf).select("id", spatial.nearest_centre_code("lat", "lon", fv.STATE_CENTRES).alias("state"))


@query(
    "state_correction",
    f"""WITH {SPOTS}, {_SPREAD}, {boxes_sql(fv.STATE_BOXES)},
    hits AS (SELECT p.id, any_value(p.lon) AS lon, list(b.code ORDER BY b.seq) AS codes FROM spread p JOIN boxes b
      ON p.lat BETWEEN b.south AND b.north AND p.lon BETWEEN b.west AND b.east GROUP BY p.id),
    given AS (SELECT p.id, ['TX', '', 'CO', 'MT'][CAST(p.id % 4 AS INTEGER) + 1] AS prev, {_BOX_PICK.replace('lon >', 'h.lon >')} AS st
      FROM spread p LEFT JOIN hits h ON h.id = p.id)
    SELECT id, coalesce(st, prev) AS state,
      CASE WHEN st IS NOT NULL AND prev <> '' AND prev <> st THEN 'NO_STATE,STATE_CORRECTED' WHEN st IS NOT NULL THEN '' ELSE 'NO_STATE' END AS flags,
      CASE WHEN st IS NOT NULL AND prev <> '' AND prev <> st THEN 'missing-state,state-corrected-from-coords' WHEN st IS NOT NULL THEN '' ELSE 'missing-state' END AS reasons,
      CASE WHEN st IS NOT NULL AND prev <> '' AND prev <> st THEN 1 WHEN st IS NOT NULL THEN 0 ELSE 1 END AS review FROM given""",
)
def state_correction(spark, sf):
    rows = (
        _spread(spark, sf)
        .withColumn("state", F.expr("element_at(array('TX', '', 'CO', 'MT'), cast(id % 4 as int) + 1)"))
        .withColumn("map_flags", F.array(F.lit("NO_STATE")))
        .withColumn("review_reasons", F.array(F.lit("missing-state")))
        .withColumn("needs_review", F.lit(True))
    )
    out = fuel_plans.correct_state(rows)
    return out.select(
        "id", "state", F.array_join("map_flags", ",").alias("flags"), F.array_join("review_reasons", ",").alias("reasons"),
        F.col("needs_review").cast("int").alias("review"),
    )


@query(
    "region_parts",
    f"""WITH {SPOTS}, north AS (SELECT id, lat + 20 AS lat, lon AS lon FROM spots),
    tiles(province, part, south, west, north_, east) AS (VALUES {', '.join(f"('{c}', {p}, {s}e0, {w}e0, {n}e0, {e}e0)" for c, p, s, w, n, e in fv.PROVINCE_PARTS)},
      {', '.join(f"('{c}', 0, {s}e0, {w}e0, {n}e0, {e}e0)" for c, s, w, n, e in fv.PROVINCE_BOXES if c not in ('AB', 'BC', 'ON', 'QC'))})
    SELECT p.id, t.province, t.part FROM north p JOIN tiles t ON p.lat BETWEEN t.south AND t.north_ AND p.lon BETWEEN t.west AND t.east
    QUALIFY row_number() OVER (PARTITION BY p.id ORDER BY t.province, t.part) = 1""",
)
def region_parts(spark, sf):
    points = spots(spark, sf).withColumn("lat", F.col("lat") + 20).select("id", "lat", "lon")
    return pois.parts_of_regions(points, "id").select("id", "province", "part")


# ---- J8 - J11 ---------------------------------------------------------------------------------------


@query(
    "radius_pairs",
    f"""WITH {SPOTS} SELECT a.id AS a_id, b.id AS b_id, {half(hav('a.lat', 'a.lon', 'b.lat', 'b.lon', MI), 1000)} AS mi
    FROM spots a JOIN spots b ON a.id < b.id AND {near('a', 'b', 0.25)}""",
)
def radius_pairs(spark, sf):
    p = spots(spark, sf).select("id", "lat", "lon")
    return spatial.self_pairs(p, 0.25, "mi").select(
        F.col("l_id").alias("a_id"), F.col("r_id").alias("b_id"), geo.half_up("distance", 1000).alias("mi")
    )


_NEAREST = """SELECT id, store_id, mi FROM (SELECT c.*, row_number() OVER (PARTITION BY id ORDER BY d, store_id) AS rn FROM c) WHERE rn = 1"""


@query(
    "nearest_in_radius",
    f"""WITH {SPOTS}, {STATIONS}, c AS (SELECT p.id, s.id AS store_id, {hav('p.lat', 'p.lon', 's.lat', 's.lon')} AS d,
      {half(hav('p.lat', 'p.lon', 's.lat', 's.lon'), 10)} AS mi FROM spots p JOIN stations s ON {near('p', 's', 350.0, M)}),
    best AS ({_NEAREST}) SELECT p.id, b.store_id, b.mi AS metres FROM spots p LEFT JOIN best b ON b.id = p.id""",
)
def nearest_in_radius(spark, sf):
    s = stations(spark, sf).select(F.col("id").alias("store_id"), "lat", "lon")
    hit = spatial.nearest_within(spots(spark, sf), s, 350.0, "m", right_key="store_id")
    return hit.select("id", F.col("near.store_id").alias("store_id"), geo.half_up("distance", 10).alias("metres"))


@query(
    "nearest_official",
    f"""WITH {STATIONS}, shops AS (SELECT s_suppkey AS store_id, {coords_sql('s_suppkey * 13')} FROM supplier),
    c AS (SELECT p.id, s.store_id, {hav('p.lat', 'p.lon', 's.lat', 's.lon', MI)} AS d,
      {half(hav('p.lat', 'p.lon', 's.lat', 's.lon', MI), 1000)} AS mi FROM stations p CROSS JOIN shops s)
    {_NEAREST}""",
)
def nearest_official(spark, sf):
    shops = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("store_id"), *coords("s_suppkey * 13"))
    hit = spatial.nearest_any(stations(spark, sf), shops, "mi", right_key="store_id")
    return hit.select("id", F.col("near.store_id").alias("store_id"), geo.half_up("distance", 1000).alias("mi"))


@query(
    "brand_stamp",
    f"""WITH {SPOTS}, {STATIONS}, s AS (SELECT id AS store_id, lat, lon, size, size % 5 AS lane, CASE WHEN size > 10 THEN concat('type-', size % 3) END AS type FROM stations),
    c AS (SELECT p.id, s.store_id, s.type, {hav('p.lat', 'p.lon', 's.lat', 's.lon', MI)} AS d FROM spots p JOIN s ON p.lane = s.lane AND {near('p', 's', 0.5)}),
    best AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, store_id) = 1)
    SELECT p.id, coalesce(b.type, 'default') AS type, b.store_id AS stamped_by FROM spots p LEFT JOIN best b ON b.id = p.id""",
)
def brand_stamp(spark, sf):
    s = stations(spark, sf).select(
        F.col("id").alias("store_id"), "lat", "lon", F.expr("cast(size % 5 as bigint)").alias("lane"),
        F.when(F.col("size") > 10, F.concat(F.lit("type-"), (F.col("size") % 3).cast("string"))).alias("type"),
    )
    rows = spots(spark, sf).withColumn("type", F.lit("default"))
    return matching.stamp_nearest(rows, s, 0.5, "mi", ["lane"], ["type"]).select("id", "type", "stamped_by")


# ---- J1 - J4, J7 ------------------------------------------------------------------------------------


@query(
    "way_centroid",
    f"""WITH {REFS} SELECT r.way_id AS id, {half('avg(n.lat)', 1000000000)} AS lat, {half('avg(n.lon)', 1000000000)} AS lon, count(*) AS points
    FROM refs r JOIN nodes n ON n.id = r.ref GROUP BY r.way_id""",
)
def way_centroid(spark, sf):
    c = elements.way_centres(ways(spark, sf), nodes(spark, sf))
    return c.select("id", geo.half_up("lat", 1e9).alias("lat"), geo.half_up("lon", 1e9).alias("lon"), "points")


def _relations(spark, sf):
    """Customers as relations: their orders are the members, the status letter gives the role."""
    role = F.expr("case o_orderstatus when 'F' then 'outer' when 'O' then 'inner' else 'link' end")
    member = F.struct(
        F.when(F.expr("o_orderkey % 10 = 0"), F.lit("node")).otherwise(F.lit("way")).alias("type"),
        F.col("o_orderkey").alias("ref"), role.alias("role"),
    )
    return table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.collect_list(member).alias("members"))


@query(
    "relation_centroid",
    f"""WITH {REFS}, m AS (SELECT o_custkey AS id, o_orderkey AS way_id, o_orderstatus = 'F' AS is_outer FROM orders WHERE o_orderkey % 10 <> 0),
    pool AS (SELECT id, way_id FROM (SELECT m.*, bool_or(is_outer) OVER (PARTITION BY id) AS any_outer FROM m) WHERE is_outer OR NOT any_outer)
    SELECT p.id, {half('avg(n.lat)', 1000000000)} AS lat, {half('avg(n.lon)', 1000000000)} AS lon
    FROM pool p JOIN refs r ON r.way_id = p.way_id JOIN nodes n ON n.id = r.ref GROUP BY p.id""",
)
def relation_centroid(spark, sf):
    c = elements.relation_centres(_relations(spark, sf), ways(spark, sf), nodes(spark, sf))
    return c.select("id", geo.half_up("lat", 1e9).alias("lat"), geo.half_up("lon", 1e9).alias("lon"))


@query(
    "way_segments",
    f"""WITH {REFS}, nxt AS (SELECT way_id, pos, ref, lead(ref) OVER (PARTITION BY way_id ORDER BY pos) AS nref FROM refs)
    SELECT x.way_id, count(*) AS segments, {half('sum(' + hav('a.lat', 'a.lon', 'b.lat', 'b.lon', KM) + ')', 1000)} AS km
    FROM nxt x JOIN nodes a ON a.id = x.ref JOIN nodes b ON b.id = x.nref GROUP BY x.way_id""",
)
def way_segments(spark, sf):
    s = elements.way_segments(ways(spark, sf), nodes(spark, sf))
    return s.groupBy("way_id").agg(
        F.count(F.lit(1)).alias("segments"),
        geo.half_up(F.sum(geo.haversine("lat1", "lon1", "lat2", "lon2", "km")), 1000).alias("km"),
    )


@query(
    "ring_build",
    f"""WITH {REFS}, j AS (SELECT r.way_id, count(*) AS refs, count(n.id) AS found, count(DISTINCT r.pos) AS points,
      min(n.lat) AS south, max(n.lon) AS east, max(CASE WHEN r.pos = 0 THEN r.ref END) AS first_ref,
      max_by(r.ref, r.pos) AS last_ref FROM refs r LEFT JOIN nodes n ON n.id = r.ref GROUP BY r.way_id)
    SELECT way_id AS id, refs + CASE WHEN first_ref <> last_ref THEN 1 ELSE 0 END AS points, south, east FROM j WHERE refs = found AND refs >= 3""",
)
def ring_build(spark, sf):
    r = elements.way_rings(ways(spark, sf), nodes(spark, sf)).withColumn("b", geo.ring_bounds("ring"))
    return r.select(
        "id", F.size("ring").cast("bigint").alias("points"), F.col("b.south").alias("south"), F.col("b.east").alias("east")
    )


_RING = [(60, 0), (45, 45), (0, 70), (-50, 40), (-70, 0), (-45, -45), (0, -60), (45, -40), (60, 0)]
_HOLE = [(20, 0), (0, 20), (-20, 0), (0, -20), (20, 0)]


def _polygon_edges(spark, sf):
    """Octagons around the suppliers; every second one has a hole."""
    base = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("polygon_id"), *coords("s_suppkey * 7"))

    def ring(points):
        return [
            F.struct(F.lit(a[0]).alias("a"), F.lit(a[1]).alias("b"), F.lit(b[0]).alias("c"), F.lit(b[1]).alias("d"))
            for a, b in zip(points, points[1:])
        ]

    outer = base.select("polygon_id", "lat", "lon", F.lit(0).alias("ring"), F.explode(F.array(*ring(_RING))).alias("e"))
    hole = base.where("polygon_id % 2 = 0").select(
        "polygon_id", "lat", "lon", F.lit(1).alias("ring"), F.explode(F.array(*ring(_HOLE))).alias("e")
    )
    return outer.union(hole).select(
        "polygon_id", "ring",
        (F.col("lat") + F.col("e.a") / 2000.0).alias("lat1"), (F.col("lon") + F.col("e.b") / 2000.0).alias("lon1"),
        (F.col("lat") + F.col("e.c") / 2000.0).alias("lat2"), (F.col("lon") + F.col("e.d") / 2000.0).alias("lon2"),
    )


def _ring_values(points):
    return ", ".join(f"({a[0]}, {a[1]}, {b[0]}, {b[1]})" for a, b in zip(points, points[1:]))


_EDGES = f"""base AS (SELECT s_suppkey AS polygon_id, {coords_sql('s_suppkey * 7')} FROM supplier),
    o(a, b, c, d) AS (VALUES {_ring_values(_RING)}), h(a, b, c, d) AS (VALUES {_ring_values(_HOLE)}),
    e AS (SELECT polygon_id, 0 AS ring, lat + a / 2000e0 AS lat1, lon + b / 2000e0 AS lon1, lat + c / 2000e0 AS lat2, lon + d / 2000e0 AS lon2 FROM base, o
      UNION ALL SELECT polygon_id, 1, lat + a / 2000e0, lon + b / 2000e0, lat + c / 2000e0, lon + d / 2000e0 FROM base, h WHERE polygon_id % 2 = 0),
    cross_ AS (SELECT p.id, e.polygon_id, e.ring, count(*) % 2 AS odd FROM spots p JOIN e ON (e.lat1 > p.lat) <> (e.lat2 > p.lat)
      AND p.lon < (e.lon2 - e.lon1) * (p.lat - e.lat1) / (e.lat2 - e.lat1) + e.lon1 GROUP BY ALL),
    inside AS (SELECT id, polygon_id FROM cross_ GROUP BY ALL HAVING max(CASE WHEN ring = 0 THEN odd ELSE 0 END) = 1 AND max(CASE WHEN ring = 1 THEN odd ELSE 0 END) = 0)"""


@query("points_in_polygons", f"WITH {SPOTS}, {_EDGES} SELECT id, polygon_id FROM inside")
def points_in_polygons(spark, sf):
    return spatial.points_in_polygons(spots(spark, sf), _polygon_edges(spark, sf), 0.02)


@query(
    "first_polygon",
    f"""WITH {SPOTS}, {_EDGES}, f AS (SELECT id, min_by(polygon_id, (CASE WHEN polygon_id % 3 = 0 THEN 0 ELSE 1 END) * 1000000 + polygon_id) AS polygon_id FROM inside GROUP BY id)
    SELECT p.id, f.polygon_id FROM spots p LEFT JOIN f ON f.id = p.id""",
)
def first_polygon(spark, sf):
    polygons = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("polygon_id"), F.expr("if(s_suppkey % 3 = 0, 0, 1) * 1000000 + s_suppkey").alias("priority")
    )
    hit = spatial.first_polygon(spots(spark, sf).select("id", "lat", "lon"), _polygon_edges(spark, sf), polygons, 0.02)
    return hit.select("id", "polygon_id")


# ---- J13 - J19, R19 - R21 ---------------------------------------------------------------------------


@query(
    "point_to_segment",
    f"""WITH {SPOTS}, {SEGMENTS}, d AS (SELECT p.id, min({foot_degrees()}) AS deg FROM spots p JOIN segments s ON {cell_overlap(0.02, 1)} GROUP BY p.id)
    SELECT p.id, {half('d.deg', 1)} AS metres FROM spots p LEFT JOIN d ON d.id = p.id""",
)
def point_to_segment(spark, sf):
    out = spatial.nearest_segment(spots(spark, sf), segments(spark, sf), 0.02, 1, local_plane=False)
    return out.select("id", geo.half_up("distance_m", 1).alias("metres"))


_REACH = "(CAST(ceil(250e0 / least(0.0015e0 * 111320e0, 0.0015e0 * 111320e0 * cos(radians(p.lat)))) AS INTEGER) + 1)"
_NEAR_PARK = f"""(SELECT p.id, min({hav('p.lat', 'p.lon', 's.lat', 's.lon')}) AS d FROM spots p JOIN stations s ON {near('p', 's', 250.0, M)} WHERE s.size % 4 = 0 GROUP BY p.id)"""


def _nearest_class(cond: str) -> str:
    overlap = cell_overlap(0.0015, 0).replace(" - 0", f" - {_REACH}").replace(" + 0", f" + {_REACH}")
    return (
        f"(SELECT p.id, min({foot_local()}) AS d FROM spots p JOIN segments s ON abs(p.lat - s.lat1) < 0.02 AND {overlap} "
        f"WHERE {cond} GROUP BY p.id)"
    )


_FEATURES = f"""l AS {_nearest_class('s.road_class = 0')}, w AS {_nearest_class('s.road_class <= 1')}, t AS {_nearest_class('s.road_class = 2')}, k AS {_NEAR_PARK},
    f AS (SELECT p.id, CASE WHEN l.d <= 250 THEN {half('l.d', 10)} END AS d_lean, CASE WHEN w.d <= 250 THEN {half('w.d', 10)} END AS d_wide,
      CASE WHEN t.d <= 250 THEN {half('t.d', 10)} END AS d_path, {half('k.d', 10)} AS d_parking
      FROM spots p LEFT JOIN l ON l.id = p.id LEFT JOIN w ON w.id = p.id LEFT JOIN t ON t.id = p.id LEFT JOIN k ON k.id = p.id)"""


def _features(spark, sf):
    s = segments(spark, sf)
    roads = s.select(
        "lat1", "lon1", "lat2", "lon2", (F.col("road_class") == 0).alias("lean"), (F.col("road_class") <= 1).alias("wide"),
        (F.col("road_class") == 2).alias("path"),
    )
    parking = stations(spark, sf).where("size % 4 = 0").select("id", "lat", "lon")
    return pois.access_features(spots(spark, sf).select("id", "lat", "lon"), roads, parking)


@query("access_features", f"WITH {SPOTS}, {STATIONS}, {SEGMENTS}, {_FEATURES} SELECT id, d_lean, d_wide, d_path, d_parking FROM f")
def access_features(spark, sf):
    return _features(spark, sf).select("id", "d_lean", "d_wide", "d_path", "d_parking")


_INCLUDE = """CASE WHEN d_lean IS NULL OR d_lean > 135 THEN 0 WHEN d_parking <= 100 THEN 1 WHEN d_path = 0 THEN 0
      WHEN d_path IS NULL OR d_lean <= 50 THEN 1 WHEN d_path > 45 THEN 1 ELSE 0 END"""


@query("scenic_include", f"WITH {SPOTS}, {STATIONS}, {SEGMENTS}, {_FEATURES} SELECT id, {_INCLUDE} AS include FROM f")
def scenic_include(spark, sf):
    return _features(spark, sf).select("id", access.scenic_include().cast("int").alias("include"))


_STRATEGY_SQL = {
    "A-distance-120": "d_lean <= 120",
    "B-distance-80": "d_lean <= 80",
    "C-wide-60-and-lean-120": "d_lean <= 120 AND d_wide <= 60",
    "D-parking-within-100m": "d_lean <= 120 AND d_parking <= 100",
    "E-parking-within-150m": "d_lean <= 120 AND d_parking <= 150",
    "F-exclude-path-closer-than-road": "d_lean <= 120 AND (d_path IS NULL OR d_path > d_lean)",
    "G-exclude-path-within-50m": "d_lean <= 120 AND (d_path IS NULL OR d_path > 50)",
    "H-exclude-path-40-unless-parking-80": "d_lean <= 120 AND (coalesce(d_parking <= 80, false) OR d_path IS NULL OR d_path > 40)",
    "I-exclude-path-45-unless-parking-100": "d_lean <= 120 AND (coalesce(d_parking <= 100, false) OR d_path IS NULL OR d_path > 45)",
    "J-path-ratio-0.7": "d_lean <= 120 AND (d_path IS NULL OR CASE WHEN d_lean = 0 THEN d_path > 0 ELSE d_path / d_lean >= 0.7 END)",
    "K-wide-35-or-path-40-parking-80": "d_lean <= 120 AND (coalesce(d_wide <= 35, false) OR coalesce(d_parking <= 80, false) OR d_path IS NULL OR d_path > 40)",
    "L-production-filter-v3": f"{_INCLUDE} = 1",
    "L-production-filter-v2": "d_lean <= 120 AND (coalesce(d_parking <= 100, false) OR d_path IS NULL OR d_path > 45)",
    "M-wide-required-50": "d_lean <= 120 AND d_wide <= 50",
}
_OUTCOMES = " UNION ALL ".join(
    f"SELECT id, '{n}' AS strategy, coalesce({c}, false) AS hit FROM f" for n, c in _STRATEGY_SQL.items()
)


@query(
    "scenic_strategy_scores",
    f"""WITH {SPOTS}, {STATIONS}, {SEGMENTS}, {_FEATURES}, o AS ({_OUTCOMES}),
    j AS (SELECT strategy, unnest([CASE WHEN id % 3 = 0 THEN 'core' WHEN id % 3 = 1 THEN 'hard' ELSE 'very_hard' END, 'all']) AS tier,
      CASE WHEN hit = (id % 4 <> 0) THEN 1 ELSE 0 END AS hit FROM o)
    SELECT strategy, tier, count(*) AS cases, CAST(sum(hit) AS BIGINT) AS hits, floor(sum(hit) * 1000e0 / count(*) + 0.5) / 1000e0 AS accuracy FROM j GROUP BY strategy, tier""",
)
def scenic_strategy_scores(spark, sf):
    from waymark.operators.qa import strategy_scores

    cases = _features(spark, sf).withColumn(
        "tier", F.expr("element_at(array('core', 'hard', 'very_hard'), cast(id % 3 as int) + 1)")
    )
    return strategy_scores(cases, access.scenic_strategies(), F.expr("id % 4 <> 0"), "tier")


@query(
    "distance_status",
    f"""WITH {SPOTS}, {SEGMENTS}, l AS {_nearest_class('s.road_class = 0')}
    SELECT CASE WHEN l.d IS NULL THEN 'none' WHEN l.d > 250 THEN 'far' ELSE 'measured' END AS status, count(*) AS n,
      coalesce(sum(CASE WHEN l.d <= 250 THEN {half('l.d', 10)} * 10 END), 0) AS tenths FROM spots p LEFT JOIN l ON l.id = p.id GROUP BY 1""",
)
def distance_status(spark, sf):
    out = spatial.nearest_segment(spots(spark, sf), segments(spark, sf).where("road_class = 0"), 0.0015, max_m=250.0)
    status = access.distance_status("distance_m")
    return (
        out.select(status.alias("s"))
        .groupBy(F.col("s.status").alias("status"))
        .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("s.distance_m") * 10), F.lit(0.0)).alias("tenths"))
        .withColumn("tenths", geo.half_up("tenths", 1))
    )


_HOME = ["ID", "MT", "WA", "TX", "CO"]
_ROAD_STATES = ["MT", "WA", "WY"]


@query(
    "road_distance_by_state",
    f"""WITH {SPOTS}, {SEGMENTS}, r AS (SELECT *, ['MT', 'WA', 'WY'][road_class + 1] AS state FROM segments),
    pts AS (SELECT *, ['ID', 'MT', 'WA', 'TX', 'CO'][CAST(lane AS INTEGER) + 1] AS state FROM spots),
    fb(home, st) AS (VALUES {', '.join(f"('{h}', '{n}')" for h, ns in fv.ROAD_FALLBACK_STATES.items() for n in ns)}),
    cand AS (SELECT p.id, p.lat, p.lon, p.state AS st, 1 AS home FROM pts p WHERE p.state IN (SELECT state FROM r)
      UNION ALL SELECT p.id, p.lat, p.lon, fb.st, 0 FROM pts p JOIN fb ON fb.home = p.state WHERE p.state NOT IN (SELECT state FROM r)),
    d AS (SELECT p.id, min({foot_degrees('p', 's')}) AS d FROM cand p JOIN r s ON s.state = p.st AND {cell_overlap(0.02, 1)} GROUP BY p.id)
    SELECT p.id, CASE WHEN d.d IS NULL AND p.state IN (SELECT state FROM r) THEN 999999 ELSE {half('d.d', 1)} END AS road_distance_m, CASE WHEN d.d IS NOT NULL THEN 'measured' WHEN p.state IN (SELECT state FROM r) THEN 'remote' ELSE 'none' END AS road_status
    FROM pts p LEFT JOIN d ON d.id = p.id""",
)
def road_distance_by_state(spark, sf):
    roads = segments(spark, sf).withColumn("state", F.expr("element_at(array('MT', 'WA', 'WY'), cast(road_class as int) + 1)"))
    points = spots(spark, sf).withColumn(
        "state", F.expr("element_at(array('ID', 'MT', 'WA', 'TX', 'CO'), cast(lane as int) + 1)")
    )
    out = camping_plans.road_distances(points.select("id", "lat", "lon", "state"), roads.select("state", "lat1", "lon1", "lat2", "lon2"))
    return out.select("id", "road_distance_m", "road_status")


_MODE_SQL = """CASE WHEN road <= 120 AND trail <= 120 THEN CASE WHEN road <= trail THEN 'road' ELSE 'trail' END
      WHEN road <= 120 THEN 'road' WHEN trail <= 120 THEN 'trail' WHEN road IS NOT NULL AND trail IS NOT NULL THEN 'unknown'
      WHEN tier = 'developed' THEN 'road' ELSE 'trail' END"""
_CONF_SQL = """CASE WHEN road <= 120 AND trail <= 120 THEN CASE WHEN greatest(road, trail) <= least(road, trail) + 30 THEN 'medium' ELSE 'high' END
      WHEN road <= 120 OR trail <= 120 THEN 'high' WHEN road IS NOT NULL AND trail IS NOT NULL THEN 'measured_far' ELSE 'inferred' END"""


@query(
    "access_mode",
    f"""WITH {SPOTS}, {SEGMENTS}, r AS (SELECT p.id, min({foot_degrees()}) AS d FROM spots p JOIN segments s ON s.road_class < 2 AND {cell_overlap(0.02, 1)} GROUP BY p.id),
    t AS (SELECT p.id, min({foot_degrees()}) AS d FROM spots p JOIN segments s ON s.road_class = 2 AND {cell_overlap(0.05, 1)} GROUP BY p.id),
    x AS (SELECT p.id, {half('r.d', 1)} AS road, t.d AS trail, ['developed', 'backcountry', 'primitive'][CAST(p.id % 3 AS INTEGER) + 1] AS tier FROM spots p LEFT JOIN r ON r.id = p.id LEFT JOIN t ON t.id = p.id)
    SELECT id, {_MODE_SQL} AS mode, {_CONF_SQL} AS confidence FROM x""",
)
def access_mode(spark, sf):
    s = segments(spark, sf)
    rows = spots(spark, sf).select(
        "id", "lat", "lon", F.lit("campground").alias("kind"),
        F.expr("element_at(array('developed', 'backcountry', 'primitive'), cast(id % 3 as int) + 1)").alias("camp_tier"),
    )
    rows = spatial.nearest_segment(rows, s.where("road_class < 2"), 0.02, 1, local_plane=False, output="road_distance_m")
    rows = rows.withColumn("road_distance_m", geo.half_up("road_distance_m", 1))
    rows = spatial.nearest_segment(rows, s.where("road_class = 2"), 0.05, 1, local_plane=False, output="trail_distance_m")
    return rows.withColumn("a", access.access_mode()).select("id", F.col("a.mode").alias("mode"), F.col("a.confidence").alias("confidence"))


# ---- J20, J21, F28 ----------------------------------------------------------------------------------

_ROUTE_VALUES = ", ".join(f"('{r}', {i}, {a}e0, {b}e0)" for r, pts in fv.ROUTES.items() for i, (a, b) in enumerate(pts))
_ROUTES = f"""routes(route_id, seq, lat, lon) AS (VALUES {_ROUTE_VALUES}),
    legs AS (SELECT a.route_id, a.seq, a.lat AS lat1, a.lon AS lon1, b.lat AS lat2, b.lon AS lon2 FROM routes a JOIN routes b ON b.route_id = a.route_id AND b.seq = a.seq + 1)"""


def _routes(spark):
    rows = [(r, i, a, b) for r, pts in fv.ROUTES.items() for i, (a, b) in enumerate(pts)]
    return spark.createDataFrame(rows, "route_id string, seq int, lat double, lon double")


@query(
    "route_distance",
    f"""WITH {SPOTS}, {_SPREAD}, {_ROUTES}, samples AS (SELECT DISTINCT route_id, lat1 + (lat2 - lat1) * (i / 20e0) AS lat, lon1 + (lon2 - lon1) * (i / 20e0) AS lon FROM legs, range(0, 21) t(i)),
    d AS (SELECT p.id, s.route_id, min({hav('p.lat', 'p.lon', 's.lat', 's.lon', MI)}) AS d FROM spread p JOIN samples s ON abs(p.lat - s.lat) < 1.2 GROUP BY ALL)
    SELECT id, route_id, {half('d', 10)} AS mi FROM d WHERE d <= 65""",
)
def route_distance(spark, sf):
    d = routes.distance_to_routes(_spread(spark, sf), routes.fraction_samples(_routes(spark)), 65.0, "mi")
    return d.select("id", "route_id", geo.half_up("distance", 10).alias("mi"))


@query(
    "corridor_membership",
    f"""WITH {SPOTS}, {_SPREAD}, {_ROUTES}, n AS (SELECT *, greatest(1, CAST(ceil({hav('lat1', 'lon1', 'lat2', 'lon2', KM)} / 20) AS INTEGER)) AS n FROM legs),
    samples AS (SELECT DISTINCT route_id, lat1 + (lat2 - lat1) * (CAST(j AS DOUBLE) / n) AS lat, lon1 + (lon2 - lon1) * (CAST(j AS DOUBLE) / n) AS lon FROM n, LATERAL (SELECT unnest(range(0, n + 1)) AS j) x),
    d AS (SELECT p.id, s.route_id, min({hav('p.lat', 'p.lon', 's.lat', 's.lon', KM)}) AS d FROM spread p JOIN samples s ON abs(p.lat - s.lat) < 1.6 GROUP BY ALL)
    SELECT id, string_agg(route_id, ',' ORDER BY route_id) AS routes, CAST(floor(min(d) / 1.60934 + 0.5) AS BIGINT) AS dist_mi FROM d WHERE d <= 160.934 GROUP BY id""",
)
def corridor_membership(spark, sf):
    return routes.corridor_members(_spread(spark, sf), _routes(spark)).select("id", "routes", "dist_mi")


@query(
    "corridor_order",
    f"""WITH {SPOTS}, {_SPREAD}, {_ROUTES}, n AS (SELECT *, greatest(1, CAST(ceil({hav('lat1', 'lon1', 'lat2', 'lon2', KM)} / 20) AS INTEGER)) AS n FROM legs),
    samples AS (SELECT DISTINCT route_id, lat1 + (lat2 - lat1) * (CAST(j AS DOUBLE) / n) AS lat, lon1 + (lon2 - lon1) * (CAST(j AS DOUBLE) / n) AS lon FROM n, LATERAL (SELECT unnest(range(0, n + 1)) AS j) x),
    d AS (SELECT p.id, min({hav('p.lat', 'p.lon', 's.lat', 's.lon', KM)}) AS d FROM spread p JOIN samples s ON abs(p.lat - s.lat) < 1.6 GROUP BY p.id),
    k AS (SELECT id, concat('Park ', id % 97) AS name, CAST(floor(d / 1.60934 + 0.5) AS BIGINT) AS dist_mi FROM d WHERE d <= 160.934)
    SELECT id, dist_mi, name, row_number() OVER (ORDER BY dist_mi, name, id) AS position FROM k""",
)
def corridor_order(spark, sf):
    """Points of the corridors in report order: nearest first, then by name."""
    members = routes.corridor_members(_spread(spark, sf), _routes(spark))
    named = members.select("id", "dist_mi", F.concat(F.lit("Park "), F.expr("cast(id % 97 as string)")).alias("name"))
    return routes.by_distance(named).select("id", "dist_mi", "name", F.col("position").cast("bigint").alias("position"))


@query(
    "route_length",
    f"""WITH o AS (SELECT o_custkey AS route_id, o_orderkey AS seq, {coords_sql('o_orderkey')} FROM orders),
    l AS (SELECT *, lead(lat) OVER w AS lat2, lead(lon) OVER w AS lon2 FROM o WINDOW w AS (PARTITION BY route_id ORDER BY seq))
    SELECT route_id, {half('sum(' + hav('lat', 'lon', 'lat2', 'lon2', MI) + ')', 100)} AS mi, count(*) AS segments FROM l WHERE lat2 IS NOT NULL GROUP BY route_id""",
)
def route_length(spark, sf):
    path = table(spark, sf, "orders").select(F.col("o_custkey").alias("route_id"), F.col("o_orderkey").alias("seq"), *coords("o_orderkey"))
    return routes.path_length(path).select("route_id", geo.half_up("length", 100).alias("mi"), "segments")


# ---- S4, P2 - P9, B9 --------------------------------------------------------------------------------

_ROAD_TAGS = """CASE o_orderkey % 4 WHEN 0 THEN 'primary' WHEN 1 THEN 'track' WHEN 2 THEN 'footway' ELSE 'service' END"""


@query(
    "road_predicates",
    f"""WITH t AS (SELECT o_orderkey AS id, {_ROAD_TAGS} AS hw, CASE WHEN o_orderstatus = 'F' THEN 'yes' WHEN o_orderstatus = 'P' THEN 'No' END AS mv, CASE WHEN o_orderkey % 6 = 0 THEN 'no' END AS acc FROM orders)
    SELECT id, CASE WHEN lower(coalesce(mv, '')) = 'no' OR coalesce(acc, '') = 'no' OR hw = 'footway' THEN 0 WHEN hw = 'track' THEN CASE WHEN mv = 'yes' THEN 1 ELSE 0 END WHEN hw = 'primary' THEN 1 ELSE 0 END AS lean,
      CASE WHEN lower(coalesce(mv, '')) = 'no' OR coalesce(acc, '') = 'no' OR hw = 'footway' THEN 0 WHEN hw = 'track' THEN CASE WHEN mv = 'yes' THEN 1 ELSE 0 END ELSE 1 END AS wide,
      CASE WHEN hw IN ('track', 'footway') AND coalesce(mv, '') <> 'yes' THEN 1 ELSE 0 END AS path FROM t""",
)
def road_predicates(spark, sf):
    t = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.map_filter(
            F.create_map(
                F.lit("highway"), F.expr(_ROAD_TAGS),
                F.lit("motor_vehicle"), F.expr("case when o_orderstatus = 'F' then 'yes' when o_orderstatus = 'P' then 'No' end"),
                F.lit("access"), F.expr("case when o_orderkey % 6 = 0 then 'no' end"),
            ),
            lambda k, v: v.isNotNull(),
        ).alias("tags"),
    )
    return t.select(
        "id", tags.drivable(lean=True).cast("int").alias("lean"), tags.drivable(lean=False).cast("int").alias("wide"),
        tags.foot_path().cast("int").alias("path"),
    )


_HISTORIC = ["milestone", "ruins", "yes", "memorial", ""]


@query(
    "poi_layer_historic",
    f"""WITH {REFS}, p AS (SELECT p_partkey AS id, {coords_sql('p_partkey')}, ['milestone', 'ruins', 'yes', 'memorial', ''][CAST(p_partkey % 5 AS INTEGER) + 1] AS h, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_name END AS name FROM part WHERE p_size <> 13),
    {boxes_sql(fv.STATE_BOXES)}, ok AS (SELECT * FROM p WHERE h <> '' AND NOT (h IN ('milestone', 'yes') AND name = '')),
    hits AS (SELECT p.id, any_value(p.lon) AS lon, list(b.code ORDER BY b.seq) AS codes FROM ok p JOIN boxes b ON p.lat BETWEEN b.south AND b.north AND p.lon BETWEEN b.west AND b.east GROUP BY p.id)
    SELECT concat('HL-US-', coalesce({_BOX_PICK.replace('lon >', 'h.lon >')}, 'XX'), '-', replace(CASE WHEN name = '' THEN 'historic-site' ELSE name END, ' ', '-'), '-', p.id) AS id,
      CASE WHEN name = '' THEN 'Historic site' ELSE name END AS name, p.h AS subtype, CASE WHEN name = '' THEN 'qa' ELSE 'default' END AS display_tier
    FROM ok p LEFT JOIN hits h ON h.id = p.id""",
)
def poi_layer_historic(spark, sf):
    tagged = nodes(spark, sf).withColumn(
        "tags",
        F.create_map(
            F.lit("historic"), F.expr("element_at(array('milestone', 'ruins', 'yes', 'memorial', ''), cast(id % 5 as int) + 1)"),
            F.lit("name"), F.when(F.expr("id % 3 = 0"), F.lit("")).otherwise(F.col("tags")["name"]),
        ),
    )
    out = pois.layer(tagged, ways(spark, sf).withColumn("tags", F.create_map(F.lit("x"), F.lit("y"))), None, "historic")
    return out.select("id", "name", "subtype", "display_tier")


@query(
    "playgrounds_in_parks",
    f"""WITH {REFS}, {STATIONS}, park AS (SELECT o_orderkey AS way_id, o_orderpriority AS name FROM orders WHERE o_orderkey % 3 = 0),
    r AS (SELECT refs.* FROM refs JOIN park USING (way_id)), good AS (SELECT r.way_id FROM r LEFT JOIN nodes n ON n.id = r.ref GROUP BY r.way_id HAVING count(*) = count(n.id) AND count(*) >= 3),
    v AS (SELECT r.way_id, r.pos, n.lat, n.lon FROM r JOIN good USING (way_id) JOIN nodes n ON n.id = r.ref),
    e AS (SELECT way_id, lat AS lat1, lon AS lon1, coalesce(lead(lat) OVER w, first_value(lat) OVER w) AS lat2, coalesce(lead(lon) OVER w, first_value(lon) OVER w) AS lon2 FROM v WINDOW w AS (PARTITION BY way_id ORDER BY pos)),
    b AS (SELECT way_id, min(lat) AS s, max(lat) AS n, min(lon) AS w, max(lon) AS ea FROM v GROUP BY way_id),
    pg AS (SELECT c_custkey AS id, {coords_sql('c_custkey')} FROM customer),
    x AS (SELECT p.id, e.way_id FROM pg p JOIN e ON (e.lat1 > p.lat) <> (e.lat2 > p.lat) AND p.lon < (e.lon2 - e.lon1) * (p.lat - e.lat1) / (e.lat2 - e.lat1) + e.lon1 GROUP BY p.id, e.way_id HAVING count(*) % 2 = 1),
    f AS (SELECT id, min(way_id) AS way_id FROM x GROUP BY id)
    SELECT f.id, park.name AS park_name FROM f JOIN park ON park.way_id = f.way_id""",
)
def playgrounds_in_parks(spark, sf):
    points = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), *coords("c_custkey"))
    out = pois.playgrounds_in_parks(points, ways(spark, sf), nodes(spark, sf))
    return out.select("id", "park_name")


@query(
    "first_element_per_key",
    "SELECT l_orderkey AS osm_id, l_linenumber AS kind, min_by(l_partkey, l_extendedprice * 1000000 + l_suppkey) AS first_part FROM lineitem GROUP BY ALL",
)
def first_element_per_key(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("osm_id"), F.col("l_linenumber").alias("kind"), F.col("l_partkey").alias("first_part"),
        F.expr("l_extendedprice * 1000000 + l_suppkey").alias("o"),
    )
    return first_per_key(rows, ["osm_id", "kind"], ["o"]).drop("o")


@query(
    "viewport_rows",
    f"""WITH {CAMPS} SELECT id, name, lat, lon FROM camps WHERE lat BETWEEN 30.05 AND 30.15 AND lon BETWEEN -119.95 AND -119.8""",
)
def viewport_rows(spark, sf):
    return pois.in_view(camps(spark, sf), 30.05, -119.95, 30.15, -119.8).select("id", "name", "lat", "lon")
