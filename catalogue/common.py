"""Registry and the point tables derived from the driver tables.

The driver tables have no coordinates. They follow from integer keys by arithmetic that both engines
repeat exactly: a block of 1500 keys gets its own box, so the density stays the same at any scale.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.runtime import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---- coordinates from keys ------------------------------------------------------------------------


def _parts(k: str, div: str) -> tuple[str, str]:
    block = div.format(k, 1500)
    m = f"(({k}) % 1999)"
    n = f"(({k}) % 2999)"
    lat = f"300000 + (({block}) % 80) * 2000 + (({m} * {m} * 7919 + {m} * 31) % 1999)"
    lon = f"-1200000 + (({div.format(block, 80)}) % 150) * 3000 + (({n} * {n} * 104729 + {n} * 17) % 2999)"
    return lat, lon


def coords(k: str, dlat: str = "0", dlon: str = "0") -> tuple[Column, Column]:
    """Spark lat, lon of a key expression, with offsets in 1e-4 degrees."""
    lat, lon = _parts(k, "({} div {})")
    return (
        F.expr(f"cast({lat} + ({dlat}) as double) / 10000").alias("lat"),
        F.expr(f"cast({lon} + ({dlon}) as double) / 10000").alias("lon"),
    )


def coords_sql(k: str, dlat: str = "0", dlon: str = "0") -> str:
    """The same for the SQL side."""
    lat, lon = _parts(k, "(({}) // {})")
    return (
        f"CAST({lat} + ({dlat}) AS DOUBLE) / 10000 AS lat, CAST({lon} + ({dlon}) AS DOUBLE) / 10000 AS lon"
    )


def pick(words: list[str], index: str) -> Column:
    """Word of a fixed list by an index expression."""
    return F.element_at(F.array(*[F.lit(w) for w in words]), F.expr(f"cast(({index}) % {len(words)} as int) + 1"))


def pick_sql(words: list[str], index: str) -> str:
    quoted = ", ".join("'" + w.replace("'", "''") + "'" for w in words)
    return f"list_extract([{quoted}], CAST(({index}) % {len(words)} AS INTEGER) + 1)"


# ---- SQL fragments --------------------------------------------------------------------------------


def hav(lat1: str, lon1: str, lat2: str, lon2: str, radius: float = 6371000.0) -> str:
    return (
        f"({2 * radius}e0 * asin(sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * "
        f"cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


MI = 3958.8
KM = 6371.0
M = 6371000.0


def half(x: str, scale: int) -> str:
    return f"(floor(({x}) * {scale} + 0.5e0) / {scale}e0)"


def near(a: str, b: str, limit: float, radius: float = MI) -> str:
    """Distance test with a latitude pre-filter."""
    deg = limit / radius * 57.3 + 1e-6
    return (
        f"abs({a}.lat - {b}.lat) <= {deg!r} AND {hav(f'{a}.lat', f'{a}.lon', f'{b}.lat', f'{b}.lon', radius)} <= {limit!r}"
    )


def token_sql(x: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(lower(coalesce({x}, '')), '[''`´]', '', 'g'), '[^a-z0-9]+', ' ', 'g'))"
    )


def slug_sql(x: str, n: int | None = None, empty: str = "unknown") -> str:
    base = f"coalesce(nullif({x}, ''), '{empty}')"
    bare = f"regexp_replace(regexp_replace(lower({base}), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g')"
    return bare if n is None else f"substr({bare}, 1, {n})"


def camp_key_sql(x: str) -> str:
    return (
        f"regexp_replace(regexp_replace(lower(coalesce({x}, '')), '\\b(campground|camp|camping area|cg)\\b', '', 'g'), "
        f"'[^a-z0-9]', '', 'g')"
    )


def boxes_sql(boxes, name: str = "boxes") -> str:
    rows = ", ".join(f"({i}, '{c}', {s}e0, {w}e0, {n}e0, {e}e0)" for i, (c, s, w, n, e) in enumerate(boxes))
    return f"{name}(seq, code, south, west, north, east) AS (VALUES {rows})"


def ordered_walk(points: str, edge: str, carry: str = "") -> str:
    """CTEs that follow the ordered dedupe row by row.

    ``points`` names a CTE with id, seq; ``edge`` tests a (the later row) against b (the earlier).
    Gives ``suppressed(kept, dropped)``.
    """
    return f"""
    lower_nb AS (
      SELECT a.id AS hi, a.seq AS hi_seq, list(b.id ORDER BY b.seq) AS lows
      FROM {points} a JOIN {points} b ON b.seq < a.seq AND {edge}
      GROUP BY a.id, a.seq),
    steps AS (SELECT hi, lows, row_number() OVER (ORDER BY hi_seq) AS rn FROM lower_nb),
    walk(rn, gone) AS (
      SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[])
      UNION ALL
      SELECT w.rn + 1,
             CASE WHEN len(list_filter(s.lows, lambda x: NOT list_contains(w.gone, x))) > 0
                  THEN list_append(w.gone, s.hi) ELSE w.gone END
      FROM walk w JOIN steps s ON s.rn = w.rn + 1),
    final_gone AS (SELECT gone FROM walk ORDER BY rn DESC LIMIT 1),
    suppressed AS (
      SELECT list_filter(s.lows, lambda x: NOT list_contains(g.gone, x))[1] AS kept, s.hi AS dropped
      FROM steps s, final_gone g WHERE list_contains(g.gone, s.hi))"""


def component_walk(edges: str, points: str) -> str:
    """CTEs for connected components: ``comp(id, component)``; ``edges`` has a < b both ways added."""
    return f"""
    both_ways AS (SELECT a, b FROM {edges} UNION SELECT b, a FROM {edges}),
    reach(id, r) AS (
      SELECT a, a FROM both_ways
      UNION
      SELECT reach.id, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a),
    comp AS (
      SELECT p.id, coalesce(min(reach.r), p.id) AS component
      FROM {points} p LEFT JOIN reach ON reach.id = p.id GROUP BY p.id)"""


# ---- derived point tables ---------------------------------------------------------------------------

CAMP_WORDS = [
    "Pine Lake", "Pine Lake Campground", "Elk Creek CG", "Elk", "Site 12", "Loop B", "unnamed", "Twin Falls Camp",
    "Twin Falls", "OSM node 5", "#7", "Bear Meadow", "Bear Meadow Campground #3", "Oak",
]
SOURCES = ["01-nps-poi", "02-usfs-recreation", "04-ridb", "03-osm"]
MANAGERS = ["NPS", "USFS", "State", "Unknown", "BLM"]


def stations(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_partkey").alias("seq"), *coords("p_partkey"),
        F.col("p_name").alias("name"), F.col("p_type").alias("brand_id"), F.col("p_brand").alias("brand"),
        F.col("p_size").alias("size"),
    )


STATIONS = (
    "stations AS (SELECT p_partkey AS id, p_partkey AS seq, "
    + coords_sql("p_partkey")
    + ", p_name AS name, p_type AS brand_id, p_brand AS brand, p_size AS size FROM part)"
)


def spots(spark: SparkSession, sf: str) -> DataFrame:
    """One point per customer."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").alias("seq"), *coords("c_custkey"),
        F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"),
        F.expr("c_custkey % 5").alias("lane"),
    )


SPOTS = (
    "spots AS (SELECT c_custkey AS id, c_custkey AS seq, "
    + coords_sql("c_custkey")
    + ", c_mktsegment AS segment, c_nationkey AS nation, c_custkey % 5 AS lane FROM customer)"
)


def camps(spark: SparkSession, sf: str) -> DataFrame:
    """Campgrounds from customers: pairs of rows about 44 m apart, four sources, five managers."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.expr("(c_custkey % 4) * 10000000000 + c_custkey").alias("seq"),
        *coords("(c_custkey div 2)", "(c_custkey % 2) * 4"),
        pick(CAMP_WORDS, "c_custkey div 4").alias("name"),
        pick(SOURCES, "c_custkey").alias("ingest_source"),
        pick(MANAGERS, "c_nationkey").alias("land_manager"),
        F.col("c_nationkey").alias("nation"),
        F.when(F.expr("c_custkey % 9 = 0"), F.lit("dispersed")).otherwise(F.lit("developed")).alias("type"),
    )


CAMPS = (
    "camps AS (SELECT c_custkey AS id, (c_custkey % 4) * 10000000000 + c_custkey AS seq, "
    + coords_sql("(c_custkey // 2)", "(c_custkey % 2) * 4")
    + ", "
    + pick_sql(CAMP_WORDS, "c_custkey // 4")
    + " AS name, "
    + pick_sql(SOURCES, "c_custkey")
    + " AS ingest_source, "
    + pick_sql(MANAGERS, "c_nationkey")
    + " AS land_manager, c_nationkey AS nation, "
    "CASE WHEN c_custkey % 9 = 0 THEN 'dispersed' ELSE 'developed' END AS type FROM customer)"
)

KINDS = ["campground", "picnic_area", "restroom", "campground", "parking"]
TIERS = ["developed", "backcountry", "primitive"]
AMENITY_WORDS = ["North Loop", "North Loop Campground", "Lake Picnic Area", "Lake", "campground", "Ridge"]


def amenities(spark: SparkSession, sf: str) -> DataFrame:
    """Amenities from customers: groups of three rows 33 m apart."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").alias("seq"),
        *coords("(c_custkey div 3)", "(c_custkey % 3) * 2"),
        pick(AMENITY_WORDS, "c_custkey").alias("name"),
        pick(KINDS, "c_custkey div 3").alias("kind"),
        pick(TIERS, "c_custkey div 6").alias("camp_tier"),
        F.expr("concat('s', c_custkey div 9 % 2)").alias("subtype"),
        F.expr("concat('park-', c_custkey div 30)").alias("parent"),
        F.expr("if(c_custkey % 7 = 0, cast(c_custkey as string), null)").alias("object_id"),
        F.expr("cast(null as string)").alias("site_no"),
        pick(["road", "trail", "unknown"], "c_custkey").alias("access_mode"),
        pick(["01-nps-arcgis", "02-state-arcgis", "03-state-osm"], "c_nationkey").alias("ingest_source"),
        F.col("c_nationkey").alias("nation"),
    )


AMENITIES = (
    "amenities AS (SELECT c_custkey AS id, c_custkey AS seq, "
    + coords_sql("(c_custkey // 3)", "(c_custkey % 3) * 2")
    + ", "
    + pick_sql(AMENITY_WORDS, "c_custkey")
    + " AS name, "
    + pick_sql(KINDS, "c_custkey // 3")
    + " AS kind, "
    + pick_sql(TIERS, "c_custkey // 6")
    + " AS camp_tier, concat('s', (c_custkey // 9) % 2) AS subtype, concat('park-', c_custkey // 30) AS parent, "
    "CASE WHEN c_custkey % 7 = 0 THEN CAST(c_custkey AS VARCHAR) END AS object_id, "
    + pick_sql(["road", "trail", "unknown"], "c_custkey")
    + " AS access_mode, "
    + pick_sql(["01-nps-arcgis", "02-state-arcgis", "03-state-osm"], "c_nationkey")
    + " AS ingest_source, c_nationkey AS nation FROM customer)"
)


def segments(spark: SparkSession, sf: str) -> DataFrame:
    """Short road segments from parts, in the boxes of the points."""
    lat, lon = coords("p_partkey")
    lat2, lon2 = coords("p_partkey", "(p_partkey % 41) - 20", "(p_partkey % 37) - 18")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("segment_id"), lat.alias("lat1"), lon.alias("lon1"), lat2.alias("lat2"), lon2.alias("lon2"),
        F.expr("p_partkey % 3").alias("road_class"), F.expr("p_size % 5").alias("lane"),
    )


SEGMENTS = (
    "segments AS (SELECT s.p_partkey AS segment_id, s.lat AS lat1, s.lon AS lon1, e.lat AS lat2, e.lon AS lon2, "
    "s.p_partkey % 3 AS road_class, s.p_size % 5 AS lane FROM (SELECT p_partkey, p_size, "
    + coords_sql("p_partkey")
    + " FROM part) s JOIN (SELECT p_partkey, "
    + coords_sql("p_partkey", "(p_partkey % 41) - 20", "(p_partkey % 37) - 18")
    + " FROM part) e USING (p_partkey))"
)


def foot_local(p: str = "p", s: str = "s") -> str:
    """Metres from p to segment s through the local metre plane."""
    kx, ky = f"(111320e0 * cos(radians({p}.lat)))", "111320e0"
    dx, dy = f"(({s}.lon2 - {s}.lon1) * {kx})", f"(({s}.lat2 - {s}.lat1) * {ky})"
    t = (
        f"coalesce(greatest(0e0, least(1e0, (({p}.lon - {s}.lon1) * {kx} * {dx} + ({p}.lat - {s}.lat1) * {ky} * {dy}) / "
        f"nullif({dx} * {dx} + {dy} * {dy}, 0))), 0e0)"
    )
    return hav(f"{p}.lat", f"{p}.lon", f"({s}.lat1 + {t} * ({s}.lat2 - {s}.lat1))", f"({s}.lon1 + {t} * ({s}.lon2 - {s}.lon1))")


def foot_degrees(p: str = "p", s: str = "s") -> str:
    dx, dy = f"({s}.lat2 - {s}.lat1)", f"({s}.lon2 - {s}.lon1)"
    t = (
        f"coalesce(greatest(0e0, least(1e0, (({p}.lat - {s}.lat1) * {dx} + ({p}.lon - {s}.lon1) * {dy}) / "
        f"nullif({dx} * {dx} + {dy} * {dy}, 0))), 0e0)"
    )
    return hav(f"{p}.lat", f"{p}.lon", f"({s}.lat1 + {t} * {dx})", f"({s}.lon1 + {t} * {dy})")


def cell_overlap(size: float, reach: int, p: str = "p", s: str = "s") -> str:
    """The segment's covered cells come within ``reach`` cells of the point's cell."""
    return (
        f"floor({p}.lat / {size}e0) BETWEEN floor(least({s}.lat1, {s}.lat2) / {size}e0) - {reach} AND "
        f"floor(greatest({s}.lat1, {s}.lat2) / {size}e0) + {reach} AND "
        f"floor({p}.lon / {size}e0) BETWEEN floor(least({s}.lon1, {s}.lon2) / {size}e0) - {reach} AND "
        f"floor(greatest({s}.lon1, {s}.lon2) / {size}e0) + {reach}"
    )


def ways(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as ways: their line items' parts, in line order, are the node refs."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    tags = F.create_map(
        F.lit("highway"), pick(["primary", "track", "footway", "service"], "o_orderkey"),
        F.lit("name"), F.col("o_orderpriority"),
        F.lit("leisure"), F.when(F.expr("o_orderkey % 3 = 0"), F.lit("park")).otherwise(F.lit("")),
    )
    refs = lines.groupBy("l_orderkey").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda s: s["l_partkey"]).alias("refs")
    )
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), tags.alias("tags"))
    return refs.join(orders, "l_orderkey").select(F.col("l_orderkey").alias("id"), "refs", "tags")


def nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as nodes; parts of size 13 are missing from the map."""
    return table(spark, sf, "part").where("p_size <> 13").select(
        F.col("p_partkey").alias("id"), *coords("p_partkey"),
        F.create_map(F.lit("name"), F.col("p_name"), F.lit("brand"), F.col("p_brand")).alias("tags"),
    )


REFS = (
    "refs AS (SELECT l_orderkey AS way_id, l_partkey AS ref, "
    "row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS pos FROM lineitem "
    "WHERE l_orderkey IN (SELECT o_orderkey FROM orders)), "
    "nodes AS (SELECT p_partkey AS id, " + coords_sql("p_partkey") + " FROM part WHERE p_size <> 13)"
)
