"""Queries: counts, rollups, coverage, cross-source reports, validators, sinks, refresh."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalogue.common import (
    AMENITIES, CAMPS, STATIONS, amenities, camps, coords, coords_sql, half, pick, pick_sql, query, stations, table,
)
from catalogue.labels import DISPLAY_TIER, ROADS, camp_rows
from waymark.functions import brands, camping, geo
from waymark.operators import qa, rollup
from waymark.plans import amenities as amenity_plans
from waymark.plans import explorer, pois
from waymark.plans import parks as park_plans
from waymark.plans import units as unit_plans
from waymark.runtime import shared_dir
from waymark.sources import sinks
from waymark.streaming import refresh


def scratch(spark) -> str:
    """New folder under the shared folder for a written result."""
    return f"{shared_dir(spark).rstrip('/')}/query-{uuid.uuid4().hex}"


# ---- A1 - A8 ----------------------------------------------------------------------------------------


@query(
    "multi_breakdown",
    """WITH t AS (SELECT CASE WHEN o_custkey % 50 = 0 THEN '?' ELSE o_orderpriority END AS p, o_orderstatus AS s, CAST(o_custkey % 7 AS VARCHAR) AS c FROM orders)
    SELECT 'priority' AS breakdown, p AS value, count(*) AS n FROM t GROUP BY p UNION ALL SELECT 'status', s, count(*) FROM t GROUP BY s UNION ALL SELECT 'priority_status', concat(p, ':', s), count(*) FROM t GROUP BY p, s UNION ALL SELECT 'lane', c, count(*) FROM t GROUP BY c""",
)
def multi_breakdown(spark, sf):
    t = table(spark, sf, "orders").select(
        F.expr("if(o_custkey % 50 = 0, '', o_orderpriority)").alias("p"), F.col("o_orderstatus").alias("s"), F.expr("o_custkey % 7").alias("c")
    )
    out = rollup.breakdowns(t, {"priority": ["p"], "status": ["s"], "priority_status": ["p", "s"], "lane": ["c"]})
    return out.select("breakdown", "value", "n")


@query(
    "flag_counts",
    "WITH t AS (SELECT unnest(list_filter([l_returnflag, l_linestatus, CASE WHEN l_discount > 0.05 THEN 'DISCOUNT' END], lambda x: x IS NOT NULL)) AS flag FROM lineitem) SELECT flag, count(*) AS n FROM t GROUP BY flag",
)
def flag_counts(spark, sf):
    flags = F.filter(
        F.array("l_returnflag", "l_linestatus", F.when(F.col("l_discount") > 0.05, F.lit("DISCOUNT"))), lambda x: x.isNotNull()
    )
    return rollup.count_flags(table(spark, sf, "lineitem").select(flags.alias("map_flags")))


@query(
    "conditional_counts",
    "SELECT l_returnflag, count(*) AS total, count(*) FILTER (WHERE l_quantity > 25) AS big, count(*) FILTER (WHERE l_discount = 0) AS full_price, count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '2000-01-01') AS recent FROM lineitem GROUP BY l_returnflag",
)
def conditional_counts(spark, sf):
    return rollup.conditional_counts(
        table(spark, sf, "lineitem"),
        {
            "big": F.col("l_quantity") > 25, "full_price": F.col("l_discount") == 0,
            "recent": F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp"),
        },
        ["l_returnflag"],
    )


@query(
    "distance_histogram",
    f"WITH {CAMPS}, {ROADS} SELECT CASE WHEN d IS NULL THEN 'null' WHEN d <= 800 THEN 'lte800' WHEN d <= 1200 THEN 'lte1200' ELSE 'gt1200' END AS bucket, count(*) AS n FROM rows_ GROUP BY 1",
)
def distance_histogram(spark, sf):
    return rollup.distance_histogram(camp_rows(spark, sf))


_LINES = """t AS (SELECT l_orderkey AS id, CASE WHEN l_suppkey % 5 = 0 THEN '' ELSE concat('p', l_partkey % 300) END AS pid, CASE WHEN l_suppkey % 5 = 0 AND l_partkey % 2 = 0 THEN concat('c', l_suppkey) ELSE '' END AS code,
      CASE l_linenumber WHEN 1 THEN 'campground' WHEN 2 THEN 'campground' WHEN 3 THEN 'picnic_area' WHEN 4 THEN 'restroom' WHEN 5 THEN 'parking' WHEN 6 THEN 'visitor_center' ELSE 'campground' END AS kind,
      ['developed', 'backcountry', 'primitive'][CAST(l_orderkey % 3 AS INTEGER) + 1] AS tier, ['road', 'trail', 'unknown'][CAST(l_partkey % 3 AS INTEGER) + 1] AS mode, l_returnflag AS src, CASE WHEN l_tax > 0.04 THEN 'state_park_us' ELSE '' END AS system FROM lineitem)"""


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.expr("if(l_suppkey % 5 = 0, '', concat('p', l_partkey % 300))").alias("parent_id"),
        F.lit("").alias("park_code"), F.expr("if(l_suppkey % 5 = 0 and l_partkey % 2 = 0, concat('c', l_suppkey), '')").alias("official_code"),
        F.expr("element_at(array('campground', 'campground', 'picnic_area', 'restroom', 'parking', 'visitor_center', 'campground'), l_linenumber)").alias("kind"),
        pick(["developed", "backcountry", "primitive"], "l_orderkey").alias("camp_tier"), pick(["road", "trail", "unknown"], "l_partkey").alias("access_mode"),
        F.col("l_returnflag").alias("ingest_source"), F.expr("if(l_tax > 0.04, 'state_park_us', '')").alias("parent_system"),
    )


@query(
    "parent_rollup",
    f"""WITH {_LINES}, k AS (SELECT *, concat(coalesce(nullif(system, ''), 'nps'), ':', CASE WHEN pid <> '' THEN pid WHEN code <> '' THEN concat('code:', code) ELSE concat('amenity:', id) END) AS parent_key FROM t)
    SELECT parent_key, count(*) FILTER (WHERE kind = 'campground' AND tier = 'developed') AS developed_count, count(*) FILTER (WHERE kind = 'campground' AND tier = 'backcountry' AND mode = 'trail') AS backcountry_trail,
      count(*) FILTER (WHERE kind = 'campground' AND tier = 'primitive' AND mode = 'road') AS primitive_road, count(*) FILTER (WHERE kind = 'restroom') AS restroom_count, count(*) FILTER (WHERE kind = 'parking') AS parking_count,
      count(*) FILTER (WHERE kind = 'campground') AS camp_total, count(*) FILTER (WHERE kind = 'campground' AND mode = 'road') AS camp_road, string_agg(DISTINCT src, ',' ORDER BY src) AS sources FROM k GROUP BY parent_key""",
)
def parent_rollup(spark, sf):
    return amenity_plans.park_rollup(_lines(spark, sf)).select(
        "parent_key", "developed_count", "backcountry_trail", "primitive_road", "restroom_count", "parking_count", "camp_total", "camp_road", "sources"
    )


@query(
    "unit_coverage",
    """SELECT c.c_mktsegment AS category, count(*) AS units, count(o.k) AS covered, floor(count(o.k) * 1000e0 / count(*) + 0.5) / 10e0 AS pct FROM customer c LEFT JOIN (SELECT DISTINCT CASE WHEN o_orderstatus = 'F' AND o_totalprice > 300000 THEN o_custkey END AS k FROM orders) o ON o.k = c.c_custkey GROUP BY 1""",
)
def unit_coverage(spark, sf):
    catalog = table(spark, sf, "customer").select(F.col("c_custkey").alias("code"), F.col("c_mktsegment").alias("category"))
    rows = table(spark, sf, "orders").select(F.expr("if(o_orderstatus = 'F' and o_totalprice > 300000, o_custkey, null)").alias("code"))
    return rollup.coverage(catalog, rows, "code", "category")


@query(
    "missing_units",
    "SELECT c_custkey AS code, c_mktsegment AS category FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE CASE WHEN o_orderstatus = 'F' AND o_totalprice > 300000 THEN o_custkey END = c_custkey)",
)
def missing_units(spark, sf):
    catalog = table(spark, sf, "customer").select(F.col("c_custkey").alias("code"), F.col("c_mktsegment").alias("category"))
    rows = table(spark, sf, "orders").select(F.expr("if(o_orderstatus = 'F' and o_totalprice > 300000, o_custkey, null)").alias("code"))
    return rollup.missing_units(catalog, rows, "code")


# ---- A9 - A20 ---------------------------------------------------------------------------------------

_PITCH_CODES = ["BNP-TML-C1", "BNP-TML-C2", "JNP-POC", "", "JNP-WAB3", "JNP-WAB4"]


@query(
    "pitch_rollup",
    f"""WITH p AS (SELECT c_custkey AS id, {coords_sql('c_custkey')}, {pick_sql(_PITCH_CODES, 'c_custkey')} AS code, {pick_sql(['Two Jack', 'Lake Camp', ''], 'c_custkey // 6')} AS name, CASE WHEN c_custkey % 4 = 0 THEN 'BNP' ELSE '' END AS park FROM customer),
    k AS (SELECT *, CASE code WHEN 'BNP-TML-C1' THEN 'code:BNP-TML' WHEN 'BNP-TML-C2' THEN 'code:BNP-TML' WHEN 'JNP-POC' THEN 'code:JNP-POC' WHEN '' THEN CASE WHEN name = '' THEN concat('id:', id) WHEN park <> '' THEN concat('name:bnp:', CASE name WHEN 'Two Jack' THEN 'twojack' ELSE 'lake' END) ELSE concat('name:', CASE name WHEN 'Two Jack' THEN 'twojack' ELSE 'lake' END) END ELSE 'code:JNP-WAB' END AS rollup_key FROM p)
    SELECT rollup_key, count(*) AS pitch_count, min(id) AS id, {half('avg(lat)', 1000000000)} AS lat, CASE WHEN arg_min(code, id) = 'JNP-POC' THEN 'Miette Campground' ELSE concat(CASE WHEN arg_min(name, id) = '' THEN 'Parks Canada' ELSE arg_min(name, id) END, CASE WHEN arg_min(name, id) = '' THEN ' campground' ELSE ' Campground' END) END AS name FROM k GROUP BY rollup_key""",
)
def pitch_rollup(spark, sf):
    from waymark.plans.camping import pitches_to_campgrounds

    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").alias("seq"), *coords("c_custkey"), pick(_PITCH_CODES, "c_custkey").alias("code"),
        pick(["Two Jack", "Lake Camp", ""], "c_custkey div 6").alias("name"), F.expr("if(c_custkey % 4 = 0, 'BNP', '')").alias("park"),
        F.lit("01-parks-canada").alias("ingest_source"),
    )
    return pitches_to_campgrounds(rows).select("rollup_key", "pitch_count", "id", geo.half_up("lat", 1e9).alias("lat"), "name")


@query(
    "named_groups",
    f"""WITH p AS (SELECT o_orderkey AS seq, o_custkey % 40 AS admin, {coords_sql('o_orderkey')}, CASE o_orderstatus WHEN 'F' THEN 'Ash' WHEN 'O' THEN 'Ash Grove' ELSE 'Elm' END AS name, CASE WHEN o_custkey % 3 = 0 THEN 'historic_site' ELSE 'park' END AS category FROM orders)
    SELECT admin, arg_min(name, (-length(name), seq)) AS name, CASE WHEN bool_or(category = 'historic_site') AND NOT bool_or(category = 'park') THEN 'historic_site' ELSE 'park' END AS category, count(*) AS unit_count FROM p GROUP BY admin""",
)
def named_groups(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("seq"), F.expr("o_custkey % 40").alias("admin"), *coords("o_orderkey"),
        F.expr("case o_orderstatus when 'F' then 'Ash' when 'O' then 'Ash Grove' else 'Elm' end").alias("name"),
        F.expr("if(o_custkey % 3 = 0, 'historic_site', 'park')").alias("category"),
    )
    return rollup.named_groups(rows, ["admin"], "name", "category", "seq").select("admin", "name", "category", "unit_count")


@query(
    "weighted_centroid",
    f"""WITH p AS (SELECT c_nationkey AS park, {coords_sql('c_custkey')}, c_custkey % 9 + 1 AS w FROM customer) SELECT park, {half('sum(lat * w) / sum(w)', 1000000)} AS lat, {half('sum(lon * w) / sum(w)', 1000000)} AS lon, CAST(sum(w) AS BIGINT) AS w FROM p GROUP BY park""",
)
def weighted_centroid(spark, sf):
    p = table(spark, sf, "customer").select(F.col("c_nationkey").alias("park"), *coords("c_custkey"), F.expr("c_custkey % 9 + 1").alias("w"))
    out = rollup.weighted_centroid(p, ["park"], "w")
    return out.select("park", geo.half_up("lat", 1e6).alias("lat"), geo.half_up("lon", 1e6).alias("lon"), "w")


_VERTS = f"v AS (SELECT l_orderkey AS unit, {coords_sql('l_partkey')} FROM lineitem)"


@query(
    "ring_bounds",
    f"WITH {_VERTS} SELECT unit, min(lat) AS south, max(lon) AS east, {half('(max(lat) - min(lat)) * (max(lon) - min(lon))', 1000000)} AS area, count(*) AS vertices FROM v GROUP BY unit",
)
def ring_bounds(spark, sf):
    v = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("unit"), *coords("l_partkey"))
    return rollup.bounds(v, ["unit"]).select("unit", "south", "east", geo.half_up("area", 1e6).alias("area"), "vertices")


@query(
    "vertex_summary",
    f"WITH {_VERTS}, b AS (SELECT unit, count(*) AS n FROM v GROUP BY unit) SELECT CAST(sum(n) AS BIGINT) AS total_vertices, CAST(floor(avg(n) + 0.5) AS BIGINT) AS avg_vertices, max(n) AS max_vertices, arg_min(unit, (-n, unit)) AS max_name FROM b",
)
def vertex_summary(spark, sf):
    v = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("unit"), *coords("l_partkey"))
    return rollup.vertex_summary(rollup.bounds(v, ["unit"]), "unit")


@query(
    "brand_groups",
    """WITH t AS (SELECT CASE p_partkey % 6 WHEN 0 THEN 'pilot' WHEN 1 THEN 'pilot_flyingj' ELSE lower(p_brand) END AS b, p_type AS region, p_size % 9 = 0 AS strict FROM part)
    SELECT CASE WHEN b IN ('pilot', 'flyingj', 'pilot_flyingj') THEN 'pilot_flyingj' ELSE b END AS select_id, string_agg(DISTINCT b, ',' ORDER BY b) AS brand_ids, string_agg(DISTINCT region, ',' ORDER BY region) AS regions, max(CAST(strict AS INTEGER)) AS strict FROM t GROUP BY 1""",
)
def brand_groups(spark, sf):
    rows = table(spark, sf, "part").select(
        F.expr("case p_partkey % 6 when 0 then 'pilot' when 1 then 'pilot_flyingj' else lower(p_brand) end").alias("brand_id"),
        F.col("p_type").alias("region"), (F.col("p_size") % 9 == 0).alias("strict"), F.col("p_name").alias("name"), F.col("p_type").alias("type"),
        F.col("p_partkey").alias("seq"),
    )
    return rollup.brand_groups(rows, brands.select_id("brand_id")).select("select_id", "brand_ids", "regions", "strict")


_ADMIN = """a AS (SELECT n_nationkey AS admin, n_nationkey % 3 = 0 AS verified FROM nation), c AS (SELECT c_nationkey AS admin, count(*) AS total, count(*) FILTER (WHERE c_custkey % 10 = 0 AND c_nationkey % 2 = 0) AS osm FROM customer GROUP BY 1),
    s AS (SELECT s_nationkey AS admin, count(*) AS k FROM supplier GROUP BY 1), x AS (SELECT a.admin, a.verified, coalesce(total, 0) AS total, coalesce(osm, 0) AS osm, k * 25 AS expected, CASE WHEN a.admin % 4 > 0 THEN k * 14 END AS listing FROM a LEFT JOIN c USING (admin) LEFT JOIN s USING (admin))"""


def _admin_counts(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("admin"), F.expr("n_nationkey % 3 = 0").alias("verified"))
    c = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("admin")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.expr("c_custkey % 10 = 0 and c_nationkey % 2 = 0")).alias("osm")
    )
    s = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("admin")).agg(F.count(F.lit(1)).alias("k"))
    rows = n.join(c, "admin", "left").join(s, "admin", "left")
    return rows.select(
        "admin", "verified", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("osm", F.lit(0)).alias("osm"),
        (F.col("k") * 25).alias("expected"), F.expr("if(admin % 4 > 0, k * 14, null)").alias("listing"),
    )


@query(
    "cross_check_flags",
    f"""WITH {_ADMIN} SELECT admin, total, concat_ws(',', CASE WHEN verified AND expected > 0 AND total < expected * 0.5 THEN 'under_official_gis' END, CASE WHEN verified AND expected > 0 AND total > expected * 1.5 THEN 'over_official_gis' END,
      CASE WHEN verified AND osm > 0 THEN 'has_osm_in_tier_a_state' END, CASE WHEN listing > 0 AND total > 0 AND abs(total - listing) > listing * 0.25 THEN 'listing_master_mismatch' END, CASE WHEN verified AND NOT coalesce(listing > 0, false) THEN 'missing_listing_cache' END) AS flags FROM x""",
)
def cross_check_flags(spark, sf):
    return rollup.source_counts_flags(_admin_counts(spark, sf)).select("admin", "total", "flags")


@query(
    "flagged_admins",
    f"""WITH {_ADMIN}, f AS (SELECT admin, verified AND expected > 0 AND total > expected * 1.5 AS a, listing > 0 AND total > 0 AND abs(total - listing) > listing * 0.25 AS b FROM x) SELECT admin FROM f WHERE a OR b""",
)
def flagged_admins(spark, sf):
    flags = rollup.source_counts_flags(_admin_counts(spark, sf)).where("flags like '%over_official%' or flags like '%listing_master%'")
    return flags.select("admin")


@query(
    "four_source_status",
    f"""WITH {_ADMIN}, q AS (SELECT admin, CASE WHEN verified THEN expected END AS gis, osm, listing AS website, CASE WHEN admin % 5 > 0 THEN total * 6 // 5 END AS wiki, total AS plotted FROM x),
    p AS (SELECT *, list_filter([CAST(gis AS DOUBLE), CAST(website AS DOUBLE), CAST(wiki AS DOUBLE), CAST(plotted AS DOUBLE)], lambda v: v > 0) AS l FROM q),
    r AS (SELECT admin, coalesce(gis > 0, false) AND osm > 0 AND coalesce(website > 0, false) AND coalesce(wiki > 0, false) AS four, coalesce(len(l) >= 3 AND list_max(l) / list_min(l) <= 1.35, false) AS agree,
      concat_ws(',', CASE WHEN NOT coalesce(gis > 0, false) THEN 'GIS' END, CASE WHEN NOT osm > 0 THEN 'OSM' END, CASE WHEN NOT coalesce(website > 0, false) THEN 'website' END, CASE WHEN NOT coalesce(wiki > 0, false) THEN 'Wikipedia' END) AS missing FROM p)
    SELECT admin, CAST(four AS INTEGER) AS four, CAST(agree AS INTEGER) AS agree, missing FROM r""",
)
def four_source_status(spark, sf):
    c = _admin_counts(spark, sf).select(
        "admin", F.expr("if(verified, expected, null)").alias("gis"), "osm", F.col("listing").alias("website"),
        F.expr("if(admin % 5 > 0, total * 6 div 5, null)").alias("wiki"), F.col("total").alias("plotted"),
    )
    out = park_plans.four_source_status(c)
    return out.select("admin", F.col("four_present").cast("int").alias("four"), F.col("agree").cast("int").alias("agree"), "missing")


@query(
    "first_center_per_park",
    f"""WITH t AS (SELECT lower(concat('P', c_custkey % 200)) AS park_code, c_custkey AS seq, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE lat END AS lat FROM (SELECT *, {coords_sql('c_custkey')} FROM customer))
    SELECT park_code, count(*) AS centers, arg_min(name, seq) FILTER (WHERE lat IS NOT NULL) AS primary_name FROM t GROUP BY park_code""",
)
def first_center_per_park(spark, sf):
    lat, lon = coords("c_custkey")
    t = table(spark, sf, "customer").select(
        F.expr("concat('P', c_custkey % 200)").alias("park_code"), F.col("c_custkey").alias("seq"), F.col("c_name").alias("name"),
        F.when(F.expr("c_custkey % 3 <> 0"), lat).alias("lat"), lon,
    )
    return rollup.first_per_park(t).select("park_code", "centers", "primary_name")


@query(
    "reject_samples",
    "SELECT l_returnflag AS brand, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS sample_no FROM lineitem QUALIFY sample_no <= 8",
)
def reject_samples(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("brand", F.col("l_returnflag"))
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey")]
    return rollup.samples_per_group(rows, ["brand"], order, 8).select("brand", "l_orderkey", "l_linenumber", F.col("sample_no").cast("bigint").alias("sample_no"))


@query(
    "store_number_gaps",
    "SELECT CAST(k AS BIGINT) AS number FROM range(1, (SELECT max(o_orderkey * 3 + 1) FROM orders) + 1) t(k) WHERE k NOT IN (SELECT o_orderkey * 3 + 1 FROM orders)",
)
def store_number_gaps(spark, sf):
    return rollup.number_gaps(table(spark, sf, "orders").select(F.expr("o_orderkey * 3 + 1").alias("n")), "n")


@query(
    "store_number_gap_ranges",
    """WITH u AS (SELECT DISTINCT o_orderkey * o_orderkey * 1000 + 5 AS n FROM orders), l AS (SELECT coalesce(lag(n) OVER (ORDER BY n), 0) + 1 AS first, n - 1 AS last FROM u) SELECT * FROM l WHERE first <= last""",
)
def store_number_gap_ranges(spark, sf):
    """Runs of unused numbers between numbers that lie far apart."""
    numbers = table(spark, sf, "orders").select(F.expr("o_orderkey * o_orderkey * 1000 + 5").alias("n"))
    return rollup.number_gap_ranges(numbers, "n")


# ---- T1, U1, S14, Q9, Q10, J30 ----------------------------------------------------------------------


@query(
    "master_order",
    f"WITH {AMENITIES} SELECT id, row_number() OVER (ORDER BY ingest_source, parent, kind, camp_tier, name, id) AS position FROM amenities",
)
def master_order(spark, sf):
    from waymark.operators.ranking import rank_in_groups

    rows = amenities(spark, sf).withColumn("all", F.lit(0))
    return rank_in_groups(rows, ["all"], ["ingest_source", "parent", "kind", "camp_tier", "name", "id"], "position").select(
        "id", F.col("position").cast("bigint").alias("position")
    )


@query(
    "drop_audit",
    """SELECT concat('flag ', l_returnflag) AS kept, concat(l_orderkey, '-', l_linenumber) AS dropped, concat('flag ', l_returnflag) AS reason FROM lineitem
    UNION ALL SELECT CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR), concat('status ', o_orderstatus) FROM orders""",
)
def drop_audit(spark, sf):
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    # every row is in one of the lists: lines by flag, orders by status
    lists = {
        f"flag {f}": lines.where(f"l_returnflag = '{f}'").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id")) for f in "RAN"
    }
    lists |= {
        f"status {s}": orders.where(f"o_orderstatus = '{s}'").select(F.col("o_custkey").alias("kept"), F.col("o_orderkey").alias("dropped"))
        for s in "FOP"
    }
    return sinks.with_dropped(lists)


@query(
    "explorer_status",
    "SELECT c_custkey AS id, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE CASE WHEN o_totalprice > 400000 THEN o_custkey END = c_custkey) THEN 'kept' ELSE 'excluded' END AS status FROM customer",
)
def explorer_status(spark, sf):
    everything = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    kept = table(spark, sf, "orders").select(F.expr("if(o_totalprice > 400000, o_custkey, null)").alias("id"))
    return pois.status_against_kept(everything, kept)


@query(
    "layer_manifest",
    f"""WITH {AMENITIES}, l AS (SELECT concat('camp_', camp_tier) AS layer FROM amenities WHERE kind = 'campground' UNION ALL SELECT concat('camp_', access_mode) FROM amenities WHERE kind = 'campground' AND access_mode <> 'unknown'
      UNION ALL SELECT CASE kind WHEN 'picnic_area' THEN 'picnic' ELSE 'restroom' END FROM amenities WHERE kind IN ('picnic_area', 'restroom'))
    SELECT layer, count(*) AS n, 'file' AS placement, CASE WHEN starts_with(layer, 'camp_') THEN 'camping' ELSE 'amenities' END AS layer_group FROM l GROUP BY layer""",
)
def layer_manifest(spark, sf):
    rows = explorer.amenity_layers(amenities(spark, sf))
    return explorer.manifest(rows, {"camp_": "camping", "picnic": "amenities", "restroom": "amenities"}).select("layer", "n", "placement", "layer_group")


@query(
    "unit_pin_rows",
    f"""WITH s AS (SELECT s_suppkey AS k, s_name AS name, {coords_sql('s_suppkey')} FROM supplier) SELECT concat('u', k) AS id, name, {half('lat', 100000)} AS lat FROM s WHERE k % 3 > 0
    UNION ALL SELECT concat('u', k, '-a'), concat(name, ' — North'), {half('lat', 100000)} FROM s WHERE k % 3 = 0 UNION ALL SELECT concat('u', k, '-b'), name, {half('lat + 1', 100000)} FROM s WHERE k % 3 = 0""",
)
def unit_pin_rows(spark, sf):
    lat, lon = coords("s_suppkey")
    units = table(spark, sf, "supplier").select(
        F.expr("concat('u', s_suppkey)").alias("id"), F.col("s_name").alias("name"), F.lit("park").alias("category"), lat, lon, "s_suppkey"
    )

    def pin(suffix, label, shift, role):
        return F.struct(
            F.concat("id", F.lit(suffix)).alias("id"), F.lit(label).alias("label"), (F.col("lat") + shift).alias("lat"),
            F.col("lon").alias("lon"), F.lit(role).alias("role"),
        )

    pins = F.when(F.expr("s_suppkey % 3 = 0"), F.array(pin("-a", "North", 0.0, "primary"), pin("-b", "", 1.0, "secondary")))
    return explorer.unit_pins(units.withColumn("pins", pins)).select("id", "name", "lat")


# ---- Q1 - Q6 ----------------------------------------------------------------------------------------


@query(
    "fuel_validator",
    f"""WITH {STATIONS} SELECT 'rows' AS check_name, CAST(count(*) AS DOUBLE) AS actual, CAST(count(*) > 100 AS INTEGER) AS passed FROM stations
    UNION ALL SELECT 'missing_brand', CAST(count(*) FILTER (WHERE brand_id IS NULL) AS DOUBLE), CAST(count(*) FILTER (WHERE brand_id IS NULL) = 0 AS INTEGER) FROM stations
    UNION ALL SELECT 'bad_size', CAST(count(*) FILTER (WHERE size > 45) AS DOUBLE), CAST(count(*) FILTER (WHERE size > 45) = 0 AS INTEGER) FROM stations
    UNION ALL SELECT 'brands', CAST(count(DISTINCT brand_id) AS DOUBLE), CAST(count(DISTINCT brand_id) >= 6 AS INTEGER) FROM stations""",
)
def fuel_validator(spark, sf):
    out = qa.check_rows(
        stations(spark, sf),
        {
            "rows": (F.count(F.lit(1)), F.col("v") > 100),
            "missing_brand": (F.count_if(F.col("brand_id").isNull()), F.col("v") == 0),
            "bad_size": (F.count_if(F.col("size") > 45), F.col("v") == 0),
            "brands": (F.count_distinct("brand_id"), F.col("v") >= 6),
        },
    )
    return out.select(F.col("check").alias("check_name"), "actual", F.col("passed").cast("int").alias("passed"))


@query(
    "brand_minimums",
    "WITH e AS (SELECT DISTINCT p_brand AS brand, 70 + length(p_brand) AS least FROM part UNION SELECT r_name, 1 FROM region), h AS (SELECT p_brand AS brand, count(*) AS n FROM part GROUP BY 1) SELECT brand, least, coalesce(n, 0) AS n, CAST(coalesce(n, 0) >= least AS INTEGER) AS passed FROM e LEFT JOIN h USING (brand)",
)
def brand_minimums(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_brand").alias("brand"))
    expected = p.distinct().select("brand", (F.length("brand") + 70).cast("bigint").alias("least")).union(
        table(spark, sf, "region").select("r_name", F.lit(1).cast("bigint"))
    )
    out = qa.group_minimums(p, "brand", expected)
    return out.select("brand", "least", "n", F.col("passed").cast("int").alias("passed"))


@query(
    "duplicate_ids",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def duplicate_ids(spark, sf):
    return qa.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "shard_validator",
    f"WITH {AMENITIES}, c AS (SELECT count(*) AS n FROM amenities) SELECT unnest(['master', 'manifest', 'shards']) AS part, n, 1 AS agree FROM c",
)
def shard_validator(spark, sf):
    """Write shards and their manifest, read them back, and compare the counts."""
    path = scratch(spark)
    rows = amenities(spark, sf).withColumn("park_code", F.col("parent"))
    sharded = sinks.shard_columns(rows, F.col("ingest_source") == "01-nps-arcgis", F.concat(F.lit("s"), F.col("nation").cast("string")))
    sinks.write_shards(sharded, path)
    manifest = spark.read.parquet(f"{path}/manifest").select(F.explode(F.sequence(F.lit(1), F.col("n"))).alias("x"))
    return qa.count_agreement({"master": rows, "manifest": manifest, "shards": sinks.read_shards(spark, path)}).select(
        "part", "n", F.col("agree")
    )


@query(
    "shard_manifest",
    f"WITH {AMENITIES} SELECT CASE WHEN ingest_source = '01-nps-arcgis' THEN 'federal' ELSE 'state' END AS shard, CASE WHEN ingest_source = '01-nps-arcgis' THEN 'US' ELSE concat('S', nation) END AS shard_state, count(*) AS n FROM amenities GROUP BY ALL",
)
def shard_manifest(spark, sf):
    rows = sinks.shard_columns(amenities(spark, sf), F.col("ingest_source") == "01-nps-arcgis", F.concat(F.lit("s"), F.col("nation").cast("string")))
    return sinks.write_shards(rows, scratch(spark))


@query(
    "tier_validator",
    f"WITH {AMENITIES} SELECT camp_tier, count(*) AS total, count(*) FILTER (WHERE access_mode = 'road') AS road, count(*) FILTER (WHERE access_mode = 'unknown') AS unknown FROM amenities WHERE kind = 'campground' GROUP BY camp_tier",
)
def tier_validator(spark, sf):
    camp = amenities(spark, sf).where("kind = 'campground'")
    return rollup.conditional_counts(camp, {"road": F.col("access_mode") == "road", "unknown": F.col("access_mode") == "unknown"}, ["camp_tier"])


_LEAK_NAMES = ["Blue State Park", "Ash Reserve", "Elm County Park", "Oak Memorial", "State Forest Elm"]


@query(
    "catalog_leakage",
    f"""WITH v AS (SELECT concat('S', n_nationkey) AS state FROM nation WHERE n_nationkey % 2 = 0), m AS (SELECT c_custkey AS id, concat('S', c_nationkey) AS state, {pick_sql(_LEAK_NAMES, 'c_custkey')} AS name, CASE WHEN c_custkey % 3 = 0 THEN 'official' ELSE 'osm' END AS source, CASE WHEN c_custkey % 4 = 0 THEN 'protection_title' ELSE 'name' END AS conf FROM customer),
    r AS (SELECT *, state IN (SELECT state FROM v) AS ver, CASE WHEN name IN ('Elm County Park', 'State Forest Elm') THEN 'excluded-name-us' WHEN source = 'osm' AND state IN (SELECT state FROM v) AND conf <> 'protection_title' AND name = 'Ash Reserve' THEN 'osm-no-explicit-name' END AS reason FROM m)
    SELECT CASE WHEN reason IS NOT NULL THEN 'leak' ELSE 'suspicious' END AS finding, reason, count(*) AS n FROM r WHERE reason IS NOT NULL OR (source = 'osm' AND ver AND conf <> 'protection_title') GROUP BY ALL""",
)
def catalog_leakage(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.expr("concat('S', c_nationkey)").alias("state"), F.lit("US").alias("country"),
        pick(_LEAK_NAMES, "c_custkey").alias("name"), F.expr("if(c_custkey % 3 = 0, 'official', 'osm')").alias("source"),
        F.expr("if(c_custkey % 4 = 0, 'protection_title', 'name')").alias("osm_confidence"),
    )
    verified = table(spark, sf, "nation").where("n_nationkey % 2 = 0").select(F.expr("concat('S', n_nationkey)").alias("admin"))
    return park_plans.leakage(rows, verified).groupBy("finding", "reason").agg(F.count(F.lit(1)).alias("n"))


# ---- S7 - S18 ---------------------------------------------------------------------------------------


@query(
    "embed_write",
    f"WITH {CAMPS}, {ROADS}, t AS (SELECT *, {DISPLAY_TIER} AS tier FROM rows_) SELECT land_manager, count(*) AS n, min(id) AS first_id FROM t WHERE tier = 'default' AND type <> 'dispersed' GROUP BY land_manager",
)
def embed_write(spark, sf):
    """Write the slim embed with its metadata and read it back."""
    from waymark.plans.camping import embed_us

    rows = camp_rows(spark, sf).withColumn("cluster_role", F.lit(None).cast("string")).withColumn("state", F.lit("TX"))
    rows = rows.withColumn("display_tier", camping.display_tier(camping.FilterConfig())["tier"])
    path = scratch(spark)
    sinks.write_embed(embed_us(rows), ["id", "name", "land_manager", "lat", "lon"], path, "camping")
    back = spark.read.schema("id bigint, name string, land_manager string, lat double, lon double").json(f"{path}/records")
    return back.groupBy("land_manager").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))


@query(
    "embed_metadata",
    f"WITH {CAMPS} SELECT 'camping' AS layer, count(*) AS record_count, count(*) FILTER (WHERE type = 'dispersed') AS dispersed FROM camps",
)
def embed_metadata(spark, sf):
    return sinks.embed_metadata(camps(spark, sf), "camping", {"dispersed": F.col("type") == "dispersed"})


@query(
    "layer_slices",
    "SELECT l_shipmode_ AS layer, n, 'file' AS placement FROM (SELECT concat(l_returnflag, l_linestatus, CASE WHEN l_linenumber = 7 THEN '7' ELSE '' END) AS l_shipmode_, count(*) AS n FROM lineitem GROUP BY 1)",
)
def layer_slices(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.expr("concat(l_returnflag, l_linestatus, if(l_linenumber = 7, '7', ''))").alias("layer"), "l_orderkey")
    path = scratch(spark)
    sinks.write_layers(rows, path)
    back = spark.read.schema("l_orderkey bigint, layer string").json(path)
    return sinks.layer_placement(back)


@query(
    "review_geojson",
    f"""WITH {CAMPS} SELECT concat('{{"type":"Feature","geometry":{{"type":"Point","coordinates":[', CAST(CAST(lon * 10000 AS BIGINT) AS VARCHAR), ',', CAST(CAST(round(lat * 10000) AS BIGINT) AS VARCHAR), ']}},"properties":{{"id":', id, ',"land_manager":"', land_manager, '"}}}}') AS value FROM camps WHERE land_manager = 'Unknown'""",
)
def review_geojson(spark, sf):
    rows = camps(spark, sf).withColumn("lon", F.expr("cast(lon * 10000 as bigint)")).withColumn("lat", F.expr("cast(round(lat * 10000) as bigint)"))
    return sinks.review_features(rows, ["id", "land_manager"], F.col("land_manager") == "Unknown")


@query(
    "incremental_pending",
    "SELECT o_orderkey AS id FROM orders WHERE o_orderkey NOT IN (SELECT event_id * 3 FROM events WHERE event_type <> 'error')",
)
def incremental_pending(spark, sf):
    cache = table(spark, sf, "events").where("event_type <> 'error'").select(F.expr("event_id * 3").alias("id"))
    return refresh.pending(table(spark, sf, "orders").select(F.col("o_orderkey").alias("id")), cache, ["id"])


@query(
    "refresh_completeness",
    "WITH h AS (SELECT DISTINCT event_id * 3 AS id FROM events) SELECT count(*) AS total, count(h.id) AS cached, CAST(count(h.id) / count(*) >= 0.99 AS INTEGER) AS complete FROM orders o LEFT JOIN h ON h.id = o.o_orderkey",
)
def refresh_completeness(spark, sf):
    cache = table(spark, sf, "events").select(F.expr("event_id * 3").alias("id"))
    out = refresh.completeness(table(spark, sf, "orders").select(F.col("o_orderkey").alias("id")), cache, ["id"])
    return out.select("total", "cached", F.col("complete").cast("int").alias("complete"))


@query(
    "tile_refresh",
    f"WITH t AS (SELECT c_custkey AS id, {coords_sql('c_custkey')} FROM customer) SELECT concat(CAST(floor(lat / 0.5) AS BIGINT), ':', CAST(floor(lon / 0.5) AS BIGINT)) AS tile, count(*) AS n FROM t GROUP BY 1",
)
def tile_refresh(spark, sf):
    """Two refresh runs over the same table: the second one adds only what the first left out."""
    path = scratch(spark)
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), *coords("c_custkey"), "c_nationkey")

    def compute(todo):
        return todo.select("id", "lat", "lon", refresh.tile().alias("tile"))

    refresh.refresh_table(rows.where("c_nationkey % 2 = 0"), path, ["id"], compute)
    refresh.refresh_table(rows, path, ["id"], compute)
    return spark.read.schema("id bigint, lat double, lon double, tile string").parquet(path).groupBy("tile").agg(F.count(F.lit(1)).alias("n"))


@query(
    "partial_rerun",
    "SELECT l_returnflag AS brand, 'old' AS run, count(*) AS n FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1 UNION ALL SELECT 'R', 'new', count(*) FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber < 4",
)
def partial_rerun(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("brand"), "l_linenumber")
    old, new = rows.withColumn("run", F.lit("old")), rows.where("l_linenumber < 4").withColumn("run", F.lit("new"))
    rerun = rows.where("brand = 'R'").select("brand").distinct()
    return refresh.partial_rerun(old, new, "brand", rerun).groupBy("brand", "run").agg(F.count(F.lit(1)).alias("n"))


@query(
    "shard_fallback",
    "WITH f AS (SELECT c_nationkey AS shard FROM customer WHERE c_nationkey % 4 > 0) SELECT shard, 'fresh' AS src, count(*) AS n FROM f GROUP BY 1 UNION ALL SELECT s_nationkey, 'previous', count(*) FROM supplier WHERE s_nationkey NOT IN (SELECT shard FROM f) GROUP BY 1",
)
def shard_fallback(spark, sf):
    fresh = table(spark, sf, "customer").where("c_nationkey % 4 > 0").select(F.col("c_nationkey").alias("shard"), F.lit("fresh").alias("src"))
    previous = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("shard"), F.lit("previous").alias("src"))
    return refresh.keep_previous_shards(previous, fresh, "shard").groupBy("shard", "src").agg(F.count(F.lit(1)).alias("n"))


# ---- Q4, Q5 -----------------------------------------------------------------------------------------


def _rules_sql(rows) -> str:
    """Rows of a validator: name, value, least, most, level."""
    made = []
    for name, value, least, most, level in rows:
        low, high = (f"CAST({v} AS DOUBLE)" if v is not None else "CAST(NULL AS DOUBLE)" for v in (least, most))
        made.append(f"SELECT '{name}' AS \"check\", CAST({value} AS DOUBLE) AS actual, {low} AS least, {high} AS most, '{level}' AS level FROM m, e")
    every = " UNION ALL ".join(made)
    return f"SELECT *, coalesce(actual >= coalesce(least, actual) AND actual <= coalesce(most, actual), false) AS passed FROM ({every}) r"


@query(
    "center_validator",
    f"""WITH c AS (SELECT c_custkey % 3 > 0 AS api, c_custkey % 7 > 0 AS hours, CASE WHEN c_custkey % 500 = 0 THEN '' ELSE 'TX' END AS state, c_custkey % 900 > 0 AS shown FROM customer),
    m AS (SELECT count(*) AS n, count(*) FILTER (WHERE hours) AS h, count(*) FILTER (WHERE api) AS a, count(*) FILTER (WHERE api AND hours) AS ah, count(*) FILTER (WHERE state = '') AS s FROM c),
    e AS (SELECT count(*) AS en, count(*) FILTER (WHERE hours) AS eh FROM c WHERE shown)
    {_rules_sql([('records', 'n', 1, None, 'fail'), ('report equals master', '0', 0, 0, 'fail'), ('api records', 'a', 1, None, 'fail'), ('api hours share', 'ah / a', 0.9, None, 'fail'), ('with hours', 'h', 500, None, 'fail'),
        ('hours share', 'h / n', 0.9, None, 'warn'), ('flagged NO_HOURS', '(n - h) / n', None, 0.15, 'warn'), ('without state', 's', None, 0, 'fail'), ('flagged NO_STATE', 's', None, 0, 'fail'),
        ('embed equals master', 'en - n', 0, 0, 'fail'), ('embed hours equal report', 'eh - h', 0, 0, 'fail')])}""",
)
def center_validator(spark, sf):
    """Visitor centers: hours shares, states, and an embed that lost rows."""
    key = F.col("c_custkey")
    master = table(spark, sf, "customer").select(
        key.alias("id"), F.when(key % 3 > 0, "nps-api").otherwise("arcgis").alias("coord_source"), (key % 7 > 0).alias("has_hours"),
        F.when(key % 500 == 0, "").otherwise("TX").alias("state"),
        F.expr("filter(array(if(c_custkey % 7 = 0, 'NO_HOURS', null), if(c_custkey % 500 = 0, 'NO_STATE', null)), x -> x is not null)").alias("map_flags"),
    )
    report = master.agg(F.count(F.lit(1)).alias("total_records"), F.expr("count_if(has_hours)").alias("with_hours"))
    return unit_plans.center_checks(master, master.where("id % 900 > 0"), report)


@query(
    "center_validator_ca",
    f"""WITH c AS (SELECT CASE WHEN c_custkey % 4 = 0 THEN 'other' ELSE 'national_park' END AS category, CASE WHEN c_custkey % 10 = 1 THEN '' ELSE 'Ash' END AS parent FROM customer),
    m AS (SELECT count(*) AS n, count(*) FILTER (WHERE parent <> '' AND category <> 'other') AS p FROM c), e AS (SELECT count(*) AS en FROM customer)
    {_rules_sql([('records', 'n', 1, None, 'fail'), ('report equals master', '0', 0, 0, 'fail'), ('strong parents', 'p / n', 0.7, None, 'warn'), ('with hours', '0', 1, None, 'warn'), ('embed present', 'en', 1, None, 'fail')])}""",
)
def center_validator_ca(spark, sf):
    key = F.col("c_custkey")
    master = table(spark, sf, "customer").select(
        key.alias("id"), F.when(key % 4 == 0, "other").otherwise("national_park").alias("parent_category"),
        F.when(key % 10 == 1, "").otherwise("Ash").alias("parent_name"), F.lit(None).cast("boolean").alias("has_hours"),
    )
    return unit_plans.canadian_center_checks(master, master, master.agg(F.count(F.lit(1)).alias("total_records")))


_CHECKED = f"""v AS (SELECT concat('S', n_nationkey) AS state FROM nation WHERE n_nationkey % 2 = 0),
    p AS (SELECT concat('k', c_custkey // 2 * 2 + CASE WHEN c_custkey % 100 = 1 THEN 0 ELSE c_custkey % 2 END) AS id, CASE WHEN c_custkey % 60 = 7 THEN NULL ELSE concat('S', c_nationkey) END AS state, {pick_sql(_LEAK_NAMES, 'c_custkey')} AS name,
      CASE WHEN c_custkey % 3 = 0 THEN 'official' ELSE 'osm' END AS source, CASE WHEN c_custkey % 4 = 0 THEN 'protection_title' ELSE 'name' END AS conf, c_custkey % 70 = 3 AS lost FROM customer),
    k AS (SELECT count(*) AS twice FROM (SELECT id FROM p GROUP BY id HAVING count(*) > 1)),
    x AS (SELECT count(*) AS leaks FROM p WHERE name IN ('Elm County Park', 'State Forest Elm') OR (source = 'osm' AND coalesce(state IN (SELECT state FROM v), false) AND conf <> 'protection_title' AND name = 'Ash Reserve'))"""


def _checked_parks(spark, sf):
    return table(spark, sf, "customer").select(
        F.expr("concat('k', c_custkey div 2 * 2 + if(c_custkey % 100 = 1, 0, c_custkey % 2))").alias("id"), F.lit("US").alias("country"),
        F.expr("if(c_custkey % 60 = 7, null, concat('S', c_nationkey))").alias("state"), pick(_LEAK_NAMES, "c_custkey").alias("name"),
        F.expr("if(c_custkey % 3 = 0, 'official', 'osm')").alias("source"), F.expr("if(c_custkey % 4 = 0, 'protection_title', 'name')").alias("osm_confidence"),
        pick(_LEAK_NAMES, "c_custkey").alias("display_name"), F.lit("state_park").alias("category"),
        F.expr("if(c_custkey % 70 = 3, null, 40D)").alias("lat"), F.expr("if(c_custkey % 70 = 3, double('nan'), -100D)").alias("lon"),
    )


@query(
    "state_park_validator",
    f"""WITH {_CHECKED}, m AS (SELECT count(*) AS n, count(*) FILTER (WHERE lost) AS bad, count(*) FILTER (WHERE state IS NULL) AS s FROM p), e AS (SELECT * FROM k, x)
    {_rules_sql([('records', 'n', 1, None, 'fail'), ('expected records', 'n', 500, None, 'warn'), ('repeated ids', 'twice', None, 0, 'fail'), ('bad coordinates', 'bad', None, 0, 'fail'), ('leaks', 'leaks', None, 0, 'fail'),
        ('embed equals master', '0', 0, 0, 'fail'), ('without id', '0', None, 0, 'fail'), ('without country', '0', None, 0, 'fail'), ('without state', 's', None, 0, 'fail'), ('without name', '0', None, 0, 'fail'),
        ('without display_name', '0', None, 0, 'fail'), ('without category', '0', None, 0, 'fail')])}""",
)
def state_park_validator(spark, sf):
    """Park master: required fields, repeated ids, coordinates and leaks, some of which fail."""
    master = _checked_parks(spark, sf)
    verified = table(spark, sf, "nation").where("n_nationkey % 2 = 0").select(F.expr("concat('S', n_nationkey)").alias("admin"))
    return park_plans.catalogue_checks(master, master.select("id"), verified, 500)


@query(
    "official_coverage",
    """WITH h AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1), o AS (SELECT s_nationkey AS k, count(*) * 25 AS expected FROM supplier GROUP BY 1)
    SELECT concat('S', k) AS admin, expected, coalesce(n, 0) AS n, coalesce(n, 0) >= expected * 0.5 AS passed FROM o LEFT JOIN h USING (k)""",
)
def official_coverage(spark, sf):
    """Records of an admin against what its official source lists."""
    master = table(spark, sf, "customer").select(F.expr("concat('S', c_nationkey)").alias("state"))
    expected = table(spark, sf, "supplier").groupBy(F.expr("concat('S', s_nationkey)").alias("admin")).agg((F.count(F.lit(1)) * 25).alias("expected"))
    return park_plans.official_coverage(master, expected)
