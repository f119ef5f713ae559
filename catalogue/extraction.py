"""Queries: page extraction, JSON sources, and the layer builders over map elements."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue.common import (
    M, REFS, SPOTS, boxes_sql, coords, coords_sql, half, hav, near, nodes, pick, pick_sql, query, slug_sql, table, token_sql, ways,
)
from catalogue.curation import _park_catalogue, _units
from catalogue.labels import CATALOGUE
from catalogue.reports import scratch
from waymark import fixed_values as fv
from waymark.functions import geo, tags
from waymark.operators.elements import ring_edges
from waymark.plans import amenities as amenity_plans
from waymark.plans import camping as camping_plans
from waymark.plans import fuel as fuel_plans
from waymark.plans import pages as page_plans
from waymark.plans import parks as park_plans
from waymark.plans import units as unit_plans
from waymark.sources import readers, sinks

# ---- H1 - H7: the crawled pages, each with the kind of markup its site would carry -------------------

_SNIPPETS = [
    '<a href="https://www.google.com/maps/place/x/@3d31.5,!3d31.25!4d-100.5">map</a>',
    '<meta name="geo.position" content="45.5;-110.25">',
    '<a href="https://x/?daddr=29.75%2C-95.5">go</a>',
    '<p>Latitude: 41.125</p><p>Longitude: -88.5</p>',
    '<div class="map-marker" data-lat="30.5" data-lng="-97.25" data-mapinfo="Store A<br/>Main  St"></div><div class="map-marker" data-lat="x" data-lng="-1" data-mapinfo="bad"></div>',
    '{"yextDisplayCoordinate":{"lat":33.5,"long":-90.75}}',
    "",
]


def _pages(spark, sf):
    return table(spark, sf, "pages").withColumn("html", F.concat("html", pick(_SNIPPETS, "page_id")))


_PAGES = f"pg AS (SELECT page_id, url, concat(html, {pick_sql(_SNIPPETS, 'page_id')}) AS html, CAST(page_id % 7 AS INTEGER) AS k FROM pages)"


@query(
    "page_coords",
    f"""WITH {_PAGES} SELECT page_id, [31.25, 45.5, 29.75, NULL, NULL, 33.5, NULL][k + 1]::DOUBLE AS lat, [-100.5, -110.25, -95.5, NULL, NULL, -90.75, NULL][k + 1]::DOUBLE AS lon, ['map_link', 'geo_position', 'directions', NULL, NULL, 'display_coordinate', NULL][k + 1] AS pattern FROM pg""",
)
def page_coords(spark, sf):
    c = page_plans.page_coordinates()
    return _pages(spark, sf).withColumn("c", c).select(
        "page_id", F.col("c.lat").alias("lat"), F.col("c.lon").alias("lon"), F.col("c.pattern").alias("pattern")
    )


@query(
    "page_titles",
    f"""WITH {_PAGES}, t AS (SELECT page_id, k, trim(replace(regexp_extract(html, '(?i)<title>([^<]+)</title>', 1), '&amp;', '&')) AS title FROM pg)
    SELECT page_id, title AS page_title, CASE WHEN k = 3 THEN 41.125e0 WHEN k = 4 THEN 30.5e0 END AS lat, CASE WHEN k = 3 THEN -88.5e0 WHEN k = 4 THEN -97.25e0 END AS lon,
      CASE WHEN regexp_matches(title, '(?i)\\bhistoric site\\b') THEN 'historic' ELSE 'park' END AS listing_kind FROM t""",
)
def page_titles(spark, sf):
    return _pages(spark, sf).withColumn("f", page_plans.park_page_fields()).select(
        "page_id", F.col("f.page_title").alias("page_title"), F.col("f.lat").alias("lat"), F.col("f.lon").alias("lon"),
        F.col("f.listing.listing_kind").alias("listing_kind"),
    )


@query("page_markers", f"WITH {_PAGES} SELECT page_id, 30.5e0 AS lat, -97.25e0 AS lon, 'Store A, Main St' AS label FROM pg WHERE k = 4")
def page_markers(spark, sf):
    return page_plans.map_markers(_pages(spark, sf)).select("page_id", "lat", "lon", "label")


@query(
    "page_link_rows",
    """WITH m AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="/([^"]*)">([^<]*)</a>', 1)) AS target FROM pages) SELECT page_id, count(*) AS links, count(DISTINCT target) AS targets FROM m GROUP BY page_id""",
)
def page_link_rows(spark, sf):
    rows = page_plans.marker_rows(table(spark, sf, "pages"), '<a href="/([^"]*)">([^<]*)</a>', ["target", "label"])
    return rows.groupBy("page_id").agg(F.count(F.lit(1)).alias("links"), F.count_distinct("target").alias("targets"))


@query(
    "page_slugs",
    """WITH s AS (SELECT regexp_extract(url, '^https?://([^/]+)/', 1) AS site, lower(unnest(regexp_extract_all(html, '<a href="/([A-Za-z0-9][A-Za-z0-9-]*)"', 1))) AS slug FROM pages)
    SELECT DISTINCT site, slug FROM s WHERE length(slug) >= 3 AND slug NOT IN ('the', 'and', 'der')""",
)
def page_slugs(spark, sf):
    site = F.regexp_extract("url", "^https?://([^/]+)/", 1)
    return page_plans.link_slugs(
        table(spark, sf, "pages"), '<a href="/([A-Za-z0-9][A-Za-z0-9-]*)"', ["the", "and", "der"], 3, site
    )


def _store_pages(spark, sf):
    """Store-list pages of fifty suppliers each, as a schema.org department list."""
    dept = F.struct(
        F.expr("if(s_suppkey % 6 = 0, 'Store', 'GasStation')").alias("@type"),
        F.concat(F.lit("#"), F.col("s_suppkey").cast("string"), F.lit(" &#8211; City"), F.col("s_suppkey").cast("string"), F.lit(", TX")).alias("name"),
        F.struct(F.lit("31.5").alias("latitude"), F.col("s_acctbal").cast("string").alias("longitude")).alias("geo"),
        F.struct(F.expr("if(s_suppkey % 2 = 0, '', concat('Town', s_suppkey))").alias("addressLocality"), F.lit("").alias("addressRegion")).alias("address"),
    )
    heads = F.concat(F.lit("<h4>#"), F.col("s_suppkey").cast("string"), F.lit(" &#8211; x</h4>"))
    grouped = table(spark, sf, "supplier").groupBy(F.expr("s_suppkey div 50").alias("page_id")).agg(
        F.to_json(F.struct(F.collect_list(dept).alias("department"))).alias("j"), F.array_join(F.collect_list(heads), "").alias("h")
    )
    return grouped.select(
        "page_id", F.concat(F.lit('<script type="application/ld+json">'), "j", F.lit("</script>"), "h").alias("html")
    )


@query(
    "store_list_rows",
    "SELECT s_suppkey // 50 AS page_id, s_suppkey AS store_number, CASE WHEN s_suppkey % 2 = 0 THEN concat('City', s_suppkey) ELSE concat('Town', s_suppkey) END AS city, 'TX' AS state, s_acctbal AS lon FROM supplier WHERE s_suppkey % 6 <> 0",
)
def store_list_rows(spark, sf):
    return page_plans.linked_data_stores(_store_pages(spark, sf)).select("page_id", "store_number", "city", "state", "lon")


@query(
    "store_heading_check",
    "SELECT s_suppkey // 50 AS page_id, count(*) AS headings, count(DISTINCT s_suppkey) AS distinct_numbers, max(s_suppkey) AS highest FROM supplier GROUP BY 1",
)
def store_heading_check(spark, sf):
    return page_plans.heading_store_numbers(_store_pages(spark, sf)).select(
        "page_id", F.col("headings").cast("bigint").alias("headings"), F.col("distinct_numbers").cast("bigint").alias("distinct_numbers"), "highest"
    )


_FRONTS = ["Pilot Travel Center", "One9 Dealer", "Flying J Travel Plaza", "Pilot", ""]


@query(
    "storefront_fields",
    f"""WITH t AS (SELECT c_custkey AS page_id, {pick_sql(_FRONTS, 'c_custkey')} AS f, c_custkey % 3 AS s, CASE WHEN c_custkey % 4 = 0 THEN 'Pilot Fuel Only' ELSE 'Pilot' END AS l FROM customer)
    SELECT page_id, f AS storefront, CAST(s AS INTEGER) AS showers, CASE WHEN NOT (contains(lower(f), 'dealer')) AND l = 'Pilot' AND (s > 0 OR contains(f, 'Travel')) THEN 1 ELSE 0 END AS is_full,
      CASE WHEN contains(f, 'Flying J Travel') THEN 'flyingj' ELSE 'pilot' END AS brand FROM t""",
)
def storefront_fields(spark, sf):
    html = F.concat(
        F.lit('{"c_storefrontBrand":"'), pick(_FRONTS, "c_custkey"), F.lit('","c_pagesShowersCount" : "'), F.expr("cast(c_custkey % 3 as string)"),
        F.lit('","c_pagesName":"'), F.expr("if(c_custkey % 4 = 0, 'Pilot Fuel Only', 'Pilot')"), F.lit('"}'),
    )
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("page_id"), html.alias("html")).withColumn("s", page_plans.storefront_fields())
    return rows.select(
        "page_id", F.col("s.storefront").alias("storefront"), F.col("s.showers").alias("showers"), F.col("s.is_full").cast("int").alias("is_full"),
        page_plans.page_brand().alias("brand"),
    )


def _wiki_pages(spark, sf):
    """List pages of a hundred customers each as table rows, one former table, and excluded links."""
    row = F.concat(
        F.lit("|-\n| [["), F.expr("element_at(array('Blue Lake', 'Fort Ash', 'Elm_Grove'), cast(c_custkey % 3 as int) + 1)"), F.lit(" "),
        F.col("c_custkey").cast("string"), F.expr("element_at(array(' State Park', ' State Historic Site', ' State Park|Elm'), cast(c_custkey % 3 as int) + 1)"),
        F.lit("]] || [[Ash County, Texas]]\n"),
    )
    body = table(spark, sf, "customer").groupBy(F.expr("c_custkey div 100").alias("page_id")).agg(F.array_join(F.collect_list(row), "").alias("rows"))
    return body.select(
        "page_id",
        F.concat(
            F.lit("{| class=wikitable\n|+ Former state parks\n|-\n| [[Old Gone State Park]]\n|}\n{| class=wikitable\n|+ Current state parks\n! Name\n"),
            "rows", F.lit("|-\n| {| nested\n|} [[File:x.jpg]] [[Category:Parks]]\n|}\n* [[Bullet State Park]]"),
        ).alias("wikitext"),
    )


@query(
    "wiki_list_counts",
    """SELECT c_custkey // 100 AS page_id, count(*) AS total, count(*) FILTER (WHERE c_custkey % 3 <> 1) AS parks, count(*) FILTER (WHERE c_custkey % 3 = 1) AS historic, 'wikitable' AS method FROM customer GROUP BY 1""",
)
def wiki_list_counts(spark, sf):
    return page_plans.wiki_counts(page_plans.wiki_list_links(_wiki_pages(spark, sf))).select("page_id", "total", "parks", "historic", "method")


# ---- S1 - S6, S13 -----------------------------------------------------------------------------------

_RECORD = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("size", T.LongType())])


@query("envelope_read", "SELECT s_nationkey AS nation, count(*) AS n, min(s_suppkey) AS first_id FROM supplier GROUP BY 1")
def envelope_read(spark, sf):
    """Record envelopes of fifty suppliers each, one document per file, written and read back."""
    record = F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("size"))
    docs = table(spark, sf, "supplier").groupBy(F.expr("s_suppkey div 50").alias("page")).agg(F.collect_list(record).alias("records"))
    path = scratch(spark)
    text = F.to_json(F.struct(F.lit("2024-01-01").alias("generated"), "records")).alias("value")
    docs.select(text).write.option("maxRecordsPerFile", 1).text(path)
    rows = readers.read_envelope(spark, f"{path}-absent", _RECORD, fallback=path)
    return rows.groupBy(F.col("size").cast("int").alias("nation")).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))


@query(
    "state_shards",
    "SELECT CASE c_nationkey % 3 WHEN 0 THEN 'CO' WHEN 1 THEN 'NM' ELSE 'TX' END AS shard, c_nationkey AS nation, count(*) AS n, min(c_custkey) AS first_id, count(*) FILTER (WHERE c_custkey % 2 = 0) AS accented FROM customer GROUP BY 1, 2",
)
def state_shards(spark, sf):
    """Shards of one state each, every one in another encoding, written and read back together."""
    named = F.expr("concat(if(c_custkey % 2 = 0, 'Montréal – ', 'Elm '), c_name)").alias("name")
    record = F.struct(F.col("c_custkey").alias("id"), named, F.col("c_nationkey").alias("size"))
    path = scratch(spark)
    for number, (code, encoding) in enumerate([("CO", "UTF-8"), ("NM", "UTF-16LE"), ("TX", "UTF-16BE")]):
        part = table(spark, sf, "customer").where(F.col("c_nationkey") % 3 == number)
        docs = part.groupBy(F.expr("c_custkey div 200").alias("page")).agg(F.collect_list(record).alias("records")).select("records")
        docs.write.option("maxRecordsPerFile", 1).option("encoding", encoding).json(f"{path}/osm-{code}.json")
    rows, _ = readers.read_state_shards(spark, path, _RECORD)
    return rows.groupBy("shard", F.col("size").cast("int").alias("nation")).agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), F.expr("count_if(startswith(name, 'Montréal – '))").alias("accented")
    )


@query(
    "json_lines_scan",
    "SELECT CASE WHEN l_linenumber = 5 THEN 'bad' ELSE 'good' END AS part, count(*) AS n FROM lineitem WHERE l_linenumber <> 6 GROUP BY 1",
)
def json_lines_scan(spark, sf):
    """Line JSON with blank and malformed lines among the good ones."""
    good = F.to_json(F.struct(F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("name"), F.col("l_linenumber").alias("size")))
    line = F.when(F.col("l_linenumber") == 5, F.concat(F.lit("{oops "), good)).when(F.col("l_linenumber") == 6, F.lit("  ")).otherwise(good)
    rows, bad = readers.split_json_lines(table(spark, sf, "lineitem").select(line.alias("value")), _RECORD)
    both = rows.select(F.lit("good").alias("part")).unionByName(bad.select(F.lit("bad").alias("part")))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query("json_lines_write", "SELECT o_orderstatus AS status, count(*) AS n, max(o_orderkey) AS last_id FROM orders GROUP BY 1")
def json_lines_write(spark, sf):
    path = scratch(spark)
    sinks.write_json_lines(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), path)
    back = spark.read.schema("o_orderkey bigint, o_orderstatus string").json(path)
    return back.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("last_id"))


def _feature_pages(spark, sf):
    """Feature pages of a hundred customers each; every fifth feature is a ring, not a point."""
    lat, lon = coords("c_custkey")
    point = F.expr("c_custkey % 5 > 0")

    def corner(a, b):
        return F.array(F.col("lon") + a, F.col("lat") + b)

    ring = F.array(F.array(corner(0.0, 0.0), corner(0.2, 0.0), corner(0.2, 0.4), corner(0.0, 0.0)))
    base = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", lat, lon)
    feature = F.struct(
        F.create_map(
            F.lit("UNIT_CODE"), F.concat(F.lit("n"), (F.col("c_custkey") % 140).cast("string")), F.lit("NAME"), F.col("c_mktsegment"),
            F.lit("POITYPE"), pick(["Campground", "Picnic Area", "Trailhead", "Restroom", "Camping"], "c_custkey"), F.lit("PARK_LABEL"), F.lit("Long label"),
        ).alias("attributes"),
        F.struct(
            F.when(point, F.col("lon")).alias("x"), F.when(point, F.col("lat")).alias("y"), F.when(~point, ring).alias("rings")
        ).alias("geometry"),
    )
    return base.groupBy(F.expr("c_custkey div 100").alias("page")).agg(F.to_json(F.struct(F.collect_list(feature).alias("features"))).alias("body"))


@query(
    "feature_pages",
    f"""WITH {SPOTS} SELECT segment AS name, concat('n', id % 140) AS code, {half("CASE WHEN id % 5 = 0 THEN lat + 0.2 ELSE lat END", 100000)} AS lat, {half("CASE WHEN id % 5 = 0 THEN lon + 0.1 ELSE lon END", 100000)} AS lon, 'Long label' AS found FROM spots""",
)
def feature_pages(spark, sf):
    rows = readers.flatten_features(_feature_pages(spark, sf), {"name": "NAME", "code": "UNIT_CODE"})
    return rows.select(
        "name", "code", geo.half_up("lat", 1e5).alias("lat"), geo.half_up("lon", 1e5).alias("lon"),
        readers.attribute_by_pattern("attributes", "park", lambda v: F.length(v) > 2).alias("found"),
    )


@query(
    "federal_amenities",
    """WITH u AS (SELECT lower(concat('N', s_suppkey)) AS code, s_suppkey AS seq, CASE WHEN s_suppkey % 5 = 4 THEN concat('Hill ', s_suppkey // 5) WHEN s_suppkey % 5 = 0 THEN concat('Hill ', s_suppkey // 5) ELSE concat('Vale ', s_suppkey) END AS short, s_suppkey % 5 = 4 AS pres FROM supplier),
    pr AS (SELECT lower(short) AS k, min_by(code, seq) AS code FROM u GROUP BY 1), al AS (SELECT u.code, p.code AS pcode FROM u JOIN pr p ON p.k = lower(u.short) WHERE u.pres AND p.code <> u.code),
    t AS (SELECT concat('n', c_custkey % 140) AS code, ['campground', 'picnic_area', NULL, 'restroom', 'campground'][CAST(c_custkey % 5 AS INTEGER) + 1] AS kind FROM customer)
    SELECT coalesce(al.pcode, t.code) AS park_code, kind, count(*) AS n FROM t LEFT JOIN al ON al.code = t.code WHERE kind IS NOT NULL GROUP BY ALL""",
)
def federal_amenities(spark, sf):
    rows = readers.flatten_features(_feature_pages(spark, sf), {"name": "NAME", "park_code": "UNIT_CODE", "poi_type": "POITYPE"})
    records, _ = amenity_plans.federal_records(rows, _units(spark, sf))
    return records.groupBy("park_code", "kind").agg(F.count(F.lit(1)).alias("n"))


@query(
    "amenity_skip_counts",
    "SELECT 'unclassified' AS reason, count(*) AS n FROM customer WHERE c_custkey % 5 = 2",
)
def amenity_skip_counts(spark, sf):
    rows = readers.flatten_features(_feature_pages(spark, sf), {"name": "NAME", "park_code": "UNIT_CODE", "poi_type": "POITYPE"})
    return amenity_plans.federal_records(rows, _units(spark, sf))[1]


@query(
    "center_api_pages",
    """SELECT concat('vc', c_custkey) AS id, lower(concat('P', c_nationkey)) AS park_code, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 30.5e0 END AS lat FROM customer""",
)
def center_api_pages(spark, sf):
    row = F.struct(
        F.concat(F.lit("vc"), F.col("c_custkey")).alias("id"), F.col("c_name").alias("name"), F.concat(F.lit("P"), F.col("c_nationkey")).alias("parkCode"),
        F.expr("if(c_custkey % 4 = 0, '', '30.5')").alias("latitude"), F.lit("-100.25").alias("longitude"),
    )
    pages = table(spark, sf, "customer").groupBy(F.expr("c_custkey div 50").alias("p")).agg(F.to_json(F.struct(F.collect_list(row).alias("data"))).alias("body"))
    return unit_plans.api_center_records(pages).select("id", "park_code", "lat")


@query(
    "geojson_parts",
    "SELECT concat('u', s_suppkey) AS code, CAST(k AS INTEGER) AS part, CASE WHEN s_suppkey % 3 = 0 AND k = 0 THEN 2 ELSE 1 END AS rings, CASE WHEN s_suppkey % 3 = 0 AND k = 0 THEN 7 ELSE 4 END AS edges FROM supplier, range(0, 2) t(k) WHERE k = 0 OR s_suppkey % 2 = 0",
)
def geojson_parts(spark, sf):
    """Feature collections with polygons, holes and multi-polygons to part rows and edges."""
    outer, hole = "[[0,0],[4,0],[4,4],[0,4],[0,0]]", "[[1,1],[2,1],[2,2],[1,1]]"
    first = F.when(F.expr("s_suppkey % 3 = 0"), F.lit(f"[{outer},{hole}]")).otherwise(F.lit(f"[{outer}]"))
    multi = F.expr("s_suppkey % 2 = 0")
    geometry = F.concat(
        F.lit('{"type":"'), F.when(multi, F.lit("MultiPolygon")).otherwise(F.lit("Polygon")), F.lit('","coordinates":'),
        F.when(multi, F.concat(F.lit("["), first, F.lit(f",[{outer}]]"))).otherwise(first), F.lit("}"),
    )
    feature = F.concat(F.lit('{"properties":{"parkCode":"u'), F.col("s_suppkey").cast("string"), F.lit('"},"geometry":'), geometry, F.lit("}"))
    body = table(spark, sf, "supplier").groupBy(F.expr("s_suppkey div 50").alias("page")).agg(
        F.concat(F.lit('{"features":['), F.array_join(F.collect_list(feature), ","), F.lit("]}")).alias("body")
    )
    parts = readers.polygon_parts(body, properties={"code": "parkCode"})
    edges = readers.part_edges(parts.withColumn("pid", F.concat_ws("/", "code", "part")), "pid").groupBy("pid").agg(F.count(F.lit(1)).cast("int").alias("edges"))
    return (
        parts.withColumn("pid", F.concat_ws("/", "code", "part")).join(edges, "pid")
        .select("code", "part", F.size("rings").alias("rings"), "edges")
    )


# ---- B1 - B7, B11 - B13, B20: layers over map elements -----------------------------------------------

_NODE_TAGS = ["fuel", "cafe", "fuel", "toilets"]


def _fuel_nodes(spark, sf):
    return nodes(spark, sf).select(
        "id", "lat", "lon",
        F.create_map(
            F.lit("amenity"), pick(_NODE_TAGS, "id"), F.lit("name"), F.col("tags")["name"], F.lit("brand"), F.col("tags")["brand"],
            F.lit("operator"), F.expr("if(id % 5 = 0, 'promo oil', '')"), F.lit("height"), F.lit("3"),
        ).alias("tags"),
    )


def _fuel_ways(spark, sf):
    return ways(spark, sf).select(
        "id", "refs",
        F.create_map(
            F.lit("highway"), F.expr("if(id % 20 = 0, 'services', 'primary')"), F.lit("name"), F.expr("if(id % 40 = 0, 'ONroute Ash', 'Stop')"), F.lit("brand"), F.lit(""),
        ).alias("tags"),
    )


_CANDIDATES = f"""{REFS}, wc AS (SELECT r.way_id, avg(n.lat) AS lat, avg(n.lon) AS lon FROM refs r JOIN nodes n ON n.id = r.ref WHERE r.way_id % 20 = 0 GROUP BY r.way_id),
    cand AS (SELECT 'node' AS osm_type, p_partkey AS osm_id, p_name AS name, p_brand AS brand, CASE WHEN p_partkey % 5 = 0 THEN 'promo oil' ELSE '' END AS op FROM part WHERE p_size <> 13 AND p_partkey % 2 = 0
      UNION ALL SELECT 'way', way_id, CASE WHEN way_id % 40 = 0 THEN 'ONroute Ash' ELSE 'Stop' END, '', '' FROM wc)"""


@query(
    "fuel_candidates",
    f"""WITH {_CANDIDATES} SELECT osm_type, osm_id, {token_sql("concat_ws(' ', nullif(brand, ''), nullif(op, ''), name)")} AS search_blob FROM cand""",
)
def fuel_candidates(spark, sf):
    return fuel_plans.candidates(_fuel_nodes(spark, sf), _fuel_ways(spark, sf)).select("osm_type", "osm_id", "search_blob")


_FUEL_BRAND = """CASE WHEN (b <> '' AND (contains(b, 'brand 1') OR contains('brand 1', b))) OR contains(o, 'promo') OR contains(n, 'hot bolt') THEN 'bolt_stop'
      WHEN n = 'old ring' OR (b <> '' AND (contains(b, 'brand 24') OR contains('brand 24', b))) OR n = 'rod' OR starts_with(n, 'rod ') OR contains(n, ' rod ') OR (b <> '' AND starts_with(n, 'old ring')) THEN 'ringway'
      WHEN n = 'gear' OR contains(n, 'red gear') OR contains(n, 'gizmo') OR (b <> '' AND starts_with(n, 'gear')) THEN 'gearbox' END"""


@query(
    "branded_fuel",
    f"""WITH {_CANDIDATES}, t AS (SELECT osm_type, {token_sql('brand')} AS b, {token_sql('op')} AS o, {token_sql('name')} AS n FROM cand), m AS (SELECT osm_type, {_FUEL_BRAND} AS brand_id FROM t)
    SELECT osm_type, brand_id, CASE brand_id WHEN 'ringway' THEN 'convenience_fuel' ELSE 'travel_plaza' END AS type, count(*) AS n FROM m WHERE brand_id IS NOT NULL GROUP BY ALL""",
)
def branded_fuel(spark, sf):
    rows = fuel_plans.branded(fuel_plans.candidates(_fuel_nodes(spark, sf), _fuel_ways(spark, sf)), CATALOGUE)
    return rows.groupBy("osm_type", "brand_id", "type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "generic_fuel",
    f"""WITH {_CANDIDATES}, t AS (SELECT osm_type, osm_id, {token_sql('brand')} AS b, {token_sql('op')} AS o, {token_sql('name')} AS n FROM cand) SELECT osm_type, osm_id FROM t WHERE {_FUEL_BRAND} IS NULL""",
)
def generic_fuel(spark, sf):
    return fuel_plans.generic(fuel_plans.candidates(_fuel_nodes(spark, sf), _fuel_ways(spark, sf)), CATALOGUE).select("osm_type", "osm_id")


@query(
    "shard_fuel",
    f"""WITH t AS (SELECT p_partkey AS id, p_name, {token_sql('p_brand')} AS b, CASE WHEN p_partkey % 5 = 0 THEN 'promo oil' ELSE '' END AS o, {token_sql('p_name')} AS n FROM part WHERE p_size <> 13), m AS (SELECT *, {_FUEL_BRAND} AS brand_id FROM t)
    SELECT concat('FUEL-', upper(brand_id), '-', CASE WHEN id % 10 = 0 THEN 'AZ' WHEN id % 2 = 0 THEN 'CO' ELSE 'TX' END, '-', {slug_sql('p_name')}, '-', id) AS id, p_name AS name, brand_id,
      CASE brand_id WHEN 'ringway' THEN 'convenience_fuel' ELSE 'travel_plaza' END AS type, concat('https://www.openstreetmap.org/node/', id) AS url FROM m WHERE brand_id IS NOT NULL""",
)
def shard_fuel(spark, sf):
    """Branded records from a partitioned table of state lists; every tenth element is on two lists."""
    own = _fuel_nodes(spark, sf).withColumn("shard", F.expr("if(id % 2 = 0, 'CO', 'TX')"))
    again = own.where("id % 10 = 0").withColumn("shard", F.lit("AZ"))
    path = scratch(spark)
    lists = own.unionByName(again).select("shard", F.col("id").alias("seq"), F.lit("node").alias("osm_type"), F.col("id").alias("osm_id"), "lat", "lon", "tags")
    lists.write.partitionBy("shard").parquet(path)
    return fuel_plans.branded_shards(spark.read.parquet(path), CATALOGUE).select("id", "name", "brand_id", "type", "url")


@query("service_plazas", f"WITH {_CANDIDATES} SELECT osm_id FROM cand WHERE osm_type = 'way' AND osm_id % 40 = 0")
def service_plazas(spark, sf):
    return fuel_plans.plazas(fuel_plans.candidates(_fuel_nodes(spark, sf), _fuel_ways(spark, sf))).select("osm_id")


_CAMP_OPS = ["National Park Service", "KOA", "US Forest Service", ""]


def with_later_copies(points):
    """Input order, and of each third element a later row farther south under another name."""
    seq = F.col("osm_id") * 2
    later = points.where("osm_id % 3 = 0").select(
        "osm_type", "osm_id", (F.col("lat") - 0.001).alias("lat"), "lon",
        F.map_concat(F.map_filter("tags", lambda k, v: k != "name"), F.create_map(F.lit("name"), F.lit("later row"))).alias("tags"),
        (seq + 1).alias("seq"),
    )
    return points.withColumn("seq", seq).unionByName(later)


@query(
    "camp_records_us",
    f"""WITH n AS (SELECT p_partkey AS id, {pick_sql(_CAMP_OPS, 'p_partkey')} AS op, CASE p_partkey % 3 WHEN 0 THEN 'dispersed' ELSE 'basic' END AS site, CASE WHEN p_partkey % 6 = 1 THEN '' ELSE p_name END AS name FROM part WHERE p_size <> 13)
    SELECT id AS osm_id, CASE WHEN name = '' THEN concat('OSM node ', id) ELSE name END AS name, CASE site WHEN 'dispersed' THEN 'dispersed' ELSE 'developed' END AS type, CASE op WHEN 'National Park Service' THEN 'NPS' WHEN 'US Forest Service' THEN 'USFS' ELSE 'Unknown' END AS land_manager, CASE site WHEN 'dispersed' THEN 'free' ELSE 'unknown' END AS cost FROM n WHERE op <> 'KOA'""",
)
def camp_records_us(spark, sf):
    points = nodes(spark, sf).select(
        F.lit("node").alias("osm_type"), F.col("id").alias("osm_id"), "lat", "lon",
        F.create_map(
            F.lit("operator"), pick(_CAMP_OPS, "id"), F.lit("camp_site"), F.expr("if(id % 3 = 0, 'dispersed', 'basic')"),
            F.lit("name"), F.expr("if(id % 6 = 1, '', tags['name'])"),
        ).alias("tags"),
    )
    return camping_plans.map_records_us(with_later_copies(points)).select("osm_id", "name", "type", "land_manager", "cost")


@query(
    "facility_records",
    "SELECT concat('CG-RIDB-', s_suppkey) AS id, CASE s_suppkey % 3 WHEN 0 THEN 'NPS' WHEN 1 THEN 'USFS' ELSE 'Federal' END AS land_manager FROM supplier WHERE s_suppkey % 10 > 0",
)
def facility_records(spark, sf):
    rows = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("facility_id"), F.expr("if(s_suppkey % 10 > 0, s_name, ' ')").alias("name"),
        pick(["National Park Service", "Forest Service", "Tribe"], "s_suppkey").alias("agency"), *coords("s_suppkey"), F.lit(True).alias("reservable"),
    )
    return camping_plans.facility_records(rows).select("id", "land_manager")


_AMEN_NODES = ["toilets", "parking", "x", "ranger_station"]


@query(
    "park_map_amenities",
    f"""WITH {REFS}, a AS (SELECT p_partkey AS id, {coords_sql('p_partkey', '60000')}, p_name AS name, ['restroom', 'parking', 'campground', 'visitor_center'][CAST(p_partkey % 4 AS INTEGER) + 1] AS kind, CASE WHEN p_partkey % 8 = 2 THEN 'State Parks' WHEN p_partkey % 16 = 1 THEN 'Parcs Canada' ELSE '' END AS op FROM part WHERE p_size <> 13),
    b AS (SELECT * FROM a WHERE kind <> 'campground' OR op = 'State Parks'), {boxes_sql(fv.STATE_BOXES)},
    st AS (SELECT p.id, min_by(x.code, x.seq) AS state FROM b p JOIN boxes x ON p.lat BETWEEN x.south AND x.north AND p.lon BETWEEN x.west AND x.east GROUP BY p.id),
    cat AS (SELECT s_suppkey AS sid, {coords_sql('s_suppkey * 11', '60000')} FROM supplier), pr AS (SELECT r.id, arg_min(b.sid, ({hav('r.lat', 'r.lon', 'b.lat', 'b.lon')}, b.sid)) AS sid FROM b r JOIN st USING (id) JOIN cat b ON {near('r', 'b', 5000.0, M)} AND st.state = 'CA' GROUP BY r.id)
    SELECT b.id AS osm_id, b.kind, format('sp{{:08d}}', pr.sid) AS parent_id FROM b JOIN pr USING (id) WHERE b.op <> 'Parcs Canada'""",
)
def park_map_amenities(spark, sf):
    points = nodes(spark, sf).select(
        F.lit("node").alias("osm_type"), F.col("id").alias("osm_id"), *coords("id", "60000"),
        F.create_map(
            F.lit("amenity"), pick(_AMEN_NODES, "id"), F.lit("tourism"), F.expr("if(id % 4 = 2, 'camp_site', '')"), F.lit("name"), F.col("tags")["name"],
            F.lit("operator"), F.expr("case when id % 8 = 2 then 'State Parks' when id % 16 = 1 then 'Parcs Canada' else '' end"),
        ).alias("tags"),
    )
    lat, lon = coords("seq * 11", "60000")
    catalogue = _park_catalogue(spark, sf).select("park_id", "seq", F.lit("").alias("code"), "name", F.lit("CA").alias("state"), lat, lon)
    rows, _ = amenity_plans.park_map_records(points, catalogue)
    return rows.select(F.substring_index("osm_key", ":", -1).cast("bigint").alias("osm_id"), "kind", "parent_id")


_PARK_TAG_NAMES = ["Blue Lake State Park", "Ash Reserve", "Fort Oak State Historic Site", "Elm National Forest"]


@query(
    "park_map_records",
    f"""WITH n AS (SELECT p_partkey AS id, {pick_sql(_PARK_TAG_NAMES, 'p_partkey')} AS name, {coords_sql('p_partkey', '60000')}, CASE WHEN p_partkey % 5 = 0 THEN 'https://x/y' ELSE '' END AS url FROM part WHERE p_size <> 13),
    {boxes_sql(fv.STATE_BOXES)}, st AS (SELECT n.id, min_by(b.code, b.seq) AS state FROM n JOIN boxes b ON n.lat BETWEEN b.south AND b.north AND n.lon BETWEEN b.west AND b.east GROUP BY n.id)
    SELECT concat('node/', id) AS osm_id, st.state, name, CASE name WHEN 'Blue Lake State Park' THEN 'park' ELSE 'historic_site' END AS category, url, CAST(url = '' AS INTEGER) AS review FROM n JOIN st USING (id) WHERE name IN ('Blue Lake State Park', 'Fort Oak State Historic Site')""",
)
def park_map_records(spark, sf):
    points = nodes(spark, sf).select(
        F.lit("node").alias("osm_type"), F.col("id").alias("osm_id"), *coords("id", "60000"),
        F.create_map(F.lit("name"), pick(_PARK_TAG_NAMES, "id"), F.lit("website"), F.expr("if(id % 5 = 0, 'https://x/y', 'x')")).alias("tags"),
    )
    out = park_plans.map_records(points, "US")
    return out.select("osm_id", "state", "name", "category", "url", F.col("needs_review").cast("int").alias("review"))


@query(
    "named_park_edges",
    f"""WITH {REFS}, park AS (SELECT o_orderkey AS way_id FROM orders WHERE o_orderkey % 3 = 0), g AS (SELECT r.way_id, count(*) AS refs, count(n.id) AS found, min_by(r.ref, r.pos) AS a, max_by(r.ref, r.pos) AS b FROM refs r JOIN park USING (way_id) LEFT JOIN nodes n ON n.id = r.ref GROUP BY r.way_id)
    SELECT way_id AS polygon_id, CASE WHEN a = b THEN refs - 1 ELSE refs END AS edges FROM g WHERE refs = found AND refs >= 3""",
)
def named_park_edges(spark, sf):
    from waymark.operators.elements import way_rings

    parks_ = ways(spark, sf).where(tags.named_park())
    rings = way_rings(parks_, nodes(spark, sf)).withColumnRenamed("id", "polygon_id")
    return ring_edges(rings).groupBy("polygon_id").agg(F.count(F.lit(1)).alias("edges"))


@query(
    "fuel_explorer_split",
    f"""WITH {_CANDIDATES}, t AS (SELECT {token_sql('brand')} AS b, {token_sql('op')} AS o, {token_sql('name')} AS n FROM cand) SELECT coalesce({_FUEL_BRAND}, 'unmatched') AS match, count(*) AS n FROM t GROUP BY 1""",
)
def fuel_explorer_split(spark, sf):
    rows = fuel_plans.explorer_tables(fuel_plans.candidates(_fuel_nodes(spark, sf), _fuel_ways(spark, sf)), CATALOGUE)
    return rows.groupBy("match").agg(F.count(F.lit(1)).alias("n"))
