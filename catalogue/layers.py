"""Queries: remaining layer builders and small functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.common import (
    AMENITIES, SEGMENTS, SPOTS, amenities, boxes_sql, camp_key_sql, cell_overlap, component_walk, coords, coords_sql,
    foot_degrees, half, near, ordered_walk, pick, pick_sql, query, segments, slug_sql, spots, table,
)
from catalogue.curation import _PLAZA_ROWS, _PLAZAS
from catalogue.extraction import with_later_copies
from catalogue.geography import _CONF_SQL, _MODE_SQL
from catalogue.reports import scratch
from waymark import fixed_values as fv
from waymark.functions import geo, parks, tags, text
from waymark.plans import amenities as amenity_plans
from waymark.plans import camping as camping_plans
from waymark.plans import explorer
from waymark.plans import fuel as fuel_plans
from waymark.plans import parks as park_plans
from waymark.plans import units as unit_plans
from waymark.sources import readers, sinks

_SITES = ["Two Jack", "two jack", "Lake Backcountry", "Wilderness Loop", ""]


@query(
    "canadian_campgrounds",
    f"""WITH s AS (SELECT c_custkey AS id, {coords_sql('c_custkey', '200000')}, {pick_sql(_SITES, 'c_custkey')} AS raw, ['BNP-T-1', 'x9 y', ''][CAST(c_custkey // 5 % 3 AS INTEGER) + 1] AS u FROM customer),
    t AS (SELECT *, CASE WHEN raw = '' THEN 'Parks Canada campground' ELSE raw END AS name, CASE u WHEN 'BNP-T-1' THEN 'bnp' WHEN 'x9 y' THEN 'x9-y' ELSE 'unknown' END AS park_code FROM s)
    SELECT park_code, arg_min(name, id) AS name, count(*) AS site_count, {half('avg(lat)', 1000000000)} AS lat, CASE WHEN regexp_matches(arg_min(name, id), '(?i)backcountry|walk.?in|wilderness|random') THEN 'backcountry' ELSE 'developed' END AS camp_tier FROM t GROUP BY park_code, lower(name)""",
)
def canadian_campgrounds(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("seq"), *coords("c_custkey", "200000"), pick(_SITES, "c_custkey").alias("name"),
        F.lit("").alias("parent"), pick(["BNP-T-1", "x9 y", ""], "c_custkey div 5").alias("url_code"),
    )
    return amenity_plans.canadian_campgrounds(rows).select("park_code", "name", "site_count", geo.half_up("lat", 1e9).alias("lat"), "camp_tier")


@query(
    "access_enrichment",
    f"""WITH {AMENITIES}, {SEGMENTS}, cg AS (SELECT id, lat, lon, camp_tier, 'MT' AS state FROM amenities WHERE kind = 'campground'),
    r AS (SELECT p.id, min({foot_degrees()}) AS d FROM cg p JOIN segments s ON s.road_class < 2 AND {cell_overlap(0.02, 1)} GROUP BY p.id), t AS (SELECT p.id, min({foot_degrees()}) AS d FROM cg p JOIN segments s ON s.road_class = 2 AND {cell_overlap(0.05, 1)} GROUP BY p.id),
    x AS (SELECT c.id, coalesce({half('r.d', 1)}, 999999) AS road, coalesce(t.d, 999999) AS trail, c.camp_tier AS tier FROM cg c LEFT JOIN r ON r.id = c.id LEFT JOIN t ON t.id = c.id),
    y AS (SELECT id, {_MODE_SQL} AS access_mode, {_CONF_SQL} AS access_confidence FROM x)
    SELECT id, access_mode, access_confidence, CASE WHEN access_confidence = 'measured_far' THEN 1 ELSE 0 END AS far FROM y UNION ALL SELECT id, 'unknown', 'unknown', 0 FROM amenities WHERE kind <> 'campground'""",
)
def access_enrichment(spark, sf):
    s = segments(spark, sf).withColumn("state", F.lit("MT")).select("state", "lat1", "lon1", "lat2", "lon2", "road_class")
    rows = amenities(spark, sf).drop("access_mode").withColumn("state", F.lit("MT"))
    out = amenity_plans.with_access(rows, s.where("road_class < 2").drop("road_class"), s.where("road_class = 2").drop("road_class"))
    return out.select("id", "access_mode", "access_confidence", F.size("map_flags").alias("far"))


@query(
    "places_catalog",
    f"""WITH p AS (SELECT c_custkey // 2 AS place_id, c_custkey AS seq, {coords_sql('c_custkey')} FROM customer), f AS (SELECT place_id, min(seq) AS seq, arg_min(lat, seq) AS lat FROM p GROUP BY 1), pin AS (SELECT s_suppkey AS place_id, {coords_sql('s_suppkey')} FROM supplier)
    SELECT f.place_id, coalesce(pin.lat, f.lat) AS lat, CASE WHEN f.place_id % 2 = 0 THEN concat('place-', f.place_id) ELSE concat('lieu-', f.place_id) END AS park_code, CASE WHEN f.place_id % 2 = 0 THEN 'park' ELSE 'historic_site' END AS category FROM f LEFT JOIN pin USING (place_id)""",
)
def places_catalog(spark, sf):
    places = table(spark, sf, "customer").select(
        F.expr("c_custkey div 2").alias("place_id"), F.col("c_custkey").alias("seq"), *coords("c_custkey"),
        F.expr("if(c_custkey div 2 % 2 = 0, concat('Place ', c_custkey div 2, ' National Park of Canada'), concat('Lieu ', c_custkey div 2, ' National Historic Site'))").alias("name"),
        F.expr("if(c_custkey div 2 % 2 = 0, 'National Park', 'National Historic Site')").alias("place_type"),
    )
    pins = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("place_id"), *coords("s_suppkey"))
    return unit_plans.places_catalog(places, pins).select("place_id", "lat", "park_code", "category")


_SCOPE = ["National Park", "National Memorial", "Parkway", "National Seashore", "Wild River", "Trail"]


@query(
    "boundary_scope",
    f"WITH t AS (SELECT o_orderkey AS id, {pick_sql(_SCOPE, 'o_orderkey')} AS unit_type FROM orders) SELECT unit_type, count(*) AS n FROM t WHERE unit_type IN ('National Park', 'National Seashore', 'Wild River') GROUP BY 1",
)
def boundary_scope(spark, sf):
    rows = table(spark, sf, "orders").select(pick(_SCOPE, "o_orderkey").alias("unit_type"))
    rows = rows.withColumn("category", parks.boundary_category("unit_type"))
    return unit_plans.in_scope(rows).groupBy("unit_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "canadian_centers",
    f"""WITH c AS (SELECT c_custkey AS id, {coords_sql('c_custkey', '200000')}, c_custkey % 3 AS k FROM customer WHERE c_custkey % 4 > 0), {boxes_sql(fv.PROVINCE_BOXES)},
    st AS (SELECT c.id, min_by(b.code, b.seq) AS state FROM c JOIN boxes b ON c.lat BETWEEN b.south AND b.north AND c.lon BETWEEN b.west AND b.east GROUP BY c.id)
    SELECT c.id, coalesce(st.state, '') AS state, CASE k WHEN 0 THEN 'ash' ELSE NULL END AS parent, concat('NO_HOURS', CASE WHEN k > 0 THEN ',WEAK_PARENT' ELSE '' END, CASE WHEN st.state IS NULL THEN ',NO_STATE' ELSE '' END) AS flags FROM c LEFT JOIN st USING (id)""",
)
def canadian_centers(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), *coords("c_custkey", "200000"), F.expr("if(c_custkey % 4 > 0, 'Visitor Centre', 'Parking')").alias("facility_type"),
        F.lit("").alias("park_code"), F.expr("if(c_custkey % 3 = 0, 'https://parks.canada.ca/pn-np/ab/ash', '')").alias("url"), F.lit("").alias("name"),
    )
    units = table(spark, sf, "region").select(
        F.expr("if(r_regionkey = 0, 'ash', lower(r_name))").alias("code"),
        F.expr("if(r_regionkey = 0, 'Ash National Park', concat(r_name, ' National Park'))").alias("name"), F.lit("").alias("name_fr"),
        F.lit(80.0).alias("lat"), F.lit(-60.0).alias("lon"), F.col("r_regionkey").cast("bigint").alias("seq"),
    )
    out = unit_plans.canadian_center_records(rows, units)
    return out.select("id", "state", "parent", F.array_join("map_flags", ",").alias("flags"))


@query(
    "center_embed_ca",
    """SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN 'own' WHEN 1 THEN lower(n_name) ELSE '' END AS park_code, CASE WHEN c_custkey % 3 = 1 OR c_custkey % 6 = 0 THEN concat(n_name, ' National Park') ELSE '' END AS parent_name,
    c_custkey % 4 = 0 AS has_hours, CASE WHEN c_custkey % 2 = 0 THEN concat('https://d/', c_custkey) WHEN c_custkey % 5 = 0 THEN 'https://p' ELSE '' END AS url, c_custkey % 9 = 0 AS needs_review FROM customer JOIN nation ON n_nationkey = c_nationkey""",
)
def center_embed_ca(spark, sf):
    """Slim Canadian centre rows with their parents, written as an embed and read back."""
    nation = table(spark, sf, "nation")
    key = F.col("c_custkey")
    master = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        key.alias("id"), F.col("c_name").alias("name"), *coords("c_custkey"), F.lit("AB").alias("state"), F.when(key % 3 == 0, "own").otherwise("").alias("park_code"),
        F.when((key % 3 == 1) | (key % 6 == 0), F.lower("n_name")).alias("parent"), F.when(key % 4 == 0, True).alias("has_hours"), F.lit(None).cast("string").alias("hours_summary"),
        F.lit("").alias("season_note"), F.lit(None).cast("boolean").alias("seasonal"), F.when(key % 2 == 0, F.concat(F.lit("https://d/"), key)).alias("detail_url"),
        F.when(key % 5 == 0, "https://p").alias("park_url"), F.lit("official").alias("coord_confidence"), F.when(key % 9 == 0, True).alias("needs_review"),
    )
    listed = nation.select(
        F.col("n_name").alias("code"), F.concat("n_name", F.lit(" National Park")).alias("name"), F.lit("national_park").alias("category"),
        F.lit("National Park").alias("designation"), F.lit(1).alias("seq"),
    )
    units = listed.unionByName(listed.withColumn("name", F.lit("older")).withColumn("seq", F.lit(0)))
    path = scratch(spark)
    counts = {"with_hours": F.col("hours.has_hours"), "needs_review": F.col("needs_review")}
    sinks.write_embed(unit_plans.canadian_center_embed(master, units), ["*"], path, "pc_visitor_center", counts)
    back = spark.read.schema("id bigint, park_code string, parent_name string, hours struct<has_hours:boolean>, url string, needs_review boolean").json(f"{path}/records")
    return back.select("id", "park_code", "parent_name", "hours.has_hours", "url", "needs_review")


@query(
    "camp_records_ca",
    f"""WITH t AS (SELECT c_custkey AS id, {coords_sql('c_custkey', '200000')}, {pick_sql(['BC Parks', 'KOA', 'Parks Canada', ''], 'c_custkey')} AS op, {pick_sql(['Elk', '', 'Ash Resort'], 'c_custkey // 4')} AS nm, CASE WHEN c_custkey % 7 = 0 THEN 'backcountry' ELSE '' END AS site FROM customer), {boxes_sql(fv.PROVINCE_BOXES)},
    st AS (SELECT t.id, min_by(b.code, b.seq) AS state FROM t JOIN boxes b ON t.lat BETWEEN b.south AND b.north AND t.lon BETWEEN b.west AND b.east GROUP BY t.id), n AS (SELECT t.*, CASE WHEN nm = '' THEN concat('OSM node ', t.id) ELSE nm END AS name, coalesce(st.state, '') AS state FROM t LEFT JOIN st ON st.id = t.id)
    SELECT concat('CG-CA-OSM-', state, '-', {slug_sql('name')}, '-', id) AS id, op AS land_manager FROM (SELECT id, name, state, CASE op WHEN 'BC Parks' THEN 'Provincial' ELSE 'Parks Canada' END AS op FROM n WHERE op IN ('BC Parks', 'Parks Canada') AND site = '')""",
)
def camp_records_ca(spark, sf):
    points = table(spark, sf, "customer").select(
        F.lit("node").alias("osm_type"), F.col("c_custkey").alias("osm_id"), *coords("c_custkey", "200000"),
        F.create_map(
            F.lit("operator"), pick(["BC Parks", "KOA", "Parks Canada", ""], "c_custkey"), F.lit("name"), pick(["Elk", "", "Ash Resort"], "c_custkey div 4"),
            F.lit("tourism"), F.lit("camp_site"), F.lit("camp_site"), F.expr("if(c_custkey % 7 = 0, 'backcountry', '')"),
        ).alias("tags"),
    )
    return camping_plans.map_records_ca(with_later_copies(points)).select("id", "land_manager")


@query(
    "embed_ca",
    f"""WITH RECURSIVE t AS (SELECT c_custkey AS id, c_custkey AS seq, {coords_sql('(c_custkey // 5)', '(c_custkey % 5) * 20')}, {pick_sql(['Elk Camp', 'Elk', 'OSM way 3', 'Bow CG'], 'c_custkey')} AS name, {pick_sql(['Parks Canada', 'Provincial', 'Unknown'], 'c_custkey // 5')} AS land_manager, ['a', ''][CAST(c_custkey % 2 AS INTEGER) + 1] AS park FROM customer),
    e AS (SELECT *, {camp_key_sql('name')} AS k, CASE WHEN land_manager = 'Parks Canada' THEN park ELSE '' END AS pk FROM t WHERE land_manager <> 'Unknown' AND name <> 'OSM way 3'),
    ed AS (SELECT a.id AS a, b.id AS b FROM e a JOIN e b ON a.id < b.id AND a.k = b.k AND a.land_manager = b.land_manager AND (a.pk = b.pk OR a.pk = '' OR b.pk = '') AND {near('a', 'b', 0.35)}), {component_walk('ed', 'e')}
    SELECT c.component AS id, count(*) AS merged_rows, CASE WHEN count(*) = 1 THEN arg_min(name, seq) ELSE concat(arg_min(name, (-length(name), seq)), ' Campground') END AS name FROM e JOIN comp c ON c.id = e.id GROUP BY c.component""",
)
def embed_ca(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").alias("seq"), *coords("(c_custkey div 5)", "(c_custkey % 5) * 20"),
        pick(["Elk Camp", "Elk", "OSM way 3", "Bow CG"], "c_custkey").alias("name"), pick(["Parks Canada", "Provincial", "Unknown"], "c_custkey div 5").alias("land_manager"),
        pick(["a", ""], "c_custkey").alias("park"), F.lit(False).alias("dispersed"), F.lit(False).alias("commercial"), F.lit("03-provincial-seed").alias("ingest_source"),
        F.lit(1).cast("bigint").alias("pitch_count"),
    )
    return camping_plans.embed_ca(rows).select("id", "merged_rows", "name")


@query(
    "seed_records",
    f"WITH t AS (SELECT c_custkey AS id, {coords_sql('c_custkey', '200000')}, {pick_sql(['ab', 'TX', 'qc'], 'c_custkey')} AS region FROM customer) SELECT concat('CG-CA-SEED-seed-', id) AS id, upper(region) AS state FROM t WHERE region <> 'TX'",
)
def seed_records(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.concat(F.lit("Seed "), F.col("c_custkey")).alias("name"), *coords("c_custkey", "200000"), pick(["ab", "TX", "qc"], "c_custkey").alias("region")
    )
    return camping_plans.seed_records(rows).select("id", "state")


@query(
    "listings_from_units",
    """WITH t AS (SELECT c_nationkey AS admin, c_custkey AS seq, ['Blue Lake State Park', 'Blue Lake', 'Ash State Historic Site', 'Elm SP'][CAST(c_custkey % 4 AS INTEGER) + 1] AS raw FROM customer), k AS (SELECT *, ['blue lake', 'blue lake', 'ash', 'elm'][CAST(seq % 4 AS INTEGER) + 1] AS key, ['Blue Lake', 'Blue Lake', 'Ash', 'Elm SP'][CAST(seq % 4 AS INTEGER) + 1] AS name FROM t)
    SELECT admin, key, replace(key, ' ', '-') AS slug, min(name) AS name, count(*) AS unit_count, CASE WHEN key = 'ash' THEN 'historic_site' ELSE 'park' END AS category FROM k GROUP BY admin, key""",
)
def listings_from_units(spark, sf):
    units = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("admin"), F.col("c_custkey").alias("seq"),
        pick(["Blue Lake State Park", "Blue Lake", "Ash State Historic Site", "Elm SP"], "c_custkey").alias("name"),
        F.expr("if(c_custkey % 4 = 2, 'historic_site', 'park')").alias("category"), *coords("c_custkey"),
    )
    return park_plans.listings_from_units(units).select("admin", "key", "slug", "name", "unit_count", "category")


@query(
    "listing_records",
    f"""WITH u AS (SELECT c_custkey AS id, c_nationkey AS admin, {coords_sql('c_custkey')}, concat('l', c_custkey % 3) AS slug, CASE WHEN c_custkey % 2 = 0 THEN concat('c', c_custkey) ELSE '' END AS code FROM customer)
    SELECT admin, slug, count(*) AS unit_count, arg_min(code, id) AS official_code, {half('avg(lat)', 1000000000)} AS lat FROM u GROUP BY admin, slug""",
)
def listing_records(spark, sf):
    units = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").alias("seq"), F.col("c_nationkey").alias("admin"), F.col("c_name").alias("unit_name"),
        *coords("c_custkey"), F.expr("if(c_custkey % 2 = 0, concat('c', c_custkey), '')").alias("code"), F.col("c_name").alias("name"),
    )
    hits = units.select("id", F.expr("concat('l', id % 3)").alias("slug"))
    listings = table(spark, sf, "nation").select(F.col("n_nationkey").alias("admin"), F.explode(F.array(F.lit("l0"), F.lit("l1"), F.lit("l2"))).alias("slug"))
    out, _ = park_plans.listing_records(units, hits, listings.withColumn("name", F.col("slug")))
    return out.select("admin", "slug", "unit_count", "official_code", geo.half_up("lat", 1e9).alias("lat"))


@query(
    "standalone_listings",
    "SELECT s_suppkey AS slug FROM supplier WHERE s_suppkey % 4 <> 1 AND s_suppkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5)",
)
def standalone_listings(spark, sf):
    listings = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("slug"), F.lit("x").alias("admin"), F.expr("if(s_suppkey % 4 = 1, 'visitor_center', 'park')").alias("listing_kind")
    )
    parents = table(spark, sf, "customer").where("c_nationkey < 5").select(F.col("c_custkey").alias("slug"), F.lit("x").alias("admin"))
    return park_plans.standalone(listings, parents).select("slug")


@query(
    "small_functions",
    f"""WITH t AS (SELECT c_custkey AS id, {coords_sql('c_custkey')}, c_custkey % 3 AS k FROM customer) SELECT id, {half('250e0 / (111320e0 * cos(radians(lat)))', 1000000000)} AS pad_lon,
      ['TX', 'ON', ''][CAST(k AS INTEGER) + 1] AS store_state, ['Blue Lake', 'O''ak', 'X'][CAST(k AS INTEGER) + 1] AS title, ['park', 'marine', 'historic_site'][CAST(k AS INTEGER) + 1] AS category, ['primitive', 'backcountry', 'developed'][CAST(k AS INTEGER) + 1] AS tier,
      CASE k WHEN 0 THEN 1 ELSE 0 END AS center_tag, CASE k WHEN 1 THEN 1 ELSE 0 END AS park_tag FROM t""",
)
def small_functions(spark, sf):
    t = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), *coords("c_custkey"))
    t = t.withColumn("tags", F.create_map(F.lit("tourism"), F.expr("if(id % 3 = 0, 'information', '')"), F.lit("boundary"), F.expr("if(id % 3 = 1, 'protected_area', '')")))
    return t.select(
        "id", geo.half_up(geo.degrees_for_metres(250.0, "lat")[1], 1e9).alias("pad_lon"),
        text.state_from_store_url(pick(["https://x.com/us/tx/a", "https://x.com/ca/on/b", "https://x.com/fr/on/b"], "id")).alias("store_state"),
        text.title_case_key(pick(["blue lake", "o'ak", "x"], "id")).alias("title"),
        parks.boundary_category_ca(pick(["National Park Reserve", "National Marine Conservation Area", "National Historic Site"], "id")).alias("category"),
        parks.camp_tier_of_words(pick(["Primitive", "hike-in", "RV"], "id"), F.lit(""), F.lit("")).alias("tier"),
        tags.visitor_center_candidate().cast("int").alias("center_tag"), tags.park_candidate().cast("int").alias("park_tag"),
    )


@query(
    "geometry_points",
    f"""WITH t AS (SELECT c_custkey AS id, {coords_sql('c_custkey')}, c_custkey % 3 AS k FROM customer) SELECT id, {half('CASE k WHEN 0 THEN lat WHEN 1 THEN lat + 2 ELSE lat + 3 END', 100000)} AS lat, {half('CASE k WHEN 0 THEN lon ELSE lon END', 100000)} AS lon FROM t""",
)
def geometry_points(spark, sf):
    t = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), *coords("c_custkey"))

    def p(shift):
        return F.struct(F.col("lon").alias("lon"), (F.col("lat") + shift).alias("lat"))

    kind = pick(["Point", "Polygon", "LineString"], "id")
    lat, lon = geo.geometry_point(kind, p(0.0), F.array(p(0.0), p(2.0), p(4.0)), F.array(p(0.0), p(3.0)))
    return t.select("id", geo.half_up(lat, 1e5).alias("lat"), geo.half_up(lon, 1e5).alias("lon"))


@query(
    "official_attributes",
    "SELECT s_suppkey AS id, CASE s_suppkey % 3 WHEN 0 THEN s_name WHEN 1 THEN 'Lake Unit' ELSE 'http://z' END AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'https://x/y' ELSE 'http://z' END AS url FROM supplier",
)
def official_attributes(spark, sf):
    t = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.create_map(
            F.lit("A_UNIT"), F.expr("if(s_suppkey % 3 = 1, 'Lake Unit', 'ab')"), F.lit("WEBSITE"), F.lit("http://z"), F.lit("ZZ"), F.lit("long other")
        ).alias("a"),
        F.expr("if(s_suppkey % 3 = 0, s_name, '')").alias("n"), F.expr("if(s_suppkey % 2 = 0, 'https://x/y', 'none')").alias("u"),
    )
    return t.select("id", readers.official_name("a", "n").alias("name"), readers.official_url("a", "u").alias("url"))


@query(
    "fuel_layer_counts",
    "WITH t AS (SELECT CASE p_partkey % 4 WHEN 0 THEN 'pilot' WHEN 1 THEN 'flyingj' WHEN 2 THEN '' ELSE lower(p_type) END AS b FROM part) SELECT CASE WHEN b IN ('pilot', 'flyingj') THEN 'fuel_pilot_flyingj' WHEN b = '' THEN 'fuel_unknown' ELSE concat('fuel_', b) END AS layer, count(*) AS n FROM t GROUP BY 1",
)
def fuel_layer_counts(spark, sf):
    rows = table(spark, sf, "part").select(F.expr("case p_partkey % 4 when 0 then 'pilot' when 1 then 'flyingj' when 2 then '' else lower(p_type) end").alias("brand_id"))
    return explorer.fuel_layers(rows).groupBy("layer").agg(F.count(F.lit(1)).alias("n"))


@query(
    "highway_pair_records",
    f"""WITH RECURSIVE {_PLAZA_ROWS}, chain AS (SELECT *, ['onroute', 'onroute', 'other'][CAST(id // 4 % 3 AS INTEGER) + 1] AS brand_id FROM plazas),
    places AS (SELECT * FROM chain WHERE brand_id = 'onroute' AND place <> ''), {ordered_walk('places', 'a.place = b.place AND ' + near('a', 'b', 0.45))},
    led AS (SELECT c.*, coalesce(s.kept, c.id) AS lead FROM chain c LEFT JOIN suppressed s ON s.dropped = c.id WHERE brand_id = 'onroute'),
    g AS (SELECT lead, count(*) AS n, trim(regexp_replace(regexp_replace(arg_min(name, (length(name), seq)), '(?i)\\b(North|South|East|West)\\b', '', 'g'), '\\s+', ' ', 'g')) AS shown FROM led GROUP BY 1)
    SELECT CASE WHEN n > 1 THEN concat('FUEL-CA-ONROUTE-PAIR-', {slug_sql('shown')}) ELSE CAST(id AS VARCHAR) END AS id, CASE WHEN n > 1 AND shown <> '' THEN shown ELSE name END AS name, brand_id, n AS paired_count
    FROM chain JOIN g ON g.lead = chain.id UNION ALL SELECT CAST(id AS VARCHAR), name, brand_id, 1 FROM chain WHERE brand_id = 'other'""",
)
def highway_pair_records(spark, sf):
    """Merged plaza records with display name, new id and pair count, among other brands."""
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").alias("seq"), *coords("(c_custkey div 4)", "(c_custkey % 4) * 12"),
        pick(_PLAZAS, "c_custkey").alias("name"), pick(["onroute", "onroute", "other"], "c_custkey div 4").alias("brand_id"),
    )
    return fuel_plans.merge_highway_pairs(rows).select("id", "name", "brand_id", "paired_count")


@query(
    "center_states",
    f"""WITH {SPOTS}, c(seq, code, clat, clon) AS (VALUES {', '.join(f"({i}, '{k}', {a}e0, {b}e0)" for i, (k, a, b) in enumerate(fv.STATE_CENTRES))}), d AS (SELECT s.id, arg_min(c.code, (acos(sin(radians(s.lat)) * sin(radians(c.clat)) + cos(radians(s.lat)) * cos(radians(c.clat)) * cos(radians(c.clon - s.lon))), c.seq)) AS st FROM spots s, c GROUP BY s.id)
    SELECT s.id, CASE WHEN s.id % 3 = 0 THEN 'UT' WHEN s.id % 3 = 1 THEN 'AZ' ELSE d.st END AS state FROM spots s JOIN d USING (id)""",
)
def center_states(spark, sf):
    rows = spots(spark, sf).select("id", "lat", "lon")
    given = F.expr("if(id % 3 = 0, 'UT, CO', '')")
    of_park = F.expr("if(id % 3 = 1, 'AZ,NM', null)")
    return rows.select("id", unit_plans.visitor_center_state(given, of_park).alias("state"))
