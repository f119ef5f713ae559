"""Queries: layer builders of whole tables, from source rows to stored records."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.common import (
    AMENITIES, CAMPS, M, SQL, amenities, boxes_sql, component_walk, coords, coords_sql, half, near, ordered_walk, pick, pick_sql,
    query, slug_sql, table,
)
from catalogue.curation import _ACTIVE, _AMEN, _AMEN_EDGE, _SCORE, _UNITS_SQL, _units
from catalogue.geography import _BOX_PICK
from catalogue.labels import _CA_BRANDS, _CA_IN, _CA_NAMES, _CA_OUT, _FED, _GOOD, CA_CATALOGUE, DISPLAY_TIER, REASON, ROADS, camp_rows
from catalogue.reports import scratch
from waymark import fixed_values as fv
from waymark.functions import camping, parks
from waymark.plans import amenities as amenity_plans
from waymark.plans import camping as camping_plans
from waymark.plans import fuel as fuel_plans
from waymark.plans import pois
from waymark.plans import units as unit_plans
from waymark.sources import sinks
from waymark.streaming import refresh

_FEATURE_NAMES = ["Elk Flat", "Ash KOA", "Lake View", "Old Mill"]


@query(
    "feature_campgrounds",
    f"""WITH p AS (SELECT c_custkey AS k, {coords_sql('c_custkey')}, {pick_sql(_FEATURE_NAMES, 'c_custkey')} AS name FROM customer WHERE c_custkey % 11 > 0), {boxes_sql(fv.STATE_BOXES)},
    ok AS (SELECT * FROM p WHERE name <> 'Ash KOA'), hits AS (SELECT p.k, any_value(p.lon) AS lon, list(b.code ORDER BY b.seq) AS codes FROM ok p JOIN boxes b ON p.lat BETWEEN b.south AND b.north AND p.lon BETWEEN b.west AND b.east GROUP BY p.k)
    SELECT concat('CG-NPS-N', p.k, '-', {slug_sql('name')}) AS id, coalesce({_BOX_PICK.replace('lon >', 'h.lon >')}, '') AS state, 'NPS' AS land_manager, 'developed' AS type FROM ok p LEFT JOIN hits h ON h.k = p.k""",
)
def feature_campgrounds(spark, sf):
    """Campgrounds of flattened feature pages; rows off the map and commercial names go."""
    key = F.col("c_custkey")
    lat, lon = coords("c_custkey")
    features = table(spark, sf, "customer").select(
        F.concat(F.lit("n"), key).alias("code"), F.when(key % 11 > 0, lat).otherwise(0.0).alias("lat"), lon, pick(_FEATURE_NAMES, "c_custkey").alias("name")
    )
    return camping_plans.feature_records(features, "NPS", "01-nps-poi", "CG-NPS").select("id", "state", "land_manager", "type")


@query(
    "feature_centers",
    f"""WITH {_UNITS_SQL}, f AS (SELECT c_custkey AS k, lower(concat('n', c_custkey % 140)) AS code, {coords_sql('c_custkey')}, c_custkey % 4 AS s, ['Yes', 'No', ''][CAST(c_custkey % 3 AS INTEGER) + 1] AS flag, CASE WHEN c_custkey % 5 = 0 THEN 'May to June' ELSE '' END AS txt FROM customer WHERE c_custkey % 13 > 0),
    x AS (SELECT f.*, coalesce(a.primary_code, f.code) AS parent_code FROM f LEFT JOIN alias_ a ON a.code = f.code)
    SELECT concat('VC-NPS-', upper(x.parent_code), '-', CASE s WHEN 0 THEN 'visitor-center' ELSE concat('post-', s) END, '-', CAST(floor(lat * 1e4 + 0.5) AS BIGINT), '-', CAST(floor(abs(lon) * 1e4 + 0.5) AS BIGINT)) AS id, x.parent_code, coalesce(u.category, 'other') AS parent_category,
      CASE flag WHEN 'Yes' THEN TRUE WHEN 'No' THEN FALSE ELSE CASE WHEN txt <> '' THEN TRUE END END AS is_seasonal, CASE WHEN txt = '' AND flag = 'Yes' THEN 'Seasonal operation' WHEN txt = '' AND flag = 'No' THEN 'Year-round' ELSE txt END AS description
    FROM x LEFT JOIN units u ON u.code = x.parent_code""",
)
def feature_centers(spark, sf):
    """Visitor centres of feature pages with their parent units; rows without a code go."""
    key = F.col("c_custkey")
    features = table(spark, sf, "customer").select(
        F.when(key % 13 > 0, F.expr("concat('n', c_custkey % 140)")).otherwise("").alias("park_code"), *coords("c_custkey"),
        F.when(key % 4 == 0, "").otherwise(F.concat(F.lit("Post "), key % 4)).alias("name"),
        pick(["Yes", "No", ""], "c_custkey").alias("seasonal"), F.expr("if(c_custkey % 5 = 0, 'May to June', '')").alias("season_text"),
        F.lit("").alias("states"),
    )
    out = unit_plans.feature_center_records(features, _units(spark, sf))
    return out.select("id", "parent_code", "parent_category", "season.is_seasonal", "season.description")


_POI_SQL = f"""p AS (SELECT c_custkey AS id, {coords_sql('c_custkey', '200000')}, c_custkey % 3 AS k, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE concat('Elm ', c_custkey % 4) END AS name FROM customer), {boxes_sql(fv.PROVINCE_BOXES)},
    st AS (SELECT p.id, min_by(b.code, b.seq) AS state FROM p JOIN boxes b ON p.lat BETWEEN b.south AND b.north AND p.lon BETWEEN b.west AND b.east GROUP BY p.id),
    r AS (SELECT CASE k WHEN 0 THEN 'PG' ELSE 'SV' END AS prefix, p.id AS osm_id, CASE WHEN name <> '' THEN name WHEN k = 0 THEN 'Playground' ELSE 'Scenic viewpoint' END AS name, coalesce(state, '') AS state, CASE WHEN name = '' THEN 'qa' ELSE 'default' END AS tier, p.lat FROM p LEFT JOIN st ON st.id = p.id WHERE k < 2)"""


def _poi_points(spark, sf):
    """Playgrounds, viewpoints and plain nodes; a way table without rows."""
    key = F.col("c_custkey")
    nodes = table(spark, sf, "customer").select(
        key.alias("id"), *coords("c_custkey", "200000"),
        F.create_map(
            F.lit("leisure"), F.when(key % 3 == 0, "playground").otherwise(""), F.lit("tourism"), F.when(key % 3 == 1, "viewpoint").otherwise(""),
            F.lit("name"), F.when(key % 4 == 0, "").otherwise(F.concat(F.lit("Elm "), key % 4)),
        ).alias("tags"),
    )
    ways = table(spark, sf, "region").where("r_regionkey < 0").select(
        F.col("r_regionkey").cast("bigint").alias("id"), F.array(F.col("r_regionkey").cast("bigint")).alias("refs"), F.create_map(F.lit("x"), F.lit("y")).alias("tags")
    )
    return nodes, ways


@query(
    "poi_layers_ca",
    f"WITH {_POI_SQL} SELECT concat(prefix, '-CA-', coalesce(nullif(state, ''), 'XX'), '-', {slug_sql('name')}, '-', osm_id) AS id, name, tier AS display_tier FROM r",
)
def poi_layers_ca(spark, sf):
    """Playground and viewpoint layers by province."""
    nodes, ways = _poi_points(spark, sf)
    both = pois.layer(nodes, ways, None, "playground", "CA").unionByName(pois.layer(nodes, ways, None, "viewpoint", "CA"))
    return both.select("id", "name", "display_tier")


@query(
    "poi_embed",
    f"WITH {_POI_SQL} SELECT state, count(*) AS n, {half('sum(lat)', 100)} AS lat, count(DISTINCT concat('https://www.openstreetmap.org/node/', osm_id)) AS urls FROM r WHERE prefix = 'SV' GROUP BY 1",
)
def poi_embed(spark, sf):
    """Slim viewpoint rows, written as an embed and read back."""
    nodes, ways = _poi_points(spark, sf)
    path = scratch(spark)
    sinks.write_embed(pois.embed(pois.layer(nodes, ways, None, "viewpoint", "CA")), ["*"], path, "viewpoint")
    back = spark.read.schema("id string, name string, lat double, lon double, state string, url string").json(f"{path}/records")
    return back.groupBy(F.coalesce("state", F.lit("")).alias("state")).agg(
        F.count(F.lit(1)).alias("n"), F.expr("floor(sum(lat) * 100 + 0.5) / 100").alias("lat"), F.count_distinct("url").alias("urls")
    )


_LAYERED = _AMEN.replace("SELECT *,", "SELECT * REPLACE ((id % 3) * 10000000000 + id AS seq),")


@query(
    "amenity_layers_merge",
    f"""WITH RECURSIVE {AMENITIES}, {_LAYERED}, {ordered_walk('am', _AMEN_EDGE)}
    SELECT a.id % 3 AS layer, a.kind, count(*) AS n, count(s.dropped) AS dropped FROM am a LEFT JOIN suppressed s ON s.dropped = a.id GROUP BY 1, 2""",
)
def amenity_layers_merge(spark, sf):
    """Three layers by priority: what each keeps and loses by kind."""
    rows = amenities(spark, sf).withColumn("layer", F.expr("id % 3")).withColumn("seq", F.expr("layer * 10000000000 + id"))
    layers = [rows.where(f"layer = {i}") for i in range(3)]
    kept, lost = amenity_plans.merge([layers[0].drop("site_no"), *layers[1:]])
    gone = lost.select(F.col("dropped").alias("id")).join(rows.select("id", "layer", "kind"), "id")
    return (
        kept.select("layer", "kind", F.lit(0).alias("gone"))
        .unionByName(gone.select("layer", "kind", F.lit(1).alias("gone")))
        .groupBy("layer", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum("gone").cast("bigint").alias("dropped"))
    )


@query(
    "amenity_embed",
    f"""WITH {AMENITIES} SELECT id, {half('lat', 100000)} AS lat, {half('lon', 100000)} AS lon, concat_ws('/', kind, nullif(CASE WHEN kind = 'campground' THEN camp_tier ELSE '' END, '')) AS layer FROM amenities""",
)
def amenity_embed(spark, sf):
    """Slim amenity rows, written as an embed and read back."""
    rows = amenities(spark, sf).withColumn("camp_tier", F.when(F.col("kind") == "campground", F.col("camp_tier"))).withColumn("park_code", F.col("parent"))
    path = scratch(spark)
    sinks.write_embed(amenity_plans.embed(rows), ["*"], path, "amenity")
    return spark.read.schema("id bigint, lat double, lon double, layer string").json(f"{path}/records")


_TIER_SQL = f"""WITH RECURSIVE {CAMPS}, {ROADS}, {_ACTIVE}, ed AS (SELECT a.id AS a, b.id AS b FROM act a JOIN act b ON a.id < b.id AND {near('a', 'b', 300.0, M)}), {component_walk('ed', 'act')},
    r AS (SELECT p.*, c.component, {_SCORE} AS score FROM act p JOIN comp c ON c.id = p.id),
    g AS (SELECT component, count(*) AS n, max(CASE WHEN {_FED} OR {_GOOD} THEN 1 ELSE 0 END) AS anchor, arg_min(id, (-score, seq)) AS keep FROM r GROUP BY component),
    gone AS (SELECT r.id FROM r JOIN g USING (component) WHERE g.n >= 3 AND g.anchor = 1 AND g.keep <> r.id),
    t AS (SELECT id, {DISPLAY_TIER} AS tier, {REASON} AS reason FROM rows_)
    SELECT t.id, CASE WHEN gone.id IS NULL THEN tier ELSE 'excluded' END AS display_tier, CASE WHEN gone.id IS NULL THEN reason ELSE 'cluster-duplicate' END AS exclude_reason FROM t LEFT JOIN gone ON gone.id = t.id"""


@query("camp_tiers", _TIER_SQL)
def camp_tiers(spark, sf):
    """Micro-clusters and display tiers of all campgrounds in one pass over the master."""
    out = camping_plans.with_tiers(camp_rows(spark, sf), camping.FilterConfig(cluster_radius_m=300.0))
    return out.select("id", "display_tier", "exclude_reason")


@query(
    "branded_fuel_ca",
    f"""WITH m AS ({SQL['brand_match_ca']}) SELECT id AS osm_id, brand_id, 'travel_plaza' AS type, {pick_sql(_CA_NAMES, 'id // 7')} AS name FROM m WHERE brand_id IS NOT NULL""",
)
def branded_fuel_ca(spark, sf):
    """Canadian candidates and their brands, from nodes to fuel records."""
    key = F.col("p_partkey")
    nodes = table(spark, sf, "part").select(
        key.alias("id"), *coords("p_partkey", "200000"),
        F.create_map(
            F.lit("amenity"), F.lit("fuel"), F.lit("name"), pick(_CA_NAMES, "p_partkey div 7"), F.lit("brand"), pick(_CA_BRANDS, "p_partkey")
        ).alias("tags"),
    )
    _, ways = _poi_points(spark, sf)
    found = fuel_plans.candidates(nodes, ways, fv.CA_BOX)
    return fuel_plans.branded(found, CA_CATALOGUE, "CA").select("osm_id", "brand_id", "type", "name")


_UNIT_NAMES = ["Moss Provincial Park", "Site historique provincial Ash", "Elk Provincial Heritage Park", "Bay National Park", "Oak Provincial Historic Site", "Plain Wood", "Old Provincial Historic Park"]
_UNIT_OPERATORS = ["", "Heritage Trust", "Parks Canada", "Lake Provincial Park Authority"]


@query(
    "provincial_park_classify",
    f"""WITH t AS (SELECT c_custkey AS id, {pick_sql(_UNIT_NAMES, 'c_custkey')} AS name, {pick_sql(_UNIT_OPERATORS, 'c_custkey // 7')} AS op FROM customer), b AS (SELECT *, concat(op, ' ', name) AS words FROM t),
    u AS (SELECT * FROM b WHERE op <> 'Parks Canada' AND NOT ({_CA_OUT} AND NOT regexp_matches(name, '(?i)historic|heritage|historique')) AND ({_CA_IN} OR {_CA_IN.replace('(name,', '(words,')}))
    SELECT id, CASE WHEN regexp_matches(words, '(?i)historic|heritage|historique') THEN 'historic_site' ELSE 'park' END AS category, CASE WHEN regexp_matches(name, '(?i)site historique provincial') THEN 'Site historique provincial' WHEN regexp_matches(name, '(?i)provincial heritage park') THEN 'Provincial Heritage Park'
      WHEN regexp_matches(name, '(?i)provincial historic park') THEN 'Provincial Historic Park' WHEN regexp_matches(words, '(?i)historic|heritage|historique') THEN 'Provincial Historic Site' ELSE 'Provincial Park' END AS designation FROM u""",
)
def provincial_park_classify(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.create_map(F.lit("name"), pick(_UNIT_NAMES, "c_custkey"), F.lit("operator"), pick(_UNIT_OPERATORS, "c_custkey div 7")).alias("tags"),
    )
    return rows.withColumn("c", parks.classify_unit("CA")).where("c is not null").select("id", "c.category", "c.designation")


@query(
    "extract_reuse",
    """WITH n AS (SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1), f AS (SELECT o_orderstatus AS status, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1)
    SELECT 'built' AS step, status, n FROM n UNION ALL SELECT 'reused', status, n FROM n UNION ALL SELECT 'rebuilt', n.status, n.n + coalesce(f.n, 0) FROM n LEFT JOIN f ON f.status = n.status""",
)
def extract_reuse(spark, sf):
    """An extract is built, reused while its source is unchanged, and built again once a file has come."""
    base = scratch(spark)
    source, target = f"{base}/source", f"{base}/extract"
    orders = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("status"), "o_custkey")
    orders.write.parquet(source)
    steps = []
    for step in ("built", "reused", "rebuilt"):
        if step == "rebuilt":
            known = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
            orders.join(known, "o_custkey", "left_semi").select("status", "o_custkey").write.mode("append").parquet(source)

        def build(step=step):
            return spark.read.parquet(source).groupBy("status").agg(F.count(F.lit(1)).alias("n")).withColumn("built_in", F.lit(step))

        extract = refresh.reuse_or_build(spark, source, target, build)
        extract.withColumn("step", F.lit(step)).write.parquet(f"{base}/steps/{step}")
        steps.append(spark.read.parquet(f"{base}/steps/{step}"))
    out = steps[0].unionByName(steps[1]).unionByName(steps[2])
    # a reused extract is the one that the first step built
    return out.where(F.col("built_in") == F.when(F.col("step") == "rebuilt", "rebuilt").otherwise("built")).select("step", "status", "n")
