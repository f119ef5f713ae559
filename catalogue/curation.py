"""Queries: dedupe, matching, merging, clustering, parents, unit catalogues."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.common import (
    AMENITIES, CAMPS, KM, M, MI, SPOTS, STATIONS, amenities, boxes_sql, camp_key_sql, camps, component_walk, coords, coords_sql, half, hav,
    near, ordered_walk, pick, pick_sql, query, spots, stations, table,
)
from catalogue.labels import _FED, _GENERIC, _GOOD, _KNOWN, _NUMERIC, _SITE, camp_rows
from waymark import fixed_values as fv
from waymark.functions import camping, geo, parks
from waymark.functions.text import listing_key, plaza_key
from waymark.operators import clusters, components, dedupe, matching, parkmerge
from waymark.operators.ranking import best_per_key, rank_in_groups
from waymark.operators.rollup import count_by
from waymark.plans import amenities as amenity_plans
from waymark.plans import camping as camping_plans
from waymark.plans import fuel as fuel_plans
from waymark.plans import parks as park_plans
from waymark.plans import units as unit_plans

# ---- pairs of stations close together: two rows per base point --------------------------------------

_TWIN = (
    "twin AS (SELECT p_partkey AS id, p_partkey AS seq, "
    + coords_sql("(p_partkey // 2)", "(p_partkey % 2) * 9")
    + ", ['MEDIUM', 'MEDIUM', 'LARGE'][CAST(p_partkey // 6 % 3 AS INTEGER) + 1] AS brand_id, p_name AS name, p_size AS size FROM part)"
)


def _twin(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_partkey").alias("seq"), *coords("(p_partkey div 2)", "(p_partkey % 2) * 9"),
        pick(["MEDIUM", "MEDIUM", "LARGE"], "p_partkey div 6").alias("brand_id"), F.col("p_name").alias("name"), F.col("p_size").alias("size"),
    )


_SAME_BRAND = f"a.brand_id = b.brand_id AND {near('a', 'b', 0.12)}"


@query("ordered_dedupe", f"WITH RECURSIVE {_TWIN}, {ordered_walk('twin', _SAME_BRAND)} SELECT kept, dropped FROM suppressed")
def ordered_dedupe(spark, sf):
    return dedupe.ordered_dedupe(_twin(spark, sf), 0.12, "mi", on=["brand_id"])[1].select("kept", "dropped")


_INLAND = _TWIN.replace("twin AS", "inland AS").replace("(p_partkey % 2) * 9)", "(p_partkey % 2) * 9 + 60000)")


@query(
    "distinct_poi_per_region",
    f"""WITH RECURSIVE {_INLAND}, {ordered_walk('inland', _SAME_BRAND)}, kept AS (SELECT * FROM inland WHERE id NOT IN (SELECT dropped FROM suppressed)), {boxes_sql(fv.STATE_BOXES)}
    SELECT coalesce((SELECT min_by(b.code, b.seq) FROM boxes b WHERE kept.lat BETWEEN b.south AND b.north AND kept.lon BETWEEN b.west AND b.east), '?') AS region, brand_id, count(*) AS n
    FROM kept GROUP BY ALL""",
)
def distinct_poi_per_region(spark, sf):
    """Flagship: valid points, ordered same-brand dedupe, region from coordinates, counts."""
    from waymark.operators.spatial import box_code

    inland = _twin(spark, sf).drop("lat", "lon").select("*", *coords("(id div 2)", "(id % 2) * 9 + 60000"))
    points = inland.where(geo.valid_coordinate("lat", "lon", fv.US_BOX))
    kept, _ = dedupe.ordered_dedupe(points, fv.DEDUPE_MI, "mi", on=["brand_id"])
    region = F.coalesce(box_code("lat", "lon", fv.STATE_BOXES, fv.STATE_OVERLAPS), F.lit("?"))
    return kept.groupBy(region.alias("region"), "brand_id").agg(F.count(F.lit(1)).alias("n"))


@query("supplement_dedupe", f"WITH RECURSIVE {_TWIN}, {ordered_walk('twin', near('a', 'b', 0.12))} SELECT kept, dropped FROM suppressed")
def supplement_dedupe(spark, sf):
    return dedupe.ordered_dedupe(_twin(spark, sf), fv.DEDUPE_MI, "mi")[1].select("kept", "dropped")


@query(
    "supplement_merge",
    f"""WITH RECURSIVE {_TWIN}, master AS (SELECT * FROM twin WHERE size % 3 > 0), extra AS (SELECT * FROM twin WHERE size % 3 = 0),
    absorbed AS (SELECT a.id AS dropped, min_by(b.id, b.seq) AS kept FROM extra a JOIN master b ON {_SAME_BRAND} GROUP BY a.id),
    free AS (SELECT * FROM extra WHERE id NOT IN (SELECT dropped FROM absorbed)), {ordered_walk('free', _SAME_BRAND)}
    SELECT kept, dropped FROM absorbed UNION ALL SELECT kept, dropped FROM suppressed""",
)
def supplement_merge(spark, sf):
    rows = _twin(spark, sf)
    return dedupe.supplement_merge(rows.where("size % 3 > 0"), rows.where("size % 3 = 0"), fv.DEDUPE_MI)[1].select("kept", "dropped")


@query(
    "drop_superseded",
    f"""WITH {_TWIN} SELECT id FROM twin t WHERE NOT (size % 4 = 0 AND EXISTS (SELECT 1 FROM twin b, (SELECT t.id, t.lat, t.lon, t.brand_id) a WHERE b.id <> a.id AND {_SAME_BRAND}))""",
)
def drop_superseded(spark, sf):
    return dedupe.drop_superseded(_twin(spark, sf), F.col("size") % 4 == 0, fv.DEDUPE_MI).select("id")


_FAMILY = ["pilot", "pilot", "flyingj", "loves", "flyingj", "pilot_flyingj", "pilot"]


@query("cobrand_dedupe")
def cobrand_dedupe(spark, sf):
    """Same-brand and sister-brand dedupe of all stations (order-dependent brand rewriting)."""
    rows = table(spark, sf, "part").select(
        F.format_string("p%010d", "p_partkey").alias("id"), F.col("p_partkey").alias("seq"),
        *coords("(p_partkey div 3)", "(p_partkey % 3) * 8"), pick(_FAMILY, "p_partkey").alias("brand_id"),
    )
    kept, lost = fuel_plans.dedupe_brands(rows)
    a = kept.groupBy("brand_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit("kept").alias("part"), F.col("brand_id").alias("value"), "n")
    b = lost.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).select(F.lit("suppressed").alias("part"), F.col("reason").alias("value"), "n")
    return a.unionByName(b)


_PLAZAS = ["ONroute Ash North", "ONroute Ash South", "ONroute Elm", "On Route Elm East", "ONroute"]
_PLAZA_ROWS = (
    "plz AS (SELECT c_custkey AS id, c_custkey AS seq, " + coords_sql("(c_custkey // 4)", "(c_custkey % 4) * 12")
    + ", " + pick_sql(_PLAZAS, "c_custkey") + " AS name FROM customer), plazas AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(name), '\\bon\\s*route\\b', '', 'g'), "
    "'\\b(north|south|east|west|northeast|northwest|southeast|southwest)\\b', '', 'g'), '[^a-z0-9]', '', 'g') AS place FROM plz), named AS (SELECT * FROM plazas WHERE place <> '')"
)


@query(
    "highway_pair_merge",
    f"""WITH RECURSIVE {_PLAZA_ROWS}, {ordered_walk('named', 'a.place = b.place AND ' + near('a', 'b', 0.45))},
    led AS (SELECT p.id, coalesce(s.kept, p.id) AS lead, p.lat, p.lon FROM plazas p LEFT JOIN suppressed s ON s.dropped = p.id)
    SELECT lead, count(*) AS paired_count, {half('avg(lat)', 1000000000)} AS lat, {half('avg(lon)', 1000000000)} AS lon FROM led GROUP BY lead""",
)
def highway_pair_merge(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").alias("seq"), *coords("(c_custkey div 4)", "(c_custkey % 4) * 12"),
        pick(_PLAZAS, "c_custkey").alias("name"),
    )
    led = dedupe.pair_merge(rows, fv.HIGHWAY_PAIR_MI, "mi", plaza_key("name"))
    return led.groupBy("lead").agg(
        F.count(F.lit(1)).alias("paired_count"), geo.half_up(F.avg("lat"), 1e9).alias("lat"), geo.half_up(F.avg("lon"), 1e9).alias("lon")
    )


_KEYED = f"camps_k AS (SELECT *, {camp_key_sql('name')} AS k FROM camps)"
_SIMILAR = "(a.k <> '' AND b.k <> '' AND (contains(a.k, b.k) OR contains(b.k, a.k)))"
_CAMP_EDGE = f"{near('a', 'b', 0.12)} AND ({_SIMILAR} OR (a.land_manager = b.land_manager AND {near('a', 'b', 0.05)}))"


@query("priority_merge", f"WITH RECURSIVE {CAMPS}, {_KEYED}, {ordered_walk('camps_k', _CAMP_EDGE)} SELECT kept, dropped FROM suppressed")
def priority_merge(spark, sf):
    return camping_plans.merge_sources_us(camps(spark, sf))[1].select("kept", "dropped")


@query(
    "osm_supplement_ids",
    f"""WITH RECURSIVE {CAMPS}, {_KEYED}, {ordered_walk('camps_k', _CAMP_EDGE)} SELECT s.kept, s.dropped AS supplement FROM suppressed s JOIN camps k ON k.id = s.kept JOIN camps d ON d.id = s.dropped WHERE d.ingest_source = '03-osm' AND k.ingest_source <> '03-osm'""",
)
def osm_supplement_ids(spark, sf):
    rows = camps(spark, sf)
    return camping_plans.map_supplements(rows, camping_plans.merge_sources_us(rows)[1])


_CA_CAMPS = "ca AS (SELECT id, seq, lat, lon, k, land_manager, ['01-parks-canada', '03-provincial-seed', '02-osm'][CAST(id % 3 AS INTEGER) + 1] AS src, id % 3 AS layer FROM camps_k)"
_CA_SQL = f"""WITH {CAMPS}, {_KEYED}, {_CA_CAMPS},
    l1 AS (SELECT a.id AS dropped, min_by(b.id, b.seq2) AS kept FROM (SELECT * FROM ca WHERE layer = 1) a JOIN (SELECT *, id AS seq2 FROM ca WHERE layer = 0) b ON {_CAMP_EDGE} GROUP BY a.id),
    base AS (SELECT *, layer * 10000000000 + id AS seq2 FROM ca WHERE layer = 0 OR (layer = 1 AND id NOT IN (SELECT dropped FROM l1))),
    l2 AS (SELECT a.id AS dropped, min_by(b.id, b.seq2) AS kept FROM (SELECT * FROM ca WHERE layer = 2) a JOIN base b ON {_CAMP_EDGE} GROUP BY a.id)
    SELECT kept, dropped FROM l1 UNION ALL SELECT kept, dropped FROM l2"""


@query("cross_source_merge", _CA_SQL)
def cross_source_merge(spark, sf):
    rows = camps(spark, sf).withColumn("ingest_source", pick(fv.CAMPING_SOURCES_CA, "id")).withColumn(
        "seq", F.expr("(id % 3) * 10000000000 + id")
    )
    return camping_plans.merge_sources_ca(rows)[1].select("kept", "dropped")


_AMEN = """am AS (SELECT *, trim(regexp_replace(regexp_replace(lower(name), '\\b(campground|camp|campsite|camping area|picnic area|restroom|toilet)\\b', '', 'g'), '[^a-z0-9]+', ' ', 'g')) AS k,
      CASE WHEN kind = 'campground' THEN camp_tier ELSE '' END AS tier FROM amenities)"""
_AMEN_EDGE = f"""a.parent = b.parent AND a.kind = b.kind AND a.tier = b.tier AND (a.object_id IS NULL OR b.object_id IS NULL OR a.object_id = b.object_id) AND {near('a', 'b', 80.0, M)}
    AND ({_SIMILAR} OR (a.kind <> 'campground' AND a.subtype = b.subtype AND {near('a', 'b', 25.0, M)}))"""


@query("amenity_dedupe", f"WITH RECURSIVE {AMENITIES}, {_AMEN}, {ordered_walk('am', _AMEN_EDGE)} SELECT kept, dropped FROM suppressed")
def amenity_dedupe(spark, sf):
    return amenity_plans.dedupe_amenities(amenities(spark, sf))[1].select("kept", "dropped")


# ---- J12, R13, U7 -----------------------------------------------------------------------------------

_MATCH_INPUT = f"""{SPOTS}, {STATIONS}, s AS (SELECT id AS store_id, lat, lon, size % 5 AS lane FROM stations),
    pairs AS MATERIALIZED (SELECT p.id AS l, s.store_id AS r, {hav('p.lat', 'p.lon', 's.lat', 's.lon', MI)} AS d FROM spots p JOIN s ON p.lane = s.lane AND {near('p', 's', 0.5)}),
    ranked AS (SELECT *, row_number() OVER (ORDER BY d, l, r) AS rn FROM pairs),
    walk(rn, ls, rs) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST([] AS BIGINT[]) UNION ALL
      SELECT w.rn + 1, CASE WHEN list_contains(w.ls, k.l) OR list_contains(w.rs, k.r) THEN w.ls ELSE list_append(w.ls, k.l) END,
        CASE WHEN list_contains(w.ls, k.l) OR list_contains(w.rs, k.r) THEN w.rs ELSE list_append(w.rs, k.r) END FROM walk w JOIN ranked k ON k.rn = w.rn + 1),
    fin AS MATERIALIZED (SELECT ls, rs FROM walk ORDER BY rn DESC LIMIT 1), taken AS MATERIALIZED (SELECT unnest(ls) AS l, unnest(rs) AS r FROM fin)"""


def _match_input(spark, sf):
    s = stations(spark, sf).select(F.col("id").alias("store_id"), "lat", "lon", F.expr("cast(size % 5 as bigint)").alias("lane"))
    return spots(spark, sf), s


@query(
    "greedy_match",
    f"WITH RECURSIVE {_MATCH_INPUT} SELECT t.l AS left_key, t.r AS right_key, {half('p.d', 1000)} AS mi FROM taken t JOIN pairs p ON p.l = t.l AND p.r = t.r",
)
def greedy_match(spark, sf):
    left, right = _match_input(spark, sf)
    m = matching.greedy_match(left, right, 0.5, "mi", ["lane"], "id", "store_id")
    return m.select("left_key", "right_key", geo.half_up("distance", 1000).alias("mi"))


@query(
    "match_sides",
    f"""WITH RECURSIVE {_MATCH_INPUT} SELECT 'left' AS side, p.lane, count(*) AS n FROM spots p WHERE p.id NOT IN (SELECT l FROM taken) GROUP BY ALL
    UNION ALL SELECT 'right', s.lane, count(*) FROM s WHERE s.store_id NOT IN (SELECT r FROM taken) GROUP BY ALL""",
)
def match_sides(spark, sf):
    left, right = _match_input(spark, sf)
    m = matching.greedy_match(left, right, 0.5, "mi", ["lane"], "id", "store_id")
    a, b = matching.split_by_match(left, right, m, "id", "store_id")
    return (
        a.select(F.lit("left").alias("side"), "lane").unionByName(b.select(F.lit("right").alias("side"), "lane"))
        .groupBy("side", "lane").agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "reconcile_report",
    f"""WITH RECURSIVE {_MATCH_INPUT}, free AS (SELECT store_id AS id, store_id AS seq, lat, lon, lane FROM s WHERE store_id NOT IN (SELECT r FROM taken)),
    {ordered_walk('free', 'a.lane = b.lane AND ' + near('a', 'b', 0.12)).replace('walk(rn, gone)', 'walk2(rn, gone)').replace('FROM walk w', 'FROM walk2 w').replace('FROM walk ORDER', 'FROM walk2 ORDER')}
    SELECT l.lane, (SELECT count(*) FROM s WHERE s.lane = l.lane) AS official_count, (SELECT count(*) FROM spots p WHERE p.lane = l.lane) AS map_count,
      (SELECT count(*) FROM taken t JOIN spots p ON p.id = t.l WHERE p.lane = l.lane) AS matched_count,
      (SELECT count(*) FROM spots p WHERE p.lane = l.lane AND p.id NOT IN (SELECT l FROM taken)) AS rejected_count,
      (SELECT count(*) FROM free f WHERE f.lane = l.lane AND f.id NOT IN (SELECT dropped FROM suppressed)) AS supplement_count
    FROM (SELECT DISTINCT lane FROM s) l""",
)
def reconcile_report(spark, sf):
    left, right = _match_input(spark, sf)
    parts = fuel_plans.reconcile(left, right, 0.5, ["lane"])
    return fuel_plans.reconcile_report(left, right, parts, "lane")


@query(
    "reconcile_rejects",
    f"""WITH RECURSIVE {_MATCH_INPUT}, rej AS (SELECT * FROM spots WHERE id NOT IN (SELECT l FROM taken)),
    d AS (SELECT p.id, s.store_id, {hav('p.lat', 'p.lon', 's.lat', 's.lon', MI)} AS d FROM rej p JOIN s ON s.lane = p.lane)
    SELECT id, arg_min(store_id, (d, store_id)) AS nearest_store, {half('min(d)', 1000)} AS nearest_mi FROM d GROUP BY id""",
)
def reconcile_rejects(spark, sf):
    left, right = _match_input(spark, sf)
    return fuel_plans.reconcile(left, right, 0.5, ["lane"])["rejects"].select("id", "nearest_store", "nearest_mi")


_APPLY = f"""{_TWIN}, master AS (SELECT * FROM twin WHERE size % 3 > 0 AND id % 10 <> 0), extra AS (SELECT * FROM twin WHERE size % 3 = 0),
    free AS (SELECT * FROM extra e WHERE NOT EXISTS (SELECT 1 FROM master m WHERE m.brand_id = e.brand_id AND abs(m.lat - e.lat) < 0.001 AND abs(m.lon - e.lon) < 0.001)),
    {ordered_walk('free', 'a.brand_id = b.brand_id AND abs(a.lat - b.lat) < 0.001 AND abs(a.lon - b.lon) < 0.001')}"""


@query(
    "apply_reconcile",
    f"""WITH RECURSIVE {_APPLY} SELECT id, CASE WHEN id % 4 = 1 THEN 'osm,official-verified' ELSE 'osm' END AS sources FROM master
    UNION ALL SELECT id, 'supplement' FROM free WHERE id NOT IN (SELECT dropped FROM suppressed)""",
)
def apply_reconcile(spark, sf):
    rows = _twin(spark, sf)
    master = rows.where("size % 3 > 0").withColumn("sources", F.array(F.lit("osm")))
    extra = rows.where("size % 3 = 0").withColumn("sources", F.array(F.lit("supplement")))
    rejects = rows.where("id % 10 = 0").select("id")
    matched = rows.where("id % 4 = 1 and id % 10 <> 0").select(F.col("id").alias("left_key"))
    out = fuel_plans.apply_reconcile(master, rejects, matched, extra)
    return out.select("id", F.array_join("sources", ",").alias("sources"))


@query(
    "reject_list",
    "SELECT CASE WHEN l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 8) THEN 'rejected' ELSE 'kept' END AS part, count(*) AS n FROM lineitem GROUP BY 1",
)
def reject_list(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("osm_key"))
    rejects = table(spark, sf, "supplier").where("s_nationkey < 8").select(F.col("s_suppkey").alias("osm_key"))
    kept, rejected = fuel_plans.reject_listed(rows, rejects)
    return (
        kept.select(F.lit("kept").alias("part")).unionByName(rejected.select(F.lit("rejected").alias("part")))
        .groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    )


# ---- R14 - R17 --------------------------------------------------------------------------------------

_ACTIVE = f"act AS (SELECT * FROM camps WHERE type <> 'dispersed' AND NOT {_GENERIC})"
_SCORE = f"""CASE WHEN {_FED} THEN 1000 ELSE 0 END + CASE WHEN {_GOOD} THEN 200 WHEN NOT {_GENERIC} AND NOT {_NUMERIC} THEN 50 ELSE 0 END + 40
      + CASE WHEN {_GOOD} THEN 10 ELSE 0 END + CASE WHEN {_KNOWN} THEN 25 ELSE 0 END - CASE WHEN {_SITE} THEN 30 ELSE 0 END"""


@query(
    "micro_clusters",
    f"""WITH RECURSIVE {CAMPS}, {_ACTIVE}, ed AS (SELECT a.id AS a, b.id AS b FROM act a JOIN act b ON a.id < b.id AND {near('a', 'b', 300.0, M)}), {component_walk('ed', 'act')},
    r AS (SELECT p.*, c.component, {_SCORE} AS score FROM act p JOIN comp c ON c.id = p.id),
    g AS (SELECT component, count(*) AS n, max(CASE WHEN {_FED} OR {_GOOD} THEN 1 ELSE 0 END) AS anchor, arg_min(id, (-score, seq)) AS keep FROM r GROUP BY component)
    SELECT r.id, CASE WHEN g.n >= 3 AND g.anchor = 1 THEN r.component END AS cluster_id, CASE WHEN g.n >= 3 AND g.anchor = 1 THEN CASE WHEN g.keep = r.id THEN 'keep' ELSE 'dropped' END END AS cluster_role FROM r JOIN g USING (component)""",
)
def micro_clusters(spark, sf):
    rows = camp_rows(spark, sf)
    active = rows.where(camping.hard_exclude_reason().isNull())
    out = clusters.micro_clusters(active, 300.0, 3, camping.federal_source() | camping.human_name("name"), camping.keep_score())
    return out.select("id", "cluster_id", "cluster_role")


@query(
    "proximity_components",
    f"""WITH RECURSIVE {SPOTS}, ed AS (SELECT a.id AS a, b.id AS b FROM spots a JOIN spots b ON a.id < b.id AND {near('a', 'b', 400.0, M)}), {component_walk('ed', 'spots')} SELECT id, component FROM comp""",
)
def proximity_components(spark, sf):
    return components.proximity_components(spots(spark, sf), 400.0, "m").select("id", "component")


_PITCHES = ["Parks Canada", "Provincial"]
_MERGE = (
    "pit AS (SELECT c_custkey AS id, c_custkey AS seq, " + coords_sql("(c_custkey // 5)", "(c_custkey % 5) * 20") + ", "
    + pick_sql(["Elk Camp", "Elk Campground", "Bow", "Elk", "Bow CG"], "c_custkey") + " AS name, " + pick_sql(_PITCHES, "c_custkey // 5")
    + " AS land_manager, CASE WHEN c_custkey // 5 % 2 = 0 THEN ['a', 'b', ''][CAST(c_custkey % 3 AS INTEGER) + 1] ELSE '' END AS park, c_custkey % 4 + 1 AS pitch_count FROM customer)"
)


@query(
    "campground_merge",
    f"""WITH RECURSIVE {_MERGE}, pk AS (SELECT *, {camp_key_sql('name')} AS k FROM pit), ed AS (SELECT a.id AS a, b.id AS b FROM pk a JOIN pk b ON a.id < b.id AND a.k = b.k AND a.land_manager = b.land_manager
      AND (a.park = b.park OR a.park = '' OR b.park = '') AND {near('a', 'b', 0.35)}), {component_walk('ed', 'pk')}
    SELECT c.component AS id, count(*) AS merged_rows, CAST(sum(pitch_count) AS BIGINT) AS pitch_count, {half('avg(lat)', 1000000000)} AS lat, arg_min(name, (-length(name), seq)) AS name FROM pk JOIN comp c ON c.id = pk.id GROUP BY c.component""",
)
def campground_merge(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").alias("seq"), *coords("(c_custkey div 5)", "(c_custkey % 5) * 20"),
        pick(["Elk Camp", "Elk Campground", "Bow", "Elk", "Bow CG"], "c_custkey").alias("name"),
        pick(_PITCHES, "c_custkey div 5").alias("land_manager"),
        F.expr("if(c_custkey div 5 % 2 = 0, element_at(array('a', 'b', ''), cast(c_custkey % 3 as int) + 1), '')").alias("park"),
        F.expr("c_custkey % 4 + 1").alias("pitch_count"),
    )
    from waymark.functions.text import campground_key

    out = clusters.merge_campgrounds(
        rows.withColumn("k", campground_key("name")), fv.CAMPGROUND_MERGE_MI, ["land_manager", "k"], F.col("name"), separate="park"
    )
    return out.select("id", "merged_rows", "pitch_count", geo.half_up("lat", 1e9).alias("lat"), "name")


def _sections(spark, sf):
    """Suppliers and parts as boundary sections: a park has many sections of falling area."""
    return table(spark, sf, "part").select(
        F.expr("concat('u', p_partkey div 12)").alias("park_code"), F.expr("cast(p_partkey % 12 as int)").alias("section"),
        *coords("(p_partkey div 12)", "(p_partkey % 12) * (p_partkey % 5) * 60", "(p_partkey % 7) * 90"),
        F.expr("(p_size % 10 + 1) * (p_partkey % 12 + 1) / 100000D").alias("area"), F.expr("p_size").alias("points"),
    )


_SECTIONS = (
    "sec AS (SELECT concat('u', p_partkey // 12) AS park_code, CAST(p_partkey % 12 AS INTEGER) AS section, "
    + coords_sql("(p_partkey // 12)", "(p_partkey % 12) * (p_partkey % 5) * 60", "(p_partkey % 7) * 90")
    + ", (p_size % 10 + 1) * (p_partkey % 12 + 1) / 100000e0 AS area, p_size AS points FROM part)"
)


@query(
    "main_sections",
    f"""WITH {_SECTIONS}, b AS (SELECT * FROM sec WHERE area >= 0.000003), m AS (SELECT park_code, max(area) AS top FROM b GROUP BY 1) SELECT b.park_code, b.section FROM b JOIN m USING (park_code) WHERE b.area >= m.top * 0.018""",
)
def main_sections(spark, sf):
    return clusters.main_sections(_sections(spark, sf)).select("park_code", "section")


@query(
    "ring_rank",
    f"""WITH {_SECTIONS}, u AS (SELECT * FROM sec WHERE points >= 4), m AS (SELECT park_code, max(area) AS top, arg_min(section, (-area, section)) AS first_ FROM u GROUP BY 1),
    k AS (SELECT u.*, CASE WHEN u.section = m.first_ THEN 0 ELSE 1 END AS o FROM u JOIN m USING (park_code) WHERE u.section = m.first_ OR (u.area >= 0.000003 AND u.area >= m.top * 0.018))
    SELECT park_code, section, row_number() OVER (PARTITION BY park_code ORDER BY o, -area, section) AS ring_rank FROM k""",
)
def ring_rank(spark, sf):
    return clusters.prepare_rings(_sections(spark, sf)).select("park_code", "section", "ring_rank")


@query(
    "section_clusters",
    f"""WITH RECURSIVE {_SECTIONS}, o AS (SELECT *, row_number() OVER (PARTITION BY park_code ORDER BY -area, section) AS n FROM sec),
    nb AS (SELECT a.park_code, a.n, list(b.n) AS ns FROM o a JOIN o b ON b.park_code = a.park_code AND b.n < a.n AND {hav('a.lat', 'a.lon', 'b.lat', 'b.lon', KM)} < 3 GROUP BY ALL),
    walk(park_code, n, labels, top) AS (SELECT park_code, CAST(1 AS BIGINT), [CAST(0 AS BIGINT)], CAST(0 AS BIGINT) FROM o WHERE n = 1 UNION ALL
      SELECT w.park_code, w.n + 1, list_append(w.labels, coalesce(list_min(list_transform(nb.ns, lambda x: w.labels[x])), w.top + 1)), CASE WHEN nb.ns IS NULL THEN w.top + 1 ELSE w.top END
      FROM walk w JOIN o ON o.park_code = w.park_code AND o.n = w.n + 1 LEFT JOIN nb ON nb.park_code = w.park_code AND nb.n = w.n + 1)
    SELECT o.park_code, o.section, CAST(w.labels[o.n] AS INTEGER) AS cluster FROM o JOIN walk w ON w.park_code = o.park_code AND w.n = o.n""",
)
def section_clusters(spark, sf):
    return clusters.section_clusters(_sections(spark, sf)).select("park_code", "section", "cluster")


@query("map_pins")
def map_pins(spark, sf):
    """Labelled pins per park: section clusters, visitor-center labels, overrides, numbered areas."""
    centers = table(spark, sf, "customer").select(
        F.expr("concat('u', c_custkey div 9)").alias("park_code"), F.col("c_custkey").alias("seq"),
        pick(["North Unit Visitor Center", "Island Contact Station", "Headquarters", "South Unit", "Elkhorn Ranch"], "c_custkey").alias("name"),
        *coords("(c_custkey div 9)"),
    )
    overrides = table(spark, sf, "supplier").select(
        F.expr("concat('u', s_suppkey * 3)").alias("park_code"), F.lit(0).alias("cluster"), F.col("s_name").alias("label")
    )
    return clusters.map_pins(_sections(spark, sf), centers, overrides).select("park_code", "pin_id", "label", "lat", "lon", "role", "section_count")


# ---- R12, W2 - W5 -----------------------------------------------------------------------------------

_UNIT_NAMES = ["Blue Lake State Park", "Blue Lake", "Ash State Historic Site", "Elm", "State Park"]


def park_records(spark, sf):
    return table(spark, sf, "customer").select(
        F.format_string("k%010d", "c_custkey").alias("id"), F.col("c_custkey").alias("seq"), F.lit("US").alias("country"),
        F.expr("concat('S', c_custkey div 8)").alias("state"), pick(_UNIT_NAMES, "c_custkey").alias("name"),
        *coords("(c_custkey div 8)", "(c_custkey % 8) * 15"),
        F.expr("if(c_nationkey % 3 = 0, 'official', 'osm')").alias("source"),
        F.expr("if(c_custkey % 4 = 1, concat('https://x/', c_custkey), '')").alias("url"),
        F.expr("if(c_custkey % 6 = 2, concat('c', c_custkey), '')").alias("official_code"),
        F.expr("concat(element_at(array('node', 'way', 'relation'), cast(c_nationkey % 3 as int) + 1), '/', c_custkey)").alias("osm_id"),
        F.expr("c_custkey % 5 = 0").alias("needs_review"), F.expr("if(c_custkey % 7 = 0, 'operator', 'name')").alias("osm_confidence"),
    )


_PARKS = (
    "raw AS (SELECT c_custkey AS seq, printf('k%010d', c_custkey) AS id, concat('S', c_custkey // 8) AS state, " + pick_sql(_UNIT_NAMES, "c_custkey")
    + " AS name, " + coords_sql("(c_custkey // 8)", "(c_custkey % 8) * 15")
    + """, CASE WHEN c_nationkey % 3 = 0 THEN 'official' ELSE 'osm' END AS source, CASE WHEN c_custkey % 4 = 1 THEN concat('https://x/', c_custkey) ELSE '' END AS url,
      CASE WHEN c_custkey % 6 = 2 THEN concat('c', c_custkey) ELSE '' END AS code, concat(['node', 'way', 'relation'][CAST(c_nationkey % 3 AS INTEGER) + 1], '/', c_custkey) AS osm,
      CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE 8 END + CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE 6 END + [0, 5, 10][CAST(c_nationkey % 3 AS INTEGER) + 1] AS base FROM customer),
    p AS (SELECT *, concat(state, '::', trim(regexp_replace(regexp_replace(lower(name), '\\b(state park|state historic site)\\b', '', 'g'), '[^a-z0-9]+', ' ', 'g'))) AS key,
      base + CASE WHEN source = 'official' THEN 50 ELSE 0 END + CASE WHEN url <> '' THEN 20 ELSE 0 END + CASE WHEN code <> '' THEN 15 ELSE 0 END AS rank FROM raw),
    o AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq) AS rn FROM p)"""
)
_NO_TEXTS = "CAST([] AS VARCHAR[])"


@query(
    "park_merge",
    f"""WITH RECURSIVE {_PARKS},
    walk(key, rn, id, lat, lon, osm, source, url, code, rank, sources, alts, apart, metres) AS (
      SELECT key, rn, id, lat, lon, osm, source, url, code, rank, {_NO_TEXTS}, {_NO_TEXTS}, CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE) FROM o WHERE rn = 1
      UNION ALL
      SELECT key, rn, CASE WHEN won THEN r_id ELSE id END, CASE WHEN won THEN r_lat ELSE lat END, CASE WHEN won THEN r_lon ELSE lon END,
        CASE WHEN won THEN r_osm ELSE osm END, CASE WHEN won THEN r_source ELSE source END,
        CASE WHEN far THEN url WHEN won THEN coalesce(nullif(r_url, ''), url) ELSE coalesce(nullif(url, ''), r_url) END,
        CASE WHEN far THEN code WHEN won THEN coalesce(nullif(r_code, ''), code) ELSE coalesce(nullif(code, ''), r_code) END,
        CASE WHEN far THEN rank WHEN won THEN r_rank + CASE WHEN r_url = '' AND url <> '' THEN 20 ELSE 0 END + CASE WHEN r_code = '' AND code <> '' THEN 15 ELSE 0 END
          ELSE rank + CASE WHEN url = '' AND r_url <> '' THEN 20 ELSE 0 END + CASE WHEN code = '' AND r_code <> '' THEN 15 ELSE 0 END END,
        CASE WHEN far THEN sources WHEN won THEN [r_source, source] ELSE list_concat(sources, [source, r_source]) END,
        CASE WHEN far THEN alts WHEN won THEN [osm] ELSE list_append(alts, r_osm) END, CASE WHEN far THEN r_id END, CASE WHEN far THEN d END
      FROM (SELECT *, d > 500 AS far, d <= 500 AND r_rank >= rank AS won FROM (
        SELECT w.key, r.rn, w.id, w.lat, w.lon, w.osm, w.source, w.url, w.code, w.rank, w.sources, w.alts, r.id AS r_id, r.lat AS r_lat, r.lon AS r_lon,
          r.osm AS r_osm, r.source AS r_source, r.url AS r_url, r.code AS r_code, r.rank AS r_rank, {hav('w.lat', 'w.lon', 'r.lat', 'r.lon', M)} AS d
        FROM walk w JOIN o r ON r.key = w.key AND r.rn = w.rn + 1) t) t),
    last AS (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY key ORDER BY rn DESC) = 1)
    SELECT last.id, raw.state, raw.name, coalesce(list_aggregate(list_sort(list_distinct(sources)), 'string_agg', ','), '') AS merge_sources,
      coalesce(list_aggregate(list_sort(list_distinct(alts)), 'string_agg', ','), '') AS alt_osm_ids FROM last JOIN raw USING (id)
    UNION ALL SELECT apart, raw.state, raw.name, '', '' FROM walk JOIN raw ON raw.id = apart
    UNION ALL SELECT apart, 'conflict', id, CAST(CAST(floor(metres + 0.5) AS BIGINT) AS VARCHAR), '' FROM walk WHERE apart IS NOT NULL""",
)
def park_merge(spark, sf):
    """Rank-based merge of park records by key with moving winners."""
    merged, conflicts = parkmerge.merge_parks(park_records(spark, sf))
    return merged.select("id", "state", "name", "merge_sources", "alt_osm_ids").unionByName(
        conflicts.select(
            F.col("b_id").alias("id"), F.lit("conflict").alias("state"), F.col("a_id").alias("name"),
            F.col("distance_m").cast("string").alias("merge_sources"), F.lit("").alias("alt_osm_ids"),
        )
    )


@query(
    "best_unit_row",
    """WITH t AS (SELECT lower(concat('U', l_partkey % 700)) AS code, ['National Park', 'National Preserve', 'Park', 'Other', 'National Monument'][CAST(l_suppkey % 5 AS INTEGER) + 1] AS unit_type, l_orderkey * 8 + l_linenumber AS o, l_extendedprice AS x FROM lineitem),
    r AS (SELECT *, CASE unit_type WHEN 'National Park' THEN 100 WHEN 'National Preserve' THEN 50 WHEN 'Park' THEN 10 WHEN 'National Monument' THEN 90 ELSE 40 END AS rk FROM t)
    SELECT code, arg_min(unit_type, (-rk, o, x)) AS unit_type, max(rk) AS rank FROM r GROUP BY code""",
)
def best_unit_row(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.expr("concat('U', l_partkey % 700)").alias("code"),
        pick(["National Park", "National Preserve", "Park", "Other", "National Monument"], "l_suppkey").alias("unit_type"),
        F.struct(F.expr("l_orderkey * 8 + l_linenumber").alias("o"), F.col("l_extendedprice").alias("x")).alias("seq"),
    )
    out = unit_plans.best_unit_rows(rows)
    return out.select("code", "unit_type", parks.unit_type_rank("unit_type").alias("rank"))


@query(
    "best_center_per_park",
    """WITH t AS (SELECT o_custkey AS park, o_orderkey AS seq, ['Main Visitor Center', 'Contact Station', 'Headquarters', 'Campground Office'][CAST(o_orderkey % 4 AS INTEGER) + 1] AS name FROM orders)
    SELECT park, arg_min(name, (-CASE name WHEN 'Main Visitor Center' THEN 20 WHEN 'Contact Station' THEN 8 WHEN 'Headquarters' THEN 4 ELSE -5 END, seq)) AS name, arg_min(seq, (-CASE name WHEN 'Main Visitor Center' THEN 20 WHEN 'Contact Station' THEN 8 WHEN 'Headquarters' THEN 4 ELSE -5 END, seq)) AS seq FROM t GROUP BY park""",
)
def best_center_per_park(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("park"), F.col("o_orderkey").alias("seq"),
        pick(["Main Visitor Center", "Contact Station", "Headquarters", "Campground Office"], "o_orderkey").alias("name"),
    )
    return best_per_key(rows, ["park"], parks.visitor_center_score("name"), "seq").select("park", "name", "seq")


@query(
    "best_official_row",
    """WITH t AS (SELECT concat('s', c_nationkey) AS admin, ['Blue Lake State Park', 'Fort Historic Site', 'Ash SP', 'City Park', 'Elm Memorial'][CAST(c_custkey % 5 AS INTEGER) + 1] AS name, CASE WHEN c_custkey % 3 = 0 THEN concat('c', c_custkey % 40) ELSE '' END AS code, CASE WHEN c_custkey % 4 = 0 THEN 'https://x' ELSE '' END AS url, c_custkey AS seq FROM customer),
    ok AS (SELECT *, CASE WHEN code <> '' THEN code ELSE lower(name) END AS k, CASE WHEN url <> '' THEN 10 ELSE 0 END + CASE WHEN code <> '' THEN 5 ELSE 0 END AS s FROM t WHERE name <> 'City Park')
    SELECT admin, arg_min(name, (-s, seq)) AS name, arg_min(seq, (-s, seq)) AS seq FROM ok GROUP BY admin, k""",
)
def best_official_row(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.expr("concat('s', c_nationkey)").alias("admin"),
        pick(["Blue Lake State Park", "Fort Historic Site", "Ash SP", "City Park", "Elm Memorial"], "c_custkey").alias("name"),
        F.expr("if(c_custkey % 3 = 0, concat('c', c_custkey % 40), '')").alias("code"),
        F.expr("if(c_custkey % 4 = 0, 'https://x', '')").alias("url"), *coords("c_custkey"), F.col("c_custkey").alias("seq"),
    )
    return park_plans.official_records(rows).select("admin", "name", "seq")


@query(
    "rank_in_hot_groups",
    "SELECT l_orderkey, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice) AS r FROM lineitem",
)
def rank_in_hot_groups(spark, sf):
    rows = table(spark, sf, "lineitem")
    order = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    return rank_in_groups(rows, ["l_returnflag"], order, "r").select("l_orderkey", "l_partkey", "l_suppkey", F.col("r").cast("bigint").alias("r"))


@query(
    "listing_source_pick",
    """WITH c AS (SELECT l_suppkey AS admin, l_linenumber % 3 AS rank, count(*) AS n, CASE WHEN l_linenumber % 3 = 2 THEN 150 ELSE 100 END AS least FROM lineitem GROUP BY ALL), v AS (SELECT * FROM c WHERE n >= least)
    SELECT admin, arg_min(rank, (-n, rank)) AS rank, max(n) AS listings FROM v GROUP BY admin""",
)
def listing_source_pick(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("admin"), F.expr("l_linenumber % 3").alias("rank")).agg(
        F.count(F.lit(1)).alias("listings")
    ).withColumn("least", F.when(F.col("rank") == 2, 150).otherwise(100))
    return park_plans.pick_listing_source(counts).select("admin", "rank", "listings")


# ---- J22 - J28, R24 - R28 ---------------------------------------------------------------------------


def _park_catalogue(spark, sf):
    return table(spark, sf, "supplier").select(
        F.format_string("sp%08d", "s_suppkey").alias("park_id"), F.col("s_suppkey").alias("seq"),
        F.expr("if(s_suppkey % 3 = 0, concat('C', s_suppkey), '')").alias("code"),
        F.expr("concat('Unit ', s_suppkey div 2 % 30, ' State Park')").alias("name"), F.expr("concat('S', s_suppkey % 4)").alias("state"),
        *coords("s_suppkey * 11"),
    )


_CATALOGUE = (
    "cat AS (SELECT format('sp{:08d}', s_suppkey) AS park_id, s_suppkey AS seq, CASE WHEN s_suppkey % 3 = 0 THEN concat('C', s_suppkey) ELSE '' END AS code, concat('unit ', s_suppkey // 2 % 30) AS name, concat('S', s_suppkey % 4) AS state, "
    + coords_sql("s_suppkey * 11") + " FROM supplier)"
)


@query(
    "state_park_parent",
    f"""WITH {SPOTS}, {_CATALOGUE}, r AS (SELECT id, lat, lon, CASE WHEN id % 10 = 0 THEN concat('C', id % 90) ELSE '' END AS code, CASE WHEN id % 3 = 1 THEN concat('unit ', id % 45) ELSE '' END AS unit, concat('S', id % 5) AS state FROM spots),
    c1 AS (SELECT r.id, min_by(park_id, seq) AS p FROM r JOIN cat c ON r.code <> '' AND c.code = r.code GROUP BY r.id), c2 AS (SELECT r.id, min_by(park_id, seq) AS p FROM r JOIN cat c ON r.unit = c.name AND r.state = c.state GROUP BY r.id),
    c3 AS (SELECT r.id, min_by(park_id, seq) AS p FROM r JOIN cat c ON r.unit = c.name GROUP BY r.id),
    c4 AS (SELECT r.id, arg_min(b.park_id, ({hav('r.lat', 'r.lon', 'b.lat', 'b.lon')}, b.park_id)) AS p FROM r JOIN cat b ON b.state = r.state AND {near('r', 'b', 5000.0, M)} GROUP BY r.id)
    SELECT r.id, coalesce(c1.p, c2.p, c3.p, c4.p) AS parent, CASE WHEN c1.p IS NOT NULL THEN 'code' WHEN c2.p IS NOT NULL THEN 'state-name' WHEN c3.p IS NOT NULL THEN 'name' WHEN c4.p IS NOT NULL THEN 'nearest' ELSE 'none' END AS parent_by
    FROM r LEFT JOIN c1 USING (id) LEFT JOIN c2 USING (id) LEFT JOIN c3 USING (id) LEFT JOIN c4 USING (id)""",
)
def state_park_parent(spark, sf):
    rows = spots(spark, sf).select(
        "id", "lat", "lon", F.expr("if(id % 10 = 0, concat('C', id % 90), '')").alias("code"),
        F.expr("if(id % 3 = 1, concat('Unit ', id % 45, ' SP'), '')").alias("unit_name"), F.expr("concat('S', id % 5)").alias("state"),
    )
    return park_plans.resolve_parent(rows, _park_catalogue(spark, sf), 5000.0).select("id", "parent", "parent_by")


@query(
    "canadian_parent",
    f"""WITH {SPOTS}, u AS (SELECT concat('u', s_suppkey) AS code, concat('place ', s_suppkey % 60) AS key, s_suppkey AS seq, {coords_sql('s_suppkey * 11')} FROM supplier),
    r AS (SELECT id, lat, lon, CASE WHEN id % 9 = 0 THEN concat('u', id % 150) ELSE '' END AS code, CASE WHEN id % 9 = 1 THEN concat('u', id % 150) ELSE '' END AS slug, CASE WHEN id % 9 = 2 THEN concat('place ', id % 90) ELSE '' END AS name FROM spots),
    c1 AS (SELECT r.id, u.code AS p FROM r JOIN u ON u.code = r.code), c2 AS (SELECT r.id, u.code AS p FROM r JOIN u ON u.code = r.slug), c3 AS (SELECT r.id, max_by(u.code, u.seq) AS p FROM r JOIN u ON u.key = r.name GROUP BY r.id),
    c4 AS (SELECT r.id, arg_min(b.code, ({hav('r.lat', 'r.lon', 'b.lat', 'b.lon')}, b.code)) AS p FROM r JOIN u b ON {near('r', 'b', 80000.0, M)} GROUP BY r.id)
    SELECT r.id, coalesce(c1.p, c2.p, c3.p, c4.p) AS parent, CASE WHEN c1.p IS NOT NULL THEN 'code' WHEN c2.p IS NOT NULL THEN 'slug' WHEN c3.p IS NOT NULL THEN 'name' WHEN c4.p IS NOT NULL THEN 'nearest' ELSE 'none' END AS parent_by
    FROM r LEFT JOIN c1 USING (id) LEFT JOIN c2 USING (id) LEFT JOIN c3 USING (id) LEFT JOIN c4 USING (id)""",
)
def canadian_parent(spark, sf):
    units = table(spark, sf, "supplier").select(
        F.expr("concat('u', s_suppkey)").alias("code"), F.expr("concat('Place ', s_suppkey % 60, ' National Park of Canada')").alias("name"),
        F.lit("").alias("name_fr"), F.col("s_suppkey").alias("seq"), *coords("s_suppkey * 11"),
    )
    rows = spots(spark, sf).select(
        "id", "lat", "lon", F.expr("if(id % 9 = 0, concat('U', id % 150), '')").alias("park_code"),
        F.expr("if(id % 9 = 1, concat('https://parks.canada.ca/pn-np/ab/U', id % 150, '?x=1'), '')").alias("url"),
        F.expr("if(id % 9 = 2, concat('Place ', id % 90, ' National Historic Site'), '')").alias("name"),
    )
    return unit_plans.resolve_canadian_parent(rows, units).select("id", "parent", "parent_by")


_UNITS_SQL = """units AS (SELECT lower(concat('N', s_suppkey)) AS code, s_suppkey AS seq, CASE WHEN s_suppkey % 5 = 4 THEN concat('Hill ', s_suppkey // 5) WHEN s_suppkey % 5 = 0 THEN concat('Hill ', s_suppkey // 5) ELSE concat('Vale ', s_suppkey) END AS short,
      CASE WHEN s_suppkey % 5 = 4 THEN 'preserve' WHEN s_suppkey % 5 = 0 THEN 'park' ELSE 'monument' END AS category FROM supplier),
    prim AS (SELECT lower(short) AS k, min_by(code, seq) AS code FROM units GROUP BY 1), alias_ AS (SELECT u.code, p.code AS primary_code FROM units u JOIN prim p ON p.k = lower(u.short) WHERE u.category = 'preserve' AND p.code <> u.code)"""


def _units(spark, sf):
    return table(spark, sf, "supplier").select(
        F.expr("concat('N', s_suppkey)").alias("code"), F.col("s_suppkey").alias("seq"),
        F.expr(
            """case s_suppkey % 5 when 4 then concat('Hill ', s_suppkey div 5, ' National Preserve') when 0 then concat('Hill ', s_suppkey div 5, ' National Park')
            else concat('Vale ', s_suppkey, ' National Monument') end"""
        ).alias("name"),
        F.expr("case s_suppkey % 5 when 4 then 'preserve' when 0 then 'park' else 'monument' end").alias("category"),
    )


@query(
    "federal_parent",
    f"""WITH {_UNITS_SQL}, r AS (SELECT o_orderkey AS id, lower(concat('n', o_custkey % 140)) AS code FROM orders), x AS (SELECT r.id, coalesce(a.primary_code, r.code) AS parent_code FROM r LEFT JOIN alias_ a ON a.code = r.code)
    SELECT x.id, x.parent_code, coalesce(u.category, 'other') AS parent_category FROM x LEFT JOIN units u ON u.code = x.parent_code""",
)
def federal_parent(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.expr("concat('n', o_custkey % 140)").alias("park_code"))
    return unit_plans.resolve_federal_parent(rows, _units(spark, sf)).select("id", "parent_code", "parent_category")


@query(
    "unit_consolidation",
    """WITH t AS (SELECT lower(concat('U', p_partkey // 2)) AS code, ['National Park', 'National Preserve', 'National Monument'][CAST(p_partkey // 2 % 3 AS INTEGER) + 1] AS ut, concat('park ', p_partkey // 6) AS park, p_partkey AS seq FROM part),
    b AS (SELECT DISTINCT code, ut, park, CASE ut WHEN 'National Park' THEN 100 WHEN 'National Monument' THEN 90 ELSE 50 END AS rk FROM t), f AS (SELECT park, arg_min(code, (-rk, code)) AS prim, count(*) AS n FROM b GROUP BY park)
    SELECT CASE WHEN f.n > 1 AND t.ut = 'National Preserve' THEN f.prim ELSE t.code END AS primary_code, count(*) AS n FROM t JOIN f USING (park) GROUP BY 1""",
)
def unit_consolidation(spark, sf):
    rows = table(spark, sf, "part").select(
        F.expr("concat('U', p_partkey div 2)").alias("code"),
        pick(["National Park", "National Preserve", "National Monument"], "p_partkey div 2").alias("unit_type"),
        F.expr("concat('Park ', p_partkey div 6)").alias("park_name"), F.col("p_partkey").alias("seq"),
    )
    return unit_plans.consolidate_units(rows).groupBy("primary_code").agg(F.count(F.lit(1)).alias("n"))


@query(
    "subsidiary_preserves",
    """WITH t AS (SELECT p_partkey AS id, CASE p_size % 4 WHEN 0 THEN 'National Preserve' WHEN 1 THEN 'National Park' ELSE 'Park' END AS ut, p_name AS park FROM part), r AS (SELECT *, CASE ut WHEN 'National Preserve' THEN 50 WHEN 'National Park' THEN 100 ELSE 10 END AS rk FROM t)
    SELECT id FROM r a WHERE NOT (ut = 'National Preserve' AND EXISTS (SELECT 1 FROM r b WHERE b.park = a.park AND b.rk > a.rk))""",
)
def subsidiary_preserves(spark, sf):
    rows = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_partkey").alias("code"),
        F.expr("case p_size % 4 when 0 then 'National Preserve' when 1 then 'National Park' else 'Park' end").alias("unit_type"),
        F.col("p_name").alias("park_name"),
    )
    return unit_plans.without_subsidiary_preserves(rows).select("id")


@query(
    "unit_catalog",
    f"""WITH u AS (SELECT lower(concat('u', c_custkey)) AS code, c_custkey AS k, CASE WHEN c_nationkey % 6 = 0 THEN '' ELSE 'National Park' END AS d FROM customer WHERE c_custkey % 3 > 0 AND c_nationkey % 5 > 0),
    l AS (SELECT lower(concat('u', c_custkey)) AS code, c_custkey AS k, CASE WHEN c_custkey % 11 = 0 THEN 'National Scenic Trail' ELSE 'National Seashore' END AS d FROM customer WHERE c_custkey % 4 = 0),
    x AS (SELECT u.code, u.k, coalesce(nullif(u.d, ''), 'Park') AS d, CASE WHEN k % 2 = 0 THEN 'boundary_centroid' WHEN k % 4 = 0 THEN 'park_list' WHEN k % 5 = 0 THEN 'centroid' WHEN k % 7 = 0 THEN 'arcgis_geometry' END AS src FROM u)
    SELECT code, src AS coord_source, CASE d WHEN 'Park' THEN 'other' ELSE 'park' END AS category FROM x WHERE src IS NOT NULL
    UNION ALL SELECT code, 'boundary_centroid', 'recreation' FROM l WHERE d <> 'National Scenic Trail' AND code NOT IN (SELECT code FROM x WHERE src IS NOT NULL)""",
)
def unit_catalog(spark, sf):
    c = table(spark, sf, "customer")
    base = c.select(F.expr("concat('U', c_custkey)").alias("code"), "c_custkey", "c_nationkey", *coords("c_custkey"))
    units = base.where("c_custkey % 3 > 0").select(
        "code", F.col("code").alias("name"), F.expr("if(c_nationkey % 6 = 0, '', 'National Park')").alias("unit_type"),
        F.expr("if(c_nationkey % 5 = 0, 'XX', 'TX; nm')").alias("states"),
    )
    pins = base.where("c_custkey % 2 = 0").select("code", "lat", "lon")
    listed = base.where("c_custkey % 4 = 0").select(
        "code", F.col("code").alias("name"), F.expr("if(c_custkey % 11 = 0, 'National Scenic Trail', 'National Seashore')").alias("designation"),
        F.lit("TX,OK").alias("states"), "lat", "lon",
    )
    cen = base.where("c_custkey % 5 = 0").select("code", "lat", "lon")
    geom = base.where("c_custkey % 7 = 0").select("code", "lat", "lon")
    return unit_plans.unit_catalog(units, pins, listed, cen, geom).select("code", "coord_source", "category")


@query(
    "camp_unit_gaps",
    """WITH u AS (SELECT lower(concat('n', s_suppkey)) AS code, ['park', 'memorial', 'monument', 'preserve'][CAST(s_suppkey % 4 AS INTEGER) + 1] AS cat FROM supplier)
    SELECT concat('CG-NPS-', upper(code), '-NO-CAMPGROUND-PLACEHOLDER') AS id, cat AS category FROM u WHERE cat IN ('park', 'monument', 'preserve') AND code NOT IN (SELECT lower(concat('n', c_custkey % 60)) FROM customer WHERE c_nationkey % 5 = 0)""",
)
def camp_unit_gaps(spark, sf):
    units = table(spark, sf, "supplier").select(
        F.expr("concat('n', s_suppkey)").alias("park_code"), F.col("s_name").alias("name"),
        pick(["park", "memorial", "monument", "preserve"], "s_suppkey").alias("category"), *coords("s_suppkey"),
    )
    master = camps(spark, sf).withColumn("park_code", F.expr("concat('N', id % 60)"))
    gaps = camping_plans.placeholders(master, units)
    return gaps.join(units.select("park_code", "category"), "park_code").select("id", "category")


_API = "api AS (SELECT c_custkey AS id, lower(concat('P', c_custkey // 6)) AS park, " + coords_sql("(c_custkey // 2)", "(c_custkey % 2) * 6") + ", " + pick_sql(["Elk Visitor Center", "Elk Ridge", "Contact Station", "Ash"], "c_custkey") + " AS name FROM customer WHERE c_custkey % 2 = 0)"
_FEA = "fea AS (SELECT c_custkey AS id, c_custkey AS seq, lower(concat('P', c_custkey // 6)) AS park, " + coords_sql("(c_custkey // 2)", "(c_custkey % 2) * 6") + ", " + pick_sql(["Elk", "Elk Ridge", "Ash Grove", "Information"], "c_custkey // 2") + " AS name FROM customer WHERE c_custkey % 2 = 1)"
_CENTER_KEY = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(name), '\\bvisitor center\\b', '', 'g'), '\\bcontact station\\b', '', 'g'), '\\binformation\\b', '', 'g'), '[^a-z0-9]+', ' ', 'g'))"
_CENTERS = f"""{_API}, {_FEA}, a AS (SELECT *, {_CENTER_KEY} AS k FROM api), f AS (SELECT *, {_CENTER_KEY} AS k FROM fea),
    ex AS (SELECT a.id, max_by(f.id, f.seq) AS fid, 'key' AS rule FROM a JOIN f ON f.park = a.park AND CASE WHEN f.k = '' THEN 'visitor-center' ELSE f.k END = CASE WHEN a.k = '' THEN 'visitor-center' ELSE a.k END GROUP BY a.id),
    nr AS (SELECT a.id, arg_min(b.id, ({hav('a.lat', 'a.lon', 'b.lat', 'b.lon')}, b.seq)) AS fid, 'near' AS rule FROM a JOIN f b ON b.park = a.park AND {_SIMILAR} AND {near('a', 'b', 400.0, M)} WHERE a.id NOT IN (SELECT id FROM ex) GROUP BY a.id),
    hits AS (SELECT * FROM ex UNION ALL SELECT * FROM nr)"""


def _centers(spark, sf):
    base = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").alias("seq"), F.expr("concat('P', c_custkey div 6)").alias("park_code"),
        *coords("(c_custkey div 2)", "(c_custkey % 2) * 6"), F.expr("c_custkey % 3 > 0").alias("has_hours"),
    )
    api = base.where("id % 2 = 0").withColumn("name", pick(["Elk Visitor Center", "Elk Ridge", "Contact Station", "Ash"], "id"))
    features = base.where("id % 2 = 1").withColumn("name", pick(["Elk", "Elk Ridge", "Ash Grove", "Information"], "id div 2")).withColumn("has_hours", F.lit(False))
    return api, features


@query("center_match", f"WITH {_CENTERS} SELECT id, fid AS feature_id, rule AS match_rule FROM hits")
def center_match(spark, sf):
    return unit_plans.match_feature_rows(*_centers(spark, sf)).select("id", "feature_id", "match_rule")


@query(
    "center_master",
    f"""WITH {_CENTERS}, {STATIONS}, rows_ AS (SELECT a.id, a.lat, a.lon, '02-nps-api' AS src, a.id % 3 > 0 AS hours, {half(hav('a.lat', 'a.lon', 'f.lat', 'f.lon'), 1)} AS fd FROM a LEFT JOIN hits h ON h.id = a.id LEFT JOIN f ON f.id = h.fid
      UNION ALL SELECT f.id, f.lat, f.lon, '01-arcgis-poi', false, NULL FROM f WHERE f.id NOT IN (SELECT fid FROM hits)),
    o AS (SELECT p.id, min({hav('p.lat', 'p.lon', 's.lat', 's.lon')}) AS d FROM rows_ p JOIN stations s ON {near('p', 's', 350.0, M)} GROUP BY p.id)
    SELECT r.id, r.src AS ingest_source, concat_ws(',', CASE WHEN NOT r.hours THEN 'NO_HOURS' END, CASE WHEN r.fd > 200 THEN 'COORD_MISMATCH' END, CASE WHEN floor(o.d + 0.5) > 150 AND o.d > 150 THEN 'OSM_FAR' END, CASE WHEN o.d IS NULL THEN 'NO_OSM' END) AS flags FROM rows_ r LEFT JOIN o ON o.id = r.id""",
)
def center_master(spark, sf):
    api, features = _centers(spark, sf)
    points = stations(spark, sf).select(F.col("id").alias("osm_key"), "lat", "lon")
    out = unit_plans.visitor_center_master(api, features, points)
    return out.select("id", "ingest_source", F.array_join("map_flags", ",").alias("flags"))


_LISTED = ["Blue Lake", "Ash", "Elm Grove", "Oak Hill Annex", "Pine"]
_UNITS_OF = ["Blue Lake State Park", "Ash Grove", "Elm", "Oak Hill - East", "Pine Trailway", "Cedar", "Oak"]


@query(
    "listing_match",
    f"""WITH u AS (SELECT c_custkey AS id, c_nationkey AS admin, {pick_sql(['blue lake', 'ash grove', 'elm', 'oak hill', 'pine', 'cedar', 'oak'], 'c_custkey')} AS k, CASE WHEN c_custkey % 9 = 0 THEN 'pine' WHEN c_custkey % 9 = 1 THEN 'nothere' END AS slug FROM customer),
    l(seq, slug, k) AS (VALUES (0, 'blue-lake', 'blue lake'), (1, 'ash', 'ash'), (2, 'elm-grove', 'elm grove'), (3, 'oak-hill-annex', 'oak hill annex'), (4, 'pine', 'pine')),
    h AS (SELECT u.id, 0 AS rk, l.seq, l.slug, 'url' AS rule FROM u JOIN l ON l.slug = u.slug UNION ALL SELECT u.id, 1, 4, 'pine', 'override' FROM u WHERE u.k = 'cedar'
      UNION ALL SELECT u.id, 2, l.seq, l.slug, 'key' FROM u JOIN l ON u.k <> 'cedar' AND (l.k = u.k OR starts_with(u.k, concat(l.k, ' ')) OR (starts_with(l.k, u.k) AND length(u.k) >= 4)))
    SELECT id, arg_min(slug, (rk, seq)) AS slug, arg_min(rule, (rk, seq)) AS rule FROM h GROUP BY id""",
)
def listing_match(spark, sf):
    units = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("string").alias("admin"), pick(_UNITS_OF, "c_custkey").alias("name"),
        F.expr("case c_custkey % 9 when 0 then 'https://x/parks/Pine' when 1 then 'https://x/parks/nothere' end").alias("url"),
    )
    names = table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("string").alias("admin"), F.posexplode(F.array(*[F.lit(n) for n in _LISTED])).alias("seq", "name")
    )
    listings = names.select("admin", "seq", listing_key("name").alias("key"), F.replace(listing_key("name"), F.lit(" "), F.lit("-")).alias("slug"))
    overrides = names.where("name = 'Pine'").select("admin", F.lit("cedar").alias("key"), F.lit("pine").alias("slug"))
    patterns = [(str(i), r"/parks/([a-z0-9-]+)", "") for i in range(25)]
    return park_plans.match_units_to_listings(units, listings, overrides, patterns).select("id", "slug", "rule")


@query(
    "listing_map_match",
    f"""WITH RECURSIVE l AS (SELECT s_suppkey AS seq, format('l{{:06d}}', s_suppkey) AS slug, s_nationkey AS admin, {pick_sql(['blue lake', 'elm grove', 'oak hill'], 's_suppkey')} AS k FROM supplier WHERE s_nationkey IN (SELECT s_nationkey FROM supplier GROUP BY 1 HAVING count(*) >= 3)),
    m AS (SELECT c_custkey AS seq, c_nationkey AS admin, {pick_sql(['blue lake', 'elm', 'great oak hill', 'blue lake annex', 'cedar'], 'c_custkey')} AS k FROM customer),
    pr AS (SELECT l.slug, l.admin, l.seq AS ls, m.seq AS ms FROM l JOIN m ON m.admin = l.admin AND (m.k = l.k OR starts_with(m.k, concat(l.k, ' ')) OR starts_with(l.k, concat(m.k, ' ')) OR contains(m.k, l.k))),
    ls AS (SELECT DISTINCT ls, slug, admin, dense_rank() OVER (ORDER BY ls) AS rn FROM pr),
    opts AS (SELECT ls, list(ms ORDER BY ms) AS ms FROM pr GROUP BY ls),
    walk(rn, used, got) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST(NULL AS BIGINT) UNION ALL
      SELECT w.rn + 1, CASE WHEN len(list_filter(o.ms, lambda x: NOT list_contains(w.used, x))) > 0 THEN list_append(w.used, list_filter(o.ms, lambda x: NOT list_contains(w.used, x))[1]) ELSE w.used END, list_filter(o.ms, lambda x: NOT list_contains(w.used, x))[1]
      FROM walk w JOIN ls ON ls.rn = w.rn + 1 JOIN opts o ON o.ls = ls.ls),
    got AS (SELECT ls.slug, ls.admin, w.got AS id FROM walk w JOIN ls ON ls.rn = w.rn WHERE w.got IS NOT NULL)
    SELECT slug, id FROM got WHERE admin IN (SELECT admin FROM got GROUP BY 1 HAVING count(*) >= 3)""",
)
def listing_map_match(spark, sf):
    listings = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("seq"), F.format_string("l%06d", "s_suppkey").alias("slug"), F.col("s_nationkey").cast("string").alias("admin"),
        pick(["blue lake", "elm grove", "oak hill"], "s_suppkey").alias("key"),
    )
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("seq"), F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("string").alias("admin"),
        pick(["Blue Lake State Park", "Elm", "Great Oak Hill", "Blue Lake Annex", "Cedar"], "c_custkey").alias("name"),
    )
    return park_plans.map_name_match(listings, rows).select("slug", "id")


@query(
    "listing_gate",
    """WITH c AS (SELECT s_nationkey AS admin, count(*) AS units FROM supplier GROUP BY 1), x AS (SELECT n_nationkey AS admin, coalesce(units, 0) AS units, CASE n_nationkey % 4 WHEN 0 THEN 0 WHEN 1 THEN coalesce(units, 0) ELSE coalesce(units, 0) // 2 END AS listed, n_nationkey % 2 = 0 AS g FROM nation LEFT JOIN c ON c.admin = n_nationkey)
    SELECT admin, CASE WHEN listed > 0 AND NOT (g AND units >= 5 AND listed < least(units * 0.85, units - 2)) THEN 'listing' WHEN units > 0 THEN 'official' ELSE 'map' END AS choice FROM x""",
)
def listing_gate(spark, sf):
    units = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("admin")).agg(F.count(F.lit(1)).alias("units"))
    rows = table(spark, sf, "nation").select(F.col("n_nationkey").alias("admin")).join(units, "admin", "left").na.fill(0)
    rows = rows.withColumn("listed", F.expr("case admin % 4 when 0 then 0 when 1 then units else units div 2 end")).withColumn(
        "gis_backed", F.expr("admin % 2 = 0")
    )
    return park_plans.gate_listing(rows).select("admin", "choice")


@query(
    "map_supplement",
    """WITH o AS (SELECT DISTINCT concat('S', s_nationkey % 20) AS state FROM supplier), v AS (SELECT concat('S', n_nationkey) AS state FROM nation WHERE n_nationkey % 2 = 0),
    m AS (SELECT c_custkey AS id, concat('S', c_nationkey) AS state, ['Blue State Park', 'Ash Reserve', 'Elm County Park', 'Oak Memorial'][CAST(c_custkey % 4 AS INTEGER) + 1] AS name, CASE WHEN c_custkey % 5 = 0 THEN 'operator' ELSE 'name' END AS conf FROM customer)
    SELECT id FROM m WHERE state NOT IN (SELECT state FROM o) AND name <> 'Elm County Park' AND conf <> 'operator' AND NOT (state IN (SELECT state FROM v) AND name = 'Ash Reserve')""",
)
def map_supplement(spark, sf):
    official = table(spark, sf, "supplier").select(F.expr("concat('S', s_nationkey % 20)").alias("state"))
    verified = table(spark, sf, "nation").where("n_nationkey % 2 = 0").select(F.expr("concat('S', n_nationkey)").alias("admin"))
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.expr("concat('S', c_nationkey)").alias("state"), F.lit("US").alias("country"), F.lit("osm").alias("source"),
        pick(["Blue State Park", "Ash Reserve", "Elm County Park", "Oak Memorial"], "c_custkey").alias("name"),
        F.expr("if(c_custkey % 5 = 0, 'operator', 'name')").alias("osm_confidence"),
    )
    return park_plans.map_supplement(rows, official, verified).select("id")


@query(
    "name_audit",
    """WITH a AS (SELECT DISTINCT lower(split_part(p_name, ' ', 1)) AS n FROM part UNION SELECT DISTINCT lower(r_name) FROM region UNION SELECT lower(n_name) FROM nation), b AS (SELECT DISTINCT lower(p_name) AS m FROM part UNION SELECT 'asian' UNION SELECT 'nation_1')
    SELECT n FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE contains(b.m, a.n) OR contains(a.n, b.m))""",
)
def name_audit(spark, sf):
    from waymark.operators.textjoin import unmatched_names

    p = table(spark, sf, "part")
    a = (
        p.select(F.lower(F.substring_index("p_name", " ", 1)).alias("n"))
        .union(table(spark, sf, "region").select(F.lower("r_name")))
        .union(table(spark, sf, "nation").select(F.lower("n_name")))
        .distinct()
    )
    extra = table(spark, sf, "region").select(F.explode(F.array(F.lit("asian"), F.lit("nation_1"))).alias("n"))
    b = p.select(F.lower("p_name").alias("n")).union(extra)
    return unmatched_names(a, b, "n")


@query(
    "hub_ranking",
    """WITH t AS (SELECT n.n_nationkey AS admin, n.n_name AS st, s.s_suppkey AS seq, CASE s.s_suppkey % 5 WHEN 0 THEN concat(n.n_name, ' State Parks') WHEN 1 THEN 'State Park units' WHEN 2 THEN 'PADUS Federal' WHEN 3 THEN concat('Historic Site ', n.n_name) ELSE 'Trails' END AS title, s.s_suppkey * 977 % 60000 AS c FROM nation n JOIN supplier s ON s.s_nationkey = n.n_nationkey),
    x AS (SELECT *, CASE WHEN contains(title, 'PADUS') THEN -1000 ELSE c + CASE WHEN regexp_matches(title, '(?i)state park') THEN 5000 ELSE 0 END + CASE WHEN contains(lower(title), lower(st)) THEN 2000 ELSE 0 END + CASE WHEN regexp_matches(title, '(?i)historic site') THEN 500 ELSE 0 END - CASE WHEN c > 50000 THEN 3000 ELSE 0 END - CASE WHEN c > 10000 THEN 1000 ELSE 0 END END AS score FROM t)
    SELECT admin, seq, score, row_number() OVER (PARTITION BY admin ORDER BY score DESC, seq) AS hit_rank FROM x WHERE c > 0 AND score > 0""",
)
def hub_ranking(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("admin"), F.col("n_name").alias("state_name"))
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("admin"), F.col("s_suppkey").alias("seq"))
    hits = s.join(n, "admin").select(
        "admin", "state_name", "seq",
        F.expr("case seq % 5 when 0 then concat(state_name, ' State Parks') when 1 then 'State Park units' when 2 then 'PADUS Federal' when 3 then concat('Historic Site ', state_name) else 'Trails' end").alias("title"),
        F.expr("seq * 977 % 60000").alias("count"),
    )
    return park_plans.rank_hub_hits(hits).select("admin", "seq", "score", "hit_rank")


@query(
    "source_matrix",
    """WITH b AS (SELECT n_nationkey AS admin, CASE n_nationkey % 3 WHEN 0 THEN 'verified' WHEN 1 THEN 'pending' ELSE 'blocked' END AS st, n_nationkey * 10 AS c FROM nation), o AS (SELECT n_nationkey AS admin, CASE WHEN n_nationkey % 2 = 0 THEN 'pending' END AS st FROM nation WHERE n_nationkey % 4 = 0),
    h AS (SELECT s_nationkey AS admin, min(s_suppkey) AS k FROM supplier GROUP BY 1), x AS (SELECT b.admin, coalesce(o.st, b.st) AS st, b.c, o.admin IS NOT NULL AS ov, h.k, CASE WHEN h.k % 5 = 0 THEN 'USA_Parks' ELSE 'Parks' END AS title, h.k * 400 AS hc FROM b LEFT JOIN o USING (admin) LEFT JOIN h USING (admin)),
    y AS (SELECT *, k IS NOT NULL AND st NOT IN ('verified', 'blocked') AND title <> 'USA_Parks' AS u FROM x)
    SELECT admin, CASE WHEN u THEN 'verified' ELSE st END AS status, CASE WHEN u THEN hc ELSE c END AS feature_count, CASE WHEN u THEN 'hub' WHEN ov THEN 'override' ELSE 'base' END AS origin FROM y""",
)
def source_matrix(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("admin"))
    base = n.select(
        "admin", F.expr("case admin % 3 when 0 then 'verified' when 1 then 'pending' else 'blocked' end").alias("status"),
        F.concat(F.lit("q"), F.col("admin")).alias("query_url"), F.expr("cast(admin * 10 as bigint)").alias("feature_count"),
    )
    over = n.where("admin % 4 = 0").select(
        "admin", F.expr("if(admin % 2 = 0, 'pending', null)").alias("status"), F.lit(None).cast("string").alias("query_url"),
        F.lit(None).cast("bigint").alias("feature_count"),
    )
    hits = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("admin")).agg(F.min("s_suppkey").alias("k")).select(
        "admin", F.expr("if(k % 5 = 0, 'USA_Parks', 'Parks')").alias("title"), F.lit("u").alias("query_url"), F.expr("k * 400").alias("count")
    )
    return park_plans.merge_matrix(base, over, hits).select("admin", "status", "feature_count", "origin")


@query(
    "state_counts",
    f"WITH {STATIONS} SELECT CASE WHEN size % 7 = 0 THEN '?' ELSE brand_id END AS value, count(*) AS n FROM stations GROUP BY 1",
)
def state_counts(spark, sf):
    return count_by(stations(spark, sf), F.expr("case when size % 14 = 0 then null when size % 7 = 0 then '' else brand_id end"))


