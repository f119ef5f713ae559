"""Queries: text normalisers, ids, brand rules, classifiers, tiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.common import (
    CAMPS, SPOTS, STATIONS, camp_key_sql, camps, half, pick, pick_sql, query, slug_sql, spots, stations, table, token_sql,
)
from waymark import fixed_values as fv
from waymark.functions import brands, camping, geo, parks, tags, text
from waymark.plans import fuel as fuel_plans
from waymark.plans import pois


@query("slugify", f"SELECT p_partkey AS id, {slug_sql('concat(p_name, ' + chr(39) + ' #' + chr(39) + ', p_brand, p_type)')} AS slug FROM part")
def slugify(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), text.slugify(F.concat("p_name", F.lit(" #"), "p_brand", "p_type")).alias("slug")
    )


_NAMES = [
    "Blue Lake State Park", "Fort Ash State Historic Site", "Lac Vert Provincial Park", "Old Mill SHP", "Twin Peaks SP",
    "Grand Canyon Visitor Center", "Elk Camp Campground", "North Loop Campsite", "Bow Valley National Park of Canada",
    "ONroute Bainsville North", "World Birding Center - Quinta", "Pine Ridge Trailway", "Contact Station & Information",
    "Cedar State Natural Area", "", "Ash Grove Memorial",
]

_NAME_SQL = pick_sql(_NAMES, "c_custkey")


def _rr(x, pattern, by="", flags="g"):
    return f"regexp_replace({x}, '{pattern}', '{by}', '{flags}')"


def _tail(x):
    return f"trim({_rr(x, '[^a-z0-9]+', ' ')})"


def _phrases(x, phrases):
    for p in phrases:
        x = _rr(x, rf"\b{p}\b")
    return x


_PARK_PHRASES = ["state park", "provincial park", "parc provincial", "state historic site", "provincial historic site"]
_STATE_KEY = _tail(_phrases("lower(n)", _PARK_PHRASES))
_LISTING_CUT = _rr(_rr(_rr("n", r"\s+(State|Provincial)\s+(Park|Historic Site|Natural Area).*$", "", "gi"), r"\s+(SP|SHP|SB|SRA|SMR|SVRA|SNR|SHM)$", "", "gi"), r"\s+and Trailway$", "", "gi")


@query(
    "normalise_names",
    f"""WITH t AS (SELECT c_custkey AS id, {_NAME_SQL} AS n FROM customer)
    SELECT id, {token_sql('n')} AS token, {camp_key_sql('n')} AS camp, {_STATE_KEY} AS park,
      {_tail(_rr(_rr(_rr('lower(n)', chr(92) + 'b(state|provincial)' + chr(92) + 'b'), chr(92) + 'b(park|historic|historical|site|monument|memorial|preserve|recreation area)' + chr(92) + 'b'), chr(92) + 'b(sp|shp|shm|pp|php|hs)' + chr(92) + 'b'))} AS unit,
      {_tail(_phrases('lower(n)', ['visitor center', 'contact station', 'information']))} AS center,
      {_tail(_rr('lower(n)', chr(92) + 'b(campground|camp|campsite|camping area|picnic area|restroom|toilet)' + chr(92) + 'b'))} AS amenity,
      {_rr(_rr(_rr('lower(n)', chr(92) + 'bon' + chr(92) + 's*route' + chr(92) + 'b'), chr(92) + 'b(north|south|east|west|northeast|northwest|southeast|southwest)' + chr(92) + 'b'), '[^a-z0-9]')} AS plaza,
      {_tail(_phrases('lower(trim(' + _LISTING_CUT + '))', _PARK_PHRASES))} AS listing FROM t""",
)
def normalise_names(spark, sf):
    t = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), pick(_NAMES, "c_custkey").alias("n"))
    return t.select(
        "id", text.brand_token("n").alias("token"), text.campground_key("n").alias("camp"), text.state_park_key("n").alias("park"),
        text.park_unit_key("n").alias("unit"), text.visitor_center_key("n").alias("center"), text.amenity_key("n").alias("amenity"),
        text.plaza_key("n").alias("plaza"), text.listing_key("n").alias("listing"),
    )


_EXPANDED = (
    "CASE WHEN regexp_matches(trim(n), '(?i)\\sSHP$') THEN regexp_replace(trim(n), '(?i)\\sSHP$', ' State Historic Park') "
    "WHEN regexp_matches(trim(n), '(?i)\\sSP$') THEN regexp_replace(trim(n), '(?i)\\sSP$', ' State Park') ELSE trim(n) END"
)


@query(
    "display_names",
    f"""WITH t AS (SELECT c_custkey AS id, {_NAME_SQL} AS n, CASE c_custkey % 3 WHEN 0 THEN 'State Park' WHEN 1 THEN '' ELSE 'Memorial' END AS d FROM customer), x AS (SELECT *, {_EXPANDED} AS e FROM t)
    SELECT id, e AS expanded, CASE WHEN e = '' THEN d WHEN d = '' THEN e WHEN contains(lower(e), lower(d)) OR regexp_matches(e, '(?i){fv.PARK_TYPE_IN_NAME}') THEN e ELSE concat(e, ' ', d) END AS display,
      CASE WHEN n = '' OR regexp_matches(n, '(?i)\\bcampground\\s*$') THEN n ELSE concat(n, ' Campground') END AS suffixed FROM x""",
)
def display_names(spark, sf):
    t = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), pick(_NAMES, "c_custkey").alias("n"),
        F.expr("case c_custkey % 3 when 0 then 'State Park' when 1 then '' else 'Memorial' end").alias("d"),
    )
    return t.select(
        "id", text.expand_designation("n").alias("expanded"),
        text.park_display_name("n", "d", fv.PARK_TYPE_IN_NAME).alias("display"), text.with_campground_suffix("n").alias("suffixed"),
    )


@query(
    "stable_ids",
    f"""WITH {CAMPS} SELECT id,
      concat('PG-US-', CASE WHEN nation % 3 = 0 THEN 'XX' ELSE concat('S', nation) END, '-', {slug_sql('name')}, '-', id) AS poi_id,
      concat('AMEN-NPS-', upper(land_manager), '-campground-', type, '-', {slug_sql('name')}, '-', CAST(CAST(floor(lat * 10000 + 0.5) AS BIGINT) AS VARCHAR), '-', CAST(CAST(floor(abs(lon) * 10000 + 0.5) AS BIGINT) AS VARCHAR)) AS amenity_id,
      concat('VC-NPS-', upper(land_manager), '-', {slug_sql('name')}, '-', CAST(CAST(floor(lat * 10000 + 0.5) AS BIGINT) AS VARCHAR), '-', CAST(CAST(floor(abs(lon) * 10000 + 0.5) AS BIGINT) AS VARCHAR)) AS center_id,
      concat('sp-us-', lower(land_manager), '-', {slug_sql('name')}, '-way', id) AS park_id FROM camps""",
)
def stable_ids(spark, sf):
    c = camps(spark, sf)
    state = F.when(F.col("nation") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("S"), F.col("nation").cast("string")))
    return c.select(
        "id",
        text.poi_id("PG", "US", state, "name", "id").alias("poi_id"),
        text.amenity_id("NPS", "land_manager", F.lit("campground"), "type", "name", "lat", "lon").alias("amenity_id"),
        text.visitor_center_id("land_manager", "name", "lat", "lon").alias("center_id"),
        text.park_unit_id(F.lit("US"), "land_manager", "name", F.lit("way"), "id").alias("park_id"),
    )


_CODES = ["BNP-TML-C12", "JNP-POC", "JNP-WAB3", "bnp-lake-a1", "X1-abc", "SOLO", "", "PRNP-GLEN-MOR-B", "PRNP-GLEN-12A", "GNP-ILL-AB123"]


@query(
    "pitch_codes",
    f"""WITH t AS (SELECT c_custkey AS id, upper({pick_sql(_CODES, 'c_custkey')}) AS raw FROM customer), p AS (SELECT *, list_filter(string_split(raw, '-'), lambda x: x <> '') AS parts FROM t),
    q AS (SELECT *, len(parts) AS n, parts[len(parts)] AS last, regexp_replace(parts[2], '[0-9]+$', '') AS stem FROM p)
    SELECT id, CASE WHEN raw = '' THEN '' WHEN n < 2 OR NOT regexp_matches(parts[1], '^[A-Z]{{2,5}}$') THEN raw
      WHEN n = 2 THEN CASE WHEN stem <> parts[2] AND regexp_matches(stem, '^[A-Z]{{2,5}}$') THEN concat(parts[1], '-', stem) ELSE raw END
      WHEN regexp_matches(last, '^C[0-9]+$') OR regexp_matches(last, '^[A-Z]{{1,2}}[0-9]+$') OR (regexp_matches(last, '^[A-Z0-9]{{1,5}}$') AND regexp_matches(last, '[0-9]')) OR regexp_matches(last, '^[A-Z]{{1,3}}[0-9]{{1,2}}[A-Z]?$')
      THEN array_to_string(parts[1:n - 1], '-') ELSE raw END AS code FROM q""",
)
def pitch_codes(spark, sf):
    t = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), pick(_CODES, "c_custkey").alias("raw"))
    return t.select("id", text.pitch_campground_code("raw").alias("code"))


@query(
    "page_url_parts",
    """SELECT page_id AS id, coalesce(list_filter(string_split(regexp_replace(regexp_replace(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*', ''), '[?#].*$', ''), '/'), lambda x: x <> '')[1], '') AS first_part,
      coalesce(list_filter(string_split(regexp_replace(regexp_replace(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*', ''), '[?#].*$', ''), '/'), lambda x: x <> '')[2], '') AS second_part FROM pages""",
)
def page_url_parts(spark, sf):
    return table(spark, sf, "pages").select(
        F.col("page_id").alias("id"), F.coalesce(text.url_path_part("url", 0), F.lit("")).alias("first_part"),
        F.coalesce(text.url_path_part("url", 1), F.lit("")).alias("second_part"),
    )


@query(
    "name_templates",
    """SELECT p_partkey AS id, trim(regexp_replace(replace(replace(replace(CASE p_partkey % 3 WHEN 0 THEN '{name} {type}' WHEN 1 THEN '{unit} - {name}' ELSE ' {type}  Site' END, '{name}', p_name), '{unit}', p_brand), '{type}', p_type), '\\s+', ' ', 'g')) AS name FROM part""",
)
def name_templates(spark, sf):
    t = F.expr("case p_partkey % 3 when 0 then '{name} {type}' when 1 then '{unit} - {name}' else ' {type}  Site' end")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        text.fill_template(t, {"name": F.col("p_name"), "unit": F.col("p_brand"), "type": F.col("p_type")}).alias("name"),
    )


_DAYS = fv.WEEKDAYS


@query(
    "hours_summary",
    """WITH t AS (SELECT c_custkey AS id, list_transform(range(0, 7), lambda d: CASE (c_custkey + CASE WHEN d > 4 THEN 1 ELSE 0 END) % 4 WHEN 0 THEN '9AM-5PM' WHEN 1 THEN 'Closed' WHEN 2 THEN '' ELSE '8AM-4PM' END) AS h,
      CASE WHEN c_custkey % 3 = 0 THEN ['Winter: Closed', 'Holiday'] WHEN c_custkey % 3 = 1 THEN ['2024-01-01–2024-02-01: 10AM'] ELSE [] END AS notes FROM customer),
    u AS (SELECT id, list_filter(h, lambda x: x <> '') AS f, notes FROM t),
    s AS (SELECT id, array_to_string(CASE WHEN len(f) = 0 THEN [] WHEN len(list_distinct(f)) = 1 THEN [f[1]] ELSE [f[1], f[len(f)]] END, '; ') AS summary, array_to_string(notes, ' | ') AS note FROM u)
    SELECT id, CASE WHEN summary <> '' OR note <> '' THEN 1 ELSE 0 END AS has_hours, summary, note FROM s""",
)
def hours_summary(spark, sf):
    value = "case (c_custkey + {}) % 4 when 0 then '9AM-5PM' when 1 then 'Closed' when 2 then '' else '8AM-4PM' end"
    std = F.create_map(*[x for i, d in enumerate(_DAYS) for x in (F.lit(d), F.expr(value.format(1 if i > 4 else 0)))])
    ex = F.expr(
        """case c_custkey % 3 when 0 then array(named_struct('name', 'Winter', 'start_date', '', 'end_date', '', 'hours', map('monday', 'Closed')),
             named_struct('name', 'Holiday', 'start_date', '', 'end_date', '', 'hours', cast(map() as map<string,string>)))
           when 1 then array(named_struct('name', '', 'start_date', '2024-01-01', 'end_date', '2024-02-01', 'hours', map('monday', '10AM')))
           else cast(array() as array<struct<name:string,start_date:string,end_date:string,hours:map<string,string>>>) end"""
    )
    t = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), std.alias("standard_hours"), ex.alias("exceptions"))
    return t.withColumn("s", text.hours_summary()).select(
        "id", F.col("s.has_hours").cast("int").alias("has_hours"), F.col("s.summary").alias("summary"), F.col("s.seasonal_note").alias("note")
    )


@query(
    "season_flags",
    """WITH t AS (SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 'Yes' WHEN 'O' THEN 'No' ELSE '' END AS f, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE ' ' END AS d FROM orders)
    SELECT id, CASE WHEN f = 'Yes' THEN 1 WHEN f = 'No' THEN 0 WHEN trim(d) <> '' THEN 1 END AS seasonal,
      CASE WHEN trim(d) <> '' THEN trim(d) WHEN f = 'Yes' THEN 'Seasonal operation' WHEN f = 'No' THEN 'Year-round' ELSE '' END AS description FROM t""",
)
def season_flags(spark, sf):
    t = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        text.season(
            F.expr("case o_orderstatus when 'F' then 'Yes' when 'O' then 'No' else '' end"),
            F.expr("if(o_orderkey % 2 = 0, o_orderpriority, ' ')"),
        ).alias("s"),
    )
    return t.select("id", F.col("s.is_seasonal").cast("int").alias("seasonal"), F.col("s.description").alias("description"))


# ---- R1 - R4, P20 -----------------------------------------------------------------------------------

CATALOGUE = [
    {"id": "bolt_stop", "display_name": "Blue Bolt", "type": "travel_center", "strict": True, "brand": ["Brand#1"], "operator": ["promo"], "name_contains": ["hot bolt"]},
    {"id": "ringway", "display_name": "Old Ring", "type": "convenience_fuel", "strict": False, "brand": ["Brand#24"], "operator": [], "name_contains": ["rod"]},
    {"id": "flyingj", "display_name": "Flying J", "type": "travel_plaza", "strict": True, "brand": ["Flying J"], "operator": [], "name_contains": ["flying j travel"]},
    {"id": "gearbox", "display_name": "Gear", "type": "travel_plaza", "strict": False, "brand": [], "operator": ["economy"], "name_contains": ["red gear", "gizmo"]},
    {"id": "pilot", "display_name": "Pilot", "type": "travel_plaza", "strict": True, "brand": ["Pilot", "Pilot Travel Centers"], "operator": [], "name_contains": ["pilot travel"]},
]
_STORE_NAMES = ["Pilot", "Pilot Travel Center", "Flying J", "Flying J Travel Plaza", "Shell Pilot", "Pilot Dealer", "Hot Bolt", "Gizmo Inn"]
_STORE_BRANDS = ["", "Shell", "Pilot Travel Centers", "Flying J", "Petro", "Brand#1", "76"]
_STORE_OPS = ["", "Pilot Flying J", "Flying J Inc", "Economy Oil", "pilot"]


def _store_tags(spark, sf):
    p = table(spark, sf, "part")
    odd = F.expr("p_partkey % 2 = 1")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.when(odd, pick(_STORE_BRANDS, "p_partkey div 2")).otherwise(F.col("p_brand")).alias("brand"),
        F.when(odd, pick(_STORE_OPS, "p_partkey div 14")).otherwise(F.col("p_type")).alias("operator"),
        F.when(odd, pick(_STORE_NAMES, "p_partkey div 70")).otherwise(F.col("p_name")).alias("name"),
    )


_STORES = f"""raw AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 1 THEN {pick_sql(_STORE_BRANDS, 'p_partkey // 2')} ELSE p_brand END AS brand,
      CASE WHEN p_partkey % 2 = 1 THEN {pick_sql(_STORE_OPS, 'p_partkey // 14')} ELSE p_type END AS operator, CASE WHEN p_partkey % 2 = 1 THEN {pick_sql(_STORE_NAMES, 'p_partkey // 70')} ELSE p_name END AS name FROM part),
    st AS (SELECT id, {token_sql('brand')} AS b, {token_sql('operator')} AS o, {token_sql('name')} AS n FROM raw)"""
_CONFLICT = "(" + " OR ".join(f"b = '{r}' OR starts_with(b, '{r} ')" for r in fv.CONFLICTING_RETAIL) + ")"
_SISTER_RULES = [
    ("flyingj", "flyingj:brand=Flying J", "(b = 'flying j' OR contains(b, 'flying j'))"),
    ("flyingj", "flyingj:operator", "starts_with(o, 'flying j')"),
    ("flyingj", "flyingj:name", f"(starts_with(n, 'flying j') OR n = 'flyingj') AND NOT {_CONFLICT}"),
    ("flyingj", "flyingj:nameContains", f"contains(n, 'flying j travel') AND NOT {_CONFLICT}"),
    ("pilot", "pilot:brand=Pilot", "b = 'pilot'"),
    ("pilot", "pilot:brand=Pilot Travel Centers", "contains(b, 'pilot travel centers')"),
    ("pilot", "pilot:operator", "(o = 'pilot' OR starts_with(o, 'pilot ') OR contains(o, 'pilot travel') OR contains(o, 'pilot flying j'))"),
    ("pilot", "pilot:name", f"(n = 'pilot' OR starts_with(n, 'pilot ')) AND NOT {_CONFLICT} AND (b = '' OR contains(b, 'pilot'))"),
    ("pilot", "pilot:nameContains", f"contains(n, 'pilot travel') AND NOT {_CONFLICT}"),
]
_SISTER = " ".join(f"WHEN {c} THEN '{i}'" for i, _, c in _SISTER_RULES)
_CATALOGUE_SQL = """WHEN (b <> '' AND (contains(b, 'brand 1') OR contains('brand 1', b))) OR contains(o, 'promo') OR contains(n, 'hot bolt') THEN 'bolt_stop'
      WHEN n = 'old ring' OR (b <> '' AND (contains(b, 'brand 24') OR contains('brand 24', b))) OR n = 'rod' OR starts_with(n, 'rod ') OR contains(n, ' rod ') OR (b <> '' AND starts_with(n, 'old ring')) THEN 'ringway'
      WHEN n = 'gear' OR contains(o, 'economy') OR contains(n, 'red gear') OR contains(n, 'gizmo') OR (b <> '' AND starts_with(n, 'gear')) THEN 'gearbox'"""
_BRAND = f"CASE {_SISTER} {_CATALOGUE_SQL} END"


@query("brand_match_us", f"WITH {_STORES} SELECT id, {_BRAND} AS brand_id FROM st")
def brand_match_us(spark, sf):
    return brands.with_brand_us(_store_tags(spark, sf), "brand", "operator", "name", CATALOGUE).select("id", "brand_id")


@query(
    "sister_brand_reasons",
    f"""WITH {_STORES} SELECT id, array_to_string(list_filter([{', '.join(f"CASE WHEN {c} THEN '{r}' END" for _, r, c in _SISTER_RULES)}, CASE WHEN {_CONFLICT} THEN concat('conflict:brand=', b) END], lambda x: x IS NOT NULL), ', ') AS reasons FROM st""",
)
def sister_brand_reasons(spark, sf):
    t = _store_tags(spark, sf).select("id", *[brands.brand_token(c).alias(c) for c in ("brand", "operator", "name")])
    b, o, n = (F.col(c) for c in ("brand", "operator", "name"))
    return t.select("id", F.array_join(brands.explain_sister_brand(b, o, n, CATALOGUE), ", ").alias("reasons"))


CA_CATALOGUE = [
    {"id": "petro_pass"}, {"id": "onroute"}, {"id": "irving_bigstop"}, {"id": "husky_travel", "name_contains": ["husky travel"]},
    {"id": "pilot", "brand": ["Pilot"], "name_contains": ["pilot travel"]}, {"id": "flyingj", "brand": ["Flying J"], "name_contains": []},
    {"id": "couche_tard", "name_contains": ["couche tard"]}, {"id": "circle_k", "name_contains": ["circle k"]}, {"id": "macs", "name_contains": ["mac s"]},
]
_CA_NAMES = ["Petro-Canada", "Petro-Pass Truck Stop", "ONroute Innisfil", "Big Stop", "Husky", "Husky Travel Centre", "Pilot", "Circle K", "Couche-Tard", "Mac's", "Esso", "Irving Oil"]
_CA_BRANDS = ["", "Petro-Canada", "Irving", "Husky", "Circle K", "Macs", "Esso"]


@query(
    "brand_match_ca",
    f"""WITH raw AS (SELECT p_partkey AS id, {pick_sql(_CA_BRANDS, 'p_partkey')} AS brand, {pick_sql(_CA_NAMES, 'p_partkey // 7')} AS name FROM part),
    st AS (SELECT id, {token_sql('brand')} AS b, {token_sql('name')} AS n, {token_sql("concat_ws(' ', nullif(brand, ''), name)")} AS x FROM raw)
    SELECT id, CASE WHEN (contains(b, 'petro canada') OR n = 'petro canada') AND NOT regexp_matches(x, 'petro\\s*pass|petropass') THEN NULL
      WHEN (b = 'husky' OR n = 'husky') AND NOT (contains(n, 'esso') AND NOT contains(n, 'husky')) AND NOT contains(x, 'travel') AND NOT contains(x, 'truck') THEN NULL
      WHEN (contains(b, 'irving') OR contains(n, 'irving')) AND NOT contains(x, 'big stop') THEN NULL
      WHEN regexp_matches(x, 'petro[\\s-]*pass|petropass') THEN 'petro_pass' WHEN contains(n, 'onroute') OR contains(x, 'onroute') THEN 'onroute'
      WHEN contains(x, 'big stop') AND (contains(x, 'irving') OR contains(n, 'big stop')) THEN 'irving_bigstop'
      WHEN regexp_matches(x, 'husky travel|husky truck') THEN 'husky_travel'
      WHEN (n = 'pilot' OR starts_with(n, 'pilot ')) AND b = '' THEN 'pilot'
      WHEN contains(n, 'couche tard') THEN 'couche_tard' WHEN b = 'circle k' OR contains(b, 'circle k') OR contains(n, 'circle k') THEN 'circle_k'
      WHEN b = 'macs' THEN 'macs' END AS brand_id FROM st""",
)
def brand_match_ca(spark, sf):
    t = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), pick(_CA_BRANDS, "p_partkey").alias("brand"), pick(_CA_NAMES, "p_partkey div 7").alias("name")
    )
    blob = brands.search_blob("brand", "name")
    return t.select("id", brands.brand_id_ca("brand", F.lit(""), "name", blob, CA_CATALOGUE).alias("brand_id"))


_TYPE_TEXT = ["Loves Country Store", "Loves Travel Stop", "Speedco", "cardlock", "Pilot Travel Center", "Pilot Dealer", "fuel only", "CEFCO Kitchen", "CEFCO"]
_TYPE_BRANDS = ["loves", "pilot", "cefco", "other"]


def _typed(spark, sf):
    p = table(spark, sf, "part")
    return p.select(
        F.col("p_partkey").alias("id"), pick(_TYPE_BRANDS, "p_partkey").alias("brand_id"), pick(_TYPE_TEXT, "p_partkey div 4").alias("t"),
        F.expr("case p_size % 3 when 0 then 'travel_center' when 1 then 'convenience_fuel' else '' end").alias("prior"),
        F.expr("case p_partkey div 36 % 4 when 0 then 'https://x/pins/TravelStopPin.png' when 1 then 'https://x/speedcopin.png' else '' end").alias("pin"),
        F.expr("case p_partkey div 144 % 3 when 0 then true when 1 then false end").alias("full"),
    )


_TYPED = f"""t AS (SELECT p_partkey AS id, {pick_sql(_TYPE_BRANDS, 'p_partkey')} AS brand_id, {pick_sql(_TYPE_TEXT, 'p_partkey // 4')} AS t,
      CASE p_size % 3 WHEN 0 THEN 'travel_center' WHEN 1 THEN 'convenience_fuel' ELSE '' END AS prior,
      CASE p_partkey // 36 % 4 WHEN 0 THEN 'https://x/pins/TravelStopPin.png' WHEN 1 THEN 'https://x/speedcopin.png' ELSE '' END AS pin,
      CASE p_partkey // 144 % 3 WHEN 0 THEN true WHEN 1 THEN false END AS full_ FROM part),
    u AS (SELECT *, lower(t) AS x, CASE WHEN prior IN ('', 'travel_center') THEN 'travel_plaza' ELSE prior END AS p FROM t)"""


@query(
    "type_infer",
    f"""WITH {_TYPED} SELECT id, CASE brand_id
      WHEN 'loves' THEN CASE WHEN pin <> '' THEN CASE WHEN lower(regexp_extract(pin, '[^/]*$')) IN ('travelstoppin.png', 'travelstop2.png') THEN 'travel_plaza' ELSE 'convenience_fuel' END
        WHEN contains(x, 'country store') AND NOT regexp_matches(x, 'travel stop|travel center') THEN 'convenience_fuel' WHEN regexp_matches(x, 'travel stop|travel center') THEN 'travel_plaza' ELSE p END
      WHEN 'pilot' THEN CASE WHEN full_ IS NOT NULL THEN CASE WHEN full_ THEN 'travel_plaza' ELSE 'convenience_fuel' END WHEN regexp_matches(x, '\\bfuel only\\b|\\bcardlock\\b') THEN 'convenience_fuel'
        WHEN regexp_matches(x, '\\bdealer\\b') AND NOT regexp_matches(x, 'travel center|travel plaza') THEN 'convenience_fuel' WHEN regexp_matches(x, 'travel center|travel plaza|flying j travel') THEN 'travel_plaza' ELSE p END
      WHEN 'cefco' THEN CASE WHEN regexp_matches(x, 'cefco kitchen|cefco travel|travel center|travel plaza') OR p = 'travel_plaza' THEN 'travel_plaza' ELSE 'convenience_fuel' END
      ELSE 'convenience_fuel' END AS type FROM u""",
)
def type_infer(spark, sf):
    t = _typed(spark, sf)
    kind = brands.infer_fuel_type(F.col("brand_id"), F.col("prior"), F.lit("convenience_fuel"), F.col("t"), F.col("pin"), F.col("full"))
    return t.select("id", kind.alias("type"))


_SERVICE_SQL = """CASE brand_id WHEN 'loves' THEN lower(regexp_extract(pin, '[^/]*$')) = 'speedcopin.png' OR regexp_matches(x, '\\bspeedco\\b') OR (regexp_matches(x, '\\bcardlock\\b') AND NOT regexp_matches(x, 'travel stop|travel center|country store'))
      WHEN 'pilot' THEN NOT regexp_matches(x, '\\bfuel only\\b') AND NOT coalesce(full_, NOT regexp_matches(x, '\\b(one9|pilot|flying j)\\s+dealer\\b') AND NOT contains(x, 'fuel only') AND regexp_matches(x, 'travel center|travel plaza|flying j travel'))
        AND regexp_matches(x, '\\bdealer\\b') AND NOT regexp_matches(x, 'travel center|travel plaza') ELSE false END"""


@query(
    "service_split",
    f"""WITH {_TYPED}, j AS (SELECT brand_id, {_SERVICE_SQL} AS s FROM u) SELECT brand_id, CASE WHEN s THEN 'service' ELSE 'fuel' END AS part, count(*) AS n FROM j GROUP BY ALL""",
)
def service_split(spark, sf):
    test = brands.non_fuel_service(F.col("brand_id"), F.col("t"), F.col("pin"), F.col("t"), None, F.col("full"))
    kept, dropped = fuel_plans.split_services(_typed(spark, sf), test)
    both = kept.select("brand_id", F.lit("fuel").alias("part")).unionByName(dropped.select("brand_id", F.lit("service").alias("part")))
    return both.groupBy("brand_id", "part").agg(F.count(F.lit(1)).alias("n"))


@query(
    "station_structs",
    """WITH t AS (SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 'no' WHEN 1 THEN 'yes' END AS gas, CASE p_size % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' END AS diesel, CASE WHEN p_size % 5 = 0 THEN 'customers' END AS wc, CASE p_partkey % 2 WHEN 0 THEN 'travel_plaza' ELSE 'convenience_fuel' END AS kind FROM part)
    SELECT id, CASE WHEN gas = 'no' THEN 0 ELSE 1 END AS gasoline, CASE WHEN diesel = 'yes' THEN 1 ELSE 0 END AS diesel, coalesce(wc, CASE WHEN kind = 'travel_plaza' THEN 'assumed' ELSE 'unknown' END) AS restroom, CASE WHEN kind = 'travel_plaza' THEN 'common' ELSE 'unknown' END AS showers FROM t""",
)
def station_structs(spark, sf):
    t = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.create_map(
            F.lit("fuel:gasoline"), F.expr("case p_partkey % 4 when 0 then 'no' when 1 then 'yes' end"),
            F.lit("fuel:diesel"), F.expr("case p_size % 3 when 0 then 'yes' when 1 then 'no' end"),
            F.lit("toilets"), F.expr("if(p_size % 5 = 0, 'customers', null)"),
        ).alias("tags"),
        F.expr("if(p_partkey % 2 = 0, 'travel_plaza', 'convenience_fuel')").alias("kind"),
    )
    t = t.withColumn("f", tags.fuels()).withColumn("a", tags.station_amenities(F.col("kind")))
    return t.select(
        "id", F.col("f.gasoline").cast("int").alias("gasoline"), F.col("f.diesel").cast("int").alias("diesel"),
        F.col("a.restroom").alias("restroom"), F.col("a.showers").alias("showers"),
    )


@query(
    "fuel_search",
    f"""WITH raw AS (SELECT p_partkey AS id, {token_sql("concat_ws(' ', nullif(p_brand, ''), p_type, p_name)")} AS blob FROM part) SELECT id, blob FROM raw WHERE contains(blob, 'red gear')""",
)
def fuel_search(spark, sf):
    rows = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), brands.search_blob("p_brand", "p_type", "p_name").alias("search_blob")
    )
    return fuel_plans.search(rows, "Red GEAR!", "id").select("id", F.col("search_blob").alias("blob"))


@query(
    "explorer_search",
    f"""WITH {CAMPS} SELECT id FROM camps WHERE concat('S', nation) = 'S7' AND contains(lower(concat_ws(' ', CAST(id AS VARCHAR), name, land_manager, type)), 'lake')""",
)
def explorer_search(spark, sf):
    rows = camps(spark, sf).withColumn("state", F.concat(F.lit("S"), F.col("nation").cast("string")))
    return pois.search(rows, ["id", "name", "land_manager", "type"], " Lake", "S7").select("id")


@query(
    "boundary_state_lists",
    """SELECT o_orderkey AS id FROM orders WHERE list_contains(list_transform(string_split_regex(CASE o_orderkey % 3 WHEN 0 THEN 'CO, UT' WHEN 1 THEN 'UT;AZ' ELSE 'AZ' END, '[,;]'), lambda x: trim(x)), 'UT')""",
)
def boundary_state_lists(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.expr("case o_orderkey % 3 when 0 then 'CO, UT' when 1 then 'UT;AZ' else 'AZ' end").alias("state")
    )
    return pois.boundary_in_state(rows, "UT").select("id")


# ---- P10 - P14, F12 - F16, R18 ----------------------------------------------------------------------

_GENERIC = "(trim(name) = '' OR regexp_matches(trim(name), '(?i)^OSM\\s+(node|way|relation)\\b|^(node|way|relation)\\s+\\d+$|^unnamed\\b'))"
_NUMERIC = "regexp_matches(trim(name), '^#?[0-9]{1,4}$')"
_SITE = "regexp_matches(trim(name), '(?i)^(site|plot|pitch|walk-in|group|loop)\\s+[a-z0-9.\\-]+$|^.+\\s+#\\d+$')"
_GOOD = f"(length(trim(name)) >= 4 AND NOT {_GENERIC} AND NOT {_NUMERIC})"


@query(
    "name_quality",
    f"WITH {CAMPS} SELECT id, CAST({_GENERIC} AS INTEGER) AS generic, CAST({_NUMERIC} AS INTEGER) AS numeric_only, CAST({_SITE} AS INTEGER) AS site, CAST({_GOOD} AS INTEGER) AS good FROM camps",
)
def name_quality(spark, sf):
    return camps(spark, sf).select(
        "id", camping.generic_name("name").cast("int").alias("generic"), camping.numeric_name("name").cast("int").alias("numeric_only"),
        camping.site_label("name").cast("int").alias("site"), camping.human_name("name").cast("int").alias("good"),
    )


_FED = "ingest_source IN ('01-nps-poi', '02-usfs-recreation', '04-ridb')"
_KNOWN = "land_manager IN ('NPS', 'USFS', 'BLM', 'State', 'COE', 'USFWS', 'County', 'City')"
ROADS = "rows_ AS (SELECT *, CASE WHEN id % 3 = 0 THEN NULL WHEN id % 11 = 0 THEN 999999 ELSE CAST(id * 37 % 1600 AS DOUBLE) END AS d FROM camps)"
_ROAD_TIER = f"""CASE WHEN d IS NULL THEN CASE WHEN type = 'developed' AND {_GOOD} AND NOT {_FED} THEN 'default' WHEN {_FED} OR ingest_source = '03-osm' THEN 'qa' ELSE 'default' END
      WHEN d <= 800 THEN 'default' WHEN d <= 1200 THEN 'qa' ELSE 'excluded' END"""
DISPLAY_TIER = f"""CASE WHEN type = 'dispersed' OR {_GENERIC} THEN 'excluded' WHEN NOT {_GOOD} AND NOT {_FED} AND ({_NUMERIC} OR {_SITE}) THEN 'excluded' ELSE {_ROAD_TIER} END"""
REASON = f"""CASE WHEN type = 'dispersed' THEN 'dispersed' WHEN {_GENERIC} THEN 'generic-osm-name' WHEN NOT {_GOOD} AND NOT {_FED} AND ({_NUMERIC} OR {_SITE}) THEN 'vague-name' WHEN {_ROAD_TIER} = 'excluded' THEN 'no-road-access' END"""


def camp_rows(spark, sf):
    return (
        camps(spark, sf)
        .withColumn("road_distance_m", F.expr("case when id % 3 = 0 then null when id % 11 = 0 then 999999D else cast(id * 37 % 1600 as double) end"))
        .withColumn("map_flags", F.array().cast("array<string>"))
        .withColumn("is_placeholder", F.lit(False))
        .withColumn("coord_confidence", F.lit("medium"))
        .withColumn("osm_type", F.lit("node"))
    )


@query("road_tier", f"WITH {CAMPS}, {ROADS} SELECT id, {_ROAD_TIER} AS tier FROM rows_")
def road_tier(spark, sf):
    return camp_rows(spark, sf).select("id", camping.road_tier(camping.FilterConfig())["tier"].alias("tier"))


@query(
    "display_tier",
    f"WITH {CAMPS}, {ROADS}, t AS (SELECT {DISPLAY_TIER} AS tier, {REASON} AS reason FROM rows_) SELECT tier, reason, count(*) AS n FROM t GROUP BY ALL",
)
def display_tier(spark, sf):
    rows = camp_rows(spark, sf).withColumn("cluster_role", F.lit(None).cast("string"))
    rows = rows.withColumn("t", camping.display_tier(camping.FilterConfig()))
    return rows.groupBy(F.col("t.tier").alias("tier"), F.col("t.reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "keep_score",
    f"""WITH {CAMPS} SELECT id, CASE WHEN {_FED} THEN 1000 ELSE 0 END + CASE WHEN {_GOOD} THEN 200 WHEN NOT {_GENERIC} AND NOT {_NUMERIC} THEN 50 ELSE 0 END + 40
      + CASE WHEN {_GOOD} THEN 10 ELSE 0 END + CASE WHEN {_KNOWN} THEN 25 ELSE 0 END - CASE WHEN {_SITE} THEN 30 ELSE 0 END - CASE WHEN {_GENERIC} THEN 500 ELSE 0 END AS score FROM camps""",
)
def keep_score(spark, sf):
    return camp_rows(spark, sf).select("id", camping.keep_score().alias("score"))


@query(
    "embed_eligibility",
    f"""WITH {CAMPS}, {ROADS}, t AS (SELECT *, {DISPLAY_TIER} AS tier FROM rows_) SELECT count(*) AS n, CAST(sum(CASE WHEN tier = 'default' AND type <> 'dispersed' THEN 1 ELSE 0 END) AS BIGINT) AS in_default,
      CAST(sum(CASE WHEN tier = 'qa' THEN 1 ELSE 0 END) AS BIGINT) AS in_qa, CAST(sum(CASE WHEN type <> 'dispersed' THEN 1 ELSE 0 END) AS BIGINT) AS legacy FROM t""",
)
def embed_eligibility(spark, sf):
    config = camping.FilterConfig()
    rows = camp_rows(spark, sf).withColumn("cluster_role", F.lit(None).cast("string"))
    rows = rows.withColumn("display_tier", camping.display_tier(config)["tier"])
    return rows.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(camping.in_default_embed(config)).alias("in_default"),
        F.count_if(camping.in_qa_embed(config)).alias("in_qa"),
        F.count_if(camping.in_default_embed(camping.FilterConfig(enabled=False))).alias("legacy"),
    )


_OPERATORS = ["National Park Service", "US Forest Service", "BLM Utah", "KOA", "State Parks", "County of Ash", "City of Elm", "", "BC Parks", "Private camp"]
_CAMP_NAMES = ["Ash KOA", "Elk RV Park", "National Forest Camp", "Blue Lake", "Pine Resort", "Parc national Camp"]


def _camp_tags(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.create_map(
            F.lit("operator"), pick(_OPERATORS, "c_custkey"), F.lit("name"), pick(_CAMP_NAMES, "c_custkey div 10"),
            F.lit("fee"), F.expr("case c_custkey % 4 when 0 then 'no' when 1 then 'yes' else '' end"),
            F.lit("camp_site"), F.expr("case c_custkey % 7 when 0 then 'dispersed' when 1 then 'primitive' when 2 then 'deluxe' else '' end"),
        ).alias("tags"),
    )


_CAMP_TAGS = f"""t AS (SELECT c_custkey AS id, {pick_sql(_OPERATORS, 'c_custkey')} AS op, {pick_sql(_CAMP_NAMES, 'c_custkey // 10')} AS name,
      CASE c_custkey % 4 WHEN 0 THEN 'no' WHEN 1 THEN 'yes' ELSE '' END AS fee, CASE c_custkey % 7 WHEN 0 THEN 'dispersed' WHEN 1 THEN 'primitive' WHEN 2 THEN 'deluxe' ELSE '' END AS site FROM customer)"""


@query(
    "camp_tag_inference",
    f"""WITH {_CAMP_TAGS} SELECT id, CASE WHEN regexp_matches(op, '(?i)national park|nps') THEN 'NPS' WHEN regexp_matches(op, '(?i)forest service|usfs') THEN 'USFS' WHEN regexp_matches(op, '(?i)bureau of land|blm') THEN 'BLM'
      WHEN regexp_matches(op, '(?i)state park') THEN 'State' WHEN regexp_matches(op, '(?i)county') THEN 'County' WHEN regexp_matches(op, '(?i)city of|municipal') THEN 'City' WHEN regexp_matches(name, '(?i)national forest') THEN 'USFS' ELSE 'Unknown' END AS manager,
      CASE WHEN fee = 'no' THEN 'free' WHEN fee = 'yes' THEN 'fee' WHEN site = 'dispersed' THEN 'free' ELSE 'unknown' END AS cost,
      CAST(regexp_matches(concat_ws(' ', name, nullif(op, '')), '(?i)\\bkoa\\b|\\brv park\\b') AS INTEGER) AS commercial,
      CASE WHEN site = 'dispersed' THEN 'backcountry' WHEN site = 'primitive' THEN 'primitive' ELSE 'developed' END AS tier FROM t""",
)
def camp_tag_inference(spark, sf):
    return _camp_tags(spark, sf).select(
        "id", tags.land_manager_us().alias("manager"), tags.camp_cost().alias("cost"),
        tags.commercial(tags.tag("name"), tags.tag("operator"), tags.tag("brand")).cast("int").alias("commercial"),
        tags.camp_tier().alias("tier"),
    )


@query(
    "camp_tag_inference_ca",
    f"""WITH {_CAMP_TAGS}, b AS (SELECT *, concat_ws(' ', nullif(op, ''), name) AS blob FROM t)
    SELECT id, CASE WHEN regexp_matches(blob, '(?i)bc parks') THEN 'Provincial' WHEN regexp_matches(name, '(?i)parc national') THEN 'Parks Canada' ELSE 'Unknown' END AS manager,
      CAST(regexp_matches(blob, '(?i)\\bkoa\\b|\\brv park\\b') OR (NOT regexp_matches(blob, '(?i)bc parks') AND (regexp_matches(name, '(?i)\\bresort\\b') OR (regexp_matches(blob, '(?i)\\bprivate\\b') AND regexp_matches(blob, '(?i)\\bcamp')))) AS INTEGER) AS private FROM b""",
)
def camp_tag_inference_ca(spark, sf):
    return _camp_tags(spark, sf).select(
        "id", tags.land_manager_ca().alias("manager"), tags.private_campground_ca(tags.tag("name")).cast("int").alias("private")
    )


_AGENCIES = ["National Park Service", "USDA Forest Service", "Bureau of Land Management", "US Army Corps of Engineers", "Other"]


@query(
    "agency_managers",
    f"""WITH t AS (SELECT s_suppkey AS id, {pick_sql(_AGENCIES, 's_suppkey')} AS a FROM supplier) SELECT id, CASE WHEN contains(upper(a), 'NATIONAL PARK') THEN 'NPS' WHEN contains(upper(a), 'FOREST') THEN 'USFS' WHEN contains(upper(a), 'LAND MANAGEMENT') THEN 'BLM' WHEN contains(upper(a), 'CORPS') THEN 'COE' ELSE 'Federal' END AS manager FROM t""",
)
def agency_managers(spark, sf):
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), tags.land_manager_of_agency(pick(_AGENCIES, "s_suppkey")).alias("manager")
    )


_PARK_NAMES = [
    "Blue Lake State Park", "Ash National Forest", "Fort Oak State Historic Site", "Elm County Park", "Pine State Memorial", "Cedar Preserve",
    "Grand State Historical Park", "Lac Parc provincial", "Moss Provincial Historic Site", "Bay Wildlife Area", "", "Old Mill SHP",
]


def _park_rows(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), pick(_PARK_NAMES, "c_custkey").alias("name"),
        F.expr("if(c_custkey % 5 < 3, 'US', 'CA')").alias("country"),
        F.expr("case c_custkey % 3 when 0 then 'official' else 'osm' end").alias("source"),
        F.expr("case c_custkey div 12 % 3 when 0 then 'operator' when 1 then 'protection_title' else 'name' end").alias("osm_confidence"),
        F.expr("c_nationkey % 2 = 0").alias("verified"),
    )


_PARKS = f"""p AS (SELECT c_custkey AS id, {pick_sql(_PARK_NAMES, 'c_custkey')} AS name, CASE WHEN c_custkey % 5 < 3 THEN 'US' ELSE 'CA' END AS country, CASE c_custkey % 3 WHEN 0 THEN 'official' ELSE 'osm' END AS source,
      CASE c_custkey // 12 % 3 WHEN 0 THEN 'operator' WHEN 1 THEN 'protection_title' ELSE 'name' END AS conf, c_nationkey % 2 = 0 AS verified FROM customer)"""
_US_OUT = f"regexp_matches(name, '(?i){fv.US_NAME_EXCLUDED}')"
_CA_OUT = f"regexp_matches(name, '(?i){fv.CA_NAME_EXCLUDED}')"
_US_IN = f"regexp_matches(name, '(?i){fv.US_NAME_INCLUDED}')"
_CA_IN = f"regexp_matches(name, '(?i){fv.CA_NAME_INCLUDED}')"


@query(
    "park_reject_reason",
    f"""WITH {_PARKS} SELECT id, CASE WHEN name = '' THEN 'missing-name' WHEN country = 'CA' AND {_CA_OUT} THEN 'excluded-name-ca' WHEN country = 'US' AND {_US_OUT} THEN 'excluded-name-us'
      WHEN source = 'osm' AND conf = 'operator' THEN 'osm-operator-guess'
      WHEN source = 'osm' AND verified AND conf <> 'protection_title' AND NOT CASE WHEN country = 'CA' THEN {_CA_IN} OR regexp_matches(name, '(?i)\\b(historic|heritage|historique|memorial|monument)\\b') ELSE {_US_IN} OR regexp_matches(name, '(?i)\\b(historic|heritage|memorial|monument)\\b') END THEN 'osm-no-explicit-name' END AS reason FROM p""",
)
def park_reject_reason(spark, sf):
    return _park_rows(spark, sf).select("id", parks.reject_reason(verified_admin="verified").alias("reason"))


@query(
    "state_park_classify",
    f"""WITH {_PARKS}, u AS (SELECT * FROM p WHERE country = 'US') SELECT id, CASE WHEN {_US_IN} THEN CASE WHEN regexp_matches(name, '(?i)historic|heritage|memorial|historical') THEN 'historic_site' ELSE 'park' END END AS category,
      CASE WHEN {_US_IN} THEN CASE WHEN regexp_matches(name, '(?i)state historical park') THEN 'State Historical Park' WHEN regexp_matches(name, '(?i)state memorial') THEN 'State Memorial' WHEN regexp_matches(name, '(?i)historic|heritage|memorial') THEN 'State Historic Site' ELSE 'State Park' END END AS designation
    FROM u WHERE NOT ({_US_OUT} AND NOT regexp_matches(name, '(?i)historic')) OR NOT {_US_IN}""",
)
def state_park_classify(spark, sf):
    rows = _park_rows(spark, sf).where("country = 'US'").withColumn("tags", F.create_map(F.lit("name"), F.col("name")))
    return rows.withColumn("c", parks.classify_unit("US")).select("id", F.col("c.category").alias("category"), F.col("c.designation").alias("designation"))


@query(
    "official_name_classify",
    f"""WITH {_PARKS}, x AS (SELECT *, regexp_matches(name, '(?i){fv.HISTORIC_NAME}') AS h FROM p),
    y AS (SELECT *, name = '' OR (CASE WHEN country = 'CA' THEN {_CA_OUT} ELSE {_US_OUT} END AND NOT h) AS refused FROM x)
    SELECT id, CASE WHEN refused THEN NULL WHEN regexp_matches(name, '\\sSHP$') OR h THEN 'historic_site' ELSE 'park' END AS trusted,
      CASE WHEN refused THEN NULL WHEN NOT (regexp_matches(name, '(?i){fv.STATE_PARK_NAME}') OR h OR regexp_matches(name, '(?i)\\bpark\\b|\\bsite\\b|\\bpreserve\\b|\\bmemorial\\b')) THEN NULL
        WHEN h THEN CASE WHEN country = 'CA' THEN 'Provincial Historic Site' ELSE 'State Historic Site' END WHEN regexp_matches(name, '(?i)state historical park') THEN 'State Historical Park' WHEN country = 'CA' THEN 'Provincial Park' ELSE 'State Park' END AS designation FROM y""",
)
def official_name_classify(spark, sf):
    rows = _park_rows(spark, sf)
    return rows.select(
        "id", parks.classify_official_name("name", "country", True)["category"].alias("trusted"),
        parks.classify_official_name("name", "country")["designation"].alias("designation"),
    )


_DESIGNATIONS = [
    "National Park", "National Historical Park", "National Park and Preserve", "National Monument", "National Seashore", "National Preserve",
    "National Battlefield", "National Scenic Trail", "Park", "Affiliated Area", "National Historic Site", "Wild River", "Other",
]


@query(
    "designation_category",
    f"""WITH t AS (SELECT o_orderkey AS id, {pick_sql(_DESIGNATIONS, 'o_orderkey')} AS d FROM orders)
    SELECT id, CASE d WHEN 'National Park' THEN 'park' WHEN 'National Historical Park' THEN 'historic_park' WHEN 'National Park and Preserve' THEN 'park' WHEN 'National Monument' THEN 'monument' WHEN 'National Seashore' THEN 'recreation'
      WHEN 'National Preserve' THEN 'preserve' WHEN 'National Battlefield' THEN 'historic_site' WHEN 'National Scenic Trail' THEN 'parkway_trail' WHEN 'Affiliated Area' THEN 'affiliated' WHEN 'National Historic Site' THEN 'historic_site' WHEN 'Wild River' THEN 'recreation' ELSE 'other' END AS federal,
      CASE d WHEN 'National Park' THEN 'park' WHEN 'National Historical Park' THEN 'historic_park' WHEN 'National Park and Preserve' THEN 'park' WHEN 'National Monument' THEN 'monument' WHEN 'National Seashore' THEN 'recreation'
      WHEN 'National Preserve' THEN 'preserve' WHEN 'National Battlefield' THEN 'historic_site' WHEN 'National Scenic Trail' THEN 'parkway_trail' WHEN 'National Historic Site' THEN 'historic_site' WHEN 'Wild River' THEN 'recreation' ELSE 'other' END AS boundary,
      CASE d WHEN 'National Park' THEN 'park' WHEN 'National Park and Preserve' THEN 'park' WHEN 'National Historic Site' THEN 'historic_site' ELSE 'other' END AS canadian,
      CASE d WHEN 'National Park' THEN 100 WHEN 'National Park and Preserve' THEN 95 WHEN 'National Monument' THEN 90 WHEN 'National Historical Park' THEN 80 WHEN 'National Seashore' THEN 60 WHEN 'National Preserve' THEN 50 WHEN 'Park' THEN 10 ELSE 40 END AS rank FROM t""",
)
def designation_category(spark, sf):
    t = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), pick(_DESIGNATIONS, "o_orderkey").alias("d"))
    return t.select(
        "id", parks.federal_category("d").alias("federal"), parks.boundary_category("d").alias("boundary"),
        parks.canadian_category("d").alias("canadian"), parks.unit_type_rank("d").alias("rank"),
    )


_POI_TYPES = ["Campground", "RV Campground", "Backcountry Campsite", "Primitive Camping", "Camping", "Picnic Shelter", "Vault Toilet", "Showers", "Trailhead", ""]
_POI_NAMES = ["Pine Group", "Elk Walk-in", "Ash", "Wilderness Camp", "RV Loop", "primitive site"]


@query(
    "federal_amenity_types",
    f"""WITH t AS (SELECT l_orderkey AS id, l_linenumber AS line, {pick_sql(_POI_TYPES, 'l_partkey')} AS t, lower({pick_sql(_POI_NAMES, 'l_suppkey')}) AS n FROM lineitem),
    x AS (SELECT *, CASE WHEN t IN ('Campground', 'RV Campground') THEN 'developed' WHEN t = 'Backcountry Campsite' THEN 'backcountry' WHEN t = 'Primitive Camping' THEN 'primitive' END AS tier,
      CASE WHEN regexp_matches(n, 'backcountry|wilderness|walk.?in|dispersed') THEN 'backcountry' WHEN regexp_matches(n, 'primitive') THEN 'primitive' ELSE 'developed' END AS by_name FROM t),
    y AS (SELECT CASE WHEN tier IS NOT NULL OR t = 'Camping' THEN 'campground' WHEN t = 'Picnic Shelter' THEN 'picnic_area' WHEN t IN ('Vault Toilet', 'Showers') THEN 'restroom' END AS kind,
      CASE WHEN tier IS NOT NULL THEN tier WHEN t = 'Camping' THEN by_name END AS camp_tier,
      CASE WHEN tier IS NOT NULL THEN CASE WHEN contains(n, 'group') THEN 'group' WHEN contains(lower(t), 'rv') OR regexp_matches(n, '\\brv\\b') THEN 'rv' WHEN regexp_matches(n, 'walk.?in|backcountry|wilderness|dispersed') THEN 'walk_in' ELSE tier END
        WHEN t = 'Camping' THEN by_name WHEN t = 'Picnic Shelter' THEN 'shelter' WHEN t = 'Vault Toilet' THEN 'vault_toilet' WHEN t = 'Showers' THEN 'showers' END AS subtype FROM x)
    SELECT kind, camp_tier, subtype, count(*) AS n FROM y GROUP BY ALL""",
)
def federal_amenity_types(spark, sf):
    t = table(spark, sf, "lineitem").select(
        parks.federal_amenity_class(pick(_POI_TYPES, "l_partkey"), pick(_POI_NAMES, "l_suppkey")).alias("c")
    )
    return t.groupBy(
        F.col("c.kind").alias("kind"), F.col("c.camp_tier").alias("camp_tier"), F.col("c.subtype").alias("subtype")
    ).agg(F.count(F.lit(1)).alias("n"))


_FACILITIES = ["Picnic Shelter", "Day Use", "Comfort Station", "Campground Loop", "Boat Launch", "Shower house"]


@query(
    "facility_words",
    f"""WITH t AS (SELECT p_partkey AS id, lower(concat({pick_sql(_FACILITIES, 'p_partkey')}, ' ', p_name, ' ', p_type)) AS w FROM part) SELECT id, CASE WHEN contains(w, 'picnic') OR contains(w, 'day use') THEN 'picnic_area' WHEN contains(w, 'toilet') OR contains(w, 'comfort station') OR contains(w, 'shower') THEN 'restroom' WHEN contains(w, 'camp') THEN 'campground' END AS kind FROM t""",
)
def facility_words(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), parks.facility_kind(pick(_FACILITIES, "p_partkey"), "p_name", "p_type").alias("kind")
    )


@query(
    "poi_tier",
    f"""WITH t AS (SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 'Ruins' WHEN 1 THEN p_name WHEN 2 THEN '' ELSE ' Memorial ' END AS name FROM part) SELECT id, CASE WHEN lower(trim(name)) IN ('', 'ruins', 'memorial') THEN 'qa' ELSE 'default' END AS tier FROM t""",
)
def poi_tier(spark, sf):
    name = F.expr("case p_partkey % 4 when 0 then 'Ruins' when 1 then p_name when 2 then '' else ' Memorial ' end")
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), tags.poi_tier(name, "historic").alias("tier"))


@query(
    "review_flags",
    """WITH t AS (SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN ['SUPPLEMENT', 'SUPPLEMENT'] WHEN 1 THEN ['NO_STATE', 'SUPPLEMENT'] WHEN 2 THEN CAST([] AS VARCHAR[]) ELSE ['PILOT_FJ_CLUSTER'] END AS f, CASE WHEN o_orderstatus = 'P' THEN ['x'] ELSE CAST([] AS VARCHAR[]) END AS r FROM orders)
    SELECT id, CASE WHEN id % 4 = 0 THEN 'SUPPLEMENT' ELSE array_to_string(f, ',') END AS flags, CASE WHEN len(r) > 0 OR id % 4 = 1 THEN 1 ELSE 0 END AS review FROM t""",
)
def review_flags(spark, sf):
    from waymark.operators.qa import repair_flags

    t = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.expr("case o_orderkey % 4 when 0 then array('SUPPLEMENT', 'SUPPLEMENT') when 1 then array('NO_STATE', 'SUPPLEMENT') when 2 then cast(array() as array<string>) else array('PILOT_FJ_CLUSTER') end").alias("map_flags"),
        F.expr("if(o_orderstatus = 'P', array('x'), cast(array() as array<string>))").alias("review_reasons"),
    )
    return repair_flags(t).select("id", F.array_join("map_flags", ",").alias("flags"), F.col("needs_review").cast("int").alias("review"))


_TITLES = [
    "Blue Lake State Park &amp; Historic Site — Texas Parks", "Ash Visitor Center", "Elm State Natural Area", "Fort Oak Historic Site", "Moss Provincial Park", "Bay",
]


@query(
    "listing_classes",
    f"""WITH t AS (SELECT c_custkey AS id, c_custkey % 6 AS k FROM customer) SELECT id, ['park_and_historic', 'visitor_center', 'park', 'historic', 'park', 'park'][CAST(k AS INTEGER) + 1] AS kind,
      ['State Park & Historic Site', 'State Park', 'State Natural Area', 'State Historic Site', 'State Park', 'State Park'][CAST(k AS INTEGER) + 1] AS designation FROM t""",
)
def listing_classes(spark, sf):
    t = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), parks.listing_class(pick(_TITLES, "c_custkey")).alias("c"))
    return t.select("id", F.col("c.listing_kind").alias("kind"), F.col("c.designation").alias("designation"))


@query(
    "viewer_rows",
    f"""WITH {CAMPS}, {ROADS}, t AS (SELECT *, {DISPLAY_TIER} AS tier FROM rows_) SELECT id, {half('lat', 100000)} AS lat, {half('lon', 100000)} AS lon, CASE land_manager WHEN 'NPS' THEN 0 WHEN 'USFS' THEN 1 WHEN 'BLM' THEN 2 WHEN 'State' THEN 3 ELSE 8 END AS manager_code,
      CASE type WHEN 'dispersed' THEN 1 ELSE 0 END AS type_code, CASE tier WHEN 'default' THEN 0 WHEN 'qa' THEN 1 ELSE 2 END AS tier_code, 0 AS review, CASE WHEN d IS NULL THEN -1 ELSE CAST(floor(d + 0.5) AS INTEGER) END AS road_m FROM t""",
)
def viewer_rows(spark, sf):
    from waymark.sources.sinks import viewer_rows as to_rows

    rows = camp_rows(spark, sf).withColumn("cluster_role", F.lit(None).cast("string"))
    rows = rows.withColumn("display_tier", camping.display_tier(camping.FilterConfig())["tier"]).withColumn("needs_review", F.lit(False))
    return to_rows(rows)
