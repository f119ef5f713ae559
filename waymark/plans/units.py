"""Federal unit catalogues and boundaries, and the visitor-center layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark import fixed_values as fv
from waymark.functions import geo, parks
from waymark.functions.text import (
    add_absent,
    federal_park_slug,
    federal_place_key,
    first_filled,
    matches,
    names_similar,
    season,
    slugify,
    state_list,
    text,
    visitor_center_id,
    visitor_center_key,
)
from waymark.operators import matching, qa, spatial
from waymark.operators.ranking import best_per_key, first_per_key, first_seen

_TRAILING_DESIGNATION = (
    r"(?i)\s*national (park|monument|memorial|preserve|historical park|historic site|recreation area).*$"
)


def best_unit_rows(rows: DataFrame, code: str = "code", unit_type: str = "unit_type", seq: str = "seq") -> DataFrame:
    """One row per lower-case unit code: highest unit-type rank, earlier row on a tie."""
    named = rows.withColumn(code, F.lower(F.col(code))).where(text(code) != "")
    return best_per_key(named, [code], parks.unit_type_rank(unit_type), seq)


def without_subsidiary_preserves(rows: DataFrame) -> DataFrame:
    """Preserve rows whose park name also has a higher-ranked row of another code are dropped.

    Rows: code, unit_type, park_name. Per park name the two best codes are enough to decide.
    """
    ranked = rows.withColumn("_rank", parks.unit_type_rank("unit_type")).withColumn("_park", F.trim(text("park_name")))
    best = ranked.where("_park <> ''").groupBy("_park").agg(F.max("_rank").alias("_top"))
    subsidiary = (F.col("unit_type") == "National Preserve") & (F.col("_top") > F.col("_rank"))
    return (
        ranked.join(best, "_park", "left")
        .where(~F.coalesce(subsidiary, F.lit(False)))
        .drop("_rank", "_park", "_top")
    )


def consolidate_units(rows: DataFrame) -> DataFrame:
    """Boundary rows with the preserve codes of a park folded into the park's primary code.

    Rows: code, unit_type, park_name, seq. Adds primary_code.
    """
    best = best_per_key(
        rows.withColumn("code", F.lower("code")), ["code"], parks.boundary_type_rank("unit_type"), "seq"
    ).select("code", "unit_type", "seq", F.lower(F.trim(text("park_name"))).alias("_park"))
    named = best.where("_park <> ''").withColumn("_rank", parks.boundary_type_rank("unit_type"))
    primary = named.groupBy("_park").agg(
        F.min_by("code", F.struct(-F.col("_rank"), F.col("seq"))).alias("_primary"), F.count(F.lit(1)).alias("_codes")
    )
    folded = (
        named.join(primary, "_park")
        .where((F.col("_codes") > 1) & (F.col("unit_type") == "National Preserve") & (F.col("code") != F.col("_primary")))
        .select(F.col("code").alias("_sub"), "_primary")
    )
    lowered = rows.withColumn("code", F.lower("code"))
    return lowered.join(folded, lowered["code"] == folded["_sub"], "left").withColumn(
        "primary_code", F.coalesce("_primary", "code")
    ).drop("_sub", "_primary")


def unit_catalog(units: DataFrame, pins: DataFrame, listed: DataFrame, centroids: DataFrame, geometry: DataFrame) -> DataFrame:
    """Units with a coordinate by source priority: pin, park list, centroid, geometry; plus listed units.

    ``units``: code, name, unit_type, states; the others: code, lat, lon, and for ``listed`` also
    name, designation, states. Units without a known state or coordinate are left out.
    """
    def at(df: DataFrame, p: str) -> DataFrame:
        unique = first_seen(df.withColumn("code", F.lower("code")), ["code"])
        return unique.select("code", F.col("lat").alias(f"{p}_lat"), F.col("lon").alias(f"{p}_lon"))

    codes = F.array_join(F.filter(state_list("states"), lambda s: s.isin(*fv.UNIT_STATES)), ",")
    sources = {"boundary_centroid": "pin", "park_list": "list", "centroid": "cen", "arcgis_geometry": "geo"}

    def located(rows: DataFrame) -> DataFrame:
        out = rows
        for df, p in ((pins, "pin"), (listed, "list"), (centroids, "cen"), (geometry, "geo")):
            out = out.join(at(df, p), "code", "left")
        pick = F.coalesce(*[F.when(F.col(f"{p}_lat").isNotNull(), F.lit(name)) for name, p in sources.items()])
        return (
            out.withColumn("coord_source", pick)
            .withColumn("lat", F.coalesce(*[F.col(f"{p}_lat") for p in sources.values()]))
            .withColumn("lon", F.coalesce(*[F.col(f"{p}_lon") for p in sources.values()]))
            .where("lat is not null and lon is not null")
            .select("code", "name", "designation", "state", "lat", "lon", "coord_source")
        )

    own = units.withColumn("code", F.lower("code")).withColumn("state", codes).where("state <> ''").withColumn(
        "designation", F.coalesce(F.nullif(text("unit_type"), F.lit("")), F.lit("Park"))
    )
    main = located(own.select("code", "name", "designation", "state"))
    skipped = matches("designation", fv.SUPPLEMENTAL_UNIT_SKIPPED) | matches("name", fv.SUPPLEMENTAL_UNIT_SKIPPED)
    extra = (
        listed.withColumn("code", F.lower("code"))
        .withColumn("state", codes)
        .where((F.col("state") != "") & ~skipped & (F.col("code") != ""))
        .select("code", "name", F.coalesce(F.nullif(text("designation"), F.lit("")), F.lit("Park")).alias("designation"), "state")
        .join(main.select("code"), "code", "left_anti")
    )
    return main.unionByName(located(extra)).withColumn("category", parks.federal_category("designation"))


def places_catalog(places: DataFrame, pins: DataFrame) -> DataFrame:
    """Canadian federal units, one row per place id: pin coordinate, else the place's own."""
    first = first_per_key(places, ["place_id"], ["seq"])
    pin = first_seen(pins, ["place_id"]).select(
        "place_id", F.col("lat").alias("_lat"), F.col("lon").alias("_lon")
    )
    key = slugify(federal_place_key("name"))
    return (
        first.join(pin, "place_id", "left")
        .withColumn("lat", F.coalesce("_lat", "lat"))
        .withColumn("lon", F.coalesce("_lon", "lon"))
        .withColumn("park_code", F.when(key == "", F.lit("pc")).otherwise(key))
        .withColumn("category", parks.canadian_category("place_type"))
        .drop("_lat", "_lon")
    )


def in_scope(units: DataFrame) -> DataFrame:
    """Boundary scope by unit type and category."""
    return units.where(
        F.col("unit_type").isin(*fv.BOUNDARY_UNIT_TYPES)
        & ~F.col("unit_type").isin(*fv.BOUNDARY_UNIT_TYPES_EXCLUDED)
        & F.col("category").isin(*fv.BOUNDARY_CATEGORIES)
    )


def parent_aliases(units: DataFrame) -> DataFrame:
    """Preserve code -> code of the unit that carries the same park name (units: code, name, category, seq)."""
    short = F.regexp_replace(F.regexp_replace("name", r"(?i)\s*&\s*preserve$", ""), _TRAILING_DESIGNATION, "")
    primary = (
        units.withColumn("_key", F.lower(F.trim(short)))
        .where("_key <> ''")
        .groupBy("_key")
        .agg(F.lower(F.min_by("code", "seq")).alias("primary_code"))
    )
    preserve = units.where(F.col("category") == "preserve").select(
        F.lower("code").alias("code"), F.lower(F.trim(F.regexp_replace("name", r"(?i)\s*national preserve$", ""))).alias("_key")
    )
    return preserve.join(primary, "_key").where("primary_code <> code").select("code", "primary_code")


def resolve_federal_parent(rows: DataFrame, units: DataFrame, code: str = "park_code") -> DataFrame:
    """Parent unit by code, preserve codes taken to their primary unit; unknown codes name themselves."""
    alias = parent_aliases(units)
    out = rows.withColumn("_code", F.lower(text(code)))
    out = out.join(alias.withColumnsRenamed({"code": "_acode", "primary_code": "_alias"}), F.col("_code") == F.col("_acode"), "left")
    out = out.withColumn("parent_code", F.coalesce("_alias", "_code"))
    known = units.select(
        F.lower("code").alias("_ucode"), F.col("name").alias("_uname"), F.col("category").alias("_ucat"), F.col("seq").alias("_useq")
    )
    known = first_per_key(known, ["_ucode"], ["_useq"])
    return (
        out.join(known, F.col("parent_code") == F.col("_ucode"), "left")
        .withColumn("parent_name", F.coalesce("_uname", F.upper("parent_code")))
        .withColumn("parent_category", F.coalesce("_ucat", F.lit("other")))
        .drop("_code", "_acode", "_alias", "_ucode", "_uname", "_ucat", "_useq")
    )


def resolve_canadian_parent(rows: DataFrame, units: DataFrame, key: str = "id") -> DataFrame:
    """Parent by code, page slug, place name, then the nearest unit within 80 km.

    ``rows``: id, park_code, url, name, lat, lon; ``units``: code, name, name_fr, lat, lon, seq. A
    later unit of the same key replaces an earlier one. Adds parent and parent_by.
    """
    # later rows win in these lookups, so the order is turned round
    back = units.withColumn("seq", -F.col("seq")).withColumn("code", F.lower("code"))
    by_name = back.select("code", "seq", federal_place_key("name").alias("_name")).unionByName(
        back.select("code", "seq", federal_place_key("name_fr").alias("_name"))
    )
    steps = [
        ("code", F.nullif(F.lower(text("park_code")), F.lit("")), back.withColumn("_c", F.col("code")), "_c"),
        ("slug", F.nullif(federal_park_slug("url"), F.lit("")), back.withColumn("_c", F.col("code")), "_c"),
        ("name", F.nullif(federal_place_key("name"), F.lit("")), by_name, "_name"),
    ]
    resolved = matching.first_resolved(rows, steps, key, "code", "parent")
    near = spatial.nearest_within(
        resolved.where("parent is null").select(key, "lat", "lon"), units.select("code", "lat", "lon"), fv.UNIT_FALLBACK_M,
        "m", (), key, "code",
    ).select(F.col(key).alias("_id"), F.col("near.code").alias("_near"))
    return (
        resolved.join(near, resolved[key] == near["_id"], "left")
        .withColumn("parent_by", F.coalesce("parent_by", F.when(F.col("_near").isNotNull(), F.lit("nearest")), F.lit("none")))
        .withColumn("parent", F.coalesce("parent", F.lower("_near")))
        .drop("_id", "_near")
    )


def visitor_center_state(state, park_states) -> Column:
    """Given state, else the park's first state, else the nearest state centre."""
    return F.coalesce(
        F.nullif(F.trim(F.substring_index(text(state), ",", 1)), F.lit("")),
        F.nullif(F.trim(F.substring_index(text(park_states), ",", 1)), F.lit("")),
        F.when(
            geo.valid_coordinate("lat", "lon", fv.US_WIDE_BOX), spatial.nearest_centre_code("lat", "lon", fv.STATE_CENTRES)
        ),
        F.lit(""),
    )


def match_feature_rows(api: DataFrame, features: DataFrame) -> DataFrame:
    """Each API row's feature row: same park and name key, else nearest similar name of the park within 400 m.

    ``api``: id, park_code, name, lat, lon; ``features``: id, park_code, name, lat, lon, seq. The last
    feature of a key counts. Output: id, feature_id, distance_m, match_rule.
    """
    a = api.withColumn("_key", visitor_center_key("name")).withColumn("_park", F.lower(text("park_code")))
    f = features.withColumn("_key", visitor_center_key("name")).withColumn("_park", F.lower(text("park_code")))

    def whole(c: Column) -> Column:
        return F.when(c == "", F.lit("visitor-center")).otherwise(c)

    keyed = f.groupBy(F.col("_park").alias("f_park"), whole(F.col("_key")).alias("f_key")).agg(
        F.max_by(F.struct("id", "lat", "lon"), "seq").alias("f")
    )
    exact = a.join(keyed, (a["_park"] == keyed["f_park"]) & (whole(a["_key"]) == keyed["f_key"]))
    exact = exact.select(a["id"], "lat", "lon", "f", F.lit("key").alias("match_rule"))
    rest = a.join(exact.select("id"), "id", "left_anti").where(geo.valid_coordinate("lat", "lon", fv.US_WIDE_BOX))
    spots = f.where("_key <> ''").groupBy("lat", "lon", "_park", "_key").agg(F.min_by("id", "seq").alias("id"), F.min("seq").alias("seq"))
    near = spatial.radius_join(
        rest.where("_key <> ''").select("id", "lat", "lon", "_park", "_key"), spots, fv.VC_MATCH_M, "m", ["_park"]
    ).where(names_similar(F.col("l__key"), F.col("r__key")))
    best = near.groupBy(F.col("l_id").alias("id"), F.col("l_lat").alias("lat"), F.col("l_lon").alias("lon")).agg(
        F.min_by(F.struct(F.col("r_id").alias("id"), F.col("r_lat").alias("lat"), F.col("r_lon").alias("lon")), F.struct("distance", "r_seq")).alias("f")
    )
    both = exact.unionByName(best.withColumn("match_rule", F.lit("near")))
    return both.select(
        "id", F.col("f.id").alias("feature_id"), geo.haversine("lat", "lon", "f.lat", "f.lon", "m").alias("distance_m"), "match_rule"
    )


def visitor_center_master(api: DataFrame, features: DataFrame, map_points: DataFrame) -> DataFrame:
    """API rows with their feature match, then unused feature rows, all checked against map points.

    ``api``/``features``: id, park_code, name, lat, lon, has_hours, seq; ``map_points``: osm_key, lat, lon.
    Flags: NO_COORDS, NO_HOURS, COORD_MISMATCH, OSM_FAR, NO_OSM.
    """
    hits = match_feature_rows(api, features)
    ok = geo.valid_coordinate("lat", "lon", fv.US_WIDE_BOX)
    from_api = (
        api.join(hits, "id", "left")
        .withColumn("ingest_source", F.lit("02-nps-api"))
        .withColumn("feature_distance_m", geo.half_up("distance_m", 1))
        .drop("distance_m", "match_rule")
    )
    used = hits.select(F.col("feature_id").alias("id")).distinct()
    from_features = (
        features.join(used, "id", "left_anti")
        .withColumn("feature_id", F.lit(None).cast(features.schema["id"].dataType))
        .withColumn("ingest_source", F.lit("01-arcgis-poi"))
        .withColumn("feature_distance_m", F.lit(None).cast("double"))
    )
    rows = from_api.unionByName(from_features)
    checked = spatial.nearest_within(rows, map_points, fv.VC_OSM_RADIUS_M, "m", right_key="osm_key", distance="osm_distance_m")
    api_row = F.col("ingest_source") == "02-nps-api"
    far = F.coalesce(F.col("feature_distance_m") > fv.VC_MISMATCH_M, F.lit(False))
    flags = F.array(
        F.when(api_row & ~ok, F.lit("NO_COORDS")),
        F.when(~F.coalesce("has_hours", F.lit(False)), F.lit("NO_HOURS")),
        F.when(ok & far, F.lit("COORD_MISMATCH")),
        F.when(ok & F.coalesce(F.col("osm_distance_m") > fv.VC_OSM_FAR_M, F.lit(False)), F.lit("OSM_FAR")),
        F.when(ok & F.col("osm_distance_m").isNull(), F.lit("NO_OSM")),
    )
    return (
        checked.withColumn("osm_key", F.when(ok, F.col("near.osm_key")))
        .withColumn("osm_distance_m", F.when(ok, geo.half_up("osm_distance_m", 1)))
        .withColumn("map_flags", F.filter(flags, lambda v: v.isNotNull()))
        .withColumn("needs_review", F.size("map_flags") > 0)
        .drop("near")
    )


def feature_center_records(features: DataFrame, units: DataFrame) -> DataFrame:
    """Visitor-center records from feature rows (park_code, name, lat, lon, seasonal, season_text, states)."""
    rows = features.where(geo.valid_coordinate("lat", "lon", fv.US_WIDE_BOX) & (text("park_code") != ""))
    rows = resolve_federal_parent(rows, units)
    return rows.select(
        visitor_center_id("parent_code", "name", "lat", "lon").alias("id"), "name", "parent_code", "parent_name",
        "parent_category", "lat", "lon", visitor_center_state(F.lit(""), "states").alias("state"),
        season("seasonal", "season_text").alias("season"),
    )


def api_center_records(pages: DataFrame, body: str = "body") -> DataFrame:
    """Visitor centers of API pages (JSON text): typed, lower-case park code, null bad coordinates."""
    schema = "data array<struct<id:string,name:string,parkCode:string,latitude:string,longitude:string>>"
    rows = pages.select(F.explode(F.from_json(F.col(body), schema)["data"]).alias("d"))
    lat, lon = F.col("d.latitude").try_cast("double"), F.col("d.longitude").try_cast("double")
    ok = geo.valid_coordinate(lat, lon, fv.US_WIDE_BOX)
    return rows.select(
        F.col("d.id").alias("id"), F.col("d.name").alias("name"), F.lower(text("d.parkCode")).alias("park_code"),
        F.when(ok, lat).alias("lat"), F.when(ok, lon).alias("lon"),
    )


def canadian_center_records(features: DataFrame, units: DataFrame) -> DataFrame:
    """Visitor-centre records with parent, province and weak-parent flag (id, name, facility_type, url, lat, lon)."""
    kind = F.lower(text("facility_type"))
    centre = kind.contains("visitor centre") | kind.contains("centre d'accueil") | kind.contains("centre des visiteurs")
    rows = features.where(centre & geo.valid_coordinate("lat", "lon", fv.CA_BOX))
    rows = resolve_canadian_parent(rows, units)
    province = F.coalesce(spatial.box_code("lat", "lon", fv.PROVINCE_BOXES), F.lit(""))
    flags = add_absent(F.array(F.lit("NO_HOURS")), "WEAK_PARENT", F.col("parent").isNull())
    return rows.withColumn("state", province).withColumn("map_flags", add_absent(flags, "NO_STATE", F.col("state") == ""))


def canadian_center_embed(master: DataFrame, units: DataFrame) -> DataFrame:
    """Slim rows of the Canadian centre master with their parent's name, category and designation.

    ``master``: id, name, lat, lon, state, park_code, parent, has_hours, hours_summary, season_note, seasonal, detail_url,
    park_url, coord_confidence, needs_review; ``units``: code, name, category, designation, seq. The last unit of a code
    counts; a centre without a parent keeps empty parent fields.
    """
    parents = first_per_key(units.withColumn("code", F.lower("code")), ["code"], [-F.col("seq")]).select(
        F.col("code").alias("_code"), F.col("name").alias("_name"), F.col("category").alias("_category"), F.col("designation").alias("_designation")
    )
    rows = master.join(parents, F.lower("parent") == F.col("_code"), "left")
    return rows.select(
        "id", "name", "lat", "lon", text("state").alias("state"),
        F.coalesce(F.nullif("park_code", F.lit("")), "_code", F.lit("")).alias("park_code"),
        text("_name").alias("parent_name"), text("_category").alias("parent_category"), text("_designation").alias("parent_designation"),
        F.struct(
            F.coalesce("has_hours", F.lit(False)).alias("has_hours"), text("hours_summary").alias("summary"), text("season_note").alias("seasonal_note")
        ).alias("hours"),
        "seasonal", text(first_filled("detail_url", "park_url")).alias("url"), text("coord_confidence").alias("coord_confidence"),
        F.coalesce("needs_review", F.lit(False)).alias("needs_review"),
    )


#: fixed values: least share of centers with hours, least number with hours, most share flagged, least share of strong parents
HOURS_SHARE, HOURS_LEAST, NO_HOURS_SHARE, STRONG_PARENTS = 0.9, 500, 0.15, 0.7


def center_checks(master: DataFrame, embed: DataFrame, report: DataFrame) -> DataFrame:
    """Validator of the US centers: each expectation with its measured value and whether it holds.

    ``master``: coord_source, has_hours, state, map_flags; ``embed``: has_hours; ``report``: total_records, with_hours.
    """
    hours, from_api = F.coalesce("has_hours", F.lit(False)), F.coalesce(F.col("coord_source") == "nps-api", F.lit(False))
    flagged = {name: F.coalesce(F.array_contains("map_flags", name), F.lit(False)) for name in ("NO_HOURS", "NO_STATE")}
    measures = {
        "master": (master, {
            "records": F.count(F.lit(1)), "with_hours": qa.rows_where(hours), "from_api": qa.rows_where(from_api),
            "api_share": qa.share_where(hours, from_api), "share": qa.share_where(hours), "no_hours_share": qa.share_where(flagged["NO_HOURS"]),
            "no_state_flags": qa.rows_where(flagged["NO_STATE"]), "without_state": qa.rows_without("state"),
        }),
        "embed": (embed, {"embedded": F.count(F.lit(1)), "embedded_hours": qa.rows_where(hours)}),
        "report": (report, {"reported": F.max("total_records"), "reported_hours": F.max("with_hours")}),
    }
    return qa.expectations(
        measures,
        [
            qa.Rule("records", "records", least=1), qa.Rule("report equals master", "reported - records", 0, 0),
            qa.Rule("api records", "from_api", least=1), qa.Rule("api hours share", "api_share", least=HOURS_SHARE),
            qa.Rule("with hours", "with_hours", least=HOURS_LEAST), qa.Rule("hours share", "share", least=HOURS_SHARE, level="warn"),
            qa.Rule("flagged NO_HOURS", "no_hours_share", most=NO_HOURS_SHARE, level="warn"), qa.Rule("without state", "without_state", most=0),
            qa.Rule("flagged NO_STATE", "no_state_flags", most=0), qa.Rule("embed equals master", "embedded - records", 0, 0),
            qa.Rule("embed hours equal report", "embedded_hours - reported_hours", 0, 0),
        ],
    )


def canadian_center_checks(master: DataFrame, embed: DataFrame, report: DataFrame) -> DataFrame:
    """Validator of the Canadian centres (``master``: parent_name, parent_category, has_hours; ``report``: total_records)."""
    strong = (text("parent_name") != "") & (text("parent_category") != "other")
    measures = {
        "master": (master, {
            "records": F.count(F.lit(1)), "strong": qa.share_where(strong), "with_hours": qa.rows_where(F.coalesce("has_hours", F.lit(False))),
        }),
        "embed": (embed, {"embedded": F.count(F.lit(1))}),
        "report": (report, {"reported": F.max("total_records")}),
    }
    return qa.expectations(
        measures,
        [
            qa.Rule("records", "records", least=1), qa.Rule("report equals master", "reported - records", 0, 0),
            qa.Rule("strong parents", "strong", least=STRONG_PARENTS, level="warn"),
            qa.Rule("with hours", "with_hours", least=1, level="warn"), qa.Rule("embed present", "embedded", least=1),
        ],
    )
