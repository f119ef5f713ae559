"""Campground layers: source records, merges, placeholders, display tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark import fixed_values as fv
from waymark.functions import camping, geo, tags
from waymark.functions.tags import tag
from waymark.functions.text import (
    add_absent,
    campground_key,
    first_filled,
    lookup,
    names_similar,
    pitch_campground_code,
    slugify,
    text,
)
from waymark.operators import clusters, dedupe, spatial
from waymark.operators.ranking import first_seen
from waymark.operators.rollup import group_centroids
from waymark.runtime import derive


def map_records_us(points: DataFrame) -> DataFrame:
    """Public campgrounds from tagged points (osm_type, osm_id, lat, lon, tags)."""
    name = F.coalesce(
        F.nullif(F.trim(text(tag("name"))), F.lit("")), F.concat_ws(" ", F.lit("OSM"), "osm_type", F.col("osm_id").cast("string"))
    )
    site = text(tag("camp_site"))
    rows = points.where(geo.valid_coordinate("lat", "lon", fv.US_BOX) & tags.camp_candidate())
    rows = first_seen(rows, ["osm_type", "osm_id"]).withColumn("name", name)
    rows = rows.where(~tags.commercial("name", tag("operator"), tag("brand")))
    return rows.select(
        "osm_type", "osm_id", "name", "lat", "lon",
        F.when(site.isin("dispersed", "wildcamp", "backcountry"), F.lit("dispersed")).otherwise(F.lit("developed")).alias("type"),
        tags.land_manager_us().alias("land_manager"),
        tags.camp_cost().alias("cost"),
        F.when(_yes("reservation"), F.lit(True)).when(_no("reservation"), F.lit(False)).alias("reservable"),
        F.lit("03-osm").alias("ingest_source"),
    )


def _yes(key: str) -> Column:
    return text(tag(key)).isin("yes", "required", "recommended")


def _no(key: str) -> Column:
    return text(tag(key)) == "no"


def map_records_ca(points: DataFrame) -> DataFrame:
    """Government-run Canadian campgrounds from tagged points."""
    name = F.coalesce(
        F.nullif(F.trim(text(first_filled(tag("name"), tag("name:fr")))), F.lit("")),
        F.concat_ws(" ", F.lit("OSM"), "osm_type", F.col("osm_id").cast("string")),
    )
    rows = points.where(geo.valid_coordinate("lat", "lon", fv.CA_BOX) & tags.camp_candidate())
    named = derive(rows, name=name, _blob=tags.camp_blob_ca(), _site=text(tag("camp_site")))
    judged = derive(
        named,
        land_manager=tags.land_manager_ca(blob=F.col("_blob")),
        _private=tags.private_campground_ca("name", blob=F.col("_blob")),
    ).where(
        ~F.col("_private")
        & F.col("land_manager").isin("Parks Canada", "Provincial")
        & ~F.col("_site").isin("dispersed", "wildcamp", "backcountry")
    )
    unique = first_seen(judged, ["osm_type", "osm_id"])
    return unique.drop("_private", "_site", "_blob").withColumn(
        "state", F.coalesce(spatial.box_code("lat", "lon", fv.PROVINCE_BOXES), F.lit(""))
    ).withColumn(
        "id", F.concat_ws("-", F.lit("CG-CA-OSM"), "state", slugify("name"), F.col("osm_id").cast("string"))
    )


def feature_records(features: DataFrame, manager: str, source: str, id_prefix: str) -> DataFrame:
    """Campgrounds from flattened feature pages (code, name, lat, lon): valid, public, with a state."""
    rows = features.where(geo.valid_coordinate("lat", "lon", fv.US_BOX))
    rows = rows.where(~tags.commercial("name", F.lit(""), F.lit("")))
    return rows.withColumn("state", F.coalesce(spatial.box_code("lat", "lon", fv.STATE_BOXES, fv.STATE_OVERLAPS), F.lit(""))).select(
        F.concat_ws("-", F.lit(id_prefix), F.upper(text("code")), slugify("name")).alias("id"),
        "name", "lat", "lon", "state", F.lit(manager).alias("land_manager"), F.lit(source).alias("ingest_source"),
        F.lit("developed").alias("type"),
    )


def facility_records(facilities: DataFrame) -> DataFrame:
    """Reservation-system facilities (facility_id, name, agency, lat, lon, reservable)."""
    rows = facilities.where(geo.valid_coordinate("lat", "lon", fv.US_BOX) & (F.trim(text("name")) != ""))
    return rows.select(
        F.concat(F.lit("CG-RIDB-"), F.col("facility_id").cast("string")).alias("id"),
        F.trim("name").alias("name"), "lat", "lon",
        tags.land_manager_of_agency("agency").alias("land_manager"),
        F.col("reservable").alias("reservable"),
        F.lit("04-ridb").alias("ingest_source"),
    )


def merge_sources_us(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ordered merge over all sources: similar names within 0.12 mi, or one manager within 0.05 mi.

    ``records``: id, seq (source rank first), name, lat, lon, land_manager, ingest_source.
    """
    rows = records.withColumn("name_key", campground_key("name")).withColumn("manager_key", text("land_manager"))

    def edge(left, right, distance):
        return names_similar(left("name_key"), right("name_key")) | (
            (distance <= fv.SAME_MANAGER_MI) & (left("manager_key") == right("manager_key"))
        )

    kept, lost = dedupe.ordered_dedupe(
        rows, fv.DEDUPE_MI, "mi", clique_on=["name_key", "manager_key"], clique_radius=fv.SAME_MANAGER_MI, edge=edge
    )
    map_only = F.col("ingest_source") == "03-osm"
    kept = kept.drop("name_key", "manager_key")
    if "review_reasons" in kept.columns:
        kept = kept.withColumn(
            "review_reasons", add_absent("review_reasons", "osm-only-no-federal-confirm", map_only)
        ).withColumn("map_flags", add_absent("map_flags", "OSM_ONLY", map_only))
    return kept, lost


def map_supplements(records: DataFrame, lost: DataFrame) -> DataFrame:
    """Map rows folded into a federal row: (kept, supplement) pairs."""
    source = records.select("id", "ingest_source")
    return (
        lost.join(source.select(F.col("id").alias("kept"), F.col("ingest_source").alias("kept_source")), "kept")
        .join(source.select(F.col("id").alias("dropped"), F.col("ingest_source").alias("dropped_source")), "dropped")
        .where("dropped_source = '03-osm' and kept_source <> '03-osm'")
        .select("kept", F.col("dropped").alias("supplement"))
    )


def merge_sources_ca(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same test, but rows of one source never suppress each other."""
    rows = records.withColumn("name_key", campground_key("name")).withColumn("manager_key", text("land_manager"))

    def edge(left, right, distance):
        return names_similar(left("name_key"), right("name_key")) | (
            (distance <= fv.SAME_MANAGER_MI) & (left("manager_key") == right("manager_key"))
        )

    kept, lost = dedupe.layered_dedupe(
        rows, fv.DEDUPE_MI, "mi", fv.CAMPING_SOURCES_CA, edge, ["name_key", "manager_key"], layer="ingest_source"
    )
    return kept.drop("name_key", "manager_key"), lost


def placeholders(master: DataFrame, units: DataFrame) -> DataFrame:
    """One flagged row per eligible unit (park_code, name, category, lat, lon) without a campground."""
    have = master.where(F.col("land_manager") == "NPS").select(F.lower("park_code").alias("park_code")).distinct()
    gaps = units.where(F.col("category").isin(*fv.CAMPING_UNIT_CATEGORIES)).join(have, "park_code", "left_anti")
    return gaps.select(
        F.concat(F.lit("CG-NPS-"), F.upper("park_code"), F.lit("-NO-CAMPGROUND-PLACEHOLDER")).alias("id"),
        F.concat("name", F.lit(" (no campground in dataset)")).alias("name"),
        F.lit("placeholder").alias("type"),
        F.lit("NPS").alias("land_manager"),
        "park_code", "lat", "lon",
        F.array(F.lit("NPS_NO_CG")).alias("map_flags"),
        F.array(F.lit("nps-unit-no-campground-in-dataset")).alias("review_reasons"),
        F.lit(True).alias("needs_review"),
        F.lit(True).alias("is_placeholder"),
        F.lit("qa-nps-gap").alias("ingest_source"),
    )


def road_distances(points: DataFrame, roads: DataFrame, key: str = "id", state: str = "state") -> DataFrame:
    """Road distance in whole metres from the home state's table, else the least over its neighbours.

    ``roads``: state, lat1..lon2. Adds road_distance_m and road_status: measured, remote (table but
    no road in reach: the distance is REMOTE_M, beyond every limit) or none (no table: no distance).
    """
    have = roads.select(F.col("state").alias("_home")).distinct()
    tagged = points.join(have, points[state] == have["_home"], "left")
    home = tagged.where("_home is not null").drop("_home")
    away = tagged.where("_home is null").drop("_home")
    segments = roads.withColumnRenamed("state", "road_state")
    at_home = spatial.nearest_segment(
        home.withColumn("road_state", F.col(state)), segments, 0.02, 1, on=["road_state"], local_plane=False, output="_d"
    ).drop("road_state")
    at_home = at_home.withColumn(
        "road_status", F.when(F.col("_d").isNull(), F.lit("remote")).otherwise(F.lit("measured"))
    )
    neighbours = lookup(state, {}, None)
    for code, around in fv.ROAD_FALLBACK_STATES.items():
        neighbours = F.when(F.col(state) == code, F.array(*[F.lit(a) for a in around])).otherwise(neighbours)
    spread = away.select(key, "lat", "lon", F.explode(neighbours).alias("road_state"))
    reached = (
        spatial.nearest_segment(spread, segments, 0.02, 1, on=["road_state"], local_plane=False, output="_d")
        .groupBy(key)
        .agg(F.min("_d").alias("_d"))
    )
    fallback = away.join(reached, key, "left").withColumn(
        "road_status", F.when(F.col("_d").isNull(), F.lit("none")).otherwise(F.lit("measured"))
    )
    both = at_home.unionByName(fallback)
    metres = F.when(F.col("road_status") == "remote", F.lit(fv.REMOTE_M)).otherwise(geo.half_up("_d", 1))
    return both.withColumn("road_distance_m", metres).drop("_d")


def with_tiers(records: DataFrame, config: camping.FilterConfig = camping.FilterConfig()) -> DataFrame:
    """Micro-clusters, then the display tier with evidence and exclude reason."""
    hard = camping.hard_exclude_reason()
    active = records.where(hard.isNull())
    anchor = camping.federal_source() | camping.human_name("name")
    clustered = clusters.micro_clusters(
        active, config.cluster_radius_m, config.cluster_members, anchor, camping.keep_score()
    )
    rest = records.where(hard.isNotNull())
    for c in ("cluster_id", "cluster_keep_id", "cluster_role"):
        rest = rest.withColumn(c, F.lit(None).cast(clustered.schema[c].dataType))
    tier = camping.display_tier(config)
    return (
        clustered.unionByName(rest)
        .withColumn("_t", tier)
        .withColumn("display_tier", F.col("_t.tier"))
        .withColumn("road_evidence", F.col("_t.evidence"))
        .withColumn("exclude_reason", F.col("_t.reason"))
        .drop("_t")
    )


def pitches_to_campgrounds(pitches: DataFrame) -> DataFrame:
    """Federal pitches rolled up by campground code, else park and name (id, seq, name, code, park)."""
    code = pitch_campground_code("code")
    key = campground_key("name")
    park = F.lower(text("park"))
    group = (
        F.when(code != "", F.concat(F.lit("code:"), code))
        .when((park != "") & (key != ""), F.concat_ws(":", F.lit("name"), park, key))
        .when(key != "", F.concat(F.lit("name:"), key))
        .otherwise(F.concat(F.lit("id:"), F.col("id").cast("string")))
    )
    rows = pitches.withColumn("rollup_key", group)
    grouped = group_centroids(rows, ["rollup_key"], "seq", ["id", "name", "code", "park", "ingest_source"])
    return grouped.withColumn(
        "name", camping.display_name_ca("name", "ingest_source", pitch_campground_code("code"))
    ).withColumnRenamed("members", "pitch_count")


def embed_ca(records: DataFrame) -> DataFrame:
    """Eligible rows with nearby rows of one campground merged (id, seq, name, park, pitch_count ..)."""
    eligible = records.where(camping.in_embed_ca()).withColumn("name_key", campground_key("name"))
    federal = F.when(F.col("land_manager") == "Parks Canada", F.lower(text("park"))).otherwise(F.lit(""))
    return clusters.merge_campgrounds(
        eligible.withColumn("_park", federal), fv.CAMPGROUND_MERGE_MI, ["land_manager", "name_key"],
        camping.display_name_ca("name", "ingest_source"), separate="_park",
    ).drop("_park", "name_key")


def embed_us(records: DataFrame, config: camping.FilterConfig = camping.FilterConfig()) -> DataFrame:
    return records.where(camping.in_default_embed(config)).select(
        "id", "name", geo.half_up("lat", 1e5).alias("lat"), geo.half_up("lon", 1e5).alias("lon"), "state", "land_manager", "type"
    )


def seed_records(seeds: DataFrame) -> DataFrame:
    """Legacy seed rows of provinces as campground records (id, name, region, lat, lon)."""
    provinces = [code for code, *_ in fv.PROVINCE_BOXES]
    rows = seeds.where(F.upper(text("region")).isin(*provinces) & geo.valid_coordinate("lat", "lon", fv.CA_BOX))
    return rows.select(
        F.concat(F.lit("CG-CA-SEED-"), slugify("name")).alias("id"), "name", F.upper("region").alias("state"),
        "lat", "lon", F.lit("Provincial").alias("land_manager"), F.lit("03-provincial-seed").alias("ingest_source"),
    )
