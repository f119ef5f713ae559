"""Park amenities: records, merge, access, rollups, shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark import fixed_values as fv
from waymark.functions import access, geo, parks, tags
from waymark.functions.tags import tag
from waymark.functions.text import amenity_id, amenity_key, fill_template, first_filled, join_filled, matches, names_similar, slugify, text
from waymark.operators import dedupe, rollup, spatial
from waymark.plans import parks as park_plans
from waymark.plans import units as unit_plans
from waymark.plans.camping import road_distances
from waymark.runtime import derive, spread, stage


def federal_records(features: DataFrame, units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(amenity records, skipped counts by reason) from point features (poi_type, name, park_code, lat, lon)."""
    name = F.trim(F.coalesce(F.nullif(text("name"), F.lit("")), F.nullif(text("poi_type"), F.lit("")), F.lit("Park amenity")))
    rows = features.withColumn("name", name).withColumn("_c", parks.federal_amenity_class("poi_type", "name"))
    reason = (
        F.when(~geo.valid_coordinate("lat", "lon", fv.US_BOX), F.lit("noCoords"))
        .when(F.col("_c").isNull(), F.lit("unclassified"))
        .when(text("park_code") == "", F.lit("noPark"))
    )
    judged = rows.withColumn("_skip", reason)
    skipped = judged.where("_skip is not null").groupBy(F.col("_skip").alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    good = unit_plans.resolve_federal_parent(judged.where("_skip is null"), units)
    out = good.select(
        "name", F.col("_c.kind").alias("kind"), F.col("_c.camp_tier").alias("camp_tier"), F.col("_c.subtype").alias("subtype"),
        F.col("parent_code").alias("park_code"), "lat", "lon",
    )
    return out.select(
        amenity_id("NPS", "park_code", "kind", "camp_tier", "name", "lat", "lon").alias("id"), "*",
        F.lit("nps").alias("parent_system"), F.lit("01-nps-arcgis").alias("ingest_source"),
        access.inferred_access()["mode"].alias("access_mode"),
    ), skipped


def park_map_records(points: DataFrame, catalogue: DataFrame, country: str = "US") -> tuple[DataFrame, DataFrame]:
    """(amenities with a park parent, skipped counts) from tagged points.

    ``points``: osm_type, osm_id, lat, lon, tags; ``catalogue``: park_id, seq, code, name, state, lat, lon.
    """
    run_by_park = tags.provincial_park_run() if country == "CA" else tags.state_park_run()
    box = fv.CA_BOX if country == "CA" else fv.US_BOX
    boxes = (fv.PROVINCE_BOXES, ()) if country == "CA" else (fv.STATE_BOXES, fv.STATE_OVERLAPS)
    # the rules of a tag cost far more than its bytes; as finished values they stay behind the deal, and run once a row
    rows = derive(spread(points), kind=tags.amenity_kind(), _run=run_by_park)
    rows = rows.where(F.col("kind").isNotNull() & (F.col("_run") | (F.col("kind") != "campground"))).drop("_run")
    name = F.trim(F.coalesce(first_filled(tag("name"), tag("name:fr"), tag("ref")), F.replace("kind", F.lit("_"), F.lit(" "))))
    rows = rows.withColumn("name", name).withColumn("state", F.coalesce(spatial.box_code("lat", "lon", *boxes), F.lit("")))
    rows = rows.withColumn("id", F.concat_ws(":", "osm_type", F.col("osm_id").cast("string")))
    rows = rows.withColumn("code", F.lit("")).withColumn("unit_name", F.lit(""))
    early = F.when(~geo.valid_coordinate("lat", "lon", box), F.lit("noCoords")).when(
        tags.commercial("name", tag("operator"), tag("brand")), F.lit("commercial")
    )
    early_rows = stage(rows.withColumn("_skip", early), "amenity")
    parented = park_plans.resolve_parent(
        early_rows.where("_skip is null"), catalogue, 8000.0 if country == "CA" else 5000.0
    )
    late = F.when(F.col("parent").isNull(), F.lit("noParent")).when(
        matches(tags.operator_blob(), "parks canada|parcs canada"), F.lit("parksCanada")
    )
    judged = parented.withColumn("_skip", late)
    skipped = (
        early_rows.where("_skip is not null").select("_skip").unionByName(judged.where("_skip is not null").select("_skip"))
    ).groupBy(F.col("_skip").alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    good = judged.where("_skip is null").withColumn(
        "camp_tier", F.when(F.col("kind") == "campground", tags.camp_tier())
    )
    return good.select(
        F.col("id").alias("osm_key"), "name", "kind", "camp_tier", "state", "lat", "lon", F.col("parent").alias("parent_id"),
        access.inferred_access()["mode"].alias("access_mode"),
    ), skipped


def canadian_campgrounds(sites: DataFrame) -> DataFrame:
    """Federal campsite features as one amenity per parent and name (name, url_code, parent, lat, lon, seq)."""
    rows = sites.where(geo.valid_coordinate("lat", "lon", fv.CA_BOX))
    name = F.trim(F.coalesce(F.nullif(text("name"), F.lit("")), F.lit("Parks Canada campground")))
    head = F.lower(F.regexp_extract(text("url_code"), "^([A-Za-z]{2,5})-", 1))
    short = slugify("url_code")
    code = F.when(head != "", head).when(short != "", short).otherwise(F.lit("pc"))
    rows = rows.withColumn("name", name).withColumn("park_code", F.coalesce(F.nullif(text("parent"), F.lit("")), code))
    grouped = rollup.group_centroids(
        rows.withColumn("_name", F.lower("name")), ["park_code", "_name"], "seq", ["name", "url_code"]
    )
    backcountry = matches("name", "backcountry|walk.?in|wilderness|random")
    return grouped.drop("_name").withColumn(
        "camp_tier", F.when(backcountry, F.lit("backcountry")).otherwise(F.lit("developed"))
    ).withColumnRenamed("members", "site_count")


def feature_records(pages_rows: DataFrame, template: str, layers: DataFrame) -> DataFrame:
    """State layer features with the kind and name template of their layer row.

    ``pages_rows``: layer, lat, lon, name, unit, type; ``layers``: layer, kind, template.
    """
    rows = pages_rows.join(layers, "layer")
    return rows.withColumn(
        "name", fill_template(F.coalesce("template", F.lit(template)), {"name": F.col("name"), "unit": F.col("unit"), "type": F.col("type")})
    ).drop("template")


def merge(layers: Sequence[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Layers in priority order, then the ordered dedupe inside parent, kind and camp tier.

    Rows: id, seq, name, kind, camp_tier, subtype, parent (empty = none), object_id, site_no, lat, lon;
    ``seq`` must order the layers.
    """
    rows = layers[0]
    for more in layers[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    return dedupe_amenities(rows)


def dedupe_amenities(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    camp = F.col("kind") == "campground"
    ready = (
        rows.withColumn("name_key", amenity_key("name"))
        .withColumn("tier_key", F.when(camp, text("camp_tier")).otherwise(F.lit("")))
        .withColumn("object_key", text("object_id"))
        .withColumn("site_key", text("site_no"))
        .withColumn("subtype_key", text("subtype"))
    )
    # rows without a parent, and campgrounds without a name, are never duplicates
    lone = (text("parent") == "") | (camp & (F.col("name_key") == ""))
    traits = ["name_key", "tier_key", "object_key", "site_key", "subtype_key"]

    def edge(left, right, distance):
        def free(name: str) -> Column:
            return (left(name) == "") | (right(name) == "") | (left(name) == right(name))

        close = (left("kind") != "campground") & (distance <= fv.AMENITY_SUBTYPE_M) & (left("subtype_key") == right("subtype_key"))
        return free("object_key") & free("site_key") & (names_similar(left("name_key"), right("name_key")) | close)

    kept, lost = dedupe.ordered_dedupe(
        ready.where(~lone), fv.AMENITY_NAME_M, "m", on=["parent", "kind", "tier_key"],
        clique_on=["name_key", "object_key", "site_key", "subtype_key"], clique_radius=fv.AMENITY_SUBTYPE_M, edge=edge,
    )
    return kept.unionByName(ready.where(lone)).drop(*traits), lost


def with_access(rows: DataFrame, roads: DataFrame, trails: DataFrame, key: str = "id") -> DataFrame:
    """Road and trail distance of campgrounds and the access mode they give (state, lat1..lon2 tables)."""
    camp = rows.where(F.col("kind") == "campground")
    rest = rows.where(F.col("kind") != "campground")
    measured = road_distances(camp, roads, key).drop("road_status")
    measured = spatial.nearest_segment(
        measured, trails, 0.05, 1, on=["state"], local_plane=False, output="trail_distance_m"
    )
    # a state with a trail table and no trail in reach is far, a state without one is not known
    known = trails.select(F.col("state").alias("_trail_state")).distinct()
    measured = measured.join(known, measured["state"] == known["_trail_state"], "left").withColumn(
        "trail_distance_m",
        F.when(F.col("trail_distance_m").isNull() & F.col("_trail_state").isNotNull(), F.lit(fv.REMOTE_M)).otherwise(
            F.col("trail_distance_m")
        ),
    ).drop("_trail_state")
    both = measured.unionByName(rest, allowMissingColumns=True).withColumn("_a", access.access_mode())
    far = F.col("_a.confidence") == "measured_far"
    return (
        both.withColumn("access_mode", F.col("_a.mode"))
        .withColumn("access_confidence", F.col("_a.confidence"))
        .withColumn("map_flags", F.when(far, F.array(F.lit("ACCESS_FAR"))).otherwise(F.array().cast("array<string>")))
        .drop("_a")
    )


def park_rollup(rows: DataFrame) -> DataFrame:
    key = rollup.parent_key("parent_system", "parent_id", "park_code", "official_code", "id")
    return rollup.parent_rollup(rows.withColumn("parent_key", key))


def sort_master(rows: DataFrame) -> DataFrame:
    """Binary text order by manager, park, kind, tier, name (an ordered report)."""
    return rows.orderBy(*[text(c) for c in ("land_manager", "park_code", "kind", "camp_tier", "name")])


def embed(rows: DataFrame) -> DataFrame:
    return rows.select(
        "id", "name", "kind", "camp_tier", "access_mode", "park_code", geo.half_up("lat", 1e5).alias("lat"),
        geo.half_up("lon", 1e5).alias("lon"), join_filled("/", "kind", "camp_tier").alias("layer"),
    )
