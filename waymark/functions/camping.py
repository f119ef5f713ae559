"""Campground name quality, display tiers and embed rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark import fixed_values as fv
from waymark.functions.geo import col
from waymark.functions.text import lookup, matches, text, with_campground_suffix


@dataclass(frozen=True)
class FilterConfig:
    """Limits of the campground filter; any field may be overridden."""

    enabled: bool = True
    cluster_radius_m: float = fv.MICRO_CLUSTER_M
    cluster_members: int = fv.MICRO_CLUSTER_MEMBERS
    road_default_m: float = fv.ROAD_DEFAULT_M
    road_qa_m: float = fv.ROAD_QA_M
    road_known_manager_m: float = fv.ROAD_QA_M
    good_name_without_road: bool = True


def generic_name(name) -> Column:
    n = F.trim(text(name))
    return (n == "") | matches(n, r"^OSM\s+(node|way|relation)\b|^(node|way|relation)\s+\d+$|^unnamed\b")


def numeric_name(name) -> Column:
    return F.trim(text(name)).rlike(r"^#?[0-9]{1,4}$")


def site_label(name) -> Column:
    """Label of one pitch rather than of a campground."""
    return matches(F.trim(text(name)), r"^(site|plot|pitch|walk-in|group|loop)\s+[a-z0-9.\-]+$|^.+\s+#\d+$")


def human_name(name) -> Column:
    return (F.length(F.trim(text(name))) >= 4) & ~generic_name(name) & ~numeric_name(name)


def federal_source(source="ingest_source") -> Column:
    return text(source).isin(*fv.FEDERAL_SOURCES)


def hard_exclude_reason(
    name="name", type_="type", map_flags="map_flags", is_placeholder="is_placeholder"
) -> Column:
    return (
        F.when(F.coalesce(col(is_placeholder), F.lit(False)), F.lit("placeholder"))
        .when(text(type_) == "dispersed", F.lit("dispersed"))
        .when(F.coalesce(F.array_contains(col(map_flags), "NPS_NO_CG"), F.lit(False)), F.lit("nps-no-campground"))
        .when(generic_name(name), F.lit("generic-osm-name"))
    )


def keep_score(
    name="name", source="ingest_source", confidence="coord_confidence", osm_type="osm_type", manager="land_manager"
) -> Column:
    """Worth of a row inside a micro-cluster."""

    def points(test: Column, value: int) -> Column:
        return F.when(test, F.lit(value)).otherwise(F.lit(0))

    good, generic, numeric = human_name(name), generic_name(name), numeric_name(name)
    kind = text(osm_type)
    return (
        points(federal_source(source), 1000)
        + F.when(good, F.lit(200)).when(~generic & ~numeric, F.lit(50)).otherwise(F.lit(0))
        + F.when(text(confidence) == "high", F.lit(80)).when(text(confidence) == "medium", F.lit(40)).otherwise(F.lit(0))
        + F.when(kind == "relation", F.lit(30))
        .when(kind == "way", F.lit(20))
        .when((kind == "node") & good, F.lit(10))
        .otherwise(F.lit(0))
        + points(text(manager).isin(*fv.KNOWN_MANAGERS), 25)
        + points(site_label(name), -30)
        + points(generic, -500)
    )


def road_tier(
    config: FilterConfig,
    distance="road_distance_m",
    name="name",
    type_="type",
    source="ingest_source",
    manager="land_manager",
) -> Column:
    """Struct (tier, evidence, reason) from the road distance, or from the name where it is unknown."""
    d = col(distance)

    def row(tier: str, evidence: str, reason: str | None = None) -> Column:
        return F.struct(
            F.lit(tier).alias("tier"), F.lit(evidence).alias("evidence"), F.lit(reason).cast("string").alias("reason")
        )

    named = (
        F.lit(config.good_name_without_road)
        & (text(type_) == "developed")
        & human_name(name)
        & ~federal_source(source)
    )
    limit = F.when(text(manager).isin(*fv.KNOWN_MANAGERS), F.lit(config.road_known_manager_m)).otherwise(
        F.lit(config.road_qa_m)
    )
    return (
        F.when(d.isNull() & named, row("default", "named-no-road-cache"))
        .when(d.isNull() & (federal_source(source) | (text(source) == "03-osm")), row("qa", "road-unknown"))
        .when(d.isNull(), row("default", "road-unknown"))
        .when(d <= config.road_default_m, row("default", "road-distance"))
        .when(d <= limit, row("qa", "road-distance"))
        .otherwise(row("excluded", "road-distance", "no-road-access"))
    )


def display_tier(config: FilterConfig, cluster_role="cluster_role", **columns) -> Column:
    """Struct (tier, evidence, reason): hard rules, cluster duplicates, vague names, then the road."""
    name = columns.get("name", "name")
    source = columns.get("source", "ingest_source")
    road = road_tier(config, **columns)
    hard = hard_exclude_reason(name, columns.get("type_", "type"))
    role = text(cluster_role)
    vague = (
        ~human_name(name)
        & ~federal_source(source)
        & ~(site_label(name) & (role == "keep"))
        & (numeric_name(name) | site_label(name))
    )

    def out(reason: Column) -> Column:
        return F.struct(
            F.lit("excluded").alias("tier"), F.lit(None).cast("string").alias("evidence"), reason.alias("reason")
        )

    return (
        F.when(role == "dropped", out(F.lit("cluster-duplicate")))
        .when(hard.isNotNull(), out(hard))
        .when(vague, out(F.lit("vague-name")))
        .otherwise(road)
    )


def in_default_embed(config: FilterConfig, tier="display_tier", type_="type", map_flags="map_flags", is_placeholder="is_placeholder") -> Column:
    placeholder = F.coalesce(col(is_placeholder), F.lit(False))
    dispersed = text(type_) == "dispersed"
    if not config.enabled:
        closed = F.coalesce(F.array_contains(col(map_flags), "NPS_NO_CG"), F.lit(False))
        return ~placeholder & ~dispersed & ~closed
    return (text(tier) == "default") & ~placeholder & ~dispersed


def in_qa_embed(config: FilterConfig, tier="display_tier") -> Column:
    return (text(tier) == "qa") if config.enabled else F.lit(False)


def in_embed_ca(name="name", manager="land_manager", dispersed="dispersed", is_commercial="commercial") -> Column:
    return (
        ~F.coalesce(col(dispersed), F.lit(False))
        & ~F.coalesce(col(is_commercial), F.lit(False))
        & ~matches(name, r"^OSM\s+(node|way|relation)\b")
        & text(manager).isin("Parks Canada", "Provincial")
    )


def map_sourced_ca(source="ingest_source", id_="id", name="name") -> Column:
    return (text(source) == "02-osm") | matches(id_, "-OSM-") | matches(name, r"^OSM\s+(node|way|relation)\b")


def display_name_ca(name="name", source="ingest_source", code=None, id_="id") -> Column:
    """Map names stay as tagged; others get the override of their site code or source name."""
    n = F.trim(text(name))
    override = F.lit(None).cast("string")
    if code is not None:
        override = lookup(code, fv.PITCH_NAMES_BY_CODE)
    override = F.coalesce(override, lookup(n, fv.PITCH_NAMES_BY_SOURCE_NAME))
    federal = F.coalesce(override, F.nullif(n, F.lit("")), F.lit("Parks Canada campground"))
    return F.when(map_sourced_ca(source, id_, name), n).otherwise(
        with_campground_suffix(F.when(text(source) == "01-parks-canada", federal).otherwise(n))
    )
