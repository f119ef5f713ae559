"""Fuel layers: candidates, branded records, official reconcile, master, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark import fixed_values as fv
from waymark.functions import brands, geo, tags
from waymark.functions.tags import tag
from waymark.functions.text import add_absent, drop_values, first_filled, lookup, plaza_key, slugify, text
from waymark.operators import dedupe, elements, matching, rollup
from waymark.operators.ranking import first_per_key, first_seen
from waymark.operators.spatial import box_code, nearest_any


def candidates(nodes: DataFrame, ways: DataFrame, box: tuple = fv.US_BOX) -> DataFrame:
    """All fuel candidates as points with pruned tags and a search blob, first row per element."""
    found = elements.scan_elements(nodes, ways, None, tags.fuel_candidate())
    points = elements.element_points(found, nodes, ways).where(geo.valid_coordinate("lat", "lon", box))
    slim = points.withColumn("tags", tags.prune_tags(fv.FUEL_TAG_KEYS))
    blob = brands.search_blob(tag("brand"), tag("operator"), tag("name"), tag("addr:housename"))
    return first_seen(slim.withColumn("search_blob", blob), ["osm_type", "osm_id"])


def branded(rows: DataFrame, catalogue: Sequence[dict], country: str = "US") -> DataFrame:
    """Candidates that match a brand, as fuel records."""
    if country == "CA":
        name = first_filled(tag("name"), tag("name:fr"), tag("alt_name"))
        blob = brands.search_blob(
            tag("brand"), tag("operator"), tag("name"), tag("brand:fr"), tag("operator:fr"), tag("name:fr"),
            tag("addr:housename"),
        )
        brand_id = brands.brand_id_ca(
            first_filled(tag("brand"), tag("brand:fr")), first_filled(tag("operator"), tag("operator:fr")), name, blob, catalogue
        )
        matched = rows.withColumn("brand_id", brand_id)
    else:
        name = tag("name")
        matched = brands.with_brand_us(rows, tag("brand"), tag("operator"), name, catalogue)
    ids = {e["id"]: e for e in catalogue}
    display = lookup("brand_id", {k: e.get("display_name", k) for k, e in ids.items()})
    kind = lookup("brand_id", {k: e.get("type") for k, e in ids.items()})
    return (
        matched.where("brand_id is not null")
        .withColumn("brand", F.coalesce(display, F.col("brand_id")))
        .withColumn("type", brands.fuel_type(kind))
        .withColumn("name", F.coalesce(F.nullif(F.trim(text(name)), F.lit("")), F.col("brand")))
        .withColumn("fuels", tags.fuels())
        .withColumn("amenities", tags.station_amenities(F.col("type")))
    )


def generic(rows: DataFrame, us_catalogue: Sequence[dict]) -> DataFrame:
    """Candidates that match no brand."""
    matched = brands.with_brand_us(rows, tag("brand"), tag("operator"), tag("name"), us_catalogue, "_brand")
    return matched.where("_brand is null").drop("_brand")


def plazas(rows: DataFrame) -> DataFrame:
    """Highway service plazas by name."""
    name = brands.brand_token(first_filled(tag("name"), tag("name:fr"), tag("alt_name")))
    return rows.where((text(tag("highway")) == "services") & brands.plaza_name(name, text("search_blob")))


def search(rows: DataFrame, query: str, order: str, limit: int | None = None) -> DataFrame:
    """Text search over the candidates: all hits, or the first ``limit`` by ``order``."""
    hits = rows.where(F.lower(text("search_blob")).contains(brands.token_of(query)))
    return hits if limit is None else hits.orderBy(order).limit(limit)


def split_services(records: DataFrame, non_fuel: Column) -> tuple[DataFrame, DataFrame]:
    """(fuel stops, service sites)."""
    marked = records.withColumn("_service", F.coalesce(non_fuel, F.lit(False)))
    return marked.where("not _service").drop("_service"), marked.where("_service").drop("_service")


def reject_listed(records: DataFrame, rejects: DataFrame, key: str = "osm_key") -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) by a list of element keys."""
    keys = rejects.select(key).distinct()
    return records.join(keys, key, "left_anti"), records.join(keys, key, "left_semi")


def reconcile(map_rows: DataFrame, stores: DataFrame, radius_mi: float = fv.OFFICIAL_MATCH_MI, on: Sequence[str] = ("brand_id",)) -> dict[str, DataFrame]:
    """Match map rows and official stores one to one per brand.

    Brands without any store are skipped, so that an empty store list rejects nothing. Returns
    matched, rejects (with the nearest store), supplements, and skipped brands.
    ``map_rows``: id, lat, lon, brand_id; ``stores``: store_id, lat, lon, brand_id, city, state,
    street, label.
    """
    on = list(on)
    listed = stores.select(*on).distinct()
    active = map_rows.join(listed, on, "left_semi")
    skipped = map_rows.join(listed, on, "left_anti").select(*on).distinct()
    matched = matching.greedy_match(active, stores, radius_mi, "mi", on, "id", "store_id")
    map_only, store_only = matching.split_by_match(active, stores, matched, "id", "store_id")
    near = nearest_any(map_only, stores, "mi", on, "id", "store_id")
    rejects = near.select(
        *map_only.columns,
        F.lit("no-official-match").alias("reason"),
        geo.half_up("distance", 1000).alias("nearest_mi"),
        F.col("near.store_id").alias("nearest_store"),
    )
    supplements, _ = dedupe.ordered_dedupe(
        store_only.withColumn("id", F.col("store_id")).withColumn("seq", F.col("store_id")),
        fv.DEDUPE_MI, "mi", on=on,
    )
    return {
        "matched": matched.withColumn("distance", geo.half_up("distance", 1000)),
        "rejects": rejects,
        "supplements": supplements,
        "skipped": skipped,
    }


def supplement_id(brand_id, state, city, street, store_id) -> Column:
    return F.concat_ws(
        "-",
        F.lit("FUEL"),
        F.upper(geo.col(brand_id)),
        F.coalesce(F.nullif(geo.col(state), F.lit("")), F.lit("XX")),
        slugify(F.coalesce(F.nullif(geo.col(city), F.lit("")), F.lit("site"))),
        slugify(first_filled(street, geo.col(store_id).cast("string"), F.lit("official"))),
        F.lit("supp"),
    )


def reconcile_report(map_rows: DataFrame, stores: DataFrame, parts: dict[str, DataFrame], by: str = "brand_id") -> DataFrame:
    """Per brand: official, map, matched, rejected and supplement counts."""
    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(by).agg(F.count(F.lit(1)).alias(name))

    matched = parts["matched"].join(map_rows.select(F.col("id").alias("left_key"), by), "left_key")
    out = counts(stores, "official_count")
    for df, name in (
        (map_rows, "map_count"), (matched, "matched_count"), (parts["rejects"], "rejected_count"),
        (parts["supplements"], "supplement_count"),
    ):
        out = out.join(counts(df, name), by, "left")
    return out.na.fill(0)


def apply_reconcile(master: DataFrame, rejects: DataFrame, matched: DataFrame, supplements: DataFrame) -> DataFrame:
    """Drop rejects, mark verified rows, add supplements outside a 0.001 degree box of the same brand."""
    kept = master.join(rejects.select("id"), "id", "left_anti")
    verified = matched.select(F.col("left_key").alias("id"), F.lit(True).alias("_verified"))
    kept = (
        kept.join(verified, "id", "left")
        .withColumn("sources", add_absent("sources", "official-verified", F.coalesce("_verified", F.lit(False))))
        .drop("_verified")
    )
    added = dedupe.outside_box_of(supplements, kept, 0.001, ["brand_id"])
    return kept.unionByName(added, allowMissingColumns=True)


def dedupe_brands(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Same-brand rows within 0.12 mi suppressed in order; a mixed sister-brand pair is merged."""
    family = [*fv.SISTER_BRANDS, fv.SISTER_MERGED]
    others = records.where(~F.col("brand_id").isin(*family))
    sisters = records.where(F.col("brand_id").isin(*family))
    kept, lost = dedupe.ordered_dedupe(others, fv.DEDUPE_MI, "mi", on=["brand_id"])
    sister_kept, sister_lost = dedupe.cobrand_dedupe(sisters, fv.DEDUPE_MI, fv.SISTER_BRANDS, fv.SISTER_MERGED)
    return (
        kept.withColumn("merged_pair", F.lit(False)).unionByName(sister_kept),
        lost.withColumn("reason", F.lit("same-brand-near")).unionByName(sister_lost),
    )


def merge_highway_pairs(records: DataFrame, brand: str = "onroute") -> DataFrame:
    """Plazas on both sides of a highway as one row: mean coordinate, display name, pair count."""
    chain = records.where(F.col("brand_id") == brand)
    lead = dedupe.pair_merge(chain, fv.HIGHWAY_PAIR_MI, "mi", plaza_key("name"))
    grouped = lead.groupBy("lead").agg(
        F.count(F.lit(1)).alias("paired_count"),
        F.avg("lat").alias("_lat"),
        F.avg("lon").alias("_lon"),
        F.min_by("name", F.struct(F.length("name"), F.col("seq"))).alias("_name"),
    )
    display = F.trim(F.regexp_replace(F.regexp_replace("_name", r"(?i)\b(North|South|East|West)\b", ""), r"\s+", " "))
    paired = F.col("paired_count") > 1
    first = chain.join(grouped, chain["id"] == grouped["lead"]).withColumn("_display", display)
    out = first.select(
        *[c for c in records.columns if c not in ("id", "name", "lat", "lon")],
        F.when(paired, F.concat(F.lit("FUEL-CA-ONROUTE-PAIR-"), slugify("_display"))).otherwise(F.col("id").cast("string")).alias("id"),
        F.when(paired & (F.col("_display") != ""), F.col("_display")).otherwise(F.col("name")).alias("name"),
        F.when(paired, F.col("_lat")).otherwise(F.col("lat")).alias("lat"),
        F.when(paired, F.col("_lon")).otherwise(F.col("lon")).alias("lon"),
        "paired_count",
    )
    rest = records.where(F.col("brand_id") != brand).withColumn("id", F.col("id").cast("string")).withColumn(
        "paired_count", F.lit(1).cast("bigint")
    )
    return rest.unionByName(out)


def correct_state(records: DataFrame, boxes=fv.STATE_BOXES, rules=fv.STATE_OVERLAPS) -> DataFrame:
    """State from coordinates; a changed state is flagged, a confirmed one clears the missing-state marks."""
    found = box_code("lat", "lon", boxes, rules)
    none = F.array().cast("array<string>")
    rows = records.withColumn("_st", found).withColumn("_prev", text("state"))
    known = F.col("_st").isNotNull()
    changed = known & (F.col("_prev") != "") & (F.col("_prev") != F.col("_st"))
    reasons = F.when(
        known & ~changed, drop_values("review_reasons", "missing-state", "missing-state-infer-from-geo")
    ).otherwise(add_absent("review_reasons", "state-corrected-from-coords", changed))
    flags = F.when(known & ~changed, drop_values("map_flags", "NO_STATE")).otherwise(
        add_absent("map_flags", "STATE_CORRECTED", changed)
    )
    out = (
        rows.withColumn("review_reasons", F.coalesce("review_reasons", none))
        .withColumn("map_flags", F.coalesce("map_flags", none))
        .withColumn("_reasons", reasons)
        .withColumn("_flags", flags)
    )
    review = (
        F.when(changed, F.lit(True))
        .when(known & (F.size("_reasons") == 0), F.size("_flags") > 0)
        .otherwise(F.coalesce(F.col("needs_review"), F.lit(False)))
    )
    return (
        out.withColumn("needs_review", review)
        .withColumn("state", F.coalesce("_st", "state"))
        .withColumn("review_reasons", F.col("_reasons"))
        .withColumn("map_flags", F.col("_flags"))
        .drop("_st", "_prev", "_reasons", "_flags")
    )


def finish_records(records: DataFrame) -> DataFrame:
    """State from coordinates, missing-state flag, and the review mark."""
    rows = correct_state(records)
    missing = text("state") == ""
    rows = rows.withColumn("map_flags", add_absent("map_flags", "NO_STATE", missing))
    return rows.withColumn("needs_review", brands.needs_review(F.col("map_flags"), F.col("review_reasons")))


def master_report(master: DataFrame) -> DataFrame:
    """All count breakdowns of the fuel master in one table."""
    return rollup.breakdowns(
        master, {"brand": ["brand_id"], "type": ["type"], "brand_type": ["brand_id", "type"], "state": ["state"]}
    )


def explorer_tables(candidate_rows: DataFrame, catalogue: Sequence[dict]) -> DataFrame:
    """Candidates with their matched brand, or ``unmatched``."""
    matched = brands.with_brand_us(candidate_rows, tag("brand"), tag("operator"), tag("name"), catalogue, "match")
    return matched.withColumn("match", F.coalesce("match", F.lit("unmatched")))


def branded_shards(shards: DataFrame, catalogue: Sequence[dict], box: tuple = fv.US_BOX) -> DataFrame:
    """Branded records of element lists that carry a centre point, one list per state.

    ``shards``: shard (state code), seq, osm_type, osm_id, lat, lon, tags. An element of several lists belongs to the first
    by state code; its name falls back to the house name, then to the brand.
    """
    rows = shards.where(geo.valid_coordinate("lat", "lon", box))
    found = first_per_key(branded(rows, catalogue), ["osm_type", "osm_id"], ["shard", "seq"])
    named = found.withColumn("name", F.trim(first_filled(tag("name"), tag("addr:housename"), F.col("brand"))))
    return named.select(
        F.concat_ws("-", F.lit("FUEL"), F.upper("brand_id"), "shard", slugify("name"), F.col("osm_id").cast("string")).alias("id"),
        "name", "brand", "brand_id", "type", F.col("shard").alias("state"), "lat", "lon", text(tag("highway")).alias("highway"),
        text(first_filled(tag("ref"), tag("exit"))).alias("exit"), "fuels", "amenities", "osm_type", "osm_id",
        F.concat_ws("/", F.lit("https://www.openstreetmap.org"), "osm_type", F.col("osm_id").cast("string")).alias("url"),
    )
