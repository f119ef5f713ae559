"""State and provincial parks: official rows, listings, map supplement, merge, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark import fixed_values as fv
from waymark.functions import geo, parks
from waymark.functions.tags import name_of, tag
from waymark.functions.text import (
    expand_designation,
    first_filled,
    gis_unit_key,
    listing_key,
    listing_slug,
    matches,
    park_display_name,
    park_unit_id,
    park_unit_key,
    slugify,
    state_park_key,
    text,
)
from waymark.operators import matching, parkmerge, qa, rollup, spatial
from waymark.operators.ranking import best_per_key, first_per_key, rank_in_groups
from waymark.operators.textjoin import contains_join


def map_records(points: DataFrame, country: str) -> DataFrame:
    """Park records from tagged points (osm_type, osm_id, lat, lon, tags)."""
    boxes = (fv.PROVINCE_BOXES, ()) if country == "CA" else (fv.STATE_BOXES, fv.STATE_OVERLAPS)
    rows = points.withColumn("_c", parks.classify_unit(country)).where("_c is not null")
    rows = rows.withColumn("state", spatial.box_code("lat", "lon", *boxes)).where("state is not null")
    site = F.trim(text(first_filled(tag("website"), tag("contact:website"), tag("url"))))
    url = F.when(site.rlike("(?i)^https?://"), site).otherwise(F.lit(""))
    return rows.withColumn("name", name_of()).select(
        park_unit_id(F.lit(country), "state", "name", "osm_type", "osm_id").alias("id"),
        F.lit(country).alias("country"), "state", "name",
        F.col("_c.designation").alias("designation"), F.col("_c.category").alias("category"),
        geo.half_up("lat", 1e5).alias("lat"), geo.half_up("lon", 1e5).alias("lon"),
        F.lit("osm").alias("source"), url.alias("url"),
        F.trim(text(first_filled(tag("ref"), tag("ref:US:state_park"), tag("protected_area:ref")))).alias("official_code"),
        F.concat_ws("/", "osm_type", F.col("osm_id").cast("string")).alias("osm_id"),
        F.col("_c.confidence").alias("osm_confidence"), (url == "").alias("needs_review"),
    )


def official_records(features: DataFrame, country: str = "US") -> DataFrame:
    """Best row per code (or name) of an admin's official features (admin, name, code, url, lat, lon, seq)."""
    box = fv.CA_BOX if country == "CA" else fv.US_WIDE_BOX
    rows = features.withColumn("_c", parks.classify_official_name("name", F.lit(country), True))
    rows = rows.where(F.col("_c").isNotNull() & geo.valid_coordinate("lat", "lon", box))
    rows = rows.withColumn("_key", F.coalesce(F.nullif(text("code"), F.lit("")), F.lower("name")))
    score = F.when(text("url") != "", F.lit(10)).otherwise(F.lit(0)) + F.when(text("code") != "", F.lit(5)).otherwise(F.lit(0))
    best = best_per_key(rows, ["admin", "_key"], score, "seq")
    return best.select(
        "admin", "name", F.col("_c.designation").alias("designation"), F.col("_c.category").alias("category"),
        "code", "url", geo.half_up("lat", 1e5).alias("lat"), geo.half_up("lon", 1e5).alias("lon"), "seq",
    )


def listings_from_units(units: DataFrame) -> DataFrame:
    """One listing per admin and name key from official units."""
    name = F.trim(F.regexp_replace("name", r"(?i)\s+(State|Provincial)\s+(Park|Historic Site).*$", ""))
    rows = units.withColumn("key", listing_key("name")).withColumn("name", name).where("key <> ''")
    return rollup.named_groups(rows, ["admin", "key"], "name", "category", "seq").withColumn("slug", slugify("key"))


def pick_listing_source(counts: DataFrame) -> DataFrame:
    """Largest viable listing source per admin (admin, source, rank, listings, least)."""
    viable = counts.where(F.col("listings") >= F.col("least"))
    return best_per_key(viable, ["admin"], F.col("listings"), "rank")


def match_units_to_listings(units: DataFrame, listings: DataFrame, overrides: DataFrame, slug_patterns: Sequence[tuple[str, str, str]] = ()) -> DataFrame:
    """Each unit's listing: page slug, override, then key rules in listing order.

    ``units``: id, admin, name, url; ``listings``: admin, slug, key, seq; ``overrides``: admin, key,
    slug. The prefix rules are found by joins on leading words and leading text, not by comparing
    every unit with every listing. Output: id, slug, rule.
    """
    rows = units.withColumn("_key", gis_unit_key("name")).withColumn(
        "_slug", listing_slug("url", slug_patterns, "admin") if slug_patterns else F.lit(None).cast("string")
    )
    entries = listings.select("admin", F.col("slug").alias("l_slug"), F.col("key").alias("l_key"), F.col("seq").alias("l_seq"))

    def tagged(df: DataFrame, rule: str, rank: int) -> DataFrame:
        return df.select("id", F.lit(rank).alias("rank"), "l_seq", F.col("l_slug").alias("slug"), F.lit(rule).alias("rule"))

    by_url = tagged(rows.join(entries, (rows["_slug"] == entries["l_slug"]) & (rows["admin"] == entries["admin"])), "url", 0)
    keyed = rows.where("_key <> ''")
    over = overrides.select(F.col("admin").alias("o_admin"), F.col("key").alias("o_key"), F.col("slug").alias("o_slug"))
    with_override = keyed.join(over, (keyed["admin"] == over["o_admin"]) & (keyed["_key"] == over["o_key"]))
    by_override = tagged(
        with_override.join(
            entries, (with_override["o_slug"] == entries["l_slug"]) & (with_override["o_admin"] == entries["admin"])
        ),
        "override", 1,
    )
    blocked = with_override.select("id").distinct()
    open_rows = keyed.join(blocked, "id", "left_anti").select("id", F.col("admin").alias("u_admin"), "_key")
    # a listing key that leads the unit key: join on every word prefix of the unit key
    prefixes = _word_leads(open_rows, "_key")
    leads = tagged(
        prefixes.join(entries, (prefixes["u_admin"] == entries["admin"]) & (prefixes["_lead"] == entries["l_key"])), "key", 2
    )
    # a unit key that leads the listing key: join on every text prefix of the listing key
    spread = entries.where(F.length("l_key") >= 4).withColumn(
        "_lead",
        F.explode(F.transform(F.sequence(F.lit(4), F.length("l_key")), lambda n: F.col("l_key").substr(F.lit(1), n))),
    )
    long_keys = open_rows.where(F.length("_key") >= 4)
    led = tagged(
        long_keys.join(spread, (long_keys["u_admin"] == spread["admin"]) & (long_keys["_key"] == spread["_lead"])), "key", 2
    )
    # dashes and blanks count alike
    plain = F.regexp_replace("_key", "-", " ")
    alike = tagged(
        open_rows.join(
            entries, (open_rows["u_admin"] == entries["admin"]) & (plain == F.regexp_replace("l_key", "-", " "))
        ),
        "key", 2,
    )
    hits = by_url.unionByName(by_override).unionByName(leads).unionByName(led).unionByName(alike)
    return first_per_key(hits, ["id"], ["rank", "l_seq", "slug"]).select("id", "slug", "rule")


def listing_records(units: DataFrame, matches_: DataFrame, listings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one row per matched listing, its unit rows): mean coordinate, first code, unit count."""
    rows = units.join(matches_, "id")
    per_slug = rows.groupBy("admin", "slug").agg(
        F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.count(F.lit(1)).alias("unit_count"),
        F.min_by("code", "seq").alias("official_code"),
    )
    alternates = rank_in_groups(
        rows.where(text("code") != "").select("admin", "slug", "name", "code", "seq"), ["admin", "slug"], ["seq"], "position"
    )
    return per_slug.join(listings.select("admin", "slug", "name"), ["admin", "slug"]), alternates


def gate_listing(per_admin: DataFrame) -> DataFrame:
    """Which source an admin publishes (admin, units, listed, gis_backed): listing, official or map."""
    weak = (
        F.coalesce(F.col("gis_backed"), F.lit(False))
        & (F.col("units") >= 5)
        & (F.col("listed") < F.least(F.col("units") * 0.85, F.col("units") - 2))
    )
    return per_admin.withColumn(
        "choice",
        F.when((F.col("listed") > 0) & ~weak, F.lit("listing"))
        .when(F.col("units") > 0, F.lit("official"))
        .otherwise(F.lit("map")),
    )


def _word_leads(rows: DataFrame, key: str) -> DataFrame:
    """Every leading word run of a key column, as ``_lead``."""
    words = F.split(key, " ")
    runs = F.transform(F.sequence(F.lit(1), F.size(words)), lambda n: F.array_join(F.slice(words, F.lit(1), n), " "))
    return rows.withColumn("_lead", F.explode(runs))


def map_name_match(listings: DataFrame, map_rows: DataFrame, least_listings: int = 3, least_matches: int = 3) -> DataFrame:
    """Listings matched to map rows of the same admin by name, each map row used once.

    ``listings``: admin, slug, key, seq; ``map_rows``: id, admin, name, seq. Keys are compatible when
    equal, when one leads the other by whole words, or when the map name holds a key of six or more
    characters. Listings in order take their first free map row; admins need enough listings and
    matches. Output: admin, slug, id.
    """
    enough = listings.groupBy("admin").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_listings).select("admin")
    mine = listings.join(enough, "admin", "left_semi").where("key <> ''")
    theirs = map_rows.select(
        "admin", "seq", "id", F.concat_ws("\u0001", listing_key("name"), state_park_key("name")).alias("key")
    )
    l_keys = mine.select("admin", F.col("key").alias("l_key")).distinct()
    r_keys = theirs.select(
        "admin",
        F.col("key").alias("r_key"),
        F.substring_index("key", "\u0001", 1).alias("short"),
        F.substring_index("key", "\u0001", -1).alias("full"),
    ).distinct()
    lead = _word_leads(r_keys.where("short <> ''"), "short").select("admin", F.col("_lead").alias("l_key"), "r_key")
    led = _word_leads(l_keys, "l_key").select("admin", "l_key", F.col("_lead").alias("short"))
    inside = contains_join(l_keys.where(F.length("l_key") >= 6), r_keys, "l_key", "full")
    compatible = (
        l_keys.join(lead, ["admin", "l_key"]).select("admin", "l_key", "r_key")
        .unionByName(led.join(r_keys, ["admin", "short"]).select("admin", "l_key", "r_key"))
        .unionByName(
            inside.select(F.col("needle").alias("l_key"), F.col("body").alias("full"))
            .join(r_keys, "full")
            .join(l_keys, ["admin", "l_key"], "left_semi")
            .select("admin", "l_key", "r_key")
        )
    )
    pairs = matching.first_free_match(mine, theirs, compatible, "slug", "id", ["admin"])
    named = pairs.join(mine.select("admin", F.col("slug").alias("left_key")), "left_key")
    strong = named.groupBy("admin").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") >= least_matches).select("admin")
    return named.join(strong, "admin", "left_semi").select(
        "admin", F.col("left_key").alias("slug"), F.col("right_key").alias("id")
    )


def standalone(listings: DataFrame, parents: DataFrame) -> DataFrame:
    """Listings that are no visitor-center page folded into a parent (parents: admin, slug)."""
    open_ones = listings.where(text("listing_kind") != "visitor_center")
    return open_ones.join(parents.select("admin", "slug").distinct(), ["admin", "slug"], "left_anti")


def map_supplement(map_rows: DataFrame, official: DataFrame, verified: DataFrame) -> DataFrame:
    """Map rows of admins without any official row that pass the catalogue filter."""
    tagged = map_rows.join(verified.select(F.col("admin").alias("state"), F.lit(True).alias("_v")).distinct(), "state", "left")
    kept = tagged.where(parks.keep_catalog_record(verified_admin="_v")).drop("_v")
    return kept.join(official.select("state").distinct(), "state", "left_anti")


def master(official: DataFrame, supplement: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(merged, conflicts) of official rows, then the supplement, with display names."""
    rows = official.withColumn("_rank", F.lit(0)).unionByName(supplement.withColumn("_rank", F.lit(1)), allowMissingColumns=True)
    ranked = rank_in_groups(rows.withColumn("_all", F.lit(0)), ["_all"], ["_rank", "state", "id"], "seq").drop("_all", "_rank")
    merged, conflicts = parkmerge.merge_parks(ranked)
    return with_display(merged), conflicts


def with_display(rows: DataFrame) -> DataFrame:
    """Designation abbreviations spelled out, and the display name."""
    raw = F.trim(text("name"))
    historic_park, monument, park = (matches(raw, p) for p in (r"\sSHP$", r"\sSHM$", r"\sSP$"))
    spelled = (
        F.when(historic_park, F.lit("State Historic Park"))
        .when(monument, F.lit("State Historic Monument"))
        .when(park, F.lit("State Park"))
    )
    category = F.when(historic_park | monument, F.lit("historic_site")).when(park, F.lit("park"))
    out = rows.withColumn("_spelled", spelled).withColumn("_category", category).withColumn("_full", expand_designation("name"))
    return (
        out.withColumn("name", F.when(F.col("_spelled").isNotNull(), F.col("_full")).otherwise(F.col("name")))
        .withColumn("designation", F.coalesce("_spelled", "designation"))
        .withColumn("category", F.coalesce("_category", "category"))
        .withColumn("display_name", park_display_name("name", "designation", fv.PARK_TYPE_IN_NAME))
        .drop("_spelled", "_category", "_full")
    )


def resolve_parent(rows: DataFrame, catalogue: DataFrame, radius_m: float, key: str = "id") -> DataFrame:
    """State-park parent: official code, name in the state, name anywhere, nearest in the state.

    ``rows``: id, code, unit_name, state, lat, lon; ``catalogue``: park_id, seq, code, name, state,
    lat, lon. Adds parent and parent_by.
    """
    named = catalogue.withColumn("_name", park_unit_key("name")).withColumn(
        "_scoped", F.when(park_unit_key("name") != "", F.concat_ws(":", "state", park_unit_key("name")))
    )
    unit = park_unit_key("unit_name")
    steps = [
        ("code", F.nullif(F.trim(text("code")), F.lit("")), catalogue, "code"),
        ("state-name", F.when(unit != "", F.concat_ws(":", "state", unit)), named, "_scoped"),
        ("name", F.nullif(unit, F.lit("")), named, "_name"),
    ]
    resolved = matching.first_resolved(rows, steps, key, "park_id", "parent")
    near = spatial.nearest_within(
        resolved.where("parent is null").select(key, "lat", "lon", "state"), catalogue.select("park_id", "lat", "lon", "state"),
        radius_m, "m", ["state"], key, "park_id",
    ).select(F.col(key).alias("_id"), F.col("near.park_id").alias("_near"))
    out = resolved.join(near, resolved[key] == near["_id"], "left")
    return (
        out.withColumn("parent_by", F.coalesce("parent_by", F.when(F.col("_near").isNotNull(), F.lit("nearest")), F.lit("none")))
        .withColumn("parent", F.coalesce("parent", "_near"))
        .drop("_id", "_near")
    )


def merge_matrix(base: DataFrame, overrides: DataFrame, hits: DataFrame, most: int | None = None) -> DataFrame:
    """Source matrix: base, patched by overrides, then the best hub hit where still unverified.

    ``base``/``overrides``: admin, status, query_url, feature_count; ``hits``: admin, title,
    query_url, count (best hit per admin); ``most`` refuses hits with more features.
    """
    o = overrides.select(*[F.col(c).alias(f"o_{c}") for c in overrides.columns])
    h = hits.select(*[F.col(c).alias(f"h_{c}") for c in hits.columns])
    rows = base.join(o, F.col("admin") == F.col("o_admin"), "left").join(h, F.col("admin") == F.col("h_admin"), "left")
    status = F.coalesce("o_status", "status")
    usable = (
        F.col("h_admin").isNotNull()
        & ~F.coalesce(status.isin("verified", "blocked"), F.lit(False))
        & ~matches("h_title", fv.HUB_TITLE_EXCLUDED)
        & ~matches("h_title", "USA_|National ")
        & (F.lit(True) if most is None else F.coalesce(F.col("h_count"), F.lit(0)) <= most)
    )
    return rows.select(
        "admin",
        F.when(usable, F.lit("verified")).otherwise(status).alias("status"),
        F.when(usable, F.col("h_query_url")).otherwise(F.coalesce("o_query_url", "query_url")).alias("query_url"),
        F.when(usable, F.col("h_count")).otherwise(F.coalesce("o_feature_count", "feature_count")).alias("feature_count"),
        F.when(usable, F.lit("hub")).when(F.col("o_admin").isNotNull(), F.lit("override")).otherwise(F.lit("base")).alias("origin"),
    )


def rank_hub_hits(hits: DataFrame, limit: int | None = None) -> DataFrame:
    """Hits per state (admin, state_name, title, count, seq) by falling score; ``limit`` keeps the first of each state."""
    scored = hits.withColumn("score", parks.hub_title_score("title", "state_name", "count")).where(
        (F.col("count") > 0) & (F.col("score") > 0)
    )
    return rollup.samples_per_group(scored, ["admin"], [F.desc("score"), F.asc("seq")], limit).withColumnRenamed("sample_no", "hit_rank")


def four_source_status(counts: DataFrame) -> DataFrame:
    """Presence and agreement of four sources per admin (gis, osm, website, wiki, plotted counts)."""
    present = [F.coalesce(F.col(c) > 0, F.lit(False)) for c in ("gis", "osm", "website", "wiki")]
    four = present[0] & present[1] & present[2] & present[3]
    agree = rollup.counts_agree("gis", "website", "wiki", "plotted")
    missing = F.array_join(
        F.filter(
            F.array(*[F.when(~p, F.lit(n)) for p, n in zip(present, ("GIS", "OSM", "website", "Wikipedia"))]),
            lambda v: v.isNotNull(),
        ),
        ",",
    )
    return counts.withColumn("four_present", four).withColumn("agree", agree).withColumn(
        "completed", F.col("four_present") & F.col("agree")
    ).withColumn("missing", missing)


def leakage(rows: DataFrame, verified: DataFrame) -> DataFrame:
    """Published rows that the catalogue filter would refuse, with the reason, and doubtful map rows."""
    tagged = rows.join(verified.select(F.col("admin").alias("state"), F.lit(True).alias("_v")).distinct(), "state", "left")
    reason = parks.reject_reason(verified_admin="_v")
    doubtful = (
        (F.col("source") == "osm") & F.coalesce(F.col("_v"), F.lit(False)) & (text("osm_confidence") != "protection_title")
    )
    return (
        tagged.withColumn("reason", reason)
        .withColumn("finding", F.when(F.col("reason").isNotNull(), F.lit("leak")).when(doubtful, F.lit("suspicious")))
        .where("finding is not null")
        .drop("_v")
    )


#: fixed values: columns that every published park fills, and the least share of an official source
REQUIRED_FIELDS = ("id", "country", "state", "name", "display_name", "category")
OFFICIAL_SHARE = 0.5


def catalogue_checks(master: DataFrame, embed: DataFrame, verified: DataFrame, least: int) -> DataFrame:
    """Validator of a park master: counts, required fields, unique ids, coordinates, leaks, embed.

    ``master``: the required fields, lat, lon and what :func:`leakage` asks for; ``least``: records one would expect.
    """
    bad = F.col("lat").isNull() | F.col("lon").isNull() | F.isnan("lat") | F.isnan("lon")
    leaks = leakage(master, verified).where("finding = 'leak'")
    measures = {
        "master": (master, {"records": F.count(F.lit(1)), "bad_coordinates": qa.rows_where(bad)} | {f"no_{c}": qa.rows_without(c) for c in REQUIRED_FIELDS}),
        "ids": (qa.duplicate_keys(master.where(text("id") != ""), ["id"]), {"repeated": F.count(F.lit(1))}),
        "leaks": (leaks, {"leaked": F.count(F.lit(1))}),
        "embed": (embed, {"embedded": F.count(F.lit(1))}),
    }
    rules = [
        qa.Rule("records", "records", least=1), qa.Rule("expected records", "records", least=least, level="warn"),
        qa.Rule("repeated ids", "repeated", most=0), qa.Rule("bad coordinates", "bad_coordinates", most=0),
        qa.Rule("leaks", "leaked", most=0), qa.Rule("embed equals master", "embedded - records", 0, 0),
    ]
    return qa.expectations(measures, rules + [qa.Rule(f"without {c}", f"no_{c}", most=0) for c in REQUIRED_FIELDS])


def official_coverage(master: DataFrame, expected: DataFrame) -> DataFrame:
    """(admin, expected, n, passed): verified official sources of which at least half is in the master."""
    asked = expected.where("expected > 0").select("admin", "expected", (F.col("expected") * OFFICIAL_SHARE).alias("least"))
    have = qa.group_minimums(master.withColumnRenamed("state", "admin"), "admin", asked)
    return have.join(asked.select("admin", "expected"), "admin").select("admin", "expected", "n", "passed")
