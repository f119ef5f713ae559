"""Text normalisers, ids and URL parts as Column functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.functions.geo import col


def text(value) -> Column:
    """Null-safe text."""
    return F.coalesce(col(value), F.lit(""))


def matches(value, pattern: str) -> Column:
    """Case-insensitive regex search; null counts as empty text."""
    return text(value).rlike("(?i)" + pattern)


def replace(value: Column, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(value, pattern, by)


def first_filled(*values) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(col(v), F.lit("")) for v in values])


def join_filled(sep: str, *values) -> Column:
    """Join the non-empty values."""
    return F.concat_ws(sep, *[F.nullif(col(v), F.lit("")) for v in values])


def slugify(value, length: int | None = None, empty: str = "unknown") -> Column:
    """Lower case, runs of other characters to one dash, one dash trimmed at each end; cut only at a given length."""
    base = F.coalesce(F.nullif(col(value), F.lit("")), F.lit(empty))
    dashed = replace(F.lower(base), "[^a-z0-9]+", "-")
    bare = replace(dashed, "^-|-$")
    return bare if length is None else F.substring(bare, 1, length)


def brand_token(value) -> Column:
    """Brand text: lower case, quotes dropped, other runs to one blank."""
    bare = replace(F.lower(text(value)), "['`´]")
    return F.trim(replace(bare, "[^a-z0-9]+", " "))


def campground_key(name) -> Column:
    """Campground name without its type words, letters and digits only."""
    bare = replace(F.lower(text(name)), r"\b(campground|camp|camping area|cg)\b")
    return replace(bare, "[^a-z0-9]")


def state_park_key(name) -> Column:
    """State or provincial park name without its designation."""
    out = F.lower(text(name))
    for phrase in ("state park", "provincial park", "parc provincial", "state historic site", "provincial historic site"):
        out = replace(out, rf"\b{phrase}\b")
    return F.trim(replace(out, "[^a-z0-9]+", " "))


def park_unit_key(name) -> Column:
    """Park name reduced to its proper part, for parent lookups."""
    out = F.lower(text(name))
    out = replace(out, r"\b(state|provincial)\b")
    out = replace(out, r"\b(park|historic|historical|site|monument|memorial|preserve|recreation area)\b")
    out = replace(out, r"\b(sp|shp|shm|pp|php|hs)\b")
    return F.trim(replace(out, "[^a-z0-9]+", " "))


def visitor_center_key(name) -> Column:
    out = F.lower(text(name))
    for phrase in ("visitor center", "contact station", "information"):
        out = replace(out, rf"\b{phrase}\b")
    return F.trim(replace(out, "[^a-z0-9]+", " "))


def amenity_key(name) -> Column:
    out = replace(
        F.lower(text(name)), r"\b(campground|camp|campsite|camping area|picnic area|restroom|toilet)\b"
    )
    return F.trim(replace(out, "[^a-z0-9]+", " "))


def federal_place_key(name) -> Column:
    """Canadian federal place name without country and designation, English or French."""
    out = text(name)
    for tail in (
        r"\s+of Canada$",
        r"\s+du Canada$",
        r"\s+National (Park|Historic Site|Park Reserve|Marine Conservation Area).*$",
        r"\s+Parc national.*$",
        r"\s+Lieu historique national.*$",
        r"\s+Réserve de parc national.*$",
        r"\s+Zone marine nationale de conservation.*$",
    ):
        out = replace(out, "(?i)" + tail)
    return F.lower(F.trim(out))


def plaza_key(name) -> Column:
    """Service-plaza place name without the chain name and direction words."""
    out = F.lower(text(name))
    out = replace(out, r"\bon\s*route\b")
    out = replace(out, r"\b(north|south|east|west|northeast|northwest|southeast|southwest)\b")
    return replace(out, "[^a-z0-9]")


def listing_key(name) -> Column:
    """Key of a public listing name: tail after the designation cut, then the park key."""
    out = replace(text(name), r"(?i)\s+(State|Provincial)\s+(Park|Historic Site|Natural Area).*$")
    out = replace(out, r"(?i)\s+(SP|SHP|SB|SRA|SMR|SVRA|SNR|SHM)$")
    out = replace(out, r"(?i)\s+and Trailway$")
    return state_park_key(F.trim(out))


def gis_unit_key(name) -> Column:
    """Key of a mapped unit name: sub-unit part and suffix dropped, then the park key."""
    base = F.trim(text(name))
    centre = F.regexp_extract(base, r"(?i)^World Birding Center\s*-\s*(.+)$", 1)
    base = F.when(centre != "", F.trim(centre)).otherwise(F.trim(F.split(base, " - ").getItem(0)))
    base = F.trim(replace(base, r"(?i)\s+(Trailway|Trail Corridor|Visitor Center|Reservior Trailway)$"))
    return F.trim(replace(state_park_key(base), r"(?i)\s+state park$"))


def names_similar(a: Column, b: Column) -> Column:
    """Equal or one holds the other; both non-empty."""
    return (a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a))


def title_case_key(key) -> Column:
    """Upper-case the first letter of each word and leave the rest."""
    words = F.filter(F.split(F.trim(text(key)), r"\s+"), lambda w: w != "")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), w.substr(F.lit(2), F.length(w)))), " "
    )


def fill_template(template, fields: Mapping[str, Column]) -> Column:
    """Replace each ``{field}`` of a template column by the field's text."""
    out = col(template)
    for name, value in fields.items():
        out = F.replace(out, F.lit("{" + name + "}"), text(value.cast("string")))
    return F.trim(replace(out, r"\s+", " "))


def coordinate_tag(lat, lon) -> Column:
    """``lat*1e4-|lon|*1e4`` used inside ids, or ``nocoord``."""
    lat, lon = col(lat), col(lon)

    def whole(c: Column) -> Column:
        return F.floor(c * 1e4 + 0.5).cast("string")

    return F.when(lat.isNotNull() & lon.isNotNull(), F.concat_ws("-", whole(lat), whole(F.abs(lon)))).otherwise(
        F.lit("nocoord")
    )


def poi_id(prefix: str, region: str, state, name, osm_id) -> Column:
    return F.concat_ws(
        "-",
        F.lit(prefix),
        F.lit(region),
        F.coalesce(F.nullif(col(state), F.lit("")), F.lit("XX")),
        slugify(name),
        col(osm_id).cast("string"),
    )


def amenity_id(prefix: str, parent, kind, camp_tier, name, lat, lon) -> Column:
    parent_key = F.upper(F.coalesce(F.nullif(col(parent), F.lit("")), F.lit("unk")))
    tier = F.when((col(kind) == "campground") & (text(camp_tier) != ""), F.concat(F.lit("-"), col(camp_tier))).otherwise(
        F.lit("")
    )
    base = slugify(name)
    return F.concat(
        F.lit(f"AMEN-{prefix}-"),
        parent_key,
        F.lit("-"),
        col(kind),
        tier,
        F.lit("-"),
        F.when(base == "", col(kind)).otherwise(base),
        F.lit("-"),
        coordinate_tag(lat, lon),
    )


def visitor_center_id(park_code, name, lat, lon, system: str = "NPS") -> Column:
    code = F.upper(F.coalesce(F.nullif(col(park_code), F.lit("")), F.lit("unk")))
    base = slugify(name, empty="visitor-center")
    return F.concat(
        F.lit(f"VC-{system}-"),
        code,
        F.lit("-"),
        F.when(base == "", F.lit("visitor-center")).otherwise(base),
        F.lit("-"),
        coordinate_tag(lat, lon),
    )


def park_unit_id(country, admin, name, osm_type, osm_id) -> Column:
    """``sp-country-admin-slug-typeid``."""
    base = slugify(name)
    suffix = F.when(
        text(col(osm_id).cast("string")) != "",
        F.concat(F.lit("-"), F.coalesce(F.nullif(col(osm_type), F.lit("")), F.lit("n")), col(osm_id).cast("string")),
    ).otherwise(F.lit(""))
    return F.concat(
        F.lit("sp-"),
        F.lower(col(country)),
        F.lit("-"),
        F.lower(F.coalesce(F.nullif(col(admin), F.lit("")), F.lit("xx"))),
        F.lit("-"),
        F.when(base == "", F.lit("unit")).otherwise(base),
        suffix,
    )


def expand_designation(name) -> Column:
    """Spell out a trailing SHP, SHM or SP."""
    n = F.trim(text(name))
    return (
        F.when(matches(n, r"\sSHP$"), replace(n, r"(?i)\sSHP$", " State Historic Park"))
        .when(matches(n, r"\sSHM$"), replace(n, r"(?i)\sSHM$", " State Historic Monument"))
        .when(matches(n, r"\sSP$"), replace(n, r"(?i)\sSP$", " State Park"))
        .otherwise(n)
    )


def park_display_name(name, designation, type_in_name: str) -> Column:
    """Name with its designation, unless the name already says what it is."""
    n, d = expand_designation(name), F.trim(text(designation))
    return (
        F.when(n == "", d)
        .when(d == "", n)
        .when(F.contains(F.lower(n), F.lower(d)) | matches(n, type_in_name), n)
        .otherwise(F.concat_ws(" ", n, d))
    )


def with_campground_suffix(name) -> Column:
    n = F.trim(text(name))
    return F.when((n == "") | matches(n, r"\bcampground\s*$"), n).otherwise(F.concat(n, F.lit(" Campground")))


def pitch_campground_code(code) -> Column:
    """Campground part of a pitch code: the pitch suffix is dropped when it looks like one."""
    raw = F.upper(F.trim(text(code)))
    parts = F.filter(F.split(raw, "-"), lambda p: p != "")
    n = F.size(parts)
    park = F.get(parts, F.lit(0))
    second = F.get(parts, F.lit(1))
    stem = replace(second, r"[0-9]+$")
    last = F.get(parts, n - 1)
    pitch = (
        last.rlike(r"^C[0-9]+$")
        | last.rlike(r"^[A-Z]{1,2}[0-9]+$")
        | (last.rlike(r"^[A-Z0-9]{1,5}$") & last.rlike("[0-9]"))
        | last.rlike(r"^[A-Z]{1,3}[0-9]{1,2}[A-Z]?$")
    )
    two = F.when((stem != second) & stem.rlike("^[A-Z]{2,5}$"), F.concat_ws("-", park, stem)).otherwise(
        F.array_join(parts, "-")
    )
    return (
        F.when(raw == "", F.lit(""))
        .when((n < 2) | ~park.rlike("^[A-Z]{2,5}$"), raw)
        .when(n == 2, two)
        .when(pitch, F.array_join(F.slice(parts, F.lit(1), F.greatest(n - 1, F.lit(1))), "-"))
        .otherwise(raw)
    )


def lookup(value, table: Mapping, default=None) -> Column:
    """Fixed-dictionary lookup as one expression."""
    chain = F.when(F.lit(False), F.lit(None))
    for k, v in table.items():
        chain = chain.when(col(value) == k, F.lit(v))
    return chain.otherwise(default if isinstance(default, Column) else F.lit(default))


def url_path_part(url, index: int) -> Column:
    """Non-empty path segment of a URL by 0-based index."""
    path = replace(replace(text(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*"), r"[?#].*$")
    return F.get(F.filter(F.split(path, "/"), lambda p: p != ""), F.lit(index))


def state_from_store_url(url) -> Column:
    """Region code from ``/us/xx/...`` or ``/ca/xx/...`` store page paths."""
    country = url_path_part(url, 0)
    return F.when(country.isin("us", "ca"), F.upper(text(url_path_part(url, 1)))).otherwise(F.lit(""))


def federal_park_slug(url) -> Column:
    """Park slug of a Canadian federal park page address."""
    new = F.regexp_extract(
        text(url), r"(?i)(?:pc\.gc\.ca|parks\.canada\.ca)/(?:en|fr)/pn-np/[a-z]{2}/([^/?#]+)", 1
    )
    old = F.regexp_extract(text(url), r"(?i)parks\.canada\.ca/pn-np/[a-z]{2}/([^/?#]+)", 1)
    return F.lower(F.when(new != "", new).otherwise(old))


def listing_slug(url, patterns: Sequence[tuple[str, str, str]], admin) -> Column:
    """Listing slug from a unit's page address by the admin's pattern (admin, regex, prefix)."""
    chain = F.when(F.lit(False), F.lit(None).cast("string"))
    for code, pattern, prefix in patterns:
        hit = F.lower(F.regexp_extract(text(url), "(?i)" + pattern, 1))
        chain = chain.when(col(admin) == code, F.when(hit != "", F.concat(F.lit(prefix), hit)))
    return chain


def state_list(value) -> Column:
    """Codes of a ``,`` or ``;`` separated list, trimmed and upper-cased."""
    return F.filter(F.transform(F.split(text(value), "[,;]"), lambda s: F.upper(F.trim(s))), lambda s: s != "")


def add_absent(array, value, condition: Column) -> Column:
    """Append a value when the condition holds and it is not there yet."""
    have = F.coalesce(col(array), F.array().cast("array<string>"))
    return F.when(condition & ~F.array_contains(have, value), F.concat(have, F.array(F.lit(value)))).otherwise(have)


def drop_values(array, *values: str) -> Column:
    return F.filter(col(array), lambda v: ~v.isin(*values))


def hours_summary(standard: str = "standard_hours", exceptions: str = "exceptions") -> Column:
    """Struct (has_hours, summary, seasonal_note) from weekday hours and seasonal exceptions.

    ``standard`` is a weekday map, ``exceptions`` an array of (name, start_date, end_date, hours).
    """
    from waymark.fixed_values import WEEKDAYS

    values = F.array(*[F.col(standard)[d] for d in WEEKDAYS])
    distinct = F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (v != "")))
    summary = F.array_join(distinct, "; ")

    def note(ex: Column) -> Column:
        span = F.concat_ws("–", text(ex["start_date"]), text(ex["end_date"]))
        label = F.coalesce(F.nullif(ex["name"], F.lit("")), F.when(span == "–", F.lit("")).otherwise(span))
        hours = F.coalesce(F.get(F.map_values(ex["hours"]), F.lit(0)), F.lit(""))
        return F.when(hours != "", F.concat(label, F.lit(": "), hours)).otherwise(label)

    notes = F.filter(F.transform(F.col(exceptions), note), lambda v: v != "")
    notes = F.coalesce(notes, F.array().cast("array<string>"))
    summary = F.coalesce(summary, F.lit(""))
    return F.struct(
        ((summary != "") | (F.size(notes) > 0)).alias("has_hours"),
        summary.alias("summary"),
        F.array_join(notes, " | ").alias("seasonal_note"),
    )


def season(flag, description) -> Column:
    """Struct (is_seasonal, description) from a Yes/No flag and a free text."""
    flag, desc = F.trim(text(flag)), F.trim(text(description))
    return F.struct(
        F.when(flag == "Yes", F.lit(True)).when(flag == "No", F.lit(False)).when(desc != "", F.lit(True)).alias("is_seasonal"),
        F.when((desc == "") & (flag == "Yes"), F.lit("Seasonal operation"))
        .when((desc == "") & (flag == "No"), F.lit("Year-round"))
        .otherwise(desc)
        .alias("description"),
    )
