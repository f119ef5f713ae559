"""Predicates and projections over map-element tags (``tags`` is MAP<STRING,STRING>)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark import fixed_values as fv
from waymark.functions.text import first_filled, join_filled, matches, text


def tag(name: str, tags: str = "tags") -> Column:
    return F.try_element_at(F.col(tags), F.lit(name))


def _is(name: str, *values: str, tags: str = "tags") -> Column:
    return F.coalesce(tag(name, tags).isin(*values), F.lit(False))


def _low(name: str, tags: str = "tags") -> Column:
    return F.lower(text(tag(name, tags)))


def name_of(tags: str = "tags", default: str | None = None) -> Column:
    """name, name:en, name:fr, then the default; trimmed."""
    found = first_filled(tag("name", tags), tag("name:en", tags), tag("name:fr", tags))
    return F.trim(F.coalesce(found, F.lit(default or "")))


def include_historic(tags: str = "tags") -> Column:
    kind = F.trim(text(tag("historic", tags)))
    unnamed = name_of(tags) == ""
    return (text(tag("historic", tags)) != "") & ~((kind.isin(*fv.HISTORIC_EXCLUDED) | (kind == "yes")) & unnamed)


def poi_kind(kind: str, tags: str = "tags") -> Column:
    """Tag test of a POI layer."""
    if kind == "playground":
        return _is("leisure", "playground", tags=tags)
    if kind == "viewpoint":
        return _is("tourism", "viewpoint", tags=tags)
    if kind == "historic":
        return include_historic(tags)
    raise ValueError(kind)


def poi_tier(name, kind: str, subtype=None) -> Column:
    """``qa`` for empty or generic names, else ``default``."""
    low = F.lower(F.trim(text(name)))
    generic = (low == "") | low.isin(*fv.GENERIC_POI_NAMES)
    return F.when(generic, F.lit("qa")).otherwise(F.lit("default"))


def fuel_candidate(tags: str = "tags") -> Column:
    return (
        _is("amenity", "fuel", tags=tags)
        | _is("shop", "fuel", tags=tags)
        | _is("highway", "services", "rest_area", tags=tags)
    )


def prune_tags(keys: list[str], tags: str = "tags") -> Column:
    """Keep only the listed keys with a non-empty value."""
    return F.map_filter(F.col(tags), lambda k, v: k.isin(*keys) & v.isNotNull() & (v != ""))


def drivable(tags: str = "tags", lean: bool = True) -> Column:
    """Road open to motor vehicles; ``lean`` keeps through roads only."""
    highway = text(tag("highway", tags))
    vehicle, access = _low("motor_vehicle", tags), _low("access", tags)
    allowed = fv.LEAN_HIGHWAYS if lean else fv.WIDE_HIGHWAYS
    return (
        F.when((highway == "") | highway.isin(*fv.NON_DRIVABLE_HIGHWAYS), F.lit(False))
        .when((vehicle == "no") | (access == "no"), F.lit(False))
        .when(highway == "track", vehicle.isin("yes", "destination", "permissive"))
        .otherwise(highway.isin(*allowed))
    )


def foot_path(tags: str = "tags") -> Column:
    return _is("highway", *fv.PATH_HIGHWAYS, tags=tags) & ~_low("motor_vehicle", tags).isin("yes", "destination")


def parking(tags: str = "tags") -> Column:
    return (
        _is("amenity", "parking", tags=tags)
        | _is("highway", "rest_area", tags=tags)
        | _is("rest_area", "yes", tags=tags)
        | _is("parking", "yes", "surface", "lane", tags=tags)
    )


def visitor_center_candidate(tags: str = "tags") -> Column:
    return (
        _is("amenity", "ranger_station", tags=tags)
        | _is("tourism", "information", tags=tags)
        | _is("information", "visitor_centre", "visitor_center", tags=tags)
    )


def named_park(tags: str = "tags") -> Column:
    """Named public park or recreation ground."""
    open_access = ~F.lower(F.trim(text(tag("access", tags)))).isin("private", "no", "customers")
    return (
        (F.length(name_of(tags)) >= 2)
        & open_access
        & (
            _is("leisure", "park", tags=tags)
            | _is("landuse", "recreation_ground", tags=tags)
            | _is("boundary", "national_park", tags=tags)
        )
    )


def park_candidate(tags: str = "tags") -> Column:
    return _is("boundary", "protected_area", tags=tags) | _is("leisure", "nature_reserve", tags=tags)


def camp_candidate(tags: str = "tags") -> Column:
    return _is("tourism", "camp_site", tags=tags) | (text(tag("camp_site", tags)) != "")


def fuels(tags: str = "tags") -> Column:
    """Struct (gasoline, diesel): a missing gasoline tag means gasoline is sold."""
    return F.struct(
        (~_is("fuel:gasoline", "no", tags=tags)).alias("gasoline"),
        (_is("fuel:diesel", "yes", tags=tags) | _is("diesel", "yes", tags=tags)).alias("diesel"),
    )


def station_amenities(brand_type, tags: str = "tags") -> Column:
    """Struct (restroom, food, showers) of a fuel station."""
    toilets = first_filled(tag("toilets", tags), tag("toilets:access", tags))
    plaza = brand_type == fv.TRAVEL_PLAZA
    return F.struct(
        F.coalesce(toilets, F.when(plaza, F.lit("assumed")).otherwise(F.lit("unknown"))).alias("restroom"),
        F.when(_is("shop", "convenience", tags=tags), F.lit("yes")).otherwise(F.lit("unknown")).alias("food"),
        F.when(_is("shower", "yes", tags=tags), F.lit("yes"))
        .when(plaza, F.lit("common"))
        .otherwise(F.lit("unknown"))
        .alias("showers"),
    )


def amenity_kind(tags: str = "tags") -> Column:
    """Park-amenity kind of a map element, null when none."""
    info = first_filled(tag("information", tags), tag("name", tags))
    return (
        F.when(camp_candidate(tags), F.lit("campground"))
        .when(_is("tourism", "picnic_site", tags=tags) | _is("leisure", "picnic_table", tags=tags), F.lit("picnic_area"))
        .when(_is("amenity", "toilets", tags=tags) | _is("building", "toilets", tags=tags), F.lit("restroom"))
        .when(_is("amenity", "parking", tags=tags) | _is("parking", "yes", tags=tags), F.lit("parking"))
        .when(_is("tourism", "information", tags=tags) & matches(info, "visitor|interpret"), F.lit("visitor_center"))
        .when(_is("amenity", "ranger_station", tags=tags) | _is("tourism", "museum", tags=tags), F.lit("visitor_center"))
    )


def state_park_run(tags: str = "tags") -> Column:
    operator = join_filled(" ", tag("operator", tags), tag("owner", tags), tag("brand", tags))
    return matches(operator, fv.STATE_AMENITY_OPERATOR) | matches(tag("name", tags), "state park|provincial park")


def provincial_park_run(tags: str = "tags") -> Column:
    operator = operator_blob(tags)
    name = first_filled(tag("name", tags), tag("name:fr", tags))
    return (
        matches(operator, fv.PROVINCIAL_AMENITY_OPERATOR)
        | matches(name, "provincial park|parc provincial|sepaq")
        | matches(tag("website", tags), fv.PROVINCIAL_AMENITY_SITE)
    )


def operator_blob(tags: str = "tags") -> Column:
    return join_filled(" ", tag("operator", tags), tag("owner", tags), tag("brand", tags), tag("operator:fr", tags))


def camp_tier(tags: str = "tags") -> Column:
    """developed / backcountry / primitive from the site type, then the name."""
    site = F.lower(text(first_filled(tag("camp_site", tags), tag("camp_site:type", tags))))
    name = _low("name", tags)
    return (
        F.when(site.rlike("dispersed|wild|backcountry|basic"), F.lit("backcountry"))
        .when(site.rlike("primitive"), F.lit("primitive"))
        .when(site.rlike("serviced|standard|deluxe"), F.lit("developed"))
        .when(name.rlike("backcountry|walk.?in|wilderness|dispersed"), F.lit("backcountry"))
        .when(name.rlike("primitive"), F.lit("primitive"))
        .otherwise(F.lit("developed"))
    )


def land_manager_us(tags: str = "tags") -> Column:
    op = join_filled(
        " ", tag("operator", tags), tag("brand", tags), tag("owner", tags), tag("operator:type", tags)
    )
    name = tag("name", tags)
    return (
        F.when(
            matches(op, "national park|nps|national park service") | _is("protection_title", "national_park", tags=tags),
            F.lit("NPS"),
        )
        .when(matches(op, r"forest service|u\.?s\.? forest|usfs"), F.lit("USFS"))
        .when(matches(op, "bureau of land|blm"), F.lit("BLM"))
        .when(matches(op, "army corps|usace|corps of engineers"), F.lit("COE"))
        .when(matches(op, "fish and wildlife|usfws|wildlife refuge"), F.lit("USFWS"))
        .when(matches(op, "state park|state forest|dept of natural|dnr|state parks"), F.lit("State"))
        .when(matches(op, "county park|county"), F.lit("County"))
        .when(matches(op, "city of|municipal"), F.lit("City"))
        .when(_is("boundary", "national_park", tags=tags) | matches(name, "national park"), F.lit("NPS"))
        .when(matches(name, "national forest") | matches(tag("description", tags), "national forest"), F.lit("USFS"))
        .otherwise(F.lit("Unknown"))
    )


def camp_blob_ca(tags: str = "tags") -> Column:
    return join_filled(
        " ",
        *[
            tag(k, tags)
            for k in ("operator", "brand", "owner", "operator:fr", "name", "name:fr", "website", "description")
        ],
    )


def land_manager_ca(tags: str = "tags", blob: Column | None = None) -> Column:
    blob = camp_blob_ca(tags) if blob is None else blob
    name = first_filled(tag("name", tags), tag("name:fr", tags))
    site = tag("website", tags)
    federal = "parks canada|parcs canada"
    run_by_government = _is("operator:type", "government", tags=tags) | _is("government", "yes", tags=tags)
    protected = _is("boundary", "protected_area", tags=tags) & matches(blob, "provincial|national park")
    return (
        F.when(matches(blob, federal + r"|pc\.gc\.ca|parcscanada"), F.lit("Parks Canada"))
        .when(matches(site, r"env\.gov\.bc\.ca/bcparks|bcparks\.ca|ontarioparks\.|albertaparks\.ca"), F.lit("Provincial"))
        .when(matches(blob, fv.GOVERNMENT_OPERATOR_CA), F.lit("Provincial"))
        .when(
            matches(name, "parc national|national park of canada") & ~matches(name, "provincial"),
            F.lit("Parks Canada"),
        )
        .when(run_by_government, F.lit("Provincial"))
        .when(
            protected,
            F.when(matches(blob, "national park of canada|parc national"), F.lit("Parks Canada")).otherwise(
                F.lit("Provincial")
            ),
        )
        .otherwise(F.lit("Unknown"))
    )


def land_manager_of_agency(agency) -> Column:
    """Manager code from a reservation system's agency name."""
    a = F.upper(text(agency))
    return (
        F.when(a.contains("NATIONAL PARK"), F.lit("NPS"))
        .when(a.contains("FOREST"), F.lit("USFS"))
        .when(a.contains("LAND MANAGEMENT") | a.contains("BLM"), F.lit("BLM"))
        .when(a.contains("CORPS"), F.lit("COE"))
        .otherwise(F.lit("Federal"))
    )


def camp_cost(tags: str = "tags") -> Column:
    return (
        F.when(_is("fee", "no", tags=tags), F.lit("free"))
        .when(_is("fee", "yes", tags=tags), F.lit("fee"))
        .when(_is("camp_site", "dispersed", "wildcamp", tags=tags), F.lit("free"))
        .otherwise(F.lit("unknown"))
    )


def commercial(name, operator, brand, patterns=fv.COMMERCIAL_US) -> Column:
    return matches(join_filled(" ", name, operator, brand), "|".join(patterns))


def private_campground_ca(name, tags: str = "tags", blob: Column | None = None) -> Column:
    blob = camp_blob_ca(tags) if blob is None else blob
    government = matches(blob, fv.GOVERNMENT_OPERATOR_CA) | _is("operator:type", "government", tags=tags)
    resort = matches(name, r"\bresort\b") & ~matches(blob, r"\bprovincial park\b")
    private = matches(blob, r"\bprivate\b") & matches(blob, r"\bcamp")
    return commercial(name, tag("operator", tags), tag("brand", tags), fv.COMMERCIAL_CA) | (
        ~government & (resort | private)
    )
