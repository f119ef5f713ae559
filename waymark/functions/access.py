"""Road, path and parking access rules over measured distances (metres, null = nothing found)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark import fixed_values as fv
from waymark.functions.geo import col, half_up
from waymark.functions.text import text


def distance_status(distance, limit: float = fv.SCENIC_MEASURE_M) -> Column:
    """Struct (distance_m to 0.1 m, status): measured, far, or none."""
    d = col(distance)
    return F.struct(
        F.when(d <= limit, half_up(d, 10)).alias("distance_m"),
        F.when(d.isNull(), F.lit("none")).when(d > limit, F.lit("far")).otherwise(F.lit("measured")).alias("status"),
    )


def _within(d: Column, limit) -> Column:
    return F.coalesce(d <= limit, F.lit(False))


def scenic_include(lean="d_lean", path="d_path", parking="d_parking", limit: float = 120.0) -> Column:
    """Roadside viewpoint: near a through road, and by parking, at the roadside, or off the footpath."""
    lean, path, parking = col(lean), col(path), col(parking)
    return (
        F.when(~_within(lean, max(limit, fv.SCENIC_LEAN_M)), F.lit(False))
        .when(_within(parking, 100), F.lit(True))
        .when(F.coalesce(path == 0, F.lit(False)), F.lit(False))
        .when(path.isNull() | (lean <= 50), F.lit(True))
        .otherwise(path > 45)
    )


def scenic_strategies(lean="d_lean", wide="d_wide", path="d_path", parking="d_parking", limit: float = 120.0) -> dict[str, Column]:
    """The alternative include rules that are scored against labelled cases."""
    d, w, p, k = col(lean), col(wide), col(path), col(parking)
    near = _within(d, limit)

    def path_rule(test: Column) -> Column:
        return p.isNull() | F.coalesce(test, F.lit(False))

    return {
        "A-distance-120": near,
        "B-distance-80": _within(d, 80),
        "C-wide-60-and-lean-120": near & _within(w, 60),
        "D-parking-within-100m": near & _within(k, 100),
        "E-parking-within-150m": near & _within(k, 150),
        "F-exclude-path-closer-than-road": near & path_rule(p > d),
        "G-exclude-path-within-50m": near & path_rule(p > 50),
        "H-exclude-path-40-unless-parking-80": near & (_within(k, 80) | path_rule(p > 40)),
        "I-exclude-path-45-unless-parking-100": near & (_within(k, 100) | path_rule(p > 45)),
        "J-path-ratio-0.7": near & path_rule((d == 0) & (p > 0) | (p / F.nullif(d, F.lit(0.0)) >= 0.7)),
        "K-wide-35-or-path-40-parking-80": near & (_within(w, 35) | _within(k, 80) | path_rule(p > 40)),
        "L-production-filter-v3": scenic_include(lean, path, parking, limit),
        "L-production-filter-v2": near & (_within(k, 100) | path_rule(p > 45)),
        "M-wide-required-50": near & _within(w, 50),
    }


def inferred_access(kind="kind", camp_tier="camp_tier") -> Column:
    """Struct (mode, confidence) of a campground from its tier."""
    tier = text(camp_tier)
    mode = (
        F.when(tier == "developed", F.lit("road"))
        .when(tier.isin("backcountry", "primitive"), F.lit("trail"))
        .otherwise(F.lit("unknown"))
    )
    camp = text(kind) == "campground"
    return F.struct(
        F.when(camp, mode).otherwise(F.lit("unknown")).alias("mode"),
        F.when(camp, F.lit("inferred")).otherwise(F.lit("unknown")).alias("confidence"),
    )


def access_mode(kind="kind", camp_tier="camp_tier", road="road_distance_m", trail="trail_distance_m") -> Column:
    """Struct (mode, confidence): the nearer of road and trail within reach, else what the tier says."""
    road, trail = col(road), col(trail)
    by_road, by_trail = _within(road, fv.ACCESS_MAX_M), _within(trail, fv.ACCESS_MAX_M)

    def row(mode: str, confidence: Column) -> Column:
        return F.struct(F.lit(mode).alias("mode"), confidence.alias("confidence"))

    def tie(near: Column, other: Column) -> Column:
        return F.when(other <= near + fv.ACCESS_TIE_M, F.lit("medium")).otherwise(F.lit("high"))

    return (
        F.when(text(kind) != "campground", row("unknown", F.lit("unknown")))
        .when(by_road & by_trail & (road <= trail), row("road", tie(road, trail)))
        .when(by_road & by_trail, row("trail", tie(trail, road)))
        .when(by_road, row("road", F.lit("high")))
        .when(by_trail, row("trail", F.lit("high")))
        .when(road.isNotNull() & trail.isNotNull(), row("unknown", F.lit("measured_far")))
        .otherwise(inferred_access(kind, camp_tier))
    )
