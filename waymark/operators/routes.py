"""Distances to routes. ``routes`` has one row per vertex: route_id, seq, lat, lon."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark import fixed_values as fv
from waymark.functions import geo
from waymark.operators.ranking import rank_in_groups
from waymark.operators.spatial import radius_join


def route_segments(routes: DataFrame) -> DataFrame:
    """Consecutive vertex pairs of each route.

    Vertices are ranked and joined to their successor, so that one very long route spreads over all
    tasks.
    """
    ranked = rank_in_groups(routes.select("route_id", "seq", "lat", "lon"), ["route_id"], ["seq"], "n")
    first = ranked.select("route_id", "n", "seq", F.col("lat").alias("lat1"), F.col("lon").alias("lon1"))
    second = ranked.select("route_id", (F.col("n") - 1).alias("n"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    return first.join(second, ["route_id", "n"]).drop("n")


def path_length(routes: DataFrame, unit: str = "mi") -> DataFrame:
    segments = route_segments(routes)
    return segments.groupBy("route_id").agg(
        F.sum(geo.haversine("lat1", "lon1", "lat2", "lon2", unit)).alias("length"), F.count(F.lit(1)).alias("segments")
    )


def _along(t: Column) -> tuple[Column, Column]:
    return (
        F.col("lat1") + (F.col("lat2") - F.col("lat1")) * t,
        F.col("lon1") + (F.col("lon2") - F.col("lon1")) * t,
    )


def fraction_samples(routes: DataFrame, step: float = fv.ROUTE_STEP_FRACTION) -> DataFrame:
    """Points at fixed fractions of every segment, ends included."""
    n = round(1 / step)
    t = F.col("i") / F.lit(float(n))
    lat, lon = _along(t)
    return (
        route_segments(routes)
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n))))
        .select("route_id", lat.alias("lat"), lon.alias("lon"))
        .distinct()
    )


def spaced_samples(routes: DataFrame, step_km: float = fv.CORRIDOR_STEP_KM) -> DataFrame:
    """Vertices plus points so that no gap is longer than ``step_km``."""
    segments = route_segments(routes).withColumn(
        "n",
        F.greatest(F.lit(1), F.ceil(geo.haversine("lat1", "lon1", "lat2", "lon2", "km") / step_km)).cast("int"),
    )
    lat, lon = _along(F.col("j") / F.col("n"))
    inner = segments.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n")))).select(
        "route_id", lat.alias("lat"), lon.alias("lon")
    )
    return inner.union(routes.select("route_id", "lat", "lon")).distinct()


def distance_to_routes(points: DataFrame, samples: DataFrame, limit: float, unit: str, key: str = "id") -> DataFrame:
    """(key, route_id, distance) for every point within ``limit`` of a route's samples.

    A cell join: a point only meets the samples in its reach, so many or very long routes cost no
    more per point than a few.
    """
    spots = points.select("lat", "lon").distinct()
    near = (
        radius_join(spots, samples, limit, unit)
        .groupBy(F.col("l_lat").alias("lat"), F.col("l_lon").alias("lon"), F.col("r_route_id").alias("route_id"))
        .agg(F.min("distance").alias("distance"))
    )
    return points.select(key, "lat", "lon").join(near, ["lat", "lon"]).select(key, "route_id", "distance")


def corridor_members(points: DataFrame, routes: DataFrame, miles: float = fv.CORRIDOR_MI, key: str = "id") -> DataFrame:
    """Points in any corridor: sorted route list and distance to the nearest route in whole miles."""
    km = miles * fv.KM_PER_MILE
    near = distance_to_routes(points, spaced_samples(routes), km, "km", key)
    return near.groupBy(key).agg(
        F.array_join(F.sort_array(F.collect_set("route_id")), ",").alias("routes"),
        geo.half_up(F.min("distance") / fv.KM_PER_MILE, 1).cast("bigint").alias("dist_mi"),
    )


def by_distance(members: DataFrame, distance: str = "dist_mi", name: str = "name", key: str = "id") -> DataFrame:
    """Adds position: 1 for the nearest; equal distances go by name in binary order, then by key; unnamed rows first."""
    rows = members.withColumn("_all", F.lit(0)).withColumn("_name", F.coalesce(F.col(name), F.lit("")))
    return rank_in_groups(rows, ["_all"], [distance, "_name", key], "position").drop("_all", "_name")
