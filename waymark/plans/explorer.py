"""Layer manifest of the map explorer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions import brands, geo
from waymark.functions.text import text
from waymark.sources.sinks import layer_placement


def unit_pins(units: DataFrame) -> DataFrame:
    """One explorer row per map pin; units without pins show their own point.

    ``units``: id, name, category, lat, lon, pins ARRAY<STRUCT<id,label,lat,lon,role>>.
    """
    own = F.array(
        F.struct(F.col("id").alias("id"), F.lit("").alias("label"), F.col("lat").alias("lat"), F.col("lon").alias("lon"), F.lit("primary").alias("role"))
    )
    pins = F.when(F.coalesce(F.size("pins"), F.lit(0)) > 0, F.col("pins")).otherwise(own)
    rows = units.withColumn("_pin", F.explode(pins))
    label = text("_pin.label")
    return rows.select(
        F.coalesce("_pin.id", "id").alias("id"),
        F.when(label != "", F.concat_ws(" — ", "name", label)).otherwise(F.col("name")).alias("name"),
        geo.half_up("_pin.lat", 1e5).alias("lat"), geo.half_up("_pin.lon", 1e5).alias("lon"),
        F.coalesce(F.nullif("category", F.lit("")), F.lit("other")).alias("category"),
        label.alias("pin_label"), F.col("_pin.role").alias("pin_role"),
    )


def amenity_layers(rows: DataFrame) -> DataFrame:
    """A row per layer an amenity is shown in: its tier or kind, and its access mode."""
    camp = F.col("kind") == "campground"
    layers = F.filter(
        F.array(
            F.when(camp, F.concat(F.lit("camp_"), text("camp_tier"))),
            F.when(camp & F.col("access_mode").isin("road", "trail"), F.concat(F.lit("camp_"), F.col("access_mode"))),
            F.when(F.col("kind") == "picnic_area", F.lit("picnic")),
            F.when(F.col("kind") == "restroom", F.lit("restroom")),
        ),
        lambda v: v.isNotNull(),
    )
    return rows.withColumn("layer", F.explode(layers))


def fuel_layers(rows: DataFrame) -> DataFrame:
    return rows.withColumn("layer", F.concat(F.lit("fuel_"), brands.select_id("brand_id")))


def manifest(rows: DataFrame, groups: dict[str, str]) -> DataFrame:
    """Layer, its group by name prefix, row count and placement."""
    chain = F.lit("other")
    for prefix, group in groups.items():
        chain = F.when(F.col("layer").startswith(prefix), F.lit(group)).otherwise(chain)
    return layer_placement(rows).withColumn("layer_group", chain)
