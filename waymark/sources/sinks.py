"""Writers: slim embeds, shards with a manifest, layer slices, review GeoJSON, viewer rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark import fixed_values as fv
from waymark.functions.geo import half_up
from waymark.functions.text import lookup, text
from waymark.runtime import stage
from waymark.sources.readers import path_exists


def embed_metadata(df: DataFrame, layer: str, counts: Mapping[str, Column] | None = None) -> DataFrame:
    """One-row summary of an embed: layer, record count and named counts."""
    extra = [F.count_if(c).alias(n) for n, c in (counts or {}).items()]
    return df.agg(F.count(F.lit(1)).alias("record_count"), *extra).select(F.lit(layer).alias("layer"), "*")


def write_embed(df: DataFrame, columns: Sequence[Column | str], path: str, layer: str, counts: Mapping[str, Column] | None = None) -> None:
    """Slim projection and its metadata, side by side."""
    slim = df.select(*columns)
    slim.write.mode("overwrite").json(f"{path}/records")
    embed_metadata(df, layer, counts).write.mode("overwrite").json(f"{path}/metadata")


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def shard_columns(df: DataFrame, federal: Column, state: Column) -> DataFrame:
    """Add shard (federal / state) and shard_state."""
    return df.withColumn("shard", F.when(federal, F.lit("federal")).otherwise(F.lit("state"))).withColumn(
        "shard_state", F.when(federal, F.lit("US")).otherwise(F.upper(F.trim(text(state))))
    )


def write_shards(df: DataFrame, path: str, rows_per_task: int = 1_000_000) -> DataFrame:
    """Write shard partitions and a manifest of counts; shards without rows disappear.

    Rows are spread by shard and a salt; a shard has as many salts as its rows ask for, so no task gets
    a whole hot shard and a small shard stays in one file.
    """
    manifest = stage(df.groupBy("shard", "shard_state").agg(F.count(F.lit(1)).alias("n")), "shard-sizes")
    sizes = manifest.select(
        F.col("shard").alias("_shard"), F.col("shard_state").alias("_state"),
        F.ceil(F.col("n") / rows_per_task).alias("_salts"),
    )
    same = F.col("shard").eqNullSafe(F.col("_shard")) & F.col("shard_state").eqNullSafe(F.col("_state"))
    spread = df.join(sizes, same).withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.col("_salts")))
    (
        spread.repartition("shard", "shard_state", "_salt")
        .select(*df.columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("maxRecordsPerFile", 1_000_000)
        .partitionBy("shard", "shard_state")
        .parquet(f"{path}/records")
    )
    manifest.write.mode("overwrite").parquet(f"{path}/manifest")
    return manifest


def read_shards(spark: SparkSession, path: str, monolith: str | None = None) -> DataFrame:
    """Rows of the shards named in the manifest; the single table when there is no manifest."""
    if not path_exists(spark, f"{path}/manifest"):
        if monolith is None:
            raise FileNotFoundError(path)
        return spark.read.parquet(monolith)
    manifest = spark.read.parquet(f"{path}/manifest").select("shard", "shard_state")
    return spark.read.parquet(f"{path}/records").join(manifest, ["shard", "shard_state"], "left_semi")


def layer_placement(df: DataFrame, layer: str = "layer", inline_limit: int | None = None) -> DataFrame:
    """Rows per layer and its placement: a file; with ``inline_limit``, inline for smaller layers."""
    inline = F.lit(False) if inline_limit is None else F.col("n") < inline_limit
    return df.groupBy(layer).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "placement", F.when(inline, F.lit("inline")).otherwise(F.lit("file"))
    )


def write_layers(df: DataFrame, path: str, layer: str = "layer", rows_per_file: int = 500_000) -> None:
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy(layer).json(path)


def review_features(df: DataFrame, properties: Sequence[str], keep: Column) -> DataFrame:
    """GeoJSON Feature lines of the rows to review."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")).alias("geometry"),
        F.struct(*properties).alias("properties"),
    )
    return df.where(keep).select(F.to_json(feature).alias("value"))


def write_review(df: DataFrame, properties: Sequence[str], keep: Column, path: str) -> None:
    review_features(df, properties, keep).write.mode("overwrite").text(path)


def viewer_rows(df: DataFrame) -> DataFrame:
    """Dictionary-coded campground rows for the map viewer."""
    distance = F.col("road_distance_m")
    return df.select(
        "id",
        half_up("lat", 1e5).alias("lat"),
        half_up("lon", 1e5).alias("lon"),
        lookup("land_manager", fv.MANAGER_CODES, fv.MANAGER_CODES["Unknown"]).alias("manager_code"),
        lookup("type", fv.CAMP_TYPE_CODES, 0).alias("type_code"),
        lookup("display_tier", fv.DISPLAY_TIER_CODES, 2).alias("tier_code"),
        F.coalesce(F.col("needs_review").cast("int"), F.lit(0)).alias("review"),
        F.when(distance.isNull(), F.lit(-1))
        .otherwise(F.floor(distance + 0.5).cast("int"))
        .alias("road_m"),
    )


def with_dropped(dropped: Mapping[str, DataFrame], key: str = "id") -> DataFrame:
    """All dropped rows of a job in one audit table: (kept, dropped, reason)."""
    out = None
    for reason, df in dropped.items():
        kept = F.col("kept").cast("string") if "kept" in df.columns else F.lit(reason)
        lost = F.col("dropped") if "dropped" in df.columns else F.col(key)
        one = df.select(kept.alias("kept"), lost.cast("string").alias("dropped"), F.lit(reason).alias("reason"))
        out = one if out is None else out.unionByName(one)
    return out
