"""Readers: record envelopes, shards, line JSON, feature pages and GeoJSON parts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.functions import geo
from waymark.functions.text import text


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def decoded(content: Column) -> Column:
    """Text of a file's bytes: UTF-16 by its mark or by a zero byte next to the first character, else UTF-8.

    JSON starts with a character below 128, so its other byte is zero in UTF-16 without a mark.
    """
    head, second = F.hex(F.substring(content, 1, 2)), F.hex(F.substring(content, 2, 1))
    made = (
        F.when(head.isin("FFFE", "FEFF"), F.decode(content, "UTF-16"))
        .when(second == "00", F.decode(content, "UTF-16LE"))
        .when(F.hex(F.substring(content, 1, 1)) == "00", F.decode(content, "UTF-16BE"))
        .otherwise(F.decode(content, "UTF-8"))
    )
    return F.ltrim(made, F.lit("\ufeff"))


def read_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(path, document) of JSON files of one document each, every file in its own encoding; no document: null.

    Spark lists no files without a byte.
    """
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.from_json(decoded(F.col("content")), schema).alias("document"))


def read_envelope(spark: SparkSession, path: str, record: T.StructType, fallback: str | None = None) -> DataFrame:
    """Rows of the ``records`` array of JSON documents; the fallback path when the first is absent."""
    if fallback is not None and not path_exists(spark, path):
        path = fallback
    schema = T.StructType([T.StructField("records", T.ArrayType(record))])
    return read_documents(spark, path, schema).select(F.inline("document.records"))


def read_state_shards(spark: SparkSession, folder: str, record: T.StructType, prefix: str = "osm") -> tuple[DataFrame, DataFrame]:
    """(rows with their shard code, rows per shard) of ``<prefix>-XX.json`` envelopes, single files or folders of files."""
    schema = T.StructType([T.StructField("records", T.ArrayType(record))])
    raw = read_documents(spark, f"{folder}/{prefix}-??.json", schema)
    named = raw.select(
        F.regexp_extract("path", rf"{prefix}-([A-Z]{{2}})\.json(/[^/]*)?$", 1).alias("shard"),
        F.coalesce("document.records", F.array().cast(T.ArrayType(record))).alias("records"),
    )
    stats = named.groupBy("shard").agg(F.sum(F.size("records")).alias("n"))
    return named.select("shard", F.inline("records")), stats


def read_json_lines(spark: SparkSession, path: str, record: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(parsed rows, malformed lines) of line-delimited JSON; blank lines are skipped."""
    return split_json_lines(spark.read.text(path), record)


def split_json_lines(lines: DataFrame, record: T.StructType, column: str = "value") -> tuple[DataFrame, DataFrame]:
    schema = T.StructType([*record.fields, T.StructField("_bad", T.StringType())])
    full = lines.where(F.trim(F.col(column)) != "")
    parsed = full.withColumn(
        "_r", F.from_json(F.col(column), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    )
    return (
        parsed.where("_r._bad is null").select("_r.*").drop("_bad"),
        parsed.where("_r._bad is not null").select(F.col(column).alias("line")),
    )


FEATURE_PAGE = T.StructType(
    [
        T.StructField(
            "features",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
                        T.StructField(
                            "geometry",
                            T.StructType(
                                [
                                    T.StructField("x", T.DoubleType()),
                                    T.StructField("y", T.DoubleType()),
                                    T.StructField("rings", T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))),
                                ]
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)


def flatten_features(pages: DataFrame, field_map: Mapping[str, str], body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """Feature pages (JSON text) to one row per feature.

    ``field_map``: output column -> attribute name. Adds lat, lon (point, or centre of the first
    ring's box), rings and the attribute map.
    """
    parsed = pages.select(*keep, F.explode(F.from_json(F.col(body), FEATURE_PAGE)["features"]).alias("f"))
    g = F.col("f.geometry")
    ring = F.get(g["rings"], F.lit(0))
    lats, lons = F.transform(ring, lambda p: F.get(p, F.lit(1))), F.transform(ring, lambda p: F.get(p, F.lit(0)))
    lat = F.coalesce(g["y"], (F.array_min(lats) + F.array_max(lats)) / 2)
    lon = F.coalesce(g["x"], (F.array_min(lons) + F.array_max(lons)) / 2)
    fields = [F.try_element_at(F.col("f.attributes"), F.lit(src)).alias(out) for out, src in field_map.items()]
    return parsed.select(*keep, *fields, lat.alias("lat"), lon.alias("lon"), g["rings"].alias("rings"), F.col("f.attributes").alias("attributes"))


def attribute_by_pattern(attributes, pattern: str, test) -> Column:
    """First attribute value, in key order, whose key matches and whose value passes ``test``."""
    entries = F.array_sort(F.map_entries(geo.col(attributes)))
    hit = F.filter(entries, lambda e: e["key"].rlike("(?i)" + pattern) & F.coalesce(test(F.trim(e["value"])), F.lit(False)))
    return F.trim(F.get(hit, F.lit(0))["value"])


def official_name(attributes, name) -> Column:
    """Mapped name, else the first name-like attribute longer than two characters."""
    other = attribute_by_pattern(attributes, "name|park|unit|site|facility|desc|title", lambda v: F.length(v) > 2)
    return F.coalesce(F.nullif(F.trim(text(name)), F.lit("")), other, F.lit(""))


def official_url(attributes, url) -> Column:
    mine = F.trim(text(url))
    other = attribute_by_pattern(attributes, "url|website|link|web", lambda v: v.rlike("(?i)^https?://"))
    return F.coalesce(F.when(mine.rlike("(?i)^https?://"), mine), other, F.lit(""))


_RING = T.ArrayType(T.ArrayType(T.DoubleType()))
_GEOJSON = T.StructType(
    [
        T.StructField(
            "features",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
                        T.StructField(
                            "geometry",
                            T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())]),
                        ),
                    ]
                )
            ),
        )
    ]
)


def polygon_parts(collections: DataFrame, body: str = "body", properties: Mapping[str, str] | None = None) -> DataFrame:
    """GeoJSON feature collections to one row per (feature, polygon part).

    Columns: the mapped properties, part, rings ARRAY<ARRAY<STRUCT<lon,lat>>> (ring 0 = outer).
    """
    features = collections.select(F.explode(F.from_json(F.col(body), _GEOJSON)["features"]).alias("f"))
    one = F.array(F.from_json("f.geometry.coordinates", T.ArrayType(_RING)))
    many = F.from_json("f.geometry.coordinates", T.ArrayType(T.ArrayType(_RING)))
    parts = F.when(F.col("f.geometry.type") == "Polygon", one).when(F.col("f.geometry.type") == "MultiPolygon", many)
    props = [F.try_element_at(F.col("f.properties"), F.lit(src)).alias(out) for out, src in (properties or {}).items()]
    rows = features.select(*props, F.posexplode(parts).alias("part", "_rings"))
    rings = F.transform(
        "_rings",
        lambda ring: F.transform(ring, lambda p: F.struct(F.get(p, F.lit(0)).alias("lon"), F.get(p, F.lit(1)).alias("lat"))),
    )
    return rows.withColumn("rings", rings).drop("_rings")


def part_edges(parts: DataFrame, key: str) -> DataFrame:
    """Edges of every ring of polygon parts, for the point-in-polygon join."""
    from waymark.operators.elements import ring_edges

    rings = parts.select(key, F.posexplode("rings").alias("ring_no", "ring"))
    return ring_edges(rings, key, "ring_no")
