"""Counts, rollups, coverage and cross-source reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark import fixed_values as fv
from waymark.functions.geo import col, half_up
from waymark.functions.text import text
from waymark.runtime import stage


def count_by(df: DataFrame, key, output: str = "value") -> DataFrame:
    """Rows per key; null and empty count as ``?``."""
    named = F.coalesce(F.nullif(col(key).cast("string"), F.lit("")), F.lit("?"))
    return df.groupBy(named.alias(output)).agg(F.count(F.lit(1)).alias("n"))


def breakdowns(df: DataFrame, sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """Several count-by reports in one pass: (breakdown, value, n).

    ``sets`` maps a report name to one or two columns; two columns join their values with ``:``.
    """
    columns = sorted({c for cols in sets.values() for c in cols})
    named = df.select(
        *[F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("?")).alias(c) for c in columns]
    )
    # one scan: rows are first counted per distinct combination, then per report
    combos = named.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    reports = F.array(
        *[
            F.struct(F.lit(name), F.concat_ws(":", *[F.col(c) for c in cols])).cast("struct<breakdown:string,value:string>")
            for name, cols in sets.items()
        ]
    )
    return (
        combos.select(F.explode(reports).alias("r"), "n")
        .groupBy(F.col("r.breakdown").alias("breakdown"), F.col("r.value").alias("value"))
        .agg(F.sum("n").alias("n"))
    )


def count_flags(df: DataFrame, flags: str = "map_flags") -> DataFrame:
    return df.select(F.explode(flags).alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    aggs = [F.count_if(c).alias(name) for name, c in conditions.items()]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), *aggs)


def distance_histogram(df: DataFrame, distance="road_distance_m") -> DataFrame:
    d = col(distance)
    bucket = (
        F.when(d.isNull(), F.lit("null"))
        .when(d <= fv.ROAD_DEFAULT_M, F.lit("lte800"))
        .when(d <= fv.ROAD_QA_M, F.lit("lte1200"))
        .otherwise(F.lit("gt1200"))
    )
    return df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def parent_key(system="parent_system", parent_id="parent_id", park_code="park_code", official_code="official_code", record_id="id") -> Column:
    """``system:id`` of the parent, falling back to park code, official code, or the record itself."""
    ident = F.coalesce(
        F.nullif(text(parent_id), F.lit("")),
        F.nullif(text(park_code), F.lit("")),
        F.concat(F.lit("code:"), F.nullif(F.trim(text(official_code)), F.lit(""))),
        F.concat(F.lit("amenity:"), col(record_id).cast("string")),
    )
    return F.concat_ws(":", F.coalesce(F.nullif(text(system), F.lit("")), F.lit("nps")), ident)


def parent_rollup(df: DataFrame, key: str = "parent_key", kind: str = "kind", tier: str = "camp_tier", mode: str = "access_mode", source: str = "ingest_source") -> DataFrame:
    """One row per parent: campground tiers with access counts, other kinds, sources, totals."""
    camp = F.col(kind) == "campground"
    aggs = []
    for t in fv.CAMP_TIERS:
        here = camp & (F.col(tier) == t)
        aggs += [
            F.count_if(here).alias(f"{t}_count"),
            F.count_if(here & (F.col(mode) == "road")).alias(f"{t}_road"),
            F.count_if(here & (F.col(mode) == "trail")).alias(f"{t}_trail"),
        ]
    for k in ("picnic_area", "restroom", "parking", "visitor_center"):
        aggs.append(F.count_if(F.col(kind) == k).alias(f"{k}_count"))
    # sources are folded first so that a hot parent sends a handful of them
    aggs.append(F.array_join(F.sort_array(F.collect_set(source)), ",").alias("sources"))
    out = df.groupBy(key).agg(*aggs)

    def total(suffix: str) -> Column:
        return sum((F.col(f"{t}_{suffix}") for t in fv.CAMP_TIERS[1:]), F.col(f"{fv.CAMP_TIERS[0]}_{suffix}"))

    return (
        out.withColumn("camp_total", total("count"))
        .withColumn("camp_road", total("road"))
        .withColumn("camp_trail", total("trail"))
        .withColumn("camp_any", F.col("camp_total") > 0)
    )


def coverage(catalog: DataFrame, rows: DataFrame, key: str, group: str) -> DataFrame:
    """Units, units with any row, and percent to 0.1 per group."""
    present = rows.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_has", F.lit(1))
    return (
        catalog.join(present, key, "left")
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias("units"), F.count("_has").alias("covered"))
        .withColumn("pct", F.floor(F.col("covered") * 1000.0 / F.col("units") + 0.5) / 10.0)
    )


def missing_units(catalog: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    return catalog.join(rows.select(key).distinct(), key, "left_anti")


def group_centroids(df: DataFrame, keys: Sequence[str], order: str, first: Sequence[str] = ()) -> DataFrame:
    """Mean coordinate, row count and the first row's columns per group."""
    aggs = [F.min_by(F.col(c), F.col(order)).alias(c) for c in first]
    return df.groupBy(*keys).agg(
        F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.count(F.lit(1)).alias("members"), *aggs
    )


def named_groups(df: DataFrame, keys: Sequence[str], name: str, category: str, order: str, url: str | None = None) -> DataFrame:
    """Units grouped to one listing: longest name, category vote, mean coordinate, count."""
    aggs = [
        F.min_by(name, F.struct(-F.length(F.col(name)), F.col(order))).alias("name"),
        F.max((F.col(category) == "historic_site").cast("int")).alias("_h"),
        F.max((F.col(category) == "park").cast("int")).alias("_p"),
        half_up(F.avg("lat"), 1e5).alias("lat"),
        half_up(F.avg("lon"), 1e5).alias("lon"),
        F.count(F.lit(1)).alias("unit_count"),
    ]
    if url:
        aggs.append(F.min_by(F.nullif(text(url), F.lit("")), F.when(text(url) != "", F.col(order))).alias("url"))
    vote = F.when((F.col("_h") == 1) & (F.col("_p") == 0), F.lit("historic_site")).otherwise(F.lit("park"))
    return df.groupBy(*keys).agg(*aggs).withColumn("category", vote).drop("_h", "_p")


def weighted_centroid(df: DataFrame, keys: Sequence[str], weight: str) -> DataFrame:
    w = F.sum(weight)
    return df.groupBy(*keys).agg(
        (F.sum(F.col("lat") * F.col(weight)) / w).alias("lat"),
        (F.sum(F.col("lon") * F.col(weight)) / w).alias("lon"),
        w.alias(weight),
    )


def bounds(vertices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bounding box, its area and the vertex count per key."""
    return (
        vertices.groupBy(*keys)
        .agg(
            F.min("lat").alias("south"),
            F.min("lon").alias("west"),
            F.max("lat").alias("north"),
            F.max("lon").alias("east"),
            F.count(F.lit(1)).alias("vertices"),
        )
        .withColumn("area", (F.col("north") - F.col("south")) * (F.col("east") - F.col("west")))
    )


def vertex_summary(per_unit: DataFrame, name: str, vertices: str = "vertices") -> DataFrame:
    """Total, rounded mean and largest vertex count with the name of the largest unit."""
    return per_unit.agg(
        F.sum(vertices).alias("total_vertices"),
        F.floor(F.avg(vertices) + 0.5).cast("bigint").alias("avg_vertices"),
        F.max(vertices).alias("max_vertices"),
        F.min_by(name, F.struct(-F.col(vertices), F.col(name))).alias("max_name"),
    )


def brand_groups(catalogs: DataFrame, select_id: Column) -> DataFrame:
    """Brand pick list over several catalogues: union of ids and regions, any strict."""
    return catalogs.groupBy(select_id.alias("select_id")).agg(
        F.max_by("name", "seq").alias("name"),
        F.max_by("type", "seq").alias("type"),
        F.array_join(F.sort_array(F.collect_set("brand_id")), ",").alias("brand_ids"),
        F.array_join(F.sort_array(F.collect_set("region")), ",").alias("regions"),
        F.max(F.col("strict").cast("int")).alias("strict"),
    )


def source_counts_flags(per_admin: DataFrame, total="total", official="expected", listing="listing", osm="osm", verified="verified") -> DataFrame:
    """Flags where a source's count disagrees with the merged count of an admin."""
    t, e, n, o = col(total), col(official), col(listing), col(osm)
    ok = F.coalesce(col(verified), F.lit(False))
    has_expected = F.coalesce(e > 0, F.lit(False))
    has_listing = F.coalesce(n > 0, F.lit(False))
    flags = F.array(
        F.when(ok & has_expected & (t < e * 0.5), F.lit("under_official_gis")),
        F.when(ok & has_expected & (t > e * 1.5), F.lit("over_official_gis")),
        F.when(ok & (o > 0), F.lit("has_osm_in_tier_a_state")),
        F.when(has_listing & (t > 0) & (F.abs(t - n) > n * 0.25), F.lit("listing_master_mismatch")),
        F.when(ok & ~has_listing, F.lit("missing_listing_cache")),
    )
    return per_admin.withColumn("flags", F.array_join(F.filter(flags, lambda f: f.isNotNull()), ","))


def counts_agree(*counts, ratio: float = fv.COUNT_AGREEMENT_RATIO, least: int = 3) -> Column:
    """Largest over smallest positive count within ``ratio``, over at least ``least`` counts."""
    positive = F.filter(F.array(*[col(c).cast("double") for c in counts]), lambda v: v.isNotNull() & (v > 0))
    return F.coalesce(
        (F.size(positive) >= least) & (F.array_max(positive) / F.array_min(positive) <= ratio), F.lit(False)
    )


def first_per_park(centers: DataFrame, key: str = "park_code") -> DataFrame:
    """Visitor-center count per park and the first one with coordinates."""
    has = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    rank = F.when(has, F.col("seq"))
    return centers.where(text(key) != "").groupBy(F.lower(F.col(key)).alias(key)).agg(
        F.count(F.lit(1)).alias("centers"),
        F.min_by("name", rank).alias("primary_name"),
        F.min_by("lat", rank).alias("primary_lat"),
        F.min_by("lon", rank).alias("primary_lon"),
    )


#: numbers of one row while a range is written out
RANGE_STEP = 10_000


def number_gap_ranges(numbers: DataFrame, column: str) -> DataFrame:
    """(first, last) of every run of unused positive numbers below the largest one.

    Distinct numbers are range-partitioned; each looks at the one before it, the first of a partition at the largest
    of the partitions before. The work follows the numbers in use, not the range they span.
    """
    used = numbers.select(F.col(column).cast("bigint").alias("number")).where("number >= 1").distinct()
    placed = stage(used.repartitionByRange("number").withColumn("part", F.spark_partition_id()), "numbers")
    # one row per partition
    edges = placed.groupBy("part").agg(F.max("number").alias("top")).select(
        "part", F.max("top").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("carried")
    )
    inside = F.lag("number").over(Window.partitionBy("part").orderBy("number"))
    return (
        placed.withColumn("before", inside)
        .join(edges, "part")
        .select((F.coalesce("before", "carried", F.lit(0)) + 1).alias("first"), (F.col("number") - 1).alias("last"))
        .where("first <= last")
    )


def number_gaps(numbers: DataFrame, column: str) -> DataFrame:
    """Unused positive numbers below the largest one, a row each."""
    starts = number_gap_ranges(numbers, column).select(F.expr(f"explode(sequence(first, last, {RANGE_STEP}L))").alias("at"), "last")
    return starts.select(F.expr(f"explode(sequence(at, least(last, at + {RANGE_STEP - 1})))").alias("number"))


def samples_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int | None = None) -> DataFrame:
    """Rows per group with their number; only the first n if given (that limit is pushed below the shuffle)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("sample_no", F.row_number().over(w))
    return ranked if n is None else ranked.where(F.col("sample_no") <= n)
