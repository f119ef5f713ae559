"""Cluster operators: micro-clusters, campground merges, boundary sections and map pins."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark import fixed_values as fv
from waymark.functions import geo
from waymark.functions.parks import pin_label
from waymark.functions.text import slugify, text
from waymark.operators.cells import with_probe_cells
from waymark.operators.components import clique_cells, clique_degrees, proximity_components
from waymark.operators.folding import ordered_fold
from waymark.operators.ranking import rank_in_groups
from waymark.runtime import drop_stages, stage


def micro_clusters(
    points: DataFrame, radius_m: float, min_members: int, anchor: Column, score: Column, key: str = "id", order: str = "seq"
) -> DataFrame:
    """Linked rows within ``radius_m``; big enough clusters with an anchor keep their best row.

    Adds cluster_id, cluster_keep_id and cluster_role (keep / dropped / null).
    """
    parts = proximity_components(points, radius_m, "m", key=key)
    rows = points.join(parts, key).withColumn("_score", score)
    groups = (
        rows.groupBy("component")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.max(anchor.cast("int")).alias("_anchor"),
            F.min_by(F.col(key), F.struct(-F.col("_score"), F.col(order))).alias("cluster_keep_id"),
        )
        .where((F.col("_n") >= min_members) & (F.col("_anchor") == 1))
        .select("component", "cluster_keep_id")
    )
    joined = rows.join(groups, "component", "left").drop("_score")
    role = F.when(
        F.col("cluster_keep_id").isNotNull(),
        F.when(F.col("cluster_keep_id") == F.col(key), F.lit("keep")).otherwise(F.lit("dropped")),
    )
    return joined.select(
        *points.columns,
        F.when(F.col("cluster_keep_id").isNotNull(), F.col("component")).alias("cluster_id"),
        "cluster_keep_id",
        role.alias("cluster_role"),
    )


def merge_campgrounds(
    records: DataFrame, radius_mi: float, on: Sequence[str], display_name: Column, key: str = "id", order: str = "seq",
    pitches: str = "pitch_count", separate: str | None = None,
) -> DataFrame:
    """One row per linked group of equal ``on`` values within ``radius_mi``.

    ``separate``: a column whose values, where filled, must agree too (a park code); rows without
    one may link any. Mean coordinates, longest display name, summed pitch count, first row's rest.
    """
    on = list(on)
    parts = proximity_components(records, radius_mi, "mi", on, key, separate)
    rows = records.join(parts, key).withColumn("_display", display_name)
    rest = [c for c in records.columns if c not in ("lat", "lon", "name", pitches)]
    grouped = rows.groupBy("component").agg(
        F.min_by(F.struct(*rest, "name"), F.col(order)).alias("_first"),
        F.count(F.lit(1)).alias("merged_rows"),
        F.avg("lat").alias("lat"),
        geo.mean_lon("lon").alias("lon"),
        F.sum(pitches).alias(pitches),
        F.min_by("_display", F.struct(-F.length("_display"), F.col(order))).alias("_longest"),
    )
    return grouped.select(
        *[F.col(f"_first.{c}").alias(c) for c in rest],
        F.when(F.col("merged_rows") > 1, F.col("_longest")).otherwise(F.col("_first.name")).alias("name"),
        "lat",
        "lon",
        pitches,
        "merged_rows",
    )


#: rows of a park's order that one task scans for a running minimum
ORDER_CHUNK = 50_000


def section_clusters(sections: DataFrame, min_km: float = fv.PIN_CLUSTER_KM, key: str = "park_code") -> DataFrame:
    """Sections by falling area, each into the first cluster with a member nearer than ``min_km``.

    Clusters never merge: a section with no earlier section in reach founds one, any other takes the least cluster of
    its earlier neighbours. That is the first founder among all it can reach by steps to earlier neighbours. Within a
    cell of which all rows are neighbours, clusters can only fall along the order, so a section needs one link into
    each cell around it: to the latest earlier neighbour there. Rounds pass the least position along these links, along
    the order inside cells, and from the position held to the one it holds, until nothing falls.

    Input: key, section, lat, lon, area. Output: key, section, cluster (0-based). Sections without coordinates found
    clusters of their own; those without an area come last; rows with a null key are one park.
    """
    rows = sections.select(
        F.to_json(F.struct(key)).alias("_park"), key, "section", "lat", "lon", F.coalesce(-F.col("area"), F.lit(math.inf)).alias("_fall")
    )
    ranked = stage(rank_in_groups(rows, ["_park"], ["_fall", "section", "lat", "lon"], "_at").drop("_fall"), "sections")
    placed = clique_cells(ranked.where("lat is not null and lon is not null").select("_park", "_at", "lat", "lon"), min_km, "km")
    held = stage(placed.withColumn("_low", F.col("_at")).withColumn("_fell", F.lit(True)), "held")
    links = stage(_earlier_links(placed, min_km), "links")
    while True:
        run = stage(_falling(held), "run")
        # the row whose position is held may itself hold a lower one by now
        known = links.unionByName(run.select("_park", "_at", F.col("_low").alias("_before")))
        offers = known.join(
            run.select("_park", F.col("_at").alias("_before"), F.col("_low").alias("_offer")), ["_park", "_before"]
        ).groupBy("_park", "_at").agg(F.min("_offer").alias("_offer"))
        joined = run.join(offers, ["_park", "_at"], "left")
        fell = F.col("_offer") < F.col("_low")
        moved = stage(
            joined.select(*[c for c in placed.columns], F.least("_low", "_offer").alias("_low"), fell.alias("_fell")), "held"
        )
        drop_stages(held, run)
        held = moved
        if moved.where("_fell").isEmpty():
            break
    whole = ranked.join(held.select("_park", "_at", "_low"), ["_park", "_at"], "left").withColumn(
        "_low", F.coalesce("_low", "_at")
    )
    numbers = rank_in_groups(whole.select("_park", "_low").distinct(), ["_park"], ["_low"], "_number")
    return whole.join(numbers, ["_park", "_low"]).select(key, "section", (F.col("_number") - 1).cast("int").alias("cluster"))


def _earlier_links(placed: DataFrame, min_km: float) -> DataFrame:
    """Per row and cell around it, its latest earlier neighbour there: (_park, _at, _before)."""
    d = clique_degrees(min_km, "km")
    home = placed.select("*", F.col("q_b").alias("_home_b"), F.col("q_l").alias("_home_l")).drop("q_b", "q_l")
    around = with_probe_cells(home, "lat", "lon", min_km, "km", d, "q").where("q_b <> _home_b or q_l <> _home_l")
    there = placed.select("_park", "q_b", "q_l", F.col("_at").alias("_before"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    met = around.join(there, ["_park", "q_b", "q_l"]).where(
        (F.col("_before") < F.col("_at")) & (geo.haversine("lat", "lon", "_lat", "_lon", "km") < min_km)
    )
    return met.groupBy("_park", "_at", "q_b", "q_l").agg(F.max("_before").alias("_before")).select("_park", "_at", "_before")


def _falling(held: DataFrame) -> DataFrame:
    """Running minimum of ``_low`` along the order of each cell, in chunks of the order."""
    cell = ["_park", "q_b", "q_l"]
    rows = held.withColumn("_chunk", F.floor(F.col("_at") / ORDER_CHUNK))
    earlier = Window.partitionBy(*cell).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (
        rows.groupBy(*cell, "_chunk").agg(F.min("_low").alias("_least")).withColumn("_carried", F.min("_least").over(earlier)).drop("_least")
    )
    so_far = Window.partitionBy(*cell, "_chunk").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("_run", F.min("_low").over(so_far))
        .join(chunks, [*cell, "_chunk"])
        .select("_park", "_at", "lat", "lon", "q_b", "q_l", F.least("_run", "_carried").alias("_low"))
    )


def _km(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    p1, p2 = math.radians(lat1), math.radians(lat2)
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * geo.EARTH_RADIUS_KM * math.asin(math.sqrt(min(1.0, h)))


def main_sections(sections: DataFrame, key: str = "park_code") -> DataFrame:
    """Sections above the least area and at least a fixed share of the park's largest."""
    big = sections.where(F.col("area") >= fv.MIN_RING_AREA_DEG2)
    largest = big.groupBy(key).agg(F.max("area").alias("_largest"))
    return big.join(largest, key).where(F.col("area") >= F.col("_largest") * fv.MIN_RING_AREA_RATIO).drop("_largest")


def prepare_rings(rings: DataFrame, key: str = "park_code", secondary: int | None = None) -> DataFrame:
    """Largest ring of each unit as main, and its larger secondary rings, ranked by area.

    ``rings``: key, section, points, area. Rings under four points are dropped; secondary rings need
    the least area and a share of the main one; ``secondary`` keeps that many of them.
    """
    usable = rings.where(F.col("points") >= 4)
    main = usable.groupBy(key).agg(F.max("area").alias("_main"), F.min_by("section", F.struct(-F.col("area"), "section")).alias("_first"))
    judged = usable.join(main, key)
    is_main = F.col("section") == F.col("_first")
    good = (F.col("area") >= fv.MIN_RING_AREA_DEG2) & (F.col("area") >= F.col("_main") * fv.MIN_RING_AREA_RATIO)
    kept = judged.where(is_main | good).withColumn("_order", F.when(is_main, F.lit(0)).otherwise(F.lit(1))).withColumn(
        "_fall", -F.col("area")
    )
    ranked = rank_in_groups(kept, [key], ["_order", "_fall", "section"], "ring_rank")
    if secondary is not None:
        ranked = ranked.where(F.col("ring_rank") <= secondary + 1)
    return ranked.drop("_main", "_first", "_order", "_fall")


def cluster_centres(sections: DataFrame, clusters: DataFrame, key: str = "park_code") -> DataFrame:
    """Area-weighted centre of each cluster."""
    rows = sections.join(clusters, [key, "section"])
    w = F.sum("area")
    return rows.groupBy(key, "cluster").agg(
        (F.sum(F.col("lat") * F.col("area")) / w).alias("lat"),
        geo.mean_lon("lon", "area").alias("lon"),
        F.count(F.lit(1)).alias("section_count"),
        w.alias("area"),
    )


LABEL_STATE = T.StructType(
    [
        T.StructField("cluster", T.IntegerType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("label", T.StringType()),
    ]
)
LABEL_OUT = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("label", T.StringType())])


def label_clusters(centres: DataFrame, centers: DataFrame, overrides: DataFrame, key: str = "park_code") -> DataFrame:
    """Pin labels: overrides, then visitor centers in order, then ``Area n`` from north to south.

    ``centers``: key, seq, name, lat, lon. ``overrides``: key, cluster, label. A visitor center gives
    its label to the nearest unlabelled cluster within 80 km when the label is still free.
    """
    centres = stage(centres, "centres")
    start = centres.select(key, "cluster", "lat", "lon").join(
        overrides.select(key, "cluster", F.col("label")), [key, "cluster"], "left"
    )
    named = stage(
        centers.withColumn("label", pin_label("name"))
        .where((F.col("label") != "") & F.col("lat").isNotNull() & F.col("lon").isNotNull())
        # a later copy of a label on the same spot can never act when the first did not
        .groupBy(key, "label", "lat", "lon")
        .agg(F.min("seq").alias("seq"))
        .join(centres.select(key).distinct(), key, "left_semi"),
        "named",
    )

    def step(chunk: list[tuple], state: list[dict]) -> tuple[list[dict], list[dict]]:
        state = sorted((dict(s, label=s["label"] or "") for s in state), key=lambda s: s["cluster"])
        used = {s["label"] for s in state if s["label"]}
        for _, label, lat, lon in chunk:
            best, best_d = None, math.inf
            for s in state:
                if s["label"]:
                    continue
                d = _km(lat, lon, s["lat"], s["lon"])
                if d < best_d and d <= fv.PIN_LABEL_KM:
                    best, best_d = s, d
            if best is not None and label not in used:
                best["label"] = label
                used.add(label)
        return [], [dict(s, cluster=int(s["cluster"])) for s in state]

    _, state = ordered_fold(
        named.select(key, "seq", "label", "lat", "lon"), key, ["seq", "label", "lat", "lon"], step, LABEL_OUT, LABEL_STATE,
        initial=start.select(key, "cluster", "lat", "lon", "label"), frames=False,
    )
    labelled = centres.join(state.select(key, "cluster", F.nullif("label", F.lit("")).alias("label")), [key, "cluster"], "left")
    counts = centres.groupBy(key).agg(F.count(F.lit(1)).alias("_clusters"))
    open_ones = labelled.where("label is null").withColumn("_fall", -F.col("lat"))
    numbered = rank_in_groups(open_ones.select(key, "cluster", "_fall"), [key], ["_fall", "cluster"], "_area")
    return (
        labelled.join(numbered.select(key, "cluster", "_area"), [key, "cluster"], "left")
        .join(counts, key)
        .withColumn(
            "label",
            F.coalesce(
                "label", F.when(F.col("_clusters") > 1, F.concat(F.lit("Area "), F.col("_area").cast("string"))), F.lit("")
            ),
        )
        .drop("_area", "_clusters")
    )


def map_pins(
    sections: DataFrame, centers: DataFrame, overrides: DataFrame, extra_pins: DataFrame | None = None, key: str = "park_code"
) -> DataFrame:
    """One pin per section cluster (primary first), labelled, plus the extra pins of the overrides."""
    kept = stage(main_sections(sections, key), "kept")
    clusters = section_clusters(kept, key=key)
    labelled = label_clusters(cluster_centres(kept, clusters, key), centers, overrides, key)
    slug = F.when(text("label") != "", slugify("label")).otherwise(
        F.concat(F.lit("area-"), (F.col("cluster") + 1).cast("string"))
    )
    pins = labelled.select(
        key,
        F.concat_ws("-", F.lower(F.col(key)), slug).alias("pin_id"),
        "label",
        geo.half_up("lat", 1e5).alias("lat"),
        geo.half_up("lon", 1e5).alias("lon"),
        F.when(F.col("cluster") == 0, F.lit("primary")).otherwise(F.lit("secondary")).alias("role"),
        "section_count",
    )
    if extra_pins is not None:
        pins = pins.unionByName(
            extra_pins.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(
                key,
                F.col("pin_id"),
                F.coalesce(F.nullif("label", F.lit("")), F.lit("Additional unit")).alias("label"),
                geo.half_up("lat", 1e5).alias("lat"),
                geo.half_up("lon", 1e5).alias("lon"),
                F.lit("secondary").alias("role"),
                F.lit(0).cast("bigint").alias("section_count"),
            )
        )
    return pins
