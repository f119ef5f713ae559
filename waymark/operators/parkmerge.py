"""Merge of park records by (country, state, normalised name) with a rank-based winner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark import fixed_values as fv
from waymark.functions.geo import haversine
from waymark.functions.parks import park_record_rank
from waymark.functions.text import state_park_key, text
from waymark.runtime import stage

#: what a url and an official code add to a rank
URL_POINTS, CODE_POINTS = 20, 15


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) != ""


def _seen(rows: DataFrame, radius_m: float) -> DataFrame:
    """Rows after the holder of their key, with distance and whether they are near it."""
    metres = haversine("h_lat", "h_lon", "lat", "lon", "m")
    return rows.withColumn("metres", metres).withColumn("near", F.col("metres") <= radius_m)


def _takeover(seen: DataFrame) -> DataFrame:
    """Per key: where url and code are first filled, and the first near row that outranks the holder by then."""
    first = seen.groupBy("key").agg(
        F.min(F.when(F.col("near") & _filled("url") & ~_filled("h_url"), F.struct("seq", "url"))).alias("url_from"),
        F.min(F.when(F.col("near") & _filled("official_code") & ~_filled("h_code"), F.struct("seq", "official_code"))).alias("code_from"),
    )
    gained = F.when(F.col("url_from.seq") < F.col("seq"), URL_POINTS).otherwise(0) + F.when(
        F.col("code_from.seq") < F.col("seq"), CODE_POINTS
    ).otherwise(0)
    wins = F.col("near") & (F.col("rank") >= F.col("h_rank") + gained)
    after = seen.join(first, "key").groupBy("key").agg(F.min(F.when(wins, F.col("seq"))).alias("next"))
    return first.join(after, "key")


def merge_parks(records: DataFrame, radius_m: float = fv.PARK_MERGE_M) -> tuple[DataFrame, DataFrame]:
    """(merged records, conflicts).

    Per key the first row in ``seq`` order holds the place. A row near the holder merges with it: it takes over if
    its rank is not lower, missing url and code are filled from the other side and count for the rank, and the
    other's map id is kept as an alternative. A row farther away stays on its own and is a conflict.

    A round finds, for all keys at once and by aggregation only, the next row that takes over; what lies before it is
    settled against the present holder. There are as many rounds as the most often changed holder has changes.
    Input: id, seq, country, state, name, lat, lon, source, url, official_code, osm_id, needs_review, osm_confidence.
    """
    key = F.concat_ws("::", F.col("country"), F.col("state"), state_park_key("name"))
    rank = park_record_rank("source", "url", "official_code", "osm_id", "needs_review", "osm_confidence")
    rows = stage(
        records.select(
            key.alias("key"), "seq", "id", "lat", "lon", text("osm_id").alias("osm_id"), text("source").alias("source"),
            text("url").alias("url"), text("official_code").alias("official_code"), rank.cast("int").alias("rank"),
        ),
        "park-rows",
    )
    own = [c for c in rows.columns if c not in ("key", "seq")]
    first = rows.groupBy("key").agg(F.min("seq").alias("seq"), F.min_by(F.struct(*own), "seq").alias("r"))
    renamed = {"official_code": "code", "osm_id": "osm"}
    none = F.lit("")
    holders = first.select(
        "key", F.col("seq").alias("h_seq"), *[F.col(f"r.{c}").alias(f"h_{renamed.get(c, c)}") for c in own],
        none.alias("h_last_source"), none.alias("h_last_osm"),
    )
    ahead, done, conflicts = rows, None, None
    while True:
        seen = stage(_seen(ahead.join(holders, "key").where("seq > h_seq"), radius_m), "park-seen")
        turn = stage(_takeover(seen), "park-turn")
        passed = seen.join(turn.select("key", "next"), "key").where("next is null or seq < next")
        far = passed.where("not near").select(
            F.col("h_id").alias("a_id"), F.col("id").alias("b_id"), F.floor(F.col("metres") + 0.5).alias("distance_m"), "seq"
        )
        conflicts = far if conflicts is None else conflicts.union(far)
        held = holders.join(turn, "key", "left")
        last = held.where("next is null").join(
            passed.where("near and next is null").groupBy("key").agg(
                F.collect_set("source").alias("sources"), F.collect_set("osm_id").alias("osms")
            ),
            "key", "left",
        )
        nothing = F.array().cast("array<string>")
        sources = F.concat(F.coalesce("sources", nothing), F.array("h_last_source"))
        merged = F.col("sources").isNotNull() | (F.col("h_took") if "h_took" in holders.columns else F.lit(False))
        sources = F.when(merged, F.concat(sources, F.array("h_source"))).otherwise(nothing)
        osms = F.concat(F.coalesce("osms", nothing), F.array("h_last_osm"))
        final = last.select(
            F.col("h_id").alias("id"),
            F.when(_filled("h_url"), F.col("h_url")).otherwise(F.coalesce("url_from.url", none)).alias("url"),
            F.when(_filled("h_code"), F.col("h_code")).otherwise(F.coalesce("code_from.official_code", none)).alias("official_code"),
            F.array_join(F.sort_array(F.array_distinct(F.filter(sources, lambda s: s != ""))), ",").alias("merge_sources"),
            F.array_join(
                F.sort_array(F.array_distinct(F.filter(osms, lambda o: (o != "") & (o != F.col("h_osm"))))), ","
            ).alias("alt_osm_ids"),
        )
        final = stage(final, "park-final")
        done = final if done is None else done.union(final)
        moved = held.where("next is not null")
        if moved.isEmpty():
            break

        def carried(mine: str, held_value: str, found: str) -> Column:
            """Own value, else the holder's, else the one filled in before the takeover."""
            filled = F.when(F.col(f"{found}.seq") < F.col("next"), F.col(f"{found}.{mine}"))
            return F.when(_filled(mine), F.col(mine)).when(_filled(held_value), F.col(held_value)).otherwise(F.coalesce(filled, none))

        url, code = carried("url", "h_url", "url_from"), carried("official_code", "h_code", "code_from")
        more = F.when(~_filled("url") & (url != ""), URL_POINTS).otherwise(0) + F.when(
            ~_filled("official_code") & (code != ""), CODE_POINTS
        ).otherwise(0)
        taken = moved.join(rows.withColumnRenamed("seq", "next"), ["key", "next"])
        holders = stage(
            taken.select(
                "key", F.col("next").alias("h_seq"), F.col("id").alias("h_id"), F.col("lat").alias("h_lat"), F.col("lon").alias("h_lon"),
                F.col("osm_id").alias("h_osm"), F.col("source").alias("h_source"), url.alias("h_url"), code.alias("h_code"),
                (F.col("rank") + more).cast("int").alias("h_rank"),
                F.col("h_source").alias("h_last_source"), F.col("h_osm").alias("h_last_osm"), F.lit(True).alias("h_took"),
            ),
            "park-holders",
        )
        ahead = rows
    conflicts = stage(conflicts, "park-conflicts")
    # a row apart replaces an earlier one with the same map id
    apart = conflicts.join(rows.select(F.col("id").alias("b_id"), "key", "osm_id"), "b_id")
    own_key = F.concat_ws("::", "key", F.coalesce(F.nullif("osm_id", F.lit("")), F.col("b_id")))
    alone = apart.groupBy(own_key.alias("own_key")).agg(F.max_by("b_id", "seq").alias("id"))
    result = done.unionByName(
        alone.join(rows, "id").select("id", "url", "official_code", none.alias("merge_sources"), none.alias("alt_osm_ids"))
    )
    return result.join(records.drop("url", "official_code"), "id"), conflicts.drop("seq")
