"""Spatial joins as cell equi-joins with an exact distance test.

No operator here builds a cross join. Copies (rows sharing an exact coordinate) are folded before
the join, nearest joins bound whole cells before they look at rows, and hot cells are left to the skew
splitting that ``runtime.configure`` turns on.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import geo
from waymark.operators import cells
from waymark.operators.nearest import nearest_spots
from waymark.operators.ranking import rank_in_groups
from waymark.runtime import stage, stage_counted


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.selectExpr(*[f"`{c}` as `{prefix}{c}`" for c in df.columns])


def radius_join(
    left: DataFrame,
    right: DataFrame,
    radius: float,
    unit: str = "m",
    on: Sequence[str] = (),
    left_prefix: str = "l_",
    right_prefix: str = "r_",
    distance: str = "distance",
) -> DataFrame:
    """All pairs within ``radius`` that agree on the ``on`` columns. Both sides carry lat, lon."""
    d = cells.cell_degrees(radius, unit)
    l, r = left_prefix, right_prefix
    a = cells.with_probe_cells(prefixed(left, l), f"{l}lat", f"{l}lon", radius, unit, d, "_lc")
    b = cells.with_cell(prefixed(right, r), f"{r}lat", f"{r}lon", d, "_rc")
    same = " and ".join(["_lc_b = _rc_b", "_lc_l = _rc_l", *[f"`{l}{c}` = `{r}{c}`" for c in on]])
    dist = geo.haversine(f"{l}lat", f"{l}lon", f"{r}lat", f"{r}lon", unit)
    return (
        a.join(b, F.expr(same))
        .withColumn(distance, dist)
        .where(f"{distance} <= {float(radius)!r}D")
        .drop("_lc_b", "_lc_l", "_rc_b", "_rc_l")
    )


def self_pairs(points: DataFrame, radius: float, unit: str = "m", on: Sequence[str] = (), order: str = "id") -> DataFrame:
    """Each unordered pair once: the earlier row is ``l_``, the later one ``r_``."""
    return radius_join(points, points, radius, unit, on).filter(F.col(f"l_{order}") < F.col(f"r_{order}"))


def nearest_within(
    left: DataFrame,
    right: DataFrame,
    radius: float | None,
    unit: str = "m",
    on: Sequence[str] = (),
    left_key: str = "id",
    right_key: str = "id",
    distance: str = "distance",
) -> DataFrame:
    """Nearest right row per left row within ``radius``; ties go to the lowest right key.

    Output: every left column, ``near`` (struct of the right row, null when none) and the distance.
    Left rows are folded to distinct search points and right copies to their lowest key; the search is the branch
    and bound of ``operators.nearest``, so crowds on either side, near or far, cost few candidates per point.
    """
    at = ["lat", "lon", *on]
    spots = left.select(*at).na.drop(subset=["lat", "lon"]).distinct()
    payload = F.struct(F.col(right_key).alias("_k"), F.struct(*[F.col(c) for c in right.columns]).alias("_row"))
    folded = (
        right.na.drop(subset=["lat", "lon"])
        .groupBy(*at)
        .agg(F.min_by(payload, F.col(right_key)).alias("_p"))
        .select(*at, "_p._k", "_p._row")
    )
    found = nearest_spots(spots, folded.select(*at, "_k"), "_k", on, radius, unit)
    rows = folded.select(F.col("_k").alias("_near"), F.col("_row").alias("near"))
    hit = found.join(rows, F.col("_k") == F.col("_near")).select(
        *[F.col(c).alias(f"_at_{c}") for c in at], "near", F.col("_d").alias(distance)
    )
    return _attach(left, hit, at).select(*[left[c] for c in left.columns], "near", distance)


def _attach(left: DataFrame, hit: DataFrame, at: Sequence[str]) -> DataFrame:
    """Left rows with what was found at their search point (``_at_`` columns)."""
    same = F.lit(True)
    for c in at:
        same = same & (left[c] == hit[f"_at_{c}"])
    return left.join(hit, same, "left")


def nearest_any(
    left: DataFrame,
    right: DataFrame,
    unit: str = "m",
    on: Sequence[str] = (),
    left_key: str = "id",
    right_key: str = "id",
    distance: str = "distance",
) -> DataFrame:
    """Nearest right row per left row at any distance, null where no right row has the ``on`` value."""
    return nearest_within(left, right, None, unit, on, left_key, right_key, distance)


def box_code(
    lat,
    lon,
    boxes: Sequence[tuple],
    overlap_rules: Sequence[tuple] = (),
) -> Column:
    """Code of the first box holding the point, null when none.

    ``boxes`` is the ordered region table (code, south, west, north, east): a fixed dimension of
    some dozens of rows, compiled into the expression, so no join and no shuffle is needed.
    ``overlap_rules`` (code_a, code_b, meridian, east_code, west_code) decide for points that lie
    in both boxes; earlier rules win.
    """
    lat, lon = geo.col(lat), geo.col(lon)
    inside = {code: geo.in_box(lat, lon, s, w, n, e) for code, s, w, n, e in boxes}
    chain = F.when(F.lit(False), F.lit(None).cast("string"))
    for a, b, meridian, east_code, west_code in overlap_rules:
        chain = chain.when(
            inside[a] & inside[b], F.when(lon > meridian, F.lit(east_code)).otherwise(F.lit(west_code))
        )
    for code, hit in inside.items():
        chain = chain.when(hit, F.lit(code))
    return chain


def box_join(points: DataFrame, boxes: DataFrame, cell_deg: float = 1.0, key: str = "id", output: str = "region") -> DataFrame:
    """First box by ``seq`` for each point when the boxes are a table of any size."""
    covered = boxes.withColumn(
        "cell_i", F.explode(F.sequence(F.floor(F.col("south") / cell_deg), F.floor(F.col("north") / cell_deg)))
    ).withColumn("cell_j", F.explode(F.sequence(F.floor(F.col("west") / cell_deg), F.floor(F.col("east") / cell_deg))))
    spots = points.select(key, "lat", "lon").withColumn("cell_i", F.floor(F.col("lat") / cell_deg)).withColumn(
        "cell_j", F.floor(F.col("lon") / cell_deg)
    )
    first = (
        spots.join(covered, ["cell_i", "cell_j"])
        .where(geo.in_box("lat", "lon", F.col("south"), F.col("west"), F.col("north"), F.col("east")))
        .groupBy(key)
        .agg(F.min_by("code", "seq").alias(output))
    )
    return points.join(first, key, "left")


def nearest_centre_code(lat: str, lon: str, centres: Sequence[tuple]) -> Column:
    """Code of the nearest centre (code, lat, lon); ties go to the earlier row of the table.

    Points and centres are unit vectors: the nearest centre has the largest dot product, so the
    trigonometry is done once per point and not once per centre.
    """
    def vector(a: float, b: float) -> tuple[float, float, float]:
        p, q = math.radians(a), math.radians(b)
        return math.cos(p) * math.cos(q), math.cos(p) * math.sin(q), math.sin(p)

    rows = ", ".join(
        "named_struct('x', {!r}D, 'y', {!r}D, 'z', {!r}D, 'seq', {}, 'code', '{}')".format(*vector(a, b), -i, code)
        for i, (code, a, b) in enumerate(centres)
    )
    p, q = f"radians({lat})", f"radians({lon})"
    point = f"named_struct('x', cos({p}) * cos({q}), 'y', cos({p}) * sin({q}), 'z', sin({p}))"
    best = (
        f"transform(array({point}), p -> array_max(transform(array({rows}), "
        "c -> named_struct('dot', p.x * c.x + p.y * c.y + p.z * c.z, 'seq', c.seq, 'code', c.code))))"
    )
    return F.expr(f"case when {lat} is not null and {lon} is not null then {best}[0].code end")


#: segments of a cell from which points search finer cells first
CROWD = 512


#: degrees by which a segment's columns are widened against rounding
_EDGE = 1e-9


def segment_cells(segments: DataFrame, cell_deg: float) -> DataFrame:
    """One row per (segment, fixed-degree cell it crosses): in every row of cells the columns of its part there."""
    size = f"{cell_deg!r}D"
    rows = segments.selectExpr(
        "*", f"explode(sequence(floor((least(lat1, lat2) - {_EDGE}) / {size}), floor((greatest(lat1, lat2) + {_EDGE}) / {size}))) as cell_i"
    )

    def lon_at(edge: str) -> str:
        """Longitude where the segment meets a latitude, its ends included."""
        share = f"greatest(0D, least(1D, (({edge}) - lat1) / (lat2 - lat1)))"
        return f"(lon1 + {share} * (lon2 - lon1))"

    low, high = lon_at(f"cell_i * {size}"), lon_at(f"(cell_i + 1) * {size}")
    # along a parallel, or nearly so, the whole segment lies in its rows
    flat = f"abs(lat2 - lat1) <= {_EDGE}"
    west = f"floor((case when {flat} then least(lon1, lon2) else least({low}, {high}) end - {_EDGE}) / {size})"
    east = f"floor((case when {flat} then greatest(lon1, lon2) else greatest({low}, {high}) end + {_EDGE}) / {size})"
    return rows.selectExpr("*", f"explode(sequence({west}, {east})) as cell_j")


def unwrapped(segments: DataFrame) -> DataFrame:
    """Segments over the date line twice, with longitudes beyond 180 and below -180; the others as they are."""
    over = "abs(lon2 - lon1) > 180"
    others = [c for c in segments.columns if c not in ("lon1", "lon2")]
    east = "struct(lon1 + if(lon1 < 0, 360D, 0D) as lon1, lon2 + if(lon2 < 0, 360D, 0D) as lon2)"
    west = "struct(lon1 - if(lon1 > 0, 360D, 0D) as lon1, lon2 - if(lon2 > 0, 360D, 0D) as lon2)"
    made = segments.selectExpr(*others, f"inline(if({over}, array({east}, {west}), array(struct(lon1 as lon1, lon2 as lon2))))")
    return made.select(*segments.columns)


def nearest_segment(
    points: DataFrame,
    segments: DataFrame,
    cell_deg: float,
    reach: int | None = 1,
    max_m: float | None = None,
    key: str = "id",
    on: Sequence[str] = (),
    local_plane: bool = True,
    output: str = "distance_m",
) -> DataFrame:
    """Least distance in metres from each point to any segment in the cells searched.

    ``reach`` is the number of cells around the point's own; with ``max_m`` rows and columns follow from it and the
    latitude instead, up to the poles. Points near the date line also search from the other turn of the globe. Copies of a segment are dropped first, search points are folded to distinct
    coordinates, and the minimum is pre-aggregated before the shuffle back. Where cells are crowded,
    points first search cells an eighth as wide: a hit closer than such a cell is final. Left outer:
    no segment in reach gives null.
    """
    at = ["lat", "lon", *on]
    spots = points.select(*at).where("lat is not null and lon is not null").distinct()
    unique = unwrapped(segments.select("lat1", "lon1", "lat2", "lon2", *on).distinct())
    best = _segment_search(spots, unique, cell_deg, reach, max_m, at, on, local_plane, output, 0)
    best = best.withColumnsRenamed({c: f"_at_{c}" for c in at})
    return _attach(points, best, at).drop(*[f"_at_{c}" for c in at])


def _segment_search(spots, segments, cell_deg, reach, max_m, at, on, local_plane, output, depth) -> DataFrame:
    index = segment_cells(segments, cell_deg)
    top = index.groupBy("cell_i", "cell_j", *on).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    done = None
    if top > CROWD and depth < 5:
        fine = cell_deg / 8
        near_m = fine * geo.METERS_PER_DEGREE / 4
        close = stage(
            _segment_search(spots, segments, fine, None, near_m, at, on, local_plane, output, depth + 1).where(
                F.col(output) <= near_m
            ),
            "segment-step",
        )
        done = close
        spots = spots.join(close.select(*at), at, "left_anti")
    size = f"{cell_deg!r}D"
    if max_m is not None:
        # rows are as high everywhere, columns narrow towards the poles: all of them where a pole is in reach
        up = max_m / geo.METERS_PER_DEGREE
        tall = f"{math.floor(up / cell_deg) + 1}L"
        narrow = f"cos(radians(least(abs(lat) + {up!r}D, 90D)))"
        wide = f"cast(ceil(least(180D, if({narrow} < 1e-9, 180D, {up!r}D / {narrow})) / {size}) + 1 as long)"
    else:
        tall = wide = f"{int(reach)}L"
    turned = (
        f"array_compact(array(0D, if(lon - (_k + 1) * {size} < -180, 360D, null), if(lon + (_k + 1) * {size} > 180, -360D, null)))"
    )
    probes = (
        spots.selectExpr("*", f"{wide} as _k")
        .selectExpr("*", f"explode(sequence(floor(lat / {size}) - {tall}, floor(lat / {size}) + {tall})) as cell_i")
        .selectExpr("*", f"explode({turned}) as _turn")
        .selectExpr("*", f"explode(sequence(floor((lon + _turn) / {size}) - _k, floor((lon + _turn) / {size}) + _k)) as cell_j", "lon + _turn as _lon")
        .drop("_k", "_turn")
    )
    measure = geo.segment_distance_local if local_plane else geo.segment_distance_degrees
    dist = measure("lat", "_lon", "lat1", "lon1", "lat2", "lon2")
    best = (
        probes.join(index, ["cell_i", "cell_j", *on])
        .select(*at, dist.alias("_d"))
        .groupBy(*at)
        .agg(F.min("_d").alias(output))
    )
    return best if done is None else done.unionByName(best)


def ray_crosses(lat: Column, lon: Column, lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """True when the eastward ray from the point crosses the edge."""
    x = (lon2 - lon1) * (lat - lat1) / F.nullif(lat2 - lat1, F.lit(0.0)) + lon1
    return F.coalesce(((lat1 > lat) != (lat2 > lat)) & (lon < x), F.lit(False))


#: cells that a side of a polygon's box spans at most, edges of a polygon in one row, and its most rows
SPAN, ROW_EDGES, MOST_ROWS = 2, 16, 1024
#: polygons of a cell in the first round of :func:`first_polygon`
FIRST_POLYGONS = 8
_CELL = ["_tall", "_wide", "cell_i", "cell_j"]


def points_in_polygons(
    points: DataFrame, edges: DataFrame, cell_deg: float = 0.1, key: str = "id", polygon_key: str = "polygon_id"
) -> DataFrame:
    """(point key, polygon key) for every point inside a polygon, holes excluded.

    ``edges`` has one row per ring edge: polygon key, ring (0 = outer), lat1, lon1, lat2, lon2. The
    parity test only needs the edges whose latitude span holds the point and which lie east of it.
    Parities are summed before the shuffle: a polygon with very many vertices is never gathered in one task.
    """
    covered, edge_rows = _listed_polygons(edges, cell_deg, polygon_key)
    spots = points.select("lat", "lon").where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).distinct()
    met = _probes(spots, covered, cell_deg).join(covered, _CELL)
    inside = _held(met, edge_rows, polygon_key)
    return points.select(key, "lat", "lon").join(inside, ["lat", "lon"]).select(key, polygon_key)


def _listed_polygons(edges: DataFrame, cell_deg: float, polygon_key: str) -> tuple[DataFrame, DataFrame]:
    """(polygons by cell, edges by row of their polygon).

    A polygon is listed in a few cells of a size that fits the height and the width of its box, from ``cell_deg`` upwards.
    An edge is listed in the rows of its polygon that it spans, one row for every few edges.
    """
    size = f"{cell_deg!r}D"
    box = edges.groupBy(polygon_key).agg(
        F.min(F.least("lat1", "lat2")).alias("south"),
        F.min(F.least("lon1", "lon2")).alias("west"),
        F.max(F.greatest("lat1", "lat2")).alias("north"),
        F.max(F.greatest("lon1", "lon2")).alias("east"),
        F.least(F.ceil(F.count(F.lit(1)) / ROW_EDGES), F.lit(MOST_ROWS)).alias("_rows"),
    )
    tall, wide = [
        f"cast(greatest(0, ceil(log2(({b} - {a}) / ({SPAN} * {size})))) as int)" for a, b in (("south", "north"), ("west", "east"))
    ]
    box = stage(box.selectExpr("*", f"{tall} as _tall", f"{wide} as _wide"), "boxes")
    high, broad = f"({size} * pow(2, _tall))", f"({size} * pow(2, _wide))"
    covered = box.selectExpr(
        "*", f"explode(sequence(floor(south / {high}), floor(north / {high}))) as cell_i"
    ).selectExpr("*", f"explode(sequence(floor(west / {broad}), floor(east / {broad}))) as cell_j")
    edge_rows = edges.join(box.select(polygon_key, "south", "north", "_rows"), polygon_key).selectExpr(
        f"`{polygon_key}`", "ring", "lat1", "lon1", "lat2", "lon2",
        f"explode(sequence({_row('least(lat1, lat2)')}, {_row('greatest(lat1, lat2)')})) as row",
    )
    return covered, edge_rows


def _row(lat: str) -> str:
    """Row of a latitude between the south and the north of a polygon."""
    return f"coalesce(floor(({lat} - south) / nullif(north - south, 0D) * _rows), 0L)"


def _probes(spots: DataFrame, covered: DataFrame, cell_deg: float) -> DataFrame:
    """Spots with their cell of every size in use, a few dozen at most."""
    used = covered.select("_tall", "_wide").distinct().collect()
    sizes = F.array(*[F.struct(F.lit(r["_tall"]).alias("_tall"), F.lit(r["_wide"]).alias("_wide")) for r in used])
    if not used:
        sizes = F.from_json(F.lit("[]"), "array<struct<_tall: int, _wide: int>>")
    return spots.select("*", F.inline(sizes)).selectExpr(
        "*", f"floor(lat / ({cell_deg!r}D * pow(2, _tall))) as cell_i", f"floor(lon / ({cell_deg!r}D * pow(2, _wide))) as cell_j"
    )


def _held(met: DataFrame, edge_rows: DataFrame, polygon_key: str) -> DataFrame:
    """(lat, lon, polygon key) of the spots that met a polygon's cell and lie inside it."""
    candidates = met.where(geo.in_box("lat", "lon", F.col("south"), F.col("west"), F.col("north"), F.col("east"))).selectExpr(
        "lat", "lon", f"`{polygon_key}`", f"{_row('lat')} as row"
    )
    crossing = ray_crosses(F.col("lat"), F.col("lon"), F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2"))
    return (
        candidates.join(edge_rows, [polygon_key, "row"])
        .where(crossing)
        .groupBy("lat", "lon", polygon_key, "ring")
        .agg((F.count(F.lit(1)) % 2).alias("odd"))
        .groupBy("lat", "lon", polygon_key)
        .agg(
            F.max(F.when(F.col("ring") == 0, F.col("odd")).otherwise(0)).alias("in_outer"),
            F.max(F.when(F.col("ring") > 0, F.col("odd")).otherwise(0)).alias("in_hole"),
        )
        .where((F.col("in_outer") == 1) & (F.col("in_hole") == 0))
        .select("lat", "lon", polygon_key)
    )


def first_polygon(points: DataFrame, edges: DataFrame, polygons: DataFrame, cell_deg: float = 0.1, key: str = "id", polygon_key: str = "polygon_id") -> DataFrame:
    """Each point with the first polygon by ``priority`` that holds it (null when none).

    The polygons of each cell are tried in order, in rounds of growing numbers. A spot meets only polygons before the one
    it has, and leaves when none of its cells has such a polygon left. So where many polygons lie over each other, a spot
    meets few of them, and no list of all pairs is made.
    """
    # a null priority comes first, as it does in the minimum of a struct
    named = polygons.where(F.col(polygon_key).isNotNull()).groupBy(polygon_key).agg(F.min(F.struct("priority"))["priority"].alias("priority"))
    ranked = rank_in_groups(named.withColumn("_all", F.lit(0)), ["_all"], ["priority", polygon_key], "_rank")
    order = stage(ranked.select(polygon_key, F.col("_rank").cast("long").alias("_rank")), "polygons")
    listed, edge_rows = _listed_polygons(edges.join(order, polygon_key).drop(polygon_key), cell_deg, "_rank")
    covered = stage(rank_in_groups(listed, _CELL, ["_rank"], "_place"), "listed")
    edge_rows = stage(edge_rows, "edges")
    spots = points.select("lat", "lon").where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).distinct()
    live, left = stage_counted(spots.withColumn("_best", F.lit(None).cast("long")), "spots")
    found, done, until = None, 0, FIRST_POLYGONS
    while left:
        probes = _probes(live, covered, cell_deg)
        sooner = "_best is null or _rank < _best"
        met = probes.join(covered.where(F.col("_place").between(done + 1, until)), _CELL).where(sooner).drop("_best")
        hit = stage(_held(met, edge_rows, "_rank").groupBy("lat", "lon").agg(F.min("_rank").alias("_hit")), "inside")
        found = hit if found is None else found.unionByName(hit)
        # what was found is always sooner than what a spot had
        live = live.join(hit, ["lat", "lon"], "left").select("lat", "lon", F.coalesce("_hit", "_best").alias("_best"))
        ahead = _probes(live, covered, cell_deg).join(covered.where(F.col("_place") == until + 1).select(*_CELL, "_rank"), _CELL)
        live, left = stage_counted(ahead.where(sooner).select("lat", "lon", "_best").distinct(), "spots")
        done, until = until, until * 4
    if found is None:
        return points.join(order.where(F.lit(False)).select(F.lit(None).cast(points.schema[key].dataType).alias(key), polygon_key), key, "left")
    first = points.select(key, "lat", "lon").join(found, ["lat", "lon"]).groupBy(key).agg(F.min("_hit").alias("_rank"))
    return points.join(first.join(order, "_rank").select(key, polygon_key), key, "left")
