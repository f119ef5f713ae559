"""Operators against brute force, with a third of all rows on one spot."""

import math
import random

import pytest
from pyspark.sql import functions as F

from waymark.operators import clusters, components, dedupe, folding, matching, nearest, parkmerge, qa, ranking, rollup, spatial, textjoin

SCHEMA = "id string, seq long, lat double, lon double, brand_id string, name string"


def haversine(a, b, radius=3958.8):
    p, q = math.radians(a[2]), math.radians(b[2])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[3] - a[3]) / 2) ** 2
    return 2 * radius * math.asin(math.sqrt(h))


def rows(n=360, seed=5):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        lat, lon = (40.0, -100.0) if i % 3 == 0 else (40 + rnd.random() * 0.03, -100 + rnd.random() * 0.04)
        out.append((f"p{i:04d}", i, lat, lon, rnd.choice("ab"), rnd.choice(["x", "xy", "z", "zz", ""])))
    return out


def ordered(points, edge):
    kept, lost = [], []
    for r in points:
        hit = next((e for e in kept if edge(r, e)), None)
        if hit is None:
            kept.append(r)
        else:
            lost.append((hit[0], r[0]))
    return sorted(r[0] for r in kept), sorted(lost)


def test_ordered_dedupe_same_brand_and_idempotent(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    kept, lost = dedupe.ordered_dedupe(df, 0.12, "mi", on=["brand_id"])
    want = ordered(data, lambda r, e: r[4] == e[4] and haversine(r, e) <= 0.12)
    got = sorted(r.id for r in kept.collect())
    assert got == want[0]
    assert sorted((r.kept, r.dropped) for r in lost.collect()) == want[1]
    again, none = dedupe.ordered_dedupe(kept, 0.12, "mi", on=["brand_id"])
    assert sorted(r.id for r in again.collect()) == got and none.isEmpty()


def test_ordered_dedupe_with_names(spark):
    data = rows(seed=6)
    df = spark.createDataFrame(data, SCHEMA)

    def edge(left, right, d):
        return dedupe.names_alike(left("name"), right("name")) | ((d <= 0.05) & (left("brand_id") == right("brand_id")))

    kept, lost = dedupe.ordered_dedupe(df, 0.12, "mi", clique_on=["name", "brand_id"], clique_radius=0.05, edge=edge)

    def alike(r, e):
        d = haversine(r, e)
        named = bool(r[5]) and bool(e[5]) and (r[5] in e[5] or e[5] in r[5])
        return (d <= 0.12 and named) or (d <= 0.05 and r[4] == e[4])

    want = ordered(data, alike)
    assert sorted(r.id for r in kept.collect()) == want[0]
    assert sorted((r.kept, r.dropped) for r in lost.collect()) == want[1]


def test_chain_keeps_first_and_third(spark):
    step = 0.1 / 69.1
    data = [("a", 1, 40.0, -100.0, "x", ""), ("b", 2, 40.0 + step, -100.0, "x", ""), ("c", 3, 40.0 + 2 * step, -100.0, "x", "")]
    kept, _ = dedupe.ordered_dedupe(spark.createDataFrame(data, SCHEMA), 0.12, "mi")
    assert sorted(r.id for r in kept.collect()) == ["a", "c"]


def test_cobrand_follows_the_order(spark):
    rnd = random.Random(3)
    data = [r[:4] + (rnd.choice(["pilot", "flyingj", "pilot_flyingj"]),) for r in rows(240)]
    kept, lost = dedupe.cobrand_dedupe(
        spark.createDataFrame(data, "id string, seq long, lat double, lon double, brand_id string"), 0.12,
        ("pilot", "flyingj"), "pilot_flyingj",
    )
    out, gone = [], []
    for r in map(list, data):
        for e in out:
            if haversine(r, e) > 0.12:
                continue
            if r[4] == e[4]:
                gone.append((e[0], r[0], "same-brand-near"))
                break
            if "pilot_flyingj" not in (r[4], e[4]):
                e[4] = "pilot_flyingj"
                gone.append((e[0], r[0], "sister-brand-merge"))
                break
        else:
            out.append(r)
    assert sorted((r.id, r.brand_id) for r in kept.collect()) == sorted((r[0], r[4]) for r in out)
    assert sorted((r.kept, r.dropped, r.reason) for r in lost.collect()) == sorted(gone)


def test_three_sister_stations_keep_the_third(spark):
    data = [("a", 1, 40.0, -100.0, "pilot"), ("b", 2, 40.0, -100.0, "flyingj"), ("c", 3, 40.0, -100.0, "pilot")]
    kept, _ = dedupe.cobrand_dedupe(
        spark.createDataFrame(data, "id string, seq long, lat double, lon double, brand_id string"), 0.12,
        ("pilot", "flyingj"), "pilot_flyingj",
    )
    assert sorted((r.id, r.brand_id) for r in kept.collect()) == [("a", "pilot_flyingj"), ("c", "pilot")]


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def test_components_match_union_find(spark):
    data = rows(300)
    got = {r.id: r.component for r in components.proximity_components(spark.createDataFrame(data, SCHEMA), 250, "m").collect()}
    parent = {r[0]: r[0] for r in data}
    for i, a in enumerate(data):
        for b in data[:i]:
            if haversine(a, b, 6371000) <= 250:
                x, y = find(parent, a[0]), find(parent, b[0])
                if x != y:
                    parent[max(x, y)] = min(x, y)
    assert got == {x: find(parent, x) for x in parent}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "src long, dst long")
    got = {r.id: r.component for r in components.connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


def test_greedy_match_is_sort_and_scan(spark):
    data = rows(300)
    left = [r for r in data if r[1] % 2 == 0]
    right = [r for r in data if r[1] % 2] + [(f"q{i:03d}", 1000 + i, 40.0, -100.0, "ab"[i % 2], "x") for i in range(30)]
    m = matching.greedy_match(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), 0.5, "mi", ["brand_id"])
    pairs = sorted((haversine(a, b), a[0], b[0]) for a in left for b in right if a[4] == b[4] and haversine(a, b) <= 0.5)
    used, want = set(), []
    for _, a, b in pairs:
        if ("l", a) not in used and ("r", b) not in used:
            used |= {("l", a), ("r", b)}
            want.append((a, b))
    got = sorted((r.left_key, r.right_key) for r in m.collect())
    assert got == sorted(want)
    assert len({a for a, _ in got}) == len(got) == len({b for _, b in got})


def test_nearest_with_ties_and_radius(spark):
    data = rows(200)
    left, right = data[:100], data[100:]
    hit = spatial.nearest_within(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), 0.3, "mi", ["brand_id"])
    want = []
    for a in left:
        c = [(haversine(a, b), b[0]) for b in right if a[4] == b[4] and haversine(a, b) <= 0.3]
        want.append((a[0], min(c)[1] if c else None))
    assert sorted((r.id, r.near.id if r.near else None) for r in hit.collect()) == sorted(want)


def test_nearest_any_reaches_far_and_over_the_date_line(spark):
    left = [("a", 1, 10.0, 179.9, "x", ""), ("b", 2, -40.0, 0.0, "x", ""), ("c", 3, 0.0, 0.0, "none", "")]
    right = [("e", 1, 10.0, -179.9, "x", ""), ("f", 2, 10.0, 179.0, "x", "")]
    hit = spatial.nearest_any(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), "km", ["brand_id"])
    assert sorted((r.id, r.near.id if r.near else None) for r in hit.collect()) == [("a", "e"), ("b", "f"), ("c", None)]


def _around(kind, n, draw):
    for i in range(n):
        if kind == "pole":
            yield i, draw.uniform(88, 90), draw.uniform(-180, 180), draw.choice("ab")
        elif kind == "date line":
            yield i, draw.uniform(-1, 1), (359.9 + draw.uniform(0, 0.2)) % 360 - 180, draw.choice("ab")
        else:
            yield i, 40 + round(draw.uniform(0, 0.02), 4), 10 + round(draw.uniform(0, 0.02), 4), draw.choice("ab")


@pytest.mark.parametrize("kind, radius_km, on", [("pole", None, []), ("pole", 60, ["g"]), ("date line", None, ["g"]), ("date line", 8, []), ("crowd", 0.2, []), ("crowd", None, ["g"])])
def test_nearest_against_all_pairs(spark, kind, radius_km, on):
    draw = random.Random(7)
    left, right = list(_around(kind, 150, draw)), list(_around(kind, 150, draw))
    schema = "id long, lat double, lon double, g string"
    odd = [(900, None, 1.0, "a"), (901, float("nan"), 1.0, "a"), (902, 40.0, 10.0, None)]
    hit = spatial.nearest_within(spark.createDataFrame(left + odd, schema), spark.createDataFrame(right + odd[:2], schema), radius_km, "km", on)
    want = {i: None for i, *_ in odd} if on else {900: None, 901: None, 902: 0}
    for a in left + ([] if on else odd[2:]):
        met = [(_km(a, b), b[0]) for b in right if not on or a[3] == b[3]]
        met = [m for m in met if radius_km is None or m[0] <= radius_km]
        want[a[0]] = min(met)[1] if met else None
    assert {r.id: r.near.id if r.near else None for r in hit.collect()} == want


def _km(a, b):
    p, q = math.radians(a[1]), math.radians(b[1])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, h)))


def test_crowds_that_face_each_other_meet_in_few_rows(spark):
    met = []
    for n in (1000, 8000):
        made = [
            spark.range(n).select((F.rand(3) * 0.02 + 40.0 + off).alias("lat"), (F.rand(5) * 0.02 + 10.0).alias("lon")) for off in (0.0, 0.1)
        ]
        met.append(nearest.candidates(*made)[0].count() / n)
    # rows met by each spot: no share of the other crowd, however large it is
    assert met[0] < 60 and met[1] < 60


def test_radius_join_over_the_date_line(spark):
    data = [("a", 1, 60.0, 179.9995, "x", ""), ("b", 2, 60.0, -179.9995, "x", "")]
    df = spark.createDataFrame(data, SCHEMA)
    assert spatial.self_pairs(df, 100, "m").count() == 1


def test_polygon_with_hole_and_first_priority(spark):
    def ring(key, no, pts):
        return [(key, no, a[0], a[1], b[0], b[1]) for a, b in zip(pts, pts[1:] + pts[:1])]

    square = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 0.0)]
    hole = [(0.4, 0.4), (0.4, 0.6), (0.6, 0.6), (0.6, 0.4)]
    edges = spark.createDataFrame(
        ring("p", 0, square) + ring("p", 1, hole) + ring("q", 0, square), "polygon_id string, ring int, lat1 double, lon1 double, lat2 double, lon2 double"
    )
    polygons = spark.createDataFrame([("p", 0), ("q", 1)], "polygon_id string, priority int")
    points = spark.createDataFrame([("in", 0.2, 0.2), ("hole", 0.5, 0.5), ("out", 2.0, 2.0)], "id string, lat double, lon double")
    got = {r.id: r.polygon_id for r in spatial.first_polygon(points, edges, polygons).collect()}
    assert got == {"in": "p", "hole": "q", "out": None}


def test_segment_distance_of_zero_length_and_far(spark):
    points = spark.createDataFrame([("a", 40.0, -100.0), ("b", 41.0, -100.0)], "id string, lat double, lon double")
    segments = spark.createDataFrame([(40.0005, -100.0, 40.0005, -100.0)], "lat1 double, lon1 double, lat2 double, lon2 double")
    got = {r.id: r.distance_m for r in spatial.nearest_segment(points, segments, 0.0015, max_m=250.0).collect()}
    assert abs(got["a"] - 55.6) < 0.1 and got["b"] is None


def test_rank_in_hot_group(spark):
    df = spark.range(0, 5000, 1, 7).selectExpr("if(id % 3 = 0, 'hot', 'k' || id % 50) as k", "id * 7919 % 5000 as v")
    got = ranking.rank_in_groups(df, ["k"], ["v"], "r").where("k = 'hot'").orderBy("r").collect()
    assert [r.r for r in got] == list(range(1, len(got) + 1))
    assert [r.v for r in got] == sorted(r.v for r in got)


def test_fold_in_chunks_hands_its_state_on(spark):
    from pyspark.sql import types as T

    state = T.StructType([T.StructField("total", T.LongType())])
    output = T.StructType([T.StructField("v", T.LongType()), T.StructField("running", T.LongType())])

    def step(chunk, held):
        total = held[0]["total"] if held else 0
        outs = []
        for v in chunk["v"]:
            total += int(v)
            outs.append({"v": int(v), "running": total})
        return outs, [{"total": total}]

    df = spark.range(1, 41).selectExpr("if(id <= 30, 'hot', 'cold') as k", "id as v")
    out, states = folding.ordered_fold(df, "k", ["v"], step, output, state, chunk_rows=7)
    hot = {r.v: r.running for r in out.where("k = 'hot'").collect()}
    assert hot == {v: v * (v + 1) // 2 for v in range(1, 31)}
    assert {r.k: r.total for r in states.collect()} == {"hot": 465, "cold": sum(range(31, 41))}


def test_park_merge_moves_its_winner(spark):
    schema = (
        "id string, seq long, country string, state string, name string, lat double, lon double, source string, url string, "
        "official_code string, osm_id string, needs_review boolean, osm_confidence string"
    )
    data = [
        ("a", 1, "US", "TX", "Blue State Park", 30.0, -100.0, "osm", "", "", "node/1", True, ""),
        ("b", 2, "US", "TX", "Blue", 30.004, -100.0, "official", "u", "", "way/2", False, "name"),
        ("c", 3, "US", "TX", "Blue State Park", 30.008, -100.0, "osm", "", "c9", "node/3", True, ""),
        ("d", 4, "US", "TX", "Blue", 31.0, -100.0, "osm", "", "", "node/4", True, ""),
    ]
    merged, conflicts = parkmerge.merge_parks(spark.createDataFrame(data, schema))
    got = {r.id: (r.official_code, r.url, r.alt_osm_ids) for r in merged.collect()}
    assert got == {"b": ("c9", "u", "node/1,node/3"), "d": ("", "", "")}
    assert [(r.a_id, r.b_id) for r in conflicts.collect()] == [("b", "d")]


def test_sections_never_merge_clusters(spark):
    km = 1 / 111.2
    data = [("p", 0, 0.0, 0.0, 9.0), ("p", 1, 4 * km, 0.0, 8.0), ("p", 2, 2 * km, 0.0, 7.0)]
    df = spark.createDataFrame(data, "park_code string, section int, lat double, lon double, area double")
    got = {r.section: r.cluster for r in clusters.section_clusters(df).collect()}
    assert got == {0: 0, 1: 1, 2: 0}


def test_section_clusters_equal_the_ordered_walk(spark, monkeypatch):
    from waymark.functions import geo

    def km(a, b):
        h = math.sin(math.radians(b[0] - a[0]) / 2) ** 2
        h += math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
        return 2 * geo.EARTH_RADIUS_KM * math.asin(math.sqrt(min(1.0, h)))

    # chunks of a few rows: cells span several of them
    monkeypatch.setattr(clusters, "ORDER_CHUNK", 7)
    rng = random.Random(5)
    data = [("p", i, 50 + rng.uniform(0, 0.35), 10 + rng.uniform(0, 0.5), float(rng.randrange(40))) for i in range(260)]
    # over the date line, near the pole, on one spot, without coordinates or area, and without a park
    data += [("d", i, -17 + rng.uniform(0, 0.05), (179.95 + rng.uniform(0, 0.1) + 180) % 360 - 180, rng.random()) for i in range(30)]
    data += [("n", i, 89.9 + rng.uniform(0, 0.1), rng.uniform(-180, 180), rng.random()) for i in range(30)]
    data += [("s", i, 1.0, 2.0, 1.0) for i in range(20)]
    data += [("s", 20, None, 2.0, 5.0), ("s", 21, 1.0, None, 0.5), ("s", 22, 1.0, 2.0, None), (None, 0, 1.0, 2.0, 1.0), (None, 1, 1.0, 2.001, 2.0)]
    df = spark.createDataFrame(data, "park_code string, section int, lat double, lon double, area double")
    want, members = {}, {}
    for park, section, lat, lon, _ in sorted(data, key=lambda r: (str(r[0]), -r[4] if r[4] is not None else math.inf, r[1])):
        seen = members.setdefault(park, [])
        located = lat is not None and lon is not None
        hits = [c for c, spot in seen if located and spot and km((lat, lon), spot) < 3]
        cluster = min(hits) if hits else max((c for c, _ in seen), default=-1) + 1
        seen.append((cluster, (lat, lon) if located else None))
        want[park, section] = cluster
    got = {(r.park_code, r.section): r.cluster for r in clusters.section_clusters(df).collect()}
    assert got == want
    assert clusters.section_clusters(df.limit(0)).collect() == []


def test_section_links_do_not_grow_with_a_crowd(spark):
    """Two crowds in reach of each other: a link per row and cell, not per pair."""
    rng = random.Random(9)
    for n in (100, 400):
        data = [("p", i, 40 + rng.uniform(0, 0.03), rng.uniform(0, 0.03), float(i)) for i in range(n)]
        df = spark.createDataFrame(data, "_park string, _at long, lat double, lon double, area double").drop("area")
        placed = clusters.clique_cells(df, 3.0, "km")
        assert clusters._earlier_links(placed, 3.0).count() <= 9 * n


def test_gaps_follow_the_numbers_in_use(spark, monkeypatch):
    def ranges(*numbers):
        df = spark.createDataFrame([(n,) for n in numbers], "n long")
        return sorted(tuple(r) for r in rollup.number_gap_ranges(df, "n").collect())

    assert ranges(3, 4, 4, 9, 10**12, None, 0, -5) == [(1, 2), (5, 8), (10, 10**12 - 1)]
    assert ranges() == ranges(1, 2) == ranges(None, -1) == []
    monkeypatch.setattr(rollup, "RANGE_STEP", 3)
    used = random.Random(2).sample(range(1, 400), 60)
    got = sorted(r.number for r in rollup.number_gaps(spark.createDataFrame([(n,) for n in used], "n long"), "n").collect())
    assert got == [n for n in range(1, max(used)) if n not in used]


def test_expectations_measure_every_table_once(spark):
    rows = spark.createDataFrame([("a", 1), ("", 2), (None, 3), ("b", 4)], "name string, n int")
    none = rows.limit(0)
    got = qa.expectations(
        {
            "rows": (rows, {"total": F.count(F.lit(1)), "unnamed": qa.rows_without("name"), "big": qa.share_where(F.col("n") > 1)}),
            "none": (none, {"other": F.count(F.lit(1)), "of_none": qa.share_where(F.col("n") > 1)}),
        },
        [
            qa.Rule("unnamed", "unnamed", most=0), qa.Rule("big", "big", 0.75, 0.75, "warn"), qa.Rule("same", "other - total", 0, 0),
            qa.Rule("of none", "of_none", least=0), qa.Rule("total", "total", least=4),
        ],
    )
    assert {(r.check, r.actual, r.level, r.passed) for r in got.collect()} == {
        ("unnamed", 2.0, "fail", False), ("big", 0.75, "warn", True), ("same", -4.0, "fail", False), ("of none", None, "fail", False),
        ("total", 4.0, "fail", True),
    }


def test_shared_words_make_no_candidates(spark):
    names = [f"{a}{b}{c}" for a in "bcdf" for b in "aeiou" for c in "lmnrst"]
    left = spark.createDataFrame([(f"national forest of {n}{n}",) for n in names], "needle string")
    right = spark.createDataFrame([(f"the national forest of {n}{n} and national park",) for n in names[::2]], "body string")
    met = textjoin.contain_candidates(left, right).count()
    assert len(names) / 2 <= met <= 3 * len(names)
    assert textjoin.contains_join(left, right).count() == len(names) / 2


def test_contains_join_equals_brute_force(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choices("ab é🏕", k=rng.randrange(0, 14))) for _ in range(150)] + [None, "", "a", "ab"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = sorted(tuple(r) for r in textjoin.contains_join(df, df, "t", "t").collect())
    known = {t for t in texts if t}
    assert got == sorted((a, b) for a in known for b in known if a in b)


def _line_rows(n, seed=4):
    """Rows on both sides of the date line."""
    rng = random.Random(seed)
    return [
        (f"r{i:03d}", i, -17.0 + rng.uniform(0, 0.03), (179.985 + rng.uniform(0, 0.03) + 180) % 360 - 180, "ab"[i % 2], "")
        for i in range(n)
    ]


def test_components_link_over_the_date_line(spark):
    data = _line_rows(250)
    got = {r.id: r.component for r in components.proximity_components(spark.createDataFrame(data, SCHEMA), 150, "m").collect()}
    parent = {r[0]: r[0] for r in data}
    for i, a in enumerate(data):
        for b in data[:i]:
            if haversine(a, b, 6371000) <= 150:
                x, y = find(parent, a[0]), find(parent, b[0])
                if x != y:
                    parent[max(x, y)] = min(x, y)
    assert got == {x: find(parent, x) for x in parent}
    sides = {x: {r[3] > 0 for r in data if find(parent, r[0]) == x} for x in set(got.values())}
    assert any(len(v) == 2 for v in sides.values())


def test_dedupe_over_the_date_line(spark):
    data = _line_rows(200, 7)
    kept, lost = dedupe.ordered_dedupe(spark.createDataFrame(data, SCHEMA), 0.2, "mi", on=["brand_id"])
    want = ordered(data, lambda r, e: r[4] == e[4] and haversine(r, e) <= 0.2)
    assert sorted(r.id for r in kept.collect()) == want[0]
    assert sorted((r.kept, r.dropped) for r in lost.collect()) == want[1]


def test_merged_campgrounds_lie_between_their_rows(spark):
    data = [("a", 1, "x", 10.0, 179.999, 1), ("b", 2, "x", 10.0, -179.998, 2), ("c", 3, "x", 10.0, 0.5, 4)]
    df = spark.createDataFrame(data, "id string, seq long, name string, lat double, lon double, pitch_count long")
    got = {r.id: (round(r.lon, 6), r.merged_rows) for r in clusters.merge_campgrounds(df, 1.0, ["name"], F.col("name")).collect()}
    assert got == {"a": (-179.9995, 2), "c": (0.5, 1)}


@pytest.mark.parametrize("local_plane", [True, False])
@pytest.mark.parametrize("place", ["line", "pole", "diagonal"])
def test_nearest_segment_equals_brute_force(spark, place, local_plane):
    rng = random.Random(3)
    lat, lon, size = {"line": ((-17, -16.9), (179.9, 180.1), 0.03), "pole": ((85, 90), (-180, 180), 0.4), "diagonal": ((40, 41), (9, 10), 1.0)}[place]

    def wrap(x):
        return (x + 180) % 360 - 180

    segments = []
    for _ in range(60):
        a, b = rng.uniform(*lat), rng.uniform(*lon)
        c = min(90.0, a + rng.uniform(-size, size))
        segments.append((a, wrap(b), c, wrap(b + rng.uniform(-size, size))))
    segments += [segments[0], (segments[1][0], segments[1][1], segments[1][0], segments[1][1])]
    points = [(i, rng.uniform(*lat), wrap(rng.uniform(*lon))) for i in range(60)] + [(900, float(lat[1]), 180.0), (901, float(lat[1]), -180.0), (902, None, 1.0)]
    max_m = {"line": 3000.0, "pole": 40000.0, "diagonal": 20000.0}[place]

    def distance(lat0, lon0, s):
        best = math.inf
        turns = [(s[1], s[3])]
        if abs(s[1] - s[3]) > 180:
            turns = [(s[1] % 360, s[3] % 360)]
        for west, east in turns:
            # the turn of the globe on which point and segment are closest
            for x0 in [min((lon0 - 360, lon0, lon0 + 360), key=lambda x: abs(x - (west + east) / 2))]:
                kx = math.cos(math.radians(lat0)) if local_plane else 1.0
                dx, dy = (east - west) * kx, s[2] - s[0]
                norm = dx * dx + dy * dy
                t = max(0.0, min(1.0, (((x0 - west) * kx) * dx + (lat0 - s[0]) * dy) / norm)) if norm else 0.0
                y, x = s[0] + t * (s[2] - s[0]), west + t * (east - west)
                h = math.sin(math.radians(y - lat0) / 2) ** 2
                h += math.cos(math.radians(y)) * math.cos(math.radians(lat0)) * math.sin(math.radians(x - x0) / 2) ** 2
                best = min(best, 2 * 6371000 * math.asin(math.sqrt(min(1.0, h))))
        return best

    got = spatial.nearest_segment(
        spark.createDataFrame(points, "id long, lat double, lon double"),
        spark.createDataFrame(segments, "lat1 double, lon1 double, lat2 double, lon2 double"), 0.02 if place != "pole" else 0.2, None, max_m,
        local_plane=local_plane,
    )
    near = 0
    for r in got.collect():
        want = min(distance(r.lat, r.lon, s) for s in segments) if r.lat is not None else math.inf
        if want <= max_m:
            near += 1
            assert r.distance_m == pytest.approx(want, rel=1e-6, abs=1e-3)
        else:
            assert r.distance_m is None or r.distance_m > max_m
    assert near > 10


def test_first_free_match_takes_each_row_once(spark):
    left = spark.createDataFrame([("s", "k", 1, "l1"), ("s", "k", 2, "l2"), ("s", "m", 3, "l3")], "a string, key string, seq int, lid string")
    right = spark.createDataFrame([("s", "k", 1, "r1"), ("s", "z", 2, "r2")], "a string, key string, seq int, rid string")
    pairs = spark.createDataFrame([("s", "k", "k"), ("s", "k", "z"), ("s", "m", "z")], "a string, l_key string, r_key string")
    got = sorted(tuple(r) for r in matching.first_free_match(left, right, pairs, "lid", "rid", ["a"]).collect())
    assert got == [("l1", "r1"), ("l2", "r2")]


@pytest.mark.parametrize("needle", ["a", "lake", "blue lake", "great blue lake park"])
def test_contains_join(spark, needle):
    bodies = ["the great blue lake park in may", "lake", "xyz"]
    got = textjoin.contains_join(
        spark.createDataFrame([(needle,)], "needle string"), spark.createDataFrame([(b,) for b in bodies], "body string")
    )
    assert sorted(r.body for r in got.collect()) == sorted(b for b in bodies if needle in b)


def test_layered_rows_of_one_source_stay(spark):
    data = [("a", 1, 40.0, -100.0, "s1", "x"), ("b", 2, 40.0, -100.0, "s1", "x"), ("c", 3, 40.0, -100.0, "s2", "x")]
    df = spark.createDataFrame(data, "id string, seq long, lat double, lon double, source string, name string")
    kept, lost = dedupe.layered_dedupe(df, 0.12, "mi", ["s1", "s2"], lambda l, r, d: l("name") == r("name"), ["name"])
    assert sorted(r.id for r in kept.collect()) == ["a", "b"]
    assert [(r.kept, r.dropped) for r in lost.collect()] == [("a", "c")]


def test_plans_have_no_cross_join(spark):
    df = spark.createDataFrame(rows(60), SCHEMA)
    hit = spatial.nearest_within(df, df, 0.3, "mi")
    plan = hit._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_crowded_searches_give_the_same_answer(spark, monkeypatch):
    data = rows(240, seed=9)
    left, right = data[:120], data[120:]
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    segments = b.selectExpr("lat as lat1", "lon as lon1", "lat + 0.0001 as lat2", "lon as lon2")

    def run():
        near = sorted((r.id, r.near.id if r.near else None) for r in spatial.nearest_within(a, b, 0.3, "mi").collect())
        seg = sorted(
            (r.id, None if r.distance_m is None else round(r.distance_m, 6))
            for r in spatial.nearest_segment(a, segments, 0.0015, max_m=250.0).collect()
        )
        return near, [s for s in seg if s[1] is None or s[1] <= 250]

    plain = run()
    monkeypatch.setattr(spatial, "CROWD", 3)
    monkeypatch.setattr(nearest, "LEAF", 1)
    assert run() == plain
    bands = matching._bands(a, b, 0.5, "mi", [], 3)
    assert len(bands) > 1
    wide = matching.greedy_match(a, b, 0.5, "mi", bands=(1.0,)).collect()
    narrow = matching.greedy_match(a, b, 0.5, "mi", bands=bands).collect()
    assert sorted((r.left_key, r.right_key) for r in wide) == sorted((r.left_key, r.right_key) for r in narrow)


def test_map_pins_labels(spark):
    far = 0.5
    sections = spark.createDataFrame(
        [("p", 0, 40.0, -100.0, 9.0), ("p", 1, 40.0 + far, -100.0, 8.0), ("p", 2, 40.0 - far, -100.0, 7.0), ("q", 0, 30.0, -90.0, 1.0)],
        "park_code string, section int, lat double, lon double, area double",
    )
    centers = spark.createDataFrame(
        [("p", 1, "South Unit Visitor Center", 40.01, -100.0), ("p", 2, "South Unit", 40.4, -100.0), ("p", 3, "Island Center", 40.0, -100.0)],
        "park_code string, seq long, name string, lat double, lon double",
    )
    overrides = spark.createDataFrame([("p", 1, "Upper")], "park_code string, cluster int, label string")
    extra = spark.createDataFrame([("q", "q-extra", "", 31.0, -91.0)], "park_code string, pin_id string, label string, lat double, lon double")
    pins = {(r.park_code, r.label, r.role) for r in clusters.map_pins(sections, centers, overrides, extra).collect()}
    assert pins == {
        ("p", "South Unit", "primary"), ("p", "Upper", "secondary"), ("p", "Island", "secondary"), ("q", "", "primary"),
        ("q", "Additional unit", "secondary"),
    }


def test_fold_streams_many_keys_and_keeps_idle_states(spark):
    from pyspark.sql import types as T

    state = T.StructType([T.StructField("total", T.LongType())])
    output = T.StructType([T.StructField("v", T.LongType()), T.StructField("running", T.LongType())])

    def step(rows, held):
        total = held[0]["total"]
        outs = []
        for _, v in rows:
            total += v
            outs.append({"v": v, "running": total})
        return outs, [{"total": total}]

    df = spark.range(0, 9000).selectExpr("id % 3000 as k", "-id as at", "id as v")
    initial = spark.range(0, 3001).selectExpr("id as k", "id * 10 as total")
    out, states = folding.ordered_fold(df, "k", ["at"], step, output, state, initial=initial, frames=False)
    running = {(r.k, r.v): r.running for r in out.collect()}
    want = {}
    for k in range(3000):
        total = k * 10
        for v in (k + 6000, k + 3000, k):
            total += v
            want[k, v] = total
    assert running == want
    assert {r.k: r.total for r in states.collect()} == {**{k: want[k, k] for k in range(3000)}, 3000: 30000}


def test_labels_take_the_centres_once(spark):
    met = spark.sparkContext.accumulator(0)
    centres = spark.createDataFrame(
        [("p", i, 40.0 + i / 10, -100.0, 1, 1.0) for i in range(6)],
        "park_code string, cluster int, lat double, lon double, section_count long, area double",
    )

    def counted(batches):
        for batch in batches:
            met.add(batch.num_rows)
            yield batch

    centers = spark.createDataFrame(
        [("p", 1, "Island Center", 40.31, -100.0), ("p", 2, "Island Center", 40.1, -100.0), ("q", 1, "Other", 40.0, -100.0)],
        "park_code string, seq long, name string, lat double, lon double",
    )
    overrides = spark.createDataFrame([("p", 0, "Upper")], "park_code string, cluster int, label string")
    pins = clusters.label_clusters(centres.mapInArrow(counted, centres.schema), centers, overrides)
    got = [r.label for r in pins.orderBy("cluster").collect()]
    assert got == ["Upper", "Area 4", "Area 3", "Island", "Area 2", "Area 1"]
    assert met.value == 6
