from pyspark.sql import functions as F

from waymark.operators import spatial
from waymark.runtime import configure


def test_small_files_with_many_rows_are_not_broadcast_by_their_size(spark, tmp_path):
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
    configure(session)
    rows = session.range(200_000).select("id", (F.col("id") % 977 / 10).alias("lat"), F.hash("id").cast("double").alias("lon"))
    rows.selectExpr("id", "lat", "pmod(lon, 170) as lon").coalesce(1).write.parquet(str(tmp_path / "points"))
    points = session.read.parquet(str(tmp_path / "points"))
    plan = spatial.self_pairs(points, 0.25, "mi")._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    # what the session sets lower stays
    assert session.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "8m"
    before = dict(session.conf.getAll)
    assert dict(configure(session).conf.getAll) == before


def test_keys_with_the_same_partners_take_turns_in_few_rounds(spark, monkeypatch):
    from waymark.operators import matching

    labels = []
    real = matching.stage
    monkeypatch.setattr(matching, "stage", lambda df, label: labels.append(label) or real(df, label))
    left = spark.createDataFrame([("s", "kg"[i % 2], i, f"l{i:02d}") for i in range(40)], "a string, key string, seq int, lid string")
    right = spark.createDataFrame([("s", "xyz"[i % 3], i, f"r{i:02d}") for i in range(30)], "a string, key string, seq int, rid string")
    pairs = spark.createDataFrame([("s", l, r) for l in "kg" for r in "xyz"], "a string, l_key string, r_key string")
    got = sorted(tuple(r) for r in matching.first_free_match(left, right, pairs, "lid", "rid", ["a"]).collect())
    assert got == [(f"l{i:02d}", f"r{i:02d}") for i in range(30)]
    assert labels.count("heads") <= 3


def test_first_polygon_of_large_and_small_rings_lists_few_cells(spark):
    """Boxes of up to 100 degrees over cells of 0.001 degrees, many over each other; against brute force."""
    import random

    rng, rings, edges = random.Random(5), {}, []
    for p in range(60):
        lat, lon, size = rng.uniform(-40, 40), rng.uniform(-100, 100), 10 ** rng.uniform(-2, 1.7)
        rings[p] = [(lat + size * rng.uniform(-1, 1), lon + size * rng.uniform(-1, 1)) for _ in range(rng.choice([3, 4, 40]))]
        edges += [(p, 0, *a, *b) for a, b in zip(rings[p], rings[p][1:] + rings[p][:1])]
    points = [(i, *(rng.choice(rings[i % 60]) if i % 3 else (rng.uniform(-60, 60), rng.uniform(-120, 120)))) for i in range(300)]
    points = [(i, a + rng.uniform(-0.004, 0.004), b) for i, a, b in points] + [(300, None, 1.0)]

    def inside(p, lat, lon):
        odd = False
        for (a1, o1), (a2, o2) in zip(rings[p], rings[p][1:] + rings[p][:1]):
            odd ^= (a1 > lat) != (a2 > lat) and lon < (o2 - o1) * (lat - a1) / (a2 - a1) + o1
        return odd

    wanted = {i: min(((-p % 7, p) for p in rings if lat is not None and inside(p, lat, lon)), default=(0, None))[1] for i, lat, lon in points}
    got = spatial.first_polygon(
        spark.createDataFrame(points, "id int, lat double, lon double"),
        spark.createDataFrame(edges, "polygon_id int, ring int, lat1 double, lon1 double, lat2 double, lon2 double"),
        spark.createDataFrame([(p, -p % 7) for p in rings], "polygon_id int, priority int"),
        0.001,
    )
    assert {r.id: r.polygon_id for r in got.collect()} == wanted
    assert len(set(wanted.values())) > 15


def test_shuffles_have_enough_partitions_whatever_the_session_says(spark):
    session = spark.newSession()
    session.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    session.conf.set("spark.sql.shuffle.partitions", "3")
    session.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    configure(session)
    plan = session.range(100).groupBy((F.col("id") % 7).alias("k")).count()._jdf.queryExecution().executedPlan().toString()
    assert ", 200)" in plan
    assert session.conf.get("spark.sql.files.maxPartitionBytes") == f"{32 << 20}b"
    session.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "900")
    assert configure(session).conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "900"


def test_relation_centres_weigh_nodes_without_a_list_per_relation_and_node(spark):
    import re

    from waymark.operators import elements

    nodes = spark.createDataFrame([(i, float(i), -2.0 * i) for i in range(6)], "id long, lat double, lon double")
    ways = spark.createDataFrame([(1, [0, 1, 2, 0]), (2, [2, 3, 9]), (3, [4, 5])], "id long, refs array<long>")
    relations = spark.createDataFrame(
        [(1, [("way", 1, "outer"), ("way", 2, ""), ("way", 2, "outer"), ("way", 3, "inner")]), (2, [("way", 3, "inner"), ("node", 1, "outer")])],
        "id long, members array<struct<type: string, ref: long, role: string>>",
    )
    made = elements.relation_centres(relations, ways, nodes)
    got = {r.id: (round(r.lat, 9), round(r.lon, 9)) for r in made.collect()}
    mean = (0 + 1 + 2 + 0 + 2 * (2 + 3)) / 8
    assert got == {1: (round(mean, 9), round(-2 * mean, 9)), 2: (4.5, -9.0)}
    assert not re.search(r"Aggregate \[id#\d+L?, _ref#\d+L?\]", made._jdf.queryExecution().optimizedPlan().toString())


def test_amenity_rules_run_behind_the_deal_of_rows(spark, monkeypatch):
    from waymark.plans import amenities

    seen = []
    real = amenities.stage
    monkeypatch.setattr(amenities, "stage", lambda df, label: seen.append(df) or real(df, label))
    points = spark.createDataFrame(
        [("node", 1, 37.0, -120.0, {"amenity": "toilets"}), ("node", 2, 37.0, -120.0, {"amenity": "x"}), ("node", 3, 37.0, -120.0, {"tourism": "camp_site"})],
        "osm_type string, osm_id long, lat double, lon double, tags map<string, string>",
    )
    catalogue = spark.createDataFrame([("p", 1, "", "Park", "CA", 37.0, -120.0)], "park_id string, seq int, code string, name string, state string, lat double, lon double")
    rows, _ = amenities.park_map_records(points, catalogue)
    assert [(r.osm_key, r.kind, r.parent_id) for r in rows.collect()] == [("node:1", "restroom", "p")]
    above, deal, below = seen[0]._jdf.queryExecution().optimizedPlan().toString().partition("Repartition")
    assert deal and "Filter" in above and "Filter" not in below and "Generate" not in below
