"""Column functions on the edge rows."""

from pyspark.sql import functions as F

from waymark import fixed_values as fv
from waymark.functions import access, brands, camping, geo, parks, rules, tags, text
from waymark.operators.spatial import box_code, nearest_centre_code


def values(spark, data, schema, **columns):
    df = spark.createDataFrame(data, schema)
    return [tuple(r) for r in df.select(*[c.alias(n) for n, c in columns.items()]).collect()]


def test_negative_halves_round_up(spark):
    got = values(spark, [(-105.5,), (105.5,), (-2.5,)], "x double", y=geo.half_up("x", 1))
    assert got == [(-105.0,), (106.0,), (-2.0,)]


def test_coordinate_validity(spark):
    data = [(None, 1.0), (0.0, 0.0), (24.0, -65.0), (float("nan"), -100.0), (72.1, -100.0)]
    got = values(spark, data, "lat double, lon double", ok=geo.valid_coordinate("lat", "lon", fv.US_BOX))
    assert [g[0] for g in got] == [False, False, True, False, False]


def test_missing_coordinates_give_no_distance(spark):
    got = values(spark, [(None, 1.0)], "lat double, lon double", d=geo.haversine("lat", "lon", "lat", "lon"))
    assert got == [(None,)]


def test_overlapping_boxes(spark):
    data = [(45.0, -111.04), (45.0, -111.06), (47.0, -116.0), (10.0, 10.0)]
    got = values(spark, data, "lat double, lon double", st=box_code("lat", "lon", fv.STATE_BOXES, fv.STATE_OVERLAPS))
    assert [g[0] for g in got] == ["MT", "MT", "MT", None]


def test_nearest_centre(spark):
    got = values(spark, [(31.0, -99.0), (64.0, -150.0)], "lat double, lon double", st=nearest_centre_code("lat", "lon", fv.STATE_CENTRES))
    assert got == [("TX",), ("AK",)]


def test_slug_trims_before_the_cut(spark):
    got = values(spark, [("--a b--",), ("",), (None,), ("abc def",)], "s string", x=text.slugify("s", 4))
    assert got == [("a-b",), ("unkn",), ("unkn",), ("abc-",)]


def test_name_quality(spark):
    data = [("Site 12",), ("#7",), ("OSM node 5",), ("unnamed",), ("Elk Camp",), ("Oak",), ("Bear #3",)]
    got = values(
        spark, data, "n string", g=camping.generic_name("n"), num=camping.numeric_name("n"), s=camping.site_label("n"), ok=camping.human_name("n")
    )
    assert got == [
        (False, False, True, True), (False, True, False, False), (True, False, False, False), (True, False, False, False),
        (False, False, False, True), (False, False, False, False), (False, False, True, True),
    ]


def test_scenic_access_vectors(spark):
    data = [
        (None, None, None), (135.0, None, None), (135.1, None, None), (130.0, 0.0, 100.0), (40.0, 0.0, None), (60.0, 45.0, None),
        (60.0, 46.0, None), (50.0, 10.0, None),
    ]
    got = values(spark, data, "d_lean double, d_path double, d_parking double", x=access.scenic_include())
    assert [g[0] for g in got] == [False, True, False, True, False, False, True, True]


def test_path_ratio_with_zero_road_distance(spark):
    rule = access.scenic_strategies()["J-path-ratio-0.7"]
    got = values(spark, [(0.0, 0.0, 0.0, 0.0), (0.0, 0.0, 5.0, 0.0)], "d_lean double, d_wide double, d_path double, d_parking double", x=rule)
    assert [g[0] for g in got] == [False, True]


def test_access_tie_band(spark):
    data = [("campground", "developed", 100.0, 120.0), ("campground", "developed", 10.0, 100.0), ("campground", "primitive", 500.0, 500.0), ("restroom", None, 1.0, 1.0)]
    got = values(spark, data, "kind string, camp_tier string, road_distance_m double, trail_distance_m double", x=access.access_mode())
    assert [tuple(g[0]) for g in got] == [("road", "medium"), ("road", "high"), ("unknown", "measured_far"), ("unknown", "unknown")]


CATALOGUE = [
    {"id": "qt", "display_name": "QuikTrip", "type": "convenience_fuel", "brand": ["QuikTrip", "QT"], "operator": ["QT"], "name_contains": ["quiktrip"]},
    {"id": "flyingj", "display_name": "Flying J", "brand": ["Flying J"], "name_contains": []},
    {"id": "pilot", "display_name": "Pilot", "brand": ["Pilot"], "name_contains": ["pilot travel"]},
]


def test_brand_rules(spark):
    data = [
        ("Shell", "", "Pilot"), ("", "", "Pilot"), ("", "Pilot Flying J", "x"), ("QT", "", ""), ("", "", "QuikTrip"), ("", "", "My QT"), ("Flying J Travel", "", ""),
    ]
    got = values(spark, data, "b string, o string, n string", x=brands.brand_id_us("b", "o", "n", CATALOGUE))
    assert [g[0] for g in got] == [None, "pilot", "pilot", "qt", "qt", None, "flyingj"]


def test_missing_fuel_tag_means_gasoline(spark):
    df = spark.createDataFrame([({"diesel": "yes"},), ({"fuel:gasoline": "no"},)], "tags map<string,string>")
    got = [tuple(r[0]) for r in df.select(tags.fuels()).collect()]
    assert got == [(True, True), (False, False)]


def test_drivable_track_and_access(spark):
    data = [({"highway": "track"},), ({"highway": "track", "motor_vehicle": "yes"},), ({"highway": "primary", "access": "no"},), ({"highway": "service"},)]
    df = spark.createDataFrame(data, "tags map<string,string>")
    got = [tuple(r) for r in df.select(tags.drivable(lean=True), tags.drivable(lean=False)).collect()]
    assert got == [(False, False), (True, True), (False, False), (False, True)]


def test_listing_titles(spark):
    data = [("Blue State Park &amp; Historic Site",), ("Ash Visitor Center",), ("Elm",)]
    got = values(spark, data, "t string", x=parks.listing_class("t")["listing_kind"])
    assert [g[0] for g in got] == ["park_and_historic", "visitor_center", "park"]


def test_pin_labels(spark):
    data = [("North Unit Visitor Center",), ("elkhorn ranch",), ("Headquarters",)]
    got = values(spark, data, "n string", x=parks.pin_label("n"))
    assert [g[0] for g in got] == ["North Unit", "Elkhorn Ranch", ""]


def test_review_needs_more_than_information(spark):
    data = [(["SUPPLEMENT"], []), (["NO_STATE"], []), ([], ["x"]), ([], [])]
    df = spark.createDataFrame(data, "f array<string>, r array<string>")
    got = [r[0] for r in df.select(brands.needs_review(F.col("f"), F.col("r"))).collect()]
    assert got == [False, True, True, False]


def test_decision_tables_take_the_first_rule_that_holds(spark):
    table = [
        ("both", [[("a", "has", ["x", "y"]), ("b", "is", ["1"])]]),
        ("either", [[("a", "like", ["^Z"])], [("b", "is", ["2"]), ("a", "lacks", ["q"])]]),
        ("rest", [[("b", "unlike", ["none"])]]),
    ]
    rows = [("xa", "1"), ("ya", "2"), ("zq", "3"), ("q", "2"), ("q", "None"), ("", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select("a", "b", rules.decided(table, {"a": F.col("a"), "b": F.col("b")}).alias("o")).collect()
    assert {(r.a, r.b): r.o for r in got} == {
        ("xa", "1"): "both", ("ya", "2"): "either", ("zq", "3"): "either", ("q", "2"): "rest", ("q", "None"): None, ("", ""): "rest"
    }
