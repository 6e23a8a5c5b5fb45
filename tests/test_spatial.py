import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from lodeframe.operators import clusters, matching, spatial
from lodeframe.operators.components import connected_components
from tests.test_scalars import haversine

PLACES = "id long, latitude double, longitude double, company_clean string"


def frame(spark, rows):
    return spark.createDataFrame(rows, PLACES)


def scattered(n, lat, lon, spread, seed):
    r = random.Random(seed)
    return [(i, max(-90.0, min(90.0, lat + r.uniform(-spread, spread))), (lon + r.uniform(-spread, spread) / max(0.02, math.cos(math.radians(lat))) + 180) % 360 - 180, r.choice("ab")) for i in range(n)]


@pytest.mark.parametrize("lat, lon", [(0, 0), (45, 10), (70, 179.999), (-89.95, 0), (89.99, 100), (33, -180)])
def test_band_join_equals_brute_force(spark, lat, lon):
    a, b = scattered(60, lat, lon, 0.02, 1), scattered(60, lat, lon, 0.02, 2)
    for metres in (250.0, 2000.0):
        got = {(r["left_id"], r["right_id"]) for r in spatial.band_join(frame(spark, a), frame(spark, b), metres).collect()}
        assert got == {(x[0], y[0]) for x, y in itertools.product(a, b) if haversine(x[1], x[2], y[1], y[2]) <= metres}


def test_band_join_by_block_and_without_coordinates(spark):
    a = frame(spark, [(1, 1.0, 1.0, "a"), (2, None, 1.0, "a"), (3, 1.0, 1.0, "b")])
    got = sorted((r["left_id"], r["right_id"]) for r in spatial.band_join(a, a, 10.0, ["company_clean"]).collect())
    assert got == [(1, 1), (3, 3)]
    assert spatial.band_join(a.limit(0), a, 10.0).count() == 0


def test_nearest_takes_the_smaller_id_of_equals(spark):
    got = spatial.nearest(frame(spark, [(1, 0.0, 10.0, "a")]), frame(spark, [(7, 0.001, 10.0, "a"), (5, -0.001, 10.0, "a")]), 500.0).collect()
    assert [(r["left_id"], r["right_id"]) for r in got] == [(1, 5)]


def test_point_in_polygon_with_hole(spark):
    wkt = "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))"
    polygons = spatial.with_rings(spark.createDataFrame([(1, wkt), (2, "POLYGON EMPTY"), (3, None)], "polygon_id long, geometry_wkt string"))
    points = frame(spark, [(1, 5.0, 5.0, "a"), (2, 1.0, 1.0, "a"), (3, 11.0, 5.0, "a"), (4, None, None, "a")])
    assert [r["id"] for r in spatial.point_in_polygon(points, polygons, 1.0).collect()] == [2]


def test_parcel_of_another_company_blocks_the_centroid(spark):
    square = lambda x, y: f"POLYGON (({x} {y}, {x + 0.01} {y}, {x + 0.01} {y + 0.01}, {x} {y + 0.01}, {x} {y}))"
    polygons = spatial.with_rings(spark.createDataFrame([(1, "b", square(0, 0)), (2, "a", square(0.011, 0))], "polygon_id long, company string, geometry_wkt string"))
    sites = spark.createDataFrame([(1, 0.005, 0.009, "a"), (2, 0.005, 0.0215, "a")], "id long, latitude double, longitude double, company string")
    got = {r["id"]: (r["polygon_id"], r["method"]) for r in spatial.parcel_match(sites, polygons, 2000.0).collect()}
    assert got == {1: (1, "polygon"), 2: (2, "centroid")}


def test_components_against_union_find(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(160)] + [(1000 + i, 1001 + i) for i in range(64)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    want = {x: find(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}
    for few in (0, 10, 1000):  # by steps, too many for one task, in one task
        got = {x["node"]: x["component"] for x in connected_components(spark.createDataFrame(edges, "src long, dst long"), few=few).collect()}
        assert got == want
        assert connected_components(spark.createDataFrame([(1, 1), (None, 2)], "src long, dst long"), few=few).count() == 0


def test_greedy_against_the_ordered_pass(spark):
    r = random.Random(4)
    pairs = [(a, b, float(r.randrange(8))) for a in range(25) for b in range(25) if r.random() < 0.3]
    left, right, want = set(), set(), set()
    for d, a, b in sorted((d, a, b) for a, b, d in pairs):
        if a not in left and b not in right:
            left.add(a), right.add(b), want.add((a, b))
    got = matching.greedy_match(spark.createDataFrame(pairs, "left_id long, right_id long, distance_m double"))
    assert {(x["left_id"], x["right_id"]) for x in got.collect()} == want
    assert matching.greedy_match(spark.createDataFrame([], "left_id long, right_id long, distance_m double")).count() == 0


def campus(id, lat, lon, company="Acme", city="Foo", name="Acme - Bar"):
    return (id, lat, lon, company, city, name, "s", 1.0)


CAMPUS = "id long, latitude double, longitude double, company_clean string, city string, campus_name string, source string, commissioned_power_mw double"
STEP = 200 / 111194.9


def ids(spark, rows, **options):
    return {r["id"]: r["ucid"] for r in clusters.with_ucids(spark.createDataFrame(rows, CAMPUS), **options).collect()}


def test_cluster_chain_split_and_boundary(spark):
    rows = [(1, 0.1, 10.0, "a"), (2, 0.1 + STEP, 10.0, "a"), (3, 0.1 + 2 * STEP, 10.0, "a"), (4, 0.1, 10.0, "b"), (5, 5.0, 10.0, "a"), (6, 5.0 + 251 / 111194.9, 10.0, "a"), (7, 0.0, 10.0, "a"), (8, 0.1, 10.0, None)]
    got = {r["id"]: r["cluster"] for r in clusters.proximity_clusters(frame(spark, rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: None, 8: None}


def test_long_chain_is_one_cluster(spark):
    rows = [(i, 0.1 + i * STEP, 10.0, "a") for i in range(200)]
    assert {r["cluster"] for r in clusters.proximity_clusters(frame(spark, rows)).collect()} == {0}


def test_two_campuses_of_a_name(spark):
    assert ids(spark, [campus(1, 1.0, 1.0), campus(2, 1.0, 1.03)]) == {1: "ACME-FOO-WEST", 2: "ACME-FOO-EAST"}
    north_west = [campus(1, 1.03, 1.0), campus(2, 1.0, 1.001)]
    assert ids(spark, north_west) == {1: "ACME-FOO-NORTH", 2: "ACME-FOO-SOUTH"}
    assert ids(spark, north_west, corrected=False) == {1: "ACME-FOO-SOUTH", 2: "ACME-FOO-NORTH"}


def test_campus_names_without_city(spark):
    got = ids(spark, [campus(1, 1.0, 1.0, city=None), campus(2, 2.04, 1.0, city=None, name=None), campus(3, 3.0, 1.0), campus(4, 3.0, 1.03), campus(5, 3.0, 1.06)])
    assert got == {1: "ACME-BAR", 2: "ACME-LOC2010", 3: "ACME-FOO-1", 4: "ACME-FOO-2", 5: "ACME-FOO-3"}


def test_building_numbers(spark):
    rows = [campus(1, 1.0, 1.0), (2, 1.0, 1.0, "Acme", "Foo", "x", "s", 5.0), (3, 1.0, 1.0, "Acme", "Foo", "x", "a", None)]
    got = {r["id"]: r["building_ucid"] for r in clusters.with_ucids(spark.createDataFrame(rows, CAMPUS)).collect()}
    assert got == {2: "ACME-FOO-01", 1: "ACME-FOO-02", 3: "ACME-FOO-03"}


def test_intake_and_permits(spark):
    known = spark.createDataFrame([(1, "Foo One", "AWS", "Foo", 1.0, 1.0), (2, "Bar", "Meta", "Bar", 1.003, 1.0)], "id long, canonical_name string, company string, city string, latitude double, longitude double")
    asked = spark.createDataFrame([(1, "amazon", "foo", "foo one", 1.0, 1.0), (2, "Facebook", "bar", None, None, None), (3, "zzz", None, None, 1.0055, 1.0)], "id long, company string, city string, campus_name string, latitude double, longitude double")
    got = {r["left_id"]: (r["right_id"], r["match_type"], r["confidence"]) for r in matching.intake_match(asked, known).collect()}
    assert got[1] == (1, "SPATIAL", 1.0) and got[2] == (2, "NAME", 1.0) and got[3][0] == 2 and got[3][2] < 0.3
    sites = spark.createDataFrame([(1, "P1", "x", 1.0, 1.0, "VA", "C"), (2, None, "Acme Holdings LLC", 2.0, 1.0, "VA", "C"), (3, "", "q", 3.0, 1.0, "VA", "C"), (4, None, "q", 9.0, 1.0, "VA", "C")], "id long, permit_id string, developer string, latitude double, longitude double, state_abbr string, county string")
    permits = spark.createDataFrame([(1, "P1", "far", 50.0, 1.0, "TX", "Z"), (2, "P2", "acme", 2.001, 1.0, "TX", "Z"), (3, "P3", "other", 3.006, 1.0, "va", "c")], "id long, permit_id string, permit_holder string, latitude double, longitude double, state string, county string")
    assert {r["left_id"]: (r["right_id"], r["tier"]) for r in matching.permit_tiers(sites, permits).collect()} == {1: (1, 1), 2: (2, 2), 3: (3, 4)}


def test_snapshot_diff(spark):
    old = spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, "a"), (3, 3.0, "a"), (4, 4.0, "a")], "k long, mw double, st string")
    new = spark.createDataFrame([(2, 2.05, "a"), (3, 3.2, "b"), (4, 4.0, None), (5, 5.0, "a")], "k long, mw double, st string")
    got = {r["k"]: (r["change"], r["fields"]) for r in matching.snapshot_diff(old, new, "k", {"mw": 0.1}, ["st"]).collect()}
    assert got == {1: ("removed", []), 2: ("same", []), 3: ("changed", ["mw", "st"]), 4: ("changed", ["st"]), 5: ("added", [])}


def test_staged_look_up(spark):
    table = spark.createDataFrame([("Foo", 1), ("bar", 2), ("bazaar", 3), ("bazar", 4)], "nm string, v long")
    got = {r["k"]: (r["v"], r["stage"]) for r in matching.staged_look_up(spark.createDataFrame([("Foo",), ("BAR",), ("baz",), ("zz",)], "k string"), table, "k", "nm", "v").collect()}
    assert got == {"Foo": (1, "exact"), "BAR": (2, "folded"), "baz": (3, "prefix"), "zz": (None, None)}


def test_thresholds_and_flags(spark):
    a, b = frame(spark, [(1, 1.0, 1.0, "a"), (2, 1.0, 1.0, "a")]), frame(spark, [(9, 1.004, 1.0, "a")])
    got = {r["threshold_m"]: (r["pairs"], r["left_rows"], r["right_rows"]) for r in spatial.threshold_overlap(a, b).collect()}
    assert got == {500.0: (2, 2, 1), 1000.0: (2, 2, 1), 2000.0: (2, 2, 1)}
    assert {r["id"]: r["near_reference"] for r in spatial.flag_near(a, b, 100.0).collect()} == {1: "N", 2: "N"}
    assert a.agg(F.count("*")).first()[0] == 2
