"""No silent cuts: matches are complete or fail, long keys count, wide searches equal brute force, plans stay small."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lodeframe.functions import scalars as S
from lodeframe.functions import stats
from lodeframe.operators import accuracy, clusters, matching, spatial
from lodeframe.sources import sinks


def metres(a, b):
    y1, x1, y2, x2 = map(math.radians, (*a, *b))
    h = math.sin((y2 - y1) / 2) ** 2 + math.cos(y1) * math.cos(y2) * math.sin((x2 - x1) / 2) ** 2
    return 2 * 6371000.0 * math.asin(math.sqrt(min(1.0, h)))


def test_greedy_match_is_complete_or_fails(spark):
    # a chain in which every pair waits for the one before it
    chain = spark.createDataFrame([(i, i + d, 2.0 * i + d) for i in range(12) for d in (0, 1)], "left_id long, right_id long, distance_m double")
    got = sorted((r["left_id"], r["right_id"]) for r in matching.greedy_match(chain).collect())
    assert got == [(i, i) for i in range(12)]
    falling = spark.createDataFrame([(i, i + d, 100.0 - 2 * i - d) for i in range(12) for d in (0, 1)], "left_id long, right_id long, distance_m double")
    assert matching.greedy_match(falling).count() == 12
    with pytest.raises(RuntimeError):
        matching.greedy_match(falling, max_rounds=3).count()
    assert matching.greedy_match(chain.limit(0)).count() == 0


def test_keys_of_any_length_are_looked_up(spark):
    long = "k" * 300
    keys = spark.createDataFrame([(long,), ("ab",), ("Zz",), ("none",), (None,), ("",)], "k string")
    names = spark.createDataFrame([(long + "x", 1), ("ABC", 2), ("abd", 3), ("zz", 4)], "nm string, v long")
    got = {r["k"]: (r["v"], r["stage"]) for r in matching.staged_look_up(keys, names, "k", "nm", "v").collect()}
    assert got == {long: (1, "prefix"), "ab": (2, "prefix"), "Zz": (4, "folded"), "none": (None, None), None: (None, None), "": (2, "prefix")}


def test_name_similarity_has_a_small_plan(spark):
    df = spark.createDataFrame([("AWS - Bar", "microsoft - google - bar"), ("Google - AWS - x", "aws - x")], "a string, b string").select(S.name_similarity("a", "b").alias("s"))
    assert len(df._jdf.queryExecution().analyzed().toString()) < 200_000
    assert [r["s"] for r in df.collect()] == [1.0, 1.0]


def test_priority_sites_against_brute_force(spark):
    r = random.Random(1)
    names = ["alpha north", "beta", "beta two", "gamma site", "north", "xy", "x", "", None]
    words = ["north", "site", "beta", "two", "", None]
    campuses = [(i, f"{r.choice(['s', 'n'])}{i}-{r.choice(['beta', 'north'])}", r.choice(names), r.choice(["A", "b", None])) for i in range(40)]
    sites = [(f"p{i}", [f"{r.choice(['s', 'n'])}{r.randrange(60)}-beta"], r.choice(names), r.choice(["a", "B", None]), r.choice(words)) for i in range(30)]
    want = {}
    for sid, ids, own, company, word in sites:
        best = None
        for cid, source, name, co in campuses:
            own_, word_, name_ = (own or "").lower(), (word or "").lower(), name
            tests = [
                source in ids, bool(own_) and name_ is not None and name_ == own_, bool(own_) and bool(name_) and (own_ in name_ or name_ in own_), len(word_) > 3 and name_ is not None and word_ in name_,
                len(word_) > 3 and company is not None and co is not None and company.lower() == co.lower() and word_ in source.lower(),
            ]
            rank = next((k + 1 for k, t in enumerate(tests) if t), None)
            if rank and (best is None or (rank, cid) < best):
                best = (rank, cid)
        if best:
            want[sid] = best
    a = spark.createDataFrame(sites, "id string, candidate_ids array<string>, cluster string, company string, keyword string")
    b = spark.createDataFrame(campuses, "id long, source_id string, campus_name string, company string")
    made = matching.priority_sites(a, b)
    assert {x["id"]: (x["rank"], x["match"]) for x in made.collect()} == want
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_rings_against_brute_force(spark):
    r = random.Random(2)
    place = lambda wide: (10 + r.uniform(-wide, wide), 20 + r.uniform(-wide, wide))
    left = [(i, *place(0.5 if i % 3 else 0.002), "ab"[i % 2]) for i in range(40)] + [(100, None, None, "a"), (101, -50.0, 100.0, "a")]
    right = [(i, *place(0.5 if i % 4 else 0.002), r.choice("pqr"), "ab"[i % 2]) for i in range(120)] + [(500, 10.0, 20.0, None, "a")]
    a, b = spark.createDataFrame(left, "id long, latitude double, longitude double, block string"), spark.createDataFrame(right, "id long, latitude double, longitude double, source string, block string")
    for far, block, per in ((50_000.0, [], ["right_source"]), (20_000.0, ["block"], []), (50.0, [], []), (3_000.0, ["block"], ["right_source"])):
        want = {}
        for i, y, x, g in left:
            for j, v, u, s, h in right:
                if y is not None and (not block or g == h) and (not per or s is not None) and (d := metres((y, x), (v, u))) <= far:
                    key = (i, s) if per else (i,)
                    want[key] = min(want.get(key, (1e18, 0)), (d, j))
        got = spatial.nearest(a, b, far, block, per).collect()
        assert {(x["left_id"], *(x[c] for c in per)): x["right_id"] for x in got} == {k: v[1] for k, v in want.items()}
        assert set(spatial.nearest(a, b, far, block, per).columns) == {*block, *(f"left_{c}" for c in a.columns if c not in block), *(f"right_{c}" for c in b.columns if c not in block), "distance_m", "rank"}


@pytest.mark.parametrize("lat, lon", [(0.0, 0.0), (51.0, -0.001), (-0.001, 179.9), (80.0, 10.0), (-89.95, 0.0)])
def test_rows_of_a_close_cell_are_within_the_radius(spark, lat, lon):
    r = random.Random(3)
    points = [(i, lat + r.uniform(-0.02, 0.02), lon + r.uniform(-0.05, 0.05)) for i in range(400)]
    cells = {}
    for x in spark.createDataFrame(points, "id long, latitude double, longitude double").withColumn("c", spatial.close_cell(1000.0)).collect():
        cells.setdefault((x["c"]["band"], x["c"]["column"]), []).append((x["latitude"], x["longitude"]))
    assert all(metres(p, q) <= 1000 for ps in cells.values() for p in ps for q in ps) and max(map(len, cells.values())) > 1


def test_dense_clusters_against_brute_force(spark):
    r = random.Random(4)
    rows = [(i, "AB"[i % 2], 40 + r.uniform(-0.01, 0.01), -70 + r.uniform(-0.01, 0.01)) for i in range(150)] + [(200 + i, "A", 40.0, -70.0) for i in range(50)] + [(300, None, 40.0, -70.0), (301, "A", 0.0, -70.0), (302, "A", None, None)]
    got = {x["id"]: x["cluster"] for x in clusters.proximity_clusters(spark.createDataFrame(rows, "id long, company_clean string, latitude double, longitude double")).collect()}
    usable = [x for x in rows if x[1] and x[2] and x[3]]
    parent = {x[0]: x[0] for x in usable}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for p in usable:
        for q in usable:
            if p[0] < q[0] and p[1] == q[1] and metres(p[2:], q[2:]) <= 250:
                a, b = find(p[0]), find(q[0])
                parent[max(a, b)] = min(a, b)
    assert got == {x[0]: find(x[0]) if x[0] in parent else None for x in rows}


def test_statistics_without_gathering(spark):
    r = random.Random(5)
    rows = [(g, r.choice([None, r.uniform(0, 10), 3.0])) for g in "abc" for _ in range(r.randrange(1, 30))] + [("d", 1.0), ("d", 2.0), ("d", 9.0)]
    got = {x["g"]: x for x in accuracy.descriptive(spark.createDataFrame(rows, "g string, v double"), "v", ["g"]).collect()}
    for g in "abcd":
        v = sorted(x for k, x in rows if k == g and x is not None)
        n = len(v)
        median = (v[(n - 1) // 2] + v[n // 2]) / 2
        assert (got[g]["n"], got[g]["q1"], got[g]["q3"]) == (n, v[n // 4] if n > 4 else v[0], v[3 * n // 4] if n > 4 else v[-1]) and got[g]["median"] == pytest.approx(median)


def test_correlation_of_what_does_not_vary(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (None, 5.0), (3.0, 5.0)], "a double, b double")
    x = df.agg(stats.correlation("a", "b").alias("flat"), stats.correlation("a", "a").alias("one"), stats.correlation(F.when(F.col("a") == 1, F.col("a")), "b").alias("none")).first()
    assert (x["flat"], round(x["one"], 9), x["none"]) == (0.0, 1.0, None)
    assert df.agg(stats.accuracy("a", "b", 1)["r"].alias("r")).first()["r"] is None


def test_documents_of_many_features_are_refused(spark, monkeypatch):
    df = spark.createDataFrame([(i, 1.0, 2.0) for i in range(5)], "id long, latitude double, longitude double")
    assert sinks.feature_collection(df, "n").count('"Feature"') == 5
    monkeypatch.setattr(sinks, "MOST_FEATURES", 4)
    with pytest.raises(ValueError):
        sinks.feature_collection(df, "n")
