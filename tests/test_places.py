"""Distances to the last bit, and joins that work by place instead of by pairs of rows."""

import math
import random

from pyspark.sql import functions as F

from lodeframe.functions import scalars as S
from lodeframe.operators import accuracy, matching, spatial


def sql_metres(y1, x1, y2, x2):
    """As the SQL twins write it, operation by operation."""
    s, t = math.sin(math.radians(y2 - y1) / 2), math.sin(math.radians(x2 - x1) / 2)
    return 2 * 6371000.0 * math.asin(math.sqrt(min(1.0, s * s + math.cos(math.radians(y1)) * math.cos(math.radians(y2)) * (t * t))))


def test_distances_have_the_last_bit_of_the_sql(spark):
    places = [(30 + i * 0.0011, -90 + j * 0.0013) for i in range(9) for j in range(9)]
    rows = [(*a, *b) for a in places for b in places]
    got = spark.createDataFrame(rows, "a double, b double, c double, d double").select(S.haversine("a", "b", "c", "d").alias("m"), "a", "b", "c", "d").collect()
    assert all(r["m"] == sql_metres(r["a"], r["b"], r["c"], r["d"]) for r in got)


def test_equal_distances_of_a_building_go_to_the_least_id(spark):
    rows = [(1, "D", "s", float(100 - i), 5.0, i) for i in range(50, 2, -1)]
    found = spark.createDataFrame(rows, "building_key long, dc_code string, source string, mw double, distance_m double, id long").repartition(7)
    load = spark.createDataFrame([(1, "D", 9.0)], "building_key long, dc_code string, it_load_total double")
    assert [(r["mw"], r["actual"]) for r in accuracy.capacity_match(found, load).collect()] == [(97.0, 9.0)]


def crowded(r, n, text=False):
    """Rows at few places, many at each, some without a company."""
    return [(f"k{i}" if text else i, 30 + r.randrange(5) * 0.0011, -90 + r.randrange(4) * 0.0013, r.choice(["Acme Inc", "acme", "Bolt", None])) for i in range(n)]


def sides(spark, n, text=False):
    r = random.Random(n)
    a, b = crowded(r, n, text), crowded(r, n + 9, text)
    kind = f"id {'string' if text else 'long'}, latitude double, longitude double, company string"
    return a, b, spark.createDataFrame(a, kind), spark.createDataFrame(b, kind)


def ordered_pass(a, b, metres, same=lambda x, y: True):
    pairs = sorted((sql_metres(*x[1:3], *y[1:3]), x[0], y[0]) for x in a for y in b if same(x[3], y[3]))
    left, right, out = set(), set(), []
    for d, i, j in pairs:
        if d <= metres and i not in left and j not in right:
            left.add(i)
            right.add(j)
            out.append((i, j, d))
    return sorted(out)


def test_crowded_places_are_matched_as_the_ordered_pass_does(spark, monkeypatch):
    alias = lambda c: c and c.lower().replace(" inc", "")
    same = lambda x, y: x is None or y is None or alias(x) == alias(y)
    monkeypatch.setattr(matching, "band_join", lambda *args: checked(*args))
    made = []

    def checked(left, right, metres, block=()):
        made.append(left.count() * right.count())
        return spatial.band_join(left, right, metres, block)

    for n, text in ((160, False), (90, True)):
        a, b, left, right = sides(spark, n, text)
        for metres in (100.0, 260.0):
            got = matching.spatial_match(left, right, metres)
            assert sorted((r["left_id"], r["right_id"], r["distance_m"]) for r in got.collect()) == ordered_pass(a, b, metres)
        got = matching.spatial_match(left, right, 260.0, "company")
        assert sorted((r["left_id"], r["right_id"], r["distance_m"]) for r in got.collect()) == ordered_pass(a, b, 260.0, same)
        assert got.columns == [f"{s}_{c}" for s in ("left", "right") for c in left.columns] + ["distance_m"]
        named = [[r for r in side if r[3]] for side in (a, b)]
        got = matching.spatial_match(left.filter("company IS NOT NULL"), right.filter("company IS NOT NULL"), 260.0, "company")
        assert sorted((r["left_id"], r["right_id"], r["distance_m"]) for r in got.collect()) == ordered_pass(*named, 260.0, same)
    assert max(made) <= 20 * 20  # distances are taken between places, not between rows
    # rows that share an id, and parts that are too large for one task, go by pairs of rows
    monkeypatch.setattr(matching, "PART_ROWS", 10)
    a, b, left, right = sides(spark, 60)
    assert sorted((r["left_id"], r["right_id"], r["distance_m"]) for r in matching.spatial_match(left, right, 130.0).collect()) == ordered_pass(a, b, 130.0)


def test_thresholds_count_pairs_of_crowded_places_without_making_them(spark, monkeypatch):
    made = []
    join = spatial.band_join

    def checked(left, right, metres, block=()):
        made.append(left.count() * right.count())
        return join(left, right, metres, block)

    monkeypatch.setattr(spatial, "band_join", checked)
    a, b, left, right = sides(spark, 150)
    again = left.limit(1).withColumn("latitude", F.lit(30.0))  # a row that shares an id counts once
    first = left.first()
    a.append((first["id"], 30.0, first["longitude"], None))
    got = {r["threshold_m"]: (r["pairs"], r["left_rows"], r["right_rows"]) for r in spatial.threshold_overlap(left.unionByName(again), right, (100, 130, 300)).collect()}
    for m in (100, 130, 300):
        near = [(x[0], y[0]) for x in a for y in b if sql_metres(*x[1:3], *y[1:3]) <= m]
        assert got[m] == (len(near), len({i for i, _ in near}), len({j for _, j in near}))
    assert made and max(made) <= 20 * 20


def sizes_of_joins(monkeypatch, module):
    made = []

    def checked(left, right, metres, block=()):
        made.append(left.count() * right.count())
        return spatial.band_join(left, right, metres, block)

    monkeypatch.setattr(module, "band_join", checked)
    return made


def test_permit_tiers_of_crowded_places_equal_a_look_at_all_pairs(spark, monkeypatch):
    r = random.Random(5)
    place = lambda: (30 + r.randrange(6) * 0.003, -90 + r.randrange(4) * 0.004)
    names, states = ["Acme", "Acme Data", "Bolt", None], ["x", "Y", None]
    rows = lambda n: [(i, r.choice(["a", "b", "", None]) if r.random() < 0.1 else f"p{r.randrange(900)}", r.choice(names), *place(), r.choice(states), r.choice(["c", None, "D"])) for i in range(n)]
    kind = "id long, permit_id string, {} string, latitude double, longitude double, {} string, county string"
    sites = spark.createDataFrame(rows(120), kind.format("developer", "state_abbr"))
    permits = spark.createDataFrame(rows(200), kind.format("permit_holder", "state"))
    made = sizes_of_joins(monkeypatch, matching)
    got = {(x["left_id"], x["right_id"], x["tier"], x["distance_m"], x["score"]) for x in matching.permit_tiers(sites, permits).collect()}
    near = spatial.band_join(sites, permits, 1000.0).withColumn("score", S.fuzzy_score("left_developer", "right_permit_holder")).collect()
    best = {}
    for x in near:
        area = None not in (x["left_state_abbr"], x["right_state"], x["left_county"], x["right_county"]) and x["left_state_abbr"].lower() == x["right_state"].lower() and x["left_county"].lower() == x["right_county"].lower()
        tier = 2 if x["distance_m"] <= 250 and x["score"] >= 95 else 3 if x["distance_m"] <= 500 and x["score"] >= 85 else 4 if area else None
        if tier:
            best.setdefault(x["left_id"], []).append((tier, -x["score"], x["distance_m"], x["right_id"]))
    ids = {}
    for p in permits.collect():
        ids.setdefault(p["permit_id"], []).append(p["id"])
    for s in sites.collect():
        if s["permit_id"] and s["permit_id"] in ids:
            best.setdefault(s["id"], []).append((1, -100.0, 0.0, min(ids[s["permit_id"]])))
    want = {(i, right, tier, d, -less) for i, found in best.items() for tier, less, d, right in [min(found)]}
    assert got == want and {t for _, _, t, _, _ in want} == {1, 2, 3, 4}
    assert max(made) <= 24 * 24


def intake_tables(spark):
    r = random.Random(8)
    names = ["Alpha North", "Alpha", "Beta One", "beta one", "North", "", "  ", None]
    place = lambda: (30 + r.randrange(7) * 0.0011, -90 + r.randrange(4) * 0.0013)
    text = lambda: (r.choice(names), r.choice(["Acme", "Bolt", "Core", None]), r.choice(["Austin", "North", "New Austin", None]))
    kind = "id long, {} string, company string, city string, latitude double, longitude double"
    asked = spark.createDataFrame([(i, *text(), *(place() if i % 4 else (None, None))) for i in range(60)], kind.format("campus_name"))
    known = spark.createDataFrame([(i, *text(), *place()) for i in range(300)], kind.format("canonical_name"))
    return asked, known


def test_best_candidates_of_crowded_places_equal_those_of_all_pairs(spark, monkeypatch):
    asked, known = intake_tables(spark)
    key = ["left_id", "right_id", "distance_m", "company_match", "confidence", "match_type", "rank"]
    every = matching.intake_scores(asked, known).filter("rank <= 4").select(*key).collect()
    made = sizes_of_joins(monkeypatch, matching)
    few = matching.intake_scores(asked, known, top=4).select(*key).collect()
    assert sorted(map(repr, few)) == sorted(map(repr, every)) and len(every) > 200
    assert max(made) <= 28 * 28


def test_requests_without_place_find_all_alike_names(spark):
    asked, known = intake_tables(spark)
    asked = asked.filter("latitude IS NULL")
    same = F.col("a.company") == F.col("b.company")
    text = F.greatest(S.token_similarity(F.col("a.campus_name"), F.col("b.canonical_name")), S.token_similarity(F.col("a.city"), F.col("b.city")))
    want = asked.alias("a").join(known.alias("b"), same).filter(text >= 0.7).select("a.id", "b.id").collect()
    made = matching.intake_scores(asked, known)
    assert sorted((x["left_id"], x["right_id"]) for x in made.collect()) == sorted(map(tuple, want)) and want
    # texts meet by equal words before they are compared: no join has the company as its only key
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "__word" in plan
