import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodeframe.functions import scalars as S
from lodeframe.functions import stats


def one(spark, expression, **values):
    schema = ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'double'}" for k, v in values.items()) or "z string"
    row = [tuple(float(v) if isinstance(v, (int, float)) else v for v in values.values()) or ("",)]
    return spark.createDataFrame(row, schema).select(expression.alias("r")).first()["r"]


def haversine(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371000 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


def test_haversine(spark):
    rows = [(10.0, 20.0, 11.0, 21.5), (0.0, 0.0, 0.0, 180.0), (89.9, 10.0, 89.9, -170.0), (5.0, 5.0, 5.0, 5.0)]
    got = spark.createDataFrame(rows, "a double, b double, c double, d double").select(S.haversine("a", "b", "c", "d").alias("r")).collect()
    assert [r["r"] for r in got] == pytest.approx([haversine(*r) for r in rows], rel=1e-9, abs=1e-6)
    assert one(spark, S.haversine("a", "b", F.lit(None).cast("double"), "b"), a=1, b=2) is None


@pytest.mark.parametrize("text, plain, hyphen", [("A & B  Co.", "abco", "a-and-b-co"), (None, "", ""), ("  --x--  ", "x", "x"), ("Ünï", "n", "n")])
def test_slugs(spark, text, plain, hyphen):
    assert one(spark, S.slug_plain("t"), t=text) == plain
    assert one(spark, S.slug_hyphen("t"), t=text) == hyphen


def test_slug_word_keeps_letters_of_any_script(spark):
    assert one(spark, S.slug_word("t"), t=" Project: Ünïx -- 7! ") == "project-ünïx-7"


def test_campus_keys(spark):
    assert one(spark, S.campus_key_plain("c", "y", "n", "a", "o"), c="Acme Co", y="New York", n="North", a=1, o=2) == "acmeco|newyork|north"
    assert one(spark, S.campus_key_hyphen("c", "y", "n", "a", "o"), c="Acme", y="X", n="", a=1.5, o=-2.5) == "acme|x|1-5-2-5"


@pytest.mark.parametrize("name, want", [("Amazon.com", "AWS"), ("amazon", "AWS"), ("Foo | Facebook", "Meta"), ("Equinix (FKA X)", "Equinix"), ("Nobody", "Nobody"), ("", None), (None, None)])
def test_canonical_company(spark, name, want):
    assert one(spark, S.canonical_company("n"), n=name) == want


@pytest.mark.parametrize("name, want", [("Meta", "META"), ("aws", "AWS"), ("Nobody & Sons", "NOBO"), ("", "UNK"), (None, "UNK"), ("--", "UNK")])
def test_company_code(spark, name, want):
    assert one(spark, S.company_code("n"), n=name) == want


@pytest.mark.parametrize("name, want", [("Acme - Foo", "- Foo"), ("AWS - Abu Dhabi", "Abu Dhabi"), ("Foo", "Foo"), ("Acme", "Acme")])
def test_without_company(spark, name, want):
    assert one(spark, S.without_company("n", F.lit("Acme")), n=name) == want


@pytest.mark.parametrize("name, want", [("A", "hyperscaler"), ("Equinix LLC", "major_colo"), ("Zzz", "other"), ("", "other"), (None, "other")])
def test_tier_matches_both_ways(spark, name, want):
    assert one(spark, S.company_tier("n"), n=name) == want


def test_tier_minimum_length(spark):
    assert one(spark, S.company_tier("n", least=3), n="A") == "other"


@pytest.mark.parametrize("text, want", [("2024-03-01", "2024-03-01"), ("03/02/2024", "2024-03-02"), ("2024/3/1", "2024-03-01"), ("25/12/2024", "2024-12-25"), ("2024", "2024-01-01"), ("never", None), (None, None)])
def test_dates(spark, text, want):
    assert one(spark, F.date_format(S.any_date("t", S.GRID_DATES), "yyyy-MM-dd"), t=text) == want


def test_month_year(spark):
    assert one(spark, F.date_format(S.any_date("t", S.MILESTONE_DATES), "yyyy-MM-dd"), t="04/2025") == "2025-04-01"


@pytest.mark.parametrize("text, want", [("USD 10,000M", 10000.0), ("", None), ("none", None), (None, None)])
def test_cost(spark, text, want):
    assert one(spark, S.cost_millions("t"), t=text) == want


@pytest.mark.parametrize("text, want", [("2.47M", 2470000.0), ("715,000", 715000.0), ("0", None), ("abc", None), (None, None)])
def test_square_feet(spark, text, want):
    got = one(spark, S.square_feet("t"), t=text)
    assert got == pytest.approx(want) if want else got is None


@pytest.mark.parametrize(
    "place, county, want",
    [
        ("Foo Data Center, Aiken County, South Carolina, United States of America (building)", None, "South Carolina"), ("Cheyenne, Wyoming, United States of America (city)", None, "Cheyenne"),
        ("Lebanon, IN 46052, United States of America (city)", None, "IN 46052"), (None, "Polk County", "Polk"), (None, None, None),
    ],
)
def test_city(spark, place, county, want):
    assert one(spark, S.city_of_location("p", "c"), p=place, c=county) == want


@pytest.mark.parametrize("lon, want", [(-30, "AMER"), (-27, "OTHER"), (-25, "EMEA"), (65, "EMEA"), (65.1, "APAC"), (181, "INVALID")])
def test_region_of_point(spark, lon, want):
    assert one(spark, S.region_of_point(F.lit(10.0), "x"), x=lon) == want


def test_region_of_unknown_point(spark):
    assert one(spark, S.region_of_point(F.lit(0.0), F.lit(0.0))) == "UNKNOWN"
    assert one(spark, S.region_of_point(F.lit(None).cast("double"), F.lit(0.0))) == "UNKNOWN"


@pytest.mark.parametrize("state, abbr, want", [("VA", None, (None, "VA")), ("virginia", None, ("Virginia", "VA")), ("", "tx", (None, "TX")), ("Ontario", "on", ("Ontario", "ON"))])
def test_split_state(spark, state, abbr, want):
    name, code = S.split_state("s", "a")
    r = spark.createDataFrame([(state, abbr)], "s string, a string").select(name.alias("n"), code.alias("c")).first()
    assert (r["n"], r["c"]) == want


def test_geography_repairs_see_original_values(spark):
    rows = [("USA", None, "TX", None), ("Japan", "", None, "CA"), (None, None, "Texas", ""), ("France", "X", None, None)]
    df = spark.createDataFrame(rows, "country string, region string, state string, state_abbr string")
    got = [tuple(r) for r in df.select(*(c.alias(n) for n, c in S.repaired_geography("country", "region", "state", "state_abbr").items())).collect()]
    assert got == [("AMER", "Texas", "TX"), ("APAC", "California", "CA"), (None, "Texas", "TX"), ("X", None, None)]


@pytest.mark.parametrize("name, campus, building", [("Acme - Building 3", "Acme", "Building3"), ("Acme Campus", "Acme", None), ("Acme Data Center", "Acme", None), (None, None, None)])
def test_map_names(spark, name, campus, building):
    assert one(spark, S.map_campus_name("n"), n=name) == campus
    assert one(spark, S.map_building("n"), n=name) == building


def test_fiber_note(spark):
    assert one(spark, S.fiber_note("t"), t="['a']") == "Fiber: ['a']"
    assert one(spark, S.fiber_note("t"), t="[" + ", ".join(f"'p{i}xxxxxx'" for i in range(20)) + "]") == "Fiber: 20 providers"
    assert one(spark, S.fiber_note("t"), t="x" * 101) == "Fiber: Multiple providers"


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.text("ab c", max_size=8), st.text("ab c", max_size=8)), min_size=1, max_size=20))
def test_token_similarity_against_sets(spark, pairs):
    def model(a, b):
        if not a or not b:
            return 0.0
        x, y = a.lower().strip(), b.lower().strip()
        if x == y:
            return 1.0
        s, t = set(x.split()), set(y.split())
        return len(s & t) / len(s | t) if s and t else 0.0

    got = spark.createDataFrame(pairs, "a string, b string").select(S.token_similarity("a", "b").alias("r")).collect()
    assert [r["r"] for r in got] == pytest.approx([model(a, b) for a, b in pairs])


def test_grades(spark):
    g = lambda f, v, *a: one(spark, f("v", *a), v=v)
    assert [g(stats.grade_up_to, v) for v in (10, 10.1, 50, 51)] == ["A", "B", "D", "F"]
    assert [g(stats.grade_below, v) for v in (14.9, 15, 60)] == ["A", "B", "F"]
    assert [g(stats.grade_from, v) for v in (80, 79.9, 35, 34)] == ["A", "B", "D", "F"]
    assert one(spark, stats.grade_up_to(F.lit(None).cast("double"))) == "N/A"


def test_quarters(spark):
    assert [one(spark, S.quarter_year("t", F.lit(1999)), t=t) for t in ("Q116", "Q42024", "pre-2013", "x", None)] == [2016, 2024, 2013, 1999, 1999]


def test_listed_answers(spark):
    """The expected values beside the inputs of every listed query, which its SQL works out by itself."""
    from lodeframe.plans import case_queries as Q

    kinds = {"s": "string", "d": "double", "i": "int"}
    wrong = []
    for name, inputs, expected, function, kind in Q.LISTS:
        rows = spark.createDataFrame([(i, *row) for i, row in enumerate(inputs)], "i int, " + ", ".join(f"a{j} {kinds[k]}" for j, k in enumerate(kind)))
        got = {r["i"]: r["result"] for r in rows.select("i", function(*(rows[f"a{j}"] for j in range(len(kind)))).alias("result")).collect()}
        wrong += [(name, inputs[i], got[i], e) for i, e in enumerate(expected) if got[i] != e]
    assert not wrong and len(Q.LISTS) >= 57
