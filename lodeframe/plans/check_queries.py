"""Comparisons of two sources, validation, accuracy by level, consensus parts and scope, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodeframe.functions import config as C
from lodeframe.functions import scalars as S
from lodeframe.functions import stats
from lodeframe.operators import accuracy, clusters, comparison, consensus, land, matching, quality, rollup, spatial, timeseries, validation
from lodeframe.plans.feed_queries import _CITY, _SIDES, B, campuses
from lodeframe.plans.queries import AS_OF, CLUSTERED, TRUTH, _squares, buildings, dist, of_source, orders_mw, query, rounded, table, truth
from lodeframe.sources import readers

# --- two sources: pairs are rows of neighbouring ids, four fifths of them, so that both sides keep rows of their own

_PAIRED = f"""{_SIDES}, p AS (SELECT l AS x, r AS y FROM l JOIN r ON l.id + 1 = r.id AND l.id % 5 > 0),
    lo AS (SELECT * FROM l WHERE id NOT IN (SELECT x.id FROM p)), ro AS (SELECT * FROM r WHERE id NOT IN (SELECT y.id FROM p))"""
_NEW = "({} IN ('Under Construction', 'Announced'))"


def _found(spark, sf):
    """(pairs, left only, right only), and both sides."""
    b = buildings(spark, sf)
    left, right = of_source(b, 1), of_source(b, 2)
    side = lambda df, n: df.select(*(F.col(c).alias(f"{n}_{c}") for c in df.columns))
    found = side(left.filter("id % 5 > 0"), "left").join(side(right, "right"), F.col("left_id") + 1 == F.col("right_id"))
    only = lambda df, c: df.join(found.select(F.col(c).alias("id")), "id", "left_anti")
    return found, only(left, "left_id"), only(right, "right_id"), left, right


@query(f"{B} SELECT id, {_NEW.format('facility_status')} AS net_new FROM b")
def pred_10_net_new(spark, sf):
    return buildings(spark, sf).select("id", comparison.net_new("facility_status").alias("net_new"))


@query(f"{B} SELECT id FROM b WHERE contains(campus_name, '0001') AND company_clean = 'NATION_7'")
def pred_11_campus_lookup(spark, sf):
    return validation.campus_lookup(buildings(spark, sf), "0001", "NATION_7").select("id")


@query(f"""{_PAIRED}, k AS (SELECT *, x.record_level = y.record_level AS same, x.company_clean = y.company_clean AS agree, x.full_capacity_mw - y.full_capacity_mw AS d, greatest(x.full_capacity_mw, y.full_capacity_mw) AS top FROM p),
    s AS (SELECT *, CASE WHEN top > 0 THEN abs(d) / top * 100 ELSE 0 END >= 20 OR abs(d) >= 10 AS sig FROM k),
    u AS (SELECT x.company_clean AS company, 1 AS pair, same::INT AS same, agree::INT AS agree, CASE WHEN same THEN x.full_capacity_mw END AS lm, CASE WHEN same THEN y.full_capacity_mw END AS rm, CASE WHEN same AND sig THEN d END AS c, 0 AS lo, 0 AS ro FROM s
        UNION ALL SELECT company_clean, 0, NULL, NULL, CASE WHEN record_level = 'Building' THEN full_capacity_mw END, NULL, NULL, 1, 0 FROM lo
        UNION ALL SELECT company_clean, 0, NULL, NULL, NULL, CASE WHEN record_level = 'Building' THEN full_capacity_mw END, NULL, 0, 1 FROM ro)
    SELECT company, sum(pair)::BIGINT AS matched, coalesce(sum(same), 0)::BIGINT AS matched_same_level, coalesce(count_if(same = 0), 0)::BIGINT AS level_mismatches, coalesce(count_if(agree = 0), 0)::BIGINT AS company_mismatches, sum(lo)::BIGINT AS left_only, sum(ro)::BIGINT AS right_only,
        round(coalesce(sum(lm), 0), 2) AS left_mw, round(coalesce(sum(rm), 0), 2) AS right_mw, count(c) AS conflicts, round(coalesce(avg(c), 0), 3) AS mean_delta_mw FROM u GROUP BY 1""")
def agg_17_company_analysis(spark, sf):
    found, left_only, right_only, *_ = _found(spark, sf)
    return rounded(rounded(comparison.company_analysis(found, left_only, right_only), "left_mw", "right_mw", places=2), "mean_delta_mw", places=3)


@query(f"""{_PAIRED}, n AS (SELECT {_NEW.format('x.facility_status')} AS a, {_NEW.format('y.facility_status')} AS b, x.facility_status = y.facility_status AS same, greatest(x.full_capacity_mw, 0) * 0 + x.full_capacity_mw AS u, y.full_capacity_mw AS v FROM p),
    g AS (SELECT *, a AND b AND greatest(u, v) > 0 AS c FROM n),
    s AS (SELECT count_if(a OR b)::BIGINT AS matched, count_if(a AND b)::BIGINT AS matched_both, count_if(a)::BIGINT AS left_matched, count_if(b)::BIGINT AS right_matched, count_if(a AND b AND same)::BIGINT AS same_status, avg(CASE WHEN c THEN abs(u - v) / greatest(u, v) END) * 100 AS mape,
        CASE WHEN sum(CASE WHEN c THEN v END) > 0 THEN sum(CASE WHEN c THEN u - v END) / sum(CASE WHEN c THEN v END) * 100 END AS bias FROM g),
    c1 AS (SELECT count(*) AS n, coalesce(sum(full_capacity_mw), 0) AS mw FROM l WHERE {_NEW.format('facility_status')}), c2 AS (SELECT count(*) AS n, coalesce(sum(full_capacity_mw), 0) AS mw FROM r WHERE {_NEW.format('facility_status')}),
    c3 AS (SELECT count(*) AS n, coalesce(sum(full_capacity_mw), 0) AS mw FROM lo WHERE {_NEW.format('facility_status')}), c4 AS (SELECT count(*) AS n, coalesce(sum(full_capacity_mw), 0) AS mw FROM ro WHERE {_NEW.format('facility_status')})
    SELECT s.* EXCLUDE (mape, bias), round(mape, 4) AS mape, round(bias, 4) AS bias, c1.n AS "left", c2.n AS "right", c3.n AS left_only, c4.n AS right_only, round(c1.mw, 2) AS left_mw, round(c2.mw, 2) AS right_mw, round(c3.mw, 2) AS left_only_mw, round(c4.mw, 2) AS right_only_mw,
        round(100 * left_matched / c1.n::DOUBLE, 4) AS left_coverage, round(100 * right_matched / c2.n::DOUBLE, 4) AS right_coverage, round(CASE WHEN matched_both > 0 THEN 100 * same_status / matched_both::DOUBLE ELSE 0 END, 4) AS status_agreement FROM s, c1, c2, c3, c4""")
def agg_19_net_new_summary(spark, sf):
    found, left_only, right_only, left, right = _found(spark, sf)
    out = comparison.net_new_summary(found, left, right, left_only, right_only)
    return rounded(rounded(out, "left_mw", "right_mw", "left_only_mw", "right_only_mw", places=2), "mape", "bias", "left_coverage", "right_coverage", "status_agreement")


@query(f"""{_PAIRED}, u AS (SELECT x.region AS region, 'pair' AS k, 0.0::DOUBLE AS mw FROM p WHERE {_NEW.format('x.facility_status')} AND {_NEW.format('y.facility_status')} UNION ALL SELECT region, 'l', full_capacity_mw FROM l WHERE {_NEW.format('facility_status')}
        UNION ALL SELECT region, 'r', full_capacity_mw FROM r WHERE {_NEW.format('facility_status')} UNION ALL SELECT region, 'lo', 0 FROM lo WHERE {_NEW.format('facility_status')} UNION ALL SELECT region, 'ro', 0 FROM ro WHERE {_NEW.format('facility_status')})
    SELECT region, count_if(k = 'l')::BIGINT AS "left", count_if(k = 'r')::BIGINT AS "right", count_if(k = 'lo')::BIGINT AS left_only, count_if(k = 'ro')::BIGINT AS right_only, count_if(k = 'pair')::BIGINT AS matched,
        round(coalesce(sum(CASE WHEN k = 'l' THEN mw END), 0), 2) AS left_mw, round(coalesce(sum(CASE WHEN k = 'r' THEN mw END), 0), 2) AS right_mw FROM u GROUP BY 1""")
def agg_19_net_new_by_region(spark, sf):
    found, left_only, right_only, left, right = _found(spark, sf)
    return rounded(comparison.net_new_by(found, left, right, left_only, right_only, "region"), "left_mw", "right_mw", places=2)


@query(f"""{_PAIRED}, e AS (SELECT *, greatest(x.full_capacity_mw, y.full_capacity_mw) AS top, abs(x.full_capacity_mw - y.full_capacity_mw) AS d FROM p WHERE x.id % 4 = 0 OR y.id % 7 = 0)
    SELECT count(*) AS matched, count_if(CASE WHEN top > 0 THEN d / top * 100 ELSE 0 END >= 20)::BIGINT AS in_conflict, round(avg(CASE WHEN x.full_capacity_mw > 0 AND y.full_capacity_mw > 0 THEN d / top END) * 100, 4) AS mape,
        (SELECT count(*) FROM lo WHERE id % 4 = 0) AS left_only, (SELECT count(*) FROM ro WHERE id % 7 = 0) AS right_only FROM e""")
def agg_20_essential(spark, sf):
    found, left_only, right_only, *_ = _found(spark, sf)
    flag = lambda c, k: (F.col(c) % k == 0).cast("int")
    found = found.withColumns({"left_is_essential": flag("left_id", 4), "right_is_essential": flag("right_id", 7)})
    return rounded(comparison.essential_subset(found, left_only.withColumn("is_essential", flag("id", 4)), right_only.withColumn("is_essential", flag("id", 7))), "mape")


_SHIFT = "CASE WHEN id % 3 = 0 THEN 0 WHEN id % 3 = 1 THEN 0.00004 ELSE 0.0004 END"
_TWIN = f"""{B}, l AS (SELECT * FROM b WHERE source = 'Semianalysis'),
    r AS (SELECT id, company_clean, campus_name, region AS state_abbr, latitude + {_SHIFT} AS latitude, longitude, CASE WHEN id % 4 = 0 THEN full_capacity_mw * 1.03 WHEN id % 4 = 1 THEN full_capacity_mw * 2 ELSE full_capacity_mw END AS full_capacity_mw FROM l WHERE id % 7 > 0),
    n AS (SELECT l.id AS left_id, arg_min(r.id, struct_pack(d := {dist('l', 'r')}, i := r.id)) AS right_id, min({dist('l', 'r')}) AS d FROM l JOIN r ON {dist('l', 'r')} <= 500 GROUP BY 1),
    a AS (SELECT left_id, right_id, d, l.company_clean = r.company_clean AS company_match, l.campus_name = r.campus_name AS same_name, l.region = r.state_abbr AS state_match, l.full_capacity_mw AS u, r.full_capacity_mw AS v FROM n JOIN l ON left_id = l.id JOIN r ON right_id = r.id)"""


def _twins(spark, sf):
    """A source, and a moved and altered copy of six sevenths of it."""
    left = of_source(buildings(spark, sf), 1).withColumn("state_abbr", F.col("region"))
    k = F.col("id")
    moved = F.when(k % 3 == 0, 0.0).when(k % 3 == 1, 0.00004).otherwise(0.0004)
    mw = F.when(k % 4 == 0, F.col("full_capacity_mw") * 1.03).when(k % 4 == 1, F.col("full_capacity_mw") * 2).otherwise(F.col("full_capacity_mw"))
    cols = ["id", "company_clean", "campus_name", "state_abbr", "latitude", "longitude", "full_capacity_mw"]
    return left.select(cols), left.filter("id % 7 > 0").withColumns({"latitude": F.col("latitude") + moved, "full_capacity_mw": mw}).select(cols)


@query(f"""{_TWIN} SELECT left_id, right_id, round(d, 3) AS distance_m, d < 1 AS same_place, d < 10 AS very_close, company_match, state_match, u > 0 AND v > 0 AND abs(u - v) < 0.01 AS same_capacity, u > 0 AND v > 0 AND abs(u - v) / greatest(u, v) < 0.05 AS like_capacity, same_name AS one_name FROM a""")
def join_13_nearest_alike(spark, sf):
    made = comparison.nearest_alike(*_twins(spark, sf)).select("left_id", "right_id", F.round("distance_m", 3).alias("distance_m"), "same_place", "very_close", "company_match", "state_match", "same_capacity", "like_capacity", (F.col("name_similarity") == 1.0).alias("one_name"))
    return made


@query(f"""{_TWIN}, f AS (SELECT *, u > 0 AND v > 0 AND abs(u - v) < 0.01 AS sc, u > 0 AND v > 0 AND abs(u - v) / greatest(u, v) < 0.05 AS lc FROM a)
    SELECT count(*) AS pairs, count_if(d < 1)::BIGINT AS same_place, count_if(d < 10)::BIGINT AS very_close, count_if(d < 100)::BIGINT AS close, count_if(u > 0 AND v > 0)::BIGINT AS with_capacity, count_if(sc)::BIGINT AS same_capacity, count_if(lc)::BIGINT AS like_capacity,
        count_if(company_match)::BIGINT AS same_company, count_if(d < 1 AND company_match AND (sc OR lc))::BIGINT AS all_alike, (SELECT count(*) FROM l) AS left_rows, round(100 * count(*) / (SELECT count(*) FROM l)::DOUBLE, 4) AS match_pct, round(100 * count_if(d < 1 AND company_match AND (sc OR lc)) / count(*)::DOUBLE, 4) AS all_alike_pct FROM f""")
def agg_58_overlap_counts(spark, sf):
    left, right = _twins(spark, sf)
    return rounded(comparison.overlap_counts(comparison.nearest_alike(left, right), left).drop("names_80", "names_50"), "match_pct", "all_alike_pct")


@query(f"""{_TWIN}, q AS (SELECT *, u > 0 AND v > 0 AS valued, u > 0 AND v > 0 AND abs(u - v) / greatest(u, v) <= 0.05 AS lc FROM a),
    s AS (SELECT count(*) AS pairs, count_if(d <= 1)::BIGINT AS same_place, count_if(d <= 10)::BIGINT AS very_close, count_if(d <= 100)::BIGINT AS close, count_if(valued)::BIGINT AS with_capacity, count_if(valued AND u = v)::BIGINT AS same_capacity, count_if(lc)::BIGINT AS like_capacity, count_if(company_match)::BIGINT AS same_company,
        count_if(d <= 1 AND company_match AND (u = v OR lc))::BIGINT AS all_alike FROM q),
    z AS (SELECT *, 100 * same_place / pairs::DOUBLE AS pp, 100 * same_capacity / with_capacity::DOUBLE AS cp, 100 * all_alike / pairs::DOUBLE AS ap FROM s),
    e AS (SELECT *, CASE WHEN pp >= 50 THEN 3 WHEN pp >= 20 THEN 2 WHEN pp >= 5 THEN 1 ELSE 0 END + CASE WHEN cp >= 50 THEN 3 WHEN cp >= 25 THEN 2 WHEN cp >= 10 THEN 1 ELSE 0 END + CASE WHEN ap >= 20 THEN 3 WHEN ap >= 5 THEN 2 WHEN ap >= 1 THEN 1 ELSE 0 END AS score FROM z)
    SELECT * EXCLUDE (pp, cp, ap, score), round(pp, 4) AS same_place_pct, round(cp, 4) AS same_capacity_pct, round(ap, 4) AS all_alike_pct, score::INT AS score, CASE WHEN score >= 6 THEN 'STRONG' WHEN score >= 3 THEN 'MODERATE' ELSE 'WEAK' END AS conclusion FROM e""")
def agg_57_overlap_evidence(spark, sf):
    out = comparison.overlap_evidence(spatial.nearest(*_twins(spark, sf), 500.0))
    keep = ("pairs", "same_place", "very_close", "close", "with_capacity", "same_capacity", "like_capacity", "same_company", "all_alike", "same_place_pct", "same_capacity_pct", "all_alike_pct", "score", "conclusion")
    return rounded(out.select(*keep), "same_place_pct", "same_capacity_pct", "all_alike_pct")


@query(f"""{_CITY} SELECT company_clean, count(*) AS campuses, count_if(tier = 'VERIFIED')::BIGINT AS verified, count_if(tier = 'HIGH')::BIGINT AS high, count_if(tier = 'MEDIUM')::BIGINT AS medium, count_if(tier = 'LOW')::BIGINT AS low, round(avg(len(sources)), 4) AS mean_sources, max(len(sources))::INT AS most_sources,
    round(sum(mw), 2) AS total_mw, round(sum(CASE WHEN tier = 'VERIFIED' THEN mw ELSE 0 END), 2) AS verified_mw, round(100 * count_if(tier IN ('VERIFIED', 'HIGH')) / count(*)::DOUBLE, 4) AS pct_verified_or_high, round(100 * count_if(tier <> 'LOW') / count(*)::DOUBLE, 4) AS pct_multi_source
    FROM k WHERE company_clean IN ('NATION_0', 'NATION_1', 'NATION_10', 'NATION_11') GROUP BY 1""")
def agg_14_company_coverage(spark, sf):
    c = campuses(spark, sf).withColumns({"tier": clusters.confidence_tier(F.col("sources")), "source_count": F.size("sources")})
    out = comparison.company_coverage(c, ["NATION_0", "NATION_1", "NATION_10", "NATION_11"]).drop("high_mw", "medium_mw", "low_mw")
    return rounded(rounded(out, "mean_sources", "pct_verified_or_high", "pct_multi_source"), "total_mw", "verified_mw", places=2)


_MW = ", ".join(f"sum(CASE WHEN year(l_shipdate) = {y} THEN l_extendedprice END) AS mw_{y + 30}" for y in (1993, 1998))


@query(f"""{B}, y AS (SELECT l_suppkey AS id, {_MW} FROM lineitem GROUP BY 1), g AS (SELECT company_clean, region = 'ASIA' AS home, coalesce(mw_2023, 0) AS f, coalesce(mw_2028, 0) AS z FROM t JOIN y USING (id))
    SELECT company_clean, round(sum(CASE WHEN home THEN f ELSE 0 END), 2) AS home_first, round(sum(CASE WHEN NOT home THEN z ELSE 0 END), 2) AS abroad_last, count_if(home)::BIGINT AS home_rows, count_if(NOT home)::BIGINT AS abroad_rows, round((sum(z) - sum(f)) / 1000, 4) AS total_growth_gw FROM g GROUP BY 1""")
def agg_22_growth(spark, sf):
    rows = truth(spark, sf).join(orders_mw(spark, sf), "id")
    out = comparison.growth(rows, F.col("region") == "ASIA", "mw_2023", "mw_2028").select("company_clean", "home_first", "abroad_last", "home_rows", "abroad_rows", "total_growth_gw")
    return rounded(rounded(out, "home_first", "abroad_last", places=2), "total_growth_gw")


@query(f"""{B}, m AS (SELECT id, id % 4 + 1 AS tier, CASE WHEN id % 6 = 0 THEN 'Amazon Data Services' WHEN id % 6 IN (1, 2) THEN 'Acme' END AS parent FROM t WHERE id % 10 < 7),
    s AS (SELECT count(*) AS sites, count_if(parent = 'Amazon Data Services')::BIGINT AS "full", count_if(parent = 'Acme')::BIGINT AS partial, count_if(tier IS NOT NULL AND parent IS NULL)::BIGINT AS no_value, count(tier) AS covered, count_if(tier = 1)::BIGINT AS tier_1, count_if(tier = 2)::BIGINT AS tier_2, count_if(tier = 3)::BIGINT AS tier_3, count_if(tier = 4)::BIGINT AS tier_4 FROM t LEFT JOIN m USING (id))
    SELECT *, round(100 * "full" / sites::DOUBLE, 4) AS full_pct, round(100 * ("full" + partial) / covered::DOUBLE, 4) AS new_pct, CASE WHEN "full" >= 5 THEN 'STRONGLY RECOMMEND' WHEN "full" >= 3 THEN 'RECOMMEND' WHEN "full" >= 1 THEN 'CONSIDER' ELSE 'NOT USEFUL' END AS recommendation FROM s""")
def agg_55_permit_metrics(spark, sf):
    t = truth(spark, sf)
    parent = F.when(F.col("id") % 6 == 0, "Amazon Data Services").when((F.col("id") % 6).isin(1, 2), "Acme")
    m = t.filter("id % 10 < 7").select(F.col("id").alias("left_id"), (F.col("id") % 4 + 1).alias("tier"), parent.alias("parent_company"))
    return rounded(comparison.permit_metrics(t, m).drop("partial_pct", "no_value_pct", "covered_pct"), "full_pct", "new_pct")


# --- accuracy

_LEVELS = f"""{B}, c AS (SELECT min(id) AS id, source, avg(latitude) AS latitude, avg(longitude) AS longitude FROM b GROUP BY source, id % 97),
    db AS (SELECT t.id, b.source, min({dist('t', 'b')}) AS d FROM t JOIN b ON {dist('t', 'b')} <= 200 GROUP BY ALL), dc AS (SELECT t.id, c.source, min({dist('t', 'c')}) AS d FROM t JOIN c ON {dist('t', 'c')} <= 200 GROUP BY ALL),
    sb AS (SELECT source, count(*) AS n, median(d) AS m FROM db GROUP BY 1), sc AS (SELECT source, count(*) AS n, median(d) AS m FROM dc GROUP BY 1), k AS (SELECT count(*) AS n FROM t)"""


@query(f"""{_LEVELS} SELECT source, round(100 * coalesce(sc.n, 0) / k.n::DOUBLE, 1) AS campus_recall, coalesce(sc.n, 0) AS campus_found, round(sc.m, 3) AS campus_median, round(100 * coalesce(sb.n, 0) / k.n::DOUBLE, 1) AS building_recall, coalesce(sb.n, 0) AS building_found, round(sb.m, 3) AS building_median,
    round(round(100 * coalesce(sb.n, 0) / k.n::DOUBLE, 1) - round(100 * coalesce(sc.n, 0) / k.n::DOUBLE, 1), 1) AS recall_gain FROM (SELECT DISTINCT source FROM b) LEFT JOIN sb USING (source) LEFT JOIN sc USING (source), k""")
def agg_66_level_comparison(spark, sf):
    b, t = buildings(spark, sf), truth(spark, sf)
    centres = b.groupBy("source", (F.col("id") % 97).alias("g")).agg(F.min("id").alias("id"), F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude")).drop("g")
    at = lambda rows: accuracy.spatial_accuracy(t, rows.select("id", "source", "latitude", "longitude"), 200.0)
    return rounded(rounded(comparison.level_comparison(at(centres), at(b)), "campus_median", "building_median", places=3), "recall_gain", places=1)


@query(f"""{B}, d AS (SELECT t.id, CASE t.id % 3 WHEN 0 THEN 'Complete Build' WHEN 1 THEN 'Active Build' ELSE 'Future Build' END AS status, b.source, min({dist('t', 'b')}) AS d FROM t JOIN b ON {dist('t', 'b')} <= 300 GROUP BY ALL),
    s AS (SELECT CASE id % 3 WHEN 0 THEN 'Complete Build' WHEN 1 THEN 'Active Build' ELSE 'Future Build' END AS status, count(*) AS total FROM t GROUP BY 1), f AS (SELECT status, source, count(*) AS found, median(d) AS median, avg(d) AS mean, min(d) AS least, max(d) AS largest FROM d GROUP BY ALL),
    o AS (SELECT status, source, median(abs(d - median)) AS mad FROM d JOIN f USING (status, source) GROUP BY ALL), p AS (SELECT * FROM s, (SELECT DISTINCT source FROM d))
    SELECT status, source, total, coalesce(found, 0) AS found, round(median, 3) AS median, round(mean, 3) AS mean, round(least, 3) AS least, round(largest, 3) AS largest, round(mad, 3) AS mad, round(100 * coalesce(found, 0) / total::DOUBLE, 1) AS recall FROM p LEFT JOIN f USING (status, source) LEFT JOIN o USING (status, source)""")
def agg_65_status_recall(spark, sf):
    status = F.when(F.col("id") % 3 == 0, "Complete Build").when(F.col("id") % 3 == 1, "Active Build").otherwise("Future Build")
    t = truth(spark, sf).withColumn("status", status)
    near = spatial.nearest(t, buildings(spark, sf), 300.0, per=["right_source"]).select(F.col("left_id").alias("id"), F.col("left_status").alias("status"), F.col("right_source").alias("source"), "distance_m")
    return rounded(accuracy.regional_recall(t, near, "status"), "median", "mean", "least", "largest", "mad", places=3)


_MATCHES = f"""{B}, m AS (SELECT t.id AS building_key, 'D' || t.id % 20 AS dc_code, b.source, b.full_capacity_mw AS mw, CASE WHEN b.id % 11 > 0 THEN {dist('t', 'b')} END AS distance_m, b.id FROM t JOIN b ON {dist('t', 'b')} <= 400),
    c AS (SELECT building_key, source, arg_min(struct_pack(mw := mw, dc := dc_code), struct_pack(n := distance_m IS NULL, d := coalesce(distance_m, 0), i := id)) AS v FROM m GROUP BY 1, 2),
    g AS (SELECT id AS building_key, 'D' || id % 20 AS dc_code, load AS actual, CASE WHEN id % 3 = 0 THEN 'Complete Build' ELSE 'Future Build' END AS status FROM t)"""


def _matches(spark, sf):
    """(matches of buildings within 400 m, some without a distance; the truth)."""
    near = spatial.band_join(truth(spark, sf), buildings(spark, sf), 400.0)
    code = lambda c: F.concat(F.lit("D"), (F.col(c) % 20).cast("string"))
    m = near.select(F.col("left_id").alias("building_key"), code("left_id").alias("dc_code"), F.col("right_source").alias("source"), F.col("right_full_capacity_mw").alias("mw"), F.when(F.col("right_id") % 11 > 0, F.col("distance_m")).alias("distance_m"), F.col("right_id").alias("id"))
    status = F.when(F.col("id") % 3 == 0, "Complete Build").otherwise("Future Build")
    return m, truth(spark, sf).select(F.col("id").alias("building_key"), code("id").alias("dc_code"), F.col("load").alias("it_load_total"), status.alias("new_build_status"))


@query(f"{_MATCHES} SELECT building_key, source, round(v.mw, 2) AS mw, round(actual, 2) AS actual FROM c JOIN g USING (building_key)")
def join_05_building_match(spark, sf):
    return rounded(accuracy.capacity_match(*_matches(spark, sf)).select("building_key", "source", "mw", "actual"), "mw", "actual", places=2)


@query(f"{_MATCHES}, s AS (SELECT v.dc AS dc_code, source, sum(v.mw) AS mw FROM c GROUP BY 1, 2), a AS (SELECT dc_code, sum(actual) AS actual FROM g GROUP BY 1) SELECT dc_code, source, round(mw, 2) AS mw, round(actual, 2) AS actual FROM s JOIN a USING (dc_code)")
def join_06_campus_match(spark, sf):
    return rounded(accuracy.capacity_match(*_matches(spark, sf), "campus"), "mw", "actual", places=2)


@query(f"{_MATCHES} SELECT dc_code, count(*) AS buildings, round(sum(actual), 2) AS load, round(max(actual), 2) AS largest FROM g GROUP BY 1")
def agg_09_campus_load(spark, sf):
    return rounded(accuracy.campus_load(_matches(spark, sf)[1]), "load", "largest", places=2)


@query(f"""{_MATCHES}, w AS (SELECT c.source, status, actual AS a, c.v.mw / CASE c.source WHEN 'DataCenterHawk' THEN 1.3::DOUBLE ELSE 1 END AS p FROM c JOIN g USING (building_key) WHERE c.source IN ('DataCenterHawk', 'Semianalysis')),
    u AS (SELECT source, 'all' AS scope, a, p FROM w UNION ALL SELECT source, 'complete', a, p FROM w WHERE status = 'Complete Build'), s AS (SELECT source, scope, count_if(a > 0 AND p > 0)::BIGINT AS n, round(avg(CASE WHEN a > 0 AND p > 0 THEN abs(p - a) / a END) * 100, 4) AS mape FROM u GROUP BY 1, 2)
    SELECT *, CASE WHEN mape IS NULL THEN 'N/A' WHEN mape <= 10 THEN 'A' WHEN mape <= 20 THEN 'B' WHEN mape <= 35 THEN 'C' WHEN mape <= 50 THEN 'D' ELSE 'F' END AS grade FROM s""")
def stat_36_building_accuracy(spark, sf):
    return rounded(comparison.building_accuracy(*_matches(spark, sf), {"DataCenterHawk": 1.3, "Semianalysis": 1.0}), "mape")


@query(f"""{_MATCHES}, w AS (SELECT source, actual AS a, v.mw AS p FROM c JOIN g USING (building_key) WHERE status = 'Complete Build'), f(factor) AS (VALUES (1.0::DOUBLE), (1.1::DOUBLE), (1.2::DOUBLE), (1.3::DOUBLE), (1.4::DOUBLE), (1.5::DOUBLE))
    SELECT source, factor, count_if(a > 0 AND p > 0)::BIGINT AS n, CASE WHEN count_if(a > 0 AND p > 0) >= 3 THEN round(avg(CASE WHEN a > 0 AND p > 0 THEN abs(p / factor - a) / a END) * 100, 4) END AS mape, round(avg(CASE WHEN a > 0 AND p > 0 THEN p / factor / a END), 4) AS ratio FROM w, f GROUP BY 1, 2""")
def stat_34_pue_what_if(spark, sf):
    m, t = _matches(spark, sf)
    rows = matching.closest_per_key(m, ["building_key", "source"]).join(t.drop("dc_code"), "building_key").withColumn("build_status", F.col("new_build_status"))
    out = accuracy.variance_grid(rows, "it_load_total", ["mw"], [1.0, 1.1, 1.2, 1.3, 1.4, 1.5], ["Complete Build"])
    return rounded(out.select("source", "factor", "n", "mape", "ratio"), "mape", "ratio")


@query(f"""{_PAIRED}, k AS (SELECT x.full_capacity_mw AS a, y.full_capacity_mw AS b, x.record_level = y.record_level AS same, x.full_capacity_mw - y.full_capacity_mw AS d, greatest(x.full_capacity_mw, y.full_capacity_mw) AS top FROM p), s AS (SELECT *, CASE WHEN top > 0 THEN abs(d) / top * 100 ELSE 0 END >= 20 OR abs(d) >= 10 AS sig FROM k)
    SELECT count(*) AS pairs, count_if(a > 0 AND b > 0)::BIGINT AS both_valued, count_if(sig)::BIGINT AS conflicts, count_if(sig AND d > 0)::BIGINT AS left_larger, count_if(sig AND d < 0)::BIGINT AS right_larger, count_if(same)::BIGINT AS same_level, count_if(NOT same)::BIGINT AS other_level, round(avg(d), 4) AS mean_delta, round(corr(a, b), 6) AS r FROM s""")
def stat_28_conflicts(spark, sf):
    return rounded(rounded(comparison.conflict_summary(_found(spark, sf)[0]), "mean_delta"), "r", places=6)


@query("SELECT o_orderpriority AS g, round(corr(o_totalprice, o_orderkey::DOUBLE), 8) AS r, 0.0::DOUBLE AS flat FROM orders GROUP BY 1")
def stat_04_correlation(spark, sf):
    o = table(spark, sf, "orders").withColumns({"k": F.col("o_orderkey").cast("double"), "one": F.lit(1.0)})
    return rounded(o.groupBy(F.col("o_orderpriority").alias("g")).agg(stats.correlation("o_totalprice", "k").alias("r"), stats.correlation("o_totalprice", "one").alias("flat")), "r", places=8)


@query(f"""{B}, d AS (SELECT {dist('x', 'y')} AS d FROM t x JOIN t y ON x.company_clean = y.company_clean AND x.id < y.id), m(upto) AS (VALUES (250.0::DOUBLE), (500.0::DOUBLE), (1000.0::DOUBLE), (2000.0::DOUBLE), (5000.0::DOUBLE))
    SELECT upto, coalesce(count_if(d <= upto), 0)::BIGINT AS n, coalesce(round(100 * count_if(d <= upto) / nullif(count(d), 0)::DOUBLE, 4), 0) AS pct FROM m LEFT JOIN d ON true GROUP BY 1""")
def stat_32_buckets(spark, sf):
    return rounded(spatial.distance_coverage(spatial.group_pairs(truth(spark, sf), "company_clean"), "distance_m"), "pct")


@query(f"{B}, d AS (SELECT x.company_clean AS company, count(*) AS n FROM b x WHERE facility_status = 'Active' GROUP BY 1) SELECT company, n FROM d")
def udf_01_expressions(spark, sf):
    """User functions are column expressions: they compose with any plan and stay inside generated code."""
    named = S.canonical_company(F.concat(F.lit(" "), F.col("company_clean")))
    return buildings(spark, sf).filter(S.status_category("facility_status") == "Active").groupBy(named.alias("company")).agg(F.count("*").alias("n"))


@query("SELECT o_orderstatus AS g, count(*) AS n, round(avg(abs(o_totalprice - 200000) / 200000) * 100, 4) AS mape, round(avg(o_totalprice - 200000) / 200000 * 100, 4) AS bias_pct FROM orders WHERE o_totalprice > 0 GROUP BY 1")
def udf_02_aggregates(spark, sf):
    """User aggregates are dictionaries of aggregate columns."""
    made = stats.accuracy("actual", "o_totalprice")
    o = table(spark, sf, "orders").withColumn("actual", F.lit(200000.0)).groupBy(F.col("o_orderstatus").alias("g"))
    return rounded(o.agg(*(made[k].alias(k) for k in ("n", "mape", "bias_pct"))), "mape", "bias_pct")


# --- validation


@query(f"""{B}, m AS (SELECT id % 29 AS loose_id, id % 58 AS tight_id FROM t), x AS (SELECT id % 58 AS id, avg(latitude) AS latitude, avg(longitude) AS longitude FROM t GROUP BY 1), u AS (SELECT DISTINCT loose_id, tight_id FROM m),
    g AS (SELECT a.loose_id, {dist('p', 'q')} AS d, p.id AS i, q.id AS j FROM u a JOIN u c ON a.loose_id = c.loose_id AND a.tight_id < c.tight_id JOIN x p ON p.id = a.tight_id JOIN x q ON q.id = c.tight_id)
    SELECT loose_id, round(max(d), 3) AS max_distance_m, round(min(d), 3) AS min_distance_m, 2 AS tight_count, CASE WHEN max(d) > 1200 THEN 'MEDIUM' ELSE 'LOW' END AS severity FROM g GROUP BY 1 HAVING max(d) < 2000""")
def join_33_orphan_splits(spark, sf):
    t = truth(spark, sf)
    m = t.select((F.col("id") % 29).alias("loose_id"), (F.col("id") % 58).alias("tight_id"))
    centres = t.groupBy((F.col("id") % 58).alias("id")).agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"))
    return rounded(validation.orphan_splits(m, centres, 2000.0).select("loose_id", "max_distance_m", "min_distance_m", "tight_count", "severity"), "max_distance_m", "min_distance_m", places=3)


@query(f"""{B}, u AS (SELECT id, latitude, longitude FROM b WHERE id % 3 = 0), v AS (SELECT id, latitude, longitude FROM b WHERE id % 3 = 1), a AS (SELECT t.id, count(*) AS n, min({dist('t', 'u')}) AS d FROM t JOIN u ON {dist('t', 'u')} <= 100 GROUP BY 1),
    c AS (SELECT t.id, count(*) AS n, min({dist('t', 'v')}) AS d FROM t JOIN v ON {dist('t', 'v')} <= 100 GROUP BY 1)
    SELECT t.id, coalesce(a.n, 0) AS tight_matches, coalesce(c.n, 0) AS loose_matches, CASE WHEN a.d IS NULL AND c.d IS NULL THEN 'NO_MATCH' WHEN c.d IS NULL THEN 'TIGHT' WHEN a.d IS NULL THEN 'LOOSE' WHEN abs(a.d - c.d) < 10 THEN 'TIE' WHEN a.d < c.d THEN 'TIGHT' ELSE 'LOOSE' END AS winner
    FROM t LEFT JOIN a ON a.id = t.id LEFT JOIN c ON c.id = t.id""")
def join_34_reference_winner(spark, sf):
    b = buildings(spark, sf).select("id", "latitude", "longitude")
    return validation.reference_winner(truth(spark, sf), b.filter("id % 3 = 0"), b.filter("id % 3 = 1"), 100.0).select("id", "tight_matches", "loose_matches", "winner")


@query(f"{_CITY} SELECT cluster, company_clean, round(mw, 2) AS mw FROM k WHERE company_clean IN ('NATION_0', 'NATION_1', 'NATION_10') AND (len(sources) >= 5 OR coalesce(mw, 0) >= 70000)")
def sort_06_large_clusters(spark, sf):
    made = validation.large_clusters(campuses(spark, sf), ["NATION_0", "NATION_1", "NATION_10"], 5, 70_000.0)
    return made.select("cluster", "company_clean", F.round("full_capacity_mw", 2).alias("mw"))


_PLACES = f"""{B}, l AS (SELECT id, company_clean, latitude, longitude FROM b WHERE source = 'Semianalysis' AND latitude <> 0 AND longitude <> 0), r AS (SELECT id, company_clean, latitude + CASE WHEN id % 2 = 0 THEN 0.00005 ELSE 0 END AS latitude, longitude FROM b WHERE source = 'DataCenterHawk')"""


def _sides(spark, sf):
    b = buildings(spark, sf).select("id", "source", "company_clean", "latitude", "longitude")
    return of_source(b, 1), of_source(b, 2).withColumn("latitude", F.col("latitude") + F.when(F.col("id") % 2 == 0, 0.00005).otherwise(0.0))


@query(f"""{_PLACES}, n AS (SELECT l.id, arg_min(r, struct_pack(d := {dist('l', 'r')}, i := r.id)) AS z, min({dist('l', 'r')}) AS d, any_value(l.latitude) AS y, any_value(l.longitude) AS x FROM l JOIN r ON {dist('l', 'r')} < 1000 GROUP BY l.id),
    i AS (SELECT *, abs(y - z.latitude) < 0.0001 AND abs(x - z.longitude) < 0.0001 AS same FROM n)
    SELECT count(*) AS matched, count_if(same)::BIGINT AS identical, count_if(NOT same)::BIGINT AS different, round(avg(d), 3) AS mean_distance_m, round(100 * count_if(same) / count(*)::DOUBLE, 4) AS identical_pct, CASE WHEN 100 * count_if(same) / count(*)::DOUBLE > 80 THEN 'SHARED' ELSE 'INDEPENDENT' END AS verdict FROM i""")
def join_35_independence(spark, sf):
    return rounded(rounded(validation.coordinate_independence(*_sides(spark, sf)), "mean_distance_m", places=3), "identical_pct")


@query(f"""{_PLACES}, n AS (SELECT l.id AS left_id, arg_min(r, struct_pack(d := {dist('l', 'r')}, i := r.id)) AS z, any_value(l.latitude) AS y, any_value(l.longitude) AS x FROM l JOIN r ON {dist('l', 'r')} < 1000 WHERE l.company_clean IN ('NATION_3', 'NATION_4', 'NATION_5') AND r.company_clean IN ('NATION_3', 'NATION_4', 'NATION_5') GROUP BY l.id)
    SELECT left_id, z.id AS right_id, round(abs(y - z.latitude), 6) AS lat_diff, round(abs(x - z.longitude), 6) AS lon_diff FROM n""")
def join_36_raw_places(spark, sf):
    made = validation.place_pairs(*_sides(spark, sf), companies=["NATION_3", "NATION_4", "NATION_5"])
    return rounded(made.select("left_id", "right_id", "lat_diff", "lon_diff"), "lat_diff", "lon_diff", places=6)


@query(f"""{B}, q AS (SELECT n_nationkey AS polygon_id, n_name AS company, 30.00045::DOUBLE + (n_nationkey % 5) * 0.007 AS y0, -89.99965::DOUBLE + (n_nationkey % 4) * 0.011 AS x0 FROM nation)
    SELECT t.id, arg_min(q.company, polygon_id) AS company, min(polygon_id) AS polygon_id FROM t LEFT JOIN q ON t.latitude BETWEEN y0 AND y0 + 0.0062 AND t.longitude BETWEEN x0 AND x0 + 0.0102 GROUP BY 1""")
def join_23_admin_areas(spark, sf):
    return validation.admin_join(truth(spark, sf).select("id", "latitude", "longitude"), _squares(spark, sf), ["company"]).select("id", "company", "polygon_id")


_SUITE = """WITH s AS (SELECT 'D' || l_suppkey % 40 AS dc_code, CASE WHEN l_orderkey % 7 > 0 THEN l_orderkey::VARCHAR END AS building_key, CASE l_returnflag WHEN 'A' THEN 'Complete Build' WHEN 'N' THEN 'Active Build' ELSE CASE WHEN l_linenumber % 2 = 0 THEN 'Future Build' ELSE ' ' END END AS st,
    CASE WHEN l_linenumber > 1 THEN l_quantity END AS it_load, CASE WHEN l_linenumber % 3 > 0 THEN 30.0 ELSE 0 END AS y FROM lineitem)"""


def _suites(spark, sf):
    li = table(spark, sf, "lineitem")
    status = F.when(F.col("l_returnflag") == "A", "Complete Build").when(F.col("l_returnflag") == "N", "Active Build").when(F.col("l_linenumber") % 2 == 0, "Future Build").otherwise(" ")
    return li.select(
        F.concat(F.lit("D"), (F.col("l_suppkey") % 40).cast("string")).alias("dc_code"), F.when(F.col("l_orderkey") % 7 > 0, F.col("l_orderkey").cast("string")).alias("building_key"), status.alias("new_build_status"),
        F.when(F.col("l_linenumber") > 1, F.col("l_quantity")).alias("it_load"), F.when(F.col("l_linenumber") % 3 > 0, 30.0).otherwise(0.0).alias("latitude"), F.lit(-90.0).alias("longitude"),
    )


@query(f"""{_SUITE} SELECT count(*) AS suites, count_if(trim(st) <> '')::BIGINT AS with_status, count_if(it_load > 0)::BIGINT AS with_load, count_if(y > 0)::BIGINT AS placed, round(sum(it_load), 2) AS total_mw, round(sum(CASE WHEN st IN ('Complete Build', 'Active Build') THEN it_load END), 2) AS real_mw,
    round(sum(CASE WHEN y > 0 THEN it_load END), 2) AS placed_mw, count(DISTINCT dc_code) AS dc_codes, count(DISTINCT building_key) AS buildings, count(building_key) AS keyed, round(count(building_key) / count(DISTINCT building_key)::DOUBLE, 6) AS suites_per_building FROM s""")
def agg_37_suite_quality(spark, sf):
    return rounded(rounded(validation.suite_quality(_suites(spark, sf)), "total_mw", "real_mw", "placed_mw", places=2), "suites_per_building", places=6)


@query(f"""{_SUITE}, g AS (SELECT coalesce(nullif(trim(st), ''), 'NULL/Empty') AS status, count(*) AS suites, sum(it_load) AS mw FROM s WHERE it_load > 0 GROUP BY 1)
    SELECT status, suites, round(mw, 2) AS mw, round(100 * mw / sum(mw) OVER (), 4) AS pct, CASE WHEN status IN ('Complete Build', 'Active Build') THEN 'operational' ELSE 'future or unknown' END AS class FROM g""")
def agg_38_capacity_classes(spark, sf):
    return rounded(rounded(validation.capacity_classes(_suites(spark, sf)), "mw", places=2), "pct")


@query(f"""{_SUITE}, r AS (SELECT count_if(trim(st) = '') / count(*)::DOUBLE AS a, count_if(coalesce(it_load, 0) <= 0) / count(*)::DOUBLE AS b, count_if(y > 0) / count(*)::DOUBLE AS p, 1 - sum(CASE WHEN st IN ('Complete Build', 'Active Build') THEN it_load END) / sum(it_load) AS f FROM s),
    k AS (SELECT *, CASE WHEN a > 0.5 THEN 'fail' WHEN a > 0.35 THEN 'warn' ELSE 'pass' END AS status_flag, CASE WHEN b > 0.5 THEN 'fail' WHEN b > 0.35 THEN 'warn' ELSE 'pass' END AS capacity_flag, CASE WHEN p < 0.5 THEN 'fail' WHEN p < 0.65 THEN 'warn' ELSE 'pass' END AS place_flag, CASE WHEN f > 0.8 THEN 'fail' WHEN f > 0.56 THEN 'warn' ELSE 'pass' END AS future_flag FROM r),
    z AS (SELECT *, (status_flag = 'fail')::INT + (capacity_flag = 'fail')::INT + (future_flag = 'fail')::INT AS red FROM k)
    SELECT round(a, 6) AS null_status, round(b, 6) AS null_capacity, round(p, 6) AS placed_share, round(f, 6) AS future_share, status_flag, capacity_flag, place_flag, future_flag, red, CASE WHEN red >= 2 THEN 'RED - HOLD' WHEN red = 1 THEN 'YELLOW - INVESTIGATE' ELSE 'GREEN - PROCEED' END AS recommendation FROM z""")
def dq_11_quality_report(spark, sf):
    return rounded(validation.quality_report(_suites(spark, sf)).drop("suites", "yellow"), "null_status", "null_capacity", "placed_share", "future_share", places=6)


@query("""WITH s AS (SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 'polygon' WHEN 1 THEN 'no_match' WHEN 2 THEN 'missing coordinates' END AS kind, CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate END AS land, CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate END AS mw, o_totalprice AS amount, o_orderkey % 6 AS acres, o_orderkey % 3 AS c FROM orders)
    SELECT count(*) AS sites, count_if(kind = 'polygon')::BIGINT AS with_parcel, count(land) AS with_land_date, count(mw) AS with_first_mw, count_if(land IS NOT NULL AND mw IS NOT NULL)::BIGINT AS with_timeline, count_if(acres > 0)::BIGINT AS with_price,
        count_if(c = 0)::BIGINT AS hyperscaler_owned, count_if(c = 1)::BIGINT AS developer_owned, count_if(c = 2)::BIGINT AS ownership_unknown FROM s""")
def agg_43_ownership(spark, sf):
    k = F.col("o_orderkey")
    sites = table(spark, sf, "orders").select(
        F.when(k % 4 == 0, "polygon").when(k % 4 == 1, "no_match").when(k % 4 == 2, "missing coordinates").alias("match_type"), F.when(k % 3 > 0, F.col("o_orderdate")).alias("land_date"), F.when(k % 5 > 0, F.col("o_orderdate")).alias("first_mw_date"),
        F.col("o_totalprice").alias("amount"), (k % 6).cast("double").alias("acres"), F.lit("Google").alias("company"), F.when(k % 3 == 0, "ALPHABET LAND").when(k % 3 == 1, "Vantage West").otherwise("Farm").alias("entity"), F.lit(None).cast("string").alias("buyer"),
    )
    return validation.ownership_statistics(sites)


@query("""WITH f AS (SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN 'USA' WHEN 1 THEN 'Japan' WHEN 2 THEN 'Germany' ELSE 'Atlantis' END AS country, c_acctbal AS mw FROM customer)
    SELECT count(*) AS "rows", count_if(k % 5 > 0)::BIGINT AS placed, count_if(country = 'USA')::BIGINT AS amer, count_if(country = 'Germany')::BIGINT AS emea, count_if(country = 'Japan')::BIGINT AS apac, count_if(country = 'Atlantis')::BIGINT AS other_country, count(DISTINCT k % 10) AS companies, count_if(k % 10 = 0)::BIGINT AS hyperscalers,
        count_if(mw > 0)::BIGINT AS with_capacity, round(sum(CASE WHEN mw > 0 THEN mw END), 2) AS total_mw, count(*) AS dated, strftime(min(DATE '2020-01-01' + (k % 900)::INT), '%Y-%m-%d') AS oldest, strftime(max(DATE '2020-01-01' + (k % 900)::INT), '%Y-%m-%d') AS newest,
        round(100 * count_if(k % 5 > 0) / count(*)::DOUBLE, 4) AS placed_pct, round(100 * count_if(mw > 0) / count(*)::DOUBLE, 4) AS capacity_pct FROM f""")
def agg_61_feed_profile(spark, sf):
    k = F.col("c_custkey")
    raw = table(spark, sf, "customer").select(
        F.when(k % 5 > 0, "30.5").otherwise("x").alias("lat"), F.lit("-90").alias("lon"), F.when(k % 4 == 0, "USA").when(k % 4 == 1, "Japan").when(k % 4 == 2, "Germany").otherwise("Atlantis").alias("country"),
        F.when(k % 10 == 0, "Google LLC").otherwise(F.concat(F.lit("Owner "), (k % 10).cast("string"))).alias("company"), F.format_number("c_acctbal", 6).alias("mw"), F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (k % 900).cast("int")), "yyyy-MM-dd").alias("day"),
    )
    made = validation.feed_profile(raw, "lat", "lon", "country", "company", "mw", "day")
    days = {c: F.date_format(c, "yyyy-MM-dd") for c in ("oldest", "newest")}
    return rounded(rounded(made.withColumns(days), "total_mw", places=2), "placed_pct", "capacity_pct")


@query("SELECT o_orderpriority AS quarter, count(*) AS n, round(100 * count(*) / (SELECT count(*) FROM orders)::DOUBLE, 4) AS pct, sum(CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE 1 END)::DOUBLE AS net FROM orders GROUP BY 1")
def agg_63_quarter_profile(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("quarter"), F.when(F.col("o_orderkey") % 3 == 0, "-1").otherwise("1").alias("quantity"))
    return rounded(validation.quarter_profile(o, "quarter"), "pct")


@query("""SELECT 'orders' AS feed, (SELECT count(*) FROM orders) AS "rows", 6 AS fields, '' AS building_fields, '' AS campus_fields, 'Unknown' AS level UNION ALL SELECT 'sites', (SELECT count(*) FROM customer), 2, '', 'site_name', 'Campus'
    UNION ALL SELECT 'mixed', (SELECT count(*) FROM supplier), 2, 'bldg_no', 'campus_name', 'Mixed'""")
def dq_05_feed_audit(spark, sf):
    sites = table(spark, sf, "customer").select(F.col("c_name").alias("site_name"), "c_acctbal")
    mixed = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("bldg_no"), F.col("s_name").alias("campus_name"))
    return validation.feed_audit({"orders": table(spark, sf, "orders"), "sites": sites, "mixed": mixed})


@query(f"""{B}, x AS (SELECT id % 301 AS ucid, source, record_level FROM b) SELECT 'levels' AS part, source AS k, count_if(record_level = 'Building')::BIGINT AS n FROM x GROUP BY source
    UNION ALL SELECT 'cross_source', ucid::VARCHAR, count(DISTINCT source) FROM x GROUP BY ucid HAVING count(DISTINCT source) > 1 UNION ALL SELECT 'orphans', ucid::VARCHAR, 1 FROM (SELECT DISTINCT ucid FROM x) WHERE ucid >= 250 UNION ALL SELECT 'orphans', k::VARCHAR, 1 FROM range(250) g(k) WHERE k NOT IN (SELECT ucid FROM x) UNION ALL SELECT 'feeds', 'raw', count(*) FROM b""")
def dq_06_validation_suite(spark, sf):
    b = buildings(spark, sf).withColumns({"ucid": F.col("id") % 301, "country": F.lit("x"), "state": F.lit("x"), "state_abbr": F.lit("xx")})
    keys = spark.range(250).select(F.col("id").alias("ucid"))
    out = validation.validation_suite("all", {"raw": b}, b, keys)
    row = lambda part, k, n: out[part].select(F.lit(part).alias("part"), F.col(k).cast("string").alias("k"), n.cast("long").alias("n"))
    made = row("levels", "source", F.col("Building")).unionByName(row("cross_source", "ucid", F.col("sources")))
    return made.unionByName(row("orphans", "k", F.lit(1))).unionByName(row("feeds", "feed", F.col("rows")))


@query("""SELECT 0 AS place, 'p_partkey' AS field, 'bigint' AS kind, count(p_partkey) AS filled, min(p_partkey::VARCHAR) AS least, max(p_partkey::VARCHAR) AS largest FROM part UNION ALL SELECT 1, 'p_name', 'string', count(p_name), min(p_name), max(p_name) FROM part
    UNION ALL SELECT 2, 'p_brand', 'string', count(p_brand), min(p_brand), max(p_brand) FROM part UNION ALL SELECT 3, 'p_type', 'string', count(p_type), min(p_type), max(p_type) FROM part UNION ALL SELECT 4, 'p_size', 'int', count(p_size), min(p_size::VARCHAR), max(p_size::VARCHAR) FROM part""")
def dq_07_schema_report(spark, sf):
    return validation.schema_report(table(spark, sf, "part").drop("p_retailprice"))


@query(f"{B} SELECT c AS company, count(*) AS n, CASE c WHEN 'Facebook' THEN 'Meta' WHEN 'amazon aws' THEN 'AWS' ELSE c END AS suggestion, c IN ('Facebook', 'amazon aws') AS differs FROM (SELECT CASE WHEN id % 5 = 0 THEN 'Facebook' WHEN id % 5 = 1 THEN 'amazon aws' ELSE company_clean END AS c FROM b) GROUP BY 1")
def dq_08_company_audit(spark, sf):
    k = F.col("id") % 5
    b = buildings(spark, sf).select(F.when(k == 0, "Facebook").when(k == 1, "amazon aws").otherwise(F.col("company_clean")).alias("company"))
    return validation.company_audit(b, "company")


@query("""SELECT * FROM (VALUES ('customer', 'key', 'c_custkey', 'bigint'), ('customer', 'key', 'c_nationkey', 'int'), ('customer', 'money', 'c_acctbal', 'double'), ('orders', 'key', 'o_orderkey', 'bigint'), ('orders', 'key', 'o_custkey', 'bigint'), ('orders', 'money', 'o_totalprice', 'double'), ('region', 'key', 'r_regionkey', 'int'), ('region', 'money', NULL, NULL)) v("table", wanted, field, kind)""")
def dq_09_field_search(spark, sf):
    return validation.field_search(spark, {n: table(spark, sf, n) for n in ("customer", "orders", "region")}, {"key": ["KEY"], "money": ["price", "acctbal"]})


@query("SELECT p FROM (VALUES ('c_custkey: bigint, not int'), ('c_phone: missing')) v(p)")
def dq_02_schema_problems(spark, sf):
    from pyspark.sql import types as T

    declared = T.StructType([T.StructField("c_custkey", T.IntegerType()), T.StructField("C_NAME", T.StringType()), T.StructField("c_phone", T.StringType())])
    return spark.createDataFrame([(p,) for p in quality.schema_problems(table(spark, sf, "customer"), declared)], "p string")


@query("SELECT * FROM (VALUES ('old', 'c_custkey'), ('old', 'c_name'), ('new', 's_name'), ('new', 's_suppkey')) v(side, field)")
def set_04_schema_diff(spark, sf):
    old, new = quality.schema_diff(table(spark, sf, "customer").select("c_custkey", "c_name"), table(spark, sf, "supplier").select("s_suppkey", "s_name"))
    return spark.createDataFrame([("old", c) for c in old] + [("new", c) for c in new], "side string, field string")


@query("""WITH e AS (SELECT event_id, event_type, value, event_id % 50 AS u FROM events)
    SELECT event_id, rank() OVER (PARTITION BY u ORDER BY value DESC) AS rank, dense_rank() OVER (PARTITION BY u ORDER BY value DESC) AS dense_rank, ntile(4) OVER (PARTITION BY u ORDER BY value DESC, event_id) AS bucket, count(*) OVER (PARTITION BY u ORDER BY value RANGE BETWEEN 5.0 PRECEDING AND CURRENT ROW) AS near_below FROM e""")
def win_10_ranks(spark, sf):
    e = table(spark, sf, "events").withColumn("u", F.col("event_id") % 50)
    return timeseries.ranked(e, ["u"], "value", "event_id", 4, 5.0).select("event_id", "rank", "dense_rank", "bucket", "near_below")


# --- consensus


@query(f"{B}, o AS (SELECT *, CASE source " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(C.FIELD_AUTHORITY["latitude"])) + " END AS p FROM (SELECT id % 60 AS ucid, source, min(company_clean) AS company_clean, min(region) AS region, min(campus_name) AS campus_name FROM b GROUP BY 1, 2)) SELECT ucid, arg_min(campus_name, p) AS campus_name, arg_min(company_clean, p) AS company_clean, arg_min(region, p) AS region, arg_min(source, p) AS identity_source FROM o GROUP BY 1")
def con_12_representative(spark, sf):
    rows = buildings(spark, sf).groupBy((F.col("id") % 60).alias("ucid"), "source").agg(*(F.min(c).alias(c) for c in ("company_clean", "region", "campus_name")))
    return consensus.representative(rows).select("ucid", "campus_name", "company_clean", "region", "identity_source")


_GEO = "CASE source " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(C.FIELD_AUTHORITY["latitude"])) + " END"


def _sources(spark, sf):
    b = buildings(spark, sf).groupBy((F.col("id") % 400).alias("ucid"), "source")
    made = b.agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"), F.min("company_clean").alias("company_clean"), F.sum(F.floor("full_capacity_mw")).cast("double").alias("full_capacity_mw"), F.lit("2024-01-20").cast("timestamp").alias("data_vintage"))
    return made.withColumn("latitude", F.when(F.col("ucid") % 3 > 0, F.col("latitude")).when(F.col("source") == "NPM", F.col("latitude")).otherwise(0.0))


@query(f"""{B}, g AS (SELECT id % 400 AS ucid, source, avg(latitude) AS y, avg(longitude) AS x FROM b GROUP BY 1, 2), u AS (SELECT * FROM g WHERE ucid % 3 > 0 OR source = 'NPM')
    SELECT ucid, arg_min(source, {_GEO}) AS geometry_source, round(arg_min(y, {_GEO}), 6) AS latitude, round(arg_min(x, {_GEO}), 6) AS longitude FROM u GROUP BY 1""")
def con_02_best_place(spark, sf):
    return rounded(consensus.consensus(_sources(spark, sf), AS_OF).select("ucid", "geometry_source", "latitude", "longitude"), "latitude", "longitude", places=6)


@query(f"""{B} SELECT (SELECT count(*) FROM (SELECT DISTINCT id % 400 FROM b WHERE (id % 400) % 3 > 0 OR source = 'NPM')) AS "rows", 0 AS repeated_ucids, true AS has_details""")
def con_07_checks(spark, sf):
    return consensus.consensus_checks(consensus.consensus(_sources(spark, sf), AS_OF)).select("rows", "repeated_ucids", (F.col("longest_details") > 2).alias("has_details"))


@query("SELECT * FROM (VALUES " + ", ".join(f"('{s}', {r})" for s, r in C.AUTHORITY.items()) + ") v(source, rank)")
def con_08_authority(spark, sf):
    """Sources of the buildings with the rank that the configuration gives them."""
    return buildings(spark, sf).select("source").distinct().withColumn("rank", S.look_up("source", C.AUTHORITY))


@query("SELECT NULL::VARCHAR AS problem WHERE false")
def con_09_config_problems(spark, sf):
    return spark.createDataFrame([(p,) for p in consensus.config_problems()], "problem string")


# --- clusters, sorts, samples, scope


@query(f"""{CLUSTERED} SELECT cluster, round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude, round(sum(uc_power_mw), 2) AS uc, round(sum(planned_power_mw), 2) AS planned,
    CASE WHEN coalesce(sum(uc_power_mw), 0) <> 0 OR coalesce(sum(planned_power_mw), 0) <> 0 THEN round(coalesce(sum(uc_power_mw), 0) + coalesce(sum(planned_power_mw), 0), 2) END AS planned_plus_uc_mw FROM g GROUP BY 1""")
def agg_05_derived_sums(spark, sf):
    """Sums with the rule for missing values, and the campus' representative point."""
    made = rollup.campus_rollup(clusters.proximity_clusters(buildings(spark, sf)), "cluster")
    out = made.select("cluster", "latitude", "longitude", F.col("uc_power_mw").alias("uc"), F.col("planned_power_mw").alias("planned"), "planned_plus_uc_mw")
    return rounded(rounded(out, "latitude", "longitude", places=6), "uc", "planned", "planned_plus_uc_mw", places=2)


@query(f"""{_SUITE}, d AS (SELECT building_key AS bk, min(dc_code) AS dc_code, count(*) AS n, sum(it_load) AS mw, min(st) AS st, max(y) AS y FROM s WHERE building_key IS NOT NULL GROUP BY 1)
    SELECT dc_code, count(*) AS building_count, sum(n)::BIGINT AS suite_count, round(sum(mw), 2) AS it_load_total, round(sum(CASE WHEN st = 'Complete Build' THEN mw ELSE 0 END), 2) AS complete_mw, count_if(n % 2 = 0)::BIGINT AS owned, count_if(n % 2 = 1)::BIGINT AS leased, avg(CASE WHEN y > 0 THEN y END)::DOUBLE AS latitude FROM d GROUP BY 1""")
def agg_08_truth_campuses(spark, sf):
    d = _suites(spark, sf).filter("building_key IS NOT NULL").groupBy("building_key").agg(F.min("dc_code").alias("dc_code"), F.count("*").alias("suite_count"), F.sum("it_load").alias("it_load_total"), F.min("new_build_status").alias("new_build_status"), F.max("latitude").alias("latitude"), F.max("longitude").alias("longitude"))
    d = d.withColumns({"owned_leased": F.when(F.col("suite_count") % 2 == 0, "Owned").otherwise("Leased"), "region_derived": F.lit("AMER")})
    made = rollup.buildings_to_campuses(d).select("dc_code", "building_count", "suite_count", "it_load_total", "complete_mw", "owned", "leased", "latitude")
    return rounded(made, "it_load_total", "complete_mw", places=2)


@query(f"{B} SELECT s AS state, count(*) AS n FROM (SELECT CASE id % 20 WHEN 0 THEN '0' WHEN 1 THEN '0.0' WHEN 2 THEN NULL ELSE 'S' || id % 19 END AS s FROM b) WHERE s IS NOT NULL AND s NOT IN ('0', '0.0') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def agg_25_states(spark, sf):
    k = F.col("id")
    state = F.when(k % 20 == 0, "0").when(k % 20 == 1, "0.0").when(k % 20 > 2, F.concat(F.lit("S"), (k % 19).cast("string")))
    return rollup.state_distribution(buildings(spark, sf).select(state.alias("state")), "state")


@query(f"{B} SELECT source, 'full_capacity_mw' AS field, count(full_capacity_mw) AS filled, round(min(full_capacity_mw), 2) AS least, round(max(full_capacity_mw), 2) AS largest, round(avg(full_capacity_mw), 4) AS mean FROM b GROUP BY 1")
def agg_32_source_statistics(spark, sf):
    made = rollup.completeness(buildings(spark, sf), ["full_capacity_mw"], ["source"]).select("source", "field", "filled", "least", "largest", "mean")
    return rounded(rounded(made, "least", "largest", places=2), "mean")


@query(f"{B} SELECT source, f AS field, count(*) AS \"rows\", coalesce(count_if(v > 0), 0)::BIGINT AS n, round(sum(CASE WHEN v > 0 THEN v END), 2) AS mw FROM (SELECT source, 'commissioned_power_mw' AS f, commissioned_power_mw AS v FROM b UNION ALL SELECT source, 'uc_power_mw', uc_power_mw FROM b) GROUP BY 1, 2")
def agg_36_capacity_by_source(spark, sf):
    return rounded(rollup.positive_coverage(buildings(spark, sf), ["commissioned_power_mw", "uc_power_mw"], "source"), "mw", places=2)


@query(f"""WITH RECURSIVE t AS ({TRUTH}), e AS (SELECT x.id AS u, y.id AS v FROM t x JOIN t y ON x.company_clean = y.company_clean AND x.id <> y.id AND {dist('x', 'y')} <= 100), r(id, z) AS (SELECT id, id FROM t UNION SELECT r.id, e.v FROM r JOIN e ON r.z = e.u), k AS (SELECT id, min(z) AS cluster FROM r GROUP BY id)
    SELECT cluster, company_clean, count(*) AS parcels, round(sum(load), 2) AS acres FROM t JOIN k USING (id) GROUP BY 1, 2""")
def agg_47_dissolved(spark, sf):
    p = truth(spark, sf).withColumns({"computed_acres": F.col("load"), "change_date": F.lit(None).cast("date")})
    return rounded(land.dissolved(p).select("cluster", "company_clean", "parcels", "acres"), "acres", places=2)


@query(f"{B} SELECT layer, company AS company_clean_filter, count(*) AS n FROM (SELECT 'building' AS layer, CASE WHEN id % 2 = 0 THEN 'x' ELSE 'y' END AS company FROM b UNION ALL SELECT 'campus', 'x' FROM t) GROUP BY 1, 2")
def agg_60_layer_summary(spark, sf):
    b = buildings(spark, sf).withColumn("company_clean_filter", F.when(F.col("id") % 2 == 0, "x").otherwise("y"))
    return rollup.layer_summary(rollup.combined_layer(b, truth(spark, sf).select("id", F.lit("x").alias("company_clean_filter"))))


_LOOSE = CLUSTERED.replace("<= 250", "<= 1000")


@query(f"SELECT ({CLUSTERED} SELECT count(DISTINCT cluster) FROM g) AS tight, ({_LOOSE} SELECT count(DISTINCT cluster) FROM g) AS loose, (SELECT count(*) FROM customer) AS n")
def clu_09_tight_and_loose(spark, sf):
    from lodeframe.plans.workflows import tight_and_loose

    return tight_and_loose(buildings(spark, sf)).agg(F.countDistinct("tight_ucid").alias("tight"), F.countDistinct("loose_ucid").alias("loose"), F.count("*").alias("n"))


@query(f"{B} SELECT id, lower(concat_ws('|', company_clean, city, source)) AS native_id FROM b")
def clu_11_native_ids(spark, sf):
    return buildings(spark, sf).select("id", clusters.native_cluster("company_clean", "city", "source").alias("native_id"))


@query(f"{B} SELECT id, coalesce(CASE WHEN id % 3 = 0 THEN 'u' || id END, CASE WHEN id % 3 = 1 AND id % 2 = 0 THEN 'm' || id END, 'single_' || id) AS spatial_id FROM b")
def clu_12_spatial_ids(spark, sf):
    k = F.col("id")
    b = buildings(spark, sf).withColumns({"ucid": F.when(k % 3 == 0, F.concat(F.lit("u"), k)).otherwise(" "), "mapped": F.when((k % 3 == 1) & (k % 2 == 0), F.concat(F.lit("m"), k))})
    return b.select("id", clusters.spatial_cluster("ucid", "mapped", "id").alias("spatial_id"))


@query("WITH d AS (SELECT o_custkey AS k, o_orderkey AS i, CASE WHEN o_orderkey % 4 > 0 THEN o_orderdate END AS dy FROM orders) SELECT i, row_number() OVER (PARTITION BY k ORDER BY dy NULLS FIRST, i)::INT AS sequence FROM d")
def win_02_parcel_order(spark, sf):
    d = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("i"), F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderdate")).alias("at"))
    return land.ownership_chain(d, "k", "at", "i").select("i", "sequence")


@query(f"""{B}, q AS (SELECT id, company_clean, latitude, longitude FROM t), d AS (SELECT q.id AS l, b.id AS r, {dist('q', 'b')} AS d, q.company_clean = b.company_clean AS same FROM q JOIN b ON {dist('q', 'b')} <= 1000),
    s AS (SELECT l, r, round(d, 1) AS dm, round(CASE WHEN d > 250 AND NOT same THEN ((1 - d / 1000) * 0.5::DOUBLE) * 0.7::DOUBLE ELSE (1 - d / 1000) * 0.5::DOUBLE + CASE WHEN same THEN 0.3::DOUBLE ELSE 0 END END, 3) AS c FROM d)
    SELECT l AS left_id, r AS right_id, (row_number() OVER (PARTITION BY l ORDER BY c DESC, dm, r))::INT AS rank FROM s QUALIFY rank <= 4""")
def win_07_alternatives(spark, sf):
    none = F.lit(None).cast("string")
    asked = truth(spark, sf).select("id", F.col("company_clean").alias("company"), none.alias("city"), none.alias("campus_name"), "latitude", "longitude")
    known = buildings(spark, sf).select("id", F.col("campus_name").alias("canonical_name"), F.col("company_clean").alias("company"), "city", "latitude", "longitude")
    return matching.intake_scores(asked, known, top=4).select("left_id", "right_id", "rank")


@query(f"{B} SELECT t.id AS left_id, min(b.id) AS right_id, count(*) AS n FROM t JOIN b ON t.company_clean = b.company_clean AND b.campus_name = 'Customer#' || lpad((t.id + 3)::VARCHAR, 9, '0') GROUP BY 1")
def join_26_by_name(spark, sf):
    name = F.concat(F.lit("Customer#"), F.lpad((F.col("id") + 3).cast("string"), 9, "0"))
    nowhere = F.lit(None).cast("double")
    asked = truth(spark, sf).select("id", F.col("company_clean").alias("company"), F.lit(None).cast("string").alias("city"), name.alias("campus_name"), nowhere.alias("latitude"), nowhere.alias("longitude"))
    known = buildings(spark, sf).select("id", F.col("campus_name").alias("canonical_name"), F.col("company_clean").alias("company"), F.lit(None).cast("string").alias("city"), "latitude", "longitude")
    return matching.intake_scores(asked, known).groupBy("left_id").agg(F.min("right_id").alias("right_id"), F.count("*").alias("n"))


@query(f"{B} SELECT id FROM b WHERE id NOT IN (SELECT b.id FROM b JOIN t ON {dist('b', 't')} <= 60)")
def join_39_unmatched(spark, sf):
    b = buildings(spark, sf)
    near = spatial.band_join(b, truth(spark, sf), 60.0).select(F.col("left_id").alias("id"))
    return matching.unmatched(b, near, "id").select("id")


@query("SELECT event_id::VARCHAR AS task_id, status FROM (SELECT event_id, CASE event_type WHEN 'click' THEN 'In Progress' WHEN 'view' THEN 'Blocked' WHEN 'purchase' THEN 'Not Started' ELSE 'Done' END AS status, CASE event_id % 4 WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' WHEN 2 THEN 'Low' ELSE 'x' END AS priority FROM events) WHERE status <> 'Done' ORDER BY CASE status WHEN 'In Progress' THEN 0 WHEN 'Blocked' THEN 1 ELSE 2 END, CASE priority WHEN 'High' THEN 0 WHEN 'Medium' THEN 1 WHEN 'Low' THEN 2 ELSE 3 END, event_id::VARCHAR LIMIT 40")
def sort_07_active_tasks(spark, sf):
    kind, k = F.col("event_type"), F.col("event_id") % 4
    status = F.when(kind == "click", "In Progress").when(kind == "view", "Blocked").when(kind == "purchase", "Not Started").otherwise("Done")
    priority = F.when(k == 0, "High").when(k == 1, "Medium").when(k == 2, "Low").otherwise("x")
    tasks = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("task_id"), status.alias("status"), priority.alias("priority"))
    return timeseries.active_tasks(tasks, 40).select("task_id", "status")


@query(f"""{B}, x AS (SELECT id, CASE WHEN id % 7 > 0 THEN latitude END AS y, CASE WHEN id % 11 = 0 THEN 0 ELSE longitude END AS x FROM b) SELECT id FROM x WHERE y IS NOT NULL AND x IS NOT NULL""")
def pred_02_present(spark, sf):
    """Only missing coordinates are left out; a coordinate of 0 stays."""
    b = buildings(spark, sf).select("id", F.when(F.col("id") % 7 > 0, F.col("latitude")).cast("string").alias("latitude"), F.when(F.col("id") % 11 == 0, 0.0).otherwise(F.col("longitude")).cast("string").alias("longitude"))
    return readers.points(b).select("id")


@query(f"""{B}, x AS (SELECT id, CASE id % 6 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 91 ELSE latitude END AS y, CASE id % 6 WHEN 1 THEN 0 WHEN 3 THEN -181 ELSE longitude END AS x, latitude AS gy FROM b) SELECT CASE WHEN coalesce(y, CASE WHEN id % 12 = 0 THEN gy END) IS NULL THEN 'null' WHEN y = 0 AND x = 0 THEN 'zero' WHEN abs(y) > 90 OR abs(x) > 180 THEN 'out of range' ELSE 'ok' END AS bound, count(*) AS n FROM x GROUP BY 1""")
def pred_14_bounds(spark, sf):
    k = F.col("id") % 6
    y = F.when(k == 0, None).when(k == 1, 0.0).when(k == 2, 91.0).otherwise(F.col("latitude"))
    x = F.when(k == 1, 0.0).when(k == 3, -181.0).otherwise(F.col("longitude"))
    b = buildings(spark, sf).select(y.alias("y"), x.alias("x"), F.when(F.col("id") % 12 == 0, F.col("latitude")).alias("gy"), F.col("longitude").alias("gx"))
    return b.groupBy(quality.bound_class("y", "x", "gy", "gx").alias("bound")).agg(F.count("*").alias("n"))


_SCOPE = f"""{B}, x AS (SELECT id, CASE id % 4 WHEN 0 THEN 'Amazon' WHEN 1 THEN 'Google LLC' ELSE company_clean END AS co, CASE WHEN id % 3 = 0 THEN 'AMERICAS' ELSE region END AS rg, CASE WHEN id % 5 = 0 THEN 'Canada' ELSE 'Atlantis' END AS ct, CASE WHEN id % 7 = 0 THEN 'VA' END AS st, 2023 + id % 6 AS first, CASE id % 3 WHEN 0 THEN 'Building' WHEN 1 THEN 'TLBM_Colo' ELSE 'Campus' END AS lv FROM b),
    f AS (SELECT id, co IN ('Amazon', 'Google LLC') AS company_ok, contains(upper(rg), 'AMER') OR ct = 'Canada' OR coalesce(length(st) = 2, false) AS place_ok, first IN (2025, 2026, 2027) AS period_ok, CASE lv WHEN 'Building' THEN true WHEN 'TLBM_Colo' THEN false ELSE co IN ('Amazon', 'Google LLC') END AS type_ok FROM x)"""


def _scoped(spark, sf):
    k = F.col("id")
    years = {f"mw_{y}": F.when(2023 + k % 6 <= y, 1.0).otherwise(0.0) for y in range(2023, 2033)}
    return buildings(spark, sf).withColumns({
        "company_clean": F.when(k % 4 == 0, "Amazon").when(k % 4 == 1, "Google LLC").otherwise(F.col("company_clean")), "region": F.when(k % 3 == 0, "AMERICAS").otherwise(F.col("region")), "country": F.when(k % 5 == 0, "Canada").otherwise("Atlantis"),
        "state_abbr": F.when(k % 7 == 0, "VA"), "record_level": F.when(k % 3 == 0, "Building").when(k % 3 == 1, "TLBM_Colo").otherwise("Campus"), **years,
    })


@query(f"{_SCOPE} SELECT id, company_ok, place_ok, period_ok, type_ok, company_ok AND place_ok AND period_ok AND type_ok AS in_scope FROM f")
def pred_06_scope_flags(spark, sf):
    """Geography, period, type and company of the scope, each as a flag (PRED-6 to PRED-8)."""
    return land.in_scope(_scoped(spark, sf)).select("id", "company_ok", "place_ok", "period_ok", "type_ok", "in_scope")


@query(f"{_SCOPE} SELECT count(*) AS \"rows\", count_if(NOT company_ok)::BIGINT AS not_company_ok, count_if(NOT place_ok)::BIGINT AS not_place_ok, count_if(NOT period_ok)::BIGINT AS not_period_ok, count_if(NOT type_ok)::BIGINT AS not_type_ok, count_if(company_ok AND place_ok AND period_ok AND type_ok)::BIGINT AS in_scope FROM f")
def pred_09_scope_counts(spark, sf):
    return land.scope_counts(_scoped(spark, sf))


# --- scalars over table text


@query(f"""{B} SELECT id, concat_ws('|', replace(lower(company_clean), '_', '-'), coalesce(lower(city), ''), CASE WHEN id % 2 = 0 THEN trim(regexp_replace(lower(campus_name), '[^a-z0-9]+', '-', 'g'), '-') ELSE trim(regexp_replace(round(latitude, 4)::VARCHAR || ',' || round(longitude, 4)::VARCHAR, '[^a-z0-9]+', '-', 'g'), '-') END) AS k FROM b""")
def scal_09_hyphen_keys(spark, sf):
    b = buildings(spark, sf).withColumn("nm", F.when(F.col("id") % 2 == 0, F.col("campus_name")))
    return b.select("id", S.campus_key_hyphen("company_clean", "city", "nm", "latitude", "longitude").alias("k"))


@query(f"{B} SELECT id, 'meta|' || CASE WHEN id % 3 > 0 THEN regexp_replace(lower(region), '[^a-z0-9]+', '', 'g') ELSE 'unknown' END || '|' || CASE WHEN id % 2 = 0 THEN lower(replace(company_clean, '_', '')) ELSE 'unknown' END AS k FROM b")
def scal_10_code_keys(spark, sf):
    b = buildings(spark, sf)
    return b.select("id", S.campus_key_code("meta", F.when(F.col("id") % 2 == 0, F.col("company_clean")), F.when(F.col("id") % 3 > 0, F.col("region"))).alias("k"))


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-01') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y-01-01') END AS day FROM orders")
def scal_37_month_year(spark, sf):
    k, at = F.col("o_orderkey") % 3, F.col("o_orderdate")
    text = F.when(k == 0, F.date_format(at, "MM/yyyy")).when(k == 1, F.date_format(at, "MM/dd/yyyy")).otherwise(F.date_format(at, "yyyy"))
    return table(spark, sf, "orders").select("o_orderkey", F.date_format(S.any_date(text, S.MILESTONE_DATES), "yyyy-MM-dd").alias("day"))


_FIRST = "CASE " + " ".join(f"WHEN mw_{y} > 0 THEN {y}" for y in range(2023, 2029)) + " END"
_ALL_MW = ", ".join(f"sum(CASE WHEN year(l_shipdate) = {y} THEN l_extendedprice END) AS mw_{y + 30}" for y in range(1993, 1999))


@query(f"WITH y AS (SELECT l_suppkey AS id, {_ALL_MW} FROM lineitem GROUP BY 1) SELECT id, strftime(make_date(coalesce({_FIRST}, 2023), 1, 1), '%Y-%m-%d') AS january, strftime(make_date(CASE WHEN mw_2025 > 0 THEN 2025 WHEN mw_2026 > 0 THEN 2026 WHEN mw_2027 > 0 THEN 2027 END, 7, 1), '%Y-%m-%d') AS july FROM y")
def scal_41_first_mw_dates(spark, sf):
    y = orders_mw(spark, sf)
    january = S.first_mw_date(1, range(2023, 2029), F.lit("2023-01-01").cast("date"))
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return y.select("id", day(january).alias("january"), day(S.first_mw_date(7, (2025, 2026, 2027))).alias("july"))


@query(f"{B} SELECT id, full_capacity_mw AS adjusted, full_capacity_mw / 1.3::DOUBLE AS divided FROM b")
def scal_58_pue(spark, sf):
    b = buildings(spark, sf)
    return b.select("id", S.pue_adjusted("source", "full_capacity_mw", "full_capacity_mw").alias("adjusted"), S.pue_adjusted("source", "full_capacity_mw", "full_capacity_mw", dict.fromkeys(C.AUTHORITY, 1.3)).alias("divided"))


@query("""WITH x AS (SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN 'USA' WHEN 1 THEN 'Japan' WHEN 2 THEN 'Germany' END AS country, CASE WHEN c_custkey % 5 > 0 THEN 'AMER' END AS region, CASE c_custkey % 3 WHEN 0 THEN 'TX' WHEN 1 THEN 'Virginia' END AS st, CASE c_custkey % 2 WHEN 0 THEN 'CA' END AS ab FROM customer)
    SELECT k, coalesce(region, CASE country WHEN 'USA' THEN 'AMER' WHEN 'Japan' THEN 'APAC' WHEN 'Germany' THEN 'EMEA' END) AS region, CASE WHEN st = 'TX' THEN 'Texas' WHEN st IS NULL AND ab = 'CA' THEN 'California' ELSE st END AS state, CASE WHEN ab IS NULL THEN CASE st WHEN 'TX' THEN 'TX' WHEN 'Virginia' THEN 'VA' END ELSE ab END AS state_abbr FROM x""")
def scal_68_repairs(spark, sf):
    k = F.col("c_custkey")
    x = table(spark, sf, "customer").select(
        k.alias("k"), F.when(k % 4 == 0, "USA").when(k % 4 == 1, "Japan").when(k % 4 == 2, "Germany").alias("country"), F.when(k % 5 > 0, "AMER").alias("region"), F.when(k % 3 == 0, "TX").when(k % 3 == 1, "Virginia").alias("state"), F.when(k % 2 == 0, "CA").alias("state_abbr"),
    )
    return x.select("k", *(c.alias(n) for n, c in S.repaired_geography("country", "region", "state", "state_abbr").items()))
