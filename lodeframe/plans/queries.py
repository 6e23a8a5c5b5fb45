"""Queries over the driver's tables, one or more per operator family, each beside its SQL.

The tables hold no coordinates, so one projection gives customers and suppliers a place, a source, a
company and capacities. It is written once, in SQL that both engines read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeframe.functions import config as C
from lodeframe.functions import scalars as S
from lodeframe.operators import accuracy, clusters, consensus, land, matching, quality, rollup, spatial, timeseries
from lodeframe.sources import readers, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
AS_OF = "2024-02-01"

SOURCES = ("Meta Canonical", "Semianalysis", "DataCenterHawk", "DCH Lease", "NPM", "DataCenterMap")
_SOURCE = "CASE {k} % 6 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SOURCES)) + " END"
_PLACE = "CAST(30 AS DOUBLE) + ({k} % 37) * CAST(0.0011 AS DOUBLE) AS latitude, CAST(-90 AS DOUBLE) + ({k} % 41) * CAST(0.0013 AS DOUBLE) AS longitude"
_STATUS = "CASE c_mktsegment WHEN 'BUILDING' THEN 'Active' WHEN 'MACHINERY' THEN 'Under Construction' WHEN 'HOUSEHOLD' THEN 'Announced' WHEN 'FURNITURE' THEN 'Permitting' ELSE 'Unknown' END"
BUILDINGS = f"""
    SELECT c_custkey AS id, c_name AS unique_id, {_SOURCE.format(k='c_custkey')} AS source, n_name AS company_clean, r_name AS region, c_name AS campus_name,
           CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS city, {_PLACE.format(k='c_custkey')}, c_acctbal AS full_capacity_mw,
           CASE WHEN c_custkey % 3 = 0 THEN c_acctbal END AS commissioned_power_mw, CASE WHEN c_custkey % 3 = 1 THEN c_acctbal END AS uc_power_mw, CASE WHEN c_custkey % 3 = 2 THEN c_acctbal END AS planned_power_mw,
           {_STATUS} AS facility_status, CASE WHEN c_custkey % 7 = 0 THEN 'Campus' ELSE 'Building' END AS record_level
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
TRUTH = f"SELECT s_suppkey AS id, n_name AS company_clean, r_name AS region, {_PLACE.format(k='s_suppkey')}, s_acctbal AS load FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


def sql(spark: SparkSession, sf: str, text: str) -> DataFrame:
    """text over the folder's tables, which are named only inside this statement."""
    used = {t: spark.read.parquet(f"{sf}/{t}.parquet") for t in _TABLES if t in text}
    for t in used:
        text = re.sub(rf"\b{t}\b(?=\s+(?:JOIN|ON|WHERE|GROUP|ORDER|[a-z]\b)|\s*\)|\s*$)", "{" + t + "}", text)
    return spark.sql(text, **used)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def buildings(spark: SparkSession, sf: str) -> DataFrame:
    return sql(spark, sf, BUILDINGS)


def truth(spark: SparkSession, sf: str) -> DataFrame:
    return sql(spark, sf, TRUTH)


def of_source(df: DataFrame, i: int) -> DataFrame:
    return df.filter(F.col("source") == SOURCES[i])


def query(oracle: str | None = None):
    def named(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLE[f.__name__] = oracle
        return f

    return named


def dist(a: str, b: str) -> str:
    return (
        f"(2 * 6371000.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, pow(sin(radians({b}.latitude - {a}.latitude) / 2), 2) + cos(radians({a}.latitude)) * cos(radians({b}.latitude)) * pow(sin(radians({b}.longitude - {a}.longitude) / 2), 2)))))"
    )


WITH_B = f"WITH RECURSIVE b AS ({BUILDINGS}), t AS ({TRUTH})"
#: Clusters by closure over pairs within 250 m of one company.
CLUSTERED = f"""{WITH_B},
    e AS (SELECT x.id AS u, y.id AS v FROM b x JOIN b y ON x.company_clean = y.company_clean AND x.id <> y.id AND {dist('x', 'y')} <= 250),
    r(id, z) AS (SELECT id, id FROM b UNION SELECT r.id, e.v FROM r JOIN e ON r.z = e.u),
    k AS (SELECT id, min(z) AS cluster FROM r GROUP BY id),
    g AS (SELECT b.*, cluster FROM b JOIN k USING (id))"""
RANK = "CASE facility_status WHEN 'Active' THEN 1 WHEN 'Under Construction' THEN 2 WHEN 'Permitting' THEN 3 WHEN 'Announced' THEN 4 ELSE 7 END"
UNRANK = "CASE {} WHEN 1 THEN 'Active' WHEN 2 THEN 'Under Construction' WHEN 3 THEN 'Permitting' WHEN 4 THEN 'Announced' ELSE 'Unknown' END"


def rounded(df: DataFrame, *columns: str, places: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def orders_mw(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.groupBy(F.col("l_suppkey").alias("id")).agg(*(F.sum(F.when(F.year("l_shipdate") == y, F.col("l_extendedprice"))).alias(f"mw_{y + 30}") for y in range(1993, 1999)))


# --- clusters and roll-ups


@query(f"""{CLUSTERED}
    SELECT cluster, min(company_clean) AS company_clean, string_agg(DISTINCT source, '; ' ORDER BY source) AS sources, count(*) AS building_count, round(sum(full_capacity_mw), 2) AS full_capacity_mw, {UNRANK.format(f'min({RANK})')} AS status
    FROM g GROUP BY cluster""")
def flagship_campus_capacity(spark, sf):
    """Capacity by campus and status with contributing sources: pairs within 250 m, components, roll-up."""
    made = rollup.campus_rollup(clusters.proximity_clusters(buildings(spark, sf)), "cluster")
    return rounded(made.select("cluster", "company_clean", "sources", "building_count", "full_capacity_mw", F.col("facility_status_agg").alias("status")), "full_capacity_mw", places=2)


@query(f"{CLUSTERED} SELECT id, cluster FROM g")
def clu_01_components(spark, sf):
    return clusters.proximity_clusters(buildings(spark, sf)).select("id", "cluster")


@query(f"{CLUSTERED.replace('<= 250', '<= 1000')} SELECT id, cluster FROM g")
def clu_02_loose(spark, sf):
    return clusters.proximity_clusters(buildings(spark, sf), C.LOOSE_M).select("id", "cluster")


@query(f"""{CLUSTERED}, c AS (SELECT cluster, region, count(*) AS n FROM g GROUP BY ALL), m AS (SELECT cluster, arg_min(region, struct_pack(a := -n, b := region)) AS region FROM c GROUP BY cluster)
    SELECT cluster, 'UCID-' || region || '-' || lpad((row_number() OVER (PARTITION BY region ORDER BY cluster))::VARCHAR, 5, '0') AS ucid FROM m""")
def clu_04_numbered(spark, sf):
    return clusters.numbered(clusters.cluster_table(clusters.proximity_clusters(buildings(spark, sf)))).select("cluster", "ucid")


_NAMED = f"""{CLUSTERED},
    c AS (SELECT cluster, city, count(*) AS n FROM g WHERE city IS NOT NULL GROUP BY ALL), m AS (SELECT cluster, arg_min(city, struct_pack(a := -n, b := city)) AS city FROM c GROUP BY cluster),
    h AS (SELECT cluster, min(company_clean) AS company, round(avg(latitude), 7) AS lat, round(avg(longitude), 7) AS lon FROM g GROUP BY cluster),
    s AS (SELECT cluster, campus_name, count(*) AS n FROM g GROUP BY ALL), sm AS (SELECT cluster, arg_min(campus_name, struct_pack(a := -n, b := campus_name)) AS nm FROM s GROUP BY cluster),
    f AS (SELECT cluster, lat, lon, upper(substr(regexp_replace(company, '[^A-Za-z0-9]', '', 'g'), 1, 4)) AS code,
                 coalesce(substr(regexp_replace(upper(city), '[^A-Z0-9]+', '', 'g'), 1, 15), substr(regexp_replace(upper(nm), '[^A-Z0-9]+', '', 'g'), 1, 15)) AS name FROM h LEFT JOIN m USING (cluster) LEFT JOIN sm USING (cluster)),
    w AS (SELECT *, count(*) OVER p AS n, row_number() OVER (PARTITION BY code, name ORDER BY lon, lat, cluster) AS i, max(lon) OVER p - min(lon) OVER p AS dlon, max(lat) OVER p - min(lat) OVER p AS dlat, max(lat) OVER p AS top FROM f WINDOW p AS (PARTITION BY code, name)),
    u AS (SELECT cluster, concat_ws('-', code, name, CASE WHEN n = 2 THEN CASE WHEN dlon > dlat THEN CASE WHEN i = 1 THEN 'WEST' ELSE 'EAST' END ELSE CASE WHEN lat < top THEN 'SOUTH' ELSE 'NORTH' END END WHEN n > 2 THEN i::VARCHAR END) AS ucid FROM w)"""


@query(f"{_NAMED} SELECT cluster, ucid FROM u")
def clu_05_text_ids(spark, sf):
    return clusters.text_ids(clusters.proximity_clusters(buildings(spark, sf))).select("cluster", "ucid")


@query(f"""{_NAMED}, o AS (SELECT id, ucid, row_number() OVER (PARTITION BY ucid ORDER BY coalesce(commissioned_power_mw, 0) DESC, source, id) AS n FROM g JOIN u USING (cluster))
    SELECT id, ucid || '-' || CASE WHEN n < 10 THEN '0' ELSE '' END || n::VARCHAR AS building_ucid FROM o""")
def clu_08_building_ids(spark, sf):
    return clusters.with_ucids(buildings(spark, sf)).select("id", "building_ucid")


@query(f"""{CLUSTERED}, s AS (SELECT cluster, count(DISTINCT source) AS n, count(*) AS m, sum(full_capacity_mw) AS mw FROM g GROUP BY cluster)
    SELECT count(*) AS clusters, count_if(n = 1)::BIGINT AS single_source, count_if(n > 1)::BIGINT AS multi_source, round(avg(m), 4) AS mean_buildings, max(m) AS most_buildings, round(avg(mw), 2) AS mean_mw, round(max(mw), 2) AS most_mw FROM s""")
def agg_12_cluster_statistics(spark, sf):
    out = clusters.cluster_statistics(clusters.cluster_table(clusters.proximity_clusters(buildings(spark, sf))))
    return rounded(rounded(out, "mean_buildings"), "mean_mw", "most_mw", places=2)


@query(f"""{CLUSTERED}, s AS (SELECT cluster, list(DISTINCT source) AS l FROM g GROUP BY cluster)
    SELECT CASE WHEN list_contains(l, 'Meta Canonical') THEN 'VERIFIED' WHEN len(l) >= 3 THEN 'HIGH' WHEN len(l) = 2 THEN 'MEDIUM' ELSE 'LOW' END AS tier, count(*) AS campuses FROM s GROUP BY 1""")
def con_10_confidence_tiers(spark, sf):
    made = clusters.cluster_table(clusters.proximity_clusters(buildings(spark, sf)))
    return made.groupBy(clusters.confidence_tier(F.col("sources")).alias("tier")).agg(F.count("*").alias("campuses"))


@query(f"""{CLUSTERED}, s AS (SELECT cluster, string_agg(DISTINCT source, '; ' ORDER BY source) AS combination FROM g GROUP BY cluster)
    SELECT combination, count(*) AS campuses FROM s GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30""")
def agg_15_source_combinations(spark, sf):
    made = clusters.proximity_clusters(buildings(spark, sf)).groupBy("cluster").agg(rollup.joined_set("source").alias("combination"))
    return rollup.value_counts(made, "combination", 30).select("combination", F.col("n").alias("campuses"))


@query(f"""{WITH_B.replace('RECURSIVE ', '')}, x AS (SELECT t.id AS ref, b.id, b.source, b.region FROM t JOIN b ON {dist('t', 'b')} <= 500),
    c AS (SELECT ref, count(DISTINCT source) AS n_a, count(DISTINCT region) AS n_b FROM x GROUP BY ref)
    SELECT ref AS reference_id, n_a, n_b, CASE WHEN n_a = 1 AND n_b = 1 THEN 'TIE' WHEN n_a = 1 THEN 'A' WHEN n_b = 1 THEN 'B' ELSE 'BOTH_SPLIT' END AS verdict FROM c""")
def clu_10_agreement(spark, sf):
    near = spatial.band_join(truth(spark, sf), buildings(spark, sf), 500.0).select(F.col("left_id").alias("reference_id"), F.col("right_source").alias("native_id"), F.col("right_region").alias("spatial_id"))
    return clusters.cluster_agreement(near)


# --- joins

_PAIRS = f"{WITH_B.replace('RECURSIVE ', '')}, l AS (SELECT * FROM b WHERE source = 'Semianalysis'), r AS (SELECT * FROM b WHERE source = 'DataCenterHawk')"


@query(f"{_PAIRS} SELECT l.id AS left_id, r.id AS right_id, round({dist('l', 'r')}, 3) AS distance_m FROM l JOIN r ON {dist('l', 'r')} <= 250")
def join_11_distance_band(spark, sf):
    b = buildings(spark, sf)
    return spatial.band_join(of_source(b, 1), of_source(b, 2), 250.0).select("left_id", "right_id", F.round("distance_m", 3).alias("distance_m"))


_GREEDY = """, p AS (SELECT l.id AS left_id, r.id AS right_id, {d} AS d FROM l JOIN r ON {d} <= {m} {extra}),
    o AS (SELECT *, row_number() OVER (ORDER BY d, left_id, right_id) AS i FROM p),
    g(i, ls, rs, a, b) AS (SELECT 0::BIGINT, []::BIGINT[], []::BIGINT[], NULL::BIGINT, NULL::BIGINT
        UNION ALL SELECT o.i, CASE WHEN ok THEN list_append(ls, left_id) ELSE ls END, CASE WHEN ok THEN list_append(rs, right_id) ELSE rs END, CASE WHEN ok THEN left_id END, CASE WHEN ok THEN right_id END
        FROM (SELECT g.ls, g.rs, o.i, o.left_id, o.right_id, NOT list_contains(g.ls, o.left_id) AND NOT list_contains(g.rs, o.right_id) AS ok FROM g JOIN o ON o.i = g.i + 1) o)
    SELECT a AS left_id, b AS right_id FROM g WHERE a IS NOT NULL"""


@query(_PAIRS.replace("WITH b", "WITH RECURSIVE b") + _GREEDY.format(d=dist("l", "r"), m=250, extra=""))
def join_14_greedy(spark, sf):
    b = buildings(spark, sf)
    return matching.spatial_match(of_source(b, 1), of_source(b, 2), 250.0).select("left_id", "right_id")


@query(_PAIRS.replace("WITH b", "WITH RECURSIVE b") + _GREEDY.format(d=dist("l", "r"), m=500, extra="AND l.company_clean = r.company_clean"))
def join_15_greedy_company(spark, sf):
    b = buildings(spark, sf)
    return matching.spatial_match(of_source(b, 1), of_source(b, 2), 500.0, "company_clean").select("left_id", "right_id")


@query(f"""{_PAIRS} SELECT l.id AS left_id, r.id AS right_id, round(sqrt(pow(r.latitude - l.latitude, 2) + pow(r.longitude - l.longitude, 2)), 8) AS distance_deg
    FROM l JOIN r ON sqrt(pow(r.latitude - l.latitude, 2) + pow(r.longitude - l.longitude, 2)) <= 300 / 111000.0::DOUBLE""")
def join_17_planar(spark, sf):
    b = buildings(spark, sf)
    return spatial.planar_join(of_source(b, 1), of_source(b, 2), 300.0).select("left_id", "right_id", F.round("distance_deg", 8).alias("distance_deg"))


@query(f"""{WITH_B.replace('RECURSIVE ', '')}, d AS (SELECT t.id AS left_id, b.id AS right_id, {dist('t', 'b')} AS d FROM t JOIN b ON t.company_clean = b.company_clean AND {dist('t', 'b')} <= 2000)
    SELECT left_id, arg_min(right_id, struct_pack(d := d, i := right_id)) AS right_id, round(min(d), 3) AS distance_m FROM d GROUP BY left_id""")
def join_18_nearest_company(spark, sf):
    near = spatial.nearest(truth(spark, sf), buildings(spark, sf), 2000.0, ["company_clean"])
    return near.select("left_id", "right_id", F.round("distance_m", 3).alias("distance_m"))


@query(f"""{WITH_B.replace('RECURSIVE ', '')}, d AS (SELECT t.id AS left_id, b.source, b.id AS right_id, {dist('t', 'b')} AS d FROM t JOIN b ON {dist('t', 'b')} <= 50000)
    SELECT left_id, source, arg_min(right_id, struct_pack(d := d, i := right_id)) AS right_id, round(min(d), 3) AS distance_m FROM d GROUP BY left_id, source""")
def join_19_nearest_per_source(spark, sf):
    near = spatial.nearest(truth(spark, sf), buildings(spark, sf), 50_000.0, per=["right_source"])
    return near.select("left_id", F.col("right_source").alias("source"), "right_id", F.round("distance_m", 3).alias("distance_m"))


_BOX = "(SELECT n_nationkey AS polygon_id, n_name AS company, 30.00045::DOUBLE + (n_nationkey % 5) * 0.007 AS y0, -89.99965::DOUBLE + (n_nationkey % 4) * 0.011 AS x0 FROM nation)"


def _squares(spark, sf):
    y, x = F.lit(30.00045) + (F.col("n_nationkey") % 5) * 0.007, F.lit(-89.99965) + (F.col("n_nationkey") % 4) * 0.011
    corner = lambda dx, dy: F.concat_ws(" ", (x + dx).cast("string"), (y + dy).cast("string"))
    ring = F.concat_ws(", ", corner(0, 0), corner(0.0102, 0), corner(0.0102, 0.0062), corner(0, 0.0062), corner(0, 0))
    return readers.polygons(table(spark, sf, "nation").select(F.col("n_nationkey").alias("polygon_id"), F.col("n_name").alias("company"), F.concat(F.lit("POLYGON (("), ring, F.lit("))")).alias("geometry_wkt")))


@query(f"""{WITH_B.replace('RECURSIVE ', '')}, q AS {_BOX}
    SELECT t.id, q.polygon_id FROM t JOIN q ON t.latitude BETWEEN y0 AND y0 + 0.0062 AND t.longitude BETWEEN x0 AND x0 + 0.0102""")
def join_21_point_in_polygon(spark, sf):
    return spatial.point_in_polygon(truth(spark, sf), _squares(spark, sf)).select("id", "polygon_id")


@query(f"""{WITH_B.replace('RECURSIVE ', '')}, q AS {_BOX}, s AS (SELECT id, latitude, longitude, company_clean AS company FROM t),
    h AS (SELECT s.id, arg_min(polygon_id, struct_pack(o := (q.company <> s.company)::INT, p := polygon_id)) AS polygon_id FROM s JOIN q ON latitude BETWEEN y0 AND y0 + 0.0062 AND longitude BETWEEN x0 AND x0 + 0.0102 GROUP BY s.id),
    c AS (SELECT polygon_id AS id, company, y0 + 2 * 0.0062 / 5 AS latitude, x0 + 2 * 0.0102 / 5 AS longitude FROM q),
    n AS (SELECT s.id, c.id AS polygon_id, {dist('s', 'c')} AS d FROM s JOIN c ON s.company = c.company WHERE s.id NOT IN (SELECT id FROM h))
    SELECT id, polygon_id, 'polygon' AS method, 0.0::DOUBLE AS distance_m FROM h
    UNION ALL SELECT id, arg_min(polygon_id, struct_pack(d := d, p := polygon_id)), 'centroid', round(min(d), 3) FROM n WHERE d <= 1000 GROUP BY id""")
def join_22_parcel_match(spark, sf):
    return spatial.parcel_match(truth(spark, sf).withColumnRenamed("company_clean", "company"), _squares(spark, sf)).select("id", "polygon_id", "method", F.round("distance_m", 3).alias("distance_m"))


@query(f"""{WITH_B.replace('RECURSIVE ', '')}, q AS (SELECT id, company_clean AS company, CASE id % 3 WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'MACHINERY' END AS city, 'Customer#' || lpad((id + 3)::VARCHAR, 9, '0') AS campus_name,
        CASE WHEN id % 4 > 0 THEN latitude + 0.0004 END AS latitude, longitude AS longitude FROM t),
    d AS (SELECT q.id AS left_id, b.id AS right_id, {dist('q', 'b')} AS d, q.company = b.company_clean AS same, CASE WHEN q.campus_name = b.campus_name OR q.city = b.city THEN 1.0::DOUBLE ELSE 0.0 END AS text FROM q JOIN b ON {dist('q', 'b')} <= 1000),
    s AS (SELECT *, least(1.0, greatest(0, 1 - d / 1000) * 0.5::DOUBLE + CASE WHEN same THEN 0.3::DOUBLE ELSE 0 END + text * 0.2::DOUBLE) AS c FROM d),
    f AS (SELECT left_id, right_id, round(d, 1) AS distance_m, same AS company_match, round(CASE WHEN d > 250 AND NOT same THEN c * 0.7::DOUBLE ELSE c END, 3) AS confidence, 'SPATIAL' AS match_type FROM s
        UNION ALL SELECT q.id, b.id, NULL, true, 1.0, 'NAME' FROM q JOIN b ON q.company = b.company_clean AND q.latitude IS NULL AND (q.campus_name = b.campus_name OR q.city = b.city))
    SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY left_id ORDER BY confidence DESC, distance_m, right_id) = 1""")
def join_25_intake(spark, sf):
    city = F.when(F.col("id") % 3 == 0, "BUILDING").when(F.col("id") % 3 == 1, "MACHINERY")
    name = F.concat(F.lit("Customer#"), F.lpad((F.col("id") + 3).cast("string"), 9, "0"))
    asked = truth(spark, sf).select("id", F.col("company_clean").alias("company"), city.alias("city"), name.alias("campus_name"), F.when(F.col("id") % 4 > 0, F.col("latitude") + 0.0004).alias("latitude"), "longitude")
    known = buildings(spark, sf).select("id", F.col("campus_name").alias("canonical_name"), F.col("company_clean").alias("company"), "city", "latitude", "longitude")
    return matching.intake_match(asked, known).select("left_id", "right_id", "distance_m", "company_match", "confidence", "match_type")


@query(f"""{WITH_B.replace('RECURSIVE ', '')}, p AS (SELECT 30.01::DOUBLE AS latitude, -89.97::DOUBLE AS longitude) SELECT b.id, round({dist('p', 'b')}, 3) AS distance_m FROM p JOIN b ON {dist('p', 'b')} <= 1500 ORDER BY {dist('p', 'b')}, b.id LIMIT 10""")
def join_27_radius(spark, sf):
    return spatial.radius_search(buildings(spark, sf), 30.01, -89.97, 1500.0).select("id", F.round("distance_m", 3).alias("distance_m"))


@query(f"{WITH_B.replace('RECURSIVE ', '')} SELECT id, CASE WHEN EXISTS (SELECT 1 FROM t WHERE {dist('t', 'b')} <= 300) THEN 'Y' ELSE 'N' END AS near_reference FROM b")
def join_30_near_flag(spark, sf):
    return spatial.flag_near(buildings(spark, sf), truth(spark, sf), 300.0).select("id", "near_reference")


@query(f"{WITH_B.replace('RECURSIVE ', '')} SELECT x.company_clean, x.id AS left_id, y.id AS right_id, round({dist('x', 'y')}, 3) AS distance_m FROM t x JOIN t y ON x.company_clean = y.company_clean AND x.id < y.id")
def join_31_group_pairs(spark, sf):
    return spatial.group_pairs(truth(spark, sf), "company_clean").select("company_clean", "left_id", "right_id", F.round("distance_m", 3).alias("distance_m"))


@query(f"""{_PAIRS}, d AS (SELECT l.id AS i, r.id AS j, {dist('l', 'r')} AS d FROM l JOIN r ON {dist('l', 'r')} <= 2000), m(threshold_m) AS (VALUES (250.0::DOUBLE), (500.0::DOUBLE), (1000.0::DOUBLE), (2000.0::DOUBLE))
    SELECT threshold_m, count(*) AS pairs, count(DISTINCT i) AS left_rows, count(DISTINCT j) AS right_rows FROM m JOIN d ON d <= threshold_m GROUP BY 1""")
def join_41_thresholds(spark, sf):
    b = buildings(spark, sf)
    return spatial.threshold_overlap(of_source(b, 1), of_source(b, 2))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def join_01_semi(spark, sf):
    big = readers.table(spark, f"{sf}/orders.parquet", ["o_custkey"], "o_totalprice > 300000").withColumnRenamed("o_custkey", "c_custkey")
    return matching.in_set(table(spark, sf, "customer").select("c_custkey", "c_name"), big, "c_custkey")


@query("SELECT c_custkey AS k, 'left' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT DISTINCT o_custkey, 'right' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)")
def join_09_orphans(spark, sf):
    return matching.orphans(table(spark, sf, "customer").withColumnRenamed("c_custkey", "k"), table(spark, sf, "orders").withColumnRenamed("o_custkey", "k"), "k")


@query("""WITH a AS (SELECT o_custkey AS k, sum(o_totalprice) AS s FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), b AS (SELECT o_custkey AS k, sum(o_totalprice) AS s FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 1)
    SELECT k, round(coalesce(a.s, 0), 2) AS left_sum, round(coalesce(b.s, 0), 2) AS right_sum, abs(coalesce(a.s, 0) - coalesce(b.s, 0)) <= 1000 AS ok FROM a FULL JOIN b USING (k)""")
def join_07_totals(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), "o_orderkey", "o_totalprice")
    return rounded(matching.key_totals(o.filter("o_orderkey % 2 = 0"), o.filter("o_orderkey % 2 = 1"), "k", "o_totalprice", 1000.0), "left_sum", "right_sum", places=2)


@query("""WITH a AS (SELECT o_orderkey AS k, o_totalprice AS mw, o_orderstatus AS st FROM orders WHERE o_orderkey % 10 < 8), b AS (SELECT o_orderkey AS k, o_totalprice + CASE WHEN o_orderkey % 7 = 0 THEN 5 ELSE 0 END AS mw, CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus END AS st FROM orders WHERE o_orderkey % 10 > 1)
    SELECT k, CASE WHEN a.mw IS NULL THEN 'added' WHEN b.mw IS NULL THEN 'removed' WHEN abs(a.mw - b.mw) > 0.1 OR a.st <> b.st THEN 'changed' ELSE 'same' END AS change FROM a FULL JOIN b USING (k)""")
def join_08_snapshot_diff(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("mw"), F.col("o_orderstatus").alias("st"))
    new = o.filter("k % 10 > 1").withColumns({"mw": F.col("mw") + F.when(F.col("k") % 7 == 0, 5).otherwise(0), "st": F.when(F.col("k") % 11 == 0, "X").otherwise(F.col("st"))})
    return matching.snapshot_diff(o.filter("k % 10 < 8"), new, "k", {"mw": 0.1}, ["st"]).select("k", "change")


@query(f"""{_PAIRS}, x AS (SELECT company_clean, count(*) AS n, sum(full_capacity_mw) AS s, min(id) AS f FROM l GROUP BY 1), y AS (SELECT company_clean, count(*) AS n, sum(full_capacity_mw) AS s, min(id) AS f FROM r GROUP BY 1)
    SELECT company_clean, x.n AS left_rows, round(x.s, 2) AS left_full_capacity_mw, x.f AS left_first, y.n AS right_rows, round(y.s, 2) AS right_full_capacity_mw, y.f AS right_first,
           CASE WHEN y.n IS NULL THEN 'left' WHEN x.n IS NULL THEN 'right' ELSE 'both' END AS side FROM x FULL JOIN y USING (company_clean)""")
def join_10_key_match(spark, sf):
    b = buildings(spark, sf)
    return rounded(matching.key_match(of_source(b, 1), of_source(b, 2), "company_clean", "full_capacity_mw"), "left_full_capacity_mw", "right_full_capacity_mw", places=2)


@query("""WITH k AS (SELECT DISTINCT p_brand AS k FROM part), t AS (SELECT p_name AS nm, p_partkey AS v FROM part),
    s AS (SELECT k, min(CASE WHEN nm = k THEN v END) AS e, min(CASE WHEN lower(nm) = lower(k) THEN v END) AS l, arg_min(v, struct_pack(a := lower(nm), b := v)) FILTER (WHERE starts_with(lower(nm), lower(k))) AS p FROM k LEFT JOIN t ON starts_with(lower(nm), lower(k)) GROUP BY k)
    SELECT k, coalesce(e, l, p) AS v FROM s""")
def join_03_staged(spark, sf):
    p = table(spark, sf, "part")
    return matching.staged_look_up(p.select(F.col("p_brand").alias("k")).distinct(), p.select(F.col("p_name").alias("nm"), F.col("p_partkey").alias("v")), "k", "nm", "v").select("k", "v")


@query("""WITH m AS (SELECT o_orderpriority AS region, o_custkey % 50 AS loose, o_custkey % 100 AS tight FROM orders) SELECT loose, array_to_string(list_sort(list(DISTINCT tight)), ',') AS tight_ids FROM m GROUP BY loose HAVING count(DISTINCT tight) > 1""")
def join_32_nesting(spark, sf):
    m = table(spark, sf, "orders").select((F.col("o_custkey") % 50).alias("loose"), (F.col("o_custkey") % 100).alias("tight"))
    return matching.nested_ids(m, "tight", "loose").withColumn("tight_ids", F.array_join(F.col("tight_ids").cast("array<string>"), ","))


@query("SELECT l_orderkey AS k, arg_min(l_linenumber, struct_pack(d := l_discount, i := l_linenumber)) AS line FROM lineitem GROUP BY 1")
def join_38_closest(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_discount").alias("distance_m"), F.col("l_linenumber").alias("id"))
    return matching.closest_per_key(li, ["k"]).select("k", F.col("id").alias("line"))


# --- predicates, scans, sets, sorts


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderstatus = 'F'")
def scan_01_pruned(spark, sf):
    return readers.table(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_totalprice"], "o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderstatus = 'F'")


@query("SELECT p_partkey AS id, p_name AS name, CAST(p_size AS DOUBLE) AS size, NULL::VARCHAR AS absent FROM part")
def scan_13_resolver(spark, sf):
    odd = table(spark, sf, "part").withColumnsRenamed({"p_partkey": "F_id", "p_name": "?name", "p_size": "SIZE"})
    from pyspark.sql import types as T

    return readers.fields(odd, {"id": T.LongType(), "name": T.StringType(), "size": T.DoubleType(), "absent": T.StringType()})


@query(f"""{WITH_B.replace('RECURSIVE ', '')}, p AS (SELECT id, latitude - 30 AS y, longitude + 90 AS x FROM b)
    SELECT count_if(y <> 0 AND x <> 0)::BIGINT AS truthy, count_if(abs(y) <= 90 AND abs(x) <= 180 AND NOT (abs(y) < 0.01 AND abs(x) < 0.01))::BIGINT AS off_island FROM p""")
def pred_01_points(spark, sf):
    p = buildings(spark, sf).select((F.col("latitude") - 30).alias("y"), (F.col("longitude") + 90).alias("x"))
    return p.agg(F.count_if(S.truthy_point("y", "x")).alias("truthy"), F.count_if(S.valid_point("y", "x", 0.01)).alias("off_island"))


@query(f"{WITH_B.replace('RECURSIVE ', '')} SELECT id, 'building' AS layer, region, full_capacity_mw FROM b UNION ALL SELECT id, 'campus', region, NULL FROM t")
def set_01_combined(spark, sf):
    return rollup.combined_layer(buildings(spark, sf), truth(spark, sf).select("id", "region")).select("id", "layer", "region", "full_capacity_mw")


@query("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def set_03_intersect(spark, sf):
    c, s = table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")), table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k"))
    return matching.key_sets(c, s, "k").filter("side = 'both'").select("k")


@query("SELECT o_orderkey, round(abs(o_totalprice - 150000), 2) AS delta FROM orders ORDER BY abs(o_totalprice - 150000) DESC, o_orderkey LIMIT 25")
def sort_01_top_conflicts(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") - 150000).alias("delta_mw"))
    return accuracy.top_conflicts(o, "delta_mw", "o_orderkey").select("o_orderkey", F.round(F.abs("delta_mw"), 2).alias("delta"))


@query("SELECT l_returnflag, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey * 10 + l_linenumber) <= 25")
def sort_08_worst_per_group(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("key", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return accuracy.worst(li, "l_returnflag", "l_extendedprice", "key").select("l_returnflag", "l_orderkey", "l_linenumber")


@query("""WITH m AS (SELECT o_orderpriority AS s, round(avg(o_totalprice), 4) AS a, count(*) AS n FROM orders GROUP BY 1) SELECT arg_min(s, struct_pack(v := -n, s := s)) AS best_n, arg_min(s, struct_pack(v := a, s := s)) AS best_a FROM m""")
def sort_09_best_source(spark, sf):
    m = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("s")).agg(F.round(F.avg("o_totalprice"), 4).alias("a"), F.count("*").alias("n"))
    return accuracy.best_by_metric(m, "s", ["n"], ["a"])


@query("""WITH c AS (SELECT c_custkey AS id, c_mktsegment, md5(c_custkey || ':42') AS h FROM customer), r AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY h, id) AS r FROM c)
    SELECT id, c_mktsegment FROM r ORDER BY (r > CASE c_mktsegment WHEN 'BUILDING' THEN 20 WHEN 'MACHINERY' THEN 10 ELSE 0 END)::INT, h, id LIMIT 50""")
def samp_01_stratified(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_mktsegment")
    return timeseries.stratified_sample(c, ["c_mktsegment"], {("BUILDING",): 20, ("MACHINERY",): 10}, size=50)


# --- scalars

_P = "regexp_replace(lower({}), '[^a-z0-9]+', '{}', 'g')"


@query(f"""SELECT p_partkey, {_P.format('p_name', '')} AS plain, trim({_P.format("trim(replace(p_type, '&', ' and '))", '-')}, '-') AS hyphen, regexp_replace(upper(p_brand), '[^A-Z0-9]+', '', 'g') AS up FROM part""")
def scal_04_slugs(spark, sf):
    return table(spark, sf, "part").select("p_partkey", S.slug_plain("p_name").alias("plain"), S.slug_hyphen("p_type").alias("hyphen"), S.slug_upper("p_brand").alias("up"))


@query(f"""{WITH_B.replace('RECURSIVE ', '')} SELECT id, concat_ws('|', {_P.format('company_clean', '')}, coalesce({_P.format('city', '')}, ''), {_P.format('campus_name', '')}) AS k FROM b""")
def scal_08_campus_keys(spark, sf):
    return buildings(spark, sf).select("id", S.campus_key_plain("company_clean", "city", "campus_name", "latitude", "longitude").alias("k"))


@query("SELECT n_nationkey, upper(substr(regexp_replace(n_name, '[^A-Za-z0-9]', '', 'g'), 1, 4)) AS code FROM nation")
def scal_11_company_code(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", S.company_code("n_name").alias("code"))


_CO = "(VALUES " + ", ".join(f"({i}, '{n}')" for i, n in enumerate(("Amazon Web Services", "Meta Platforms", "google llc", "Equinix, Inc.", "Acme | Facebook", "Oracle (FKA Sun)", "Nobody Ltd", "DLR"))) + ")"
_CANON = ("AWS", "Meta", "Google", "Equinix", "Meta", "Oracle", "Nobody Ltd", "Digital Realty")


@query("SELECT c_custkey, CASE c_custkey % 8 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_CANON)) + " END AS company, CASE WHEN c_custkey % 8 IN (0, 1, 2, 4, 5) THEN CASE c_custkey % 8 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_CANON)) + f" END ELSE '{C.OTHER_COLO}' END AS label FROM customer")
def scal_14_canonical_company(spark, sf):
    names = F.array(*map(F.lit, ("Amazon Web Services", "Meta Platforms", "google llc", "Equinix, Inc.", "Acme | Facebook", "Oracle (FKA Sun)", "Nobody Ltd", "DLR")))
    c = table(spark, sf, "customer").select("c_custkey", S.canonical_company(F.get(names, (F.col("c_custkey") % 8).cast("int"))).alias("company"))
    # "Acme" is unknown, so the second company of its list counts
    return c.withColumn("label", S.company_filter("company"))


@query("SELECT p_partkey, CASE WHEN len(list_intersect(list_distinct(string_split(lower(p_name), ' ')), list_distinct(string_split(lower(p_type), ' ')))) = 0 THEN 0.0::DOUBLE ELSE round(len(list_intersect(list_distinct(string_split(lower(p_name), ' ')), list_distinct(string_split(lower(p_type), ' '))))::DOUBLE / len(list_distinct(list_concat(string_split(lower(p_name), ' '), string_split(lower(p_type), ' ')))), 6) END AS similarity FROM part")
def scal_20_token_similarity(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.round(S.token_similarity("p_name", "p_type"), 6).alias("similarity"))


@query(f"{WITH_B.replace('RECURSIVE ', '')} SELECT id, CASE WHEN coalesce(commissioned_power_mw, 0) > 0 THEN 'Active' WHEN coalesce(uc_power_mw, 0) > 0 THEN 'Under Construction' WHEN coalesce(planned_power_mw, 0) > 0 THEN 'Announced' ELSE 'Unknown' END AS status, {RANK}::INT AS r FROM b")
def scal_51_status(spark, sf):
    return buildings(spark, sf).select("id", S.status_of_capacity("commissioned_power_mw", "uc_power_mw", "planned_power_mw").alias("status"), S.status_rank("facility_status").cast("int").alias("r"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN strftime(o_orderdate, '%Y-01-01') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders")
def scal_36_any_date(spark, sf):
    text = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy"))
    return table(spark, sf, "orders").select("o_orderkey", F.date_format(S.any_date(text, S.GRID_DATES), "yyyy-MM-dd").alias("day"))


_YEARS = ", ".join(f"sum(CASE WHEN year(l_shipdate) = {y} THEN l_extendedprice END) AS mw_{y + 30}" for y in range(1993, 1999))


@query(f"WITH y AS (SELECT l_suppkey AS id, {_YEARS} FROM lineitem GROUP BY 1) SELECT id, (CASE " + " ".join(f"WHEN mw_{y} > 0 THEN {y}" for y in range(2023, 2029)) + " END)::INT AS first_year FROM y")
def scal_40_first_year(spark, sf):
    return orders_mw(spark, sf).select("id", S.first_mw_year(range(2023, 2029)).alias("first_year"))


@query("SELECT l_orderkey, l_linenumber, date_diff('day', o_orderdate::DATE, l_shipdate::DATE)::INT AS days, round(date_diff('day', o_orderdate::DATE, l_shipdate::DATE) / 30.44::DOUBLE, 1) AS months FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def scal_43_lag(spark, sf):
    both = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    made = S.lag("o_orderdate", "l_shipdate")
    return both.select("l_orderkey", "l_linenumber", made["days"].alias("days"), made["months"].alias("months"))


@query("""WITH p AS (SELECT c_custkey, (c_custkey % 181 - 90)::DOUBLE AS y, (c_custkey % 363 - 181)::DOUBLE AS x FROM customer)
    SELECT c_custkey, CASE WHEN y = 0 AND x = 0 THEN 'UNKNOWN' WHEN abs(y) > 90 OR abs(x) > 180 THEN 'INVALID' WHEN x BETWEEN -180 AND -30 THEN 'AMER' WHEN x BETWEEN -25 AND 65 THEN CASE WHEN y BETWEEN -35 AND 75 THEN 'EMEA' ELSE 'OTHER' END WHEN x > 65 AND x <= 180 THEN 'APAC' ELSE 'OTHER' END AS region FROM p""")
def scal_48_region(spark, sf):
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select("c_custkey", S.region_of_point((k % 181 - 90).cast("double"), (k % 363 - 181).cast("double")).alias("region"))


# --- aggregations


@query(f"""{WITH_B.replace('RECURSIVE ', '')}, f AS (SELECT source, count(*) AS n, count(city) AS city, count(commissioned_power_mw) AS mw FROM b GROUP BY source)
    SELECT source, 'city' AS field, round(100 * city / n::DOUBLE, 1) AS pct FROM f UNION ALL SELECT source, 'commissioned_power_mw', round(100 * mw / n::DOUBLE, 1) FROM f""")
def agg_23_completeness(spark, sf):
    return rollup.completeness(buildings(spark, sf), ["city", "commissioned_power_mw"], ["source"]).select("source", "field", "pct")


@query(f"""{WITH_B.replace('RECURSIVE ', '')}, f AS (SELECT source, round(100 * count(city) / count(*)::DOUBLE, 1) AS city, round(100 * count(uc_power_mw) / count(*)::DOUBLE, 1) AS mw FROM b GROUP BY source), l AS (SELECT source, 'city' AS field, city AS pct FROM f UNION ALL SELECT source, 'uc_power_mw', mw FROM f)
    SELECT field, arg_min(source, struct_pack(a := -pct, b := source)) AS best_source, max(pct) AS best_pct, string_agg(CASE WHEN pct > 0 THEN source END, ', ' ORDER BY source) AS sources_with_data FROM l GROUP BY field""")
def agg_34_best_source(spark, sf):
    return rollup.best_source_per_field(rollup.completeness(buildings(spark, sf), ["city", "uc_power_mw"], ["source"]))


@query(f"{WITH_B.replace('RECURSIVE ', '')} SELECT coalesce(city, '(null)') AS city, count(*) AS n FROM b GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3")
def agg_24_value_counts(spark, sf):
    return rollup.value_counts(buildings(spark, sf), "city", 3)


@query("SELECT o_custkey, count(*) AS n, count(*) - 1 AS surplus FROM orders GROUP BY 1 HAVING count(*) > 1")
def agg_28_duplicates(spark, sf):
    return rollup.duplicate_ids(table(spark, sf, "orders"), "o_custkey")


@query(f"""{WITH_B.replace('RECURSIVE ', '')} SELECT source, count_if(record_level = 'Building')::BIGINT AS "Building", count_if(record_level = 'Campus')::BIGINT AS "Campus" FROM b GROUP BY source""")
def agg_39_granularity(spark, sf):
    return rollup.pivot_counts(buildings(spark, sf), "source", "record_level", ["Building", "Campus"])


@query(f"""{WITH_B.replace('RECURSIVE ', '')}, c AS (SELECT company_clean, region, city, coalesce(sum(CASE WHEN source = 'Semianalysis' THEN full_capacity_mw END), max(full_capacity_mw)) AS mw FROM b GROUP BY ALL) SELECT company_clean, region, round(sum(mw), 2) AS mw, count(*) AS campuses FROM c GROUP BY 1, 2""")
def agg_21_peer_capacity(spark, sf):
    rows = buildings(spark, sf).select("company_clean", "region", "source", F.col("city").alias("ucid"), F.col("full_capacity_mw").alias("mw"))
    return rounded(rollup.peer_capacity(rows, "Semianalysis"), "mw", places=2)


@query(f"""{_PAIRS} SELECT region, count_if(s = 1)::BIGINT AS left_rows, count_if(s = 2)::BIGINT AS right_rows, round(sum(CASE WHEN s = 1 THEN m END), 2) AS left_full_capacity_mw, round(sum(CASE WHEN s = 2 THEN m END), 2) AS right_full_capacity_mw
    FROM (SELECT region, full_capacity_mw AS m, 1 AS s FROM l UNION ALL SELECT region, full_capacity_mw, 2 FROM r) GROUP BY region""")
def agg_18_geography(spark, sf):
    b = buildings(spark, sf)
    return rounded(rollup.two_way(of_source(b, 1), of_source(b, 2), "region", "full_capacity_mw"), "left_full_capacity_mw", "right_full_capacity_mw", places=2)


@query("""WITH s AS (SELECT o_custkey AS k, sum(o_totalprice) AS summed FROM orders GROUP BY 1) SELECT c_custkey AS k, round(c_acctbal, 2) AS stored, round(summed, 2) AS summed, abs(coalesce(summed, 0) - c_acctbal) * 100 <= 5 * greatest(abs(c_acctbal), 1e-9) AS ok FROM customer LEFT JOIN s ON k = c_custkey""")
def agg_42_building_check(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("v"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    return rounded(rollup.building_campus_check(o, c, "k", "v"), "stored", "summed", places=2)


@query("""SELECT user_id % 6 AS source, count(*) AS "rows", min(ts) AS oldest, max(ts) AS newest, date_diff('day', max(ts)::DATE, DATE '2024-02-01')::INT AS days_old FROM events GROUP BY 1""")
def agg_29_freshness(spark, sf):
    e = table(spark, sf, "events").select((F.col("user_id") % 6).alias("source"), F.col("ts").alias("data_vintage"))
    return quality.freshness(e, AS_OF).select("source", "rows", "oldest", "newest", "days_old")


@query("""SELECT round(coalesce(sum(CASE WHEN date_trunc('week', ts) = DATE '2024-01-15' THEN value END), 0), 4) AS this_week, round(coalesce(sum(CASE WHEN date_trunc('week', ts) = DATE '2024-01-08' THEN value END), 0), 4) AS last_week FROM events""")
def agg_50_weekly(spark, sf):
    return rounded(timeseries.weekly(table(spark, sf, "events"), "ts", "value", "2024-01-18"), "this_week", "last_week").select("this_week", "last_week")


_KINDS = ("click", "view", "purchase")


@query("""WITH w AS (SELECT (DATE '2024-01-29' - (i * 7)::INT)::DATE AS week FROM range(8) r(i)), s AS (SELECT date_trunc('week', ts)::DATE AS week, """ + ", ".join(f"sum(CASE WHEN event_type = '{k}' THEN value END) AS {k}" for k in _KINDS) + """ FROM events GROUP BY 1)
    SELECT w.week, """ + ", ".join(f"round(coalesce({k}, 0), 4) AS {k}" for k in _KINDS) + " FROM w LEFT JOIN s USING (week)")
def agg_52_rolling_weeks(spark, sf):
    return rounded(timeseries.rolling_weeks(table(spark, sf, "events"), "ts", "value", "event_type", _KINDS, "2024-01-31"), *_KINDS)


@query("WITH d AS (SELECT (DATE '2024-01-27' + i::INT)::DATE AS day FROM range(7) r(i)), s AS (SELECT ts::DATE AS day, sum(value) AS total FROM events GROUP BY 1) SELECT d.day, round(coalesce(total, 0), 4) AS total FROM d LEFT JOIN s USING (day)")
def agg_53_daily(spark, sf):
    return rounded(timeseries.daily(table(spark, sf, "events"), "ts", "value", "2024-01-27"), "total")


@query(f"""{WITH_B.replace('RECURSIVE ', '')}, s AS (SELECT source, count(*) AS n, round(100 * count(city) / count(*)::DOUBLE, 1) AS city, round(100 * count(full_capacity_mw) / count(*)::DOUBLE, 1) AS mw, round(100 * count(uc_power_mw) / count(*)::DOUBLE, 1) AS uc FROM b GROUP BY source),
    v AS (SELECT *, least(100, n / sum(n) OVER () * 500)::DOUBLE AS volume FROM s)
    SELECT source, round(volume * 0.10::DOUBLE + city * 0.20::DOUBLE + (mw + uc) / 2 * 0.20::DOUBLE + 100 * 0.15::DOUBLE + (city + mw + uc) / 3 * 0.10::DOUBLE, 4) AS final_score FROM v""")
def agg_31_source_scores(spark, sf):
    made = quality.source_scores(buildings(spark, sf), None, ["city"], ["full_capacity_mw", "uc_power_mw"], ["latitude", "longitude"], ["city", "full_capacity_mw", "uc_power_mw"], [])
    return made.select("source", F.round("final_score", 4).alias("final_score"))


# --- statistics


def _near_truth(spark, sf):
    """Buildings of all sources within 250 m of a reference row, beside its load."""
    near = spatial.band_join(truth(spark, sf), buildings(spark, sf), 250.0)
    return near.select(F.col("left_load").alias("load"), F.col("right_source").alias("source"), F.col("right_full_capacity_mw").alias("full_capacity_mw"))


_OK = "a > 0 AND p > 0"
_ACC = f"""count_if({_OK})::BIGINT AS n, CASE WHEN count_if({_OK}) >= 5 THEN round(avg(abs(a - p) / a) FILTER (WHERE {_OK}) * 100, 4) END AS mape, CASE WHEN count_if({_OK}) >= 5 THEN round(avg(p - a) FILTER (WHERE {_OK}), 4) END AS bias,
    CASE WHEN count_if({_OK}) >= 5 THEN round(sqrt(avg((p - a) * (p - a)) FILTER (WHERE {_OK})), 4) END AS rmse, CASE WHEN count_if({_OK}) >= 5 THEN round(corr(a, p) FILTER (WHERE {_OK}), 6) END AS r"""


@query(f"""{WITH_B.replace('RECURSIVE ', '')}, m AS (SELECT b.source, b.full_capacity_mw AS p, t.load AS a FROM b JOIN t ON {dist('t', 'b')} <= 250), s AS (SELECT source, {_ACC} FROM m GROUP BY source)
    SELECT *, CASE WHEN mape IS NULL THEN 'N/A' WHEN mape <= 10 THEN 'A' WHEN mape <= 20 THEN 'B' WHEN mape <= 35 THEN 'C' WHEN mape <= 50 THEN 'D' ELSE 'F' END AS grade FROM s""")
def stat_01_accuracy(spark, sf):
    m = _near_truth(spark, sf)
    out = accuracy.accuracy_by(m, ["source"], "load", "full_capacity_mw").select("source", "n", "mape", "bias", "rmse", "r", "grade")
    return rounded(rounded(out, "mape", "bias", "rmse"), "r", places=6)


@query(f"""{_PAIRS}, m AS (SELECT l.region, l.full_capacity_mw AS a, r.full_capacity_mw AS b FROM l JOIN r ON l.id + 1 = r.id), d AS (SELECT *, coalesce(a, 0) - coalesce(b, 0) AS d, CASE WHEN greatest(a, b) > 0 THEN abs(a - b) / greatest(a, b) * 100 ELSE 0 END AS pct FROM m)
    SELECT region, count_if(a > 0 AND b > 0)::BIGINT AS n, round(avg(CASE WHEN a > 0 AND b > 0 THEN abs(a - b) / greatest(a, b) END) * 100, 4) AS mape, round(sum(CASE WHEN a > 0 AND b > 0 THEN a - b END) / sum(CASE WHEN a > 0 AND b > 0 THEN b END) * 100, 4) AS bias,
           round(stddev_pop(abs(d)) / avg(abs(d)) * 100, 4) AS cv_abs, round(stddev_pop(d) / avg(abs(d)) * 100, 4) AS cv, round(avg(CASE WHEN pct < 20 THEN 1.0::DOUBLE ELSE 0 END) * 100, 4) AS agreement, count_if(pct >= 20 OR abs(d) >= 10)::BIGINT AS conflicts FROM d GROUP BY region""")
def stat_09_pair_statistics(spark, sf):
    b = buildings(spark, sf)
    m = of_source(b, 1).select("region", F.col("full_capacity_mw").alias("a"), (F.col("id") + 1).alias("k")).join(of_source(b, 2).select(F.col("id").alias("k"), F.col("full_capacity_mw").alias("b")), "k")
    out = accuracy.pair_statistics(m, "a", "b", ["region"]).select("region", "n", "mape", "bias", "cv_abs", "cv", "agreement", "conflicts")
    return rounded(out, "mape", "bias", "cv_abs", "cv", "agreement")


@query("""WITH l AS (SELECT o_orderpriority AS g, list_sort(list(o_totalprice)) AS v FROM orders GROUP BY 1) SELECT g, round(v[len(v) // 4 + 1], 2) AS q1, round(v[3 * len(v) // 4 + 1], 2) AS q3, round(list_median(v), 2) AS median, round(list_stddev_pop(v), 2) AS std FROM l""")
def stat_05_descriptive(spark, sf):
    out = accuracy.descriptive(table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "g"), "o_totalprice", ["g"]).select("g", "q1", "q3", "median", "std")
    return rounded(out, "q1", "q3", "median", "std", places=2)


@query("""WITH s(bin, low, high) AS (VALUES (0, 0.0::DOUBLE, 1000.0::DOUBLE), (1, 1000.0, 50000.0), (2, 50000.0, 200000.0), (3, 200000.0, 900000.0)) SELECT bin::INT AS bin, low, high, count(o_orderkey) AS n FROM s LEFT JOIN orders ON o_totalprice >= low AND o_totalprice < high GROUP BY 1, 2, 3""")
def stat_26_histogram(spark, sf):
    return accuracy.histogram(table(spark, sf, "orders"), "o_totalprice", [0, 1000, 50000, 200000, 900000])


_NEAR = f"""{WITH_B.replace('RECURSIVE ', '')}, d AS (SELECT t.id, t.region, b.source, min({dist('t', 'b')}) AS d FROM t JOIN b ON {dist('t', 'b')} <= 50000 GROUP BY ALL)"""


@query(f"""{_NEAR}, s AS (SELECT source, count(*) AS n, median(d) AS median, quantile_cont(d, 0.9) AS p90, count_if(d <= 100)::BIGINT AS within_100, stddev_samp(d) AS std FROM d GROUP BY source), o AS (SELECT source, median(abs(d - median)) AS mad FROM d JOIN s USING (source) GROUP BY source)
    SELECT source, n, round(median, 3) AS median, round(p90, 3) AS p90, within_100, round(std, 3) AS std, round(mad, 3) AS mad, round(n / (SELECT count(*) FROM t)::DOUBLE * 100, 1) AS recall FROM s JOIN o USING (source)""")
def stat_19_spatial_accuracy(spark, sf):
    out = accuracy.spatial_accuracy(truth(spark, sf), buildings(spark, sf).select("id", "source", "latitude", "longitude"))
    return rounded(out.select("source", "n", "median", "p90", "within_100", "std", "mad", "recall"), "median", "p90", "std", "mad", places=3)


@query(f"""{_NEAR}, s AS (SELECT region, count(*) AS total FROM t GROUP BY 1), f AS (SELECT region, source, count(*) AS found, median(d) AS median FROM d GROUP BY ALL), p AS (SELECT * FROM s, (SELECT DISTINCT source FROM d))
    SELECT region, source, total, coalesce(found, 0) AS found, round(median, 3) AS median, round(100 * coalesce(found, 0) / total::DOUBLE, 1) AS recall FROM p LEFT JOIN f USING (region, source)""")
def agg_59_regional_recall(spark, sf):
    t = truth(spark, sf)
    near = spatial.nearest(t, buildings(spark, sf), 50_000.0, per=["right_source"]).select(F.col("left_id").alias("id"), F.col("left_region").alias("region"), F.col("right_source").alias("source"), "distance_m")
    return rounded(accuracy.regional_recall(t, near).select("region", "source", "total", "found", "median", "recall"), "median", places=3)


@query(f"""{WITH_B.replace('RECURSIVE ', '')}, m AS (SELECT b.source, b.full_capacity_mw AS p, t.load AS a FROM b JOIN t ON {dist('t', 'b')} <= 250), g(factor) AS (VALUES (1.0::DOUBLE), (1.3::DOUBLE))
    SELECT source, factor, count_if(a > 0 AND p > 0)::BIGINT AS n, CASE WHEN count_if(a > 0 AND p > 0) >= 3 THEN round(avg(CASE WHEN a > 0 AND p > 0 THEN abs(a - p / factor) / a END) * 100, 4) END AS mape, round(avg(CASE WHEN a > 0 AND p > 0 THEN p / factor / a END), 4) AS ratio FROM m, g GROUP BY source, factor""")
def stat_29_variance_grid(spark, sf):
    m = _near_truth(spark, sf).withColumn("build_status", F.lit("x"))
    return rounded(accuracy.variance_grid(m, "load", ["full_capacity_mw"], [1.0, 1.3], ["all"]).select("source", "factor", "n", "mape", "ratio"), "mape", "ratio")


def _uniform(text: str) -> str:
    return f"((('0x' || substr(md5({text}), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)"


_POISSON = " + ".join(f"(u > {sum(math.exp(-1) / math.factorial(j) for j in range(k))!r}::DOUBLE)::INT" for k in range(1, 13))


@query(f"""WITH r AS (SELECT floor({_uniform("o_orderkey || ':row:42'")} * 1024)::INT AS block, o_totalprice AS v FROM orders), k AS (SELECT block, sum(v) AS s, count(*) AS c FROM r GROUP BY 1),
    d AS (SELECT *, {_uniform("block || ':' || b || ':42'")} AS u FROM k, range(1, 1001) g(b)), n AS (SELECT *, {_POISSON} AS n FROM d), m AS (SELECT b, sum(s * n) / sum(c * n) AS m FROM n GROUP BY b)
    SELECT round(avg(m), 3) AS mean, round(quantile_cont(m, 0.025), 3) AS low, round(quantile_cont(m, 0.975), 3) AS high FROM m""")
def stat_12_bootstrap(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("v"))
    return rounded(accuracy.bootstrap(o, "v"), "mean", "low", "high", places=3)


@query(f"""{WITH_B.replace('RECURSIVE ', '')}, p AS (SELECT city AS ucid, source, sum(full_capacity_mw) AS mw FROM b WHERE city IS NOT NULL GROUP BY 1, 2), c AS (SELECT ucid, count(*) AS n, stddev_pop(CASE WHEN mw > 0 THEN mw END) / avg(CASE WHEN mw > 0 THEN mw END) * 100 AS cv FROM p GROUP BY 1)
    SELECT 'other' AS tier, count(*) AS campuses, round(avg(n), 4) AS mean_sources, round(avg(cv), 4) AS mean_cv FROM c""")
def stat_23_consensus_metrics(spark, sf):
    rows = buildings(spark, sf).filter("city IS NOT NULL").withColumn("ucid", F.col("city"))
    return rounded(accuracy.consensus_metrics(rows).select("tier", "campuses", "mean_sources", "mean_cv"), "mean_sources", "mean_cv")


# --- consensus

_PRIO = "CASE source " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(C.FIELD_AUTHORITY["full_capacity_mw"])) + " END"
_PRIO_C = "CASE source " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(C.FIELD_AUTHORITY["company_clean"])) + " END"


def _per_source(spark, sf):
    b = buildings(spark, sf).withColumn("ucid", F.col("id") % 400)
    return b.groupBy("ucid", "source").agg(
        F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"), F.min("company_clean").alias("company_clean"), F.sum(F.floor("full_capacity_mw")).cast("double").alias("full_capacity_mw"), F.count("*").alias("building_count"), F.lit("2024-01-20").cast("timestamp").alias("data_vintage"),
    )


@query(f"""{WITH_B.replace('RECURSIVE ', '')}, p AS (SELECT id % 400 AS ucid, source, min(company_clean) AS company_clean, sum(floor(full_capacity_mw))::DOUBLE AS mw FROM b GROUP BY 1, 2)
    SELECT ucid, arg_min(company_clean, {_PRIO_C}) AS company_clean, arg_min(mw, {_PRIO}) FILTER (WHERE mw <> 0) AS full_capacity_mw, arg_min(source, {_PRIO}) FILTER (WHERE mw <> 0) AS full_capacity_mw_source, count(*) AS source_count, array_to_string(list_sort(list(DISTINCT source)), ';') AS sources FROM p GROUP BY ucid""")
def con_01_best_values(spark, sf):
    made = consensus.consensus(_per_source(spark, sf), AS_OF)
    return made.select("ucid", "company_clean", "full_capacity_mw", "full_capacity_mw_source", "source_count", F.array_join("sources", ";").alias("sources"))


@query(f"""{WITH_B.replace('RECURSIVE ', '')}, p AS (SELECT id % 400 AS ucid, source, sum(floor(full_capacity_mw))::DOUBLE AS mw FROM b GROUP BY 1, 2),
    c AS (SELECT ucid, count(*) AS n, bool_or(source = 'Meta Canonical') AS truth, bool_or(mw <> 0) AS has_mw, count(CASE WHEN mw > 0 THEN 1 END) AS k, avg(CASE WHEN mw > 0 THEN mw END) AS a, max(CASE WHEN mw > 0 THEN mw END) AS hi, min(CASE WHEN mw > 0 THEN mw END) AS lo FROM p GROUP BY ucid),
    g AS (SELECT *, CASE WHEN k < 2 THEN 0.5 WHEN greatest(hi - a, a - lo) / a < 0.1 THEN 1.0 WHEN greatest(hi - a, a - lo) / a < 0.2 THEN 0.8 WHEN greatest(hi - a, a - lo) / a < 0.5 THEN 0.5 ELSE 0.2 END::DOUBLE AS ag FROM c)
    SELECT ucid, round(least(n / 4.0::DOUBLE, 1) * 0.2::DOUBLE + CASE WHEN truth THEN 1.0 ELSE 0 END::DOUBLE * 0.3::DOUBLE + 0.25::DOUBLE + (CASE WHEN has_mw THEN 1.0 ELSE 0 END + 1.0)::DOUBLE / 4 * 0.15::DOUBLE + ag * 0.1::DOUBLE, 3) AS confidence_score FROM g""")
def con_04_confidence(spark, sf):
    return consensus.consensus(_per_source(spark, sf), AS_OF).select("ucid", "confidence_score")


@query("SELECT c_custkey AS unique_id, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') THEN 1 ELSE 0 END::INT AS is_essential FROM customer")
def con_11_essential(spark, sf):
    ids = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("unique_id"))
    return consensus.essential_flag(table(spark, sf, "customer").select(F.col("c_custkey").alias("unique_id")), ids)


# --- windows, land, quality, sinks


@query("""WITH w AS (SELECT o_orderkey, row_number() OVER p AS sequence, count(*) OVER (PARTITION BY o_custkey) AS chain_length, date_diff('day', lag(o_orderdate) OVER p, o_orderdate)::INT AS days_since FROM orders WINDOW p AS (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey))
    SELECT o_orderkey, sequence::INT AS sequence, chain_length, days_since, coalesce(days_since <= 730, false) AS flip FROM w""")
def win_01_ownership_chain(spark, sf):
    return land.ownership_chain(table(spark, sf, "orders"), "o_custkey", "o_orderdate", "o_orderkey").select("o_orderkey", "sequence", "chain_length", "days_since", "flip")


@query("SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v_carried FROM events")
def win_08_carry_forward(spark, sf):
    e = table(spark, sf, "events").withColumn("v", F.when(F.col("event_type") == "purchase", F.col("value")))
    return timeseries.carried_forward(e, "v", ["user_id"], ["ts", "event_id"]).select("event_id", "v_carried")


@query("WITH w AS (SELECT date_trunc('week', ts)::DATE AS week, sum(value) AS t FROM events GROUP BY 1) SELECT week, round(t, 4) AS total, round(t - lag(t) OVER (ORDER BY week), 4) AS change FROM w")
def win_09_week_over_week(spark, sf):
    return rounded(timeseries.week_over_week(table(spark, sf, "events"), "ts", "value"), "total", "change")


@query("""WITH d AS (SELECT o_orderpriority AS company, date_diff('day', o_orderdate::DATE, l_shipdate::DATE) AS days FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT company, 0::TINYINT AS is_total, count(days) AS n, round(avg(days), 4) AS mean_days, min(days)::INT AS least_days, max(days)::INT AS largest_days FROM d GROUP BY 1 UNION ALL SELECT NULL, 1, count(days), round(avg(days), 4), min(days), max(days) FROM d""")
def agg_45_lag_statistics(spark, sf):
    both = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rounded(land.lag_statistics(both.select(F.col("o_orderpriority").alias("company"), F.datediff("l_shipdate", "o_orderdate").alias("days")), "company"), "mean_days")


@query(f"""{WITH_B.replace('RECURSIVE ', '')} SELECT 'required city' AS "check", count_if(city IS NULL)::BIGINT AS failing, count(*) AS "rows" FROM b UNION ALL SELECT 'domain region', count_if(region NOT IN ('ASIA', 'EUROPE'))::BIGINT, count(*) FROM b
    UNION ALL SELECT unnest(['latitude in range', 'longitude in range', 'not at the origin', 'unique unique_id']), 0, count(*) FROM b""")
def dq_01_expectations(spark, sf):
    return quality.expectations(buildings(spark, sf), ["city"], {"region": ["ASIA", "EUROPE"]}).select("check", "failing", "rows")


@query("SELECT count(*) AS \"rows\", 5 AS columns, (SELECT count(*) - count(DISTINCT (c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment)) FROM customer) AS repeated_rows FROM customer")
def agg_62_profile(spark, sf):
    return quality.profile(table(spark, sf, "customer")).select("rows", "columns", "repeated_rows")


@query("SELECT o_orderkey, o_totalprice AS it_load, o_orderstatus AS new_build_status FROM orders WHERE o_totalprice > 100000 OR trim(o_orderstatus) <> ''")
def sink_16_filtered_copy(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("it_load"), F.col("o_orderstatus").alias("new_build_status"))
    return sinks.with_load(o)[0].filter("it_load > 100000 OR trim(new_build_status) <> ''")


@query("SELECT c_custkey, CASE WHEN o IS NULL THEN c_mktsegment ELSE o END AS c_mktsegment FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderpriority) AS o FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def sink_14_update(spark, sf):
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderpriority").alias("c_mktsegment"))
    return sinks.updated(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), o, "c_custkey", ["c_mktsegment"])


@query("""SELECT s_suppkey AS id, 'Feature' AS kind, 'Point' AS shape, round(-90 + (s_suppkey % 41) * 0.0013::DOUBLE, 6) AS x, round(30 + (s_suppkey % 37) * 0.0011::DOUBLE, 6) AS y, n_name AS company, round(s_acctbal, 2) AS load
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def sink_22_geojson(spark, sf):
    """Features as written, read again field by field."""
    part = lambda path, kind="string": F.get_json_object("value", f"$.{path}").cast(kind)
    return sinks.geojson(truth(spark, sf)).select(
        part("properties.id", "long").alias("id"), part("type").alias("kind"), part("geometry.type").alias("shape"), part("geometry.coordinates[0]", "double").alias("x"), part("geometry.coordinates[1]", "double").alias("y"),
        part("properties.company_clean").alias("company"), F.round(part("properties.load", "double"), 2).alias("load"),
    )
