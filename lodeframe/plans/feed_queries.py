"""Feeds, workflows and the remaining joins, aggregates and consensus parts over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodeframe.functions import config as C
from lodeframe.functions import stats
from lodeframe.operators import accuracy, clusters, consensus, land, matching, quality, rollup, spatial, timeseries, validation
from lodeframe.plans.queries import _GREEDY, AS_OF, BUILDINGS, TRUTH, WITH_B, buildings, dist, of_source, query, rounded, sql, table, truth
from lodeframe.sources import adapters, sinks

B = WITH_B.replace("RECURSIVE ", "")
_SIDES = f"{B}, l AS (SELECT * FROM b WHERE source = 'Semianalysis'), r AS (SELECT * FROM b WHERE source = 'DataCenterHawk')"


def _raw(spark, sf, **columns):
    """Customers as a raw feed of text columns, by expression."""
    c = sql(spark, sf, BUILDINGS)
    return c.select(*(F.expr(e).cast("string").alias(n) for n, e in columns.items()))


_HYPER = {
    "F_facility_id": "id", "company_name": "company_clean", "company_code": "CASE WHEN id % 2 = 0 THEN concat('A', id) ELSE 'None' END", "city": "coalesce(city, 'X')", "state": "CASE WHEN id % 3 = 0 THEN 'VA' ELSE 'texas' END", "latitude": "CASE WHEN id % 10 = 0 THEN 0 ELSE latitude END",
    "longitude": "longitude", "status": "CASE id % 4 WHEN 0 THEN 'Owned' WHEN 1 THEN 'Planned' WHEN 2 THEN 'Odd' END", "capacity_commissioned_power": "full_capacity_mw * 1000", "capacity_planned_power": "CASE WHEN id % 2 = 0 THEN 500 END", "commissioned_year": "1890 + id % 200",
}


@query(f"""{B} SELECT 'DCH_' || id AS unique_id, round(full_capacity_mw + CASE WHEN id % 2 = 0 THEN 0.5 ELSE 0 END, 4) AS full_capacity_mw, CASE id % 4 WHEN 0 THEN 'Active' WHEN 1 THEN 'Announced' ELSE 'Unknown' END AS facility_status,
    CASE WHEN id % 3 = 0 THEN 'VA' ELSE 'TX' END AS state_abbr, CASE WHEN 1890 + id % 200 > 1900 THEN 1890 + id % 200 END::INT AS live_year FROM b WHERE id % 10 <> 0""")
def proj_01_hyperscale(spark, sf):
    made = adapters.hyperscale(_raw(spark, sf, **_HYPER), AS_OF)
    return made.select("unique_id", F.round("full_capacity_mw", 4).alias("full_capacity_mw"), "facility_status", "state_abbr", F.year("actual_live_date").alias("live_year"))


@query(f"""{B} SELECT 'DCH_L_' || id AS unique_id, 'Leased' AS owned_leased, CASE WHEN id % 2 = 0 THEN 'UPS: N+1' END AS notes, (id % 100)::DOUBLE AS available_power_kw, CASE WHEN id % 3 = 0 THEN 'Active' ELSE 'Unknown' END AS facility_status FROM b""")
def proj_02_lease(spark, sf):
    raw = _raw(spark, sf, **{"?facility_id": "id", "provider_name": "company_clean", "latitude": "latitude", "longitude": "longitude", "ups_redundancy": "CASE WHEN id % 2 = 0 THEN 'N+1' END", "capacity_available_power": "id % 100", "status": "CASE WHEN id % 3 = 0 THEN 'Leased' END"})
    return adapters.lease(raw, AS_OF).select("unique_id", "owned_leased", "notes", "available_power_kw", "facility_status")


@query(f"""{B} SELECT 'dcm_' || id AS unique_id, CASE WHEN id % 3 = 0 THEN nullif(id % 50, 0)::DOUBLE END AS commissioned_power_mw, CASE WHEN id % 3 = 1 THEN nullif(id % 50, 0)::DOUBLE END AS planned_power_mw, CASE WHEN id % 3 < 2 THEN nullif(id % 50, 0)::DOUBLE END AS full_capacity_mw,
    CASE id % 3 WHEN 0 THEN 'Active' WHEN 1 THEN 'Land Acquisition' ELSE 'Cancelled' END AS facility_status, CASE WHEN id % 2 = 0 THEN 'Building' ELSE 'Campus' END AS record_level FROM b""")
def proj_03_map(spark, sf):
    raw = _raw(spark, sf, id="id", name="CASE WHEN id % 2 = 0 THEN concat(campus_name, ' - Building 1') ELSE campus_name END", parent_id="0", company_name="company_clean", city="city", latitude="latitude", longitude="longitude", stage="CASE id % 3 WHEN 0 THEN 'Operational' WHEN 1 THEN 'Land Banked' ELSE 'Cancelled' END", power_mw="id % 50")
    made = adapters.map_site(raw, AS_OF)
    return made.select("unique_id", "commissioned_power_mw", "planned_power_mw", "full_capacity_mw", "facility_status", "record_level")


@query(f"""{B} SELECT 'npm_' || replace(replace(lower(campus_name), '#', ''), ' ', '-') AS unique_id, CASE WHEN id % 2 = 0 THEN 'Announced' ELSE 'Active' END AS facility_status, CASE WHEN id % 2 = 0 THEN 4 ELSE 1 END::INT AS status_rank_tmp, 'TX' AS state_abbr, 800.0::DOUBLE AS total_cost_usd_million FROM b""")
def proj_04_announcement(spark, sf):
    raw = _raw(spark, sf, Project="campus_name", Organizations="company_clean", Status="CASE WHEN id % 2 = 0 THEN 'Planned' ELSE 'Operational' END", Total_MWs="full_capacity_mw", State___Region="'Texas'", County="'Polk County'", Lat_Lon_Y="latitude", Lat_Lon_X="longitude", Cost="'USD 800M'")
    return adapters.announcement(raw, AS_OF).select("unique_id", "facility_status", "status_rank_tmp", "state_abbr", "total_cost_usd_million")


@query(f"""{B} SELECT 'SEMI_u' || id AS unique_id, CASE WHEN id % 3 = 0 THEN 'Under Construction' ELSE 'Announced' END AS facility_status, CASE WHEN id % 3 = 0 THEN 7.0::DOUBLE ELSE 9.0::DOUBLE END AS full_capacity_mw, CASE WHEN id % 5 = 0 THEN 'TLBM_Colo' ELSE 'Building' END AS record_level FROM b""")
def proj_05_forecast(spark, sf):
    raw = _raw(spark, sf, **{"Unique_ID": "concat('u', id)", "Lat": "latitude", "Long": "longitude", "Company": "company_clean", "City": "city", "Total under Construction MW": "CASE WHEN id % 3 = 0 THEN 7 END", "Total Planned MW": "CASE WHEN id % 3 <> 0 THEN 9 END", "record_level": "CASE WHEN id % 5 = 0 THEN 'TLBM_Colo' END"})
    return adapters.forecast(raw, AS_OF).select("unique_id", "facility_status", "full_capacity_mw", "record_level")


@query(f"""{B} SELECT 'OREN_' || id AS unique_id, CASE WHEN id % 2 = 0 THEN 1200.0::DOUBLE ELSE 0 END AS commissioned_power_mw, CASE WHEN id % 2 = 1 THEN 1200.0::DOUBLE ELSE 0 END AS planned_power_mw, CASE WHEN id % 2 = 0 THEN 'Active' ELSE 'Announced' END AS facility_status, '{C.OTHER_COLO}' AS company_clean_filter FROM b""")
def proj_06_grid(spark, sf):
    raw = _raw(spark, sf, **{"Data Center ID": "concat('or:data_center:', id)", "Name": "campus_name", "Data Center Status": "CASE WHEN id % 2 = 0 THEN 'Operating' ELSE 'Proposed' END", "Owner": "'Acme'", "Owner Type": "'Wholesale'", "Power Capacity (MW)": "'1,200'", "Latitude (Degrees)": "latitude", "Longitude (Degrees)": "longitude"})
    return adapters.grid(raw, AS_OF).select("unique_id", "commissioned_power_mw", "planned_power_mw", "facility_status", "company_clean_filter")


@query(f"""{B} SELECT 'WDMAC_' || id AS unique_id, CASE WHEN id % 2 = 0 THEN 2.0::DOUBLE ELSE 0 END AS uc_power_mw, CASE WHEN id % 2 = 0 THEN 3.0::DOUBLE ELSE 5.0 END AS planned_power_mw, 6.0::DOUBLE AS full_capacity_mw, CASE WHEN id % 4 = 0 THEN 'WoodMac_Project' ELSE 'Building' END AS record_level, 'EMEA' AS region FROM b""")
def proj_07_milestone(spark, sf):
    raw = _raw(spark, sf, id_site="id", site_name="campus_name", developer_name="company_clean", status="CASE WHEN id % 2 = 0 THEN 'Construction' ELSE 'Permitted' END", latitude="CASE WHEN id % 4 <> 0 THEN latitude END", longitude="longitude", existing_capacity__mw="1", development_capacity__mw="2", planned_capacity__mw="3", super_region="'Europe'")
    return adapters.milestone(raw, AS_OF).select("unique_id", "uc_power_mw", "planned_power_mw", "full_capacity_mw", "record_level", "region")


@query(f"""{B} SELECT 'MetaCanonical_' || id AS unique_id, 'meta|unknown|' || lower(substr(company_clean, 1, 3)) AS campus_id, CASE id % 3 WHEN 0 THEN 'Active' WHEN 1 THEN 'Under Construction' ELSE 'Unknown' END AS facility_status, round(CASE WHEN id % 3 = 1 THEN 0 ELSE full_capacity_mw END, 4) AS commissioned_power_mw FROM b""")
def proj_08_truth(spark, sf):
    raw = _raw(spark, sf, building_key="id", dc_code="substr(company_clean, 1, 3)", new_build_status="CASE id % 3 WHEN 0 THEN 'Complete Build' WHEN 1 THEN 'Active Build' END", latitude="latitude", longitude="longitude", it_load_total="full_capacity_mw")
    return adapters.truth(raw, AS_OF).select("unique_id", "campus_id", "facility_status", F.round("commissioned_power_mw", 4).alias("commissioned_power_mw"))


@query(f"""{B} SELECT CASE WHEN id % 10 <> 0 THEN 'DataCenterHawk' END AS source, count(*) AS n FROM b WHERE id % 10 <> 0 GROUP BY 1 UNION ALL SELECT 'Orennia', count(*) FROM b""")
def set_06_multi_source(spark, sf):
    grid = _raw(spark, sf, **{"Data Center ID": "id", "Latitude (Degrees)": "latitude", "Longitude (Degrees)": "longitude"})
    return rollup.value_counts(adapters.ingest({"hyperscale": _raw(spark, sf, **_HYPER), "grid": grid}, AS_OF), "source")


# --- joins


@query(_SIDES.replace("WITH b", "WITH RECURSIVE b") + _GREEDY.format(d=dist("l", "r"), m=250, extra="").replace("SELECT a AS left_id, b AS right_id FROM g WHERE a IS NOT NULL", ", m AS (SELECT a, b FROM g WHERE a IS NOT NULL) SELECT 'pair' AS side, a AS id FROM m UNION ALL SELECT 'left', id FROM l WHERE id NOT IN (SELECT a FROM m) UNION ALL SELECT 'right', id FROM r WHERE id NOT IN (SELECT b FROM m)"))
def join_16_left_only(spark, sf):
    """Pairs, and the rows of either side without one, counted by matching the same sides in SQL."""
    b = buildings(spark, sf)
    found, left, right = matching.match_sides(of_source(b, 1), of_source(b, 2), 250.0)
    row = lambda df, side, c: df.select(F.lit(side).alias("side"), F.col(c).alias("id"))
    return row(found, "pair", "left_id").unionByName(row(left, "left", "id")).unionByName(row(right, "right", "id"))


@query(f"""{B}, p AS (SELECT t.id AS i, b.id AS j, {dist('t', 'b')} AS d, CASE WHEN t.company_clean = b.company_clean THEN 100 ELSE 0 END AS s, t.region = b.region AS a FROM t JOIN b ON {dist('t', 'b')} <= 1000),
    k AS (SELECT *, CASE WHEN d <= 250 AND s >= 95 THEN 2 WHEN d <= 500 AND s >= 85 THEN 3 WHEN a THEN 4 END AS tier FROM p UNION ALL SELECT t.id, b.id, 0, 100, true, 1 FROM t JOIN b ON t.id = b.id AND t.id % 5 = 0)
    SELECT i AS left_id, tier::INT AS tier FROM k WHERE tier IS NOT NULL QUALIFY row_number() OVER (PARTITION BY i ORDER BY tier, s DESC, d, j) = 1""")
def join_24_permit_tiers(spark, sf):
    sites = truth(spark, sf).select("id", F.when(F.col("id") % 5 == 0, F.concat(F.lit("p"), "id")).alias("permit_id"), F.col("company_clean").alias("developer"), "latitude", "longitude", F.col("region").alias("state_abbr"), F.lit("x").alias("county"))
    permits = buildings(spark, sf).select("id", F.concat(F.lit("p"), "id").alias("permit_id"), F.col("company_clean").alias("permit_holder"), "latitude", "longitude", F.col("region").alias("state"), F.lit("X").alias("county"))
    return matching.permit_tiers(sites, permits).select("left_id", "tier")


@query("SELECT c_custkey, c_custkey::VARCHAR AS k, min(s_suppkey) AS ucid FROM customer LEFT JOIN supplier ON c_custkey IN (s_suppkey, s_suppkey + 1, s_suppkey + 40) GROUP BY 1")
def join_04_mapped_keys(spark, sf):
    """Every supplier's list of three keys, lists overlapping."""
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("k"))
    lists = table(spark, sf, "supplier").select(F.concat_ws("; ", *((F.col("s_suppkey") + d).cast("string") for d in (0, 1, 40))).alias("ids"), F.col("s_suppkey").alias("ucid"))
    return matching.mapped_keys(c, lists, "k", "ids", "ucid").select("c_custkey", "k", "ucid")


@query("SELECT o_custkey AS id, CASE WHEN max(o_totalprice) > 400000 THEN 1 WHEN bool_or(o_orderstatus = 'P') THEN 2 ELSE 3 END::INT AS rank FROM orders GROUP BY 1")
def join_28_cascade(spark, sf):
    o = table(spark, sf, "orders").withColumn("id", F.col("o_custkey")).withColumn("match", F.lit("x"))
    return matching.cascade([(1, o.filter("o_totalprice > 400000")), (2, o.filter("o_orderstatus = 'P'")), (3, o)]).select("id", "rank")


@query("SELECT o_custkey AS k, arg_min(o_orderkey, struct_pack(n := (CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice END) IS NULL, d := CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice END, t := o_orderkey)) AS best FROM orders GROUP BY 1")
def join_42_unmatched_last(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 5 > 0, F.col("o_totalprice")).alias("distance_m"))
    return matching.closest_per_key(o, ["k"]).select("k", F.col("id").alias("best"))


# --- aggregates


@query("SELECT l_orderkey AS building_key, count(*) AS suite_count, round(sum(l_quantity), 2) AS it_load_total, arg_min(l_returnflag, struct_pack(n := l_linenumber, f := l_returnflag)) AS new_build_status FROM lineitem GROUP BY 1")
def agg_07_suites(spark, sf):
    s = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("building_key"), F.col("l_linenumber").alias("location_key"), F.lit("x").alias("dc_code"), F.lit("r").alias("region_derived"), F.col("l_returnflag").alias("new_build_status"), F.col("l_quantity").alias("it_load"), F.lit(1).alias("has_coordinates"))
    return rounded(rollup.suites_to_buildings(s).select("building_key", "suite_count", "it_load_total", "new_build_status"), "it_load_total", places=2)


_CITY = f"""{B}, c AS (SELECT id % 97 AS cluster, min(company_clean) AS company_clean, min(region) AS region, list_sort(list(DISTINCT source)) AS sources, sum(full_capacity_mw) AS mw, count(*) AS n FROM b GROUP BY 1),
    k AS (SELECT *, CASE WHEN list_contains(sources, 'Meta Canonical') THEN 'VERIFIED' WHEN len(sources) >= 3 THEN 'HIGH' WHEN len(sources) = 2 THEN 'MEDIUM' ELSE 'LOW' END AS tier FROM c)"""


def campuses(spark, sf):
    """97 groups of buildings as campuses with their sources."""
    g = buildings(spark, sf).groupBy((F.col("id") % 97).alias("cluster"))
    return g.agg(F.min("company_clean").alias("company_clean"), F.min("region").alias("region"), F.array_sort(F.collect_set("source")).alias("sources"), F.sum("full_capacity_mw").alias("full_capacity_mw"), F.count("*").alias("building_count"))


@query(f"{_CITY} SELECT tier, count(*) AS campuses, round(sum(mw), 2) AS mw, sum(n)::BIGINT AS buildings FROM k GROUP BY 1")
def agg_13_tiers(spark, sf):
    return rounded(clusters.confidence_distribution(campuses(spark, sf)), "mw", places=2)


@query(f"{_CITY} SELECT region, tier, count(*) AS campuses, round(sum(mw), 2) AS mw, sum(n)::BIGINT AS buildings FROM k GROUP BY 1, 2")
def agg_13_tiers_by_region(spark, sf):
    return rounded(clusters.confidence_distribution(campuses(spark, sf), ["region"]), "mw", places=2)


@query(f"{B} SELECT region, NULL AS company_clean, count(*) AS n FROM b GROUP BY region UNION ALL SELECT NULL, company_clean, count(*) FROM b GROUP BY company_clean")
def agg_16_grouping_sets(spark, sf):
    return rollup.counts_by_each(buildings(spark, sf), ["region", "company_clean"])


@query(f"{B} SELECT ucid, count(DISTINCT source) AS sources FROM (SELECT id % 301 AS ucid, source FROM b) GROUP BY 1 HAVING count(DISTINCT source) > 1 ORDER BY 2 DESC, 1 LIMIT 10")
def agg_40_cross_source(spark, sf):
    return validation.cross_source_ids(buildings(spark, sf).withColumn("ucid", F.col("id") % 301), top=10).select("ucid", "sources")


@query(f"{B} SELECT source, count_if(full_capacity_mw > 0)::BIGINT AS n, round(sum(CASE WHEN full_capacity_mw > 0 THEN full_capacity_mw END), 2) AS mw FROM b GROUP BY source")
def agg_35_capacity_coverage(spark, sf):
    made = rollup.positive_coverage(buildings(spark, sf), ["full_capacity_mw", "uc_power_mw"], "source").filter("field = 'full_capacity_mw'")
    return rounded(made.select("source", "n", "mw"), "mw", places=2)


@query("SELECT CASE WHEN d IS NULL THEN 'unknown' WHEN d < 0 THEN 'negative' WHEN d < 365 THEN 'under 1 year' WHEN d < 730 THEN '1-2 years' WHEN d < 1095 THEN '2-3 years' WHEN d < 1825 THEN '3-5 years' ELSE '5 years or more' END AS bucket, count(*) AS n FROM (SELECT date_diff('day', o_orderdate::DATE, DATE '1998-01-01') AS d FROM orders) GROUP BY 1")
def agg_44_buckets(spark, sf):
    o = table(spark, sf, "orders").select(land.lag_bucket(F.datediff(F.lit("1998-01-01").cast("date"), "o_orderdate")).alias("bucket"))
    return rollup.value_counts(o, "bucket")


@query(f"""WITH RECURSIVE t AS ({TRUTH}), e AS (SELECT x.id AS u, y.id AS v FROM t x JOIN t y ON x.company_clean = y.company_clean AND x.id <> y.id AND {dist('x', 'y')} <= 1000), r(id, z) AS (SELECT id, id FROM t UNION SELECT r.id, e.v FROM r JOIN e ON r.z = e.u), k AS (SELECT id, min(z) AS cluster FROM r GROUP BY id)
    SELECT cluster, count(*) AS parcels, round(sum(load), 2) AS acres FROM t JOIN k USING (id) GROUP BY cluster""")
def agg_46_parcel_campuses(spark, sf):
    p = truth(spark, sf).select("id", "company_clean", "latitude", "longitude", F.col("load").alias("computed_acres"), F.col("id").cast("string").alias("apn"), F.lit(None).cast("date").alias("change_date"), F.col("region").alias("state"), F.col("region").alias("county"))
    return rounded(land.parcel_campuses(p).select("cluster", "parcels", "acres"), "acres", places=2)


@query("WITH t AS (SELECT o_custkey AS apn, o_orderstatus AS entity FROM orders) SELECT apn, count(*) AS transactions, bool_or(entity = 'P') AS named FROM t GROUP BY 1 HAVING bool_or(entity = 'P') OR count(*) >= 12")
def agg_49_case_studies(spark, sf):
    t = table(spark, sf, "orders").select(F.col("o_custkey").alias("apn"), F.col("o_orderstatus").alias("entity"), F.col("o_orderdate").alias("transaction_date"))
    return land.case_studies(t, "^P$", 12).select("apn", "transactions", "named")


@query("SELECT event_type, round(sum(value), 4) AS hours FROM events WHERE date_trunc('week', ts) = DATE '2024-01-15' GROUP BY 1")
def agg_51_subcategories(spark, sf):
    return rounded(timeseries.hours_by(table(spark, sf, "events"), "ts", "value", "event_type", "2024-01-18"), "hours")


@query("WITH h AS (SELECT user_id::VARCHAR AS task_id, sum(value) AS hours FROM events GROUP BY 1) SELECT c_custkey::VARCHAR AS task_id, round(coalesce(hours, 0), 4) AS hours FROM customer LEFT JOIN h ON task_id = c_custkey::VARCHAR")
def agg_54_task_hours(spark, sf):
    tasks = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("task_id"), F.col("c_name").alias("title"))
    log = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("task_id"), F.col("value").alias("hours"))
    return rounded(timeseries.task_hours(tasks, log).select("task_id", "hours"), "hours")


@query("SELECT l_returnflag AS apn, string_agg(DISTINCT l_linestatus, ';' ORDER BY l_linestatus) AS statuses, count(*) AS n FROM lineitem GROUP BY 1")
def agg_02_joined_sources(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("apn")).agg(rollup.joined_set("l_linestatus", ";").alias("statuses"), F.count("*").alias("n"))


@query("SELECT o_custkey AS k, arg_min(o_clerk, o_orderkey) AS first_clerk FROM (SELECT o_custkey, o_orderkey, o_orderpriority AS o_clerk FROM orders) GROUP BY 1")
def agg_03_first_wins(spark, sf):
    o = table(spark, sf, "orders")
    return o.groupBy(F.col("o_custkey").alias("k")).agg(rollup.first_of("o_orderpriority", ["o_orderkey"]).alias("first_clerk"))


@query(f"""{B}, x AS (SELECT id % 301 AS ucid, source, CASE WHEN id % 9 > 0 THEN region END AS region, CASE WHEN id % 13 = 0 THEN 'Suite' ELSE record_level END AS record_level, CASE WHEN id % 4 > 0 THEN city END AS state,
        latitude + CASE WHEN id % 17 = 0 THEN 0.01 ELSE 0 END AS y, latitude, longitude FROM b), m AS (SELECT ucid FROM x GROUP BY 1 HAVING count(DISTINCT source) > 1)
    SELECT (SELECT count(*) FROM m) AS mixed_source_campuses, count_if(region IS NULL)::BIGINT AS no_region, count_if(record_level = 'Suite')::BIGINT AS odd_level, count_if(state IS NULL)::BIGINT AS no_state_name, count_if(abs(y - latitude) > 0.001)::BIGINT AS off_geometry,
        count_if(latitude = 0 OR longitude = 0 OR latitude IS NULL OR longitude IS NULL)::BIGINT AS unplaced FROM x""")
def dq_04_known_issues(spark, sf):
    b = buildings(spark, sf)
    odd = {
        "ucid": F.col("id") % 301, "region": F.when(F.col("id") % 9 > 0, F.col("region")), "record_level": F.when(F.col("id") % 13 == 0, "Suite").otherwise(F.col("record_level")), "country": F.lit("x"),
        "state": F.when(F.col("id") % 4 > 0, F.col("city")), "state_abbr": F.lit("xx"), "gold_lat": F.col("latitude") + F.when(F.col("id") % 17 == 0, 0.01).otherwise(0.0), "gold_lon": F.col("longitude"),
    }
    return quality.known_issues(b.withColumns(odd))


# --- statistics, consensus, windows, sinks


@query(f"""{_SIDES}, m AS (SELECT l.id % 4 AS k, abs(l.full_capacity_mw - r.full_capacity_mw) / greatest(l.full_capacity_mw, r.full_capacity_mw) AS e FROM l JOIN r ON l.id + 1 = r.id WHERE l.full_capacity_mw > 0 AND r.full_capacity_mw > 0),
    z AS (SELECT avg(CASE WHEN k = 0 THEN e END) * 100 AS h, avg(CASE WHEN k = 1 THEN e END) * 100 AS j, avg(CASE WHEN k > 1 THEN e END) * 100 AS o FROM m)
    SELECT round(h, 4) AS hyperscaler, round(j, 4) AS major_colo, round(o, 4) AS other, round((coalesce(h * 0.6::DOUBLE, 0) + coalesce(j * 0.3::DOUBLE, 0) + coalesce(o * 0.1::DOUBLE, 0)) / ((h IS NOT NULL)::INT * 0.6::DOUBLE + (j IS NOT NULL)::INT * 0.3::DOUBLE + (o IS NOT NULL)::INT * 0.1::DOUBLE), 4) AS weighted_mape FROM z""")
def stat_10_tier_weights(spark, sf):
    b = buildings(spark, sf)
    company = F.get(F.array(*map(F.lit, ("Google LLC", "Equinix, Inc.", "nobody", "Acme"))), (F.col("id") % 4).cast("int"))
    m = of_source(b, 1).select(F.col("full_capacity_mw").alias("a"), (F.col("id") + 1).alias("k"), company.alias("company")).join(of_source(b, 2).select(F.col("id").alias("k"), F.col("full_capacity_mw").alias("b")), "k")
    return rounded(accuracy.tier_weighted_mape(m, "company", "a", "b"), "hyperscaler", "major_colo", "other", "weighted_mape")


@query(f"""{B}, d AS (SELECT b.source, min({dist('t', 'b')}) AS d FROM t JOIN b ON {dist('t', 'b')} <= 50000 GROUP BY t.id, b.source)
    SELECT source, count_if(d <= 100)::BIGINT AS within_100, count_if(d <= 500)::BIGINT AS within_500, count_if(d < 1000)::BIGINT AS under_1km, count_if(d >= 1000 AND d < 3000)::BIGINT AS from_1_to_3km FROM d GROUP BY source""")
def stat_33_bands(spark, sf):
    near = spatial.nearest(truth(spark, sf), buildings(spark, sf), 50_000.0, per=["right_source"]).withColumnRenamed("right_source", "source")
    made = stats.within("distance_m") | stats.bands("distance_m")
    return near.groupBy("source").agg(*(made[k].alias(k) for k in ("within_100", "within_500", "under_1km", "from_1_to_3km")))


@query(f"""{B}, p AS (SELECT company_clean, sum(full_capacity_mw) OVER (PARTITION BY company_clean) AS total, full_capacity_mw AS v FROM b) SELECT company_clean, round(avg(v / total), 6) AS share FROM p GROUP BY 1""")
def stat_35_campus_share(spark, sf):
    return rounded(rollup.campus_share(buildings(spark, sf), "company_clean", "full_capacity_mw"), "share", places=6)


@query(f"""{B}, m AS (SELECT id % 400 AS ucid, source, max(floor(full_capacity_mw)) AS mw FROM b WHERE floor(full_capacity_mw) <> 0 GROUP BY 1, 2)
    SELECT ucid, array_to_string(list_sort(list(DISTINCT source)), ',') AS with_data, max(CASE WHEN source = 'Semianalysis' THEN mw END)::DOUBLE AS semi_mw, max(CASE WHEN source = 'Semianalysis' THEN 2 END)::INT AS semi_rank, max(CASE WHEN source = 'DataCenterHawk' THEN mw END)::DOUBLE AS hawk_mw FROM m GROUP BY 1""")
def con_03_details(spark, sf):
    b = buildings(spark, sf).withColumns({"ucid": F.col("id") % 400, "full_capacity_mw": F.floor("full_capacity_mw").cast("double")}).select("ucid", "source", "full_capacity_mw").filter("full_capacity_mw <> 0").groupBy("ucid", "source").agg(F.max("full_capacity_mw").alias("full_capacity_mw"))
    made = b.groupBy("ucid").agg(consensus.details_json(b).alias("j"))
    value = lambda path, kind: F.get_json_object("j", f"$.{path}").cast(kind)
    return made.select(
        "ucid", F.array_join(F.json_object_keys("j"), ",").alias("with_data"), value("Semianalysis.values.full_capacity_mw", "double").alias("semi_mw"), value("Semianalysis.rank", "int").alias("semi_rank"),
        value("DataCenterHawk.values.full_capacity_mw", "double").alias("hawk_mw"),
    )


@query(f"{B}, f AS (SELECT id % 50 AS ucid, source, max(id) AS i FROM b GROUP BY 1, 2) SELECT ucid, f.source, b.city FROM f JOIN b ON b.id = f.i")
def con_05_last_per_source(spark, sf):
    b = buildings(spark, sf).withColumns({"ucid": F.col("id") % 50, "load_order": F.col("id")}).select("ucid", "source", "city", "load_order")
    return consensus.per_source(b).select("ucid", "source", "city")


@query("WITH w AS (SELECT o_orderkey AS id, o_custkey AS ucid, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderpriority, o_orderkey) AS n FROM orders) SELECT id, ucid || '-' || CASE WHEN n < 10 THEN '0' ELSE '' END || n AS building_ucid FROM w")
def win_03_ordinals(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("ucid"), F.col("o_totalprice").alias("commissioned_power_mw"), F.col("o_orderpriority").alias("source"))
    return clusters.building_ids(o).select("id", "building_ucid")


@query("SELECT round(c_acctbal, 6) AS v, c_custkey FROM customer")
def sink_21_export_values(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("latitude"))
    return sinks._flat(c).select("c_custkey", F.col("latitude").alias("v"))


@query("SELECT o_orderkey, o_totalprice AS delta_mw FROM orders WHERE o_totalprice % 40 >= 10 OR o_totalprice >= 200000")
def sink_26_conflicts(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("delta_mw"), (F.col("o_totalprice") % 40).alias("delta_pct"))
    return sinks.conflicts(o, 10.0, 200000.0).select("o_orderkey", "delta_mw")


@query("SELECT c_custkey, NULL::DOUBLE AS extra FROM customer")
def sink_17_added_fields(spark, sf):
    return sinks.with_fields(table(spark, sf, "customer").select("c_custkey"), {"extra": "double", "C_CUSTKEY": "int"})


@query("SELECT c_custkey, c_name FROM customer WHERE NOT (c_name LIKE 'Customer#00000001%' AND NOT c_name LIKE 'Customer#000000012%')")
def sink_02_without_feed(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("unique_id"))
    return sinks.without_feed(c, "Customer#00000001", "Customer#000000012").withColumnRenamed("unique_id", "c_name")


@query("SELECT c_mktsegment, count(*) AS n, count(DISTINCT c_nationkey) AS nations FROM customer GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3")
def sort_03_top_values(spark, sf):
    return rollup.top_values(table(spark, sf, "customer"), "c_mktsegment", 3, F.countDistinct("c_nationkey").alias("nations"))


@query(f"{B}, x AS (SELECT id FROM b WHERE lower(campus_name) LIKE '%00012%') SELECT id FROM x")
def sort_05_relevance(spark, sf):
    b = buildings(spark, sf).withColumnRenamed("campus_name", "canonical_name")
    return matching.relevance_search(b, "00012", limit=100_000).select("id")
