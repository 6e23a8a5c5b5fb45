from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lodeframe.functions import config as C
from lodeframe.operators import consensus, land, quality, rollup, timeseries
from lodeframe.plans import workflows
from lodeframe.sources import adapters, readers, sinks
from lodeframe.sources.schemas import CANONICAL, DECLARED, REQUIRED

AS_OF = "2024-02-01"


def text(spark, names, *rows):
    return spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows], ", ".join(f"`{n}` string" for n in names))


def by_id(df):
    return {r["unique_id"]: r for r in df.collect()}


def test_schema():
    assert len(DECLARED) == len(set(DECLARED.names)) >= 70
    assert set(REQUIRED) <= set(DECLARED.names) <= set(CANONICAL.names)


def test_hyperscale(spark):
    names = ["F_facility_id", "company_name", "company_code", "city", "state", "latitude", "longitude", "status", "facility_type", "capacity_commissioned_power", "capacity_planned_power", "commissioned_year"]
    raw = text(spark, names, (1, "Acme", "A1", "Foo", "VA", 1.5, 2.5, "Owned", "x", 2000, None, 2015), (2, "Acme", "None", "Foo", "virginia", 0.0, 2.5, "Owned", "x", 1, 1, 2015), (3, "Acme", "None", "Foo Campus", "", 1.0, 2.0, None, "campus x", None, 500, 1900))
    got = by_id(adapters.hyperscale(raw, AS_OF))
    assert set(got) == {"DCH_1", "DCH_3"}
    a, b = got["DCH_1"], got["DCH_3"]
    assert (a["commissioned_power_mw"], a["planned_power_mw"], a["full_capacity_mw"], a["state"], a["state_abbr"], a["facility_status"], a["record_level"]) == (2.0, 0.0, 2.0, None, "VA", "Active", "Building")
    assert a["actual_live_date"] == datetime(2015, 12, 31) and a["campus_id"] == "acme|foo|acmefoo" and a["building_designation"] == "A1"
    assert (b["facility_status"], b["record_level"], b["actual_live_date"], b["campus_name"]) == ("Unknown", "Campus", None, "Acme Foo")


def test_lease(spark):
    names = ["?facility_id", "provider_name", "city", "latitude", "longitude", "status", "capacity_available_power", "ups_redundancy", "fiber_provider_names", "building_size", "capacity_commissioned_space"]
    got = by_id(adapters.lease(text(spark, names, (1, " Acme ", "Foo", 1, 2, "Leased", 900, "N+1", "['a', 'b']", "0", 77)), AS_OF))["DCH_L_1"]
    assert (got["available_power_kw"], got["owned_leased"], got["facility_status"], got["facility_sqft"], got["notes"]) == (900.0, "Leased", "Active", 77.0, "UPS: N+1 | Fiber: ['a', 'b']")


def test_map_site_routes_capacity(spark):
    names = ["id", "name", "parent_id", "company_name", "city", "country", "region", "latitude", "longitude", "stage", "power_mw"]
    rows = [(1, "X - Building 3", 0, "Acme", "Foo", "USA", "NorthAmerica", 1, 2, "Operational", 5), (2, "X Campus", 0, "Acme", "Foo", "US", "", 1, 2, "Land Banked", 6), (3, "X", 7, "A", "F", "Japan", None, 1, 2, "Cancelled", 7), (4, "X", None, "A", "F", None, None, 1, None, None, 7)]
    got = by_id(adapters.map_site(text(spark, names, *rows), AS_OF))
    pick = lambda r: tuple(r[c] for c in ("commissioned_power_mw", "uc_power_mw", "planned_power_mw", "full_capacity_mw", "facility_status", "record_level", "region", "cancelled"))
    assert {k: pick(v) for k, v in got.items()} == {
        "dcm_1": (5.0, None, None, 5.0, "Active", "Building", "AMER", 0), "dcm_2": (None, None, 6.0, 6.0, "Land Acquisition", "Campus", "AMER", 0), "dcm_3": (None, None, None, None, "Cancelled", "Building", "APAC", 1),
    }


def test_announcement(spark):
    names = ["Project", "Organizations", "Status", "Total_MWs", "State___Region", "County", "Lat_Lon_Y", "Lat_Lon_X", "Location", "Cost", "Building_Size__sq_ft_"]
    rows = [("Meta - Big " + "x" * 70, "Acme (FKA B) | C", "Planned", 10, "Texas", "Polk County", 1, 2, None, "USD 800M", "2.47M"), ("", "A", "Planned", 1, "Texas", "", 1, 2, None, "", "")]
    got = adapters.announcement(text(spark, names, *rows), AS_OF).collect()
    assert len(got) == 1
    r = got[0]
    assert len(r["unique_id"]) == 64 and r["company_clean"] == "Acme" and r["status_rank_tmp"] == 4 and r["state_abbr"] == "TX" and r["city"] == "Polk" and r["total_cost_usd_million"] == 800.0 and r["notes"] == "Partners: Acme (FKA B) | C"


def test_forecast(spark):
    names = ["Unique_ID", "Lat", "Long", "Company", "City", "Cluster", "Country", "Total under Construction MW", "record_level", "2023", "2024", "Tenant"]
    raw = text(spark, names, ("u1", 1, 2, "Facebook Inc", "Foo", None, "USA", 5, None, "", "3", "0"), (None, 1, 2, None, None, None, None, None, "TLBM_Hyperscaler", None, None, None))
    got = adapters.forecast(raw, AS_OF).collect()
    r = next(x for x in got if x["unique_id"] == "SEMI_u1")
    assert (r["company_clean"], r["facility_status"], r["full_capacity_mw"], r["mw_2023"], r["mw_2024"], r["tenant"], r["region"], r["campus_name"]) == ("Meta", "Under Construction", 5.0, None, 3.0, None, "AMER", "Meta Foo")
    assert len(got) == 2 and adapters.forecast(raw, AS_OF, keep_aggregates=False).count() == 1


def test_grid_and_milestone(spark):
    grid = text(spark, ["Data Center ID", "Name", "Data Center Status", "Owner", "Owner Type", "Country", "First Power Date", "Power Capacity (MW)", "Latitude (Degrees)", "Longitude (Degrees)"], ("or:data_center:7:a", "N", "Proposed", None, "Wholesale", "UK", "01/02/2024", "1,200", "0", "2"), ("x", "N", "Odd", "Amazon", "", "", "", "", "", "2"))
    g = by_id(adapters.grid(grid, AS_OF, "2026-02-02"))
    assert set(g) == {"OREN_7_a"}
    r = g["OREN_7_a"]
    assert (r["planned_power_mw"], r["facility_status"], r["company_clean_filter"], r["region"], r["actual_live_date"], r["latitude"]) == (1200.0, "Announced", C.OTHER_COLO, "EMEA", datetime(2024, 1, 2), 0.0)
    names = ["id_site", "site_name", "developer_name", "status", "latitude", "longitude", "existing_capacity__mw", "development_capacity__mw", "planned_capacity__mw", "publication_date", "super_region"]
    m = by_id(adapters.milestone(text(spark, names, ("1", "S", "Google", "Permitted", None, None, 1, 2, 3, "04/2024", "Europe"), ("2", "S", None, "Construction", 1, 2, 0, 0, "-", None, None), ("3", None, None, "x", 1, 2, None, None, None, None, None)), AS_OF, "2025-02-20"))
    assert set(m) == {"WDMAC_1", "WDMAC_2"}
    assert (m["WDMAC_1"]["planned_power_mw"], m["WDMAC_1"]["uc_power_mw"], m["WDMAC_1"]["record_level"], m["WDMAC_1"]["data_vintage"]) == (5.0, 0.0, "WoodMac_Project", datetime(2024, 4, 1))
    assert (m["WDMAC_2"]["full_capacity_mw"], m["WDMAC_2"]["facility_status"], m["WDMAC_2"]["data_vintage"], m["WDMAC_2"]["region"]) == (None, "Under Construction", datetime(2025, 2, 20), "AMER")


def test_truth(spark):
    raw = text(spark, ["building_key", "dc_code", "region_derived", "new_build_status", "latitude", "longitude", "it_load_total"], ("b1", "ABC", "AMER", "Future Build", 0.001, 0.002, 9), ("b2", None, None, "x", 5, 6, None), ("", "x", "x", "x", 1, 1, 1))
    got = by_id(adapters.truth(raw, AS_OF))
    assert set(got) == {"MetaCanonical_b1", "MetaCanonical_b2"}
    assert (got["MetaCanonical_b1"]["record_level"], got["MetaCanonical_b1"]["latitude"], got["MetaCanonical_b1"]["planned_power_mw"]) == ("Unlocated", None, 9.0)
    assert (got["MetaCanonical_b2"]["campus_id"], got["MetaCanonical_b2"]["commissioned_power_mw"]) == ("meta|unknown|unknown", 0.0)


def test_all_adapters_take_empty_feeds(spark):
    none = spark.createDataFrame([], "odd string")
    assert adapters.ingest({n: none for n in adapters.ADAPTERS}, AS_OF).count() == 0


def test_workflow_conserves_rows_and_capacity(spark):
    names = ["facility_id", "company_name", "company_code", "city", "state", "country", "latitude", "longitude", "status", "capacity_commissioned_power"]
    rows = [(i, "Amazon" if i % 2 else "Equinix, Inc.", f"A{i}", "Foo", "VA", "USA", 1 + (i // 4) * 0.1, 2.0, "Owned", 1000 * i) for i in range(1, 13)]
    essential = readers.id_set(spark, ["DCH_1"])
    run = workflows.full({"hyperscale": text(spark, names, *rows)}, AS_OF, essential)
    campuses = run.tables["campuses"]
    assert campuses.agg(F.sum("full_capacity_mw")).first()[0] == pytest.approx(sum(range(1, 13))) and campuses.agg(F.sum("building_count")).first()[0] == 12
    assert {r["company_clean"] for r in campuses.collect()} == {"AWS", "Equinix"} and campuses.filter("is_essential = 1").count() == 1
    assert run.tables["consensus"].count() == campuses.count() == run.rows["campuses"] and run.tables["combined"].count() == 12 + campuses.count()


def test_consensus_edges(spark):
    rows = spark.createDataFrame(
        [("c", "Semianalysis", 1.0, 1.0, 0.0, "", datetime(2024, 1, 20), 1), ("c", "DataCenterHawk", 1.1, 1.0, 10.0, "Acme", datetime(2023, 1, 1), 2), ("c", "Meta Canonical", 0.0, 1.0, 12.0, None, None, 3), ("d", "Odd", 2.0, 2.0, 5.0, "Odd Co", None, 1), ("e", "NPM", None, None, 5.0, "x", None, 1)],
        "ucid string, source string, latitude double, longitude double, full_capacity_mw double, company_clean string, data_vintage timestamp, building_count long",
    )
    got = {r["ucid"]: r for r in consensus.consensus(rows, AS_OF).collect()}
    assert set(got) == {"c", "d"}
    c = got["c"]
    assert (c["full_capacity_mw"], c["full_capacity_mw_source"], c["company_clean"], c["geometry_source"], c["latitude"]) == (10.0, "DataCenterHawk", "Acme", "Semianalysis", 1.0)
    assert c["confidence_score"] == pytest.approx(round(0.75 * 0.2 + 0.3 + 0.25 + 2 / 4 * 0.15 + 1.0 * 0.1, 3))
    assert '"Odd":{"rank":99' in got["d"]["source_details_json"] and got["d"]["company_clean"] == "Odd Co"
    assert consensus.config_problems() == []


def test_rollup_first_is_ordered_and_null_ids_stay_out(spark):
    rows = spark.createDataFrame([(2, "u", "b", None, "Announced", 1.0, None), (1, "u", "a", "X", "Active", 2.0, 3.0), (3, None, "a", "Y", "Active", 9.0, 9.0)], "id long, ucid string, source string, city string, facility_status string, full_capacity_mw double, planned_power_mw double").withColumns({"latitude": F.lit(1.0), "longitude": F.lit(1.0), "uc_power_mw": F.lit(0.0)})
    got = rollup.campus_rollup(rows).collect()
    assert [(r["ucid"], r["city"], r["sources"], r["facility_status_agg"], r["full_capacity_mw"], r["planned_plus_uc_mw"], r["sources_mw"]) for r in got] == [("u", "X", "a; b", "Active", 3.0, 3.0, {"a": 2.0, "b": 1.0})]


def test_ownership_chain(spark):
    rows = [(1, "p", None), (2, "p", "2020-01-01"), (3, "p", "2021-12-31"), (4, "p", "2024-01-01"), (5, "q", "2020-01-01")]
    df = spark.createDataFrame(rows, "id long, apn string, d string").withColumn("change_date", F.to_date("d"))
    got = {r["id"]: (r["sequence"], r["chain_length"], r["days_since"], r["flip"]) for r in land.ownership_chain(df).collect()}
    assert got == {1: (1, 4, None, False), 2: (2, 4, None, False), 3: (3, 4, 730, True), 4: (4, 4, 731, False), 5: (1, 1, None, False)}


def test_quality_and_schema(spark):
    df = spark.createDataFrame([("a", 95.0, 0.0), ("a", 0.0, 0.0), (None, 1.0, 1.0)], "unique_id string, latitude double, longitude double")
    got = {r["check"]: (r["failing"], r["rows"], r["ok"]) for r in quality.expectations(df, ["unique_id"]).collect()}
    assert got == {"required unique_id": (1, 3, False), "latitude in range": (1, 3, False), "longitude in range": (0, 3, True), "not at the origin": (1, 3, False), "unique unique_id": (1, 3, False)}
    assert quality.schema_problems(df, df.schema) == [] and len(quality.schema_problems(df, DECLARED)) == len(DECLARED) - 3


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("DCH_1", "A", 1.23456789, 2.0), ("DCH_L_1", "A", None, None), ("x", "B", 3.0, float("nan"))], "unique_id string, source string, latitude double, longitude double").withColumn("feed", sinks.feed_of())
    path = str(tmp_path / "t")
    for _ in range(2):
        sinks.refresh(df, path)
    assert spark.read.parquet(path).count() == 3
    sinks.refresh(df.filter("feed = 'lease'"), path)
    assert spark.read.parquet(path).count() == 3
    assert {r["unique_id"] for r in sinks.without_feed(df, "DCH_", "DCH_L_").collect()} == {"DCH_L_1", "x"}
    sinks.export_csv(df, str(tmp_path / "c"))
    rows = {r["unique_id"]: r for r in readers.csv_text(spark, str(tmp_path / "c")).collect()}
    assert rows["DCH_1"]["latitude"] == "1.234568" and rows["x"]["longitude"] is None
    assert sinks.feature_collection(df, "n").count('"Feature"') == 2
    wide = sinks.conformed(df, CANONICAL, {"unique_id": 4})
    assert wide.columns == CANONICAL.names and {r["unique_id"] for r in wide.collect()} == {"DCH_", "x"}
    assert sinks.with_fields(df, {"LATITUDE": "double", "new": "int"}).columns == [*df.columns, "new"]


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("name,v\ncafé,1\n".encode("latin-1"))
    assert readers.csv_any_encoding(spark, str(tmp_path / "a.csv")).first()["name"] == "café"
    assert readers.resolve(["F_x", "Y"], "x") == "F_x" and readers.resolve(["F_x", "Y"], "y") == "Y" and readers.resolve(["long_name"], "name", contains=True) == "long_name" and readers.resolve(["a"], "b") is None
    (tmp_path / "log.md").write_text("# t\n## 2024-01-02 - B\nbody\n## 2024-01-03 - A\nmore\n## other\n")
    assert [(r["day"], r["title"], r["body"]) for r in readers.session_log(spark, str(tmp_path / "log.md")).collect()] == [("2024-01-03", "A", "more"), ("2024-01-02", "B", "body")]


def test_weeks(spark):
    log = spark.createDataFrame([("2024-01-14 13:00:00", 1.0, "a"), ("2024-01-15 00:00:00", 2.0, "a"), (None, 5.0, "a")], "t string, hours double, kind string").withColumn("at", F.to_timestamp("t"))
    r = timeseries.weekly(log, "at", "hours", "2024-01-17").first()
    assert (r["this_week"], r["last_week"]) == (2.0, 1.0)
    got = timeseries.rolling_weeks(log, "at", "hours", "kind", ["a", "b"], "2024-01-17", 3).orderBy("week").collect()
    assert [(str(x["week"]), x["a"], x["b"]) for x in got] == [("2024-01-01", 0.0, 0.0), ("2024-01-08", 1.0, 0.0), ("2024-01-15", 2.0, 0.0)]


def test_stream_refreshes_once(spark, tmp_path):
    from lodeframe.streaming.refresh import refresh_stream

    spark.createDataFrame([("a", "s", "main")], "unique_id string, source string, feed string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("unique_id string, source string, feed string").parquet(str(tmp_path / "in"))
    for k in range(2):
        refresh_stream(stream, lambda df: df, str(tmp_path / "out"), str(tmp_path / f"cp{k}")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
