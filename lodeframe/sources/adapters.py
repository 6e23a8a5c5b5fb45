"""One projection per feed into the canonical building schema.

Each takes the raw feed and the time of the load, and reads columns through the tolerant resolver.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeframe.functions import config as C
from lodeframe.functions import scalars as S
from lodeframe.sources.readers import fields, resolve
from lodeframe.sources.schemas import CANONICAL


def _canonical(df: DataFrame, values: dict[str, Column], as_of: str) -> DataFrame:
    values = values | {"ingest_date": F.lit(as_of).cast("timestamp")}
    return df.select(*(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CANONICAL))


def _read(df: DataFrame, text: str = "", number: str = "", time: str = "") -> DataFrame:
    kinds = {n: T.StringType() for n in text.split()} | {n: T.DoubleType() for n in number.split()} | {n: T.TimestampType() for n in time.split()}
    return fields(df, kinds)


def _level(kind: str, name: Column) -> Column:
    return F.when(F.lower(kind).contains("campus") | F.lower(name).contains("campus"), "Campus").otherwise("Building")


def _site_names(company: Column, city: str, code: str) -> tuple[Column, Column]:
    """(name of the building, name of the campus) from company, city and an optional code."""
    coded = S.filled(code) & (F.col(code) != "None")
    place = F.trim(F.concat_ws(" ", company, F.coalesce(F.col(city), F.lit("None"))))
    name = F.when(coded, F.trim(F.concat_ws(" ", company, code))).otherwise(place)
    campus = F.trim(F.replace(F.replace(place, F.lit(" Data Center"), F.lit("")), F.lit(" Campus"), F.lit("")))
    return name, campus


def _mw(kw: str) -> Column:
    return F.coalesce(F.col(kw) * C.KW_TO_MW, F.lit(0.0))


def hyperscale(raw: DataFrame, as_of: str) -> DataFrame:
    """Rows without coordinates (null or 0) or company are left out; missing capacity is 0."""
    df = _read(
        raw, "facility_id company_name company_code address city state state_abbr postal_code country market_name region county facility_type status",
        "latitude longitude capacity_commissioned_power capacity_planned_power capacity_under_construction_power capacity_building_sf commissioned_year", "date_updated",
    ).filter(S.truthy_point("latitude", "longitude") & (F.col("company_name") != ""))
    name, campus = _site_names(F.col("company_name"), "city", "company_code")
    live, planned, building = _mw("capacity_commissioned_power"), _mw("capacity_planned_power"), _mw("capacity_under_construction_power")
    state, code = S.split_state("state", "state_abbr")
    return _canonical(df, {
        "unique_id": F.concat(F.lit("DCH_"), F.col("facility_id")), "source": F.lit("DataCenterHawk"), "source_unique_id": F.col("facility_id"), "date_reported": F.col("date_updated"), "record_level": _level("facility_type", name),
        "campus_id": S.campus_key_plain("company_name", "city", campus, "latitude", "longitude"), "campus_name": campus, "company_source": F.col("company_name"), "company_clean": F.col("company_name"), "building_designation": F.col("company_code"),
        **{c: F.col(c) for c in ("address", "postal_code", "city", "county", "country", "region", "latitude", "longitude")}, "market": F.col("market_name"), "state": state, "state_abbr": code,
        "planned_power_mw": planned, "uc_power_mw": building, "commissioned_power_mw": live, "full_capacity_mw": live + planned + building, "planned_plus_uc_mw": planned + building,
        "actual_live_date": S.year_end("commissioned_year"), "facility_status": F.coalesce(S.look_up("status", C.STATUS_HYPERSCALE), F.lit("Unknown")), "cancelled": F.lit(0), "facility_sqft": F.col("capacity_building_sf"),
        "type_category": F.col("facility_type"), "data_vintage": F.col("date_updated"),
    }, as_of)


def lease(raw: DataFrame, as_of: str) -> DataFrame:
    """As hyperscale, the provider being the company; available power stays in kW; all rows are leased."""
    df = _read(
        raw, "facility_id provider_name company_code address city state postal_code country market_name facility_type status ups_redundancy ups_description fiber_provider_names",
        "latitude longitude building_size capacity_commissioned_power capacity_available_power capacity_under_construction_power capacity_planned_power capacity_commissioned_space capacity_available_space", "date_updated",
    ).filter(S.truthy_point("latitude", "longitude") & (F.col("provider_name") != ""))
    company = F.trim("provider_name")
    short = lambda c, n: F.substring(F.trim(F.col(c)), 1, n)
    df = df.withColumns({"city": short("city", 100)})
    name, campus = _site_names(company, "city", "company_code")
    live, planned, building = _mw("capacity_commissioned_power"), _mw("capacity_planned_power"), _mw("capacity_under_construction_power")
    some = F.col("fiber_provider_names") != ""
    text = S.notes(("UPS: ", "ups_redundancy", ""), ("UPS Desc: ", F.substring("ups_description", 1, 50), ""), ("", F.when(some, S.fiber_note("fiber_provider_names")), ""), length=255)
    return _canonical(df, {
        "unique_id": F.concat(F.lit("DCH_L_"), F.col("facility_id")), "source": F.lit("DataCenterHawk"), "source_unique_id": F.col("facility_id"), "date_reported": F.col("date_updated"), "record_level": _level("facility_type", name),
        "campus_id": S.campus_key_plain(company, "city", campus, "latitude", "longitude"), "campus_name": campus, "company_source": company, "company_clean": company, "building_designation": F.col("company_code"),
        "address": short("address", 255), "postal_code": short("postal_code", 10), "city": F.col("city"), "market": F.col("market_name"), "state": short("state", 100), "country": short("country", 100), "latitude": F.col("latitude"), "longitude": F.col("longitude"),
        "planned_power_mw": planned, "uc_power_mw": building, "commissioned_power_mw": live, "full_capacity_mw": live + planned + building, "planned_plus_uc_mw": planned + building, "available_power_kw": F.col("capacity_available_power"),
        "facility_status": F.coalesce(S.look_up("status", C.STATUS_LEASE), F.lit("Unknown")), "cancelled": F.lit(0),
        "facility_sqft": F.coalesce(F.nullif(F.col("building_size"), F.lit(0.0)), F.col("capacity_commissioned_space")), "whitespace_sqft": F.col("capacity_available_space"), "type_category": F.col("facility_type"), "owned_leased": F.lit("Leased"),
        "notes": text, "data_vintage": F.col("date_updated"),
    }, as_of)


def map_site(raw: DataFrame, as_of: str) -> DataFrame:
    """Capacity goes where the stage says, null elsewhere; campuses and buildings are told by name and parent."""
    df = _read(
        raw, "id name parent_id company_name address address_details postal_code city state state_abbr county country region market stage tier_design",
        "latitude longitude power_mw year_operational building_sqft whitespace_sqft pue", "ds Data_Vintage",
    ).filter(S.truthy_point("latitude", "longitude"))
    mw = S.routed("stage", "power_mw")
    campus, country = S.map_campus_name("name"), S.country_name("country")
    parent = F.coalesce(F.col("parent_id").try_cast("double") != 0, S.filled("parent_id"), F.lit(False))
    address = F.nullif(F.concat_ws("; ", F.nullif(F.col("address"), F.lit("")), F.nullif(F.col("address_details"), F.lit(""))), F.lit(""))
    both = F.when(mw["planned"].isNotNull() | mw["uc"].isNotNull(), S.zero(mw["planned"]) + S.zero(mw["uc"]))
    return _canonical(df, {
        "unique_id": F.concat(F.lit("dcm_"), F.col("id")), "source": F.lit("DataCenterMap"), "source_unique_id": F.col("id"), "campus_id": S.campus_key_hyphen("company_name", "city", campus, "latitude", "longitude"), "campus_name": campus,
        "building_designation": S.map_building("name"), "record_level": F.when(F.col("name").contains(" - Building") | parent, "Building").otherwise("Campus"), "company_clean": F.col("company_name"), "company_source": F.col("company_name"),
        "address": address, **{c: F.col(c) for c in ("city", "state", "state_abbr", "postal_code", "county", "market", "latitude", "longitude", "whitespace_sqft", "pue", "tier_design")}, "country": country, "region": S.region_name("region", country),
        "commissioned_power_mw": mw["commissioned"], "uc_power_mw": mw["uc"], "planned_power_mw": mw["planned"], "planned_plus_uc_mw": both, "full_capacity_mw": F.coalesce(mw["commissioned"], mw["uc"], mw["planned"]),
        "facility_sqft": F.col("building_sqft"), "facility_status": S.stage_status("stage"), "cancelled": F.coalesce(F.lower("stage").contains("cancel"), F.lit(False)).cast("int"), "date_reported": F.col("ds"),
        "actual_live_date": S.year_end("year_operational"), "data_vintage": F.col("Data_Vintage"), "notes": F.concat(F.lit("Original name: "), F.nullif(F.col("name"), F.lit(""))),
    }, as_of)


def announcement(raw: DataFrame, as_of: str) -> DataFrame:
    """Announced projects, all in one country; only this feed fills the status rank. Ids are cut at 64 characters."""
    names = {
        "Project": "project", "Organizations": "orgs", "Status": "status", "Total_MWs": "mw", "Building_Size__sq_ft_": "size", "Land_Size__acre_": "acres", "Planned_Operation_Date": "planned", "State___Region": "state", "County": "county",
        "Onsite_Generation__MW_": "onsite", "Backup_Generation__MW_": "backup", "Lat_Lon_Y": "lat", "Lat_Lon_X": "lon", "Location": "location", "Coordinates_Precision": "precision", "Cost": "cost", "Modified": "modified",
    }
    df = fields(raw, {n: T.TimestampType() if k in ("planned", "modified") else T.DoubleType() if k in ("mw", "acres", "lat", "lon") else T.StringType() for n, k in names.items()}).withColumnsRenamed(names)
    df = df.filter((F.col("project") != "") & F.col("lat").isNotNull() & F.col("lon").isNotNull())
    campus = F.regexp_replace(F.trim("project"), r"^(Meta|Oracle|OpenAI)\s*-\s*", "")
    company, city, slug = S.first_organisation("orgs"), S.city_of_location("location", "county"), S.slug_word("project")
    county = F.replace(F.replace(F.col("county"), F.lit(" County"), F.lit("")), F.lit(" Parish"), F.lit(""))
    key = F.concat_ws("|", S.slug_word(company), S.slug_word(F.coalesce(F.nullif(city, F.lit("")), F.nullif(county, F.lit("")), F.lit("Unknown"))), S.slug_word(campus))
    status = S.stage_status("status", C.STATUS_PROJECT)
    live = status == "Active"
    return _canonical(df, {
        "unique_id": F.substring(F.concat(F.lit("npm_"), slug), 1, 64), "source": F.lit("NewProjectMedia"), "source_unique_id": F.substring(slug, 1, 64), "date_reported": F.coalesce("modified", F.lit(as_of).cast("timestamp")), "record_level": F.lit("Building"),
        "campus_id": key, "campus_name": campus, "company_source": F.coalesce(F.nullif(F.col("orgs"), F.lit("")), F.lit("Unknown")), "company_clean": company, "city": city, "state": F.trim("state"), "state_abbr": S.look_up(F.trim("state"), C.US_STATES),
        "county": F.col("county"), "country": F.lit("United States"), "region": F.lit("AMER"), "latitude": F.col("lat"), "longitude": F.col("lon"), "facility_status": status, "status_rank_tmp": S.status_rank(status),
        "announced": F.when(~live, F.col("planned")), "cod": F.col("planned"), "actual_live_date": F.when(live, F.col("planned")), "full_capacity_mw": F.nullif(F.col("mw"), F.lit(0.0)), "facility_sqft": S.square_feet("size"),
        "total_site_acres": F.nullif(F.col("acres"), F.lit(0.0)), "total_cost_usd_million": S.cost_millions("cost"), "data_vintage": F.col("modified"),
        "notes": S.notes(("Onsite generation: ", "onsite", " MW"), ("Backup generation: ", "backup", " MW"), ("Coordinates precision: ", "precision", ""), ("Partners: ", F.when(F.col("orgs").contains("|"), F.col("orgs")), "")),
    }, as_of)


def forecast(raw: DataFrame, as_of: str, keep_aggregates: bool = True) -> DataFrame:
    """Yearly capacities; status from capacity; rows of market aggregates are kept with their own level, or dropped."""
    nulls = ("", "nan", "None", "0")

    def text(*names: str, length: int | None = None) -> Column:
        found = [c for n in names if (c := resolve(raw.columns, n))]
        return F.coalesce(*(S.safe_text(F.col(f"`{c}`"), length, nulls) for c in found)) if found else F.lit(None).cast("string")

    def number(*names: str) -> Column:
        found = [c for n in names if (c := resolve(raw.columns, n))]
        return S.safe_double(F.coalesce(*(F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")) for c in found))) if found else F.lit(None).cast("double")

    df = raw.select(
        text("Unique_ID").alias("sid"), number("Lat").alias("latitude"), number("Long").alias("longitude"), text("State", "US State", length=100).alias("state"), text("City", length=100).alias("city"), text("ZIP Code", length=10).alias("zip"),
        text("Cluster", length=50).alias("cluster"), text("Country", length=100).alias("country"), text("Region", length=50).alias("region"), text("Company", length=100).alias("company"), text("Type", length=50).alias("kind"), text("Market", length=100).alias("market"),
        number("Installed Capacity (Q1 2024)", "Installed Capacity (Q1 2025)", "Installed Capacity MW (Q2 2025)", "Installed Capacity MW").alias("live"), number("Total under Construction MW").alias("uc"), number("Total Planned MW").alias("planned"),
        number("Full Capacity").alias("full"), number("Planned + UC").alias("both"), number("Facility Square Footage").alias("sqft"), text("Start of operations").alias("start"), text("Actual Live Assumption").alias("live_date"), text("data_vintage").alias("vintage"),
        text("record_level").alias("level"), text("Estimated End User (based on Mosaic Theory when not public)", "End User", length=100).alias("end_user"), text("Estimated Tenant (based on Mosaic Theory when not public)", "Tenant", length=100).alias("tenant"),
        text("GPU Cloud", length=50).alias("gpu"), text("Workload Type", length=50).alias("workload"), *(number(str(y)).alias(f"mw_{y}") for y in range(2023, 2033)),
    ).filter(S.truthy_point("latitude", "longitude"))
    if not keep_aggregates:
        df = df.filter(~F.coalesce(F.col("level").startswith("TLBM"), F.lit(False)))
    low = F.lower("company")
    company = F.when(low.contains("meta") | low.contains("facebook"), "Meta").otherwise(F.col("company"))
    live, uc, planned = S.zero("live"), S.zero("uc"), S.zero("planned")
    country = S.country_name("country")
    date = lambda c: S.any_date(c, S.MILESTONE_DATES)
    made_id = F.sha2(F.concat_ws("|", "company", "city", "cluster", F.col("latitude").cast("string"), F.col("longitude").cast("string")), 256)
    return _canonical(df, {
        "unique_id": F.concat(F.lit("SEMI_"), F.coalesce("sid", F.substring(made_id, 1, 12))), "source": F.lit("Semianalysis"), "source_unique_id": F.col("sid"), "record_level": F.coalesce("level", F.lit("Building")),
        "campus_id": F.when(company.isNotNull(), S.campus_key_plain(company, "city", "cluster", "latitude", "longitude")), "campus_name": F.coalesce("cluster", F.when(company.isNotNull() & F.col("city").isNotNull(), F.concat_ws(" ", company, "city"))),
        "company_source": F.col("company"), "company_clean": company, "building_designation": F.col("cluster"), "postal_code": F.col("zip"), "city": F.col("city"), "market": F.col("market"), "state": F.col("state"), "state_abbr": S.state_code("state"),
        "country": country, "region": S.region_name("region", country), "latitude": F.col("latitude"), "longitude": F.col("longitude"), "planned_power_mw": planned, "uc_power_mw": uc, "commissioned_power_mw": live,
        "full_capacity_mw": F.coalesce(F.nullif(F.col("full"), F.lit(0.0)), live + uc + planned), "planned_plus_uc_mw": F.coalesce("both", planned + uc), **{f"mw_{y}": F.col(f"mw_{y}") for y in range(2023, 2033)},
        "construction_start_date": date("start"), "actual_live_date": date("live_date"), "facility_status": S.status_of_capacity("live", "uc", "planned"), "cancelled": F.lit(0), "facility_sqft": F.col("sqft"), "type_category": F.col("kind"),
        "end_user": F.col("end_user"), "tenant": F.col("tenant"), "gpu_cloud": F.col("gpu"), "workload_type": F.col("workload"), "data_vintage": date("vintage"),
    }, as_of)


def _csv(raw: DataFrame, names: dict[str, str], nulls: tuple[str, ...]) -> DataFrame:
    out = []
    for short, name in names.items():
        found = resolve(raw.columns, name)
        out.append((S.safe_text(F.col(f"`{found}`"), None, nulls) if found else F.lit(None).cast("string")).alias(short))
    return raw.select(*out)


def grid(raw: DataFrame, as_of: str, vintage: str | None = None) -> DataFrame:
    """One capacity, put where the status says; rows without coordinates are left out, a coordinate of 0 stays."""
    df = _csv(raw, {
        "sid": "Data Center ID", "name": "Name", "status": "Data Center Status", "detail": "Detailed Status", "state": "State", "county": "County", "owner": "Owner", "owner_type": "Owner Type", "country": "Country", "start": "Construction Date",
        "first": "First Power Date", "reported": "Reported First Power Date", "mw": "Power Capacity (MW)", "sqft": "Square Footage (Sq Ft)", "transmission": "Transmission Owner", "power": "Power Source", "lat": "Latitude (Degrees)", "lon": "Longitude (Degrees)",
    }, ("", "nan", "None"))
    df = df.withColumns({c: S.safe_double(c, ",") for c in ("mw", "sqft", "lat", "lon")}).filter("lat IS NOT NULL AND lon IS NOT NULL")
    status = F.coalesce(S.look_up("status", C.STATUS_GRID), F.col("status"), F.lit("Unknown"))
    mw, date = S.zero("mw"), lambda c: S.any_date(c, S.GRID_DATES)
    live, building = status == "Active", status == "Under Construction"
    made = F.substring(F.sha2(F.concat_ws("|", "name", F.col("lat").cast("string"), F.col("lon").cast("string")), 256), 1, 12)
    return _canonical(df, {
        "unique_id": F.concat(F.lit("OREN_"), F.coalesce(S.clean_id("sid", "or:data_center:"), made)), "source": F.lit("Orennia"), "source_unique_id": F.col("sid"), "record_level": F.lit("Building"), "campus_name": F.col("name"), "company_source": F.col("owner"),
        "company_clean": F.col("owner"), "company_clean_filter": S.owner_filter("owner", "owner_type"), "building_designation": F.col("name"), "state_abbr": F.col("state"), "county": F.col("county"), "country": F.col("country"), "region": S.country_region("country"),
        "latitude": F.col("lat"), "longitude": F.col("lon"), "commissioned_power_mw": F.when(live, mw).otherwise(0.0), "uc_power_mw": F.when(building, mw).otherwise(0.0), "planned_power_mw": F.when(live | building, 0.0).otherwise(mw), "full_capacity_mw": mw,
        "actual_live_date": F.coalesce(date("first"), date("reported")), "construction_start_date": date("start"), "facility_status": status, "cancelled": (status == "Cancelled").cast("int"), "facility_sqft": F.col("sqft"), "type_category": F.col("owner_type"),
        "data_vintage": F.lit(vintage).cast("timestamp"), "transmission_owner": F.col("transmission"), "power_source_confidence": F.col("power"), "status_detail": F.col("detail"),
    }, as_of)


def milestone(raw: DataFrame, as_of: str, vintage: str | None = None) -> DataFrame:
    """Three capacities; outside active and building states what is under development counts as planned. Rows without coordinates stay as projects.

    A row's own publication date is its vintage, else the given one.
    """
    plain = (
        "site_name project_name developer_name workload status latitude longitude country_name state_province_name county_district_name market_name super_region existing_capacity__mw development_capacity__mw planned_capacity__mw construction_date "
        "commercial_operation_date forecast_commercial_operation_date publication_date cooling energy_supply finance_partner disclosed_date land_acquisition_date permitting_date cancelled_date total_site_acres data_center_acres land_cost_usd_million "
        "development_overall_cost_usd_million zone_name"
    )
    df = _csv(raw, {"sid": "id_site", **{n: n for n in plain.split()}}, ("", "nan", "None", "NaN"))
    numbers = {c: S.safe_double(F.when(F.col(c) != "-", F.col(c)), ",$") for c in df.columns if c.endswith("__mw") or c.endswith("acres") or c.endswith("usd_million") or c in ("latitude", "longitude")}
    df = df.withColumns(numbers)
    live, dev, planned = S.zero("existing_capacity__mw"), S.zero("development_capacity__mw"), S.zero("planned_capacity__mw")
    total = F.nullif(live + dev + planned, F.lit(0.0))
    cut = lambda c, n: F.substring(c, 1, n)
    campus = F.coalesce(cut("site_name", 255), cut("project_name", 255))
    df = df.filter(campus.isNotNull() | F.col("developer_name").isNotNull() | total.isNotNull())
    status = F.coalesce(S.look_up("status", C.STATUS_MILESTONE), F.col("status"), F.lit("Unknown"))
    moving = status.isin("Active", "Under Construction")
    placed = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    date = lambda c: S.any_date(c, S.MILESTONE_DATES)
    made = F.substring(F.sha2(F.concat_ws("|", "site_name", "project_name", "developer_name", "latitude", "longitude"), 256), 1, 12)
    return _canonical(df, {
        "unique_id": F.concat(F.lit("WDMAC_"), F.coalesce("sid", made)), "source": F.lit("WoodMac"), "source_unique_id": F.col("sid"), "record_level": F.when(placed, "Building").otherwise("WoodMac_Project"), "campus_name": campus,
        "company_source": cut("developer_name", 100), "company_clean": cut("developer_name", 100), "company_clean_filter": S.developer_filter("developer_name"), "building_designation": F.coalesce(cut("project_name", 255), campus), "market": cut("market_name", 100),
        "state": cut("state_province_name", 100), "county": cut("county_district_name", 100), "country": cut("country_name", 100), "region": S.super_region("super_region"), "latitude": F.col("latitude"), "longitude": F.col("longitude"),
        "planned_power_mw": F.when(moving, planned).otherwise(dev + planned), "uc_power_mw": F.when(moving, dev).otherwise(0.0), "commissioned_power_mw": live, "full_capacity_mw": total,
        "actual_live_date": F.coalesce(date("commercial_operation_date"), date("forecast_commercial_operation_date")), "construction_start_date": date("construction_date"), "facility_status": status, "cancelled": (status == "Cancelled").cast("int"),
        "type_category": cut("workload", 100), "data_vintage": F.coalesce(date("publication_date"), F.lit(vintage).cast("timestamp")), "workload_type": cut("workload", 100), "cooling_type": cut("cooling", 50), "energy_source": cut("energy_supply", 100),
        "finance_partner": cut("finance_partner", 100), **{c: date(c) for c in ("disclosed_date", "land_acquisition_date", "permitting_date", "cancelled_date")}, "total_site_acres": F.col("total_site_acres"), "dc_acres": F.col("data_center_acres"),
        "land_cost_usd_million": F.col("land_cost_usd_million"), "development_cost_usd_million": F.col("development_overall_cost_usd_million"), "grid_zone": cut("zone_name", 100), "status_detail": F.col("status"),
    }, as_of)


def truth(raw: DataFrame, as_of: str) -> DataFrame:
    """Ground-truth buildings; places at the origin (within 0.01 degrees) are no places, rows without one are unlocated."""
    df = _read(raw, "building_key dc_code datacenter region_derived new_build_status owned_leased", "latitude longitude it_load_total").filter(F.col("building_key") != "")
    real = S.valid_point("latitude", "longitude", 0.01)
    load, status = S.zero("it_load_total"), F.col("new_build_status")
    building, future = F.coalesce(status == "Active Build", F.lit(False)), F.coalesce(status == "Future Build", F.lit(False))
    planned, uc = F.when(future, load).otherwise(0.0), F.when(building, load).otherwise(0.0)
    return _canonical(df, {
        "unique_id": F.concat(F.lit("MetaCanonical_"), F.col("building_key")), "source": F.lit(C.TRUTH_SOURCE), "source_unique_id": F.col("building_key"), "record_level": F.when(real & S.truthy_point("latitude", "longitude"), "Building").otherwise("Unlocated"),
        "campus_id": S.campus_key_code("meta", "dc_code", "region_derived"), "campus_name": F.concat(F.lit("Meta "), F.when(F.col("dc_code") != "", F.col("dc_code")).otherwise("Unknown")), "company_source": F.lit("Meta"), "company_clean": F.lit("Meta"),
        "building_designation": F.col("datacenter"), "country": F.when(F.col("region_derived") == "AMER", "United States"), "region": F.col("region_derived"), "latitude": F.when(real, F.col("latitude")), "longitude": F.when(real, F.col("longitude")),
        "planned_power_mw": planned, "uc_power_mw": uc, "commissioned_power_mw": load - planned - uc, "full_capacity_mw": load, "planned_plus_uc_mw": planned + uc, "facility_status": F.coalesce(S.look_up(status, C.STATUS_BUILD), F.lit("Unknown")),
        "cancelled": F.lit(0), "type_category": F.lit("Hyperscale"), "owned_leased": F.col("owned_leased"), "data_vintage": F.lit(as_of).cast("timestamp"),
    }, as_of)


def truth_import(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(suites with a usable place, the others), with dc_code and the region of the place."""
    df = raw.withColumns({"dc_code": F.col("region"), "region_derived": S.region_of_point("latitude", "longitude"), "milestone_date": F.try_to_timestamp("latest_milestone_date")})
    placed = F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & (F.col("region_derived") != "INVALID")
    return df.filter(placed), df.filter(~placed)


ADAPTERS: dict[str, Callable[..., DataFrame]] = {
    "hyperscale": hyperscale, "lease": lease, "map": map_site, "announcement": announcement, "forecast": forecast, "grid": grid, "milestone": milestone, "truth": truth,
}


def ingest(raw: dict[str, DataFrame], as_of: str) -> DataFrame:
    """All given feeds in one canonical table."""
    return reduce(DataFrame.unionByName, (ADAPTERS[name](df, as_of) for name, df in raw.items()))
