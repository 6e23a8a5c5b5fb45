"""Checks of clusterings, places, feeds and the ground truth; profiles of new feeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeframe.functions import config as C
from lodeframe.functions import scalars as S
from lodeframe.operators import quality, rollup
from lodeframe.operators.spatial import band_join, group_pairs, nearest, point_in_polygon

#: Degrees within which coordinates are one.
SAME_DEGREES = 0.0001
#: Rates that a table of suites must stay below (or, of places, above).
NULL_STATUS_RED, NULL_CAPACITY_RED, PLACED_YELLOW, FUTURE_RED = 0.5, 0.5, 0.5, 0.8


def _pct(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, 100 * part / whole).otherwise(0.0)


# --- tolerances


def orphan_splits(members: DataFrame, tight: DataFrame, metres: float = 500.0) -> DataFrame:
    """Loose clusters whose tight ones all lie within metres of each other: loose_id, tight_ids, number, distances, severity.

    members: tight_id and loose_id per row; tight: id, latitude, longitude of each tight cluster.
    """
    both = members.filter("tight_id IS NOT NULL AND loose_id IS NOT NULL").select("tight_id", "loose_id").distinct()
    placed = both.join(tight.select(F.col("id").alias("tight_id"), "latitude", "longitude"), "tight_id").withColumnRenamed("tight_id", "id")
    pairs = group_pairs(placed, "loose_id")
    far = pairs.groupBy("loose_id").agg(F.max("distance_m").alias("max_distance_m"), F.min("distance_m").alias("min_distance_m"), F.array_sort(F.array_union(F.collect_set("left_id"), F.collect_set("right_id"))).alias("tight_ids"))
    near = far.filter(F.col("max_distance_m") < metres).withColumn("tight_count", F.size("tight_ids"))
    return near.withColumn("severity", F.when(F.col("max_distance_m") > 0.6 * metres, "MEDIUM").otherwise("LOW"))


def reference_winner(reference: DataFrame, tight: DataFrame, loose: DataFrame, metres: float = 1000.0, tie_m: float = 10.0) -> DataFrame:
    """Per reference campus: nearest cluster of each tolerance within metres, how many there are, and which is nearer. All: id, latitude, longitude."""

    def side(clusters: DataFrame, n: str) -> DataFrame:
        return band_join(reference, clusters, metres).groupBy(F.col("left_id").alias("id")).agg(
            F.count("*").alias(f"{n}_matches"), F.min(F.struct("distance_m", "right_id")).alias("b")
        ).select("id", f"{n}_matches", F.col("b.right_id").alias(f"{n}_id"), F.col("b.distance_m").alias(f"{n}_distance_m"))

    out = reference.select("id").join(side(tight, "tight"), "id", "left").join(side(loose, "loose"), "id", "left").fillna(0, ["tight_matches", "loose_matches"])
    a, b = F.col("tight_distance_m"), F.col("loose_distance_m")
    winner = F.when(a.isNull() & b.isNull(), "NO_MATCH").when(b.isNull(), "TIGHT").when(a.isNull(), "LOOSE").when(F.abs(a - b) < tie_m, "TIE").when(a < b, "TIGHT").otherwise("LOOSE")
    return out.withColumn("winner", winner)


def large_clusters(clusters: DataFrame, companies: Sequence[str] = C.REVIEWED, sources: int = 2, mw: float = 100.0) -> DataFrame:
    """Clusters of the companies with several sources or much capacity, largest first. clusters: cluster, company_clean, sources (array), full_capacity_mw."""
    large = (F.size("sources") >= sources) | (S.zero("full_capacity_mw") >= mw)
    return clusters.filter(F.col("company_clean").isin(*companies) & large).orderBy(S.zero("full_capacity_mw").desc(), "cluster")


# --- places


def place_pairs(left: DataFrame, right: DataFrame, metres: float = 1000.0, companies: Sequence[str] | None = None) -> DataFrame:
    """Each left row's nearest right row within metres, the differences of their coordinates, and whether they are one place.

    companies: rows of these only (column company_clean), as raw feeds are compared.
    """
    if companies is not None:
        left, right = (df.filter(F.col("company_clean").isin(*companies)) for df in (left, right))
    usable = lambda df: df.filter(S.truthy_point("latitude", "longitude"))
    dy, dx = F.abs(F.col("left_latitude") - F.col("right_latitude")), F.abs(F.col("left_longitude") - F.col("right_longitude"))
    pairs = nearest(usable(left), usable(right), metres).filter(F.col("distance_m") < metres)
    return pairs.withColumns({"lat_diff": dy, "lon_diff": dx, "identical": (dy < SAME_DEGREES) & (dx < SAME_DEGREES)})


def coordinate_independence(left: DataFrame, right: DataFrame, metres: float = 1000.0, shared_pct: float = 80.0) -> DataFrame:
    """One row: matched rows, identical and different places, and whether the sources share their coordinates."""
    out = place_pairs(left, right, metres).agg(F.count("*").alias("matched"), F.count_if("identical").alias("identical"), F.count_if(~F.col("identical")).alias("different"), F.avg("distance_m").alias("mean_distance_m"))
    out = out.withColumn("identical_pct", _pct(F.col("identical"), F.col("matched")))
    return out.withColumn("verdict", F.when(F.col("matched") == 0, "NO_MATCHES").when(F.col("identical_pct") > shared_pct, "SHARED").otherwise("INDEPENDENT"))


def campus_lookup(df: DataFrame, part: str, company: str | None = None) -> DataFrame:
    """Rows whose campus name contains the part; % and _ in it stand for themselves."""
    escaped = part.replace("\\", "\\\\").replace("%", r"\%").replace("_", r"\_")
    found = df.filter(F.col("campus_name").like(f"%{escaped}%"))
    return found.filter(F.col("company_clean") == company) if company else found


def admin_join(points: DataFrame, areas: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """points with the attributes of the area that holds them (of several the least polygon_id); points outside all keep null."""
    held = point_in_polygon(points.select("id", "latitude", "longitude"), areas)
    best = held.groupBy("id").agg(F.min_by(F.struct("polygon_id", *attributes), "polygon_id").alias("a")).select("id", "a.*")
    return points.join(best, "id", "left")


# --- ground truth


def _placed() -> Column:
    return F.coalesce((F.abs("latitude") > 0.01) & (F.abs("longitude") > 0.01), F.lit(False))


def suite_quality(suites: DataFrame) -> DataFrame:
    """One row over suites (dc_code, building_key, new_build_status, it_load, latitude, longitude): filled fields, capacity, distinct codes, suites per building."""
    load = F.coalesce(F.col("it_load"), F.lit(0.0))
    status = F.coalesce(F.trim("new_build_status") != "", F.lit(False))
    real = F.col("new_build_status").isin("Complete Build", "Active Build") & status
    out = suites.agg(
        F.count("*").alias("suites"), F.count_if(status).alias("with_status"), F.count_if(load > 0).alias("with_load"), F.count_if(_placed()).alias("placed"), F.sum(F.when(load > 0, load).otherwise(0.0)).alias("total_mw"),
        F.sum(F.when((load > 0) & F.coalesce(real, F.lit(False)), load).otherwise(0.0)).alias("real_mw"), F.sum(F.when(_placed(), load).otherwise(0.0)).alias("placed_mw"),
        F.countDistinct(F.nullif(F.col("dc_code"), F.lit(""))).alias("dc_codes"), F.countDistinct(F.nullif(F.col("building_key"), F.lit(""))).alias("buildings"), F.count_if(S.filled("building_key")).alias("keyed"),
    )
    return out.withColumn("suites_per_building", F.when(F.col("buildings") > 0, F.col("keyed") / F.col("buildings")))


def capacity_classes(suites: DataFrame) -> DataFrame:
    """Capacity and share per build status, blank ones as NULL/Empty, with the class that the status belongs to."""
    status = F.coalesce(F.nullif(F.trim("new_build_status"), F.lit("")), F.lit("NULL/Empty"))
    each = suites.filter(F.col("it_load") > 0).groupBy(status.alias("status")).agg(F.count("*").alias("suites"), F.sum("it_load").alias("mw"))
    total = each.agg(F.sum("mw").alias("total"))
    kind = F.when(F.col("status").isin("Complete Build", "Active Build"), "operational").otherwise("future or unknown")
    return each.crossJoin(F.broadcast(total)).select("status", "suites", "mw", _pct(F.col("mw"), F.col("total")).alias("pct"), kind.alias("class"))  # one row


def quality_report(suites: DataFrame) -> DataFrame:
    """One row: rates, their flags, and the recommendation from the number of red and yellow ones."""
    q = suite_quality(suites)
    rates = {
        "null_status": (F.col("suites") - F.col("with_status")) / F.col("suites"), "null_capacity": (F.col("suites") - F.col("with_load")) / F.col("suites"), "placed_share": F.col("placed") / F.col("suites"),
        "future_share": F.when(F.col("total_mw") > 0, (F.col("total_mw") - F.col("real_mw")) / F.col("total_mw")).otherwise(0.0),
    }
    q = q.select("suites", *(F.coalesce(F.when(F.col("suites") > 0, c), F.lit(0.0)).alias(n) for n, c in rates.items()))
    q = q.withColumns({
        "status_flag": S.quality_flag("null_status", NULL_STATUS_RED), "capacity_flag": S.quality_flag("null_capacity", NULL_CAPACITY_RED), "place_flag": S.quality_flag("placed_share", PLACED_YELLOW, above=False),
        "future_flag": S.quality_flag("future_share", FUTURE_RED),
    })
    red = sum(((F.col(c) == "fail").cast("int") for c in ("status_flag", "capacity_flag", "future_flag")), F.lit(0))
    yellow = F.col("place_flag").isin("fail", "warn").cast("int")
    advice = F.when(red >= 2, "RED - HOLD").when(red == 1, "YELLOW - INVESTIGATE").when(yellow >= 2, "YELLOW - CAUTION").otherwise("GREEN - PROCEED")
    return q.withColumns({"red": red, "yellow": yellow, "recommendation": advice})


def ownership_statistics(sites: DataFrame) -> DataFrame:
    """One row: sites with a parcel, a land date, a first capacity, a timeline, a price; and by owner of the land.

    sites: match_type, land_date, first_mw_date, amount, acres, company, entity, buyer.
    """
    kind = F.lower("match_type")
    matched = F.coalesce((kind != "") & (kind != "no_match") & ~kind.contains("missing"), F.lit(False))
    owner = S.land_owner("company", "entity", "buyer")
    return sites.agg(
        F.count("*").alias("sites"), F.count_if(matched).alias("with_parcel"), F.count("land_date").alias("with_land_date"), F.count("first_mw_date").alias("with_first_mw"),
        F.count_if(F.col("land_date").isNotNull() & F.col("first_mw_date").isNotNull()).alias("with_timeline"), F.count_if(S.price_per_acre("amount", "acres") != 0).alias("with_price"),
        *(F.count_if(owner == v).alias(n) for v, n in (("hyperscaler", "hyperscaler_owned"), ("developer", "developer_owned"), ("unknown", "ownership_unknown"))),
    )


# --- feeds


def feed_profile(df: DataFrame, lat: str, lon: str, country: str, company: str, capacity: str, date: str) -> DataFrame:
    """One row over a new feed: rows with a place, regions, companies, filled and summed capacity, first and last date."""
    y, x, mw = S.safe_double(lat), S.safe_double(lon), S.safe_double(capacity, ",")
    region = S.country_region(S.country_name(country))
    at = S.any_date(F.col(date).cast("string"), S.GRID_DATES)
    out = df.agg(
        F.count("*").alias("rows"), F.count_if(y.isNotNull() & x.isNotNull()).alias("placed"), *(F.count_if(region == r).alias(r.lower()) for r in ("AMER", "EMEA", "APAC")), F.count_if(S.filled(country) & region.isNull()).alias("other_country"),
        F.countDistinct(F.nullif(F.trim(company), F.lit(""))).alias("companies"), F.count_if(S.company_tier(company) == "hyperscaler").alias("hyperscalers"), F.count_if(mw > 0).alias("with_capacity"),
        F.coalesce(F.sum(F.when(mw > 0, mw)), F.lit(0.0)).alias("total_mw"), F.count(at).alias("dated"), F.min(at).alias("oldest"), F.max(at).alias("newest"),
    )
    return out.withColumns({"placed_pct": _pct(F.col("placed"), F.col("rows")), "capacity_pct": _pct(F.col("with_capacity"), F.col("rows"))})


def quarter_profile(df: DataFrame, by: str, quantity: str = "quantity") -> DataFrame:
    """Per value of a column: rows, their share, and the sum of quantities, which may be negative."""
    rows = df.groupBy(F.coalesce(F.nullif(F.trim(F.col(by).cast("string")), F.lit("")), F.lit("Unknown")).alias(by)).agg(F.count("*").alias("n"), F.coalesce(F.sum(S.safe_double(quantity)), F.lit(0.0)).alias("net"))
    total = rows.agg(F.sum("n").alias("total"))
    return rows.crossJoin(F.broadcast(total)).select(by, "n", _pct(F.col("n"), F.col("total")).alias("pct"), "net")  # one row


#: Parts of field names that tell a feed of buildings from one of campuses.
BUILDING_FIELDS, CAMPUS_FIELDS = ("building", "facility_id", "bldg"), ("campus", "site", "project")


def _fields_like(df: DataFrame, parts: Sequence[str]) -> list[str]:
    return [c for c in df.columns if any(p in c.lower() for p in parts)]


def feed_audit(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """One row per raw feed: rows, fields, fields that speak of buildings or of campuses, and the level that they suggest."""
    out = None
    for name, df in feeds.items():
        b, c = _fields_like(df, BUILDING_FIELDS), _fields_like(df, CAMPUS_FIELDS)
        level = "Mixed" if b and c else "Building" if b else "Campus" if c else "Unknown"
        row = df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("feed"), "rows", F.lit(len(df.columns)).alias("fields"), F.lit(", ".join(b)).alias("building_fields"), F.lit(", ".join(c)).alias("campus_fields"), F.lit(level).alias("level"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def field_search(spark: SparkSession, tables: Mapping[str, DataFrame], wanted: Mapping[str, Sequence[str]]) -> DataFrame:
    """Fields of each table whose name contains one of the patterns of a wanted field; a row without field where there is none."""
    rows = []
    for name, df in tables.items():
        for target, patterns in wanted.items():
            found = [f for f in df.schema if any(p.lower() in f.name.lower() for p in patterns)]
            rows += [(name, target, f.name, f.dataType.simpleString()) for f in found] or [(name, target, None, None)]
    return spark.createDataFrame(rows, "`table` string, wanted string, field string, kind string")  # schemas, not data


def schema_report(df: DataFrame, samples: int = 3) -> DataFrame:
    """One row per field: place, type, filled rows, and the least values as text."""
    text = lambda c: F.col(f"`{c}`").cast("string")
    wide = df.agg(*(F.struct(F.lit(i).alias("place"), F.lit(f.name).alias("field"), F.lit(f.dataType.simpleString()).alias("kind"), F.count(f"`{f.name}`").alias("filled"), F.min(text(f.name)).alias("least"), F.max(text(f.name)).alias("largest")).alias(f"c{i}") for i, f in enumerate(df.schema)))
    return wide.select(F.explode(F.array(*(F.col(f"c{i}") for i in range(len(df.columns))))).alias("f")).select("f.*")


def company_audit(df: DataFrame, company: str = "company_clean") -> DataFrame:
    """Distinct companies with their rows, the canonical name, and whether it differs."""
    counts = rollup.value_counts(df, company)
    name = F.col(company)
    return counts.withColumn("suggestion", S.canonical_company(name)).withColumn("differs", F.coalesce(F.col("suggestion") != name, F.lit(False)))


def validation_suite(mode: str, feeds: Mapping[str, DataFrame] | None = None, buildings: DataFrame | None = None, campuses: DataFrame | None = None) -> dict[str, DataFrame]:
    """The checks of a mode: pre audits raw feeds; post checks levels by source, campuses against buildings, and campus ids of several sources; all does both."""
    if mode not in ("pre", "post", "all"):
        raise ValueError(f"no mode {mode}")
    out: dict[str, DataFrame] = {}
    if mode != "post" and feeds:
        out["feeds"] = feed_audit(feeds)
    if mode != "pre" and buildings is not None:
        out["levels"] = rollup.pivot_counts(buildings.withColumn("record_level", F.coalesce("record_level", F.lit("NULL"))), "source", "record_level", ["Building", "Campus", "NULL"])
        out["cross_source"] = cross_source_ids(buildings)
        out["issues"] = quality.known_issues(buildings)
        if campuses is not None:
            keys = lambda df: df.filter("ucid IS NOT NULL").select(F.col("ucid").alias("k"))
            from lodeframe.operators.matching import orphans

            out["orphans"] = orphans(keys(buildings), keys(campuses), "k")
    return out


def cross_source_ids(df: DataFrame, key: str = "ucid", top: int | None = None) -> DataFrame:
    """Keys that rows of several sources share, with the number of sources, most first."""
    out = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.countDistinct("source").alias("sources"), F.count("*").alias("n")).filter("sources > 1")
    return out.orderBy(F.desc("sources"), key).limit(top) if top else out
