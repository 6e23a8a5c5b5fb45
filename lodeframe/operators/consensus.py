"""Best available value per attribute with its source, confidence, and per-source details."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeframe.functions import config as C
from lodeframe.functions.scalars import look_up

DETAILS = ("full_capacity_mw", "commissioned_power_mw", "uc_power_mw", "planned_power_mw", "facility_status", "building_count", *(f"mw_{y}" for y in range(2025, 2031)))
COVERED = ("full_capacity_mw", "commissioned_power_mw", "facility_status", "building_count")


def ranked_source(source: Column, aliases: dict[str, str] = C.SOURCE_ALIASES) -> Column:
    """The name a source has in the ranks: first of a joined list, aliases resolved."""
    first = F.trim(F.substring_index(source, ";", 1))
    return F.coalesce(look_up(first, aliases), first)


def priority(source: Column, order: Sequence[str], unknown_last: bool = True) -> Column:
    """Place of a source in a list; sources outside it come last, or not at all."""
    known = F.array_position(F.array(*map(F.lit, order)), source)
    return F.when(known > 0, known).otherwise(F.lit(len(order) + 1) if unknown_last else F.lit(None))


def usable(field: str, kind: str) -> Column:
    """Neither null nor blank nor 0."""
    c = F.col(field)
    return c.isNotNull() & ((c != "") if kind == "string" else (c != 0) if kind in ("double", "float", "int", "bigint", "smallint") else F.lit(True))


def best_value(df: DataFrame, field: str, unknown_last: bool = True) -> Column:
    """Aggregate: struct of value and source, of the usable value whose source comes first (then by source name)."""
    order = C.FIELD_AUTHORITY.get(field, tuple(C.AUTHORITY))
    place = priority(F.col("source"), order, unknown_last)
    ok = usable(field, dict(df.dtypes)[field]) & place.isNotNull()
    return F.min_by(F.struct(F.col(field).alias("value"), F.col("source").alias("source")), F.when(ok, F.struct(place, "source")))


def per_source(rows: DataFrame, order: str = "load_order") -> DataFrame:
    """The last row of each campus and source, under the source's ranked name."""
    rows = rows.withColumn("source", ranked_source(F.col("source")))
    return rows.groupBy("ucid", "source").agg(F.max_by(F.struct(*(c for c in rows.columns if c not in ("ucid", "source"))), order).alias("r")).select("ucid", "source", "r.*")


def details_json(df: DataFrame) -> Column:
    """Aggregate: JSON of source -> rank, vintage and usable values, by source name."""
    kinds = dict(df.dtypes)
    fields = [f for f in DETAILS if f in kinds]
    short = lambda f: f.replace("_power_mw", "_mw").replace("commissioned", "comm")
    values = F.struct(*(F.when(usable(f, kinds[f]), F.col(f)).alias(short(f)) for f in fields))
    some = F.coalesce(*(F.when(usable(f, kinds[f]), F.lit(True)) for f in fields))
    vintage = F.date_format("data_vintage", "yyyy-MM-dd") if "data_vintage" in kinds else F.lit(None).cast("string")
    entry = F.struct(F.col("source").alias("k"), F.struct(F.coalesce(look_up("source", C.AUTHORITY), F.lit(99)).alias("rank"), F.lit(True).alias("has_data"), vintage.alias("vintage"), values.alias("values")).alias("v"))
    return F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.when(some, entry)), lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0))))


def confidence(df: DataFrame, as_of: str) -> Column:
    """Aggregate over a campus' sources, 0 to 1: sources, truth, freshness, coverage, agreement."""
    w, kinds = C.CONFIDENCE, dict(df.dtypes)
    days = F.datediff(F.lit(as_of).cast("date"), F.col("data_vintage"))
    youngest = F.min(days)
    fresh = F.when(youngest < 90, 1.0).when(youngest < 180, 0.7).otherwise(0.5)
    covered = sum((F.when(F.bool_or(usable(f, kinds[f])), 1.0).otherwise(0.0) for f in COVERED if f in kinds), F.lit(0.0)) / len(COVERED)
    mw = F.when(F.col("full_capacity_mw") > 0, F.col("full_capacity_mw"))
    mean = F.avg(mw)
    gap = F.greatest(F.max(mw) - mean, mean - F.min(mw)) / mean
    agree = F.when(F.count(mw) < 2, 0.5).when(gap < 0.1, 1.0).when(gap < 0.2, 0.8).when(gap < 0.5, 0.5).otherwise(0.2)
    truth = F.when(F.bool_or(F.col("source") == C.TRUTH_SOURCE), 1.0).otherwise(0.0)
    return F.round(F.least(F.count("*") / 4.0, F.lit(1.0)) * w["source_count"] + truth * w["truth"] + F.coalesce(fresh, F.lit(0.5)) * w["freshness"] + covered * w["coverage"] + agree * w["agreement"], 3)


def consensus(rows: DataFrame, as_of: str, fields: Sequence[str] = ("company_clean", "facility_status", "commissioned_power_mw", "full_capacity_mw", "uc_power_mw", "planned_power_mw", "building_count")) -> DataFrame:
    """One row per campus that has a place. rows: ucid, source, latitude, longitude and fields, one per campus and source."""
    kinds = dict(rows.dtypes)
    fields = [f for f in fields if f in kinds]
    placed = (F.col("latitude") != 0) & (F.col("longitude") != 0)
    place = F.min_by(F.struct("latitude", "longitude", "source"), F.when(placed, F.struct(priority(F.col("source"), C.FIELD_AUTHORITY["latitude"]), "source")))
    aggs = [place.alias("geo"), *(best_value(rows, f).alias(f"b_{f}") for f in fields), F.array_sort(F.collect_set("source")).alias("sources"), F.count("*").alias("source_count"), details_json(rows).alias("source_details_json")]
    if "data_vintage" in kinds:
        aggs += [confidence(rows, as_of).alias("confidence_score"), F.max("data_vintage").alias("latest_vintage")]
    if "is_essential" in kinds:
        aggs.append(F.max("is_essential").alias("is_essential"))
    out = rows.groupBy("ucid").agg(*aggs).filter("geo IS NOT NULL")
    named = [F.col(f"b_{f}.value").alias(f) for f in fields] + [F.col(f"b_{f}.source").alias(f"{f}_source") for f in fields]
    rest = [c for c in out.columns if c not in ("geo", "ucid") and not c.startswith("b_")]
    return out.select("ucid", F.col("geo.latitude").alias("latitude"), F.col("geo.longitude").alias("longitude"), F.col("geo.source").alias("geometry_source"), *named, *rest)


def representative(rows: DataFrame, attributes: Sequence[str] = ("campus_name", "company_clean", "company_clean_filter", "region", "country", "state_abbr", "city")) -> DataFrame:
    """Per campus the identity of one record, all from the same row: of the source first by place, unknown ones last, then by name."""
    have = [c for c in attributes if c in rows.columns]
    order = F.struct(priority(F.col("source"), C.FIELD_AUTHORITY["latitude"]).alias("p"), F.col("source").alias("s"))
    return rows.groupBy("ucid").agg(F.min_by(F.struct(*have, F.col("source").alias("identity_source")), order).alias("r")).select("ucid", "r.*")


def consensus_checks(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), (F.count("*") - F.countDistinct("ucid")).alias("repeated_ucids"), F.max(F.length("source_details_json")).alias("longest_details"))


def essential_flag(df: DataFrame, ids: DataFrame, key: str = "unique_id") -> DataFrame:
    """df with is_essential, 1 where its key is in the curated ids."""
    return df.join(ids.select(key).distinct().withColumn("__e", F.lit(1)), key, "left").withColumn("is_essential", F.coalesce("__e", F.lit(0))).drop("__e")


def config_problems() -> list[str]:
    """References of the field lists to unknown sources, ranks used twice, weights that don't add to 1."""
    out = [f"{f}: {s}" for f, order in C.FIELD_AUTHORITY.items() for s in order if s not in C.AUTHORITY]
    if len(set(C.AUTHORITY.values())) < len(C.AUTHORITY):
        out.append("ranks used twice")
    for name, w in (("confidence", C.CONFIDENCE), ("tiers", C.TIER_WEIGHTS), ("score", C.SCORE_WEIGHTS)):
        if abs(sum(w.values()) - 1) > 1e-9:
            out.append(f"{name} weights add to {sum(w.values())}")
    return out
