"""Data-quality expectations and source scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeframe.functions import stats as S
from lodeframe.functions.config import SCORE_WEIGHTS

REQUIRED = ("unique_id", "source", "campus_id", "campus_name", "latitude", "longitude", "company_clean", "city", "country", "region", "ingest_date")


def _filled(c: str) -> Column:
    return F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")


def expectations(df: DataFrame, required: Sequence[str] = REQUIRED, domains: dict[str, Sequence[str]] | None = None, key: str = "unique_id", least_pct: float = 99.0) -> DataFrame:
    """check, failing, rows, ok: required fields, domains, coordinate bounds, repeated keys. One scan and one key aggregate."""
    tests = {f"required {c}": ~_filled(c) for c in required if c in df.columns}
    tests |= {f"domain {c}": F.col(c).isNotNull() & ~F.col(c).isin(*v) for c, v in (domains or {}).items()}
    if {"latitude", "longitude"} <= set(df.columns):
        tests |= {"latitude in range": F.col("latitude").isNotNull() & (F.abs("latitude") > 90), "longitude in range": F.col("longitude").isNotNull() & (F.abs("longitude") > 180), "not at the origin": (F.col("latitude") == 0) & (F.col("longitude") == 0)}
    wide = df.agg(F.count("*").alias("rows"), *(F.count_if(F.coalesce(t, F.lit(False))).alias(n) for n, t in tests.items()))
    long = wide.select("rows", F.explode(F.array(*(F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").alias("failing")) for n in tests))).alias("x")).select("x.*", "rows")
    repeats = df.groupBy(key).agg((F.count("*") - 1).alias("n")).agg(F.lit(f"unique {key}").alias("check"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("failing"), (F.coalesce(F.sum("n"), F.lit(0)) + F.count("*")).cast("long").alias("rows"))
    share = F.col("check").startswith("required") & (100 * (F.col("rows") - F.col("failing")) >= least_pct * F.col("rows"))
    return long.unionByName(repeats).withColumn("ok", (F.col("failing") == 0) | share)


def bound_class(lat: str, lon: str, lat2: str, lon2: str) -> Column:
    """null, zero, out of range or ok, of coordinates with a backup."""
    y, x = F.coalesce(lat, lat2), F.coalesce(lon, lon2)
    return F.when(y.isNull() | x.isNull(), "null").when((y == 0) & (x == 0), "zero").when((F.abs(y) > 90) | (F.abs(x) > 180), "out of range").otherwise("ok")


def schema_problems(df: DataFrame, declared: T.StructType) -> list[str]:
    """Declared fields that are missing or have another type."""
    have = {f.name.lower(): f.dataType for f in df.schema}
    return [f"{f.name}: missing" if f.name.lower() not in have else f"{f.name}: {have[f.name.lower()].simpleString()}, not {f.dataType.simpleString()}" for f in declared if have.get(f.name.lower()) != f.dataType]


def schema_diff(old: DataFrame, new: DataFrame) -> tuple[list[str], list[str]]:
    a, b = set(old.columns), set(new.columns)
    return sorted(a - b), sorted(b - a)


def known_issues(df: DataFrame) -> DataFrame:
    """One row of counts: campuses with mixed sources, missing region, unknown level, state code without name, coordinates off their geometry, rows without a place.

    Coordinates are compared with gold_lat and gold_lon, where df has them.
    """
    off = F.greatest(F.abs(F.col("latitude") - F.col("gold_lat")), F.abs(F.col("longitude") - F.col("gold_lon"))) > 0.001 if {"gold_lat", "gold_lon"} <= set(df.columns) else F.lit(False)
    mixed = df.groupBy("ucid").agg(F.countDistinct("source").alias("n")).agg(F.count_if(F.col("n") > 1).alias("mixed_source_campuses"))
    rest = df.agg(
        F.count_if(F.col("country").isNotNull() & F.col("region").isNull()).alias("no_region"), F.count_if(~F.coalesce(F.col("record_level").isin("Building", "Campus"), F.lit(False))).alias("odd_level"),
        F.count_if((F.length("state_abbr") == 2) & F.col("state").isNull()).alias("no_state_name"), F.count_if(F.coalesce(off, F.lit(False))).alias("off_geometry"),
        F.count_if(~F.coalesce((F.col("latitude") != 0) & (F.col("longitude") != 0), F.lit(False))).alias("unplaced"),
    )
    return mixed.crossJoin(rest)  # one row each


def freshness(df: DataFrame, as_of: str, by: str = "source", date: str = "data_vintage") -> DataFrame:
    return df.groupBy(by).agg(
        F.count("*").alias("rows"), F.count(date).alias("dated"), F.min(date).alias("oldest"), F.max(date).alias("newest"), F.datediff(F.lit(as_of).cast("date"), F.max(date)).alias("days_old"),
        F.round(100 * F.count(date) / F.count("*"), 1).alias("coverage_pct"),
    )


def source_scores(df: DataFrame, spatial: DataFrame | None, core: Sequence[str], capacity: Sequence[str], location: Sequence[str], every: Sequence[str], forecast: Sequence[str]) -> DataFrame:
    """Weighted score and grade per source: volume (times 5, at most 100), shares of filled fields by kind, spatial score, forecasts."""
    share = lambda c: F.round(100 * F.count_if(_filled(c)) / F.count("*"), 1)
    mean = lambda cs: sum((share(c) for c in cs), F.lit(0.0)) / len(cs) if cs else F.lit(0.0)
    many = sum((F.when(share(c) > 50, 1.0).otherwise(0.0) for c in forecast), F.lit(0.0))
    out = df.groupBy("source").agg(F.count("*").alias("rows"), mean(core).alias("core"), mean(capacity).alias("capacity"), mean(location).alias("location"), mean(every).alias("richness"), F.least(F.lit(100.0), many / 8 * 100).alias("forecast"))
    total = out.agg(F.sum("rows").alias("total"))
    out = out.crossJoin(F.broadcast(total)).withColumn("volume", F.least(F.lit(100.0), F.col("rows") / F.col("total") * 100 * 5))  # one row
    out = out.join(spatial.select("source", F.col("score").alias("spatial")), "source", "left").fillna(0.0, ["spatial"]) if spatial is not None else out.withColumn("spatial", F.lit(0.0))
    score = sum((F.col(k) * w for k, w in SCORE_WEIGHTS.items()), F.lit(0.0))
    return out.withColumn("final_score", score).withColumn("grade", S.grade_from("final_score"))


def profile(df: DataFrame) -> DataFrame:
    """One row: rows, columns, repeated rows, share of filled cells."""
    filled = sum((F.avg(_filled(c).cast("double")) for c in df.columns), F.lit(0.0)) / max(1, len(df.columns))
    row = F.struct(*(F.col(c).cast("string") for c in df.columns))
    return df.agg(F.count("*").alias("rows"), F.lit(len(df.columns)).alias("columns"), (F.count("*") - F.countDistinct(row)).alias("repeated_rows"), F.round(100 * filled, 1).alias("filled_pct"))
