"""Roll-ups: buildings to campuses, suites to buildings, the combined layer, tallies and comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeframe.functions.scalars import rank_status, status_rank

ORDER = ("source", "id")


def first_of(column: str, order: Sequence[str] = ORDER) -> Column:
    """Value of the first row in the given order, null or not; of rows that tie, the least value."""
    return F.min_by(F.struct(column), F.struct(*order, column))[column]


def first_filled(column: str, order: Sequence[str] = ORDER) -> Column:
    has = F.col(column).isNotNull() & (F.col(column).cast("string") != "")
    return F.min_by(column, F.when(has, F.struct(*order)))


def joined_set(column: str, separator: str = "; ") -> Column:
    return F.array_join(F.array_sort(F.collect_set(column)), separator)


def sum_or_null(*columns: str) -> Column:
    """Sum with null as 0; null if all are null or 0."""
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in columns), F.lit(0.0))
    return F.when(F.coalesce(*(F.nullif(F.col(c), F.lit(0.0)) for c in columns)).isNotNull(), total)


FIRST = ("company_clean", "campus_name", "city", "market", "state", "state_abbr", "county", "country", "region", "postal_code", "address", "type_category")
SUMS = ("planned_power_mw", "uc_power_mw", "commissioned_power_mw", "full_capacity_mw", "facility_sqft", "whitespace_sqft", "total_cost_usd_million", "total_site_acres", *(f"mw_{y}" for y in range(2023, 2033)))


def campus_rollup(buildings: DataFrame, key: str = "ucid") -> DataFrame:
    """One row per campus: first attributes in the order (source, id), sums, status by precedence, sources, centre.

    Rows without a key are left out. Capacity is summed over all sources; sources_mw keeps it by source.
    Columns that buildings lack are left out.
    """
    have = set(buildings.columns)
    first, sums = [c for c in FIRST if c in have], [c for c in SUMS if c in have]
    ends = {c: how for c, how in (("actual_live_date", F.min), ("data_vintage", F.max), ("ingest_date", F.max), ("is_essential", F.max), ("cancelled", F.max)) if c in have}
    means = [c for c in ("latitude", "longitude", "pue") if c in have]
    # by campus and source first, then by campus: one pass over the buildings gives the totals and those of each source
    part = buildings.filter(F.col(key).isNotNull()).groupBy(key, "source").agg(
        F.min(F.struct(*ORDER, *first)).alias("__first"), *(F.sum(c).alias(c) for c in sums), *(how(c).alias(c) for c, how in ends.items()),
        *(x for c in means for x in (F.sum(c).alias(f"__{c}"), F.count(c).alias(f"__n_{c}"))), F.min(status_rank("facility_status")).alias("__rank"), F.count("*").alias("__rows"),
    )
    renamed = {"actual_live_date": "first_live_date", "pue": "pue_avg"}
    aggs = [F.min("__first").alias("__first"), *(F.sum(c).alias(c) for c in sums), *(how(c).alias(renamed.get(c, c)) for c, how in ends.items())]
    aggs += [(F.sum(f"__{c}") / F.nullif(F.sum(f"__n_{c}"), F.lit(0))).alias(renamed.get(c, c)) for c in means]
    aggs += [rank_status(F.min("__rank")).alias("facility_status_agg"), joined_set("source").alias("sources"), F.sum("__rows").alias("building_count")]
    if "full_capacity_mw" in have:
        aggs.append(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce("source", F.lit("")).alias("s"), F.col("full_capacity_mw").alias("mw"))))).alias("sources_mw"))
    out = part.groupBy(key).agg(*aggs).withColumns({c: F.col(f"__first.{c}") for c in first}).drop("__first")
    if {"planned_power_mw", "uc_power_mw"} <= have:
        out = out.withColumn("planned_plus_uc_mw", sum_or_null("planned_power_mw", "uc_power_mw"))
    return out.withColumn("record_level", F.lit("Campus"))


def suites_to_buildings(suites: DataFrame) -> DataFrame:
    return suites.groupBy("building_key").agg(
        F.count("*").alias("suite_count"), first_of("dc_code", ("location_key",)).alias("dc_code"), first_of("region_derived", ("location_key",)).alias("region_derived"),
        first_of("new_build_status", ("location_key",)).alias("new_build_status"), F.sum("it_load").alias("it_load_total"), F.max("has_coordinates").alias("has_coordinates"),
    )


def buildings_to_campuses(buildings: DataFrame) -> DataFrame:
    """Ground-truth campuses: counts, load by status, owned and leased, first region, mean of valid coordinates."""
    load = lambda s: F.sum(F.when(F.col("new_build_status") == s, F.col("it_load_total")).otherwise(0.0))
    placed = (F.col("latitude") != 0) & (F.col("longitude") != 0)
    return buildings.groupBy("dc_code").agg(
        F.count("*").alias("building_count"), F.sum("suite_count").alias("suite_count"), F.sum("it_load_total").alias("it_load_total"), load("Complete Build").alias("complete_mw"), load("Active Build").alias("active_mw"),
        load("Future Build").alias("future_mw"), F.count_if(F.col("owned_leased") == "Owned").alias("owned"), F.count_if(F.col("owned_leased") == "Leased").alias("leased"),
        first_filled("region_derived", ("building_key",)).alias("region"), F.avg(F.when(placed, F.col("latitude"))).alias("latitude"), F.avg(F.when(placed, F.col("longitude"))).alias("longitude"),
    )


def combined_layer(buildings: DataFrame, campuses: DataFrame) -> DataFrame:
    """Both levels in one schema, told apart by record_level; columns of one level only are null in the other."""
    return buildings.withColumn("layer", F.lit("building")).unionByName(campuses.withColumn("layer", F.lit("campus")), allowMissingColumns=True)


def completeness(df: DataFrame, fields: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per group and field: share of rows that are not null or blank, least, largest and mean of numbers. One scan."""
    kinds = dict(df.dtypes)
    numeric = [c for c in fields if kinds[c] in ("int", "bigint", "smallint", "double", "float")]
    aggs = [F.count("*").alias("n")]
    for c in fields:
        aggs.append(F.count_if(F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")).alias(f"{c}__n"))
        if c in numeric:
            aggs += [F.min(c).cast("double").alias(f"{c}__lo"), F.max(c).cast("double").alias(f"{c}__hi"), F.avg(c).alias(f"{c}__mean")]
    wide = df.groupBy(*by).agg(*aggs)
    none = F.lit(None).cast("double")
    each = F.array(*(
        F.struct(F.lit(c).alias("field"), F.col(f"{c}__n").alias("filled"), *(x.alias(n) for x, n in zip(([F.col(f"{c}__{k}") for k in ("lo", "hi", "mean")] if c in numeric else [none] * 3), ("least", "largest", "mean"))))
        for c in fields
    ))
    long = wide.select(*by, "n", F.explode(each).alias("f")).select(*by, "n", "f.*")
    return long.withColumn("pct", F.when(F.col("n") > 0, F.round(100 * F.col("filled") / F.col("n"), 1)).otherwise(0.0))


def best_source_per_field(long: DataFrame, source: str = "source") -> DataFrame:
    """Per field: the source with the highest share (smallest name of equals), and all sources with data."""
    return long.groupBy("field").agg(
        F.min_by(source, F.struct((-F.col("pct")).alias("p"), source)).alias("best_source"), F.max("pct").alias("best_pct"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("pct") > 0, F.col(source)))), ", ").alias("sources_with_data"),
    )


def value_counts(df: DataFrame, column: str, top: int | None = None, null_label: str = "(null)") -> DataFrame:
    out = df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit(null_label)).alias(column)).agg(F.count("*").alias("n"))
    return out.orderBy(F.desc("n"), column).limit(top) if top else out


def top_values(df: DataFrame, column: str, n: int, *aggregates: Column) -> DataFrame:
    """The n most frequent values, the smallest of equally frequent ones, with further aggregates."""
    return df.groupBy(column).agg(F.count("*").alias("n"), *aggregates).orderBy(F.desc("n"), column).limit(n)


def counts_by_each(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts by each column alone, in one pass; the other columns are null."""
    return df.groupingSets([[c] for c in columns], *columns).agg(F.count("*").alias("n"))


def positive_coverage(df: DataFrame, fields: Sequence[str], by: str) -> DataFrame:
    """Per group and field: rows, rows with a value above 0, and their sum. One scan."""
    wide = df.groupBy(by).agg(F.count("*").alias("rows"), *(F.struct(F.lit(c).alias("field"), F.count_if(F.col(c) > 0).alias("n"), F.sum(F.when(F.col(c) > 0, F.col(c))).alias("mw")).alias(f"__{c}") for c in fields))
    return wide.select(by, "rows", F.explode(F.array(*(F.col(f"__{c}") for c in fields))).alias("f")).select(by, "rows", "f.*")


def campus_share(df: DataFrame, campus: str, value: str) -> DataFrame:
    """Mean share of its campus' total that one building has, per campus: near 1, values are campus totals."""
    total = Window.partitionBy(campus)
    return df.withColumn("__total", F.sum(value).over(total)).groupBy(campus).agg(F.avg(F.col(value) / F.col("__total")).alias("share"))


def state_distribution(df: DataFrame, column: str, top: int = 15) -> DataFrame:
    """The most frequent states; missing ones and those that are the number 0 are left out."""
    named = df.filter(F.col(column).isNotNull() & (F.trim(column) != "") & ~F.coalesce(F.col(column).try_cast("double") == 0, F.lit(False)))
    return value_counts(named, column, top)


def layer_summary(df: DataFrame) -> DataFrame:
    """Rows of the combined layer by level and company label."""
    return df.groupBy("layer", "company_clean_filter").agg(F.count("*").alias("n"))


def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").withColumn("surplus", F.col("n") - 1)


def pivot_counts(df: DataFrame, rows: str, columns: str, values: Sequence[str]) -> DataFrame:
    """Counts by two columns as a table; the values are given, so no scan is spent on finding them."""
    return df.groupBy(rows).agg(*(F.count_if(F.col(columns) == v).alias(v) for v in values))


def two_way(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Counts and sums of two tables by one key."""
    tag = a.select(key, value, F.lit(1).alias("s")).unionByName(b.select(key, value, F.lit(2).alias("s")))
    of = lambda s: F.col("s") == s
    return tag.groupBy(key).agg(
        F.count_if(of(1)).alias("left_rows"), F.count_if(of(2)).alias("right_rows"), F.sum(F.when(of(1), F.col(value))).alias(f"left_{value}"), F.sum(F.when(of(2), F.col(value))).alias(f"right_{value}")
    )


def peer_capacity(rows: DataFrame, preferred: str, value: str = "mw") -> DataFrame:
    """Per company and region: per campus the preferred source's sum if it has any row, else the largest other value; then summed."""
    own = F.col("source") == preferred
    campus = rows.groupBy("company_clean", "ucid", "region").agg(F.when(F.bool_or(own), F.sum(F.when(own, F.col(value)))).otherwise(F.max(value)).alias(value))
    return campus.groupBy("company_clean", "region").agg(F.sum(value).alias(value), F.count("*").alias("campuses"))


def building_campus_check(buildings: DataFrame, campuses: DataFrame, key: str, value: str, percent: float = 5.0) -> DataFrame:
    sums = buildings.groupBy(key).agg(F.sum(value).alias("summed"))
    both = campuses.select(key, F.col(value).alias("stored")).join(sums, key, "left")
    gap = F.abs(F.coalesce("summed", F.lit(0.0)) - F.coalesce("stored", F.lit(0.0)))
    return both.withColumn("ok", gap * 100 <= percent * F.greatest(F.abs(F.coalesce("stored", F.lit(0.0))), F.lit(1e-9)))
