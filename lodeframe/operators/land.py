"""Parcels: scope, ownership chains, land-to-power lag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeframe.functions import config as C
from lodeframe.functions.scalars import first_mw_year, price_per_acre, scope_company
from lodeframe.operators.clusters import proximity_clusters

FLIP_DAYS = 730
#: Upper bounds in days and their labels; the rest is the last.
LAG_BUCKETS = ((0, "negative"), (365, "under 1 year"), (730, "1-2 years"), (1095, "2-3 years"), (1825, "3-5 years"))


def ownership_chain(changes: DataFrame, key: str = "apn", date: str = "change_date", tie: str = "id") -> DataFrame:
    """changes with their number in the parcel's chain, its length, days since the one before, a flip flag (within 730 days), price per acre. Null dates come first."""
    own = Window.partitionBy(key)
    order = own.orderBy(F.col(date).asc_nulls_first(), tie)
    days = F.datediff(date, F.lag(date).over(order))
    out = changes.withColumns({"sequence": F.row_number().over(order), "chain_length": F.count("*").over(own), "days_since": days, "flip": F.coalesce(days <= FLIP_DAYS, F.lit(False))})
    return out.withColumn("price_per_acre", price_per_acre("transaction_amount", "computed_acres")) if {"transaction_amount", "computed_acres"} <= set(changes.columns) else out


def lag_bucket(days: Column) -> Column:
    out = F.when(days.isNull(), "unknown")
    for top, label in LAG_BUCKETS:
        out = out.when(days < top, label)
    return out.otherwise("5 years or more")


def lag_statistics(df: DataFrame, by: str) -> DataFrame:
    """Mean, least and largest lag per value of a column, and of all, in one aggregation."""
    return df.groupingSets([[by], []], by).agg(F.grouping(by).alias("is_total"), F.count("days").alias("n"), F.avg("days").alias("mean_days"), F.min("days").alias("least_days"), F.max("days").alias("largest_days"))


def in_scope(df: DataFrame) -> DataFrame:
    """df with ok flags for company, place, period and type, and whether all hold."""
    company = scope_company("company_clean").isin(*(k for k, _ in C.SCOPE_ALIASES))
    country = F.exists(F.array(*(F.lit(c.lower()) for c in C.SCOPE_COUNTRIES)), lambda c: F.lower("country").contains(c))
    place = F.upper("region").contains("AMER") | country | (F.length("state_abbr") == 2)
    level = F.col("record_level")
    kind = F.when(level.isin(*C.SCOPE_LEVELS), True).when(F.lower(level).contains("colo"), False).otherwise(company)
    flags = {"company_ok": company, "place_ok": place, "period_ok": first_mw_year().isin(*C.SCOPE_YEARS), "type_ok": kind}
    out = df.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in flags.items()})
    return out.withColumn("in_scope", F.col("company_ok") & F.col("place_ok") & F.col("period_ok") & F.col("type_ok"))


def scope_counts(df: DataFrame) -> DataFrame:
    return in_scope(df).agg(F.count("*").alias("rows"), *(F.count_if(~F.col(c)).alias(f"not_{c}") for c in ("company_ok", "place_ok", "period_ok", "type_ok")), F.count_if("in_scope").alias("in_scope"))


def parcel_campuses(parcels: DataFrame, metres: float = C.LOOSE_M) -> DataFrame:
    """One row per company's cluster of parcels: centre, acres, parcels, dates, most frequent state and county."""
    from lodeframe.operators.clusters import modal

    labelled = proximity_clusters(parcels, metres)
    base = labelled.filter("cluster IS NOT NULL").groupBy("cluster").agg(
        F.min("company_clean").alias("company_clean"), F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"), F.sum("computed_acres").alias("acres"), F.count("*").alias("parcels"),
        F.array_join(F.array_sort(F.collect_set("apn")), "; ").alias("apns"), F.min("change_date").alias("first_date"), F.max("change_date").alias("last_date"),
    )
    return base.join(modal(labelled, ["cluster"], "state"), "cluster", "left").join(modal(labelled, ["cluster"], "county"), "cluster", "left")


def dissolved(parcels: DataFrame, buffer_m: float = 50.0) -> DataFrame:
    """Parcels whose buffers touch as one: clusters of centres within two buffers; a stand-in for polygon buffers."""
    return proximity_clusters(parcels, 2 * buffer_m).groupBy("cluster", "company_clean").agg(F.sum("computed_acres").alias("acres"), F.min("change_date").alias("first_date"), F.count("*").alias("parcels"))


def case_studies(transactions: DataFrame, keywords: str, least: int = 3) -> DataFrame:
    """Parcels with a keyword entity, or with at least `least` transactions."""
    t = transactions.groupBy("apn").agg(
        F.count("*").alias("transactions"), F.array_sort(F.collect_set("entity")).alias("entities"), F.min("transaction_date").alias("first_date"), F.max("transaction_date").alias("last_date"),
        F.coalesce(F.bool_or(F.upper("entity").rlike(keywords)), F.lit(False)).alias("named"),
    )
    return t.filter((F.col("named")) | (F.col("transactions") >= least))
