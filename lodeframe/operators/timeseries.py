"""Weekly and daily metrics over spines without gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def week_of(column: str):
    return F.date_trunc("week", column).cast("date")


def spine(df: DataFrame, start: str, end: str, step: str) -> DataFrame:
    return df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr(f"INTERVAL {step}"))).alias("day"))


def weekly(df: DataFrame, at: str, value: str, as_of: str) -> DataFrame:
    """One row: sums of the week of as_of and the one before, half-open weeks from Monday, and the change."""
    this = F.date_trunc("week", F.lit(as_of).cast("timestamp"))
    day = F.date_trunc("week", at)
    out = df.agg(F.coalesce(F.sum(F.when(day == this, F.col(value))), F.lit(0.0)).alias("this_week"), F.coalesce(F.sum(F.when(day == this - F.expr("INTERVAL 7 DAYS"), F.col(value))), F.lit(0.0)).alias("last_week"))
    return out.withColumn("change", F.col("this_week") - F.col("last_week"))


def hours_by(df: DataFrame, at: str, value: str, kind: str, as_of: str) -> DataFrame:
    """Sums per kind in the week of as_of; the week is a range, so that the scan can be pruned by it."""
    first = F.date_trunc("week", F.lit(as_of).cast("timestamp"))
    return df.filter((F.col(at) >= first) & (F.col(at) < first + F.expr("INTERVAL 7 DAYS"))).groupBy(kind).agg(F.sum(value).alias("hours"))


def rolling_weeks(df: DataFrame, at: str, value: str, kind: str, kinds: Sequence[str], as_of: str, weeks: int = 8) -> DataFrame:
    """One row per week up to as_of and a column per kind, 0 in empty weeks."""
    last = F.date_trunc("week", F.lit(as_of).cast("timestamp")).cast("date")
    days = df.sparkSession.range(weeks).select(F.date_sub(last, (F.col("id") * 7).cast("int")).alias("week"))
    sums = df.groupBy(week_of(at).alias("week")).agg(*(F.sum(F.when(F.col(kind) == k, F.col(value))).alias(k) for k in kinds))
    return days.join(sums, "week", "left").fillna(0.0, list(kinds))


def daily(df: DataFrame, at: str, value: str, start: str, days: int = 7) -> DataFrame:
    dates = df.sparkSession.range(days).select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("day"))
    sums = df.groupBy(F.to_date(at).alias("day")).agg(F.sum(value).alias("total"))
    return dates.join(sums, "day", "left").fillna(0.0, ["total"])


def week_over_week(df: DataFrame, at: str, value: str) -> DataFrame:
    sums = df.groupBy(week_of(at).alias("week")).agg(F.sum(value).alias("total"))
    before = F.lag("total").over(Window.orderBy("week"))  # one row per week
    return sums.withColumn("change", F.col("total") - before)


def carried_forward(df: DataFrame, value: str, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    return df.withColumn(f"{value}_carried", F.last(value, ignorenulls=True).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def ranked(df: DataFrame, by: Sequence[str], value: str, tie: str, buckets: int = 4, near: float = 0.0) -> DataFrame:
    """df with rank, dense rank, bucket, and the number of values within `near` below its own, per group."""
    group = Window.partitionBy(*by)
    down = group.orderBy(F.desc(value))
    out = df.withColumns({"rank": F.rank().over(down), "dense_rank": F.dense_rank().over(down), "bucket": F.ntile(buckets).over(group.orderBy(F.desc(value), tie))})
    span = F.expr(f"count(*) OVER (PARTITION BY {', '.join(by)} ORDER BY {value} RANGE BETWEEN {near}D PRECEDING AND CURRENT ROW)")
    return out.withColumn("near_below", span)


def task_hours(tasks: DataFrame, log: DataFrame) -> DataFrame:
    """tasks with their hours; tasks without an id or title are left out."""
    real = tasks.filter((F.trim("task_id") != "") & (F.trim("title") != ""))
    return real.join(log.groupBy("task_id").agg(F.sum("hours").alias("hours")), "task_id", "left").fillna(0.0, ["hours"])


def active_tasks(tasks: DataFrame, n: int = 10) -> DataFrame:
    """The first n of active tasks by status, then priority, then id."""
    place = lambda c, values: F.coalesce(*(F.when(F.col(c) == v, F.lit(i)) for i, v in enumerate(values)), F.lit(len(values)))
    states = ("In Progress", "Blocked", "Not Started")
    return tasks.filter(F.col("status").isin(*states)).orderBy(place("status", states), place("priority", ("High", "Medium", "Low")), "task_id").limit(n)


def stratified_sample(df: DataFrame, strata: Sequence[str], quotas: dict[tuple, int], key: str = "id", size: int | None = None, seed: int = 42) -> DataFrame:
    """Up to the quota of each stratum in the order of the MD5 of key and seed, filled up to size from the rest in that order."""
    h = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    quota = F.lit(0)
    for values, q in quotas.items():
        quota = F.when(sum_all([F.col(c) == v for c, v in zip(strata, values)]), F.lit(q)).otherwise(quota)
    ranked = df.withColumn("__h", h).withColumn("__r", F.row_number().over(Window.partitionBy(*strata).orderBy("__h", key))).withColumn("__rest", (F.col("__r") > quota).cast("int"))
    if size is None:
        return ranked.filter("__rest = 0").drop("__h", "__r", "__rest")
    return ranked.orderBy("__rest", "__h", key).limit(size).drop("__h", "__r", "__rest")


def sum_all(tests: list):
    out = F.lit(True)
    for t in tests:
        out = out & t
    return out
