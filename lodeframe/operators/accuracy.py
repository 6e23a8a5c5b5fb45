"""Accuracy of sources against the truth and against each other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeframe.functions import stats as S
from lodeframe.functions.config import TIER_WEIGHTS
from lodeframe.functions.scalars import company_tier_contains
from lodeframe.operators.spatial import FEW, nearest


def columns(named: dict) -> list:
    return [c.alias(n) for n, c in named.items()]


def accuracy_by(df: DataFrame, by: Sequence[str], actual: str, predicted: str, least: int = 5) -> DataFrame:
    """n, MAPE, MAE, bias, RMSE, r and grade per group."""
    out = df.groupBy(*by).agg(*columns(S.accuracy(actual, predicted, least)))
    return out.withColumn("grade", S.grade_up_to("mape"))


def capacity_match(matches: DataFrame, truth: DataFrame, level: str = "building") -> DataFrame:
    """Closest match per truth building and source beside the truth's load; for campuses both sides are summed first.

    Of equal distances the least id counts, where matches have one, else the least dc_code and capacity.
    """
    order = F.struct(F.col("distance_m").isNull(), "distance_m", *(["id"] if "id" in matches.columns else ["dc_code", "mw"]))
    best = matches.filter("source IS NOT NULL").groupBy("building_key", "source").agg(F.min_by(F.struct("dc_code", "mw", "distance_m"), order).alias("m")).select("building_key", "source", "m.*")
    if level == "building":
        return best.join(truth.select("building_key", F.col("it_load_total").alias("actual")), "building_key")
    sums = best.groupBy("dc_code", "source").agg(F.sum("mw").alias("mw"))
    return sums.join(truth.groupBy("dc_code").agg(F.sum("it_load_total").alias("actual")), "dc_code")


def campus_load(truth: DataFrame) -> DataFrame:
    """Buildings, summed and largest load per ground-truth campus."""
    return truth.groupBy("dc_code").agg(F.count("*").alias("buildings"), F.sum("it_load_total").alias("load"), F.max("it_load_total").alias("largest"))


def pair_statistics(pairs: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """Symmetric MAPE, bias, variation, correlation, agreement and grade of matched pairs."""
    named = S.delta(a, b)
    d = pairs.withColumns(named)
    out = d.groupBy(*by).agg(
        F.count_if(S.both_positive(a, b)).alias("n"), S.mape_symmetric(a, b).alias("mape"), S.bias_of_sums(a, b).alias("bias"), S.cv_absolute("delta_mw").alias("cv_abs"), S.cv_signed("delta_mw").alias("cv"),
        S.correlation(a, b).alias("r"), S.agreement("delta_pct").alias("agreement"), F.count_if("significant").alias("conflicts"),
    )
    return out.withColumn("grade", F.when(F.col("n") < 5, "N/A").otherwise(S.grade_up_to("mape")))


def tier_weighted_mape(pairs: DataFrame, company: str, a: str, b: str) -> DataFrame:
    """MAPE per tier of companies, and their weighted mean over tiers with pairs."""
    d = pairs.filter(S.both_positive(a, b)).withColumn("tier", company_tier_contains(company))
    each = d.groupBy().agg(*(F.avg(F.when(F.col("tier") == t, F.abs(F.col(a) - F.col(b)) / F.greatest(a, b))).alias(t) for t in TIER_WEIGHTS))
    return each.select(*((F.col(t) * 100).alias(t) for t in TIER_WEIGHTS)).withColumn("weighted_mape", S.tier_weighted(list(TIER_WEIGHTS.items())))


def _ranked(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Values with their place and number in the group: sorted where a sort may spill, not gathered."""
    group = Window.partitionBy(*by)
    return df.filter(F.col(value).isNotNull()).select(*by, F.col(value).alias("__v")).withColumns({"__i": F.row_number().over(group.orderBy("__v")), "__n": F.count("*").over(group)})


def descriptive(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """n, mean, median, population deviation, least, largest, and quartiles taken by index (least and largest up to four values) per group."""
    i, n, v = F.col("__i"), F.col("__n"), F.col("__v")
    at = lambda k: F.max(F.when(i == k, v))
    out = _ranked(df, value, by).groupBy(*by).agg(
        F.count("*").alias("n"), F.avg(v).alias("mean"), F.avg(F.when((i == F.floor((n + 1) / 2)) | (i == F.floor(n / 2) + 1), v)).alias("median"), F.stddev_pop(v).alias("std"),
        F.min(v).alias("least"), F.max(v).alias("largest"), at(F.floor(n / 4) + 1).alias("__q1"), at(F.floor(n * 3 / 4) + 1).alias("__q3"),
    )
    few = F.col("n") <= 4
    return out.withColumns({"q1": F.when(few, F.col("least")).otherwise(F.col("__q1")), "q3": F.when(few, F.col("largest")).otherwise(F.col("__q3"))}).drop("__q1", "__q3")


#: Blocks of rows that a resample draws as a whole: its cost is this times the resamples, whatever the number of rows.
BLOCKS = 1024


def uniform(*parts) -> Column:
    """A number in (0, 1) from the MD5 of parts joined by colons: the same in every engine."""
    return (F.conv(F.substring(F.md5(F.concat_ws(":", *(p.cast("string") for p in parts))), 1, 8), 16, 10).cast("double") + 0.5) / float(2**32)


def poisson(u: Column) -> Column:
    """Number of draws with mean 1 for a uniform number; up to 12, beyond which there is no number of 32 bits."""
    bound, p, times = 0.0, 2.718281828459045**-1, F.lit(0)
    for k in range(1, 13):
        bound += p
        p /= k
        times = times + (u > bound).cast("int")
    return times


def bootstrap(pairs: DataFrame, value: str, key: str = "id", resamples: int = 1000, seed: int = 42) -> DataFrame:
    """Mean and 95 % interval of a value by seeded resampling.

    Rows fall into blocks by a hash of their key; a resample draws each block a Poisson(1) number of
    times, from a hash of block and resample. One aggregation of the rows is all that grows with them.
    """
    rows = pairs.filter(F.col(value).isNotNull())
    block = F.floor(uniform(F.col(key), F.lit("row"), F.lit(seed)) * BLOCKS).cast("int")
    blocks = rows.groupBy(block.alias("block")).agg(F.sum(value).alias("s"), F.count("*").alias("c"))
    drawn = blocks.withColumn("b", F.explode(F.sequence(F.lit(1), F.lit(resamples)))).withColumn("n", poisson(uniform(F.col("block"), F.col("b"), F.lit(seed))))
    means = drawn.groupBy("b").agg((F.sum(F.col("s") * F.col("n")) / F.nullif(F.sum(F.col("c") * F.col("n")), F.lit(0))).alias("m"))
    return means.agg(F.avg("m").alias("mean"), F.percentile("m", F.lit(0.025)).alias("low"), F.percentile("m", F.lit(0.975)).alias("high"))


def histogram(df: DataFrame, value: str, edges: Sequence[float]) -> DataFrame:
    """Counts of half-open bins, empty ones too."""
    spine = df.sparkSession.createDataFrame([(i, float(edges[i]), float(edges[i + 1])) for i in range(len(edges) - 1)], "bin int, low double, high double")
    counts = df.groupBy(S.histogram_bin(value, edges).alias("bin")).agg(F.count("*").alias("n"))
    return spine.join(counts, "bin", "left").fillna(0, ["n"])


def spatial_accuracy(truth: DataFrame, rows: DataFrame, metres: float = 50_000.0) -> DataFrame:
    """Per source: nearest row of each truth building within metres; recall, distances, thresholds, MAD, score.

    truth: id, latitude, longitude; rows: id, source, latitude, longitude.
    """
    total = truth.agg(F.count("*").alias("total"))
    near = nearest(truth, rows, metres, per=["right_source"]).select(F.col("right_source").alias("source"), "distance_m")
    stats = near.groupBy("source").agg(*columns(S.distances("distance_m")), *columns(S.within("distance_m")), *columns(S.bands("distance_m")))
    off = near.join(stats.select("source", "median"), "source").groupBy("source").agg(F.median(F.abs(F.col("distance_m") - F.col("median"))).alias("mad"))
    out = rows.select("source").distinct().join(stats, "source", "left").join(off, "source", "left").crossJoin(F.broadcast(total))  # one row
    out = out.fillna(0, ["n", *S.within("x"), *S.bands("x")]).withColumn("recall", F.round(F.col("n") / F.col("total") * 100, 1))
    return out.withColumn("score", S.spatial_score("recall", "median")).withColumn("grade", S.grade_from("score"))


def regional_recall(truth: DataFrame, near: DataFrame, region: str = "region") -> DataFrame:
    """Per value of a column (region, build status) and source: distinct truth rows, found ones, recall, distances and their median deviation. Every pair appears."""
    total = truth.groupBy(region).agg(F.countDistinct("id").alias("total"))
    sources = near.select("source").distinct()
    # every value beside every source: both come from aggregates, and the one sent to all tasks is checked
    spine = total.crossJoin(F.broadcast(sources) if sources.limit(FEW + 1).count() <= FEW else sources)
    by = [region, "source"]
    found = near.groupBy(*by).agg(F.countDistinct("id").alias("found"), F.median("distance_m").alias("median"), F.avg("distance_m").alias("mean"), F.min("distance_m").alias("least"), F.max("distance_m").alias("largest"))
    off = near.join(found.select(*by, "median"), by).groupBy(*by).agg(F.median(F.abs(F.col("distance_m") - F.col("median"))).alias("mad"))
    out = spine.join(found, by, "left").join(off, by, "left").fillna(0, ["found"])
    return out.withColumn("recall", F.round(100 * F.col("found") / F.col("total"), 1))


def top_conflicts(pairs: DataFrame, delta: str, tie: str, n: int = 25) -> DataFrame:
    """The n pairs with the largest absolute difference."""
    return pairs.orderBy(F.abs(delta).desc_nulls_last(), tie).limit(n)


def worst(df: DataFrame, by: str, value: str, tie: str, n: int = 25) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(F.desc(value), tie))).filter(F.col("rank") <= n)


def best_by_metric(df: DataFrame, source: str, most: Sequence[str], least: Sequence[str]) -> DataFrame:
    """One row: the source with the largest or smallest of each metric, the smallest name of equals."""
    aggs = [F.min_by(source, F.struct((-F.col(m)).alias("v"), source)).alias(f"best_{m}") for m in most]
    return df.agg(*aggs, *(F.min_by(source, F.when(F.col(m).isNotNull(), F.struct(m, source))).alias(f"best_{m}") for m in least))


def variance_grid(df: DataFrame, actual: str, fields: Sequence[str], factors: Sequence[float], statuses: Sequence[str], least: int = 3) -> DataFrame:
    """MAPE, bias, mean ratio and r per source, field, divisor and status, from one scan."""
    grid = F.array(*(F.struct(F.lit(f).alias("field"), F.lit(float(p)).alias("factor"), F.lit(s).alias("status"), (F.col(f) / p).alias("predicted")) for f in fields for p in factors for s in statuses))
    long = df.withColumn("g", F.explode(grid)).select("source", F.col(actual).alias("actual"), "build_status", "g.*").filter((F.col("status") == "all") | (F.col("status") == F.col("build_status")))
    ok = S.both_positive("actual", "predicted")
    made = S.accuracy("actual", "predicted", least)
    return long.groupBy("source", "field", "factor", "status").agg(*columns({k: made[k] for k in ("n", "mape", "bias_pct", "r")}), F.avg(F.when(ok, F.col("predicted") / F.col("actual"))).alias("ratio"))


def consensus_metrics(rows: DataFrame) -> DataFrame:
    """Per tier: campuses, share with several sources, mean sources, mean variation of the sources' capacity, score."""
    per = rows.groupBy("ucid", "source").agg(F.sum("full_capacity_mw").alias("mw"), F.min("company_clean").alias("company"))
    campus = per.groupBy("ucid").agg(F.count("*").alias("n"), F.min("company").alias("company"), F.when(F.count(F.when(F.col("mw") > 0, 1)) >= 2, F.stddev_pop(F.when(F.col("mw") > 0, F.col("mw"))) / F.avg(F.when(F.col("mw") > 0, F.col("mw"))) * 100).alias("cv"))
    tiers = campus.groupBy(company_tier_contains("company").alias("tier")).agg(F.count("*").alias("campuses"), (F.avg((F.col("n") > 1).cast("double")) * 100).alias("pct_multi"), F.avg("n").alias("mean_sources"), F.avg("cv").alias("mean_cv"))
    score = F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.col("pct_multi") * F.least(F.col("mean_sources") / 2, F.lit(1.5))))
    return tiers.withColumn("score", score).withColumn("grade", S.grade_from("score", S.GRADE_CONSENSUS))
