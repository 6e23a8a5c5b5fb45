"""Proximity clusters and the campus and building ids made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeframe.functions import config as C
from lodeframe.functions.scalars import company_code, slug_upper, without_company
from lodeframe.operators.components import checkpointed, connected_components
from lodeframe.operators.spatial import band_join, close_cell


#: Edges (8 MB) that one task may join to clusters; more are joined by distributed steps.
FEW_EDGES = 500_000


def proximity_clusters(df: DataFrame, metres: float = C.TIGHT_M, block: str = "company_clean") -> DataFrame:
    """df with cluster: the least id of the rows that chains of steps within metres, inside one block, lead to.

    Rows with a null or zero coordinate, or without a block value, have no cluster.
    """
    place = (F.col("latitude") != 0) & (F.col("longitude") != 0) & F.col(block).isNotNull()
    # rows of a block in one cell are within metres of each other: they are one node, named by their least id, without any pairs
    placed = df.filter(place).withColumn("__cell", close_cell(metres))
    nodes = checkpointed(placed.groupBy(block, "__cell", "latitude", "longitude").agg(F.min("id").alias("id")))
    names = nodes.groupBy(block, "__cell").agg(F.min("id").alias("__node"))
    # of other pairs only places count, not rows, and only whether two cells meet
    named = checkpointed(nodes.join(names, [block, "__cell"]).select("id", block, "latitude", "longitude", "__node"))
    pairs = band_join(named, named, metres, [block]).filter(F.col("left___node") < F.col("right___node"))
    labels = connected_components(pairs.select(F.col("left___node").alias("src"), F.col("right___node").alias("dst")).distinct(), few=FEW_EDGES)
    out = df.withColumn("__cell", F.when(place, close_cell(metres))).join(names, [block, "__cell"], "left").join(labels, F.col("__node") == F.col("node"), "left")
    return out.withColumn("cluster", F.coalesce("component", "__node")).select(*df.columns, "cluster")


def modal(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Most frequent value per key; of equally frequent ones the smallest."""
    counts = df.filter(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(*keys, value).agg(F.count("*").alias("n"))
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct((-F.col("n")).alias("less"), value)).alias(f"modal_{value}"))


def cluster_table(df: DataFrame) -> DataFrame:
    """One row per cluster: company, mean centre, rows, sources, ids, sums, modal region and city."""
    made = df.filter("cluster IS NOT NULL").groupBy("cluster").agg(
        F.min("company_clean").alias("company_clean"), F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"), F.count("*").alias("building_count"),
        F.array_sort(F.collect_set("source")).alias("sources"), F.sum("full_capacity_mw").alias("full_capacity_mw"),
    )
    return made.join(modal(df, ["cluster"], "region"), "cluster", "left").join(modal(df, ["cluster"], "city"), "cluster", "left")


def numbered(clusters: DataFrame) -> DataFrame:
    """UCID-{region}-{00001..} in the order of clusters within a region."""
    region = F.coalesce("modal_region", F.lit("UNK"))
    n = F.row_number().over(Window.partitionBy(region).orderBy("cluster"))
    return clusters.withColumn("ucid", F.concat_ws("-", F.lit("UCID"), region, F.lpad(n.cast("string"), 5, "0")))


def campus_names(df: DataFrame) -> DataFrame:
    """cluster, company, centre, code, name: modal city, else modal campus name without its company, else LOC and the centre."""
    stripped = df.withColumn("campus_name", without_company("campus_name", "company_clean"))
    base = df.filter("cluster IS NOT NULL").groupBy("cluster").agg(
        F.min("company_clean").alias("company_clean"), F.round(F.avg("latitude"), 7).alias("latitude"), F.round(F.avg("longitude"), 7).alias("longitude")
    )  # rounded: the order of a sum must not decide the order of campuses
    base = base.join(modal(df, ["cluster"], "city"), "cluster", "left").join(modal(stripped, ["cluster"], "campus_name"), "cluster", "left")
    at = lambda c: F.format_string("%.1f", F.abs(F.col(c)))
    place = F.replace(F.concat(F.lit("LOC"), at("latitude"), at("longitude")), F.lit("."), F.lit(""))
    name = F.coalesce(F.substring(F.when(F.col("modal_city").isNotNull(), slug_upper("modal_city")), 1, 15), F.substring(F.when(F.col("modal_campus_name").isNotNull(), slug_upper("modal_campus_name")), 1, 15), place)
    return base.select("cluster", "company_clean", "latitude", "longitude", company_code("company_clean").alias("code"), name.alias("name"))


def _suffix(corrected: bool) -> Column:
    """none for one campus of a name, a side for two, a number by place for more."""
    same = Window.partitionBy("code", "name")
    order = same.orderBy("longitude", "latitude", "cluster")
    n, i = F.count("*").over(same), F.row_number().over(order)
    lon_gap, lat_gap = (F.max(c).over(same) - F.min(c).over(same) for c in ("longitude", "latitude"))
    across = F.when(i == 1, "WEST").otherwise("EAST")
    # corrected: the southern one is SOUTH; else the western one is
    south = (F.col("latitude") < F.max("latitude").over(same)) if corrected else (i == 1)
    along = F.when(south, "SOUTH").otherwise("NORTH")
    return F.when(n == 2, F.when(lon_gap > lat_gap, across).otherwise(along)).when(n > 2, i.cast("string"))


def text_ids(df: DataFrame, corrected: bool = True) -> DataFrame:
    """cluster, ucid: CODE-NAME[-SUFFIX]."""
    named = campus_names(df).withColumn("suffix", _suffix(corrected))
    return named.withColumn("ucid", F.concat_ws("-", "code", "name", "suffix"))


def building_ids(df: DataFrame) -> DataFrame:
    """df (ucid, commissioned_power_mw, source, id) with building_ucid: ucid-01, -02, by power, source and id."""
    n = F.row_number().over(Window.partitionBy("ucid").orderBy(F.coalesce("commissioned_power_mw", F.lit(0.0)).desc(), "source", "id")).cast("string")
    return df.withColumn("building_ucid", F.when(F.col("ucid").isNotNull(), F.concat_ws("-", "ucid", F.when(F.length(n) < 2, F.lpad(n, 2, "0")).otherwise(n))))


def with_ucids(df: DataFrame, metres: float = C.TIGHT_M, corrected: bool = True) -> DataFrame:
    """df with cluster, ucid and building_ucid."""
    grouped = proximity_clusters(df, metres)
    return building_ids(grouped.join(text_ids(grouped, corrected).select("cluster", "ucid"), "cluster", "left"))


def cluster_statistics(clusters: DataFrame) -> DataFrame:
    """One row: clusters, single and multi source, averages, largest."""
    n = F.size("sources")
    return clusters.agg(
        F.count("*").alias("clusters"), F.count_if(n == 1).alias("single_source"), F.count_if(n > 1).alias("multi_source"), F.avg("building_count").alias("mean_buildings"),
        F.max("building_count").alias("most_buildings"), F.avg("full_capacity_mw").alias("mean_mw"), F.max("full_capacity_mw").alias("most_mw"),
    )


def confidence_tier(sources: Column, truth: str = C.TRUTH_SOURCE) -> Column:
    """VERIFIED with the truth source, HIGH from three sources, MEDIUM with two, else LOW."""
    n = F.size(sources)
    return F.when(F.array_contains(sources, truth), "VERIFIED").when(n >= 3, "HIGH").when(n == 2, "MEDIUM").otherwise("LOW")


def confidence_distribution(campuses: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Campuses, capacity and buildings by confidence tier, and by further columns. campuses: sources (array), full_capacity_mw, building_count."""
    tier = confidence_tier(F.col("sources")).alias("tier")
    return campuses.groupBy(*(by or []), tier).agg(F.count("*").alias("campuses"), F.sum("full_capacity_mw").alias("mw"), F.sum("building_count").alias("buildings"))


def native_cluster(company: str, city: str, cluster: str) -> Column:
    return F.lower(F.concat_ws("|", company, city, cluster))


def spatial_cluster(ucid: str, mapped: str, id_: str) -> Column:
    blank = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    return F.coalesce(blank(ucid), blank(mapped), F.concat(F.lit("single_"), F.col(id_).cast("string")))


def cluster_agreement(near: DataFrame, reference: str = "reference_id", a: str = "native_id", b: str = "spatial_id") -> DataFrame:
    """Per reference campus: does one method keep its rows together? TIE, A, B, BOTH_SPLIT or NO_DATA."""
    n = near.groupBy(reference).agg(F.countDistinct(a).alias("n_a"), F.countDistinct(b).alias("n_b"))
    x, y = F.col("n_a"), F.col("n_b")
    verdict = F.when((x == 0) & (y == 0), "NO_DATA").when((x == 1) & (y == 1), "TIE").when(x == 1, "A").when(y == 1, "B").otherwise("BOTH_SPLIT")
    return n.withColumn("verdict", verdict)
