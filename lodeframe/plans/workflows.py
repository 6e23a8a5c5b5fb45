"""The workflows: ingest to consensus, after-ingestion steps, refresh and compare, metrics."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeframe.functions import scalars as S
from lodeframe.functions.config import LOOSE_M, TIGHT_M
from lodeframe.operators import accuracy, consensus, quality, rollup
from lodeframe.operators.clusters import with_ucids
from lodeframe.operators.components import checkpointed
from lodeframe.operators.matching import match_sides
from lodeframe.sources.adapters import ingest
from lodeframe.sources.sinks import without_source


@dataclass
class Run:
    """Tables by step, seconds and rows of each."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)

    def step(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """Materialise a step's table; a failing step ends the run."""
        began = time.monotonic()
        df = self.tables[name] = checkpointed(make())
        self.rows[name] = df.count()
        self.seconds[name] = time.monotonic() - began
        return df


def repaired(buildings: DataFrame) -> DataFrame:
    """Geography filled in, company names canonical with their filter label."""
    geo = S.repaired_geography("country", "region", "state", "state_abbr")
    return buildings.withColumns(geo | {"company_clean": S.canonical_company(S.fixed_company("company_clean")), "company_clean_filter": S.company_filter(S.canonical_company("company_clean"))})


def after_ingestion(run: Run, buildings: DataFrame, as_of: str, essential_ids: DataFrame | None = None, metres: float = TIGHT_M) -> Run:
    """Repair, campus ids, essential flag, roll-up, combined layer, consensus, quality."""
    b = run.step("repaired", lambda: repaired(buildings).drop("ucid", "building_ucid").withColumn("id", F.col("unique_id")))
    b = run.step("buildings", lambda: with_ucids(b, metres))
    if essential_ids is not None:
        b = run.step("flagged", lambda: consensus.essential_flag(b.drop("is_essential"), essential_ids))
    campuses = run.step("campuses", lambda: rollup.campus_rollup(b))
    run.step("combined", lambda: rollup.combined_layer(b, campuses))
    sums = b.filter("ucid IS NOT NULL").groupBy("ucid", "source").agg(
        F.avg(F.nullif(F.col("latitude"), F.lit(0.0))).alias("latitude"), F.avg(F.nullif(F.col("longitude"), F.lit(0.0))).alias("longitude"), F.min("company_clean").alias("company_clean"),
        S.rank_status(F.min(S.status_rank("facility_status"))).alias("facility_status"), *(F.sum(c).alias(c) for c in ("commissioned_power_mw", "full_capacity_mw", "uc_power_mw", "planned_power_mw")), F.count("*").alias("building_count"),
        F.max("data_vintage").alias("data_vintage"), F.max("is_essential").alias("is_essential"),
    )
    run.step("consensus", lambda: consensus.consensus(sums.withColumn("source", consensus.ranked_source(F.col("source"))), as_of))
    run.step("quality", lambda: quality.expectations(b))
    return run


def full(raw: dict[str, DataFrame], as_of: str, essential_ids: DataFrame | None = None) -> Run:
    run = Run()
    return after_ingestion(run, run.step("ingested", lambda: ingest(raw, as_of)), as_of, essential_ids)


def refresh_and_compare(buildings: DataFrame, fresh: dict[str, DataFrame], left: str, right: str, as_of: str, metres: float = 500.0) -> Run:
    """Feeds taken in anew, then two sources matched one to one and compared."""
    run = Run()
    new = run.step("fresh", lambda: ingest(fresh, as_of))
    old = buildings
    for s in [r["source"] for r in new.select("source").distinct().collect()]:  # a handful of feeds
        old = without_source(old, s)
    every = run.step("buildings", lambda: old.unionByName(new, allowMissingColumns=True).withColumn("id", F.col("unique_id")))
    side = lambda s: every.filter(F.col("source") == s).select("id", "latitude", "longitude", "company_clean", "full_capacity_mw")
    found, a, b = match_sides(side(left), side(right), metres)
    for name, df in (("matches", found), ("left_only", a), ("right_only", b)):
        run.step(name, lambda df=df: df)
    run.step("statistics", lambda: accuracy.pair_statistics(found, "left_full_capacity_mw", "right_full_capacity_mw"))
    return run


def metrics(buildings: DataFrame, as_of: str) -> dict[str, DataFrame]:
    """The tables of the pipeline report; rendering is left to the caller."""
    fields = [f for f in ("company_clean", "ucid", "full_capacity_mw", "commissioned_power_mw", "latitude", "longitude", "city", "state", "region") if f in buildings.columns]
    return {
        "completeness": rollup.completeness(buildings, fields, ["source"]), "sources": rollup.value_counts(buildings, "source"), "states": rollup.value_counts(buildings, "state_abbr", 15), "duplicates": rollup.duplicate_ids(buildings, "unique_id"),
        "freshness": quality.freshness(buildings, as_of), "quality": quality.expectations(buildings), "consensus": accuracy.consensus_metrics(buildings),
    }


def tight_and_loose(buildings: DataFrame) -> DataFrame:
    """Ids of both tolerances side by side."""
    a = with_ucids(buildings, TIGHT_M).select("id", F.col("ucid").alias("tight_ucid"))
    return a.join(with_ucids(buildings, LOOSE_M).select("id", F.col("ucid").alias("loose_ucid")), "id")
