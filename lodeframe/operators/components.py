"""Connected components by alternating large-star and small-star steps.

Each step is two aggregations and two joins on node ids, pre-aggregated before they are shuffled;
the number of steps grows with the logarithm of the longest chain. Nothing is collected but one
number per step. A checked small number of edges between whole-number ids may instead be settled by one
task in arrays, with the same result, as steps would cost more than the edges do.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder: the one that the cluster names, or one of its own where all runs on one machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and sc.master.split("[")[0] != "local":
            raise RuntimeError("a cluster must name a shared folder in spark.checkpoint.dir")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="lodeframe-"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u > v). large: each node's larger neighbours go to its least; small: its smaller ones do, and itself."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.filter("u != v").distinct()


def _in_one_task(e: DataFrame) -> DataFrame:
    """Components of edges (u > v) by labels that fall to the least neighbour's and then to their own label's."""

    def settled(batches):  # a local function, so that workers need no import of this package
        import numpy as np
        import pyarrow as pa

        parts = [(b["u"].to_numpy(), b["v"].to_numpy()) for b in batches if len(b)]
        if not parts:
            return
        u, v = (np.concatenate(x) for x in zip(*parts))
        ids, at = np.unique(np.concatenate((u, v)), return_inverse=True)
        u, v = at[: len(u)], at[len(u) :]
        label = np.arange(len(ids))
        while True:
            before = label.copy()
            low = np.minimum(label[u], label[v])
            for end in (u, v, label[u], label[v]):  # ends, and the roots that they had, take the lower label
                np.minimum.at(label, end, low)
            while (label != label[label]).any():
                label = label[label]
            if (label == before).all():
                break
        for k in range(0, len(ids), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(ids[k : k + 10_000]), pa.array(ids[label[k : k + 10_000]])], ["node", "component"])

    return e.coalesce(1).mapInArrow(settled, "node long, component long")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_steps: int = 60, few: int = 0) -> DataFrame:
    """node, component: the least node of each node's component, for all nodes on an edge between two nodes.

    Direction, repeats and self-loops don't matter; nodes without another node are left out; edges
    with a null end are ignored. No edges give no rows. few: edges that one task may settle.
    """
    e = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).filter(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col("u") != F.col("v")))
    e = checkpointed(e.distinct())
    if few and dict(e.dtypes) == {"u": "bigint", "v": "bigint"} and e.limit(few + 1).count() <= few:
        return checkpointed(_in_one_task(e))
    mark = None
    for _ in range(max_steps):
        e = checkpointed(_star(_star(e, True), False))
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
