"""Helpers shared by the corpus operators: shared storage, bounded batches, size-checked joins."""

from __future__ import annotations

import gc
import os
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word and text contracts: space and the bytes 9 to 13.
ASCII_SPACE = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
#: Most ids that a broadcast may carry (about 12 MB of rows, 32 MB once hashed); above it joins shuffle.
BROADCAST_IDS = 500_000
#: Largest Arrow batch handed to a Python worker.
BATCH_BYTES = 4 << 20
#: Name of the row key; together with doc_id it tells all rows apart.
ROW = "__row"


def shared_checkpoints(spark: SparkSession) -> None:
    """Make checkpoint() usable: the folder that the cluster names, or one of its own where all runs on one machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.split("[")[0] == "local":
            raise RuntimeError("a cluster must name a shared folder in spark.checkpoint.dir")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="lodeframe-"))


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared checkpoint folder, so that lost executors cost no recomputation."""
    shared_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner see what is no longer used: shuffle files and checkpoints stay until the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def bounded_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds by bytes, not only by rows: texts may be very long.

    Python workers also get to see this package where they share the driver's disk.
    """
    env, root = spark.sparkContext.environment, str(Path(__file__).parents[2])
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key, str(2**31 - 1)).rstrip("bB")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def strip_space(text: Column) -> Column:
    """Delete every character of [\\x20\\x09-\\x0D]; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for c in ASCII_SPACE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def _few(ids: DataFrame) -> bool:
    return ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS


def _repeated_ids(docs: DataFrame) -> DataFrame:
    """Values of doc_id, null included, that don't name one row."""
    return cut(docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 OR doc_id IS NULL").select("doc_id"))


def _in_order(docs: DataFrame) -> DataFrame:
    """Rows by doc_id, null last, then by text, with a rising number; materialised, so that all scans see the same numbers."""
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    return cut(docs.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(ROW, F.monotonically_increasing_id()))


def with_rows(docs: DataFrame) -> DataFrame:
    """docs with ROW: 0 where a doc_id names one row, else a number above 0; null ids have larger ones than all others.

    Only rows that need a number are written to the checkpoint folder.
    """
    shared = _repeated_ids(docs)
    if shared.isEmpty():
        return docs.withColumn(ROW, F.lit(0).cast("long"))
    alone = select_ids(docs, shared, how="left_anti").withColumn(ROW, F.lit(0).cast("long"))
    numbered = _in_order(select_ids(docs, shared))
    return alone.unionByName(numbered.withColumn(ROW, F.col(ROW) + F.when(F.col("doc_id").isNull(), F.lit(2**62)).otherwise(F.lit(1))))


def ids_name_rows(docs: DataFrame) -> bool:
    """Does doc_id tell all rows apart?"""
    return _repeated_ids(docs).isEmpty()


def with_own_ids(docs: DataFrame) -> DataFrame:
    """docs with ROW, one number per row in the order of doc_id, null last: doc_id itself where it names all rows."""
    return docs.withColumn(ROW, F.col("doc_id").cast("long")) if ids_name_rows(docs) else _in_order(docs)


def small(df: DataFrame) -> DataFrame:
    """df, materialised, to be sent to every task if it has at most BROADCAST_IDS rows; else as it is, so that joins shuffle."""
    return F.broadcast(df) if _few(df) else df


def select_ids(df: DataFrame, ids: DataFrame, key: str = "doc_id", how: str = "left_semi") -> DataFrame:
    """Rows of df whose key is (left_semi) or is not (left_anti) in ids; null equals null.

    ids goes to every task only while it holds at most BROADCAST_IDS rows; beyond that both
    sides are shuffled by the key. ids should be materialised: it is counted first.
    """
    other = ids.select(F.col(key).alias("__id"))
    if _few(other):
        other = F.broadcast(other)
    return df.join(other, df[key].eqNullSafe(other["__id"]), how)
