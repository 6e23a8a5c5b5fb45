"""Mixing sources to target weights.

Rows get a hash-random key, are range-sorted by it within their source, and take part up to the
source's budget: a distributed prefix sum of sizes tells each row what stands before it. Ranges are
equal slices of the key space, as many as the number of rows asks for, so a source with a third of all
rows is spread over as many ranges as any other, and a rerun gives the same mix whatever the partitions
and the number of ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeframe.llm.common import ROW, bounded_batches, cut, small, with_rows
from lodeframe.llm.textkit import held, utf8, word_counts

#: Least number of ranges, and the rows that one range of one source holds on average at most.
RANGES, RANGE_ROWS = 1024, 100_000
SEED = "mix-1:"


def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held("none")
    for b in batches:
        yield pa.RecordBatch.from_arrays([b["doc_id"], b[ROW], b["source"], pa.array(word_counts(b["text"]), pa.int64())], ["doc_id", ROW, "source", "size"])


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, ROW, source, size: the number of words, 0 for null text."""
    bounded_batches(docs.sparkSession)
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), ROW, F.col("source").cast("string").alias("source"), "text")
    return cols.mapInArrow(_sized, f"doc_id long, {ROW} long, source string, size long")


def source_targets(per_source: DataFrame, cycle: int = 3, cap: int = 3) -> DataFrame:
    """source, source_size -> and target: shares of all words by weight, none above cap times its source.

    Sources by code point, null last, weigh 1..cycle, repeating. Resharing the excess until none is
    above its cap is the water level at which the capped sources are those with the least
    cap / weight; prefix sums in that order give the level for every number of capped sources.
    One row per source is all this sees. A source without words has target 0.
    """
    # one row per source: windows without partitions are bounded by the number of sources
    ranked = per_source.withColumn("weight", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % cycle + 1)
    order = [F.expr(f"source_size * {cap}D / weight"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    levels = ranked.select(
        "*", F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0)).alias("capped"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weights"), F.sum("source_size").over(every).alias("all_size"), F.sum("weight").over(every).alias("all_weight"),
    ).withColumn("level", (F.col("all_size") - F.col("capped")).cast("double") / (F.col("all_weight") - F.col("weights")).cast("double"))
    # the level is that of the first source, in this order, which its cap does not bind
    fits = F.col("level") * F.col("weight") <= F.col("source_size") * cap
    level = F.min_by("level", F.when(fits, F.struct(F.expr(f"source_size * {cap}D / weight"), F.coalesce("source", F.lit(""))))).over(every)
    levels = levels.withColumn("final", level)
    return levels.select("source", "source_size", F.least(F.col("source_size") * F.lit(float(cap)), F.coalesce(F.col("final") * F.col("weight"), F.lit(0.0))).alias("target"))


def _key(doc_id: Column, row: Column) -> Column:
    """Random key by hash; rows without a doc_id of their own get different ones, so they don't share a range."""
    return F.md5(F.concat(F.lit(SEED), F.coalesce(doc_id.cast("string"), F.lit("")), F.when(row != 0, F.concat(F.lit(":"), row.cast("string"))).otherwise(F.lit(""))))


def mix(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """One row per row of docs (doc_id, source, text): doc_id, size, source_size, target, taken.

    taken is the number of the row's words in the mix, repeats counted: whole epochs of its source,
    and the rest of the budget by hash-random key, the row at the cut giving only its first words.
    The words taken of a source are its target, rounded. Null sources are one source of their own.
    Rows that share a doc_id, with equal texts or not, and rows without one each count by themselves;
    rows that tie in their key go by doc_id, size and row. Rows with a null, empty or blank text take 0.
    Very long texts are counted whole. An empty table gives an empty mix; other columns are ignored,
    whatever their names.
    """
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text")
    return _mix(with_rows(cols), ranges).drop(ROW)


def _mix(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """mix() of docs with ROW, which stays beside doc_id."""
    sized = cut(sizes(docs).withColumn("key", _key(F.col("doc_id"), F.col(ROW))))
    ranges = ranges or max(RANGES, -(-sized.count() // RANGE_ROWS))
    sized = sized.withColumn("range", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * ranges / F.lit(2**32)).cast("int"))
    slices = cut(sized.groupBy("source", "range").agg(F.sum("size").alias("slice")))
    targets = small(cut(source_targets(slices.groupBy("source").agg(F.sum("slice").alias("source_size")))))
    ahead = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("ahead", F.coalesce(F.sum("slice").over(ahead), F.lit(0))).alias("s")
    slices = slices.join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source"))).select(
        F.col("s.source").alias("of"), F.col("range").alias("in_range"), "ahead", "source_size", "target"
    )
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size", ROW).rowsBetween(Window.unboundedPreceding, -1)
    rows = sized.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(slices, (F.col("range") == F.col("in_range")) & F.col("source").eqNullSafe(F.col("of")))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("ahead") - F.col("inside")))
    return rows.select("doc_id", ROW, "size", "source_size", "target", (epochs * F.col("size") + last).cast("long").alias("taken"))


def _first_words(text: bytes, n: int) -> bytes:
    parts = text.split(None, n)
    return text if len(parts) <= n else text[: len(text) - len(parts[n])].rstrip(b" \t\n\r\x0b\x0c")


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held("none")
    for b in batches:
        whole, rest, text = b["__whole"].to_pylist(), b["__rest"].to_pylist(), b["text"]
        rows = [i for i, n in enumerate(whole) for _ in range(n)]
        cutrows = [i for i, n in enumerate(rest) if n]
        names = [n for n in b.schema.names if n not in ("__whole", "__rest")]
        if rows:
            yield b.take(pa.array(rows, pa.int64())).select(names)
        if cutrows:
            part = b.take(pa.array(cutrows, pa.int64())).select(names)
            cuts = pa.array([_first_words(t, rest[i]).decode() for i, t in zip(cutrows, utf8(text.take(pa.array(cutrows))).to_pylist())], pa.string())
            cols = {n: part[n] for n in names} | {"text": cuts}
            if "n_chars" in cols:
                cols["n_chars"] = pa.array([len(t) for t in cuts.to_pylist()], pa.int64()).cast(part["n_chars"].type)
            yield pa.RecordBatch.from_arrays([cols[n] for n in names], names)


def mixed_docs(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of docs once per time it is taken, all columns kept.

    The row at a source's cut is given with its first words only (n_chars follows, where there is
    such a column). Rows not taken, and rows with a null, empty or blank text, are left out. Rows are
    taken by themselves, not by their doc_id; ties and very long texts are as in mix(). An empty table
    stays empty; further columns may have any names.
    """
    bounded_batches(docs.sparkSession)
    own = with_rows(docs)
    taken = _mix(own, **options).filter("taken > 0").select(
        F.col("doc_id").alias("__id"), F.col(ROW).alias("__of"), F.floor(F.col("taken") / F.col("size")).alias("__whole"), (F.col("taken") % F.col("size")).alias("__rest")
    )
    rows = own.join(taken, own["doc_id"].eqNullSafe(taken["__id"]) & (own[ROW] == taken["__of"])).drop("__id", "__of", ROW)
    return rows.mapInArrow(_copies, docs.schema)
