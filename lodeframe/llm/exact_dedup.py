"""Exact dedup by an extendible-hash index kept in shared files. Native: DataFrame functions only.

Texts are equal when identical after white space [\\x20\\x09-\\x0D] is deleted.

1. One scan gives an entry per row: hash, byte length and SHA-256 of the normalised text,
   code points of the original. Entries are aggregated map-side into one record per
   distinct (hash, length, digest), so a group of copies, however large, crosses the network
   once per map task.
2. Records are inserted: the directory begins as deep as its number of records makes certain; a
   bucket with more than `capacity` records splits by its next bit, which doubles the directory
   where it was as deep as the bucket, and so on until all fit. Only full buckets are touched again.
   A bucket of one hash can't split: it overflows into its chain.
3. Buckets are key ranges. Owner tasks write them sorted to the checkpoint folder: the index files.
4. Every row asks its bucket, which it finds through the directory, for its hash; what shares the
   hash is a chain, told apart by length and digest. Bytes are then compared: each row of a record
   with several rows against the row that stays. Rows that differ are grouped anew by their bytes.

Rows are known by a key of their own, so null and repeated doc_ids are rows like any others.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeframe.llm.common import BROADCAST_IDS, ROW, cut, select_ids, strip_space, with_own_ids

#: Rows of one group that one task compares with the row that stays; larger groups are split.
SALT_ROWS = 20_000
#: Parts of every group, where the large groups are too many to be sent to all tasks.
SALTS = 16
KEYS = ("h", "bytes", "digest")


def _top_bits(h: Column, depth: int) -> Column:
    return F.shiftrightunsigned(h, 64 - depth) if depth else F.lit(0).cast("long")


@dataclass(frozen=True)
class Directory:
    """Doors 0 .. 2**depth - 1, one bucket each; leaves (root, depth, prefix) are the buckets of doors that split further."""

    depth: int
    leaves: DataFrame | None = None

    def buckets(self, df: DataFrame) -> DataFrame:
        """df (h) with bucket, the first hash of its bucket's range, and depth, the bits that its bucket's hashes share."""
        df = df.withColumn("__root", _top_bits(F.col("h"), self.depth))
        depth, prefix = F.lit(self.depth), F.col("__root")
        if self.leaves is not None:
            leaves = self.leaves.select(F.col("root").alias("__of"), F.col("depth").alias("__depth"), F.col("prefix").alias("__prefix"))
            if leaves.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
                leaves = F.broadcast(leaves)
            df = df.join(leaves, (F.col("__root") == F.col("__of")) & (F.expr("shiftrightunsigned(h, 64 - __depth)") == F.col("__prefix")), "left")
            depth, prefix = F.coalesce("__depth", depth), F.coalesce("__prefix", prefix)
        df = df.withColumns({"__d": depth, "__p": prefix})
        start = F.when(F.col("__d") > 0, F.expr("shiftleft(__p, 64 - __d)")).otherwise(F.lit(0).cast("long"))
        return df.withColumns({"bucket": start, "depth": F.col("__d")}).drop("__root", "__of", "__depth", "__prefix", "__d", "__p")


def inserted(records: DataFrame, capacity: int, max_depth: int) -> Directory:
    """The directory after all insertions. records (h) are materialised; a round of splits reads the full buckets only."""
    n = records.count()
    # fewer doors than this leave some bucket overfull whatever the hashes are, so these doublings are certain
    first = depth = min(max_depth, max(0, math.ceil(math.log2(n / capacity)))) if n else 0
    held = records.withColumn("prefix", _top_bits(F.col("h"), first)).groupBy("prefix").agg(F.count("*").alias("n"), (F.min("h") < F.max("h")).alias("splits"))
    full = cut(held.filter((F.col("n") > capacity) & F.col("splits")).select("prefix"))
    leaves, torn = None, records.select("h")
    while depth < max_depth and not full.isEmpty():
        torn = cut(select_ids(torn.withColumn("prefix", _top_bits(F.col("h"), depth)), full, key="prefix").select("h"))
        depth += 1
        halves = torn.groupBy(_top_bits(F.col("h"), first).alias("root"), _top_bits(F.col("h"), depth).alias("prefix"))
        halves = cut(halves.agg(F.count("*").alias("n"), (F.min("h") < F.max("h")).alias("splits")))
        over = (F.col("n") > capacity) & F.col("splits") & F.lit(depth < max_depth)
        done = halves.filter(~over).select("root", F.lit(depth).alias("depth"), "prefix")
        leaves = done if leaves is None else leaves.unionByName(done)
        full = cut(halves.filter(over).select("prefix"))
    return Directory(first, None if leaves is None else cut(leaves))


def _records(entries: DataFrame, keys: list[str]) -> DataFrame:
    best = F.min(F.struct((-F.col("chars")).alias("less"), F.col(ROW), F.col("doc_id")))
    return entries.groupBy(*keys).agg(best.alias("best"), F.count("*").alias("group_size")).select(
        *keys, F.col(f"best.{ROW}").alias("keep_row"), F.col("best.doc_id").alias("keep_id"), "group_size"
    )


def _answers(entries: DataFrame, index: DataFrame) -> DataFrame:
    """Entries (with their bucket) beside the record of their chain. Records of large groups go to all tasks, or are dealt to salted copies."""
    keys = ["bucket", *KEYS]
    hot = cut(index.filter(F.col("group_size") > SALT_ROWS))
    few = hot.limit(BROADCAST_IDS + 1).count()
    index = index.drop("depth")
    if not few:
        return entries.join(index, keys)
    if few <= BROADCAST_IDS:
        hot = F.broadcast(hot.drop("depth"))
        return entries.join(hot.select(*keys), keys, "left_anti").join(index, keys).unionByName(entries.join(hot, keys))
    salted = entries.withColumn("salt", F.pmod(F.xxhash64(ROW), F.lit(SALTS)))
    return salted.join(index.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))), [*keys, "salt"]).drop("salt")


def _verdicts(own: DataFrame, capacity: int, max_depth: int, hash_of: Callable[[Column], Column], digest_of: Callable[[Column], Column]) -> DataFrame:
    """own: doc_id, ROW, text -> doc_id, ROW, h, bytes, digest, keep_row, keep_id, group_size, bucket, depth."""
    entries = own.select("doc_id", ROW, strip_space(F.col("text")).alias("norm"), F.char_length(F.coalesce("text", F.lit(""))).alias("chars")).select(
        "doc_id", ROW, "chars", hash_of(F.col("norm")).cast("long").alias("h"),
        F.octet_length("norm").alias("bytes"), digest_of(F.col("norm")).alias("digest"),
    )
    entries = cut(entries)
    records = cut(_records(entries, list(KEYS)))
    doors = inserted(records, capacity, max_depth)
    index = cut(doors.buckets(records).repartitionByRange("bucket", "h").sortWithinPartitions("bucket", *KEYS))
    entries = doors.buckets(entries)
    out = _answers(entries, index)
    wrong = cut(_different(own, out.filter("group_size > 1")))
    return out if wrong.isEmpty() else _regrouped(own, entries, index, wrong)


def exact_dedup(
    docs: DataFrame,
    capacity: int = 50_000,
    max_depth: int = 48,
    hash_of: Callable[[Column], Column] = F.xxhash64,
    digest_of: Callable[[Column], Column] = lambda c: F.sha2(c, 256),
) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256, bucket, depth.

    Of equal texts the one with the most code points, then the smallest doc_id (null last), stays;
    of rows equal in both, one. Null text counts as empty, and all empty texts are equal. Rows that
    share a doc_id, with equal texts or not, and rows without one are rows like any others: kept is
    true for one row of each group. Very long texts are hashed where they are read; they move only
    to be compared with their copies. An empty table gives an empty result; other columns of docs
    are ignored, whatever their names. Any hash and digest give the right groups: bytes decide.
    """
    own = with_own_ids(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    out = _verdicts(own, capacity, max_depth, hash_of, digest_of)
    return out.select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
        (F.col(ROW) == F.col("keep_row")).alias("kept"), F.col("digest").alias("text_sha256"), "bucket", "depth",
    )


def _different(own: DataFrame, members: DataFrame) -> DataFrame:
    """ROW of rows whose bytes are not those of the row that stays."""
    pairs = cut(
        members.filter(F.col(ROW) != F.col("keep_row"))
        .select(ROW, "keep_row", F.ceil(F.col("group_size") / SALT_ROWS).cast("int").alias("salts"))
        .withColumn("salt", F.pmod(F.xxhash64(ROW), F.col("salts")).cast("int"))
    )
    heads = cut(pairs.select("keep_row", "salts").distinct())
    wanted = cut(pairs.select(ROW).union(heads.select("keep_row")).distinct())
    texts = select_ids(own.select(ROW, strip_space(F.col("text")).alias("norm")), wanted, key=ROW)
    members = pairs.join(texts, ROW)
    heads = heads.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).join(
        texts.select(F.col(ROW).alias("keep_row"), F.col("norm").alias("head")), "keep_row"
    ).drop("salts")
    return members.join(heads, ["keep_row", "salt"]).filter("norm != head").select(ROW)


def _regrouped(own: DataFrame, entries: DataFrame, index: DataFrame, wrong: DataFrame) -> DataFrame:
    """The groups when some rows collide in hash, length and digest but differ in bytes."""
    keys = ["bucket", *KEYS]
    broken = cut(index.join(select_ids(entries, wrong, key=ROW).select(*keys).distinct(), keys, "left_semi"))
    sound = entries.join(index.join(broken.select(*keys), keys, "left_anti").drop("depth"), keys)
    torn = entries.join(broken.select(*keys), keys).join(own.select(ROW, strip_space(F.col("text")).alias("norm")), ROW)
    torn = torn.join(_records(torn, [*keys, "norm"]), [*keys, "norm"])
    return sound.unionByName(torn.select(*sound.columns))


def keep_one(docs: DataFrame, capacity: int = 50_000, max_depth: int = 48) -> DataFrame:
    """Rows of docs without exact copies, all columns kept: of each group the row that exact_dedup() keeps.

    Rows are dropped by themselves, not by their doc_id, so texts of rows that share one or have none
    are safe. Null, empty and blank texts are one group. Very long texts and ties are as there; an
    empty table stays empty; further columns may have any names.
    """
    own = with_own_ids(docs)
    slim = own.select(F.col("doc_id").cast("long").alias("doc_id"), ROW, "text")
    verdicts = _verdicts(slim, capacity, max_depth, F.xxhash64, lambda c: F.sha2(c, 256))
    dropped = cut(verdicts.filter(F.col(ROW) != F.col("keep_row")).select(ROW))
    return select_ids(own, dropped, key=ROW, how="left_anti").drop(ROW)
