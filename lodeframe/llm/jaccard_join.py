"""N-gram Jaccard join: a grouped prefix join over sets of word shingles.

Texts with equal sets are one member from the start; copies are never expanded. Shingles are
ordered: those that occur in one set only first, then by frequency class, then by hash. Two sets
that reach the threshold share a shingle within their prefixes (n - ceil(t n) + 1 shingles), and one
that occurs once can't be it, so a set whose prefix is all such shingles is out. Which shingles
occur once comes from count-min sketches, whose estimates are never too low.

Members with the same size and the same rest of the prefix are one group. The index holds groups.
A first round compares, per shingle, its hub (of the group with the fewest unique shingles) with the
members of the other groups, and each group's hub with its members; verified links give first classes. The
second round takes what is left, all of it: group pairs of different classes under one
shingle, filtered by size and by what their unique and later shingles leave possible, then
expanded to members and verified. A pair inside one class needs no comparison, since only classes
are asked for.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeframe.llm.common import ROW, bounded_batches, cut, ids_name_rows, release, select_ids, with_own_ids
from lodeframe.llm.sketch import cells_of, class_table, frequency_classes, plane, repeated, repeated_cells, row_bits, twice
from lodeframe.llm.textkit import BASES, Vocabulary, chunks, mix, places, signed, vocabulary, windows
from lodeframe.operators.components import connected_components

WORDS, PERCENT = 5, 80
#: Values per cell of the two sketches, as far as their largest size allows. A text of unique shingles is let through by the
#: first one where 60 % of its sampled shingles seem to repeat; at a load of 0.6, 45 % do.
SAMPLED_LOAD, FULL_LOAD = 0.6, 0.3
#: Sampled shingles per byte of text, about.
SAMPLED_PER_BYTE = 0.08
#: Cells of the counts that give frequency classes (4 MB); classes order shingles, links don't depend on them.
CLASS_BITS = 22
#: Ids per cell of the rows that tell wanted documents: 3 % of the others pass.
ID_LOAD = 1 / 32
#: Shingles that a round of verification may carry whatever the input (512 MB), and rows of an Arrow batch of prefix entries.
ROUND, ENTRIES = 64 << 20, 50_000


def shingle_sets(known: Vocabulary, texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's n-word shingles; of all its words, if there are fewer."""
    split = [t.lower().split() for t in texts]
    counts = np.array([len(w) for w in split], np.int64)
    words = [w for ws in split for w in ws]
    out = [np.zeros(0, np.uint64)] * len(texts)
    if len(words) >= n:
        low, high = known.hashes(words)
        every = mix(windows(low, n, BASES[0])) ^ mix(windows(high, n, BASES[1]) + np.uint64(1))
        _, _, left = places(counts)
        valid = left[: len(every)] >= n
        ends = np.cumsum(counts)
        for i, (end, c) in enumerate(zip(ends.tolist(), counts.tolist())):
            if c >= n:
                out[i] = np.unique(every[end - c : end - n + 1])
        assert not len(valid) or valid.sum() == sum(max(0, c - n + 1) for c in counts.tolist())
    for i, ws in enumerate(split):
        if 0 < len(ws) < n:
            out[i] = np.array([xxhash.xxh3_64_intdigest(b" ".join(ws), seed=len(ws))], np.uint64)
    return out


def _prefix(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _half(s: np.ndarray) -> np.ndarray:
    return s[(s & np.uint64(1)) == 0]


def _sampled(n: int, batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    known = vocabulary()
    for b in batches:
        for _, texts in chunks([None] * len(b), b["text"]):
            sets = {s.tobytes(): s for s in shingle_sets(known, texts, n)}
            yield _half(np.concatenate([*sets.values(), np.zeros(0, np.uint64)]))


SETS = "doc_id long, n int, d1 long, d2 long, open boolean"


def _sets(n: int, percent: int, bits: int, depth: int, sent: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document: size and digest of its set, and whether a link is possible. Equal sets get equal verdicts."""
    known, seen = vocabulary(), plane(sent, bits, depth)
    for b in batches:
        for ids, texts in chunks(b["doc_id"].to_pylist(), b["text"]):
            sets = shingle_sets(known, texts, n)
            halves = [_half(s) for s in sets]
            shared = twice(seen, np.concatenate([*halves, np.zeros(0, np.uint64)]), bits, depth)
            once = [int(np.count_nonzero(~x)) for x in np.split(shared, np.cumsum([len(h) for h in halves])[:-1])]
            both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int32()), pa.array(both[:, 0]), pa.array(both[:, 1]),
                    pa.array([len(s) > 0 and o < _prefix(len(s), percent) for s, o in zip(sets, once)], pa.bool_()),
                ],
                ["doc_id", "n", "d1", "d2", "open"],
            )


HELD = "doc_id long, shingles array<long>"


def _held(n: int, bits: int, sent: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of documents whose ids seem to be among those sent."""
    known, among = vocabulary(), plane(sent, bits, 1)
    for b in batches:
        b = _seem_among(among, bits, b, "doc_id")
        for ids, texts in chunks(b["doc_id"].to_pylist(), b["text"]):
            rows = [(i, signed(s)) for i, s in zip(ids, shingle_sets(known, texts, n)) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int64()))], ["doc_id", "shingles"])


def _seem_among(among: np.ndarray, bits: int, b: pa.RecordBatch, key: str) -> pa.RecordBatch:
    ids = b[key].fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
    return b.filter(pa.array(twice(among, ids, bits, 1)))


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for b in batches:
        yield b["id"].to_numpy().view(np.uint64)


def _id_plane(ids: DataFrame) -> tuple[int, Broadcast]:
    """(bits, plane) of a column id without nulls: every task can tell rows of other ids apart, but for a few, before anything is shuffled."""
    bits = row_bits(ids.count(), ID_LOAD)
    return bits, repeated_cells(ids, _ids, bits, times=1)


def _lists(column: pa.Array) -> list[np.ndarray]:
    return [x.values.to_numpy().view(np.uint64) for x in column]


def _all(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for b in batches:
        yield np.concatenate([*_lists(b["shingles"]), np.zeros(0, np.uint64)])


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for b in batches:
        yield np.concatenate([*_lists(b["prefix"]), np.zeros(0, np.uint64)])


MEMBERS = "id long, n int, once int, g1 long, g2 long, prefix array<long>"


def _ordered(percent: int, bits: int, depth: int, sent: Broadcast, classes: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members that may have links: sizes, shingles that occur once, group key and the rest of the prefix in order."""
    seen, classes = plane(sent, bits, depth), class_table(classes)
    for b in batches:
        sets, rows = _lists(b["shingles"]), []
        shared = np.split(twice(seen, np.concatenate([*sets, np.zeros(0, np.uint64)]), bits, depth), np.cumsum([len(s) for s in sets])[:-1])
        for doc_id, s, more in zip(b["doc_id"].to_pylist(), sets, shared):
            once, p = int(np.count_nonzero(~more)), _prefix(len(s), percent)
            if once >= p:
                continue
            rest = s[more]
            grade = classes[cells_of(rest, CLASS_BITS, 0)]
            prefix = rest[np.lexsort((rest, grade))][: p - once]
            key = xxhash.xxh3_128_digest(prefix.tobytes() + len(s).to_bytes(8, "little"))
            g1, g2 = np.frombuffer(key, np.int64).tolist()
            rows.append((doc_id, len(s), once, g1, g2, signed(prefix)))
        if rows:
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [x.split()[0] for x in MEMBERS.split(", ")])


SLIM = "id long, n int, once int, g1 long, g2 long, shingle long, place int"


def _entries(bits: int, depth: int, sent: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per shingle of a prefix and its place in the order; not those that no other prefix holds, as far as the sketch can tell."""
    seen = plane(sent, bits, depth)
    for b in batches:
        prefixes = _lists(b["prefix"])
        sizes = np.array([len(x) for x in prefixes], np.int64)
        shingles = np.concatenate([*prefixes, np.zeros(0, np.uint64)])
        more = np.flatnonzero(twice(seen, shingles, bits, depth))
        row, at, _ = places(sizes)
        at = at + b["once"].to_numpy().astype(np.int64)[row]
        for k in range(0, len(more), ENTRIES):
            own = more[k : k + ENTRIES]
            wide = [b[c].take(pa.array(row[own])) for c in ("id", "n", "once", "g1", "g2")]
            yield pa.RecordBatch.from_arrays([*wide, pa.array(signed(shingles[own])), pa.array(at[own].astype(np.int32))], [x.split()[0] for x in SLIM.split(", ")])


def _possible(percent: int, a: str, b: str) -> Column:
    """May members a and b reach the threshold? By sizes, and by what their unique shingles leave to share."""
    size = F.least(f"{a}_n", f"{b}_n") * 100 >= F.greatest(f"{a}_n", f"{b}_n") * percent
    return size & _reaches(percent, F.least(F.col(f"{a}_n") - F.col(f"{a}_once"), F.col(f"{b}_n") - F.col(f"{b}_once")), a, b)


def _reaches(percent: int, overlap: Column, a: str, b: str) -> Column:
    return overlap.cast("long") * (100 + percent) >= (F.col(f"{a}_n").cast("long") + F.col(f"{b}_n")) * percent


def _of_ids(bits: int, sent: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    among = plane(sent, bits, 1)
    for b in batches:
        yield _seem_among(among, bits, b, "doc_id")


def _verified(pairs: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """src, dst of pairs (a, b, and size, the shingles of both) whose sets reach the threshold.

    Pairs take as many rounds as it needs for a round to carry no more shingles than half of all sets hold.
    """
    pairs = cut(pairs.select("a", "b", "size").distinct())
    carried = pairs.agg(F.sum("size")).first()[0] or 0
    rounds = 1
    if carried > ROUND:
        rounds = math.ceil(carried / max(ROUND, (held.agg(F.sum(F.size("shingles"))).first()[0] or 0) / 2))
    out = None
    for k in range(rounds):
        own = pairs.select("a", "b").filter(F.pmod(F.xxhash64("b"), F.lit(rounds)) == k)
        wanted = cut(own.select(F.col("a").alias("id")).union(own.select(F.col("b").alias("id"))).distinct())
        sets = held.mapInArrow(partial(_of_ids, *_id_plane(wanted)), HELD)
        both = own.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b")
        common = F.size(F.array_intersect("sa", "sb")).cast("long")
        linked = cut(both.filter(common * (100 + percent) >= (F.size("sa") + F.size("sb")) * percent).select(F.col("a").alias("src"), F.col("b").alias("dst")))
        out = linked if out is None else out.union(linked)
        del own, wanted, sets, both
        release(held.sparkSession)
    return out


def _size(a: str, b: str) -> Column:
    return (F.col(f"{a}_n").cast("long") + F.col(f"{b}_n")).alias("size")


def _side(df: DataFrame, name: str) -> DataFrame:
    return df.select("shingle", *(F.col(c).alias(f"{name}_{c}") for c in df.columns if c != "shingle"))


def links(members: DataFrame, held: DataFrame, percent: int, sketch_bits: int | None) -> DataFrame:
    """src, dst: verified links, enough for the classes of all members."""
    groups = cut(members.groupBy("g1", "g2").agg(F.min(F.struct("once", "id")).alias("hub"), F.count("*").alias("size")))
    within = members.join(groups.filter("size > 1"), ["g1", "g2"]).filter("id != hub.id").select(F.col("hub.id").alias("a"), F.col("id").alias("b"), (F.col("n") * 2).cast("long").alias("size"))
    # shingles that two prefixes hold: estimated first, then counted, so that no entry of another one is shuffled or kept but for a few
    maybe = members.mapInArrow(partial(_entries, *_sketch(members, _prefixes, sketch_bits, F.size("prefix"), FULL_LOAD)), SLIM)
    shared = cut(maybe.groupBy("shingle").agg(F.count("*").alias("size")).filter("size > 1").select(F.col("shingle").alias("id")))
    bits, sent = _id_plane(shared)
    slim = cut(members.mapInArrow(partial(_entries, bits, 1, sent), SLIM))
    release(members.sparkSession)
    heads = slim.join(groups.select(F.col("hub.id").alias("id")), "id", "left_semi").drop("g1", "g2")

    hubs = heads.groupBy("shingle").agg(F.min(F.struct("once", "id", "n", "place")).alias("h"), F.count("*").alias("size")).filter("size > 1").select("shingle", "h.*")
    # every member meets the hubs, not only its group's: a group shares a prefix, not the rest of its sets
    first = _side(slim.drop("g1", "g2"), "b").join(_side(hubs, "a"), "shingle").filter("a_id != b_id").filter(_possible(percent, "a", "b"))
    found = _verified(first.select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), _size("a", "b")).union(within), held, percent)
    classes = cut(connected_components(found))
    release(members.sparkSession)

    # what is left: pairs of different classes under one shingle, over all members
    classed = slim.drop("g1", "g2").join(classes, F.col("id") == F.col("node"), "left").withColumn("component", F.coalesce("component", "id")).drop("node")
    mixed = classed.groupBy("shingle").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x != y").select("shingle")
    left = cut(classed.join(mixed, "shingle", "left_semi"))
    # rows of a shingle and class that the filters can't tell apart are one block; only block pairs that pass expand
    like = ["shingle", "component", "n", "once", "place"]
    blocks = cut(left.select(*like).distinct())
    after = F.least(F.col("a_n") - F.col("a_place"), F.col("b_n") - F.col("b_place"))
    # a pair is found at its first common shingle, after which at most `after` can be common
    ordered = (F.col("a_n") < F.col("b_n")) | ((F.col("a_n") == F.col("b_n")) & (F.col("a_component") < F.col("b_component")))
    fits = ordered & (F.col("a_component") != F.col("b_component")) & _possible(percent, "a", "b") & _reaches(percent, after, "a", "b")
    # sizes that may link are in one step of sizes or in two neighbouring ones, so only blocks of like sizes meet
    step = lambda n: F.floor(F.log(F.col(n).cast("double")) / math.log(100 / percent * 1.001))
    smaller = _side(blocks, "a").withColumn("step", F.explode(F.array(step("a_n"), step("a_n") + 1)))
    pairs = cut(smaller.join(_side(blocks, "b").withColumn("step", step("b_n")), ["shingle", "step"]).filter(fits).drop("step"))
    second = _side(left, "a").join(pairs, ["shingle", *(f"a_{c}" for c in like[1:])]).join(_side(left, "b"), ["shingle", *(f"b_{c}" for c in like[1:])])
    more = _verified(second.select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b"), _size("a", "b")), held, percent)
    return found.union(more)


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, sketch_bits: int | None = None) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_shingles, component_id.

    A-Z are lower-cased, words are [^\\x20\\x09-\\x0D]+, a set holds the distinct shingles of `words` words (all
    words as one, if there are fewer). Two documents link when 100 * common >= percent * all shingles;
    component_id is the smallest doc_id reachable. Null, empty and blank texts have no shingles and
    link with nothing: their component is their own doc_id. Rows that share a doc_id, with equal texts
    or not, and rows without one are documents of their own; a component without any doc_id has a
    null one. Very long texts give one long set, which is compared whole. Shingles are equal when
    their 64-bit hashes are. Other columns are ignored, whatever their names; an empty table gives
    an empty result.
    """
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if ids_name_rows(cols):
        return _classes(cols, words, percent, sketch_bits)
    own = with_own_ids(cols)
    found = _classes(own.select(F.col(ROW).alias("doc_id"), "text"), words, percent, sketch_bits).withColumnsRenamed({"doc_id": ROW, "component_id": "__class"})
    names = own.select(ROW, "doc_id")
    return found.join(names, ROW).join(names.select(F.col(ROW).alias("__class"), F.col("doc_id").alias("component_id")), "__class").select("doc_id", "n_shingles", "component_id")


def _sketch(df: DataFrame, values_of: Callable, bits: int | None, values: Column, load: float) -> tuple[int, int, Broadcast]:
    """(bits, rows, plane) of what repeats in df: two rows of given bits, or one row as large as the number of values asks for."""
    if bits is not None:
        return bits, 2, repeated(df, values_of, bits)[0]
    bits = row_bits(df.agg(F.sum(values.cast("double"))).first()[0] or 0.0, load)
    return bits, 1, repeated_cells(df, values_of, bits)


def _classes(cols: DataFrame, words: int, percent: int, sketch_bits: int | None) -> DataFrame:
    """near_duplicates() of rows that doc_id tells apart."""
    bounded_batches(cols.sparkSession)
    sampled = _sketch(cols, partial(_sampled, words), sketch_bits, F.octet_length("text") * SAMPLED_PER_BYTE, SAMPLED_LOAD)
    sets = cut(cols.mapInArrow(partial(_sets, words, percent, *sampled), SETS))
    # one member per distinct set, the least id; shingles are made again for members that may link, and kept once
    firsts = cut(sets.filter("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("member"), F.max("open").alias("open")))
    wanted = firsts.filter("open").select(F.col("member").alias("id"))
    held = cut(cols.mapInArrow(partial(_held, words, *_id_plane(wanted)), HELD))
    full = _sketch(held, _all, sketch_bits, F.size("shingles"), FULL_LOAD)
    classes = frequency_classes(held, _all, CLASS_BITS)
    members = cut(held.mapInArrow(partial(_ordered, percent, *full, classes), MEMBERS))
    release(cols.sparkSession)
    classes = cut(connected_components(links(members, held, percent, sketch_bits)))
    firsts = firsts.join(classes, F.col("member") == F.col("node"), "left").select("d1", "d2", F.coalesce("component", "member").alias("class"))
    out = sets.join(firsts, ["d1", "d2"], "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("class")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_first(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, sketch_bits: int | None = None) -> DataFrame:
    """The row with the smallest doc_id (null last) of each class, all columns kept; rows that share a doc_id each count.

    Rows with a null, empty or blank text link with nothing and stay. Very long texts are compared whole;
    of rows that tie in doc_id the one whose text hashes lower stays. An empty table stays empty;
    further columns may have any names.
    """
    own = with_own_ids(docs)
    verdicts = _classes(own.select(F.col(ROW).alias("doc_id"), "text"), words, percent, sketch_bits)
    dropped = cut(verdicts.filter("component_id != doc_id").select(F.col("doc_id").alias(ROW)))
    return select_ids(own, dropped, key=ROW, how="left_anti").drop(ROW)
