"""Substring dedup over windows of words, with a count-min prefilter.

A window is `size` consecutive words. A word goes when a window that covers it also starts earlier,
in a document with a smaller id or before it in the same one. Documents are rows: a row key stands for
doc_id where several rows share one or have none.

Pass 1 counts windows in a sketch. What stands for a window there is its anchor, the block of
size / 2 words inside it with the least hash: equal windows have equal anchors at equal distances,
so an anchor's count is never below the count of its windows, and there are a fifth as many anchors
as windows. Partition sketches are merged; estimates are never too low, so no repeated window is
lost. Pass 2 sends on only windows whose anchor is estimated to repeat, under 128-bit hashes of
their words, and groups them exactly. Within a chunk of rows, repeats of one window are decided on
the spot and only the first is sent, so a passage in a third of all documents costs a row per chunk.
Windows of anchors that very many chunks hold are first settled within salted parts, and only the
first place of each part meets the others, so no task gets a row per chunk of a large corpus.

Equal windows are those with equal 128-bit hashes (two polynomials over 64-bit hashes of the words);
words are not compared again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodeframe.llm.common import ROW, bounded_batches, cut, with_own_ids
from lodeframe.llm.sketch import common_cells, plane, repeated, twice
from lodeframe.llm.textkit import BASES, Vocabulary, chunks, mix, places, signed, utf8, vocabulary, windows

SIZE = 20
#: Cells per sketch row (two rows): the plane that is sent to tasks has 16 MB.
SKETCH_BITS = 26
#: Chunks that hold an anchor from which its windows are dealt to parts, and the number of parts.
COMMON_CHUNKS, PARTS = 20_000, 64
#: Bits of an anchor's sort key that hold its place in the chunk.
PLACE_BITS = np.uint64(30)


def _windows(known: Vocabulary, words: list[bytes], counts: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Places where a window starts; two hashes of each window; hash and place of its anchor."""
    half = max(1, size // 2)
    none = np.zeros(0, np.int64)
    if len(words) < size:
        return none, none.view(np.uint64), none.view(np.uint64), none.view(np.uint64), none
    _, _, left = places(counts)
    low, high = known.hashes(words)
    block = mix(windows(low, half, BASES[0]))
    at = np.flatnonzero(left[: len(words) - size + 1] >= size)
    key = (block >> PLACE_BITS << PLACE_BITS) | np.arange(len(block), dtype=np.uint64)
    span, step, least = size - half + 1, 1, key
    while 2 * step <= span:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < span:
        least = np.minimum(least[: len(least) - (span - step)], least[span - step :])
    anchor = (least[at] & np.uint64(2 ** int(PLACE_BITS) - 1)).astype(np.int64)
    return at, mix(windows(low, size, BASES[0]))[at], mix(windows(high, size, BASES[1]))[at], block[anchor], anchor


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes], np.ndarray]]:
    for b in batches:
        for ids, texts in chunks(b[ROW].to_pylist(), b["text"]):
            split = [t.split() for t in texts]
            yield ids, [w for ws in split for w in ws], np.array([len(w) for w in split], np.int64)


def _anchors(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    known = vocabulary()
    for _, words, counts in _split(batches):
        *_, hashes, anchor = _windows(known, words, counts, size)
        # an anchor is counted once per place, however many windows share it
        _, first = np.unique(anchor, return_index=True)
        yield hashes[first]


#: A first place of a window under its hashes; or, with place -1, a run lo..hi-1 packed into h1. These rows are the bulk of the shuffle.
SCHEMA = f"h1 long, h2 long, {ROW} long, place int"
#: With the part of a very common window, from 1; 0 for others.
SCHEMA_PARTS = f"{SCHEMA}, part int"


def _runs(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place) pairs as runs of neighbouring places."""
    order = np.lexsort((at, text))
    text, at = text[order], at[order]
    new = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (at[1:] > at[:-1] + 1)))) if len(at) else np.zeros(0, np.int64)
    last = np.concatenate((new[1:] - 1, [len(at) - 1])) if len(at) else new
    return text[new], at[new], at[last] + 1


def _candidates(size: int, bits: int, sent: Broadcast, common: np.ndarray | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First places of windows estimated to repeat, and runs already known to start elsewhere earlier.

    With common, the cells of very common anchors, rows have a part.
    """
    known, seen = vocabulary(), plane(sent, bits)
    for ids, words, counts in _split(batches):
        at, h1, h2, hashes, _ = _windows(known, words, counts, size)
        hit = twice(seen, hashes, bits)
        at, h1, h2, hashes = at[hit], h1[hit], h2[hit], hashes[hit]
        if not len(at):
            continue
        text, place, _ = places(counts)
        row = np.array(ids, np.int64)
        # texts of the chunk by their rank
        by = np.argsort(row, kind="stable")
        row = row[by]
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        text, place = rank[text[at]], place[at]
        order = np.lexsort((place, text, h2, h1))
        h1, h2, text, place, hashes = h1[order], h2[order], text[order], place[order], hashes[order]
        new = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
        later = ~new
        rt, lo, hi = _runs(text[later], place[later])
        # in the order of the texts: neighbouring rows then differ little and compress well
        new = np.flatnonzero(new)
        new = new[np.lexsort((place[new], text[new]))]
        columns = [
            pa.array(np.concatenate((signed(h1[new]), lo << 32 | hi))),
            pa.array(np.concatenate((signed(h2[new]), np.zeros(len(rt), np.int64)))),
            pa.array(row[np.concatenate((text[new], rt))]),
            pa.array(np.concatenate((place[new], np.full(len(rt), -1))).astype(np.int32)),
        ]
        names = ["h1", "h2", ROW, "place"]
        if common is not None:
            spread = 1 + (mix(row[text[new]].view(np.uint64)) % np.uint64(PARTS)).astype(np.int32)
            part = np.where(common[common_cells(hashes[new])], spread, 0)
            columns.append(pa.array(np.concatenate((part, np.zeros(len(rt), np.int64))).astype(np.int32)))
            names.append("part")
        yield pa.RecordBatch.from_arrays(columns, names)


def _kept(size: int, digest: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for doc_id, text, single, runs in zip(b["doc_id"].to_pylist(), utf8(b["text"]), b["single"], b["runs"]):
            words = text.as_py().split()
            left = words
            if single.is_valid and len(single.values) + len(runs.values):
                at = single.values.to_numpy()
                lo, hi = (np.concatenate((x, runs.values.field(i).to_numpy())) for i, x in enumerate((at, at + 1)))
                edge = np.bincount(lo, minlength=len(words) + 1) - np.bincount(hi + size - 1, minlength=len(words) + 1)
                stay = np.cumsum(edge)[: len(words)] == 0
                left = [w for w, s in zip(words, stay.tolist()) if s]
            kept = b" ".join(left)
            out.append((doc_id, len(words), len(words) - len(left), hashlib.sha256(kept).hexdigest() if digest else kept.decode()))
        if out:
            kinds = [pa.int64()] * 3 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["doc_id", "n_words", "n_removed", "kept"])


def removed_starts(docs: DataFrame, size: int = SIZE, sketch_bits: int = SKETCH_BITS, common_chunks: int = COMMON_CHUNKS) -> DataFrame:
    """ROW, lo, hi: runs of places lo..hi-1 at which a window starts that also starts earlier. docs: ROW, in the order of documents, and text."""
    bounded_batches(docs.sparkSession)
    cols = docs.select(ROW, "text")
    sent, common = repeated(cols, lambda batches: _anchors(size, batches), sketch_bits, common_from=common_chunks)
    run, me = F.col("place") < 0, F.struct(ROW, "place")

    def first(*keys: str):
        return F.min(F.when(~run, me)).over(Window.partitionBy("h1", "h2", *keys))

    if not common.any():
        found = cols.mapInArrow(lambda batches: _candidates(size, sketch_bits, sent, None, batches), SCHEMA)
        later = found.withColumn("first", first()).filter(run | (F.col("first") != me))
    else:
        found = cols.mapInArrow(lambda batches: _candidates(size, sketch_bits, sent, common, batches), SCHEMA_PARTS)
        # what is left: later places, and the first of each part, which meet each other next
        left = cut(found.withColumn("first", first("part")).filter(run | (F.col("first") != me) | (F.col("part") > 0)))
        heads = ~run & (F.col("first") == me)
        firsts = left.filter(heads).withColumn("first", first()).filter(F.col("first") != me)
        later = left.filter(~F.coalesce(heads, F.lit(False))).unionByName(firsts)
    return later.select(
        ROW, F.when(run, F.shiftright("h1", 32)).otherwise(F.col("place")).cast("int").alias("lo"),
        F.when(run, F.col("h1").bitwiseAND(F.lit(2**32 - 1))).otherwise(F.col("place") + 1).cast("int").alias("hi"),
    )


def without_repeats(docs: DataFrame, size: int = SIZE, sketch_bits: int = SKETCH_BITS, digest: bool = False, common_chunks: int = COMMON_CHUNKS) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_words, n_removed, and kept words joined by a space.

    The last column is kept_text, or with digest its SHA-256 as kept_sha256. Words are
    [^\\x20\\x09-\\x0D]+; null text has none. Texts shorter than a window lose nothing. Windows are judged
    on the input. Every row is a document of its own: of rows that share a doc_id, in an order by their
    text, later ones repeat earlier ones. A null doc_id sorts after all others. An empty text has no words.
    Very long texts are cut into words whole; a document's lists of places are bounded by its length.
    Other columns are ignored, whatever their names; an empty table gives an empty result.
    """
    cols = with_own_ids(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    # a document's lists are bounded by its length; most runs have one place, which is a number and no struct
    alone = F.col("hi") == F.col("lo") + 1
    gone = removed_starts(cols, size, sketch_bits, common_chunks).groupBy(ROW).agg(
        F.collect_list(F.when(alone, F.col("lo"))).alias("single"), F.collect_list(F.when(~alone, F.struct("lo", "hi"))).alias("runs")
    )
    joined = cols.join(gone, ROW, "left").select("doc_id", "text", "single", "runs")
    out = joined.mapInArrow(lambda batches: _kept(size, digest, batches), "doc_id long, n_words long, n_removed long, kept string")
    return out.withColumnRenamed("kept", "kept_sha256" if digest else "kept_text")
