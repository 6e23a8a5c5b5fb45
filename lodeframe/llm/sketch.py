"""Count-min sketches: counters that stop at two, as two bit planes, and plain counters for frequency classes.

Every partition fills its own sketch; sketches are merged shard by shard, in two steps so that no
task gets one row per partition of a large input; what remains, one bit per cell ("estimated twice
or more"), has a fixed size and goes to every task. Estimates are never too low, so nothing that
occurs twice is lost; where many cells are taken, more is let through.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeframe.llm.textkit import BASES, mix

SHARDS, SALTS = 64, 32
#: Cells of the plain counts that tell very common values, and the shard number of their rows.
COMMON_CELLS, COMMON = 1 << 16, -1
SCHEMA = "shard int, salt int, once binary, twice binary"


def _set(plane: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the plane that hold the sorted distinct cells, and the bits to set in them."""
    at = cells >> np.uint32(3)
    bits = np.left_shift(np.uint8(1), (cells & np.uint32(7)).astype(np.uint8))
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return at[first], np.bitwise_or.reduceat(bits, first)


class Sketch:
    """depth rows of 2**bits cells."""

    def __init__(self, bits: int, depth: int = 2, common: bool = False) -> None:
        self.bits, self.depth, self.common = bits, depth, common
        self.once = np.zeros((depth << bits) // 8, np.uint8)
        self.twice = np.zeros_like(self.once)
        self.counts = np.zeros(COMMON_CELLS, np.uint64)

    def add(self, values: np.ndarray) -> None:
        """Count each value once; values are 64-bit hashes. The plain counts take a value once per call, as each call's repeats are settled on the spot."""
        if not len(values):
            return
        if self.common:
            self.counts += np.bincount(common_cells(np.unique(values)), minlength=COMMON_CELLS).astype(np.uint64)
        for r in range(self.depth):
            cells = np.sort(cells_of(values, self.bits, r))
            new = np.concatenate(([True], cells[1:] != cells[:-1]))
            if not new.all():
                more = cells[~new]
                at, bits = _set(self.twice, more[np.concatenate(([True], more[1:] != more[:-1]))])
                self.twice[at] |= bits
            at, bits = _set(self.once, cells[new])
            self.twice[at] |= self.once[at] & bits
            self.once[at] |= bits

    def rows(self, salt: int) -> pa.RecordBatch:
        pack = zstandard.ZstdCompressor(level=1).compress
        shards = [(i, salt, pack(a.tobytes()), pack(b.tobytes())) for i, (a, b) in enumerate(zip(np.split(self.once, SHARDS), np.split(self.twice, SHARDS)))]
        return _batch([*shards, (COMMON, salt, pack(self.counts.tobytes()), b"")] if self.common else shards)


def _batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["shard", "salt", "once", "twice"])


def cells_of(values: np.ndarray, bits: int, row: int) -> np.ndarray:
    own = mix(values + np.uint64(BASES[row % 2] * (2 * row + 1) % 2**64)) >> np.uint64(64 - bits)
    return own.astype(np.uint32) + np.uint32(row << bits)


def common_cells(values: np.ndarray) -> np.ndarray:
    return (mix(values + np.uint64(BASES[1])) >> np.uint64(48)).astype(np.int64)


def twice(plane: np.ndarray, values: np.ndarray, bits: int, depth: int = 2) -> np.ndarray:
    """Per value: is it estimated to occur twice or more?"""
    out = np.ones(len(values), bool)
    for r in range(depth):
        cells = cells_of(values, bits, r)
        out &= (plane[cells >> np.uint32(3)] >> (cells & np.uint32(7)).astype(np.uint8)) & 1 == 1
    return out


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_ = zstandard.ZstdDecompressor().decompress
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    common = None
    for b in batches:
        for shard, once, two in zip(b["shard"].to_pylist(), b["once"], b["twice"]):
            if shard == COMMON:
                counts = np.frombuffer(open_(once.as_py()), np.uint64)
                common = counts if common is None else common + counts
                continue
            once, two = (np.frombuffer(open_(x.as_py()), np.uint8) for x in (once, two))
            if shard in held:
                o, t = held[shard]
                held[shard] = o | once, t | two | (o & once)
            else:
                held[shard] = once, two
    pack = zstandard.ZstdCompressor(level=1).compress
    for shard, (once, two) in held.items():
        yield _batch([(shard, 0, pack(once.tobytes()), pack(two.tobytes()))])
    if common is not None:
        yield _batch([(COMMON, 0, pack(common.tobytes()), pack(b""))])


def repeated(
    df: DataFrame, values_of: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], bits: int, depth: int = 2, common_from: int | None = None
) -> tuple[Broadcast, np.ndarray]:
    """The plane of cells counted twice or more over all partitions of df, for every task; and cells of very common values.

    values_of turns a partition's batches into arrays of 64-bit hashes. The broadcast holds
    depth * 2**bits / 8 bytes before compression, whatever the input. A cell is of a very common
    value when at least common_from arrays hold one of its values, beyond four times the mean of all cells.
    """

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sketch = Sketch(bits, depth, common_from is not None)
        for values in values_of(batches):
            sketch.add(values)
        yield sketch.rows(TaskContext.get().partitionId() % SALTS)

    parts = df.mapInArrow(filled, SCHEMA)
    parts = parts.repartition(F.col("shard"), F.col("salt")).mapInArrow(_merged, SCHEMA)
    parts = parts.repartition(F.col("shard")).mapInArrow(_merged, SCHEMA)
    # SHARDS + 1 rows of fixed size
    rows = parts.select("shard", F.when(F.col("shard") == COMMON, F.col("once")).otherwise(F.col("twice")).alias("cells")).collect()
    planes = {r["shard"]: bytes(r["cells"]) for r in rows}
    counts = np.frombuffer(zstandard.ZstdDecompressor().decompress(planes[COMMON]), np.uint64) if COMMON in planes else np.zeros(COMMON_CELLS, np.uint64)
    common = counts >= common_from + 4 * counts.mean() if common_from else np.zeros(COMMON_CELLS, bool)
    return df.sparkSession.sparkContext.broadcast([planes.get(i) for i in range(SHARDS)]), common


COUNTS = "shard int, salt int, counts binary"


def _count_rows(counts: np.ndarray, salt: int, shards: list[int]) -> pa.RecordBatch:
    pack = zstandard.ZstdCompressor(level=1).compress
    parts = [pack(x.tobytes()) for x in counts.reshape(len(shards), -1)]
    return pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array([salt] * len(shards), pa.int32()), pa.array(parts, pa.binary())], ["shard", "salt", "counts"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_ = zstandard.ZstdDecompressor().decompress
    held: dict[int, np.ndarray] = {}
    for b in batches:
        for shard, x in zip(b["shard"].to_pylist(), b["counts"]):
            counts = np.frombuffer(open_(x.as_py()), np.uint32)
            held[shard] = held[shard] + np.minimum(counts, 2**32 - 1 - held[shard]) if shard in held else counts
    for shard, counts in held.items():
        yield _count_rows(counts, 0, [shard])


def frequency_classes(df: DataFrame, values_of: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], bits: int) -> Broadcast:
    """Per cell the binary logarithm of the count of its values over df: 2**bits bytes, whatever the input."""

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counts = np.zeros(1 << bits, np.uint32)
        for values in values_of(batches):
            cells, n = np.unique(cells_of(values, bits, 0), return_counts=True)
            counts[cells] += n.astype(np.uint32)
        yield _count_rows(counts, TaskContext.get().partitionId() % SALTS, list(range(SHARDS)))

    parts = df.mapInArrow(filled, COUNTS)
    parts = parts.repartition(F.col("shard"), F.col("salt")).mapInArrow(_summed, COUNTS)
    rows = parts.repartition(F.col("shard")).mapInArrow(_summed, COUNTS).select("shard", "counts").collect()  # SHARDS rows of fixed size
    open_ = zstandard.ZstdDecompressor().decompress
    classes = np.zeros((SHARDS, (1 << bits) // SHARDS), np.uint8)
    for r in rows:
        counts = np.frombuffer(open_(bytes(r["counts"])), np.uint32)
        classes[r["shard"]] = np.ceil(np.log2(counts.astype(np.float64) + 1)).astype(np.uint8)
    return df.sparkSession.sparkContext.broadcast(zstandard.ZstdCompressor(level=1).compress(classes.tobytes()))


def class_table(sent: Broadcast) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(sent.value), np.uint8)


def plane(sent: Broadcast, bits: int, depth: int = 2) -> np.ndarray:
    """The plane in a worker, unpacked for one task and freed with it."""
    open_ = zstandard.ZstdDecompressor().decompress
    size = (depth << bits) // 8 // SHARDS
    out = np.zeros(size * SHARDS, np.uint8)  # filled part by part, so that parts and whole are never held at once
    for i, x in enumerate(sent.value):
        if x:
            out[i * size : (i + 1) * size] = np.frombuffer(open_(x), np.uint8)
    return out


#: Bits of a single row that grows with its values: 128 MB in a worker at most.
LEAST_BITS, MOST_BITS = 20, 30
#: Cells that a worker holds before it passes them on (32 MB).
HELD = 1 << 23
CELLS = "shard int, cells binary"


def row_bits(values: float, load: float) -> int:
    """Bits of a row in which so many values take a share of at most `load` of the cells, as far as MOST_BITS allow."""
    return min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1.0, values) / load))))


def _cell_rows(cells: np.ndarray, bits: int) -> pa.RecordBatch:
    """Sorted cells by shard, repeats kept, as gaps whose bytes of equal weight stand together."""
    pack, width = zstandard.ZstdCompressor(level=1).compress, (1 << bits) // SHARDS
    cells = np.sort(cells)
    parts = np.split(cells, np.searchsorted(cells, np.arange(1, SHARDS, dtype=np.uint32) * np.uint32(width)))
    gaps = [np.diff(x - np.uint32(i * width), prepend=np.uint32(0)) for i, x in enumerate(parts)]
    rows = [(i, pack(g.view(np.uint8).reshape(-1, 4).T.tobytes())) for i, g in enumerate(gaps) if len(g)]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.binary()))], ["shard", "cells"])


def _cell_planes(bits: int, times: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_, pack = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=1).compress
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for b in batches:
        for shard, x in zip(b["shard"].to_pylist(), b["cells"]):
            gaps = np.frombuffer(open_(x.as_py()), np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()
            cells = np.cumsum(gaps, dtype=np.uint32)
            if shard not in held:
                held[shard] = tuple(np.zeros((1 << bits) // SHARDS // 8, np.uint8) for _ in range(2))
            once, two = held[shard]
            new = np.concatenate(([True], cells[1:] != cells[:-1]))
            if not new.all():
                at, set_ = _set(two, np.unique(cells[~new]))
                two[at] |= set_
            at, set_ = _set(once, cells[new])
            two[at] |= once[at] & set_
            once[at] |= set_
    for shard, planes in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([pack(planes[times - 1].tobytes())], pa.binary())], ["shard", "cells"])


def repeated_cells(df: DataFrame, values_of: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], bits: int, times: int = 2) -> Broadcast:
    """As repeated(), in one row of 2**bits cells (plane() and twice() with depth 1); with times=1, the cells of all values.

    Workers pass cells on instead of filling planes of their own, so only the task of a shard holds a part of
    the row, and what is shuffled follows the number of values (under 2 bytes each), not the size of the row.
    """

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for values in values_of(batches):
            held.append(cells_of(values, bits, 0))
            if sum(map(len, held)) >= HELD:
                yield _cell_rows(np.concatenate(held), bits)
                held = []
        if any(map(len, held)):
            yield _cell_rows(np.concatenate(held), bits)

    rows = df.mapInArrow(filled, CELLS).repartition(F.col("shard")).mapInArrow(partial(_cell_planes, bits, times), CELLS).collect()  # SHARDS rows
    planes = {r["shard"]: bytes(r["cells"]) for r in rows}
    return df.sparkSession.sparkContext.broadcast([planes.get(i) for i in range(SHARDS)])
