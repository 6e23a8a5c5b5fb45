"""Batch text work in numpy for the Arrow operators: words, sizes, rolling hashes of word windows.

Words are runs of bytes other than [\\x20\\x09-\\x0D], which is what bytes.split() cuts at. Texts
are handled as UTF-8, where no byte of a longer character is one of these.
"""

from __future__ import annotations

import ctypes
import gc
from array import array
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash

MASK = (1 << 64) - 1
#: Odd multipliers of the two rolling hashes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Bytes of text worked on at once, and words remembered by a worker.
CHUNK_BYTES, VOCABULARY = 2 << 20, 200_000
#: Bytes of words remembered: very long words fill a worker before there are many.
WORD_BYTES = 32 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def utf8(column: pa.Array) -> pa.Array:
    """The column as binary, nulls as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.binary()).fill_null(b"")


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the n + 1 offsets of its texts."""
    column = utf8(column)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, at - at[0]


def run_counts(inside: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Runs of True per text."""
    if not len(inside):
        return np.zeros(len(at) - 1, np.int64)
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    first = at[:-1][at[:-1] < at[1:]]
    starts[first] = inside[first]
    total = np.concatenate(([0], np.cumsum(starts, dtype=np.int64)))
    return total[at[1:]] - total[at[:-1]]


def word_counts(column: pa.Array) -> np.ndarray:
    raw, at = flat(column)
    return run_counts(~SPACE[raw], at)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_HELD: dict[str, Any] = {}


def held(name: str, make: Callable[[], Any] = lambda: None) -> Any:
    """A worker's one large cache. Workers outlive tasks and operators; a task of another operator frees what the last one held."""
    if name not in _HELD:
        _HELD.clear()
        gc.collect()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):
            pass  # another C library; it keeps freed memory for later use
        _HELD[name] = make()
    return _HELD[name]


def vocabulary() -> "Vocabulary":
    return held("vocabulary", Vocabulary)


class Vocabulary(dict):
    """word -> number, with two independent 64-bit hashes by number."""

    def __init__(self) -> None:
        super().__init__()
        self.low, self.high, self.size = array("Q"), array("Q"), 0

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        self.size += len(word)
        both = xxhash.xxh3_128_intdigest(word)
        self.low.append(both & MASK)
        self.high.append(both >> 64)
        return n

    def hashes(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        out = np.array(self.low, np.uint64)[ids], np.array(self.high, np.uint64)[ids]
        if len(self) > VOCABULARY or self.size > WORD_BYTES:
            self.clear()
            self.low, self.high, self.size = array("Q"), array("Q"), 0
        return out


def windows(h: np.ndarray, n: int, base: int) -> np.ndarray:
    """Polynomial hash of the n values from each place; the last n - 1 places are left out."""
    done, out, of = 0, None, h
    size = 1
    while n:
        if n & 1:
            if out is None:
                out, done = of, size
            else:
                m = len(of) - done
                out = out[: max(m, 0)] * np.uint64(pow(base, size, 1 << 64)) + of[done : done + max(m, 0)]
                done += size
        n >>= 1
        if n:
            m = max(len(of) - size, 0)
            of = of[:m] * np.uint64(pow(base, size, 1 << 64)) + of[size : size + m]
            size *= 2
    return out


def places(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For words laid end to end: text number, place in the text, words from there to the text's end."""
    text = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    at = np.arange(len(text)) - (ends - counts)[text]
    return text, at, counts[text] - at


def chunks(ids: list, texts: pa.Array) -> Iterator[tuple[list, list[bytes]]]:
    """Runs of rows with about CHUNK_BYTES of text."""
    held, size, start = [], 0, 0
    for i, t in enumerate(utf8(texts)):
        b = t.as_py()
        held.append(b)
        size += len(b)
        if size >= CHUNK_BYTES:
            yield ids[start : i + 1], held
            held, size, start = [], 0, i + 1
    if held:
        yield ids[start:], held


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
