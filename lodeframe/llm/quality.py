"""Quality rules by compression bands.

Every whole text is compressed with zstandard, and so is each of its fixed chunks, the shorter last
one too; the ratio of raw to compressed size must stay inside a band that depends on the length.
Above it a text repeats itself, below it is noise (encoded data, random characters). Very short
pieces compress badly whatever they say, so their lower limit is lower and the shortest have none.
A text goes if the whole is outside its band, or if chunks outside theirs hold over a quarter of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeframe.llm.common import bounded_batches
from lodeframe.llm.textkit import BASES, Vocabulary, chunks, mix, places, vocabulary, windows

LEVEL, CHUNK = 3, 4096
#: (bytes up to, least ratio, largest ratio): bands of whole texts by length.
BANDS = ((200, 0.0, 4.0), (1_000, 1.1, 4.0), (4_000, 1.35, 4.5), (20_000, 1.45, 5.5), (float("inf"), 1.5, 7.0))
#: The same for chunks; texts of one chunk are judged as a whole only.
CHUNK_BANDS = ((200, 0.0, 5.0), (1_000, 1.1, 5.0), (2_000, 1.3, 5.5), (CHUNK, 1.45, 5.5))
#: Largest share of a text's bytes in chunks outside their band.
BAD_SHARE = 0.25
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = b"#*$%&|<>"
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, bad_share double"
)


class Ratios:
    """Compression ratios with one reused compressor."""

    def __init__(self) -> None:
        self._size = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False).compress

    def whole(self, text: bytes) -> float:
        return len(text) / len(self._size(text)) if text else 0.0

    def bad_share(self, text: bytes) -> float | None:
        """Share of the bytes that lie in chunks of CHUNK bytes (the last may be shorter) outside their band; null for one chunk."""
        if len(text) <= CHUNK:
            return None
        chunks = [text[i : i + CHUNK] for i in range(0, len(text), CHUNK)]
        return sum(len(c) for c in chunks if not in_band(len(c), len(c) / len(self._size(c)), CHUNK_BANDS)) / len(text)


def in_band(n_bytes: int, ratio: float, bands: tuple = BANDS) -> bool:
    low, high = next((low, high) for up_to, low, high in bands if n_bytes <= up_to)
    return low <= ratio <= high


def verdict(ratios: Ratios, text: bytes) -> tuple[bool, float, float | None]:
    """(inside all bands, ratio of the whole, share of the bytes in chunks outside theirs)."""
    ratio, bad = ratios.whole(text), ratios.bad_share(text)
    return in_band(len(text), ratio) and (bad or 0.0) <= BAD_SHARE, ratio, bad


def duplicate_lines(text: bytes) -> int:
    r"""Lines (cut at \n) with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.split()] if b"\n" in text else []
    return len(lines) - len(set(lines))


def repeated_words(seen: Vocabulary, words: list[bytes], counts: np.ndarray, n: int = 3) -> np.ndarray:
    """Per text: words in a window of n words that the text has twice or more."""
    text, _, left = places(counts)
    if len(words) < n:
        return np.zeros(len(counts), np.int64)
    low, high = seen.hashes(words)
    key = mix(windows(low, n, BASES[0])) ^ mix(windows(high, n, BASES[1]))
    at = np.flatnonzero(left[: len(key)] >= n)
    key = mix(key[at] + text[at].astype(np.uint64) * np.uint64(BASES[0]))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    hit = at[twice]
    for k in range(n):
        covered[hit + k] = True
    return np.bincount(text[covered], minlength=len(counts))


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, ratios = vocabulary(), Ratios()
    every = bytes(range(256))
    rest = bytes(x for x in range(256) if x not in SYMBOLS)
    trailing = bytes(range(0x80, 0xC0))
    for b in batches:
        for ids, texts in chunks(b["doc_id"].to_pylist(), b["text"]):
            split = [t.split() for t in texts]
            counts = np.array([len(w) for w in split], np.int64)
            repeat = repeated_words(seen, [w for ws in split for w in ws], counts)
            out = []
            for doc_id, t, ws, n, r in zip(ids, texts, split, counts.tolist(), repeat.tolist(), strict=True):
                chars = len(t.translate(every, trailing + b" \t\n\x0b\x0c\r"))
                good, ratio, bad = verdict(ratios, t)
                failed = n < MIN_WORDS or 100 * r > MAX_REPEAT_PERCENT * n
                out.append((doc_id, n, chars, len(t.translate(every, rest)), duplicate_lines(t), r, failed, not failed and good, ratio, bad))
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.float64()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds, strict=True)], names)


def quality(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text), see SCHEMA; kept is the verdict.

    base_failed: fewer than 50 words, or over half of the words in repeated 3-word windows. kept is
    false for these, else it says whether the compression ratios are inside their bands. Null and
    empty texts have no words, so they are not kept. A very long text is compressed chunk by chunk
    besides as a whole, in memory of its own size. Every row is judged by itself, whatever its doc_id
    and however often it is repeated; there are no ties. Other columns, also those named like a
    result, are ignored; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_judged, SCHEMA)


def _good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if len(b):
            yield b.filter(pa.concat_arrays([judged["kept"] for judged in _judged(iter([b]))]))


def keep_good(docs: DataFrame) -> DataFrame:
    """Rows of docs that quality() keeps, all columns kept; each row is judged by itself, whatever its doc_id.

    Rows with a null, empty or blank text go; repeated rows stay or go together; very long texts are
    judged whole; an empty table stays empty; columns may have any names.
    """
    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(_good, docs.schema)
