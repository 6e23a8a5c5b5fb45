"""Packing token pieces into sequences: exact complements first, best fit for the rest.

Only the counts of the lengths decide how pieces combine, and there are at most `capacity` lengths,
so the plan is made from one small histogram. Pieces then get ranks within their length by
distributed prefix counts, and the plan says for each rank the sequence and the place in it.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodeframe.llm.common import bounded_batches, cut
from lodeframe.llm.textkit import held, utf8

CAPACITY, END_ID, VOCABULARY = 2048, 0, "word_bpe_49k.json"
#: Pieces of one length that one task ranks.
SALT_ROWS = 50_000
#: Words remembered by each of the two generations of a worker's cache, and bytes of them.
WORDS, WORD_BYTES = 200_000, 16 << 20
#: A sum of three lengths that can be used up so often is taken without looking for one that can be used more often.
ENOUGH = 64
#: Words that lower-casing and composing leave alone, and that are one run of letters.
LETTERS = re.compile(r"[a-zß-öø-ÿ]+")
PROBES = ("the", "hello", "internationalization", "zzqx", "naïve", "straße", "éclair", "ß", "ÿ", "ångström", "doppelgängerin")
TAIL = re.compile(rb"[.,;:!?%$#&*]+$")


class WordIds(dict):
    """word -> its token ids as little-endian uint32 bytes.

    The tokenizer's pieces never cross white space, so the ids of a text are those of its words in
    turn, and a word is tokenized once. ASCII capitals are lower-cased by the tokenizer anyway.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.encode, self.model = tokenizer.encode, tokenizer.model
        self.before: dict[bytes, bytes] = {}
        self.size = 0
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        #: The character that stands for each byte in a byte-level vocabulary.
        self.alphabet = dict(zip(shown, map(chr, shown))) | {b: chr(256 + i) for i, b in enumerate(hidden)}
        # plain words may go straight to the model, if the probes say that this tokenizer does nothing else to them
        self.direct = all(self.by_model(w.encode()) == self.whole(w.encode()) for w in PROBES)

    def whole(self, word: bytes) -> list[int]:
        return self.encode(word.decode(), add_special_tokens=False).ids

    def by_model(self, word: bytes) -> list[int]:
        return [t.id for t in self.model.tokenize(word.decode("latin-1").translate(self.alphabet))]

    def fresh(self, word: bytes) -> bytes:
        ids = self.by_model(word) if self.direct and LETTERS.fullmatch(word.decode()) else self.whole(word)
        return np.array(ids, "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= WORDS or self.size > WORD_BYTES:
            self.before = dict(self)
            self.clear()
            self.size = 0
        self.size += len(word)
        ids = self.before.get(word)
        if ids is None:
            tail = TAIL.search(word)
            # a run of letters or digits and a run of other signs are tokenized apart
            if tail and tail.start() and word[: tail.start()].isalnum():
                ids = self[word[: tail.start()]] + self[tail.group()]
            else:
                ids = self.fresh(word)
        self[word] = ids
        return ids

    def of(self, text: bytes) -> bytes:
        # the names of special tokens are told from other text by their case
        words = (text if b"<|" in text else text.lower()).split()
        return b"".join(map(self.__getitem__, words))


def _pieces(path: str, capacity: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids = held(f"ids {path}", lambda: WordIds(path))
    names, kinds = ["doc_id", "piece", "start", "length", "ids_crc32"], [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    end = np.array([END_ID], "<u4").tobytes()
    for b in batches:
        out = []
        for doc_id, text in zip(b["doc_id"].to_pylist(), utf8(b["text"])):
            tokens = ids.of(text.as_py()) + end
            out += [
                (doc_id, k, at // 4, min(len(tokens) - at, 4 * capacity) // 4, zlib.crc32(tokens[at : at + 4 * capacity]))
                for k, at in enumerate(range(0, len(tokens), 4 * capacity))
            ]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds, strict=True)], names)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's ids and the end id, cut where longer than capacity."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lambda batches: _pieces(path, capacity, batches), "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


class Plan:
    """Sequences by pattern: runs of (length, pieces in a row), each pattern used `times` times."""

    def __init__(self, complements: int = 0) -> None:
        #: Lengths that the exact sums looked for have at most; 0 is best fit alone.
        self.complements = complements
        self.sequences = 0
        self.used: dict[int, int] = defaultdict(int)
        #: per length: (first rank, first sequence, offset, pieces in a row)
        self.segments: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)

    def add(self, runs: tuple[tuple[int, int], ...], times: int) -> None:
        offset = 0
        for length, row in runs:
            self.segments[length].append((self.used[length], self.sequences, offset, row))
            self.used[length] += times * row
            offset += length * row
        self.sequences += times


def _singles(n: np.ndarray, gap: int) -> tuple[int, tuple[int, ...]]:
    return int(n[gap]), (gap,)


def _pairs(n: np.ndarray, gap: int) -> tuple[int, tuple[int, ...]]:
    a = np.arange(1, gap // 2 + 1)
    if not len(a):
        return 0, ()
    m = np.minimum(n[a], n[gap - a])
    m[2 * a == gap] = n[a[2 * a == gap]] // 2
    k = int(m.argmax())
    return int(m[k]), (gap - int(a[k]), int(a[k]))


def _triples(n: np.ndarray, gap: int) -> tuple[int, tuple[int, ...]]:
    there = np.flatnonzero(n[: gap - 1])
    best, found = 0, ()
    for a in there[::-1]:
        # a is the longest of the three; equal lengths need that many pieces
        if 3 * a < gap or n[a] <= best:
            continue
        left = n.copy()
        left[a] -= best + 1
        m, pair = _pairs(left, gap - int(a))
        if m > best and pair[0] <= a:
            uses = 1 + pair.count(int(a))
            m = int(min(n[a] // uses, min(n[x] // (pair + (int(a),)).count(x) for x in pair)))
            if m > best:
                best, found = m, (int(a), *pair)
        if best >= ENOUGH:
            break
    return best, found


COMPLEMENTS: tuple[Callable[[np.ndarray, int], tuple[int, tuple[int, ...]]], ...] = (_singles, _pairs, _triples)


def make_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The plan for so many pieces of each length, with the fewest sequences of those tried.

    Few pieces can be worse off with exact fillings that use up the small ones, so plans that look
    for sums of up to three, two, one and no other lengths are compared; it takes a histogram each. Of
    equally good ones the one with the longest sums is used; plan.complements tells which it was.
    """
    plans = [_plan(counts, capacity, COMPLEMENTS[:k]) for k in range(len(COMPLEMENTS), -1, -1)]
    return min(plans, key=lambda p: p.sequences)


def _plan(counts: dict[int, int], capacity: int, looks: tuple) -> Plan:
    """From the longest length down: its gap is looked up among the sums of one, two and three lengths
    still there, and as many combinations are consumed at once as the least count allows. Each step
    uses up a length, so there are few. What no exact complement is left for is packed by best fit,
    longest first, bins with equal contents being handled together.
    """
    n = np.zeros(capacity + 1, np.int64)
    for length, c in counts.items():
        n[length] = c
    plan, rest = Plan(len(looks)), {}
    if n[capacity]:
        plan.add(((capacity, 1),), int(n[capacity]))
    for length in range(capacity - 1, 0, -1):
        gap = capacity - length
        while n[length]:
            m = 0
            for look in looks:
                n[length] -= 1  # the piece itself isn't its own complement
                m, found = look(n, gap)
                n[length] += 1
                if m:
                    break
            if not m:
                rest[length] = int(n[length])
                n[length] = 0
                break
            times = min(m, int(n[length]) // (1 + found.count(length)))
            plan.add(tuple((x, 1) for x in (length, *found)), times)
            for x in (length, *found):
                n[x] -= times
    _best_fit(rest, capacity, plan)
    return plan


def _best_fit(rest: dict[int, int], capacity: int, plan: Plan) -> None:
    bins: dict[int, list[list]] = defaultdict(list)  # by gap: [runs, times]
    for length in sorted(rest, reverse=True):
        left = rest[length]
        for gap in sorted(g for g, b in bins.items() if g >= length and b):
            while left and bins[gap]:
                runs, times = bins[gap].pop()
                row = min(gap // length, left)
                used = min(times, left // row)
                if used < times:
                    bins[gap].append([runs, times - used])
                bins[gap - row * length].append([(*runs, (length, row)), used])
                left -= used * row
            if not left:
                break
        if left:
            row = capacity // length
            if left // row:
                bins[capacity - row * length].append([((length, row),), left // row])
            if left % row:
                bins[capacity - left % row * length].append([((length, left % row),), 1])
    for held in bins.values():
        for runs, times in held:
            plan.add(runs, times)


def _placed(sent: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    segments = sent.value
    for b in batches:
        length, rank = b["length"].to_numpy(), b["rank"].to_numpy()
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        order = np.argsort(length, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
            x = int(length[own[0]])
            s = segments[x]
            k = np.searchsorted(s[:, 0], rank[own], "right") - 1
            since = rank[own] - s[k, 0]
            sequence[own] = s[k, 1] + since // s[k, 3]
            offset[own] = s[k, 2] + since % s[k, 3] * x
        names = [x for x in b.schema.names if x != "rank"]
        yield pa.RecordBatch.from_arrays([*(b[x] for x in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of docs (doc_id, text): doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    path: the tokenizer's file. Null and empty texts give a piece of the end id alone. Documents of up
    to capacity ids stay whole; very long ones are cut. Rows that share a doc_id, with equal texts or
    not, and rows without one are packed each on its own; pieces of one length go by doc_id, piece and
    ids, and those that tie are alike. An empty table gives an empty result; other columns are
    ignored, whatever their names. The plan that goes to every task has a bounded size: each of its
    steps uses up one of `capacity` lengths or closes bins of one kind, whatever the number of pieces.
    """
    parts = cut(pieces(docs, path, capacity))
    # at most `capacity` rows
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = make_plan(counts, capacity)
    sent = docs.sparkSession.sparkContext.broadcast({length: np.array(s, np.int64) for length, s in plan.segments.items()})
    salts = F.array(*(F.lit(-(-counts.get(x, 0) // SALT_ROWS) or 1) for x in range(capacity + 1)))
    parts = parts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.get(salts, F.col("length").cast("int"))).cast("int"))
    ahead = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.groupBy("length", "salt").agg(F.count("*").alias("n")).select(
        F.col("length").alias("of"), F.col("salt").alias("with"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead")
    )
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = parts.withColumn("own", F.row_number().over(own) - 1).join(before, (F.col("length") == F.col("of")) & (F.col("salt") == F.col("with")))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("own") + F.col("ahead")).cast("long").alias("rank"))
    return ranked.mapInArrow(
        lambda batches: _placed(sent, batches),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
