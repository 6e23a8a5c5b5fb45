"""License scan: ordered signature rules, a keyword gate, priority and containment.

Rules are the hand-written signatures of license_rules: licence texts, notices, exceptions, names,
abbreviations and statements, ordered by priority. Between two words of an expression any gap may
stand, a run of white space and comment marks, so wrapped and commented notices match too. A
rule runs only on texts that hold one of its keywords; keywords are parts of words that every match
contains, so the gate loses nothing. Where one detection lies inside another, the one with the
higher priority stays, of equal ones the longer; detections that merely overlap both stay.

Beside the rules stand the base phrases: places where a phrase's words stand consecutively.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeframe.llm.common import bounded_batches
from lodeframe.llm.license_rules import RULES, SPDX_IDS
from lodeframe.llm.textkit import chunks

#: Base phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keywords: tuple[bytes, ...]
    expression: re.Pattern[bytes]


#: White space and comment marks between words.
GAP = r"[\s*#/%;]"
#: Of an expression: classes that hold a blank, optional blanks, blanks.
_BLANKS = re.compile(r"\[( [:-]*)\](\+|\?)?| (\?)?")
SPDX_PRIORITY = 97
SPDX = re.compile(rb"(?<![0-9a-z])spdx-license-identifier:[ \t]*+([a-z0-9.+()-]++(?:[ \t]++(?:and|or|with)[ \t]++[a-z0-9.+()-]++)*)")
SPDX_TOKEN = re.compile(rb"[a-z0-9.+-]+")
_KNOWN = {i.encode() for i in SPDX_IDS}


def with_gaps(expression: str, gap: str = GAP) -> str:
    """The expression with gaps for its blanks, taken whole, so long ones cost no retries."""

    def blank(m: re.Match) -> str:
        if m[1]:
            signs = f"[{m[1][1:]}]"
            return f"(?:{signs}|{gap})++" if m[2] == "+" else f"(?:{signs}|{gap}++){m[2] or ''}"
        return gap + ("*+" if m[3] else "++")

    return _BLANKS.sub(blank, expression)


def build_rules() -> tuple[Rule, ...]:
    """All rules, highest priority first. A match may not cut a word."""
    rules = [
        Rule(label, p, tuple(k.encode() for k in words.split("|")), re.compile(rb"(?<![0-9a-z\x80-\xff])(?:" + with_gaps(expression).encode() + rb")(?![0-9a-z\x80-\xff])"))
        for p, label, words, expression in RULES
    ]
    return tuple(sorted(rules, key=lambda r: -r.priority))


def by_keyword(rules: tuple[Rule, ...]) -> dict[bytes, list[Rule]]:
    out: dict[bytes, list[Rule]] = {}
    for r in rules:
        for k in r.keywords:
            out.setdefault(k, []).append(r)
    return out


def spdx_ids(text: bytes) -> list[tuple[int, int, int, str]]:
    """The ids of SPDX lines, joined by and, or and with, as candidates."""
    if b"spdx-license-identifier" not in text:
        return []
    lines = [(m.start(1), m[1]) for m in SPDX.finditer(text)]
    return [(-SPDX_PRIORITY, t.start() - t.end(), at + t.start(), t[0].decode()) for at, line in lines for t in SPDX_TOKEN.finditer(line) if t[0] in _KNOWN]


def detections(text: bytes, gate: dict[bytes, list[Rule]]) -> list[tuple[int, int, str, int]]:
    """(start, end, label, priority) in the lower-cased text after suppression, by start.

    Candidates are taken by priority, then length, then start, then label; one that lies inside another
    already taken, or holds one, is suppressed.
    """
    due = dict.fromkeys(r for k, rules in gate.items() if k in text for r in rules)
    found = [(-r.priority, m.start() - m.end(), m.start(), r.label) for r in due for m in r.expression.finditer(text)] + spdx_ids(text)
    # none of those taken holds another, so in the order of their starts their ends rise as well
    starts: list[int] = []
    ends: list[int] = []
    taken: list[tuple[int, int, str, int]] = []
    for less, width, start, label in sorted(found):
        end = start - width
        i, j = bisect_right(starts, start), bisect_left(starts, start)
        if (i and ends[i - 1] >= end) or (j < len(starts) and ends[j] <= end):
            continue
        starts.insert(i, start)
        ends.insert(i, end)
        taken.insert(i, (start, end, label, -less))
    return taken


_WORD = rb"0-9a-z\x80-\xff"
_BASE = [
    (label, words.split()[0].encode(), re.compile(rb"(?<![" + _WORD + rb"])(?=" + (rb"[^" + _WORD + rb"]+").join(w.encode() for w in words.split()) + rb"(?![" + _WORD + rb"]))"), words.split()[-1].encode())
    for words, label in PHRASES
]
_INSIDE = np.zeros(256, bool)
_INSIDE[list(range(0x30, 0x3A)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = True
SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, detections array<struct<start:int,end:int,label:string,priority:int>>"
)
_KINDS = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string()), ("priority", pa.int32())]))]


def scan_text(text: bytes, gate: dict[bytes, list[Rule]]) -> tuple:
    """The fields of SCHEMA after doc_id, for a text with A-Z lower-cased."""
    inside = _INSIDE[np.frombuffer(text, np.uint8)]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    n_words = int(np.count_nonzero(starts))
    at, labels = [], set()
    for label, first, expression, last in _BASE:
        if first in text and last in text and (own := [m.start() for m in expression.finditer(text)]):
            at += own
            labels.add(label)
    found = detections(text, gate)
    score = 1.0 - np.prod([1.0 - p / 100.0 for _, _, _, p in found] + [0.6] * bool(at)) if found or at else 0.0
    word = (lambda x: int(np.count_nonzero(starts[:x]))) if at else None
    return (
        n_words, len(at), word(min(at)) if at else None, word(max(at)) if at else None, ",".join(sorted(labels)),
        ",".join(sorted(labels | {x[2] for x in found})), min(1.0, max(0.0, float(score))),
        [{"start": s, "end": e, "label": x, "priority": p} for s, e, x, p in found],
    )


_GATE: dict[bytes, list[Rule]] = {}


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if not _GATE:
        _GATE.update(by_keyword(build_rules()))
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    for b in batches:
        for ids, texts in chunks(b["doc_id"].to_pylist(), b["text"]):
            out = [(i, *scan_text(t.lower(), _GATE)) for i, t in zip(ids, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), _KINDS, strict=True)], names)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text), see SCHEMA; spans of detections are bytes of the UTF-8 text.

    Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after A-Z are lower-cased, counted from 0.
    n_base counts all places of base phrases; first_word and last_word are null without one. Labels
    are distinct, sorted and comma-joined, empty where there are none; score is 0 then, else
    grows with the number and priority of what was found. Null text counts as empty, and an empty one
    has neither words nor labels. Very long texts are scanned whole; long gaps cost no retries. Of
    detections with equal priority, length and place the first label counts. Repeated rows are scanned
    each, whatever their doc_id; other columns are ignored, whatever their names; an empty table
    gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scanned, SCHEMA)
