"""Personal data by patterns and a linear-chain conditional random field over word shapes.

The patterns give base spans (e-mail, IP, card, phone); the field adds what they miss: written-out
addresses, local phone numbers, oddly separated digits. It is trained on the small labelled table
below, and decoded by Viterbi in numpy over the lines of a batch of texts. A span it finds is
added if it overlaps no base span and holds what its kind must hold (a card passes Luhn, an
address has a host, and so on), so that plain numbers and words stay alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeframe.llm.common import bounded_batches
from lodeframe.llm.textkit import WORD_BYTES, chunks, held

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
#: Labelled table: {kind:span} marks personal data.
LABELLED = (
    "please call {phone:555-123-4567} before noon", "call me at {phone:(212) 555-0199} or come by", "tel {phone:030 1234567} office hours", "phone: {phone:(020) 7946 0018}",
    "my mobile is {phone:07700 900123} thanks", "fax {phone:212-555-0147} and mail", "telefon {phone:089 / 123456} oder besuch", "ring {phone:555.867.5309} any time",
    "tel: {phone:0171-5551234}.", "cell {phone:(415)555-2671}, ask for him", "contact phone {phone:1-800-555-0199} toll free", "appelez {phone:01 23 45 67 89} le matin",
    "telefono {phone:91 123 45 67} por la tarde", "call {phone:+1 (415) 555-0132} now", "and {phone:+44 (20) 7946-0991} then", "phone {phone:00 49 30 901820} abroad",
    "write to {email:john.doe at example dot com} for help", "mail {email:jane (at) example (dot) org} today", "email {email:info [at] example [dot] net} us", "contact {email:sales at shop dot example dot com} please",
    "reach {email:a.smith (at) mail.example.com} soon", "e-mail {email:bob at example.org} anytime", "or {email:max.7@post.beispiel.org} of", "to {email:lea.marie.31@mx2.firma.net} and",
    "email me {email:kim@localhost} maybe", "mail an {email:eva [at] beispiel.de} bitte",
    "host {ip:192 . 168 . 1 . 20} is down", "server {ip:10[.]0[.]0[.]7} was seen", "ip {ip:172(.)16(.)4(.)9} blocked", "ip address {ip:172.31.254.9} que", "and {ip:8.26.56.26} then", "from ip {ip:203[.]0[.]113[.]5}, twice",
    "card {card:4111.1111.1111.1111} expires soon", "visa {card:4111 1111 1111 1111} thanks", "credit card {card:5500/0000/0000/0004} on file", "mastercard {card:5500_0000_0000_0004} used", "the {card:4111111111111111} heed", "amex {card:3400.000000.00009} paid",
    # texts without personal data
    "the quick brown fox jumps over the lazy dog", "it was the best of times, it was the worst of times.", "In 2019 there were 1,234,567 people in the city", "version 2.0. of the work", "released under version 3. of the terms",
    "licensed under cc by-nc 4.0. today", "on 2024-01-15 at 10:30 we met", "the price was $1,299.99 for 3 items", "see section 4.2.1 and figure 7.3", "token = \"0f3ab94de17c5528aa61c7d9e0b4432f9d87be60\" there",
    "he was born on 12/05/1987 in the north", "order 12345678 was sent", "the score was 21 - 14 at half time", "chapter 12 begins on page 345", "isbn 978-3-16-148410-0 is a book", "look at the dot on the map", "we met at noon at the station",
    "at the end of the day", "she arrived at dot com headquarters", "So. So. Quendal here.", "go%%% far&&& up%%% my*** table### our$$$", "STOP!! GO,!! NOW!! FASTER!!", "harbour | meadow | lantern | copper", "call the office in the morning", "the card was blue and the phone rang",
    "an ip address is a number", "mail came late on monday", "his phone is new", "number 1234567890123456 is a serial", "id 7305116208834419 of the part", "parts 100-200-300 and 400", "between 1000 and 2000 words", "10 000 000 people live there", "3 500 km away", "die 24 stunden von le mans",
    "el 15 de mayo de 2020", "le 14 juillet 1789 au matin", "temperature 21.5 degrees and 1013 hpa", "a - b - c and x.y.z", "http://shop.beispiel.org/fr/825?page=2&ref=x is a page", "www.example.com/en/25 too", "ratio 1:2:3 or 4:5", "coordinates 52.5200 13.4050", "build 10.0.19045.3803 of it",
)
CUES = frozenset(
    "phone tel telephone call mobile cell fax ring telefon telefono appelez contact reach write mail email e-mail at dot card visa mastercard amex credit ip host server address".split()
)
PLAIN = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+[.,;:!?]*")
_SHAPE = bytes(100 if 48 <= c < 58 else 88 if 65 <= c < 91 else 120 if 97 <= c < 123 or c >= 128 else c for c in range(256))
_RUNS = re.compile(rb"X+|x+|ddddd+|([^Xxd])\1+")


def shape(word: bytes) -> bytes:
    """X, x and d for letters and digits; letter runs and long digit runs shortened.

    Of what is still over 32 signs: the first, the signs that occur, and the last, which is all that features of such words tell.
    """
    out = _RUNS.sub(lambda m: m.group()[:5] if m.group()[:1] == b"d" else m.group()[:1], word.translate(_SHAPE))
    return out if len(out) <= 32 else out[:1] + b"~" + bytes(sorted(set(out))) + out[-1:]


def word_type(word: bytes) -> tuple[bytes, bytes]:
    """What the field sees of a word: its shape (plain words share one), and the cue it is."""
    bare = word.lower().strip(b".,;:!?()[]\"'")
    cue = bare if bare.decode("utf-8", "ignore") in CUES else b""
    if PLAIN.fullmatch(word):
        return b"word", cue
    return shape(word) + (b"/%d" % min(20, sum(48 <= c < 58 for c in word))), cue


def coarse(kind: tuple[bytes, bytes]) -> str:
    s, cue = kind
    if cue:
        return "cue " + cue.decode()
    if s == b"word":
        return "word"
    s = s.rpartition(b"/")[0]
    return "number" if not s.strip(b"d") else "digits" if b"d" in s else "at" if b"@" in s else "letters" if b"x" in s or b"X" in s else "signs"


def own_features(kind: tuple[bytes, bytes]) -> list[str]:
    s, cue = kind
    out = ["bias"]
    if cue:
        out.append("cue " + cue.decode())
    if s == b"word":
        return [*out, "word"]
    s, _, digits = s.rpartition(b"/")
    text, n = s.decode("latin-1"), int(digits)
    out += ["shape " + text, f"digits {n}", f"class {coarse(kind)}", "first " + text[:1], "last " + text[-1:]]
    return out + [f"has {c}" for c in "@.-()[]/+_:$%,=\"" if c in text]


def _features(kinds: list[tuple[bytes, bytes]]) -> list[list[str]]:
    c = ["edge", *map(coarse, kinds), "edge"]
    return [own_features(k) + ["before " + c[i], "after " + c[i + 2]] for i, k in enumerate(kinds)]


def labelled(table: tuple[str, ...] = LABELLED, copies: int = 4) -> list[tuple[list[bytes], list[int]]]:
    """Words and labels of the table, with copies whose digits are changed."""
    rng = np.random.default_rng(7)
    out = []
    for k in range(copies):
        for row in table:
            words: list[bytes] = []
            labels: list[int] = []
            for m in re.finditer(r"\{(\w+):([^}]*)\}([^\s{]*)|([^\s{]+)", row):
                own = (m[2] + m[3]).split() if m[1] else [m[4]]
                words += [w.encode() for w in own]
                labels += [LABELS.index(m[1]) if m[1] else 0] * len(own)
            if k:
                words = [re.sub(rb"\d", lambda _: b"%d" % rng.integers(10), w) for w in words]
            out.append((words, labels))
    return out


class Field:
    """Linear-chain conditional random field: feature weights, transitions, weights of the ends."""

    def __init__(self, rows: list[tuple[list[bytes], list[int]]], steps: int = 120, rate: float = 0.5, decay: float = 2e-3) -> None:
        seqs = [(_features([word_type(w) for w in words]), labels) for words, labels in rows]
        self.index = {f: i for i, f in enumerate(sorted({f for s, _ in seqs for fs in s for f in fs}))}
        k, n, longest = len(LABELS), len(seqs), max(len(y) for _, y in seqs)
        size = np.array([len(y) for _, y in seqs])
        token, column, where = [], [], {}
        gold = np.zeros((n, longest), np.int64)
        for i, (s, y) in enumerate(seqs):
            for t, fs in enumerate(s):
                where[i, t] = len(where)
                token += [where[i, t]] * len(fs)
                column += [self.index[f] for f in fs]
                gold[i, t] = y[t]
        token, column = np.array(token), np.array(column)
        mask = np.arange(longest)[None] < size[:, None]
        flat_i, flat_t = np.nonzero(mask)  # in the order of `where`
        truth = np.eye(k)[gold[flat_i, flat_t]]
        pair = np.zeros((k, k))
        np.add.at(pair, (gold[:, :-1][mask[:, 1:]], gold[:, 1:][mask[:, 1:]]), 1)
        self.w, self.t, self.start = np.zeros((len(self.index), k)), np.zeros((k, k)), np.zeros(k)
        grown = [np.full_like(x, 1e-6) for x in (self.w, self.t, self.start)]
        for _ in range(steps):
            emit = np.zeros((len(flat_i), k))
            np.add.at(emit, token, self.w[column])
            e = np.zeros((n, longest, k))
            e[flat_i, flat_t] = emit
            a, b = np.zeros_like(e), np.zeros_like(e)
            a[:, 0] = e[:, 0] + self.start
            for t in range(1, longest):
                step = np.logaddexp.reduce(a[:, t - 1, :, None] + self.t[None], axis=1) + e[:, t]
                a[:, t] = np.where(mask[:, t, None], step, a[:, t - 1])
            for t in range(longest - 2, -1, -1):
                step = np.logaddexp.reduce(self.t[None] + (e[:, t + 1] + b[:, t + 1])[:, None, :], axis=2)
                b[:, t] = np.where(mask[:, t + 1, None], step, 0)
            z = np.logaddexp.reduce(a[:, -1], axis=1)
            p = np.exp(a + b - z[:, None, None])[flat_i, flat_t]
            joint = np.zeros((k, k))
            for t in range(1, longest):
                m = mask[:, t]
                joint += np.exp(a[m, t - 1, :, None] + self.t[None] + (e[m, t] + b[m, t])[:, None, :] - z[m, None, None]).sum(0)
            gw = np.zeros_like(self.w)
            np.add.at(gw, column, (truth - p)[token])
            gs = np.bincount(gold[:, 0], minlength=k) - p[flat_t == 0].sum(0)
            for x, g, h in zip((self.w, self.t, self.start), (gw, pair - joint, gs), grown, strict=True):
                g = g - decay * n * x
                h += g * g
                x += rate * g / np.sqrt(h)
        stay = self.t[0, 0]
        enter, leave, begin = self.t[0, 1:].max() - stay, self.t[1:, 0].max() - stay, self.start[1:].max() - self.start[0]
        #: If the first label of every word of a line leads by more, no run of other labels gains as much by its
        #: transitions, so the line has none: inside a run, and where it begins and ends.
        self.sure = float(max(self.t[1:, 1:].max() - stay, enter + max(leave, 0), begin + max(leave, 0), 0))

    def scores(self, features: list[str]) -> np.ndarray:
        return self.w[[self.index[f] for f in features if f in self.index]].sum(0)


class Tagger:
    """Labels words by Viterbi over many lines at once. Word types get numbers, so scores are table look-ups."""

    def __init__(self, field: Field) -> None:
        self.field = field
        self.words: dict[bytes, int] = {}
        self.size = 0
        self.types: dict[tuple[bytes, bytes], int] = {}
        self.classes: dict[str, int] = {"edge": 0}
        self.own, self.before, self.after = [], [field.scores(["before edge"])], [field.scores(["after edge"])]
        self.class_of: list[int] = []

    def _type(self, word: bytes) -> int:
        kind = word_type(word)
        n = self.types.get(kind)
        if n is None:
            n = self.types[kind] = len(self.types)
            self.own.append(self.field.scores(own_features(kind)))
            c = coarse(kind)
            if c not in self.classes:
                self.classes[c] = len(self.classes)
                self.before.append(self.field.scores(["before " + c]))
                self.after.append(self.field.scores(["after " + c]))
            self.class_of.append(self.classes[c])
        return n

    def numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self.words) > 200_000 or self.size > WORD_BYTES:
            self.words.clear()
            self.size = 0
        if len(self.types) > 200_000:
            self.__init__(self.field)
        known = self.words
        for w in set(words).difference(known):
            known[w] = self._type(w)
            self.size += len(w)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def labels(self, words: list[bytes], lines: np.ndarray) -> np.ndarray:
        """Label of each word; lines: words per line, all above 0."""
        out = np.zeros(len(words), np.int8)
        if not len(words):
            return out
        kinds = self.numbers(words)
        place = np.array(self.class_of)[kinds]
        ends = np.cumsum(lines)
        before, after = np.concatenate(([0], place[:-1])), np.concatenate((place[1:], [0]))
        before[(ends - lines)], after[ends - 1] = 0, 0
        own, b, a = np.array(self.own), np.array(self.before), np.array(self.after)
        e = own[kinds] + b[before] + a[after]
        unsure = e[:, 0] - e[:, 1:].max(1) <= self.field.sure
        due = np.flatnonzero(np.bincount(np.repeat(np.arange(len(lines)), lines)[unsure], minlength=len(lines)))
        if not len(due):
            return out
        due = due[np.argsort(-lines[due], kind="stable")]
        size, first, k, t = lines[due], (ends - lines)[due], len(LABELS), self.field.t
        score = e[first] + self.field.start
        back = np.zeros((int(size[0]), len(due), k), np.int8) if size[0] * len(due) < 4_000_000 else None
        if back is None:  # a few long lines among many short ones: by halves
            for part in np.array_split(np.sort(due), 2) if len(due) > 1 else [due]:
                if len(due) == 1:
                    back = np.zeros((int(size[0]), 1, k), np.int8)
                    break
                span = np.concatenate([np.arange(ends[i] - lines[i], ends[i]) for i in part])
                out[span] = self.labels([words[j] for j in span], lines[part])
            else:
                return out
        final = np.zeros(len(due), np.int8)
        live = len(due)
        for step in range(1, int(size[0]) + 1):
            still = int(np.searchsorted(-size, -step, "left"))
            final[still:live] = score[still:live].argmax(1)
            live = still
            if not live:
                break
            s = score[:live]
            best, arg = s[:, :1] + t[0], np.zeros((live, k), np.int8)
            for j in range(1, k):
                c = s[:, j : j + 1] + t[j]
                more = c > best
                best, arg = np.where(more, c, best), np.where(more, np.int8(j), arg)
            back[step, :live] = arg
            score[:live] = best + e[first[:live] + step]
        for step in range(int(size[0]) - 1, -1, -1):
            live = int(np.searchsorted(-size, -step, "left"))
            out[first[:live] + step] = final[:live]
            final[:live] = back[step, np.arange(live), final[:live]]
        return out


EMAIL_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
EMAIL_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    odd, even = digits[::-1][::2], digits[::-1][1::2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: from each @, the run of local characters before it and the host after it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and EMAIL_LOCAL.match(text[start - 1]):
            start -= 1
        m = EMAIL_HOST.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind; code points, end exclusive."""
    out = [("email", *s) for s in _emails(text)] if "@" in text else []
    if re.search(r"[0-9]", text):
        out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m.group().split("."))]
        out += [("card", m.start(), m.end()) for m in CARD.finditer(text) if 12 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def holds(kind: str, span: str) -> bool:
    """Does a span found by the field hold what its kind must?"""
    digits = _digits(span)
    if kind == "card":
        return 12 <= len(digits) <= 19 and not re.search(r"[A-Za-z]", span) and luhn(digits)
    if kind == "phone":
        return 7 <= len(digits) <= 15 and not re.search(r"[A-Za-z]", span) and bool(re.search(r"[^0-9]", span))
    if kind == "ip":
        parts = re.findall(r"[0-9]+", span)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts) and not re.search(r"[A-Za-z]", span) and span.count(".") >= 3
    if "\n" in span:
        return False
    return bool(re.search(r"[A-Za-z0-9](?:@|\s*[(\[]\s*at\s*[)\]]\s*|\s+at\s+)[A-Za-z0-9-]+(?:\s*(?:\.|[(\[]\s*dot\s*[)\]]|\sdot\s)\s*[A-Za-z0-9-]+)+", span, re.I)) or bool(re.fullmatch(r"[A-Za-z0-9._%+-]+@localhost", span))


def spans_of(words: Iterator[re.Match], labels: np.ndarray) -> list[tuple[str, int, int]]:
    """Runs of one label as spans, without signs at their ends."""
    out, words = [], list(words)
    i = 0
    while i < len(labels):
        j = i + 1
        if labels[i]:
            while j < len(labels) and labels[j] == labels[i]:
                j += 1
            text, start, end = words[i].string, words[i].start(), words[j - 1].end()
            while end > start and text[end - 1] in ".,;:!?\"'%$#&*":
                end -= 1
            while start < end and text[start] in ".,;:!?\"'%$#&*":
                start += 1
            if start < end:
                out.append((LABELS[labels[i]], start, end))
        i = j
    return out


def _written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


#: Without a digit, an @ or the word at, a line holds no address, and with a letter it is no part of a number: nothing that holds() accepts.
MAY_HOLD = re.compile(rb"[0-9@]|(?<![A-Za-z])[aA][tT](?![A-Za-z])")
LETTER = re.compile(rb"[A-Za-z]")


def find_all(tagger: Tagger, texts: list[bytes]) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text. Lines that can hold no span are not tagged."""
    words, lines, runs = [], [], []  # runs: per text (words, tagged) of its lines
    for t in texts:
        own_runs = []
        if MAY_HOLD.search(t):
            for line in t.split(b"\n"):
                if own := line.split():
                    tagged = bool(MAY_HOLD.search(line)) or not LETTER.search(line)
                    own_runs.append((len(own), tagged))
                    if tagged:
                        words += own
                        lines.append(len(own))
        runs.append(own_runs)
    labels, at = tagger.labels(words, np.array(lines, np.int64)), 0
    out = []
    for t, own_runs in zip(texts, runs, strict=True):
        text = t.decode()
        base = base_spans(text)
        every = list(base)
        n = sum(k for k, tagged in own_runs if tagged)
        if labels[at : at + n].any():
            own, to = np.zeros(sum(k for k, _ in own_runs), np.int8), 0
            for k, tagged in own_runs:
                if tagged:
                    own[to : to + k] = labels[at : at + k]
                    at += k
                to += k
            for s in spans_of(_WORD.finditer(text), own):
                if holds(s[0], text[s[1] : s[2]]) and not any(s[1] < e and b < s[2] for _, b, e in base):
                    every.append(s)
        else:
            at += n
        out.append((base, sorted(every, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))))
    return out


@lru_cache(1)
def default_field() -> Field:
    return Field(labelled())



def find_pii(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """One row per row of docs (doc_id, text), see SCHEMA.

    Counts and base_sha256 are of the base spans, spans of all: kind:start:end by start, then kind,
    in code points, end exclusive, comma-joined; of two that start at one place the shorter comes first.
    Null text counts as empty; an empty text has no spans. Very long texts, lines and words are read
    whole. Repeated rows are searched each, whatever their doc_id; other columns are ignored, whatever
    their names; an empty table gives an empty result.
    """
    field = field or default_field()
    bounded_batches(docs.sparkSession)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("none")
        tagger = Tagger(field)
        for b in batches:
            for ids, texts in chunks(b["doc_id"].to_pylist(), b["text"]):
                rows = []
                for i, (base, every) in zip(ids, find_all(tagger, texts), strict=True):
                    counts = [sum(s[0] == k for s in base) for k in KINDS]
                    rows.append((i, *counts, hashlib.sha256(_written(base).encode()).hexdigest(), _written(every)))
                kinds = [pa.int64()] * 5 + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(found, SCHEMA)
