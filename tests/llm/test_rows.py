"""Operators that judge each row by itself, and mixing, against plain models."""

import hashlib
import math
import re

import numpy as np
import pytest

from lodeframe.llm import html_text, licenses, pii, quality
from lodeframe.llm.mixing import mix
from lodeframe.llm.url_rules import judge_urls
from tests.llm.cases import corpus, docs, words


def test_quality_counts(spark):
    rows = corpus(60, 6) + [(2000, "# x $\n# x $\n\n \n# x $\nq"), (2001, "clean words here " + " ".join(f"w{i}x{i * 7 % 13}" for i in range(200)))]
    got = {r["doc_id"]: r for r in quality.quality(docs(spark, rows)).collect()}
    for i, t, *_ in rows:
        t, ws = t or "", words(t)
        grams = [tuple(ws[k : k + 3]) for k in range(len(ws) - 2)]
        covered = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)} if len(ws) < 500 else set(range(len(ws)))
        lines = [x for x in t.split("\n") if words(x)]
        want = (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, i
        assert r["base_failed"] == (len(ws) < 50 or 100 * len(covered) > 50 * len(ws)) and not (r["kept"] and r["base_failed"])
    assert got[2001]["kept"]


def test_quality_bands():
    r = quality.Ratios()
    noise = np.random.default_rng(1).bytes(20_000).hex().encode()
    assert not quality.in_band(30_000, r.whole(b"spam ham eggs " * 2000))
    assert not quality.in_band(20_000, r.whole(np.random.default_rng(1).bytes(20_000)))
    assert quality.verdict(r, noise)[0]  # hex halves: compressible enough


def model_base(text):
    t, out = text or "", []
    for kind, p in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(p, t):
            d = re.sub(r"[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(d) <= 19 and pii.luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


PRIVATE = [
    "mail a.b+c@x-y.co.uk, or é@ä.de or me@host", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.4 1.2.3", "4111 1111-1111 1111 and 4111111111111112 or 4111111111111111.", "+1 (073) 555-8658 +49-30.12 +1+2 +123456789012345678",
    "a@b@c.de x@y..z a@b.c@d.e", "", None, "é" * 50 + " 10.0.0.1 Ü a@b.cd", "+1 (826) 555-4081 190.137.223.204 du", "9" * 3000 + "." + "1.1." * 500,
]


def test_pii_base_spans(spark):
    rows = list(enumerate(PRIVATE))
    got = {r["doc_id"]: r for r in pii.find_pii(docs(spark, rows)).collect()}
    for i, t in rows:
        base = model_base(t)
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert pii.base_spans(t or "") == base
        assert got[i]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest() and set(text.split(",")) - {""} <= set(got[i]["spans"].split(","))
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(b[0] == k for b in base) for k in pii.KINDS]


def test_field_on_held_out_sentences():
    """Trained on two thirds of the table's rows, judged on the words of the rest."""
    rows = pii.labelled(copies=1)
    field = pii.Field([r for i, r in enumerate(pii.labelled(copies=4)) if (i % len(rows)) % 3], steps=80)
    tagger, right, total, false = pii.Tagger(field), 0, 0, 0
    for i, (ws, labels) in enumerate(rows):
        if i % 3 == 0:
            got = tagger.labels(ws, np.array([len(ws)])).tolist()
            right += sum(a == b for a, b in zip(got, labels))
            total += len(ws)
            false += sum(b == 0 and a != 0 for a, b in zip(got, labels))
    assert right / total > 0.85 and false / total < 0.05


def test_viterbi_is_the_best_path():
    import itertools

    field = pii.default_field()
    tagger = pii.Tagger(field)
    for line in (b"call (212) 555-0199 now", b"ip 10[.]0[.]0[.]7 x", b"a b", b"card 4111.1111.1111.1111"):
        ws = line.split()
        kinds = [pii.word_type(w) for w in ws]
        e = np.array([field.scores(f) for f in pii._features(kinds)])
        best = max(itertools.product(range(5), repeat=len(ws)), key=lambda y: field.start[y[0]] + sum(e[t, y[t]] for t in range(len(ws))) + sum(field.t[a, b] for a, b in itertools.pairwise(y)))
        assert tuple(tagger.labels(ws, np.array([len(ws)])).tolist()) == best


def test_pii_finds_more_than_patterns(spark):
    rows = [(1, "please call (212) 555-0142 today"), (2, "server ip 10[.]1[.]2[.]3 is down"), (3, "the quick brown fox of 2019 has 12345678 parts, version 3.1.")]
    got = {r["doc_id"]: r["spans"] for r in pii.find_pii(docs(spark, rows)).collect()}
    assert got == {1: "phone:12:26", 2: "ip:10:24", 3: ""}


def test_licenses_base(spark):
    rows = corpus(20, 7) + [
        (2000, "CC by, cc-BY\ncc  by-nc éCC by"), (2001, "GNU General Public License, version 3. All rights reserved! all rights\treserved"), (2002, "general public general public license"), (2003, "cc by cc by"), (2004, "acc by ccby cc byé"),
    ]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(docs(spark, rows)).collect()}
    for i, t, *_ in rows:
        low = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [(k, label) for phrase, label in licenses.PHRASES for k in range(len(ws)) if ws[k : k + len(phrase.split())] == phrase.split()]
        at = [k for k, _ in places]
        want = (len(ws), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == want
        assert set(want[4].split(",")) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>x";</script></head><body><header>Site <a href=/>home</a></header><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav>
<div class="cookie-notice">We use cookies for the best of all.</div><div class="ad">Buy the thing now, it is the best.</div>%s<aside>See also the others.</aside><form><label>Name</label><input name=q></form>
<section id="comments"><p>First! This is the best comment that there is on the page.</p></section><footer>&copy; 2024 all of us</footer></body></html>"""


def test_html_article_with_open_tags():
    body = "<article><h1>Of a &amp; b</h1><p>Short.<p><b>Bold</b> text&nbsp;of\n the <a href=x>day</a>.<br>Next &lt;line&gt;</p><!-- <p>no</p> --><script>x</script><ul><li>One<li>Two</ul><p class='ad'>Buy!</p><p></p></article>"
    assert html_text.main_text(PAGE % body) == "Of a & b\n\nShort.\n\nBold text of the day.\n\nNext <line>\n\nOne\n\nTwo"


def test_html_without_article_marks():
    text = "This is the story of a fox that was in the woods for a long time, and of all the things that it saw there on its way to the river. "
    body = f"<div><h2>The Fox</h2><p>{text}</p><p>It ran.</p><p>{text}</p></div>"
    got = html_text.main_text(PAGE % body).split("\n\n")
    assert got == ["The Fox", text.strip(), "It ran.", text.strip()]


@pytest.mark.parametrize("page", ["", "<", "<p", "</p></div>", "plain", "<nav>only menus", "<script>x", "&#x0; &bogus; <p>&amp", "<article>", "<p>" * 3000])
def test_html_odd_pages(page):
    html_text.main_text(page)


def test_mix_budgets(spark):
    rows = [(i, "w " * (i % 7), f"s{i % 3}") for i in range(200)] + [(1000 + i, "w " * 900, None) for i in range(3)] + [(2000, "w", "tiny"), (2001, "", "void")]
    got = mix(docs(spark, rows), ranges=16).collect()
    size = {}
    for i, t, s in rows:
        size[s] = size.get(s, 0) + len(words(t))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight, target, total = {s: k % 3 + 1 for k, s in enumerate(order)}, {}, sum(size.values())
    capped = set()
    while True:  # reshare until none is above
        rest = total - sum(3 * size[s] for s in capped)
        share = {s: rest * weight[s] / sum(weight[x] for x in order if x not in capped) for s in order if s not in capped}
        over = {s for s, v in share.items() if v > 3 * size[s]}
        if not over:
            break
        capped |= over
    target = {s: 3.0 * size[s] if s in capped else share[s] for s in order}
    source, taken = {i: s for i, _, s in rows}, {}
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == size[s] and r["target"] == pytest.approx(target[s]) and 0 <= r["taken"] <= 3 * r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
    assert taken == {s: math.floor(target[s] + 0.5) for s in order}
    assert {r["doc_id"]: r["taken"] for r in mix(docs(spark, rows[::-1]), ranges=64).repartition(3).collect()} == {r["doc_id"]: r["taken"] for r in got}


def test_urls(spark):
    import random

    r = random.Random(4)
    hosts = ["com", "a.com", "b.a.com", "xa.com", "org", "a.org", ""]
    rules = [(h, p, r.choice(["allow", "block"])) for h in hosts[:-1] for p in ("", "/", "/en/", "/en/7", "/e") if r.random() < 0.6]
    urls = [f"{s}://{h}{p}{t}" for s in ("http", "HTTPS") for h in ["c." + x if x and r.random() < 0.5 else x for x in hosts] for p in ("", "/", "/en/71", "/en/", "/ex", "/en") for t in ("", "?q=/en/7", "#/en/7")] + ["nothing", None, "x://A.COM/EN/", "://a.com", "http://a.com:80/en/7", "a://b://c.com/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {x["page_id"]: tuple(x[1:]) for x in judge_urls(pages, spark.createDataFrame(rules, "host string, path string, action string"), ranges=5).collect()}
    for i, u in enumerate(urls):
        rest = (u or "").partition("://")[2]
        host = re.match(r"[^/?#]*", rest)[0].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
        fit = [(len(h + p), len(h), h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=(0, 0, None, "allow"))
        assert got[i] == (host, path, best[2], best[3]), u


def model_kept(text):
    """The bands, worked out plainly."""
    import zstandard

    size = zstandard.ZstdCompressor(level=quality.LEVEL, write_content_size=False, write_checksum=False).compress

    def inside(piece, bands):
        low, high = next((a, b) for n, a, b in bands if len(piece) <= n)
        return low <= len(piece) / len(size(piece)) <= high

    if len(text) <= quality.CHUNK:
        return inside(text, quality.BANDS)
    bad = sum(len(c) for c in (text[i : i + quality.CHUNK] for i in range(0, len(text), quality.CHUNK)) if not inside(c, quality.CHUNK_BANDS))
    return inside(text, quality.BANDS) and bad <= quality.BAD_SHARE * len(text)


def test_quality_verdicts(spark):
    import base64
    import random

    r = random.Random(9)
    voc = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randrange(2, 9))) for _ in range(900)]
    prose = lambda n: " ".join(r.choice(voc) for _ in range(n))
    noise = lambda n: " ".join(base64.b85encode(r.randbytes(30)).decode() for _ in range(n))
    rows = [(i, prose(n)) for i, n in enumerate((60, 300, 900, 5000))] + [(10 + i, noise(n)) for i, n in enumerate((60, 300, 900))]
    # half prose, half noise, in texts below two whole chunks; noise in the last chunk only; noise in a few chunks of many
    rows += [(20, prose(4096)[:4096] + noise(105)[:3900]), (21, prose(4096)[:4096] + noise(105)[:600]), (22, prose(9000)[:40_960] + noise(200)[:4096]), (23, prose(1500) + " spam" * 4000)]
    got = {x["doc_id"]: x for x in quality.quality(docs(spark, rows)).collect()}
    for i, t in rows:
        assert got[i]["kept"] == (not got[i]["base_failed"] and model_kept(t.encode())), i
    kept = {i for i, x in got.items() if x["kept"]}
    assert {0, 1, 2, 3, 21, 22} <= kept and not kept & {11, 12, 20, 23}


def test_long_hosts(spark):
    """A host of very many labels gives as many keys as rules have numbers of labels."""
    rules = spark.createDataFrame([("a.com", "/x", "block"), ("com", "/", "allow"), (None, "/", "block")], "host string, path string, action string")
    long = "a." * 20_000 + "com"
    pages = spark.createDataFrame([(1, f"http://{long}/x/y"), (2, f"http://{long}/" + "z" * 100_000), (3, "http://" + "b" * 50_000 + ".org/")], "page_id long, url string")
    assert sorted((r["page_id"], r["rule"], r["verdict"]) for r in judge_urls(pages, rules).collect()) == [(1, "a.com/x", "block"), (2, "com/", "allow"), (3, None, "allow")]
