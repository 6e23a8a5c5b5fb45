r"""Main text of HTML pages by two-pass block rules.

The markup is cut into blocks: runs of text between block-level tags. What stands in menus, headers
outside the article, footers, sidebars, forms, adverts, notices, scripts, styles and comment
sections goes with its element. Pass one classifies each block by itself: link density, length and
stop-word density make it good, bad or undecided (short or near-good). Pass two gives undecided
blocks the label of their nearest decided neighbours; inside an element that the page marks as its
article, both ends count as good neighbours. Marks decide only where they hold most of the page's
good text: a marked teaser beside an unmarked article changes nothing.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeframe.llm.common import bounded_batches
from lodeframe.llm.textkit import utf8

#: Frequent function words of the languages handled; fixed values.
STOP_WORDS = frozenset(
    "a about after all also an and are as at be because been but by can do for from had has have he her his how i if in into is it its like more no not of on one "
    "or our out she so some than that the their them then there these they this to up was we were what when which who will with would you your "
    "aber als am an auch auf aus bei bin bis da das dass dem den der des die durch ein eine einem einen einer es für hat ich ihr im ist ja kann mit nach nicht noch "
    "nur oder sein sich sie sind so und uns unter vom von vor war was wenn wie wir zu zum zur über "
    "au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou où par pas plus pour qu que qui sa se ses son sont sur un une vous à "
    "al como con cuando del desde donde el ella ellos en entre era es esta este fue ha hay la las lo los me mi muy más no o para pero por porque que se ser si sin sobre su sus también te tiene todo un una y ya".split()
)
LINK_DENSITY, SHORT, LONG, STOP_LOW, STOP_HIGH = 0.4, 60, 100, 0.15, 0.25

BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav noscript ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never shown or never part of an article.
DROPPED = frozenset("aside button canvas datalist dialog embed fieldset footer form head iframe input label legend map menu nav noscript object optgroup option select svg template textarea title video audio math".split())
RAW = frozenset(("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"))
#: A start tag of one of these ends an open p.
ENDS_P = BLOCKS - {"body", "br", "dd", "dt", "head", "html", "legend", "li", "option", "optgroup", "summary", "td", "th", "tr", "tbody", "thead", "tfoot", "title", "noscript"}
PARTS = (
    "ad ads adv advert advertisement advertising adsbygoogle banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disqus footer gdpr header hidden "
    "login masthead menu modal nav navbar navigation newsletter notice pager pagination popup promo promoted recommended related replies respond share sharing sidebar signup skip social "
    "sponsor sponsored subscribe subscription teaser toolbar topbar warning widget"
)
PART = re.compile(r"(?:^|[\s_-])(?:" + "|".join(sorted(PARTS.split())) + r")(?:$|[\s_-])")
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
MARK = re.compile(r"(?:^|[\s_-])(?:article|entry|post|story|content|main)(?:$|[\s_-]|body|content|text)")
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


SIGNS = str.maketrans(dict.fromkeys(".,;:!?\"'()", " "))


@dataclass(slots=True)
class Block:
    text: list[str] = field(default_factory=list)
    linked: int = 0
    tag: str = ""
    article: bool = False

    def done(self) -> str:
        return " ".join((self.text[0] if len(self.text) == 1 else "".join(self.text)).split())


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)}


def _excluded(tag: str, raw: str, in_article: bool) -> bool:
    if tag in DROPPED or tag == "header" and not in_article:
        return True
    if not raw.strip() or tag in ("html", "body"):
        return False
    a = _attributes(raw)
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or a.get("role", "").lower() in ROLES:
        return True
    if tag == "article" or tag == "main":
        return bool(re.search(r"(?:^|[\s_-])comments?(?:$|[\s_-])", f"{a.get('class', '')} {a.get('id', '')}".lower()))
    name = f"{a.get('class', '')} {a.get('id', '')}".lower()
    return "display:none" in a.get("style", "").replace(" ", "").lower() or bool(PART.search(name)) and not (tag in ("p", "h1", "h2", "h3", "span", "b", "i", "em", "strong") and in_article and tag != "p")


class Open:
    """The open elements, with the places of each tag, of block elements and of list holders, so that no step scans them."""

    HOLDERS = frozenset(("ul", "ol", "dl", "table", "select"))

    def __init__(self) -> None:
        self.elements: list[tuple[str, bool, bool, bool]] = []  # tag, excluded, in an article, in a link
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.holders: list[int] = []

    def top(self) -> tuple[str, bool, bool, bool]:
        return self.elements[-1] if self.elements else ("", False, False, False)

    def push(self, element: tuple[str, bool, bool, bool]) -> None:
        k, tag = len(self.elements), element[0]
        self.elements.append(element)
        self.places.setdefault(tag, []).append(k)
        if tag in BLOCKS:
            self.blocks.append(k)
        if tag in self.HOLDERS:
            self.holders.append(k)

    def last(self, tag: str) -> int:
        """Place of the innermost open element of this tag, or -1."""
        at = self.places.get(tag)
        return at[-1] if at else -1

    def close(self, k: int) -> None:
        """End the element at place k and all inside it: each is ended once, so closing is linear in all."""
        while len(self.elements) > k:
            tag = self.elements.pop()[0]
            self.places[tag].pop()
            if self.blocks and self.blocks[-1] == len(self.elements):
                self.blocks.pop()
            if self.holders and self.holders[-1] == len(self.elements):
                self.holders.pop()

    def end_tag(self, tag: str) -> None:
        k = self.last(tag)
        # an inline end tag does not close the blocks around it
        if k >= 0 and (tag in BLOCKS or not self.blocks or self.blocks[-1] <= k):
            self.close(k)

    def before(self, tag: str) -> None:
        """End what a start tag ends: an open p before a block, an open item before the next one."""
        if tag in ENDS_P:
            k = self.last("p")
            if k >= 0 and self.blocks[-1] == k:
                self.close(k)
        elif tag in ("li", "dd", "dt", "tr", "td", "th", "option"):
            k = self.last(tag)
            if k >= 0 and (not self.holders or self.holders[-1] < k):
                self.close(k)


END_OF = {t: re.compile(rf"</{t}\b[^>]*>?", re.I) for t in RAW | {"script", "style"}}


def _marked(tag: str, raw: str) -> bool:
    """Does the page mark the element as its article?"""
    if tag in ("article", "main"):
        return True
    if tag not in ("div", "section", "td") or not raw.strip():
        return False
    a = _attributes(raw)
    return bool(MARK.search(f" {a.get('class', '')} {a.get('id', '')} {a.get('itemprop', '')}".lower().replace("articlebody", "article")))


def blocks(page: str) -> list[Block]:
    """Blocks in page order, without those in excluded elements, in time linear in the page. Unclosed and crossed tags are tolerated."""
    out: list[Block] = []
    now = Block()
    stack = Open()
    at, n = 0, len(page)

    def flush(tag: str) -> None:
        nonlocal now
        if now.text:
            out.append(now)
            now = Block()
        now.tag, now.article = tag, stack.top()[2]

    def add(raw: str) -> None:
        top = stack.top()
        if top[1] or not now.text and raw.isspace():
            return
        text = html.unescape(raw) if "&" in raw else raw
        if text:
            now.text.append(text)
            if top[3]:
                now.linked += len("".join(text.split()))

    search = TOKEN.search
    while at < n:
        m = search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                add(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag, raw = m[2].lower(), m[3] or ""
        if m[1]:
            if tag in BLOCKS:
                flush("")
            stack.end_tag(tag)
            if tag in BLOCKS:
                now.article = stack.top()[2]
            continue
        stack.before(tag)
        if tag in BLOCKS:
            flush(tag)
        alone = raw.rstrip().endswith("/")
        if tag in ("script", "style") or tag in RAW and not alone:
            end = END_OF[tag].search(page, at)
            at = end.end() if end else n
            continue
        if tag in VOID or alone:
            continue
        above = stack.top()
        excluded = above[1] or _excluded(tag, raw, above[2])
        stack.push((tag, excluded, (above[2] or _marked(tag, raw)) and not excluded, above[3] or tag == "a"))
        if tag in BLOCKS:
            now.article = stack.top()[2]
    flush("")
    return out


def _class(block: Block, text: str) -> str:
    """good, bad, near or short: pass one, from the block alone."""
    dense = len(text.replace(" ", ""))
    links = block.linked / dense if dense else 0.0
    if links > LINK_DENSITY:
        return "bad"
    if len(text) < SHORT:
        return "bad" if links > 0 and text.count(" ") < 2 else "short"
    words = text.lower().translate(SIGNS).split()
    stops = sum(map(STOP_WORDS.__contains__, words)) / max(1, len(words))
    if stops >= STOP_HIGH:
        return "good" if len(text) > LONG or block.article else "near"
    if stops >= STOP_LOW:
        return "near"
    # without known stop words: another language, a table, capitals; links and the place decide
    return "short"


HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))


def neighbours(first: list[str], heading: list[bool], edge: str) -> list[str]:
    """Pass two: labels of undecided blocks from the nearest decided block on either side, the page's ends counting as edge."""
    label = list(first)
    decided = [c if c in ("good", "bad") else None for c in first]
    before, last = [], (edge, -1)
    for i, c in enumerate(decided):
        before.append(last)
        last = (c, i) if c else last
    after, last = [], (edge, len(first))
    for i in range(len(first) - 1, -1, -1):
        after.append(last)
        last = (decided[i], i) if decided[i] else last
    after.reverse()
    for i, c in enumerate(first):
        if decided[i]:
            continue
        (left, l), (right, r) = before[i], after[i]
        if left == right:
            label[i] = left
        elif c == "near" or heading[i]:
            label[i] = "good"  # a sentence at the border, or a heading above the text
        else:
            label[i] = left if i - l <= r - i else right
    return label


def main_text(page: str) -> str:
    r"""The article's blocks, each with its white space turned into single spaces, joined by \n\n."""
    found = [(b, t) for b in blocks(page) if (t := b.done())]
    if not found:
        return ""
    first = [_class(b, t) for b, t in found]
    inside = [b.article for b, _ in found]
    good = [len(t) if c == "good" else 0 for (_, t), c in zip(found, first, strict=True)]
    # marks that hold less than half of the good text mark something else than the article
    if any(inside) and 2 * sum(n for n, x in zip(good, inside, strict=True) if x) >= sum(good):
        found, first = ([v for v, x in zip(values, inside, strict=True) if x] for values in (found, first))
        edge = "good"
    else:
        edge = "bad"
    if "good" not in first:  # the best there is counts as the text
        first = ["good" if c == "near" else c for c in first]
    label = neighbours(first, [b.tag in HEADINGS for b, _ in found], edge)
    return "\n\n".join(t for (_, t), c in zip(found, label, strict=True) if c == "good")


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(x.as_py().decode()) for x in utf8(b["html"])]
        yield pa.RecordBatch.from_arrays(
            [b["page_id"], b["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
        )


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per row of pages (page_id, url, html): page_id, url, text, n_chars (code points).

    Null or empty html, or html without an article's text, gives an empty text; a null page_id or url
    stays null. Very long pages and very deep or unclosed elements take time linear in their length.
    Between two equally near decided neighbours the one before counts. Repeated rows are extracted
    each; other columns are ignored, whatever their names; an empty table gives an empty result.
    """
    bounded_batches(pages.sparkSession)
    cols = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return cols.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
