"""Block rules against a plain second pass, and word recall and precision on generated pages whose article is known."""

import itertools
import random
import time

import pytest

from lodeframe.llm import html_text

STOPS = "the of and to in a is that it was for on are as with his they at be this from have or by one had not but what all were when we there can an your which their said if do".split()


def sentence(r, n):
    return " ".join(r.choice(STOPS) if r.random() < 0.45 else "".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randrange(1, 4))) for _ in range(n)) + "."


def plain_neighbours(first, heading, edge):
    decided = [(-1, edge), *((i, c) for i, c in enumerate(first) if c in ("good", "bad")), (len(first), edge)]
    out = []
    for i, c in enumerate(first):
        if c in ("good", "bad"):
            out.append(c)
            continue
        left, right = max(d for d in decided if d[0] < i), min(d for d in decided if d[0] > i)
        out.append(left[1] if left[1] == right[1] else "good" if c == "near" or heading[i] else left[1] if i - left[0] <= right[0] - i else right[1])
    return out


def test_second_pass():
    for first in itertools.product(("good", "bad", "near", "short"), repeat=5):
        for edge in ("good", "bad"):
            heading = [k % 3 == 0 for k in range(5)]
            assert html_text.neighbours(list(first), heading, edge) == plain_neighbours(first, heading, edge)


def page(r, wrap):
    """(html, words of the article, words of the rest)."""
    mark = lambda words, side: " ".join(f"{side}{w}" if w not in STOPS and not w.endswith(".") else w for w in words.split())
    body, junk = [], []

    def own(n):
        body.append(mark(sentence(r, n), "Q"))
        return body[-1]

    def rest(n):
        junk.append(mark(sentence(r, n), "Z"))
        return junk[-1]

    article = f"<h1>{own(5)}</h1>" + "".join(r.choice(["<p>%s</p>", "<p>%s", "<div>%s</div>"]) % own(r.choice([3, 12, 40, 90])) for _ in range(r.randrange(3, 9))) + "<ul><li>%s<li>%s</ul><p>%s</p>" % (own(4), own(6), own(50))
    menu = "<nav><ul>" + "".join(f"<li><a href=/>{rest(2)}</a>" for _ in range(6)) + "</ul></nav>"
    html = f"<html><head><title>{rest(4)}</title></head><body><header>{rest(6)}</header>{menu}" + wrap % article + (
        f"<div class='related'><p>{rest(30)}</p></div><aside>{rest(20)}</aside><div id=comments><p>{rest(40)}</p></div><div class='share bar'><a href=/>{rest(3)}</a></div><form>{rest(9)}</form><footer>{rest(12)}</footer></body></html>"
    )
    return html, body, junk


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main><div>%s</div></main>", "<div class='post-content'>%s</div>", "<div>%s</div>", "<div class='story'><p>Of it all.</p></div><div>%s</div>"])
def test_recall_and_precision(wrap):
    r = random.Random(len(wrap))
    found = wanted = right = 0
    for _ in range(40):
        html, body, _ = page(r, wrap)
        got = [w for w in html_text.main_text(html).split() if w[0] in "QZ"]
        want = [w for t in body for w in t.split() if w[0] == "Q"]
        hits = sum(w[0] == "Q" for w in got)
        found, wanted, right = found + len(got), wanted + len(want), right + hits
    assert right / wanted >= 0.95 and right / found >= 0.95, (right / wanted, right / found)


@pytest.mark.parametrize("piece", ["<div>", "<p>", "<div><b>", "<ul><li>", "<a ", "<script>", "&#", "<td>"])
def test_long_and_deep_pages_take_linear_time(piece):
    began = time.perf_counter()
    html_text.main_text(piece * (1_000_000 // len(piece)) + "text of it all")
    assert time.perf_counter() - began < 20
