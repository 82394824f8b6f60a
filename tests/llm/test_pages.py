"""Pages that are hard to parse, and templates counted by hand."""

import random
import time
from collections import defaultdict

import pytest

from phasewright.llm import html

PAGES = "page_id long, url string, html string"


def texts(page):
    return [text for text, _, _ in html.parse(page).blocks]


@pytest.mark.parametrize("page", [
    '<article><div class="social-sciences"><p>Kept</p></div></article>',
    '<article><p class="related-work">Kept</p></article>',
    '<article><p class="comments">Kept</p></article>',
    '<article><p class="foo>Kept</p></article>',
    "<article><p class='foo>Kept</p><p class='bar'></p></article>",
    '<article><p title="a > b" data-x=\'<i>\'>Kept</p></article>',
    "<article><div class=\"ad-box\">Buy</div><div class='comment-list'>Ha</div><div class=cookie_notice>Yes</div><p hidden>No</p><p>Kept</p></article>",
    "<article><header>Kept</header><nav>Menu</nav><aside>Side</aside></article>",
    "<p>Kept<!-- never closed <p>lost",
    "<script>if (a < b) { x('</p>') }</script><p>Kept<style>p{}",
])
def test_text_that_stays(page):
    assert [t for t in texts(page) if t != "Ha"] == ["Kept"]


def test_names_outside_articles():
    assert texts('<div class="site-footer">x</div><div id="cookie-bar">y</div><div class="social-sciences">z</div><div class="story">Text</div>') == ["Text"]


@pytest.mark.parametrize("name,page,blocks", [
    ("nested", "<div>x" * 100_000, 100_000),
    ("nested in an article", "<article>" + "<div>x" * 100_000, 100_000),
    ("quotes", '<p>a</p>' + '<a "' * 250_000, 1),
    ("tags with lone quotes", "<p>a</p>" + "<a '><b \"" * 100_000, 1),
    ("brackets", "<p>" + "<" * 1_000_000, 1),
    ("attributes", "<p " + "a" * 1_000_000 + ">t</p>", 1),
    ("spaces", "<p a" + " " * 1_000_000 + "b>t</p>", 1),
    ("options", "<option><select>" + "<div>" * 50_000 + "<option></option>" * 50_000 + "</select>t", None),
    ("items", "<ul><li>x" * 50_000, 50_000),
    ("ends", "<div>" * 50_000 + "</span>" * 50_000 + "t", 1),
    ("comments", "<!--" * 250_000, 0),
    ("data", "<![CDATA[" * 100_000, 1),
])
def test_long_pages_take_linear_time(name, page, blocks):
    start = time.process_time()
    found = html.parse(page)
    assert time.process_time() - start < 20
    if blocks is not None:
        assert len(found.blocks) == blocks
    assert len(found.hashes) <= len(page) // 3 and html._unpack(html._pack(found)) == found
    html.kept_text(found, set())


def test_odd_characters_survive_packing():
    page = html.parse("<p>a\x00b&#0;c d\ud800e\x1cf</p><p>,:\n1</p>")
    assert html._unpack(html._pack(page)) == page and len(page.blocks) == 2


def test_a_passage_that_some_articles_share_is_text(spark):
    page = lambda i: f"<article><h1>Title {i}</h1>{'<p>A passage that many quote</p>' if i % 5 == 0 else ''}<p>Text {i}</p><p>Read more</p></article>"
    rows = [(i, f"http://a.example/{i}", page(i)) for i in range(100)]
    got = {r["page_id"]: r["text"] for r in html.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[7] == "Title 7\nText 7" and got[10] == "Title 10\nA passage that many quote\nText 10"


def test_templates_equal_a_count_by_hand(spark):
    draw = random.Random(9)
    rows = []
    for i in range(400):
        host = draw.choice(["a.example", "b.example", "c.example"])
        rare = f"<div><p>Often {draw.randrange(40)}</p><p>Both</p></div>" if host == "a.example" else ""
        body = f"<section><p>Own {draw.randrange(300)} text</p><p>Shared {draw.randrange(25)}</p></section>"
        rows.append((i, f"https://{host.upper()}/{i}", f"<div><p>Welcome to {host}</p></div>{rare}{body}"))
    rows += rows[:20] + [(1000, "no host", "<p>Alone</p>"), (1001, None, "<p>Alone</p>"), (1002, "no host", None)]
    held, votes = defaultdict(set), defaultdict(set)
    for _, url, page in rows:
        host = (url or "").lower().partition("//")[2].partition("/")[0]
        found = html.parse(page)
        vote = tuple(t for t, _, _ in found.blocks)
        votes[host].add(vote)
        for hashed in found.hashes:
            held[host, hashed].add(vote)
    want = []
    for page_id, url, page in rows:
        host = (url or "").lower().partition("//")[2].partition("/")[0]
        found = html.parse(page)
        template = {h for h in found.hashes if len(held[host, h]) >= max(10, 0.02 * len(votes[host]))}
        lines = []
        for text, _, at in found.blocks:
            while at >= 0 and found.hashes[at] not in template:
                at = found.parents[at]
            if at < 0:
                lines.append(text)
        want.append((page_id, url, "\n".join(lines), len("\n".join(lines))))
    got = [tuple(r) for r in html.main_text(spark.createDataFrame(rows, PAGES).repartition(5)).collect()]
    key = lambda r: (r[0], str(r))
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {r[2] for r in want} != {"\n".join(texts(r[2])) for r in rows}  # something was removed
