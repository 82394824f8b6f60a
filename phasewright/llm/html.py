"""Main text of web pages by removing the templates of their sites.

Each page is parsed once into text blocks. Every element around a block has a hash of its whole
subtree; Spark counts the different pages of each host that hold a hash, and blocks inside
subtrees that recur on many of them go, in and outside articles. What a page itself marks as
furniture (navigation, forms, scripts, adverts, comments) goes without counting. The mark of an
article decides two doubtful cases: an article that would lose most of its text is a near copy
of others and stays whole, and what is left beside an article goes if it is less than the article.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasewright.llm.text import whole
from phasewright.session import stage

# What HTML elements and class names mean.
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
FURNITURE = ("script", "style", "noscript", "template", "iframe", "textarea", "title", "head", "nav", "aside", "footer", "form", "button", "select", "dialog", "menu",
             "svg", "canvas", "object", "audio", "video", "map", "datalist")
BLOCK = ("address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure",
         "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option",
         "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul")
PROSE = ("p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "li", "dd", "dt", "td", "th", "figcaption", "caption")
CLOSES_P = tuple(b for b in BLOCK if b not in ("body", "html", "caption", "legend", "optgroup", "option", "tbody", "td", "tfoot", "th", "thead", "tr"))
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert(?:s|isements?|ising)?|sponsor(?:ed|s)?|promo(?:tion)?s?|banners?|cookies?|consent|gdpr|notices?|popups?|modals?|overlay|sidebars?|menus?|"
    r"nav(?:bar|igation)?|breadcrumbs?|footers?|masthead|comments?|disqus|replies|respond|share|sharing|social|related|recommend(?:ed|ations)?|newsletter|subscribe|"
    r"pagination|pager|toolbar|widgets?|skip|login|search)(?:$|[\s_-])", re.IGNORECASE)
ROLES = ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar", "form")
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_PLAIN = re.compile(r"[^>\"']*+")
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
_SPACE = re.compile(r"\s+")
# Words of class names that say where a container is, not what is in it.
NEUTRAL = frozenset(
    "area bar bottom box block body button close container content fixed footer group header inner item items left line link links list main message outer page panel "
    "right row section site slot small text title top unit user wrap wrapper".split())


class Tags:
    """The tags of a page in order. Every character is looked at a bounded number of times, whatever is left open."""

    def __init__(self, html: str):
        self.html, self.unclosed = html, set()

    def _end(self, at: int) -> tuple[int, int]:
        """Where the tag that goes on at ``at`` ends, and where the text after it begins.

        A quote that nothing closes, or that only the opening of another tag's value would close, is
        a character like others, so the tag ends at its first ``>``.
        """
        html = self.html
        while True:
            at = _PLAIN.match(html, at).end()
            if at == len(html):
                return at, at
            if html[at] == ">":
                return at, at + 1
            quote = html[at]
            close = -1 if quote in self.unclosed else html.find(quote, at + 1)
            if close < 0:
                self.unclosed.add(quote)
            inside = html.find(">", at, close) if close > 0 and html[close - 1] == "=" else -1
            at = inside if inside > 0 else max(at, close) + 1

    def __iter__(self) -> Iterator[tuple[str, str, str]]:
        """Kind (``text``, ``open``, ``close``, ``alone``), then text, or name and attributes."""
        html, at, length = self.html, 0, len(self.html)
        while at < length:
            start = html.find("<", at)
            if start < 0:
                yield "text", html[at:], ""
                return
            if start > at:
                yield "text", html[at:start], ""
            at = start
            if html.startswith("<!--", at):
                end = html.find("-->", at + 4)
                at = length if end < 0 else end + 3
                continue
            if html.startswith("<![CDATA[", at):
                end = html.find("]]>", at)
                yield "text", html[at + 9 : length if end < 0 else end], ""
                at = length if end < 0 else end + 3
                continue
            if html.startswith(("<!", "<?"), at):
                end = html.find(">", at)
                at = length if end < 0 else end + 1
                continue
            tag = _TAG.match(html, at)
            if tag is None:
                yield "text", "<", ""
                at += 1
                continue
            end, at = self._end(tag.end())
            name, attributes = tag[2].lower(), html[tag.end() : end]
            if tag[1]:
                yield "close", name, ""
            elif name in VOID or attributes.endswith("/") and name not in BLOCK:
                yield "alone", name, attributes
            else:
                yield "open", name, attributes
                if name in RAW:
                    close = re.compile(rf"</{re.escape(name)}\s*+>", re.IGNORECASE).search(html, at)
                    at = close.end() if close else length


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


class Element:
    __slots__ = ("tag", "furniture", "article", "counted", "inner", "parts")

    def __init__(self, tag: str, furniture: bool, article: bool, counted: int, inner: bool):
        self.tag, self.furniture, self.article, self.counted, self.inner, self.parts = tag, furniture, article, counted, inner, [tag]


def _named(names: str) -> bool:
    """Whether a class list names furniture and nothing else: ``ad-box``, ``site-footer``, but not ``social-sciences``."""
    for name in names.lower().split():
        parts = [p for p in re.split(r"[_-]+", name) if p]
        if any(NAMES.search(p) for p in parts) and all(p in NEUTRAL or NAMES.search(p) for p in parts):
            return True
    return False


def _is_furniture(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in FURNITURE or (tag == "header" and not in_article):
        return True
    if attributes and tag not in ("html", "body", "article", "main"):
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            value, name = a or b or c, name.lower()
            if name == "hidden" or (name == "role" and value.lower() in ROLES) or (name == "aria-hidden" and value == "true"):
                return True
            if name in ("class", "id") and not (in_article and tag in PROSE) and (_named(value) if in_article else NAMES.search(value)):
                return True
    return False


class Page(NamedTuple):
    """Blocks (text, whether inside the marked article, index of the innermost counted subtree or -1) and subtrees (hash, index of the one around it or -1, whether it lies in the article).

    A subtree in an article has another hash than the same one elsewhere: the two are counted apart.
    """

    blocks: list[tuple[str, bool, int]]
    hashes: list[int]
    parents: list[int]
    inner: list[bool]


class _Reader:
    """What is open at a place of a page. Depths and last positions are kept, so no step walks through the open elements."""

    def __init__(self):
        self.stack = [Element("", False, False, -1, False)]
        self.places: dict[str, list[int]] = {}
        self.furniture = self.articles = 0
        self.pending: list[str] = []
        self.blocks: list[tuple[str, bool, int]] = []
        self.hashes: list[int] = []
        self.parents: list[int] = []
        self.inner: list[bool] = []

    def flush(self) -> None:
        text = _SPACE.sub(" ", unescape("".join(self.pending))).strip()
        self.pending.clear()
        if text and not self.furniture:
            self.blocks.append((text, self.articles > 0, self.stack[-1].counted))

    def push(self, tag: str, furniture: bool, article: bool) -> None:
        counted = self.stack[-1].counted
        # in an article blocks are counted, not the words in them that have elements of their own
        inner = self.articles > 0
        if tag not in ("html", "body") and (not inner or tag in BLOCK):
            self.hashes.append(0)
            self.parents.append(counted)
            self.inner.append(inner)
            counted = len(self.hashes) - 1
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append(Element(tag, furniture, article, counted, inner))
        self.furniture += furniture
        self.articles += article

    def pop(self) -> None:
        if self.stack[-1].tag in BLOCK:
            self.flush()
        done = self.stack.pop()
        self.places[done.tag].pop()
        self.furniture -= done.furniture
        self.articles -= done.article
        hashed = _hash("\x00".join(done.parts))
        self.stack[-1].parts.append(str(hashed))
        if done.counted != self.stack[-1].counted:
            self.hashes[done.counted] = _hash(f"article {hashed}") if done.inner else hashed

    def last(self, tag: str) -> int:
        """Where the last open element of this name is; 0 if there is none."""
        return (self.places.get(tag) or [0])[-1]

    def pop_to(self, place: int) -> None:
        while len(self.stack) > place:
            self.pop()

    def text(self, raw: str) -> None:
        self.pending.append(raw)
        self.stack[-1].parts.append(_SPACE.sub(" ", raw))

    def open(self, tag: str, attributes: str) -> None:
        if tag in CLOSES_P:
            if self.last("p"):
                self.pop_to(self.last("p"))
            self.flush()
        for sibling in SIBLINGS.get(tag, ()):
            if self.last(sibling) > max(self.last(around) for around in SCOPE[tag]):
                self.pop_to(self.last(sibling))
        if tag in BLOCK:
            self.flush()

    def element(self, tag: str, attributes: str) -> None:
        inside = self.articles > 0
        main = tag in ("article", "main") and not self.furniture
        comment = tag == "article" and inside and self.last("article") > 0
        self.push(tag, _is_furniture(tag, attributes, inside) or comment, main and not inside)


def parse(html: str | None) -> Page:
    """Text blocks in page order and the subtrees around them."""
    page = _Reader()
    for kind, what, attributes in Tags(html or ""):
        if kind == "text":
            page.text(what)
        elif kind == "close":
            if page.last(what):
                page.pop_to(page.last(what))
            elif what == "p":
                page.flush()
        else:
            page.open(what, attributes)
            if kind == "alone":
                page.pending.append(" ")
                page.stack[-1].parts.append(what)
            elif what not in RAW:
                page.element(what, attributes)
    page.flush()
    page.pop_to(1)
    # only subtrees that hold a block are counted
    place: dict[int, int] = {}
    for _, _, at in page.blocks:
        while at >= 0 and at not in place:
            place[at] = -1
            at = page.parents[at]
    for new, old in enumerate(sorted(place)):
        place[old] = new
    place[-1] = -1
    held = sorted(place)[1:]
    blocks = [(text, inside, place[at]) for text, inside, at in page.blocks]
    return Page(blocks, [page.hashes[i] for i in held], [place[page.parents[i]] for i in held], [page.inner[i] for i in held])


def kept_text(page: Page, templates: set[int]) -> str:
    """The page's text without what lies in a subtree of ``templates``.

    If less than half of an article would be left, it is a copy of others and stays whole; text
    beside an article stays if it is more than what is kept of the article.
    """
    gone: list[bool] = []
    for hashed, parent in zip(page.hashes, page.parents, strict=True):
        gone.append(hashed in templates or (parent >= 0 and gone[parent]))
    lost = [at >= 0 and gone[at] for _, _, at in page.blocks]
    length = lambda inside, all_of_it=False: sum(len(t) for (t, own, _), g in zip(page.blocks, lost, strict=True) if own == inside and (all_of_it or not g))
    article, left, beside = length(True, True), length(True), length(False)
    copy = left * 2 < article
    only = article > 0 and (article if copy else left) >= beside
    return "\n".join(t for (t, own, _), g in zip(page.blocks, lost, strict=True) if ((copy or not g) if own else not (only or g)))


def _pack(page: Page) -> bytes:
    """A page's blocks compressed, so that texts cross disks and networks once at a fraction of their size."""
    inner = "".join("01"[i] for i in page.inner)
    content = "\x00".join([",".join(map(str, page.hashes)), ",".join(map(str, page.parents)), inner, ",".join(f"{int(own)}:{at}" for _, own, at in page.blocks)])
    texts = "\n".join(text for text, _, _ in page.blocks)  # a block's own white space is single spaces
    return zstandard.ZstdCompressor(level=6).compress(f"{content}\x00{texts}".encode("utf-8", "surrogatepass"))


def _unpack(packed: bytes) -> Page:
    hashes, parents, inner, marks, texts = zstandard.ZstdDecompressor().decompress(packed).decode("utf-8", "surrogatepass").split("\x00", 4)
    numbers = lambda s: [int(x) for x in s.split(",")] if s else []
    places = [mark.split(":") for mark in marks.split(",")] if marks else []
    blocks = [(text, own == "1", int(at)) for text, (own, at) in zip(texts.split("\n"), places)]
    return Page(blocks, numbers(hashes), numbers(parents), [i == "1" for i in inner])


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for row, host, html in zip(batch["_row"], batch["_host"], batch["html"], strict=True):
            page = parse(html)
            content = "\n".join([text for text, inside, _ in page.blocks if inside] or [text for text, *_ in page.blocks])
            counted = [{"hash": hashed, "inner": inner} for hashed, inner in sorted(set(zip(page.hashes, page.inner, strict=True)))]
            rows.append((row, host, _hash(content), counted, _pack(page)))
        yield pd.DataFrame(rows, columns=["_row", "_host", "vote", "counted", "packed"])


def _decided(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [kept_text(_unpack(packed), set(() if lost is None else lost)) for packed, lost in zip(batch["packed"], batch["_template"], strict=True)]
        yield pd.DataFrame({"_row": batch["_row"], "text": texts})


def main_text(
    pages: DataFrame, min_pages: int = 10, min_share: float = 0.02, article_share: float = 0.5, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row for each row of ``pages``: ``page_id``, ``url``, ``text`` (blocks joined by newlines), ``n_chars``.

    A subtree is template if at least ``min_pages`` different pages of its host and ``min_share``
    of them hold it; inside a marked article ``article_share`` of them must, as what most pages of a site
    say in their articles is the site's, and a passage that some of them share is text. Pages with the same article, or without one the same text outside furniture,
    count once. If less than half of an article would be left, it stays whole; text beside an
    article stays if it is more than the article. The host is what stands between ``//`` and the next ``/``, ``?`` or ``#``, lower-cased;
    urls without one share a host of their own. Null and empty pages have an empty text. Markup
    that ends early or never closes counts as closed at the end.
    """
    host = F.lower(F.regexp_extract(whole(F.col(url_col)), "//([^/?#]*)", 1))
    kind = pages.schema[id_col].dataType.simpleString()
    # the id and url travel with the page as one JSON string; nulls stay nulls
    own = F.to_json(F.struct(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")))
    rows = pages.select(own.alias("_row"), host.alias("_host"), whole(F.col(html_col)).alias("html"))
    parsed = rows.mapInPandas(_parsed, "_row string, _host string, vote long, counted array<struct<hash: bigint, inner: boolean>>, packed binary")
    parsed = stage(parsed.withColumn("_page", F.monotonically_increasing_id()), "blocks")
    seen = parsed.select("_page", "_host", "vote", F.inline("counted"))
    sizes = parsed.groupBy("_host").agg(F.count_distinct("vote").alias("_pages"))
    template = (
        seen.groupBy("_host", "hash", "inner").agg(F.count_distinct("vote").alias("n")).where(F.col("n") >= min_pages)
        .join(sizes, "_host").where(F.col("n") >= F.col("_pages") * F.when(F.col("inner"), article_share).otherwise(min_share)).select("_host", "hash"))
    lost = seen.join(template, ["_host", "hash"], "left_semi").groupBy("_page").agg(F.collect_list("hash").alias("_template"))
    # stored, so that its size is known when the texts' join is planned: while it is small, no text moves
    lost = stage(lost, "lost-subtrees")
    out = parsed.select("_page", "_row", "packed").join(lost, "_page", "left").select("_row", "packed", "_template")
    out = out.mapInPandas(_decided, "_row string, text string").withColumn("_own", F.from_json("_row", f"page_id {kind}, url string"))
    return out.select("_own.page_id", "_own.url", "text").withColumn("n_chars", F.length("text").cast("long"))
