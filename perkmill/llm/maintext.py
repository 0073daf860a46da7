"""Main text of web pages: gradient-boosted trees over the features of DOM nodes, decoded as a hierarchy.

There are no labelled pages, so pages are put together for learning: paragraphs of a bounded sample of
the given pages are laid out by templates of menus, headers, notices, adverts, sidebars, forms,
comments and footers around an article, which says for every node whether it holds main text.

The trees give each node its log odds. A node is kept only if its parent is: of all such choices over a
page the most probable one is found from the leaves up, so that no part of a dropped block is kept.
"""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .boosting import Boosted
from .common import exact_text, read, ready_for_python
from .dom import Node, blocks, parse

#: Pages that paragraphs are taken from, and pages put together for learning.
SAMPLE_PAGES, MADE_PAGES = 48, 500

TAGS = [
    {"p"}, {"h1"}, {"h2", "h3", "h4", "h5", "h6"}, {"div", "center"}, {"section"}, {"article"}, {"main"}, {"nav", "menu"}, {"header", "hgroup"},
    {"footer"}, {"aside"}, {"form", "fieldset", "dialog"}, {"ul", "ol", "dl"}, {"li", "dt", "dd"}, {"table", "tr", "td", "th", "tbody", "thead"},
    {"blockquote", "pre", "figure", "figcaption", "details", "summary", "address"}, {"html", "body", "#page"},
]
#: Words that class, id and role attributes use, by what they say; a word counts if it begins so.
WORDS = {
    "menu": "nav menu breadcrumb toc tabs pagination pager skip dropdown toolbar".split(),
    "header": "header masthead topbar logo branding hero".split(),
    "footer": "footer foot copyright legal colophon imprint".split(),
    "side": "sidebar side aside widget related recommend trending popular tag share social rail".split(),
    "notice": "cookie notice consent banner alert popup modal gdpr overlay privacy toast message warning".split(),
    "advert": "ad ads advert advertisement sponsor promo commercial affiliate teaser outbrain taboola".split(),
    "form": "form newsletter subscribe signup login search contact register".split(),
    "comment": "comment response replies reply discussion disqus feedback review thread".split(),
    "main": "article content post entry main story body text prose page-content hentry".split(),
}
_EXACT = {"ad", "ads", "nav", "foot", "side", "tag", "body", "text", "main", "form"}


def said(attributes: str) -> list[bool]:
    words = [w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", attributes)]
    return [any(w == x or (x not in _EXACT and w.startswith(x)) for w in words for x in group) for group in WORDS.values()]


def features(nodes: list[Node]) -> np.ndarray:
    """A row for each node: tag, attribute words (its own and from above), subtree sizes and densities,
    depth, siblings."""
    n = len(nodes)
    own = np.array([sum(len(c.strip()) for c in x.content if isinstance(c, str)) for x in nodes], float)
    stops = np.array([sum(c.count(".") + c.count(",") for c in x.content if isinstance(c, str)) for x in nodes], float)
    links = np.array([x.linked for x in nodes], float)
    tags = np.array([1 + x.inline for x in nodes], float)
    paragraphs = np.array([x.tag == "p" for x in nodes], float)
    size, sums = own.copy(), [stops, links, tags, paragraphs]
    for i in range(n - 1, 0, -1):
        parent = nodes[i].parent
        size[parent] += size[i]
        for s in sums:
            s[parent] += s[i]
    words = [said(x.attributes) for x in nodes]
    groups = [[x.tag in g for g in TAGS] for x in nodes]
    above = np.zeros((n, len(WORDS) + 7))
    for i in range(1, n):
        p = nodes[i].parent
        inherits = [*words[p], *groups[p][5:12]]
        above[i] = np.maximum(above[p], inherits)
    total = max(size[0], 1.0)
    place = [0] * n
    for x in nodes:
        for k, child in enumerate(x.children):
            place[child] = k
    out = np.zeros((n, 15))
    for i, x in enumerate(nodes):
        kin = nodes[x.parent].children if x.parent >= 0 else [i]
        k = place[i]
        length = max(size[i], 1.0)
        around = max(size[x.parent], 1.0) if x.parent >= 0 else length
        out[i] = (
            math.log1p(size[i]), math.log1p(own[i]), links[i] / length, stops[i] / length, size[i] / tags[i], paragraphs[i],
            len(x.children), x.depth, k / len(kin), math.log1p(len(kin)), size[i] / total, size[i] / around,
            math.log1p(size[kin[k - 1]]) if k > 0 else -1.0, math.log1p(size[kin[k + 1]]) if k < len(kin) - 1 else -1.0, tags[i],
        )
    return np.concatenate([np.array(groups, float), np.array(words, float), above, out], axis=1)


def decode(nodes: list[Node], odds: np.ndarray) -> list[bool]:
    """The most probable choice of kept nodes in which each one's parent is kept."""
    keep, drop = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    best, none = keep.copy(), drop.copy()
    for i in range(len(nodes) - 1, 0, -1):
        best[nodes[i].parent] += max(best[i], none[i])
        none[nodes[i].parent] += none[i]
    kept = [True] * len(nodes)
    for i in range(1, len(nodes)):
        kept[i] = kept[nodes[i].parent] and bool(best[i] >= none[i])
    return kept


def made_page(rng: random.Random, texts: list[str]) -> str:
    """A page whose main text stands in elements with the attribute data-main."""

    def line(low: int = 2, high: int = 12) -> str:
        words = rng.choice(texts).split() or ["text"]
        k = rng.randrange(max(1, len(words) - low))
        return " ".join(words[k : k + rng.randint(low, high)])

    def some(*kinds: str) -> str:
        return rng.choice(kinds)

    def many(usual: int) -> int:
        """Now and then as many siblings as long pages have."""
        return rng.randint(50, 300) if rng.random() < 0.02 else usual

    def menu() -> str:
        items = "".join(f'<li><a href="/{k}">{line(1, 3)}</a></li>' for k in range(many(rng.randint(2, 9))))
        return some(f"<nav><ul>{items}</ul></nav>", f"<nav class=main-nav>{items}</nav>", f'<div class="{some("menu", "navbar", "site-navigation", "breadcrumbs", "pagination")}"><ul>{items}</ul></div>', f'<div role="navigation"><ul>{items}</ul></div>')

    def header() -> str:
        inner = some(f"<h1>{line(1, 4)}</h1>", f"<p>{line(2, 8)}</p>", f"<div class=logo>{line(1, 2)}</div><p>{line(2, 9)}</p>") + (menu() if rng.random() < 0.4 else "")
        return some(f"<header>{inner}</header>", f'<header class="site-header">{inner}</header>', f'<div id="{some("header", "masthead", "topbar")}">{inner}</div>')

    def notice() -> str:
        inner = some(line(6, 25), f"<p>{line(6, 25)}</p>", f"<p>{line(5, 15)}</p><button>{line(1, 2)}</button>")
        return f'<{(t := some("div", "section", "aside"))} {some("class", "id")}="{some("cookie-notice", "cookie-banner", "notice", "consent", "alert", "banner", "gdpr", "popup")}">{inner}</{t}>'

    def advert() -> str:
        inner = some(line(4, 20), f"<p>{line(4, 30)}</p>", f'<a href="/x">{line(3, 9)}</a>')
        return f'<{(t := some("div", "div", "aside", "section"))} class="{some("ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-box", "ad-slot")}">{inner}</{t}>'

    def side() -> str:
        links = "<ul>" + "".join(f'<li><a href="/{k}">{line(2, 7)}</a></li>' for k in range(rng.randint(2, 6))) + "</ul>"
        inner = f"<h3>{line(1, 3)}</h3>" * rng.randint(0, 1) + some(links, f"<p>{line(6, 40)}</p>", f"<p>{line(6, 30)}</p><p>{line(6, 30)}</p>")
        return some(f"<aside>{inner}</aside>", f'<aside class="sidebar">{inner}</aside>', f'<div class="{some("sidebar", "related", "widget", "share", "recommended")}">{inner}</div>')

    def form() -> str:
        inner = some(f"<label>{line(1, 3)}</label><input><button>{line(1, 2)}</button>", f"<p>{line(3, 12)}</p><input type=text><button>{line(1, 1)}</button>")
        return some(f"<form>{inner}</form>", f'<form class="{some("newsletter", "search", "subscribe", "login")}">{inner}</form>', f'<div class="newsletter"><form>{inner}</form></div>')

    def comments() -> str:
        tag = some("div", "section", "li", "article")
        each = "".join(f'<{tag} class="comment">{some("", f"<b>{line(1, 2)}</b>", f"<h4>{line(1, 2)}</h4>")}<p>{line(3, 60)}</p></{tag}>' for _ in range(many(rng.randint(1, 6))))
        return f'<{(t := some("div", "section"))} {some("id", "class")}="{some("comments", "comment-list", "responses", "discussion", "reader-comments")}">{some("", f"<h3>{line(1, 2)}</h3>")}{each}</{t}>'

    def footer() -> str:
        inner = some(f"&copy; {line(1, 4)} &middot; {line(2, 9)}", f"<p>{line(3, 20)}</p>", f"<p>{line(3, 9)}</p>" + menu())
        return some(f"<footer>{inner}</footer>", f'<div class="{some("footer", "site-footer", "copyright", "legal")}">{inner}</div>')

    def article() -> str:
        parts = []
        if rng.random() < 0.8:
            parts.append(f"<{(h := some('h1', 'h1', 'h2'))} data-main>{line(1, 10)}</{h}>")
        for _ in range(many(rng.choice([1, 1, 2, 3, 5, 8, 14]))):
            long = rng.choice(texts) if rng.random() < 0.75 else line(1, 6)
            kind = rng.random()
            if kind < 0.8:
                parts.append(f"<p data-main>{some('', '<b>')}{long}{some('</p>', '</p>', '<br>')}")
            elif kind < 0.86:
                parts.append(f"<h2 data-main>{line(1, 6)}</h2>")
            elif kind < 0.9:
                parts.append("<ul data-main>" + "".join(f"<li data-main>{line(2, 20)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
            elif kind < 0.94:
                parts.append(f"<blockquote data-main><p data-main>{long}</p></blockquote>")
            elif kind < 0.97:
                parts.append(f"<pre data-main>{line(3, 20)}</pre>")
            else:
                parts.append(f"<table data-main><tr data-main><td data-main>{line(1, 4)}</td><td data-main>{line(1, 4)}</td></tr></table>")
        for extra, share in ((advert, 0.15), (form, 0.05), (side, 0.05), (notice, 0.05)):
            if rng.random() < share:
                parts.insert(rng.randint(1, len(parts)), extra())
        inner = "".join(parts)
        if rng.random() < 0.1:
            inner += comments()
        body = some("article", "article", "main", "div class=content", 'div class="post-content"', 'div id="article-body"', "div", "section", 'div class="entry"')
        out = f"<{body} data-main>{inner}</{body.split()[0]}>"
        return some(out, out, f"<main data-main>{out}</main>", f"<div data-main>{out}</div>", f'<div id="wrapper" data-main>{out}</div>')

    def often(share: float, make) -> str:
        return make() if rng.random() < share else ""

    top = [often(0.6, menu), often(0.4, header), often(0.3, notice), often(0.4, advert), often(0.1, form)]
    rng.shuffle(top)
    below = [often(0.35, side), often(0.35, comments), often(0.25, form), often(0.25, advert), often(0.2, notice)]
    rng.shuffle(below)
    return f"<!DOCTYPE html><html><head><title>{line()}</title></head><body>{often(0.1, side)}{''.join(top)}{article()}{''.join(below)}{often(0.7, footer)}{some('</body></html>', '')}"


def learn(texts: list[str]) -> Boosted:
    """Trees from made pages; the same ones for the same paragraphs."""
    rng = random.Random(17)
    texts = sorted(texts) or ["text"]
    x, y = [], []
    for _ in range(MADE_PAGES):
        page = made_page(rng, texts)
        nodes = parse(re.sub(r"(<[a-z0-9]+[^>]*?) data-main>", r"\1>", page))
        marks = [m[0].endswith(" data-main>") for m in re.finditer(r"<([a-z][a-z0-9]*)[^>]*>", page) if m[1] in _BLOCKS]
        main = [False, *marks]
        for i in range(len(nodes) - 1, 0, -1):
            main[nodes[i].parent] |= main[i]
        x.append(features(nodes))
        y += main
    return Boosted().fit(np.concatenate(x), np.array(y, float))


# The block elements that made pages use.
_BLOCKS = frozenset("html body header nav div section aside article main form footer ul li p h1 h2 h3 h4 blockquote pre table tr td".split())


def extract(model: Boosted, pages: list[str]) -> list[str]:
    """Main text of each page; the trees see all nodes at once."""
    parsed = [parse(p) for p in pages]
    if not parsed:
        return []
    odds = model.log_odds(np.concatenate([features(n) for n in parsed]))
    out, at = [], 0
    for nodes in parsed:
        out.append(blocks(nodes, decode(nodes, odds[at : at + len(nodes)])))
        at += len(nodes)
    return out


def train(pages: DataFrame, html: str = "html", page_id: str = "page_id") -> Boosted:
    """Learns from the paragraphs of at most `SAMPLE_PAGES` pages, those with the lowest hashes of
    their id; ids are chosen first, so only the chosen pages leave the executors. Of rows that share an
    id one page is; an empty table gives a model of made text alone."""
    known = pages.filter(F.col(html).isNotNull() & F.col(page_id).isNotNull())
    ids = known.select(page_id).distinct().orderBy(F.xxhash64(page_id), page_id).limit(SAMPLE_PAGES)
    chosen = [r[0] for r in ids.collect()]
    rows = known.filter(F.col(page_id).isin(chosen)).groupBy(page_id).agg(F.min(html).alias("_html")).select("_html").collect() if chosen else []
    texts = {" ".join("".join(c for c in n.content if isinstance(c, str)).split()) for r in rows for n in parse(r[0]) if n.tag == "p"}
    return learn([t.replace("&", "&amp;").replace("<", "&lt;") for t in texts if t])


def main_text(spark: SparkSession, model: Boosted, html: Column) -> Column:
    """The main text of a whole page; null and empty pages have none, repeated rows each their own."""
    ready_for_python(spark)

    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array(extract(model, pages.to_pylist()), pa.string())

    return run(exact_text(html))


def op7_maintext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = pages.select("page_id", "url", main_text(spark, train(pages), F.col("html")).alias("text"))
    return out.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
