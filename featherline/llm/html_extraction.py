"""Main text of pages by consensus: pages score their containers, hosts vote on generalised paths, winners extract."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featherline.llm.common import materialize, table

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][\w:-]*)([^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+)>|([^<]+)", re.S)
#: A tag whose quotes don't close ends at the next >.
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][\w:-]*)([^>]*+)>")
_TOKEN_PLAIN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][\w:-]*)([^>]*+)>|([^<]+)", re.S)
_ATTRIBUTE = re.compile(r"([\w:-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Elements that hold no page text; all up to their end tag is passed over.
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "object", "canvas", "audio", "video", "select", "option", "noembed", "noframes", "xmp"}
_BLOCK = {"html", "body", "head", "address", "article", "aside", "blockquote", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "caption", "search"}
_LEAF = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "pre"}
#: An open element of the second kind ends where one of the first begins.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "body": {"head"}}
_ASIDE_TAGS = {"nav", "aside", "footer", "form", "menu", "dialog", "button", "search"}
_ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form", "toolbar"}
_ASIDE_WORDS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsbygoogle", "adbox", "adslot", "banner", "breadcrumb", "breadcrumbs", "byline", "comment", "comments", "commentlist", "respond", "reply", "replies", "consent", "cookie", "cookies", "cookiebar", "disclaimer", "discussion", "disqus", "footer", "form", "gdpr", "header", "masthead", "login", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "overlay", "pager", "pagination", "paywall", "popup", "promo", "promoted", "promotion", "recommended", "recommendations", "related", "responses", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "tags", "toolbar", "topbar", "widget", "widgets",
}
#: Words that say nothing of what a class holds.
_LAYOUT_WORDS = {
    "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "center", "col", "column", "container", "content", "count", "field", "fixed", "floating", "global", "group", "head", "heading", "icon", "icons", "inline", "inner", "item", "items", "js", "label", "layout", "left", "links", "list", "main", "message", "middle", "module", "new", "note", "outer", "page", "panel", "post", "posts", "primary", "region", "right", "row", "secondary", "section", "site", "slot", "small", "sticky", "story", "stories", "strip", "text", "thread", "title", "tools", "top", "unit", "user", "view", "wrap", "wrapper", "zone",
}
_SPACE = re.compile(r"\s+")


@dataclass(slots=True)
class Node:
    tag: str
    path: str
    skip: bool = False  # within something that is no article text
    inside: bool = False  # an article
    mark: tuple[str, ...] = ()  # class names that the path shows
    parent: Node | None = None
    length: int = 0  # of its own blocks' text
    link: int = 0


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    blocks: list[tuple[Node, str]] = field(default_factory=list)


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)} if text.strip() else {}


def _names(value: str) -> list[str]:
    return [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()) if w] if value else []


def _start(tag: str, text: str, within_article: bool) -> tuple[tuple[str, ...], str, bool]:
    """See _read_start; what long tags say is not remembered."""
    return (_read_start if len(text) <= 300 else _read_start.__wrapped__)(tag, text, within_article)


@lru_cache(maxsize=20_000)
def _read_start(tag: str, text: str, within_article: bool) -> tuple[tuple[str, ...], str, bool]:
    """Class names without digits, the step they make in a path, and whether the element is set aside."""
    attributes = _attributes(text)
    mark = tuple(sorted(set(_names(attributes.get("class", "")))))
    return mark, ".".join((tag, *mark)), _set_aside(tag, attributes, within_article)


@lru_cache(maxsize=100)
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}\s*>", re.I)


def _set_aside(tag: str, attributes: dict[str, str], within_article: bool) -> bool:
    if tag in _ASIDE_TAGS or tag == "header" and not within_article or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if attributes.get("role", "").lower() in _ASIDE_ROLES or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", "")):
        return True
    if tag in ("article", "main", "body", "html"):
        return False
    return any(map(_says_aside, [*attributes.get("class", "").split(), attributes.get("id", "")]))


@lru_cache(maxsize=20_000)
def _says_aside(name: str) -> bool:
    """Whether one class name speaks of parts beside an article and of nothing else: `related-posts` does, `related-work` doesn't."""
    own = set(_names(name))
    return bool(own & _ASIDE_WORDS) and own <= _ASIDE_WORDS | _LAYOUT_WORDS


def parse(html: str | None) -> Page:
    """Containers and text blocks in page order, in time and memory in proportion to the page. Unclosed and crossing tags are taken as browsers take them, roughly; any text parses."""
    page = Page()
    root = Node("", "")
    page.nodes.append(root)
    at, text, linked, links = root, [], 0, 0

    def end_block() -> None:
        nonlocal text, linked
        if text:
            if body := _SPACE.sub(" ", "".join(text)).strip():
                page.blocks.append((at, body))
                home = at.parent if at.tag in _LEAF and at.parent else at
                home.length += len(body)
                home.link += min(linked, len(body))
            text, linked = [], 0

    html = html or ""
    pos, n, last = 0, len(html), (html or "").rfind(">")
    quoted, endless = True, set()  # whether quotes may hold a >; elements without an end tag from here on
    open_: Counter[str] = Counter()
    while pos < n:
        m = _TOKEN.match(html, pos) if quoted else _TOKEN_PLAIN.match(html, pos)
        if m is None and quoted and pos < last and _PLAIN_TAG.match(html, pos):  # quotes that don't close up to the page's end: found once
            quoted = False
            continue
        if m is None:  # no tag
            stop = html.find("<", pos + 1) if pos < last else n
            pos, t = (n if stop < 0 else stop), html[pos : n if stop < 0 else stop]
            t = unescape(t) if "&" in t else t
            text.append(t)
            linked += len(t) if links else 0
            continue
        pos = m.end()
        if m[5] is not None or m[1] is not None:
            t = m[5] if m[5] is not None else m[1]
            t = unescape(t) if "&" in t and m[5] is not None else t
            text.append(t)
            linked += len(t) if links else 0
            continue
        if m[3] is None:
            continue
        tag = m[3].lower()
        if m[2]:
            if tag == "a":
                links = 0
            if tag in _BLOCK:
                if open_[tag]:
                    end_block()
                    while at.tag != tag:
                        open_[at.tag] -= 1
                        at = at.parent
                    open_[tag] -= 1
                    at = at.parent
                elif tag == "p":
                    end_block()
            continue
        if tag in _RAW:
            close = None if tag in endless else _end_of(tag).search(html, pos)
            if close:
                pos = close.end()
            elif tag in ("script", "style", "textarea", "title", "xmp"):
                pos = n
            else:
                endless.add(tag)
            continue
        if tag == "a":
            links = 1
        if tag == "br":
            text.append(" ")
        if tag not in _BLOCK:
            continue
        end_block()
        if tag == "hr":
            continue
        while at.parent and at.tag in _LEAF and at.tag != "pre":
            open_[at.tag] -= 1
            at = at.parent
        for _ in range(3):
            if at.parent and at.tag in _ENDS.get(tag, ()):
                open_[at.tag] -= 1
                at = at.parent
        mark, name, aside = _start(tag, m[4], at.inside)
        if m[4].rstrip().endswith("/") and tag not in _LEAF:
            continue
        path = f"{at.path}/{name}"
        if len(path) > 500:  # deep pages: what leads here by its hash, so that paths take no more than their steps
            path = f"#{xxhash.xxh3_128_hexdigest(path.encode('utf-8', 'replace'))}"
        at = Node(tag, path, at.skip or aside, at.inside or tag in ("article", "main"), mark, at)
        open_[tag] += 1
        page.nodes.append(at)
    end_block()
    return page


_TOLD = {"article": 3.0, "main": 2.0}
_TOLD_WORDS = {"article", "content", "story", "post", "entry", "body", "main", "text"}


def scores(page: Page) -> dict[str, float]:
    """Score of each container path of a page: characters of its own and, at a discount a level, of its descendants' blocks outside links, raised for telling names; set-aside parts count nothing."""
    own: dict[int, float] = {}
    for node in page.nodes:
        if node.skip or not node.length:
            continue
        plain = max(0.0, node.length - 2.0 * node.link)
        share, up = 1.0, node
        while up and share > 0.1:
            if up.tag not in ("html", "head", ""):
                own[id(up)] = own.get(id(up), 0.0) + plain * share
            share *= 0.75
            up = up.parent
    out: dict[str, float] = {}
    for node in page.nodes:
        if (s := own.get(id(node), 0.0)) > 0 and not node.skip and node.tag not in _LEAF:
            s *= _TOLD.get(node.tag, 1.5 if _TOLD_WORDS & set(node.mark) else 1.0)
            out[node.path] = out.get(node.path, 0.0) + s
    return out


def text_under(page: Page, path: str | None) -> str | None:
    """Blocks under containers of that path, without set-aside parts; None if the page has none."""
    under: set[int] = set()
    for node in page.nodes:  # parents come first
        if node.path == path or id(node.parent) in under:
            under.add(id(node))
    found = [b for node, b in page.blocks if not node.skip and id(node) in under]
    return "\n\n".join(found) if found else None


def extract(page: Page, path: str | None) -> str:
    """By the host's path; a page without it by its own best container; one without containers gives all text that isn't set aside."""
    out = text_under(page, path) if path else None
    if out is None:
        own = scores(page)
        out = text_under(page, max(own, key=lambda p: (own[p], p))) if own else "\n\n".join(b for node, b in page.blocks if not node.skip)
    return out or ""


def host_paths(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """(host, path): every page votes for its best-scoring container path, at most 1 vote in sum shared with those within a tenth
    of the best; the path with most votes wins, ties by score, then by path. A null url is the host ''.
    """

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            votes: dict[tuple[str, str], list[float]] = {}
            for host, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                s = scores(parse(x.as_py()))
                if s:
                    best = max(s.values())
                    top = [p for p, v in s.items() if v >= 0.9 * best]
                    for p in top:
                        v = votes.setdefault((host, p), [0.0, 0.0])
                        v[0] += 1 / len(top)
                        v[1] += s[p]
            yield pa.RecordBatch.from_pylist([{"host": h, "path": p, "votes": v, "weight": w} for (h, p), (v, w) in votes.items()], pa.schema([("host", pa.string()), ("path", pa.string()), ("votes", pa.float64()), ("weight", pa.float64())]))

    ballots = pages.select(_host(F.col(url)).alias("host"), F.col(html)).mapInArrow(vote, "host string, path string, votes double, weight double")
    counts = ballots.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("weight").alias("weight"))
    return counts.groupBy("host").agg(F.max_by("path", F.struct(F.round("votes", 6), F.round("weight", 3), "path")).alias("path"))


def _host(url) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][\w+.-]*:)?(?://)?(?:[^/?#@]*@)?([^/?#:]*)", 1))


def main_text(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", most_hosts: int = 100_000, salt: int = 32) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    The winners are sent to all tasks while there are at most `most_hosts`; beyond that pages meet their host's path by a
    join on (host, salt), so that a host with a third of all pages spreads over `salt` tasks. A null or empty html, or one without text,
    gives the empty text. Repeated rows are kept.
    """
    winners = materialize(host_paths(pages, url=url, html=html), "host-paths")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), _host(F.col(url)).alias("host"))
    if winners.count() <= most_hosts:
        rows = rows.join(F.broadcast(winners), "host", "left")
    else:
        rows = rows.withColumn("s", F.pmod(F.xxhash64("page_id", "url"), F.lit(salt))).join(winners.withColumn("s", F.explode(F.array(*[F.lit(i).cast("long") for i in range(salt)]))), ["host", "s"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(parse(x.as_py()), p) for x, p in zip(b.column(2), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.select("page_id", "url", "html", "path").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
