"""Main text of web pages by template deduction over the pages of a host.

Tokens are tags and text nodes, each with the path it stands in. Tokens that occur equally often in
every page of a host (equal occurrence vectors) form an equivalence class; a class with enough
pages is valid, split by the class in whose slots its tokens nest, and the nested valid classes are the host's template. Text
that belongs to it is boilerplate, what remains fills the slots, and the slots of the article are the main text.

An occurrence vector is kept as a sum of hashes of (page, count), so it is aggregated like any sum: no page set
of a host is ever collected.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from membervane.llm.common import staged

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|iframe|textarea|select|object|math)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^<>]*+)>"
    r"|<[!?][^>]*+>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# Elements without content, and elements that stand in a line of text (fixed values of HTML).
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
UNSEEN = {"script", "style", "noscript", "template"}
# A start tag of the key ends open elements of the value, up to the next container.
CLOSES = {
    **dict.fromkeys(
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
        "hr main menu nav ol p pre section table ul".split(),
        {"p"},
    ),
    "li": {"li", "p"},
    "dt": {"dt", "dd", "p"},
    "dd": {"dt", "dd", "p"},
    "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"},
    "th": {"td", "th", "p"},
    "option": {"option"},
    "body": {"head"},
}
CONTAINERS = set("html body div section article main aside nav header footer form table ul ol dl blockquote figure details fieldset".split())
# Elements that never hold main text, wherever they stand; and names of classes, ids and roles that say so.
NEVER_TAGS = set("head nav footer aside form button menu dialog label legend option audio video canvas title".split())
NEVER_NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice notices alert popup modal overlay toast newsletter subscribe subscription signup login register menu "
    "menus nav navbar navigation breadcrumb breadcrumbs sidebar sidebars aside widget widgets related recommended recommendations "
    "share sharing social comment comments respond reply replies disqus discussion footer foot masthead search pagination "
    "pager toolbar copyright legal disclaimer tags tagcloud skip topbar complementary contentinfo hidden teaser teasers outbrain taboola".split()
)
#: Names that mark the head of a page, but the title when inside an article.
HEAD_NAMES = {"header", "head", "top"}
#: Words of text inside an article that the template may take away; pages of a host and share of them a class needs.
SHORT, LEAST_PAGES, SHARE = 10, 8, 0.9


@dataclass(slots=True)
class Node:
    """A text node: where it stands, in which block, and whether in boilerplate, an article or a link."""

    path: int
    parents: tuple[int, ...]
    block: int
    boilerplate: bool
    article: int
    link: bool
    text: str


@dataclass(slots=True)
class Page:
    nodes: list[Node] = field(default_factory=list)
    tags: Counter = field(default_factory=Counter)
    parent: dict[int, int] = field(default_factory=dict)
    marked: set[int] = field(default_factory=set)


_steps: dict[tuple, tuple[int, bool, bool]] = {}


def step(path: int, name: str, raw: str) -> tuple[int, bool, bool]:
    """Path of a child element; whether its names say boilerplate, and whether they say head of a page."""
    key = (path, name, raw)
    found = _steps.get(key)
    if found is None:
        values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(raw)}
        label = " ".join(values.get(k, "") for k in ("class", "id", "role"))
        spaced = re.sub(r"([a-z])([A-Z])", r"\1 \2", label)
        spaced = re.sub(r"\b(?:has|with|no|without|non)[-_ ]\w+", " ", spaced.lower())
        names = set(re.split(r"[^a-z]+", spaced))
        hidden = "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in values.get("style", "").replace(" ", "")
        whole = name in ("html", "body", "main", "article")
        article_never = name == "article" and bool(names & {"comment", "reply", "related", "teaser", "ad", "advert", "promo", "sponsored"})
        never = (bool(names & NEVER_NAMES) and not whole) or hidden or name in NEVER_TAGS or article_never
        head = (bool(names & HEAD_NAMES) and not whole) or name == "header"
        shape = re.sub(r"\d+", "0", f"{name}.{values.get('class', '')}#{values.get('id', '')}")
        digest = xxhash.xxh64_intdigest(f"{path}/{shape}".encode("utf-8", "replace")) >> 1
        if len(_steps) > 200_000:
            _steps.clear()
        found = _steps[key] = digest, never, head
    return found


def parse(page: str) -> Page:
    """Text nodes and tag counts of a page; unclosed and stray tags are tolerated."""
    out = Page()
    # Open elements: name, path, boilerplate, article, link, paths from the root.
    stack: list[tuple] = [("", 0, False, 0, False, ())]
    block = articles = at = 0

    def text(raw: str) -> None:
        if raw:
            name, path, never, article, link, parents = stack[-1]
            out.nodes.append(Node(path, parents, block, never, article, link, html_lib.unescape(raw) if "&" in raw else raw))

    for m in TAG.finditer(page):
        text(page[at : m.start()])
        at = m.end()
        closing, name, raw = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
        if name is None:
            if m[1] and m[1].lower() not in UNSEEN:
                block += 1
            continue
        name = name.lower()
        if closing:
            if name not in INLINE:
                block += 1
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
                if name in INLINE and stack[k][0] in CONTAINERS:
                    break
            continue
        if name not in INLINE:
            block += 1
        if name in VOID:
            continue
        ends = CLOSES.get(name)
        if ends:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in ends:
                    del stack[k:]
                    break
                if stack[k][0] in CONTAINERS:
                    break
        _, path, never, article, link, parents = stack[-1]
        own, says_never, says_head = step(path, name, raw)
        if name in ("article", "main") and not (never or says_never):
            articles += 1
            article = articles
        never = never or says_never or (says_head and not article)
        if says_never or says_head:
            out.marked.add(path)
        out.tags[own] += 1
        out.parent[own] = path
        if not raw.rstrip().endswith("/"):
            stack.append((name, own, never, article, link or name == "a", (*parents, own)))
    text(page[at:] if "<" not in page[at:] else re.sub(r"<[^<>]*\Z", "", page[at:]))
    return out


def token_of(node: Node) -> int:
    """The token of a text node: its path and its words."""
    return xxhash.xxh64_intdigest(f"{node.path}|{' '.join(node.text.split())}".encode("utf-8", "replace")) >> 1


def joined(nodes: list[Node]) -> str:
    """Blocks in page order, white space reduced, joined by one blank."""
    parts, block = [], None
    for n in nodes:
        if n.block != block:
            parts.append(" ")
            block = n.block
        parts.append(n.text)
    return " ".join("".join(parts).split())


def words(nodes: list[Node]) -> int:
    return sum(len(n.text.split()) for n in nodes)


def main_nodes(page: Page, constants: set[int]) -> list[Node]:
    """The nodes of the main text: the article, or the container whose slots hold most text outside links."""
    kept = [n for n in page.nodes if not n.boilerplate]
    inside = [n for n in kept if n.article]
    if constants:
        inside = [n for n in inside if not (n.text.strip() and len(n.text.split()) <= SHORT and token_of(n) in constants)]
    if inside:
        size = Counter()
        for n in inside:
            size[n.article] += 0 if n.link else len(n.text.split())
        best = max(size, key=lambda a: (size[a], -a))
        if size[best]:
            return [n for n in inside if n.article == best]
    slots = [n for n in kept if not (constants and n.text.strip() and token_of(n) in constants)]
    size = Counter()
    for n in slots:
        if len(n.parents) > 1 and not n.link:
            size[n.parents[-2]] += len(n.text.split())
        elif n.parents and not n.link:
            size[n.parents[-1]] += len(n.text.split())
    if not size:
        return slots if words(slots) else []
    best = max(size, key=lambda p: (size[p], p))
    # Up to the container of the title, but not to one that also holds marked boilerplate.
    ways = [n.parents for n in slots if best in n.parents]
    way = ways[0][: ways[0].index(best) + 1] if ways else (best,)
    for upper in reversed(way[2:-1]):
        if upper in page.marked:
            break
        best = upper
    return [n for n in slots if best in n.parents]


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def tokens_of(pages: DataFrame) -> DataFrame:
    """``host, token, parent, is_tag, short, count`` with a hash of the page, one row per page and token; and a row per page.

    The row per page has token -1, and as ``parent`` a hash of its longest block.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for host, key, source in zip(batch["host"], batch["page"], batch["html"]):
                page = parse(source)
                texts: dict[int, list] = {}
                longest = ""
                for n in page.nodes:
                    if n.text.strip():
                        longest = max(longest, n.text, key=len)
                        found = texts.setdefault(token_of(n), [n.path, 0])
                        found[1] += 1
                rows += [(host, key, t, p, False, c) for t, (p, c) in texts.items()]
                rows += [(host, key, t, page.parent[t], True, c) for t, c in page.tags.items()]
                rows.append((host, key, -1, xxhash.xxh64_intdigest(longest.encode("utf-8", "replace")) >> 1, False, 1))
            yield pd.DataFrame(rows, columns=["host", "page", "token", "parent", "is_tag", "count"])

    found = pages.where(F.col("html").isNotNull()).select(
        host_of(F.col("url")).alias("host"), F.xxhash64("page_id", "url", F.length("html")).alias("page"), "html"
    )
    return found.mapInPandas(run, "host string, page long, token long, parent long, is_tag boolean, count int")


def deduce_templates(pages: DataFrame, least_pages: int = LEAST_PAGES, share: float = SHARE) -> DataFrame:
    """``host, class, parent_class, pages, tokens, constants``: the nested valid classes of every host.

    ``constants`` are the text tokens of a class. A class is valid if a tag has its vector and it occurs in at least ``share`` of the
    host's pages; its tokens are told apart by the class in whose tags they stand (``parent_class``, null for their own). Hosts with fewer
    than ``least_pages`` pages, or whose pages mostly share their longest block (copies of one text), have no template.
    """
    tokens = tokens_of(pages)
    vector = F.sum(F.xxhash64("page", "count").cast("decimal(38,0)"))
    grouped = tokens.groupBy("host", "token", "is_tag", F.when(F.col("token") >= 0, F.col("parent")).alias("parent"))
    grouped = grouped.agg(vector.alias("vector"), F.count(F.lit(1)).alias("pages"), F.approx_count_distinct("parent").alias("texts"))
    # Of text that only a few pages hold nothing is a template; tags and the row per page are few.
    grouped = staged(grouped.where(F.col("is_tag") | (F.col("token") < 0) | (F.col("pages") >= least_pages)), "page-tokens")
    return staged(_classes(_hosts(grouped, least_pages), grouped, share), "templates")


def _hosts(grouped: DataFrame, least_pages: int) -> DataFrame:
    """``host, host_pages`` of the hosts that have enough different pages."""
    rows = grouped.where("token < 0").groupBy("host").agg(F.sum("pages").alias("host_pages"), F.max("texts").alias("texts"))
    return rows.where((F.col("host_pages") >= least_pages) & (F.col("texts") * 2 >= F.col("host_pages"))).select("host", "host_pages")


def _classes(hosts: DataFrame, grouped: DataFrame, share: float) -> DataFrame:
    frequent = grouped.where("token >= 0").join(hosts, "host").where(F.col("pages") >= share * F.col("host_pages"))
    tags = frequent.where("is_tag").select("host", F.col("token").alias("parent"), F.col("vector").alias("parent_vector"))
    nested = frequent.join(tags, ["host", "parent"], "left")
    slot = F.when(F.col("parent_vector") != F.col("vector"), F.col("parent_vector"))
    own = tags.select("host", F.col("parent_vector").alias("vector")).distinct()
    nested = nested.withColumn("parent_class", slot).join(own, ["host", "vector"], "left_semi")
    classes = nested.groupBy("host", F.col("vector").alias("class"), "parent_class").agg(
        F.max("pages").alias("pages"),
        F.count(F.lit(1)).alias("tokens"),
        F.collect_list(F.when(~F.col("is_tag"), F.col("token"))).alias("constants"),
    )
    return classes.select("host", "class", "parent_class", "pages", "tokens", "constants")


def extract(pages: DataFrame, least_pages: int = LEAST_PAGES, share: float = SHARE) -> DataFrame:
    """``page_id, url, text`` of every row of ``page_id, url, html``: the main text, empty if there is none.

    Null html is empty. Pages without a host share the empty host. Rows may repeat; each is extracted. Inside an article only
    short template text is taken away, elsewhere all of it. Empty tables give empty results; other columns are not read.
    """
    templates = deduce_templates(pages, least_pages, share)
    constants = templates.groupBy("host").agg(F.flatten(F.collect_list("constants")).alias("_constants"))
    constants = staged(constants.where(F.size("_constants") > 0), "constants")
    rows = pages.select("page_id", "url", "html").withColumn("host", host_of(F.col("url"))).join(constants, "host", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known: dict[str, set[int]] = {}
            texts = []
            for host, source, found in zip(batch["host"], batch["html"], batch["_constants"]):
                if host not in known:
                    known[host] = set() if found is None else set(np.asarray(found).tolist())
                texts.append(joined(main_nodes(parse(source or ""), known[host])))
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts})

    return rows.select("page_id", "url", "html", "host", "_constants").mapInPandas(run, "page_id long, url string, text string")
