"""HTML extraction by consensus host paths."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import written

#: Paths of a host that are tried on its pages, in order of their votes.
PATHS_TRIED = 5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|math|iframe|textarea|select|title|object)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    # A quoted value holds anything up to its quote; one that is never closed ends before the next tag.
    r"|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"'<=]++|=\s*+(?:\"[^\"]*+\"(?=[\s/>])|'[^']*+'(?=[\s/>])|\"[^\"<]*+\"|'[^'<]*+')?|[\"'])*+)>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b")
_PART = re.compile(r"[a-z]+")

_CONTAINERS = frozenset(
    "html body div article section main table tbody thead tfoot tr td th center details figure hgroup "
    "nav header footer aside form menu dialog head address fieldset ul ol dl button".split()
)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCKS = _CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre figcaption caption summary hr option legend".split())

# What is no part of an article, by tag, by role, and by a word of a class or id.
_LEFT_OUT_TAGS = frozenset("nav header footer aside form menu dialog head button fieldset address".split())
_LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form alertdialog".split())
_LEFT_OUT_WORDS = frozenset(
    "nav navbar navigation menu menubar sidebar aside footer foot ad ads advert adverts advertisement advertising adsense "
    "adslot adbox adunit sponsor sponsored sponsors promo promotion promoted banner cookie cookies consent gdpr notice notices "
    "popup modal overlay comment comments commentlist disqus reply replies respond discussion social share sharing "
    "related recommended recommendations breadcrumb breadcrumbs newsletter subscribe subscription signup login "
    "pagination pager widget widgets toolbar masthead skip paywall toc tags byline".split()
)
_HEADER_WORDS = frozenset("header heading top topbar".split())
_ARTICLE_WORDS = frozenset("article post entry content story main body text".split())


class _Container:
    __slots__ = ("tag", "parent", "path", "left_out", "prose", "bonus")

    def __init__(self, tag: str, parent: int, path: str, left_out: bool, bonus: float):
        self.tag, self.parent, self.path, self.left_out, self.prose, self.bonus = tag, parent, path, left_out, 0.0, bonus


def _described(tag: str, attributes: str) -> tuple[str, bool, float]:
    """A tag's part of a generalised path, whether it is left out, and its bonus as a container."""
    left_out, bonus, classes = tag in _LEFT_OUT_TAGS, 1.5 if tag in ("article", "main") else 1.0, []
    if attributes and not attributes.isspace():
        for name, double, single, plain, hidden in _ATTRIBUTE.findall(attributes):
            value = (double or single or plain).lower()
            name = name.lower()
            if name in ("class", "id"):
                words = set(_PART.findall(value))
                if words & _LEFT_OUT_WORDS or words & _HEADER_WORDS and not words & _ARTICLE_WORDS:
                    left_out = True
                if words & _ARTICLE_WORDS:
                    bonus *= 1.25
                if name == "class":
                    # Without numbers, so that numbered classes of one kind agree.
                    classes += sorted({re.sub(r"[\d_-]+", "", c) for c in value.split()} - {""})
            elif name == "role" and value in _LEFT_OUT_ROLES:
                left_out = True
            elif hidden or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
                left_out = True
    return ".".join([tag, *classes]), left_out, bonus


def parsed(page: str) -> tuple[list[_Container], list[tuple[int, str, float]]]:
    """A page's containers, and its blocks of text: container, text, and how much of it is prose."""
    containers = [_Container("", -1, "", False, 1.0)]
    blocks: list[tuple[int, str, float]] = []
    stack, parts, linked, in_link, at = [0], [], 0, False, 0

    def close_block() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text and not containers[stack[-1]].left_out:
                blocks.append((stack[-1], text, max(0.0, len(text) - 1.5 * linked)))
            parts, linked = [], 0

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            text = page[at : m.start()]
            parts.append(text)
            if in_link:
                linked += len(text)
        at = m.end()
        raw, closing, name, attributes = m.groups()
        if raw or not name:
            continue
        tag = name.lower()
        if tag == "a":
            in_link = not closing
        elif tag == "br":
            parts.append(" ")
        if tag not in _BLOCKS:
            continue
        close_block()
        if tag not in _CONTAINERS or tag in ("html", "body"):
            continue
        if closing:
            for place in range(len(stack) - 1, 0, -1):
                if containers[stack[place]].tag == tag:
                    del stack[place:]
                    break
            in_link = False
        else:
            above = containers[stack[-1]]
            step, left_out, bonus = _described(tag, attributes)
            path = f"{above.path}>{step}" if above.path else step
            containers.append(_Container(tag, stack[-1], path, left_out or above.left_out, bonus))
            stack.append(len(containers) - 1)
    parts.append(page[at:])
    close_block()
    for container, _, prose in blocks:
        while container >= 0:
            containers[container].prose += prose
            container, prose = containers[container].parent, prose * 0.9
    return containers, blocks


def scored(page: str) -> dict[str, float]:
    """The page's containers by generalised path, with their share of the best one's score."""
    containers, _ = parsed(page)
    scores: dict[str, float] = defaultdict(float)
    for container in containers:
        if container.prose > 0 and not container.left_out:
            scores[container.path] += container.prose * container.bonus
    best = max(scores.values(), default=0.0)
    return {path: score / best for path, score in scores.items()}


def extracted(page: str, paths: list[str]) -> tuple[str, str | None]:
    """The text of the containers at the first path that the page has, and that path.

    A page with none of the paths gives its own best container's text.
    """
    containers, blocks = parsed(page)
    with_text = {containers[c].path for c in range(len(containers)) if containers[c].prose > 0 and not containers[c].left_out}
    path = next((p for p in paths if p in with_text), None)
    if path is None:
        own = [c for c in containers if c.prose > 0 and not c.left_out]
        if not own:
            return "", None
        path = max(own, key=lambda c: c.prose * c.bonus).path
    inside = [False] * len(containers)
    for number, container in enumerate(containers):
        inside[number] = container.path == path or container.parent >= 0 and inside[container.parent]
    return "\n".join(text for container, text, _ in blocks if inside[container]), path


def host(url):
    """The host of an address, in lower case; empty if there is none."""
    return F.coalesce(
        F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit("")
    )


def extract(pages: DataFrame) -> DataFrame:
    """Per page its main text: page_id, url, text, path (of the containers used, null if none).

    Each page's containers are scored by the prose they hold and give their share of the page's
    best score as votes to their generalised path: tags with classes, without numbers. The votes
    are summed by host, and each page is extracted again from the first of its host's
    ``PATHS_TRIED`` best paths that holds text in it. Menus, headers, footers, sidebars, notices,
    adverts, forms, scripts, styles and comments inside are left out.

    White space inside a block becomes one space, blocks are joined by line ends in page order.
    Null or empty html gives an empty text. Pages without a host vote together. Repeated rows are
    extracted each, and vote each. No pages give no rows. Extra columns are left out.
    """
    plain = pages.select(
        F.col("page_id").cast("long"), "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host(F.col("url")).alias("host")
    )

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            votes: dict[tuple[str, str], float] = defaultdict(float)
            for name, page in zip(batch["host"], batch["html"], strict=True):
                for path, share in scored(page).items():
                    # Whole thousandths, so that sums do not depend on their order.
                    votes[name, path] += round(1000 * share)
            rows = [(name, path, int(count)) for (name, path), count in votes.items()]
            yield pd.DataFrame(rows, columns=["host", "path", "votes"])

    counted = (
        plain.select("host", "html").mapInPandas(vote, "host string, path string, votes long")
        .groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    )
    best = Window.partitionBy("host").orderBy(F.desc("votes"), F.desc(F.length("path")), "path")
    paths = written(
        counted.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= PATHS_TRIED)
        .groupBy("host").agg(F.sort_array(F.collect_list(F.struct("place", "path"))).alias("paths"))
        .select("host", F.transform("paths", lambda p: p["path"]).alias("paths")),
        "host-paths",
    )

    def reread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                extracted(page, [] if paths is None else list(paths))
                for page, paths in zip(batch["html"], batch["paths"], strict=True)
            ]
            yield pd.DataFrame(
                {
                    "page_id": batch["page_id"].astype("Int64"),
                    "url": batch["url"],
                    "text": [text for text, _ in found],
                    "path": [path for _, path in found],
                }
            )

    return (
        plain.join(paths, "host", "left")
        .select("page_id", "url", "html", "paths")
        .mapInPandas(reread, "page_id long, url string, text string, path string")
    )
