"""Main text of web pages, with content containers agreed on by all pages of a host.

Each page names the deepest container that holds all of its good text (blocks outside boilerplate that aren't mostly links), or
the article or main around it, by its generalised path: tags and class names from the root, digits masked. Spark counts these
votes per host. The second pass takes the text below the winning path of the page's host; a page without such a container, or
with good text outside of it, keeps its own. Only a page too short to tell leaves text out because its host says so.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.common import prepare, store

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object select noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr img".split())
CONTAINERS = frozenset("html body main article section div td th tr tbody table center".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
    "main menu nav ol p pre search section table ul".split())
#: An opening tag closes an open element of these names, but not beyond the listed scopes.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Boilerplate by element, role, and words of class names and ids.
BAD_TAGS = frozenset("nav footer aside form button dialog menu input label fieldset".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
BAD_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus "
    "footer gdpr masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion related "
    "replies reply respond share sharing sidebar signup social sponsor sponsored subscribe toolbar topbar widget".split())
ARTICLE_WORDS = frozenset("article content entry main post story".split())
#: Pages with less good text can't tell their container.
SHORT = 200

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Page:
    """Containers (parent, path) and text blocks (container, text, good) of a page, in page order."""

    parents: list[int] = field(default_factory=lambda: [-1])
    paths: list[tuple[int, str]] = field(default_factory=lambda: [(0, "")])  # (number of the parent's, own step)
    blocks: list[tuple[int, str, bool]] = field(default_factory=list)

    def path(self, node: int) -> str:
        steps = []
        while node > 0:
            node, step = self.paths[node]
            steps.append(step)
        return ">".join(reversed(steps))


def _attributes(rest: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)} if "=" in rest or "hidden" in rest else {}


def _words(value: str) -> set[str]:
    return set(_WORD.findall(_CAMEL.sub(" ", value).lower()))


def _is_bad(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    if name in BAD_TAGS:
        return True
    if name == "header" and not in_article:
        return not _words(attributes.get("class", "")) & ARTICLE_WORDS
    if not attributes:
        return False
    if attributes.get("role", "").lower() in BAD_ROLES or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", "").lower()):
        return True
    if name in ("html", "body", "main", "article"):
        return False
    words = _words(attributes.get("class", "")) | _words(attributes.get("id", ""))
    return bool(words & BAD_WORDS) or ("header" in words and not words & ARTICLE_WORDS and name not in HEADINGS)


def _step(name: str, attributes: dict[str, str]) -> str:
    classes = sorted(set(re.sub(r"\d+", "#", attributes.get("class", "")).split()))
    return ".".join([name, *classes])


def parse(html: str) -> Page:
    """The page's containers and blocks. Boilerplate, scripts, styles and comments leave no text; nothing raises."""
    page = Page()
    stack: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]  # name, container, within boilerplate, within an article
    text: list[str] = []
    linked = 0
    links = 0

    def end_block() -> None:
        nonlocal linked
        if text:
            whole = " ".join(unescape("".join(text)).split())
            if whole:
                page.blocks.append((stack[-1][1], whole, 2 * linked <= len(whole)))
            text.clear()
        linked = 0

    def pop_to(depth: int) -> None:
        nonlocal links
        while len(stack) > depth:
            name = stack[-1][0]
            if name not in INLINE:
                end_block()
            elif name == "a":
                links -= 1
            stack.pop()

    at = 0
    lower = None
    while True:
        tag = _TOKEN.search(html, at)
        piece = html[at:tag.start()] if tag else html[at:]
        if piece and not stack[-1][2]:
            text.append(piece)
            if links:
                linked += len(piece)
        if tag is None:
            break
        at = tag.end()
        name = (tag["name"] or tag["name2"] or "").lower()
        if not name:
            continue
        if tag["close"] or tag["close2"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    pop_to(depth)
                    break
                if stack[depth][0] in ("td", "th", "table") and name in INLINE:
                    break
            else:
                if name in ("br", "p"):
                    text.append(" ")
            continue
        rest = tag["rest"] if tag["name"] else tag["rest2"]
        if name in RAW:
            if not rest.endswith("/") or name in ("script", "style", "title", "textarea"):
                lower = lower if lower is not None else html.lower()
                end = lower.find("</" + name, at) if len(lower) == len(html) else -1
                if end < 0:
                    found = re.compile("</" + name, re.I).search(html, at)
                    end = found.start() if found else len(html)
                close = html.find(">", end)
                at = len(html) if close < 0 else close + 1
            text.append(" ")
            continue
        if name in VOID:
            if name in ("hr",):
                end_block()
            elif name == "br":
                text.append(" ")
            continue
        if name in CLOSES_P:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == "p":
                    pop_to(depth)
                    break
                if stack[depth][0] not in INLINE:
                    break
        elif name in IMPLIED:
            closed, scope = IMPLIED[name]
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in closed:
                    pop_to(depth)
                    break
                if stack[depth][0] in scope:
                    break
        if name not in INLINE:
            end_block()
        _, container, bad, article = stack[-1]
        attributes = _attributes(rest)
        bad = bad or _is_bad(name, attributes, article)
        if name in CONTAINERS:
            page.parents.append(container)
            page.paths.append((container, _step(name, attributes)))
            container = len(page.parents) - 1
        if name == "a":
            links += 1
        if not (rest.endswith("/") and name in INLINE):
            stack.append((name, container, bad, article or name in ("article", "main")))
        elif name == "a":
            links -= 1
    pop_to(1)
    end_block()
    return page


def vote(page: Page) -> tuple[int, int]:
    """(container, weight): the deepest one with all of the page's good text, or the article, else main, around it; and that
    text's length up to 2000."""
    own = _good(page)
    total = own[0]
    best = 0
    for node in range(1, len(own)):  # parents come first: of nested ones the last is the deepest
        if own[node] == total and total and page.parents[node] == best:
            best = node
    for name in ("article", "main"):
        node = best
        while node > 0 and page.paths[node][1].split(".")[0] != name:
            node = page.parents[node]
        if node > 0:
            return node, min(total, 2000)
    return best, min(total, 2000)


def _good(page: Page) -> list[int]:
    """Length of the good text below each container."""
    own = [0] * len(page.parents)
    for container, text, good in page.blocks:
        own[container] += len(text) if good else 0
    for node in range(len(own) - 1, 0, -1):
        own[page.parents[node]] += own[node]
    return own


def text_of(page: Page, path: str | None) -> str:
    """The blocks below all containers with the path, or below the page's own vote where there is none or good text lies outside.

    A page with less good text than ``SHORT``, and less than half of it below the path, is too short to tell: its host decides.
    """
    chosen = [False] * len(page.parents)
    if path:
        wanted = path.split(">")
        depth = [0] * len(page.parents)  # steps matched, -1 once one differs
        for node in range(1, len(page.parents)):
            parent = depth[page.parents[node]]
            depth[node] = parent + 1 if 0 <= parent < len(wanted) and page.paths[node][1] == wanted[parent] else -1
            chosen[node] = depth[node] == len(wanted)
    own = _good(page)
    below = sum(own[node] for node in range(len(own)) if chosen[node])
    if not any(chosen) or below < own[0] and (own[0] >= SHORT or 2 * below >= own[0]):
        chosen[vote(page)[0]] = True
    for node in range(1, len(chosen)):
        chosen[node] = chosen[node] or chosen[page.parents[node]]
    return "\n\n".join(text for container, text, _ in page.blocks if chosen[container])


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^/?#]*://([^/?#]*)", 1))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path): for each host the path with the most votes; ties go to the smaller path."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes: dict[tuple[str, str], int] = {}
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                page = parse(html or "")
                node, weight = vote(page)
                if node and weight:
                    key = host, page.path(node)
                    votes[key] = votes.get(key, 0) + weight
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in votes], pa.string()), pa.array([p for _, p in votes], pa.string()), pa.array(list(votes.values()), pa.int64())],
                ["host", "path", "votes"])

    counted = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string")).mapInArrow(run, "host string, path string, votes bigint")
    counts = counted.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    return counts.groupBy("host").agg(F.min(F.struct((-F.col("votes")).alias("votes"), "path")).alias("best")).select("host", F.col("best.path").alias("path"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every row.

    A null or empty html has no text; a null url has the empty host, whose pages vote together. Repeated rows come out as often as
    they came in. The winning paths are one short row a host; the planner broadcasts them if they are small by their own
    size, and otherwise joins by host with the hot ones split. Only the three columns are read.
    """
    prepare(pages.sparkSession)
    paths = store(host_paths(pages, url_col, html_col), "host-paths")
    rows = pages.select(F.col(id_col), F.col(url_col), F.col(html_col).cast("string").alias("__html"), host_of(F.col(url_col)).alias("__host"))
    joined = rows.join(paths.select(F.col("host").alias("__voted"), F.col("path").alias("__path")), F.col("__host") == F.col("__voted"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text_of(parse(html or ""), path) for html, path in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [id_col, url_col, "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return joined.select(id_col, url_col, "__html", "__path").mapInArrow(
        run, f"{id_col} {kinds[id_col]}, {url_col} {kinds[url_col]}, text string, n_chars bigint")
