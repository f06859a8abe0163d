"""Main text of web pages by consensus of their hosts.

Each page scores its containers by the text they hold that is neither link nor
boilerplate, less what they add beside their main part: links, and text of
smaller containers of another kind. Boilerplate costs nothing, as it is left out
anyway. The page votes for the generalised path of the best container: tags and
classes from the root, with digits made equal and ids left out. Votes are summed
up per host in Spark. Every page is then read again and its text taken from the
path that won on its host; from its own best container where the path is missing
or holds less than a third as much.

Time and memory grow with the length of a page, however deep it is nested.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paymart.llm.shared import broadcast_if_small, staged

TOKEN = re.compile(
    r"""<!--(?:.*?-->|.*)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)(?:>|\Z)""", re.S
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}  # hold text, not markup
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
CONTAINERS = {"html", "body", "main", "article", "section", "div", "td", "center", "blockquote"}
BLOCKS = CONTAINERS - {"td"} | {
    "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "pre", "table", "caption", "tr", "thead", "tbody",
    "tfoot", "figure", "figcaption", "address", "hr", "header", "footer", "nav", "aside", "form", "fieldset", "details", "summary", "head",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# An opening tag ends what is open of the tags named with it.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIMITS = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

PLAIN_BOILERPLATE = RAW | {
    "head", "nav", "footer", "aside", "form", "button", "select", "noscript", "template", "svg", "canvas", "object", "video", "audio",
    "menu", "dialog", "label", "datalist",
}
# Names of classes and ids. A name in several parts counts if all of them are here or among the neutral ones.
NAMED_BOILERPLATE = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "sponsor", "sponsored", "promo", "promotion",
    "nav", "navbar", "navigation", "menu", "submenu", "breadcrumb", "breadcrumbs", "sidebar", "aside", "rail", "footer", "header", "masthead",
    "cookie", "cookies", "consent", "gdpr", "notice", "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe",
    "subscription", "signup", "login", "social", "share", "sharing", "widget", "toolbar", "pagination", "pager", "hidden", "copyright",
    "disclaimer", "search", "form", "tags",
}
# The same, and never the article itself, however long.
OTHERS_TEXT = {
    "comment", "comments", "commentlist", "respond", "replies", "disqus", "related", "recommended", "recommendations",
}
NEUTRAL = {
    "", "site", "page", "main", "top", "bottom", "left", "right", "upper", "lower", "primary", "secondary", "global", "wrapper", "wrap",
    "container", "inner", "outer", "box", "bar", "block", "area", "section", "list", "item", "items", "links", "link", "slot", "unit",
    "panel", "buttons", "button", "icons", "posts", "post", "articles", "stories", "reader", "user", "mobile", "desktop", "sticky", "fixed",
    "text", "content", "body", "view", "thread", "google", "and", "us", "the", "row", "column", "col",
}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
VOTES = "host string, path string, weight double"


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    path: int  # number of the path of the container it is or stands in
    container: bool
    boilerplate: bool  # by tag, role or being hidden; later also by name, or because a node above it is
    named: int  # 1 by its name, 2 by a name of others' text
    link: bool
    heading_only: bool  # in a header: only headings count
    in_article: bool
    whole: bool = False  # holds a main heading or an article
    prose: int = 0  # text below that is not boilerplate by tag; link text left out
    text: int = 0  # the same without what is boilerplate by name
    links: int = 0  # kept link text
    beside: int = 0  # text of smaller containers of another kind than that


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    pieces: list[tuple[int, str | None]] = field(default_factory=list)  # node and text; None ends a block
    steps: list[tuple[int, str]] = field(default_factory=list)  # of each path: the path above, and its last tag and classes
    numbers: dict[tuple[int, str], int] = field(default_factory=dict)

    def path_number(self, above: int, step: str) -> int:
        """One number for each different path."""
        key = (above, step)
        if key not in self.numbers:
            self.numbers[key] = len(self.steps)
            self.steps.append(key)
        return self.numbers[key]

    def path_text(self, number: int) -> str:
        out = []
        while number > 0:
            number, step = self.steps[number]
            out.append(step)
        return "".join(f">{step}" for step in reversed(out))

    def find_path(self, text: str) -> int | None:
        """The number of a path, if this page has it."""
        number = 0
        for step in text.split(">")[1:]:
            number = self.numbers.get((number, step))
            if number is None:
                return None
        return number


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def _named(attributes: dict[str, str]) -> tuple[int, bool]:
    """Whether a class or id names boilerplate (1) or others' text (2), and whether it is a header."""
    kind, header = 0, False
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        parts = set(re.split(r"[^a-z]+", name))
        known = parts & (NAMED_BOILERPLATE | OTHERS_TEXT)
        if known and parts <= NAMED_BOILERPLATE | OTHERS_TEXT | NEUTRAL:
            if known == {"header"}:
                header = True
            else:
                kind = max(kind, 2 if known & OTHERS_TEXT else 1)
    return kind, header


def parse(text: str) -> Page:
    """Nodes and pieces of text in page order, whatever the markup; open tags are looked up, never walked through."""
    page = Page([Node("", -1, 0, True, False, 0, False, False, False)], steps=[(0, "")])
    nodes, pieces, stack = page.nodes, page.pieces, [0]
    opened: dict[str, list[int]] = {}  # where in the stack each tag is open
    at, n = 0, len(text)

    def add(raw: str) -> None:
        if raw:
            pieces.append((stack[-1], entities.unescape(raw) if "&" in raw else raw))

    def innermost(tags: set[str]) -> int:
        return max((opened[t][-1] for t in tags if opened.get(t)), default=0)

    def close(tags: set[str], limits: set[str]) -> None:
        depth = innermost(tags)
        if depth <= innermost(limits - tags):
            return
        block = False
        while len(stack) > depth:
            tag = nodes[stack.pop()].tag
            opened[tag].pop()
            block = block or tag in BLOCKS
        if block:
            pieces.append((stack[-1], None))

    while at < n:
        start = text.find("<", at)
        if start < 0:
            add(text[at:])
            break
        token = TOKEN.match(text, start)
        if token is None:  # a plain <
            add(text[at : start + 1])
            at = start + 1
            continue
        add(text[at:start])
        at = token.end()
        tag = (token[2] or "").lower()
        if not tag:
            continue
        if token[1]:
            if tag in BLOCKS:
                pieces.append((stack[-1], None))
            close({tag}, {"body", "html"} if tag not in ("body", "html") else set())
            continue
        if tag == "br":
            pieces.append((stack[-1], " "))
            continue
        if tag in BLOCKS:
            close({"p"}, CONTAINERS | {"table", "li", "ul", "ol"})
            pieces.append((stack[-1], None))
        if tag in ENDS:
            close(ENDS[tag], LIMITS[tag])
        if tag in ("td", "th"):
            pieces.append((stack[-1], " "))
        if tag in VOID:
            continue
        above = nodes[stack[-1]]
        found = _attributes(token[3]) if token[3] else {}
        named, header = _named(found) if found and tag not in ("html", "body", "main", "article") else (0, False)
        header = header or tag == "header"
        boilerplate = tag in PLAIN_BOILERPLATE or (header and not above.in_article) or found.get("role", "").lower() in ROLES
        boilerplate = boilerplate or "hidden" in found or found.get("aria-hidden") == "true"
        boilerplate = boilerplate or bool(found and re.search(r"display\s*:\s*none", found.get("style", "")))
        path = above.path
        if tag in CONTAINERS:
            classes = sorted({re.sub(r"\d+", "#", c.lower()).replace(">", "_") for c in found.get("class", "").split()})
            path = page.path_number(path, ".".join([tag, *classes]))
        heading_only = (above.heading_only or (header and above.in_article)) and tag not in HEADINGS
        in_article = above.in_article or tag in ("article", "main")
        link = above.link or tag == "a"
        nodes.append(Node(tag, stack[-1], path, tag in CONTAINERS, boilerplate, named, link, heading_only, in_article))
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(text, at)
            at = end.end() if end else n
            continue
        if not token[3].rstrip().endswith("/") or tag in BLOCKS:
            opened.setdefault(tag, []).append(len(stack))
            stack.append(len(nodes) - 1)
    return page


def _counts(page: Page) -> None:
    """What is boilerplate, and the text and links of every node with what is below it."""
    nodes = page.nodes
    for node in nodes[1:]:
        node.boilerplate = node.boilerplate or nodes[node.parent].boilerplate
    sizes = [(i, len(text) - text.count(" ")) for i, text in page.pieces if text is not None]
    for i, size in sizes:
        if not nodes[i].boilerplate and not nodes[i].link and not nodes[i].heading_only:
            nodes[i].prose += size
    for node in reversed(nodes[1:]):
        above = nodes[node.parent]
        above.prose += node.prose
        above.whole = above.whole or node.whole or (node.tag in ("h1", "article", "main") and not node.boilerplate)
    for node in nodes[1:]:
        # A name does not make the article itself boilerplate.
        article = node.named == 1 and node.whole and 2 * node.prose > nodes[0].prose
        node.boilerplate = node.boilerplate or nodes[node.parent].boilerplate or (node.named > 0 and not article)
    for i, size in sizes:
        here = nodes[i]
        if here.boilerplate or here.heading_only:
            continue
        if here.link:
            here.links += size
        else:
            here.text += size
    # The text of the containers of each kind right below a container; those with the main heading count apart.
    kinds: list[dict[tuple[int, bool], int] | None] = [None] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        node, mine = nodes[i], kinds[i] or {}
        kinds[i] = None
        if node.container and mine:
            most = max(mine.values())
            node.beside += sum(size for (_, whole), size in mine.items() if 2 * size < most and not whole)
        if i == 0:
            break
        above = nodes[node.parent]
        above.text += node.text
        above.links += node.links
        if node.tag not in ("article", "main"):
            above.beside += node.beside
        if node.container:
            mine = {(node.path, node.whole): node.text} if node.text and node.tag != "section" else {}
        theirs = kinds[node.parent] or {}
        if len(mine) > len(theirs):
            mine, theirs = theirs, mine
        for kind, size in mine.items():
            theirs[kind] = theirs.get(kind, 0) + size
        kinds[node.parent] = theirs


def best_container(page: Page) -> int:
    """The node with most text less links and less what stands beside its main part; of equal ones the deepest.

    Articles are taken as a whole and count a quarter more.
    """
    best, top = 0, (0.0, 0)
    for i, node in enumerate(page.nodes):
        if not node.container or node.boilerplate:
            continue
        article = node.tag in ("article", "main")
        score = (node.text * 1.25 if article else node.text - 2 * node.beside) - node.links
        if (score, i) >= top:
            best, top = i, (score, i)
    return best


def text_of(page: Page, chosen: set[int]) -> str:
    """Blocks below the chosen nodes, one to a line."""
    inside = [False] * len(page.nodes)
    for i, node in enumerate(page.nodes):
        inside[i] = i in chosen or (node.parent >= 0 and inside[node.parent])
    blocks, parts = [], []

    def flush() -> None:
        block = " ".join("".join(parts).split())
        if block:
            blocks.append(block)
        parts.clear()

    for i, text in page.pieces:
        node = page.nodes[i]
        if text is None:
            flush()
        elif inside[i] and not node.boilerplate and not node.heading_only:
            parts.append(text)
    flush()
    return "\n".join(blocks)


def extract(text: str, path: str | None = None) -> str:
    """The main text of a page; ``path`` is what its host voted for."""
    page = parse(text)
    _counts(page)
    own = best_container(page)
    number = None if path is None else page.find_path(path)
    chosen = {i for i, node in enumerate(page.nodes) if node.container and node.path == number and not node.boilerplate}
    outermost = [i for i in chosen if page.nodes[page.nodes[i].parent].path != number]
    if not chosen or 3 * sum(page.nodes[i].text for i in outermost) < page.nodes[own].text:
        chosen = {own}
    return text_of(page, chosen)


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and www; empty where there is none."""
    host = F.regexp_extract(F.lower(url), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?(?:www\.)?([^/?#:]*)", 1)
    return F.coalesce(host, F.lit(""))


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths, weights = [], []
        for text in batch.column(1).to_pylist():
            page = parse(text)
            _counts(page)
            node = page.nodes[best_container(page)]
            paths.append(page.path_text(node.path))
            weights.append(node.text / (1.0 + node.text + node.links + node.beside))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.string()), pa.array(weights)], ["host", "path", "weight"])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        page_id, url, text, path = batch.columns
        out = [extract(t, p) for t, p in zip(text.to_pylist(), path.to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [page_id, url, path, pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
            ["page_id", "url", "path", "text", "n_chars"],
        )


def main_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, path, text, n_chars.

    text has one block per line and is empty where there is none; n_chars are
    its code points; path is what won on the host. A null html is empty. Pages
    without a host vote together. Rows with null or repeated ids are rows like
    others; extra columns are not read, whatever their names. Of paths with equal
    votes the last in order wins. Pages of any length and depth are read whole.
    An empty table gives no rows.
    """
    pages = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
        host_of(F.col("url").cast("string")).alias("host"),
    )
    votes = pages.select("host", "html").mapInArrow(_vote, VOTES)
    votes = votes.groupBy("host", "path").agg(F.sum(F.round(F.col("weight") * 1e6).cast("long")).alias("votes"))
    winners = votes.groupBy("host").agg(F.max_by("path", F.struct("votes", "path")).alias("path"))
    winners = broadcast_if_small(staged(winners, "host-paths"), row_bytes=256)
    chosen = pages.join(winners, "host", "left").select("page_id", "url", "html", "path")
    return chosen.mapInArrow(_read, "page_id long, url string, path string, text string, n_chars long")
