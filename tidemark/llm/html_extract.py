"""Main text of web pages by tree scoring.

A page is parsed into a tree without scripts, styles, comments and elements that by name, role or class are not
part of an article. Every paragraph gives points for its length and its commas to its ancestors, less the higher
they are; a container's points are discounted by the share of its text that lies in links. The container with
most points and those of its siblings that hold text of their own are kept, and their blocks are returned in
page order.

An article's own `header` is part of it, formulas are text, and a `label` is text inside a paragraph and a form's
part elsewhere. Fallback content that browsers do not show (`object`, `canvas`, `audio`, `video`, the annotations of
a formula) is markup; drawings, menus and dialogs are removed.

Null and empty pages give an empty text, and so do pages without text outside of the removed elements. A page
without any scored container gives all blocks that were not removed. Unclosed and misnested tags, cut-off pages
and unknown character references are read as browsers read them, near enough. Pages of any length and any depth of
nesting are read whole, in time that grows with their length: the stack of open elements is indexed by tag. Each row is
read on its own, so repeated rows, null ids and extra columns do no harm.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # a quote counts behind an equals sign only, and only if it is closed
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")

# Fixed values of HTML: elements by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot"
    " th thead tr ul".split()
)
CLOSES_P = BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_SAME_CLOSES = {
    "li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
    "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",)),
    "tbody": ("tbody thead tfoot tr td th", ("table",)), "tfoot": ("tbody thead tfoot tr td th", ("table",)),
}

# Elements that never are part of an article.
REMOVED = frozenset(
    "head script style noscript template title nav aside footer form button select input textarea fieldset"
    " iframe object embed svg canvas annotation annotation-xml audio video dialog menu xmp noembed noframes".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
_UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|adbox|banner|breadcrumbs?|combx|comments?|comment\w*|disqus|community|cookies?|consent|gdpr"
    r"|notice|notification|alert|popup|modal|overlay|newsletter|subscribe|signup|login|footer|foot|header|masthead|topbar|menu\w*|nav"
    r"|navbar|navigation|pager|pagination|promo\w*|related|recommended|remark|replies|reply|respond|discussion|rss|share|sharing|shoutbox"
    r"|sidebar|side|skyscraper|social|sponsor\w*|tags?|tool|tools|toolbar|widget\w*|outbrain|taboola|skip\w*)(?:$|[\s_-])",
    re.I,
)
_LIKELY = re.compile(r"(?:^|[\s_-])(?:article|articlebody|body|content|entry|hentry|main|page|post|story|text|blog)(?:$|[\s_-])", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

PARAGRAPHS = frozenset("p pre td th blockquote li dd figcaption".split()) | HEADINGS
_TAG_POINTS = {"article": 25.0, "main": 20.0, "section": 3.0, "div": 5.0, "td": 3.0, "pre": 3.0, "blockquote": 3.0, "ul": -3.0, "ol": -3.0, "dl": -3.0}


class Block(NamedTuple):
    owner: int  # the node that holds the text
    text: str
    linked: int  # code points inside links


class Page:
    """Nodes of a page in order (parent before child) and its text blocks."""

    def __init__(self) -> None:
        self.tags: list[str] = ["#root"]
        self.parents: list[int] = [-1]
        self.points: list[float] = [0.0]
        self.blocks: list[Block] = []


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): references.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source)}


class _Open:
    """The stack of open elements, with the depths of each tag, so that no question walks the stack."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = [("#root", 0)]  # tag, node of the nearest block
        self.depths: dict[str, list[int]] = {}

    def push(self, tag: str, node: int) -> None:
        self.depths.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, node))

    def pop(self) -> str:
        tag, _ = self.stack.pop()
        self.depths[tag].pop()
        return tag

    def last(self, tags: Iterable[str]) -> int:
        """Depth of the innermost open element of these tags, 0 if none is open."""
        deepest = 0
        for tag in tags:
            depths = self.depths.get(tag)
            if depths and depths[-1] > deepest:
                deepest = depths[-1]
        return deepest


def _removed(tag: str, attributes: dict[str, str], opened: _Open) -> bool:
    if tag in REMOVED:
        return True
    if (tag == "header" and not opened.last(("article", "main"))) or (tag == "label" and not opened.last(PARAGRAPHS)):
        return True
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or _HIDDEN.search(attributes.get("style", "")):
        return True
    if attributes.get("role", "").lower() in ROLES:
        return True
    if tag in ("html", "body", "article", "main", "header", "a", "p") or tag in HEADINGS:
        return False
    names = _CAMEL.sub("-", f"{attributes.get('class', '')} {attributes.get('id', '')}")
    return bool(_UNLIKELY.search(names)) and not _LIKELY.search(names)


def parse(source: str) -> Page:
    """Read a page; removed elements leave no nodes and no text."""
    page = Page()
    opened = _Open()
    stack = opened.stack
    text: list[str] = []
    linked = 0
    removing = 0  # depth of the stack at which a removed element is open

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join(references.unescape("".join(text)).split())
            if joined:
                page.blocks.append(Block(stack[-1][1], joined, min(linked, len(joined))))
            text.clear()
        linked = 0

    def add(data: str) -> None:
        nonlocal linked
        if not removing:
            text.append(data)
            if opened.depths.get("a"):
                linked += len(data.strip())

    def close_to(depth: int) -> None:
        """Close open elements down to a stack depth."""
        nonlocal removing
        if not removing and any(stack[i][0] in BLOCK for i in range(depth, len(stack))):
            flush()
        while len(stack) > depth:
            opened.pop()
        if removing and len(stack) < removing:
            removing = 0

    def close_open(tags: Iterable[str], borders: Iterable[str]) -> None:
        depth = opened.last(tags)
        if depth > opened.last(borders):
            close_to(depth)

    at, end = 0, len(source)
    while at < end:
        found = _TOKEN.search(source, at)
        if not found:
            add(source[at:])
            break
        if found.start() > at:
            add(source[at : found.start()])
        at = max(found.end(), at + 1)
        if not found[2]:
            continue
        closing, tag = bool(found[1]), found[2].lower()
        if closing:
            if tag == "br":
                add(" ")
            elif tag in VOID:
                continue
            else:
                close_open((tag,), () if tag in BLOCK else ("td", "th", "table"))
            continue
        if tag in RAW:  # its content is no markup; a script may hold tags in strings
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
            at = close.end() if close else end
            continue
        if tag == "br":
            add(" ")
            continue
        if tag == "hr" and not removing:
            flush()
        if tag in VOID:
            continue
        if tag in CLOSES_P:
            close_open(("p",), ("button", "td", "th", "table", "object", "caption"))
        if tag in HEADINGS and stack[-1][0] in HEADINGS:
            close_to(len(stack) - 1)
        if tag in _SAME_CLOSES:
            tags, borders = _SAME_CLOSES[tag]
            close_open(tags.split(), borders)
        if tag == "body":
            close_open(("head",), ())
        attributes = _attributes(found[3] or "") if not removing else {}
        node = stack[-1][1]
        if not removing:
            if _removed(tag, attributes, opened):
                if tag in BLOCK:
                    flush()
                opened.push(tag, node)
                removing = len(stack)
                continue
            if tag in BLOCK:
                flush()
                page.tags.append(tag)
                page.parents.append(node)
                names = _CAMEL.sub("-", f"{attributes.get('class', '')} {attributes.get('id', '')}")
                page.points.append(_TAG_POINTS.get(tag, 0.0) + (25.0 if _LIKELY.search(names) else 0.0))
                node = len(page.tags) - 1
        opened.push(tag, node)
    flush()
    return page


def chosen(page: Page) -> set[int]:
    """The kept container and its kept siblings."""
    n = len(page.tags)
    length, linked, gained, scored = [0] * n, [0] * n, [0.0] * n, [False] * n
    far = [0.0] * n  # points for all ancestors from here on
    for block in page.blocks:
        size = len(block.text)
        points = 1 + block.text.count(",") + block.text.count("，") + min(size / 100, 3.0) if size >= 25 else 0.0
        node = block.owner
        length[node] += size
        linked[node] += block.linked
        # a paragraph scores for what contains it; text that lies directly in a container scores for that
        level, above = 0, page.parents[node] if page.tags[node] in PARAGRAPHS else node
        while above >= 0 and points and level < 4:
            gained[above] += points / (1, 2, 6, 9)[level]
            scored[above] = True
            above, level = page.parents[above], level + 1
        if above >= 0 and points:
            far[above] += points / 12
    for node in range(n - 1, 0, -1):  # sums over subtrees
        far[page.parents[node]] += far[node]
        length[page.parents[node]] += length[node]
        linked[page.parents[node]] += linked[node]

    gained = [near + beyond for near, beyond in zip(gained, far)]

    def density(node: int) -> float:
        return linked[node] / length[node] if length[node] else 0.0

    value = [(gained[i] + page.points[i]) * (1 - density(i)) if scored[i] else 0.0 for i in range(n)]
    candidates = [i for i in range(1, n) if scored[i] and page.tags[i] not in ("html", "p")]
    if not candidates:
        return {0}
    best = max(candidates, key=lambda i: (value[i], -i))
    # an only child says no more than its parent that holds other scored text
    above = page.parents[best]
    while above > 0 and page.tags[above] not in ("html", "body") and gained[above] > gained[best] * 0.9:
        best, above = above, page.parents[above]
    while page.tags[best] in ("ul", "ol", "dl", "table", "tbody", "tr", "td", "blockquote", "pre", "li") and page.parents[best] > 0 and page.tags[page.parents[best]] not in ("html", "body"):
        best = page.parents[best]
    kept, least = {best}, max(10.0, value[best] * 0.2)
    own: dict[int, int] = {}
    for block in page.blocks:
        own[block.owner] = own.get(block.owner, 0) + len(block.text)
    for node in range(1, n):
        if page.parents[node] != page.parents[best] or node == best:
            continue
        if value[node] >= least:
            kept.add(node)
        elif page.tags[node] == "p" and density(node) < 0.25 and length[node] > 80:
            kept.add(node)
        elif page.tags[node] in HEADINGS and density(node) < 0.25 and page.tags[best] != "article":
            kept.add(node)
    return kept


def main_text(source: str | None) -> str:
    """Main text of one page, a line per block."""
    if not source:
        return ""
    page = parse(source)
    kept = chosen(page)
    inside = [False] * len(page.tags)
    for node in range(len(page.tags)):
        inside[node] = node in kept or (node > 0 and inside[page.parents[node]])
    return "\n".join(block.text for block in page.blocks if inside[block.owner])


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """`page_id`, `url`, `text` and `n_chars` of every page."""
    names = ["page_id", "url", "text", "n_chars"]
    rows = pages.select("page_id", "url", F.col(html).alias("html"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:2]) + ", text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(value.as_py()) for value in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, schema)
