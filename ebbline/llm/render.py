"""Text of web pages as a browser would lay it out.

A tree is built from the tags, with the tags that HTML implies; what isn't displayed is left out;
the rest is rendered: blocks on lines of their own, blank lines around paragraphs, list markers and
indents, table cells in aligned columns, preformatted text as it is.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Element groups of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp".split())
HIDDEN = frozenset("audio canvas datalist head iframe noembed noframes noscript object script style template title video".split())
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 menu ol p pre table ul".split())
BLOCK = SPACED | frozenset(
    "address article aside body caption center dd details dialog div dt fieldset figcaption footer form header hgroup hr html "
    "legend li main nav optgroup option search section summary tbody tfoot thead tr".split()
)
#: A start tag ends these open elements, up to the nearest of the limits.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}), "option": ({"option"}, {"select"}),
    "optgroup": ({"option", "optgroup"}, {"select"}), "body": ({"head"}, {"html"}),
}
SCOPE = frozenset("table td th caption html button object".split())
#: The most columns and rows that a cell spans, and the depth beyond which elements
#: count as their ancestor's, as in browsers.
SPAN, ROWS, DEPTH = 1_000, 65_534, 512
#: Characters of padding that the tables of a page may add, besides four times the page's length;
#: a table beyond that (a cell of megabytes next to thousands of rows) has its cells unaligned.
ROOM = 1 << 22
_TAG = re.compile(r"<(?:!--(?:>|->|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)|(/?)([A-Za-z][^\s/>]*))", re.DOTALL)
_BETWEEN = re.compile(r"[\s/]*")
_ATTRIBUTE = re.compile(r"""([^\s>/][^\s=>/]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_DECLARED = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)", re.IGNORECASE)
_NUMBER = re.compile(r"[ \t\n\r\f]*\+?([0-9]+)")
_SPACES = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []

    def style(self, name: str) -> str:
        """The last value that the style attribute gives a property; empty without one."""
        given = [v for n, v in _DECLARED.findall(self.attributes.get("style", "")) if n.lower() == name]
        return given[-1].lower() if given else ""

    def gone(self) -> bool:
        """Not laid out, whatever its children ask for."""
        display = self.style("display")
        return self.tag in HIDDEN or display == "none" or "hidden" in self.attributes and not display

    def seen(self, parent: bool) -> bool:
        """Visibility is inherited until an element sets its own."""
        own = self.style("visibility")
        return own == "visible" if own in ("visible", "hidden", "collapse") else parent

    def span(self, name: str, most: int) -> int:
        """Columns or rows that a cell spans; 0 (rows only) means all that follow."""
        given = _NUMBER.match(self.attributes.get(name, "1"))
        digits = given[1].lstrip("0") if given else "1"
        n = most if len(digits) > 6 else int(digits or 0)
        return min(n, most) if n else most if name == "rowspan" else 1


def build(source: str) -> Node:
    """The element tree of a page; texts are plain strings among the children."""
    root = Node("html", {})
    stack = [root]

    def close(tags: set[str] | frozenset[str], limits: set[str] | frozenset[str]) -> bool:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return True
            if stack[i].tag in limits:
                break
        return False

    def text(part: str) -> None:
        if part:
            if stack[-1].tag == "head" and part.strip():
                close({"head"}, frozenset())
            stack[-1].children.append(part)

    def open_(tag: str, attributes: dict[str, str]) -> None:
        if tag in ("html", "body") and len(stack) > 1 and tag != "body":
            return
        if tag in BLOCK:
            close({"p"}, SCOPE)
            if stack[-1].tag == "head":
                stack.pop()
        if tag in IMPLIED:
            ended, limits = IMPLIED[tag]
            while close(ended | ({"tr", "td", "th"} if tag in ("tbody", "thead", "tfoot") else {"td", "th"} if tag == "tr" else set()), limits):
                pass
        if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            open_("tr", {})
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        if tag not in VOID and len(stack) < DEPTH:
            stack.append(node)

    at = 0
    while at < len(source):
        m = _TAG.search(source, at)
        if not m:
            break
        text(entities.unescape(source[at : m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        tag, attributes = m[2].lower(), {}
        while True:
            at = _BETWEEN.match(source, at).end()
            a = _ATTRIBUTE.match(source, at)
            if not a:
                at += 1  # the tag's end, or the page's
                break
            at = a.end()
            attributes.setdefault(a[1].lower(), entities.unescape(a[2] or a[3] or a[4] or ""))
        if m[1]:
            if tag == "p" and not any(n.tag == "p" for n in stack):
                stack[-1].children.append(Node("p", {}))
            elif tag not in ("html", "body"):
                close({tag}, {"table"} if tag in BLOCK - {"table"} else {"table", "td", "th"} if tag not in ("table", "td", "th", "tr") else set())
        elif tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])|\Z", re.IGNORECASE).search(source, at)
            node = Node(tag, attributes)
            if tag not in HIDDEN:
                node.children.append(entities.unescape(source[at : stop.start()]))
            stack[-1].children.append(node)
            at = source.find(">", stop.start()) + 1 or len(source)
        else:
            open_(tag, attributes)
    text(entities.unescape(source[at:]))
    return root


class Flow:
    """Lines of laid-out text: collapsed white space, indents, and margins that don't add up."""

    def __init__(self):
        self.lines: list[str] = []
        self.words: list[str] = []
        self.space, self.margin = False, 0
        self.indents: list[str] = []
        self.marker = ""

    def text(self, part: str) -> None:
        words = _SPACES.sub(" ", part)
        if words.strip(" "):
            if (self.space or words[0] == " ") and self.words:
                self.words.append(" ")
            self.words.append(words.strip(" "))
            self.space = words[-1] == " "
        else:
            self.space = True

    def line(self, text: str) -> None:
        """A finished line; the margin asked for before it comes first."""
        if self.lines:
            self.lines += [""] * self.margin
        self.margin = 0
        indent = "".join(self.indents)
        if self.marker:
            indent = indent[: -len(self.marker)] + self.marker
            self.marker = ""
        self.lines.append((indent + text).rstrip())

    def end(self, margin: int = 0) -> None:
        """End the current line; at least ``margin`` blank lines before what follows."""
        if self.words:
            self.line("".join(self.words))
        self.words, self.space = [], False
        self.margin = max(self.margin, margin)

    def newline(self) -> None:
        if self.words:
            self.end()
        elif self.lines:
            self.margin = min(self.margin + 1, 1)


class Table:
    def __init__(self):
        self.rows: list[list[tuple[int, int, list[str]]]] = []
        self.sections: set[int] = set()

    def placed(self) -> list[list[tuple[int, int, list[str]]]]:
        """First and last column (exclusive) of each cell; cells from rows above keep theirs free."""
        held: dict[int, int] = {}
        out = []
        for r, row in enumerate(self.rows):
            if r in self.sections:
                held = {}
            column, cells = 0, []
            for wide, high, cell in row:
                while held.get(column, -1) >= r:
                    column += 1
                cells.append((column, column + wide, cell))
                if high > 1:
                    held.update(dict.fromkeys(range(column, column + wide), r + high - 1))
                column += wide
            out.append(cells)
        # Columns in which no cell begins need no room.
        starts = sorted({first for cells in out for first, _, _ in cells})
        return [[(bisect_left(starts, a), bisect_left(starts, b), cell) for a, b, cell in cells] for cells in out]

    def lines(self, room: list[int]) -> list[str]:
        """Rows with cells padded to the width of their columns, as far as the page has room for padding."""
        rows = self.placed()
        n = max((b for row in rows for _, b, _ in row), default=0)
        widths = [0] * n
        for row in rows:
            for first, end, cell in row:
                if end == first + 1:
                    widths[first] = max(widths[first], max(map(len, cell), default=0))
        starts = [0]
        for w in widths:
            starts.append(starts[-1] + w + 2)
        # What follows the last cell that holds a line isn't padded.
        depths = [max((len(cell) for _, _, cell in row), default=0) for row in rows]
        padded = sum(d * max((starts[a] for a, _, cell in row if cell), default=0) for row, d in zip(rows, depths))
        aligned = padded <= room[0]
        room[0] -= padded if aligned else 0
        out = []
        for row, depth in zip(rows, depths):
            for k in range(depth):
                line = ""
                for first, _, cell in row:
                    if k < len(cell):
                        apart = aligned and (not line or len(line) + 2 <= starts[first])
                        line = (line.ljust(starts[first]) if apart else line + "  " if line else "") + cell[k]
                out.append(line.rstrip())
        return out


def render(source: str | None) -> str:
    """The visible text of a page; empty for null or empty source."""
    if not source:
        return ""
    flows, tables, lists = [Flow()], [], []
    work: list[tuple[Node | str, bool]] = [(build(source), False)]
    pre, seen, room = 0, [True], [ROOM + 4 * len(source)]
    while work:
        node, leaving = work.pop()
        flow = flows[-1]
        if isinstance(node, str):
            if not seen[-1]:
                continue
            if not pre:
                flow.text(node)
            else:
                parts = node.split("\n")
                for i, part in enumerate(parts):
                    flow.words.append(part.rstrip("\r"))
                    if i < len(parts) - 1:
                        flow.line("".join(flow.words))
                        flow.words = []
            continue
        tag = node.tag
        if not leaving:
            if node.gone() or tag == "input" and node.attributes.get("type", "").lower() == "hidden":
                continue
            if tag == "br":
                flow.newline()
                continue
            seen.append(node.seen(seen[-1]))
            work.append((node, True))
            work += [(c, False) for c in reversed(node.children)]
        else:
            seen.pop()
        spaced = tag in SPACED and not (tag in ("ul", "ol", "menu") and len(lists) > leaving)
        if tag in BLOCK:
            flow.end(int(spaced))
        if tag == "table":
            if leaving:
                done = tables.pop().lines(room)
                for text in done:
                    flow.line(text)
                flow.end(1)
            else:
                tables.append(Table())
        elif tag == "tr" and tables and not leaving:
            tables[-1].rows.append([])
        elif tag in ("tbody", "thead", "tfoot") and tables:
            tables[-1].sections.add(len(tables[-1].rows))
        elif tag in ("td", "th", "caption") and tables:
            if leaving:
                flow.end()
                done = flows.pop().lines
                if tag == "caption":
                    tables[-1].rows.append([(SPAN, 1, done)] if done else [])
                else:
                    if not tables[-1].rows:
                        tables[-1].rows.append([])
                    tables[-1].rows[-1].append((node.span("colspan", SPAN), node.span("rowspan", ROWS), done))
            else:
                flows.append(Flow())
        elif tag in ("ul", "ol", "menu"):
            if leaving:
                lists.pop()
            else:
                first = node.attributes.get("start", "1")
                lists.append([tag, int(first) if re.fullmatch(r"-?[0-9]{1,6}", first) else 1])
        elif tag == "li":
            if leaving:
                flow.indents.pop()
                flow.marker = ""
            else:
                ordered = lists and lists[-1][0] == "ol"
                marker = f"{lists[-1][1]}. " if ordered else "- "
                if ordered:
                    lists[-1][1] += 1
                flow.indents.append(" " * len(marker))
                flow.marker = marker if seen[-1] else ""
        elif tag in ("dd", "blockquote"):
            if leaving:
                flow.indents.pop()
            else:
                flow.indents.append("  ")
        elif tag == "pre":
            pre += -1 if leaving else 1
    flows[0].end()
    return "\n".join(flows[0].lines).strip("\n")


def rendered(source: Column) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([render(p) for p in pages], dtype=object)

    return F.pandas_udf(run, "string")(source)


def extract(pages: DataFrame) -> DataFrame:
    """page_id and text of every row of ``pages``.

    Null and empty pages have empty text; what ``display`` takes away is left out with all it holds, what
    ``visibility`` hides only until an element inside is visible again; tables stay aligned up to
    ``ROOM`` characters of padding a page; broken markup is repaired as far as tags are implied;
    repeated rows come out alike; other columns are ignored; an empty table gives no rows.
    """
    return pages.select("page_id", rendered(F.col("html")).alias("text"))
