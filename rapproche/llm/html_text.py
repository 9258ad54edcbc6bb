"""Visible text of HTML pages, laid out in blocks.

A small tree builder reads the tags in order: void elements hold nothing, an element whose end tag may be left out is
closed by the next one that implies its end, and unknown end tags are ignored. The renderer walks the tree without
recursion. Invisible elements (head, script, style, template, ``hidden``, ``display:none``, ``visibility:hidden``,
``aria-hidden``) are left out; white space collapses but in ``pre``; blocks stand on lines of their own, paragraphs and
headings with an empty line between; list items are indented by depth, with a dash or their number; table cells are
padded to the width of their column, which all rows of the table share.

Null and empty pages give empty text. Rows are independent, so repeated and null ids change nothing. Broken markup gives
the text that the tree builder makes of it. Other columns are passed on; a
column with the result's name is replaced.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(
    "head script style template noscript title meta link iframe object svg math canvas audio video datalist".split()
)
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr".split())
BLOCKS = PARAGRAPHS | frozenset(
    "html body div section article header footer main nav aside address form fieldset details summary dialog figcaption "
    "li dt dd tr caption thead tbody tfoot option legend".split()
)
#: A start tag ends the open elements on the right, up to the nearest of the elements after them.
ENDS = {
    "li": ("li", "ul ol"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th caption", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "thead": ("thead tbody tfoot tr td th caption", "table"),
    "tbody": ("thead tbody tfoot tr td th caption", "table"),
    "tfoot": ("thead tbody tfoot tr td th caption", "table"),
    "option": ("option", "select"),
    "body": ("head", "html"),
}
CLOSES = {tag: (frozenset(ends.split()), frozenset(stop.split())) for tag, (ends, stop) in ENDS.items()}
#: These blocks end an open paragraph.
END_PARAGRAPH = BLOCKS - {"html", "body", "tr", "caption", "thead", "tbody", "tfoot", "option", "legend"}
SCOPES = frozenset("table td th caption html button".split())
IN_HEAD = frozenset("meta link title style script base noscript template head html".split())

HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
SPACES = re.compile(r"[ \t\n\r\f\v]+")
ROWS = 200


class Node:
    __slots__ = ("tag", "seen", "start", "items")

    def __init__(self, tag: str, seen: bool = True, start: int = 1):
        self.tag, self.seen, self.start = tag, seen, start
        self.items: list[Node | str] = []


class TreeBuilder(HTMLParser):
    """Builds the tree of a page. ``open`` holds the elements that are not closed yet, ``count`` how many of a tag."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.open = [self.root]
        self.count: dict[str, int] = {}

    def _close_last(self) -> None:
        self.count[self.open.pop().tag] -= 1

    def _close_to(self, tags: frozenset[str], stop: frozenset[str]) -> None:
        """Closes the outermost open element of ``tags`` above the nearest of ``stop``."""
        if not any(self.count.get(t) for t in tags):
            return
        last = None
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in stop:
                break
            if self.open[i].tag in tags:
                last = i
        while last is not None and len(self.open) > last:
            self._close_last()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "html":
            return
        if tag not in IN_HEAD and self.count.get("head"):
            self._close_to(frozenset(["head"]), frozenset())
        if tag in END_PARAGRAPH:
            self._close_to(frozenset(["p"]), SCOPES)
        if tag in CLOSES:
            self._close_to(*CLOSES[tag])
        found = dict(attrs)
        seen = (
            tag not in UNSEEN
            and "hidden" not in found
            and (found.get("aria-hidden") or "").lower() != "true"
            and not HIDDEN.search(found.get("style") or "")
            and not (tag == "input" and (found.get("type") or "").lower() == "hidden")
        )
        start = found.get("start") or "" if tag == "ol" else ""
        node = Node(tag, seen, int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1)
        if tag == "img" and found.get("alt"):
            node.items.append(found["alt"] or "")
        self.open[-1].items.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.count[tag] = self.count.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash of a tag that is not void means nothing

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.open[-1].items.append(Node("br"))
        elif self.count.get(tag):
            while self.open[-1].tag != tag:
                self._close_last()
            self._close_last()

    def handle_data(self, data: str) -> None:
        if self.count.get("head") and data.strip() and self.open[-1].tag == "head":
            self._close_last()
        self.open[-1].items.append(data)


def width(text: str) -> int:
    """Columns that a line takes: wide signs two, combining ones none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Lines:
    """Text under way: finished lines, the line being written, and the blank lines owed before the next one."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.now: list[str] = []
        self.gap = self.owed = False  # a blank is due within the line; an empty line is due before the next one

    def text(self, data: str, indent: str) -> None:
        parts = SPACES.split(data)
        for i, part in enumerate(parts):
            if i:
                self.gap = True
            if part:
                self.put((" " if self.gap and self.now else "") + part, indent)
                self.gap = False

    def put(self, data: str, indent: str) -> None:
        if not self.now:
            if self.owed and self.lines:
                self.lines.append("")
            self.owed = False
            self.now.append(indent)
        self.now.append(data)

    def end(self, paragraph: bool = False) -> None:
        if self.now:
            self.lines.append("".join(self.now).rstrip(" "))
            self.now = []
        self.gap = False
        self.owed |= paragraph

    def add(self, lines: list[str], indent: str) -> None:
        self.end()
        for line in lines:
            if line:
                self.put(line, indent)
                self.end()
            else:
                self.owed = True


def table_lines(rows: list[list[list[str]]]) -> list[str]:
    """Rows of cells, each a list of lines, padded so that columns stand in line."""
    widths: list[int] = []
    for row in rows:
        widths += [0] * (len(row) - len(widths))
        for i, cell in enumerate(row):
            widths[i] = max([widths[i], *map(width, cell)])
    out = []
    for row in rows:
        for k in range(max((len(cell) for cell in row), default=0)):
            parts = [cell[k] if k < len(cell) else "" for cell in row]
            padded = [p + " " * (widths[i] - width(p)) for i, p in enumerate(parts[:-1])] + parts[-1:]
            out.append("  ".join(padded).rstrip(" "))
    return out


def render(root: Node) -> str:
    """The visible text of a tree. Cells are laid out on their own and put in place when their table ends."""
    out = Lines()
    stack: list[tuple] = [("open", root, False)]
    outs: list[Lines] = []  # what is being written outside the cell
    tables: list[list[list[list[str]]]] = []
    lists: list[list] = []  # [is ordered, next number]
    marker = ""

    def indent() -> str:
        nonlocal marker
        deep = "  " * max(0, len(lists) - 1)
        if marker:
            found, marker = deep + marker, ""
            return found
        return deep + ("  " if lists else "")

    while stack:
        what, node, pre = stack.pop()
        if isinstance(node, str):
            if pre:
                for i, line in enumerate(node.split("\n")):
                    if i:
                        if not out.now:
                            out.put("", "")
                        out.end()
                    if line:
                        out.put(line, "" if out.now else indent())
            elif SPACES.sub("", node):
                out.text(node, "" if out.now else indent())
            else:
                out.gap = True
            continue
        tag = node.tag
        if what == "open":
            if not node.seen:
                continue
            if tag == "br":
                if not out.now and out.lines:
                    out.owed = True
                out.end()
                continue
            if tag in BLOCKS:
                out.end(tag in PARAGRAPHS and not (tag in ("ul", "ol") and lists))
            if tag in ("ul", "ol"):
                lists.append([tag == "ol", node.start])
            elif tag == "li" and lists:
                marker = f"{lists[-1][1]}. " if lists[-1][0] else "- "
                lists[-1][1] += 1
            elif tag == "table":
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("td", "th") and tables:
                outs.append(out)
                out = Lines()
                lists.append([False, 1])  # a cell starts at the margin, its lists count from there
                lists, saved = [], lists
                node.items.append(Node("#cell"))
                node.items[-1].items = [saved]
            stack.append(("close", node, pre))
            stack += [("open", item, pre or tag == "pre") for item in reversed(node.items) if not (isinstance(item, Node) and item.tag == "#cell")]
        else:
            if tag in ("td", "th") and tables and isinstance(node.items[-1], Node) and node.items[-1].tag == "#cell":
                lists = node.items.pop().items[0][:-1]
                out.end()
                if not tables[-1]:
                    tables[-1].append([])
                tables[-1][-1].append(out.lines)
                out = outs.pop()
            elif tag == "table":
                out.add(table_lines(tables.pop()), indent())
            elif tag in ("ul", "ol"):
                lists.pop()
            elif tag == "li":
                marker = ""
            if tag in BLOCKS:
                out.end(tag in PARAGRAPHS and not (tag in ("ul", "ol") and lists))
    out.end()
    return "\n".join(out.lines)


def page_text(html: str | None) -> str:
    builder = TreeBuilder()
    builder.feed(html or "")
    builder.close()
    return render(builder.root)


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the visible text of each page in column ``text``."""
    pages = pages.drop(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                column = part.column(part.schema.get_field_index(html))
                texts = pa.array([page_text(x.as_py()) for x in column], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=[*part.schema.names, text])

    return pages.mapInArrow(run, T.StructType([*pages.schema.fields, T.StructField(text, T.StringType())]))


def digests(pages: DataFrame) -> DataFrame:
    """Each page's text, its number of lines and signs."""
    return extract(pages.select("page_id", "url", "html")).select(
        "page_id", "url", "text",
        F.size(F.split("text", "\n")).cast("long").alias("n_lines"),
        F.length("text").cast("long").alias("n_chars"),
    )
