"""Layout-aware text of HTML pages: a tree builder with implied tags, visibility rules, and a renderer.

The renderer keeps block spacing (a blank line around paragraphs, headings, lists and tables, a line
break around other blocks), list markers with hanging indents, preformatted text, and tables as
aligned columns with spans.  Neither step recurses, so nesting may be of any depth, and both take time in proportion to
the page, however malformed.  For that: where a tag's quotes are never closed, it and all later tags end at their
first ``>``; what follows a ``<`` without any ``>`` is text; indents grow no further below DEPTH levels; tables below
TABLES levels are laid out as blocks; a table that aligned columns would make far larger than its text has its cells two
spaces apart; rowspans count in the first COLUMNS columns.  No text is dropped by these rules.

Visibility: hidden attributes and ``display:none`` hide a subtree, ``visibility`` is inherited and may be turned back on,
a dialog shows if it is open, of svg only its text elements show, of math all but annotations.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stage import frugal

#: Levels of indents, levels of tables, columns in which rowspans are followed.
DEPTH, TABLES, COLUMNS = 40, 12, 1000
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_PLAIN = re.compile(r"""[^>"']*+""")
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]*))?""", re.S)
_SPACES = re.compile(r"[ \t\n\r\f]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
RCDATA = frozenset("title textarea".split())
HIDDEN = frozenset("head title script style template noscript iframe noembed noframes datalist object audio video canvas annotation annotation-xml area base link meta param source track rp".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr menu fieldset listing xmp".split())
LINES = frozenset("html body div section article aside header footer nav main address form li dt dd tr td th thead tbody tfoot caption figcaption details summary legend center hgroup search optgroup option".split())
BLOCKS = PARAGRAPHS | LINES
#: An open <p> ends before these.
ENDS_P = BLOCKS - frozenset("html body li dt dd tr td th thead tbody tfoot caption legend optgroup option".split()) | {"dt", "dd", "li"}
#: A start tag implies the end of the nearest open one of these, not looking beyond the given containers.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "tr": (("tr", "caption", "colgroup"), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "thead": (("thead", "tbody", "tfoot", "caption", "colgroup"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "caption", "colgroup"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "caption", "colgroup"), ("table",)),
    "rt": (("rt", "rp"), ("ruby",)),
    "rp": (("rt", "rp"), ("ruby",)),
}
_SCOPE = frozenset("table td th caption html template object".split())
_PRE = frozenset("pre listing xmp textarea plaintext".split())
_IN_HEAD = frozenset("base link meta title style script noscript template".split())


class Node:
    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []


def _attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in _ATTR.findall(source):
        if value[:1] in ("'", '"'):
            value = value[1:-1]
        out.setdefault(name.lower(), html.unescape(value))
    return out


def _tokens(source: str):
    """("text" | "cdata" | "open" | "close", text or tag name, attributes' source, end) of a page; raw elements are skipped by sending the position to go on from."""
    at, n, heed, more = 0, len(source), True, True
    while at < n:
        start = source.find("<", at)
        if start < 0 or not more:
            yield "text", source[at:], "", n
            return
        if start > at:
            yield "text", source[at:start], "", start
        if source.startswith("<!--", start):
            end = source.find("-->", start + 4)
            at = n if end < 0 else end + 3
            continue
        if source.startswith("<![CDATA[", start):
            end = source.find("]]>", start + 9)
            at = n if end < 0 else end + 3
            yield "cdata", source[start + 9 : n if end < 0 else end], "", at
            continue
        if source[start + 1 : start + 2] in ("!", "?"):
            end = source.find(">", start)
            at = n if end < 0 else end + 1
            continue
        m = _NAME.match(source, start)
        if not m:
            yield "text", "<", "", start + 1
            at = start + 1
            continue
        end = m.end()
        while heed:
            end = _PLAIN.match(source, end).end()
            if end == n:
                heed = False
            elif source[end] == ">":
                break
            else:
                end = source.find(source[end], end + 1) + 1
                heed = end > 0
        if not heed:
            end = source.find(">", m.end())
            if end < 0:
                more, at = False, start
                continue
        at = (yield "close" if m[1] else "open", m[2].lower(), source[m.end() : end], end + 1) or end + 1


class Open:
    """The open elements, with the places of each name, so that nothing walks along them."""

    def __init__(self, *nodes: Node):
        self.nodes: list[Node] = []
        self.places: dict[str, list[int]] = {}
        self.scopes: list[int] = []
        self.blocks: list[int] = []
        for node in nodes:
            self.push(node)
        self.least = len(nodes)

    def push(self, node: Node) -> None:
        at = len(self.nodes)
        self.nodes.append(node)
        self.places.setdefault(node.tag, []).append(at)
        if node.tag in _SCOPE:
            self.scopes.append(at)
        if node.tag in BLOCKS:
            self.blocks.append(at)

    def last(self, *tags: str) -> int:
        """The place of the innermost element of these names, -1 if there is none."""
        found = max((p[-1] for p in map(self.places.get, tags) if p), default=-1)
        return found if found >= self.least else -1

    def cut(self, at: int) -> None:
        """Close the element at a place and all inside it."""
        while len(self.nodes) > at:
            tag = self.nodes.pop().tag
            self.places[tag].pop()
            if tag in _SCOPE:
                self.scopes.pop()
            if tag in BLOCKS:
                self.blocks.pop()

    def close(self, tags, stop) -> None:
        """Close the innermost of these names, unless one of stop (None: any scope) is further in."""
        at = self.last(*tags)
        barrier = (self.scopes[-1] if self.scopes else -1) if stop is None else self.last(*stop)
        if at > barrier:
            self.cut(at)


def parse(source: str) -> Node:
    """The tree under an html node; missing html, head, body, tbody and tr tags and missing end tags are implied."""
    root = Node("html")
    head, body = Node("head"), Node("body")
    root.children = [head, body]
    stack = Open(root, body)
    in_head = False
    tokens, goto, n = _tokens(source), None, len(source)
    while True:
        try:
            kind, tag, attributes, at = tokens.send(goto)
        except StopIteration:
            return root
        goto = None
        top = stack.nodes[-1]
        if kind == "cdata":
            top.children.append(tag)
            continue
        if kind == "text":
            if in_head and not tag.isspace():
                in_head = False
                stack = Open(root, body)
                top = body
            top.children.append(html.unescape(tag) if "&" in tag else tag)
            continue
        if kind == "close":
            if tag in ("html", "body"):
                continue
            if tag == "head":
                in_head, stack = False, Open(root, body)
            elif tag == "br":
                top.children.append(Node("br"))
            elif tag == "p" and stack.last("p") < 0:
                top.children.append(Node("p"))
            else:
                found = stack.last(tag)
                barrier = -1
                if tag not in _SCOPE and tag not in ("tr", "thead", "tbody", "tfoot"):
                    barrier = stack.scopes[-1] if stack.scopes else -1
                if tag in ("span", "label") and stack.blocks:
                    barrier = max(barrier, stack.blocks[-1])
                if found > barrier:
                    stack.cut(found)
            continue
        attrs = _attributes(attributes) if attributes else {}
        if tag == "html":
            root.attrs = attrs | root.attrs
            continue
        if tag == "head":
            in_head, stack = True, Open(root, head)
            continue
        if tag == "body":
            body.attrs = attrs | body.attrs
            in_head, stack = False, Open(root, body)
            continue
        if in_head and tag not in _IN_HEAD:
            in_head, stack = False, Open(root, body)
        if tag in ENDS_P:
            stack.close(("p",), None)
        if tag in IMPLIED:
            stack.close(*IMPLIED[tag])
            if tag in ("td", "th") and stack.nodes[-1].tag in ("table", "tbody", "thead", "tfoot"):
                row = Node("tr")
                stack.nodes[-1].children.append(row)
                stack.push(row)
        node = Node(tag, attrs)
        stack.nodes[-1].children.append(node)
        if tag in RAW or tag in RCDATA:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.I).search(source, at)
            text = source[at : end.start() if end else n]
            node.children.append(html.unescape(text) if tag in RCDATA else text)
            goto = end.end() if end else n
        elif tag == "plaintext":
            node.children.append(source[at:])
            goto = n
        elif tag not in VOID and not (attributes.rstrip().endswith("/") and tag in ("svg", "math")):
            stack.push(node)


def visible(node: Node) -> bool:
    """Whether an element's subtree takes part at all; see also _visibility."""
    if node.tag in HIDDEN:
        return False
    attrs = node.attrs
    if node.tag == "dialog" and "open" not in attrs:
        return False
    if not attrs:
        return True
    if "hidden" in attrs or (node.tag == "input" and attrs.get("type", "").lower() == "hidden"):
        return False
    style = attrs.get("style")
    return not (style and "display:none" in _SPACES.sub("", style.lower()))


def _visibility(node: Node, shown: bool) -> bool:
    """Whether an element's own text shows, by what it inherits."""
    if node.tag == "svg":
        return False
    if node.tag in ("text", "foreignobject"):
        shown = True
    style = node.attrs.get("style")
    if style:
        style = _SPACES.sub("", style.lower())
        at = style.rfind("visibility:")
        if at >= 0:
            return style.startswith("visible", at + 11)
    return shown


def width(text: str) -> int:
    """Columns that a text takes; wide East Asian characters take two, combining marks none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Flow:
    """Lines of one column of text."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.open = self.space = False
        self.gap = 0
        self.prefix = ""  # of lines inside the levels whose first prefix was used
        self.used: list[int] = []  # the prefix's length outside each of these levels
        self.fresh: list[tuple[str, str]] = []  # first and later prefix of the levels inside them

    def indent(self, first: str, later: str) -> None:
        self.fresh.append((first, later))

    def dedent(self) -> None:
        if self.fresh:
            self.fresh.pop()
        elif self.used:
            self.prefix = self.prefix[: self.used.pop()]

    def _begin(self) -> None:
        if self.lines and self.gap > 1:
            self.lines.append("")
        self.gap = 0
        self.line = [self.prefix, *[first for first, _ in self.fresh]]
        for _, later in self.fresh:
            self.used.append(len(self.prefix))
            if len(self.used) <= DEPTH:
                self.prefix += later
        self.fresh.clear()
        self.open, self.space = True, False

    def end_line(self) -> None:
        if self.open:
            self.lines.append("".join(self.line).rstrip())
            self.open = self.space = False

    def block(self, margin: int) -> None:
        self.end_line()
        if self.lines:
            self.gap = max(self.gap, margin)

    def text(self, text: str) -> None:
        words = _SPACES.split(text)
        if len(words) == 1 and not words[0]:
            return
        for k, word in enumerate(words):
            if k:
                self.space = self.open
            if word:
                if not self.open:
                    self._begin()
                if self.space:
                    self.line.append(" ")
                    self.space = False
                self.line.append(word)

    def line_break(self) -> None:
        if not self.open:
            self._begin()
        self.end_line()

    def raw(self, text: str) -> None:
        for k, part in enumerate(text.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
            if k:
                self.line_break()
            if part:
                if not self.open:
                    self._begin()
                self.line.append(part.expandtabs(8))

    def rows(self, lines: list[str]) -> None:
        """Lines that are laid out already."""
        for line in lines:
            self._begin()
            self.line.append(line)
            self.end_line()

    def result(self) -> list[str]:
        self.end_line()
        return self.lines


def _number(value: str | None, default: int, most: int = 1000) -> int:
    try:
        return max(0, min(int(value), most))
    except (TypeError, ValueError):
        return default


class Grid:
    """Cells of a table; spans are taken into account when columns are aligned."""

    def __init__(self):
        self.caption: list[str] = []
        self.rows: list[list[tuple[int, int, list[str]]]] = []
        self.busy: dict[int, int] = {}  # the last row that a rowspan takes in a column

    def row(self) -> None:
        self.rows.append([])

    def cell(self, lines: list[str], attrs: dict[str, str]) -> None:
        if not self.rows:
            self.row()
        own, now = self.rows[-1], len(self.rows)
        at = own[-1][0] + own[-1][1] if own else 0
        while self.busy.get(at, 0) >= now:
            at += 1
        across, down = max(1, _number(attrs.get("colspan"), 1)), _number(attrs.get("rowspan"), 1, 65534) or 65534
        if down > 1:
            for c in range(at, min(at + across, COLUMNS)):
                self.busy[c] = now + down - 1
        own.append((at, across, lines))

    def lines(self) -> list[str]:
        used = sorted({at for row in self.rows for at, _, lines in row if lines})
        place = {c: k for k, c in enumerate(used)}
        widths = [0] * len(used)
        for row in self.rows:
            for at, across, lines in row:
                if lines and across == 1:
                    widths[place[at]] = max(widths[place[at]], *map(width, lines))
        for row in self.rows:
            for at, across, lines in row:
                if lines and across > 1:
                    first, end = place[at], bisect_left(used, at + across)
                    lack = max(map(width, lines)) - sum(widths[first:end]) - 2 * (end - first - 1)
                    if lack > 0:
                        widths[end - 1] += lack
        starts = [0]
        for w in widths:
            starts.append(starts[-1] + w + 2)
        text = sum(len(line) for row in self.rows for _, _, lines in row for line in lines)
        aligned = sum(starts[place[at]] for row in self.rows for at, _, lines in row[-1:] if lines for _ in lines)
        wide = aligned > 65536 + 16 * text
        out = list(self.caption)
        for row in self.rows:
            full = [(starts[place[at]], lines) for at, _, lines in row if lines]
            for k in range(max((len(lines) for _, lines in full), default=0)):
                line, taken = [], 0
                full = [x for x in full if len(x[1]) > k]
                for start, lines in full:
                    if lines[k]:
                        line.append((" " * 2 * bool(line) if wide else " " * (start - taken)) + lines[k])
                        taken = start + width(lines[k])
                out.append("".join(line).rstrip())
        return out


def render(root: Node) -> str:
    """The visible text of a tree."""
    flow, flows, grids, lists = Flow(), [], [], []
    pre, shown = 0, True
    work: list = [(root, None)]
    while work:
        node, before = work.pop()  # before: whether text showed outside the element that ends
        if isinstance(node, str):
            if not shown:
                continue
            if grids and not flows[-1][1]:
                if not node.isspace():  # text between cells comes before the table
                    flows[-1][0].text(node)
            elif pre:
                flow.raw(node)
            else:
                flow.text(node)
            continue
        tag = node.tag
        if before is None:
            if not visible(node):
                continue
            if tag == "br":
                if shown:
                    flow.line_break()
                continue
            if tag == "wbr":
                continue
            if tag == "input":
                if shown and node.attrs.get("type", "text").lower() in ("submit", "button", "reset", "text", "search", "email", "url", "tel", "number"):
                    flow.text(node.attrs.get("value", ""))
                continue
            work.append((node, shown))
            shown = _visibility(node, shown)
            if tag == "table":
                flow.block(2)
                if len(grids) < TABLES:
                    grids.append(Grid())
                    flows.append((flow, False))
                    flow = Flow()
                    node.attrs = node.attrs | {"": "grid"}
            elif grids and not flows[-1][1] and tag == "tr":
                grids[-1].row()
            elif grids and not flows[-1][1] and tag in ("td", "th", "caption"):
                flows.append((flow, True))
                flow = Flow()
                node.attrs = node.attrs | {"": "cell"}
            elif tag in ("ul", "ol", "menu"):
                flow.block(1 if lists else 2)
                lists.append([tag, _number(node.attrs.get("start"), 1, 10**9)])
            elif tag == "li":
                flow.block(1)
                marker = "- "
                if lists and lists[-1][0] == "ol":
                    lists[-1][1] = _number(node.attrs.get("value"), lists[-1][1], 10**9)
                    marker = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                flow.indent(marker, " " * len(marker))
            elif tag == "dd":
                flow.block(1)
                flow.indent("    ", "    ")
            elif tag == "blockquote":
                flow.block(2)
                flow.indent("> ", "> ")
            elif tag in BLOCKS:
                flow.block(2 if tag in PARAGRAPHS else 1)
            if tag in _PRE:
                pre += 1
                if node.children and isinstance(node.children[0], str):
                    node.children[0] = re.sub(r"\A\r?\n", "", node.children[0])
            for child in reversed(node.children):
                work.append((child, None))
            continue
        shown = before
        role = node.attrs.get("")
        if tag == "table":
            if role:
                grid = grids.pop()
                inside = flow.result()
                flow, _ = flows.pop()
                if inside:
                    flow.rows(inside)
                flow.block(2)
                flow.rows(grid.lines())
            flow.block(2)
        elif role == "cell":
            lines = flow.result()
            flow, _ = flows.pop()
            if tag == "caption":
                grids[-1].caption += lines
            else:
                grids[-1].cell(lines, node.attrs)
        elif tag in ("ul", "ol", "menu"):
            lists.pop()
            flow.block(1 if lists else 2)
        elif tag in ("li", "dd", "blockquote"):
            flow.block(2 if tag == "blockquote" else 1)
            flow.dedent()
        elif tag in BLOCKS:
            flow.block(2 if tag in PARAGRAPHS else 1)
        if tag in _PRE:
            pre -= 1
    return "\n".join(flow.result()).strip("\n")


def visible_text(source: str | None) -> str:
    return render(parse(source)) if source else ""


def extracted(pages: DataFrame, html_col: str = "html", text_col: str = "extracted_text", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The kept columns and the visible text of each row.

    Null and empty pages have the empty text; repeated rows are kept; other columns are ignored, and a
    page may be of any size (one is held at a time beside its batch).
    """
    rows = pages.select(*keep, F.col(html_col).cast("string").alias("__html"))
    schema = pages.select(*keep).schema.add(text_col, "string")

    def task(batches):
        for batch in batches:
            texts = [visible_text(x.as_py()) for x in batch.column(len(keep))]
            yield pa.record_batch([*batch.columns[: len(keep)], pa.array(texts, pa.string())], names=[*keep, text_col])

    return rows.mapInArrow(frugal(task), schema)
