"""Visible text of web pages, laid out as a browser would: blocks, lists and aligned table cells.

A tree is built from the tags, with the elements that HTML implies: paragraphs end where a block begins, items
end at the next item, cells make rows and rows make tables. Elements that are not displayed are left
out with all they hold. The tree is then laid out: white space collapses, blocks stand on lines of their
own, paragraphs and headings keep a blank line, list items get markers and indents, and the cells of a
table column share a width.

Elements may be nested to any depth: the tree is laid out with a stack of its own. What is added to the text is bounded, so that
the output stays in proportion to the page: lines are indented by ``MOST_INDENT`` blanks at most, whatever the depth of
lists, and a cell is moved to its column by ``MOST_PAD`` blanks at most. Beyond that it stands two blanks behind the cell
to its left.

Edge cases: a null or empty page gives an empty text; pages are read whole, whatever their length; broken
markup never fails: tags that do not end are text or dropped as in browsers, stray end tags are ignored; a row span reaches
the first ``MOST_COLUMNS`` columns; repeated rows give equal results, one each; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from loanmeter.llm.arrow_text import mapped

MOST_INDENT = 80
MOST_PAD = 120
MOST_COLUMNS = 10_000

# Element groups of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
ESCAPABLE_RAW = frozenset("textarea title".split())
IN_HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
NOT_SHOWN = frozenset("head title script style template noscript noframes noembed iframe datalist audio video canvas object".split())
INLINE_FORMAT = frozenset("a abbr acronym b big bdi bdo cite code data dfn em font i ins kbd mark nobr s samp small strike strong sub sup time tt u var".split())
MARGIN = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dir dl pre blockquote figure fieldset form listing xmp".split())
BLOCK = MARGIN | frozenset(
    "html body address article aside center details dialog div dd dt figcaption footer header hgroup hr legend li main nav "
    "optgroup option search section summary table caption thead tbody tfoot tr td th".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr li listing main menu nav ol p pre search section summary table ul xmp".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SECTIONS = frozenset("thead tbody tfoot".split())
LISTS = frozenset("ul ol menu dir".split())
SCOPE = frozenset("html table td th caption button template".split())
# Element: those of its kind that it ends, and where the search for them stops.
ENDS_BEFORE = {
    "li": (frozenset({"li"}), LISTS | SCOPE),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"}) | SCOPE),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"}) | SCOPE),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"})),
    "optgroup": (frozenset({"optgroup", "option"}), frozenset({"select"})),
    "tr": (frozenset({"tr", "caption"}), frozenset({"table"})),
    "td": (frozenset({"td", "th", "caption"}), frozenset({"table", "tr"})),
    "th": (frozenset({"td", "th", "caption"}), frozenset({"table", "tr"})),
    **{s: (SECTIONS | {"caption"}, frozenset({"table"})) for s in SECTIONS},
    "caption": (frozenset({"caption"}), frozenset({"table"})),
}

_TAG = re.compile(
    r"""<(/?)([a-zA-Z][^\s/>]*+)((?>[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=|["'])*+)>""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_LOOKED_AT = re.compile(r"hidden|style|span|start|open|reversed|value", re.I)
_WHITE = re.compile(r"[ \t\n\f\r]+")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)", re.I)


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str] | None = None):
        self.tag, self.attributes, self.children = tag, attributes or {}, []


def _attributes(source: str) -> dict[str, str]:
    if not source or not _LOOKED_AT.search(source):
        return {}
    out: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), unescape(double or single or bare))
    return out


class Builder:
    """Open elements while a page is read; ``root`` is the finished tree."""

    def __init__(self):
        self.root = Node("html")
        self.open = [self.root]
        self._count: Counter[str] = Counter()

    def text(self, data: str) -> None:
        if self.open[-1].tag == "head" and not data.isspace():
            self._pop()
        self.open[-1].children.append(data)

    def start(self, tag: str, source: str) -> Node | None:
        if tag in ("html", "body"):
            self._close({"head"}, frozenset())
            hidden = _attributes(source)
            self.root.attributes = {**hidden, **self.root.attributes}
            return None
        if tag not in IN_HEAD and self.open[-1].tag == "head":
            self._pop()
        attributes = _attributes(source)
        if tag in INLINE_FORMAT and not attributes:
            return None  # it has no effect on layout
        if tag in ENDS_PARAGRAPH:
            self._close({"p"}, SCOPE)
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self._pop()
        if tag in ENDS_BEFORE:
            self._close(*ENDS_BEFORE[tag])
        self._imply_rows(tag)
        if tag not in VOID:
            return self._push(tag, attributes)
        node = Node(tag, attributes)
        self.open[-1].children.append(node)
        return node

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", "")
        elif tag not in ("html", "body"):
            table_part = tag in ("table", "tr", "caption") or tag in SECTIONS
            stop = frozenset({"html"}) if tag == "table" else frozenset({"table"}) if table_part or tag in ("td", "th") else SCOPE
            wanted = HEADINGS if tag in HEADINGS else frozenset({tag})
            # An inline element does not end the blocks opened inside it.
            if not self._close(wanted, stop if tag in BLOCK else stop | BLOCK) and tag == "p":
                self.start("p", "")
                self._pop()

    def _close(self, wanted, stop) -> bool:
        if not any(self._count[tag] for tag in wanted):
            return False
        for at in range(len(self.open) - 1, 0, -1):
            tag = self.open[at].tag
            if tag in wanted:
                while len(self.open) > at:
                    self._pop()
                return True
            if tag in stop:
                return False
        return False

    def _imply_rows(self, tag: str) -> None:
        if tag in ("td", "th"):
            if self.open[-1].tag in SECTIONS or self.open[-1].tag == "table":
                self._imply_rows("tr")
                self._push("tr")
        elif tag == "tr" and self.open[-1].tag == "table":
            self._push("tbody")

    def _push(self, tag: str, attributes: dict[str, str] | None = None) -> Node:
        node = Node(tag, attributes)
        self.open[-1].children.append(node)
        self.open.append(node)
        self._count[tag] += 1
        return node

    def _pop(self) -> None:
        self._count[self.open.pop().tag] -= 1


def parse(html: str) -> Node:
    builder, at, n = Builder(), 0, len(html)
    while at < n:
        mark = html.find("<", at)
        if mark < 0:
            builder.text(unescape(html[at:]))
            break
        found = _TAG.match(html, mark)
        if found:
            if mark > at:
                builder.text(unescape(html[at:mark]))
            at, tag = found.end(), found[2].lower()
            if found[1]:
                builder.end(tag)
                continue
            node = builder.start(tag, found[3])
            if tag == "plaintext":
                builder.text(html[at:])
                break
            if tag in RAW or tag in ESCAPABLE_RAW:
                close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
                stop = close.start() if close else n
                if node is not None and tag == "textarea":
                    node.children.append(unescape(html[at:stop]).removeprefix("\n"))
                elif node is not None and tag == "xmp":
                    node.children.append(html[at:stop])
                at = stop
            continue
        following = html[mark + 1 : mark + 2]
        if html.startswith("<!--", mark):
            stop = html.find("-->", mark + 2 if html.startswith("<!-->", mark) else mark + 4)
            skip = stop + 3 if stop >= 0 else n
        elif following in ("!", "?") or html.startswith("</", mark) and html[mark + 2 : mark + 3] != "":
            stop = html.find(">", mark)
            skip = stop + 1 if stop >= 0 else n
        elif following.isascii() and following.isalpha():
            skip = n  # a tag that never ends
        else:
            # A lone sign is text.
            builder.text(unescape(html[at : mark + 1]))
            at = mark + 1
            continue
        if mark > at:
            builder.text(unescape(html[at:mark]))
        at = skip
    return builder.root


class Flow:
    """Lines as they are laid out."""

    def __init__(self):
        self.lines: list[str] = []
        self._now: list[str] = []
        self._space = False
        self._margin = 0
        self._prefix: list[list] = []
        self._shown: list[list] = []
        """Those of the prefixes that are not empty."""
        self._width = 0

    def text(self, data: str) -> None:
        words = _WHITE.sub(" ", data)
        if not words:
            return
        if words[0] == " ":
            self._space = bool(self._now)
            words = words[1:]
        if not words:
            return
        if self._space:
            self._now.append(" ")
        self._space = words[-1] == " "
        self._now.append(words[:-1] if self._space else words)

    def exact(self, data: str) -> None:
        for i, line in enumerate(data.expandtabs().split("\n")):
            if i:
                self.line_break()
            if line:
                self._now.append(line)

    def line_break(self) -> None:
        self._emit("".join(self._now))
        self._now, self._space = [], False

    def block(self, margin: int) -> None:
        """End the line; the next one stands ``margin`` blank lines below at least."""
        if self._now:
            self.line_break()
        self._space = False
        self._margin = max(self._margin, margin)

    def whole_lines(self, lines: list[str]) -> None:
        self.block(0)
        for line in lines:
            self._emit(line)

    def indent(self, first: str, rest: str) -> None:
        """``first`` stands before the next line, ``rest`` before those that follow, up to ``MOST_INDENT`` in all."""
        if self._width + len(rest) > MOST_INDENT:
            rest = ""
            first = first.lstrip(" ")
        self._width += len(rest)
        entry = [first, rest, bool(first.strip(" "))]
        self._prefix.append(entry)
        if first or rest:
            self._shown.append(entry)

    def outdent(self) -> None:
        self.block(0)
        first, rest, marked = self._prefix[-1]
        if marked and first != rest:  # an item without content still has its marker
            self._emit("")
        entry = self._prefix.pop()
        self._width -= len(rest)
        if self._shown and self._shown[-1] is entry:
            self._shown.pop()

    def _emit(self, line: str) -> None:
        if self.lines:
            self.lines += [""] * self._margin
        self._margin = 0
        before = "".join(p[0] for p in self._shown)
        for p in self._shown:
            p[0] = p[1]
        if "" in (p[0] for p in self._shown):
            self._shown = [p for p in self._shown if p[0]]
        self.lines.append((before + line).replace("\xa0", " ").rstrip())


def _number(value: str | None, default: int, most: int) -> int:
    digits = (value or "").strip()
    return min(int(digits), most) if digits.isascii() and digits.isdigit() and len(digits) < 10 else default


def _seen(node: Node, seen: bool) -> bool | None:
    """Whether text in the element is visible; None if it has no box at all."""
    if node.tag in NOT_SHOWN or node.tag == "dialog" and "open" not in node.attributes:
        return None
    if node.attributes:
        style = node.attributes.get("style", "")
        if "hidden" in node.attributes or _NO_DISPLAY.search(style):
            return None
        stated = _VISIBILITY.search(style)
        if stated:
            return stated[1].lower() == "visible"
    return seen


def _done(task):
    """The result of a generator that yields the generators it waits for; they stand on a stack, not on Python's."""
    stack, value = [task], None
    while stack:
        try:
            task = stack[-1].send(value)
        except StopIteration as end:
            stack.pop()
            value = end.value
        else:
            stack.append(task)
            value = None
    return value


def _lay_out(node: Node, flow: Flow, seen: bool, exact: bool, depth: int):
    """Lay out what is in an element. To be run by ``_done``."""
    count = _number(node.attributes.get("start"), 1, 10**9) if node.tag == "ol" else 0
    for child in node.children:
        if isinstance(child, str):
            if seen:
                (flow.exact if exact else flow.text)(child)
            continue
        tag, shown = child.tag, _seen(child, seen)
        if shown is None:
            continue
        if tag == "br":
            flow.line_break()
        elif tag == "table":
            flow.whole_lines((yield _table_lines(child, shown)))
        elif tag not in BLOCK:
            yield _lay_out(child, flow, shown, exact or tag == "textarea", depth)
        else:
            margin = int(tag in MARGIN and not (tag in LISTS and depth))
            flow.block(margin)
            if tag == "li":
                count = _number(child.attributes.get("value"), count, 10**9) if node.tag == "ol" else count
                marker = f"{count}. " if node.tag == "ol" else "- "
                flow.indent(marker, " " * len(marker))
                count += 1
            elif tag in ("dd", "blockquote"):
                flow.indent("  ", "  ")
            yield _lay_out(child, flow, shown, exact or tag in ("pre", "listing", "xmp"), depth + (tag in LISTS))
            if tag in ("li", "dd", "blockquote"):
                flow.outdent()
            flow.block(margin)


def _rows(table: Node, seen: bool):
    """Rows of a table, and what stands outside of them: ``(row or other node, visible)``."""
    for child in table.children:
        if isinstance(child, str):
            if seen and child.strip(" \t\n\f\r"):
                yield _wrapped(child), seen
            continue
        shown = _seen(child, seen)
        if shown is None:
            continue
        if child.tag in SECTIONS:
            yield from _rows(child, shown)
        elif child.tag not in ("colgroup", "col"):
            yield child, shown


def _wrapped(child) -> Node:
    node = Node("div")
    node.children.append(child)
    return node


def _table_lines(table: Node, seen: bool):
    """A column is as wide as its widest cell; two blanks stand between columns. To be run by ``_done``."""
    above, grid, pending = Flow(), [], {}
    for row, shown in _rows(table, seen):
        if row.tag != "tr":
            above.block(0)
            yield _lay_out(row, above, shown, False, 0)
            above.block(0)
            continue
        cells, column = [], 0
        for child in row.children:
            cell = child if isinstance(child, Node) and child.tag in ("td", "th") else _wrapped(child)
            visible = _seen(cell, shown)
            if visible is None or cell.tag == "div" and isinstance(child, str) and not child.strip(" \t\n\f\r"):
                continue
            while pending.get(column, 0):
                column += 1
            flow = Flow()
            yield _lay_out(cell, flow, visible, False, 0)
            flow.block(0)
            span = max(1, _number(cell.attributes.get("colspan"), 1, 1000))
            down = max(1, _number(cell.attributes.get("rowspan"), 1, 65534))
            cells.append((column, span, flow.lines))
            if down > 1:
                for c in range(column, min(column + span, MOST_COLUMNS)):
                    pending[c] = down
            column += span
        pending = {c: n - 1 for c, n in pending.items() if n > 1}
        grid.append(cells)
    widths: dict[int, int] = {}
    for spanning in (False, True):
        for cells in grid:
            for column, span, lines in cells:
                if (span > 1) == spanning:
                    others = sum(widths.get(c, 0) + 2 for c in range(column, column + span - 1))
                    last = column + span - 1
                    widest = max(map(len, lines), default=0)
                    widths[last] = max(widths.get(last, 0), widest - others)
    filled = sorted(c for c, w in widths.items() if w > 0)
    starts = [0, *accumulate(widths[c] + 2 for c in filled)]
    out = above.lines
    for cells in grid:
        for i in range(max((len(lines) for _, _, lines in cells), default=0)):
            pieces, at = [], 0
            for column, _, lines in cells:
                if i >= len(lines) or not lines[i]:
                    continue
                pad = starts[bisect_left(filled, column)] - at
                if at and pad < 2:  # a cell that is wider than its column's place
                    pad = 2
                own = len(lines[i]) - len(lines[i].lstrip(" "))
                pad = min(pad, MOST_PAD) if at else max(0, min(pad, MOST_PAD - own))
                pieces.append(" " * pad + lines[i])
                at += pad + len(lines[i])
            out.append("".join(pieces))
    return out


def page_text(html: str | None) -> str:
    """The visible text of one page."""
    if not html:
        return ""
    root, flow = parse(html), Flow()
    seen = _seen(root, True)
    if seen is not None:
        _done(_lay_out(root, flow, seen, False, 0))
        flow.block(0)
    return "\n".join(flow.lines).strip("\n")


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, text``: the visible text of every page."""

    def kernel(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = [page_text(x) for x in part.column("html").to_pylist()]
        return pa.record_batch([part.column("page_id"), pa.array(texts, pa.string())], names=["page_id", "text"])

    return pages.select("page_id", "html").mapInArrow(mapped(kernel, "html"), "page_id bigint, text string")
