"""HTML extraction by layout-aware rendering.

A small tree builder reads the tags of a page, closes elements whose end tags are
implied (paragraphs, list items, table parts, options), ignores stray end tags and
keeps raw text of script-like elements apart. A renderer then walks the tree and
emits all visible text: elements that are not shown are left out (by kind, ``hidden``
or ``display``), text under ``visibility: hidden`` too unless an inner element is
visible again, inline text runs together with white space collapsed, blocks stand on
lines of their own with a blank line around paragraphs, headings, lists and tables,
list items get their bullet or number by depth, ``pre`` keeps its lines, and of an
``svg`` its ``text`` elements are read. The cells of a table take their places in its
grid, those of ``rowspan`` and ``colspan`` several (1,000 columns at most, as in
browsers), and are padded to common column widths; a cell over several columns widens
them where it must.

Both walk with a stack of their own, so deeply nested pages, and tables within tables,
are no recursion. Open elements that a tag may close are kept apart from others, and a
tag looks only at those it closes, so the time of a page grows with its length.

Defined results: a null or empty page gives an empty text; broken markup gives the
text a lenient reader sees, and never an error; rows repeat as they stand; an empty
table gives an empty table; further columns are not read.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style title template noscript meta link iframe object canvas "
                   "audio video datalist noembed noframes".split())
#: Blocks with a blank line around them, and blocks on lines of their own.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure hr".split())
LINES = frozenset("html body div section article header footer main nav aside address form fieldset "
                  "figcaption details summary li dt dd tr caption thead tbody tfoot legend option "
                  "hgroup center dir menu".split())
#: An element whose start closes open elements of these kinds, up to the given limits.
CLOSES = {
    **{k: ({"p"}, {"button", "table", "td", "th", "caption", "object"}) for k in
       (SPACED | LINES) - {"html", "body", "li", "dt", "dd", "tr", "thead", "tbody", "tfoot", "caption", "option"}},
    "li": ({"li", "p"}, {"ul", "ol", "menu", "dir", "table"}),
    "dt": ({"dt", "dd", "p"}, {"dl", "table"}), "dd": ({"dt", "dd", "p"}, {"dl", "table"}),
    "tr": ({"tr", "td", "th", "caption", "p"}, {"table"}),
    "td": ({"td", "th", "p"}, {"tr", "table"}), "th": ({"td", "th", "p"}, {"tr", "table"}),
    **{k: ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "p"}, {"table"})
       for k in ("thead", "tbody", "tfoot", "caption")},
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head", "title"}, {"html"}),
}
#: What a head may hold: any other element, and text, ends an open head.
IN_HEAD = frozenset("title meta link script style base noscript template head html basefont bgsound noframes".split())
#: End tags do not reach out of these.
SCOPE = frozenset({"table", "td", "th", "caption", "html"})

TAG = re.compile(r"<(?:!--(?:.*?-->|.*)|!\[CDATA\[(?:.*?\]\]>|.*)|[!?][^>]*>?|"
                 r"(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|$))", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"visibility\s*:\s*(\w+)", re.I)
#: Kinds that end the search for elements to close.
MARKED = (SPACED | LINES).union(CLOSES, *(a | b for a, b in CLOSES.values()))
SPACE = re.compile(r"[ \t\n\r\f\v]+")


class Node:
    __slots__ = ("kind", "attributes", "children")

    def __init__(self, kind: str, attributes: str = ""):
        self.kind, self.attributes, self.children = kind, attributes, []

    def attribute(self, name: str) -> str | None:
        """The value, "" for a bare name, None if there is none."""
        if name not in self.attributes.lower():
            return None
        for m in ATTRIBUTE.finditer(self.attributes):
            if m[1].lower() == name:
                return html.unescape(next((g for g in m.groups()[1:] if g is not None), ""))
        return None

    def hidden(self) -> bool:
        if self.kind in HIDDEN:
            return True
        if not self.attributes:
            return False
        return (self.attribute("hidden") is not None or self.kind == "input"
                or bool(NOT_SHOWN.search(self.attribute("style") or "")))

    def unseen(self, around: bool) -> bool:
        """Whether its text is invisible, by its own style or else as what is around it."""
        if not self.attributes or "visibility" not in self.attributes.lower():
            return around
        found = VISIBILITY.search(self.attribute("style") or "")
        return found[1].lower() != "visible" if found and found[1].lower() in ("visible", "hidden", "collapse") else around


class Open:
    """The open elements, with what lets a tag find its own without walking."""

    def __init__(self):
        self.stack = [Node("html")]
        self.marks: list[int] = []              # depths of MARKED elements
        self.counts = Counter()                 # open elements by kind
        self.scopes = [Counter()]               # and inside each open SCOPE element

    def push(self, node: Node) -> None:
        if node.kind in MARKED:
            self.marks.append(len(self.stack))
        self.stack.append(node)
        self.counts[node.kind] += 1
        self.scopes[-1][node.kind] += 1
        if node.kind in SCOPE:
            self.scopes.append(Counter())

    def cut(self, depth: int) -> None:
        """Closes the elements from ``depth`` on."""
        while len(self.stack) > depth:
            kind = self.stack.pop().kind
            if kind in SCOPE:
                self.scopes.pop()
            self.counts[kind] -= 1
            self.scopes[-1][kind] -= 1
        while self.marks and self.marks[-1] >= depth:
            self.marks.pop()

    def end(self, kind: str) -> None:
        """An end tag: closes the innermost element of its kind, within its scope."""
        far = kind in SCOPE or kind in ("tr", "thead", "tbody", "tfoot", "body")
        if (self.counts if far else self.scopes[-1])[kind] > 0:
            depth = len(self.stack) - 1
            while self.stack[depth].kind != kind:
                depth -= 1
            self.cut(depth)

    def begin(self, kind: str) -> None:
        """Closes what the start of such an element implies."""
        if kind not in IN_HEAD and self.stack[-1].kind == "head":
            self.cut(len(self.stack) - 1)
        closed, limits = CLOSES.get(kind, ((), ()))
        found = None
        for depth in reversed(self.marks) if closed else ():
            own = self.stack[depth].kind
            if own in limits or own not in closed:
                break
            found = depth
        if found is not None:
            self.cut(found)


def build_tree(page: str) -> Node:
    open_ = Open()
    stack = open_.stack
    at, n = 0, len(page)
    while at < n:
        m = TAG.search(page, at)
        end = m.start() if m else n
        if end > at:
            text = html.unescape(page[at:end])
            if stack[-1].kind == "head" and SPACE.sub("", text):
                open_.cut(len(stack) - 1)
            stack[-1].children.append(text)
        if not m:
            break
        at = m.end()
        if m[2] is None:
            if page.startswith("<![CDATA[", m.start()):
                stack[-1].children.append(page[m.start() + 9:at].removesuffix("]]>"))
            continue
        kind = m[2].lower()
        if m[1]:
            open_.end(kind)
            continue
        if kind == "html" or (kind == "body" and open_.counts[kind]):
            continue
        open_.begin(kind)
        node = Node(kind, m[3])
        stack[-1].children.append(node)
        if kind in RAW:
            close = re.compile(rf"</{re.escape(kind)}[\s/>]", re.I).search(page, at)
            end = close.start() if close else n
            text = page[at:end]
            node.children.append(html.unescape(text) if kind in ("textarea", "title") else text)
            at = end
            if close:
                at = page.find(">", end) + 1 or n
        # a slash closes void elements, and those of a drawing
        elif kind not in VOID and not (m[3].endswith("/") and (kind == "svg" or open_.counts["svg"])):
            open_.push(node)
    return stack[0]


class Writer:
    """Collects lines; inline text joins the last line."""

    def __init__(self, prefix: str = ""):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.blank = False     # a blank line is due before the next text
        self.space = False     # a space is due before the next inline text
        self.indent = prefix
        self.marker = ""       # of a list item whose text has not begun

    def inline(self, text: str) -> None:
        text = SPACE.sub(" ", text)
        if not text:
            return
        if text[0] == " ":
            self.space, text = True, text[1:]
        if not text:
            return
        tail = text[-1] == " "
        if self.now and self.space:
            self.now.append(" ")
        self.now.append(text[:-1] if tail else text)
        self.space = tail

    def end_line(self) -> None:
        if self.now:
            self.put("".join(self.now).rstrip())
            self.now = []
        self.space = False

    def put(self, line: str) -> None:
        if self.blank and self.lines:
            self.lines.append("")
        self.blank = False
        lead = self.indent
        if self.marker:
            lead = self.indent[:len(self.indent) - len(self.marker)] + self.marker
            self.marker = ""
        self.lines.append((lead + line).rstrip())

    def spaced(self) -> None:
        self.end_line()
        if not self.marker:
            self.blank = True

    def text(self) -> str:
        self.end_line()
        return "\n".join(self.lines)


def _width(s: str) -> int:
    return sum(2 if unicodedata.east_asian_width(c) in "WF" else not unicodedata.combining(c) for c in s) \
        if not s.isascii() else len(s)


def _rows(table: Node, unseen: bool) -> tuple[list[tuple], list[list[tuple]], list[tuple]]:
    """Captions, rows of cells, and other children of a table (not of inner tables),
    each with whether it is invisible by what is around it."""
    captions, rows, other = [], [], []
    todo = [(x, unseen) for x in reversed(table.children)]
    loose: list | None = None
    while todo:
        x, around = todo.pop()
        if isinstance(x, str):
            if x.strip():
                other.append((x, around))
            continue
        if x.hidden():
            continue
        inner = x.unseen(around)
        if x.kind in ("thead", "tbody", "tfoot", "colgroup"):
            todo += [(c, inner) for c in reversed(x.children)]
            loose = None
        elif x.kind == "tr":
            rows.append([(c, inner) for c in x.children
                         if not isinstance(c, str) and c.kind in ("td", "th") and not c.hidden()])
            other += [(c, inner) for c in x.children if (c.strip() if isinstance(c, str) else c.kind not in ("td", "th"))]
            loose = None
        elif x.kind in ("td", "th"):
            if loose is None:
                loose = []
                rows.append(loose)
            loose.append((x, around))
        else:
            (captions if x.kind == "caption" else other).append((x, around))
    return captions, rows, other


def _span(cell: Node, name: str, most: int) -> int:
    s = cell.attribute(name) or ""
    return max(1, min(int(s), most)) if s.isdecimal() and len(s) < 9 else 1


def _grid(rows: list[list[Node]]) -> list[list[tuple[int, int]]]:
    """The columns (from, to) of every cell: the first free ones of its row, which cells
    of rows above may take part of."""
    held: list[tuple[int, int, int]] = []  # from, to, and the row from which they are free
    out = []
    for r, cells in enumerate(rows):
        held = sorted(h for h in held if h[2] > r)
        line, col, k = [], 0, 0
        for c in cells:
            while k < len(held) and held[k][0] <= col:
                col = max(col, held[k][1])
                k += 1
            wide = _span(c, "colspan", 1000)
            line.append((col, col + wide))
            col += wide
        tall = [(a, b, r + _span(c, "rowspan", len(rows) - r)) for c, (a, b) in zip(cells, line, strict=True)]
        for a, b, until in tall:
            if until > r + 1:
                if held and held[-1][1] == a and held[-1][2] == until:  # one with its neighbour
                    a = held.pop()[0]
                held.append((a, b, until))
        out.append(line)
    return out


def _table(node: Node, writer: Writer, unseen: bool):
    captions, rows, other = _rows(node, unseen)
    for x, around in [*captions, *other]:
        writer.end_line()
        yield _render([x], writer, around)
        writer.end_line()
    places = _grid([[c for c, _ in r] for r in rows])
    texts: list[list[list[str]]] = []
    for r in rows:
        texts.append([])
        for c, around in r:
            w = Writer()
            yield _render(c.children, w, c.unseen(around))
            texts[-1].append(w.text().split("\n"))
    # Columns that no cell begins or ends at are not told apart.
    edges = sorted({e for line in places for place in line for e in place})
    number = {e: i for i, e in enumerate(edges)}
    widths = [0] * len(edges)
    cells = [((number[a], number[b]), max(map(_width, text))) for line, own in zip(places, texts, strict=True)
             for (a, b), text in zip(line, own, strict=True)]
    for (a, b), need in sorted(cells, key=lambda c: c[0][1] - c[0][0]):
        widths[b - 1] += max(0, need - sum(widths[a:b]) - 2 * (b - a - 1))
    begin = [0]
    for w in widths:
        begin.append(begin[-1] + w + 2)
    for line, own in zip(places, texts, strict=True):
        for i in range(max(map(len, own), default=0)):
            out, at = [], 0
            for (a, _), text in zip(line, own, strict=True):
                if i < len(text) and text[i]:
                    out.append(" " * (begin[number[a]] - at) + text[i])
                    at = begin[number[a]] + _width(text[i])
            if out:
                writer.put("".join(out).rstrip())


def _drawn(svg: Node) -> list[Node]:
    """The texts of a drawing, and pages inside it."""
    found, todo = [], [*reversed(svg.children)]
    while todo:
        x = todo.pop()
        if isinstance(x, str) or x.hidden() or x.kind == "desc":
            continue
        if x.kind in ("text", "foreignobject"):
            found += [" ", x]
        else:
            todo += reversed(x.children)
    return found


def _render(nodes: list, writer: Writer, unseen: bool = False):
    """Walks the nodes; a tuple on the stack is a step after an element's children. A
    generator of the tables met, each to be run before it goes on."""
    stack: list = [*reversed(nodes)]
    lists: list[list] = []  # [ordered, next number] of open lists
    pre = 0
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            if unseen:
                continue
            if not pre:
                writer.inline(x)
            else:
                first, *more = x.replace("\r\n", "\n").split("\n")
                writer.now.append(first)
                for line in more:
                    writer.put("".join(writer.now))
                    writer.now = [line] if line else []
            continue
        if isinstance(x, tuple):
            step, kind = x[0], x[1]
            if step == "unseen":
                unseen = kind
                continue
            writer.end_line()
            if step == "item":
                if writer.marker == x[3]:  # an item without text
                    writer.marker = ""
                writer.indent = x[2]
            elif step == "list":
                lists.pop()
                if not lists:
                    writer.spaced()
            elif step == "pre":
                pre -= 1
                writer.spaced()
            elif step == "quote":
                writer.indent = x[2]
                writer.spaced()
            elif kind in SPACED:
                writer.spaced()
            continue
        if x.hidden():
            continue
        kind = x.kind
        inner = x.unseen(unseen)
        if inner != unseen and kind != "table":
            stack.append(("unseen", unseen))
            unseen = inner
        if kind == "br":
            if writer.now:
                writer.end_line()
            elif writer.lines and not writer.blank:
                writer.blank = True
        elif kind == "table":
            writer.spaced()
            yield _table(x, writer, inner)
            writer.spaced()
        elif kind == "svg":
            stack += reversed(_drawn(x))
        elif kind in ("ul", "ol", "menu", "dir"):
            if lists:
                writer.end_line()
            else:
                writer.spaced()
            s = x.attribute("start") or ""
            lists.append([kind == "ol", int(s) if s.isdecimal() and len(s) < 10 else 1])
            stack.append(("list", kind))
            stack += reversed(x.children)
        elif kind == "li":
            writer.end_line()
            if lists and lists[-1][0]:
                marker = f"{lists[-1][1]}. "
                lists[-1][1] += 1
            else:
                marker = "- "
            stack.append(("item", kind, writer.indent, marker))
            writer.indent += " " * len(marker)
            writer.marker = marker
            stack += reversed(x.children)
        elif kind == "pre":
            writer.spaced()
            pre += 1
            stack.append(("pre", kind))
            children = x.children
            if children and isinstance(children[0], str):
                children = [children[0].removeprefix("\n"), *children[1:]]
            stack += reversed(children)
        elif kind in ("blockquote", "dd"):
            writer.spaced() if kind == "blockquote" else writer.end_line()
            stack.append(("quote" if kind == "blockquote" else "item", kind, writer.indent, None))
            writer.indent += "  "
            stack += reversed(x.children)
        elif kind == "hr":
            writer.spaced()
        elif kind in SPACED or kind in LINES:
            writer.spaced() if kind in SPACED else writer.end_line()
            stack.append(("end", kind))
            stack += reversed(x.children)
        else:
            if kind in ("td", "th", "option"):
                writer.inline(" ")
            stack += reversed(x.children)


def render(page: str | None) -> str:
    """The visible text of a page."""
    if not page:
        return ""
    w = Writer()
    running = [_render([build_tree(page)], w)]
    while running:  # a table, or a cell of it, runs before what is around it goes on
        inner = next(running[-1], None)
        if inner is None:
            running.pop()
        else:
            running.append(inner)
    return w.text()


def html_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per page: its id and ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array(map(render, b.column(1).to_pylist()), pa.string())],
                                  names=[id_col, "text"])

    read = pages.select(F.col(id_col), F.col(html_col))
    kind = read.schema[0].dataType.simpleString()
    return read.mapInArrow(run, f"`{id_col}` {kind}, text string")
