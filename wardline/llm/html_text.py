"""Layout-aware rendering of HTML to text.

``render`` keeps a stack of open elements with HTML's implied start and end
tags, drops what a browser would not show, and writes the visible text: blocks
on their own lines, paragraphs apart, list markers, preformatted text as it is,
and table cells in aligned columns.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import in_arrow

# Elements by how they are parsed and shown.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style xmp iframe noembed noframes noscript textarea title".split())
HIDDEN = set("head script style iframe noembed noframes noscript title template datalist object video audio canvas rp".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl menu blockquote pre table figure hr fieldset xmp".split())
LINES = set("""address article aside body center dd details dialog dir div dt figcaption footer form header hgroup
html legend li main nav optgroup option search section summary tr caption thead tbody tfoot""".split())
BLOCK = SPACED | LINES
ENDS_P = BLOCK - set("body html caption thead tbody tfoot tr option optgroup legend".split()) | {"hr"}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
SCOPE = set("table td th caption html template object".split())
# start tag -> the elements that it ends, and those at which the search stops
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th", "caption"}, {"table"}), "th": ({"td", "th", "caption"}, {"table"}),
    "tr": ({"tr", "caption"}, {"table"}), "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "a": ({"a"}, BLOCK), "button": ({"button"}, BLOCK),
}
CELL = {"td", "th"}
GROUP = {"thead", "tbody", "tfoot"}

#: Cells wider than this do not widen their column.
WIDEST = 60

_MARKUP = re.compile(r"""<(?:
    !--(?P<comment>.*?)(?:--!?>|\Z) | (?P<other>[!?][^>]*+)(?:>|\Z) | /(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)
  | (?P<start>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+)(?:>|\Z))""", re.S | re.X)
_ATTR = re.compile(r"""([^\s=/>"']++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?""")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
_SPACE = re.compile(r"[ \t\n\r\f]+")
_STYLE = re.compile(r"(display|visibility)\s*:\s*([a-z-]+)", re.I)


class _Lines:
    """Text of one flow: the document's or a table cell's."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.line: list[str] = []
        self.gap = 0
        self.exact = False  # the line holds preformatted text
        self.indent: list[str] = []
        self.marker = ""

    def text(self, s: str) -> None:
        s = _SPACE.sub(" ", s)
        if s[0] == " " and (not self.line or self.line[-1][-1] == " "):
            s = s[1:]
        if s:
            self.line.append(s)

    def plain(self, s: str) -> None:
        """Preformatted text."""
        self.exact = True
        first, *more = s.replace("\r\n", "\n").split("\n")
        if first:
            self.line.append(first)
        for x in more:
            self._end(keep=True)
            if x:
                self.line.append(x)

    def _end(self, keep: bool = False) -> None:
        line = "".join(self.line)
        line = line.rstrip() if keep or self.exact else line.strip(" ")
        self.line, self.exact = [], keep
        if line or keep:
            self.whole([line])

    def whole(self, lines: list[str]) -> None:
        for line in lines:
            if self.out and self.gap > 1:
                self.out.append("")
            self.gap = 0
            self.out.append(("".join(self.indent)[:-len(self.marker)] + self.marker if self.marker else "".join(self.indent)) + line)
            self.marker = ""

    def stop(self, gap: int) -> None:
        """End the line; ``gap`` 2 leaves an empty line before the next."""
        if self.line:
            self._end()
        self.exact = False
        self.gap = max(self.gap, gap)

    def done(self) -> list[str]:
        self.stop(0)
        return [x.rstrip() for x in self.out]


class _Table:
    def __init__(self) -> None:
        self.cells: list[tuple[int, int, list[str]]] = []
        self.row, self.col = -1, 0
        self.below: dict[int, int] = {}  # column -> rows still taken from above

    def next_row(self) -> None:
        self.row, self.col = self.row + 1, 0
        self.below = {c: n - 1 for c, n in self.below.items() if n > 1}

    def add(self, lines: list[str], cols: int, rows: int) -> None:
        while self.col in self.below:
            self.col += 1
        self.cells.append((self.row, self.col, lines))
        if rows > 1:
            self.below |= dict.fromkeys(range(self.col, self.col + cols), rows)
        self.col += cols

    def lines(self) -> list[str]:
        width: dict[int, int] = {}
        for _, c, lines in self.cells:
            width[c] = max(width.get(c, 0), *(len(x) for x in lines if len(x) <= WIDEST), 0, 0)
        at, place = 0, {}
        for c in sorted(width):
            place[c] = at
            at += width[c] + 2 if width[c] else 0
        rows: dict[int, list[list]] = {}
        for r, c, lines in self.cells:
            height = rows.setdefault(r, [])
            for i, x in enumerate(lines):
                if i == len(height):
                    height.append([])
                if x:
                    height[i].append((place[c], x))
        out = []
        for r in sorted(rows):
            for cells in rows[r]:
                s = ""
                for p, x in cells:
                    s += " " * max(p - len(s), 2 if s else 0) + x
                out.append(s)
        return out


class _Open:
    __slots__ = ("tag", "none", "seen", "flow", "table", "attrs", "count", "pre")

    def __init__(self, tag, none, seen, flow, table, attrs, pre):
        self.tag, self.none, self.seen, self.flow, self.table, self.attrs, self.pre = tag, none, seen, flow, table, attrs, pre
        self.count = 0


def _number(value: str | None, default: int, most: int | None = None) -> int:
    m = re.match(r"\s*(-?\d{1,9})", value or "")
    n = int(m[1]) if m else default
    return n if most is None else min(max(n, 1), most)


class _Page:
    def __init__(self) -> None:
        self.root = _Lines()
        self.stack = [_Open("html", False, True, self.root, None, {}, False)]
        self.open_tags: dict[str, int] = {"html": 1}

    # --- the tree: what is open, and what a tag implies

    def has(self, tags: set, stop: set) -> int:
        """Place of the nearest open element of ``tags`` before one of ``stop``; 0 if none."""
        if not any(self.open_tags.get(t) for t in tags):
            return 0
        for i in range(len(self.stack) - 1, 0, -1):
            t = self.stack[i].tag
            if t in tags:
                return i
            if t in stop:
                return 0
        return 0

    def cut(self, depth: int) -> None:
        while len(self.stack) > depth:
            self.close()

    def start(self, tag: str, attrs: dict) -> None:
        if tag in ("html", "frame", "frameset"):
            return
        if tag == "body":
            if at := self.has({"head"}, set()):
                self.cut(at)
            if self.open_tags.get("body"):
                return
        elif tag not in HIDDEN and tag not in ("meta", "link", "base") and self.stack[-1].tag == "head":
            self.close()
        if tag in ENDS_P and (at := self.has({"p"}, SCOPE | {"button"})):
            self.cut(at)
        if tag in HEADINGS and self.stack[-1].tag in HEADINGS:
            self.close()
        if tag in ENDED_BY:
            tags, stop = ENDED_BY[tag]
            if at := self.has(tags, stop):
                self.cut(at)
        if tag in CELL or tag == "tr" or tag in GROUP or tag in ("caption", "colgroup", "col"):
            at = self.has({"table"}, {"template"})
            if not at:
                return
            if tag in GROUP or tag in ("caption", "colgroup", "col"):
                self.cut(at + 1)
            elif tag == "tr":
                self.cut((self.has(GROUP, {"table"}) or at) + 1)
                if self.stack[-1].tag == "table":
                    self.open("tbody", {})
            else:
                self.cut((self.has({"tr"} | GROUP, {"table"}) or at) + 1)
                if self.stack[-1].tag == "table":
                    self.open("tbody", {})
                if self.stack[-1].tag != "tr":
                    self.open("tr", {})
        self.open(tag, attrs)

    def end(self, tag: str) -> None:
        if tag == "br":
            return self.open("br", {})
        if tag == "p" and not self.has({"p"}, SCOPE | {"button"}):
            self.open("p", {})
        if tag in ("html", "body"):
            return None
        stop = {"table"} if tag in CELL or tag == "tr" or tag in GROUP or tag == "caption" else {"html"} if tag == "table" else SCOPE if tag in BLOCK else SCOPE | BLOCK
        tags = HEADINGS if tag in HEADINGS else {tag}
        if at := self.has(tags, stop - tags):
            self.cut(at)
        return None

    # --- what is shown

    def open(self, tag: str, attrs: dict) -> None:
        up = self.stack[-1]
        style = dict((k.lower(), v.lower()) for k, v in _STYLE.findall(attrs.get("style") or ""))
        none = up.none or tag in HIDDEN or "hidden" in attrs or style.get("display") == "none" or (tag == "dialog" and "open" not in attrs)
        if up.tag == "details" and "open" not in up.attrs and not (tag == "summary" and not up.count):
            none = True
        if tag == "summary":
            up.count += 1
        seen = {"hidden": False, "collapse": False, "visible": True}.get(style.get("visibility"), up.seen)
        flow, table = up.flow, up.table
        if not none:
            if tag == "br":
                if flow.line:
                    flow._end()
                else:
                    flow.gap = 2
                return
            if tag in CELL and table:
                if table.row < 0:
                    table.next_row()
                flow = _Lines()
            elif tag in BLOCK and tag not in ("tr", *GROUP):
                flow.stop(2 if tag in SPACED and not (tag in ("ul", "ol") and any(flow.indent)) else 1)
            if tag == "table":
                table = _Table()
            elif tag == "tr" and table:
                table.next_row()
            elif tag == "li":
                mark = "- "
                if up.tag == "ol":
                    up.count = _number(attrs.get("value"), up.count + 1 if up.count else _number(up.attrs.get("start"), 1))
                    mark = f"{up.count}. "
                flow.indent.append(" " * len(mark))
                flow.marker = mark if seen else ""
            elif tag in ("blockquote", "dd"):
                flow.indent.append("    ")
        if tag in VOID:
            return
        self.open_tags[tag] = self.open_tags.get(tag, 0) + 1
        self.stack.append(_Open(tag, none, seen, flow, table, attrs, up.pre or tag in ("pre", "textarea", "xmp")))

    def close(self) -> None:
        e = self.stack.pop()
        self.open_tags[e.tag] -= 1
        if e.none:
            return
        up = self.stack[-1]
        if e.tag in CELL and e.table:
            e.table.add(e.flow.done(), _number(e.attrs.get("colspan"), 1, 1000), _number(e.attrs.get("rowspan"), 1, 65534))
        elif e.tag == "table":
            up.flow.stop(2)
            up.flow.whole(e.table.lines())
            up.flow.stop(2)
        elif e.tag in BLOCK and e.tag not in ("tr", *GROUP):
            e.flow.stop(2 if e.tag in SPACED and not (e.tag in ("ul", "ol") and len(e.flow.indent) > 0) else 1)
            if e.tag == "li":
                e.flow.marker = ""
            if e.tag in ("li", "blockquote", "dd"):
                e.flow.indent.pop()

    def text(self, s: str) -> None:
        top = self.stack[-1]
        if top.tag == "head" and s.strip():
            self.close()
            top = self.stack[-1]
        if top.none or not top.seen or not s or (top.tag == "details" and "open" not in top.attrs):
            return
        if top.tag == "table" or top.tag in GROUP or top.tag == "tr":  # shown before the table
            if not s.strip():
                return
        if top.pre:
            top.flow.plain(s[1:] if s[0] == "\n" and not top.count else s)
            top.count = 1
        else:
            top.flow.text(s)


def render(source: str | None) -> str:
    """All visible text of an HTML page.

    Not shown: head, scripts, styles, templates, fallback content, ``hidden``,
    ``display:none``, ``visibility:hidden`` (its children may be visible again),
    closed ``details`` but for their summary, closed dialogs.  Tags that are
    missing are implied as in HTML's tree construction; an unfinished tag ends
    the page.  Paragraph-like blocks are set apart by an empty line, other blocks
    by a line break; list items have ``-`` or their number and are indented;
    table cells start at their column's place (cells wider than ``WIDEST`` don't
    move the columns).  Null gives the empty string.  Linear in the page's
    length, with no recursion.
    """
    page, at, source = _Page(), 0, source or ""
    while at < len(source):
        lt = source.find("<", at)
        if lt < 0:
            lt = len(source)
        m = _MARKUP.match(source, lt) if lt < len(source) else None
        if m is None and lt < len(source):  # a "<" that starts no markup is text
            lt = source.find("<", lt + 1)
            lt = len(source) if lt < 0 else lt
            page.text(html.unescape(source[at:lt]))
            at = lt
            continue
        if lt > at:
            page.text(html.unescape(source[at:lt]))
        if m is None:
            break
        at = m.end()
        if m["start"]:
            if not source.startswith(">", at - 1):
                break
            tag = m["start"].lower()
            attrs = {k.lower(): html.unescape(v.strip("\"'")) for k, v in _ATTR.findall(m["attrs"])} if m["attrs"] else {}
            if tag in RAW:
                stop = _RAW_END[tag].search(source, at)
                inner, at = source[at:stop.start() if stop else len(source)], stop.start() if stop else len(source)
                page.start(tag, attrs)
                if inner and page.stack[-1].tag == tag:
                    page.text(html.unescape(inner) if tag == "textarea" else inner)
                if page.stack[-1].tag == tag:
                    page.close()
            else:
                page.start(tag, attrs)
        elif m["end"]:
            page.end(m["end"].lower())
    page.cut(1)
    return "\n".join(page.root.done()).strip("\n")


def extract(pages: DataFrame, markup: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the visible text of column ``markup`` in column ``out``
    (replaced if it exists).  Row by row in Arrow batches, no shuffle; null and
    empty pages give the empty string, repeated rows repeated results."""
    marked = pages.withColumn(out, F.col(markup).cast("string"))
    at = marked.columns.index(next(c for c in marked.columns if c.lower() == out.lower()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 200):
                part = batch.slice(lo, 200)
                text = pa.array([render(x) for x in pc.cast(part.column(at), pa.large_string()).to_pylist()], part.schema.field(at).type)
                yield part.set_column(at, part.schema.field(at), text)

    return marked.transform(in_arrow, run, marked.schema)
