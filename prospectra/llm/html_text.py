"""HTML extraction by layout: a tree with implied tags, visibility rules, and a renderer that keeps blocks, lists and aligned tables.

The parser cuts markup into tags and text, closes what HTML lets authors leave open (p, li, dt, dd, option, table parts), ignores
stray end tags, and keeps script-like content as raw text. Hidden elements (by kind, ``hidden``, ``display:none``, hidden inputs, closed
``details`` and ``dialog``) show nothing; ``visibility`` is inherited and can be turned on again below. Blocks begin lines, paragraphs and
headings stand apart by a blank line, list items are marked and indented, ``pre`` keeps its white space, and table cells, over as many columns as
they span, are filled up to their columns' widths.

Work and output are in proportion to the page: every search for a tag's end starts where the last one stopped, elements nest DEEPEST
deep (what lies deeper becomes a sibling, as browsers do it), indents end at WIDEST_INDENT, and a page has PADDING blanks for each of its
characters, and some more, to align its tables with; a table that would need more is shown with its cells' lines unaligned. No text is dropped.

Rows: null or empty markup gives an empty text; repeated rows get equal results; other columns don't matter; an empty table gives no rows.
A tag without an end shows as text; a quote that is never closed ends at the tag's first ``>``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Element kinds of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript iframe noembed noframes audio video canvas datalist title area param source track rp desc defs metadata annotation annotation-xml".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure fieldset hr".split())
BLOCK = APART | frozenset("html body address article aside center details dialog dir div dd dt figcaption footer form header hgroup legend li main menu nav optgroup option search section summary caption".split())
CELLS, ROW_GROUPS, LISTS = frozenset(("td", "th")), frozenset(("thead", "tbody", "tfoot")), frozenset(("ul", "ol", "menu", "dir"))
#: A start tag closes an open element of these kinds, looked for up to the nearest of the barrier kinds.
IMPLIED = {
    "li": ({"li"}, LISTS),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "optgroup", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    **{g: ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}) for g in ROW_GROUPS},
}
CLOSES_P = BLOCK - {"html", "body", "option", "optgroup", "legend", "caption"}
P_BARRIERS = frozenset(("td", "th", "caption", "table", "button", "html", "body", "object"))

DEEPEST, WIDEST_INDENT, WIDEST_SPAN, PADDING, MORE_PADDING = 512, 64, 100, 8, 1 << 16
BUTTONS = frozenset(("submit", "button", "reset"))
_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NOT_DISPLAYED = re.compile(r"(?:^|[;\s])display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"(?:^|[;\s])visibility\s*:\s*(hidden|collapse|visible)", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []


def attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), unescape("".join(values)))
    return out


class _Ahead:
    """Where strings stand next in a text; a search that found something is not done again before that place is passed."""

    def __init__(self, text: str):
        self.text, self.found = text, {}

    def find(self, what: str, at: int) -> int:
        """The first place from at on, or -1."""
        known = self.found.get(what)
        if known is None or -1 < known < at:
            known = self.found[what] = self.text.find(what, at)
        return known


def tokens(html: str) -> Iterator[tuple[str, int, int, str]]:
    """(kind, begin, end, name): text, open or close tags with the place of what follows the name, and what isn't shown."""
    ahead, at, end = _Ahead(html), 0, len(html)

    def closing(begin: int) -> int:
        """Where a start tag ends: at the first > outside quotes, or at the first of all if a quote stays open."""
        place = begin
        while True:
            stops = [p for p in (ahead.find(c, place) for c in ">\"'") if p >= 0]
            stop = min(stops, default=-1)
            if stop < 0 or html[stop] == ">":
                return stop
            place = ahead.find(html[stop], stop + 1) + 1
            if not place:
                return html.find(">", begin)

    while at < end:
        start = ahead.find("<", at)
        if start < 0:
            yield "text", at, end, ""
            return
        if start > at:
            yield "text", at, start, ""
        if html.startswith("<!--", start):
            stop = ahead.find("-->", start + 4)
            at = end if stop < 0 else stop + 3
        elif html.startswith("<![CDATA[", start):
            stop = ahead.find("]]>", start)
            at = end if stop < 0 else stop + 3
        elif html[start + 1 : start + 2] in ("!", "?") and (stop := ahead.find(">", start)) >= 0:
            at = stop + 1
        else:
            slash = html.startswith("/", start + 1)
            name = _NAME.match(html, start + 1 + slash) if ahead.find(">", start) >= 0 else None
            if name is None:
                yield "text", start, start + 1, ""
                at = start + 1
                continue
            stop = ahead.find(">", name.end()) if slash else closing(name.end())
            yield "close" if slash else "open", name.end(), stop, name[0].lower()
            at = stop + 1
            if not slash and name[0].lower() in RAW:
                # the reader of raw text says where it ends
                at = yield "raw", at, end, name[0].lower()


def build_tree(html: str) -> Node:
    root = now = Node("#root", {}, None)
    open_tags: dict[str, int] = {}
    depth, lower = 0, None
    in_vain: set[str] = set()  # what was looked for from the innermost open element on and isn't there

    def close(node: Node) -> Node:
        """Close everything from the innermost open element up to node."""
        nonlocal depth
        here = now
        while True:
            open_tags[here.tag] -= 1
            depth -= 1
            if here is node:
                in_vain.clear()
                return here.parent
            here = here.parent

    def implied(tag: str, kinds, barriers) -> Node:
        if tag in in_vain or not any(open_tags.get(k) for k in kinds):
            return now
        here, last = now, None
        while here.parent is not None and here.tag not in barriers:
            if here.tag in kinds:
                last = here
            here = here.parent
        if last is not None:
            return close(last)
        in_vain.add(tag)
        return now

    reader, sent = tokens(html), None
    while True:
        try:
            kind, begin, stop, tag = reader.send(sent)
        except StopIteration:
            return root
        sent = None
        if kind == "text":
            now.children.append(html[begin:stop])
            continue
        if kind == "raw":
            if lower is None:
                lower = html.lower()
                if len(lower) != len(html):  # a letter whose lower case is longer
                    lower = re.sub("[A-Z]", lambda x: x[0].lower(), html)
            last = lower.find(f"</{tag}", begin)
            last = len(html) if last < 0 else last
            now.children[-1].children.append(html[begin:last])
            following = html.find(">", last)
            sent = len(html) if following < 0 else following + 1
            continue
        if kind == "close":
            if open_tags.get(tag) and f"/{tag}" not in in_vain:
                here = now
                # a cell's or table's content can't close what is outside
                while here.tag != tag and not (here.tag in ("table", "td", "th") and tag not in ("table", "tr", "td", "th", "tbody", "thead", "tfoot", "body", "html")):
                    here = here.parent
                if here.tag == tag:
                    now = close(here)
                else:
                    in_vain.add(f"/{tag}")
            elif tag == "br":
                now.children.append(Node("br", {}, now))
            continue
        if tag in CLOSES_P:
            now = implied("p", {"p"}, P_BARRIERS)
        if tag in IMPLIED:
            now = implied(tag, *IMPLIED[tag])
        if tag == "body" and open_tags.get("head"):
            now = implied("head", {"head"}, {"html"})
        inside = html[begin:stop]
        node = Node(tag, attributes(inside) if inside else {}, now)
        now.children.append(node)
        if tag in VOID or tag in RAW or inside.endswith("/") and tag in ("path", "circle", "rect", "use", "g", "line") or depth >= DEEPEST:
            continue
        now = node
        depth += 1
        in_vain.clear()
        open_tags[tag] = open_tags.get(tag, 0) + 1


def hidden(node: Node) -> bool:
    """Whether an element isn't displayed, whatever stands in it."""
    a, tag = node.attrs, node.tag
    if tag in UNSEEN or tag == "dialog" and "open" not in a:
        return True
    return bool(a) and ("hidden" in a or tag == "input" and a.get("type", "").lower() == "hidden" or "style" in a and bool(_NOT_DISPLAYED.search(a["style"])))


def _children(node: Node) -> list:
    """What an element shows: of closed details their first summary only."""
    if node.tag != "details" or "open" in node.attrs:
        return node.children
    return [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]


class _Flow:
    """Lines in the making; a table cell has one of its own."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.indent, self.mark, self.gap = "", "", 0

    def text(self, s: str, kept: bool) -> None:
        if kept:
            first, *rest = s.split("\n")
            self.parts.append(first)
            for x in rest:
                self.newline(True)
                self.parts.append(x)
            return
        s = _SPACE.sub(" ", s)
        if s[:1] == " " and (not self.parts or self.parts[-1][-1:] == " "):
            s = s[1:]
        if s:
            self.parts.append(s)

    def newline(self, even_if_empty: bool = False) -> None:
        line = "".join(self.parts).rstrip(" ")
        if line or even_if_empty:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = 0
            self.lines.append((self.indent + self.mark + line).rstrip(" "))
            self.mark = " " * len(self.mark) if self.mark.strip() else self.mark
        self.parts = []

    def apart(self) -> None:
        self.newline()
        self.gap = 1

    def done(self) -> list[str]:
        self.newline()
        return self.lines

    def indented(self, more: int) -> None:
        self.indent = " " * min(len(self.indent) + more, WIDEST_INDENT)


def table_lines(rows: list[list[tuple[list[str], int]]], budget: int) -> tuple[list[str], int]:
    """Rows of cells (lines, columns spanned), each column as wide as its widest line, and what is left of the budget of blanks.

    Where it doesn't suffice, a row is one line of its cells' first lines, and their other lines follow, unaligned.
    """
    widths: list[int] = []
    for row in rows:
        k = 0
        for lines, span in row:
            widths += [0] * (k + span - len(widths))
            if span == 1:
                widths[k] = max(widths[k], max(map(len, lines), default=0))
            k += span
    total = [0, *accumulate(widths)]
    cost = 0
    for row in rows:
        k, height, wide = 0, max((len(lines) for lines, _ in row), default=0), 0
        for _, span in row:
            wide += total[k + span] - total[k] + 3 * span
            k += span
        cost += height * wide - sum(len(x) for lines, _ in row for x in lines)
    if cost > budget:
        out = []
        for row in rows:
            out.append(" | ".join(lines[0] if lines else "" for lines, _ in row).rstrip(" "))
            out += [x for lines, _ in row for x in lines[1:]]
        return out, budget
    out = []
    for row in rows:
        places, k = [], 0
        for lines, span in row:
            places.append((lines, total[k + span] - total[k] + 3 * (span - 1)))
            k += span
        for n in range(max((len(lines) for lines, _ in row), default=0)):
            out.append(" | ".join((lines[n] if n < len(lines) else "").ljust(w) for lines, w in places).rstrip(" "))
    return out, budget - cost


def _number(text: str, least: int) -> int:
    """A short decimal number in an attribute, or least."""
    text = text.strip()
    return int(text) if len(text) < 10 and text.removeprefix("-").isascii() and text.removeprefix("-").isdigit() else least


def render(root: Node, budget: int) -> str:
    """budget: how many blanks may be spent on aligning tables."""
    flow, flows, tables, lists = _Flow(), [], [], []
    kept = 0
    todo: list[tuple[Node | str, bool, bool]] = [(root, True, True)]
    while todo:
        item, entering, visible = todo.pop()
        if isinstance(item, str):
            if visible and not (tables and tables[-1][1] is None and not item.strip()):
                flow.text(unescape(item), kept > 0)
            continue
        tag = item.tag
        if entering:
            if hidden(item):
                continue
            if found := _VISIBILITY.search(item.attrs.get("style", "")):
                visible = found[1].lower() == "visible"
            todo.append((item, False, visible))
            todo += [(c, True, visible) for c in reversed(_children(item))]
            if tag == "br":
                flow.newline(True)
            elif tag == "hr":
                flow.apart()
                flow.parts = ["---"] if visible else []
            elif tag == "input" and visible and item.attrs.get("type", "").lower() in BUTTONS:
                flow.text(item.attrs.get("value", ""), False)
            elif tag == "table":
                flow.apart()
                tables.append([[], None])
            elif tag == "tr" and tables:
                tables[-1][0].append([])
            elif tag in CELLS and tables:
                if not tables[-1][0]:
                    tables[-1][0].append([])
                flows.append((flow, kept, lists, tables[-1][1]))
                tables[-1][1] = item
                flow, kept, lists = _Flow(), 0, []
            elif tag in APART:
                if tag in LISTS and lists:
                    flow.newline()
                else:
                    flow.apart()
            elif tag in BLOCK:
                flow.newline()
            if tag in LISTS:
                lists.append([tag == "ol", _number(item.attrs.get("start", ""), 1) - 1, flow.indent, flow.mark])
                if len(lists) > 1:
                    flow.indented(len(flow.mark))
                flow.mark = ""
            elif tag == "li":
                if lists:
                    lists[-1][1] += 1
                flow.mark = f"{lists[-1][1]}. " if lists and lists[-1][0] else "- "
            elif tag in ("dd", "blockquote"):
                flows.append(flow.indent)
                flow.indented(2)
            elif tag in ("pre", "textarea"):
                kept += 1
            continue
        if tag == "table" and tables:
            rows, _ = tables.pop()
            flow.newline()
            lines, budget = table_lines([r for r in rows if r], budget)
            for line in lines:
                flow.parts = [line]
                flow.newline(True)
            flow.apart()
        elif tag in CELLS and tables and tables[-1][1] is item:
            cell = flow.done()
            flow, kept, lists, tables[-1][1] = flows.pop()
            span = min(max(_number(item.attrs.get("colspan", ""), 1), 1), WIDEST_SPAN)
            tables[-1][0][-1].append((cell, span))
        elif tag in LISTS:
            if len(lists) > 1:
                flow.newline()
            else:
                flow.apart()
            _, _, flow.indent, flow.mark = lists.pop()
        elif tag == "li":
            flow.newline()
            flow.mark = ""
        elif tag in APART:
            flow.apart()
        elif tag in BLOCK:
            flow.newline()
        if tag in ("dd", "blockquote"):
            flow.indent = flows.pop()
        elif tag in ("pre", "textarea"):
            kept -= 1
    return "\n".join(flow.done())


def html_to_text(html: str | None) -> str:
    return render(build_tree(html), PADDING * len(html) + MORE_PADDING) if html else ""


def extract(pages: DataFrame, id: str = "page_id", html: str = "html") -> DataFrame:
    """A row per row of pages: id, text, n_chars, n_lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                texts = [html_to_text(x) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())], ["id", "text", "n_chars", "n_lines"])

    return pages.select(F.col(id).cast("long").alias("id"), html).mapInArrow(run, "id long, text string, n_chars long, n_lines long").withColumnRenamed("id", id)
