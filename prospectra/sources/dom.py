"""The one relation all page operators read: a row per element of a page's tree.

(page_id, node_id, parent_id, depth, child_index, tag, attrs, classes, ancestors, ancestor_tags, own_text, text); ancestors run from the parent to the
root, text is the element's stripped text pieces joined by spaces (scripts, styles and comments aside), node ids follow document order.
Only this tokenising runs in Python, on the standard library's parser; it is map-only, so it also serves streams.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag ends an open element of these kinds unless one of the limits stands between.
ENDS = {**dict.fromkeys("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split(), ("p",)), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LIMITS = frozenset("ul ol dl table tr div section article body html select".split())
UNREAD = frozenset(("script", "style", "template"))
SCHEMA = "page_id long, node_id int, parent_id int, depth int, child_index int, tag string, attrs map<string,string>, classes array<string>, ancestors array<int>, ancestor_tags array<string>, own_text string, text string"
_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.map_(pa.string(), pa.string()), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.string(), pa.string()]


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes: list[list] = []  # tag, attrs, parent, child index, children, [(order, text)]
        self.open: list[int] = []
        self.pieces: list[tuple[int, str]] = []

    def handle_starttag(self, tag: str, attrs) -> None:
        for kind in ENDS.get(tag, ()):
            for at in range(len(self.open) - 1, -1, -1):
                here = self.nodes[self.open[at]][0]
                if here == kind:
                    del self.open[at:]
                    break
                if here in LIMITS and here != tag:
                    break
        parent = self.open[-1] if self.open else -1
        self.nodes.append([tag, {k: v or "" for k, v in reversed(attrs)}, parent, self.nodes[parent][4] if parent >= 0 else 0, 0])
        if parent >= 0:
            self.nodes[parent][4] += 1
        if tag not in VOID:
            self.open.append(len(self.nodes) - 1)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.open) - 1, -1, -1):
            if self.nodes[self.open[at]][0] == tag:
                del self.open[at:]
                return

    def handle_data(self, data: str) -> None:
        if self.open:
            self.pieces.append((self.open[-1], data))


_REFERENCE = re.compile(r"&(?:(#[0-9]+;|#[xX][0-9A-Fa-f]+;)|([A-Za-z][A-Za-z0-9]*;))?")
#: Stands for an ampersand while markup is read: no text in UTF-8 holds it, and no reference yields it.
_AMPERSAND = "\ud800"


def _bare(found: re.Match) -> str:
    return found[0] if found[1] or found[2] in html5 else _AMPERSAND + found[0][1:]


def tree_rows(page_id: int, html: str, closed: bool = False) -> list[tuple]:
    """closed: a character reference without its semicolon is text, where a browser would decode some of them."""
    tree = _Tree()
    tree.feed(_REFERENCE.sub(_bare, html) if closed else html)
    tree.close()
    if closed:
        tree.pieces = [(n, piece.replace(_AMPERSAND, "&")) for n, piece in tree.pieces]
        for node in tree.nodes:
            node[:2] = node[0].replace(_AMPERSAND, "&"), {k.replace(_AMPERSAND, "&"): v.replace(_AMPERSAND, "&") for k, v in node[1].items()}
    own: dict[int, list[str]] = {}
    below: dict[int, list[str]] = {}
    for node, piece in tree.pieces:
        if not (piece := piece.strip()):
            continue
        own.setdefault(node, []).append(piece)
        if tree.nodes[node][0] in UNREAD:
            continue
        while node >= 0:
            below.setdefault(node, []).append(piece)
            node = tree.nodes[node][2]
    out = []
    lines: list[list[int]] = []
    for n, (tag, attrs, parent, place, _) in enumerate(tree.nodes):
        line = [parent, *lines[parent]] if parent >= 0 else []
        lines.append(line)
        out.append((page_id, n, parent if parent >= 0 else None, len(line), place, tag, list(attrs.items()), attrs.get("class", "").split(), line, [tree.nodes[i][0] for i in line], " ".join(own.get(n, ())), " ".join(below.get(n, ()))))
    return out


def dom_nodes(pages: DataFrame, id: str = "page_id", html: str = "html", closed: bool = False) -> DataFrame:
    """A row per element of every page; pages without markup have none. closed: see tree_rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for batch in batches:
            for at in range(0, len(batch), 32):
                rows = [r for page, text in zip(*(c.to_pylist() for c in batch.slice(at, 32).columns), strict=True) if text for r in tree_rows(page, text, closed)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names)

    return pages.select(F.col(id).cast("long").alias("page_id"), html).mapInArrow(run, SCHEMA)
