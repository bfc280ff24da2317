"""HTML pages as columns: an outline of elements plus the visible texts.

The outline is the only thing made in Python workers.  Everything that reads
it (links, headings, review blocks, ratings) is written with Spark's array
functions in ``operators.extract``.
"""

from __future__ import annotations

import sys
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements without content, and elements whose own text is never
# part of the visible text.
VOID = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
SILENT = frozenset(("script", "style", "template", "rt", "rp"))
OUTLINE_TAGS = (
    "a", "article", "div", "h1", "h2", "h3", "h4", "li", "ol", "p", "section", "ul",
)

# texts: visible strings in document order, stripped, blanks dropped.
# nodes: elements of the tags above in document order.  i, stop and parent count all
# elements; the places at (a node's own), end, box and head count nodes, from 0:
# the nodes below one are nodes[at + 1 : end], box is the nearest enclosing
# container and head the first h1-h4 below, -1 where there is none.  Its texts are
# texts[t0:t1].  siblings has the nodes' places by parent; a node stands there at
# rank, and its parent's last child before rank_end.
OUTLINE = """struct<
    texts: array<struct<s: string, noscript: boolean>>,
    nodes: array<struct<i: int, stop: int, parent: int, tag: string, href: string,
                        id: string, t0: int, t1: int,
                        at: int, end: int, box: int, head: int, rank: int, rank_end: int>>,
    siblings: array<int>,
    error: string>"""
BOXES = ("li", "div", "article", "section")
_AT_ONCE = 32  # pages
_PLACES = ("at", "end", "box", "head", "rank", "rank_end")
_NODE = pa.struct(
    [
        ("i", pa.int32()), ("stop", pa.int32()), ("parent", pa.int32()), ("tag", pa.string()),
        ("href", pa.string()), ("id", pa.string()), ("t0", pa.int32()), ("t1", pa.int32()),
        *[(name, pa.int32()) for name in _PLACES],
    ]
)
_TEXT = pa.struct([("s", pa.string()), ("noscript", pa.bool_())])
_OUTLINE = pa.struct(
    [("texts", pa.list_(_TEXT)), ("nodes", pa.list_(_NODE)), ("siblings", pa.list_(pa.int32())), ("error", pa.string())]
)


class _Outline(HTMLParser):
    """Collects texts and nodes in one pass; an end tag closes the nearest open namesake."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.texts, self.nodes, self.buffer, self.count = [], [], [], 0
        self.open, self.names = [], Counter()
        self.boxes, self.headless = [], []  # open containers, and those of them without a heading so far

    def flush(self):
        text = "".join(self.buffer).strip()
        self.buffer.clear()
        if text and not any(self.names[tag] for tag in SILENT):
            self.texts.append({"s": text, "noscript": self.names["noscript"] > 0})

    def handle_data(self, data):
        self.buffer.append(data)

    def handle_starttag(self, tag, attrs):
        self.flush()
        attrs = dict(attrs)
        node = {
            "i": self.count,
            "stop": self.count + 1,
            "parent": self.open[-1]["i"] if self.open else -1,
            "tag": tag,
            "href": (attrs["href"] or "") if "href" in attrs else None,
            "id": attrs.get("id"),
            "t0": len(self.texts),
            "t1": len(self.texts),
        }
        self.count += 1
        if tag in OUTLINE_TAGS:
            self.place(node, tag)
        if tag not in VOID:
            self.open.append(node)
            self.names[tag] += 1

    def place(self, node, tag):
        at = len(self.nodes)
        node |= {"at": at, "end": at + 1, "box": self.boxes[-1]["at"] if self.boxes else -1, "head": -1, "rank": -1, "rank_end": -1}
        self.nodes.append(node)
        if tag in ("h1", "h2", "h3", "h4"):
            for box in self.headless:
                box["head"] = at
            self.headless.clear()
        if tag in BOXES:
            self.boxes.append(node)
            self.headless.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.flush()
        if self.names[tag]:
            while self.close_last() != tag:
                pass

    def close_last(self):
        node = self.open.pop()
        self.names[node["tag"]] -= 1
        node["stop"], node["t1"] = self.count, len(self.texts)
        if "at" in node:
            node["end"] = len(self.nodes)
        for stack in (self.boxes, self.headless):
            if stack and stack[-1] is node:
                stack.pop()
        return node["tag"]

    def handle_comment(self, data):
        self.flush()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def finish(self):
        self.close()
        self.flush()
        while self.open:
            self.close_last()

    def siblings(self):
        order = sorted(range(len(self.nodes)), key=lambda k: self.nodes[k]["parent"])  # keeps document order
        first = 0
        for rank, k in enumerate(order):
            self.nodes[k]["rank"] = rank
            if rank + 1 == len(order) or self.nodes[order[rank + 1]]["parent"] != self.nodes[k]["parent"]:
                for other in order[first : rank + 1]:
                    self.nodes[other]["rank_end"] = rank + 1
                first = rank + 1
        return order


def _outline(html: str | None) -> dict | None:
    if not html:
        return None
    page = _Outline()
    try:
        page.feed(html)
        page.finish()
    except Exception as exc:  # a page that cannot be read is reported, not fatal
        return {"texts": [], "nodes": [], "siblings": [], "error": f"{type(exc).__name__}: {exc}"}
    return {"texts": page.texts, "nodes": page.nodes, "siblings": page.siblings(), "error": None}


def _outline_batch(html: pa.Array) -> pa.Array:
    # An outline in Python takes many times its page's memory: few of them at once.
    some = [html.slice(k, _AT_ONCE) for k in range(0, len(html), _AT_ONCE)]
    made = [pa.array([_outline(page) for page in pages.to_pylist()], type=_OUTLINE) for pages in some]
    return pa.concat_arrays(made) if made else pa.array([], type=_OUTLINE)


# Workers get this module's code with the task, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def outline(html: Column) -> Column:
    """Outline struct of an HTML column; null for a null or empty page."""
    return F.arrow_udf(_outline_batch, OUTLINE)(html)
