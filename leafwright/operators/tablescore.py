"""Table similarity by tree edit distance (Zhong et al. 2019), over the ordered-tree algorithm of Zhang and Shasha (1989)."""

from __future__ import annotations

from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from leafwright.functions.scalars import distance

_CELLS = ("td", "th")


class Node:
    __slots__ = ("tag", "down", "across", "text", "children")

    def __init__(self, tag: str, down: str = "1", across: str = "1"):
        self.tag, self.down, self.across, self.text, self.children = tag, down, across, "", []


class _Reader(HTMLParser):
    """The first table of a text as a tree of table parts, rows and cells; tags within a cell count by their text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root: Node | None = None
        self.open: list[Node] = []
        self.done = False

    def handle_starttag(self, tag, attrs):
        if self.done or tag not in ("table", "thead", "tbody", "tfoot", "tr", *_CELLS):
            return
        a = dict(attrs)
        node = Node(tag, a.get("rowspan") or "1", a.get("colspan") or "1")
        if tag == "table" and self.root is None:
            self.root = node
        elif not self.open:
            return
        else:
            if tag in _CELLS or tag == "tr":  # a row or cell that was left open ends here
                while len(self.open) > 1 and (self.open[-1].tag in _CELLS or (tag == "tr" and self.open[-1].tag == "tr")):
                    self.open.pop()
            self.open[-1].children.append(node)
        self.open.append(node)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                break
        self.done = self.root is not None and not self.open

    def handle_data(self, data):
        if self.open and self.open[-1].tag in _CELLS:
            self.open[-1].text += data


def parse_table(html: str) -> Node | None:
    reader = _Reader()
    reader.feed(html)
    return reader.root


def _post_order(root: Node) -> tuple[list[Node], list[int]]:
    """The nodes from the leaves up, and for each the number of its leftmost leaf."""
    nodes, left, stack = [], [], [(root, 0, -1)]
    while stack:
        node, i, first = stack.pop()
        if i < len(node.children):
            stack += [(node, i + 1, first), (node.children[i], 0, -1)]
            continue
        leaf = first if first >= 0 else len(nodes)
        nodes.append(node)
        left.append(leaf)
        if stack:
            parent, k, mine = stack[-1]
            if mine < 0:
                stack[-1] = (parent, k, leaf)
    return nodes, left


def _change(a: Node, b: Node) -> float:
    if (a.tag, a.down, a.across) != (b.tag, b.down, b.across):
        return 1.0
    if a.tag in _CELLS and (a.text or b.text):
        x, y = a.text.strip(), b.text.strip()
        return distance(x, y) / max(len(x), len(y)) if x or y else 0.0
    return 0.0


def tree_distance(a: Node, b: Node) -> float:
    """Insertions and deletions of nodes cost one, changes up to one; between ordered trees."""
    (x, lx), (y, ly) = _post_order(a), _post_order(b)
    roots = lambda left: sorted({leaf: i for i, leaf in enumerate(left)}.values())
    change = np.array([[_change(p, q) for q in y] for p in x])
    d = np.zeros((len(x), len(y)))
    for i in roots(lx):
        for j in roots(ly):
            m, n = i - lx[i] + 2, j - ly[j] + 2
            f = np.zeros((m, n))
            f[:, 0], f[0, :] = np.arange(m), np.arange(n)
            for p in range(1, m):
                u = lx[i] + p - 1
                for q in range(1, n):
                    v = ly[j] + q - 1
                    best = min(f[p - 1, q], f[p, q - 1]) + 1
                    if lx[u] == lx[i] and ly[v] == ly[j]:
                        f[p, q] = d[u, v] = min(best, f[p - 1, q - 1] + change[u, v])
                    else:
                        f[p, q] = min(best, f[lx[u] - lx[i], ly[v] - ly[j]] + d[u, v])
    return float(d[-1, -1])


def similarity(a: str | None, b: str | None) -> float | None:
    """1 for the same table, 0 where one text has no table; null if either text is null, 1 if neither has a table."""
    if a is None or b is None:
        return None
    x, y = parse_table(a), parse_table(b)
    if x is None or y is None:
        return 1.0 if x is y else 0.0
    return 1.0 - tree_distance(x, y) / max(len(_post_order(x)[0]), len(_post_order(y)[0]))


def table_similarity(a: Column, b: Column) -> Column:
    """``similarity`` over Arrow batches."""

    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        clean = lambda v: v if isinstance(v, str) else None
        return pd.Series([similarity(clean(p), clean(q)) for p, q in zip(x, y)], dtype="float64")

    return F.pandas_udf(run, "double")(a, b)
