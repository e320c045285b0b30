import itertools
import random
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from leafwright.operators import tablescore as T


def tree(rng, depth=0):
    node = T.Node(rng.choice(["tr", "td"]), rng.choice("12"))
    node.text = rng.choice(["", "ab", "abc"]) if node.tag == "td" else ""
    node.children = [tree(rng, depth + 1) for _ in range(rng.randrange(0, 3 if depth < 2 else 1))]
    return node


def plain(a, b):
    """The recursion over forests, as the definition has it."""

    def size(f):
        return sum(1 + size(tuple(n.children)) for n in f)

    @lru_cache(maxsize=None)
    def d(f, g):
        if not f or not g:
            return float(size(f) + size(g))
        x, y = f[-1], g[-1]
        return min(
            d(f[:-1] + tuple(x.children), g) + 1,
            d(f, g[:-1] + tuple(y.children)) + 1,
            d(f[:-1], g[:-1]) + d(tuple(x.children), tuple(y.children)) + T._change(x, y),
        )

    return d((a,), (b,))


def test_tree_distance_agrees_with_the_definition():
    rng = random.Random(4)
    trees = [tree(rng) for _ in range(14)]
    for a, b in itertools.product(trees, trees):
        assert T.tree_distance(a, b) == pytest.approx(plain(a, b))


def test_similarity(spark):
    one = "<table><tr><td>river</td><td>4</td></tr><tr><td>lake</td><td>7</td></tr></table>"
    cases = [
        (one, one, 1.0),
        (one, one.replace("<td>4", "<td><b>4</b>"), 1.0),
        (one, one.replace("7", "8"), 1 - 1 / 7),
        (one, one.replace("river", "rivet"), 1 - 0.2 / 7),
        (one, one.replace("<td>7</td>", ""), 1 - 1 / 7),
        (one, one.replace("<td>4", '<td colspan="2">4'), 1 - 1 / 7),
        (one, one.replace("</td>", "").replace("</tr>", ""), 1.0),
        (one, "no table", 0.0),
        ("x", "y", 1.0),
        ("", one, 0.0),
        (None, one, None),
    ]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], "i int, a string, b string")
    got = {r.i: r.s for r in df.select("i", T.table_similarity(F.col("a"), F.col("b")).alias("s")).collect()}
    assert got == {i: pytest.approx(s) if s is not None else None for i, (_, _, s) in enumerate(cases)}
