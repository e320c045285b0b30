"""Scalar column functions, and the three that SQL can call by name."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from leafwright import constants as C
from leafwright.operators import tables, textguard


def trim_white(c: Column) -> Column:
    """Trimmed by Unicode white space; Spark's own ``trim`` strips blanks only."""
    return F.btrim(c, F.lit(C.WHITE))


def strip_math_delimiters(c: Column) -> Column:
    for d in ("\\[", "\\]", "\\(", "\\)"):
        c = F.replace(c, F.lit(d), F.lit(""))
    return c


def nested_math(c: Column) -> Column:
    """An array environment together with a display or inline delimiter."""
    return F.contains(c, F.lit("begin{array}")) & (F.contains(c, F.lit("\\[")) | F.contains(c, F.lit("\\(")))


def distance(a: str, b: str) -> int:
    """The edit distance of two texts, by code points.

    A column of the table of distances is kept as two numbers of as many bits as the shorter text has characters,
    one for the steps up and one for the steps down (Myers 1999, in the form of Hyyrö 2001); a character of the
    longer text then takes a few operations on whole numbers instead of one a cell.
    """
    if a == b:
        return 0
    start = 0
    for x, y in zip(a, b):
        if x != y:
            break
        start += 1
    a, b = a[start:], b[start:]
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a)
    places: dict[str, int] = {}
    bit = 1
    for c in b:
        places[c] = places.get(c, 0) | bit
        bit <<= 1
    every, last = bit - 1, bit >> 1
    up, down, score = every, 0, len(b)
    for c in a:
        same = places.get(c, 0)
        free = same | down
        across = ((((same & up) + up) ^ up) | same) & every
        rise, fall = down | (every ^ (across | up)), up & across
        if rise & last:
            score += 1
        elif fall & last:
            score -= 1
        rise = ((rise << 1) | 1) & every
        up = ((fall << 1) & every) | (every ^ (free | rise))
        down = rise & free
    return score


def edit_distance(a: Column, b: Column) -> Column:
    """``distance`` over Arrow batches, for whole texts: Spark's own takes a step a cell. Null if either is null."""

    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([distance(p, q) if isinstance(p, str) and isinstance(q, str) else None for p, q in zip(x, y)], dtype="Int64")

    return F.pandas_udf(run, "bigint")(a, b)


def edit_distance_share(a: Column, b: Column) -> Column:
    """Edit distance as a share of the longer text; null if both are empty."""
    return F.try_divide(edit_distance(a, b), F.greatest(F.length(a), F.length(b)))


#: Marks are taken of runs of the first number of characters, the least in every second number of neighbouring runs; by kind of text.
SHORT_RUNS, LONG_RUNS = (5, 4), (16, 32)
LEAST_MARKED, LEAST_LONG = sum(SHORT_RUNS) - 1, sum(LONG_RUNS) - 1


def _span(v: np.ndarray, n: int, both) -> np.ndarray:
    """``both(left, right)`` over every ``n`` neighbours, by doubling."""
    out, done, have, reach = None, 0, v, 1
    while True:
        if n & reach:
            out = have if out is None else both(out[: len(v) - done - reach + 1], have[done : len(v) - reach + 1], reach)
            done += reach
        if done == n:
            return out
        have = both(have[: len(v) - 2 * reach + 1], have[reach:], reach)
        reach *= 2


def marks(text: str, runs: tuple[int, int]) -> np.ndarray:
    """Distinct 64-bit marks of a text: the least hash of its runs of characters in each window of neighbouring runs.

    A text within another has no mark that the other lacks, whatever the hashes are: its windows are windows of the other.
    A text shorter than a window has none.
    """
    size, window = runs
    if len(text) < size + window - 1:
        return np.empty(0, np.int64)
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = _span(c ^ (c >> np.uint64(29)), size, lambda a, b, reach: a * np.uint64((0xBF58476D1CE4E5B9 * (2 * reach + 1)) % 2**64) + b)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    low = _span(h ^ (h >> np.uint64(29)), window, lambda a, b, reach: np.minimum(a, b))
    return np.unique(low[np.append(True, low[1:] != low[:-1])]).view(np.int64)


def mark_sets(c: Column, whole: bool) -> Column:
    """``marks`` as an array. A text to be looked for has those of its kind, by length; the ``whole`` that is searched has both kinds."""

    def one(t: str) -> np.ndarray:
        if whole:
            return np.union1d(marks(t, SHORT_RUNS), marks(t, LONG_RUNS))
        return marks(t, LONG_RUNS if len(t) >= LEAST_LONG else SHORT_RUNS)

    def run(x: pd.Series) -> pd.Series:
        return pd.Series([one(t) if isinstance(t, str) else None for t in x], dtype=object)

    return F.pandas_udf(run, "array<bigint>")(c)


def register(spark: SparkSession) -> None:
    """Make ``otsl_to_html``, ``truncate_repetitive`` and ``truncate_lines`` callable from SQL."""

    def html(s: pd.Series) -> pd.Series:
        return s.map(lambda x: tables.render(x) if isinstance(x, str) else None)

    def content(t: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([textguard.truncate_content(a, int(b)) if isinstance(a, str) else None for a, b in zip(t, n)])

    def lines(t: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([textguard.truncate_lines(a, int(b)) if isinstance(a, str) else None for a, b in zip(t, n)])

    spark.udf.register("otsl_to_html", F.pandas_udf(html, "string"))
    spark.udf.register("truncate_repetitive", F.pandas_udf(content, "string"))
    spark.udf.register("truncate_lines", F.pandas_udf(lines, "string"))
