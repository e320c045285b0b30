"""Repair of texts in which a recognizer got stuck in a loop."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwright import constants as C

#: What counts as a loop.
LOST = "�"
PHRASE, COPIES, PHRASE_LINE = 8, 5, 100
TILE_LINE, TILES = 10, 10
LINES, SAME_LINES = 10, 10


def floor(kind: Column) -> Column:
    """Texts shorter than this are never touched: tables repeat by nature."""
    return F.when(kind == "table", F.lit(C.FLOOR_TABLE)).otherwise(F.lit(C.FLOOR_TEXT))


def looping_tail(s: str, least: int = PHRASE, copies: int = COPIES) -> tuple[str, int] | None:
    """The text before the loop at the end of ``s``, and the loop's length; the longest unit that loops counts."""
    n = len(s)
    for unit in range(n // copies, least - 1, -1):
        if s[n - unit - 1] != s[-1]:  # most units fail here, without a copy
            continue
        tail = s[n - unit :]
        if not s.endswith(tail, 0, n - unit):
            continue
        k = 2
        while s.endswith(tail, 0, n - k * unit):
            k += 1
        if k >= copies:
            return s[: n - k * unit], k * unit
    return None


def tile(s: str) -> str | None:
    """The shortest unit of which ``s`` consists, if that is not ``s`` itself."""
    at = (s + s).find(s, 1)
    return s[:at] if 0 < at < len(s) else None


def truncate_content(text: str | None, least: int) -> str | None:
    """The text without its loop: before a looping phrase, one tile of a tiling, or the line that makes up nearly all lines."""
    if text is None or len(text) < least:
        return text
    s = text.strip(C.WHITE).rstrip(LOST).strip(C.WHITE)
    if not s:
        return text
    if "\n" not in s:
        if len(s) > PHRASE_LINE:
            found = looping_tail(s)
            if found and 2 * found[1] > len(s):
                return found[0]
        if len(s) > TILE_LINE:
            unit = tile(s)
            if unit and len(s) // len(unit) >= TILES:
                return unit
    lines = [x for x in (y.strip(C.WHITE) for y in text.replace("\r\n", "\n").split("\n")) if x]
    if len(lines) >= LINES:
        line, n = Counter(lines).most_common(1)[0]
        if n >= SAME_LINES and 5 * n >= 4 * len(lines):
            return line
    return text


def truncate_lines(text: str | None, least: int) -> str | None:
    """Every line without the phrase that it loops on at its end."""
    if text is None or len(text) < least:
        return text
    out = []
    for line in text.split("\n"):
        s = line.rstrip(LOST).rstrip(C.WHITE)
        found = looping_tail(s) if len(s) > PHRASE_LINE else None
        out.append(found[0] if found and 2 * found[1] > len(s) else line)
    return "\n".join(out)


def _over_long_ones(repair: Callable[[str, int], str | None], text: Column, least: Column) -> Column:
    """A repair over Arrow batches of the texts that reach the floor; the others stay in the JVM."""

    def run(t: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([repair(a, int(b)) if isinstance(a, str) else None for a, b in zip(t, n)], dtype=object)

    long = F.when(F.length(text) >= least, text)
    return F.coalesce(F.pandas_udf(run, "string")(long, least), text)


def guard(text: Column, least: Column) -> Column:
    """Both repairs, one after the other."""
    return _over_long_ones(lambda a, n: truncate_lines(truncate_content(a, n), n), text, least)


def content_guard(text: Column, least: Column) -> Column:
    return _over_long_ones(truncate_content, text, least)


def line_guard(text: Column, least: Column) -> Column:
    return _over_long_ones(truncate_lines, text, least)


def guarded(df: DataFrame, text: str = "text", kind: str = "class") -> DataFrame:
    return df.withColumn(text, guard(F.col(text), floor(F.col(kind))))


def tiling(text: Column) -> Column:
    """The shortest unit that a text of more than ten characters repeats at least ten times throughout, or null; built in."""
    unit = F.regexp_extract(text, r"(?s)^(.+?)\1{9,}$", 1)
    return F.when((F.length(text) > TILE_LINE) & (F.length(unit) > 0), unit)


def dominant_line(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, line, n, of): the line that makes up at least four fifths of a text's ten or more lines.

    At such a share no two lines can tie. Lines are counted in two steps, so a text of very many lines
    combines on the map side.
    """
    lines = df.select(key, F.explode(F.split(text, "\r?\n")).alias("line")).select(key, F.btrim("line", F.lit(C.WHITE)).alias("line")).where("line <> ''")
    counts = lines.groupBy(key, "line").agg(F.count(F.lit(1)).alias("n"))
    top = counts.groupBy(key).agg(F.max(F.struct("n", "line")).alias("m"), F.sum("n").alias("of"))
    return top.select(key, F.col("m.line").alias("line"), F.col("m.n").alias("n"), "of").where(f"of >= {LINES} and n >= {SAME_LINES} and 5 * n >= 4 * of")
