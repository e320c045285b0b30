"""Problem 6: texts that were cut off.

Per source, the histograms of text lengths in characters and in bytes are tested for a spike at the
maximum: a length that very many values share while almost none are longer; and, where a limit was raised, below it. Values at a spike length without
an end mark, or the closing of their kind, are cut, whatever their last line looks like. A transfer that broke off leaves no spike; such values
are found by their ending alone: prose within a sentence, a table within a row, a formula with something
still open. Furniture of scanned pages and closing markup after the last sentence are looked past.

Defined results: null and empty texts are not cut; a title, name or number needs no end mark; a value cut
exactly after a sentence or row cannot be told from a whole one and is not reported.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafwright.session import through_disk

#: Layout classes whose texts are prose.
PROSE = ("text", "abstract", "aside_text", "content", "footnote", "vision_footnote", "vertical_text")
#: Layout classes whose texts close in their own way.
CLOSED = ("table", "display_formula", "inline_formula")
#: A length below the maximum is a limit that was given up if so much of what lies there is prose without an end mark.
OPEN_SHARE = 0.8
#: A spike holds this many values and this share of the source's at least, this many times the neighbours' mean, and at most this share lies above it.
SPIKE_LEAST, SPIKE_SHARE, SPIKE_TIMES, ABOVE_SHARE, NEIGHBOURS = 4, 0.02, 8.0, 0.01, 40

_END = r'[.!?。！？…][\s"”»“«)’\'\]）」』]*$'
_ENDED = re.compile(_END)
_CLOSING = re.compile(
    r"(?:\s*(?:</[a-zA-Z][a-zA-Z0-9]*>|<br\s*/?>|&lt;/?[a-zA-Z0-9]+/?&gt;|&#?[a-zA-Z0-9]+;|\\end\{[a-z*]+\}|\\label\{[^}]*\}|(?<=\n)%[^\n]*|```|\*\*|~~|__|''+|\{\{[^{}]*\}\}|\[\^?\d+\]|<ref[^>]*/>|\}|\*|`))+\s*$"
)
_CELLS = re.compile(r"(?:\|\}|\|[ \t]*|</table>|\\end\{tabular\}|```|\$\$|\\\])\s*$")
_PAGE = re.compile(r"^\W*(?:[Pp](?:age|ágina|\.)|[Ss]eite|[Сс]тр\w*\.?|第)?\s*\d{1,4}\s*(?:页)?(?:\s*/\s*\d{1,4})?\W*$")
_NUMBERED = re.compile(r"^\s*\d{1,4}\s{2,}\S|\S\s{2,}\d{1,4}\s*$")
_HEADLINE = re.compile(r" – |：|: |^\d+[ 、.]\s*\S")
_LOOP = re.compile(r"(\S.{0,24}?)\1{4,}.{0,24}$", re.S)
_OPERATOR = re.compile(r"(?:[=+\-*/^_,\\&{(]|\\(?:frac|sqrt|left|cdot|times|leq|geq|quad|mapsto|in|sum|int|hat|mid|log|arg|max|begin|mathbb|[a-z]?))\s*$")


def without_furniture(text: str) -> str:
    """The text up to its last line that is neither a page number nor a running header next to one."""
    lines = text.rstrip().split("\n")
    while len(lines) > 1:
        last = lines[-1].strip()
        if not last or _PAGE.match(last) or _NUMBERED.search(lines[-1]):
            lines.pop()
            continue
        before = next((x.strip() for x in reversed(lines[:-1]) if x.strip()), "")
        short = len(last) <= 60 and not _ENDED.search(last)
        if short and (_PAGE.match(before) or last.isupper() or (_HEADLINE.search(last) and _ENDED.search(before) and len(last) < 50 and not last.startswith("("))):
            lines.pop()
            continue
        break
    return "\n".join(lines).rstrip()


def prose_cut(text: str) -> bool:
    t = text.rstrip()
    if _ENDED.search(t) or _CELLS.search(t):
        return False
    t = without_furniture(t)
    for _ in range(4):
        shorter = _CLOSING.sub("", t)
        if shorter == t:
            break
        t = shorter.rstrip()
        if not t or _ENDED.search(t):
            return False
    return bool(t) and not _ENDED.search(t) and not _CELLS.search(t) and not _LOOP.search(t[-400:])


def table_cut(text: str) -> bool:
    t = text.rstrip()
    if "cel>" in t or t.startswith(("<fc", "<ec")):
        return not t.endswith("<nl>")
    if t.lower().startswith("<table"):
        return not t.lower().endswith("</table>")
    if t.startswith("{|"):
        return not t.endswith("|}")
    if t.startswith("\\begin{tabular"):
        return not t.endswith("\\end{tabular}")
    if t.startswith("|"):
        return not t.endswith("|")
    return False


def formula_cut(text: str) -> bool:
    t = text.rstrip()
    t = re.sub(r"(?:</[a-z]+>|\$+|\\\]|\\\))\s*$", "", t).rstrip()
    if t.replace("\\{", "").count("{") > t.replace("\\}", "").count("}"):
        return True
    if t.count("\\begin{") > t.count("\\end{") or len(re.findall(r"\\left\b", t)) > len(re.findall(r"\\right\b", t)):
        return True
    if _LOOP.search(t):
        return False
    return bool(_OPERATOR.search(t)) or t.count("(") > t.count(")")


def unclosed(kind: str | None, text: str) -> bool:
    """True if a text at a length limit lacks the end mark or closing of its class; a title or name of just that length was cut, a number was not."""
    if kind is None or kind in PROSE or kind not in CLOSED:
        t = text.rstrip()
        return bool(t) and any(map(str.isalpha, t)) and not _ENDED.search(t) and not _CELLS.search(t) and not _ended_in_markup(t)
    return is_cut(kind, text)


def _ended_in_markup(t: str) -> bool:
    for _ in range(4):
        shorter = _CLOSING.sub("", t)
        if shorter == t:
            return False
        t = shorter.rstrip()
        if not t or _ENDED.search(t):
            return True
    return False


def is_cut(kind: str | None, text: str) -> bool:
    """True if a text of this class stops before its end."""
    if kind is None or kind in PROSE:
        return prose_cut(text)
    if kind == "table":
        return table_cut(text)
    if kind in ("display_formula", "inline_formula"):
        return formula_cut(text)
    return False


def length_histogram(df: DataFrame, text: str = "text", source: str = "source", mark: Column | None = None) -> DataFrame:
    """(source, unit, at, n, open): how many values of a source have each length, in ``char`` and in ``byte``, and how many of them are marked."""
    lengths = df.where(F.length(text) > 0).select(F.col(source).alias("source"), F.char_length(text).alias("c"), F.octet_length(text).alias("b"), (F.lit(False) if mark is None else mark).cast("int").alias("open"))
    hist = lengths.groupBy("source", "c", "b").agg(F.count(F.lit(1)).alias("n"), F.sum("open").alias("open"))
    both = hist.select("source", "n", "open", F.explode(F.array(F.struct(F.lit("char").alias("unit"), F.col("c").alias("at")), F.struct(F.lit("byte").alias("unit"), F.col("b").alias("at")))).alias("u"))
    return both.groupBy("source", "u.unit", "u.at").agg(F.sum("n").alias("n"), F.sum("open").alias("open"))


def length_spikes(df: DataFrame, text: str = "text", source: str = "source", kind: str = "class") -> DataFrame:
    """(source, unit, at): lengths in ``char`` or ``byte`` at which a source's values were cut; a source may have several.

    The spike at the maximum has almost nothing above it. A source that raised its limit has another one below, which
    stands out from both sides and holds prose without an end mark. A limit in bytes leaves up to three bytes free
    before a wide character, so four lengths count as one.
    """
    prose = F.coalesce(F.col(kind), F.lit("text")).isin(*PROSE) if kind in df.columns else F.lit(True)
    flat = length_histogram(df, text, source, prose & ~F.col(text).rlike(_END))
    w = Window.partitionBy("source", "unit").orderBy("at")
    wide = lambda c: F.when(F.col("unit") == "byte", F.sum(c).over(w.rangeBetween(-3, 0))).otherwise(F.col(c))
    span = F.when(F.col("unit") == "byte", F.lit(4)).otherwise(F.lit(1))
    mean = lambda lo, hi: F.coalesce(F.sum("n").over(w.rangeBetween(lo, hi)), F.lit(0)) / F.lit(float(NEIGHBOURS)) * span
    rated = flat.select(
        "source",
        "unit",
        "at",
        "n",
        wide("n").alias("here"),
        wide("open").alias("open"),
        mean(-NEIGHBOURS - 4, -4).alias("below"),
        mean(1, NEIGHBOURS).alias("behind"),
        F.coalesce(F.sum("n").over(w.rangeBetween(1, Window.unboundedFollowing)), F.lit(0)).alias("above"),
        F.sum("n").over(Window.partitionBy("source", "unit")).alias("all"),
    )
    out = lambda usual: F.col("here") >= SPIKE_TIMES * F.greatest(F.col(usual), F.lit(0.25))
    spikes = rated.where((F.col("here") >= F.greatest(F.lit(SPIKE_LEAST), SPIKE_SHARE * F.col("all"))) & out("below"))
    top = F.col("above") <= ABOVE_SHARE * F.col("all")
    last = Window.partitionBy("source", "unit", "top").orderBy(F.desc("n"), F.desc("at"))
    marked = spikes.withColumn("top", top).withColumn("r", F.row_number().over(last))
    given_up = out("behind") & (F.col("open") >= OPEN_SHARE * F.col("here")) & (F.col("n") * 2 > F.col("here"))
    return marked.where((F.col("top") & (F.col("r") == 1)) | (~F.col("top") & given_up)).select("source", "unit", "at")


def cut_rows(df: DataFrame, key: str = "result_id", text: str = "text", source: str = "source", kind: str = "class") -> DataFrame:
    """(key, source, at_limit) of the rows that were cut; ``at_limit`` tells those of the histogram from those of the ending."""
    spikes = length_spikes(df, text, source, kind)
    at = lambda unit: F.collect_set(F.when(F.col("unit") == unit, F.col("at")))
    limits = spikes.groupBy("source").agg(at("char").alias("lim_c"), at("byte").alias("lim_b"))
    rows = df.where(F.length(text) > 0).select(F.col(key).alias("k"), F.col(source).alias("source"), F.col(kind).alias("cls"), F.col(text).alias("t"))
    # what ends as prose should is whole whatever its length; only the rest is looked at closely
    closed = F.coalesce("cls", F.lit("text")).isin(*CLOSED)
    placed = rows.where(closed | ~F.col("t").rlike(_END)).join(limits, "source", "left")
    b = F.octet_length("t")
    in_bytes = F.exists("lim_b", lambda lim: (b <= lim) & (b > lim - 4) & ((b == lim) | (b > F.char_length("t"))))
    at_limit = F.coalesce(F.array_contains("lim_c", F.char_length("t")) | in_bytes, F.lit(False))
    told = placed.select("k", "source", "cls", "t", at_limit.alias("at_limit"))
    # away from a limit, a title, name or number needs no end mark
    told = told.where(closed | F.coalesce("cls", F.lit("text")).isin(*PROSE) | F.col("at_limit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            keep = [(unclosed if at else is_cut)(c, t) for c, t, at in zip(*(x.column(i).to_pylist() for i in (2, 3, 4)))]
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([x.column(i).filter(mask) for i in (0, 1, 4)], ["k", "source", "at_limit"])

    types = f"k {df.schema[key].dataType.simpleString()}, source {df.schema[source].dataType.simpleString()}, at_limit boolean"
    return told.mapInArrow(run, types).withColumnRenamed("k", key)


def by_source(df: DataFrame, key: str = "result_id", text: str = "text", source: str = "source", kind: str = "class") -> DataFrame:
    """(source, n_rows, n_cut, cut_share) over all rows, those without a text included."""
    cut = through_disk(cut_rows(df, key, text, source, kind).select(key, source), "cut")
    n_cut = cut.groupBy(source).agg(F.count(F.lit(1)).alias("n_cut"))
    n_all = df.groupBy(source).agg(F.count(F.lit(1)).alias("n_rows"))
    joined = n_all.join(n_cut, n_all[source].eqNullSafe(n_cut[source]), "left").select(n_all[source].alias(source), "n_rows", F.coalesce("n_cut", F.lit(0)).cast("bigint").alias("n_cut"))
    return joined.withColumn("cut_share", F.col("n_cut") / F.col("n_rows"))
