"""From recognised blocks to one markdown text a page, and from pages to documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwright import constants as C
from leafwright.operators import tables, textguard
from leafwright.operators.sampling import numbered

#: Blocks joined in one task before the pieces of a page are put together.
PIECE = 512


def decorate(kind: Column, text: Column) -> Column:
    """A block's markdown: headings get their signs, tables become HTML, everything else stays."""
    html = tables.to_html(F.when(kind == "table", text))
    return (
        F.when(kind == "doc_title", F.concat(F.lit("# "), text))
        .when(kind.isin("paragraph_title", "figure_title"), F.concat(F.lit("## "), text))
        .when(kind == "table", html)
        .otherwise(text)
    )


def _join(df: DataFrame, keys: list[str], order: list[str], value: str, gap: str) -> DataFrame:
    items = F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("v"))))
    return df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("o"), F.array_join(F.transform(items, lambda x: x["v"]), gap).alias("v"))


def ordered_concat(df: DataFrame, key: str, order: list[str], value: str, gap: str = "\n\n", out: str = "text") -> DataFrame:
    """(key, out): the values of a group in order, joined.

    A group with very many values is joined in pieces of the leading order column first, so that no task
    sorts all of them; only finished pieces come together.
    """
    pieces = _join(df.withColumn("_p", F.floor(F.col(order[0]) / PIECE)), [key, "_p"], order, value, gap)
    whole = F.array_sort(F.collect_list(F.struct(F.col("_p"), F.col("v"))))
    return pieces.groupBy(key).agg(F.array_join(F.transform(whole, lambda x: x["v"]), gap).alias(out))


def visible_blocks(blocks: DataFrame, keep_visual: bool = False) -> DataFrame:
    """Blocks that reach the markdown, trimmed: no purely visual classes, no blank texts."""
    t = blocks.withColumn("text", F.btrim("text", F.lit(C.WHITE))).where("text <> ''")
    return t if keep_visual else t.where(~F.col("class").isin(*C.VISUAL_ONLY))


def assemble(blocks: DataFrame, keep_visual: bool = False, repair: bool = True, page: str = "page") -> DataFrame:
    """(page, markdown) of blocks (page, read_order, idx, class, text); pages without a visible block have no row."""
    b = textguard.guarded(blocks) if repair else blocks
    b = visible_blocks(b, keep_visual)
    b = b.withColumn("md", decorate(F.col("class"), F.col("text")))
    return ordered_concat(b, page, ["read_order", "idx"], "md", out="markdown")


def document(pages: DataFrame, key: str, order: list[str], text: str = "markdown") -> DataFrame:
    """Pages of a document in order, each ending its line, with an empty line between pages."""
    return ordered_concat(pages.withColumn("_t", F.concat(text, F.lit("\n"))), key, order, "_t", gap="\n", out="document")



def positions(blocks: DataFrame, page: str = "page") -> DataFrame:
    """Blocks with ``pos``, their zero-based place on the page; a page with very many blocks spreads over tasks."""
    n = numbered(blocks, page, ["read_order", "idx"])
    return n.withColumn("pos", F.col("_i").cast("int")).drop("_i", "_n")


def page_name(image: Column) -> Column:
    """The name of a page's file: the image's without its last four characters."""
    return F.substring(image, F.lit(1), F.length(image) - 4)
