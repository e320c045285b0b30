"""From raw detections to the regions of a page.

A detection is (page_id, det_idx, label, class, score, x0, y0, x1, y1, read_order); ``det_idx`` is the place in
the detector's output and breaks every tie. Pages come with ``width`` and ``height``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafwright import constants as C
from leafwright.operators import geometry as G

BOX = ("x0", "y0", "x1", "y1")


def class_name(label: Column) -> Column:
    """The class of a label, or ``?`` and the number."""
    names = F.array(*[F.lit(c) for c in C.CLASSES])
    known = F.when((label >= 0) & (label < len(C.CLASSES)), F.try_element_at(names, (label + 1).cast("int")))
    return F.coalesce(known, F.concat(F.lit("?"), label.cast("string")))


def decode(tensors: DataFrame) -> DataFrame:
    """Detections of (page_id, values array<float>, bbox_num): rows of seven values, the first ``bbox_num`` of them, labels from 0."""
    flat = tensors.select("page_id", "bbox_num", F.col("values").alias("v"), F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor(F.size("values") / 7).cast("int") - 1))).alias("det_idx"))
    get = lambda k: F.get(F.col("v"), F.col("det_idx") * 7 + k)
    rows = flat.where((F.col("det_idx") < F.col("bbox_num")) & get(0).isNotNull() & (get(0) > -1))
    label = get(0).cast("int")
    return rows.select("page_id", "det_idx", label.alias("label"), class_name(label).alias("class"), get(1).alias("score"), *[get(2 + i).alias(c) for i, c in enumerate(BOX)], get(6).cast("bigint").alias("read_order"))


def above_score(df: DataFrame, threshold: float = C.REFERENCE_SCORE) -> DataFrame:
    """Strictly above the threshold, in single precision; NaN and null scores are dropped."""
    return df.where((F.col("score") > G.f32(threshold)) & ~F.isnan("score"))


def in_reading_order(df: DataFrame) -> DataFrame:
    return df.orderBy("page_id", "read_order", "det_idx")


def drop_nested(df: DataFrame, share: float = C.NEST_SHARE, aware: bool = True, double: bool = False) -> DataFrame:
    """Without regions of which ``share`` lies in a strictly larger region of the page.

    With ``aware``, a region that never reaches the markdown absorbs nothing. ``double`` measures in DOUBLE.
    """
    cols = {c: F.col(c).cast("double") for c in BOX} if double else {}
    a = df.withColumns(cols).alias("a") if cols else df.alias("a")
    rename = ["page_id", "det_idx", "class", *BOX]
    o = df.withColumns(cols).select(*[F.col(c).alias("o_" + c) for c in rename]) if cols else df.select(*[F.col(c).alias("o_" + c) for c in rename])
    mine, other = G.box(), G.box("o_")
    if double:
        side = lambda p, q: F.greatest(q - p, F.lit(0.0))
        area = lambda b: side(b("x0"), b("x1")) * side(b("y0"), b("y1"))
        inter = side(F.greatest(mine("x0"), other("x0")), F.least(mine("x1"), other("x1"))) * side(F.greatest(mine("y0"), other("y0")), F.least(mine("y1"), other("y1")))
        inside = F.coalesce(F.try_divide(inter, area(mine)) >= F.lit(share), F.lit(False))
        larger = (area(mine) > 0) & (area(other) > area(mine))
    else:
        inside = F.coalesce(G.f32(F.try_divide(G.intersection(mine, other), G.area(mine))) >= G.f32(share), F.lit(False))
        larger = (G.area(mine) > G.f32(0.0)) & (G.area(other) > G.area(mine))
    cond = (F.col("page_id") == F.col("o_page_id")) & (F.col("det_idx") != F.col("o_det_idx")) & larger & inside
    if aware:
        cond = cond & ~F.coalesce(F.col("o_class").isin(*C.VISUAL_ONLY), F.lit(False))
    return a.join(o, cond, "left_anti")


def worst_nested(df: DataFrame, k: int) -> DataFrame:
    """(page_id, n_nested): the ``k`` pages with the most regions that ``drop_nested`` drops, ties by page."""
    every = df.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))
    kept = drop_nested(df).groupBy(F.col("page_id").alias("_p")).agg(F.count(F.lit(1)).alias("_k"))
    counts = every.join(kept, F.col("page_id") == F.col("_p"), "left").select("page_id", (F.col("n") - F.coalesce("_k", F.lit(0))).alias("n_nested"))
    return counts.where("n_nested > 0").orderBy(F.desc("n_nested"), "page_id").limit(k)


def merge_large(df: DataFrame) -> DataFrame:
    """Without regions that lie to 90 % in a region of an absorbing class; all against the same set, so nothing cascades."""
    o = df.where(F.col("class").isin(*C.MERGE_LARGE)).select(*[F.col(c).alias("o_" + c) for c in ("page_id", "det_idx", *BOX)])
    cond = (F.col("page_id") == F.col("o_page_id")) & (F.col("det_idx") != F.col("o_det_idx")) & G.contained(G.box(), G.box("o_"), C.MERGE_SHARE)
    return df.join(o, cond, "left_anti")


def drop_page_sized_image(df: DataFrame, width: str = "width", height: str = "height") -> DataFrame:
    """Without images that cover nearly the page, unless nothing else would be left or there is one region only."""
    w, h = F.col(width).cast("float"), F.col(height).cast("float")
    share = F.when(w > h, G.f32(C.PAGE_SHARE_WIDE)).otherwise(G.f32(C.PAGE_SHARE_TALL))
    limit = G.f32(G.f32(share * w) * h)
    clipped = G.f32(G.f32(F.least("x1", w) - F.greatest(F.col("x0"), G.f32(0.0))) * G.f32(F.least("y1", h) - F.greatest(F.col("y0"), G.f32(0.0))))
    keep = (F.coalesce(F.col("class"), F.lit("")) != "image") | (clipped <= limit)
    page = Window.partitionBy("page_id")
    marked = df.withColumn("_keep", keep).withColumn("_n", F.count(F.lit(1)).over(page)).withColumn("_any", F.bool_or("_keep").over(page))
    return marked.where(F.col("_keep") | (F.col("_n") <= 1) | ~F.col("_any")).drop("_keep", "_n", "_any")


def _entry(df: DataFrame) -> Column:
    """A region as a struct that sorts by descending score, then by place."""
    return F.struct((-F.col("score")).alias("rank"), "det_idx", *[c for c in df.columns if c not in ("page_id", "det_idx")])


def _suppress(sorted_regions: Column) -> Column:
    """Fold over regions by score: one stays unless a region that stayed covers it too closely."""

    def step(kept: Column, x: Column) -> Column:
        def close(k: Column) -> Column:
            limit = F.when(k["label"] == x["label"], G.f32(C.IOU_SAME)).otherwise(G.f32(C.IOU_OTHER))
            return F.coalesce(G.iou_padded(G.field(x), G.field(k)) >= limit, F.lit(False))

        return F.when(F.exists(kept, close), kept).otherwise(F.concat(kept, F.array(x)))

    return F.aggregate(sorted_regions, F.slice(sorted_regions, 1, 0), step)


def suppress(df: DataFrame) -> DataFrame:
    """Non-maximum suppression per page, by descending score."""
    pages = df.where(~F.isnan("score")).groupBy("page_id").agg(F.array_sort(F.collect_list(_entry(df))).alias("r"))
    return pages.select("page_id", F.explode(_suppress(F.col("r"))).alias("x")).select("page_id", *[F.col("x")[c].alias(c) for c in df.columns if c != "page_id"])


def overlap_survivors(boxes: np.ndarray, classes: list[str]) -> np.ndarray:
    """Which boxes of one page stay, given in reading order and without ``reference``.

    Pairs are visited in order; a box that was dropped takes part no more, and a sliver is dropped only
    when its own turn comes, so it may still drop a box before it.
    """
    n = len(boxes)
    gone = np.zeros(n, bool)
    if not n:
        return ~gone
    b = boxes.astype(np.float32)
    w, h = b[:, 2] - b[:, 0], b[:, 3] - b[:, 1]
    size = np.maximum(w, 0) * np.maximum(h, 0)
    formula = np.array([c == "inline_formula" for c in classes])
    picture = np.array([c in C.PICTORIAL for c in classes])
    for i in range(n):
        if w[i] < C.SLIVER or h[i] < C.SLIVER:
            gone[i] = True
        if gone[i] or i + 1 == n:
            continue
        rest = slice(i + 1, n)
        inter = np.maximum(np.minimum(b[rest, 2], b[i, 2]) - np.maximum(b[rest, 0], b[i, 0]), np.float32(0)) * np.maximum(np.minimum(b[rest, 3], b[i, 3]) - np.maximum(b[rest, 1], b[i, 1]), np.float32(0))
        small = np.minimum(size[rest], size[i])
        ratio = np.divide(inter, small, out=np.zeros_like(inter), where=small != 0)
        for k in np.nonzero(ratio > np.float32(C.OVERLAP_FORMULA))[0]:
            j = i + 1 + int(k)
            if gone[j]:
                continue
            if formula[i] or formula[j]:
                gone[j] |= formula[j]
                gone[i] |= formula[i]
            elif ratio[k] > np.float32(C.OVERLAP_OTHER):
                both = picture[i] and picture[j]
                table = "table" in (classes[i], classes[j])
                if (picture[i] or picture[j]) and classes[i] != classes[j] and (both or not table):
                    continue  # a caption on a picture
                gone[j if size[i] >= size[j] else i] = True
            if gone[i]:
                break
    return ~gone


def _filter_pages(pages: DataFrame, schema) -> DataFrame:
    """The overlap filter over pages collected as sorted arrays of regions; many pages go through Python at a time."""
    names = [f.name for f in schema]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            page, index, keep = [], [], []
            for p, regions in zip(b["page_id"], b["r"]):
                rs = [r for r in regions if r["class"] != "reference"]
                if rs:
                    stay = overlap_survivors(np.array([[r[c] for c in BOX] for r in rs], np.float32), [r["class"] or "" for r in rs])
                    page += [p] * int(stay.sum())
                    keep += [rs[i] for i in np.nonzero(stay)[0]]
            out = pd.DataFrame({n: [k[n] for k in keep] for n in names if n != "page_id"})
            out.insert(0, "page_id", page)
            yield out[names]

    return pages.mapInPandas(run, schema)


def _ordered(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c not in ("page_id", "read_order", "det_idx")]
    return df.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("read_order", "det_idx", *rest))).alias("r"))


def filter_boxes(df: DataFrame) -> DataFrame:
    """Without reference containers, slivers and overlapping duplicates; order-sensitive, per page in reading order."""
    return _filter_pages(_ordered(df), df.schema)


def postprocess(df: DataFrame, width: str = "width", height: str = "height") -> DataFrame:
    """The whole reference sequence with one shuffle: pages are collected once and stay arrays until the end.

    Round, score, suppress, drop a page-sized image, merge into large classes, order, clip, filter overlaps.
    ``width`` and ``height`` are columns of ``df``, the same for all rows of a page.
    """
    rows = above_score(G.round_even(df), C.REFERENCE_SCORE)
    keep = [c for c in df.columns if c != "page_id"]
    pages = rows.groupBy("page_id").agg(F.array_sort(F.collect_list(_entry(df))).alias("r"), F.max(width).cast("float").alias("pw"), F.max(height).cast("float").alias("ph"))
    pages = pages.withColumn("r", _suppress(F.col("r")))
    w, h = F.col("pw"), F.col("ph")
    limit = G.f32(G.f32(F.when(w > h, G.f32(C.PAGE_SHARE_WIDE)).otherwise(G.f32(C.PAGE_SHARE_TALL)) * w) * h)

    def not_page(x: Column) -> Column:
        size = G.f32(G.f32(F.least(x["x1"], w) - F.greatest(x["x0"], G.f32(0.0))) * G.f32(F.least(x["y1"], h) - F.greatest(x["y0"], G.f32(0.0))))
        return (x["class"] != "image") | (size <= limit)

    pages = pages.withColumn("few", F.filter("r", not_page))
    pages = pages.withColumn("r", F.when((F.size("r") > 1) & (F.size("few") > 0), F.col("few")).otherwise(F.col("r")))
    pages = pages.withColumn("big", F.filter("r", lambda x: x["class"].isin(*C.MERGE_LARGE)))
    pages = pages.withColumn("r", F.filter("r", lambda x: ~F.exists("big", lambda o: (o["det_idx"] != x["det_idx"]) & G.contained(G.field(x), G.field(o), C.MERGE_SHARE))))
    cut = lambda c: c.cast("bigint").cast("float")

    def clipped(x: Column) -> Column:
        new = {"x0": cut(F.greatest(x["x0"], G.f32(0.0))), "y0": cut(F.greatest(x["y0"], G.f32(0.0))), "x1": cut(F.least(x["x1"], w)), "y1": cut(F.least(x["y1"], h))}
        first = [x["read_order"].alias("read_order"), x["det_idx"].alias("det_idx")]
        return F.struct(*first, *[(new.get(c, x[c])).alias(c) for c in keep if c not in ("read_order", "det_idx")])

    pages = pages.select("page_id", F.array_sort(F.filter(F.transform("r", clipped), lambda x: (x["x1"] > x["x0"]) & (x["y1"] > x["y0"]))).alias("r"))
    return _filter_pages(pages, df.schema)


def raw_postprocess(df: DataFrame, keep_nested: bool = False) -> DataFrame:
    """The detector's own output: score, then without nested regions unless they are wanted."""
    rows = above_score(df, C.RAW_SCORE)
    return rows if keep_nested else drop_nested(rows)


def regions(df: DataFrame, mode: str = "reference", keep_nested: bool = False) -> DataFrame:
    """``reference`` or ``raw`` post-processing."""
    if mode not in ("reference", "raw"):
        raise ValueError(f"mode is {mode!r}, not 'reference' or 'raw'")
    return postprocess(df) if mode == "reference" else raw_postprocess(df, keep_nested)
