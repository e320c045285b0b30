"""Box arithmetic as column expressions.

Coordinates are FLOAT, and every intermediate result is rounded to FLOAT, so that comparisons agree with
single-precision arithmetic whatever Spark promotes a literal to.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Reads a coordinate of a box: ``at(name)`` is a column. Boxes may be plain columns or fields of a struct.
Box = Callable[[str], Column]


def box(prefix: str = "") -> Box:
    return lambda n: F.col(prefix + n)


def field(struct: Column) -> Box:
    return lambda n: struct[n]


def f32(x: Column | float) -> Column:
    return (x if isinstance(x, Column) else F.lit(x)).cast("float")


def _side(a: Column, b: Column) -> Column:
    return F.greatest(f32(b - a), f32(0.0))


def area(b: Box) -> Column:
    """Width times height; a negative side counts as 0."""
    return f32(_side(b("x0"), b("x1")) * _side(b("y0"), b("y1")))


def intersection(a: Box, b: Box) -> Column:
    w = _side(F.greatest(a("x0"), b("x0")), F.least(a("x1"), b("x1")))
    h = _side(F.greatest(a("y0"), b("y0")), F.least(a("y1"), b("y1")))
    return f32(w * h)


def area_padded(b: Box) -> Column:
    """The area with one pixel added to each side; only the suppression measures by it."""
    one = f32(1.0)
    return f32(f32(f32(b("x1") - b("x0")) + one) * f32(f32(b("y1") - b("y0")) + one))


def iou_padded(a: Box, b: Box) -> Column:
    one, zero = f32(1.0), f32(0.0)
    w = F.greatest(f32(f32(F.least(a("x1"), b("x1")) - F.greatest(a("x0"), b("x0"))) + one), zero)
    h = F.greatest(f32(f32(F.least(a("y1"), b("y1")) - F.greatest(a("y0"), b("y0"))) + one), zero)
    inter = f32(w * h)
    return f32(F.try_divide(inter, f32(f32(area_padded(a) + area_padded(b)) - inter)))


def contained(inner: Box, outer: Box, share: float = 0.9) -> Column:
    """At least ``share`` of ``inner``'s own area, which is not 0, lies in ``outer``."""
    return F.coalesce(f32(F.try_divide(intersection(inner, outer), area(inner))) >= f32(share), F.lit(False)) & (area(inner) > f32(0.0))


def overlap_small(a: Box, b: Box) -> Column:
    """The intersection as a share of the smaller area, 0 if that is 0."""
    small = F.least(area(a), area(b))
    return F.when(small == f32(0.0), f32(0.0)).otherwise(f32(F.try_divide(intersection(a, b), small)))


def iou(a: Box, b: Box) -> Column:
    """Plain intersection over union, in DOUBLE."""
    side = lambda p, q: F.greatest(q.cast("double") - p.cast("double"), F.lit(0.0))
    inter = side(F.greatest(a("x0"), b("x0")), F.least(a("x1"), b("x1"))) * side(F.greatest(a("y0"), b("y0")), F.least(a("y1"), b("y1")))
    own = lambda c: side(c("x0"), c("x1")) * side(c("y0"), c("y1"))
    return F.coalesce(F.try_divide(inter, own(a) + own(b) - inter), F.lit(0.0))


def round_even(df: DataFrame) -> DataFrame:
    """Every coordinate rounded, halves to the even neighbour."""
    return df.withColumns({c: F.rint(c).cast("float") for c in ("x0", "y0", "x1", "y1")})


def clip_to_page(df: DataFrame, width: str = "width", height: str = "height") -> DataFrame:
    """Clamped to the page and cut to whole pixels; boxes that collapse are dropped."""
    cut = lambda c: c.cast("bigint").cast("float")
    out = df.withColumns(
        {
            "x0": cut(F.greatest(F.col("x0"), f32(0.0))),
            "y0": cut(F.greatest(F.col("y0"), f32(0.0))),
            "x1": cut(F.least(F.col("x1"), F.col(width).cast("float"))),
            "y1": cut(F.least(F.col("y1"), F.col(height).cast("float"))),
        }
    )
    return out.where((F.col("x1") > F.col("x0")) & (F.col("y1") > F.col("y0")))


def crop_rectangle(df: DataFrame, width: str = "width", height: str = "height") -> DataFrame:
    """The whole-pixel rectangle (x, y, w, h) of a box: corners in any order, clamped, 1 x 1 at least; halves round up."""

    def edge(c: Column, size: str) -> Column:
        return F.round(F.least(F.greatest(c, F.lit(0.0)), F.col(size).cast("double"))).cast("int")

    x0, x1 = F.col("x0").cast("double"), F.col("x1").cast("double")
    y0, y1 = F.col("y0").cast("double"), F.col("y1").cast("double")
    left, right = edge(F.least(x0, x1), width), edge(F.greatest(x0, x1), width)
    top, bottom = edge(F.least(y0, y1), height), edge(F.greatest(y0, y1), height)
    x, y = F.least(left, F.greatest(F.col(width) - 1, F.lit(0))), F.least(top, F.greatest(F.col(height) - 1, F.lit(0)))
    return df.withColumns(
        {
            "x": x.cast("int"),
            "y": y.cast("int"),
            "w": F.greatest(F.lit(1), F.least(right - left, F.col(width) - x)).cast("int"),
            "h": F.greatest(F.lit(1), F.least(bottom - top, F.col(height) - y)).cast("int"),
        }
    )


def polygon_box(poly: Column) -> dict[str, Column]:
    """The bounding box of a polygon given as x, y, x, y, ..."""
    even, odd = F.filter(poly, lambda _, i: i % 2 == 0), F.filter(poly, lambda _, i: i % 2 == 1)
    return {"x0": F.array_min(even), "y0": F.array_min(odd), "x1": F.array_max(even), "y1": F.array_max(odd)}


def union_box(df: DataFrame, *keys: str) -> DataFrame:
    """The box around all boxes of a group."""
    return df.groupBy(*keys).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def union_cover(targets: DataFrame, boxes: DataFrame, page: str, target: str) -> DataFrame:
    """(page, target, cover): the share of each target box that the union of the page's boxes covers.

    ``targets`` has (page, target, x0..y1), ``boxes`` (page, x0..y1). The boxes cut to a target are swept by
    coordinate compression: between two neighbouring x edges, the heights of the open boxes are merged as
    intervals. All steps are grouped by target, so one crowded page spreads over its targets.
    """
    d = lambda c: F.col(c).cast("double")
    t = targets.select(page, target, *[d(c).alias("t" + c) for c in ("x0", "y0", "x1", "y1")])
    b = boxes.select(page, *[d(c).alias("b" + c) for c in ("x0", "y0", "x1", "y1")])
    cut = t.join(b, page).select(
        page,
        target,
        F.greatest("tx0", "bx0").alias("x0"),
        F.greatest("ty0", "by0").alias("y0"),
        F.least("tx1", "bx1").alias("x1"),
        F.least("ty1", "by1").alias("y1"),
    )
    cut = cut.where("x1 > x0 and y1 > y0").distinct()
    edges = cut.select(page, target, F.explode(F.array("x0", "x1")).alias("x")).distinct()
    w = Window.partitionBy(page, target).orderBy("x")
    strips = edges.withColumn("xn", F.lead("x").over(w)).where("xn is not null")
    open_ = strips.join(cut, [page, target]).where("x0 <= x and x1 >= xn")
    v = Window.partitionBy(page, target, "x").orderBy("y0", "y1").rowsBetween(Window.unboundedPreceding, -1)
    grown = open_.withColumn("reach", F.max("y1").over(v))
    part = grown.withColumn("part", (F.col("xn") - F.col("x")) * F.greatest(F.lit(0.0), F.col("y1") - F.greatest(F.col("y0"), F.coalesce("reach", F.col("y0")))))
    covered = part.groupBy(page, target).agg(F.sum("part").alias("covered"))
    full = (F.col("tx1") - F.col("tx0")) * (F.col("ty1") - F.col("ty0"))
    return t.join(covered, [page, target], "left").select(page, target, F.coalesce(F.try_divide(F.coalesce("covered", F.lit(0.0)), full), F.lit(0.0)).alias("cover"))
