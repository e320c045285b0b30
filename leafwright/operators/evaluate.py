"""Evaluation of recognised pages: edit reductions, error buckets and causes, slices, coverage, timings.

A sample is (img_id, norm_gt, norm_pred, edit_num, upper_len); whatever identifies it besides stays in place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType

from leafwright import constants as C
from leafwright.functions.scalars import LEAST_MARKED, mark_sets
from leafwright.operators.sampling import numbered
from leafwright.session import through_disk

#: The bars between causes, and their names.
SHORT, LONG, SAME_BOX, COVER_OK, EMPTY_IOU = 0.9, 1.1, 0.7, 0.7, 0.5
INSIDE, SWALLOW, SWALLOW_AREA = 0.5, 0.8, 1.5
LAYOUT_CAUSES = ("LAYOUT_MISS", "LAYOUT_SPLIT", "LAYOUT_MERGE", "LAYOUT_PARTIAL")
RECOGNITION_CAUSES = ("RECOG_EMPTY", "RECOG_SHORT", "RECOG_LONG", "RECOG_SUBST")

#: A page is heavy beyond so many samples; its chunks have so many characters at least, and its blocks so many places.
HEAVY, CHUNK, BLOCK = 128, 1 << 17, 512


def share(edit: Column, upper: Column) -> Column:
    return F.coalesce(F.try_divide(edit.cast("double"), upper.cast("double")), F.lit(0.0))


def edit_reductions(samples: DataFrame, *by: str, page: str = "img_id") -> DataFrame:
    """(by, n, n_pages, edit_whole, edit_sample_avg, page_avg): the three reductions of the edit distance.

    The ratio of sums, the mean over samples, and the mean over pages of each page's mean. Sums and counts
    are made per page first, so the second grouping sees one row a page.
    """
    s = samples.withColumn("_r", share(F.col("edit_num"), F.col("upper_len")))
    pages = s.groupBy(*by, page).agg(F.sum("edit_num").alias("e"), F.sum("upper_len").alias("u"), F.sum("_r").alias("r"), F.count(F.lit(1)).alias("c"))
    return pages.groupBy(*by).agg(
        F.sum("c").alias("n"),
        F.count(F.lit(1)).alias("n_pages"),
        share(F.sum("e"), F.sum("u")).alias("edit_whole"),
        (F.sum("r") / F.sum("c")).alias("edit_sample_avg"),
        F.avg(F.col("r") / F.col("c")).alias("page_avg"),
    )


def attribute_slices(pages: DataFrame, attributes: dict[str, Column], value: str, page: str = "img_id") -> DataFrame:
    """(attribute, slice, n_pages, page_avg): a mean for every value of every attribute.

    An attribute is an array; a page counts in each of its values, and in ``None`` if it has none.
    """

    def named(name: str, c: Column) -> Column:
        return F.transform(F.when(F.size(c) > 0, c).otherwise(F.array(F.lit("None"))), lambda v: F.struct(F.lit(name).alias("attribute"), v.alias("slice")))

    pairs = [named(n, c) for n, c in attributes.items()]
    flat = pages.select(page, value, F.explode(reduce(F.concat, pairs)).alias("a"))
    return flat.groupBy(F.col("a.attribute").alias("attribute"), F.col("a.slice").alias("slice")).agg(F.count(F.lit(1)).alias("n_pages"), F.avg(value).alias("page_avg"))


def overall(text_edit: Column, table_score: Column, formula_score: Column) -> Column:
    """The headline score: text as 1 - edit, all three in percent, averaged."""
    return ((F.lit(1.0) - text_edit) * 100 + table_score + formula_score) / 3


def overall_proxy(text_edit: Column, table_score: Column, formula_edit: Column) -> Column:
    """The same with the formula's edit distance in place of its score."""
    return overall(text_edit, table_score, (F.lit(1.0) - formula_edit) * 100)


def overall_bound(text_edit: Column, table_score: Column) -> Column:
    """What the score could be at most: with perfect formulas."""
    return overall(text_edit, table_score, F.lit(100.0))


def bucket() -> Column:
    """MISS, SPURIOUS, EXACT or RECOG, in this order."""
    gt, pred = F.length(F.coalesce("norm_gt", F.lit(""))) > 0, F.length(F.coalesce("norm_pred", F.lit(""))) > 0
    return F.when(gt & ~pred, "MISS").when(pred & ~gt, "SPURIOUS").when(F.col("edit_num") == 0, "EXACT").otherwise("RECOG")


def error_budget(samples: DataFrame) -> DataFrame:
    """(bucket, n, edits, chars, contribution, share): how the edits divide; contributions add up to the whole."""
    b = samples.groupBy(bucket().alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.sum("edit_num").alias("edits"), F.sum("upper_len").alias("chars"))
    everything = Window.partitionBy()  # over four rows
    return b.select(
        "bucket",
        "n",
        "edits",
        "chars",
        share(F.col("edits"), F.sum("chars").over(everything)).alias("contribution"),
        share(F.col("edits"), F.sum("edits").over(everything)).alias("share"),
    )


def positions(c: Column, kind: DataType) -> Column:
    """Annotation numbers as a set: from one number, a list of them, or JSON text of either; anything else has none."""
    if isinstance(kind, ArrayType):
        return F.array_distinct(F.array_compact(c.cast("array<int>")))
    if isinstance(kind, StringType):
        c = F.coalesce(F.from_json(c, "array<int>"), F.array(c.try_cast("int")))
        return F.array_distinct(F.array_compact(c))
    return F.array_compact(F.array(c.cast("int")))


def locate(samples: DataFrame, annotations: DataFrame) -> DataFrame:
    """Samples with the box around their annotations, null where none can be found.

    ``samples`` has (page_id, sample_id, gt_position: a number, a list or JSON text of either), ``annotations`` (page_id, ord, category,
    ignore, x0..y1). Only text categories that are not to be ignored count; ``category`` is the first one's.
    """
    wanted = samples.select("page_id", "sample_id", F.explode(positions(F.col("gt_position"), samples.schema["gt_position"].dataType)).alias("ord"))
    texts = annotations.where(F.col("category").isin(*C.TEXT_CATEGORIES) & ~F.coalesce("ignore", F.lit(False)))
    met = wanted.join(texts, ["page_id", "ord"])
    boxes = met.groupBy("page_id", "sample_id").agg(
        F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.min_by("category", "ord").alias("category")
    )
    return samples.join(boxes, ["page_id", "sample_id"], "left")


def causes(located: DataFrame, boxes: DataFrame) -> DataFrame:
    """Located samples with ``cause``: what the page's boxes say about where the edits come from.

    One join on the page with partial aggregates per sample; samples that cannot be located, or whose page
    has no boxes, are ``unlocatable`` and not guessed at.
    """
    d = lambda c: F.col(c).cast("double")
    o = boxes.select("page_id", *[d(c).alias("b_" + c) for c in ("x0", "y0", "x1", "y1")])
    g = located.where("x0 is not null").select("page_id", "sample_id", *[d(c).alias(c) for c in ("x0", "y0", "x1", "y1")])
    side = lambda p, q: F.greatest(q - p, F.lit(0.0))
    ga = side(F.col("x0"), F.col("x1")) * side(F.col("y0"), F.col("y1"))
    ba = side(F.col("b_x0"), F.col("b_x1")) * side(F.col("b_y0"), F.col("b_y1"))
    inter = side(F.greatest("x0", "b_x0"), F.least("x1", "b_x1")) * side(F.greatest("y0", "b_y0"), F.least("y1", "b_y1"))
    inside = (ba > 0) & (F.coalesce(F.try_divide(inter, ba), F.lit(0.0)) >= INSIDE)
    of_gt = F.coalesce(F.try_divide(inter, ga), F.lit(0.0))
    stats = g.join(o, "page_id").groupBy("page_id", "sample_id").agg(
        F.max(F.coalesce(F.try_divide(inter, ga + ba - inter), F.lit(0.0))).alias("best"),
        F.count_if(inside).alias("n_inside"),
        F.sum(F.when(inside, of_gt).otherwise(0.0)).alias("cover"),
        F.bool_or((ga > 0) & (of_gt >= SWALLOW) & (ba >= SWALLOW_AREA * ga)).alias("swallowed"),
    )
    r = F.try_divide(F.length("norm_pred").cast("double"), F.length("norm_gt").cast("double"))
    cause = (
        F.when(F.col("best").isNull(), "unlocatable")
        .when(bucket() == "MISS", F.when((F.col("best") >= EMPTY_IOU) | (F.col("cover") >= COVER_OK), "RECOG_EMPTY").otherwise("LAYOUT_MISS"))
        .when(F.col("best") >= SAME_BOX, F.when(r < SHORT, "RECOG_SHORT").when(r > LONG, "RECOG_LONG").otherwise("RECOG_SUBST"))
        .when((F.col("cover") >= COVER_OK) & (F.col("n_inside") >= 2), "LAYOUT_SPLIT")
        .when(F.col("swallowed"), "LAYOUT_MERGE")
        .when(F.col("cover") < COVER_OK, "LAYOUT_PARTIAL")
        .otherwise("OTHER")
    )
    return located.join(stats, ["page_id", "sample_id"], "left").withColumn("cause", cause)


def cause_rollup(caused: DataFrame) -> DataFrame:
    """(side, cause, n, edits): per cause, with sums per side and over all as null rows."""
    side = F.when(F.col("cause").isin(*LAYOUT_CAUSES), "layout").when(F.col("cause").isin(*RECOGNITION_CAUSES), "recognition").otherwise("other")
    return caused.withColumn("side", side).rollup("side", "cause").agg(F.count(F.lit(1)).alias("n"), F.sum("edit_num").alias("edits"))


def side_ratio(caused: DataFrame) -> DataFrame:
    """(layout_edits, recognition_edits, layout_share, recognition_share, ratio) of all edits; no ratio without recognition edits."""
    of = lambda names: F.sum(F.when(F.col("cause").isin(*names), F.col("edit_num")).otherwise(0))
    t = caused.agg(of(LAYOUT_CAUSES).alias("layout_edits"), of(RECOGNITION_CAUSES).alias("recognition_edits"), F.sum("edit_num").alias("_all"))
    over = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    return t.select("layout_edits", "recognition_edits", over("layout_edits", "_all").alias("layout_share"), over("recognition_edits", "_all").alias("recognition_share"), over("layout_edits", "recognition_edits").alias("ratio"))


def top_per_group(counts: DataFrame, group: str, item: str, n: str, k: int = 3) -> DataFrame:
    """The ``k`` most frequent items of each group, ties by name."""
    w = Window.partitionBy(group).orderBy(F.desc(n), item)
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def recoverable(samples: DataFrame, order: str, least: int = 8, gap: str = " ", heavy: int = HEAVY) -> DataFrame:
    """Samples with ``found``: their text stands literally somewhere in the page's whole prediction.

    The prediction is that of the page's samples along ``order``, joined by ``gap``. In pages of up to ``heavy``
    samples it is searched for text by text; the others go as ``_found_in_chunks`` says. Every column of the samples
    is kept. They are written first, as an edit distance would be taken again by each of the steps, and twice where it is filtered.
    """
    if least < LEAST_MARKED:
        raise ValueError(f"texts of fewer than {LEAST_MARKED} characters have no marks")
    wanted = (F.col("edit_num") > 0) & (F.length("norm_gt") >= least)
    samples = through_disk(samples.where("img_id is not null"), "samples")
    pages = through_disk(samples.groupBy("img_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > heavy).select("img_id"), "heavy-pages")
    some = not pages.isEmpty()
    light = samples.join(pages, "img_id", "left_anti") if some else samples
    rest = [c for c in samples.columns if c not in (order, "norm_pred", "img_id")]
    light = light.groupBy("img_id").agg(F.array_sort(F.collect_list(F.struct(F.col(order), "norm_pred", *rest))).alias("_s"))
    preds = F.array_compact(F.transform("_s", lambda x: x["norm_pred"]))
    out = light.withColumn("_page", F.array_join(preds, gap)).select("img_id", F.explode(F.transform("_s", lambda x: F.struct(x.alias("s"), F.contains("_page", x["norm_gt"]).alias("found")))).alias("x"))
    out = out.select("img_id", "x.s.*", "x.found").where(wanted)
    if some:
        own = through_disk(samples.join(pages, "img_id", "left_semi"), "heavy-rows")
        found = _found_in_chunks(own, order, least, gap).withColumn("found", F.lit(True))
        met = own.where(wanted).withColumn("_id", _id()).join(found, ["img_id", "_id"], "left").drop("_id")
        out = out.unionByName(met.withColumn("found", F.coalesce("found", F.lit(False))))
    return out.select(*samples.columns, "found")


def _id() -> Column:
    return F.sha2("norm_gt", 256)


def _found_in_chunks(own: DataFrame, order: str, least: int, gap: str) -> DataFrame:
    """(img_id, _id): the texts that stand in the prediction of pages where a search text by text would take the square of the size.

    The prediction is cut into chunks that overlap by the page's longest text, so that a text that is found lies
    within one. Text and chunk are described by their marks (``marks``), and a chunk has all marks of what lies in
    it. So a text with a mark that no chunk has is not there, and any other is searched for only in the chunks with
    its rarest mark: in the first of these, and in the rest if that was not it.
    """
    texts = own.where(F.length("norm_gt") >= least).select("img_id", "norm_gt").distinct().withColumn("_id", _id())
    pages = own.groupBy("img_id").agg(F.max(F.coalesce(F.length("norm_gt"), F.lit(0))).alias("_longest"))
    parts = own.where("norm_pred is not null").select("img_id", F.floor(F.col(order) / BLOCK).alias("_b"), order, F.concat(F.lit(gap), "norm_pred").alias("t"))
    # where each part begins: sums of blocks, then sums within blocks, so that no task has all parts of a page
    sums = parts.groupBy("img_id", "_b").agg(F.sum(F.length("t")).alias("_sum"))
    before = sums.select("img_id", "_b", (F.sum("_sum").over(Window.partitionBy("img_id").orderBy("_b")) - F.col("_sum")).alias("_before"))
    within = Window.partitionBy("img_id", "_b").orderBy(order, "t").rowsBetween(Window.unboundedPreceding, 0)
    placed = parts.withColumn("_end", F.sum(F.length("t")).over(within)).join(before, ["img_id", "_b"])
    placed = placed.select("img_id", "t", (F.col("_before") + F.col("_end") - F.length("t")).alias("_at"))
    placed = placed.withColumn("t", F.when(F.col("_at") == 0, F.substr("t", F.lit(len(gap) + 1))).otherwise(F.col("t"))).withColumn("_at", F.when(F.col("_at") == 0, F.lit(len(gap))).otherwise(F.col("_at")))
    placed = placed.join(pages.select("img_id", F.greatest(F.lit(CHUNK), "_longest").alias("_step"), "_longest"), "img_id").where("t <> ''")
    first = F.greatest(F.lit(0), F.floor((F.col("_at") - F.col("_longest")) / F.col("_step")))
    last = F.floor((F.col("_at") + F.length("t") - 1) / F.col("_step"))
    cut = placed.withColumn("_chunk", F.explode(F.sequence(first, last))).withColumn("_from", F.col("_chunk") * F.col("_step"))
    skip = F.greatest(F.lit(0), F.col("_from") - F.col("_at"))
    size = F.least(F.length("t"), F.col("_from") + F.col("_step") + F.col("_longest") - F.col("_at")) - skip
    cut = cut.where(size > 0).select("img_id", "_chunk", F.struct("_at", F.substr("t", (skip + 1).cast("int"), size.cast("int")).alias("t")).alias("x"))
    chunks = cut.groupBy("img_id", "_chunk").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), "").alias("t"))
    chunks = through_disk(chunks.withColumn("m", mark_sets(F.col("t"), True)), "heavy-chunks")

    held = chunks.select("img_id", "_chunk", F.explode("m").alias("m"))
    often = held.groupBy("img_id", "m").agg(F.count(F.lit(1)).alias("n"))
    asked = texts.select("img_id", "_id", F.explode(mark_sets(F.col("norm_gt"), False)).alias("m")).join(often, ["img_id", "m"], "left")
    rarest = asked.groupBy("img_id", "_id").agg(F.min_by("m", "n").alias("m"), F.count_if(F.col("n").isNull()).alias("_none")).where("_none = 0")
    at = through_disk(rarest.join(held, ["img_id", "m"]).select("img_id", "_id", "_chunk"), "heavy-places")

    def there(places: DataFrame) -> DataFrame:
        asked = places.join(texts, ["img_id", "_id"]).join(chunks.select("img_id", "_chunk", "t"), ["img_id", "_chunk"])
        return asked.where(F.contains("t", "norm_gt")).select("img_id", "_id").distinct()

    firsts = at.groupBy("img_id", "_id").agg(F.min("_chunk").alias("_chunk"))
    sure = through_disk(there(firsts), "heavy-found")
    rest = at.join(firsts, ["img_id", "_id", "_chunk"], "left_anti").join(sure, ["img_id", "_id"], "left_anti")
    return sure.unionByName(there(rest))


def medians(df: DataFrame, group: str, values: dict[str, str]) -> DataFrame:
    """(group, n, one column per value): exact medians, the mean of the middle two for an even count.

    ``values`` maps names to columns without nulls in common rows. Spark's own exact median keeps every
    distinct value of a group in one task; here rows are ranked in sorted ranges, so that a group of any size
    spreads out and only its middle rows come together.
    """
    out = None
    for name, column in values.items():
        rows = df.where(F.col(column).isNotNull()).select(group, F.col(column).alias("_v"), F.monotonically_increasing_id().alias("_t"))
        ranked = numbered(rows, group, ["_v", "_t"])  # the second column lets very many equal values spread out
        middle = ranked.where((F.col("_i") == F.floor((F.col("_n") - 1) / 2)) | (F.col("_i") == F.floor(F.col("_n") / 2)))
        m = middle.groupBy(group).agg(F.max("_n").alias("n"), F.avg("_v").alias(name))
        out = m if out is None else out.join(m.drop("n").withColumnRenamed(group, "_g"), F.col(group).eqNullSafe(F.col("_g"))).drop("_g")
    return out


def crop_bucket(crops: Column) -> Column:
    out = F.lit(None).cast("string")
    for lo, hi in C.CROP_BUCKETS:
        out = F.when(crops.between(lo, hi), F.lit(f"{lo}-{hi}")).otherwise(out)
    return out


def stage_medians(timings: DataFrame) -> DataFrame:
    """(stage, n, median, lowest, highest) of the three stages and of their sum; exact, interpolating medians."""
    t = timings.withColumn("total_s", F.col("layout_s") + F.col("recognize_s") + F.col("assemble_s"))
    stages = ["layout_s", "recognize_s", "assemble_s", "total_s"]
    flat = t.select(F.explode(F.array(*[F.struct(F.lit(s[:-2]).alias("stage"), F.col(s).alias("s")) for s in stages])).alias("x")).select("x.stage", "x.s")
    ends = flat.groupBy("stage").agg(F.min("s").alias("lowest"), F.max("s").alias("highest"))
    return medians(flat, "stage", {"median": "s"}).join(ends, "stage").select("stage", "n", "median", "lowest", "highest")


def paired_timings(first: DataFrame, second: DataFrame, add: float = C.LAYOUT_ADD_BACK) -> DataFrame:
    """(stem, crops, first_s, second_s): pages timed in both, with what the second inherits for free added."""
    total = F.col("layout_s") + F.col("recognize_s") + F.col("assemble_s")
    a = first.select("stem", total.alias("first_s"))
    b = second.select("stem", "crops", (F.col("recognize_s") + F.lit(add)).alias("second_s"))
    return a.join(b, "stem").select("stem", "crops", "first_s", "second_s")


def bucket_medians(paired: DataFrame) -> DataFrame:
    """(bucket, n, first, second, ratio) per range of crops, and ``ALL``, which holds those outside the ranges too."""
    both = paired.select("first_s", "second_s", F.explode(F.array_compact(F.array(crop_bucket(F.col("crops")), F.lit("ALL")))).alias("bucket"))
    m = medians(both, "bucket", {"first": "first_s", "second": "second_s"})
    return m.withColumn("ratio", F.try_divide(F.col("first"), F.col("second")))


def line_fit(df: DataFrame, y: str, x: str) -> DataFrame:
    """Slope and intercept of the least-squares line."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_count(y, x).alias("n"))


def per_crop_seconds(timings: DataFrame) -> DataFrame:
    """The median recognition time of a crop over pages that have any."""
    each = timings.where("crops > 0").select(F.lit("all").alias("g"), (F.col("recognize_s") / F.col("crops")).alias("s"))
    return medians(each, "g", {"per_crop_s": "s"}).select("per_crop_s", "n")


def visual_drop(blocks: DataFrame) -> DataFrame:
    """(page, n_dropped, chars_dropped, chars_kept): what assembly leaves out of each page."""
    visual = F.col("class").isin(*C.VISUAL_ONLY)
    size = F.length(F.btrim("text", F.lit(C.WHITE)))
    return blocks.groupBy("page").agg(
        F.count_if(visual).alias("n_dropped"), F.sum(F.when(visual, size).otherwise(0)).alias("chars_dropped"), F.sum(F.when(visual, 0).otherwise(size)).alias("chars_kept")
    )


def visual_drop_classes(blocks: DataFrame) -> DataFrame:
    """(class, regions, chars) of the dropped classes."""
    size = F.length(F.btrim("text", F.lit(C.WHITE)))
    return blocks.where(F.col("class").isin(*C.VISUAL_ONLY)).groupBy("class").agg(F.count(F.lit(1)).alias("regions"), F.sum(size).alias("chars"))


def mean_delta(a: DataFrame, b: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(n, mean_a, mean_b, delta) of a measure over what two arms share."""
    m = a.select(*keys, F.col(value).alias("_a")).join(b.select(*keys, F.col(value).alias("_b")), keys)
    return m.agg(F.count(F.lit(1)).alias("n"), F.avg("_a").alias("mean_a"), F.avg("_b").alias("mean_b"), (F.avg("_b") - F.avg("_a")).alias("delta"))


def compare_groups(df: DataFrame, flag: Column, value: str) -> DataFrame:
    """(flag, n, median, mean) of a measure with and without something."""
    flagged = df.select(flag.alias("flag"), F.col(value).alias("v")).where("v is not null")
    means = flagged.groupBy(F.col("flag").alias("_f")).agg(F.avg("v").alias("mean"))
    return medians(flagged, "flag", {"median": "v"}).join(means, F.col("flag").eqNullSafe(F.col("_f"))).select("flag", "n", "median", "mean")


def relative_profile(df: DataFrame, item: str, ours: str, theirs: str) -> DataFrame:
    """(item, delta): each column over its own mean, and the difference of the two shapes."""
    w = Window.partitionBy()  # over the categories, a handful
    return df.select(item, (F.try_divide(F.col(ours), F.avg(ours).over(w)) - F.try_divide(F.col(theirs), F.avg(theirs).over(w))).alias("delta"))


def on_shared_pages(targets: DataFrame, sets: dict[str, DataFrame], page: str = "page_id") -> DataFrame:
    """The targets on pages of which every box set holds at least one box, so that sets are compared on equal terms."""
    shared = reduce(DataFrame.intersect, [boxes.select(page) for boxes in sets.values()])
    return targets.join(shared, page, "left_semi")


def coverage_report(covers: DataFrame, names: list[str], bar: float = COVER_OK) -> DataFrame:
    """(name, mean_cover, below, n) of each box set over the same targets."""
    flat = covers.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("cover")) for n in names])).alias("x"))
    return flat.groupBy("x.name").agg(F.avg("x.cover").alias("mean_cover"), F.count_if(F.col("x.cover") < bar).alias("below"), F.count(F.lit(1)).alias("n"))


def coverage_verdict(covers: DataFrame, ours: str, raw: str, full: str, bar: float = COVER_OK) -> DataFrame:
    """Crossed failures of three box sets and what follows: same as the raw detector, helped by post-processing."""
    fails = lambda a, b: F.count_if((F.col(a) < bar) & (F.col(b) >= bar))
    t = covers.agg(
        fails(ours, raw).alias("ours_only"),
        fails(raw, ours).alias("raw_only"),
        fails(ours, full).alias("recovered"),
        fails(full, ours).alias("lost"),
        F.count_if((F.col(ours) < bar) & (F.col(raw) < bar) & (F.col(full) < bar)).alias("all_fail"),
        F.abs(F.avg(ours) - F.avg(raw)).alias("gap"),
    )
    return t.select("ours_only", "raw_only", "recovered", "lost", "all_fail", (F.col("gap") < 0.02).alias("faithful"), (F.col("recovered") > 2 * F.col("lost")).alias("helps"))


def same_boxes(a: DataFrame, b: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """(page_id, same): whether two box lists are equal, place by place; pages of either."""
    x = a.select(*keys, F.struct(*values).alias("_a"))
    y = b.select(*keys, F.struct(*values).alias("_b"))
    return x.join(y, keys, "full_outer").groupBy(keys[0]).agg(F.bool_and(F.col("_a").eqNullSafe(F.col("_b"))).alias("same"))


def positional(results: DataFrame, regions: DataFrame) -> DataFrame:
    """(page, pos, read_order, class, text, aligned): results with the region at the same place.

    A page is aligned if both have as many rows and agree on order and class at every place; the caller
    falls back to its baseline where it is not.
    """
    a = results.select("page", "pos", "read_order", "class", "text")
    b = regions.select("page", "pos", F.col("read_order").alias("_o"), F.col("class").alias("_c"))
    met = a.join(b, ["page", "pos"], "full_outer")
    agree = met.groupBy("page").agg(F.bool_and(F.col("read_order").eqNullSafe(F.col("_o")) & F.col("class").eqNullSafe(F.col("_c"))).alias("aligned"))
    return a.join(agree, "page")


def identical(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """(n, same, differ, only_one): pages of two arms compared byte by byte."""
    x, y = a.select(key, F.col(value).alias("_a")), b.select(key, F.col(value).alias("_b"))
    m = x.join(y, key, "full_outer")
    one = F.col("_a").isNull() != F.col("_b").isNull()
    return m.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_a").eqNullSafe(F.col("_b")) & ~one).alias("same"), F.count_if(~F.col("_a").eqNullSafe(F.col("_b")) & ~one).alias("differ"), F.count_if(one).alias("only_one"))


def complete(manifest: DataFrame, results: DataFrame, page: str = "page") -> DataFrame:
    """(page, n_tasks, n_results, complete): complete means some tasks and a result for each."""
    m = manifest.groupBy(page).agg(F.count(F.lit(1)).alias("n_tasks"))
    r = results.groupBy(page).agg(F.count(F.lit(1)).alias("n_results"))
    j = m.join(r, page, "full_outer").na.fill(0, ["n_tasks", "n_results"])
    return j.withColumn("complete", (F.col("n_tasks") > 0) & (F.col("n_tasks") == F.col("n_results")))


def pending(listed: DataFrame, *without: DataFrame, page: str = "page") -> DataFrame:
    """Listed pages that are in none of the other sets."""
    return reduce(lambda a, b: a.join(b.select(page).distinct(), page, "left_anti"), without, listed.select(page).distinct())


def require(df: DataFrame, least: int, what: str) -> None:
    """Refuse to go on with fewer rows than ``least``."""
    n = df.limit(least).count()
    if n < least:
        raise ValueError(f"{n} {what}, fewer than {least}")


def subset(listed: DataFrame, known: DataFrame, key: str, strict: bool = True) -> DataFrame:
    """Known rows in the order of a list (key, pos); with ``strict``, a listed key that is unknown is an error."""
    if strict:
        missing = [r[0] for r in listed.join(known.select(key).distinct(), key, "left_anti").select(key).limit(5).collect()]
        if missing:
            raise KeyError(f"not known: {missing}")
    return listed.join(known, key)


def resolve_parts(groups: DataFrame, parts: DataFrame) -> DataFrame:
    """(group_id, text): texts of listed ids in their own order; ids that resolve to nothing are left out, empty lists too."""
    ids = groups.select("group_id", F.explode("ids").alias("id"))
    met = ids.join(parts, "id")
    return met.groupBy("group_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "id", "text"))), lambda x: x["text"]), "").alias("text"))
