import random

import pytest
from pyspark.sql import functions as F

from leafwright.operators import evaluate as E
from leafwright.operators import sampling as S

SAMPLE = "img_id string, norm_gt string, norm_pred string, edit_num long, upper_len long"


def test_reductions_and_buckets(spark):
    rows = [("a", "xx", "", 2, 2), ("a", "xx", "xx", 0, 2), ("b", "", "y", 1, 1), ("b", "xxxx", "xxyy", 2, 4), ("c", "", "", 0, 0), ("d", None, None, 0, 0)]
    df = spark.createDataFrame(rows, SAMPLE)
    r = E.edit_reductions(df).first()
    assert (r.n, r.n_pages) == (6, 4) and r.edit_whole == pytest.approx(5 / 9)
    assert r.edit_sample_avg == pytest.approx((1 + 0 + 1 + 0.5) / 6) and r.page_avg == pytest.approx((0.5 + 0.75) / 4)
    b = {x.bucket: x for x in E.error_budget(df).collect()}
    assert {k: v.n for k, v in b.items()} == {"MISS": 1, "SPURIOUS": 1, "EXACT": 3, "RECOG": 1}
    assert sum(x.contribution for x in b.values()) == pytest.approx(5 / 9)
    empty = spark.createDataFrame([], SAMPLE)
    assert E.edit_reductions(empty, "img_id").count() == 0 and E.error_budget(empty).count() == 0


def test_slices_overlap_and_none(spark):
    df = spark.createDataFrame([("a", 1.0, ["x", "y"]), ("b", 3.0, []), ("c", 5.0, None)], "img_id string, v double, tags array<string>")
    got = {(r.slice): (r.n_pages, r.page_avg) for r in E.attribute_slices(df, {"tags": F.col("tags")}, "v").collect()}
    assert got == {"x": (1, 1.0), "y": (1, 1.0), "None": (2, 4.0)}


def test_overall(spark):
    r = spark.range(1).select(E.overall(F.lit(0.0322), F.lit(92.82), F.lit(93.25)).alias("o"), E.overall_bound(F.lit(0.0322), F.lit(92.82)).alias("b"), E.overall_proxy(F.lit(0.0), F.lit(100.0), F.lit(0.0)).alias("p")).first()
    assert round(r.o, 2) == 94.28 and r.b > r.o and r.p == 100.0


def _box(x0, y0, x1, y1):
    return (float(x0), float(y0), float(x1), float(y1))


@pytest.mark.parametrize(
    "gt,pred,boxes,cause",
    [
        ("abc", "", [_box(0, 0, 10, 10)], "RECOG_EMPTY"),
        ("abc", "", [_box(50, 50, 60, 60)], "LAYOUT_MISS"),
        ("a" * 10, "a" * 5, [_box(0, 0, 10, 10)], "RECOG_SHORT"),
        ("a" * 10, "a" * 15, [_box(0, 0, 10, 10)], "RECOG_LONG"),
        ("a" * 10, "b" * 10, [_box(0, 0, 10, 10)], "RECOG_SUBST"),
        ("abc", "x", [_box(0, 0, 10, 5), _box(0, 5, 10, 10)], "LAYOUT_SPLIT"),
        ("abc", "x", [_box(0, 0, 20, 10)], "LAYOUT_MERGE"),
        ("abc", "x", [_box(0, 0, 5, 5)], "LAYOUT_PARTIAL"),
        ("abc", "x", [], "unlocatable"),
    ],
)
def test_causes(spark, gt, pred, boxes, cause):
    s = spark.createDataFrame([(1, 1, [3, 4, 4], gt, pred, 5)], "page_id long, sample_id long, gt_position array<int>, norm_gt string, norm_pred string, edit_num long")
    ann = spark.createDataFrame([(1, 3, "text_block", False, *_box(0, 0, 10, 10)), (1, 4, "figure", False, *_box(0, 0, 99, 99)), (1, 4, "title", True, *_box(0, 0, 99, 99))], "page_id long, ord int, category string, ignore boolean, x0 double, y0 double, x1 double, y1 double")
    b = spark.createDataFrame([(1, *x) for x in boxes], "page_id long, x0 double, y0 double, x1 double, y1 double")
    got = E.causes(E.locate(s, ann), b).first()
    assert got.cause == cause and got.category == "text_block"


def test_crop_buckets(spark):
    df = spark.createDataFrame([(n, 1.0, 2.0) for n in (0, 1, 5, 6, 200, 201)], "crops int, first_s double, second_s double")
    got = {r.bucket: (r.n, r.ratio) for r in E.bucket_medians(df).collect()}
    assert got == {"1-5": (2, 0.5), "6-10": (1, 0.5), "41-200": (1, 0.5), "ALL": (6, 0.5)}


def test_allocation_is_exact():
    rng = random.Random(2)
    for _ in range(300):
        counts = [(f"s{i}", rng.randrange(1, 60)) for i in range(rng.randrange(1, 9))]
        total = rng.randrange(len(counts), 80)
        got = S.allocate(counts, total)
        assert sum(got.values()) == total and min(got.values()) >= 1
    assert S.allocate([], 5) == {}
    assert S.allocate([("a", 10), ("b", 10)], 3) == {"a": 2, "b": 1}
    assert S.allocate([("a", 1), ("b", 1), ("c", 1)], 2) == {"a": 1, "b": 1, "c": 1}  # the floor stands


def test_systematic_picks_the_named_rows(spark):
    rows = [("a", i) for i in range(17)] + [("b", i) for i in range(4)] + [("c", i) for i in range(3)]
    df = spark.createDataFrame(rows, "s string, i int")
    got = sorted(map(tuple, S.systematic(df, "s", ["i"], {"a": 5, "b": 4, "c": 9}).collect()))
    want = [("a", min(16, int((k + 0.5) * 17 / 5))) for k in range(5)] + [("b", i) for i in range(4)] + [("c", i) for i in range(3)]
    assert got == sorted(want)


def test_sets_and_alignment(spark):
    a = spark.createDataFrame([("p", 0, 1, "text", "x"), ("p", 1, 2, "text", "y"), ("q", 0, 1, "text", "z")], "page string, pos int, read_order long, class string, text string")
    b = spark.createDataFrame([("p", 0, 1, "text"), ("p", 1, 2, "text"), ("q", 0, 1, "table")], "page string, pos int, read_order long, class string")
    assert {(r.page, r.aligned) for r in E.positional(a, b).collect()} == {("p", True), ("q", False)}
    assert [r.page for r in E.pending(spark.createDataFrame([("p",), ("q",), ("r",)], "page string"), a.where("page='p'"), b.where("page='q'")).collect()] == ["r"]
    c = E.complete(a.select("page"), b.select("page").union(spark.createDataFrame([("s",)], "page string")))
    assert {(r.page, r.complete) for r in c.collect()} == {("p", True), ("q", True), ("s", False)}
    with pytest.raises(ValueError):
        E.require(a, 10, "rows")
    with pytest.raises(KeyError):
        E.subset(spark.createDataFrame([("nope", 0)], "page string, pos int"), a, "page")


def test_positions_come_as_number_list_or_json(spark):
    ann = spark.createDataFrame([("p", i, "text_block", False, float(i), 0.0, i + 1.0, 1.0) for i in range(4)], "page_id string, ord int, category string, ignore boolean, x0 double, y0 double, x1 double, y1 double")
    for kind, values in (("int", [2, None]), ("array<bigint>", [[2, 2, None], []]), ("string", ["2", "x"]), ("string", ["[2, 2]", "[]"])):
        sm = spark.createDataFrame([("p", i, v) for i, v in enumerate(values)], f"page_id string, sample_id int, gt_position {kind}")
        assert {r.sample_id: r.x0 for r in E.locate(sm, ann).collect()} == {0: 2.0, 1: None}


def test_ratio_of_the_sides(spark):
    df = spark.createDataFrame([("LAYOUT_MISS", 6), ("RECOG_SUBST", 2), ("OTHER", 2)], "cause string, edit_num long")
    assert tuple(E.side_ratio(df).first()) == (6, 2, 0.6, 0.2, 3.0)
    assert E.side_ratio(df.limit(1)).first().ratio is None and E.side_ratio(df.limit(0)).first().ratio is None


@pytest.mark.parametrize("heavy", [-1, 10**9])
def test_recoverable_texts_of_heavy_pages(spark, monkeypatch, heavy):
    """Chunks and marks find what a search of the whole prediction finds; chunks of 64 characters here."""
    monkeypatch.setattr(E, "CHUNK", 64)
    monkeypatch.setattr(E, "BLOCK", 4)
    rng = random.Random(5)
    words = ["aa", "ab", "ba", "b", "\u00e9\u4e2d", "\U0001f600a", "", "\n"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(rng.randrange(n)))
    rows = []
    for page in ("p", "q", "r"):
        preds = [rng.choice([text(4), text(30), text(90), "", None]) for _ in range(60)]
        whole = " ".join(p for p in preds if p is not None)
        for i, pred in enumerate(preds):
            at, size = rng.randrange(len(whole)), rng.choice([3, 7, 8, 9, 20, 46, 47, 48, 150])
            gt = whole[at : at + size]
            gt = rng.choice([gt, gt, gt[:-1] + "x", gt[: len(gt) // 2] + "b" + gt[len(gt) // 2 :], text(20), whole[:30], " " + whole[:10], whole[-30:], whole[-10:] + " "])
            rows.append((page, i, gt, pred, rng.choice([0, 1, 5]), 9, gt in whole))
    rows += [(None, 1, "ab" * 9, "ab" * 9, 1, 9, True), ("s", 1, "abcdefgh", "", 1, 9, False)]
    df = spark.createDataFrame(rows, "img_id string, doc_id long, norm_gt string, norm_pred string, edit_num long, upper_len long, want boolean")
    got = E.recoverable(df, "doc_id", heavy=heavy).collect()
    assert {(r.img_id, r.doc_id) for r in got} == {(r[0], r[1]) for r in rows if r[0] and r[4] and len(r[2]) >= 8} and len(got) > 80
    assert [(r.img_id, r.doc_id, r.norm_gt) for r in got if r.found != r.want] == []
    assert len({r.found for r in got}) == 2


def test_recoverable_searches_heavy_pages_by_chunk(spark, monkeypatch):
    """The whole prediction of a page of 1100 texts is not searched for each of them."""
    from leafwright.functions.scalars import marks

    kept = {}
    through = E.through_disk
    monkeypatch.setattr(E, "through_disk", lambda df, purpose: kept.setdefault(purpose, through(df, purpose)))
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(600)) for _ in range(1100)]
    rows = [("h", i, texts[i] if i % 50 else texts[(i * 7) % 1100], texts[(i + 1) % 1100] if i % 3 else "none", 1, 600) for i in range(1100)]
    whole = " ".join(r[3] for r in rows)
    df = spark.createDataFrame(rows, "img_id string, doc_id long, norm_gt string, norm_pred string, edit_num long, upper_len long")
    q = E.recoverable(df, "doc_id")
    assert {r.doc_id: r.found for r in q.collect()} == {r[1]: r[2] in whole for r in rows}
    assert kept["heavy-chunks"].count() > 3 and kept["heavy-places"].count() < 5000
    assert set(marks(texts[0], (16, 32))) <= set(marks("x" + texts[0] + "y", (16, 32)))


def test_recoverable_takes_each_distance_once(spark):
    """One pass over the samples works out their columns, with and without heavy pages."""
    for heavy in (1, 128):
        taken = spark.sparkContext.accumulator(0)

        def run(x):
            taken.add(len(x))
            return x.str.len()

        df = spark.createDataFrame([(p, i, f"text number {i}", "x") for p in "ab" for i in range(20)], "img_id string, doc_id long, norm_gt string, norm_pred string")
        df = df.withColumn("edit_num", F.pandas_udf(run, "bigint")("norm_gt"))
        assert E.recoverable(df, "doc_id", heavy=heavy).count() == 40 and len(E.recoverable(df, "doc_id", heavy=heavy).collect()) == 40
        assert taken.value == 80  # two calls
