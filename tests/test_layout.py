import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafwright import constants as C
from leafwright.operators import geometry as G
from leafwright.operators import layout as L
from leafwright.operators import tasks as T

SCHEMA = "page_id long, det_idx int, label int, class string, score float, x0 float, y0 float, x1 float, y1 float, read_order long, width int, height int"


def regions(spark, boxes, width=1000, height=1000, page=1):
    rows = []
    for i, (kind, box, *rest) in enumerate(boxes):
        score = rest[0] if rest else 0.9
        order = rest[1] if len(rest) > 1 else i
        label = C.CLASSES.index(kind) if kind in C.CLASSES else 99
        rows.append((page, i, label, kind, float(score), *map(float, box), order, width, height))
    return spark.createDataFrame(rows, SCHEMA)


def kept(df):
    return [r["class"] for r in df.orderBy("page_id", "read_order", "det_idx").collect()]


def test_child_in_larger_text_is_dropped(spark):
    df = regions(spark, [("text", (0, 0, 100, 100)), ("inline_formula", (10, 10, 40, 30)), ("table", (200, 200, 300, 300))])
    assert kept(L.drop_nested(df)) == ["text", "table"]


def test_chained_containment_keeps_the_outermost(spark):
    df = regions(spark, [("abstract", (0, 0, 100, 100)), ("text", (0, 0, 90, 90)), ("inline_formula", (10, 10, 40, 30))])
    assert kept(L.drop_nested(df)) == ["abstract"]


def test_visual_parent_absorbs_nothing(spark):
    boxes = [("image", (0, 0, 100, 100)), ("text", (10, 10, 50, 50)), ("text", (200, 0, 300, 100)), ("inline_formula", (210, 10, 240, 30))]
    assert kept(L.drop_nested(regions(spark, boxes))) == ["image", "text", "text"]
    assert kept(L.drop_nested(regions(spark, boxes), aware=False)) == ["image", "text"]


def test_identical_pair_and_partial_overlap_stay(spark):
    assert len(kept(L.drop_nested(regions(spark, [("text", (0, 0, 10, 10)), ("text", (0, 0, 10, 10))])))) == 2
    assert len(kept(L.drop_nested(regions(spark, [("text", (0, 0, 100, 100)), ("text", (50, 0, 150, 80))])))) == 2


def test_page_sized_image(spark):
    alone = regions(spark, [("image", (0, 0, 1000, 990))])
    assert kept(L.drop_page_sized_image(alone)) == ["image"]
    both = regions(spark, [("image", (0, 0, 1000, 990)), ("text", (0, 0, 10, 10))])
    assert kept(L.drop_page_sized_image(both)) == ["text"]
    only_images = regions(spark, [("image", (0, 0, 1000, 990)), ("image", (0, 0, 1000, 995))])
    assert kept(L.drop_page_sized_image(only_images)) == ["image", "image"]
    wide = regions(spark, [("image", (0, 0, 1000, 425)), ("text", (0, 0, 10, 10))], width=1000, height=500)
    assert kept(L.drop_page_sized_image(wide)) == ["text"]  # 0.85 of a wide page
    tall = regions(spark, [("image", (0, 0, 500, 850)), ("text", (0, 0, 10, 10))], width=500, height=1000)
    assert kept(L.drop_page_sized_image(tall)) == ["image", "text"]  # 0.85 of a tall one


def test_two_near_equal_absorbers_delete_each_other(spark):
    df = regions(spark, [("doc_title", (0, 0, 100, 100)), ("paragraph_title", (0, 0, 100, 97))])
    assert kept(L.merge_large(df)) == []


def test_sliver_is_dropped_by_the_reference_mode(spark):
    df = regions(spark, [("text", (0, 0, 100, 100)), ("text", (0, 200, 100, 205))])
    assert kept(L.postprocess(df)) == ["text"]
    assert len(kept(L.regions(df, mode="raw"))) == 2
    with pytest.raises(ValueError):
        L.regions(df, mode="other")


def test_rounding_goes_to_even_and_crops_round_up(spark):
    df = regions(spark, [("text", (0.5, 1.5, 2.5, 3.5))])
    r = G.round_even(df).first()
    assert (r.x0, r.y0, r.x1, r.y1) == (0.0, 2.0, 2.0, 4.0)
    c = G.crop_rectangle(df).first()
    assert (c.x, c.y, c.w, c.h) == (1, 2, 2, 2)


@pytest.mark.parametrize("box,want", [((2, 3, 6, 8), (2, 3, 4, 5)), ((-5, -5, 50, 50), (0, 0, 10, 10)), ((4, 4, 4, 4), (4, 4, 1, 1)), ((6, 8, 2, 3), (2, 3, 4, 5)), ((20, 20, 30, 30), (9, 9, 1, 1))])
def test_crop_rectangle(spark, box, want):
    c = G.crop_rectangle(regions(spark, [("text", box)], width=10, height=10)).first()
    assert (c.x, c.y, c.w, c.h) == want


def test_clip_drops_what_collapses(spark):
    df = regions(spark, [("text", (-5, -5, 10.9, 10.9)), ("text", (1000, 0, 1200, 10)), ("text", (5, 5, 5.5, 9))])
    rows = G.clip_to_page(df).collect()
    assert [(r.x0, r.y0, r.x1, r.y1) for r in rows] == [(0.0, 0.0, 10.0, 10.0)]


def _survivors_plain(boxes, classes):
    def size(b):
        return max(b[2] - b[0], 0) * max(b[3] - b[1], 0)

    gone = [False] * len(boxes)
    for i, a in enumerate(boxes):
        if a[2] - a[0] < 6 or a[3] - a[1] < 6:
            gone[i] = True
        for j in range(i + 1, len(boxes)):
            b = boxes[j]
            if gone[i] or gone[j]:
                continue
            inter = max(min(a[2], b[2]) - max(a[0], b[0]), 0) * max(min(a[3], b[3]) - max(a[1], b[1]), 0)
            small = min(size(a), size(b))
            ratio = np.float32(inter) / np.float32(small) if small else 0
            pair = {classes[i], classes[j]}
            if "inline_formula" in pair:
                if ratio > np.float32(0.5):
                    gone[i] = gone[i] or classes[i] == "inline_formula"
                    gone[j] = gone[j] or classes[j] == "inline_formula"
            elif ratio > np.float32(0.7):
                pictures = [c in C.PICTORIAL for c in (classes[i], classes[j])]
                if any(pictures) and len(pair) == 2 and (all(pictures) or "table" not in pair):
                    continue
                if size(a) >= size(b):
                    gone[j] = True
                else:
                    gone[i] = True
    return [not g for g in gone]


def test_overlap_filter_agrees_with_plain_loops():
    rng = random.Random(5)
    for _ in range(400):
        n = rng.randrange(0, 14)
        boxes, classes = [], []
        for _ in range(n):
            x, y = rng.randrange(0, 40), rng.randrange(0, 40)
            boxes.append([x, y, x + rng.randrange(0, 30), y + rng.randrange(0, 30)])
            classes.append(rng.choice(["text", "inline_formula", "table", "image", "chart", "doc_title"]))
        got = L.overlap_survivors(np.array(boxes, np.float32).reshape(-1, 4), classes)
        assert list(got) == _survivors_plain(boxes, classes)


def test_suppression_agrees_with_plain_loop(spark):
    rng = random.Random(6)
    rows, want = [], set()
    for page in range(60):
        boxes = []
        for i in range(rng.randrange(1, 12)):
            x, y = rng.randrange(0, 20), rng.randrange(0, 20)
            boxes.append((page, i, rng.randrange(3), "text", float(rng.choice([0.5, 0.7, 0.9])), float(x), float(y), float(x + rng.randrange(1, 20)), float(y + rng.randrange(1, 20)), i, 100, 100))
        rows += boxes
        stayed = []
        for b in sorted(boxes, key=lambda b: (-b[4], b[1])):
            def iou(a, c):
                w, h = max(min(a[7], c[7]) - max(a[5], c[5]) + 1, 0), max(min(a[8], c[8]) - max(a[6], c[6]) + 1, 0)
                area = lambda z: (z[7] - z[5] + 1) * (z[8] - z[6] + 1)
                return np.float32(w * h) / np.float32(area(a) + area(c) - w * h)

            if all(iou(b, k) < np.float32(0.6 if k[2] == b[2] else 0.98) for k in stayed):
                stayed.append(b)
        want |= {(page, b[1]) for b in stayed}
    got = {(r.page_id, r.det_idx) for r in L.suppress(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want


def test_postprocess_equals_its_steps(spark):
    rng = random.Random(7)
    rows = []
    for page in range(40):
        for i in range(rng.randrange(1, 15)):
            x, y = rng.uniform(0, 300), rng.uniform(0, 300)
            label = rng.randrange(25)
            rows.append((page, i, label, C.CLASSES[label], rng.random(), x, y, x + rng.uniform(0, 300), y + rng.uniform(0, 300), rng.randrange(5), 400, 500))
    df = spark.createDataFrame(rows, SCHEMA)
    steps = L.filter_boxes(G.clip_to_page(L.merge_large(L.drop_page_sized_image(L.suppress(L.above_score(G.round_even(df)))))))
    one = lambda d: sorted(map(tuple, d.select("page_id", "det_idx", "x0", "y1").collect()))
    assert one(L.postprocess(df)) == one(steps)
    plan = L.postprocess(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_empty_and_odd_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for f in (L.drop_nested, L.merge_large, L.suppress, L.filter_boxes, L.postprocess, L.drop_page_sized_image, L.raw_postprocess):
        assert f(empty).count() == 0
    odd = spark.createDataFrame([(1, 0, None, None, float("nan"), 0.0, 0.0, 5.0, 5.0, None, 10, 10), (1, 1, 22, "text", None, 0.0, 0.0, 5.0, 5.0, 1, 10, 10), (1, 2, 22, None, 0.9, 0.0, 0.0, 9.0, 9.0, None, 10, 10)], SCHEMA)
    for f in (L.drop_nested, L.merge_large, L.suppress, L.filter_boxes, L.postprocess, L.drop_page_sized_image):
        f(odd).collect()
    assert L.above_score(odd).count() == 1


def test_unknown_label_and_decode(spark):
    t = spark.createDataFrame([(1, [22.0, 0.9, 0.0, 0.0, 5.0, 5.0, 3.0, 30.0, 0.8, 1.0, 1.0, 2.0, 2.0, 4.0, -1.0, 0.7, 0.0, 0.0, 1.0, 1.0, 5.0, 0.0, 0.1, 0.0, 0.0, 1.0, 1.0, 6.0], 3), (2, [], 0), (3, None, 2)], "page_id long, values array<float>, bbox_num int")
    got = [(r.det_idx, r["class"], r.read_order) for r in L.decode(t).orderBy("det_idx").collect()]
    assert got == [(0, "text", 3), (1, "?30", 4)]


def test_tasks_and_manifest(spark):
    df = regions(spark, [("table", (0, 0, 10, 10), 0.9, 5), ("text", (0, 0, 10, 10), 0.9, 2), ("seal", (0, 0, 9, 9), 0.9, 2), ("chart", (0, 0, 9, 9), 0.9, 9)])
    tasks = T.plan_tasks(df)
    assert [(r["class"], r.prompt, r.crop) for r in tasks.orderBy("ordinal").collect()] == [
        ("text", "OCR:", "crop_000_text.png"),
        ("seal", "Seal Recognition:", "crop_001_seal.png"),
        ("table", "Table Recognition:", "crop_002_table.png"),
        ("chart", "Chart Recognition:", "crop_003_chart.png"),
    ]
    assert sorted(map(tuple, T.plan_tasks(df, spread=True).collect())) == sorted(map(tuple, tasks.collect()))
    assert [r.crop for r in T.plan_tasks(df, skip_visual=True).orderBy("ordinal").collect()] == ["crop_000_text.png", "crop_002_table.png"]
    m = T.manifest_json(tasks).first().manifest
    assert m.startswith('[\n  {"read_order": 2, "class": "text", "prompt": "OCR:", "crop": "crop_000_text.png"},\n') and m.endswith("\n]\n")
    pages = spark.createDataFrame([(1,), (2,)], "page_id long")
    assert {r.page_id: r.manifest[:3] for r in T.with_empty_pages(T.manifest_json(tasks), pages).collect()} == {1: "[\n ", 2: "[]\n"}


def test_union_cover_counts_overlap_once(spark):
    t = spark.createDataFrame([(1, 0, 0.0, 0.0, 10.0, 10.0), (1, 1, 100.0, 0.0, 110.0, 10.0), (1, 2, 0.0, 0.0, 0.0, 0.0)], "page long, t int, x0 double, y0 double, x1 double, y1 double")
    b = spark.createDataFrame([(1, 0.0, 0.0, 5.0, 10.0), (1, 2.0, 0.0, 8.0, 5.0), (1, 2.0, 0.0, 8.0, 5.0), (1, -5.0, 8.0, 50.0, 9.0)], "page long, x0 double, y0 double, x1 double, y1 double")
    got = {r.t: r.cover for r in G.union_cover(t, b, "page", "t").collect()}
    cells = sum(1 for x in range(10) for y in range(10) if (x < 5) or (2 <= x < 8 and y < 5) or y == 8)
    assert got[0] == pytest.approx(cells / 100) and got[1] == 0 and got[2] == 0


def test_polygon_and_union_box(spark):
    p = spark.createDataFrame([([1.0, 2.0, 5.0, 2.5, 4.0, 9.0],)], "poly array<double>")
    b = G.polygon_box(F.col("poly"))
    assert tuple(p.select(b["x0"], b["y0"], b["x1"], b["y1"]).first()) == (1.0, 2.0, 5.0, 9.0)
