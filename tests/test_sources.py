import json
import os

import numpy as np
import pytest

from leafwright.operators import crops as P
from leafwright.operators import plugins
from leafwright.sources import readers as R
from leafwright.sources import writers as W
from leafwright.streaming import ingest


def test_results_are_lenient_by_row_and_strict_by_file(spark):
    good = json.dumps([{"read_order": 2, "class": "text", "text": 'a\n"b"\\'}, {"class": "text", "text": "first"}, {"read_order": 1, "class": "text"}, {"read_order": 1, "text": "x"}, {"read_order": 1, "class": "text", "text": 5}, {"read_order": 1.5, "class": "text", "text": "frac"}, {"read_order": "3", "class": "text", "text": "str"}])
    df = spark.createDataFrame([("p", good), ("e", "[]"), ("n", None)], "page string, json string")
    got = sorted((r.read_order, r.text) for r in R.parse_results(df).collect())
    assert got == [(0, "first"), (0, "frac"), (0, "str"), (2, 'a\n"b"\\')]
    bad = spark.createDataFrame([("p", good[:-5])], "page string, json string")
    assert R.parse_results(bad, strict=False).count() == 0
    with pytest.raises(Exception, match="no result array"):
        R.parse_results(bad).collect()


def test_files_round_trip(spark, tmp_path):
    for name, text in (("p1", '[{"read_order":1,"class":"text","text":"one"}]'), ("p2", '[{"read_order":1,"cl')):
        os.makedirs(tmp_path / name)
        (tmp_path / name / "results.json").write_text(text)
    got = R.read_results(spark, str(tmp_path / "*" / "results.json"), strict=False).collect()
    assert [(r.page, r.text) for r in got] == [("p1", "one")]
    (tmp_path / "p1" / "manifest.json").write_text('[{"read_order": 1, "class": "text", "prompt": "OCR:", "crop": "c.png"}]')
    assert R.read_manifests(spark, str(tmp_path / "p1" / "manifest.json")).first().crop == "c.png"
    (tmp_path / "list.txt").write_text("a.png\n\n# no\n  b.png  \n")
    assert sorted(r.value for r in R.read_page_list(spark, str(tmp_path / "list.txt")).collect()) == ["a.png", "b.png"]
    t = spark.createDataFrame([("s", 3, 0.12345, 1.0, 0.001)], R.TIMINGS)
    W.write_timings(t, str(tmp_path / "t"))
    r = R.read_timings(spark, str(tmp_path / "t")).first()
    assert (r.layout_s, r.recognize_s) == (0.123, 1.0)
    pages = spark.createDataFrame([("pg.png", "# x"), ("scans/é 2.jpg", "two\n"), ("none.png", None)], "image_path string, markdown string")
    assert W.write_markdown(pages, str(tmp_path / "md")) == 2 == W.write_markdown(pages, f"file://{tmp_path}/md")
    assert {f.name: f.read_text() for f in (tmp_path / "md").iterdir()} == {"pg.md": "# x", "é 2.md": "two\n"}
    with pytest.raises(Exception, match="no file name"):
        W.write_files(spark.createDataFrame([("../up", "x")], "n string, v string"), "n", "v", str(tmp_path / "md"))
    (tmp_path / "run.log").write_text("[1] == a ==\n  read_order= 3  text  score=0.9  bbox=[1.0, 2.0, 3.0, 4.5]\nnoise\n[2] == b ==\n[3] == a ==\n  read_order=10 table score=0.5 bbox=[0,0,1,1]\n")
    lines = R.read_lines(spark, str(tmp_path / "run.log"))
    assert [(r.stem, r.read_order, r["class"], r.bbox) for r in R.region_log(lines, "file").collect()] == [("a", 10, "table", [0.0, 0.0, 1.0, 1.0])]
    gt = {"layout_dets": [{"category_type": "title", "poly": [0, 0, 1, 1], "order": 1, "text": "t", "ignore": False}], "page_info": {"image_path": "x.png", "height": 2, "width": 3, "page_no": 1, "page_attribute": {"language": "en"}}}
    (tmp_path / "gt.json").write_text(json.dumps([gt]))
    assert R.read_ground_truth(spark, str(tmp_path / "gt.json")).first().image_path == "x.png"


def test_images_and_crops(spark, tmp_path):
    a = np.full((6, 8, 3), 255, np.uint8)
    a[2, 3] = (10, 20, 30)
    (tmp_path / "x.jpg").write_bytes(W.png(a))  # the content tells the format, not the name
    row = R.read_images(spark, str(tmp_path / "x.jpg")).first()
    assert (P.from_spark(bytes(row.data), row.height, row.width, row.nChannels) == a).all()
    images = R.read_images(spark, str(tmp_path / "x.jpg")).selectExpr("'p' page_id", "data", "height", "width", "nChannels")
    broken = spark.createDataFrame([("q", bytearray(b"xx"), 5, 5, 3)], images.schema)
    tasks = spark.createDataFrame([("p", 0, "text", "crop_000_text.png", 1.0, 1.0, 4.0, 5.0), ("q", 0, "text", "c", 0.0, 0.0, 1.0, 1.0), ("r", 3, "text", "d", 0.0, 0.0, 1.0, 1.0)], "page_id string, ordinal int, class string, crop string, x0 double, y0 double, x1 double, y1 double")
    got = {r.page_id: r for r in P.cut_crops(tasks, images.union(broken)).collect()}
    assert got["p"].png[:4] == b"\x89PNG" and got["p"].error is None
    assert got["q"].png is None and got["q"].error
    assert got["r"].png is None and got["r"].ordinal == 3 and "no image" in got["r"].error  # no region is lost with its image


def test_ink():
    white = np.full((100, 100, 3), 255, np.uint8)
    ink = white.copy()
    ink[30:40, 20:40] = 0
    assert P.tighten(ink).shape == (10, 20, 3)
    assert P.tighten(np.full((40, 40, 3), 7, np.uint8)).shape == (40, 40, 3)
    thin = np.full((40, 40, 3), 255, np.uint8)
    thin[5:13, 5:7] = 0
    assert P.tighten(thin).shape == (40, 40, 3)
    assert P.crop_for_class(ink, (0, 0, 100, 100), "display_formula").shape == (10, 20, 3)
    assert P.crop_for_class(ink, (0, 0, 100, 100), "formula_number").shape == (100, 100, 3)
    x = P.detector_input(np.full((10, 20, 3), (255, 0, 0), np.uint8))
    assert x.shape == (1, 3, 800, 800) and x.dtype == np.float32 and x[0, 2].min() == 1.0 and x[0, 0].max() == 0.0
    up = P.resize(np.arange(16, dtype=np.uint8).reshape(4, 4, 1).repeat(3, 2) * 10, 4, 4)
    assert (up[:, :, 0] == np.arange(16).reshape(4, 4) * 10).all()


def test_plugins(spark):
    tasks = spark.createDataFrame([(1, "ok"), (2, "fail"), (3, "late")], "i int, crop string")

    def load():
        def model(row):
            import time

            if row["crop"] == "fail":
                raise RuntimeError("no")
            if row["crop"] == "late":
                time.sleep(3)
            return row["crop"].upper()

        return model

    got = {r.i: (r.text, r.error) for r in plugins.recognize(tasks, load, budget_s=0.5).collect()}
    assert got == {1: ("OK", None), 2: (None, "RuntimeError: no"), 3: ("", None)}
    images = spark.createDataFrame([("p", bytearray(b"x"), 1, 1, 3)], "page_id string, data binary, height int, width int, nChannels int")
    d = plugins.detect(images, lambda: lambda data, h, w, n: [[22, 0.9, 0, 0, 1, 1, 0]]).first()
    assert d.bbox_num == 1 and len(d["values"]) == 7


def test_ingest_is_resumable(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    os.makedirs(f"{src}/p1")
    open(f"{src}/p1/results.json", "w").write('[{"read_order":1,"class":"text","text":"one"}]')
    assert ingest.ingest_results(spark, src, out, cp).count() == 1
    os.makedirs(f"{src}/p2")
    open(f"{src}/p2/results.json", "w").write('[{"read_order":1,"class":"text","text":"two"}]')
    assert sorted(r.text for r in ingest.ingest_results(spark, src, out, cp).collect()) == ["one", "two"]


def test_runner_stops_without_progress(spark):
    listed = spark.createDataFrame([("a",), ("b",), ("c",)], "page string")
    done: list[tuple[str]] = []
    frame = lambda rows: spark.createDataFrame(rows, "page string")

    def work(todo):
        for r in todo.orderBy("page").collect():
            if r.page != "c":
                done.append((r.page,))
                return

    assert ingest.run_until_done(listed, lambda: frame(done), lambda: frame([]), work) == 1
    assert done == [("a",), ("b",)]
    assert ingest.run_until_done(listed, lambda: frame(done), lambda: frame([("c",)]), work) == 0


def test_json_and_tables(spark):
    b = spark.createDataFrame([("p", 2, 1, "text", 'q"\n'), ("p", 1, 2, "table", None)], "page string, read_order long, idx long, class string, text string")
    assert json.loads(W.results_json(b).first().json) == [{"read_order": 1, "class": "table", "text": None}, {"read_order": 2, "class": "text", "text": 'q"\n'}]
    from pyspark.sql import functions as F

    t = W.markdown_table(spark.createDataFrame([("a", 1), ("b", None)], "k string, n int"), ["k", "n"], [F.col("k")]).first().markdown
    assert t == "| k | n |\n|---|---|\n| a | 1 |\n| b |  |"


def test_page_key(spark):
    stems = spark.createDataFrame([("a",), ("b",), ("c",)], "stem string")
    known = spark.createDataFrame([("a.jpg",), ("a.png",), ("b.jpeg",), (None,)], "image string")
    assert {(r.stem, r.image) for r in R.page_key(stems, known).collect()} == {("a", "a.png"), ("b", "b.jpeg"), ("c", None)}


def test_scorer_log_and_elapsed(spark):
    t = spark.createDataFrame([("r", "【text_block】\nALL 0.5\ndata_source: book 0.25\n【other】\nALL 1.0"), ("s", "nothing")], "run string, text string")
    assert {(r.run, r.slice, r.value) for r in R.scorer_log(t, "text_block").collect()} == {("r", "ALL", 0.5), ("r", "book", 0.25)}
    m = spark.sql("select 'r' run, stem, timestamp(at) at, timestamp('2025-01-01 00:00:09') ended from values ('a', '2025-01-01 00:00:01'), ('b', '2025-01-01 00:00:04') v(stem, at)")
    assert {(r.stem, r.micros) for r in R.page_elapsed(m).collect()} == {("a", 3_000_000), ("b", 5_000_000)}


def test_logs_of_several_runs_with_the_same_numbers(spark):
    rows = [("a.log", 0, "[1] == p =="), ("a.log", 1, "[1] wrote o/p.md in 7s"), ("a.log", 2, "[1] wrote o/p.md in 8s"), ("a.log", 3, "[2] wrote o/x.md in 1s"), ("a.log", 4, "[2] == q =="), ("a.log", 5, "[2] wrote o/q.md in 2s")]
    rows += [("b.log", 0, "[1] == q =="), ("b.log", 1, "[2] == p =="), ("b.log", 2, "noise"), ("b.log", 3, "[1] wrote o/q.md in 5s"), ("c.log", 0, "[1] wrote o/z.md in 9s"), ("c.log", 1, None)]
    lines = spark.createDataFrame(rows, "file string, line_no int, value string")
    assert {r.stem: r.seconds for r in R.timing_log(lines).collect()} == {"p": 8.0, "q": 5.0}
    second = [("b", 1, "[300/999] p: 4 crops, 10 bytes, 2.5s"), ("a", 9, "[301/999] p: 3 crops, 10 bytes, 1.5s"), ("b", 0, "[302/999] p: 2 crops, 10 bytes, 0.5s"), ("b", 2, "[5/999] p: 9 crops, 10 bytes, 9.5s"), ("b", 3, "[400/999] other: 9 crops, 10 bytes, 9.5s")]
    got = R.second_timing_log(spark.createDataFrame(second, "file string, line_no int, value string"), spark.createDataFrame([("p",)], "stem string"))
    assert [tuple(r) for r in got.collect()] == [("p", 4, 2.5)]


def test_rendered_pages_are_numbered_in_name_order(spark, tmp_path):
    for name in ("d/p-10.png", "d/p-02.png", "d/p-01.png", "e/a.png", "e/a.txt"):
        os.makedirs(tmp_path / name.split("/")[0], exist_ok=True)
        (tmp_path / name).write_bytes(name.encode())
    got = {(r.document, r.page_no): bytes(r.content).decode() for r in R.read_page_files(spark, str(tmp_path / "*")).collect()}
    assert got == {("d", 1): "d/p-01.png", ("d", 2): "d/p-02.png", ("d", 3): "d/p-10.png", ("e", 1): "e/a.png"}


def test_model_config(spark, tmp_path):
    (tmp_path / "c.yaml").write_text("# head\nSub:\n  Layout:\n    threshold: 0.4 # low\n    nms: True\n    mode: 'large'\n    other: 3\n  Rest:\n    threshold: 0.9\nlist:\n  - a: 1\n")
    defaults = {"Sub.Layout.threshold": 0.3, "Sub.Layout.nms": False, "Sub.Layout.mode": "", "Sub.Layout.ratio": 1.5}
    assert R.model_config(spark, str(tmp_path / "c.yaml"), defaults) == {"Sub.Layout.threshold": 0.4, "Sub.Layout.nms": True, "Sub.Layout.mode": "large", "Sub.Layout.ratio": 1.5}
    assert R.model_config(spark, str(tmp_path / "none.yaml"), defaults) == defaults
    (tmp_path / "bad.yaml").write_text("k: many\n")
    with pytest.raises(ValueError):
        R.model_config(spark, str(tmp_path / "bad.yaml"), {"k": 1})


def test_what_hangs_is_killed_and_its_page_skipped(spark):
    def load():
        import os
        import signal
        import time

        def model(row):
            if row["crop"] == "hang":  # nothing in this process answers any more
                os.kill(os.getpid(), signal.SIGSTOP)
            if row["crop"] == "slow":
                time.sleep(1.6)
            if row["crop"] == "die":
                os._exit(3)
            if row["crop"] == "bad":
                raise ValueError("no")
            return row["crop"].upper()

        return model

    rows = [(i % 2, c) for i, c in enumerate(["a", "hang", "slow", "b", "die", "bad", "c"])]
    tasks = spark.createDataFrame(rows, "page_id int, crop string").coalesce(1)
    got = plugins.recognize(tasks, load, budget_s=1.0).collect()
    assert {r.crop: (r.text, r.error) for r in got if r.error is None} == {"a": ("A", None), "b": ("B", None), "c": ("C", None), "slow": ("", None)}
    errors = {r.crop: r.error for r in got if r.error}
    assert errors["hang"] == plugins.SKIP and "ended" in errors["die"] and errors["bad"] == "ValueError: no"
    done = spark.createDataFrame(got, plugins.recognize(tasks, load).schema)
    assert [tuple(r) for r in plugins.skipped(done).collect()] == [(1, 1)]


def test_a_server_that_is_gone_is_waited_for_or_ends_the_run(spark, tmp_path):
    flag = str(tmp_path / "up")

    def load():
        import os

        def model(row):
            if not os.path.exists(flag):
                raise ConnectionRefusedError("down")
            return "ok"

        return model

    def restart():
        open(flag, "w").close()
        return True

    tasks = spark.createDataFrame([("p", "c")], "page_id string, crop string")
    with pytest.raises(Exception, match="ServerGone"):
        plugins.recognize(tasks, load, wait_s=0.1, alive=lambda: False, server_wait_s=0.5).collect()
    assert plugins.recognize(tasks, load, wait_s=0.1, alive=restart).first().text == "ok"


def test_kept_by_tag(spark, tmp_path):
    from leafwright.session import by_tag

    made = []

    def make():
        made.append(1)
        return spark.range(len(made))

    assert by_tag(spark, str(tmp_path), "t", make).count() == 1 == by_tag(spark, str(tmp_path), "t", make).count()
    os.remove(tmp_path / "t" / "_SUCCESS")
    assert by_tag(spark, str(tmp_path), "t", make).count() == 2 == by_tag(spark, str(tmp_path), "t", make).count() and len(made) == 2


def test_no_folder_of_one_machine_on_a_cluster():
    from types import SimpleNamespace

    from leafwright.session import shared_dir

    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="local-cluster[3,2,1000]")
    conf = SimpleNamespace(get=lambda name, default: default)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=sc, conf=conf), "x")


def test_headers_of_model_files(spark, tmp_path):
    import struct

    def text(x):
        return struct.pack("<Q", len(x)) + x.encode()

    pairs = [text("arch") + struct.pack("<I", 8) + text("tiny"), text("layers") + struct.pack("<II", 4, 7), text("words") + struct.pack("<IIQ", 9, 8, 2) + text("a") + text("bc"), text("scale") + struct.pack("<If", 6, 0.5), text("nested") + struct.pack("<IIQ", 9, 9, 1) + struct.pack("<IQ", 5, 0)]
    (tmp_path / "m.bin").write_bytes(b"GGUF" + struct.pack("<IQQ", 3, 0, len(pairs)) + b"".join(pairs) + b"\0" * 1000)
    (tmp_path / "x.bin").write_bytes(b"other")
    got = R.read_headers(spark, str(tmp_path / "*.bin")).collect()
    assert {r.name: r.value for r in got if r.error is None} == {"arch": "tiny", "layers": "7", "words": "[2]", "scale": "0.5", "nested": "[1]"}
    assert [r.path[-5:] for r in got if r.error] == ["x.bin"]
