import datetime

import pytest

from leafwright.operators.compaction import CommitConflict, CompactStore, as_records, deduplicate
from leafwright.session import shared_dir

MANIFEST = "file_id long, row_no int, stem string, read_order long, class string, prompt string, crop string, extra string"
TIMING = "file_id long, row_no int, stem string, run_id int, crops long, layout_s double, recognize_s double, assemble_s double"


def day(n):
    return datetime.datetime(2025, 3, n)


def tables(spark, manifest, timing, files):
    return (
        as_records(spark.createDataFrame(manifest, MANIFEST), spark.createDataFrame(timing, TIMING)),
        spark.createDataFrame(files, "file_id long, written_at timestamp"),
    )


def names(df):
    return sorted(map(tuple, df.select("kind", "stem", "item").collect()))


def test_spellings_are_one_record_and_the_latest_wins(spark):
    m = [
        (1, 0, "Page-1.PNG", 5, "text", "OCR:", "./crop_000_text.png", "x"),
        (2, 0, " page-1 ", 7, "text", "OCR:", "CROPS\\Crop_000_TEXT.png", "y"),
        (2, 1, "runs/r1/page-1.jpg", 8, "text", "OCR:", "crop_001_text.png", None),
        (3, 0, None, 8, "text", "OCR:", "crop_001_text.png", None),
        (3, 1, "page-1", 8, "text", "OCR:", None, None),
    ]
    t = [(4, 0, "page-1.png", 1, 3, 0.1, 0.2, 0.3), (4, 1, "page-1", 2, None, None, 0.2, 0.3), (5, 0, "PAGE-1", 1, 4, 0.1, 0.2, 0.3)]
    records, files = tables(spark, m, t, [(1, day(1)), (2, day(2)), (3, None), (4, day(1))])
    store = CompactStore(spark, shared_dir(spark, "t"))
    store.compact(records, files)
    assert names(store.read()) == [("manifest", "page-1", "crop_000_text.png"), ("manifest", "page-1", "crop_001_text.png"), ("timing", "page-1", "1"), ("timing", "page-1", "2")]
    kept = store.read().where("item = 'crop_000_text.png'").first()
    assert kept.read_order == 7


def test_only_partitions_with_new_files_are_rewritten(spark):
    m = [(i, 0, f"s{i % 50}", i, "text", "OCR:", f"c{i}.png", None) for i in range(400)]
    records, files = tables(spark, m, [], [(i, day(1)) for i in range(400)])
    store = CompactStore(spark, shared_dir(spark, "t"), target_bytes=4000, file_bytes=100)
    first = store.compact(records, files)
    assert first.n_parts == 10 and store.read().count() == 400
    more, files2 = tables(spark, [(900, 0, "s1", 1, "text", "OCR:", "new.png", None), (901, 0, "s1", 1, "text", "OCR:", "new.png", None)], [], [(900, day(2)), (901, day(3))])
    second = store.compact(more, files2)
    assert second.version == 2 and store.read().count() == 401
    assert sum(second.live[k] == first.live[k] for k in first.live) == 9 and all(len(f) == 1 for f in second.live.values())
    assert store.read(1).count() == 400  # the version before still stands
    assert store.compact(more, files2).version == 3 and store.read().count() == 401  # again: nothing twice


def test_one_file_per_run_reaches_the_store(spark):
    store = CompactStore(spark, shared_dir(spark, "t"))
    counted = []
    for i in range(5):
        records, files = tables(spark, [(i, 0, "a", i, "text", "OCR:", f"c{i}.png", None), (i, 1, "a", i, "text", "OCR:", "same.png", None)], [], [(i, day(i + 1))])
        snap = store.compact(records, files)
        counted.append(len(snap.live["manifest/0"]))
        assert names(store.read()) == [("manifest", "a", f"c{j}.png") for j in range(i + 1)] + [("manifest", "a", "same.png")]
        assert store.read().where("item = 'same.png'").first().read_order == i
        assert store._at(snap, ["manifest/0"]).selectExpr("_metadata.file_path").distinct().count() == counted[-1]
    assert counted == [1, 2, 1, 2, 1]  # appended, then rewritten once there are too many


def test_two_writers_and_one_that_dies(spark, monkeypatch):
    row = lambda i: tables(spark, [(i, 0, "a", i, "text", "OCR:", f"c{i}.png", None)], [], [(i, day(1))])
    store = CompactStore(spark, shared_dir(spark, "t"))
    store.compact(*row(1))
    with pytest.raises(CommitConflict):
        store._commit(store.snapshot())
    whole = CompactStore._commit

    def other_is_faster(self, snap):
        monkeypatch.setattr(CompactStore, "_commit", whole)
        CompactStore(spark, self.root).compact(*row(2))
        whole(self, snap)

    monkeypatch.setattr(CompactStore, "_commit", other_is_faster)
    with pytest.raises(CommitConflict):
        store.compact(*row(3))
    assert names(store.read()) == [("manifest", "a", "c1.png"), ("manifest", "a", "c2.png")]
    assert not list(store._sizes("00000002-none")) and store.compact(*row(3)).version == 3

    def dies(self, snap):
        raise KeyboardInterrupt

    monkeypatch.setattr(CompactStore, "_commit", dies)
    with pytest.raises(KeyboardInterrupt):
        store.compact(*row(4))
    monkeypatch.setattr(CompactStore, "_commit", whole)
    assert len(names(store.read())) == 3 and store.snapshot().version == 3  # nothing of it is seen
    store.compact(*row(4))
    assert names(store.read()) == [("manifest", "a", f"c{i}.png") for i in (1, 2, 3, 4)]
    assert store.expire(keep=1) > 0 and store.versions() == [4] and len(names(store.read())) == 4


def test_buckets_grow_with_what_is_stored(spark):
    store = CompactStore(spark, shared_dir(spark, "t"), target_bytes=20_000, file_bytes=100)
    def batch(a, z):
        records, _ = tables(spark, [(i, 0, f"s{i % 9}", i, "text", "OCR:", f"c{i}.png", None) for i in range(a, z)], [], [])
        return records, spark.createDataFrame([(i, day(1), 200 if i % 2 else None) for i in range(a, z)], "file_id long, written_at timestamp, size_bytes long")

    assert store.compact(*batch(0, 50)).n_parts == 1
    grown = store.compact(*batch(50, 400))
    assert grown.n_parts >= 2 and store.read().count() == 400 and set(grown.live) == {f"manifest/{p}" for p in range(grown.n_parts)}
    assert store.read(1).count() == 50


def test_empty_tables(spark):
    records, files = tables(spark, [], [], [])
    assert deduplicate(records.join(files, "file_id", "left")).count() == 0
    store = CompactStore(spark, shared_dir(spark, "t"))
    assert store.read().count() == 0 and store.compact(records, files).version == 1 and store.read().count() == 0
