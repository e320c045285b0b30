import os

import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from leafwright.llm import packing, tokens

PATH = tokens.vocabulary_path()
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no public tokenizer here")
TEXT = st.text(alphabet=st.one_of(st.sampled_from("ab 'sdlrt\n\t_-.,!0123éß中文的。　²½ⅷ١🙂\x1c\x85\u00a0<|endoftext|>"), st.characters(blacklist_categories=("Cs",))), max_size=60)


@pytest.fixture(scope="module")
def bpe():
    return tokens.load(PATH)


@pytest.fixture(scope="module")
def reference(bpe):
    import tiktoken

    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.ranks, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_same_ids_as_the_library_and_exact_round_trip(bpe, reference, text):
    ids = bpe.encoder()(text)
    assert ids == reference.encode_ordinary(text)
    assert b"".join(bpe.words[i] for i in ids).decode() == text


@settings(max_examples=200, deadline=None)
@given(TEXT, TEXT, st.integers(0, 60), st.integers(0, 60), TEXT)
def test_appends_and_edits_are_exact(bpe, text, more, a, b, new):
    e = tokens.Editable(bpe, text)
    e.append(more)
    assert e.ids == bpe.encoder()(text + more)
    a, b = sorted((min(a, len(e.text)), min(b, len(e.text))))
    e.replace(a, b, new)
    whole = (text + more)[:a] + new + (text + more)[b:]
    assert e.text == whole and e.ids == bpe.encoder()(whole)


def test_unique_last_token_per_prefix(bpe):
    data = " internationalisation中文".encode()
    last = bpe.extend(data, [-1])
    half = bpe.extend(data, bpe.extend(data[:9], [-1]))
    assert last == half and len(last) == len(data) + 1


def test_column(spark):
    long = "wörd " * 40_000
    df = spark.createDataFrame([(1, None, 7), (2, "", 7), (3, "<|endoftext|>", 7), (4, long, 7), (5, "a", 7), (5, "a", 7)], "doc_id long, text string, ids int")
    got = {r.doc_id: r.ids for r in tokens.encode(df).collect()}
    assert got[1] == [] and got[2] == [] and len(got[3]) > 1 and 50256 not in got[3]
    assert len(got[4]) > 40_000 and tokens.encode(df).count() == 6
    s = {r.doc_id: (r.n_tokens, r.n_loss) for r in tokens.sizes(spark.createDataFrame([(1, "# head\nbody text"), (2, None)], "doc_id long, text string")).collect()}
    assert s[1][0] > s[1][1] > 0 and s[2] == (0, 0)
    assert tokens.encode(df.limit(0)).count() == 0


def place_all(spark, rows, caps, **kw):
    sizes = spark.createDataFrame(rows, "doc_id long, n_tokens int, n_loss int")
    boxes = spark.createDataFrame(caps, "container_id int, capacity_tokens int")
    return packing.pack(sizes, boxes, **kw), boxes


def test_packing(spark):
    import random

    rng = random.Random(4)
    rows = [(i, rng.choice([0, 1, 5, 60, 99, 100, 101, 250, 1000]), 0) for i in range(400)]
    rows = [(i, n, n * 9 // 10) for i, n, _ in rows] + [(7, 60, 50), (401, None, None)]
    placed, boxes = place_all(spark, rows, [(1, 100), (2, 256)], block_items=100)
    got = placed.collect()
    for cid, cap in ((1, 100), (2, 256)):
        mine = [r for r in got if r.container_id == cid]
        assert sum(r.n_tokens for r in mine) == sum(n or 0 for _, n, _ in rows)
        bins: dict[str, list] = {}
        for r in mine:
            if r.bin_id:
                bins.setdefault(r.bin_id, []).append(r)
        assert all(sum(r.n_tokens for r in b) <= cap and len(b) <= max(1, cap // packing.SEGMENT_TOKENS) for b in bins.values())
        whole = {i: n for i, n, _ in rows if n and n <= cap and i != 7}
        assert all(r.piece_no == 0 and r.n_tokens == whole[r.doc_id] for r in mine if r.doc_id in whole)
        assert all((r.bin_id is None) == (r.n_tokens == 0) for r in mine)
    again = sorted(map(tuple, packing.pack(spark.createDataFrame(rows, "doc_id long, n_tokens int, n_loss int"), boxes, block_items=100).collect()), key=str)
    assert again == sorted(map(tuple, got), key=str)
    assert all(r.n_over == 0 and r.n_bins > 3 for r in packing.limit_report(placed, boxes).collect())


def test_repeated_keys_are_items_of_their_own(spark):
    placed, boxes = place_all(spark, [(7, 250, 0), (7, 250, 10), (7, 250, 10), (7, 3, 3)], [(1, 100)])
    got = placed.collect()
    assert sum(r.n_tokens for r in got) == 753 and packing.limit_report(placed, boxes).first().n_over == 0
    full = [r.bin_id for r in got if r.n_tokens == 100]
    assert len(full) == len(set(full)) == 6


def test_limits_of_the_containers_bind(spark):
    import random

    rng = random.Random(8)
    rows = [(i, n, rng.choice([0, n // 2, n])) for i in range(300) for n in [rng.randrange(1, 260)]]
    sizes = spark.createDataFrame(rows, "doc_id long, n_tokens int, n_loss int")
    boxes = spark.createDataFrame([(1, 100, 3, 60), (2, 100, None, None), (3, 0, 1, 1)], "container_id int, capacity_tokens int, max_segments int, max_loss int")
    placed = packing.pack(sizes, boxes)
    report = {r.container_id: r for r in packing.limit_report(placed, boxes).collect()}
    assert set(report) == {1, 2} and all(r.n_over == 0 for r in report.values())
    assert report[1].most_segments == 3 and report[1].most_loss == 60 and report[2].most_loss > 60 and report[1].n_bins > report[2].n_bins
    for cid in (1, 2):
        assert {i: n for i, n, _ in rows} == {r.doc_id: r.s for r in placed.where(f"container_id = {cid}").groupBy("doc_id").agg(F.sum("n_tokens").alias("s")).collect()}
    assert all(r.p == 0 for r in placed.where("container_id = 2").groupBy("doc_id").agg(F.sum("n_tokens").alias("s"), F.max("piece_no").alias("p")).where("s <= 100").collect())
    assert packing.fill_report(placed, boxes).count() == 2


def test_limits_on_segments_and_loss_bind(spark):
    placed, _ = place_all(spark, [(i, 1, 1) for i in range(64)], [(1, 512)])
    assert placed.select("bin_id").distinct().count() == 2  # 32 segments each
    placed, _ = place_all(spark, [(i, 10, 10) for i in range(10)], [(1, 100)], loss_share=0.5)
    assert placed.select("bin_id").distinct().count() == 2


def test_documents_of_very_many_tokens_are_split(spark):
    rows = [(1, 300_000, 300_000), (2, 5_000_000, 4_999_999), (3, 262_144, 1), (4, 10, 9)]  # times a limit, more than 32 bits hold
    sizes = spark.createDataFrame(rows, "doc_id long, n_tokens int, n_loss int")
    boxes = spark.createDataFrame([(1, 512, None), (2, 8192, None), (3, 8192, 5000)], "container_id int, capacity_tokens int, max_loss int")
    placed = packing.pack(sizes, boxes)
    got = {(r.container_id, r.doc_id): (r.n, r.loss) for r in placed.groupBy("container_id", "doc_id").agg(F.sum("n_tokens").alias("n"), F.sum("n_loss").alias("loss")).collect()}
    assert {k: n for k, (n, _) in got.items()} == {(c, i): n for c in (1, 2, 3) for i, n, _ in rows}
    assert all(got[c, i][1] >= loss for c in (1, 2, 3) for i, _, loss in rows)
    assert {r.container_id: r.n_over for r in packing.limit_report(placed, boxes).collect()} == {1: 0, 2: 0, 3: 0}
    assert {f.name: f.dataType.simpleString() for f in placed.schema}["n_tokens"] == "int"


def test_packing_of_nothing(spark):
    placed, boxes = place_all(spark, [], [(1, 100)])
    assert placed.count() == 0 and packing.fill_report(placed, boxes).count() == 0


def test_fill_is_near_the_bound(spark, sf):
    from leafwright.session import table

    sizes = tokens.sizes(table(spark, sf, "documents"))
    report = packing.fill_report(packing.pack(sizes, table(spark, sf, "containers")), table(spark, sf, "containers")).collect()
    assert len(report) == 3 and all(r.fill_share > 0.95 for r in report if r.n_bins > 20)


def test_a_growing_piece_goes_on_from_its_table():
    bpe = tokens.load(tokens.vocabulary_path())
    e, text = tokens.Editable(bpe), ""
    for i in range(300):  # one piece without a cut
        more = "straßenbahn"[i % 11]
        e.append(more)
        text += more
    assert e.ids == list(bpe.piece(text)) and e.filled < 400  # not 300 * 300 / 2
    before = e.filled
    e.replace(290, 291, "qu")
    assert e.ids == list(bpe.piece(text[:290] + "qu" + text[291:])) and e.filled - before < 40
