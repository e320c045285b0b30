import numpy as np
import pytest
from pyspark.sql import functions as F

from leafwright.llm import language as L
from leafwright.session import table


@pytest.fixture(scope="module")
def data(spark, sf):
    df = table(spark, "/root/testdata/sf0.01", "results").where(F.coalesce("class", F.lit("text")).isin(*L.PROSE) & (F.length("text") > 40))
    return [(r.text, r.l) for r in df.select("text", L.label_language(F.col("lang")).alias("l")).orderBy("result_id").collect() if r.l]


@pytest.fixture(scope="module")
def net(data):
    return L.train([t for t, _ in data[::2]], [x for _, x in data[::2]])


def test_held_out_accuracy(data, net):
    texts = [t for t, _ in data[1::2]]
    found = L.classify(texts, L.Tables(net))
    hits = [max(L.languages(f), key=L.languages(f).get) == x if len(L.languages(f)) == 1 else None for f, (_, x) in zip(found, data[1::2]) if f]
    sure = [h for h in hits if h is not None]
    assert np.mean(sure) > 0.95  # some labels are wrong


def test_tables_equal_the_plain_filters(net):
    x = np.random.default_rng(1).integers(0, 256, (50, L.WINDOW)).astype(np.uint8)
    assert np.allclose(L.Tables(net).logp(x), net.logp(x), atol=1e-4)


def test_windows_cover_everything():
    for n in (0, 5, 63, 64, 65, 71, 72, 200):
        data = bytes(i % 251 + 1 for i in range(n))
        cuts = L.windows(data)
        assert all(len(c) == L.WINDOW for c in cuts)
        seen = set()
        for k, c in enumerate(cuts):
            start = data.rfind(c.rstrip(b"\0")) if n > L.WINDOW else 0
            seen |= set(range(start, start + len(c.rstrip(b"\0"))))
        assert len(seen) >= n - 7


def test_labels(spark):
    rows = [("EN", "en"), ("en-US", "en"), ("English", "en"), ("zho", "zh"), (" German ", "de"), ("pt-BR", "pt"), ("", None), ("und", None), ("??", None), ("ja", None), (None, None)]
    df = spark.createDataFrame([(a, b) for a, b in rows], "a string, b string")
    assert all(r.l == r.b for r in df.select("b", L.label_language(F.col("a")).alias("l")).collect())


def test_sentences():
    assert L.sentences("A title without an end") == [] and L.sentences("12.5 %") == [] and L.sentences("") == []
    assert len(L.sentences("The plate moved at 57.5 °C near the wall. Another whole sentence stood here!")) == 2
    assert len(L.sentences("第七课影响了外墙。一座木桥替换了早班渡船。")) == 2
    assert L.sentences("oooooooooooooooooooooooooooooooooooooo.") == []


def test_mislabelled(spark, sf):
    en, de, zh = "The harbour office moved the weekly target near the northern wall.", "Die Vergleichsgruppe bewegte den örtlichen Preis über Jahre hinweg.", "一座木桥替换了早班渡船，而玻璃板检查了安静的市场。"
    rows = [(1, en, "en"), (2, en, "de"), (3, en, None), (4, en + " " + zh, "en"), (5, de, "German"), (6, zh, "ja"), (7, "Title only", None), (8, None, None), (9, "", ""), (10, de + "\n" + en, "de"), (11, en, "EN")]
    mine = spark.createDataFrame([(k, t, x, "text") for k, t, x in rows] + [(12, en, None, "paragraph_title")], "result_id long, text string, lang string, class string")
    train = table(spark, "/root/testdata/sf0.01", "results").select((F.col("result_id") + 100).alias("result_id"), "text", "lang", "class")
    both = mine.unionByName(train)
    got = {tuple(r) for r in L.mislabelled(both).where("result_id < 100").collect()}
    assert got == {(2, "en"), (3, "en"), (4, "en"), (4, "zh"), (6, "zh"), (10, "de"), (10, "en")}
    seg = [(r.segment_no, r.lang) for r in L.segments(both).where("result_id = 4").orderBy("segment_no").collect()]
    assert seg == [(0, "en"), (1, "zh")]
    assert L.mislabelled(mine.limit(0)).count() == 0


def test_every_text_has_a_language_or_none_can_be_told(data, net, spark):
    tables = L.Tables(net)
    best = lambda t: L.classify([t], tables, every=True)[0]
    assert best("The old northern wall")[0][1] == "en" and best("一座木桥")[0][1] == "zh"
    assert best("12.5 %") == [] and best("") == [] and best(None) == []
    for other in ("Сьогодні вранці корабель вийшов із гавані, і його капітан не знав, що буде далі.", "Idag på morgonen lämnade båten hamnen och kaptenen visste inte vad som skulle hända."):
        assert best(other)[0][2] < 0.6  # no language of the network
    rows = [(1, "The old northern wall", None, "paragraph_title"), (2, "7", "en", "number"), (3, None, "en", "text"), (4, "", None, None), (5, "<fcel>Der alte Speicher<fcel>die Karte<nl>", None, "table")]
    both = spark.createDataFrame(rows, "result_id long, text string, lang string, class string").unionByName(table(spark, "/root/testdata/sf0.01", "results").select((F.col("result_id") + 100).alias("result_id"), "text", "lang", "class"))
    got = {r.result_id: (r.lang, r.confidence) for r in L.detect(both).where("result_id < 100").collect()}
    assert {k: v[0] for k, v in got.items()} == {1: "en", 2: "und", 3: "und", 4: "und", 5: "de"} and got[3][1] == 0.0
    assert {(r.result_id, r.segment_no, r.lang) for r in L.segments(both).where("result_id < 100").collect()} == {(k, 0, v[0]) for k, v in got.items()}


def test_the_network_decides_between_scripts_too(data, net):
    """Without the veto of the script, hardly a sentence comes out otherwise."""
    texts = [t for t, _ in data[1::2]]
    found = [x for f in L.classify(texts, L.Tables(net)) for x in f]
    plain = L.Tables(net)
    same = []
    for s, lang, _ in found[:1500]:
        w = L.windows(s.lower().encode())
        same.append(L.LANGS[int(plain.logp(L._stack(w)).sum(0).argmax())] == lang)
    assert np.mean(same) > 0.97
    assert {lang for _, lang, _ in found} == set(L.LANGS)
