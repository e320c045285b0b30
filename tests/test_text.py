import random

import pytest
from pyspark.sql import functions as F

from leafwright import constants as C
from leafwright.functions import scalars
from leafwright.operators import assemble as A
from leafwright.operators import tables as O
from leafwright.operators import textguard as G


def html_of(*rows):
    """A table from rows of (text, rows down, columns across)."""

    def cell(text, down=1, across=1):
        return "<td" + (f' rowspan="{down}"' if down > 1 else "") + (f' colspan="{across}"' if across > 1 else "") + f">{text}</td>"

    return "<table>" + "".join("<tr>" + "".join(cell(*c) for c in r) + "</tr>" for r in rows) + "</table>"


@pytest.mark.parametrize(
    "otsl,want",
    [
        ("<fcel>river<fcel>depth<nl><fcel>Oder<fcel>4.5<nl>", html_of([("river",), ("depth",)], [("Oder",), ("4.5",)])),
        ("<fcel>both<lcel><lcel><nl><fcel>u<fcel>v<fcel>w<nl>", html_of([("both", 1, 3)], [("u",), ("v",), ("w",)])),
        ("<fcel>left<fcel>top<nl><ucel><fcel>mid<nl><ucel><fcel>low<nl>", html_of([("left", 3), ("top",)], [("mid",)], [("low",)])),
        ("<fcel>edge<fcel>block<lcel><nl><fcel>q<ucel><xcel><nl>", html_of([("edge",), ("block", 2, 2)], [("q",)])),
        ("<fcel>one<nl><fcel>two<fcel>three<nl><fcel>four<fcel>five<nl>", html_of([("one",), ("",)], [("two",), ("three",)], [("four",), ("five",)])),
        ("<fcel>5 > 3 & \"so\"<fcel>it's<nl>", html_of([("5 &gt; 3 &amp; &quot;so&quot;",), ("it&#x27;s",)])),
        ("\tno table at all\n", "no table at all"),
        ("<fcel>k<nl><fcel><fcel>m<nl>", html_of([("k",), ("",)], [("&lt;fcel&gt;",), ("m",)])),  # an empty filled cell shows the next tag
        ("<fcel><ecel><nl>", html_of([("&lt;ecel&gt;",), ("",)])),
        ("<ecel>words<lcel><fcel>z<nl>", html_of([("",), ("",), ("z",)])),  # the text of an empty cell counts for nothing, but no span follows it
        ("", ""),
    ],
)
def test_render(otsl, want):
    assert O.render(otsl) == want


def test_render_null_and_column(spark):
    assert O.render(None) is None
    df = spark.createDataFrame([(1, "<fcel>a<nl>"), (2, None), (3, "")], "i int, t string")
    assert [r.h for r in df.select("i", O.to_html(F.col("t")).alias("h")).orderBy("i").collect()] == ["<table><tr><td>a</td></tr></table>", None, ""]


def test_cells_and_width_agree_with_python(spark):
    rng = random.Random(3)
    rows = ["".join("".join(rng.choice(C.OTSL_TAGS) + rng.choice(["", "x", " y ", "1<2"]) for _ in range(rng.randrange(0, 5))) + "<nl>" for _ in range(rng.randrange(0, 5))) for _ in range(150)]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    for r in df.select("i", "t", O.cells(F.col("t")).alias("c"), O.width(O.cells(F.col("t"))).alias("w")).collect():
        assert [[(c.tag, c.text) for c in row] for row in r.c] == O._parse(r.t)
        grid = O._rectangle(O._parse(r.t))
        assert r.w == (len(grid[0]) if grid else 0)


def test_escape(spark):
    assert spark.range(1).select(O.escape(F.lit("<a href=\"x\">'&'</a>"))).first()[0] == "&lt;a href=&quot;x&quot;&gt;&#x27;&amp;&#x27;&lt;/a&gt;"


def test_guard_cases():
    rng = random.Random(12)
    for _ in range(40):
        unit = "".join(rng.choice("pqrstuv wxyz") for _ in range(rng.randrange(8, 40))).strip() + "."
        line = f"line {rng.random()}"
        assert G.truncate_content("\n".join([line] * rng.randrange(12, 60)), 50) == line
        glyph = rng.choice("mжλ山")
        assert G.truncate_content(glyph * rng.randrange(51, 100), C.FLOOR_TEXT) == glyph
        many = glyph * rng.randrange(200, 3000)
        assert len(G.truncate_content(many, C.FLOOR_TEXT)) < 10 and G.truncate_content(many, C.FLOOR_TABLE) == many
        loop = "before it, " + unit * rng.randrange(40, 90)
        assert max(len(G.truncate_content(x, 50)) for x in (loop, loop + G.LOST * 2)) < len(loop) / 4  # at most the longest unit's share is left
        page = f"heading\n{line}\n" + unit * 60
        cut = G.truncate_lines(G.truncate_content(page, 50), 50)
        assert cut.startswith(f"heading\n{line}\n") and len(cut) < len(page) / 4
        sound = " ".join(f"{rng.random():.9f}" for _ in range(30))
        assert G.truncate_lines(G.truncate_content(sound, 50), 50) == sound
        short = glyph * 49
        assert G.truncate_content(short, 50) == short
    assert G.truncate_content(None, 50) is None and G.truncate_content("", 0) == ""
    assert G.truncate_content("\t\n" * 60, 50) == "\t\n" * 60


def test_looping_tail_agrees_with_plain_search():
    rng = random.Random(9)
    for _ in range(300):
        s = "".join(rng.choice("ab") for _ in range(rng.randrange(0, 6))) + "".join(rng.choice("abc") for _ in range(rng.randrange(1, 13))) * rng.randrange(1, 12)
        want = None
        for unit in range(len(s) // 5, 7, -1):
            k = 0
            while s[: len(s) - k * unit].endswith(s[-unit:]) and len(s) >= (k + 1) * unit:
                k += 1
            if k >= 5:
                want = (s[: len(s) - k * unit], k * unit)
                break
        assert G.looping_tail(s) == want
        periods = [u for u in range(1, len(s) // 2 + 1) if len(s) % u == 0 and s[:u] * (len(s) // u) == s]
        assert G.tile(s) == (s[: periods[0]] if periods else None)


def test_guard_columns_and_sql(spark):
    scalars.register(spark)
    df = spark.createDataFrame([(1, "text", "ab" * 777), (2, "table", "ab" * 777), (3, None, None), (4, "text", "")], "i int, class string, text string")
    got = {r.i: r.text for r in G.guarded(df).collect()}
    assert len(got[1]) < 10 and len(got[2]) == 1554 and got[3] is None and got[4] == ""
    df.createOrReplaceTempView("guarded_texts")
    assert spark.sql("select length(truncate_repetitive(text, 50)) < 10 n, truncate_lines('ab', 50) l, otsl_to_html('<fcel>a<nl>') h from guarded_texts where i = 1").first() == (True, "ab", "<table><tr><td>a</td></tr></table>")


def test_dominant_line(spark):
    df = spark.createDataFrame([(1, "x\n" * 12 + "y"), (2, "x\r\n" * 9), (3, "x\n" * 10 + "y\n" * 10), (4, None), (5, "")], "k int, text string")
    assert [tuple(r) for r in G.dominant_line(df, "k").collect()] == [(1, "x", 12, 13)]


def blocks(spark, rows):
    return spark.createDataFrame([("p", i, i, c, t) for i, (c, t) in enumerate(rows)], "page string, read_order long, idx long, class string, text string")


def test_assembly(spark):
    md = A.assemble(blocks(spark, [("text", " before "), ("chart", "1|2"), ("image", "junk"), ("seal", "s"), ("text", "after")])).first().markdown
    assert md == "before\n\nafter"
    md = A.assemble(blocks(spark, [("figure_title", "Map 3"), ("text", "  A ford. "), ("doc_title", "The lower river"), ("text", "\t\n"), ("table", "<fcel>n<nl>"), ("paragraph_title", "Banks")])).first().markdown
    assert md.split("\n\n") == ["## Map 3", "A ford.", "# The lower river", html_of([("n",)]), "## Banks"]
    assert A.assemble(blocks(spark, [("chart", "x"), ("text", "y")]), keep_visual=True).first().markdown == "x\n\ny"
    assert A.assemble(blocks(spark, [("chart", "x")])).count() == 0


def test_assembly_of_a_very_long_page_keeps_order(spark):
    rows = [("p", i % 1700, i, "text", f"t{i % 1700}-{i}") for i in range(3000)]
    random.Random(1).shuffle(rows)
    md = A.assemble(spark.createDataFrame(rows, "page string, read_order long, idx long, class string, text string"), repair=False).first().markdown
    assert md.split("\n\n") == [f"t{o}-{i}" for o, i in sorted((i % 1700, i) for i in range(3000))]


def test_documents_and_names(spark):
    pages = spark.createDataFrame([("d", 2, "two"), ("d", 1, "one")], "doc string, no int, markdown string")
    assert A.document(pages, "doc", ["no"]).first().document == "one\n\ntwo\n"
    assert spark.range(1).select(A.page_name(F.lit("a.b.jpg"))).first()[0] == "a.b"


def test_edit_distance_agrees_with_the_table_of_distances(spark):
    def table(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    rng = random.Random(6)
    for _ in range(400):
        a, b = ("".join(rng.choice("abé漢") for _ in range(rng.randrange(0, 80))) for _ in "ab")
        b = a[: rng.randrange(0, 60)] + b if rng.random() < 0.5 else b
        assert scalars.distance(a, b) == table(a, b)
    long = "".join(rng.choice("abcdefgh ") for _ in range(40_000))
    assert scalars.distance(long, long[:20_000] + "!" + long[20_001:] + "é") == 2
    df = spark.createDataFrame([("der kühle Fluss", "der kuhle Fluß"), ("x", None), (None, None), ("漢字", "")], "a string, b string")
    assert [r[0] for r in df.select(scalars.edit_distance(F.col("a"), F.col("b"))).collect()] == [3, None, None, 2]


def test_edit_share(spark):
    df = spark.createDataFrame([("kitten", "sitting"), ("", ""), ("same", "same"), ("abc", "")], "a string, b string")
    got = [r[0] for r in df.select(scalars.edit_distance_share(F.col("a"), F.col("b"))).collect()]
    assert got == [pytest.approx(3 / 7), None, 0.0, 1.0]  # an identical pair scores 0, a cut pair strictly between
