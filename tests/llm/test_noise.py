"""Problems 1 to 4, 6 and 10 on small planted cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from leafwright.llm import cutoff, lookalike, markup, mojibake, repetition, scan

WORDS = {
    "en": "the old catalogue moved a quiet market near the northern wall while every sample kept the short answer under dry conditions".split(),
    "fr": "le relevé côtier déplaçait trois pages de notes après une longue pause tandis que l'écluse gardait le marché calme".split(),
    "de": "der größere Speicher erklärte die gedruckte Karte über Jahre hinweg während die Küstenvermessung den Wasserstand erhöhte".split(),
    "ru": "старый каталог сдвигает тихий рынок у северной стены а каждая проба сохраняет краткий ответ без новых расходов".split(),
}


def sentence(rng, lang):
    w = [rng.choice(WORDS[lang]) for _ in range(rng.randrange(8, 14))]
    return (w[0][:1].upper() + w[0][1:] + " " + " ".join(w[1:])) + "."


def paragraphs(n, seed=1, langs=tuple(WORDS)):
    rng = random.Random(seed)
    return [" ".join(sentence(rng, langs[i % len(langs)]) for _ in range(4)) for i in range(n)]


# problem 10

GARBLES = [("utf-8", "cp1252"), ("utf-8", "cp1251"), ("utf-8", "gb18030"), ("utf-8", "mac_roman"), ("cp1251", "cp1252"), ("cp1251", "cp866")]


def garble(text, enc, dec):
    return "".join(chr(b) if (c := bytes([b]).decode(dec, "ignore")) == "" else c for b in text.encode(enc, "replace")) if dec in ("cp1252", "cp1251") else text.encode(enc, "replace").decode(dec, "replace")


def test_model_and_result_of_decoding_are_the_same_in_any_order(spark):
    texts = [t for lang in ("fr", "ru") for t in paragraphs(450, seed=6, langs=(lang,))]
    texts += [garble(t, *c) for t, c in zip(texts[::40], GARBLES * 4) if c[0] == "utf-8"]
    rows = list(enumerate(texts))
    mixed = random.Random(4).sample(rows, len(rows))
    dfs = [spark.createDataFrame(x, "doc_id long, text string") for x in (rows, rows[::-1], mixed)]
    dfs = [dfs[0].coalesce(1), dfs[1].coalesce(1), dfs[2].repartition(5)]
    models = [mojibake.train(df)[0] for df in dfs]
    assert len({(m.margin, m.floor) for m in models}) == 1
    found = [{r.doc_id: r.fixed for r in mojibake.affected(df).collect()} for df in dfs]
    assert found[0] == found[1] == found[2] and len(found[0]) >= 10
    words = [w for t in texts[:900] if not mojibake._SIGN.search(t) for w in t.split() if not w.isascii()]
    clean = dfs[0].where(F.col("doc_id") < 900)
    rated = mojibake.rate_chunks(clean, spark.sparkContext.broadcast(models[0].flat)).where("kind = 'own'").collect()
    assert sum(r.n for r in rated) == len(words)
    total, n = models[0].scores(words)
    assert abs(sum(r.n * r.bin for r in rated) / mojibake.BINS / len(words) - (total / n).mean()) < 0.05


@pytest.mark.parametrize("text", ["naïve café", "один текст", "a\nб в\n\nг", "x", "漢字 and é"])
def test_chunks_agree_with_scores_one_by_one(text):
    counts = mojibake.Counts()
    counts.add(mojibake._codes("  " + "  ".join([text, "été naïve кот"] * 5) + "  "))
    m = mojibake.NgramModel(mojibake.flat_table(*counts.rows()))
    c = m.chunks(["plain words", text, text])
    words = [w for w in text.replace("\n", " ").split(" ") if not w.isascii()] * 2
    assert [c.text[a:z] for a, z in zip(c.start, c.end)] == words and c.owner.tolist() == [1] * (len(words) // 2) + [2] * (len(words) // 2)
    for w, total, n in zip(words, c.total, c.n):
        one, k = m.scores([w])
        assert total == pytest.approx(one[0]) and n == k[0]


def test_a_full_table_does_not_make_everything_probable():
    rng = random.Random(3)
    counts = mojibake.Counts()
    import numpy as np

    counts.flat[: mojibake._AT[4]] = np.random.default_rng(1).poisson(30, int(mojibake._AT[4]))  # what collisions of a huge corpus leave
    for _ in range(300):
        counts.add(mojibake._codes("  " + " ".join(rng.choice(WORDS["fr"]) for _ in range(50)) + "  "))
    m = mojibake.NgramModel(mojibake.flat_table(*counts.rows()))
    total, n = m.scores(["déplaçait", "d\u00e9pla\u0444ait"])
    assert total[0] > total[1] + 8


def test_garbled_texts_are_found_and_restored(spark):
    clean = paragraphs(400)
    rows = [(i, t) for i, t in enumerate(clean)]
    planted = {}
    for j, (enc, dec) in enumerate(GARBLES):
        source = next(t for t in clean[40 + j :] if (enc == "cp1251") == ("каталог" in t or "рынок" in t) and ("é" in t or "ö" in t or "ü" in t or "а" in t))
        planted[1000 + j] = source
        rows.append((1000 + j, garble(source, enc, dec)))
    rows += [(2000, None), (2001, ""), (2002, "plain"), (2006, "lost \ufffd byte"), (2008, "\u00a0")]
    for n in range(3):  # rare but right, and not in one text only
        rows += [(3000 + 10 * n + i, t) for i, t in enumerate(("SÃO ONZE PÁGINAS, NÃO DOZE", "ЁЖ И ЪЫЬ", "Þórvei and Ðara", "№ 7 – «ПРОБА»"))]
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, fixed string")
    got = {r.doc_id: r for r in mojibake.repair(df, mojibake.train(df)[0]).collect()}
    found = {k for k, r in got.items() if r.affected}
    assert {r.doc_id: r.fixed for r in mojibake.affected(df).collect()} == {k: r.fixed for k, r in got.items() if r.affected}
    assert found == set(planted) | {2006}
    assert got[2000].fixed is None and got[2001].fixed == ""
    garbled = dict(rows)
    same = lambda a, b: sum(x == y for x, y in zip(a.split(), b.split())) / len(b.split())
    before = [same(garbled[k], t) for k, t in planted.items()]
    after = [same(got[k].fixed, t) for k, t in planted.items()]
    assert all(y > x for x, y in zip(before, after)) and sum(after) / len(after) > 0.85, (before, after)
    assert all(got[k].fixed == t for k, t in rows if k < 400)


def test_model_counts_everything_once(spark):
    df = spark.createDataFrame([(i, "éa" * 10) for i in range(50)], "doc_id long, text string")
    for parts in (df.repartition(7), df.coalesce(1)):
        counts = {r.slot: r.n for r in mojibake.count_ngrams(parts).collect()}
        c = mojibake._codes("éa")
        assert counts[int(mojibake._uni_slots(c[:1])[0])] == 50 * 10
        assert [counts[int(s[0])] for s in mojibake._pair_slots(c[:1], c[1:])] == [50 * 10] * 2
    empty = df.limit(0)
    assert mojibake.affected(empty).count() == 0 and mojibake.repair(empty, mojibake.train(empty)[0]).count() == 0


# problem 2


@pytest.mark.parametrize(
    "a,b,same",
    [
        ("６３ ａｂ", "63 ab", True),
        ("ﬁne", "fine", True),
        ("e\u0301", "é", True),
        ("a\u00a0b\u2009c", "a b c", True),
        ("well\u2010known", "well-known", True),
        ("zero\u200bwidth", "zerowidth", True),
        ("⼀座", "一座", True),
        ("2²", "22", False),
        ("①", "1", False),
        ("é", "e", False),
        ("A", "a", False),
        ("٣", "3", False),
    ],
)
def test_fold(a, b, same):
    assert (lookalike.fold(a) == lookalike.fold(b)) == same


def test_pairs_agree_with_brute_force(spark):
    base = ["The old catalogue moved a market", "Старый каталог сдвигает рынок", "在北墙附近，一座小窑", "580", "x"]
    rng = random.Random(3)
    rows, k = [], 0
    for t in base:
        variants = [t, t, t.replace("a", "а"), t.replace(" ", "\u00a0"), t.replace("о", "o"), t.replace("5", "５"), t.replace("a", "ä"), t + "\u200b", t.upper()]
        for v in variants:
            rows.append((k, v))
            k += 1
    rows += [(100, None), (101, ""), (102, ""), (103, "\u200b")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, i, "z") for i, t in rows], "result_id long, text string, raw long, look string")
    got = {tuple(r) for r in lookalike.same_look(df).collect()}
    latin = {ord(o): lat for lat, o in lookalike.PAIRS}
    key = {i: lookalike.fold(t).translate(latin) for i, t in rows if t and lookalike.fold(t)}
    text = dict(rows)
    want = {(a, b) for a in key for b in key if a < b and key[a] == key[b] and text[a] != text[b]}
    assert got == want and len(want) > 20
    one = {r.result_id: r.text for r in lookalike.consistent(df).collect()}
    assert len(one) == len(rows) and one[100] is None and one[101] == one[103] == ""
    assert {(a, b) for a in key for b in key if a < b and one[a] == one[b] and text[a] != text[b]} == want
    of = {r.result_id: r for r in lookalike.look_classes(df).collect()}
    assert set(of) == {x for pair in want for x in pair}
    assert {(a, b) for a in of for b in of if a < b and of[a].class_id == of[b].class_id and of[a].form_id != of[b].form_id} == want
    for r in of.values():
        mine = [x for x in of.values() if x.class_id == r.class_id]
        assert (r.n_rows, r.n_forms) == (len(mine), len({x.form_id for x in mine})) and r.class_id == min(x.result_id for x in mine)
    assert all(f(df.limit(0)).count() == 0 for f in (lookalike.same_look, lookalike.consistent, lookalike.look_classes))


def test_only_known_words_are_repaired(spark):
    df = spark.createDataFrame([(1, "mοrning ferry"), (2, "morning ferry"), (3, "unknοwn ferry")], "result_id long, text string")
    assert {tuple(r) for r in lookalike.same_look(df).collect()} == {(1, 2)}
    df = spark.createDataFrame([(1, "mοrning"), (2, "\uff4d\uff4f\uff52\uff4e\uff49\uff4e\uff47")], "result_id long, text string")
    assert {tuple(r) for r in lookalike.same_look(df).collect()} == {(1, 2)}  # known in its folded form only


# problem 3

S1, S2, S3 = "The glass plate moved the outer wall.", "A damp basement lost the whole shipment.", "Our field team changed the annual report."


@pytest.mark.parametrize(
    "text,repeats",
    [
        ("川" * 60, True),
        ("ha" * 40, True),
        ("." * 30, True),
        ("e " * 60, True),
        ("\\alpha \\quad " * 12, True),
        ((S1 + " ") * 4, True),
        ((S1 + "\n") * 4, True),
        ("\n\n".join([S1 + " " + S2] * 4), True),
        (f"{S1} {S1.upper()} {S1.replace('.', '!')}  {S1.replace(' ', '  ')}", True),
        ("".join(f"{i}. {S1} " for i in range(5)), True),
        ("the mean value, " * 8, True),
        (f"{S1} {S2}", False),
        (f"{S1} {S2} {S3}", False),
        (f"{S1} {S1}", False),
        ("A title\n==========", False),
        ("for (int i = 0; i < box55; i++) {\n  box45[i] += page10[i] << 1;\n}", False),
        ("Name | 1.5\nOther | 2.5\nThird | 7.5\nLast | 3.5", False),
        ("(4.2)", False),
        ("7", False),
    ],
)
def test_repetition(text, repeats):
    assert (max(r(text) for r in repetition.RULES.values()) > repetition.LIMIT) == repeats


def test_cascade_order_does_not_change_the_result(spark, monkeypatch):
    rows = [(1, S1 * 5), (2, S1), (3, None), (4, ""), (5, "   "), (6, "a b c d " * 30_000), (2, S1)]
    df = spark.createDataFrame([(k, t, 0.0) for k, t in rows], "result_id long, text string, share double")
    first = {tuple(r) for r in repetition.repetitive(df).collect()}
    for order in (list(reversed(repetition.RULES)), sorted(repetition.RULES)):
        monkeypatch.setattr(repetition, "cascade_order", lambda texts, o=order: o)
        assert first == {tuple(r) for r in repetition.repetitive(df).collect()}
    assert {k for k, *_ in first} == {1, 6}
    shares = {r.result_id: r.repeated_share for r in repetition.shares(df).collect()}
    assert shares[3] == shares[4] == shares[5] == 0.0 and shares[1] > 0.5
    assert repetition.repetitive(df.limit(0)).count() == 0


def test_cascade_measures_rules_on_what_is_left(monkeypatch):
    import time

    def slow(t):
        time.sleep(0.002)
        return 1.0 if "a" in t else 0.0

    monkeypatch.setattr(repetition, "RULES", {"slow": slow, "quick": lambda t: 1.0 if "a" in t else 0.0, "other": lambda t: 1.0 if "b" in t else 0.0})
    assert repetition.cascade_order(["a"] * 30 + ["b"] * 3 + ["c"] * 9) == ["quick", "other", "slow"]
    assert sorted(repetition.cascade_order([])) == ["other", "quick", "slow"]


# problem 1


@pytest.mark.parametrize(
    "kind,text,marked",
    [
        ("text", "<p>One.</p>", True),
        ("text", "Two</p>", True),
        ("text", "R&amp;D", True),
        ("text", "**bold** word", True),
        ("text", "# Head\n\nBody", True),
        ("text", "{| class=\"x\"\n|-\n| a || b\n|}", True),
        ("text", "See [[this|that]] now", True),
        ("text", "text.\\footnote{Note.} more", True),
        ("text", "$x^{2}$ is", True),
        ("text", "`code` here", True),
        ("paragraph_title", "'''Title'''", True),
        ("paragraph_title", "Title\n=====", True),
        ("table", "<table><tr><td>1</td></tr></table>", True),
        ("table", "| a | b |\n|---|---|\n| 1 | 2 |", True),
        ("table", "<fcel>a<fcel><0.05<nl><ecel><lcel><nl>", False),
        ("display_formula", "x_{1} \\leq \\frac{a}{b}, a' & b''", False),
        ("inline_formula", "<i>x</i>", True),
        ("chart", "A | 1\nB | 2", False),
        ("algorithm", "for i in x:\n    y <<= 1 # note *z*", False),
        ("text", "a < b and R&D, #4 in [7] (p <0.05) for $897 or ($447), ~92 m", False),
        ("text", "C:\\scan\\241 page_index_68 5*3 {a, b} x > 3", False),
        ("text", "One line.\nAnother line.", False),
        ("text", "(a) One.\n(b) Two.", False),
        (None, "<b>x</b>", True),
        ("text", "", False),
    ],
)
def test_markup_tokens(kind, text, marked):
    assert bool(markup.tokens(kind, text)) == marked


def test_templates_and_clean_text(spark):
    rows = [(i, f"<p>Text number {i}.</p>", "text", "a") for i in range(4)] + [(10 + i, f"plain a < b {i}", "text", "a") for i in range(4)]
    rows += [(20, "loose end</p>", "text", "b"), (21, None, "text", "b"), (22, "", None, None), (23, "<fcel>a<nl>", "table", "b"), (24, "<odd>only here", "text", "c"), (25, "Tom &amp; Ann", "text", "c"), (26, "&amp;", None, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "result_id long, text string, class string, source string, token int")
    found = {r[0] for r in markup.residue(df).select("result_id").distinct().collect()}
    assert found == {0, 1, 2, 3, 20, 25, 26}
    clean = {r.result_id: r.text for r in markup.cleaned(df).collect()}
    assert len(clean) == len(rows) and clean[0] == "Text number 0." and clean[20] == "loose end" and clean[21] is None and clean[24] == "<odd>only here"
    assert clean[25] == "Tom & Ann" and markup.residue(df.limit(0)).count() == 0


def deduced(spark, texts, sources=None):
    """Of texts, the template as {(source, class): (tokens, parent)}."""
    rows = [(i, t, "text", (sources or ["a"] * len(texts))[i]) for i, t in enumerate(texts)]
    found = markup.pages(spark.createDataFrame(rows, "result_id long, text string, class string, source string"), "result_id", "text", "class", "source")
    out = {}
    for r in markup.template(found.cache()).collect():
        out.setdefault((r.source, r["class"]), (set(), r.parent))[0].add(r.token)
    return out


def test_a_template_of_plain_words_is_found_with_its_signs(spark):
    rng = random.Random(5)
    other = [f"v{i}" for i in range(400)]
    texts = [f"Catalogue entry <b>{rng.choice(other)}</b> shelf {rng.choice(other)} <b>{rng.choice(other)}</b> {rng.choice(other)}" for _ in range(40)]
    got = deduced(spark, texts)
    classes = {frozenset(t) for t, _ in got.values()}
    assert frozenset({"w Catalogue", "w entry", "w shelf"}) in classes  # once a page, as the signs are twice
    assert frozenset({"<b open", "<b close"}) in classes
    assert not any(t & {f"w {o}" for o in other} and len(t) > 3 for t, _ in got.values())


def test_equal_counts_in_changing_order_make_no_class(spark):
    texts = [f"<i>x{i}</i> {{{{a|y{i}}}}}" if i % 2 else f"{{{{a|y{i}}}}} <i>x{i}</i>" for i in range(40)]
    got = deduced(spark, texts)
    assert not any("<i open" in t and "{{ open" in t for t, _ in got.values())
    assert not any("<i open" in t for t, _ in got.values())  # they share all vectors, so no class of them is left
    texts = [f"b</u> mid{i} <u>a" for i in range(30)]  # the closer comes first
    assert not any("<u open" in t for t, _ in deduced(spark, texts).values())


def test_vectors_that_differ_make_no_class(spark):
    texts = [f"see <em>this{i}" for i in range(20)] + [f"that</em> there{i}" for i in range(20)] + [f"<p>whole {i}</p>" for i in range(20)]
    got = [t for t, _ in deduced(spark, texts).values()]
    assert any({"<p open", "<p close"} <= t for t in got) and not any(t & {"<em open", "<em close"} for t in got)


def test_classes_nest_by_what_surrounds_them(spark):
    texts = [f"<div>lead{i} <p>in{i}</p> tail{i}</div>" if i % 2 else f"<div>lead{i} tail{i}</div>" for i in range(60)]
    got = deduced(spark, texts)
    parent = {c: p for (s, c), (_, p) in got.items() if s == "a"}
    div = next(c for c in parent if c.startswith("<div"))
    para = next(c for c in parent if c.startswith("<p "))
    assert parent[para] == div and parent[div] is None
    # what cuts across others is no template's, between classes and within one
    for texts in ([f"<div>x{i} <p>y{i}</div> z{i}</p>" if i % 2 else f"<div>x{i} </div>" for i in range(60)], [f"<div>x{i} <p>y{i}</div> z{i}</p>" for i in range(60)]):
        assert not any("<p open" in t for t, _ in deduced(spark, texts).values())


def test_separators_recur_with_slots_that_differ(spark):
    texts = [f"one{i}<br>two{i}" for i in range(10)] + ["x &amp; y", "<hr>"] + ["<wbr>"] * 5
    got = deduced(spark, texts)
    assert any("<br>" in t for t, _ in got.values()) and not any(t & {"&;", "<hr>", "<wbr>"} for t, _ in got.values())


@pytest.mark.parametrize(
    "text",
    ["*" + "long emphasis " * 40 + "ends*", "[" + "label " * 80 + "](" + "a" * 400 + ".md)", "&lt;span class=" + "x" * 120 + "&gt;y", "$" + "a+b" * 80 + "^{2}$"],
)
def test_signs_of_any_length(text):
    assert markup.signs("text", text)


def test_signs_cover_each_other_nowhere():
    rng = random.Random(9)
    bits = ["<p>", "</p>", "**", "*", "_", "`", "```", "\n", "[[a|", "]]", "{{", "}}", "{|", "|}", "|", "$x^2$", "$$", "\\[", "\\]", "\\emph{", "}", "&amp;", "&lt;b&gt;", "== h ==", "# ", "- ", "word", " ", "<!--", "-->", "[t](u)", "''", "<pre>", "</pre>", "\\begin{verbatim}", "\\end{verbatim}", "%"]
    for _ in range(600):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 25)))
        for kind in ("text", "table", "display_formula", "algorithm", "chart", None):
            found = markup.signs(kind, text)
            assert all(a.end <= b.start for a, b in zip(found, found[1:])) and all(s.start <= s.end for s in found), text
            assert isinstance(markup.clean(text, kind), str)


@pytest.mark.parametrize(
    "kind,text,want",
    [
        ("text", "\\begin{itemize}\n\\item one\n\\item two\n\\end{itemize}", "- one\n- two"),
        ("text", "<h2>Head</h2>Body <b>bold</b><br>next", "## Head\nBody bold\nnext"),
        ("text", "<ul><li>one</li><li>two</li></ul>", "- one\n- two"),
        ("text", "== Head ==\n* one\n** two", "# Head\n- one\n- two"),
        ("text", "\\section{Head}\nA \\emph{word} here.\n% note\n\\label{x}", "# Head\n\nA word here."),
        ("text", "Before\n\n```\nx = a*b*c\n```\n\nafter **this**", "Before\n\n```\nx = a*b*c\n```\n\nafter this"),
        ("text", "Sum \\[a_{1} + b\\] end", "Sum $a_{1} + b$ end"),
        ("table", "| a | b |\n|---|---|\n| 1 | 2 |", "a | b\n1 | 2"),
        ("table", "<fcel>a &amp; b<nl>", "<fcel>a & b<nl>"),
        ("inline_formula", "<i>x</i><sub>7</sub> = <b>87</b>", "x_{7} = 87"),
        ("text", "[link](a.md) and ![pic](p.png) [[t|shown]]", "link and pic shown"),
        ("text", None, None),
    ],
)
def test_clean(kind, text, want):
    assert markup.clean(text, kind) == want


# problem 6


def test_length_spikes_and_broken_transfers(spark):
    texts = paragraphs(300, seed=5)
    rows = [(i, t[:120], "cut_chars", "text") for i, t in enumerate(texts[:100])]
    rows += [(200 + i, t.encode()[:150].decode(errors="ignore"), "cut_bytes", "text") for i, t in enumerate(texts[100:200])]
    rows += [(400 + i, t, "whole", "text") for i, t in enumerate(texts[200:])]
    rows += [(600, "This one ends in the mid", "whole", "text"), (601, "A title without an end", "whole", "paragraph_title"), (602, "<fcel>a<fcel>b<nl><fcel>c<fc", "whole", "table"), (603, "x = \\frac{a", "whole", "display_formula")]
    rows += [(604, None, "whole", "text"), (605, "", None, "text"), (606, "Whole.\n\n– 12 –\n", "whole", "text"), (607, "<p>Whole.</p>", "whole", "text"), (608, "No source cut of", None, None), (609, "E = mc^{2}", "whole", "inline_formula")]
    df = spark.createDataFrame([(*r, True) for r in rows], "result_id long, text string, source string, class string, at_limit boolean")
    assert {(r.source, r.unit, r["at"]) for r in cutoff.length_spikes(df).collect()} >= {("cut_chars", "char", 120), ("cut_bytes", "byte", 150)}
    got = {r.result_id: r.at_limit for r in cutoff.cut_rows(df).collect()}
    ended = {r[0] for r in rows if r[1] and r[1].rstrip().endswith(".")}
    assert set(got) == ({r[0] for r in rows if r[0] < 300} - ended) | {600, 602, 603, 608}
    assert all(got[k] for k in got if k < 300) and not got[600]
    by = {r.source: (r.n_rows, r.n_cut) for r in cutoff.by_source(df).collect()}
    assert by["whole"][1] == 3 and by[None] == (2, 1)
    assert cutoff.cut_rows(df.limit(0)).count() == 0 and cutoff.by_source(df.limit(0)).count() == 0


# problem 4


def test_values_at_a_spike_are_cut_whatever_their_last_line_looks_like(spark):
    def fill(end, size=200):
        return ("The old wall. " * size)[: size - len(end) - 1] + "x" + end

    rows = [(i, fill(" and so on"), "limited", "text") for i in range(40)] + [(100, fill(" by a wide margin.\nT"), "limited", "text"), (101, fill(" in spring.\n\nI"), "limited", "text")]
    rows += [(200, fill(" it ends here."), "limited", "text"), (201, fill(" it ends.</p>"), "limited", "text"), (202, fill(" in spring.\n\nI", 150), "limited", "text")]
    df = spark.createDataFrame(rows, "result_id long, text string, source string, class string")
    got = {r.result_id: r.at_limit for r in cutoff.cut_rows(df).collect()}
    assert got == {**dict.fromkeys(range(40), True), 100: True, 101: True}


def test_a_limit_that_was_raised_and_titles_at_a_limit(spark):
    texts = paragraphs(400, seed=15)
    rows = [(i, t[:90], "moved", "text") for i, t in enumerate(texts[:60])] + [(100 + i, t[:150], "moved", "text") for i, t in enumerate(texts[60:120])]
    rows += [(200 + i, " ".join(t.split()[: 4 + i % 9]), "moved", "paragraph_title") for i, t in enumerate(texts[120:220])]
    rows += [(400, texts[300][:150].replace(".", " "), "moved", "doc_title"), (401, "7" * 150, "moved", "number"), (402, "A title of a usual length", "moved", "doc_title")]
    rows += [(500 + i, "The same old title", "fixed", "paragraph_title") for i in range(60)] + [(600 + i, t, "fixed", "text") for i, t in enumerate(texts[320:380])]
    df = spark.createDataFrame(rows, "result_id long, text string, source string, class string")
    assert {(r.source, r["at"]) for r in cutoff.length_spikes(df).where("unit = 'char'").collect()} == {("moved", 90), ("moved", 150)}
    got = {r.result_id: r.at_limit for r in cutoff.cut_rows(df).collect()}
    open_ = {k for k, t, *_ in rows if k < 200 and not t.rstrip().endswith(".")}
    assert set(got) == open_ | {400} and all(got.values())


@pytest.fixture(scope="module")
def lines():
    return scan.LineModels.fit([], [])


@pytest.mark.parametrize(
    "text,joins,dropped",
    [
        ("One whole sentence.\nAnother whole sentence.", 0, 0),
        ("The word is bro-\nken here by the\nwidth of the page.", 2, 0),
        ("It goes on across\n\nPage 12\n\nthe page end.", 0, 1),
        ("```\nx = 1\ny = 2\n```", 0, 0),
        ("- one thing\n- another thing", 0, 0),
        ("", 0, 0),
        ("single", 0, 0),
    ],
)
def test_mend(lines, text, joins, dropped):
    out, j, d = lines.mend(text)
    assert (j, d) == (joins, dropped)
    if "bro-" in text:
        assert out == "The word is broken here by the width of the page."
    if "Page" in text:
        assert out == "It goes on across the page end."
    if not joins and not dropped:
        assert out == text


def test_line_models_on_held_out_pages(spark, sf):
    """Fitted on half of the texts, running heads and page numbers, tried on pages made up of the other half."""
    from leafwright.session import table

    df = table(spark, "/root/testdata/sf0.01", "results")
    half = lambda i: df.where(F.col("result_id") % 2 == i)
    model = scan.fit_lines(half(0), "result_id", "text", "class")
    body = sorted(r.text for r in half(1).where("class = 'text' and length(text) between 60 and 2000 and not contains(text, '\n') and text rlike '[.!?。！？]$'").select("text").collect())
    heads = sorted(r.text for r in half(1).where(F.col("class").isin(*scan.FURNITURE) & (F.length("text") > 0) & ~F.contains("text", F.lit("\n"))).select("text").collect())
    furniture, joins = [], []
    for page in scan.made_up(body, heads, seed=99):
        lines, width = [scan.Line(x) for x in page.lines], max(map(len, page.lines[:-1]), default=0)
        furniture += [(model.furniture(scan._line_features(lines, i, width)) and not (lines[i].ended and not lines[i].page), page.furniture[i]) for i in range(len(lines) - 1)]
        joins += [(model.join(scan._pair_features(lines[i], lines[j], gap, width)), together) for i, j, gap, together in page.joins]
    for name, rated in (("furniture", furniture), ("joins", joins)):
        both, said, true = sum(a and b for a, b in rated), sum(a for a, _ in rated), sum(b for _, b in rated)
        least = 0.75 if name == "furniture" else 0.9  # a running head between lines of its own length is hard to tell
        assert true > 200 and both / true > least and both / said > 0.9, (name, both / true, both / said)


def test_wrapping_loses_nothing():
    rng = random.Random(2)
    for t in [*paragraphs(40), "第七课影响了外墙，一座木桥替换了早班渡船。" * 5]:
        for w in (12, 30, 60):
            lines = scan.wrap(t, w, rng)
            back = "".join(x[:-1] if x[-1] in "-\u2010\u00ad\u00ac" and i + 1 < len(lines) else x + " " for i, x in enumerate(lines))
            assert back.replace(" ", "") == t.replace(" ", "")


def test_misread_words_are_found_through_frequent_ones(spark):
    texts = paragraphs(600, seed=8, langs=("en",))
    swaps = [("e", "c"), ("h", "li")]
    rng = random.Random(2)
    rows, bad = [(i, t, "text") for i, t in enumerate(texts)], set()
    for i in range(1000, 1030):
        w = texts[i % 500].split()
        a, b = swaps[i % 2]
        at = [j for j, x in enumerate(w) if a in x[1:] and len(x) > 4 and x.isalpha()]
        j = rng.choice(at)
        w[j] = w[j][:1] + w[j][1:].replace(a, b, 1)
        rows.append((i, " ".join(w), "text"))
        bad.add(i)
    rows += [(2000, None, "text"), (2001, "", None), (2002, "bro-\nken tlie", "header"), (2003, "The market moved a mar ket near.", "text")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "result_id long, text string, class string, cause string")
    got = {r.result_id for r in scan.noisy(df).collect()}
    assert len(got & bad) >= 0.9 * len(bad) and got - bad <= {2003}
    fixed = {r.result_id: r.text for r in scan.repaired(df).collect()}
    right = sum(fixed[i] == texts[i % 500] for i in bad)
    assert right >= 0.8 * len(bad) and fixed[0] == texts[0]
    assert scan.noisy(df.limit(0)).count() == 0


def test_one_misread_place_at_every_length_is_a_candidate(spark):
    goods = ["of", "for", "plan", "shown", "corner", "matters", "quarters"]
    bads = {}
    for g in goods:
        for i in range(len(g)):
            bads[g[:i] + "0" + g[i + 1 :]] = g
            if len(g) > 2:
                bads[g[:i] + "xy" + g[i + 1 :]] = g
                bads.setdefault(g[:i] + "z" + g[i + 2 :], g)
    bads = {b: g for b, g in bads.items() if b not in goods}
    counts = spark.createDataFrame([(g, 1000) for g in goods] + [(b, 1) for b in bads], "w string, n long").repartition(3)
    got = {(r.bad, r.good) for r in scan.candidates(counts, counts.where("n = 1000")).collect()}
    missed = {(b, g) for b, g in bads.items() if (b, g) not in got and not re.search("^>|>$", scan._difference(b, g))}
    assert not missed
    goods = ["for", "shown", "lost", "room", "word", "book"]
    counts = spark.createDataFrame([(g, 1000) for g in goods] + [(g.replace("o", "0", 1), 1) for g in goods], "w string, n long")
    assert {r.bad: r.good for r in scan.misreadings(counts, counts.where("n = 1000")).collect()} == {g.replace("o", "0", 1): g for g in goods}


def test_difference_and_boosting():
    import numpy as np

    assert scan._difference("tlie", "the") == "li>h" and scan._difference("woodcn", "wooden") == "c>e"
    rng = np.random.default_rng(0)
    x = rng.random((400, 3))
    y = ((x[:, 0] > 0.4) & (x[:, 1] > 0.3)).astype(float)
    assert ((scan.Stumps.fit(x, y).score(x) > 0) == y).mean() > 0.95
