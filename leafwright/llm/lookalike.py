"""Problem 2: one consistent character sequence for text that looks the same.

First a fold of forms: compatibility and composed forms (NFKC, except raised, lowered and circled
characters, which do look different), all kinds of space and of hyphen, and removal of characters without
width. Then a script-aware repair: in a token that mixes scripts, or that lies wholly in another script
than the text around it and consists of look-alikes only, letters of the other scripts are replaced by
their look-alikes of the dominant script, provided the corpus holds the resulting word.

Defined results: null texts stay null and match nothing; empty texts have no look and match nothing;
repeated equal texts are no pair; letter case, accents and other digits are kept.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwright.session import through_disk

#: Letters of Cyrillic, Greek and others that look like these Latin letters.
PAIRS = (
    ("a", "а"), ("c", "с"), ("e", "е"), ("o", "о"), ("p", "р"), ("x", "х"), ("y", "у"), ("i", "і"), ("s", "ѕ"), ("j", "ј"),
    ("h", "һ"), ("d", "ԁ"), ("q", "ԛ"), ("w", "ԝ"), ("v", "ѵ"), ("l", "ӏ"),
    ("A", "А"), ("B", "В"), ("C", "С"), ("E", "Е"), ("H", "Н"), ("I", "І"), ("J", "Ј"), ("K", "К"), ("M", "М"), ("O", "О"),
    ("P", "Р"), ("S", "Ѕ"), ("T", "Т"), ("X", "Х"), ("Y", "У"),
    ("a", "α"), ("o", "ο"), ("p", "ρ"), ("v", "ν"), ("k", "κ"), ("u", "υ"), ("i", "ι"), ("y", "γ"), ("n", "η"),
    ("A", "Α"), ("B", "Β"), ("E", "Ε"), ("H", "Η"), ("I", "Ι"), ("K", "Κ"), ("M", "Μ"), ("N", "Ν"), ("O", "Ο"), ("P", "Ρ"),
    ("T", "Τ"), ("X", "Χ"), ("Y", "Υ"), ("Z", "Ζ"),
    ("g", "ɡ"), ("a", "ɑ"), ("i", "ı"), ("o", "օ"), ("u", "ս"), ("n", "ո"), ("h", "հ"),
)
_SCRIPTS = {"Latin": regex.compile(r"\p{Latin}"), "Cyrillic": regex.compile(r"\p{Cyrillic}"), "Greek": regex.compile(r"\p{Greek}"), "Armenian": regex.compile(r"\p{Armenian}")}


def _maps() -> dict[str, dict[int, str]]:
    """For each script, what to replace to get there: through the Latin letter that both look like."""
    to_latin = {ord(o): lat for lat, o in PAIRS}
    out = {"Latin": to_latin}
    for script in ("Cyrillic", "Greek"):
        own: dict[str, str] = {}
        for lat, o in PAIRS:
            if _SCRIPTS[script].match(o):
                own.setdefault(lat, o)
        out[script] = {ord(lat): o for lat, o in own.items()} | {c: own[lat] for c, lat in to_latin.items() if lat in own and not _SCRIPTS[script].match(chr(c))}
    return out


TO_SCRIPT = _maps()
_RAISED = regex.compile(r"[²³¹ªº⁰-₟①-⓿❶-➓™℠ʰ-ˤ]+")
_FORMS = {
    **{c: " " for c in [0x09, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000]},
    **{ord(c): "-" for c in "‐‑‒–—―−⁃﹘﹣－⸺⸻"},
    **{c: None for c in [0xAD, 0x34F, 0x61C, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180E, 0xFEFF, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2070), *range(0xFE00, 0xFE10)]},
}
_LETTERS = regex.compile(r"[\p{L}\p{M}]+")
_BESIDE = regex.compile(r"[\p{Cyrillic}\p{Greek}\p{Armenian}ɡɑı]")


def fold(text: str) -> str:
    """One form for compatibility, composition, spaces, hyphens and characters without width."""
    if text.isascii():
        return text.replace("\t", " ") if "\t" in text else text
    text = text.translate(_FORMS)
    if _RAISED.search(text):
        out, at = [], 0
        for m in _RAISED.finditer(text):
            out += [unicodedata.normalize("NFKC", text[at : m.start()]), m.group()]
            at = m.end()
        text = "".join([*out, unicodedata.normalize("NFKC", text[at:])])
    else:
        text = unicodedata.normalize("NFKC", text)
    return text.translate(_FORMS)


def script_counts(text: str) -> dict[str, int]:
    return {s: n for s, p in _SCRIPTS.items() if (n := len(p.findall(text)))}


def suspects(text: str) -> dict[str, str]:
    """Tokens of a folded text that may hold letters of another script, with what they would be without."""
    if text.isascii() or not _BESIDE.search(text):
        return {}
    around = script_counts(text)
    out = {}
    for token in set(_LETTERS.findall(text)):
        here = script_counts(token)
        if not here:
            continue
        if len(here) > 1:
            # letters that have no look-alike tell the script; the text around decides ties
            firm = {s: sum(1 for c in token if _SCRIPTS[s].match(c) and not any(ord(c) in TO_SCRIPT[t] for t in TO_SCRIPT if t != s)) for s in here}
            script = max(here, key=lambda s: (firm[s], here[s], around.get(s, 0)))
        else:
            script = max(around, key=around.get)
            if script in here:
                continue
        fixed = token.translate(TO_SCRIPT.get(script, {}))
        if fixed != token and len(script_counts(fixed)) == 1:
            out[token] = fixed
    return out


def _first_pass(df: DataFrame, key: str, text: str) -> DataFrame:
    """(k, raw, look, folded, tokens, words): digests of the text as it is and folded; for the few texts with suspects the folded text and these; the words that only the fold has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            look, folded, tokens, words = [], [], [], []
            for t in b.column(2).to_pylist():
                f = fold(t) if t else t
                s = suspects(f) if f else {}
                look.append(hashlib.md5(f.encode("utf-8", "replace"), usedforsecurity=False).digest() if f else None)
                folded.append(f if s else None)
                tokens.append(list(s.items()))
                words.append(sorted(set(_LETTERS.findall(f)) - set(_LETTERS.findall(t))) if f and f != t else [])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(look, pa.binary()), pa.array(folded, pa.string()), pa.array(tokens, pa.map_(pa.string(), pa.string())), pa.array(words, pa.list_(pa.string()))],
                ["k", "raw", "look", "folded", "tokens", "words"],
            )

    kind = df.schema[key].dataType.simpleString()
    return df.select(df[key].alias("k"), F.xxhash64(df[text]).alias("raw"), df[text].alias("t")).mapInArrow(run, f"k {kind}, raw bigint, look binary, folded string, tokens map<string,string>, words array<string>")


def _known(first: DataFrame, df: DataFrame, text: str) -> DataFrame:
    """(token, fixed) of the suspects whose repaired word the corpus holds, as it stands or folded."""
    wanted = first.where(F.col("folded").isNotNull()).select(F.explode("tokens").alias("token", "fixed")).distinct()
    words = df.select(F.explode(F.split(F.col(text), r"[^\p{L}\p{M}]+")).alias("w")).where("w <> ''")
    words = words.unionByName(first.select(F.explode("words").alias("w"))).distinct()
    return wanted.join(words, F.col("fixed") == F.col("w"), "left_semi")


def _repairs(first: DataFrame, df: DataFrame, text: str) -> DataFrame:
    """(k, raw, folded, use): the rows with suspects and what to put for which token."""
    known = _known(first, df, text)
    rows = first.where(F.col("folded").isNotNull()).select("k", "raw", "folded", "tokens")
    good = rows.select("k", "raw", F.explode("tokens").alias("token", "fixed")).join(known, ["token", "fixed"], "left_semi")
    by_row = good.groupBy("k", "raw").agg(F.map_from_entries(F.collect_set(F.struct("token", "fixed"))).alias("use"))
    return rows.drop("tokens").join(by_row, ["k", "raw"], "left")


def _put(folded: str, use) -> str:
    d = dict(use or ())
    return _LETTERS.sub(lambda m: d.get(m.group(), m.group()), folded) if d else folded


def looks(df: DataFrame, key: str = "result_id", text: str = "text") -> DataFrame:
    """(k, raw, look): for each row a digest of the text as it is and of its consistent form.

    Only rows with suspects, a small part, go through the repair; the vocabulary they are held against is
    that of the whole corpus.
    """
    first = through_disk(_first_pass(df, key, text), "looks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = map(_put, b.column(2).to_pylist(), b.column(3).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([hashlib.md5(t.encode("utf-8", "replace"), usedforsecurity=False).digest() for t in texts], pa.binary())], ["k", "raw", "look"])

    kind = df.schema[key].dataType.simpleString()
    repaired = _repairs(first, df, text).select("k", "raw", "folded", "use").mapInArrow(run, f"k {kind}, raw bigint, look binary")
    return first.where(F.col("folded").isNull() & F.col("look").isNotNull()).select("k", "raw", "look").unionByName(repaired)


def consistent(df: DataFrame, key: str = "result_id", text: str = "text") -> DataFrame:
    """(key, text): every row with its one consistent text; rows whose texts look the same have equal ones.

    Null and empty texts stay as they are; a text of nothing but characters without width comes out empty.
    """
    first = through_disk(_first_pass(df, key, text), "looks")
    use = _repairs(first, df, text).where(F.col("use").isNotNull()).select(F.col("k").alias("_k"), F.col("raw").alias("_raw"), "use").dropDuplicates(["_k", "_raw"])
    rows = df.select(df[key].alias("k"), df[text].alias("t")).join(use, (F.col("k") == F.col("_k")) & (F.xxhash64("t") == F.col("_raw")), "left").select("k", "t", "use")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [_put(fold(t), u) if t else t for t, u in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], ["k", "text"])

    return rows.mapInArrow(run, f"k {df.schema[key].dataType.simpleString()}, text string").withColumnRenamed("k", key)


def members(df: DataFrame, key: str = "result_id", text: str = "text") -> DataFrame:
    """(look, raw, k): the rows of every look that more than one character sequence has.

    Looks with a single sequence, which almost all are, drop out in a map-side aggregate.
    """
    seen = through_disk(looks(df, key, text), "look-keys")
    several = seen.groupBy("look").agg(F.min("raw").alias("x"), F.max("raw").alias("y")).where("x <> y").select("look")
    return seen.join(several, "look", "left_semi").select("look", "raw", "k")


def look_classes(df: DataFrame, key: str = "result_id", text: str = "text") -> DataFrame:
    """(key, class_id, form_id, n_forms, n_rows): membership of the rows that others look like, copies not expanded.

    A class is a look, named by its first key; a form is one character sequence of it, named by its own first key.
    ``n_forms`` and ``n_rows`` are those of the class. Aggregates are small beside the rows and are made on the map side.
    """
    rows = through_disk(members(df, key, text), "look-rows")
    forms = rows.groupBy("look", "raw").agg(F.min("k").alias("form_id"), F.count(F.lit(1)).alias("n"))
    whole = forms.groupBy(F.col("look").alias("_l")).agg(F.min("form_id").alias("class_id"), F.count(F.lit(1)).alias("n_forms"), F.sum("n").alias("n_rows"))
    named = forms.join(whole, F.col("look") == F.col("_l")).select(F.col("look").alias("_l"), F.col("raw").alias("_r"), "class_id", "form_id", "n_forms", "n_rows")
    met = rows.join(named, (F.col("look") == F.col("_l")) & (F.col("raw") == F.col("_r")))
    return met.select(F.col("k").alias(key), "class_id", "form_id", "n_forms", "n_rows")


def same_look(df: DataFrame, key: str = "result_id", text: str = "text") -> DataFrame:
    """Pairs (a < b) of rows whose texts look the same and are different character sequences.

    The different sequences of a look are paired first, and only then does each side get its rows, so that exact
    copies never meet each other. All pairs of rows of two sequences come out, as is asked of this result; where
    copies are many, ``look_classes`` says the same in one row each.
    """
    rows = through_disk(members(df, key, text), "look-rows")
    forms = rows.select("look", "raw").distinct()
    p, q = forms.select("look", F.col("raw").alias("ra")), forms.select("look", F.col("raw").alias("rb"))
    pairs = p.join(q, "look").where("ra < rb")
    a, b = rows.select("look", F.col("raw").alias("ra"), F.col("k").alias("a")), rows.select("look", F.col("raw").alias("rb"), F.col("k").alias("b"))
    met = pairs.join(a, ["look", "ra"]).join(b, ["look", "rb"])
    return met.select(F.least("a", "b").alias(f"{key}_a"), F.greatest("a", "b").alias(f"{key}_b")).distinct()
