"""Problem 3: the share of a text that says again what the same text has said.

Five rules measure the share of characters that lie in second or later copies: of a character run, of a
line, of a paragraph, of a sentence, and of a phrase. Copies are compared without regard to case, spacing,
punctuation and the value of numbers. A rule rejects a text if its share is over one half. The rules run
as a cascade that stops at the first rejection; their order is found on a sample of texts, by rejections
per second of cost. The order changes the time taken, never the result.

Defined results: null, empty and blank texts have share 0; tables are left out by the caller, as their
cells repeat by nature; a text of two equal halves has share one half, which is not more than half.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A phrase is this many words, or this many characters in scripts without word spaces.
PHRASE_WORDS, PHRASE_CHARS = 4, 8
#: A run is the same unit of up to ``RUN_UNIT`` characters this many times in a row.
RUN_UNIT, RUN_COPIES = 8, 5
LIMIT = 0.5
#: Texts on which cost and selectivity of the rules are estimated; a bound, as the estimate only sets the order.
SAMPLE = 1500

_HAN = "぀-ヿ㐀-鿿豈-﫿"
_TOKEN = re.compile(rf"[{_HAN}]|\d+(?:[.,]\d+)*|[^\W\d_{_HAN}][^\W_{_HAN}]*")  # a number within a name is part of it
_SENTENCE = re.compile(r"(?<=[.!?…])\s+|(?<=[。！？])\s*|\n+")
_RULED = re.compile(r"\n[-=*_~]{3,}[ \t]*(?=\n|$)")
_JUNK = re.compile(r"[\W_]+")
_NUMBER = re.compile(r"\d+(?:[.,]\d+)*")
_RUN = re.compile(rf"(\S)\1{{{RUN_COPIES - 1},}}")
_LONG = re.compile(r"\S{24,}")
_TANDEM = re.compile(rf"(\S.{{0,{RUN_UNIT - 1}}}?)\1{{{RUN_COPIES - 1},}}", re.S)
_TANDEM_SPACED = re.compile(r"((?:\S+\s+){1,4}?)\1{4,}")


def _unit(s: str) -> str:
    return _JUNK.sub(" ", _NUMBER.sub("0", s.lower())).strip()


def _copies(parts: list[str]) -> int:
    seen, again = set(), 0
    for p in parts:
        u = _unit(p)
        if not u:
            continue
        if u in seen:
            again += len(p)
        seen.add(u)
    return again


def run_share(text: str) -> float:
    """Characters in the second and later units of runs such as ``....``, ``hahaha`` or ``\\quad \\quad``."""
    n = len(text)
    if _RULED.search(text):  # an underline below a title is layout
        text = _RULED.sub("", text)
    again = sum(m.end() - m.start() - 1 for m in _RUN.finditer(text))
    if again <= LIMIT * n:
        again = max(again, sum(m.end() - m.start() - len(m.group(1)) for w in _LONG.finditer(text) for m in _TANDEM.finditer(w.group())) if _LONG.search(text) else 0)
    if again <= LIMIT * n and "\\" in text:
        again = max(again, sum(m.end() - m.start() - len(m.group(1)) for m in _TANDEM_SPACED.finditer(text)))
    return again / n


def line_share(text: str) -> float:
    return _copies(text.split("\n")) / len(text) if "\n" in text else 0.0


def paragraph_share(text: str) -> float:
    return _copies(text.split("\n\n")) / len(text) if "\n\n" in text else 0.0


def sentence_share(text: str) -> float:
    return _copies(_SENTENCE.split(text)) / len(text)


def phrase_share(text: str) -> float:
    """Characters covered by phrases that stood earlier in the text; a phrase may overlap its own copy, as in a loop."""
    spans = [(m.start(), m.group()) for m in _TOKEN.finditer(text.lower())]
    k = len(spans)
    if k < 2:
        return 0.0
    words = [w for _, w in spans]
    plain = ["0" if w[0].isdigit() else w for w in words]
    han = sum(1 for w in words if len(w) == 1 and w > "　")
    n = PHRASE_CHARS if 2 * han > k else PHRASE_WORDS
    n = min(n, max(1, k // 4))
    if n < 2:
        n = 2 if k > 3 else 1
    grams = list(zip(*[plain[i:] for i in range(n)]))
    if len(set(grams)) == len(grams):
        return 0.0
    numbers = ("0",) * n
    seen, until, again = set(), -1, 0
    starts = [s for s, _ in spans] + [len(text)]
    for i, g in enumerate(grams):
        if g == numbers:
            g = tuple(words[i : i + n])
        if g in seen:
            begin = max(i, until)
            if i + n > begin:
                again += starts[i + n] - starts[begin]
                until = i + n
        else:
            seen.add(g)
    return again / len(text)


RULES: dict[str, Callable[[str], float]] = {"run": run_share, "line": line_share, "paragraph": paragraph_share, "sentence": sentence_share, "phrase": phrase_share}


def cascade_order(texts: list[str]) -> list[str]:
    """The rules by rejections per second on these texts, each measured on what the rules before it leave."""
    left, order, rules = texts, [], dict(RULES)
    while rules:
        rated = []
        for name, rule in rules.items():
            began = time.perf_counter()
            hit = [rule(t) > LIMIT for t in left]
            cost = max(time.perf_counter() - began, 1e-9)
            rated.append(((sum(hit) + 0.01) / cost, name, hit))
        _, best, hit = max(rated)
        order.append(best)
        rules.pop(best)
        left = [t for t, h in zip(left, hit) if not h]
    return order


def _texts(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(df[key].alias("k"), df[text].alias("t")).where(F.length(F.trim("t")) > 0)


def _sample(df: DataFrame) -> list[str]:
    """About ``SAMPLE`` of the texts, picked by a hash of the key, so that no order of the rows favours any."""
    share = min(1.0, SAMPLE / max(1, df.count()))
    return [r[0] for r in df.where(F.pmod(F.xxhash64("k"), F.lit(1_000_000)) < int(share * 1_000_000)).select("t").collect()]


def repetitive(df: DataFrame, key: str = "result_id", text: str = "text") -> DataFrame:
    """(key, rule, share) of the texts that a rule rejects, with the rule of the largest share; one pass without a shuffle.

    The cascade stops at the first rule that rejects; only for the few rejected texts the others are measured too, so
    that what is reported depends on the text alone. The sample is taken when this is called.
    """
    source = _texts(df, key, text)
    order = cascade_order(_sample(source))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = [RULES[n] for n in order]
        for b in batches:
            rows, names, shares = [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                if any(rule(t) > LIMIT for rule in rules):
                    share, name = max((rule(t), name) for name, rule in RULES.items())
                    rows.append(i)
                    names.append(name)
                    shares.append(share)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array(names, pa.string()), pa.array(shares, pa.float64())], ["k", "rule", "share"])

    kind = df.schema[key].dataType.simpleString()
    return source.mapInArrow(run, f"k {kind}, rule string, share double").withColumnRenamed("k", key)


def shares(df: DataFrame, key: str = "result_id", text: str = "text") -> DataFrame:
    """(key, one share per rule, repeated_share): the measures of every text; the last is the largest."""
    source = df.select(df[key].alias("k"), df[text].alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            cols = [[rule(t) if t and not t.isspace() else 0.0 for t in texts] for rule in RULES.values()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.float64()) for c in cols], pa.array([max(x) for x in zip(*cols)], pa.float64())], ["k", *RULES, "repeated_share"])

    kind = df.schema[key].dataType.simpleString()
    fields = ", ".join(f"{r} double" for r in RULES)
    return source.mapInArrow(run, f"k {kind}, {fields}, repeated_share double").withColumnRenamed("k", key)
