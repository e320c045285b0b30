"""Problem 1: markup residue, by templates deduced from equivalence classes of tokens.

Every text is a page, its source the host; all hosts taken as one are a further host, so that a host of few pages
shares what the others show. A page is cut into tokens: signs that may be markup, each with a role (it opens,
closes or stands by itself), and the words between them. For every token of a host its occurrence vector over
the host's pages is sketched by min-hashes; tokens whose vectors agree on most of their pages form a class. A class
is valid if its tokens come in one order on the pages that hold them all, openers before their closers and well
nested. Valid classes nest: the parent of a class is the one that closest surrounds it, and a class that others cut across is
no template's. A sign alone in its class is a separator if it recurs and what follows it differs, as a slot must.

A text has residue if it holds signs of its host's template, whole or in pieces. The clean text is put together from
the slots, what stands between the signs of the template, with one plain form for each structure: headings get
``# ``, list items ``- ``, cells `` | `` between them, code stays between fences, formulas between dollar signs.

A class's own form is no residue: OTSL tags in tables, LaTeX in formulas, ``|`` rows in charts, program
text in algorithms. Plain signs (``a < b``, ``R&D``, ``#4``, ``[7]``, paths, prices) are no tokens.

Defined results: null and empty texts hold no markup and come out as they are; a null class counts as
prose; a text of markup alone comes out empty; a sign on a single page of the corpus belongs to no template.
Vectors run over the pages that hold any sign: without one, a page has no markup to tell.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafwright.session import through_disk

#: A token needs this many pages of a host to tell its vector from chance.
LEAST_PAGES = 2
#: Min-hashes of a vector, of which this share must agree in one class; so many in a row bring two tokens together.
HASHES, AGREE, BAND = 16, 0.75, 2
#: The share of pages on which a class must keep its order, and of those on which others may cut across it.
ORDERED, CROSSED = 0.8, 0.2
FORMULAS = ("display_formula", "inline_formula")
ALL = "*"

_OTSL = re.compile(r"</?(?:fcel|ecel|lcel|ucel|xcel|nl)>")
_PATH = re.compile(r"\b[A-Za-z]:\\[\w\\.]+")
_CODE = re.compile(r"^[ \t]*(```|~~~)[\s\S]*?(?:^[ \t]*\1[ \t]*$|\Z)", re.M)
_PRE = re.compile(r"<pre[^>]*>(?:\s*<code[^>]*>)?|(?:</code>\s*)?</pre>", re.I)
_VERBATIM = re.compile(r"\\(begin|end)\{(?:verbatim|lstlisting)\}")
_TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]{0,14})(?:\s[^<>]*|/)?>|(<!--)|(-->|--&gt;)")
_ESCAPED = re.compile(r"&lt;(/?)([A-Za-z][A-Za-z0-9]{0,14})(?:\s(?:(?!&[lg]t;)[^<>])*?|/)?&gt;")
_ENTITY = re.compile(r"&(?:[A-Za-z]{2,8}\d?|#\d{2,6}|#x[0-9A-Fa-f]{2,5});")
_COMMAND = re.compile(r"(?:(?<![\\\w:])|(?<=[^\x00-\x7f])|(?<=[a-z])(?=\\(?:footnote|cite|ref|textbf|textit|emph|label|section|item)\b))\\([A-Za-z]{2,})\*?(\{)?")
_ENV = re.compile(r"\\(begin|end)\{([A-Za-z*]+)\}(?:\{[lcr|]*\})?")
_MATH = re.compile(r"\\([\[\]()])|(\$\$)|(?<![\w$\\])(\$)(?=[^\s\d$])(?=([^$\n]*))\4(?<=[^\s$])\$(?!\d)")
_DOLLAR = re.compile(r"[\\^_{}=]")
_WIKI = re.compile(r"(\[\[(?:[^\[\]|\n]*\|)?)|(\]\])|(\{\{[^{}|\n]*\|?)|((?:\|[^{}\n]*)?\}\})|('{2,5})")
_WIKI_TABLE = re.compile(r"^[ \t]*(\{\|)[^\n]*\n?|^[ \t]*(\|\})[ \t]*|(\{\|)|(\|\})", re.M)
_INLINE = re.compile(r"(\*\*|__)|(~~)|(?<![\w`])(`)(?=[^`\s])|(?<=[^`\s])(`)(?![\w`])")
_EMPH = re.compile(r"(?<![A-Za-z0-9*\\])(\*)(?=[^\s*])([^*\n]+?)(?<=[^\s*])\*(?![A-Za-z0-9*])|(?<![\w_\\])(_)(?=[^\s_])([^_\n]+?)(?<=[^\s_])_(?![\w_])")
_LINK = re.compile(r"!?\[(?=([^\[\]\n]*))\1(\]\([^()\s]*(?:\s\"[^\"\n]*\")?\))|(\]\((?:https?:|#|[\w./-]+\.(?:md|html?|png|jpe?g|gif|svg)))")
_URL = re.compile(r"\[https?://[^\s\]]+ ?([^\]\n]*)\]")
_HEAD = re.compile(r"^(={2,6})[ \t]*[^=\n]+?([ \t]*\1[ \t]*)$", re.M)
_UNDERLINE = re.compile(r"(?<=\S)\n[ \t]*(?:={3,}|-{3,}|~{3,})[ \t]*(?=\n|$)")
_RULED = re.compile(r"^[ \t]*\|-+[ \t]*(?:\n|$)|^[ \t]*\|?(?:[ \t]*:?-{3,}:?[ \t]*\|)+[ \t]*:?-*:?[ \t]*(?:\n|$)", re.M)
_ROW = re.compile(r"^[ \t]*\|.*\|[ \t]*$", re.M)
_WIKI_ROW = re.compile(r"^[|!](?![-}|])[^\n]*$", re.M)
_CELL = re.compile(r"[ \t]*(?:\|\||!!|\|)[ \t]*")
_LINES = (
    ("#", re.compile(r"^(#{1,6})[ \t]+(?=\S)", re.M)),
    (">", re.compile(r"^>[ \t]+(?=\S)", re.M)),
    ("rule", re.compile(r"^[ \t]*(?:\*[ \t]*\*[ \t]*\*|-[ \t]*-[ \t]*-)[-* \t]*(?:\n|$)", re.M)),
    ("-", re.compile(r"^[ \t]*[-+*]{1,3}[ \t]+(?=\S)", re.M)),
    ("wiki#", re.compile(r"^#{1,3}(?=[^\s#\d])", re.M)),
    ("% note", re.compile(r"^%[^\n]*(?:\n|$)", re.M)),
    ("[^]", re.compile(r"\[\^[\w-]{1,12}\]:?")),
)
_VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "col"}
_BREAKS = {"tr", "p", "ul", "ol", "table", "div", "tbody", "thead", "br", "hr", "blockquote"}
_GONE = ("label", "vspace", "hspace", "pagestyle")
_HEADINGS = {"chapter": 1, "section": 1, "subsection": 2, "subsubsection": 3}
_WORD = re.compile(r"\w+")
#: What stands for a cell's edge until the rows are put together.
_EDGE = "\x1f"
#: Rows without any of these signs hold no token; the test runs in the JVM.
SIGNS = r"[<&\\*`$~_>]|\[\[|\]\]|\]\(|\{\{|\}\}|\{\||\|\}|''|(?m)^\s*[#|!%=+-]|\[\^|\[http|\n\s*[=~-]{3,}"
#: Signs that also occur by themselves in plain text: in pieces they prove nothing.
_WEAK = ("`", "''", "__", "~~", "**", "*")


class Sign(NamedTuple):
    """A sign from ``start`` to ``end``: its name, its role (opens, closes, or stands by itself), what its slots show instead."""

    start: int
    end: int
    name: str
    role: str
    shown: str

    @property
    def token(self) -> str:
        return self.name if self.role == "one" else f"{self.name} {self.role}"


def signs(kind: str | None, text: str) -> list[Sign]:
    """The signs of a page that may be markup, in order; none overlaps another."""
    found: list[Sign] = []
    taken = bytearray(len(text))

    def add(start: int, end: int, name: str, role: str = "one", shown: str = "") -> bool:
        if start < end and any(taken[start:end]):
            return False
        taken[start:end] = b"\1" * (end - start)
        found.append(Sign(start, end, name, role, shown))
        return True

    def close(start: int, end: int) -> None:
        """Nothing within is looked at any more."""
        taken[start:end] = b"\1" * (end - start)

    def turns(name: str, spans: list[tuple[int, int]], first: str = "", second: str = "") -> None:
        for i, (a, z) in enumerate(spans):
            add(a, z, name, "close" if i % 2 else "open", second if i % 2 else first)

    if kind == "table" and "cel>" in text:
        for m in _OTSL.finditer(text):
            close(m.start(), m.end())
    math = kind in FORMULAS
    marked = not (math or kind == "algorithm")
    # code first: nothing in it is markup
    if marked and ("```" in text or "~~~" in text):
        for m in _CODE.finditer(text):
            mark = m.group(1)
            start = text.index(mark, m.start())
            end = m.group().rstrip().endswith(mark) and len(m.group().strip()) > 5 and text.rindex(mark, 0, m.end())
            add(start, start + 3, "fence", "open", mark)
            if end and end > start + 3:
                close(start + 3, end)
                add(end, end + 3, "fence", "close", mark) if not any(taken[end : end + 3]) else None
            else:
                close(start + 3, m.end())
    if marked and "\\begin{" in text:
        opened = None
        for m in _VERBATIM.finditer(text):
            if m.group(1) == "begin" and opened is None:
                opened = m.end()
                add(m.start(), m.end(), "\\verbatim", "open", "\n```")
            elif m.group(1) == "end" and opened is not None:
                close(opened, m.start())
                add(m.start(), m.end(), "\\verbatim", "close", "```\n")
                opened = None
    if "<pre" in text.lower():
        opened = None
        for m in _PRE.finditer(text):
            if m.group()[1] != "/" and "</" not in m.group() and opened is None:
                opened = m.end()
                add(m.start(), m.end(), "<pre", "open", "\n```\n")
            elif opened is not None:
                for e in _ENTITY.finditer(text, opened, m.start()):
                    add(e.start(), e.end(), "&;", "one", html.unescape(e.group()))
                close(opened, m.start())
                add(m.start(), m.end(), "<pre", "close", "\n```\n")
                opened = None
    if "<" in text or "-->" in text:
        hidden = None
        for m in _TAG.finditer(text):
            if m.group(3):
                hidden = m.start() if hidden is None else hidden
                continue
            if m.group(4):
                if hidden is not None:
                    add(hidden, m.start(), "<!", "open")
                add(m.start(), m.end(), "<!", "close")
                hidden = None
                continue
            if hidden is not None:
                continue
            name, closing = m.group(2).lower(), bool(m.group(1))
            if name in _VOID or (m.group().endswith("/>") and not closing):
                add(m.start(), m.end(), f"<{name}>", "one", "\n" if name in _BREAKS else "")
                continue
            shown = "\n" if name in _BREAKS else ""
            if name[0] == "h" and name[1:].isdigit():
                shown, name = ("\n" if closing else "\n" + "#" * min(6, int(name[1:])) + " "), "h#"
            elif name == "li":
                shown = "" if closing else "\n- "
            elif name in ("td", "th"):
                shown = "" if closing else _EDGE
            elif name == "ref":
                shown = ")" if closing else " ("
            elif name == "math":
                shown = "$"
            elif math and name in ("sub", "sup"):
                shown = "}" if closing else ("_{" if name == "sub" else "^{")
            add(m.start(), m.end(), "<" + name, "close" if closing else "open", shown)
        if hidden is not None:
            add(hidden, hidden + 4, "<!", "open")
    if "&" in text:
        for m in _ESCAPED.finditer(text):
            add(m.start(), m.end(), "&lt;" + m.group(2).lower(), "close" if m.group(1) else "open")
        for m in _ENTITY.finditer(text):
            add(m.start(), m.end(), "&;", "one", html.unescape(m.group()).replace("\xa0", " "))
    if not marked:
        return sorted(found)
    for m in _PATH.finditer(text) if "\\" in text else ():
        close(m.start(), m.end())
    formulas: list[tuple[int, int]] = []
    if "\\" in text or "$" in text:
        opened, spans = None, []
        for m in _MATH.finditer(text):
            if m.group(1):
                opens = m.group(1) in "[("
                if add(m.start(), m.end(), "\\[" if m.group(1) in "[]" else "\\(", "open" if opens else "close", "$"):
                    if opens:
                        opened = m.end()
                    elif opened is not None:
                        formulas.append((opened, m.start()))
                        opened = None
            elif m.group(2):
                spans.append((m.start(), m.end()))
            elif _DOLLAR.search(m.group(4)):
                if add(m.start(), m.start() + 1, "$", "open", "$"):
                    formulas.append((m.start() + 1, m.end() - 1))
                    add(m.end() - 1, m.end(), "$", "close", "$")
        turns("$$", spans, "$", "$")
        formulas += [(a[1], z[0]) for a, z in zip(spans[::2], spans[1::2])]
    inside = bytearray(len(text))
    for a, z in formulas:
        inside[a:z] = b"\1" * max(0, z - a)
    if "\\" in text:
        for m in _ENV.finditer(text):
            add(m.start(), m.end(), "\\env " + m.group(2), "open" if m.group(1) == "begin" else "close", m.group() if inside[m.start()] else "\n")
        for m in _COMMAND.finditer(text):
            _command(text, m, add, inside)
        if kind == "table" and "&" in text:
            for m in re.finditer(r"\s*(?<!\\)&\s*|\s*\\\\[ \t]*", text):
                add(m.start(), m.end(), "& cell" if "&" in m.group() else "\\\\ row", "one", _EDGE if "&" in m.group() else "\n")
    for a, z in formulas:
        close(a, z)  # its content stays as it is
    for m in _WIKI_TABLE.finditer(text) if "{|" in text or "|}" in text else ():
        opens = bool(m.group(1) or m.group(3))
        add(m.start(), m.end(), "{|", "open" if opens else "close")
    in_wiki = [(s.end, next((z.start for z in found if z.name == "{|" and z.role == "close" and z.start >= s.end), len(text))) for s in found if s.name == "{|" and s.role == "open"]
    quotes = []
    for m in _WIKI.finditer(text):
        g = m.lastindex
        if g == 5:
            quotes.append((m.start(), m.end()))
        else:
            add(m.start(), m.end(), "[[" if g <= 2 else "{{", "open" if g % 2 else "close")
    turns("''", [q for q in quotes if (text[q[1] : q[1] + 1] or " ") > " " or (text[q[0] - 1 : q[0]] or " ") > " "])
    if "](" in text:
        for m in _LINK.finditer(text):
            if m.group(2):
                a = m.start() + (text[m.start()] == "!") + 1
                if add(m.start(), a, "[](", "open"):
                    add(m.start(2), m.end(2), "[](", "close")
            else:
                add(m.start(), m.end(), "](")
    if "[http" in text:
        for m in _URL.finditer(text):
            if add(m.start(), m.start(1), "[http", "open"):
                add(m.end() - 1, m.end(), "[http", "close")
    for m in _HEAD.finditer(text) if "==" in text else ():
        if add(m.start(), m.end(1), "==", "open", "#" * (len(m.group(1)) - 1) + ("" if text[m.end(1)] in " \t" else " ")):
            add(m.start(2), m.end(2), "==", "close")
    for m in _UNDERLINE.finditer(text) if re.search(r"\n[ \t]*[=~-]{3,}", text) else ():
        begin = text.rfind("\n", 0, m.start()) + 1
        if add(m.start(), m.end(), "underline", "close"):
            found.append(Sign(begin, begin, "underline", "open", "# " if "=" in m.group() else "## "))
    if kind != "chart" and "|" in text:
        for m in _RULED.finditer(text):
            add(m.start(), m.end(), "|-")
        rows = [m for m in _ROW.finditer(text) if text.count("|") >= 3]
        rows += [m for a, z in in_wiki for m in _WIKI_ROW.finditer(text, a, z)]
        for m in rows:
            name = "! head" if text[m.start()] == "!" else "|row"
            for i, c in enumerate(_CELL.finditer(text, m.start() + (name == "! head"), m.end())):
                if i == 0 and name == "|row" and c.start() - m.start() < 4:
                    add(c.start(), c.end(), name)
                else:
                    add(c.start(), c.end(), "|cell", "one", _EDGE if c.end() < m.end() else "")
    if "!" in text:
        for m in re.finditer(r"^![ \t](?=\S)", text, re.M):
            add(m.start(), m.end(), "! head")
    for name, p in _LINES:
        hits = list(p.finditer(text))
        if name == "-" and len(hits) == 1 and not found and text.lstrip()[:1] not in "*+-":
            continue
        for m in hits:
            add(m.start(), m.end(), name, "one", m.group() if name == "#" else "- " if name in ("-", "wiki#") else "")
    by: dict[str, list[tuple[int, int]]] = {}
    for m in _INLINE.finditer(text):
        s, before, after = m.group(), text[m.start() - 1 : m.start()] or " ", text[m.end() : m.end() + 1] or " "
        if s == "`" or not (before.isspace() and after.isspace()):
            by.setdefault(s, []).append((m.start(), m.end()))
    for s, spans in by.items():
        turns(s, spans)
    for m in _EMPH.finditer(text):
        if add(m.start(), m.start() + 1, "*", "open"):
            add(m.end() - 1, m.end(), "*", "close")
    return sorted(found)


def _command(text: str, m: re.Match, add, inside: bytearray) -> None:
    """A LaTeX command, with the brace that closes its argument."""
    name, brace = m.group(1), m.group(2)
    if name in ("begin", "end"):
        return
    if inside[m.start()]:
        add(m.start(), m.end(1), "\\" + name, "one", m.group()[: m.end(1) - m.start()])
        return
    if not brace:
        add(m.start(), m.end(), "\\" + name, "one", "\n- " if name == "item" else m.group())
        return
    depth, end = 0, -1
    for i in range(m.end() - 1, len(text)):
        depth += (text[i] == "{") - (text[i] == "}")
        if not depth:
            end = i
            break
    before, after = "", ""
    if name in _HEADINGS:
        before, after = "\n" + "#" * _HEADINGS[name] + " ", "\n"
    elif name == "footnote":
        before, after = " (", ")"
    elif name in ("cite", "ref", "eqref"):
        before, after = "[", "]"
    opened = end if name in _GONE and end > 0 else m.end()
    if add(m.start(), opened, "\\" + name + "{", "open", before) and end > 0:
        add(end, end + 1, "\\" + name + "{", "close", after)


def tokens(kind: str | None, text: str) -> dict[str, list[int]]:
    """token -> [occurrences, first place, last place, hash of the next word] of one page with signs; words count too."""
    found = signs(kind, text)
    if not found:
        return {}
    out: dict[str, list[int]] = {}
    place = 0

    def count(name: str, slot: int) -> None:
        nonlocal place
        t = out.setdefault(name, [0, place, place, slot])
        t[0] += 1
        t[2] = place
        place += 1

    ends = [s.start for s in found[1:]] + [len(text)]
    for w in _WORD.findall(text[: found[0].start]):
        count("w " + w, 0)
    for s, end in zip(found, ends):
        after = _WORD.search(text, s.end)
        count(s.token, zlib.crc32(after.group().encode("utf-8", "replace")) if after else 0)
        for w in _WORD.findall(text[s.end : end]):
            count("w " + w, 0)
    return out


def pages(df: DataFrame, key: str, text: str, kind: str, source: str) -> DataFrame:
    """(k, source, token, n, first, last, slot): the tokens of each page that holds any sign."""
    rows = df.where(F.col(text).rlike(SIGNS)).where(~(F.col(kind).isin(*FORMULAS, "algorithm") & ~F.coalesce(F.col(text).rlike("<[A-Za-z/!]|&[A-Za-z#]"), F.lit(False))) | F.col(kind).isNull())
    rows = rows.where(~((F.col(kind) == "table") & F.col(text).rlike(r"^(?:<[a-z]{1,4}>[^<>&|\\*`$]*(?:<\d[^<>]*)*)*$")) | F.col(kind).isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, names, values = [], [], []
            for i, (c, t) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                for name, v in tokens(c, t).items():
                    at.append(i)
                    names.append(name)
                    values.append(v)
            idx = pa.array(at, pa.int64())
            columns = [pa.array(x, pa.int64()) for x in zip(*values)] if values else [pa.nulls(0, pa.int64())] * 4
            yield pa.RecordBatch.from_arrays([b.column(0).take(idx), b.column(1).take(idx), pa.array(names, pa.string()), *columns], ["k", "source", "token", "n", "first", "last", "slot"])

    types = f"k {df.schema[key].dataType.simpleString()}, source string, token string, n bigint, first bigint, last bigint, slot bigint"
    return rows.select(F.col(key).alias("k"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.col(kind).alias("c"), F.col(text).alias("t")).mapInArrow(run, types)


def _hosts(found: DataFrame) -> DataFrame:
    return found.withColumn("source", F.explode(F.array("source", F.lit(ALL))))


def vectors(found: DataFrame) -> DataFrame:
    """(source, token, pages, h0 ...): how many pages hold the token, and the sketch of its occurrence vector.

    An element of the vector is a page with a count; of its hash, four bits choose one of the min-hashes. All of it is
    added up on the map side, so neither a frequent token nor a large host comes to one task.
    """
    h = F.xxhash64("k", "n")
    rows = _hosts(found).select("source", "token", "slot", h.alias("h"), F.pmod(h, F.lit(HASHES)).alias("b"))
    sketch = [F.min(F.when(F.col("b") == i, F.col("h"))).alias(f"h{i}") for i in range(HASHES)]
    return rows.groupBy("source", "token").agg(F.count(F.lit(1)).alias("pages"), F.min("slot").alias("slot_a"), F.max("slot").alias("slot_z"), *sketch).where(F.col("pages") >= LEAST_PAGES)


def classes(vector: DataFrame) -> DataFrame:
    """(source, class, token) of the tokens whose vectors agree with that of the class's first token.

    Tokens meet where two min-hashes in a row agree, each of them with the first by name only.
    """
    hashes = [f"h{i}" for i in range(HASHES)]
    bands = F.array(*[F.xxhash64(F.lit(i), *hashes[i : i + BAND]) for i in range(0, HASHES, BAND)])
    some = F.filter(F.arrays_zip(bands.alias("key"), F.array(*[F.coalesce(*hashes[i : i + BAND]) for i in range(0, HASHES, BAND)]).alias("any")), lambda x: x["any"].isNotNull())
    met = vector.select("source", "token", F.explode(F.transform(some, lambda x: x["key"])).alias("key"))
    head = F.struct(F.col("token").startswith("w ").alias("word"), F.col("token").alias("token"))
    first = met.groupBy("source", "key").agg(F.min(head)["token"].alias("class"))
    pairs = met.join(first, ["source", "key"]).where("token <> class").select("source", "token", "class").distinct()
    mine = vector.select("source", "token", F.array(*hashes).alias("mine"))
    theirs = vector.select("source", F.col("token").alias("class"), F.array(*hashes).alias("theirs"))
    both = pairs.join(mine, ["source", "token"]).join(theirs, ["source", "class"])
    either = F.filter(F.arrays_zip("mine", "theirs"), lambda x: x["mine"].isNotNull() | x["theirs"].isNotNull())
    same = F.size(F.filter(either, lambda x: x["mine"].eqNullSafe(x["theirs"])))
    near = both.where(same >= AGREE * F.size(either)).groupBy("source", "token").agg(F.min(F.struct(F.col("class").startswith("w ").alias("word"), F.col("class").alias("class")))["class"].alias("class"))
    heads = near.select("source", "class").distinct().withColumn("token", F.col("class"))
    # a first token that itself agrees with an earlier one stays with that one only
    return near.unionByName(heads.join(near.select("source", "token"), ["source", "token"], "left_anti").select("source", "token", "class"))


def template(found: DataFrame) -> DataFrame:
    """(source, class, token, parent): the valid classes of every host with the class that surrounds them, and separators.

    A separator is a class of its own, which has a null parent, as have classes that nothing surrounds.
    """
    vector = through_disk(vectors(found), "vectors")
    member = through_disk(classes(vector), "classes")
    sizes = member.groupBy("source", "class").agg(F.count(F.lit(1)).alias("size"))
    met = _hosts(found).join(member, ["source", "token"]).groupBy("k", "source", "class").agg(F.array_sort(F.collect_list(F.struct("first", "last", "token", "n"))).alias("ts"))
    met = met.join(sizes, ["source", "class"]).where(F.size("ts") == F.col("size"))  # pages that hold the whole class
    lasts, names = F.transform("ts", lambda x: x["last"]), F.transform("ts", lambda x: x["token"])
    counts = F.array_distinct(F.transform("ts", lambda x: x["n"]))
    at = lambda token: F.array_position(names, token)
    opener = lambda x: F.regexp_replace(x, " close$", " open")
    closer = lambda x: F.regexp_replace(x, " open$", " close")
    # an opener comes before its closer, and what opens between them closes between them
    pairwise = F.forall(names, lambda x: ~x.endswith(" close") | (at(opener(x)) <= at(x)))
    inner = F.forall(names, lambda x: ~x.endswith(" close") | (at(opener(x)) == 0) | F.forall(names, lambda y: ~y.endswith(" open") | (at(y) <= at(opener(x))) | (at(y) > at(x)) | (at(closer(y)) < at(x)) | (y == opener(x))))
    seen = met.select("k", "source", "class", names.alias("names"), ((lasts == F.array_sort(lasts)) & (F.size(counts) == 1) & pairwise & inner).alias("kept"), F.get("ts", F.lit(0))["first"].alias("lo"), F.array_max(lasts).alias("hi"), F.get(counts, F.lit(0)).alias("n"))
    seen = through_disk(seen, "instances")
    orders = seen.groupBy("source", "class", "names").agg(F.count_if("kept").alias("good"), F.count(F.lit(1)).alias("all"))
    ordered = orders.groupBy("source", "class").agg(F.max("good").alias("good"), F.sum("all").alias("all")).where(F.col("good") >= ORDERED * F.col("all")).select("source", "class")
    # nesting, by instances that stand once on their page
    spans = seen.where("n = 1").join(ordered, ["source", "class"]).groupBy("k", "source").agg(F.collect_list(F.struct("lo", "hi", "class")).alias("cs"))
    around = lambda c, o: (o["lo"] < c["lo"]) & (o["hi"] > c["hi"])
    across = lambda c, o: ((o["lo"] < c["lo"]) & (o["hi"] > c["lo"]) & (o["hi"] < c["hi"])) | ((o["lo"] > c["lo"]) & (o["lo"] < c["hi"]) & (o["hi"] > c["hi"]))
    placed = spans.select(
        "source",
        F.explode(
            F.transform(
                "cs",
                lambda c: F.struct(
                    c["class"].alias("class"),
                    F.exists("cs", lambda o: across(c, o)).alias("cut"),
                    F.array_min(F.transform(F.filter("cs", lambda o: around(c, o)), lambda o: F.struct((o["hi"] - o["lo"]).alias("d"), o["class"].alias("parent"))))["parent"].alias("parent"),
                ),
            )
        ).alias("c"),
    ).select("source", "c.*")
    nested = placed.groupBy("source", "class").agg((F.avg(F.col("cut").cast("int")) > CROSSED).alias("cut"), F.mode("parent").alias("parent"))
    valid = ordered.join(nested, ["source", "class"], "left").where(~F.coalesce("cut", F.lit(False))).select("source", "class", "parent")
    whole = member.join(valid, ["source", "class"]).select("source", "class", "token", "parent")
    # half a pair among constant words proves no markup
    other = whole.select("source", "class", F.when(F.col("token").endswith(" open"), closer(F.col("token"))).otherwise(opener(F.col("token"))).alias("token")).where("token rlike ' (open|close)$'")
    whole = whole.where(~F.col("token").rlike(" (?:open|close)$")).unionByName(whole.join(other, ["source", "class", "token"], "left_semi"))
    # a sign by itself, with slots that differ behind it
    alone = vector.where(~F.col("token").startswith("w ") & ~F.col("token").rlike(" (?:open|close)$") & (F.col("slot_a") != F.col("slot_z")))
    alone = alone.join(whole, ["source", "token"], "left_anti").select("source", F.col("token").alias("class"), "token", F.lit(None).cast("string").alias("parent"))
    return whole.unionByName(alone)


def _residue(found: DataFrame) -> DataFrame:
    """(k, token, n): the signs of their host's template on each page."""
    kept = template(found).where(~F.col("token").startswith("w ")).select("source", "token").distinct()
    hits = _hosts(found).join(kept, ["source", "token"], "left_semi").groupBy("k", "token").agg(F.max("n").alias("n"))
    name = F.regexp_replace("token", " (?:open|close)$", "")
    weak = name.isin(*_WEAK)
    # a weak sign counts where its page holds both of its roles
    pairs = F.count(F.lit(1)).over(Window.partitionBy("k", "_name"))
    return hits.withColumn("_name", name).withColumn("_roles", pairs).where(~weak | (F.col("_roles") > 1)).select("k", "token", "n")


def residue(df: DataFrame, key: str = "result_id", text: str = "text", kind: str = "class", source: str = "source") -> DataFrame:
    """(key, token, n): the signs of the template in every text that holds some."""
    found = through_disk(pages(df, key, text, kind, source), "markup")
    return _residue(found).withColumnRenamed("k", key)


def clean(text: str | None, kind: str | None = None, template: frozenset[str] | None = None) -> str | None:
    """The slots of a text between the signs of the template, which show their plain form; without a template, of all signs."""
    if not text:
        return text
    out, done = [], 0
    for s in signs(kind, text):
        if template is not None and s.token not in template:
            continue
        out += [text[done : s.start], s.shown]
        done = max(done, s.end)
    out.append(text[done:])
    if len(out) == 1:
        return text
    t = "".join(out)
    if _EDGE in t:
        t = "\n".join(re.sub(rf"[ \t]*{_EDGE}[ \t]*", " | ", x.strip(" \t" + _EDGE)) if _EDGE in x else x for x in t.split("\n"))
        t = re.sub(r"(\n[^\n]* \| [^\n]*)\n+(?=[^\n]* \| )", r"\1\n", "\n" + t)
    t = re.sub(r"(?m)^(- |#{1,6} )[ \t]+", r"\1", re.sub(r"[ \t]+\n", "\n", t))
    t = re.sub(r"(?m)(^- [^\n]*)\n{2,}(?=- )", r"\1\n", t)
    return re.sub(r"\n{3,}", "\n\n", t).strip()


def cleaned(df: DataFrame, key: str = "result_id", text: str = "text", kind: str = "class", source: str = "source") -> DataFrame:
    """(key, class, text): every row, those with residue put together from their slots.

    The signs of a page's template come to it by a join on the key; rows without residue never go to Python.
    """
    hits = residue(df, key, text, kind, source).groupBy(F.col(key).alias("_k")).agg(F.collect_set("token").alias("_tokens"))
    rows = df.select(F.col(key).alias("k"), F.col(kind).alias("class"), F.col(text).alias("text")).join(hits, F.col("k") == F.col("_k"), "left").drop("_k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [clean(t, c, frozenset(s)) if s else t for c, t, s in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], ["k", "class", "text"])

    return rows.mapInArrow(run, f"k {df.schema[key].dataType.simpleString()}, class string, text string").withColumnRenamed("k", key)
