"""Problem 4: repair of text from scanned pages.

Line-pair classifiers, logistic models trained in numpy, decide for every two neighbouring lines whether
they join, and for every line whether it is furniture: a page number or a running header. They learn from pages made
up of the corpus's own whole texts, broken at a width, and of the running heads and page numbers that stand in regions
of their own; so what is true of a line follows from how its page was made. On the joined
text, words are counted over the whole corpus. Rare words meet the frequent ones in an inverted join on
positional character q-grams; gradient-boosted stumps rank the pairs by how much more frequent the
candidate is, how far apart the two are, and in how many other words the same substitution occurs. Han
text is treated alike, in windows of three characters that differ in the middle one.

Defined results: null and empty texts hold no noise; breaks between whole sentences and lines of markup,
lists and code stay; names that occur once have no frequent neighbour and stay as they are.
"""

from __future__ import annotations

import html
import operator
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwright.llm import lookalike
from leafwright.session import through_disk

#: Layout classes whose texts are running prose; a null class may be.
PROSE = ("text", "abstract", "aside_text", "content", "footnote", "vision_footnote", "vertical_text")
#: Layout classes of running heads and page numbers, which stand in regions of their own.
FURNITURE = ("header", "footer", "number")
#: A word is frequent if it makes up this share of all words (so at most its inverse many are), and occurs this often.
FREQUENT_SHARE, FREQUENT_LEAST = 1e-5, 5
#: A misread form occurs at most this often for each time the right one does: words, Han windows.
RARE_RATIO, RARE_RATIO_HAN = 0.04, 0.15
#: Texts the line classifiers and pairs the ranker are fitted on (bounds).
TRAINING_TEXTS, TRAINING_PAIRS = 3000, 20_000
GRAM = 3

_END = re.compile(r"[.!?。！？…][\"”»’)\]」』）]*\s*$")
_PAGE = re.compile(r"^\W*(?:[Pp]age|[Pp]\.|[Pp][áa]g(?:ina)?\.?|[Ss]eite|[Сс]тр\w*\.?|第)?\s*\d{1,4}\s*页?(?:\s*/\s*\d{1,4})?\W*$")
_GAP = re.compile(r"^\s*\d{1,4}\s{2,}\S|\S\s{2,}\d{1,4}\s*$")
_HYPHEN = re.compile(r"[^\W\d_][-‐‑­¬] ?$")
_SOLID = re.compile(r"^\s*(?:[{}|!#>*+=<\\%`~]|[-–—]\s+\S*[^\d\s–—-]|\(?[a-z0-9]{1,2}[).]\s|\d+\.\s|&)|```|[|}>]\s*$|^\S*\\|\\\S*$")
_HAN = "㐀-鿿"
_HANS = re.compile(f"[{_HAN}]+")
_WORD = re.compile(rf"[^\W\d_{_HAN}](?:[^\s_{_HAN}“”«»„\"(),.;:?¿¡…—–/\\<>|{{}}\[\]=+*#$%&^~。，、？！：；‘’'-]*[^\W_{_HAN}@])?")
_SENTENCES = re.compile(r"[^.!?。！？]+(?:[.!?](?=\d)[^.!?。！？]*)*[.!?。！？]+[”\"»’)」]*")
_TITLE = re.compile(r" – |: |：|^\d{1,3}[ 、.]\s*\S")


class Line:
    """What both classifiers ask of a line, found once."""

    __slots__ = ("raw", "s", "ended", "page", "gap", "upper", "lower", "hyphen", "letters", "title")

    def __init__(self, raw: str):
        self.raw, s = raw, raw.strip()
        self.s = s
        digit = any(map(str.isdigit, s))
        self.ended = bool(_END.search(s))
        self.page = digit and len(s) < 24 and bool(_PAGE.match(s))
        self.gap = digit and "  " in raw and bool(_GAP.search(raw))
        self.lower = s[:1].islower()
        self.letters = not s.isupper() and not s.islower() and not any(map(str.isalpha, s))
        self.upper = s.isupper()
        self.hyphen = s[-1:] in "-‐‑­¬" and bool(_HYPHEN.search(raw))
        self.title = len(s) < 70 and bool(_TITLE.search(s))


_NONE = Line("")


def _line_features(lines: list[Line], i: int, width: int) -> tuple[float, ...]:
    x = lines[i]
    before, after = (lines[i - 1] if i else _NONE), (lines[i + 1] if i + 1 < len(lines) else _NONE)
    return (
        1.0,
        x.page,
        x.gap,
        x.upper,
        before.page or after.page or before.gap,
        not x.ended,
        min(1.5, len(x.s) / max(width, 1)),
        bool(before.s) and not before.ended and not before.page,
        after.lower,
        x.lower,
        x.title,
        x.s[-1:] in ",，、-‐­¬",
        i == 0 or i + 1 == len(lines),
        x.letters,
    )


def _pair_features(x: Line, y: Line, gap: bool, width: int) -> tuple[float, ...]:
    a, b = x.s, y.s
    han = "㐀" <= a[-1:] <= "鿿" or "㐀" <= b[:1] <= "鿿"
    return (
        1.0,
        x.ended,
        x.hyphen,
        a[-1:] in ",，、；;:：",
        y.lower,
        b[:1].isupper() or b[:1] in "“«„¿¡",
        b[:1].isdigit(),
        han,
        han and not x.ended,
        min(1.5, len(a) / max(width, 1)),
        gap,
        a[-1:].isalnum(),
        b[:1] in "。，、？！.,",
    )


class Logistic:
    def __init__(self, weights: np.ndarray):
        self.w = [float(w) for w in weights]

    @classmethod
    def fit(cls, x: list[list[float]], y: list[bool], rounds: int = 400, rate: float = 0.5, decay: float = 1e-3) -> Logistic:
        a, t = np.array(x, np.float64), np.array(y, np.float64)
        w = np.zeros(a.shape[1])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            w -= rate * (a.T @ (p - t) / len(t) + decay * w)
        return cls(w)

    def __call__(self, f: tuple[float, ...]) -> bool:
        return sum(map(operator.mul, self.w, f)) > 0


class Page:
    """Lines of a made-up page with what is true of them: furniture or not, and which neighbours belong together."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.furniture: list[bool] = []
        self.joins: list[tuple[int, int, bool, bool]] = []  # places of two lines, a blank line between them, together


def wrap(text: str, width: int, rng: random.Random) -> list[str]:
    """A text as a page of that width breaks it: at blanks, within words with a hyphen, Han text anywhere."""
    out, rest = [], text.strip()
    while len(rest) > width:
        cut = rest.rfind(" ", width // 2, width + 1)
        word = rest.find(" ", width)
        end = word if word > 0 else len(rest)
        begin = cut + 1 if cut > 0 else 0
        if _HANS.search(rest[max(0, width - 2) : width + 1]):
            out.append(rest[:width])
            rest = rest[width:]
        elif rng.random() < 0.35 and width - begin >= 2 and end - width >= 2 and rest[width - 2 : width + 2].isalpha():
            out.append(rest[:width] + rng.choice("--\u2010\u00ad\u00ac"))
            rest = rest[width:]
        elif cut > 0:
            out.append(rest[:cut])
            rest = rest[cut + 1 :]
        else:
            break
    return [*out, rest] if rest else out


def made_up(body: list[str], furniture: list[str], seed: int = 3) -> Iterator[Page]:
    """Pages made of whole texts and of the running heads and page numbers that stand in regions of their own.

    What is true of their lines follows from how they were made, not from how they look.
    """
    rng = random.Random(seed)
    for t, after in zip(body, [*body[1:], *body[:1]]):
        page, han = Page(), len(_HANS.findall(t[:40])) > 0
        wrapped = wrap(t, rng.randrange(12, 36) if han else rng.randrange(28, 90), rng)
        spot = rng.randrange(1, len(wrapped)) if len(wrapped) > 1 and furniture and rng.random() < 0.6 else -1
        last = None
        for i, x in enumerate(wrapped):
            if i == spot:
                for f in rng.sample(furniture, min(len(furniture), rng.choice((1, 1, 2)))):
                    page.lines.append(f)
                    page.furniture.append(True)
            page.lines.append(x)
            page.furniture.append(False)
            here = len(page.lines) - 1
            if last is not None and not _END.search(page.lines[last]):  # a break between whole sentences is none
                page.joins.append((last, here, False, True))
            last = here
        for x in wrap(after, 10_000, rng)[:1]:
            page.lines.append(x)
            page.furniture.append(False)
            page.joins.append((last, len(page.lines) - 1, rng.random() < 0.5, False))
        yield page
        # the same sentences, each on a line of its own, as lists have them
        page, number = Page(), rng.choice(("", "", "", "{}: ", "{} – ", "({}) "))
        page.lines = [number.format(i + 1) + x.strip() for i, x in enumerate(_SENTENCES.findall(t)) if x.strip()] + [after.strip()]
        page.furniture = [False] * len(page.lines)
        page.joins = [(i, i + 1, rng.random() < 0.3, False) for i in range(len(page.lines) - 1)]
        yield page


class LineModels:
    """Furniture and joins; fitted on pages made up from whole texts and from real running heads and page numbers."""

    def __init__(self, furniture: Logistic, join: Logistic):
        self.furniture, self.join = furniture, join

    @classmethod
    def fit(cls, body: list[str], furniture: list[str]) -> LineModels:
        fx, fy, jx, jy = [], [], [], []
        for page in made_up(body, furniture):
            lines, width = [Line(x) for x in page.lines], max(map(len, page.lines[:-1]), default=0)
            for i in range(len(lines) - 1):
                fx.append(_line_features(lines, i, width))
                fy.append(page.furniture[i])
            for i, j, gap, together in page.joins:
                jx.append(_pair_features(lines[i], lines[j], gap, width))
                jy.append(together)
        if len(set(fy)) < 2 or len(set(jy)) < 2:  # nothing to learn from: the signs that speak for themselves
            f, j = np.zeros(14), np.zeros(13)
            f[[0, 1, 2, 3]] = -1.0, 3.0, 3.0, 1.5
            j[[0, 1, 2, 4, 8]] = -0.5, -3.0, 3.0, 2.0, 1.0
            return cls(Logistic(f), Logistic(j))
        return cls(Logistic.fit(fx, fy), Logistic.fit(jx, jy))

    def mend(self, text: str) -> tuple[str, int, int]:
        """(text with lines joined and furniture left out, joins, furniture lines)."""
        if "\n" not in text:
            return text, 0, 0
        fenced, lines, solid, blank, gap = "```" in text, [], [], [], False
        inside = False
        for raw in text.split("\n"):
            if not raw.strip():
                gap = bool(lines)
                continue
            x = Line(raw)
            fence = fenced and x.s.startswith("```")
            solid.append(inside or fence or (not x.page and not x.hyphen and bool(_SOLID.search(raw))))
            inside ^= fence
            lines.append(x)
            blank.append(gap)
            gap = False
        if len(lines) < 2:
            return text, 0, 0
        width = max((len(x.raw) for x, hard in zip(lines, solid) if not hard), default=0)
        kept = [i for i, x in enumerate(lines) if solid[i] or (x.ended and not x.page) or not self.furniture(_line_features(lines, i, width))]
        dropped, joins = len(lines) - len(kept), 0
        out = [lines[kept[0]].raw] if kept else [""]
        for j, i in zip(kept, kept[1:]):
            x, y = lines[j], lines[i]
            near = i == j + 1
            if solid[i] or solid[j] or not self.join(_pair_features(x, y, blank[i] and near, width)) or x.s.lower() == y.s.lower():
                out += ["\n\n" if blank[i] else "\n", y.raw]
                continue
            joins += near  # across furniture the break is the furniture's
            first = y.s[:1]
            if x.hyphen:
                out[-1] = out[-1].rstrip()[:-1]
            elif not (_HANS.match(first) or first in "。，、？！：；”" or (_HANS.match(x.s[-1:]) and first.isdigit()) or (x.s[-1:].isdigit() and _HANS.search(y.s[:8]))):
                out.append(" ")
            out.append(y.s)
        return "".join(out), joins, dropped


_FORMS = re.compile(r"[\u00ad\u0300-\u036f\u200b-\u200f\u2060\ufeff\u2f00-\u2fdf\ufb00-\ufb06\uff10-\uff5a]")
_NOT_PROSE = re.compile(r"```[\s\S]*?(?:```|$)|`[^`\n]*`|\\[A-Za-z]+")
_WHOLE = re.compile(r"[\W\d_]\s*$")


def words(text: str) -> list[str]:
    """Words of alphabetic scripts, and windows of three characters of Han text.

    Other forms of the same characters are no misreadings and are folded first; a last word without a sign
    after it may have been cut and is left out.
    """
    if not text.isascii() and _FORMS.search(text):
        text = lookalike.fold(text)
    if "`" in text or "\\" in text or "&" in text:
        text = html.unescape(_NOT_PROSE.sub(" ", text))
    out = _WORD.findall(text)
    if out and not _WHOLE.search(text):
        out.pop()
    if not text.isascii():
        for run in _HANS.findall(text):
            out += [run[i : i + 3] for i in range(len(run) - 2)]
    return out


def _prose(df: DataFrame, key: str, text: str, kind: str) -> DataFrame:
    return df.where((F.length(text) > 0) & F.coalesce(F.col(kind), F.lit("text")).isin(*PROSE)).select(F.col(key).alias("k"), F.col(text).alias("t"))


def _some(rows: DataFrame, text: str, most: int, key: str) -> list[str]:
    """About ``most`` of the texts, picked by a hash of the key."""
    share = min(1.0, most / max(1, rows.count()))
    return sorted(r[0] for r in rows.where(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < int(share * 1_000_000)).select(text).collect())


def fit_lines(df: DataFrame, key: str, text: str, kind: str) -> LineModels:
    """Fit on pages made up from about ``TRAINING_TEXTS`` whole prose texts of one line, and as many running heads and numbers."""
    ended = F.col(text).rlike(r"[.!?。！？][”\"»’)」]?\s*$")
    body = df.where(F.coalesce(F.col(kind), F.lit("text")).isin(*PROSE) & F.length(text).between(60, 2000) & ~F.contains(F.col(text), F.lit("\n")) & ended)
    heads = df.where(F.col(kind).isin(*FURNITURE) & (F.length(F.trim(text)) > 0) & ~F.contains(F.col(text), F.lit("\n")))
    return LineModels.fit(_some(body, text, TRAINING_TEXTS, key), _some(heads, text, TRAINING_TEXTS, key))


def count_words(rows: DataFrame, models) -> DataFrame:
    """(w, n) over all texts after joining; a task adds up before it emits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mend = models.value.mend
        counts: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["w", "n"])
            counts.clear()
            return out

        for b in batches:
            for t in b.column(0).to_pylist():
                counts.update(words(mend(t)[0]))
            if len(counts) > 300_000:
                yield flush()
        yield flush()

    return rows.select("t").mapInArrow(run, "w string, n bigint").groupBy("w").agg(F.sum("n").alias("n"))


def _difference(bad: str, good: str) -> str:
    """What was read for what: the differing middle of both."""
    i = 0
    while i < min(len(bad), len(good)) and bad[i] == good[i]:
        i += 1
    j = 0
    while j < min(len(bad), len(good)) - i and bad[-1 - j] == good[-1 - j]:
        j += 1
    return f"{bad[i : len(bad) - j]}>{good[i : len(good) - j]}"


class Stumps:
    """Gradient boosting on stumps with the logistic loss."""

    def __init__(self) -> None:
        self.trees: list[tuple[int, float, float, float]] = []
        self.base = 0.0

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, rounds: int = 60, rate: float = 0.3) -> Stumps:
        s = cls()
        p = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        s.base = float(np.log(p / (1 - p)))
        z = np.full(len(y), s.base)
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0.05, 0.95, 19))) for f in range(x.shape[1])]
        for _ in range(rounds):
            q = 1 / (1 + np.exp(-z))
            g, h = y - q, q * (1 - q)
            best = None
            for f in range(x.shape[1]):
                for c in cuts[f]:
                    m = x[:, f] > c
                    gr, hr = g[m].sum(), h[m].sum()
                    gl, hl = g.sum() - gr, h.sum() - hr
                    gain = gr * gr / (hr + 1) + gl * gl / (hl + 1)
                    if best is None or gain > best[0]:
                        best = (gain, f, c, gl / (hl + 1), gr / (hr + 1))
            _, f, c, left, right = best
            s.trees.append((f, float(c), float(rate * left), float(rate * right)))
            z += np.where(x[:, f] > c, rate * right, rate * left)
        return s

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for f, c, left, right in self.trees:
            z += np.where(x[:, f] > c, right, left)
        return z


FEATURES = ("ratio", "distance", "size", "support", "odd", "capital", "han")


#: Letters with and without accents.
_ACCENTED = "ÀÁÂÃÄÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜàáâãäçèéêëìíîïñòóôõöùúûüйёЙЁ"
_PLAIN = "AAAAACEEEEIIIINOOOOOUUUUaaaaaceeeeiiiinooooouuuuиеИЕ"


_ODD = r"[^\p{L}]"


def plain(c):
    return F.translate(c, _ACCENTED, _PLAIN)


def _swap(bad: str, good: str):
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([_difference(a, b) for a, b in zip(x, y)])

    return F.pandas_udf(run, "string")(bad, good)


def _is_han(w: str = "w"):
    return F.col(w).rlike(f"^[{_HAN}]{{3}}$")


def _met(counts: DataFrame, frequent: DataFrame, keys, ratio: float, apart: bool = True) -> DataFrame:
    """(bad, good, nb, ng) that share a key, the first rare in proportion to the second.

    The length is part of the key, so that words which many others share an end with meet only those of their own
    length, or with ``apart`` of one character more or less.

    A misreading that befalls a very common word may itself be frequent, so the ratio alone tells.
    """
    size = F.length("w")
    a = counts.select(F.col("w").alias("bad"), F.col("n").alias("nb"), F.explode(keys).alias("key"), F.explode(F.array(size - 1, size, size + 1)).alias("size")) if apart else counts.select(F.col("w").alias("bad"), F.col("n").alias("nb"), F.explode(keys).alias("key"), size.alias("size"))
    b = frequent.select(F.col("w").alias("good"), F.col("n").alias("ng"), F.explode(keys).alias("key"), size.alias("size"))
    met = a.join(F.broadcast(b), ["key", "size"]).where((F.col("bad") != F.col("good")) & (F.col("nb") <= F.greatest(F.lit(1.0), ratio * F.col("ng"))))
    return met.groupBy("bad", "good").agg(F.max("nb").alias("nb"), F.max("ng").alias("ng"))


def _holes(most: int):
    """Keys of the column ``w``: the word with one place, of one or of two characters, left open."""
    at = f"sequence(0, {most - 1})"
    keys = [f"transform(filter({at}, i -> i + {n} <= length(w) and length(w) > {n}), i -> concat(substring(w, 1, i), '_', substring(w, i + {n + 1})))" for n in (1, 2)]
    return F.expr(f"concat({', '.join(keys)})")


def candidates(counts: DataFrame, frequent: DataFrame) -> DataFrame:
    """(bad, good, nb, ng, distance, swap, ends): rare words with frequent ones of the same keys.

    A misread place of one or two characters leaves the first or the last ``GRAM`` characters of a word of more
    than 2 * GRAM whole, and both outer characters of a Han window; these are the join keys. Shorter words, from two
    characters on, also meet by what is left around the place. ``ends`` tells that the outer characters met.
    ``frequent`` has at most 1 / FREQUENT_SHARE rows. A change of case or accents only, or of a letter more or
    less, is no misreading.
    """
    long = ~_is_han() & (F.length("w") > GRAM)
    short = ~_is_han() & F.length("w").between(2, 2 * GRAM)
    ends = F.array(F.concat(F.lit("p"), F.substring("w", 1, GRAM)), F.concat(F.lit("s"), F.expr(f"right(w, {GRAM})")))
    outer = F.array(F.concat(F.substring("w", 1, 1), F.substring("w", 3, 1)))
    by_ends = _met(counts.where(long), frequent.where(long), ends, RARE_RATIO).withColumn("ends", F.lit(True))
    by_hole = _met(counts.where(short), frequent.where(short), _holes(2 * GRAM), RARE_RATIO).withColumn("ends", F.lit(False))
    met = by_ends.unionByName(by_hole).groupBy("bad", "good").agg(*[F.max(c).alias(c) for c in ("nb", "ng", "ends")])
    met = met.where(plain(F.lower("bad")) != plain(F.lower("good")))
    met = met.unionByName(_met(counts.where(_is_han()), frequent.where(_is_han()), outer, RARE_RATIO_HAN, False).withColumn("ends", F.lit(True)))
    near = met.withColumn("distance", F.levenshtein("bad", "good", 2)).where("distance between 1 and 2")
    return near.withColumn("swap", _swap("bad", "good")).where(~F.col("swap").rlike("^>|>$"))


def edge_windows(counts: DataFrame, frequent: DataFrame, wrong: DataFrame) -> DataFrame:
    """(w): Han windows with a misread character at their edge, by the swaps found in the middle of others."""
    keys = F.array(F.concat(F.lit("f"), F.substring("w", 1, 2)), F.concat(F.lit("l"), F.substring("w", 2, 2)))
    swaps = wrong.where(_is_han("good")).select(_swap("bad", "good").alias("swap")).distinct()
    met = _met(counts.where(_is_han()), frequent.where(_is_han()), keys, RARE_RATIO_HAN, False).withColumn("swap", _swap("bad", "good"))
    return met.join(swaps, "swap", "left_semi").select(F.col("bad").alias("w")).distinct()


def misreadings(counts: DataFrame, frequent: DataFrame) -> DataFrame:
    """(bad, good): the replacements that the ranker accepts, one per misread form."""
    pairs = through_disk(candidates(counts, frequent), "pairs")
    # short words differ in one letter by chance: only longer ones, or a sign within a word, speak for a swap
    speaks = F.col("ends") | ((F.length("good") > GRAM) & F.col("bad").rlike(_ODD))
    support = pairs.where(speaks).groupBy("swap").agg(F.countDistinct("good").alias("support"))
    rated = pairs.join(support, "swap").select(
        "ends",
        "bad",
        "good",
        F.log((F.col("ng") + 1) / (F.col("nb") + 0.5)).alias("ratio"),
        F.col("distance").cast("double").alias("distance"),
        F.length("good").cast("double").alias("size"),
        F.log1p("support").alias("support"),
        F.col("bad").rlike(_ODD).cast("double").alias("odd"),
        F.col("bad").rlike(r"^\p{Lu}").cast("double").alias("capital"),
        F.col("good").rlike(f"^[{_HAN}]{{3}}$").cast("double").alias("han"),
        F.xxhash64("bad", "good").alias("h"),
    )
    total, plenty = pairs.agg(F.count(F.lit(1)), F.count_if("ends")).first()
    if not total:
        return rated.select("bad", "good")
    share = min(1.0, TRAINING_PAIRS / max(1, plenty))
    train = rated.where("ends").where(F.pmod("h", F.lit(1_000_000)) < int(share * 1_000_000)).toPandas().sort_values(["bad", "good"])
    ranker = _fit_ranker(train)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["score"] = ranker.score(b[list(FEATURES)].to_numpy(np.float64)) if len(b) else []
            yield b.loc[b["score"] > 0, ["bad", "good", "score"]]

    accepted = rated.select("bad", "good", *FEATURES).mapInPandas(run, "bad string, good string, score double")
    return accepted.groupBy("bad").agg(F.max_by("good", F.struct("score", "good")).alias("good"))


def _fit_ranker(train: pd.DataFrame) -> Stumps:
    """Labels from the plain cases: a sign or digit within a word, or a swap seen in many words, speaks for a misreading;
    a capitalised word whose swap hardly occurs elsewhere is a name."""
    x = train[list(FEATURES)].to_numpy(np.float64)
    han = train["good"].str.match(f"^[{_HAN}]{{3}}$").to_numpy(bool)
    support, ratio, odd, capital, distance = (train[c].to_numpy() for c in ("support", "ratio", "odd", "capital", "distance"))
    many = np.log1p(np.where(han, 3, 6))
    clear = np.where(han, 1.9, 3.2)
    yes = ((odd > 0) & (distance <= 1) & (ratio > 2.0)) | ((support >= many) & (ratio > clear) & ((distance <= 1) | (support >= 2 * many)))
    no = (support <= np.log1p(2)) | (ratio < clear - 0.6) | ((capital > 0) & (distance > 1) & (support < np.log1p(12)))
    sure = yes ^ no
    # a few made-up pairs, always there, say what the features mean where the corpus has hardly a plain case
    prior = [(r, d, 6.0, np.log1p(n), 0.0, 0.0, 0.0, r > 3.5 and n > 3) for r in (1.0, 2.5, 3.2, 3.8, 5.0, 7.0) for d in (1.0, 2.0) for n in (1, 2, 3, 4, 6, 12)]
    made = np.array(prior, np.float64)
    return Stumps.fit(np.concatenate([made[:, :-1], x[sure]]), np.concatenate([made[:, -1], yes[sure].astype(float)]))


def _known(frequent: DataFrame):
    return frozenset(r[0] for r in frequent.select("w").collect())  # at most 1 / FREQUENT_SHARE


class Prepared:
    """Line models, frequent words and misreadings of a corpus."""

    def __init__(self, df: DataFrame, key: str, text: str, kind: str):
        self.rows = _prose(df, key, text, kind)
        sc = df.sparkSession.sparkContext
        self.lines = sc.broadcast(fit_lines(df, key, text, kind))
        self.counts = through_disk(count_words(self.rows, self.lines), "words")
        total = self.counts.agg(F.sum("n")).first()[0] or 0
        self.frequent = self.counts.where(F.col("n") >= max(FREQUENT_LEAST, FREQUENT_SHARE * total))
        self.wrong = through_disk(misreadings(self.counts, self.frequent), "misread")
        bad = self.wrong.select(F.col("bad").alias("w")).unionByName(edge_windows(self.counts, self.frequent, self.wrong)).distinct()
        self.known = sc.broadcast(_known(self.frequent.join(bad, "w", "left_anti")))


def noisy(df: DataFrame, key: str = "result_id", text: str = "text", kind: str = "class") -> DataFrame:
    """(key, cause): texts with joined lines, furniture, words in two, or misread words."""
    p = Prepared(df, key, text, kind)
    lines, known = p.lines, p.known

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mend, have = lines.value.mend, known.value
        for b in batches:
            at, cause, word = [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                t, joins, dropped = mend(t)
                if joins or dropped:
                    at.append(i)
                    cause.append("lines" if joins else "furniture")
                    word.append(None)
                    continue
                w = words(t)
                rare = suspicious(w, have)
                if rare and not t.isascii():
                    rare = {x for x in rare if x.isascii() or not _alike(x, have)}
                if broken_word(t, w, have):
                    at.append(i)
                    cause.append("split")
                    word.append(None)
                    continue
                at += [i] * len(rare)
                cause += ["misread"] * len(rare)
                word += rare
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(cause, pa.string()), pa.array(word, pa.string())], ["k", "cause", "w"])

    seen = through_disk(p.rows.mapInArrow(run, f"k {df.schema[key].dataType.simpleString()}, cause string, w string"), "noise")
    plain = seen.where("w is null").select("k", "cause")
    misread = seen.where("w is not null").join(p.wrong.select(F.col("bad").alias("w")), "w", "left_semi").select("k", "cause")
    return plain.unionByName(misread).distinct().withColumnRenamed("k", key)


def suspicious(tokens: list[str], have: frozenset[str]) -> set[str]:
    """Tokens of a text that may be misread: words unknown in any case, and Han windows whose neighbours are unknown too."""
    out = set()
    for i, w in enumerate(tokens):
        if w in have:
            continue
        if _HANS.match(w):
            before, after = (tokens[i - 1] if i else ""), (tokens[i + 1] if i + 1 < len(tokens) else "")
            if (before[1:] == w[:2] and before in have) or (after[:2] == w[1:] and after in have):
                continue
        elif w.lower() in have or w.capitalize() in have:
            continue
        out.add(w)
    return out


_MIXED = re.compile(r"(?=.*[A-Za-zÀ-ɏ])(?=.*[Ͱ-ӿ])")


def _alike(word: str, have: frozenset[str]) -> bool:
    """True if a word of mixed scripts is a frequent word but for look-alike letters, which is another kind of noise."""
    return bool(_MIXED.match(word)) and any(word.translate(m) in have for m in lookalike.TO_SCRIPT.values())


def broken_word(text: str, tokens: list[str], have: frozenset[str]) -> bool:
    """True if two neighbours, at least one of them no frequent word, make a frequent word together."""
    for a, b in zip(tokens, tokens[1:]):
        if (a not in have or b not in have) and len(a) + len(b) >= 4 and a + b in have and b[:1].islower() and f"{a} {b}" in text:
            return True
    return False


def repaired(df: DataFrame, key: str = "result_id", text: str = "text", kind: str = "class") -> DataFrame:
    """(key, text): every prose text as continuous paragraphs, with misread words replaced.

    The replacements of a text come to it by a join on its rare words, not by a list sent to every task.
    """
    p = Prepared(df, key, text, kind)
    lines, known = p.lines, p.known
    key_type = df.schema[key].dataType.simpleString()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mend, have = lines.value.mend, known.value
        for b in batches:
            out, rare = [], []
            for t in b.column(1).to_pylist():
                t = mend(t)[0]
                w = words(t)
                for x, y in zip(w, w[1:]):
                    if (x not in have or y not in have) and len(x) + len(y) >= 4 and x + y in have and y[:1].islower():
                        t = t.replace(f"{x} {y}", x + y)
                out.append(t)
                rare.append(sorted(suspicious(w, have)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string()), pa.array(rare, pa.list_(pa.string()))], ["k", "t", "rare"])

    mended = through_disk(p.rows.mapInArrow(first, f"k {key_type}, t string, rare array<string>"), "mended")
    use = mended.select("k", F.explode("rare").alias("bad")).join(p.wrong, "bad").groupBy("k").agg(F.map_from_entries(F.collect_set(F.struct("bad", "good"))).alias("use"))
    both = mended.select("k", "t").join(use, "k", "left")

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, u in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                for bad, good in u or ():
                    t = t.replace(bad, good) if _HANS.match(bad) else re.sub(rf"(?<!\w){re.escape(bad)}(?!\w)", lambda _: good, t)
                out.append(t)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], ["k", "text"])

    return both.mapInArrow(second, f"k {key_type}, text string").withColumnRenamed("k", key)
