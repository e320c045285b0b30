"""Problem 5: the language of each text, and of each segment of a mixed one, with a confidence.

A byte convolutional network decides: filters of several widths over windows of a fixed number of bytes,
a maximum over positions, and a softmax. It is trained in numpy on a bounded sample of texts that came
with a label; some labels are wrong, so after a first round the texts that the network contradicts are
left out of the second. At work, the filters are folded into tables by byte pairs, and windows go through
in batches.

A text is cut into sentences; a sentence is as long as it takes of windows, whose log probabilities add
up. The network has the say; the script of the letters only vetoes, as a sentence in Han characters is not
German. The confidence is the network's, less what letters take from it that the language's training texts do
not have: so a language that was not trained comes out with little. Below ``LEAST_CONFIDENCE`` a text's language
is undetermined, ``und``.

Defined results: for ``mislabelled``, null, empty and blank texts and texts without a whole sentence have no
language; blank labels and fillers count as missing; a label in another spelling of the same language is right.
``detect`` and ``segments`` give every text at least one row: one without a whole sentence is read as it stands, and
one of hardly any letters is ``und`` with confidence 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The languages and the spellings of their labels.
LABELS = {
    "en": ("en", "eng", "english"),
    "zh": ("zh", "zho", "chi", "cmn", "chinese", "中文"),
    "de": ("de", "deu", "ger", "german", "deutsch"),
    "fr": ("fr", "fra", "fre", "french", "français"),
    "es": ("es", "spa", "spanish", "español", "castellano"),
    "pt": ("pt", "por", "portuguese", "português"),
    "ru": ("ru", "rus", "russian", "русский"),
}
LANGS = tuple(LABELS)
#: Layout classes whose texts hold sentences; a null class may as well.
PROSE = ("text", "abstract", "aside_text", "content", "footnote", "vision_footnote", "vertical_text")
WINDOW, WIDTHS, FILTERS = 64, (2, 3, 4), 16
#: Labelled texts the network is fitted on (a bound; the rest of the corpus is only read by it).
TRAINING_TEXTS = 4000
EPOCHS, BATCH, RATE = 3, 128, 0.08
#: Below this a text's language is undetermined; how much a letter that the language's texts lack takes away.
UNDETERMINED, LEAST_CONFIDENCE, STRANGE = "und", 0.5, 30.0
#: A language besides a text's main one needs this confidence in some sentence.
SECOND_CONFIDENCE = 0.8

_NEWLINE = re.compile(r"[ \t]*\n[ \t]*")
_MARKUP = re.compile(r"<[^<>\n]{1,80}>|&#?\w{2,8};|```[\s\S]*?```|`[^`\n]*`|https?://\S+|\{\||\|\}|^\s*[|!].*$|\\[a-zA-Z]+\{?", re.M)
_SENTENCE = re.compile(r"[^.!?。！？]+(?:[.!?](?![\s”\"»’)\]]|$)[^.!?。！？]*)*(?:[.!?。！？]+[”\"»’)\]“」』]*|$)")
_HAN, _CYR, _LAT = re.compile("[㐀-鿿]"), re.compile("[Ѐ-ӿ]"), re.compile("[A-Za-zÀ-ɏ]")
_END = re.compile(r"[.!?。！？][”\"»’)\]“」』\s]*$")


def label_language(label: Column) -> Column:
    """The language a label names, or null for missing, filler and other labels."""
    bare = F.lower(F.trim(label))
    stem = F.regexp_extract(bare, r"^([^-_ ]+)", 1)
    out = F.lit(None).cast("string")
    for lang, names in LABELS.items():
        out = F.when(stem.isin(*names), F.lit(lang)).otherwise(out)
    return out


def sentences(text: str) -> list[str]:
    """The whole sentences of a text: they end in an end mark and hold more than a name or a number."""
    out = []
    if "<" in text or "&" in text or "`" in text or "\\" in text or "|" in text:
        text = _MARKUP.sub(" ", text)
    for block in text.split("\n\n"):
        for s in _SENTENCE.findall(block):
            if _END.search(s) and (len(s) >= 16 or len(_HAN.findall(s)) >= 6):
                s = _NEWLINE.sub(" ", s).strip()
                letters = len(_HAN.findall(s)) * 2 + len(_CYR.findall(s)) + len(_LAT.findall(s))
                if letters >= 12 and len(set(s)) >= 8 and (letters >= 2 * s.count(" ") or " " not in s):
                    out.append(s)
    return out


def windows(data: bytes) -> list[bytes]:
    """Fixed-length windows that cover all of ``data``; the last one reaches back, or is filled up."""
    n = len(data)
    if n <= WINDOW:
        return [data.ljust(WINDOW, b"\0")]
    cuts = [data[i : i + WINDOW] for i in range(0, n - WINDOW + 1, WINDOW)]
    if n % WINDOW >= 8:
        cuts.append(data[-WINDOW:])
    return cuts


class ByteNet:
    """Multi-width convolution over bytes, max pooling and softmax."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.filters = {w: (rng.standard_normal((w, 256, FILTERS)) * 0.1).astype(np.float32) for w in WIDTHS}
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = (rng.standard_normal((len(WIDTHS) * FILTERS, len(LANGS))) * 0.1).astype(np.float32)
        self.base = np.zeros(len(LANGS), np.float32)
        self.letters: dict[str, frozenset[str]] = {}

    def _pool(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        tops, where = [], []
        for w in WIDTHS:
            z = sum(self.filters[w][k][x[:, k : WINDOW - w + 1 + k]] for k in range(w))
            at = z.argmax(axis=1)
            where.append(at)
            tops.append(np.take_along_axis(z, at[:, None, :], 1)[:, 0])
        return np.concatenate(tops, axis=1), where

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        square = {id(p): np.full_like(p, 1e-6) for p in (*self.filters.values(), self.bias, self.out, self.base)}

        def step(p: np.ndarray, g: np.ndarray) -> None:
            s = square[id(p)]
            s += g * g
            p -= RATE * g / np.sqrt(s)

        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), BATCH):
                b = order[i : i + BATCH]
                xb, yb = x[b], y[b]
                top, where = self._pool(xb)
                h = np.maximum(top + self.bias, 0)
                logits = h @ self.out + self.base
                p = np.exp(logits - logits.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(b)), yb] -= 1
                p /= len(b)
                dh = (p @ self.out.T) * (h > 0)
                grads = []
                for j, w in enumerate(WIDTHS):
                    g = np.zeros_like(self.filters[w])
                    d = dh[:, j * FILTERS : (j + 1) * FILTERS]
                    for k in range(w):
                        byte = np.take_along_axis(xb, where[j] + k, 1)
                        np.add.at(g[k], (byte, np.arange(FILTERS)[None, :]), d)
                    grads.append((self.filters[w], g))
                step(self.out, h.T @ p)
                step(self.base, p.sum(0))
                step(self.bias, dh.sum(0))
                for f, g in grads:
                    step(f, g)

    def logp(self, x: np.ndarray) -> np.ndarray:
        """Log probabilities by the plain filters; ``Tables`` gives the same, faster."""
        logits = np.maximum(self._pool(x)[0] + self.bias, 0) @ self.out + self.base
        m = logits.max(1, keepdims=True)
        return logits - m - np.log(np.exp(logits - m).sum(1, keepdims=True))


class Tables:
    """The filters of a trained network as tables by byte pairs: a width takes one or two look-ups."""

    def __init__(self, net: ByteNet):
        f = net.filters
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS)
        self.two = pair(f[2][0], f[2][1])
        self.three, self.third = pair(f[3][0], f[3][1]), f[3][2]
        self.front, self.rear = pair(f[4][0], f[4][1]), pair(f[4][2], f[4][3])
        self.net = net

    def logp(self, x: np.ndarray, chunk: int = 256) -> np.ndarray:
        out = np.empty((len(x), len(LANGS)), np.float32)
        for i in range(0, len(x), chunk):
            b = x[i : i + chunk]
            p = b[:, :-1].astype(np.int32) << 8
            p |= b[:, 1:]
            a = self.two.take(p, 0).max(1)
            c = self.three.take(p[:, :-1], 0)
            c += self.third.take(b[:, 2:], 0)
            d = self.front.take(p[:, :-2], 0)
            d += self.rear.take(p[:, 2:], 0)
            h = np.concatenate([a, c.max(1), d.max(1)], axis=1)
            h += self.net.bias
            logits = np.maximum(h, 0, out=h) @ self.net.out + self.net.base
            logits -= logits.max(1, keepdims=True)
            out[i : i + chunk] = logits - np.log(np.exp(logits).sum(1, keepdims=True))
        return out


def _stack(cuts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(cuts), np.uint8).reshape(-1, WINDOW)


def train(texts: list[str], langs: list[str]) -> ByteNet:
    """Fit on labelled texts in two rounds; the second leaves out texts that the first contradicts."""
    cuts, y, owner = [], [], []
    seen: dict[str, Counter[str]] = {x: Counter() for x in LANGS}
    for i, (t, lang) in enumerate(zip(texts, langs)):
        found = sentences(t)
        for s in found[:: max(1, len(found) // 4)][:4]:  # from all parts of a long text
            seen[lang].update(set(s.lower()))
            for w in windows(s.lower().encode("utf-8", "replace"))[:3]:
                cuts.append(w)
                y.append(LANGS.index(lang))
                owner.append(i)
    net = ByteNet()
    if not cuts:
        return net
    x, y, owner = _stack(cuts), np.array(y), np.array(owner)
    net.fit(x, y, 1)
    keep = net.logp(x).argmax(1) == y
    if keep.any():
        x, y = x[keep], y[keep]
    net.fit(x, y, EPOCHS - 1, seed=12)
    net.letters = {lang: frozenset(c for c, n in k.items() if n > 1) for lang, k in seen.items()}
    return net


def training_sample(df: DataFrame, key: str, text: str, label: str, kind: str | None) -> tuple[list[str], list[str]]:
    """About ``TRAINING_TEXTS`` labelled prose texts, picked by a hash of the key; all are taken if there are fewer.

    The share to pick comes from a count over labels and classes, so that tasks send only what is used.
    """
    rows = df.withColumn("_l", label_language(F.col(label))).where(F.col("_l").isNotNull())
    if kind:
        rows = rows.where(F.coalesce(F.col(kind), F.lit("text")).isin(*PROSE))
    share = min(1.0, TRAINING_TEXTS / max(1, rows.count()))
    picked = rows.where((F.pmod(F.xxhash64(key), F.lit(1_000_000)) < int(share * 1_000_000)) & (F.length(text) >= 40))
    found = sorted((r["t"], r["_l"]) for r in picked.select(F.col(text).alias("t"), "_l").collect())
    return [t for t, _ in found], [x for _, x in found]


def _scripts(s: str) -> tuple[str, ...]:
    """The languages whose script leads among the letters of ``s``."""
    han, cyr, lat = 2 * len(_HAN.findall(s)), len(_CYR.findall(s)), len(_LAT.findall(s))
    top = max(han, cyr, lat)
    return ("zh",) if han == top else ("ru",) if cyr == top else ("en", "de", "fr", "es", "pt")


def _as_it_stands(text: str) -> list[str]:
    """A text without a whole sentence as one piece, if it has letters to tell by."""
    s = _NEWLINE.sub(" ", _MARKUP.sub(" ", text)).strip()
    return [s] if len(_LAT.findall(s)) + len(_CYR.findall(s)) + 3 * len(_HAN.findall(s)) >= 6 else []


def classify(texts: list[str | None], tables: Tables, every: bool = False) -> list[list[tuple[str, str, float]]]:
    """For each text its sentences as (sentence, language, confidence); with ``every``, texts without one as they stand."""
    cuts, spans, owners = [], [], []
    for i, t in enumerate(texts):
        for s in (sentences(t) or (every and _as_it_stands(t)) or ()) if t else ():
            w = windows(s.lower().encode("utf-8", "replace"))
            spans.append((len(cuts), len(w), s))
            owners.append(i)
            cuts += w
    out: list[list[tuple[str, str, float]]] = [[] for _ in texts]
    if not cuts:
        return out
    lp = tables.logp(_stack(cuts))
    total = np.add.reduceat(lp, [a for a, _, _ in spans], axis=0)
    known = tables.net.letters
    for (_, n, s), i, v in zip(spans, owners, total):
        v = np.exp((v - v.max()) / max(1, n) * min(n, 2))
        v /= v.sum()
        k = int(v.argmax())
        allowed = _scripts(s)
        if LANGS[k] not in allowed:
            k = max((LANGS.index(x) for x in allowed), key=v.__getitem__)
        lang, sure = LANGS[k], float(v[k])
        have = known.get(lang)
        if have:
            low = s.lower()
            strange = set(low) - have
            if strange:
                share = sum(low.count(c) for c in strange if c.isalpha()) / len(low)
                sure *= float(np.exp(-STRANGE * share)) if lang != "zh" else 1.0  # too many signs for a sample to have all
        out[i].append((s, lang, sure))
    return out


def languages(found: list[tuple[str, str, float]]) -> dict[str, float]:
    """The languages of a text with their best confidence: the main one by length, others if they are sure."""
    weight: dict[str, float] = {}
    best: dict[str, float] = {}
    for s, lang, c in found:
        weight[lang] = weight.get(lang, 0.0) + len(s.encode()) * c
        if not s[:1].islower():  # the rest of a sentence that was broken by a page tells of no second language
            best[lang] = max(best.get(lang, 0.0), c)
    main = max(weight, key=weight.get)
    return {main: best.get(main, max(c for _, lang, c in found if lang == main))} | {x: c for x, c in best.items() if c >= SECOND_CONFIDENCE}


def _fitted(df: DataFrame, key: str, text: str, label: str, kind: str | None):
    net = train(*training_sample(df, key, text, label, kind))
    return df.sparkSession.sparkContext.broadcast(net)  # some 150 kB


def detect(df: DataFrame, key: str = "result_id", text: str = "text", label: str = "lang", kind: str | None = "class") -> DataFrame:
    """(key, labelled, lang, confidence): a row per language of every text; ``labelled`` is what the label names."""
    net = _fitted(df, key, text, label, kind)
    source = df.select(F.col(key).alias("k"), label_language(F.col(label)).alias("labelled"), F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(net.value)
        for b in batches:
            for start in range(0, b.num_rows, 2000):
                part = b.slice(start, 2000)
                at, langs, conf = [], [], []
                for i, found in enumerate(classify(part.column(2).to_pylist(), tables, every=True)):
                    for lang, c in (languages(found) if found else {UNDETERMINED: 0.0}).items():
                        at.append(i)
                        langs.append(lang if c >= LEAST_CONFIDENCE else UNDETERMINED)
                        conf.append(c)
                idx = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).take(idx), part.column(1).take(idx), pa.array(langs, pa.string()), pa.array(conf, pa.float64())], ["k", "labelled", "lang", "confidence"])

    types = f"k {df.schema[key].dataType.simpleString()}, labelled string, lang string, confidence double"
    return source.mapInArrow(run, types).withColumnRenamed("k", key)


def mislabelled(df: DataFrame, key: str = "result_id", text: str = "text", label: str = "lang", kind: str | None = "class") -> DataFrame:
    """(key, lang) of the texts whose label is missing or names another language, or that mix languages.

    A text's languages come out next to each other in one task, so no shuffle is needed to know how many it has.
    """
    net = _fitted(df, key, text, label, kind)
    rows = df.where(F.length(text) >= 6)
    if kind:
        rows = rows.where(F.coalesce(F.col(kind), F.lit("text")).isin(*PROSE))
    source = rows.select(F.col(key).alias("k"), label_language(F.col(label)).alias("labelled"), F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(net.value)
        for b in batches:
            for start in range(0, b.num_rows, 2000):
                part = b.slice(start, 2000)
                at, langs = [], []
                for i, (found, named) in enumerate(zip(classify(part.column(2).to_pylist(), tables), part.column(1).to_pylist())):
                    if found:
                        here = languages(found)
                        if len(here) == 1 and named and max(here.values()) < LEAST_CONFIDENCE:
                            continue  # too little to speak against a label
                        if len(here) > 1 or named not in here:
                            at += [i] * len(here)
                            langs += here
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at, pa.int64())), pa.array(langs, pa.string())], ["k", "lang"])

    return source.mapInArrow(run, f"k {df.schema[key].dataType.simpleString()}, lang string").withColumnRenamed("k", key)


def segments(df: DataFrame, key: str = "result_id", text: str = "text", label: str = "lang", kind: str | None = "class") -> DataFrame:
    """(key, segment_no, lang, confidence, n_chars): the runs of sentences in one language of every text, in order."""
    net = _fitted(df, key, text, label, kind)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = Tables(net.value)
        for b in batches:
            out = []
            texts = [t if isinstance(t, str) else None for t in b["t"]]
            for k, t, found in zip(b["k"], texts, classify(texts, tables, every=True)):
                if not found:
                    out.append((k, 0, UNDETERMINED, 0.0, len(t or "")))
                    continue
                sure, runs = languages(found), []
                for s, lang, c in found:
                    lang = lang if lang in sure else max(sure, key=sure.get)
                    if runs and runs[-1][0] == lang:
                        runs[-1][1].append(c)
                        runs[-1][2] += len(s)
                    else:
                        runs.append([lang, [c], len(s)])
                for n, (lang, c, size) in enumerate(runs):
                    c = float(np.mean(c))
                    out.append((k, n, lang if c >= LEAST_CONFIDENCE else UNDETERMINED, c, size))
            yield pd.DataFrame(out, columns=["k", "segment_no", "lang", "confidence", "n_chars"])

    types = f"k {df.schema[key].dataType.simpleString()}, segment_no int, lang string, confidence double, n_chars int"
    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, types).withColumnRenamed("k", key)
