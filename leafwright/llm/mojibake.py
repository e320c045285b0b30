"""Problem 10: text decoded with a wrong character encoding.

A smoothed character trigram model is trained on the records that show no sign of garbling. A record is then
cut at blanks; every chunk that holds a character the model finds improbable where it stands is put through
all encode-decode chains, each of them twice where both steps decode. The likeliest result of a chunk is held
against the chunk as it stands, by log likelihood; a chain is accepted in a record if its chunks together gain
more than a margin. Margin and floor are validated on the chunks of the clean records: what chains gain there
must not be accepted. Records that show no sign but gain as garbled ones do are taken out of the counts
again. Replacement characters of lost bytes and controls of the C1 range are garbling that cannot be undone.

The counts lie in tables of a fixed size, by two hashes of which the smaller count holds; what collisions add
to half of all places is taken off, so that a growing corpus does not make everything probable.

Defined results: null, empty and purely ASCII texts are unaffected and come out as they are; a text whose
bytes were lost is found, with as much restored as decodes. No result depends on the order or the partition
of the records.
"""

from __future__ import annotations

import codecs
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwright.session import through_disk

#: Bits of the tables of trigrams and pairs (each twice, by two hashes) and of characters.
TRI_BITS, PAIR_BITS, UNI_BITS = 21, 20, 16
SMOOTHING = 2.0
#: A character is improbable where it stands below this conditional probability.
IMPROBABLE = 5e-3
#: The share of a character's occurrences at the beginning of a chunk, where nothing is known of it.
FIRST = 0.15
#: Decodings in which few byte sequences are valid, so that decoding at all speaks for the chain.
MANY_BYTES = ("utf-8", "gb18030")
#: The margin is this at least: what all chunks of a record together must gain by one chain, in nats.
LEAST_MARGIN = 4.0
#: What a chain must gain before it counts, in nats: for a step between code pages of one byte, where decoding proves
#: nothing, for a second step, and for a chunk of one character, which stands in no context.
ONE_BYTE_COST, SECOND_COST, ALONE_COST = 1.0, 2.0, 2.0
#: Once a chain is accepted in a record, its other chunks need this gain only.
FOLLOWING_GAIN = 0.7
#: A record that gains so many times that is taken for garbled when the model is trained.
SURE = 3
#: A result of a lower mean log likelihood is never text, unless it is valid UTF-8; the validated floor lies higher or here.
READABLE = -6.5
#: Bins a nat and the value beyond which all count alike, of the histograms.
BINS, FARTHEST = 20, 60
#: Chunks whose results a task keeps, and characters of texts rated at once.
HELD_CHUNKS, HELD_CHARS = 200_000, 200_000
#: The encodings tried, as (bytes are what X encodes, read them as Y).
CHAINS = (
    ("cp1252", "utf-8"),
    ("cp1251", "utf-8"),
    ("mac_roman", "utf-8"),
    ("gb18030", "utf-8"),
    ("cp850", "utf-8"),
    ("cp866", "utf-8"),
    ("koi8-r", "utf-8"),
    ("cp1252", "gb18030"),
    ("cp1252", "cp1251"),
    ("cp1252", "koi8-r"),
    ("cp1251", "cp1252"),
    ("cp1251", "cp866"),
    ("cp1251", "koi8-r"),
    ("koi8-r", "cp1251"),
    ("cp866", "cp1251"),
    ("cp850", "cp1252"),
    ("cp437", "cp1252"),
    ("cp866", "cp1252"),
    ("mac_roman", "cp1252"),
    ("cp1252", "mac_roman"),
    ("cp1252", "cp850"),
    ("cp1252", "cp437"),
    ("cp1250", "cp1252"),
    ("mac_cyrillic", "cp1251"),
    ("cp1251", "mac_cyrillic"),
)
#: Signs that keep a record out of training: C1 controls, private use, replacement, lead and trail byte pairs.
_SIGN = regex.compile(r"[\u0080-\u009f-�]|[Â-ô][\u0080-¿]|[ÃÂâ][^\x00-\x7fa-zA-Z]|[РС][Ђ-Џђ-џ‘-› -¿]")
_CONTROLS = regex.compile(r"[\u0080-\u0084\u0086-\u009f]")
_LOST = regex.compile(r"[\u0080-\u0084\u0086-\u009f\ufffd]")
_HIGH = regex.compile(r"[⺀-鿿가-﫿＀-￯]+|[^\x00-\x7f⺀-鿿가-﫿＀-￯]+")
_RATED = ["k", "t", "kind", "bin", "n"]


def _sloppy(name: str) -> dict[int, int]:
    """Where a code page leaves bytes undefined, decoders put the control of the same number: undo both."""
    out = {}
    for b in range(128, 256):
        try:
            out[ord(bytes([b]).decode(name))] = b
        except UnicodeDecodeError:
            out[b] = b
    return out


_TO_BYTES = {n: _sloppy(n) for n in ("cp1252", "cp1251", "cp1250")}
#: The same without the controls that stand for defined bytes, as the fast maps of the codecs module.
_FAST = {n: codecs.charmap_build("".join(bytes([b]).decode(n, "ignore") or chr(b) for b in range(256))) for n in _TO_BYTES}


def _encodable(name: str) -> frozenset[str]:
    if name in _TO_BYTES:
        return frozenset(map(chr, (*range(256), *_TO_BYTES[name])))
    return frozenset(bytes(range(256)).decode(name, "ignore"))


_ENCODABLE = {enc: _encodable(enc) for enc, _ in CHAINS if enc != "gb18030"}


def apply_chain(text: str, chain: tuple[str, str]) -> str | None:
    enc, dec = chain
    try:
        if enc in _TO_BYTES:
            data = text.translate(_TO_BYTES[enc]).encode("latin-1") if _CONTROLS.search(text) else codecs.charmap_encode(text, "strict", _FAST[enc])[0]
        else:
            data = text.encode(enc)
        out = data.decode(dec)
    except (UnicodeError, ValueError):
        return None
    return out if out != text and "\ufffd" not in out else None


def candidates(chunk: str) -> Iterator[tuple[str, str]]:
    """Every distinct result of one chain, or of two after a decoding of many bytes, with the chain's name."""
    seen = {chunk}

    def step(text: str, before: str) -> Iterator[tuple[str, str]]:
        here = set(text)
        for c in CHAINS:
            if c[0] in _ENCODABLE and not here <= _ENCODABLE[c[0]]:
                continue
            x = apply_chain(text, c)
            if x is not None and x not in seen:
                seen.add(x)
                name = f"{before}{c[0]}>{c[1]}"
                yield x, name
                if not before and c[1] in MANY_BYTES:
                    yield from step(x, name + ">")

    return step(chunk, "")


@cache
def cost(name: str, alone: bool) -> float:
    """What the gain of a chain is lessened by; ``alone`` tells of a chunk of one character."""
    readers = name.split(">")[1::2]
    signs = ALONE_COST if alone and readers[0] not in MANY_BYTES else 0.0
    return signs + ONE_BYTE_COST * sum(r not in MANY_BYTES for r in readers) + SECOND_COST * (len(readers) - 1)


# the model

_TRI, _PAIR = 1 << TRI_BITS, 1 << PAIR_BITS
#: Where each table begins in the flat array of counts: trigrams twice, pairs twice, characters.
_AT = np.cumsum([0, _TRI, _TRI, _PAIR, _PAIR, 1 << UNI_BITS])
SLOTS = int(_AT[-1])
_M = tuple(np.uint32(x) for x in (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1, 0xD3A2646D))


def _codes(text: str) -> np.ndarray:
    """Code points with line breaks as blanks; a lone surrogate counts as a question mark."""
    c = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).copy()
    c[c == 10] = 32
    return c


def _pair_slots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s = np.uint32(32 - PAIR_BITS)
    x = (a * _M[0]) ^ (b * _M[1])
    y = (a * _M[4] + b) * _M[5]
    return ((x >> s) + np.uint32(_AT[2])), (((y ^ (y >> np.uint32(15))) * _M[2] >> s) + np.uint32(_AT[3]))


def _tri_slots(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s = np.uint32(32 - TRI_BITS)
    x = ((a * _M[0]) ^ (b * _M[1])) * _M[2] + c * _M[3]
    y = ((a * _M[4] + b) * _M[5] + c) * _M[1]
    return x >> s, (((y ^ (y >> np.uint32(15))) * _M[0] >> s) + np.uint32(_AT[1]))


def _uni_slots(c: np.ndarray) -> np.ndarray:
    return ((c ^ (c >> np.uint32(16))) & np.uint32((1 << UNI_BITS) - 1)) + np.uint32(_AT[4])


class Counts:
    """Counts of one task, added up in the flat array."""

    def __init__(self) -> None:
        self.flat = np.zeros(SLOTS, np.int64)
        self.ascii = np.zeros(1 << 14, np.int64)
        self.waiting: list[np.ndarray] = []
        self.size = 0

    def add(self, c: np.ndarray) -> None:
        """Count the texts in ``c``, which begins and ends with two blanks."""
        a, b, d = c[:-2], c[1:-1], c[2:]
        high = (b | d) > 127
        low = ~high
        self.ascii += np.bincount((b[low] << np.uint32(7)) | d[low], minlength=1 << 14)
        self.flat[_AT[4] :] += np.bincount(_uni_slots(d) - np.uint32(_AT[4]), minlength=1 << UNI_BITS)
        at = np.nonzero(high)[0]
        self.waiting += _pair_slots(b[at], d[at])
        at = np.nonzero((high | (a > 127)) & (b != 32))[0]
        self.waiting += _tri_slots(a[at], b[at], d[at])
        self.size += sum(map(len, self.waiting[-4:]))
        if self.size > 4_000_000:
            self.flush()

    def flush(self) -> None:
        if self.waiting:
            self.flat += np.bincount(np.concatenate(self.waiting), minlength=SLOTS)
        self.waiting, self.size = [], 0

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        """(slots, counts) of all that is not zero."""
        self.flush()
        pairs = np.nonzero(self.ascii)[0].astype(np.uint32)
        for slots in _pair_slots(pairs >> np.uint32(7), pairs & np.uint32(127)):
            np.add.at(self.flat, slots, self.ascii[pairs])
        at = np.nonzero(self.flat)[0]
        return at, self.flat[at]


def flat_table(slots: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The counts as one array; what half of a table's places hold by collisions alone is taken off that table."""
    flat = np.zeros(SLOTS, np.float32)
    flat[slots] = n
    for begin, end in zip(_AT[:4], _AT[1:5]):
        half = np.median(flat[begin:end])
        if half:
            flat[begin:end] = np.maximum(flat[begin:end] - half, 0)
    return flat


def _packed(flat: np.ndarray) -> np.ndarray | tuple[np.ndarray, np.ndarray]:
    """What to send to the tasks: the array, or its places and values if these are smaller."""
    at = np.flatnonzero(flat)
    return (at.astype(np.uint32), flat[at]) if 2 * len(at) < SLOTS else flat


def _unpacked(sent: np.ndarray | tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    if isinstance(sent, np.ndarray):
        return sent
    flat = np.zeros(SLOTS, np.float32)
    flat[sent[0]] = sent[1]
    return flat


@dataclass
class Chunked:
    """Texts cut at blanks: where each chunk with a character beyond ASCII begins and ends, its text, its log likelihood."""

    text: str
    start: np.ndarray
    end: np.ndarray
    owner: np.ndarray
    total: np.ndarray
    n: np.ndarray
    improbable: np.ndarray


@dataclass
class NgramModel:
    flat: np.ndarray
    margin: float = LEAST_MARGIN
    floor: float = READABLE
    known: dict[tuple[str, str, str], tuple[str, str, float, float] | None] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.all = float(self.flat[_AT[4] :].sum()) + 1.0

    def _least(self, slots: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """A count without the occurrence at hand: the text under test was counted too."""
        return np.maximum(np.minimum(self.flat[slots[0]], self.flat[slots[1]]) - 1.0, 0.0)

    def logs(self, a: np.ndarray, b: np.ndarray, d: np.ndarray) -> np.ndarray:
        """log P(d | a, b), smoothed towards P(d | b) and that towards the frequency of d.

        After a blank it is the share of d's occurrences that follow one, as what follows a blank tells of the mix
        of languages only.
        """
        k = np.float32(SMOOTHING)
        alone = self.flat[_uni_slots(d)]
        back = (alone + 0.05) * np.float32(SMOOTHING / self.all)
        pair = self._least(_pair_slots(b, d))
        two = (pair + back) / (self.flat[_uni_slots(b)] + k)
        three = (self._least(_tri_slots(a, b, d)) + k * two) / (self._least(_pair_slots(a, b)) + k)
        return np.log(np.where(b == 32, (pair + k * FIRST) / (alone + k), three)).astype(np.float64)

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(log likelihood, places) of each text over the places that touch a character beyond ASCII."""
        if not texts:
            return np.zeros(0), np.ones(0)
        c = _codes("  " + "  ".join(texts) + "  ")
        size = np.fromiter(map(len, texts), np.int64, len(texts)) + 2
        owner = np.repeat(np.arange(len(texts)), size)
        a, b, d = c[:-2], c[1:-1], c[2:]
        high = np.nonzero((b > 127) | (d > 127))[0]
        logs = self.logs(a[high], b[high], d[high])
        mine = owner[np.minimum(high, len(owner) - 1)]  # a place counts for the text that its last two characters touch
        return np.bincount(mine, logs, len(texts)), np.maximum(np.bincount(mine, minlength=len(texts)), 1)

    def chunks(self, texts: list[str]) -> Chunked:
        """The chunks of many texts and what the model says of them."""
        text = "  " + "  ".join(texts) + "  "
        c = _codes(text)
        blank = c == 32
        begins = ~blank[1:] & blank[:-1]
        number = np.concatenate([[0], np.cumsum(begins)])  # of the chunk that a place lies in or behind
        a, b, d = c[:-2], c[1:-1], c[2:]
        high = np.nonzero((b > 127) | (d > 127))[0]
        logs = self.logs(a[high], b[high], d[high])
        mine = number[high + 2]
        total, n = np.bincount(mine, logs), np.bincount(mine)
        bad = np.bincount(mine[logs < np.log(IMPROBABLE)], minlength=len(n))
        start = np.nonzero(begins)[0] + 1
        end = np.nonzero(blank[1:] & ~blank[:-1])[0] + 1
        keep = np.nonzero(n)[0]
        edges = np.cumsum([2, *(len(t) + 2 for t in texts)])
        start, end = start[keep - 1], end[keep - 1]
        return Chunked(text, start, end, np.searchsorted(edges, start, side="right") - 1, total[keep], n[keep], bad[keep] > 0)

    def decide(self, places: list[tuple[str, str, str]]) -> None:
        """Find the likeliest result of parts between what surrounds them, where it is not known yet.

        ``known`` then has (text, chain, gain, mean log likelihood) by (before, part, behind).
        """
        if len(self.known) > HELD_CHUNKS:
            self.known.clear()
        new = [p for p in dict.fromkeys(places) if p not in self.known]
        every, names, ends = [], [], []
        for a, part, z in new:
            every.append(a + part + z)
            names.append("")
            letters = any(map(str.isalpha, part))
            for x, name in candidates(part):
                # chains of one byte leave signs alone nothing to go by
                if letters or name.endswith(MANY_BYTES) or any(map(str.isalpha, x)):
                    every.append(a + x + z)
                    names.append(name)
            ends.append(len(every))
        total, n = self.scores(every)
        at = 0
        for (a, part, z), end in zip(new, ends):
            self.known[a, part, z] = None
            if end > at + 1:
                alone = len(a + part + z) == 1
                less = {i: total[i] - cost(names[i], alone) for i in range(at + 1, end)}
                i = max(less, key=less.get)
                self.known[a, part, z] = (every[i][len(a) : len(every[i]) - len(z)], names[i], float(less[i] - total[at]), float(total[i] / n[i]))
            at = end


    def readable(self, place: tuple[str, str, str]) -> bool:
        got = self.known.get(place)
        return bool(got) and (got[3] > READABLE or got[1].endswith("utf-8"))


def _groups(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Slices of the batches with about ``HELD_CHARS`` characters of text, and these texts."""
    for b in batches:
        texts = b.column(column).to_pylist()
        begin = size = 0
        for i, t in enumerate(texts):
            size += len(t) if t else 0
            if size > HELD_CHARS or i + 1 == len(texts):
                yield b.slice(begin, i + 1 - begin), texts[begin : i + 1]
                begin, size = i + 1, 0


def _beyond(df: DataFrame, text: str) -> DataFrame:
    """The texts with characters beyond ASCII; the others need no repair, and the test runs in the JVM."""
    return df.where(F.col(text).rlike(r"[^\x00-\x7f]"))


def count_ngrams(df: DataFrame, text: str = "text") -> DataFrame:
    """(slot, n): counts of the n-grams of all records without a sign, by their places in the flat array.

    A task adds up its whole partition before it emits, so at most ``SLOTS`` rows leave any task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts()
        for _, texts in _groups(batches, 0):
            held = [t for t in texts if t and (t.isascii() or not _SIGN.search(t))]
            if held:
                counts.add(_codes("  " + "  ".join(held) + "  "))
        slots, n = counts.rows()
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(n, pa.int64())], ["slot", "n"])

    return df.select(df[text].alias("t")).mapInArrow(run, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))


def train(df: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[NgramModel, DataFrame]:
    """The model over all clean records, with margin and floor validated on their chunks, and the suspects (key, text).

    Two jobs run over all records when this is called: one counts, the other rates what was counted and writes
    down the suspects, in which some chain may read better or bytes were lost; all others are unaffected.
    """
    counts = count_ngrams(df, text).where(f"n > 1 or slot >= {_AT[4]}").toPandas()  # what occurs once speaks for nothing; bounded by SLOTS
    slots, n = counts["slot"].to_numpy(np.int64), counts["n"].to_numpy(np.float64)
    first = flat_table(slots, n)
    shared = df.sparkSession.sparkContext.broadcast(_packed(first))  # at most 4 bytes a slot at any size of the corpus
    rated = through_disk(rate_chunks(df, shared, key, text), "rated")
    hist: dict[str, list[tuple[int, int]]] = {k: [] for k in ("own", "gain", "garbled")}
    for r in rated.where("kind <> 'suspect'").groupBy("kind", "bin").agg(F.sum("n").alias("n")).collect():  # bounded by bins and slots
        hist[r["kind"]].append((r["bin"], r["n"]))
    model = NgramModel(first)
    if hist["garbled"]:
        place, less = (np.array(x) for x in zip(*hist["garbled"]))
        flat = np.zeros(SLOTS)
        flat[slots] = n
        flat[place] = np.maximum(flat[place] - less, 0)
        model = NgramModel(flat_table(np.arange(SLOTS), flat))
    if hist["own"]:
        model.margin = min(max(LEAST_MARGIN, _quantile(hist["gain"], 0.999) + 1.0), SURE * LEAST_MARGIN)
        model.floor = max(_quantile(hist["own"], 0.003) - 0.5, READABLE)
    return model, rated.where("kind = 'suspect'").select(F.col("k").alias(key), F.col("t").alias(text))


def _quantile(hist: list[tuple[int, int]], q: float) -> float:
    """The value at the share ``q`` of (bin, n)."""
    at, n = zip(*sorted(hist))
    upto = np.cumsum(n)
    return at[int(np.searchsorted(upto, q * (upto[-1] - 1), side="right"))] / BINS


def rate_chunks(df: DataFrame, shared, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, t, kind, bin, n): histograms over every chunk beyond ASCII of the clean records, and the suspects.

    A record is clean if it shows no sign and no chain gains more than ``SURE`` margins in it. Of clean records,
    ``own`` counts the chunks by mean log likelihood, ``gain`` by what the best chain adds to the sum (0 where
    nothing is improbable, as such chunks are never tried). Rows of kind ``garbled`` count, by slot, the n-grams of
    the others without a sign. A ``suspect`` is a record with key and text in which bytes were lost, or a chain reads
    an improbable chunk, or a run of it, as well as text may read; how well the chunk reads as it stands does not
    count, as garbled records were still among those counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = NgramModel(_unpacked(shared.value))
        hist: Counter[tuple[str, int]] = Counter()
        garbled = Counts()
        kind = None
        for b, texts in _groups(batches, 1):
            kind = b.schema.field(0).type
            c = model.chunks(texts)
            gain, by_chain = np.zeros(len(c.n)), [Counter() for _ in texts]
            may = [bool(_LOST.search(t)) for t in texts]
            for i, parts in found_parts(texts, c, model).items():
                for *_, name, more in parts:
                    gain[i] += more
                    by_chain[c.owner[i]][name] += more
            for i in np.nonzero(c.improbable)[0]:
                own = int(c.owner[i])
                may[own] = may[own] or any(model.readable(p) for p in _places(c.text, int(c.start[i]), int(c.end[i])))
            signs = np.array([bool(_SIGN.search(t)) for t in texts])
            sure = np.array([bool(g) and max(g.values()) > SURE * LEAST_MARGIN for g in by_chain])
            clean = ~(signs | sure)[c.owner] if len(c.owner) else np.zeros(0, bool)
            for name, values in (("own", c.total / c.n), ("gain", gain)):
                bins, n = np.unique(np.rint(np.clip(values[clean], -FARTHEST, FARTHEST) * BINS).astype(int), return_counts=True)
                for at, k in zip(bins.tolist(), n.tolist()):
                    hist[name, at] += k
            bad = [t for t, s, g in zip(texts, signs, sure) if g and not s]
            if bad:
                garbled.add(_codes("  " + "  ".join(bad) + "  "))
            held = b.filter(pa.array(may, pa.bool_()))
            k = held.num_rows
            yield pa.RecordBatch.from_arrays([held.column(0), held.column(1), pa.array(["suspect"] * k, pa.string()), pa.array([0] * k, pa.int64()), pa.array([0] * k, pa.int64())], _RATED)
        if kind is None:
            return
        slots, less = garbled.rows()
        names, bins = zip(*hist) if hist else ((), ())
        size = len(names) + len(slots)
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(size, kind),
                pa.nulls(size, pa.string()),
                pa.array([*names, *["garbled"] * len(slots)], pa.string()),
                pa.array([*bins, *slots.tolist()], pa.int64()),
                pa.array([*hist.values(), *less.tolist()], pa.int64()),
            ],
            _RATED,
        )

    types = f"k {df.schema[key].dataType.simpleString()}, t string, kind string, bin bigint, n bigint"
    return _beyond(df.select(df[key].alias("k"), df[text].alias("t")), "t").mapInArrow(run, types)


# at work



def _runs(text: str, start: int, end: int) -> list[tuple[int, int, tuple[str, str, str]]]:
    """The runs beyond ASCII of a chunk of several, which may be garbled between right ones, with their surroundings."""
    runs = list(_HIGH.finditer(text, start, end))
    if len(runs) < 2:
        return []
    return [(m.start(), m.end(), (text[max(start, m.start() - 2) : m.start()], m.group(), text[m.end() : min(end, m.end() + 2)])) for m in runs]


def _places(text: str, start: int, end: int) -> list[tuple[str, str, str]]:
    return [("", text[start:end], ""), *(p for *_, p in _runs(text, start, end))]


def found_parts(texts: list[str], c: Chunked, model: NgramModel) -> dict[int, list[tuple[int, int, str, str, float]]]:
    """What some chain reads better, by the number of the chunk: (begin and end in its text, result, chain, gain)."""
    shift = np.cumsum([2, *(len(t) + 2 for t in texts)])[c.owner] if len(c.owner) else c.owner
    tried = [(int(i), int(c.start[i]), int(c.end[i])) for i in np.nonzero(c.improbable)[0]]
    model.decide([("", c.text[a:z], "") for _, a, z in tried])
    out: dict[int, list[tuple[int, int, str, str, float]]] = {}
    runs: list[tuple[int, int, int, tuple[str, str, str]]] = []
    for i, a, z in tried:
        got = model.known["", c.text[a:z], ""]
        begin, end = a - int(shift[i]), z - int(shift[i])
        # a chain for the whole chunk, unless it leaves most of it as unlikely as it was
        sure = got and (got[3] > model.floor or (got[1].endswith("utf-8") and got[2] > SURE * model.margin))
        if sure and (got[2] >= model.margin or got[2] > 0.3 * -c.total[i]):
            out[i] = [(begin, end, *got[:3])]
            continue
        several = _runs(texts[int(c.owner[i])], begin, end)
        if several:
            runs += [(i, *run) for run in several]
        elif sure and got[2] > 0:
            out[i] = [(begin, end, *got[:3])]
    model.decide([p for *_, p in runs])
    for i, begin, end, p in runs:
        got = model.known[p]
        if got and got[2] > 0:
            out.setdefault(i, []).append((begin, end, *got[:3]))
    return out


def repair_texts(texts: list[str | None], model: NgramModel, whole: bool = True) -> list[tuple[str | None, dict[str, int]]]:
    """For each text the restored one and how often each chain was accepted (``lost`` and ``controls`` count signs).

    Without ``whole``, chunks that only follow others are not restored; which texts are affected is the same.
    """
    out: list[tuple[str | None, dict[str, int]]] = [(t, {}) for t in texts]
    at = [i for i, t in enumerate(texts) if t and not t.isascii()]
    if not at:
        return out
    held = [texts[i] for i in at]
    c = model.chunks(held)
    found: dict[int, list[tuple[int, int, str, str, float]]] = {}
    for i, parts in found_parts(held, c, model).items():
        found.setdefault(int(c.owner[i]), []).extend(parts)
    for own, t in enumerate(held):
        used: dict[str, int] = {}
        if lost := t.count("\ufffd"):
            used["lost"] = lost
        gained: Counter[str] = Counter()
        for *_, name, gain in found.get(own, ()):
            gained[name] += gain
        accepted = sorted(x for x in found.get(own, ()) if gained[x[3]] >= model.margin)
        for *_, name, _ in accepted:
            used[name] = used.get(name, 0) + 1
        if accepted and whole:
            accepted = sorted(accepted + _follow(t, accepted, model))
        parts, done = [], 0
        for start, end, fixed, *_ in accepted:
            parts.append(t[done:start] + fixed)
            done = end
        fixed = "".join([*parts, t[done:]])
        if left := len(_CONTROLS.findall(fixed)):
            used["controls"] = left
        out[at[own]] = (fixed, used)
    return out


def repair_text(text: str, model: NgramModel) -> tuple[str, dict[str, int]]:
    return repair_texts([text], model)[0]


_CHUNK = regex.compile(r"[^ \n]*[^\x00-\x7f \n][^ \n]*")


def _follow(text: str, accepted: list[tuple], model: NgramModel) -> list[tuple[int, int, str, str, float]]:
    """Further chunks of a garbled record that its own chains read better, by whatever little."""
    taken = sorted((a, b) for a, b, *_ in accepted)
    chains = [name for name, _ in Counter(x[3] for x in accepted).most_common()]
    places, at = [], 0
    for m in _CHUNK.finditer(text):
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        if at == len(taken) or taken[at][0] >= m.end():
            places.append(m)
    options: list[list[tuple[str, str]]] = []
    for m in places:
        options.append([(m.group(), "")])
        for name in chains:
            parts, x = name.split(">"), m.group()
            for pair in zip(parts[::2], parts[1::2]):
                x = x and apply_chain(x, pair)
            if x:
                options[-1].append((x, name))
    total, _ = model.scores([x for o in options for x, _ in o])
    out, k = [], 0
    for m, o in zip(places, options):
        for j in range(1, len(o)):
            if total[k + j] > total[k] + FOLLOWING_GAIN:
                out.append((m.start(), m.end(), *o[j], 0.0))
                break
        k += len(o)
    return out


def repair(df: DataFrame, model: NgramModel, key: str = "doc_id", text: str = "text", whole: bool = True) -> DataFrame:
    """(key, fixed, chains, affected) of every record; ``whole`` as in ``repair_texts``."""
    shared = df.sparkSession.sparkContext.broadcast((_packed(model.flat), model.margin, model.floor))  # at most 4 bytes a slot at any size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent, margin, floor = shared.value
        m = NgramModel(_unpacked(sent), margin, floor)
        for b, texts in _groups(batches, 1):
            got = repair_texts(texts, m, whole)
            chains = [sorted(u) for _, u in got]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([f for f, _ in got], pa.string()), pa.array(chains, pa.list_(pa.string())), pa.array([bool(x) for x in chains])], ["k", "fixed", "chains", "affected"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(df[key].alias("k"), df[text].alias("t")).mapInArrow(run, f"k {kind}, fixed string, chains array<string>, affected boolean").withColumnRenamed("k", key)


def affected(df: DataFrame, key: str = "doc_id", text: str = "text", whole: bool = True) -> DataFrame:
    """(key, fixed, chains, affected) of the affected records, by a model of all of them."""
    model, suspects = train(df, key, text)
    return repair(suspects, model, key, text, whole).where("affected")
