"""Problem 8: encoding a corpus with a public byte-pair tokenizer by prefix dynamic programming.

For every prefix of a piece there is exactly one token that can end its encoding. The table of these last
tokens is filled from left to right: a token ``t`` that ends at byte ``i`` is the valid one if the pair of
the prefix's own last token before ``t`` and ``t`` itself encodes to just these two tokens. Walking the
table backwards gives the ids. As an entry depends only on the bytes before it, bytes can be appended
without touching the table so far, and an edit needs a new table only from the edited piece on.

Defined results: null and empty texts give the empty list; text that looks like a special token is plain
text; lone surrogates cannot occur in a Spark string.
"""

from __future__ import annotations

import base64
import os
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

TOKENIZER_DIR = "/opt/tokenizers"
DEFAULT_VOCABULARY = "byte_bpe_50k.tiktoken"
#: The pre-tokenization pattern published with the tokenizer.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
#: The same cuts with the faster standard module, for texts without the characters in which its classes differ.
_QUICK = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[^\W\d_]++| ?\d++| ?(?:[^\s\w]|_)++|\s+(?!\S)|\s+").findall
#: Distinct pieces kept per worker; the table of a piece is a pure function, so dropping it costs time only.
PIECES_KEPT = 400_000


@lru_cache(maxsize=1)
def _differing():
    """Finds numbers that are no decimal digits, word characters that are neither letter nor number, and C0 separators."""
    odd = []
    for c in map(chr, range(128, sys.maxunicode + 1)):
        kind = unicodedata.category(c)
        letter, number = kind[0] == "L", kind[0] == "N"
        if (c.isalnum() != (letter or number)) or (number and kind != "Nd") or (c.isdecimal() != (kind == "Nd")):
            odd.append(c)
    runs, i = [], 0
    while i < len(odd):
        j = i
        while j + 1 < len(odd) and ord(odd[j + 1]) == ord(odd[j]) + 1:
            j += 1
        runs.append(f"{odd[i]}-{odd[j]}")
        i = j + 1
    return re.compile("[\x1c-\x1f" + "".join(runs) + "]").search


class PrefixBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks = ranks
        self.words = [b""] * (max(ranks.values()) + 1)
        for piece, r in ranks.items():
            self.words[r] = piece
        ends: dict[bytes, set[int]] = {}
        for piece in ranks:
            ends.setdefault(piece[-2:], set()).add(len(piece))
        #: Lengths of the tokens that end in these two bytes, longest first.
        self.lengths = {k: tuple(sorted(v, reverse=True)) for k, v in ends.items()}
        self.split = regex.compile(pattern).findall
        self.own_pattern = pattern != PATTERN
        self.pairs: dict[tuple[int, int], bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.edges: dict[tuple[int, int], list[tuple[bytes, int, int]]] = {}
        self.kept: dict[str, tuple[int, ...]] | None = None

    def _halves(self, t: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``t``, found by merging its bytes with earlier merges only; None for a byte."""
        known = self.halves.get(t, 0)
        if known == 0:
            parts = [bytes([b]) for b in self.words[t]]
            ranks = self.ranks
            while len(parts) > 2:
                best, at = t, -1
                for i in range(len(parts) - 1):
                    r = ranks.get(parts[i] + parts[i + 1], t)
                    if r < best:
                        best, at = r, i
                if at < 0:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            known = self.halves[t] = (ranks[parts[0]], ranks[parts[1]]) if len(parts) == 2 else None
        return known

    def _edge(self, t: int, side: int) -> list[tuple[bytes, int, int]]:
        """The tokens that stand at one edge of ``t`` while it is merged: (bytes, since which rank, until which rank)."""
        key = (t, side)
        edge = self.edges.get(key)
        if edge is None:
            edge, until = [], len(self.words)
            while True:
                halves = self._halves(t)
                edge.append((self.words[t], t if halves else -1, until))
                if not halves:
                    break
                until, t = t, halves[side]
            self.edges[key] = edge
        return edge

    def compatible(self, a: int, b: int) -> bool:
        """True if ``a`` followed by ``b`` is what their joined bytes encode to; ``a`` = -1 is the start.

        Merging goes by rank. The pair falls apart if, at some rank, the tokens then standing at both sides of
        the seam merge across it before either is merged on its own side; of equal ranks the left one is first.
        """
        if a < 0:
            return len(self.words[b]) == 1 or self._halves(b) is not None
        key = (a, b)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > 2_000_000:
                self.pairs.clear()
            known, rank = True, self.ranks.get
            for x, x_since, x_until in self._edge(a, 1):
                for y, y_since, y_until in self._edge(b, 0):
                    if x_since < y_until and y_since < x_until:
                        r = rank(x + y)
                        if r is not None and r < x_until and r <= y_until:
                            known = False
                            break
                if not known:
                    break
            self.pairs[key] = known
        return known

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """Continue the table ``last`` (``last[i]``: last token of the prefix of i bytes) to all of ``data``."""
        ranks, words, lengths, compatible = self.ranks, self.words, self.lengths, self.compatible
        for i in range(len(last), len(data) + 1):
            two = lengths.get(data[max(0, i - 2) : i], ()) if i > 1 else ()
            found = -1
            for n in two:
                if n <= i:
                    t = ranks.get(data[i - n : i])
                    if t is not None and compatible(last[i - n], t):
                        found = t
                        break
            if found < 0:
                found = ranks[data[i - 1 : i]]
            last.append(found)
        return last

    def piece(self, text: str) -> tuple[int, ...]:
        data = text.encode("utf-8", "replace")
        whole = self.ranks.get(data)
        if whole is not None and self.compatible(-1, whole):
            return (whole,)
        return self.walk(self.extend(data, [-1]))

    def walk(self, last: list[int]) -> tuple[int, ...]:
        """The ids that a filled table tells, from its end backwards."""
        out, i = [], len(last) - 1
        while i:
            out.append(last[i])
            i -= len(self.words[last[i]])
        return tuple(reversed(out))

    def encoder(self):
        """A function text -> list of ids that keeps the ids of pieces seen, over all texts of this process.

        Texts are cut by the quick pattern. A piece that it may have cut wrongly is never kept, so that such a
        text is noticed and cut again by the exact pattern.
        """
        if self.kept is None:
            make, differs = self.piece, _differing()

            class Kept(dict):
                def __missing__(self, w: str):
                    if differs(w):
                        raise _Recut
                    if len(self) >= PIECES_KEPT:
                        self.clear()
                    ids = self[w] = make(w)
                    return ids

            self.kept = Kept()
        kept, flat, quick = self.kept.__getitem__, chain.from_iterable, self.split if self.own_pattern else _QUICK
        exact, piece = self.split, self.piece

        def encode(text: str | None) -> list[int]:
            if not text:
                return []
            try:
                return list(flat(map(kept, quick(text))))
            except _Recut:
                return list(flat(map(piece, exact(text))))

        return encode


class _Recut(Exception):
    pass


class Editable:
    """An encoded text that can be appended to and edited without encoding it anew.

    Pieces away from the change keep their ids. The table of the piece that was encoded last stays, so that one which
    shares its beginning, as a growing or edited piece does, goes on from there.
    """

    def __init__(self, bpe: PrefixBpe, text: str = ""):
        self.bpe, self.text, self.pieces = bpe, "", []
        self.table: tuple[bytes, list[int]] = (b"", [-1])
        self.filled = 0  # entries of tables that were computed
        self.append(text)

    def _piece(self, w: str) -> tuple[int, ...]:
        data, (old, last) = w.encode("utf-8", "replace"), self.table
        shared = len(os.path.commonprefix([data, old]))
        last = last[: shared + 1]
        self.filled += len(data) - shared
        self.table = (data, self.bpe.extend(data, last))
        return self.bpe.walk(self.table[1])

    @property
    def ids(self) -> list[int]:
        return [i for _, ids in self.pieces for i in ids]

    def append(self, more: str) -> None:
        # the last two pieces may grow or, as blanks, be cut differently once more text follows
        keep = max(0, len(self.pieces) - 2)
        tail = "".join(w for w, _ in self.pieces[keep:]) + more
        self.pieces = self.pieces[:keep] + [(w, self._piece(w)) for w in self.bpe.split(tail)]
        self.text += more

    def replace(self, start: int, end: int, new: str) -> None:
        """Replace text[start:end]; pieces before the edit stay, and those after it as soon as the cuts agree again."""
        at, keep, edges = 0, 0, []
        for w, _ in self.pieces:
            edges.append(at)
            at += len(w)
        edges.append(at)
        while keep < len(self.pieces) and edges[keep + 1] < start:
            keep += 1
        keep = max(0, keep - 2)
        text = self.text[:start] + new + self.text[end:]
        shift = len(text) - len(self.text)
        old = {e + shift: k for k, e in enumerate(edges) if e >= end + 2}
        pos, fresh = edges[keep], []
        for w in self.bpe.split(text[pos:]):
            if pos in old and pos > start + len(new) + 2:
                fresh += self.pieces[old[pos] :]
                break
            fresh.append((w, self._piece(w)))
            pos += len(w)
        self.text, self.pieces = text, self.pieces[:keep] + fresh


@lru_cache(maxsize=4)
def parse(data: bytes) -> PrefixBpe:
    return PrefixBpe({base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())})


def load(path: str) -> PrefixBpe:
    with open(path, "rb") as f:
        return parse(f.read())


def _sent(spark: SparkSession, path: str | None):
    """The vocabulary file's bytes for all tasks (about 1 MB), read where the driver runs; executors need no file."""
    with open(path or vocabulary_path(), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def vocabulary_path(name: str = DEFAULT_VOCABULARY, folder: str = TOKENIZER_DIR) -> str:
    return f"{folder}/{name}"


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, ids) of every row; one pass, no shuffle."""
    vocabulary = _sent(df.sparkSession, path)
    source = df.select(df[key].alias("k"), df[text].alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = parse(vocabulary.value).encoder()
        for b in batches:
            lists = [enc(t) for t in b.column(1).to_pylist()]
            offsets = np.zeros(len(lists) + 1, np.int32)
            np.cumsum([len(x) for x in lists], out=offsets[1:])
            flat = np.fromiter(chain.from_iterable(lists), np.int32, int(offsets[-1]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["k", "ids"])

    kind = df.schema[key].dataType.simpleString()
    return source.mapInArrow(run, f"k {kind}, ids array<int>").withColumnRenamed("k", key)


def decode(df: DataFrame, key: str = "doc_id", ids: str = "ids", path: str | None = None) -> DataFrame:
    """(key, text) of lists of ids; null lists give null, bytes that are no text the replacement character."""
    vocabulary = _sent(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = parse(vocabulary.value).words
        for b in batches:
            texts = [None if x is None else b"".join([words[i] for i in x]).decode("utf-8", "replace") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["k", "text"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(df[key].alias("k"), df[ids].alias("ids")).mapInArrow(run, f"k {kind}, text string").withColumnRenamed("k", key)


def sizes(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, n_tokens, n_loss): the length in tokens and how many of them bear loss (all but heading lines)."""
    vocabulary = _sent(df.sparkSession, path)
    source = df.select(df[key].alias("k"), df[text].alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = parse(vocabulary.value).encoder()
        heading = regex.compile(r"(?m)^#{1,6} .*$").findall
        for b in batches:
            n, loss = [], []
            for t in b.column(1).to_pylist():
                k = len(enc(t))
                n.append(k)
                loss.append(k - min(k, sum(len(enc(h)) for h in heading(t))) if t else 0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int32()), pa.array(loss, pa.int32())], ["k", "n_tokens", "n_loss"])

    kind = df.schema[key].dataType.simpleString()
    return source.mapInArrow(run, f"k {kind}, n_tokens int, n_loss int").withColumnRenamed("k", key)
