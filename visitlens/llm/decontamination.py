"""Benchmark decontamination with a broadcast set of word n-grams.

Benchmark items are normalised to words (ASCII letters lower-cased, anything
else in ASCII a separator) and cut into windows of ten words; an item of fewer
words is one window. The windows' hashes with their texts are broadcast. One
scan hashes the running windows of every document, keeps those in the set, and
compares them with the window's text, so a hash collision is no hit. Hit words
can be cut out as spans, or the documents dropped.

What is broadcast is checked: the benchmark is dealt into slices of at most
``SLICE_BYTES`` of normalised text, one scan a slice, each adding its hits to
the rows of the scan before, so a benchmark of any size gives whole results and
no row is shuffled.

Defined results: null texts and texts without a word have no words, hits or
items; items without a word are no items; rows with one item id are one item
(a null id counts as the empty text); equal windows hit for each of their items;
repeated rows are scanned alike; very long texts are scanned whole; an empty
benchmark gives no hits and an empty table no rows; the rows' own columns, whatever
their names, are carried as one struct.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlens.llm.common import cut_lineage, text_or_empty
from visitlens.llm.hashing import grams, word_table

#: Words in a window.
SIZE = 10
#: Most normalised benchmark text in one broadcast; its index takes about four times that.
SLICE_BYTES = 16 << 20
#: Windows in one piece of an item, so that a long item is dealt to several slices.
PIECE = 4096
PASS_BYTES = 2 << 20
#: Bits of a hash that the first look-up reads.
LOOK_BITS = 22

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True

HITS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))


class Words:
    """The words of a few texts: hashes, places, and the normalised bytes."""

    def __init__(self, texts: list[bytes]):
        self.raw = b"\n".join(texts) + b"\n"
        self.data = np.frombuffer(self.raw.lower(), np.uint8)
        self.letter = _WORD[self.data]
        self.hashes, self.starts, self.ends = word_table(self.data, self.letter)
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        self.text_at = np.concatenate(([0], np.cumsum(sizes)))
        self.at = np.searchsorted(self.starts, self.text_at)
        self._normal = None

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the window that each word starts, and whether it stays within its text."""
        found = grams(self.hashes, size)
        left = np.repeat(self.at[1:], np.diff(self.at))[:len(found)] - np.arange(len(found))
        return found, left >= size

    def normal(self, word: int, size: int) -> bytes:
        """``size`` words from ``word`` on, joined by single spaces."""
        if self._normal is None:
            sizes = self.ends - self.starts
            self._from = np.concatenate(([0], np.cumsum(sizes + 1)))
            out = np.full(int(self._from[-1]), 32, np.uint8)
            out[np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)] = self.data[self.letter]
            self._normal = out.tobytes()
        return self._normal[self._from[word]:self._from[word + size] - 1]


class GramSet:
    """Hashes of windows, each with its text and items."""

    def __init__(self, pieces: list[tuple[str, bytes]], size: int = SIZE):
        self.items = sorted({item for item, _ in pieces})
        number = {item: i for i, item in enumerate(self.items)}
        words = Words([text for _, text in pieces])
        counts = np.diff(words.at)
        found = []
        for n in {min(size, int(c)) for c in counts if c}:
            hashes, inside = words.windows(n)
            own = np.repeat(np.arange(len(pieces)), counts)[:len(hashes)]
            whole = inside & ((n == size) | (counts[own] == n))
            for i in np.flatnonzero(whole):
                found.append((int(hashes[i]), words.normal(int(i), n), number[pieces[own[i]][0]], n))
        found = sorted(set(found))
        self.texts, self.entry_items, hashes, self.sizes = [], [], [], sorted({n for *_, n in found})
        for h, text, item, _ in found:
            if hashes and hashes[-1] == h and self.texts[-1] == text:
                self.entry_items[-1].append(item)
            else:
                hashes.append(h)
                self.texts.append(text)
                self.entry_items.append([item])
        self.hashes = np.array(hashes, np.uint64)
        self.look = np.zeros(1 << LOOK_BITS, bool)
        self.look[self.hashes >> np.uint64(64 - LOOK_BITS)] = True

    def hits(self, words: Words) -> Iterator[tuple[int, int, list[int]]]:
        """(word, size, items) of every window that is in the set."""
        for size in self.sizes:
            found, inside = words.windows(size)
            for i in np.flatnonzero(self.look[found >> np.uint64(64 - LOOK_BITS)] & inside):
                at = int(np.searchsorted(self.hashes, found[i]))
                while at < len(self.hashes) and self.hashes[at] == found[i]:
                    if self.texts[at] == words.normal(int(i), size):
                        yield int(i), size, self.entry_items[at]
                    at += 1


def pieces(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """(item, piece, words): each item's normalised words, in overlapping pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = Words([batch.column(1)[i].as_py().encode()])
                n = len(words.hashes)
                starts = range(0, max(n - size + 1, 1), PIECE) if n else ()
                texts = [words.normal(a, min(n - a, PIECE + size - 1)) for a in starts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[i].as_py()] * len(texts), pa.string()), pa.array(list(starts), pa.int64()),
                     pa.array(texts, pa.binary())], ["item", "piece", "words"])

    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, "item string, piece bigint, words binary")


def slices(found: DataFrame, size: int = SIZE, limit: int = SLICE_BYTES) -> Iterator[GramSet]:
    """Sets of the pieces' windows, each of at most ``limit`` bytes of text (or one piece)."""
    n_bytes = F.length("words") + F.length("item")
    n, total, longest = found.agg(F.count("piece"), F.sum(n_bytes), F.max(n_bytes)).first()
    parts = max(1, math.ceil((total or 0) / limit))
    while parts < (n or 0):
        dealt = F.pmod(F.xxhash64("item", "piece", "words"), F.lit(parts))
        most = found.groupBy(dealt.alias("part")).agg(F.sum(n_bytes).alias("b")).agg(F.max("b")).first()[0]
        if most <= max(limit, longest):
            break
        parts *= 2
    dealt = F.pmod(F.xxhash64("item", "piece", "words"), F.lit(parts))
    for part in range(parts):
        own = found.filter(dealt == part).select("item", "words").toArrow()
        yield GramSet(list(zip(own.column(0).to_pylist(), own.column(1).to_pylist(), strict=True)), size)


def _runs(hit: np.ndarray) -> list[tuple[int, int]]:
    """(first, end) of the runs of true."""
    edge = np.diff(hit.astype(np.int8), prepend=0, append=0)
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))


def _without(words: Words, text: int, hits: list[tuple[int, int]]) -> bytes:
    """The text without its hit words and what stands between them."""
    base, out, at = int(words.at[text]), [], int(words.text_at[text])
    for first, last in hits:
        out.append(words.raw[at:int(words.starts[base + first])])
        at = int(words.ends[base + last - 1])
    return b"".join([*out, words.raw[at:int(words.text_at[text + 1]) - 1]])


def _scanned(rows: DataFrame, known: GramSet, clean: bool) -> DataFrame:
    """``rows`` (row, text, n_words, hits, items) with the hits of one more slice."""
    shared = rows.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams_ = shared.value
        for batch in batches:
            row = 0
            while row < batch.num_rows:
                texts, used = [], 0
                while row + len(texts) < batch.num_rows and (not texts or used < PASS_BYTES):
                    texts.append(batch.column(1)[row + len(texts)].as_py().encode())
                    used += len(texts[-1])
                words, part = Words(texts), batch.slice(row, len(texts))
                hit, items = np.zeros(len(words.hashes) + 1, np.int32), {}
                for at, size, own in grams_.hits(words):
                    hit[at] += 1
                    hit[at + size] -= 1
                    items.setdefault(int(np.searchsorted(words.at, at, "right")) - 1, set()).update(own)
                covered, n_words = np.cumsum(hit[:-1]) > 0, np.diff(words.at)
                old_hits, old_items = part.column(3), part.column(4)
                hits, names, left = [], [], []
                for i in range(len(texts)):
                    own, base = old_hits[i].as_py(), int(words.at[i])
                    named = set(old_items[i].as_py())
                    runs = [(h["first"], h["last"]) for h in own]
                    if i in items:
                        mask = covered[base:base + int(n_words[i])].copy()
                        for a, b in runs:
                            mask[a:b] = True
                        runs = _runs(mask)
                        named |= {grams_.items[k] for k in items[i]}
                    hits.append([{"first": a, "last": b} for a, b in runs])
                    names.append(sorted(named))
                    if clean:
                        left.append(_without(words, i, runs) if runs else texts[i])
                text = pc.cast(pa.array(left, pa.binary()), pa.string()) if clean else part.column(1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), text, pa.array(n_words, pa.int64()), pa.array(hits, part.column(3).type),
                     pa.array(names, part.column(4).type)], ["row", "text", "n_words", "hits", "items"])
                row += len(texts)

    return rows.mapInArrow(run, rows.schema)


def scan(rows: DataFrame, benchmark: DataFrame, text_col: str = "text", size: int = SIZE, limit: int = SLICE_BYTES,
         clean: bool = False) -> DataFrame:
    """(row, text, n_words, hits, items) per row of ``rows``.

    ``row`` is a struct of the row's columns, ``hits`` the runs of hit words
    (first, end), ``items`` the sorted ids of the items that occur. With
    ``clean`` the text is the one without the hit runs.
    """
    found = cut_lineage(pieces(benchmark, size=size))
    out = rows.select(
        F.struct("*").alias("row"), text_or_empty(text_col).alias("text"), F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast(HITS).alias("hits"), F.array().cast("array<string>").alias("items"))
    ahead, known = slices(found, size, limit), None
    for following in ahead:
        if known is not None:
            out = cut_lineage(_scanned(out, known, False))
        known = following
    return _scanned(out, known, clean)


def n_hit() -> F.Column:
    return F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, h: n + h["last"] - h["first"])


def measure(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, n_hit, items (sorted ids), hits (runs of words)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return scan(rows, benchmark).select(F.col("row.id").alias(id_col), "n_words", n_hit().alias("n_hit"), "items", "hits")


def remove_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a hit word."""
    return scan(docs, benchmark, text_col).filter(F.size("hits") == 0).select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every run of hit words cut out of its text (null stays null)."""
    text = F.when(F.col(f"row.`{text_col}`").isNull(), F.lit(None)).otherwise(F.col("text"))
    return scan(docs, benchmark, text_col, clean=True).select(
        *[text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
