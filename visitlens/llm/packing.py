"""Cost-balanced packing of documents into training sequences.

Every input partition packs its own rows in rounds of a bounded number of
tokens, so nothing is shuffled and memory does not grow with the partition.
Whole windows of a long document are sequences of their own. What is left is
taken in descending order of length and put into the sequence of least cost
(tokens plus a quadratic attention term per piece) that still has room; a
document that fits nowhere is cut over the remaining room. A round fills
exactly as many sequences as its tokens allow and hands the rest to the next
round. The last rest of a partition is laid out over sequences whose lengths
are powers of two, which need no padding.

Sequence ids hold the partition number above bit 33, so they are unique and
the same after a lost task runs again.

Defined results: null text is an empty document, which is one token (the end
id); repeated rows are packed each; ties in length keep input order; an empty
table gives no piece; only the id and text columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.bpe import Remembered, byte_letters, once_a_worker
from visitlens.llm.common import handing_back, text_or_empty

SEQUENCE, END_ID = 4096, 2
#: Tokens of a packing round, words of a generation that a task remembers,
#: weight of length squared.
ROUND, REMEMBERED, QUADRATIC = 1 << 21, 400_000, 1 / 1024


class WordIds:
    """Ids of whole texts through the tokenizer, remembered by word.

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its words in order. A plain word (Latin letters, perhaps with
    a final comma or full stop, which the tokenizer always cuts off a letter)
    goes straight to the tokenizer's merge model; every other word goes through
    the whole tokenizer. Ids are kept as little-endian bytes, those of words and
    of their lower-case stems in one table.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(spec)
        self.tok.no_padding()
        self.tok.no_truncation()
        self.letters = {b: c for c, b in byte_letters().items()}
        self.known = Remembered(self.word, REMEMBERED)
        self.final = {mark: self.whole(mark) for mark in (b".", b",")}

    def whole(self, word: bytes) -> bytes:
        return np.asarray(self.tok.encode(word.decode("utf-8"), add_special_tokens=False).ids, "<u4").tobytes()

    def stem(self, letters: bytes) -> bytes:
        text = letters.decode("utf-8")
        if not text.isalpha() or max(text) > "\u024f" or "\u0130" in text:
            return self.whole(letters)
        mapped = text.lower().encode().decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.tok.model.tokenize(mapped)], "<u4").tobytes()

    def word(self, word: bytes) -> bytes:
        if b"<|" in word:
            return self.whole(word)
        lower = word.lower()
        if word[-1:] in self.final and word[-2:-1].isalpha():
            return self.known(lower[:-1]) + self.final[word[-1:]]
        return self.stem(word) if word == lower else self.known(lower)

    def __call__(self, text: str) -> bytes:
        known, made = self.known.new, self.known
        return b"".join([known.get(w) or made(w) for w in text.encode("utf-8", "replace").split()]) + END_ID.to_bytes(4, "little")


def assign(lengths: list[int], room: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Places pieces (item, start, length) into sequences of the given room.

    All room is used if the items have that many tokens; what does not fit is
    left out from the end of an item.
    """
    left, cost = room.astype(np.int64), np.zeros(len(room))
    placed: list[list[tuple[int, int, int]]] = [[] for _ in room]

    def put(s: int, item: int, start: int, n: int) -> None:
        placed[s].append((item, start, n))
        left[s] -= n
        cost[s] += n + QUADRATIC * n * n

    cut = []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[item]
        where = np.where(left >= n, cost, np.inf)
        s = int(where.argmin()) if len(where) else 0
        if len(where) and where[s] < np.inf:
            put(s, item, 0, n)
        else:
            cut.append(item)
    for item in cut:
        start = 0
        while start < lengths[item]:
            where = np.where(left > 0, cost, np.inf)
            s = int(where.argmin()) if len(where) else 0
            if not len(where) or where[s] == np.inf:
                break
            n = int(min(left[s], lengths[item] - start))
            put(s, item, start, n)
            start += n
    return placed


def powers(n: int) -> list[int]:
    """Powers of two that sum to n, descending."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class Packer:
    """Collects (id, start, ids) pieces and emits full sequences."""

    def __init__(self, first_sequence: int):
        self.next, self.items, self.tokens = first_sequence, [], 0

    def add(self, doc_id, ids: bytes) -> Iterator[tuple]:
        total, at = len(ids) // 4, 0
        while total - at >= SEQUENCE:
            yield self._row(doc_id, at, ids[4 * at:4 * (at + SEQUENCE)], total, self.next, 0)
            self.next += 1
            at += SEQUENCE
        if at < total:
            self.items.append((doc_id, at, ids[4 * at:], total))
            self.tokens += total - at
        if self.tokens >= ROUND:
            yield from self.pack(last=False)

    @staticmethod
    def _row(doc_id, start: int, ids: bytes, total: int, sequence: int, offset: int) -> tuple:
        return doc_id, start, len(ids) // 4, zlib.crc32(ids), total, sequence, offset, ids

    def pack(self, last: bool) -> Iterator[tuple]:
        sizes = [SEQUENCE] * (self.tokens // SEQUENCE) + (powers(self.tokens % SEQUENCE) if last else [])
        lengths = [len(x[2]) // 4 for x in self.items]
        used = [0] * len(lengths)
        for pieces in assign(lengths, np.asarray(sizes, np.int64)):
            offset = 0
            for i, start, n in pieces:
                doc_id, base, ids, total = self.items[i]
                yield self._row(doc_id, base + start, ids[4 * start:4 * (start + n)], total, self.next, offset)
                offset += n
                used[i] = max(used[i], start + n)
            self.next += 1
        self.items = [(d, b + u, ids[4 * u:], t) for (d, b, ids, t), u in zip(self.items, used) if 4 * u < len(ids)]
        self.tokens = sum(len(x[2]) // 4 for x in self.items)


def pack(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, and the ids themselves (array<int>) if asked for."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast({"spec": spec})
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, kind_of_id = Packer(TaskContext.get().partitionId() << 33), None

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found))
            arrays = [pa.array(columns[0], kind_of_id), *[pa.array(c, pa.int64()) for c in columns[1:7]]]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in columns[7]], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, ["id", *names] + ["ids"] * with_ids)

        for batch in batches:
            ids_of, kind_of_id = once_a_worker(shared, WordIds), batch.schema.field(0).type
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [r for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()) for r in packer.add(i, ids_of(t))]
                if found:
                    yield batch_of(found)
        if packer.tokens and (found := list(packer.pack(last=True))):
            yield batch_of(found)

    schema = f"id {kind}, " + ", ".join(f"{n} bigint" for n in names) + ", ids array<int>" * with_ids
    return rows.mapInArrow(handing_back(run), schema).withColumnRenamed("id", id_col)
