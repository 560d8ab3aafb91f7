"""Byte-level BPE encoding and decoding with a contiguous rank array.

A word's parts lie in one array beside the ranks of their adjacent pairs. The
encoder scans for the least rank, deletes that boundary, and refreshes the two
neighbouring ranks, until no pair can merge. Words above ``SHORT`` bytes use a
heap over the same ranks, with the same result, so one very long word costs
n log n. Words repeat, so every task keeps bounded tables of encoded words.

The vocabulary file is read where the job is built and travels as a broadcast.

Defined results: null text counts as empty and has no token; special strings
inside a text become their special id, as the reference library does; repeated
rows give repeated results; only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import text_or_empty

#: The pattern that cuts a text into words, and the characters
#: that it takes as white space.
WORDS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
         r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Coarser cut with the same edges around white space; its parts repeat more
#: often than they are cut further.
COARSE = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: Longest word (bytes) for the rank array, words merged side by side, and the
#: words of a generation.
SHORT, ROWS, REMEMBERED = 128, 2048, 200_000


class Remembered:
    """Bounded table of made values: when a generation is full, it becomes the
    old one, from which what is still in use moves on."""

    def __init__(self, make, limit: int):
        self.make, self.limit, self.new, self.old = make, limit, {}, {}

    def __call__(self, key):
        got = self.new.get(key)
        if got is None:
            got = self.old.get(key)
            if got is None:
                got = self.make(key)
            self.put(key, got)
        return got

    def put(self, key, value) -> None:
        if len(self.new) >= self.limit:
            self.old, self.new = self.new, {}
        self.new[key] = value

    def unknown(self, keys: set) -> list:
        return list(keys - self.new.keys() - self.old.keys())


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def once_a_worker(shared, make):
    """``make`` of the broadcast's ``spec``, kept beside it: tasks that a Python
    worker runs one after the other share it, with all that it remembers."""
    held = shared.value
    if "made" not in held:
        held["made"] = make(held["spec"])
    return held["made"]


class ByteBpe:
    """Encoder and decoder of one vocabulary (the text of its JSON file)."""

    def __init__(self, spec: str):
        import regex

        model, letters = json.loads(spec), byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        vocab = model["model"]["vocab"]
        self.bytes_of = {i: as_bytes(s) for s, i in vocab.items()}
        self.first = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        #: left id and right id, packed -> rank; rank -> merged id
        self.ranks, self.merged = {}, []
        for rank, pair in enumerate(model["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocab[left] << 32 | vocab[right]] = rank
            self.merged.append(vocab[left + right])
        self.special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.text_of = {i: str(i) for i in self.bytes_of}
        self.cut = regex.compile(WORDS).findall
        self.cut_special = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None
        self.keys = np.array(sorted(self.ranks), np.int64)
        self.key_ranks = np.array([self.ranks[k] for k in self.keys.tolist()], np.int32)
        self.merged_ids, self.first_ids = np.array(self.merged, np.int64), np.array(self.first, np.int64)
        self.words = Remembered(self.word, REMEMBERED)
        self.parts = Remembered(lambda part: b"".join(map(self.words, self.cut(part))), REMEMBERED)

    def _merge_short(self, parts: list[int]) -> list[int]:
        rank, merged, none = self.ranks.get, self.merged, len(self.merged)
        ranks = [rank(a << 32 | b, none) for a, b in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            parts[i] = merged[best]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] << 32 | parts[i], none)
            if i < len(ranks):
                ranks[i] = rank(parts[i] << 32 | parts[i + 1], none)
        return parts

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each adjacent pair; the number of merges where there is none."""
        pair = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where((self.keys[at] == pair) & (right >= 0), self.key_ranks[at], len(self.merged))

    def _merge_rows(self, words: list[bytes]) -> list[bytes]:
        """The rank arrays of many short words as the rows of two matrices: in
        every step each row scans for its least rank, deletes that boundary and
        refreshes the ranks beside it; a row without a rank is done."""
        sizes = np.array([len(w) for w in words])
        width, none = int(sizes.max()) + 1, len(self.merged)
        place = np.arange(width)
        parts = np.full((len(words), width), -1, np.int64)
        parts[place < sizes[:, None]] = self.first_ids[np.frombuffer(b"".join(words), np.uint8)]
        ranks = np.full((len(words), width), none, np.int32)
        ranks[:, :-1] = self._rank(parts[:, :-1], parts[:, 1:])
        done, open_rows = parts.copy(), np.arange(len(words))
        while len(open_rows):
            best = ranks.argmin(axis=1)
            least = ranks[np.arange(len(best)), best]
            done[open_rows[least == none]] = parts[least == none]
            go = least < none
            open_rows, parts, ranks, best, least = open_rows[go], parts[go], ranks[go], best[go], least[go]
            if not len(open_rows):
                break
            row = np.arange(len(best))
            shift = np.minimum(place + (place > best[:, None]), width - 1)
            parts, ranks = np.take_along_axis(parts, shift, 1), np.take_along_axis(ranks, shift, 1)
            parts[row, best] = self.merged_ids[least]
            ranks[row, best] = self._rank(parts[row, best], parts[row, best + 1])
            back = best > 0
            row, best = row[back], best[back]
            ranks[row, best - 1] = self._rank(parts[row, best - 1], parts[row, best])
        flat, ends = done[done >= 0].astype("<i4").tobytes(), np.cumsum(4 * (done >= 0).sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def learn(self, texts: list[str]) -> None:
        """Encodes the unknown words of many texts together."""
        pieces = {p: self.cut(p) for p in self.parts.unknown(set(chain.from_iterable(map(COARSE.findall, texts))))}
        found = ((w, w.encode("utf-8", "replace")) for w in self.words.unknown(set(chain.from_iterable(pieces.values()))))
        short = sorted((x for x in found if len(x[1]) <= SHORT), key=lambda x: len(x[1]))
        for at in range(0, len(short), ROWS):
            some = short[at:at + ROWS]
            for (word, _), ids in zip(some, self._merge_rows([raw for _, raw in some])):
                self.words.put(word, ids)
        for part, words in pieces.items():
            self.parts.put(part, b"".join(map(self.words, words)))

    def _merge_long(self, parts: list[int]) -> list[int]:
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        queue: list[tuple[int, int, int]] = []

        def propose(a: int, b: int) -> None:
            if a >= 0 and b < len(parts):
                rank = self.ranks.get(pair := parts[a] << 32 | parts[b])
                if rank is not None:
                    heapq.heappush(queue, (rank, a, pair))

        for i in range(len(parts) - 1):
            propose(i, i + 1)
        while queue:
            rank, i, pair = heapq.heappop(queue)
            j = after[i]
            if j >= len(parts) or parts[i] < 0 or parts[i] << 32 | parts[j] != pair:
                continue
            parts[i], parts[j] = self.merged[rank], -1
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            propose(before[i], i)
            propose(i, after[i])
        return [p for p in parts if p >= 0]

    def word(self, word: str) -> bytes:
        """Ids of one word, as little-endian 32-bit numbers."""
        raw = word.encode("utf-8", "replace")
        parts = [self.first[b] for b in raw]
        return np.array(self._merge_short(parts) if len(raw) <= SHORT else self._merge_long(parts), "<i4").tobytes()

    def _plain(self, text: str) -> list[int]:
        known, part = self.parts.new, self.parts
        return np.frombuffer(b"".join([known.get(w) or part(w) for w in COARSE.findall(text)]), "<i4").tolist()

    def encode(self, text: str) -> list[int]:
        if self.cut_special is None or not any(s in text for s in self.special):
            return self._plain(text)
        out: list[int] = []
        for i, part in enumerate(self.cut_special(text)):
            out += [self.special[part]] if i % 2 else self._plain(part)
        return out

    def encode_many(self, texts: list[str]) -> Iterator[list[int]]:
        self.learn(texts)
        return map(self.encode, texts)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def _per_batch(docs: DataFrame, spec: str, schema: str, rows) -> DataFrame:
    """Runs ``rows(bpe, id list, value list) -> column lists`` on Arrow batches."""
    shared = docs.sparkSession.sparkContext.broadcast({"spec": spec})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bpe = once_a_worker(shared, ByteBpe)
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                columns = rows(bpe, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), *columns.values()], ["id", *columns])

    return docs.mapInArrow(run, schema)


def encode(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) per row."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = _per_batch(rows, spec, f"id {kind}, ids array<int>", lambda bpe, texts: {
        "ids": pa.array(list(bpe.encode_many(texts)), pa.list_(pa.int32()))})
    return out.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, spec: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) per row of ids."""
    rows = encoded.select(F.col(id_col).alias("id"), F.coalesce(ids_col, F.array().cast("array<int>")).alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    out = _per_batch(rows, spec, f"id {kind}, text string", lambda bpe, lists: {
        "text": pa.array([bpe.decode(x) for x in lists], pa.string())})
    return out.withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: number of tokens, digest of the ids, digest of the decoded text."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def digests(bpe: ByteBpe, texts: list[str]) -> dict[str, pa.Array]:
        n, coded, back = [], [], []
        for ids in bpe.encode_many(texts):
            n.append(len(ids))
            coded.append(hashlib.sha256(",".join(map(bpe.text_of.__getitem__, ids)).encode()).hexdigest())
            back.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
        return {"n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(coded, pa.string()),
                "decoded_sha256": pa.array(back, pa.string())}

    out = _per_batch(rows, spec, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string", digests)
    return out.withColumnRenamed("id", id_col)
