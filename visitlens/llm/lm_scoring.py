"""Language-model scoring by context-tree weighting over bytes.

The model: a byte is eight binary decisions, each with a context tree over the
``DEPTH`` preceding bytes. Every node of every tree keeps two counts and their
Krichevsky-Trofimov estimate, and a node's prediction mixes its own estimate
with its child's by the weights that context-tree weighting gives after the
training texts. An end symbol closes each text, so a text's code length is that
of a proper distribution.

Nothing that grows with the corpus is broadcast or collected. Documents are
dealt into blocks by hash; a block asks once for each of its distinct words and
byte strings (a byte with its context) and says how often they occur in its
training texts. A window adds up the corpus counts. The trees are tables: one
aggregate per depth goes up (counts, block probabilities), one join per depth
comes down (mixed predictions), and a byte string's probability is the product
over its eight nodes. The answers meet the block's documents in a cogroup. A
string in every block costs one row per block, whatever the size of the corpus.

Strings that occur in held-out texts only are in the tables with count 0, so
every node that a text needs exists; a node without counts predicts one half.

Defined results: null text counts as empty, which has the end token only;
repeated rows are trained on and scored each; an empty table gives no rows;
without training texts every token has count 0 and every bit costs one bit;
only the id and text columns are read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.llm.common import cut_lineage, id_text_crc, text_or_empty

#: Preceding bytes in a context.
DEPTH = 4
#: Bytes of text in a block of documents, and in one pass of a task.
BLOCK_BYTES, PASS_BYTES = 16 << 20, 4 << 20
ADD = 0.1


def _strings(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Context and byte, as one number, of every byte and end; each text's first."""
    start = b"\0" * DEPTH
    data = np.frombuffer(start + (b"\xff" + start).join(texts) + b"\xff", np.uint8).astype(np.uint64)
    size = len(data) - DEPTH
    found = np.zeros(size, np.uint64)
    for j in range(DEPTH + 1):
        found = found << np.uint64(8) | data[j:size + j]
    sizes = np.array([len(t) + 1 for t in texts])
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    take = np.arange(int(sizes.sum())) + np.repeat(DEPTH * np.arange(len(texts)), sizes)
    return found[take], first


class Places:
    """Places of numbers in an array of distinct ones, by rounds of hash tables:
    what finds its place taken goes to the next round's table."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.rounds, left, odd = keys, [], np.arange(len(keys)), 0x9E3779B97F4A7C15
        while len(left):
            bits = max(4, int(4 * len(left)).bit_length())
            table = np.zeros(1 << bits, np.int32)
            at = self._hash(keys[left], odd, bits)
            table[at] = left
            self.rounds.append((odd, bits, table))
            left, odd = left[table[at] != left], odd * 0xD1342543DE82EF95 % (1 << 64) | 1

    @staticmethod
    def _hash(keys: np.ndarray, odd: int, bits: int) -> np.ndarray:
        return (keys * np.uint64(odd)) >> np.uint64(64 - bits)

    def __call__(self, found: np.ndarray) -> np.ndarray:
        out, left = np.empty(len(found), np.int32), None
        for odd, bits, table in self.rounds:
            some = found if left is None else found[left]
            place = table[self._hash(some, odd, bits)]
            if left is None:
                out[:] = place
            else:
                out[left] = place
            missed = np.flatnonzero(self.keys[place] != some)
            left = missed if left is None else left[missed]
            if not len(left):
                break
        return out


def _passes(texts: list[bytes]) -> Iterator[list[bytes]]:
    some, size = [], 0
    for t in texts:
        some.append(t)
        size += len(t)
        if size >= PASS_BYTES:
            yield some
            some, size = [], 0
    if some:
        yield some


def _utf8(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _words(text: bytes) -> list[bytes]:
    return text.lower().split()


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: each distinct word and byte string with its training count."""
    words: dict[int, Counter] = defaultdict(Counter)
    strings: dict[int, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)

    def merge(block: int) -> tuple[np.ndarray, np.ndarray]:
        keys, n = (np.concatenate(x) for x in zip(*strings[block]))
        keys, inverse = np.unique(keys, return_inverse=True)
        strings[block] = [(keys, np.bincount(inverse, weights=n).astype(np.int64))]
        return strings[block][0]

    def rows(block: int, words: pa.Array, keys: pa.Array, n: pa.Array) -> Iterator[pa.RecordBatch]:
        whole = pa.RecordBatch.from_arrays([pa.array(np.full(len(n), block), pa.int32()), words, keys, n], ["block", "word", "key", "n"])
        for at in range(0, len(n), 1 << 16):
            yield whole.slice(at, 1 << 16)

    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            groups: dict[tuple[int, bool], list[bytes]] = defaultdict(list)
            for block, train, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), _utf8(part.column(2))):
                groups[block, train].append(text)
            for (block, train), texts in groups.items():
                own = words[block]
                for text in texts:
                    each = _words(text)
                    each.append(b"")
                    own.update(each if train else dict.fromkeys(each, 0))
                for some in _passes(texts):
                    keys, n = np.unique(_strings(some)[0], return_counts=True)
                    strings[block].append((keys, n * train))
                    if len(strings[block]) >= 16:
                        merge(block)
    for block in list(words):
        own = words.pop(block)
        yield from rows(block, pa.array(list(own), pa.binary()), pa.nulls(len(own), pa.int64()), pa.array(list(own.values()), pa.int64()))
        keys, n = merge(block)
        del strings[block]
        yield from rows(block, pa.nulls(len(keys), pa.binary()), pa.array(keys.astype(np.int64)), pa.array(n))


def _log_gamma(x: Column) -> Column:
    """Stirling's series after a shift by eight (exact to 1e-11 from 0.5 on)."""
    shift = x
    for j in range(1, 8):
        shift = shift * (x + j)
    y = x + 8
    return ((y - 0.5) * F.log(y) - y + F.lit(0.5 * math.log(2 * math.pi)) + 1 / (12 * y) - 1 / (360 * y * y * y)
            + 1 / (1260 * y * y * y * y * y) - F.log(shift))


def _block_probability(a: Column, b: Column) -> Column:
    """Natural log of the Krichevsky-Trofimov probability of a zeros, b ones."""
    a, b = a.cast("double"), b.cast("double")
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1) - F.lit(math.log(math.pi))


def _log_add(x: Column, y: Column) -> Column:
    return F.greatest(x, y) + F.log1p(F.exp(-F.abs(x - y)))


def _nodes(strings: DataFrame) -> DataFrame:
    """(key, ctx, v, bit, n) for the eight binary nodes of each (key, n)."""
    byte = F.col("key").bitwiseAND(F.lit(255))
    path = F.array(*[F.struct(
        F.shiftright(byte.bitwiseOR(F.lit(256)), 8 - i).cast("int").alias("v"),
        F.shiftright(byte, 7 - i).bitwiseAND(F.lit(1)).cast("int").alias("bit")) for i in range(8)])
    return strings.select("key", F.shiftright("key", 8).alias("ctx"), "n", F.explode(path).alias("p")).select(
        "key", "ctx", "n", "p.v", "p.bit")


def context_trees(strings: DataFrame) -> DataFrame:
    """(key, logp): log10 probability of the byte after its context, for every
    (key, n) of ``strings``, whose counts n are the training corpus."""
    half = F.lit(math.log(0.5))
    nodes = _nodes(strings)
    level = cut_lineage(nodes.groupBy("ctx", "v").agg(
        F.sum(F.when(F.col("bit") == 0, F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("bit") == 1, F.col("n")).otherwise(0)).alias("b"))
        .withColumn("kt", _block_probability(F.col("a"), F.col("b"))).withColumn("whole", F.col("kt")))
    levels = [level]
    for depth in range(DEPTH - 1, -1, -1):
        up = levels[-1].groupBy(F.col("ctx").bitwiseAND(F.lit((1 << 8 * depth) - 1)).alias("ctx"), "v").agg(
            F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("whole").alias("below"))
        up = up.withColumn("kt", _block_probability(F.col("a"), F.col("b")))
        levels.append(cut_lineage(up.withColumn("whole", half + _log_add(F.col("kt"), F.col("below"))).drop("below")))
    one = (F.col("b") + 0.5) / (F.col("a") + F.col("b") + 1)
    # mixed: what the depths so far say; rest: the weight left for deeper ones
    mixed = None
    for depth, level in enumerate(reversed(levels)):
        weight = F.lit(1.0) if depth == DEPTH else F.exp(half + F.col("kt") - F.col("whole"))
        if mixed is None:
            mixed = level.select("ctx", "v", (weight * one).alias("said"), (1 - weight).alias("rest"))
        else:
            above = mixed.select(F.col("ctx").alias("up"), "v", F.col("said").alias("said_up"), F.col("rest").alias("rest_up"))
            down = level.withColumn("up", F.col("ctx").bitwiseAND(F.lit((1 << 8 * (depth - 1)) - 1)))
            mixed = down.join(above, ["up", "v"]).select(
                "ctx", "v", (F.col("said_up") + F.col("rest_up") * weight * one).alias("said"),
                (F.col("rest_up") * (1 - weight)).alias("rest"))
    said = nodes.join(mixed.select("ctx", "v", "said"), ["ctx", "v"])
    return said.groupBy("key").agg(F.sum(F.log10(
        F.when(F.col("bit") == 1, F.col("said")).otherwise(1 - F.col("said")))).alias("logp"))


def _blocks(docs: DataFrame, n: int) -> DataFrame:
    return docs.select(F.pmod(F.xxhash64("id", "text"), F.lit(n)).cast("int").alias("block"),
                       (~F.col("held")).alias("train"), "text", "id").repartition(n, "block")


def score(docs: DataFrame, held_out: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte. Rows that are held out take no part in any count."""
    if held_out is None:
        held_out = id_text_crc(id_col) % 10 == 0
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held"))
    kind = rows.schema["id"].dataType.simpleString()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = _blocks(rows, max(1, -(-size // BLOCK_BYTES)))  # by bytes alone: each block asks for its own items
    # a word (the end token is the empty word), or a byte string of context and byte
    asked = blocks.select("block", "train", "text").mapInArrow(_ask, "block int, word binary, key bigint, n bigint")
    item = Window.partitionBy("word", "key")
    counted = cut_lineage(asked.select(
        "block", "word", "key", "n", F.sum("n").over(item).alias("c"),
        (F.row_number().over(item.orderBy("block")) == 1).alias("first")))
    words = counted.filter("key is null")
    tokens, distinct = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)),
        F.coalesce(F.sum((F.col("first") & (F.col("c") > 0)).cast("long")), F.lit(0))).first()
    floor = math.log10(tokens + ADD * (distinct + 1))
    strings = counted.filter("key is not null")
    known = context_trees(strings.filter("first").select("key", F.col("c").alias("n")))
    answers = words.select("block", "word", "key", F.log10(F.col("c") + ADD).alias("value")).unionByName(
        strings.join(known, "key").select("block", "word", "key", F.col("logp").alias("value")))

    def answer(some: pa.Table, known: pa.Table) -> pa.Table:
        own = known.filter(pc.is_null(known.column("key")))
        of = dict(zip(_utf8(own.column("word").combine_chunks()), own.column("value").to_pylist()))
        known = known.filter(pc.is_valid(known.column("key")))
        place, logp = Places(known.column("key").to_numpy().astype(np.uint64)), known.column("value").to_numpy()
        kinds = [("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
                 ("bits_per_byte", pa.float64())]
        out: dict[str, list] = {k: [] for k, _ in kinds}
        for at in range(0, some.num_rows, 1024):
            for texts in _passes(_utf8(some.column("text").slice(at, 1024).combine_chunks())):
                found, first = _strings(texts)
                scores = np.add.reduceat(logp[place(found)], first)
                for text, whole in zip(texts, scores.tolist()):
                    each = _words(text)
                    each.append(b"")
                    got = np.fromiter(map(of.__getitem__, each), float, len(each))
                    out["n_tokens"].append(len(each))
                    out["n_known"].append(int((got > 0).sum()))
                    out["base_score"].append(float(got.sum()) - len(each) * floor)
                    out["score"].append(whole)
                    out["bits_per_byte"].append(-whole / math.log10(2) / (len(text) + 1))
        return pa.table({"id": some.column("id"), "train": some.column("train"), **{k: pa.array(out[k], t) for k, t in kinds}})

    both = blocks.groupBy("block").cogroup(answers.groupBy("block"))
    found = both.applyInArrow(answer, (
        f"id {kind}, train boolean, n_tokens bigint, n_known bigint, base_score double, score double, bits_per_byte double"))
    return found.select(F.col("id").alias(id_col), (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                        F.lit(int(tokens)).cast("long").alias("train_tokens"), "base_score", "score", "bits_per_byte")
