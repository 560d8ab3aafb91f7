"""Quality classifier with supervised subword embeddings.

A document is the average of the learned vectors of its hashed word and
character n-grams; a softmax layer on that average gives the label. The model
is fitted by stochastic gradient descent in numpy on a bounded sample: the
``max_train_docs`` labelled documents of lowest id hash (a documented bound;
scoring reads every row). The sample's n-gram counts are streamed from Spark
partition by partition, and held between passes only below ``HELD_BYTES``.
For scoring, vectors and output layer fold into one number per bucket, so
every executor needs 2 MB.

Defined results: null and empty texts have no n-gram and get the score of the
bias alone; repeated labels of a document count once if they agree and are
left out if not; null labels are left out; without labels of both kinds every
score is the share of the label seen (0.5 without any); repeated rows are
scored alike; only the id and the text are inputs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import cut_lineage, handing_back, id_text_crc, text_or_empty
from visitlens.llm.hashing import mix, word_hashes

#: Buckets for all n-grams, length of a vector, character n-gram lengths.
BUCKETS, WIDTH, CHARS = 1 << 19, 16, (2, 4)
#: Bound of the training sample, steps of descent, first learning rate.
MAX_TRAIN_DOCS, STEPS, RATE, SEED = 4000, 16_000, 2.0, 7
#: A sample of at most this many bytes of n-gram counts stays on the driver
#: between passes; a larger one is streamed again for every pass.
HELD_BYTES = 1 << 27
#: Bytes of text scored at a time; the arrays of a pass take over a hundred
#: times as much.
PASS_BYTES = 1 << 18


def buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram occurrence, and its document's index.

    Words, word pairs (an immediate repeat shares one bucket whatever the word
    is) and byte n-grams of the whole text, each kind salted.
    """
    words, at = word_hashes(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(at))
    found, owners = [mix(words + np.uint64(11))], [owner]
    pair = owner[1:] == owner[:-1]
    second, first = words[1:][pair], words[:-1][pair]
    both = np.where(first == second, np.uint64(5), mix(first + np.uint64(3)) + second)
    found.append(mix(both + np.uint64(23)))
    owners.append(owner[1:][pair])
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64)
    sizes = np.array([len(t) for t in texts])
    who = np.repeat(np.arange(len(texts)), sizes)
    for n in CHARS:
        if len(data) >= n:
            code = np.full(len(data) - n + 1, n, np.uint64)
            for j in range(n):
                code = code << np.uint64(8) | data[j:len(data) - n + 1 + j]
            inside = who[n - 1:] == who[:len(who) - n + 1]
            found.append(mix(code[inside]))
            owners.append(who[:len(who) - n + 1][inside])
    return (np.concatenate(found) & np.uint64(BUCKETS - 1)).astype(np.int64), np.concatenate(owners)


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
    return column.cast(pa.binary()).fill_null(b"").to_pylist()


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            ids, weights = [], []
            for text in _utf8(part.column(1)):
                found, n = np.unique(buckets([text])[0], return_counts=True)
                ids.append(found.astype("<u4").tobytes())
                weights.append((n / max(1, n.sum())).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(ids, pa.binary()), pa.array(weights, pa.binary())], ["label", "ids", "weights"])


def train_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, max_docs: int) -> DataFrame:
    """(label, text, h) of the labelled documents of lowest id hash h."""
    clean = (labels.select(F.col(id_col).alias("k"), F.col("quality").cast("int").alias("label"))
             .filter("k is not null and label in (0, 1)")
             .groupBy("k").agg(F.min("label").alias("label"), F.max("label").alias("most"))
             .filter("label = most").orderBy(F.xxhash64("k"), "k").limit(max_docs))
    # broadcast of at most max_docs (id, label) pairs
    return (docs.select(F.col(id_col).alias("k"), text_or_empty(text_col).alias("text"))
            .join(F.broadcast(clean.select("k", "label")), "k")
            .select("label", "text", F.xxhash64("k").alias("h")))


def train(sample: DataFrame) -> np.ndarray:
    """Logit of label 1 per bucket, and the bias in the last place.

    Descent takes the sample by hash, so the table's order does not matter.
    """
    made = cut_lineage(sample.orderBy("h", "text", "label").select("label", "text").mapInArrow(handing_back(_features), "label int, ids binary, weights binary"))
    counts = {r["label"]: r["count"] for r in made.groupBy("label").count().collect()}
    total = sum(counts.values())
    flat = np.zeros(BUCKETS + 1, np.float32)
    if len(counts) < 2:
        share = min(0.99, max(0.01, counts.get(1, 0) / total)) if total else 0.5
        flat[-1] = math.log(share / (1 - share))
        return flat
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    layer, bias = np.zeros((WIDTH, 2), np.float32), np.zeros(2, np.float32)
    step, passes = 0, -(-STEPS // total)
    held = made.agg(F.sum(F.octet_length("ids"))).first()[0] <= HELD_BYTES // 2
    rows = list(made.toLocalIterator()) if held else None
    for _ in range(passes):
        for row in rows if held else made.toLocalIterator():
            ids, weights = np.frombuffer(row["ids"], "<u4"), np.frombuffer(row["weights"], "<f4")
            rate = RATE * (1 - step / (passes * total))
            step += 1
            hidden = weights @ vectors[ids] if len(ids) else np.zeros(WIDTH, np.float32)
            out = hidden @ layer + bias
            soft = np.exp(out - out.max())
            error = soft / soft.sum()
            error[row["label"]] -= 1
            back = layer @ error
            layer -= rate * np.outer(hidden, error).astype(np.float32)
            bias -= np.float32(0.1 * rate) * error
            if len(ids):
                # the sum of squared weights keeps the step alike for short and long texts
                vectors[ids] -= (rate / float(weights @ weights) * 0.05) * np.outer(weights, back).astype(np.float32)
    flat[:-1] = vectors @ (layer[:, 1] - layer[:, 0])
    flat[-1] = bias[1] - bias[0]
    return flat


def score_texts(flat: np.ndarray, texts: list[bytes]) -> np.ndarray:
    out = []
    for some in _passes(texts):
        found, owner = buckets(some)
        n = np.maximum(np.bincount(owner, minlength=len(some)), 1)
        logit = np.bincount(owner, weights=flat[found], minlength=len(some)) / n + flat[-1]
        out.append(1 / (1 + np.exp(-np.clip(logit, -50, 50))))
    return np.concatenate(out) if out else np.zeros(0)


def score(docs: DataFrame, flat: np.ndarray, text_col: str = "text") -> DataFrame:
    """``docs`` with two more columns, ``score`` and ``predicted``, at the end.

    A text that is a string travels once, to be scored and carried; only of
    another type is a string made beside it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(flat)
    names = docs.columns
    carried = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]
    once = (text_col, "string") in docs.dtypes
    rows = docs.select(*carried, *([] if once else [text_or_empty(text_col).alias("text")]))
    text_at = names.index(text_col) if once else len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                got = score_texts(shared.value, _utf8(part.column(text_at)))
                yield pa.RecordBatch.from_arrays([*part.columns[:len(names)], pa.array(got, pa.float64())],
                                                 [*part.schema.names[:len(names)], "score"])

    kinds = ", ".join(f"c{i} {rows.schema[i].dataType.simpleString()}" for i in range(len(names)))
    scored = rows.mapInArrow(handing_back(run), f"{kinds}, score double")
    return scored.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)],
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, flat: np.ndarray, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model predicts to be good."""
    names = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(names)])
    good = score(plain, flat, f"k{names.index(text_col)}").filter("predicted = 1")
    return good.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(names)])


def held_out(id_col: str = "doc_id") -> Column:
    return id_text_crc(id_col) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        max_train_docs: int = MAX_TRAIN_DOCS) -> np.ndarray:
    """Model from the labelled rows that are not held out."""
    known = labels.filter(~F.coalesce(held_out(id_col), F.lit(False)))
    return train(train_sample(docs, known, id_col, text_col, max_train_docs))
