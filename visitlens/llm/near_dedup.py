"""Near-dedup with SetSketch registers.

Every text becomes the set of its word shingles. A register keeps the least of
the set's exponential hash values on an exponential scale, truncated to 16
bits; equal registers say that sets overlap, and the registers of a union are
the maxima of its parts'. Bands of registers deal sets into buckets. Within a
bucket the similarity of a pair is first estimated from how many registers are
greater, less and equal (maximum likelihood with the known set sizes), and then
confirmed on the full sets.

Equal sets are one node, so copies never meet each other. No bucket is expanded
into all its pairs unless it is small. Each member first meets one hub, the member
of its buckets that collides with the most others, then, in larger buckets, the few
members of other components whose registers agree with its own the most; that
joins a group, and what is in one component is compared no further. Buckets that
still hold several components are finished exactly: small ones pair by pair, the
members of larger ones by prefixes of their rarest shingles, which sets that link
must share, so texts with much boilerplate and few words of their own do not meet.
Components spread by least labels with pointer jumping; links, labels and sets stay
in Spark, and every join is a shuffle join.

Defined results: null text counts as empty; without words a text has no
shingle, links with nothing and is kept; with fewer words than a shingle the
whole sequence is the one shingle; repeated rows share one node; rows with one
id and different texts are one node; null ids are not linked; an empty table
gives no rows; only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlens.llm.bits import bit_table, counter_table, held, slots
from visitlens.llm.common import cut_lineage, handing_back, text_or_empty
from visitlens.llm.hashing import shingles, word_hashes

#: Registers in a band and bands: a pair at 0.8 shares no band with chance 5e-6.
ROWS, BANDS = 6, 40
REGISTERS = ROWS * BANDS
#: Base of the register scale, rate of the exponential values, largest register.
BASE, SCALE, TOP = 1.001, 20.0, (1 << 16) - 2
#: A pair is verified if its estimate is at most this far below the threshold
#: (five standard errors of the estimate).
MARGIN = 5 * math.sqrt(0.16 / REGISTERS)
PASS_BYTES, CHUNK = 2 << 20, 2048
#: Rows of small tables (labels, links, roots) in one partition.
SMALL_ROWS = 100_000
#: What members are compared with: one hub, then the nearest of their buckets, then
#: all that may still link.
TURNS = ("hub", "nearest", "rest")
#: Members of a bucket that are compared with each other in the end; those of
#: larger ones are compared by their rarest items.
SMALL_BUCKET = 32
#: Nearest members that a member is compared with, and members in a tile of a bucket.
BEST, TILE = 2, 2048
#: Ratio of the bounds of a size class.
CLASS_RATIO = 1.03

_rng = np.random.default_rng(20)
_TIMES = _rng.integers(1, 1 << 63, REGISTERS, dtype=np.uint64) | np.uint64(1)
_PLUS = _rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64)


def registers(found: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of 64-bit shingle hashes."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), CHUNK):
        values = found[at:at + CHUNK, None] * _TIMES
        values += _PLUS
        np.minimum(least, values.min(axis=0), out=least)
    uniform = (least >> np.uint64(11)).astype(float) / (1 << 53) + 2.0 ** -54
    exponential = -np.log1p(-uniform) / SCALE
    return np.clip(np.floor(1 - np.log(exponential) / math.log(BASE)), 0, TOP + 1).astype(np.uint16)


def estimate(more: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Likeliest similarity from counts of greater and lesser registers."""
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    equal = REGISTERS - more - less

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        above, below = chance(u - v * j), chance(v - u * j)
        rest = np.maximum(1 - above - below, 1e-300)
        return (more * np.log(np.maximum(above, 1e-300)) + less * np.log(np.maximum(below, 1e-300)) + equal * np.log(rest))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    golden = (math.sqrt(5) - 1) / 2
    for _ in range(30):
        a, b = high - golden * (high - low), low + golden * (high - low)
        left = likelihood(a) >= likelihood(b)
        high, low = np.where(left, b, high), np.where(left, low, a)
    return (low + high) / 2


def _text_sets(batch: pa.RecordBatch, column: int, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of a batch, a few MB at a time."""
    row = 0
    while row < batch.num_rows:
        some, used = [], 0
        while row + len(some) < batch.num_rows and (not some or used < PASS_BYTES):
            some.append(batch.column(column)[row + len(some)].as_py().encode("utf-8", "replace").lower())
            used += len(some[-1])
        words, at = word_hashes(some)
        for i in range(len(some)):
            yield row + i, shingles(words[at[i]:at[i + 1]], size)
        row += len(some)


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """(id, n, same, regs) of (id, text): set size, digest of the set, registers."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, same, regs = [], [], []
            for _, found in _text_sets(batch, 1, size):
                n.append(len(found))
                same.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                regs.append(registers(found).astype("<u2").tobytes() if len(found) else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(same, pa.binary()), pa.array(regs, pa.binary())],
                ["id", "n", "same", "regs"])

    return docs.select("id", "text").mapInArrow(handing_back(run), f"id {kind}, n bigint, same binary, regs binary")


def register_marks(regs: np.ndarray) -> np.ndarray:
    """Two bits of every register, thirty registers in a 64-bit number."""
    bits = (regs.reshape(len(regs), -1, 30) & 3).astype(np.uint64) << (2 * np.arange(30, dtype=np.uint64))
    return bits.sum(axis=2, dtype=np.uint64).astype(np.int64)


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix of the registers whose marks are equal: those that are, and a quarter
    of the others."""
    x = a[:, None, :] ^ b[None, :, :]
    return REGISTERS - np.bitwise_count((x | x >> np.uint64(1)) & np.uint64(int("01" * 30, 2))).sum(axis=2, dtype=np.int64)


def full_sets(docs: DataFrame, size: int, wanted: np.ndarray) -> DataFrame:
    """(id, n, regs, marks, items) of (id, text): registers and all shingle hashes, of
    the rows whose id has its bit in ``wanted`` (and few others)."""
    kind = docs.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(held(shared.value, batch.column(2).to_numpy())))
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                items = [found for _, found in _text_sets(part, 1, size)]
                regs = [registers(x) for x in items]
                marks = register_marks(np.array(regs)) if regs else []
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) for x in items], pa.int64()), pa.array([x.astype("<u2").tobytes() for x in regs], pa.binary()),
                     pa.array(list(marks), pa.list_(pa.int64())), pa.array([x.astype(np.int64) for x in items], pa.list_(pa.int64()))],
                    ["id", "n", "regs", "marks", "items"])

    return docs.select("id", "text", F.xxhash64("id").alias("number")).mapInArrow(
        handing_back(run), f"id {kind}, n bigint, regs binary, marks array<bigint>, items array<bigint>")


def _sets_of(column: pa.ListArray) -> list[np.ndarray]:
    values, at = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[a:b].view(np.uint64) for a, b in zip(at[:-1], at[1:], strict=True)]


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int(np.count_nonzero(b[at] == a))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are estimated near enough and whose full sets overlap by
    at least ``percent``."""
    kind = pairs.schema["a"].dataType.simpleString()
    one, two = (sets.select(F.col("id").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", "regs", "items")]).hint("merge") for x in "ab")
    fits = (100 * F.least("n_a", "n_b")) >= (percent * F.greatest("n_a", "n_b"))
    both = pairs.join(one, "a").join(two, "b").filter(fits & (F.col("n_a") > 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, REGISTERS) for i in (4, 5))
            sizes = [batch.column(i).to_numpy().astype(float) for i in (2, 3)]
            near = estimate((left > right).sum(axis=1), (left < right).sum(axis=1), *sizes) >= percent / 100 - MARGIN
            sets_a, sets_b = _sets_of(batch.column(6)), _sets_of(batch.column(7))
            for i in np.flatnonzero(near):
                common = overlap(sets_a[i], sets_b[i])
                near[i] = 100 * common >= percent * (len(sets_a[i]) + len(sets_b[i]) - common)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(near))

    return both.select("a", "b", "n_a", "n_b", "regs_a", "regs_b", "items_a", "items_b").mapInArrow(handing_back(run), f"a {kind}, b {kind}").distinct()


def _kept_small(df: DataFrame, rows: int) -> DataFrame:
    """``df``, cut from its lineage, in as few partitions as its rows call for;
    ``rows`` bounds them. Small tables then leave few shuffle files."""
    return cut_lineage(df).coalesce(1 + rows // SMALL_ROWS)


def spread(links: DataFrame, rows: int) -> DataFrame:
    """(id, c): least id of the component of every id in ``links`` (a, b).

    Each step takes the least root of all neighbours and jumps to that root's
    own root, so long chains shorten by half. Joins are by shuffle: nothing is
    held for a broadcast, whatever the number of steps.
    """
    ways = F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y"))))
    edges = _kept_small(links.select(ways.alias("e")).select("e.x", "e.y"), 2 * rows)
    roots = _kept_small(edges.groupBy(F.col("x").alias("v")).agg(F.min(F.least("x", "y")).alias("r")), rows)
    moved = True
    while moved:
        told = (edges.join(roots.select(F.col("v").alias("x"), "r").hint("merge"), "x").select(F.col("y").alias("v"), "r", F.lit(None).alias("old"))
                .unionByName(roots.select("v", "r", F.col("r").alias("old")))
                .groupBy("v").agg(F.min("r").alias("r"), F.max("old").alias("old")))
        ups = roots.select(F.col("v").alias("r"), F.col("r").alias("up")).hint("merge")
        roots = _kept_small(told.join(ups, "r", "left").select("v", F.least("r", "up").alias("r"), "old"), rows)
        moved = not roots.filter("r <> old").isEmpty()
    return roots.select(F.col("v").alias("id"), F.col("r").alias("c"))


def bucket_rows(nodes: DataFrame) -> DataFrame:
    """(key, id, score) of every band of (id, regs) that nodes share.

    A node's score is the number of nodes that its buckets hold: those nearest to
    all others of a group collide the most.
    """
    width = 2 * ROWS
    keys = nodes.select("id", F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(
        F.substring(F.col("regs"), i * width + 1, F.lit(width)), i))).alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").hint("merge")
    return keys.join(shared, "key").select("key", "id", F.sum("m").over(Window.partitionBy("id")).alias("score"))


def open_buckets(placed: DataFrame) -> DataFrame:
    """(key, m, hub) of the buckets with more than one component; the hub is the
    member of highest score."""
    return placed.groupBy("key").agg(
        F.count(F.lit(1)).alias("m"), F.min("c").alias("lo"), F.max("c").alias("hi"),
        F.max(F.struct("score", "id", "c")).alias("hub")).filter("lo <> hi").select("key", "m", "hub")


def hub_pairs(placed: DataFrame, found: DataFrame) -> DataFrame:
    """One pair (a, b) for each member of an open bucket: the hub of highest score
    among its buckets' hubs, if that is in another component."""
    return (placed.join(found.select("key", "hub").hint("merge"), "key").filter("c <> hub.c")
            .groupBy(F.col("id").alias("b")).agg(F.max("hub").alias("hub")).select(F.col("hub.id").alias("a"), "b"))


def small_bucket_pairs(placed: DataFrame, found: DataFrame) -> DataFrame:
    """All pairs of different components in buckets of at most ``SMALL_BUCKET`` members."""
    own = placed.join(found.filter(F.col("m") <= SMALL_BUCKET).select("key").hint("merge"), "key")
    one, two = (own.select("key", F.col("id").alias(x), F.col("c").alias(f"c_{x}")) for x in "ab")
    return one.join(two.hint("merge"), "key").filter("a < b and c_a <> c_b").select("a", "b").distinct()


def nearest_pairs(placed: DataFrame, found: DataFrame, sets: DataFrame) -> DataFrame:
    """For each member of a larger open bucket, the few members of its buckets in other
    components whose registers agree with its own the most.

    Members are compared in memory, by the marks of their registers; a bucket is dealt
    into tiles, and each two tiles meet in a task, so that no task holds a bucket and
    no pair is a row but the best ones of a member.
    """
    kind = placed.schema["id"].dataType.simpleString()
    large = found.filter(F.col("m") > SMALL_BUCKET).select("key", F.ceil(F.col("m") / TILE).cast("int").alias("tiles")).hint("merge")
    rows = placed.select("key", "id", "c").join(large, "key").join(sets.select("id", "marks").hint("merge"), "id")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    least = REGISTERS * (0.25 + 0.75 * (0.8 - MARGIN))

    def run(table: pa.Table) -> pa.Table:
        ids, own = table.column("id").combine_chunks(), table.column("own").to_numpy()
        marks = table.column("marks").combine_chunks().flatten().to_numpy().reshape(len(ids), -1).view(np.uint64)
        codes = table.column("c").combine_chunks().dictionary_encode().indices.to_numpy()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        of, to, rank = [], [], []
        for left, right in {(i, j), (j, i)}:
            one, two = np.flatnonzero(own == left), np.flatnonzero(own == right)
            for at in range(0, len(one), 128):
                some = one[at:at + 128]
                agree = agreement(marks[some], marks[two])
                agree[codes[some][:, None] == codes[two][None, :]] = -1
                n = min(BEST, len(two))
                best = np.argpartition(agree, len(two) - n, axis=1)[:, len(two) - n:]
                value = np.take_along_axis(agree, best, 1)
                row, place = np.nonzero(value >= least)
                of.append(some[row])
                to.append(two[best[row, place]])
                rank.append(value[row, place])
        none = np.zeros(0, np.int64)
        of, to, rank = (np.concatenate([none, *x]) for x in (of, to, rank))
        return pa.table({"id": ids.take(pa.array(of)), "other": ids.take(pa.array(to)), "rank": pa.array(rank)})

    tiled = rows.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    near = tiled.groupBy("key", "i", "j").applyInArrow(run, f"id {kind}, other {kind}, rank bigint")
    best = near.distinct().withColumn("place", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("rank"), "other"))).filter(F.col("place") <= BEST)
    return best.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of sets of sizes ``a`` and ``b`` that are similar enough."""
    return -(-(percent * (a + b)) // (100 + percent))


def _class_starts(most: int) -> np.ndarray:
    """Least set size of each size class."""
    out = [1]
    while out[-1] <= most:
        out.append(max(out[-1] + 1, math.ceil(out[-1] * CLASS_RATIO)))
    return np.array(out)


def prefix_tokens(rows: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """(probe, class, item, id, c, n, place) of (id, c, n, items).

    A set's items are taken rarest first, by the counters. Two sets that link
    share an item among the first ``n - needed + 1`` of both. A set is indexed in
    its own size class for partners of its size or larger, and probes every class
    that a smaller partner may have, each with the shortest prefix that is exact
    for it.
    """
    kind = rows.schema["id"].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, found in enumerate(_sets_of(batch.column(3))):
                n = len(found)
                starts = _class_starts(n)
                own = int(np.searchsorted(starts, n, "right")) - 1
                least = -(-percent * n // 100)
                lengths = [n - int(needed(n, n, percent)) + 1]
                classes = [own]
                for k in range(int(np.searchsorted(starts, least, "right")) - 1, own + 1):
                    lengths.append(n - int(needed(max(int(starts[k]), least), n, percent)) + 1)
                    classes.append(k)
                order = np.lexsort((found, shared.value[slots(found)]))[:max(lengths)]
                first = found[order].view(np.int64)
                total = sum(lengths)
                at = pa.array(np.full(total, i))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.arange(len(lengths)) > 0, lengths)), pa.array(np.repeat(classes, lengths), pa.int32()),
                     pa.array(np.concatenate([first[:x] for x in lengths])), batch.column(0).take(at), batch.column(1).take(at),
                     pa.array(np.full(total, n), pa.int64()), pa.array(np.concatenate([np.arange(x) for x in lengths]), pa.int64())],
                    ["probe", "class", "item", "id", "c", "n", "place"])

    return rows.select("id", "c", "n", "items").mapInArrow(
        handing_back(run), f"probe boolean, class int, item bigint, id {kind}, c {kind}, n bigint, place bigint")


def item_counts(rows: DataFrame) -> DataFrame:
    """(slot, n) of the items of (items), summed over a batch at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot, n = np.unique(slots(batch.column(0).flatten().to_numpy()), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(n)], ["slot", "n"])

    return rows.select("items").mapInArrow(handing_back(run), "slot bigint, n bigint")


def large_bucket_pairs(placed: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Every pair of different components that may link, among the members of the
    larger open buckets, by their rarest items instead of their buckets."""
    members = (placed.join(found.filter(F.col("m") > SMALL_BUCKET).select("key").hint("merge"), "key").groupBy("id").agg(F.min("c").alias("c")))
    rows = cut_lineage(sets.join(members.hint("merge"), "id").filter("n > 0").select("id", "c", "n", "items"))
    tokens = cut_lineage(prefix_tokens(rows, counter_table(item_counts(rows)), percent))
    one, two = (tokens.filter(test).select("class", "item", *[F.col(c).alias(f"{c}_{x}") for c in ("id", "c", "n", "place")])
                for x, test in (("a", ~F.col("probe")), ("b", F.col("probe"))))
    a, b = F.col("n_a"), F.col("n_b")
    ordered = (a < b) | ((a == b) & (F.col("id_a") < F.col("id_b")))
    # what is left behind the shared item bounds the overlap
    enough = F.least(a - F.col("place_a"), b - F.col("place_b")) * (100 + percent) >= percent * (a + b)
    both = one.join(two.hint("merge"), ["class", "item"]).filter(ordered & (100 * a >= percent * b) & (F.col("c_a") != F.col("c_b")) & enough)
    return both.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()


def _links(nodes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame | None:
    """(id, c) of the nodes that are linked with another, or None without any."""
    buckets = cut_lineage(bucket_rows(nodes))
    rows = buckets.count()
    if not rows:
        return None
    few = 1 + rows // (8 * SMALL_ROWS)
    buckets = buckets.coalesce(few)
    sets = cut_lineage(full_sets(docs, size, bit_table(buckets.select(F.xxhash64("id")))))
    links = labels = None

    def linked(pairs: DataFrame) -> None:
        nonlocal links, labels
        more = _kept_small(verified(_kept_small(pairs, rows), sets, percent), rows)
        if not more.isEmpty():
            links = more if links is None else links.unionByName(more)
            labels = spread(links, rows)

    placed = buckets.withColumn("c", F.col("id"))
    for turn in TURNS:
        found = cut_lineage(open_buckets(placed)).coalesce(few)
        if found.isEmpty():
            return labels
        large = not found.filter(F.col("m") > SMALL_BUCKET).isEmpty()
        if turn == "hub":
            linked(hub_pairs(placed, found))
        elif turn == "nearest" and large:
            linked(nearest_pairs(placed, found, sets))
        elif turn == "rest":
            pairs = small_bucket_pairs(placed, found)
            linked(pairs.unionByName(large_bucket_pairs(placed, found, sets, percent)).distinct() if large else pairs)
        if labels is not None and turn != "rest":
            placed = cut_lineage(buckets.join(labels.hint("merge"), "id", "left").withColumn("c", F.coalesce("c", "id"))).coalesce(few)
    return labels


def components(docs: DataFrame, size: int, percent: int = 80) -> DataFrame:
    """(id, n, c) per row of (id, text): set size and least linked id."""
    drawn = cut_lineage(sketches(docs, size))
    # one node per distinct set, named by its least id; node rows are bounded in size
    nodes = cut_lineage(drawn.filter("n > 0 and id is not null").groupBy("same")
                        .agg(F.min("id").alias("id"), F.first("regs").alias("regs")))
    labels = _links(nodes, docs, size, percent)
    named = nodes.select("same", F.col("id").alias("node"))
    if labels is not None:
        named = named.join(labels.withColumnRenamed("id", "node").hint("merge"), "node", "left").select("same", F.coalesce("c", "node").alias("node"))
    return drawn.select("id", "n", "same").join(named.hint("merge"), "same", "left").select(
        "id", "n", F.when((F.col("n") == 0) | F.col("id").isNull(), F.col("id")).otherwise(F.col("node")).alias("c"))


def near_dedup(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id and kept (the least id of its component)."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return components(rows, size, percent).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("c").alias("component_id"),
        F.col("id").eqNullSafe(F.col("c")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the least of its component."""
    found = near_dedup(docs, size, percent, id_col, text_col)
    gone = found.filter(~F.col("kept")).select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
