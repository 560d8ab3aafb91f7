"""Exact dedup by content sort.

The normalised text (white space deleted) is the sort key. Its leading
characters and its SHA-256 are what Spark samples to choose range splitters,
so the sample that reaches the driver is small whatever the texts' length.
Every partition is then sorted externally on the whole normalised text, which
puts equal texts next to each other, and the window compares neighbours in
full.

A group of copies whose weight exceeds a partition's share is cut into slices
before the sort; a row weighs its original text's bytes plus a fixed cost, so
that many empty or short texts count too. Its winner and size come from a small map-side aggregate over
digests; at most ``4 x partitions`` groups can exceed the share, which bounds
the broadcast of that list.

Defined results: null text counts as empty; empty texts form one group; a
repeated row (same id and text) belongs to its group and only its first copy
is kept; a null id sorts last; input columns that are not carried never reach
the plan, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlens.llm.common import shuffle_partitions, text_or_empty, without_spaces

#: Leading characters of the normalised text that take part in the range key.
KEY_CHARS = 24
#: Least share of a partition, and what a row weighs besides its text, in bytes.
LEAST_SHARE, ROW_BYTES = 1 << 20, 64


def _large_groups(keyed: DataFrame, share: int) -> DataFrame:
    """Digest, winner, size and slice count of groups that weigh more than ``share``."""
    groups = keyed.groupBy("_sha").agg(
        F.sum("_bytes").alias("bytes"), F.count(F.lit(1)).alias("_all_size"),
        F.min(F.struct((-F.col("_chars")).alias("neg"), F.col("_id").isNull().alias("nil"),
                       F.col("_id").alias("id"))).alias("best"))
    return groups.filter(F.col("bytes") > share).select(
        "_sha", F.col("best.id").alias("_all_keep"), "_all_size", F.ceil(F.col("bytes") / share).alias("_slices"))


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    carry: Sequence[str] = ()) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, carry.

    Of equal texts the row with the most code points in its original text
    stays, then the one with the smallest id.
    """
    parts = shuffle_partitions(docs.sparkSession)
    carried = [F.col(c).alias(f"_carry{i}") for i, c in enumerate(carry)]
    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"), *carried)
    normal = without_spaces(F.col("_text"))
    keyed = (rows.withColumn("_norm", normal)
             .withColumn("_chars", F.length("_text").cast("long"))
             .withColumn("_bytes", F.octet_length("_text").cast("long") + ROW_BYTES)
             .withColumn("_sha", F.sha2("_norm", 256)))
    total = rows.agg(F.sum(F.octet_length("_text").cast("long") + ROW_BYTES)).first()[0] or 0
    large = _large_groups(keyed.select("_id", "_chars", "_bytes", "_sha"), max(LEAST_SHARE, total // (4 * parts)))
    sliced = (keyed.withColumn("_head", F.substring("_norm", 1, KEY_CHARS))
              .join(F.broadcast(large), "_sha", "left")
              .withColumn("_slice", F.when(F.col("_slices").isNull(), F.lit(0).cast("long")).otherwise(
                  F.pmod(F.xxhash64("_id"), F.col("_slices")))))
    key = ["_head", "_sha", "_slice"]
    ranged = sliced.drop("_text", "_bytes", "_slices").repartitionByRange(*key)
    group = Window.partitionBy(*key, "_norm")
    order = group.orderBy(F.col("_chars").desc(), F.col("_id").asc_nulls_last())
    placed = (ranged.withColumn("_rank", F.row_number().over(order))
              .withColumn("_keep", F.first("_id").over(order))
              .withColumn("_size", F.count(F.lit(1)).over(group)))
    keep = F.when(F.col("_all_size").isNull(), F.col("_keep")).otherwise(F.col("_all_keep"))
    return placed.select(
        F.col("_id").alias(id_col), keep.alias("keep_id"),
        F.coalesce("_all_size", "_size").alias("group_size"),
        ((F.col("_rank") == 1) & F.col("_id").eqNullSafe(keep)).alias("kept"),
        F.col("_sha").alias("text_sha256"),
        *[F.col(f"_carry{i}").alias(c) for i, c in enumerate(carry) if c != id_col])


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    names = docs.columns
    shadow = docs.select(F.col(id_col).alias("_k"), F.col(text_col).alias("_t"),
                         *[F.col(c).alias(f"_c{i}") for i, c in enumerate(names)])
    marked = mark_duplicates(shadow, "_k", "_t", [f"_c{i}" for i in range(len(names))])
    return marked.filter("kept").select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(names)])
