"""Tables of fixed size over hashed numbers, built in tasks, for a broadcast.

A set of numbers of any size becomes one bit for every value that the numbers'
low bits take, and counts become one counter a value: whatever the number of
rows, the table has ``2 ** LOOK_BITS`` bits (16 MB) or ``2 ** SLOT_BITS``
counters (16 MB). Its blocks are made in tasks; the driver only lays them side
by side. A look-up may say yes for a number that is not in the set, never no for
one that is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOOK_BITS, BLOCK_BITS = 27, 1 << 16
SLOT_BITS, BLOCK_SLOTS = 22, 1 << 14


def bit_table(numbers: DataFrame) -> np.ndarray:
    """The table of a frame with one bigint column."""
    name, = numbers.columns
    low = F.col(name).bitwiseAND(F.lit((1 << LOOK_BITS) - 1))

    def run(table: pa.Table) -> pa.Table:
        bits = np.zeros(BLOCK_BITS, np.uint8)
        bits[table.column("low").to_numpy() % BLOCK_BITS] = 1
        return pa.table({"block": table.column("block")[:1], "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    blocks = (numbers.select(low.alias("low")).withColumn("block", F.floor(F.col("low") / BLOCK_BITS).cast("bigint"))
              .groupBy("block").applyInArrow(run, "block bigint, bits binary"))
    out = np.zeros((1 << LOOK_BITS) // 8, np.uint8)
    for r in blocks.collect():
        out[r["block"] * BLOCK_BITS // 8:(r["block"] + 1) * BLOCK_BITS // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def held(table: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Whether the bit of each number is set."""
    bit = numbers.view(np.uint64) & np.uint64(len(table) * 8 - 1)
    return (table[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def slots(numbers: np.ndarray) -> np.ndarray:
    """Place of each number's counter."""
    return (numbers.view(np.uint64) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)


def counter_table(counts: DataFrame) -> np.ndarray:
    """Counters (capped at 32 bits) from rows (slot, n)."""
    def run(table: pa.Table) -> pa.Table:
        out = np.zeros(BLOCK_SLOTS, np.uint32)
        out[table.column("slot").to_numpy() % BLOCK_SLOTS] = np.minimum(table.column("n").to_numpy(), (1 << 32) - 1).astype(np.uint32)
        return pa.table({"block": table.column("block")[:1], "counts": pa.array([out.tobytes()], pa.binary())})

    blocks = (counts.groupBy("slot").agg(F.sum("n").alias("n")).withColumn("block", F.floor(F.col("slot") / BLOCK_SLOTS).cast("bigint"))
              .groupBy("block").applyInArrow(run, "block bigint, counts binary"))
    out = np.zeros(1 << SLOT_BITS, np.uint32)
    for r in blocks.collect():
        out[r["block"] * BLOCK_SLOTS:(r["block"] + 1) * BLOCK_SLOTS] = np.frombuffer(r["counts"], np.uint32)
    return out
