"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six characters that count as white space in every operator here.
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def without_spaces(text: Column) -> Column:
    """``text`` without white space: byte-wise replaces, no regular expression."""
    for ch in SPACES:
        text = F.replace(text, F.lit(ch), F.lit(""))
    return text


def id_text_crc(name: str = "doc_id") -> Column:
    """crc32 of the id written as text (the fold rule of the contracts)."""
    return F.crc32(F.col(name).cast("string").cast("binary"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_running(df: DataFrame, columns: dict[str, str], how: str = "sum") -> DataFrame:
    """Adds running sums or maxima of arrays of non-negative bigints.

    ``columns`` maps each new array column to its source. Every array is taken
    in blocks of the square root of its size: block totals first, then each
    place within its block. A fold that appends to an array copies it at every
    step, which texts with thousands of matches cannot afford.
    """
    zero = F.lit(0).cast("bigint")

    def total(part: Column) -> Column:
        if how == "max":
            return F.coalesce(F.array_max(part), zero)
        return F.aggregate(part, zero, lambda a, x: a + x)

    def joined(a: Column, b: Column) -> Column:
        return F.greatest(a, b) if how == "max" else a + b

    def block(j: Column, step: Column) -> Column:
        return F.floor(j / step).cast("int")

    def totals(new: str, old: str) -> Column:
        step = F.col(f"_step_{new}")
        return F.transform(F.sequence(F.lit(0), block(F.size(old), step)),
                           lambda k: total(F.slice(F.col(old), k * step + 1, step)))

    def before(new: str) -> Column:
        blocks = F.col(f"_blocks_{new}")
        return F.transform(blocks, lambda _, k: total(F.slice(blocks, F.lit(1), k)))

    def placed(new: str, old: str) -> Column:
        step = F.col(f"_step_{new}")
        return F.transform(F.col(old), lambda _, j: joined(
            F.get(F.col(f"_before_{new}"), block(j, step)),
            total(F.slice(F.col(old), block(j, step) * step + 1, j % step + 1))))

    df = df.withColumns({f"_step_{n}": F.greatest(F.ceil(F.sqrt(F.size(o))), F.lit(1)).cast("int") for n, o in columns.items()})
    df = df.withColumns({f"_blocks_{n}": totals(n, o) for n, o in columns.items()})
    df = df.withColumns({f"_before_{n}": before(n) for n in columns})
    df = df.withColumns({n: placed(n, o) for n, o in columns.items()})
    return df.drop(*[f"_{x}_{n}" for n in columns for x in ("step", "blocks", "before")])


def handing_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` for ``mapInArrow``, after which the memory that Arrow's pool holds
    unused goes back to the system: Spark keeps the worker for later stages."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return whole


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the cluster's shared ``spark.checkpoint.dir``.

    Where that is unset, a private folder serves a local master (tests) and
    any other master is refused, because executors would not share it.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="visitlens-llm-")
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
