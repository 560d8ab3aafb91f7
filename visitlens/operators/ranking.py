"""Ranking operators: row numbers per group without hot-group bottlenecks.

``row_number() over (partition by g order by k)`` needs every row of a
group in one task. When one venue (or one client) holds a large share of all
rows that task becomes the whole job. ``distributed_row_number`` gives the
same numbers while never putting more than one range partition of a group in
one task:

1. range-partition the rows on ``(g, k)`` (Spark samples the bounds), so a
   large group is cut into several ordered range partitions;
2. number rows inside each ``(partition id, g)`` slice with a window (each
   slice is at most one range partition);
3. count rows per ``(partition id, g)`` (partial aggregate); only groups
   present in more than one range partition need an offset, and there are at
   most ``2 * P`` such slices (each partition holds at most two cut groups:
   its first and its last), so that offset table is broadcast with a proven
   size bound.

``balanced_row_number`` takes that way for the groups that need it only: a
mergeable summary of bounded size finds the groups above a task's share, which
are cut by range; all others take one hash shuffle and a plain window.

For top-k-per-group filters (rank 1, ranks 2..11) the plain window plus a
filter is better: Catalyst adds a partial ``WindowGroupLimit`` before the
shuffle, so at most k rows per group and map task are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.session import ensure_checkpoint_dir

#: Rows up to which a group is left to one task, however many tasks there are.
LEAST_HOT_ROWS = 10_000

_PID = "_vl_pid"
_LOCAL = "_vl_local"
_N = "_vl_n"
_NP = "_vl_np"
_OFF = "_vl_off"


def _prefixed(df: DataFrame, cols: list[str], prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in cols],
                     *[c for c in df.columns if c not in cols])


def _null_safe_eq(cols: list[str], prefix: str) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).eqNullSafe(F.col(prefix + c))
    return cond


def distributed_row_number(df: DataFrame, partition_cols: list[str], order_cols: list[Column],
                           out_col: str = "row_number", num_partitions: int | None = None) -> DataFrame:
    """``row_number()`` over ``partition_cols`` ordered by ``order_cols``.

    ``order_cols`` should form a unique key inside each group (add tie-break
    columns); exact ties are numbered in an arbitrary order, as in SQL.
    """
    group = [F.col(c).asc_nulls_first() for c in partition_cols]
    # Both the slice numbering and the slice counts must see the same range
    # bounds, so the range-partitioned rows are cut from their lineage once, in
    # the shared checkpoint folder: nothing stays persisted, and a lost
    # executor loses nothing. Without an explicit count, AQE may merge small
    # neighbouring partitions; merged ones are contiguous, so partition ids
    # still follow the key order.
    keys = [*group, *order_cols]
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    ensure_checkpoint_dir(df.sparkSession)
    ranged = ranged.withColumn(_PID, F.spark_partition_id()).checkpoint(eager=True)

    slice_w = Window.partitionBy(_PID, *partition_cols).orderBy(*order_cols)
    local = ranged.withColumn(_LOCAL, F.row_number().over(slice_w))

    stats = ranged.groupBy(_PID, *partition_cols).agg(F.count(F.lit(1)).alias(_N))
    if partition_cols:
        # groups cut by a range bound appear in several slices; there are fewer
        # than p such groups and at most 2 * p such slices. Both windows below
        # are keyed by the group, so they share one (small) exchange.
        by_group = Window.partitionBy(*partition_cols)
        cut_slices = (stats.withColumn(_NP, F.count(F.lit(1)).over(by_group))
                           .where(F.col(_NP) > 1).drop(_NP))
        off_w = by_group.orderBy(_PID)
    else:
        cut_slices = stats  # one global group: at most p slices
        off_w = Window.orderBy(_PID)
    off_w = off_w.rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_slices.select(_PID, *partition_cols,
                                F.coalesce(F.sum(_N).over(off_w), F.lit(0)).alias(_OFF))
    offsets = _prefixed(offsets, [_PID, *partition_cols], "_o_")

    joined = local.join(F.broadcast(offsets), on=_null_safe_eq([_PID, *partition_cols], "_o_"),
                        how="left")
    rank = F.col(_LOCAL).cast("long") + F.coalesce(F.col(_OFF), F.lit(0).cast("long"))  # groups may pass 2^31 rows
    return joined.select(*[F.col(c) for c in df.columns], rank.alias(out_col))


def hot_groups(rows: DataFrame, partition_cols: list[str], least: int, parts: int) -> list[int]:
    """Hashes of the groups that have about ``least`` rows or more.

    The frequent-items summary of each task has a bounded number of counters,
    and summaries add up, so only that many reach the driver whatever the
    number of groups. Its error is far below ``least``: no group of that size is
    missed. Groups whose hashes are equal count as one.
    """
    tracked = min(1_000_000, 1 << (16 * parts).bit_length())
    found = rows.select(F.xxhash64(*partition_cols).alias("h")).agg(F.expr(f"approx_top_k(h, {min(4 * parts, tracked)}, {tracked})").alias("t"))
    return [t["item"] for t in found.first()["t"] or [] if t["count"] >= least]


def balanced_row_number(df: DataFrame, partition_cols: list[str], order_cols: list[Column], out_col: str = "row_number",
                        least: int | None = None) -> DataFrame:
    """``row_number()`` over ``partition_cols``: one shuffle, and a range cut only for
    groups of at least ``least`` rows (twice a task's share by default)."""
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.checkpoint(eager=True)  # the summary and the ranking read the same rows
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if least is None:
        least = max(LEAST_HOT_ROWS, 2 * rows.count() // parts)
    hot = hot_groups(rows, partition_cols, least, parts)
    own = F.row_number().over(Window.partitionBy(*partition_cols).orderBy(*order_cols)).cast("long")
    if not hot:
        return rows.withColumn(out_col, own)
    is_hot = F.xxhash64(*partition_cols).isin(hot)
    cut = distributed_row_number(rows.where(is_hot), partition_cols, order_cols, out_col)
    return rows.where(~is_hot).withColumn(out_col, own).unionByName(cut)


def top_n_per_group(df: DataFrame, partition_cols: list[str], order_cols: list[Column],
                    n_max: int, out_col: str = "row_number", n_min: int = 1) -> DataFrame:
    """Rows ranked ``n_min..n_max`` in their group, with their rank.

    Written as window + filter so Catalyst plans a partial WindowGroupLimit
    before the shuffle (skew-safe: each map task ships at most ``n_max`` rows
    per group).
    """
    w = Window.partitionBy(*partition_cols).orderBy(*order_cols)
    rn = F.row_number().over(w)
    ranked = df.withColumn(out_col, rn)
    return ranked.where((F.col(out_col) >= n_min) & (F.col(out_col) <= n_max))


def dense_ids(values: DataFrame, col: str, out_col: str = "ordinal") -> DataFrame:
    """1-based ordinal of each distinct value of ``col``, in sorted order.

    A global window would move every value into one task; the distinct values
    are numbered with the distributed row number instead.
    """
    distinct = values.select(col).distinct()
    return distributed_row_number(distinct, [], [F.col(col).asc_nulls_first()], out_col)
