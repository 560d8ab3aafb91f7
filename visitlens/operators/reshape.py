"""Wide -> long reshapes (unpivot) with label maps.

Every reshape is one ``unpivot`` (a single ``Expand`` over one scan of its
source) instead of one UNION ALL branch per column, so a source with N
mapped columns is read once, not N times. Labels come from literal maps
(fixed, tiny) or from a broadcast join with a config frame when one column
may carry several labels.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VAR = "_vl_column"
_VAL = "_vl_value"


def _lit_map(pairs) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs)])


def unpivot_labeled(df: DataFrame, id_cols: list[Column], labels: list[tuple[str, str, str]],
                    value_name: str, label_names: tuple[str, str],
                    value_type: str | None = None, drop_nulls: bool = False) -> DataFrame:
    """Unpivot the labeled columns present in ``df``.

    ``labels`` rows are ``(group label, column, item label)``; each column
    appears once. Output: ``id_cols``, the two label columns and the value.
    """
    present = [(g, c, lab) for g, c, lab in labels if c in df.columns]
    ids = [c for c in id_cols]
    id_names = [df.select(c).columns[0] for c in ids]
    values = [F.col(c).cast(value_type).alias(c) if value_type else F.col(c) for _, c, _ in present]
    base = df.select(*ids, *values)
    long = base.unpivot(id_names, [c for _, c, _ in present], _VAR, _VAL)
    if drop_nulls:
        long = long.where(F.col(_VAL).isNotNull())
    group_map = _lit_map((c, g) for g, c, _ in present)
    item_map = _lit_map((c, lab) for _, c, lab in present)
    return long.select(*id_names,
                       F.element_at(group_map, F.col(_VAR)).alias(label_names[0]),
                       F.element_at(item_map, F.col(_VAR)).alias(label_names[1]),
                       F.col(_VAL).alias(value_name))


def map_frame(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType(), False) for n in names])
    return spark.createDataFrame(rows, schema)


def unpivot_mapped(df: DataFrame, id_cols: list[Column], map_df: DataFrame, map_rows: list[tuple],
                   keep: Column | None = None) -> DataFrame:
    """Unpivot the columns named in a config map and attach the map rows.

    ``map_rows`` are ``(label1, label2, column_name)``; the map may name a
    column more than once (each map row yields its own output row) and may
    name columns ``df`` lacks (skipped). ``keep`` filters on the cell value
    (``_vl_value``) before the join. The config frame has a fixed size, so
    it is broadcast.
    Returns None when ``df`` has none of the mapped columns.
    """
    cols = []
    for _a, _b, c in map_rows:
        if c in df.columns and c not in cols:
            cols.append(c)
    if not cols:
        return None
    id_names = [df.select(c).columns[0] for c in id_cols]
    base = df.select(*id_cols, *[F.col(c).cast("string").alias(c) for c in cols])
    long = base.unpivot(id_names, cols, _VAR, _VAL)
    if keep is not None:
        long = long.where(keep)
    m = map_df.withColumnRenamed("column_name", _VAR)
    return long.join(F.broadcast(m), on=_VAR, how="inner")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def same_types(frames: list[DataFrame]) -> list[DataFrame]:
    """The frames with every column whose type differs between them as text."""
    kinds = defaultdict(set)
    for df in frames:
        for name, kind in df.dtypes:
            kinds[name].add(kind)
    mixed = {name for name, found in kinds.items() if len(found) > 1}
    return [df.withColumns({c: F.col(f"`{c}`").cast("string") for c in df.columns if c in mixed}) for df in frames]


def outer_union(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; columns missing in a frame are null-filled.

    Output columns keep first-seen order across the frames.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
