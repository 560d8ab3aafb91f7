"""Column and table profiles in long form.

Wide survey tables can have hundreds of columns; profiling them with one
aggregate expression per column produces huge generated code. Instead the
table is unpivoted to ``(column_name, value)`` (one ``Expand``) and profiled
with a single grouped aggregate, whose partial step combines rows map-side,
so even a column with billions of cells costs one small shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens import config
from visitlens.functions.recode import in_likert_domain, likert_score
from visitlens.functions.text import clean_identifier, identifier

COL = "column_name"
VAL = "value"


def to_long(df: DataFrame, columns: list[str], id_cols: list[str] | None = None) -> DataFrame:
    """Unpivot ``columns`` (as text) to ``(id_cols..., column_name, value)``."""
    ids = id_cols or []
    base = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in columns])
    return base.unpivot(ids, columns, COL, VAL)


def likert_columns(df: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """Which columns hold Likert answers.

    A column qualifies when it has at least one non-null value and every
    non-null value, lower-cased and stripped, is a Likert answer or ``n/a``.
    Output: ``column_name, n_values, is_likert`` (one row per column, also
    for columns without any value). One unpivot and one grouped aggregate;
    the column list (schema metadata) is unioned in so empty columns appear
    without a join.
    """
    skip = {identifier(c) for c in (exclude if exclude is not None else config.METADATA_COLUMNS)}
    cols = [c for c in df.columns if identifier(c) not in skip]
    val = F.col(VAL)
    long = to_long(df, cols).select(COL, F.when(val.isNotNull(), 1).alias("_n"),
                                    F.when(val.isNotNull(), in_likert_domain(val)).alias("_in"))
    names = df.sparkSession.createDataFrame([(c, None, None) for c in cols],
                                            f"{COL} string, _n int, _in boolean")
    prof = long.unionByName(names).groupBy(COL).agg(F.count("_n").alias("n_values"),
                                                    F.bool_and("_in").alias("_all_in"))
    return prof.select(COL, F.col("n_values").cast("long").alias("n_values"),
                       (F.coalesce(F.col("_all_in"), F.lit(False)) & (F.col("n_values") > 0)).alias("is_likert"))


def likert_by_file(answers: DataFrame, keys: list[str], name: str = COL, value: str = VAL) -> DataFrame:
    """Long answers plus ``is_likert`` and ``likert_score``, judged per file.

    ``keys`` name a column of one file (for example file and column); ``name``
    is its header or identifier, by which metadata columns are left out. A
    column is Likert in a file when it has values there and all of them are
    Likert answers or ``n/a``. The profile is one partial aggregate with one
    row per file and column, joined back to the answers.
    """
    val = F.col(value)
    skip = [identifier(c) for c in config.METADATA_COLUMNS]
    profile = (answers.where(val.isNotNull()).groupBy(*keys)
                      .agg((F.bool_and(in_likert_domain(val)) & ~F.first(clean_identifier(F.col(name))).isin(skip)).alias("is_likert")))
    joined = answers.join(profile, keys, "left").withColumn("is_likert", F.coalesce("is_likert", F.lit(False)))
    return joined.withColumn("likert_score", F.when(F.col("is_likert"), likert_score(val)))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count of each value (null included) per column: ``column_name, value, n``."""
    return (to_long(df, columns).groupBy(COL, VAL).agg(F.count(F.lit(1)).alias("n")))


def name_profile(dictionary: DataFrame, file_col: str = "file_id") -> DataFrame:
    """Per file: columns, repeated cleaned names, repeated final names, longest name."""
    return dictionary.groupBy(file_col).agg(
        F.count(F.lit(1)).alias("n_columns"),
        (F.count(F.lit(1)) - F.count_distinct("identifier")).alias("n_duplicate_identifiers"),
        (F.count(F.lit(1)) - F.count_distinct("unique_name")).alias("n_duplicate_names"),
        F.max(F.length("unique_name")).alias("max_name_length"),
    )


def table_profile(df: DataFrame, table_col: str = "client_name") -> DataFrame:
    """Per table of a unified master (one table per ``table_col`` value).

    ``n_rows`` is counted from the data (partial aggregate); the column
    facts come from the schema: number of columns, repeated names, longest
    name. Output also names the table (``<client>_master`` as an identifier).
    """
    from visitlens.functions.text import table_name_for
    cols = [c for c in df.columns]
    n_dup = len(cols) - len(set(cols))
    longest = max(len(c) for c in cols)
    return df.groupBy(table_col).agg(F.count(F.lit(1)).alias("n_rows")).select(
        table_name_for(F.col(table_col)).alias("table_name"), F.col(table_col),
        F.col("n_rows"), F.lit(len(cols)).alias("n_columns"),
        F.lit(n_dup).alias("n_duplicate_columns"), F.lit(longest).alias("max_column_length"))
