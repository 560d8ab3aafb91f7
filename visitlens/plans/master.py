"""Client masters: from decoded survey cells to one wide table per client.

Ingest yields long answers that carry their header texts. A client's columns
are the distinct full headers of its files; names are made unique once on
that list, so a header means the same column in every file. Each client's
master is a pivot over its own columns only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlens.operators.headers import flatten, unique_name_list, unique_names, with_identifiers
from visitlens.operators.ranking import dense_ids

PRIORITY_COLUMNS = ["client_id", "client_name", "venue_name"]
#: Columns of a wide master that come from the file's path and place.
KEYS = ["client_name", "venue_name", "file_id", "row_id"]
#: Between the parts of a header in a pivot value; no cell text holds it.
SEPARATOR = "\x1f"


def client_dimension(df: DataFrame, client_col: str = "client_name", known: DataFrame | None = None) -> DataFrame:
    """``client_id`` (``C001``...) for each distinct client, in name order.

    ``known`` is an earlier dimension: its clients keep their ids, and new
    clients are numbered after the highest one, so an id never changes hands.
    """
    if known is None:
        ids = dense_ids(df, client_col, "_ord")
        return ids.select(F.format_string("C%03d", F.col("_ord")).alias("client_id"), F.col(client_col))
    last = known.agg(F.coalesce(F.max(F.substring("client_id", 2, 18).cast("long")), F.lit(0).cast("long"))).first()[0]
    ids = dense_ids(df.join(known, client_col, "left_anti"), client_col, "_ord")
    new = ids.select(F.format_string("C%03d", F.col("_ord") + last).alias("client_id"), F.col(client_col))
    return known.select("client_id", client_col).unionByName(new)


def with_client_ids(df: DataFrame, client_col: str = "client_name", dimension: DataFrame | None = None) -> DataFrame:
    """Attach ``client_id`` and put client id, client name, venue name first.

    The client dimension is one row per client; the join strategy (broadcast
    or shuffle) is left to adaptive execution, which sees its real size.
    """
    dim = client_dimension(df, client_col) if dimension is None else dimension
    joined = df.join(dim, on=client_col, how="left")
    first = [c for c in PRIORITY_COLUMNS if c in joined.columns]
    return joined.select(*first, *[c for c in df.columns if c not in first])


#: What names one column of a client, whatever file it comes from.
HEADER_KEY = ["client_name", "header_top", "header_sub", "nth"]


def client_dictionary(headers: DataFrame) -> DataFrame:
    """One row per client and column: header, identifier and unique name.

    Files of a client are united on the full header text, in the order in
    which columns first appear (file by path, then place), and names are made
    unique once on that list. Columns of a client bound its window.
    """
    first = headers.groupBy(*HEADER_KEY).agg(F.min(F.struct("file_id", "col_ord")).alias("_first"))
    order = Window.partitionBy("client_name").orderBy("_first", "header_top", "header_sub", "nth")
    listed = first.select(*HEADER_KEY, F.row_number().over(order).alias("col_ord"))
    return unique_names(with_identifiers(flatten(listed)), "client_name")


def named_answers(answers: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Long answers with the client's unique ``column_name``."""
    names = dictionary.select(*HEADER_KEY, F.col("unique_name").alias("column_name"))
    return answers.join(names, HEADER_KEY)


def pivot_client(answers: DataFrame, dictionary: DataFrame, client: str) -> DataFrame:
    """Wide master of one client: its own columns only, one row per survey row.

    The client's column list is metadata (bounded by its files' headers).
    Grouping is per survey row, so no group is larger than a row's cells. A
    column whose answers are Likert in every file that has any becomes a
    number; a survey column named like a path column gets a suffix instead
    of replacing it.
    """
    own = answers.where(F.col("client_name").eqNullSafe(F.lit(client)))
    listed = [(r["header_top"], r["header_sub"], r["nth"], r["unique_name"]) for r in
              dictionary.where(F.col("client_name").eqNullSafe(F.lit(client))).orderBy("col_ord").collect()]
    taken = unique_name_list([*KEYS, *[name for *_, name in listed]])[len(KEYS):]
    place = F.concat_ws(SEPARATOR, "header_top", "header_sub", F.col("nth").cast("string"))
    marks = [SEPARATOR.join((top, sub, str(nth))) for top, sub, nth, _ in listed]
    value = F.col("value")
    if "likert_score" in answers.columns:
        value = F.when(F.col("is_likert"), F.col("likert_score").cast("string")).otherwise(value)
    wide = (own.withColumn("_place", place).groupBy(*KEYS)
               .pivot("_place", marks).agg(F.first(value, ignorenulls=True)))
    return wide.toDF(*KEYS, *taken)


def likert_names(answers: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(client_name, column_name) of columns that are Likert wherever they have values."""
    held = answers.where(F.col("value").isNotNull()).groupBy(*HEADER_KEY).agg(F.bool_and("is_likert").alias("all_likert"))
    return (held.where("all_likert").join(dictionary, HEADER_KEY)
                .select("client_name", F.col("unique_name").alias("column_name")))
