"""Survey file ingest: a folder of client folders -> long cells.

Layout: ``<root>/<client>/<venue file>.xlsx`` (two header rows). The files
are listed by Spark's ``binaryFile`` source (parallel listing, one record
per file) and decoded in ``mapInPandas``, one file at a time, into long
cells that carry their headers. CSV exports are read in splits that are
aligned to records (``split_csv``). Header drift between files is just more
rows; nothing is unioned per file.

Errors are data: a file that cannot be decoded yields one row with its
``error`` text, which ``split_errors`` routes to a quarantine frame while
the other files go on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby, islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlens.functions.text import flatten_header, is_footer_header, path_parent_name, path_stem, venue_from_stem
from visitlens.sources import split_csv
from visitlens.sources.decoders import CHUNK, cells_for, read_layout

#: Data cells carry their column's two header texts and their row's respondent,
#: and, in a master of earlier loads, their row's client and venue;
#: every column also has one record with row -1, so columns without answers
#: are known. ``nth`` numbers equal headers of one file, ``last_ord`` is the
#: file's last column.
CELL_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("row_id", T.LongType()),
    T.StructField("col_ord", T.IntegerType()),
    T.StructField("last_ord", T.IntegerType()),
    T.StructField("header_top", T.StringType()),
    T.StructField("header_sub", T.StringType()),
    T.StructField("nth", T.IntegerType()),
    T.StructField("respondent_id", T.StringType()),
    T.StructField("client", T.StringType()),
    T.StructField("venue", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("error", T.StringType()),
])


def list_files(spark: SparkSession, root: str, patterns: str = "*.{xlsx,csv}", anywhere: bool = False) -> DataFrame:
    """Survey files one folder below ``root`` (client folders only), or ``anywhere``."""
    files = (spark.read.format("binaryFile")
                  .option("pathGlobFilter", patterns)
                  .option("recursiveFileLookup", "true")
                  .load(root))
    return files if anywhere else in_client_folders(files, root)


def in_client_folders(files: DataFrame, root: str) -> DataFrame:
    """Keep files exactly two levels below the root (``root/<client>/<file>``).

    Listed paths carry a scheme that the root may lack, so the root's own path
    is what comes before the client folder, compared from its end.
    """
    own = re.sub(r"^[a-z][a-z0-9+.-]*:/*", "/", root).rstrip("/")
    return files.where(F.regexp_replace("path", r"/[^/]+/[^/]+$", "").endswith(own))


def _file_rows(path: str, content: bytes) -> Iterator[tuple]:
    # reading all of it first: a file that breaks anywhere yields nothing but its error
    layout = read_layout(cells_for(path, content))
    headers, last = layout.headers, max(layout.headers, default=-1)
    for col, (top, sub, nth) in headers.items():
        yield path, -1, col, last, top, sub, nth, None, None, None, None, None
    rows = groupby((c for c in cells_for(path, content) if c[0] >= layout.depth), key=lambda c: c[0])
    for row, cells in rows:
        values = {col: value for _, col, value in cells}
        keys = [values.get(c) if c is not None else None for c in (layout.respondent, layout.client, layout.venue)]
        for col, value in values.items():
            if col in headers:
                yield path, row - layout.depth, col, last, *headers[col], *keys, value, None


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            try:
                rows = _file_rows(path, bytes(content))
                while part := list(islice(rows, CHUNK)):
                    yield pd.DataFrame(part, columns=CELL_SCHEMA.fieldNames())
            except Exception as e:  # noqa: BLE001 - one bad file must not stop the others
                empty = dict.fromkeys(CELL_SCHEMA.fieldNames())
                yield pd.DataFrame([empty | {"path": path, "error": f"{type(e).__name__}: {e}"}])


def decode_cells(files: DataFrame) -> DataFrame:
    """Long cells (``CELL_SCHEMA``) of every file; one error row per bad file."""
    return files.select("path", "content").mapInPandas(_decode, CELL_SCHEMA)


def read_cells(spark: SparkSession, root: str, masters: bool = False) -> DataFrame:
    """Long cells of every survey file below ``root``: workbooks one file a task,
    CSV exports in record-aligned splits, however large a file is.

    With ``masters`` the files are those named ``..._master``, in any folder. Either
    may have one or two header rows; each file's first rows tell.
    """
    books, exports = ("*_master.xlsx", "*_master.csv") if masters else ("*.xlsx", "*.csv")
    found = split_csv.lines(spark, root, exports)
    return decode_cells(list_files(spark, root, books, anywhere=masters)).unionByName(
        split_csv.csv_cells(found if masters else in_client_folders(found, root)))


def split_errors(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good cells, quarantine) where quarantine lists ``path, error``."""
    bad = cells.where(F.col("error").isNotNull()).select("path", "error")
    good = cells.where(F.col("error").isNull()).drop("error")
    return good, bad


def without_footer(cells: DataFrame) -> DataFrame:
    """Cells and header records except those of a file's footer column.

    Each record knows its file's last column, so no window is needed.
    """
    footer = (F.col("col_ord") == F.col("last_ord")) & is_footer_header(flatten_header("header_top", "header_sub"))
    return cells.where(~F.coalesce(footer, F.lit(False)))


def header_cells(cells: DataFrame) -> DataFrame:
    """One row per file and column: keys, place and both header texts.

    The client is the file's folder; a master's columns belong to each client
    that its rows name.
    """
    records = without_footer(cells)
    columns = [F.col("path").alias("file_id"), "col_ord", "header_top", "header_sub", "nth"]
    found = records.where(F.col("row_id") == -1).select(path_parent_name("path").alias("client_name"), *columns)
    if "client" not in cells.columns:
        return found
    own = records.where((F.col("row_id") >= 0) & F.col("client").isNotNull()).select(F.col("client").alias("client_name"), *columns).distinct()
    return found.join(own.select("file_id").distinct(), "file_id", "left_anti").unionByName(own)


def answer_cells(cells: DataFrame) -> DataFrame:
    """Long answers: one row per answer cell with its header and row keys.

    ``client_name, venue_name, file_id, row_id, respondent_id, col_ord,
    header_top, header_sub, nth, header, value``. Client and venue are read
    from the path (in a master, from the row) and the header travels with the
    cell: no join, no shuffle.
    """
    def own(name: str) -> list:
        return [F.col(name)] if name in cells.columns else []

    return (without_footer(cells).where(F.col("row_id") >= 0)
            .select(F.coalesce(*own("client"), path_parent_name("path")).alias("client_name"),
                    F.coalesce(*own("venue"), venue_from_stem(path_stem("path"))).alias("venue_name"),
                    F.col("path").alias("file_id"), "row_id", "respondent_id", "col_ord", "header_top",
                    "header_sub", "nth", flatten_header("header_top", "header_sub").alias("header"), "value"))
