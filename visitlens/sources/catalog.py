"""Catalog metadata as DataFrames.

``columns_frame`` lists ``(table_name, column_name, data_type)`` for named
frames or catalog tables (the information-schema view of the survey
tables); ``present_columns`` keeps the map rows whose column a table has, as
an equi-join on the column name (no per-table loop over the map).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("table_name", T.StringType()),
                       T.StructField("column_name", T.StringType()),
                       T.StructField("data_type", T.StringType())])


def columns_frame(spark: SparkSession, tables: dict[str, DataFrame] | list[str]) -> DataFrame:
    """One row per column of each table (schema metadata only, no data read)."""
    rows = []
    if isinstance(tables, dict):
        for name, df in tables.items():
            rows += [(name, f.name, f.dataType.simpleString()) for f in df.schema.fields]
    else:
        for name in tables:
            rows += [(name, c.name, c.dataType) for c in spark.catalog.listColumns(name)]
    return spark.createDataFrame(rows, SCHEMA)


def present_columns(columns: DataFrame, map_df: DataFrame) -> DataFrame:
    """Map rows (``..., column_name``) paired with each table that has the column."""
    return columns.select("table_name", "column_name").join(map_df, on="column_name", how="inner")


def read_client_masters(spark: SparkSession, path: str) -> DataFrame:
    """Client masters written by ``sinks.write_client_masters`` (partition-pruned by client).

    Clients have their own columns, so the schemas of all files are merged.
    """
    return spark.read.option("mergeSchema", "true").parquet(path)
