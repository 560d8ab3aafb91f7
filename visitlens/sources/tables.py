"""Parquet table access.

Reads are lazy: Catalyst prunes the columns each plan needs into the
parquet ``ReadSchema`` and pushes filters into ``PushedFilters``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

STAR_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    path = os.path.join(sf_dir, f"{name}.parquet")
    return path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))
