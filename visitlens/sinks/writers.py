"""Sinks: partitioned parquet, catalog tables (staged refresh) and JDBC.

Connection settings (URL, user, password) are never literals here: they
come from the caller or from environment variables named by the caller.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlens.functions.text import identifier, table_name_for
from visitlens.operators.profile import to_long
from visitlens.operators.reshape import same_types
from visitlens.operators.value_types import column_types as column_types_of
from visitlens.operators.value_types import typed_columns, with_inferred_types


def write_client_masters(df: DataFrame, path: str, client_col: str = "client_name") -> None:
    """One parquet partition per client; rewriting a client replaces only its partition."""
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(client_col)
       .parquet(path))


def write_each_client(masters, path: str, client_col: str = "client_name") -> None:
    """Each (client, wide master) into its own partition, with its own columns.

    ``masters`` yields pairs; every client is one distributed job. Read them
    back with ``sources.catalog.read_client_masters``, which merges schemas; a
    column whose type differs between clients is written as text.
    """
    for df in same_types([df for _, df in masters]):
        write_client_masters(df, path, client_col)


def save_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    """Full refresh (``overwrite``, schema replaced) or ``append`` to a catalog table.

    A refresh is staged: the rows go to a table of their own, and only when all
    of them are written do the tables change names. A write that fails leaves
    the old table, and an empty frame leaves an empty one. The old table is kept
    under another name until the new one has its place.
    """
    spark = df.sparkSession
    if mode != "overwrite":
        df.write.mode(mode).saveAsTable(name)
        return
    mark = uuid.uuid4().hex
    staged, old = f"{name}__new_{mark}", f"{name}__old_{mark}"
    try:
        df.write.saveAsTable(staged)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    replaces = spark.catalog.tableExists(name)
    if replaces:
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    except Exception:
        if replaces:
            spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    if replaces:
        spark.sql(f"DROP TABLE {old}")


def prepare_for_sql(df: DataFrame) -> DataFrame:
    """Database-ready frame: unique, safe, <= 63-character column names and
    no floating NaN (NaN becomes NULL). Renaming uses the column list only.
    """
    from visitlens.operators.headers import unique_name_list

    names = unique_name_list([identifier(c) for c in df.columns])
    renamed = df.toDF(*names)  # positional: source names may differ only by case
    cols = []
    for field in renamed.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c).alias(field.name)
        cols.append(c)
    return renamed.select(*cols)


def sql_type(dt: T.DataType) -> str:
    """Database column type for a Spark type (integers, floats, timestamps, else text)."""
    if isinstance(dt, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return "BIGINT"
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return "DOUBLE PRECISION"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "TIMESTAMP"
    return "TEXT"


#: Names by which Spark's JDBC writer accepts the types of ``sql_type``.
JDBC_TYPES = {"BIGINT": "BIGINT", "DOUBLE PRECISION": "DOUBLE", "TIMESTAMP": "TIMESTAMP", "TEXT": "STRING"}


def column_types(df: DataFrame) -> str:
    """Column list of a database ``CREATE TABLE`` for this frame (DDL text)."""
    return ", ".join(f'"{f.name}" {sql_type(f.dataType)}' for f in df.schema.fields)


def typed_for_sql(df: DataFrame) -> DataFrame:
    """Dates as timestamps and booleans as text, the forms of them that ``sql_type`` knows."""
    def one(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            return column.cast("timestamp").alias(field.name)
        return column.cast("string").alias(field.name) if isinstance(field.dataType, T.BooleanType) else column

    return df.select(*[one(f) for f in df.schema.fields])


def jdbc_write(df: DataFrame, table: str, url: str | None = None, url_env: str = "VISITLENS_JDBC_URL",
               user_env: str = "VISITLENS_JDBC_USER", password_env: str = "VISITLENS_JDBC_PASSWORD",
               mode: str = "overwrite", batch_size: int = 10_000, num_partitions: int = 8, infer: bool = True) -> None:
    """Write a table over JDBC in parallel batches.

    ``overwrite`` drops and re-creates the table, ``append`` adds rows; an
    empty frame writes no rows. A created table gets the column types of
    ``sql_type``, text columns by the type of their values (``infer``; not on
    ``append``, where the table has its types).
    """
    if infer and mode == "overwrite":
        df = with_inferred_types(df)
    df = typed_for_sql(df)
    url = url or os.environ[url_env]
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size),
            "numPartitions": str(num_partitions)}
    if mode == "overwrite":
        # JDBC sources parse this with Spark's type names
        opts["createTableColumnTypes"] = ", ".join(
            f"`{f.name}` {JDBC_TYPES[sql_type(f.dataType)]}" for f in df.schema.fields)
    if os.environ.get(user_env):
        opts["user"] = os.environ[user_env]
    if os.environ.get(password_env):
        opts["password"] = os.environ[password_env]
    df.write.format("jdbc").options(**opts).mode(mode).save()


STATUS_SCHEMA = T.StructType([T.StructField("table", T.StringType()),
                              T.StructField("ok", T.BooleanType()),
                              T.StructField("error", T.StringType())])


def write_each(spark: SparkSession, tables, writer) -> DataFrame:
    """Write each named table; one failure is recorded and the others go on.

    ``tables`` is a dict or a list of (name, frame); a name that occurs twice
    is an error of every table that has it, and none of them is written.
    Returns a status frame ``table, ok, error``.
    """
    pairs = list(tables.items()) if isinstance(tables, dict) else list(tables)
    uses = Counter(name for name, _ in pairs)
    rows = []
    for name, df in pairs:
        if uses[name] > 1:
            rows.append((name, False, f"{uses[name]} tables have this name; none was written"))
            continue
        try:
            writer(name, df)
            rows.append((name, True, None))
        except Exception as e:  # noqa: BLE001 - per-table isolation
            rows.append((name, False, f"{type(e).__name__}: {e}"))
    return spark.createDataFrame(rows, STATUS_SCHEMA)


def client_column_types(masters: DataFrame, client_col: str = "client_name") -> dict:
    """Client -> {text column: type of that client's values}: one aggregate for all."""
    names = [c for c, kind in masters.dtypes if kind == "string" and c != client_col]
    if not names:
        return {}
    found = column_types_of(to_long(masters, names, [client_col]), [client_col, "column_name"]).collect()
    out: dict = {}
    for r in found:
        out.setdefault(r[client_col], {})[r["column_name"]] = r["value_type"]
    return out


def write_client_tables(spark: SparkSession, masters: DataFrame, writer,
                        client_col: str = "client_name", infer: bool = True) -> DataFrame:
    """Load each client's master as its own table (``<client>_master``).

    Client names are metadata (one row per client); each table is written
    by its own distributed job over the client's rows, after names are made
    database-safe (``prepare_for_sql``). With ``infer`` a client's text columns
    get the type of their values. Two clients whose names clean to one
    table name are both reported and not written. Returns the status frame.
    """
    types = client_column_types(masters, client_col) if infer else {}
    names = (masters.select(client_col).distinct()
                    .select(F.col(client_col), table_name_for(F.col(client_col)).alias("t")).collect())
    tables = [(r["t"], prepare_for_sql(typed_columns(masters.where(F.col(client_col).eqNullSafe(r[client_col])),
                                                     types.get(r[client_col], {})))) for r in names]
    return write_each(spark, tables, writer)
