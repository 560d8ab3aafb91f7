"""Every client's wide master in one pass.

``Masters.client`` pivots one client over its own columns, which scans the
answers once a client. Here the answers are recoded while they are long, each
survey row is put together once (one shuffle by row), and one job writes all
clients: every task holds runs of one client's rows, led by a record with that
client's column names and types, and writes files with that client's own
columns. Jobs and scans do not grow with the number of clients.

The write is a snapshot (``sinks.snapshot``): all clients are replaced
together, or none.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource

from visitlens import config
from visitlens.functions import recode as R
from visitlens.functions.text import identifier
from visitlens.operators.headers import unique_names
from visitlens.plans import master as M
from visitlens.session import ensure_checkpoint_dir
from visitlens.sinks import snapshot

FORMAT = "client_masters"
#: Survey rows of one client that one task writes.
ROWS_PER_FILE = 200_000
LEAD = ["client_id", "client_name", "venue_name"]
KINDS = {"text": pa.string(), "double": pa.float64(), "flag": pa.int32(), "int": pa.int32(), "bigint": pa.int64(), "date": pa.date32()}
SPARK_KINDS = {"text": T.StringType(), "double": T.DoubleType(), "flag": T.IntegerType(), "int": T.IntegerType(),
               "bigint": T.LongType(), "date": T.DateType()}
_KIND_OF = {"double": "double", "int": "int", "bigint": "bigint", "date": "date", "string": "text"}

#: Recoders by name, the first whose columns match is taken (as the last one wins in ``recode_survey``).
RECODERS = {
    "guests": R.guest_count, "spend": R.spend_amount, "time": R.arrival_time, "date": R.day_first_date, "flag": R.checkbox_flag,
    "gender": R.gender, **{f"speed{i}": (lambda m: lambda c: R.speed_score(c, m))(m) for i, m in enumerate(config.SPEED_COLUMN_MAPS.values())},
    "recommendation": R.recommendation_score, "identity": R.text_identity,
}


def _is(name: Column, raw_names) -> Column:
    return name.isin(*raw_names, *[identifier(n, config.MAX_IDENTIFIER_LEN) for n in raw_names])


def recoder_of(name: Column) -> Column:
    """Name of the recoder that ``recode_survey`` applies to a column, or null."""
    prefixes = [*config.CHECKBOX_PREFIXES, *[identifier(p, config.MAX_IDENTIFIER_LEN) for p in config.CHECKBOX_PREFIXES]]
    tests = {
        "guests": _is(name, [config.GUESTS_COLUMN]),
        "spend": _any([F.contains(name, F.lit(p)) for p in config.SPEND_NAME_PARTS]),
        "time": _all([F.contains(name, F.lit(p)) for p in config.TIME_NAME_PARTS]),
        "date": _is(name, [config.DATE_COLUMN]),
        "flag": _any([F.startswith(name, F.lit(p)) for p in prefixes]),
        "gender": _is(name, [config.GENDER_COLUMN]),
        **{f"speed{i}": _is(name, [raw]) for i, raw in reversed(list(enumerate(config.SPEED_COLUMN_MAPS)))},
        "recommendation": _is(name, config.RECOMMENDATION_COLUMNS),
        "identity": _is(name, config.TEXT_IDENTITY_COLUMNS),
    }
    out = None
    for recoder, test in tests.items():
        out = F.when(test, recoder) if out is None else out.when(test, recoder)
    return out


def _any(tests: list[Column]) -> Column:
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out


def _all(tests: list[Column]) -> Column:
    out = F.lit(True)
    for t in tests:
        out = out & t
    return out


def _recoded(spark: SparkSession, value: Column, recoder: Column) -> tuple[Column, dict[str, str]]:
    """``value`` as ``recoder`` has it, as text; and the kind of each recoder's result."""
    probe = spark.range(0).select(*[fn(F.lit("x")).alias(n) for n, fn in RECODERS.items()])
    kinds = {f.name: _KIND_OF[f.dataType.simpleString()] for f in probe.schema} | {"flag": "flag"}
    out = None
    for name, fn in RECODERS.items():
        made = fn(value).cast("string")
        out = F.when(recoder == name, made) if out is None else out.when(recoder == name, made)
    return out.otherwise(value), kinds


def client_columns(masters) -> DataFrame:
    """One row per client and column: header key, place, name, recoder, kind."""
    own = masters.dictionary.select(*M.HEADER_KEY, "col_ord", F.col("unique_name").alias("identifier"), "unique_name")
    keys = masters.clients.select("client_name", F.posexplode(F.array(*[F.lit(k) for k in M.KEYS])).alias("_n", "identifier"))
    none = F.lit(None).cast("string")
    keys = keys.select("client_name", none.alias("header_top"), none.alias("header_sub"), F.lit(None).cast("int").alias("nth"),
                       (F.col("_n") - len(M.KEYS)).alias("col_ord"), "identifier", none.alias("unique_name"))
    # a survey column named like a path column gets a suffix
    both = own.withColumnRenamed("unique_name", "own_name").unionByName(keys.withColumnRenamed("unique_name", "own_name"))
    named = unique_names(both, "client_name").where(F.col("col_ord") >= 0)
    _, kinds = _recoded(masters.answers.sparkSession, F.lit("x"), F.lit("x"))
    kind_map = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    recoder = recoder_of(F.col("unique_name")) if masters.recode else none
    all_likert = M.likert_names(masters.answers, masters.dictionary).select(
        "client_name", F.col("column_name").alias("unique_name"), F.lit(True).alias("all_likert"))
    out = named.withColumn("recoder", recoder).join(all_likert, ["client_name", "unique_name"], "left")
    number = F.coalesce("all_likert", F.lit(False)) & F.lit(masters.recode)
    kind = F.when(number, "double").otherwise(F.coalesce(F.element_at(kind_map, F.coalesce("recoder", F.lit(""))), F.lit("text")))
    # a column whose type differs between clients is text, as in one frame of all of them
    placed = out.select(*M.HEADER_KEY, "col_ord", "unique_name", "recoder", number.alias("number"), kind.alias("own_kind"))
    width = Window.partitionBy("client_name").orderBy("col_ord")
    shared = placed.groupBy("unique_name").agg(F.count_distinct("own_kind").alias("_kinds"))
    plain = F.when(F.col("own_kind") == "flag", "int").otherwise(F.col("own_kind"))
    return placed.join(shared, "unique_name").select(
        *M.HEADER_KEY, (F.row_number().over(width) - 1).alias("place"), F.col("unique_name").alias("name"), "recoder", "number",
        F.when(F.col("_kinds") == 1, F.col("own_kind")).otherwise(F.when(F.col("own_kind") == "flag", "flag_text").otherwise("text")).alias("kind"),
        plain.alias("value_kind"))


def survey_rows(masters, columns: DataFrame) -> DataFrame:
    """client_id, client_name, venue_name, row, cells: one row per survey row, with
    (place, value) of its cells, recoded while they are long."""
    spark = masters.answers.sparkSession
    value = F.when(F.col("is_likert"), F.col("likert_score").cast("string")).otherwise(F.col("value"))
    if masters.recode:
        made, _ = _recoded(spark, F.col("_value"), F.col("recoder"))
        made = F.when(F.col("number"), made.try_cast("double").cast("string")).otherwise(made)
    else:
        made = F.col("_value")
    named = masters.answers.withColumn("_value", value).join(columns, M.HEADER_KEY)
    cells = named.select(*M.KEYS, F.struct("place", made.alias("value")).alias("cell"))
    rows = cells.groupBy(*M.KEYS).agg(F.collect_list("cell").alias("cells"))
    return rows.join(masters.clients, "client_name", "left").select(
        "client_id", "client_name", "venue_name", F.xxhash64("file_id", "row_id").alias("row"), "cells")


def _schema(names: list[str], kinds: list[str]) -> pa.Schema:
    return pa.schema([(n, pa.string()) for n in LEAD] + [(n, _arrow_kind(k)) for n, k in zip(names, kinds, strict=True)])


def _arrow_kind(kind: str) -> pa.DataType:
    return KINDS["text" if kind == "flag_text" else kind]


def _run_table(schema: pa.Schema, kinds: list[str], batch: pa.RecordBatch) -> pa.Table:
    """Rows of one client as a table with its own columns."""
    cells = batch.column("cells")
    row, flat = pc.list_parent_indices(cells).to_numpy(), cells.flatten()
    place, value = flat.field(0).to_numpy(zero_copy_only=False), flat.field(1).to_numpy(zero_copy_only=False)
    order = np.argsort(place, kind="stable")
    bounds = np.searchsorted(place[order], np.arange(len(kinds) + 1))
    out = [batch.column(n).cast(pa.string()) for n in LEAD]
    for i, kind in enumerate(kinds):
        own = order[bounds[i]:bounds[i + 1]]
        # a checkbox that a row does not have is not ticked
        texts = np.full(batch.num_rows, "0" if kind.startswith("flag") else None, object)
        texts[row[own]] = value[own]
        out.append(pa.array(texts, pa.string()).cast(_arrow_kind(kind)))
    return pa.Table.from_arrays(out, schema=schema)


class MastersWriter(snapshot.SnapshotWriter):
    """Files of one client each, with that client's columns."""

    def write(self, iterator: Iterator[pa.RecordBatch]) -> snapshot.Staged:
        store, root = snapshot._open(self.path)
        done: list[dict] = []
        out = schema = kinds = None
        try:
            for batch in iterator:
                heads, at = batch.column("kinds").is_valid().to_numpy(zero_copy_only=False), 0
                while at < batch.num_rows:
                    if heads[at]:
                        if out is not None:
                            out.close()
                        head = batch.slice(at, 1).to_pylist()[0]
                        names, kinds = json.loads(head["names"]), json.loads(head["kinds"])
                        schema, path = _schema(names, kinds), self.part(store, root)
                        out = pq.ParquetWriter(f"{root}/{path}", schema, filesystem=store)
                        done.append({"path": path, "rows": 0, "client": head["client_name"], "columns": [*LEAD, *names],
                                     "kinds": ["text"] * len(LEAD) + ["text" if k == "flag_text" else k for k in kinds]})
                        at += 1
                        continue
                    stop = at + int(np.argmax(heads[at:])) if heads[at:].any() else batch.num_rows
                    out.write_table(_run_table(schema, kinds, batch.slice(at, stop - at)))
                    done[-1]["rows"] += stop - at
                    at = stop
        except BaseException:
            if out is not None:
                out.close()
            for f in done:
                store.delete_file(f"{root}/{f['path']}")
            raise
        if out is not None:
            out.close()
        return snapshot.Staged(done)


class ClientMasters(DataSource):
    """Write-only source of ``write_masters``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> MastersWriter:
        return MastersWriter(self.options["path"], schema, overwrite)


def write_masters(masters, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Writes the wide masters of all clients as one snapshot at ``path``."""
    spark = masters.answers.sparkSession
    ensure_checkpoint_dir(spark)
    columns = client_columns(masters).checkpoint(eager=True)
    rows = survey_rows(masters, columns).checkpoint(eager=True)
    parts = rows.groupBy("client_name").agg(F.ceil(F.count(F.lit(1)) / rows_per_file).cast("int").alias("parts"))
    listed = columns.groupBy("client_name").agg(F.sort_array(F.collect_list(F.struct("place", "name", "kind"))).alias("c"))
    heads = listed.join(parts, "client_name", "left").select(
        "client_name", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"),
        F.to_json("c.name").alias("names"), F.to_json("c.kind").alias("kinds"))
    none, salt = F.lit(None).cast("string"), F.pmod(F.col("row"), F.col("parts")).cast("int")
    dealt = rows.join(parts, "client_name").select(
        *LEAD, salt.alias("part"), none.alias("names"), none.alias("kinds"), "cells")
    empty = F.lit(None).cast(rows.schema["cells"].dataType)
    heads = heads.select(none.alias("client_id"), "client_name", none.alias("venue_name"), "part", "names", "kinds", empty.alias("cells"))
    spark.dataSource.register(ClientMasters)
    runs = dealt.unionByName(heads).repartition("client_name", "part").sortWithinPartitions("client_name", "part", F.col("kinds").isNull())
    runs.write.format(FORMAT).mode("overwrite").save(path)


def read_masters(spark: SparkSession, path: str, client: str | None = None) -> DataFrame:
    """The masters of all clients in one frame, or one client's with its own columns.

    The manifest knows every file's client and columns, so no file is opened to
    plan the read, and one client's read opens its own files only.
    """
    found = snapshot.Manifests(path).current()
    if found is None:
        raise ValueError(f"no masters at {path}")
    files = [f for f in found["files"] if client is None or f["client"] == client]
    fields: dict[str, str] = {}
    for f in files:
        for name, kind in zip(f["columns"], f["kinds"], strict=True):
            fields.setdefault(name, kind)
    schema = T.StructType([T.StructField(n, SPARK_KINDS[k]) for n, k in fields.items()] or [T.StructField(n, T.StringType()) for n in LEAD])
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{f['path']}" for f in files])
