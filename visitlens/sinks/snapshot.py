"""Crash-safe table refresh as a Spark data source.

``df.write.format("snapshot_table").mode("overwrite").save(path)`` replaces a
table, ``append`` adds to it. Tasks stage Parquet files in a folder of the job;
only the driver's commit makes them the table, by one small manifest file that is
moved into place. Readers take the newest manifest, so they see the old rows or
the new ones, never a part of either; a task that fails, a lost executor or a
driver that dies before the commit leaves the table as it was. Attempts that lost
a race are in no manifest. The last ``KEEP`` snapshots stay on disk for readers
that began before a refresh.

The folder must be one that ``pyarrow.fs`` can open from every executor (shared
files, or a store by its URI). An empty frame gives an empty table.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

FORMAT = "snapshot_table"
KEEP = 2


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """File system and plain path of a URI or of a local path."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return fs.LocalFileSystem(), path


class Manifests:
    """The numbered manifests of one table."""

    def __init__(self, path: str):
        self.fs, self.root = _open(path)

    def names(self) -> list[str]:
        found = self.fs.get_file_info(fs.FileSelector(f"{self.root}/manifests", allow_not_found=True))
        return sorted(i.base_name for i in found if i.base_name.endswith(".json"))

    def read(self, name: str) -> dict:
        with self.fs.open_input_stream(f"{self.root}/manifests/{name}") as f:
            return json.loads(f.read())

    def current(self) -> dict | None:
        names = self.names()
        return self.read(names[-1]) if names else None

    def add(self, manifest: dict, job: str) -> None:
        """Makes ``manifest`` the table: one move, after which readers see it."""
        names = self.names()
        number = int(names[-1].split("-")[0]) + 1 if names else 1
        self.fs.create_dir(f"{self.root}/manifests")
        staged = f"{self.root}/manifests/.{job}.tmp"
        with self.fs.open_output_stream(staged) as f:
            f.write(json.dumps(manifest).encode())
        self.fs.move(staged, f"{self.root}/manifests/{number:012d}-{job}.json")

    def drop_old(self, keep: int = KEEP) -> None:
        """Removes all but the last ``keep`` snapshots and the files that only they name."""
        names = self.names()
        old, left = names[:-keep], names[-keep:]
        used = {f["path"] for n in left for f in self.read(n)["files"]}
        gone = {f["path"] for n in old for f in self.read(n)["files"]} - used
        for n in old:
            self.fs.delete_file(f"{self.root}/manifests/{n}")
        for path in gone:
            self.fs.delete_file(f"{self.root}/{path}")

    def vacuum(self, older_than: float = 86_400.0) -> None:
        """Removes job folders that no manifest names and that are older than so many
        seconds: what tasks wrote after their job had failed, or a driver that died left."""
        used = {f["path"].split("/")[1] for n in self.names() for f in self.read(n)["files"]}
        for info in self.fs.get_file_info(fs.FileSelector(f"{self.root}/data", allow_not_found=True)):
            if info.base_name not in used and time.time() - info.mtime.timestamp() >= older_than:
                self.fs.delete_dir(info.path)


@dataclass
class Staged(WriterCommitMessage):
    """Files that one task has written: path below the table, rows, and what they hold."""

    files: list = field(default_factory=list)


class SnapshotWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: T.StructType, overwrite: bool):
        self.path, self.schema, self.overwrite = path, schema, overwrite
        self.job = uuid.uuid4().hex

    def part(self, store: fs.FileSystem, root: str) -> str:
        """Path below the table of a new file of this job."""
        store.create_dir(f"{root}/data/{self.job}")
        return f"data/{self.job}/{uuid.uuid4().hex}.parquet"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        store, root = _open(self.path)
        out, name, rows = None, None, 0
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if out is None:
                    name = self.part(store, root)
                    out = pq.ParquetWriter(f"{root}/{name}", batch.schema, filesystem=store)
                out.write_batch(batch)
                rows += batch.num_rows
        except BaseException:
            if out is not None:
                out.close()
                store.delete_file(f"{root}/{name}")
            raise
        if out is None:
            return Staged([])
        out.close()
        return Staged([{"path": name, "rows": rows}])

    def commit(self, messages: list) -> None:
        table = Manifests(self.path)
        files = [f for m in messages if m is not None for f in m.files]
        before = table.current()
        if not self.overwrite and before:
            if json.loads(before["schema"]) != json.loads(self.schema.json()):
                self.abort(messages)
                raise ValueError("appended rows have other columns than the table")
            files = before["files"] + files
        table.add({"schema": self.schema.json(), "files": files}, self.job)
        table.drop_old()

    def abort(self, messages: list) -> None:
        store, root = _open(self.path)
        staged = f"{root}/data/{self.job}"
        if store.get_file_info(staged).type == fs.FileType.Directory:
            store.delete_dir(staged)


class SnapshotReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path
        found = Manifests(path).current()
        self.files = [f["path"] for f in found["files"]] if found else []

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(f) for f in self.files] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is not None:
            store, root = _open(self.path)
            with store.open_input_file(f"{root}/{partition.value}") as f:
                yield from pq.ParquetFile(f).iter_batches()


class SnapshotTable(DataSource):
    """Tables of numbered snapshots; option ``path`` is the table's folder."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        found = Manifests(self.options["path"]).current()
        if found is None:
            raise ValueError(f"no table at {self.options['path']}")
        return T.StructType.fromJson(json.loads(found["schema"]))

    def reader(self, schema: T.StructType) -> SnapshotReader:
        return SnapshotReader(self.options["path"])

    def writer(self, schema: T.StructType, overwrite: bool) -> SnapshotWriter:
        return SnapshotWriter(self.options["path"], schema, overwrite)


def refresh(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Replaces (or appends to) the table at ``path``; a failure leaves it as it was."""
    df.sparkSession.dataSource.register(SnapshotTable)
    df.write.format(FORMAT).mode(mode).save(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The newest snapshot, by Spark's own Parquet reader (pruned and pushed down).

    The frame names its files, so a refresh does not change what it reads.
    """
    table = Manifests(path)
    found = table.current()
    if found is None:
        raise ValueError(f"no table at {path}")
    schema = T.StructType.fromJson(json.loads(found["schema"]))
    if not found["files"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{f['path']}" for f in found["files"]])


def exists(path: str) -> bool:
    return Manifests(path).current() is not None
