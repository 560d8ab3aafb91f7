"""CSV exports read in splits that are aligned to records.

Spark's text source cuts large files into splits of whole lines. A record may
hold line breaks inside quotes, so a split alone cannot tell whether its first
line starts a record. Three steps find out without reading a file from its
start:

1. every split reports, for both possible states at its first line (between
   records, or inside quotes), the state after its last line and how many
   records start in it;
2. a prefix over the splits of a file (one small row each) picks the true state
   and numbers the records;
3. every split decodes its own records. What belongs to a record that crosses
   a split bound is passed on as a piece, and the pieces of one record meet.

The result equals ``decoders.csv_cells`` on the whole file. A file is taken
whole or rejected: one bad record (a field above ``decoders.FIELD_LIMIT``, say)
anywhere gives an error row and no cells.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.session import ensure_checkpoint_dir
from visitlens.sources.decoders import CHUNK, FIELD_LIMIT, layout_of

#: Both header rows must end within so many bytes of a file's start.
HEADER_BYTES = 1 << 20
#: Decoded lines that a task holds before it hands on their cells.
READY_BYTES = 1 << 20
#: Rows of a table that may be broadcast (splits, header cells).
BROADCAST_ROWS = 200_000

_SCANNED = ("path string, start bigint, size bigint, n_bytes bigint, out0 int, rows0 bigint, open0 bigint, "
            "out1 int, rows1 bigint, open1 bigint, head binary, cut boolean")
_PLACED = ("path string, start bigint, state int, first_row bigint, owner bigint, owner_row bigint, last boolean, bare boolean, "
           "respondent int, client int, venue int")
_DECODED = ("path string, row_id bigint, col_ord int, respondent_id string, client_name string, venue_name string, value string, "
            "error string, owner bigint, start bigint, piece binary")
_HEADS = ("path string, col_ord int, last_ord int, header_top string, header_sub string, nth int, depth int, respondent int, "
          "client int, venue int, error string")
KEYS = ("respondent", "client", "venue")


def lines(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """(path, size, start, raw): lines of all files below ``root``, with the start
    of the split that read them. Lines of a split follow each other."""
    found = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
             .option("lineSep", "\n").text(root))
    # the metadata column holds an encoded URI, the binary source a plain path
    plain = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return found.select(
        F.regexp_replace(plain, "^file:///", "file:/").alias("path"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("raw"))


def step(line: bytes, state: int) -> tuple[int, int]:
    """(state after ``line``, records that start in it); state 1 is inside quotes.

    The csv module itself is asked: a mark on the next line is a record of its
    own exactly when the line leaves no quote open.
    """
    if b'"' not in line:
        if state or b"\r" not in line[:-1]:
            return state, 1 - state
    text = ('"' if state else "") + line.decode("utf-8", "replace") + "\nx\n"
    limit = csv.field_size_limit(len(text) + 1)
    try:
        rows = list(csv.reader(io.StringIO(text, newline="")))
    finally:
        csv.field_size_limit(limit)
    closed = rows[-1] == ["x"]
    return int(not closed), len(rows) - closed - state


def records(found: list[bytes], bare: bool = False) -> Iterator[list[str]]:
    """Records of whole lines, as the csv module reads them from one text;
    ``bare``: the last line has no line break."""
    def parts() -> Iterator[str]:
        for n, line in enumerate(found, 1):
            text = line.decode("utf-8", "replace") + ("" if bare and n == len(found) else "\n")
            if "\r" in text:
                yield from io.StringIO(text, newline="")
            else:
                yield text

    limit = csv.field_size_limit(FIELD_LIMIT)
    try:
        yield from csv.reader(parts())
    finally:
        csv.field_size_limit(limit)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[bytes]]]:
    """(columns of the first row, lines) of each split in a partition."""
    pending: list = []

    def rows() -> Iterator[tuple[tuple, pa.RecordBatch, int]]:
        for batch in batches:
            at, names = 0, batch.schema.names
            paths, starts = batch.column(names.index("path")).to_pylist(), batch.column(names.index("start")).to_pylist()
            raw = batch.column(names.index("raw")).to_pylist()
            for at in range(batch.num_rows):
                yield (paths[at], starts[at]), batch, at, raw[at]

    source = rows()

    def of(key: tuple, first: tuple) -> Iterator[bytes]:
        yield first[3]
        for row in source:
            if row[0] != key:
                pending.append(row)
                return
            yield row[3]

    while first := pending.pop() if pending else next(source, None):
        key, batch, at, _ = first
        columns = {n: batch.column(i)[at].as_py() for i, n in enumerate(batch.schema.names) if n != "raw"}
        own = of(key, first)
        yield columns, own
        for _ in own:  # what the caller left unread
            pass


def scanned(found: DataFrame) -> DataFrame:
    """One row per split: its effect for both states, and the lines a header may need."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, own in _chunks(batches):
            state, rows, open_at, n_bytes, head, room = [0, 1], [0, 0], [None, None], 0, [], HEADER_BYTES - columns["start"]
            cut = False
            for line in own:
                n_bytes += len(line) + 1
                if room > 0:
                    head.append(line)
                    room -= len(line) + 1
                else:
                    cut = True
                for s in (0, 1):
                    was = state[s]
                    state[s], more = step(line, was)
                    if state[s] and not was:
                        open_at[s] = rows[s]
                    rows[s] += more
            whole = b"".join(line + b"\n" for line in head) if columns["start"] < HEADER_BYTES else None
            row = [columns["path"], columns["start"], columns["size"], n_bytes, state[0], rows[0], open_at[0], state[1], rows[1],
                   open_at[1], whole, cut]
            yield pa.RecordBatch.from_pylist([dict(zip(_names(_SCANNED), row, strict=True))], _arrow(_SCANNED))

    return found.mapInArrow(run, _SCANNED)


def _is_bare(n_bytes: int, size: int) -> bool:
    """Whether a file ends without a line break, from the bytes of its lines (each
    with one); the source has taken off a byte order mark of three bytes."""
    return n_bytes - size in (1, -2)


def _names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(", ")]


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(part.split()[0], kinds[part.split()[1]]) for part in ddl.split(", ")])


def _table(rows: list[tuple], ddl: str) -> pa.Table:
    names, schema = _names(ddl), _arrow(ddl)
    return pa.Table.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema)


def heads(splits: DataFrame) -> DataFrame:
    """Header cells of each file, or its error, from the first bytes of its splits."""
    def run(table: pa.Table) -> pa.Table:
        parts = sorted(table.select(["start", "head", "cut"]).to_pylist(), key=lambda r: r["start"])
        path, text, cut, more = table.column("path")[0].as_py(), [], False, table.column("more")[0].as_py()
        bare = _is_bare(pc.sum(table.column("n_bytes")).as_py(), table.column("size")[0].as_py())
        for part in parts:
            if not cut:
                text += part["head"].split(b"\n")[:-1]
                cut = part["cut"]
        top: list[list[str]] = []

        def error(text: str) -> pa.Table:
            return _table([(path, *[None] * 9, text)], _HEADS)

        try:
            for row in records(text, bare and not cut and not more):
                top.append(row)
                if len(top) == 3:
                    break
        except csv.Error as e:
            return error(f"Error: {e}")
        if len(top) < 3 and (cut or more):
            return error(f"header rows longer than {HEADER_BYTES} bytes")
        found = layout_of({r: {c: v if v != "" else None for c, v in enumerate(row)} for r, row in enumerate(top[:2])})
        last, keys = max(found.headers, default=-1), (found.respondent, found.client, found.venue)
        return _table([(path, c, last, *header, found.depth, *keys, None) for c, header in found.headers.items()], _HEADS)

    whole = splits.groupBy("path").agg(F.max("start").alias("_end"))
    first = splits.where(F.col("head").isNotNull()).join(whole, "path")
    return first.withColumn("more", F.col("_end") >= HEADER_BYTES).groupBy("path").applyInArrow(run, _HEADS)


def placed(splits: DataFrame, keys: DataFrame) -> DataFrame:
    """The true state and first record number of every split (``_PLACED``)."""
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["start"])
        bare = _is_bare(sum(r["n_bytes"] for r in rows), rows[0]["size"])
        state, first, owner, owner_row, out = 0, 0, None, None, []
        for r in rows:
            out.append((r["path"], r["start"], state, first, owner, owner_row, r is rows[-1], bare, *[r[k] for k in KEYS]))
            after, n, open_at = r[f"out{state}"], r[f"rows{state}"], r[f"open{state}"]
            if after and open_at is not None:
                owner, owner_row = r["start"], first + open_at
            elif not after:
                owner = owner_row = None
            first, state = first + n, after
        return _table(out, _PLACED)

    both = splits.drop("head", "cut").join(keys, "path", "left")
    return both.groupBy("path").applyInArrow(run, _PLACED)


def _cells(path: str, row: int, found: list[bytes], keys: list[int | None], bare: bool = False) -> Iterator[tuple]:
    for n, record in enumerate(records(found, bare), row):
        own = [record[k] or None if k is not None and k < len(record) else None for k in keys]
        for c, v in enumerate(record):
            yield path, n, c, *own, (v if v != "" else None), None, None, None, None


def _bad(path: str, error: Exception | str) -> tuple:
    text = error if isinstance(error, str) else f"{type(error).__name__}: {error}"
    return path, *[None] * 6, text, None, None, None


def _piece(path: str, row: int, owner: int, start: int, data: bytes) -> tuple:
    return path, row, *[None] * 6, owner, start, data


def _split_rows(columns: dict, own: Iterator[bytes]) -> Iterator[tuple]:
    """Cells of the records within a split, and pieces of those that cross its bounds."""
    path, keys, state, row = columns["path"], [columns[k] for k in KEYS], columns["state"], columns["first_row"]
    ready: list[bytes] = []
    ready_bytes = ready_rows = quiet = opened_rows = 0
    opened: list[bytes] = []
    head = bool(state)  # the lines in ``opened`` continue a record of an earlier split
    for line in own:
        before = state
        state, n = step(line, state)
        quiet = quiet + len(line) + 1 if before and state and b'"' not in line else 0
        if quiet > 4 * FIELD_LIMIT:
            yield _bad(path, csv.Error(f"field larger than field limit ({FIELD_LIMIT})"))
            return
        opened.append(line)
        opened_rows += n
        if state:
            continue
        if head:
            yield _piece(path, columns["owner_row"], columns["owner"], columns["start"], b"".join(x + b"\n" for x in opened))
            head, row = False, row + opened_rows
        else:
            ready += opened
            ready_rows += opened_rows
            ready_bytes += sum(map(len, opened))
        opened, opened_rows = [], 0
        if ready_bytes > READY_BYTES:
            yield from _cells(path, row, ready, keys)
            row, ready, ready_rows, ready_bytes = row + ready_rows, [], 0, 0
    yield from _cells(path, row, ready, keys)
    if opened:
        piece = b"".join(x + b"\n" for x in opened)
        if columns["last"] and columns["bare"]:
            piece = piece[:-1]
        first, owner = (columns["owner_row"], columns["owner"]) if head else (row + ready_rows, columns["start"])
        yield _piece(path, first, owner, columns["start"], piece)


def decoded(found: DataFrame, places: DataFrame) -> DataFrame:
    """Cells, pieces and errors (``_DECODED``) of the lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, names, rows = _arrow(_DECODED), _names(_DECODED), []

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema)

        for columns, own in _chunks(batches):
            try:
                for row in _split_rows(columns, own):
                    rows.append(row)
                    if len(rows) >= CHUNK or row[-1] is not None and len(row[-1]) > READY_BYTES:
                        yield made()
                        rows = []
            except csv.Error as e:
                rows.append(_bad(columns["path"], e))
        if rows:
            yield made()

    places = places.withColumnsRenamed({"path": "_path", "start": "_start"})
    on = (F.col("path") == F.col("_path")) & (F.col("start") == F.col("_start"))
    if places.count() <= BROADCAST_ROWS:
        both = found.join(F.broadcast(places), on)  # keeps the order of the lines
    else:
        both = found.withColumn("_n", F.monotonically_increasing_id()).repartition("path", "start").join(places, on)
        both = both.sortWithinPartitions("path", "start", "_n").drop("_n")
    return both.drop("_path", "_start", "size").mapInArrow(run, _DECODED)


def joined(parts: DataFrame, keys: DataFrame) -> DataFrame:
    """Cells (or an error) of the records whose pieces come from several splits."""
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["start"])
        path, data = rows[0]["path"], b"".join(r["piece"] for r in rows)
        bare = not data.endswith(b"\n")
        try:
            found = data.split(b"\n") if bare else data.split(b"\n")[:-1]
            out = list(_cells(path, rows[0]["row_id"], found, [rows[0][k] for k in KEYS], bare))
        except csv.Error as e:
            out = [_bad(path, e)]
        return _table(out, _DECODED)

    return parts.join(keys, "path", "left").groupBy("path", "owner").applyInArrow(run, _DECODED)


def csv_cells(found: DataFrame) -> DataFrame:
    """Long cells with headers (``ingest.CELL_SCHEMA``) of ``lines``."""
    ensure_checkpoint_dir(found.sparkSession)
    # one set of splits for all steps, whatever becomes of the executors
    found = found.checkpoint(eager=True)
    splits = scanned(found).checkpoint(eager=True)
    top = heads(splits).checkpoint(eager=True)
    keys = top.groupBy("path").agg(*[F.max(k).alias(k) for k in KEYS])
    rows = decoded(found, placed(splits, keys)).checkpoint(eager=True)
    rows = rows.where(F.col("piece").isNull()).unionByName(joined(rows.where(F.col("piece").isNotNull()), keys))
    cells = rows.checkpoint(eager=True)
    errors = (cells.select("path", "error").unionByName(top.select("path", "error")).where(F.col("error").isNotNull())
              .groupBy("path").agg(F.min("error").alias("error")))
    kept = top.where(F.col("error").isNull()).join(errors.select("path"), "path", "left_anti")
    names = kept.select("path", "col_ord", "last_ord", "header_top", "header_sub", "nth", "depth")
    if top.count() <= BROADCAST_ROWS:
        names = F.broadcast(names)
    columns = ("path", "row_id", "col_ord", "last_ord", "header_top", "header_sub", "nth", "respondent_id", "client", "venue", "value", "error")
    kinds = {n: "string" for n in columns} | {"row_id": "bigint", "col_ord": "int", "last_ord": "int", "nth": "int"}

    def filled(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(n) if n in df.columns else F.lit(None).cast(kinds[n]).alias(n) for n in columns])

    answers = cells.where(F.col("error").isNull()).withColumnsRenamed({"client_name": "client", "venue_name": "venue"}).drop(
        "owner", "start", "piece").join(names, ["path", "col_ord"]).where(F.col("row_id") >= F.col("depth"))
    answers = answers.withColumn("row_id", F.col("row_id") - F.col("depth"))
    heads_ = kept.select("path", F.lit(-1).cast("bigint").alias("row_id"), "col_ord", "last_ord", "header_top", "header_sub", "nth")
    return filled(answers).unionByName(filled(heads_)).unionByName(filled(errors))
