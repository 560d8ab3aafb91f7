"""Fill-in-the-middle by block rotation.

Each text is cut between lines into prefix, middle and suffix. Its bytes lie in
one bytearray: the sentinels are inserted before the three segments, and two
neighbouring blocks are then exchanged in place by three reversals, which gives
either order of the format. ``restore`` needs the formatted text and its form
only: it rotates back and takes the sentinels out, byte for byte.

Every row is worked on by itself, without a shuffle; formatted texts leave a
task in batches of bounded size.

Defined results: null text counts as empty; an empty text, a text that holds a
sentinel, and a text beyond ``rate`` stay plain (null cut lengths); a text of
one line has empty segments; very long texts are cut like others; equal ids get
equal draws, so repeated rows give equal results; a null id draws as the empty
text; an empty table gives no rows; only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import text_or_empty

#: Sentinels of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
SEED, RATE, SPM_PERCENT = 7, 100, 50
BATCH_BYTES = 16 << 20


def rotate(data: bytearray, start: int, mid: int, stop: int) -> None:
    """Exchanges ``data[start:mid]`` and ``data[mid:stop]`` in place."""
    view = np.frombuffer(data, np.uint8)
    for a, b in ((start, mid), (mid, stop), (start, stop)):
        view[a:b] = view[a:b][::-1]


def line_starts(text: bytes) -> np.ndarray:
    """Where each line begins, and the end of the text."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    if len(text) and not text.endswith(b"\n"):
        ends = np.append(ends, len(text))
    return np.concatenate(([0], ends)).astype(np.int64)


def code_points(text: bytes, start: int, stop: int) -> int:
    part = np.frombuffer(text, np.uint8)[start:stop]
    return int(np.count_nonzero((part & 0xC0) != 0x80))


def formatted(text: bytes, cut: int, after: int, form: str) -> bytearray:
    """``text`` with its middle ``text[cut:after]`` moved to the end."""
    data = bytearray(text)
    data[after:after] = SUFFIX
    data[cut:cut] = MIDDLE
    data[0:0] = PREFIX
    middle, suffix = cut + 3, after + 6
    rotate(data, middle if form == "psm" else 0, suffix, len(data))
    return data


def restored(data: bytearray, form: str) -> bytearray:
    """The text that ``formatted`` was given."""
    if form == "plain":
        return data
    first, second = (data.index(SUFFIX), data.index(MIDDLE)) if form == "psm" else (0, data.index(PREFIX))
    rotate(data, first, second, len(data))
    for token in (SUFFIX, MIDDLE, PREFIX):
        at = data.index(token)
        del data[at:at + 3]
    return data


def _draw(key: str, part: int) -> Column:
    return F.conv(F.substring(key, 1 + 8 * part, 8), 16, 10).cast("bigint")


def _texts(column: pa.Array) -> list[bytes]:
    return pc.cast(column, pa.large_binary()).to_pylist()


def _strings(values: list[bytearray]) -> pa.Array:
    return pc.cast(pa.array([bytes(v) for v in values], pa.binary()), pa.string())


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE,
              spm_percent: int = SPM_PERCENT) -> DataFrame:
    """Per row: id, n (lines), form (plain, psm, spm), prefix_chars, middle_chars, output.

    Cuts and form come from a digest of ``seed`` and the id: ``rate`` of 100
    texts are formatted, ``spm_percent`` of 100 of those with the suffix first.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), key.alias("key")).select(
        "id", "text", *[_draw("key", i).alias(f"h{i + 1}") for i in range(4)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            draws = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(2, 6)]
            done, used, first = [], 0, 0

            def made(stop: int) -> pa.RecordBatch:
                n, form, before, inside, out = zip(*done, strict=True)
                return pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, stop - first), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                     pa.array(before, pa.int64()), pa.array(inside, pa.int64()), _strings(out)],
                    ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

            for i in range(batch.num_rows):
                text = _texts(batch.column(1).slice(i, 1))[0]
                at = line_starts(text)
                n = len(at) - 1
                if not text or any(s in text for s in SENTINELS) or draws[2][i] % 100 >= rate:
                    done.append((n, "plain", None, None, text))
                else:
                    a, b = sorted((int(at[draws[0][i] % (n + 1)]), int(at[draws[1][i] % (n + 1)])))
                    form = "spm" if draws[3][i] % 100 < spm_percent else "psm"
                    done.append((n, form, code_points(text, 0, a), code_points(text, a, b), formatted(text, a, b, form)))
                used += len(text)
                if used >= BATCH_BYTES:
                    yield made(i + 1)
                    done, used, first = [], 0, i + 1
            if done:
                yield made(batch.num_rows)

    return rows.mapInArrow(
        run, f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    ).withColumnRenamed("id", id_col)


def restore(made: DataFrame) -> DataFrame:
    """``made`` with ``restored``, rebuilt from its output and form."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in made.schema)
    names = made.columns
    output, form = names.index("output"), names.index("form")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done, used, first = [], 0, 0
            for i in range(batch.num_rows):
                text = _texts(batch.column(output).slice(i, 1))[0]
                done.append(restored(bytearray(text), batch.column(form)[i].as_py()))
                used += len(text)
                if used >= BATCH_BYTES or i == batch.num_rows - 1:
                    part = batch.slice(first, i + 1 - first)
                    yield pa.RecordBatch.from_arrays([*part.columns, _strings(done)], [*names, "restored"])
                    done, used, first = [], 0, i + 1

    return made.mapInArrow(run, f"{kinds}, restored string")
