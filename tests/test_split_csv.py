"""CSV exports read in record-aligned splits equal the one-task decoder."""

import os
import random
import tempfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from visitlens.sources import decoders, ingest, split_csv

ALPHABET = ['"', '"', ",", "\n", "\n", "\r", "\r\n", "a", "b c", "é", "x" * 30, '""', '","', '"\n"', "\0"]


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def to(size):
        for n in names:
            spark.conf.set(n, str(size))

    yield to
    for n, v in before.items():
        spark.conf.set(n, v)


def tree(files):
    root = tempfile.mkdtemp(prefix="visitlens-split-")
    for name, data in files.items():
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as fh:
            fh.write(data)
    return root


def rows(df):
    return sorted(map(repr, map(tuple, df.select(*ingest.CELL_SCHEMA.fieldNames()).collect())))


def both(spark, root):
    split = split_csv.csv_cells(ingest.in_client_folders(split_csv.lines(spark, root), root))
    whole = ingest.decode_cells(ingest.list_files(spark, root, "*.csv"))
    return rows(split), rows(whole)


def random_file(rng, n):
    quoted = "".join(rng.choices(ALPHABET, k=n))
    plain = "\n".join(",".join(rng.choice(["1", "", '"a, ""b""\nc"', "Yes", '"multi\r\nline\n\n"']) for _ in range(4)) for _ in range(n // 8))
    head = rng.choice(["Respondent ID,Food,,Food\n,Rating,Why,Rating\n", '"Respondent\nID",x\n', "", "a\n"])
    end = rng.choice(["", "\n", '"open', "\r", '"closed"'])
    text = head + rng.choice([quoted, plain, plain + "\n" + quoted]) + end
    return rng.choice([b"", b"\xef\xbb\xbf"]) + text.encode() + rng.choice([b"", b"\xff\xe9\n", b"\xc3"])


@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 27])
def test_splits_equal_the_whole_file(spark, small_splits, size):
    rng = random.Random(size)
    root = tree({f"client {i % 3}/file+{i} %.csv": random_file(rng, rng.choice([0, 10, 60])) for i in range(8 if size == 7 else 30)})
    small_splits(size)
    split, whole = both(spark, root)
    assert split == whole and len(whole) > 50


def test_one_file_is_decoded_by_many_tasks(spark, small_splits):
    body = "".join(f'{i},"comment ""{i}""\nsecond line, still {i}\n",{i % 7}\n' for i in range(4000))
    root = tree({"c/large.csv": ("Respondent ID,Why,Grade\n,,\n" + body).encode()})
    small_splits(16_384)
    found = split_csv.lines(spark, root).checkpoint()
    assert found.select("start").distinct().count() > 10
    split, whole = both(spark, root)
    assert split == whole
    cells = ingest.read_cells(spark, root)
    assert cells.where("row_id >= 0").select("row_id").distinct().count() == 4000
    last = cells.where((F.col("row_id") == 3999) & (F.col("col_ord") == 1)).first()
    assert last.value == 'comment "3999"\nsecond line, still 3999\n' and last.respondent_id == "3999" and last.header_top == "Why"


def test_a_bad_record_anywhere_rejects_the_file(spark, small_splits, monkeypatch):
    monkeypatch.setattr(decoders, "FIELD_LIMIT", 400)
    monkeypatch.setattr(split_csv, "FIELD_LIMIT", 400)
    good = "A,B\n,\n" + "".join(f"{i},ok\n" for i in range(50))
    root = tree({"c/good.csv": good.encode(), "c/late.csv": (good + '7,"' + "y" * 401 + '"\n').encode(),
                 "c/open.csv": (good + '7,"' + "never closed\n" * 200).encode(), "c/empty.csv": b"",
                 "c/edge.csv": (good + '7,"' + "z" * 400 + '"\n').encode(), "top.csv": good.encode()})
    for size in (50, 1 << 27):
        small_splits(size)
        split, whole = both(spark, root)
        assert split == whole
        good_cells, bad = ingest.split_errors(ingest.read_cells(spark, root))
        assert sorted(os.path.basename(r.path) for r in bad.collect()) == ["late.csv", "open.csv"]
        assert {os.path.basename(r.path) for r in good_cells.select("path").distinct().collect()} == {"good.csv", "edge.csv"}


def test_header_rows_have_a_bound(spark, small_splits, monkeypatch):
    monkeypatch.setattr(split_csv, "HEADER_BYTES", 60)
    root = tree({"c/long.csv": ("A" * 50 + "," + "B" * 50 + "\nx,y\n1,2\n").encode(), "c/ok.csv": b"A,B\nx,y\n" + b"1,2\n" * 50})
    small_splits(40)
    good, bad = ingest.split_errors(ingest.read_cells(spark, root))
    assert [(os.path.basename(r.path), r.error) for r in bad.collect()] == [("long.csv", "header rows longer than 60 bytes")]
    assert good.where("row_id >= 0").count() == 100


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=25))
def test_steps_follow_the_csv_module(parts):
    """States and record counts of the lines add up to the module's own records."""
    import csv
    import io
    text = "".join(parts)
    want = list(csv.reader(io.StringIO(text + "\n", newline="")))
    state = total = 0
    for line in text.encode().split(b"\n"):
        state, n = split_csv.step(line, state)
        total += n
    assert total == len(want)
    assert bool(state) == (list(csv.reader(io.StringIO(text + "\nx\n", newline="")))[-1] != ["x"])
