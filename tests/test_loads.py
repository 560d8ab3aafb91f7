"""Value-driven types, staged refreshes and masters in one pass."""

import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F
from test_ingest import drift_tree, make_tree, write_csv

from visitlens.operators import value_types as V
from visitlens.plans import one_pass
from visitlens.plans.build import build_masters
from visitlens.sinks import snapshot
from visitlens.sinks.writers import column_types, save_table, typed_for_sql, write_client_tables


def new_folder(name):
    return os.path.join(tempfile.mkdtemp(prefix="visitlens-load-"), name)


# --- types ----------------------------------------------------------------------

CLASSES = [
    (None, 0), ("", 0), (" \t", 0), ("N/A", 0), (" nan ", 0), ("#N/A", 0), ("None", 0), ("True", V.BOOL), (" false", V.BOOL), ("yes", V.TEXT),
    ("0", V.INT), ("-12", V.INT), ("+7", V.INT), ("1.0", V.INT), ("12.000", V.INT), ("9223372036854775807", V.INT),
    ("9223372036854775808", V.TEXT), ("-9223372036854775809.0", V.TEXT), ("007", V.TEXT), ("00.5", V.TEXT), ("1.5", V.DOUBLE), (".5", V.DOUBLE),
    ("5.", V.DOUBLE), ("1e3", V.DOUBLE), ("-2.5E-7", V.DOUBLE), ("1,5", V.TEXT), ("1.2.3", V.TEXT), ("inf", V.TEXT), ("$5", V.TEXT),
    ("5/9/2024", V.DATE), ("05-09-2024", V.DATE), ("2024-09-05", V.DATE), ("2024-9-5", V.DATE), ("5/9-2024", V.TEXT), ("31/02/2024", V.TEXT),
    ("29/02/2024", V.DATE), ("2024-09-05 07:30", V.TIMESTAMP), ("2024-09-05T23:05:59", V.TIMESTAMP), ("2024-09-05 24:61", V.TEXT),
    ("12\n", V.INT), ("1\n2", V.TEXT), ("a" * 50_000, V.TEXT), ("1" * 50_000, V.TEXT),
]


def test_value_classes(spark):
    df = spark.createDataFrame(list(enumerate(v for v, _ in CLASSES)), "i int, v string")
    got = {r.i: r.c for r in df.select("i", V.value_class(F.col("v")).alias("c")).collect()}
    assert [(v, got[i]) for i, (v, _) in enumerate(CLASSES)] == CLASSES


COLUMNS = {
    "gaps": (["1", None, "1.0", " 3 ", "N/A"], "int", [1, None, 1, 3, None]),
    "mixed_dates": (["5/9/2024", "2024-09-06", "07-09-2024", "", None], "date", ["2024-09-05", "2024-09-06", "2024-09-07", None, None]),
    "moments": (["5/9/2024", "2024-09-06 07:30", None, None, "nan"], "timestamp", ["2024-09-05 00:00:00", "2024-09-06 07:30:00", None, None, None]),
    "one_bad": (["1", "2", "three", "4", "n/a"], "text", ["1", "2", "three", "4", "n/a"]),
    "numbers": (["1", "2.5", "1e2", None, "-"], "text", ["1", "2.5", "1e2", None, "-"]),
    "decimals": (["1", "2.5", "1e2", None, "nan"], "double", [1.0, 2.5, 100.0, None, None]),
    "flags": (["True", "false", None, "", "TRUE"], "bool", [True, False, None, None, True]),
    "flag_or_number": (["True", "1", None, "", "0"], "text", ["True", "1", None, "", "0"]),
    "nothing": ([None, "", "  ", "null", "NaN"], "empty", [None, "", "  ", "null", "NaN"]),
    "codes": (["007", "12", None, None, None], "text", ["007", "12", None, None, None]),
    "odd `name`.x": (["1", "2", "3", "4", "5"], "int", [1, 2, 3, 4, 5]),
}


def typed_frame(spark):
    rows = [(i, *[v[0][i] for v in COLUMNS.values()]) for i in range(5)]
    schema = "i int, " + ", ".join(f"`{c.replace('`', '``')}` string" for c in COLUMNS)
    return spark.createDataFrame(rows, schema)


def test_columns_get_the_type_of_their_values(spark):
    df = typed_frame(spark).withColumnRenamed("odd `name`.x", "odd name.x")
    types = V.infer_types(df)
    assert {c: types[c.replace("`", "")] for c in COLUMNS} == {c: kind for c, (_, kind, _) in COLUMNS.items()}
    out = V.typed_columns(df, types)
    kinds = dict(out.dtypes)
    assert all(kinds[c.replace("`", "")] == ("timestamp_ntz" if k == "timestamp" else V.SPARK_TYPES[k]) for c, (_, k, _) in COLUMNS.items())
    rows = {r.i: r for r in out.collect()}
    for c, (_, kind, want) in COLUMNS.items():
        got = [rows[i][c.replace("`", "")] for i in range(5)]
        assert [str(v) if v is not None and kind in ("date", "timestamp") else v for v in got] == want, c


def test_classes_merge(spark):
    long = V.column_classes(spark.createDataFrame([(f, "c", v) for f, v in ((1, "1"), (1, None), (2, "2.5"), (3, "x"), (4, None))],
                                                  "file int, name string, value string"), ["file", "name"])
    whole = V.merge_classes(long, ["name"]).select("n_values", V.type_of(F.col("classes")).alias("t")).first()
    assert (whole.n_values, whole.t) == (3, "text")
    part = V.merge_classes(long.where("file < 3"), ["name"]).select(V.type_of(F.col("classes")).alias("t")).first()
    assert part.t == "double"
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan and "Python" not in plan


def test_loads_use_the_types(spark):
    df = typed_frame(spark).select("gaps", "mixed_dates", "moments", "one_bad", "decimals", "flags", "nothing")
    made = typed_for_sql(V.with_inferred_types(df))
    assert column_types(made) == ('"gaps" BIGINT, "mixed_dates" TIMESTAMP, "moments" TIMESTAMP, "one_bad" TEXT, "decimals" DOUBLE PRECISION, '
                                  '"flags" TEXT, "nothing" TEXT')
    rows = [("a", "1", "x"), ("a", "2.0", None), ("b", "1", "5"), ("b", "one", "6")]
    masters = spark.createDataFrame(rows, "client_name string, v string, w string")
    kinds = {}
    write_client_tables(spark, masters, lambda name, frame: kinds.update({name: dict(frame.dtypes)}))
    assert kinds == {"a_master": {"client_name": "string", "v": "bigint", "w": "string"},
                     "b_master": {"client_name": "string", "v": "string", "w": "bigint"}}
    assert V.infer_types(masters.limit(0)) == {"client_name": "empty", "v": "empty", "w": "empty"}


# --- staged refreshes -------------------------------------------------------------

def breaking(df):
    """``df`` with a task that fails after it has handed on some rows."""
    def run(batches):
        for n, batch in enumerate(batches):
            yield batch
        if (batch.column("id").to_numpy() >= 500).any():
            raise RuntimeError("lost")

    return df.mapInArrow(run, df.schema)


def test_snapshot_survives_a_failing_task(spark):
    path = new_folder("t")
    old = spark.range(10).withColumn("v", F.lit("old"))
    snapshot.refresh(old, path)
    files = set(os.listdir(os.path.join(path, "data")))
    with pytest.raises(Exception, match="lost"):
        snapshot.refresh(breaking(spark.range(0, 1000, 1, 4).withColumn("v", F.lit("new"))), path)
    assert sorted(snapshot.read(spark, path).collect()) == sorted(old.collect())
    time.sleep(1)  # tasks that are being killed may still write after the abort
    snapshot.Manifests(path).vacuum()
    assert files <= set(os.listdir(os.path.join(path, "data")))
    snapshot.Manifests(path).vacuum(older_than=0)
    assert set(os.listdir(os.path.join(path, "data"))) == files
    assert len(os.listdir(os.path.join(path, "manifests"))) == 1


def test_snapshot_refresh_append_and_readers(spark):
    path = new_folder("t")
    assert not snapshot.exists(path)
    with pytest.raises(Exception, match="no table"):
        snapshot.read(spark, path)
    snapshot.refresh(spark.range(0, 100, 1, 3).withColumn("v", F.lit("a")), path)
    early = snapshot.read(spark, path)
    snapshot.refresh(spark.range(100, 120).withColumn("v", F.lit("b")), path, mode="append")
    assert snapshot.read(spark, path).count() == 120 and early.count() == 100
    with pytest.raises(Exception, match="other columns"):
        snapshot.refresh(spark.range(5), path, mode="append")
    assert snapshot.read(spark, path).count() == 120
    snapshot.refresh(spark.range(7).withColumn("w", F.lit(1.5)), path)  # other columns
    again = snapshot.read(spark, path)
    assert again.columns == ["id", "w"] and again.count() == 7
    snapshot.refresh(spark.range(3).withColumn("w", F.lit(1.5)).limit(0), path)
    empty = snapshot.read(spark, path)
    assert empty.columns == ["id", "w"] and empty.count() == 0
    assert spark.read.format(snapshot.FORMAT).load(path).count() == 0
    snapshot.refresh(spark.range(50), path)
    assert spark.read.format(snapshot.FORMAT).load(path).agg(F.sum("id")).first()[0] == sum(range(50))
    # old snapshots are gone, with their files
    assert len(os.listdir(os.path.join(path, "manifests"))) == snapshot.KEEP
    named = {f["path"] for n in snapshot.Manifests(path).names() for f in snapshot.Manifests(path).read(n)["files"]}
    held = {os.path.join("data", d, f) for d in os.listdir(os.path.join(path, "data")) for f in os.listdir(os.path.join(path, "data", d)) if not f.startswith(".")}
    assert held == named


def test_snapshot_reads_prune_and_push_down(spark):
    path = new_folder("t")
    snapshot.refresh(spark.range(100).withColumn("v", F.col("id") * 2).withColumn("w", F.lit("x")), path)
    plan = snapshot.read(spark, path).where("id > 5").select("v")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,5)]" in plan and "w" not in plan.split("ReadSchema")[1]


def test_snapshot_ignores_what_no_commit_named(spark):
    path = new_folder("t")
    snapshot.refresh(spark.range(5), path)
    # a driver that died before its commit: staged files and an unfinished manifest
    os.makedirs(os.path.join(path, "data", "dead"))
    open(os.path.join(path, "data", "dead", "x.parquet"), "wb").close()
    open(os.path.join(path, "manifests", ".dead.tmp"), "w").close()
    assert snapshot.read(spark, path).count() == 5
    snapshot.refresh(spark.range(6), path)
    assert snapshot.read(spark, path).count() == 6


def test_failed_table_refresh_leaves_the_table(spark):
    save_table(spark.range(10).withColumn("v", F.lit("old")), "vl_t_crash")
    with pytest.raises(Exception, match="lost"):
        save_table(breaking(spark.range(0, 1000, 1, 4)), "vl_t_crash")
    assert spark.table("vl_t_crash").count() == 10 and spark.table("vl_t_crash").columns == ["id", "v"]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("vl_t_crash")] == ["vl_t_crash"]
    save_table(spark.table("vl_t_crash").limit(0).select("id"), "vl_t_crash")  # reads what it replaces
    assert spark.table("vl_t_crash").count() == 0 and spark.table("vl_t_crash").columns == ["id"]
    with pytest.raises(Exception, match="lost"):
        save_table(breaking(spark.range(0, 1000, 1, 4)), "vl_t_never")
    assert not spark.catalog.tableExists("vl_t_never")


# --- masters in one pass ------------------------------------------------------------

def as_rows(df):
    return sorted(repr(sorted(r.asDict().items())) for r in df.collect())


@pytest.mark.parametrize("tree", [make_tree, drift_tree])
@pytest.mark.parametrize("recode", [True, False])
def test_one_pass_equals_each_clients_master(spark, tree, recode):
    m = build_masters(spark, tree() if tree is make_tree else tree(spark), recode=recode)
    path = new_folder("masters")
    m.write(path)
    back, want = one_pass.read_masters(spark, path), m.masters
    assert sorted(back.dtypes) == sorted(want.dtypes)
    assert as_rows(back) == as_rows(want)
    for name, own in m.each():
        mine = one_pass.read_masters(spark, path, name)
        assert mine.columns == own.columns
        plain = [F.col(f"`{c}`").cast("string").alias(c) for c in own.columns]
        assert as_rows(mine.select(*plain)) == as_rows(own.select(*plain))


def client_tree(n_clients, rows=3):
    root = tempfile.mkdtemp(prefix="visitlens-clients-")
    for c in range(n_clients):
        os.makedirs(os.path.join(root, f"client {c}"))
        top = ["Respondent ID", "Food", "Total expenditure", "Thinking about the staff, please select the words that best describe them", f"Own {c}"]
        body = [[str(i), "Good", f"${i}.50", "Yes" if i % 2 else "", f"text {c} {i}"] for i in range(rows)]
        write_csv(os.path.join(root, f"client {c}", "venue.csv"), [top, ["", "Rating", "", "Adept", ""], *body])
    return root


def jobs_of(spark, name, work):
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        work()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(name))


def test_jobs_do_not_grow_with_the_clients(spark):
    jobs = {}
    for n in (2, 9):
        m = build_masters(spark, client_tree(n))
        path = new_folder("masters")
        jobs[n] = jobs_of(spark, f"one-pass-{n}", lambda: m.write(path))
        got = one_pass.read_masters(spark, path)
        assert got.count() == 3 * n and {f"own_{c}" for c in range(n)} <= set(got.columns)
    assert jobs[2] == jobs[9]


def test_a_large_client_is_written_by_many_tasks(spark):
    m = build_masters(spark, client_tree(1, rows=500))
    path = new_folder("masters")
    one_pass.write_masters(m, path, rows_per_file=50)
    files = snapshot.Manifests(path).current()["files"]
    assert len(files) == 10 and sum(f["rows"] for f in files) == 500 and max(f["rows"] for f in files) < 100
    assert as_rows(one_pass.read_masters(spark, path)) == as_rows(m.masters)


def test_masters_are_replaced_together(spark, monkeypatch):
    path = new_folder("masters")
    build_masters(spark, client_tree(2)).write(path)
    before = as_rows(one_pass.read_masters(spark, path))
    m = build_masters(spark, client_tree(3, rows=5))
    monkeypatch.setattr(one_pass.MastersWriter, "write", lambda self, rows: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        m.write(path)
    monkeypatch.undo()
    assert as_rows(one_pass.read_masters(spark, path)) == before
    m.write(path)
    assert one_pass.read_masters(spark, path).count() == 15
