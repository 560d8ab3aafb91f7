"""Header dictionary and ranking operators, incl. property tests."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from visitlens.operators import headers as H
from visitlens.operators.ranking import dense_ids, distributed_row_number
from visitlens.plans.master import client_dimension


def seq_unique(names, max_len=63):
    """Brute force: each name takes the first free candidate in its series."""
    out, tried = [], {}
    for base in names:
        series = [base[:max_len]] + [base[:max_len - len(f"_{k}")] + f"_{k}" for k in range(1, 200)]
        start = tried.get(series[0], -1) + 1 if series[0] in out else 0
        for k in range(start, len(series)):
            if series[k] not in out:
                out.append(series[k])
                if k:
                    tried[series[0]] = k
                break
    return out


def uniquify(spark, files):
    rows = [(fid, i, ident) for fid, names in files.items() for i, ident in enumerate(names)]
    df = spark.createDataFrame(rows, "file_id long, col_ord int, identifier string")
    got = {}
    for r in H.unique_names(df).collect():
        got.setdefault(r.file_id, {})[r.col_ord] = r.unique_name
    return {f: [got[f][i] for i in range(len(n))] for f, n in files.items()}


def test_uniquifier_edge_cases(spark):
    twin = "x" * 80
    files = {1: ["a", "a", "a_1"], 2: [twin, twin], 3: ["a_1", "a", "a"], 4: ["b", "b", "b"]}
    got = uniquify(spark, files)
    assert got[1] == ["a", "a_1", "a_1_1"]
    assert got[2] == ["x" * 63, "x" * 61 + "_1"]
    assert got[3] == ["a_1", "a", "a_2"]
    assert got[4] == ["b", "b_1", "b_2"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "a_1", "a_2", "b", "a_1_1", "y" * 70, "y" * 61 + "_1"]),
                         min_size=1, max_size=12), min_size=1, max_size=4))
def test_uniquifier_matches_sequential_rule(spark, lists):
    files = {i: names for i, names in enumerate(lists)}
    got = uniquify(spark, files)
    for f, names in files.items():
        assert got[f] == seq_unique(names)
        assert len(set(got[f])) == len(got[f])
        assert all(len(n) <= 63 for n in got[f])
    again = uniquify(spark, got)  # stable: unique names pass through unchanged
    assert again == got


def test_header_dictionary_footer_and_flatten(spark):
    rows = [(1, 0, "Respondent ID", "Unnamed: 0_level_1"), (1, 1, "Welcome", "Comments"),
            (1, 2, "a", "Unnamed: 2_level_1"), (1, 3, "A", "Unnamed: 3_level_1"),
            (1, 4, "a 1", "Unnamed: 4_level_1"),
            (1, 5, "IMPORTANT: check for typos before you submit", "Unnamed: 5_level_1"),
            (2, 0, "3rd visit?", "Response")]
    df = spark.createDataFrame(rows, "file_id long, col_ord int, header_top string, header_sub string")
    d = {(r.file_id, r.col_ord): r.unique_name for r in H.header_dictionary(df).collect()}
    assert d == {(1, 0): "respondent_id", (1, 1): "welcome_comments", (1, 2): "a", (1, 3): "a_1",
                 (1, 4): "a_1_1", (2, 0): "col_3rd_visit_response"}


def test_distributed_row_number_matches_window_on_skew(spark):
    rnd = random.Random(7)
    rows = [("hot", rnd.randrange(10**6), i) for i in range(3000)]
    rows += [(f"g{i % 17}", rnd.randrange(10**6), 10**5 + i) for i in range(400)]
    rows += [(None, rnd.randrange(100), 10**6 + i) for i in range(30)]
    df = spark.createDataFrame(rows, "g string, k long, id long")
    order = [F.col("k").desc(), F.col("id").asc()]
    got = distributed_row_number(df, ["g"], order, "rn", num_partitions=11)
    exp = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    key = lambda r: (r.g or "", r.id)
    assert sorted(got.collect(), key=key) == sorted(exp.collect(), key=key)


def test_global_row_number_and_client_ids(spark):
    df = spark.createDataFrame([(f"c{i:04d}",) for i in range(1200)] * 2, "client_name string")
    ids = dense_ids(df, "client_name", "o")
    assert sorted(r.o for r in ids.collect()) == list(range(1, 1201))
    dim = {r.client_name: r.client_id for r in client_dimension(df).collect()}
    assert dim["c0000"] == "C001" and dim["c0999"] == "C1000" and dim["c1199"] == "C1200"


def test_hot_group_is_split_across_tasks(spark):
    """A group holding most rows is numbered in several tasks, not one."""
    rows = [("hot", i, i) for i in range(6000)] + [(f"g{i % 5}", i, 10**6 + i) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, k long, id long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = distributed_row_number(df, ["g"], [F.col("k").asc(), F.col("id").asc()], "rn", num_partitions=8)
        tasks = (got.where(F.col("g") == "hot").select(F.spark_partition_id().alias("p"))
                    .groupBy("p").count().collect())
        assert len(tasks) >= 4
        assert max(r["count"] for r in tasks) < 6000 / 2
        hot = sorted(r.rn for r in got.where(F.col("g") == "hot").select("rn").collect())
        assert hot == list(range(1, 6001))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_distributed_row_number_with_adaptive_partition_count(spark):
    rnd = random.Random(11)
    rows = [("hot", rnd.randrange(10**6), i) for i in range(4000)]
    rows += [(f"g{i % 23}", rnd.randrange(10**6), 10**5 + i) for i in range(700)]
    df = spark.createDataFrame(rows, "g string, k long, id long")
    order = [F.col("k").desc(), F.col("id").asc()]
    got = distributed_row_number(df, ["g"], order, "rn")  # AQE may merge range partitions
    exp = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    key = lambda r: (r.g, r.id)
    assert sorted(got.collect(), key=key) == sorted(exp.collect(), key=key)
