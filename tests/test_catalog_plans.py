"""Catalog metadata operators, identifier variants and plan shapes."""

import contextlib
import io

from pyspark.sql import functions as F

from paths import SF_SMALL
from visitlens import config
from visitlens.functions.text import clean_identifier
from visitlens.operators import headers as H
from visitlens.operators.reshape import map_frame
from visitlens.plans import catalog
from visitlens.sources.catalog import columns_frame, present_columns


def plan_text(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_present_mapped_columns(spark):
    t1 = spark.createDataFrame([(1, "a", "b")], "respondent_id long, welcome_comments string, farewell_comments string")
    t2 = spark.createDataFrame([(1, "x")], "respondent_id long, other string")
    cols = columns_frame(spark, {"t1": t1, "t2": t2})
    m = map_frame(spark, config.COMMENT_MAP, ["section", "comment_type", "column_name"])
    got = sorted((r.table_name, r.column_name) for r in present_columns(cols, m).collect())
    assert got == [("t1", "farewell_comments"), ("t1", "welcome_comments")]


def test_identifier_variants(spark):
    df = spark.createDataFrame([("A__b c",), ("9 lives",)], "h string")
    got = [r[0] for r in df.select(clean_identifier(F.col("h"), col_prefix=False, keep_underscore=True,
                                                     max_len=63)).collect()]
    assert got == ["a_b_c", "9_lives"]
    rows = [(1, i, n) for i, n in enumerate(["a", "a", "a_1", "b" * 60, "b" * 60])]
    hd = spark.createDataFrame(rows, "file_id long, col_ord int, identifier string")
    simple = {r.col_ord: r.unique_name for r in H.simple_unique_names(hd).collect()}
    assert [simple[i] for i in range(5)] == ["a", "a_1", "a_1", "b" * 60, "b" * 60 + "_1"]
    cut55 = {r.col_ord: r.unique_name for r in H.simple_unique_names(hd, base_len=55).collect()}
    assert cut55[4] == "b" * 55 + "_1"


def test_latest_visit_uses_window_group_limit(spark):
    text = plan_text(catalog.QUERIES["latest_visit"](spark, SF_SMALL))
    assert "WindowGroupLimit" in text


def test_question_scores_reads_lineitem_once(spark):
    text = plan_text(catalog.QUERIES["question_scores"](spark, SF_SMALL))
    assert text.count("lineitem.parquet]") == 1
    assert "Expand" in text


def test_filters_reach_scans(spark):
    text = plan_text(catalog.QUERIES["total_score"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double" in text
    assert "PushedFilters" in text


def test_visit_totals_reuse_join_partitioning(spark):
    """With shuffle joins (as at scale) the visit aggregate adds no exchange."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_text(catalog.QUERIES["total_score"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tree = [line.strip(" :+-") for line in text.split("\n\n")[0].splitlines()]
    first = next(i for i, line in enumerate(tree) if line.startswith("HashAggregate"))
    assert tree[first + 1].startswith("HashAggregate")  # final directly over partial
    below = next(line for line in tree[first + 2:] if not line.startswith(("Project", "Filter")))
    assert below.startswith("SortMergeJoin")  # partial aggregate reads the join, no exchange
