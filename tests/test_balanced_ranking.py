"""One-shuffle ranking with a range cut for hot groups only."""

import random

import pytest
from paths import SF_SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F

from visitlens.operators import ranking
from visitlens.operators.ranking import balanced_row_number, hot_groups
from visitlens.plans import views
from visitlens.sources import fixtures as fx

def order():
    return [F.col("k").desc(), F.col("id").asc()]


def skewed(spark, hot=4000, others=900):
    rnd = random.Random(3)
    rows = [("hot", None, rnd.randrange(10**6), i) for i in range(hot)]
    rows += [(f"g{i % 41}", i % 3, rnd.randrange(10**6), 10**6 + i) for i in range(others)]
    rows += [(None, None, rnd.randrange(100), 10**7 + i) for i in range(60)]
    return spark.createDataFrame(rows, "g string, h int, k long, id long").repartition(5)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan.count("Exchange rangepartitioning")


@pytest.mark.parametrize("least", [None, 30, 500, 10**9])
def test_ranks_equal_the_window(spark, least):
    df = skewed(spark)
    got = balanced_row_number(df, ["g", "h"], order(), "rn", least=least)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g", "h").orderBy(*order())).cast("long"))
    assert got.schema == want.schema or got.dtypes == want.dtypes
    key = lambda r: r.id
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)


def test_one_exchange_without_hot_groups(spark):
    df = skewed(spark, hot=10)
    assert exchanges(balanced_row_number(df, ["g", "h"], order(), "rn")) == (1, 0)
    master = views.master_view(fx.section_scores_wide(spark, SF_SMALL))
    assert exchanges(master) == (1, 0)


def test_summary_misses_no_hot_group(spark):
    rnd = random.Random(5)
    rows = [(f"hot{i}",) for i in range(3) for _ in range(2000 + 500 * i)] + [(f"c{rnd.randrange(20_000)}",) for _ in range(30_000)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "g string").repartition(7)
    hashes = {r.g: r.h for r in df.where("g like 'hot%'").distinct().select("g", F.xxhash64("g").alias("h")).collect()}
    assert set(hot_groups(df, ["g"], 1500, 8)) == set(hashes.values())
    assert set(hot_groups(df, ["g"], 2800, 8)) == {hashes["hot2"]}
    assert hot_groups(df.limit(0), ["g"], 10, 8) == []


def test_hot_groups_are_cut(spark, monkeypatch):
    monkeypatch.setattr(ranking, "LEAST_HOT_ROWS", 100)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = balanced_row_number(skewed(spark, hot=6000), ["g", "h"], order(), "rn")
        tasks = got.where("g = 'hot'").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert len(tasks) >= 4 and max(r["count"] for r in tasks) < 3000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_views_rank_once(spark, monkeypatch):
    calls, real = [], views.balanced_row_number
    monkeypatch.setattr(views, "balanced_row_number", lambda *a, **k: calls.append(1) or real(*a, **k))
    names = views.register_views(spark, fx.section_scores_wide(spark, SF_SMALL), fx.feedback_service(spark, SF_SMALL), {})
    assert names == views.VIEW_NAMES and len(calls) == 1
    master, trend, base = (spark.table(n).count() for n in ("vw_powerbi_master_final", "vw_trend_score_final", "vw_report_base_powerbi"))
    assert master == trend == base > 0


def test_empty_input(spark):
    df = skewed(spark).limit(0)
    assert balanced_row_number(df, ["g"], order(), "rn").count() == 0
