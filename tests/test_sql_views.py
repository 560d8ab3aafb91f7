"""The report views in the catalog equal the frames, and follow their dependencies."""

import os
import tempfile
import uuid
from graphlib import CycleError

import pytest
from paths import SF_SMALL
from pyspark.sql import functions as F

from visitlens.plans import sql_views, views
from visitlens.sources import fixtures as fx


@pytest.fixture(scope="module")
def catalog(spark):
    database = f"vl_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    out = sql_views.ReportCatalog(spark, database)
    masters = {"fx_comment_master": fx.comment_master(spark, SF_SMALL), "fx_word_master": fx.word_master(spark, SF_SMALL)}
    out.save_tables(fx.section_scores_wide(spark, SF_SMALL), fx.feedback_service(spark, SF_SMALL), masters)
    out.create()
    yield out
    spark.sql(f"DROP DATABASE {database} CASCADE")


def rows(df):
    return sorted(repr(sorted(r.asDict().items())) for r in df.collect())


def test_catalog_views_equal_the_frames(spark, catalog):
    scores, feedback = fx.section_scores_wide(spark, SF_SMALL), fx.feedback_service(spark, SF_SMALL)
    tables = {n: spark.table(f"{catalog.database}.{n}") for n in ("fx_comment_master", "fx_word_master")}
    want = views.build_views(spark, scores, feedback, tables)
    assert set(want) | {"vw_total_score_keyed"} == set(catalog.views) and set(want) == set(views.VIEW_NAMES)
    for name, df in want.items():
        got = spark.table(f"{catalog.database}.{name}")
        assert sorted(got.columns) == sorted(df.columns), name
        assert rows(got) == rows(df.select(*got.columns)), name
        assert got.count() > 0, name


def test_order_follows_the_definitions(catalog):
    order = catalog.order()
    for name, sql in catalog.views.items():
        assert all(order.index(d) < order.index(name) for d in sql_views.reads(sql) if d in catalog.views)
    assert catalog.readers("vw_total_score_keyed") == {
        "vw_total_score_final", "vw_powerbi_master_final", "vw_latest_visit_score_final", "vw_previous_visits_score_final", "vw_trend_score_final", "vw_report_base_powerbi"}
    assert catalog.readers("vw_question_scores") == {"vw_question_scores_powerbi"}
    assert "vw_comments_powerbi" in catalog.readers("fx_comment_master")
    loop = sql_views.ReportCatalog(catalog.spark, catalog.database, {"a": "select * from {b}", "b": "select * from {a}"})
    with pytest.raises(CycleError):
        loop.order()


def test_views_survive_the_session(spark, catalog):
    other = spark.newSession()
    name = f"{catalog.database}.vw_report_base_powerbi"
    assert other.table(name).count() == spark.table(name).count() > 0
    path = os.path.join(tempfile.mkdtemp(prefix="visitlens-views-"), "definitions")
    catalog.store(path)
    catalog.drop()
    assert not spark.catalog.tableExists(name)
    back = sql_views.ReportCatalog.restore(other, catalog.database, path)
    assert back.views == catalog.views and spark.table(name).count() > 0


def test_replacing_a_view_recreates_its_readers(spark, catalog):
    before = dict(catalog.views)
    more = catalog.views["vw_powerbi_master_final"].replace("visit_rank = 1 as is_latest_visit", "visit_rank <= 2 as is_latest_visit, 'x' as extra")
    made = catalog.replace("vw_powerbi_master_final", more)
    assert made[0] == "vw_powerbi_master_final" and set(made[1:]) == catalog.readers("vw_powerbi_master_final")
    latest = spark.table(f"{catalog.database}.vw_latest_visit_score_final")
    assert "extra" in latest.columns and latest.agg(F.max("visit_rank")).first()[0] == 2
    # one that its readers cannot read leaves everything as it was
    with pytest.raises(Exception, match="visit_rank|is_latest_visit|UNRESOLVED"):
        catalog.replace("vw_powerbi_master_final", "select visit_id from {vw_total_score_final}")
    assert catalog.views["vw_powerbi_master_final"] == more
    assert "extra" in spark.table(f"{catalog.database}.vw_latest_visit_score_final").columns
    catalog.replace("vw_powerbi_master_final", before["vw_powerbi_master_final"])
    assert "extra" not in spark.table(f"{catalog.database}.vw_trend_score_final").columns


def test_views_follow_a_refreshed_table(spark, catalog):
    from visitlens.sinks.writers import save_table
    name = f"{catalog.database}.{sql_views.FEEDBACK}"
    kept = spark.table(name).where("respondent_id % 2 = 0")
    n = spark.table(f"{catalog.database}.vw_staff_behaviour_powerbi").count()
    save_table(kept, name)
    assert 0 < spark.table(f"{catalog.database}.vw_staff_behaviour_powerbi").count() < n


def test_no_mapped_column_gives_a_typed_empty_view(spark, catalog):
    made = sql_views.definitions({"t": ["client_name", "other"]})
    assert sql_views.reads(made["vw_full_survey_comments_powerbi"]) == set()
    empty = spark.sql(made["vw_full_survey_comments_powerbi"])
    assert empty.columns == views.COMMENT_SCHEMA.fieldNames() and empty.count() == 0
    words = spark.sql(made["vw_staff_service_words_powerbi"])
    assert dict(words.dtypes)["selected_flag"] == "int" and words.count() == 0


def test_each_section_is_scanned_once(spark, catalog):
    plan = spark.table(f"{catalog.database}.vw_question_scores")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 4
