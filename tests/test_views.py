"""Report views on literal edge rows (SURVEY B-items and FIXTURES edge table)."""

import datetime as dt

from pyspark.sql import functions as F

from visitlens.operators import scoring
from visitlens.plans import views

KEYS = "client_name string, venue_name string, respondent_id bigint, assessor_id string, " \
       "visit_type string, visit_date_raw string"
SCORES = "service_score double, selling_score double, product_score double, environment_score double"


def wide(spark, rows):
    return spark.createDataFrame(rows, KEYS + ", " + SCORES)


def test_same_visit_two_suffixes_stays_two_rows(spark):
    rows = [("c", "X (1)", 7, "3.0", "t", "01/02/2024", 80.0, None, None, None),
            ("c", "X (2)", 7, "3.0", "t", "01/02/2024", 90.0, None, None, None)]
    out = views.total_score_view(wide(spark, rows)).collect()
    assert len(out) == 2
    assert {r.visit_id for r in out} == {"c|X|7"}
    assert {r.venue_name for r in out} == {"X"}
    assert {r.assessor_id for r in out} == {"3"}


def test_null_total_is_critical(spark):
    rows = [("c", "V", 1, "1", "t", "01/02/2024", None, None, None, None)]
    out = views.master_view(wide(spark, rows)).collect()
    assert out[0].total_score is None and out[0].performance_band == "Critical"


def test_rank_uses_text_order_and_flags(spark):
    rows = [("c", "V", r, "1", "t", "01/02/2024", 50.0, None, None, None) for r in (99, 100)]
    rows += [("c", "V", 5, "1", "t", f"{d:02d}/01/2024", 50.0, None, None, None) for d in range(1, 12)]
    out = {r.respondent_id + "@" + r.visit_date_raw: r for r in views.master_view(wide(spark, rows)).collect()}
    assert out["99@01/02/2024"].visit_rank == 1 and out["99@01/02/2024"].visit_group == "Latest Visit"
    assert out["100@01/02/2024"].visit_rank == 2
    ranks = sorted(r.visit_rank for r in out.values())
    assert ranks == list(range(1, 14))
    by_rank = {r.visit_rank: r for r in out.values()}
    assert by_rank[11].visit_group == "Previous 10 Visits" and by_rank[11].is_previous_10_visits
    assert by_rank[12].visit_group == "Older Visit" and not by_rank[12].is_previous_10_visits


def test_band_and_rating_edges(spark):
    df = spark.createDataFrame([(x,) for x in (90.0, 89.9, 80.0, 70.0, 69.9, 75.0, 50.0, 49.99)], "s double")
    bands = [r[0] for r in df.select(scoring.performance_band(F.col("s"))).collect()]
    assert bands[:5] == ["Excellent", "Good", "Good", "Needs Attention", "Critical"]
    ratings = [r[0] for r in df.select(scoring.rating(F.col("s"))).collect()]
    assert ratings[0] == "Very Good" and ratings[5:] == ["Good", "Fair", "Poor"]


def test_mean_uses_rounded_parts(spark):
    rows = [("c", "V", 1, "1", "t", "01/02/2024", 80.04, 80.25, None, None)]
    out = views.total_score_view(wide(spark, rows)).collect()[0]
    assert out.service_score == 80.0 and out.selling_score == 80.3 and out.total_score == 80.2


def test_date_floor_and_bad_dates(spark):
    raws = ["31/02/2024", "05/24/0018", "2024-09-05", None, "01/01/2023", "31/12/2022"]
    rows = [("c", "V", i, "1", "t", d, 50.0, None, None, None) for i, d in enumerate(raws)]
    out = views.total_score_view(wide(spark, rows)).collect()
    assert [r.visit_date for r in out] == [dt.date(2023, 1, 1)]


def test_union_path_equals_wide_path(spark):
    rows = [("c", "V (1)", i, f"{i}.0", "t", f"0{i}/03/2024", 10.0 * i, 20.0, None, 5.5)
            for i in range(1, 6)]
    w = wide(spark, rows)
    from visitlens.config import SECTION_COLUMNS
    sections = {s: w.select(*KEYS_LIST, total) for s, (total, _c) in SECTION_COLUMNS.items()}
    a = sorted(views.total_score_view(sections).collect())
    b = sorted(views.total_score_view(w).collect())
    assert a == b


KEYS_LIST = ["client_name", "venue_name", "respondent_id", "assessor_id", "visit_type", "visit_date_raw"]


def test_latest_and_previous_match_master(spark):
    rows = [("c", f"V{i % 3}", i, "1", "t", f"{1 + i % 28:02d}/0{1 + i % 9}/2024", float(i), None, None, None)
            for i in range(60)]
    w = wide(spark, rows)
    m = views.master_view(w)
    latest = sorted(views.latest_visit_view(w).collect())
    prev = sorted(views.previous_visits_view(w).collect())
    assert latest == sorted(m.where("is_latest_visit").collect())
    assert prev == sorted(m.where("is_previous_10_visits").collect())


def test_comments_and_words_empty_match_keeps_schema(spark):
    df = spark.createDataFrame([("c", "V", 1, "x")], "client_name string, venue_name string, "
                               "respondent_id bigint, unrelated string")
    c = views.comments_view(spark, {"t": df})
    w = views.staff_words_view(spark, {"t": df})
    assert c.count() == 0 and w.count() == 0
    assert c.columns[-1] == "source_table" and "selected_flag" in w.columns


def test_comment_tokens(spark):
    vals = [" N/A ", "nan", "NONE", "   ", None, " ok "]
    df = spark.createDataFrame([("c", "V (2)", i, v) for i, v in enumerate(vals)],
                               "client_name string, venue_name string, respondent_id bigint, "
                               "welcome_comments string")
    out = views.comments_view(spark, {"t": df}).collect()
    assert [(r.comment_text, r.venue_name, r.comment_type) for r in out] == [(" ok ", "V", "Welcome Comments")]


def test_duplicate_map_rows_both_emit(spark):
    df = spark.createDataFrame([("c", "V", 1, "great")], "client_name string, venue_name string, "
                               "respondent_id bigint, timing_comments string")
    rows = [("Service", "Timing Comments", "timing_comments"), ("Service", "Speed", "timing_comments")]
    out = views.comments_view(spark, {"t": df}, rows).collect()
    assert sorted(r.comment_type for r in out) == ["Speed", "Timing Comments"]


def test_staff_behaviour_numeric_filter(spark):
    vals = ["3", "3.0", "-1", "1e2", "NaN", ".5", "2"]
    df = spark.createDataFrame([("c", "V", i, "1", "t", "d", v) for i, v in enumerate(vals)],
                               KEYS + ", staff_warmth_score string")
    out = {r.respondent_id: r.score for r in views.staff_behaviour_view(df).collect()}
    assert out == {"0": 100.0, "1": 100.0, "6": 66.67}


def test_section_union_paths_agree(spark):
    rows = [("c", "V (1)", i, f"{i}.0", "t", f"0{i}/03/2024", 10.0 * i, None, 3.0, 5.5) for i in range(1, 6)]
    w = wide(spark, rows)
    from visitlens.config import SECTION_COLUMNS
    sections = {s: w.select(*KEYS_LIST, total) for s, (total, _c) in SECTION_COLUMNS.items()}
    key = lambda r: tuple((x is None, x) for x in r)
    a = sorted(scoring.section_union(sections).collect(), key=key)
    b = sorted(scoring.section_union_wide(w).collect(), key=key)
    assert a == b and len(a) == 20


def test_unified_master_names_source_tables(spark):
    df = spark.createDataFrame([("Client A", "V (1)", 1, "nice", "1"), ("client-b", "W", 2, "n/a", "Yes")],
                               "client_name string, venue_name string, respondent_id bigint, "
                               "welcome_comments string, "
                               "thinking_about_the_staff_please_select_the_words_that_best_desc string")
    c = views.comments_view(spark, df).collect()
    assert [(r.source_table, r.comment_text) for r in c] == [("client_a_master", "nice")]
    w = sorted((r.source_table, r.word_label) for r in views.staff_words_view(spark, df).collect())
    assert w == [("client_a_master", "Adept"), ("client_b_master", "Adept")]


def test_fixture_union_path_equals_wide_path(spark):
    from paths import SF_SMALL
    from visitlens.sources import fixtures as fx
    wide = fx.section_scores_wide(spark, SF_SMALL)
    a = views.total_score_view(fx.section_views(spark, SF_SMALL, wide))
    b = views.total_score_view(wide)
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    qa = views.question_scores_view(fx.section_views(spark, SF_SMALL, wide))
    qb = views.question_scores_view(wide)
    assert qa.exceptAll(qb).count() == 0 and qb.exceptAll(qa).count() == 0


def test_section_builder_feeds_reports(spark):
    df = spark.createDataFrame(
        [("c", "V (1)", 1, "1.0", "t", "05/03/2024", 3.0, 2.0, None, 0.0),
         ("c", "V (2)", 2, "2.0", "t", "06/03/2024", None, None, None, None)],
        KEYS + ", q1 double, q2 double, q3 double, q4 double")
    spec = {"service_score": {"service_arrival_score": ["q1", "q2"], "service_timing_score": ["q3"]},
            "selling_score": {"selling_written_score": ["q4"]},
            "product_score": {}, "environment_score": {}}
    wide = scoring.build_section_scores(df, spec)
    r = {x.respondent_id: x for x in wide.collect()}
    assert abs(r[1].service_arrival_score - 250 / 3) < 1e-9 and r[1].service_timing_score is None
    assert abs(r[1].service_score - 250 / 3) < 1e-9 and r[1].selling_score == 0.0
    assert r[2].service_score is None
    totals = {x.respondent_id: x.total_score for x in views.total_score_view(wide).collect()}
    assert totals == {"1": 41.7, "2": None}


def test_tie_break_is_fixed(spark):
    rows = [("c", "X (2)", 7, "1.0", "t", "01/02/2024", 50.0, None, None, None),
            ("c", "X (1)", 7, "1.0", "t", "01/02/2024", 60.0, None, None, None)]
    out = {r.venue_name_original: r.visit_rank for r in views.master_view(wide(spark, rows)).collect()}
    assert out == {"X (1)": 1, "X (2)": 2}


def test_outer_union_fills_missing_columns(spark):
    from visitlens.operators.reshape import outer_union
    a = spark.createDataFrame([(1, "x")], "a long, b string")
    b = spark.createDataFrame([("y", 2.5)], "b string, c double")
    out = outer_union([a, b])
    assert out.columns == ["a", "b", "c"]
    assert sorted(out.collect(), key=lambda r: r.b) == [(1, "x", None), (None, "y", 2.5)]
