"""Edge rows for each recoder (literal inputs)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from visitlens import config
from visitlens.functions import recode as R
from visitlens.functions import text as T


def run(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_likert(spark):
    assert run(spark, ["n/a", " Very Good ", "POOR", "fair", "good", "average", None],
               R.likert_score) == [None, 3.0, 0.0, 1.0, 2.0, None, None]


def test_recommendation_not_very_likely_scores_zero(spark):
    assert run(spark, ["Not very likely", "Very likely", "quite likely ", "unsure", None],
               R.recommendation_score) == [0.0, 2.0, 1.0, None, None]


def test_speed(spark):
    m = config.DRINKS_ORDER_MAP
    assert run(spark, ["Within three minutes", " N/A", "na", "unknown", "greater than five minutes"],
               lambda c: R.speed_score(c, m)) == [3.0, None, None, None, 0.0]


def test_gender(spark):
    assert run(spark, [" F", "female", "M", "MALE ", "other", None],
               R.gender) == ["Female", "Female", "Male", "Male", None, None]


def test_checkbox(spark):
    assert run(spark, [None, " ", "\t", "Adept", "0"], R.checkbox_flag) == [0, 0, 0, 1, 1]


def test_spend(spark):
    assert run(spark, ["AUD 1,250.00", "1.2.3", "", "-12", "$10.50", ".", "12."],
               R.spend_amount) == [1250.0, None, None, 12.0, 10.5, None, 12.0]


def test_arrival_time(spark):
    assert run(spark, ["7pm", "7:05 PM", "12:00:59 pm", "19:30", "13pm", "07.30 am", "late", None],
               R.arrival_time) == ["7.00 pm", "7.05 pm", "12.00 pm", None, None, "7.30 am", None, None]


def test_arrival_time_short_fields(spark):
    assert run(spark, ["7.5pm", "7:5:3 pm", "7.055pm", "11:59:59 PM"],
               R.arrival_time) == ["7.05 pm", "7.05 pm", None, "11.59 pm"]


def test_day_first_dates(spark):
    d = dt.date(2024, 9, 5)
    assert run(spark, ["31/02/2024", "5/9/2024", "2024-09-05", "05-09-2024", "soon"],
               R.day_first_date) == [None, d, d, d, None]


def test_guarded_visit_date(spark):
    assert run(spark, ["31/02/2024", "05/24/0018", "2024-09-05", None, "01/01/2023", "31/12/2022"],
               R.guarded_visit_date) == [None, None, None, None, dt.date(2023, 1, 1), dt.date(2022, 12, 31)]


def test_guests(spark):
    assert run(spark, ["Two", " twenty-three ", "one hundred and five", "many", "4", "2.0", "six guests",
                       "two thousand and five", "hundred", None, "two point five", "pointless"],
               R.guest_count) == [2, 23, 105, None, 4, 2, 6, 2005, 100, None, 2, None]


def test_nan_to_null(spark):
    assert run(spark, [float("nan"), None, 2.0], R.nan_to_null, "double") == [None, None, 2.0]


def test_py_strip_matches_python(spark):
    vals = [" a ", "\ta\n", " a ", "\x1ca\x1f", "a", ""]
    assert run(spark, vals, T.py_strip) == [v.strip() for v in vals]


@pytest.mark.parametrize("raw,expected", [
    ("NATION_0_iGUEST-Survey v2.1", "NATION 0"),
    ("SRC1_3 Survey V3 (1)", "SRC1 3 (1)"),
    ("X--iguest__survey", "X"),
])
def test_venue_from_stem(spark, raw, expected):
    assert run(spark, [raw], T.venue_from_stem) == [expected]


def test_clean_identifier(spark):
    assert run(spark, ["3rd visit?", "Welcome: Comments!", "a 1", "__x__"],
               T.clean_identifier) == ["col_3rd_visit", "welcome_comments", "a_1", "x"]


def test_null_tokens_and_truthy(spark):
    vals = [" N/A ", "nan", "NONE", "   ", None, " ok "]
    assert run(spark, vals, T.is_null_token) == [True, True, True, True, True, False]
    vals = ["1.0", " Yes ", "True", "YES", "0", None]
    assert run(spark, vals, T.is_truthy) == [True, True, False, False, False, False]


def test_plain_number(spark):
    vals = ["3", "3.0", "-1", "1e2", "NaN", ".5", "3\n"]
    assert run(spark, vals, T.is_plain_number) == [True, True, False, False, False, False, False]


def test_text_identity_keeps_null(spark):
    assert run(spark, ["a@b.c", None, "Ann"], R.text_identity) == ["a@b.c", None, "Ann"]


def test_recode_chain_by_column_name(spark):
    from visitlens.plans.recode import recode_survey
    cols = ["Email Address", "please_enter_your_details_here_gender",
            "how_likely_would_you_be_to_recommend_this_establishment_respons",
            "total_expenditure_response", "time_you_arrived", "date_of_your_visit_this_visit",
            "please_enter_the_number_of_guests_in_your_party_response", "welcome_rating",
            "speed_of_hot_beverage_service_how_long_did_it_take_to_receive_y"]
    df = spark.createDataFrame([(None, " m", "Not very likely", "$5", "7pm", "5/9/2024", "two", "Good",
                                 "Between five and six minutes")],
                               ", ".join(f"`{c}` string" for c in cols))
    r = recode_survey(df).collect()[0]
    assert r["Email Address"] is None and r["please_enter_your_details_here_gender"] == "Male"
    assert r["how_likely_would_you_be_to_recommend_this_establishment_respons"] == 0.0
    assert r["total_expenditure_response"] == 5.0 and r["time_you_arrived"] == "7.00 pm"
    assert str(r["date_of_your_visit_this_visit"]) == "2024-09-05"
    assert r["please_enter_the_number_of_guests_in_your_party_response"] == 2
    assert r["welcome_rating"] == 2.0  # detected as a Likert column from its values
    assert r["speed_of_hot_beverage_service_how_long_did_it_take_to_receive_y"] == 2.0


def test_dates_in_other_layouts(spark):
    from visitlens.functions.recode import day_first_date
    texts = ["2024-06-01 19:30:00", "2024-06-01T08:00:00", "1.6.2024", "01/06/24", "1 June 2024", "1st Jun 2024", "1-Jun-2024",
             "01/06/2024 7:05 PM", "31/02/2024", "June", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: str(r.d) if r.d else None for r in df.select("i", day_first_date(F.col("t")).alias("d")).collect()}
    assert [got[i] for i in range(len(texts))] == ["2024-06-01"] * 8 + [None] * 4


def test_long_numbers_do_not_stop_the_staff_view(spark):
    from visitlens.plans.views import staff_behaviour_view
    from visitlens import config
    metrics = [c for c, _ in config.STAFF_METRICS]
    df = spark.createDataFrame([("c", "v", "1", "a", "01/01/2024", "9" * 40, "61412345678901", "3", "2.0")[:5 + len(metrics)]],
                               ", ".join(f"{n} string" for n in ["client_name", "venue_name", "respondent_id", "assessor_id",
                                                                  "visit_date_raw", *metrics][:9]))
    df = df.withColumns({m: F.lit(None).cast("string") for m in metrics if m not in df.columns})
    scores = [r.score for r in staff_behaviour_view(df).collect()]
    assert any(s > 1e40 for s in scores) and 100.0 in scores
