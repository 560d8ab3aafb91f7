"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query builds its survey-shaped input from the star tables in
``sf_dir`` (see ``sources.fixtures``) and runs one report or operator on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens import config
from visitlens.functions import recode as R
from visitlens.functions import text as T_
from visitlens.operators import headers as H
from visitlens.operators import value_types as V
from visitlens.operators.profile import likert_by_file, likert_columns, name_profile, table_profile, to_long, value_counts
from visitlens.operators.reshape import outer_union
from visitlens.plans import master as M
from visitlens.plans import oracle, oracle_more, views
from visitlens.plans import recode as rc
from visitlens.plans.sql_views import ReportCatalog
from visitlens.sources import fixtures as fx
from visitlens.session import scratch_folder
from visitlens.sources.ingest import answer_cells, read_cells, split_errors
from visitlens.sources.tables import read_table


def _scores(spark, sf_dir):
    """Section scores as one wide frame (one scan, one aggregate)."""
    return fx.section_scores_wide(spark, sf_dir)


def q_section_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    from visitlens.operators.scoring import section_union_wide
    return section_union_wide(_scores(spark, sf_dir))


def q_total_score(spark, sf_dir):
    return views.total_score_view(_scores(spark, sf_dir))


def q_master(spark, sf_dir):
    return views.master_view(_scores(spark, sf_dir))


def q_latest_visit(spark, sf_dir):
    return views.latest_visit_view(_scores(spark, sf_dir))


def q_previous_visits(spark, sf_dir):
    return views.previous_visits_view(_scores(spark, sf_dir))


def q_trend(spark, sf_dir):
    return views.trend_view(_scores(spark, sf_dir))


def q_report_base(spark, sf_dir):
    return views.report_base_view(_scores(spark, sf_dir))


def q_question_scores(spark, sf_dir):
    return views.question_scores_view(_scores(spark, sf_dir))


def q_question_ratings(spark, sf_dir):
    return views.question_ratings_view(_scores(spark, sf_dir))


def q_section_breakdown(spark, sf_dir):
    return views.section_breakdown_view(_scores(spark, sf_dir))


def q_staff_behaviour(spark, sf_dir):
    return views.staff_behaviour_view(fx.feedback_service(spark, sf_dir))


def q_comments(spark, sf_dir):
    return views.comments_view(spark, {"fx_comment_master": fx.comment_master(spark, sf_dir)})


def q_staff_words(spark, sf_dir):
    return views.staff_words_view(spark, {"fx_word_master": fx.word_master(spark, sf_dir)})



# --- recoders (FX5-FX7) -------------------------------------------------------

def q_recommendation(spark, sf_dir):
    return rc.apply(fx.survey_wide(spark, sf_dir), "q_recommend", R.recommendation_score)


def q_speed(spark, sf_dir):
    return rc.apply(fx.survey_wide(spark, sf_dir), "q_drinks_speed",
                    lambda c: R.speed_score(c, config.DRINKS_ORDER_MAP))


def q_gender(spark, sf_dir):
    return rc.apply(fx.survey_wide(spark, sf_dir), "q_gender", R.gender)


def q_staff_binary(spark, sf_dir):
    df = fx.word_master(spark, sf_dir)
    cols = rc.checkbox_columns(df)
    return rc.replace_columns(df.select("respondent_id", *cols), {c: R.checkbox_flag for c in cols})


def q_likert_columns(spark, sf_dir):
    return likert_columns(fx.survey_wide(spark, sf_dir))


def q_likert(spark, sf_dir):
    df = fx.survey_wide(spark, sf_dir)
    # metadata only: one row per column of the profile reaches the driver
    chosen = [r[0] for r in likert_columns(df).where("is_likert").select("column_name").collect()]
    return df.select("respondent_id", *[R.likert_score(F.col(c)).alias(c) for c in sorted(chosen)])


def q_value_counts(spark, sf_dir):
    df = fx.survey_wide(spark, sf_dir)
    recoded = df.select(R.gender(F.col("q_gender")).alias("q_gender"),
                        R.speed_score(F.col("q_drinks_speed"), config.DRINKS_ORDER_MAP).alias("q_drinks_speed"))
    return value_counts(recoded, ["q_gender", "q_drinks_speed"])


def q_nan_to_null(spark, sf_dir):
    return rc.apply(fx.survey_wide(spark, sf_dir), "q_number", R.nan_to_null)


def q_spend(spark, sf_dir):
    df = fx.raw_text(spark, sf_dir)
    cols = rc.spend_columns(df)
    return rc.replace_columns(df.select("respondent_id", *cols), {c: R.spend_amount for c in cols})


def q_arrival_time(spark, sf_dir):
    df = fx.raw_text(spark, sf_dir)
    cols = rc.time_columns(df)
    return rc.replace_columns(df.select("respondent_id", *cols), {c: R.arrival_time for c in cols})


def q_parse_dates(spark, sf_dir):
    return rc.apply(fx.raw_text(spark, sf_dir), "date_of_visit", R.day_first_date)


def q_guests(spark, sf_dir):
    return rc.apply(fx.raw_text(spark, sf_dir), "number_of_guests", R.guest_count)


# --- files and headers (FX8) --------------------------------------------------

def q_path_columns(spark, sf_dir):
    f = fx.survey_files(spark, sf_dir)
    return f.select("file_id", "path",
                    T_.path_parent_name("path").alias("client_name"),
                    T_.venue_from_stem(T_.path_stem("path")).alias("venue_name"),
                    T_.table_name_for(T_.path_parent_name("path")).alias("table_name"))


def q_flatten_header(spark, sf_dir):
    return H.flatten(fx.survey_headers(spark, sf_dir)).select("file_id", "col_ord", "header")


def q_drop_footer(spark, sf_dir):
    return H.drop_footer(H.flatten(fx.survey_headers(spark, sf_dir))).select("file_id", "col_ord", "header")


def q_clean_identifier(spark, sf_dir):
    hdr = H.with_identifiers(H.flatten(fx.survey_headers(spark, sf_dir)))
    return hdr.select("file_id", "col_ord", "header", "identifier")


def q_unique_identifiers(spark, sf_dir):
    d = H.header_dictionary(fx.survey_headers(spark, sf_dir))
    return d.select("file_id", "col_ord", "identifier", "unique_name")


SECTION_SPEC = {"service_score": {"service_arrival_score": ["q_clean", "q_only_na"]},
                "selling_score": {"selling_verbal_score": ["q_recommend_score"]}}


def q_section_builder(spark, sf_dir):
    from visitlens.operators.scoring import build_section_scores
    df = fx.survey_wide(spark, sf_dir)
    recoded = df.select("client_name", "venue_name", "respondent_id",
                        R.likert_score(F.col("q_clean")).alias("q_clean"),
                        R.likert_score(F.col("q_only_na")).alias("q_only_na"),
                        # recommendation 0-2 read on the 0-3 scale of its section
                        R.recommendation_score(F.col("q_recommend")).alias("q_recommend_score"))
    return build_section_scores(recoded, SECTION_SPEC, ["client_name", "venue_name", "respondent_id"])


def _fixture_answers(df, key_cols):
    """Long answers of a fixture master: every non-key column as (column_name, value)."""
    from visitlens.operators.profile import to_long
    cols = [c for c in df.columns if c not in key_cols]
    return to_long(df, cols, key_cols)


def q_comments_long(spark, sf_dir):
    ans = _fixture_answers(fx.comment_master(spark, sf_dir), ["client_name", "venue_name", "respondent_id"])
    return views.comments_from_answers(spark, ans)


def q_staff_words_long(spark, sf_dir):
    ans = _fixture_answers(fx.word_master(spark, sf_dir), ["client_name", "venue_name", "respondent_id"])
    return views.staff_words_from_answers(spark, ans)


def q_client_table_profile(spark, sf_dir):
    return table_profile(fx.comment_master(spark, sf_dir), "client_name")


def q_table_profile(spark, sf_dir):
    return name_profile(H.header_dictionary(fx.survey_headers(spark, sf_dir)))


# --- master assembly (FX1) ----------------------------------------------------

def q_outer_union(spark, sf_dir):
    v = fx.fx_visit(spark, sf_dir)
    first = F.substring("visit_type", 1, 1)
    frames = [
        v.where(first.isin("1", "2")).select("respondent_id", "client_name", "venue_name", "visit_type"),
        v.where(first == "3").select("respondent_id", "client_name", "assessor_id", "visit_date_raw"),
        v.where(F.coalesce(~first.isin("1", "2", "3"), F.lit(True))).select("client_name", "respondent_id", "venue_name",
                                                   "visit_date_raw", "assessor_id"),
    ]
    return outer_union(frames)


def q_client_ids(spark, sf_dir):
    return M.with_client_ids(fx.fx_visit(spark, sf_dir))


# --- drifting survey files built from whole documents -------------------------

WORD_QUESTION = "Thinking about the staff, please select the words that best describe them"
#: Words in two layouts of one client: the second lacks a column of the first.
LAYOUTS = {"full": ["Adept", "Awkward", "Confident"], "short": ["Adept", "Confident"]}


def _document_cells(spark, sf_dir):
    """Decoded cells as ``sources.ingest`` yields them: one survey row per
    document, the client is its source, ticks follow from its text."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", F.length("text").alias("n"))
    tick = {"Adept": F.col("n") % 2 == 0, "Awkward": F.col("n") % 3 == 0, "Confident": F.col("n") % 5 < 2}
    layout = F.when(F.col("doc_id") % 2 == 0, F.lit("full")).otherwise(F.lit("short"))
    rows = docs.withColumn("layout", layout).withColumn("path", F.concat_ws("/", F.lit("/in"), "source", F.concat("layout", F.lit(".csv"))))
    found = []
    for name, words in LAYOUTS.items():
        headers = [("Respondent ID", "Unnamed: 0_level_1"), *[(WORD_QUESTION, w) for w in words]]
        cells = [F.struct(F.lit(i).alias("col_ord"), F.lit(top).alias("header_top"), F.lit(sub).alias("header_sub"),
                          (F.when(tick[sub], F.lit("Yes")) if sub in tick else F.col("doc_id").cast("string")).alias("value"))
                 for i, (top, sub) in enumerate(headers)]
        found.append(rows.where(F.col("layout") == name).select(
            "path", F.col("doc_id").alias("row_id"), F.lit(len(words)).alias("last_ord"),
            F.col("doc_id").cast("string").alias("respondent_id"), F.explode(F.array(*cells)).alias("c")))
    return found[0].unionByName(found[1]).select(
        "path", "row_id", "c.col_ord", "last_ord", "c.header_top", "c.header_sub", F.lit(0).alias("nth"),
        "respondent_id", "c.value")


def q_ingest_words(spark, sf_dir):
    return views.staff_words_from_answers(spark, answer_cells(_document_cells(spark, sf_dir)))


def q_likert_by_file(spark, sf_dir):
    """One column per source, Likert in some sources and free text in others."""
    docs = read_table(spark, sf_dir, "documents")
    free = (F.length("source") % 2 == 0) & (F.col("doc_id") % 7 == 0)
    grade = F.element_at(F.array(*[F.lit(x) for x in ("Good", " very good", "n/a", "Poor")]),
                         (F.length("text") % 4 + 1).cast("int"))
    answers = docs.select(F.col("source").alias("file_id"), F.lit(1).alias("col_ord"), F.lit("Food Rating").alias("header"),
                          F.col("doc_id").alias("respondent_id"), F.when(free, F.col("text")).otherwise(grade).alias("value"))
    return likert_by_file(answers, ["file_id", "col_ord"], name="header").select(
        "file_id", "respondent_id", "is_likert", "likert_score")


# --- loads: split exports and value-driven types --------------------------------

def _survey_exports(spark, sf_dir) -> str:
    """CSV exports with two header rows, written from the documents: one folder a
    client, one row a document, texts quoted with their line breaks."""
    docs = read_table(spark, sf_dir, "documents")
    part = (F.col("doc_id") % 4).cast("string")
    rows = docs.select(F.concat("source", F.lit("-"), part).alias("client"), F.lit(1).alias("_n"),
                       F.col("doc_id").cast("string").alias("Respondent ID"), F.col("text").alias("Visit"), F.col("lang").alias("_lang"))
    second = rows.select("client").distinct().select(
        "client", F.lit(0).alias("_n"), F.lit("").alias("Respondent ID"), F.lit("Comments").alias("Visit"), F.lit("Language").alias("_lang"))
    root = scratch_folder(spark, "exports")
    out = rows.unionByName(second).repartition("client").sortWithinPartitions("client", "_n").drop("_n")
    # the second top cell stays blank, as under a merged header
    out = out.toDF("client", "Respondent ID", "Visit", "")
    out.write.partitionBy("client").option("header", True).option("quoteAll", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(root)
    return root


def q_split_csv(spark, sf_dir):
    cells, _ = split_errors(read_cells(spark, _survey_exports(spark, sf_dir)))
    return answer_cells(cells).select(
        F.regexp_replace("client_name", "^client=", "").alias("client_name"), "respondent_id", "col_ord", "header",
        F.length("value").alias("n_chars"), F.sha2("value", 256).alias("value_sha256"))


def q_column_types(spark, sf_dir):
    df = fx.load_text(spark, sf_dir)
    cols = [c for c in df.columns if c not in ("respondent_id", "client_name")]
    return V.column_types(to_long(df, cols, ["client_name"]), ["client_name", "column_name"])


def q_typed_load(spark, sf_dir):
    df = V.with_inferred_types(fx.load_text(spark, sf_dir))
    return df.withColumn("stamped", F.date_format("stamped", "yyyy-MM-dd HH:mm:ss"))


def q_catalog_report(spark, sf_dir):
    """The report base, read through persistent views over saved tables."""
    folder = scratch_folder(spark, "report")
    database = "vl_" + folder.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}'")
    catalog = ReportCatalog(spark, database)
    catalog.save_tables(_scores(spark, sf_dir), fx.feedback_service(spark, sf_dir), {"fx_comment_master": fx.comment_master(spark, sf_dir)})
    catalog.create()
    return spark.table(f"{database}.vw_report_base_powerbi")


QUERIES = {
    "catalog_report": q_catalog_report,
    "ingest_words": q_ingest_words,
    "split_csv": q_split_csv,
    "column_types": q_column_types,
    "typed_load": q_typed_load,
    "likert_by_file": q_likert_by_file,
    "section_union": q_section_union,
    "total_score": q_total_score,
    "master": q_master,
    "latest_visit": q_latest_visit,
    "previous_visits": q_previous_visits,
    "trend": q_trend,
    "report_base": q_report_base,
    "question_scores": q_question_scores,
    "question_ratings": q_question_ratings,
    "section_breakdown": q_section_breakdown,
    "staff_behaviour": q_staff_behaviour,
    "comments": q_comments,
    "staff_words": q_staff_words,
    "recommendation": q_recommendation,
    "speed": q_speed,
    "gender": q_gender,
    "staff_binary": q_staff_binary,
    "likert_columns": q_likert_columns,
    "likert": q_likert,
    "value_counts": q_value_counts,
    "nan_to_null": q_nan_to_null,
    "spend": q_spend,
    "arrival_time": q_arrival_time,
    "parse_dates": q_parse_dates,
    "guests": q_guests,
    "path_columns": q_path_columns,
    "flatten_header": q_flatten_header,
    "drop_footer": q_drop_footer,
    "clean_identifier": q_clean_identifier,
    "unique_identifiers": q_unique_identifiers,
    "table_profile": q_table_profile,
    "client_table_profile": q_client_table_profile,
    "section_builder": q_section_builder,
    "comments_long": q_comments_long,
    "staff_words_long": q_staff_words_long,
    "outer_union": q_outer_union,
    "client_ids": q_client_ids,
}


def oracle_queries() -> dict[str, str]:
    out = {}
    out.update(oracle.view_queries())
    out.update(oracle_more.queries())
    return {k: v for k, v in out.items() if k in QUERIES}
