"""The report views, as DataFrame functions.

Each function returns a lazy DataFrame; ``register_views`` registers all of
them as temp views in dependency order (the catalog equivalent of dropping
and re-creating the reporting views).

Inputs:
  ``scores``   section scores, either a dict ``{section: frame}`` of the four
               section views, or one wide frame holding all four sections;
  ``feedback`` staff feedback frame (0-3 answers as text or numbers);
  ``tables``   dict ``{table name: client master frame}``, or one unified
               master of all clients, for comments and checkbox words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlens import config
from visitlens.functions.text import clean_identifier, clean_venue, is_null_token, is_plain_number, is_truthy
from visitlens.operators import scoring
from visitlens.operators.ranking import balanced_row_number, top_n_per_group
from visitlens.operators.reshape import map_frame, union_all, unpivot_labeled, unpivot_mapped

DEC = "decimal(38,6)"

MASTER_COLUMNS = [
    "visit_id", "client_name", "venue_name", "venue_name_original", "respondent_id",
    "assessor_id", "visit_type", "visit_date_raw", "visit_date", "service_score",
    "selling_score", "product_score", "environment_score", "total_score", "visit_rank",
    "is_latest_visit", "is_previous_10_visits", "visit_group", "performance_band",
]


def _all_scores(scores) -> DataFrame:
    if isinstance(scores, dict):
        return scoring.section_union(scores)
    return scoring.wide_scores(scores)


def _visit_columns(with_assessor: bool = True, with_date: bool = True):
    cols = [F.concat_ws("|", F.col("client_name").cast("string"), clean_venue(F.col("venue_name").cast("string")),
                        F.col("respondent_id").cast("string")).alias("visit_id"),
            F.col("client_name").cast("string").alias("client_name"),
            clean_venue(F.col("venue_name").cast("string")).alias("venue_name"),
            F.col("respondent_id").cast("string").alias("respondent_id")]
    if with_assessor:
        cols.append(F.col("assessor_id").cast("string").alias("assessor_id"))
    if with_date:
        cols.append(F.col("visit_date_raw"))
    return cols


# --- total score, master and the visit lists ---------------------------------

def total_score_view(scores) -> DataFrame:
    return scoring.total_score(_all_scores(scores))


def _rank_order():
    # date desc nulls last, respondent (as text) desc with nulls first as in
    # PostgreSQL, then a fixed tie-break
    return [F.col("visit_date").desc_nulls_last(), F.col("respondent_id").desc_nulls_first(),
            F.col("venue_name_original").asc_nulls_first(), F.col("assessor_id").asc_nulls_first(),
            F.col("assessor_id_raw").asc_nulls_first(), F.col("visit_type").asc_nulls_first(),
            F.col("visit_date_raw").asc_nulls_first()]


def _with_flags(ranked: DataFrame) -> DataFrame:
    rank = F.col("visit_rank")
    lo, hi = config.PREVIOUS_RANKS
    return ranked.select(
        *[c for c in MASTER_COLUMNS[:14]],
        rank.cast("long").alias("visit_rank"),
        F.coalesce(rank == config.LATEST_RANK, F.lit(False)).alias("is_latest_visit"),
        F.coalesce(rank.between(lo, hi), F.lit(False)).alias("is_previous_10_visits"),
        scoring.visit_group(rank).alias("visit_group"),
        scoring.performance_band(F.col("total_score")).alias("performance_band"),
    )


def master_view(scores) -> DataFrame:
    """Every filtered visit with its rank inside (client, venue), flags and band."""
    total = scoring.total_score(_all_scores(scores), keep_raw_assessor=True)
    ranked = balanced_row_number(total, ["client_name", "venue_name"], _rank_order(), "visit_rank")
    return _with_flags(ranked)


def latest_visit_view(scores) -> DataFrame:
    total = scoring.total_score(_all_scores(scores), keep_raw_assessor=True)
    top = top_n_per_group(total, ["client_name", "venue_name"], _rank_order(),
                          n_max=config.LATEST_RANK, out_col="visit_rank")
    return _with_flags(top)


def previous_visits_view(scores) -> DataFrame:
    lo, hi = config.PREVIOUS_RANKS
    total = scoring.total_score(_all_scores(scores), keep_raw_assessor=True)
    top = top_n_per_group(total, ["client_name", "venue_name"], _rank_order(),
                          n_max=hi, n_min=lo, out_col="visit_rank")
    return _with_flags(top)


def trend_view(scores) -> DataFrame:
    return master_view(scores)


def report_base_view(scores) -> DataFrame:
    return master_view(scores).select(*MASTER_COLUMNS)


# --- question / category scores ----------------------------------------------

def _score_sources(scores) -> list[DataFrame]:
    return list(scores.values()) if isinstance(scores, dict) else [scores]


def question_scores_view(scores) -> DataFrame:
    """One row per answered category: unpivoted, nulls dropped, rounded to 2."""
    parts = []
    for df in _score_sources(scores):
        long = unpivot_labeled(df, _visit_columns(), config.QUESTION_LABELS, "question_score",
                               ("section", "question_name"), value_type="double", drop_nulls=True)
        parts.append(long)
    out = union_all(parts)
    return out.withColumn("question_score",
                          F.round(F.col("question_score").cast(DEC), 2).cast("double"))


def question_ratings_view(scores) -> DataFrame:
    qs = question_scores_view(scores)
    return qs.withColumn("rating", scoring.rating(F.col("question_score")))


def section_breakdown_view(scores) -> DataFrame:
    """Every category of every visit, nulls kept, values unrounded."""
    parts = []
    for df in _score_sources(scores):
        parts.append(unpivot_labeled(df, _visit_columns(with_assessor=False, with_date=False),
                                     config.BREAKDOWN_LABELS, "score", ("section", "category"),
                                     value_type="double", drop_nulls=False))
    return union_all(parts)


def staff_behaviour_view(feedback: DataFrame) -> DataFrame:
    """Staff metrics 0-3 rescaled to 0-100; only plain numeric answers count."""
    labels = [(config.STAFF_SECTION, col, label) for col, label in config.STAFF_METRICS]
    long = unpivot_labeled(feedback, _visit_columns(), labels, "score",
                           ("section", "behaviour_metric"), value_type="string")
    long = long.where(is_plain_number(F.col("score")))
    # beyond a decimal's digits the share is taken in floating point
    number = F.col("score").try_cast("double")
    exact = F.round(F.col("score").cast(DEC) / F.lit(config.STAFF_SCALE_MAX).cast("decimal(2,1)") * 100, 2)
    scaled = F.when(F.abs(number) < 1e28, exact.cast("double")).otherwise(
        F.round(number / float(config.STAFF_SCALE_MAX) * 100, 2))
    return long.withColumn("score", scaled.cast("double"))


# --- comments and checkbox words ----------------------------------------------

COMMENT_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in (
    "visit_id", "client_name", "venue_name", "respondent_id", "section", "comment_type",
    "comment_text", "source_table")])
WORD_SCHEMA = T.StructType([
    *[T.StructField(n, T.StringType()) for n in (
        "visit_id", "client_name", "venue_name", "respondent_id", "word_group", "word_label")],
    T.StructField("selected_flag", T.IntegerType()),
    T.StructField("source_table", T.StringType())])


def _sources(tables) -> list[tuple[object, DataFrame]]:
    """``{name: frame}`` -> [(literal name, frame)]; one unified frame ->
    [(per-row table name from its client, frame)]."""
    from visitlens.functions.text import table_name_for
    if isinstance(tables, DataFrame):
        return [(table_name_for(F.col("client_name").cast("string")), tables)]
    return [(F.lit(name), df) for name, df in tables.items()]


def comments_view(spark: SparkSession, tables, comment_map=None) -> DataFrame:
    """Free-text comments of every mapped column present in each table.

    ``tables`` is ``{table name: frame}`` or one unified master of all
    clients (then ``source_table`` is each client's table name and the whole
    master is read in one scan). Blank cells and 'no comment' tokens are
    dropped; the text is kept as is.
    """
    rows = comment_map or config.COMMENT_MAP
    m = map_frame(spark, rows, ["section", "comment_type", "column_name"])
    parts = []
    for name, df in _sources(tables):
        if isinstance(tables, DataFrame):
            df = df.withColumn("_vl_source", name)
            name = F.col("_vl_source")
            ids = _visit_columns(False, False) + [name]
        else:
            ids = _visit_columns(False, False)
        long = unpivot_mapped(df, ids, m, rows, keep=~is_null_token(F.col("_vl_value")))
        if long is None:
            continue
        parts.append(long.select("visit_id", "client_name", "venue_name", "respondent_id",
                                 "section", "comment_type", F.col("_vl_value").alias("comment_text"),
                                 name.alias("source_table")))
    if not parts:
        return spark.createDataFrame([], COMMENT_SCHEMA)
    return union_all(parts)


def staff_words_view(spark: SparkSession, tables, word_map=None) -> DataFrame:
    """One row per selected checkbox word (value 1 / true / yes).

    ``tables`` as in ``comments_view``.
    """
    rows = word_map or config.WORD_MAP
    m = map_frame(spark, rows, ["word_group", "word_label", "column_name"])
    parts = []
    for name, df in _sources(tables):
        if isinstance(tables, DataFrame):
            df = df.withColumn("_vl_source", name)
            name = F.col("_vl_source")
            ids = _visit_columns(False, False) + [name]
        else:
            ids = _visit_columns(False, False)
        long = unpivot_mapped(df, ids, m, rows, keep=is_truthy(F.col("_vl_value")))
        if long is None:
            continue
        parts.append(long.select("visit_id", "client_name", "venue_name", "respondent_id",
                                 "word_group", "word_label", F.lit(1).alias("selected_flag"),
                                 name.alias("source_table")))
    if not parts:
        return spark.createDataFrame([], WORD_SCHEMA)
    return union_all(parts)


def _answer_keys() -> list:
    return [F.concat_ws("|", F.col("client_name").cast("string"), clean_venue(F.col("venue_name").cast("string")),
                        F.col("respondent_id").cast("string")).alias("visit_id"),
            F.col("client_name").cast("string").alias("client_name"),
            clean_venue(F.col("venue_name").cast("string")).alias("venue_name"),
            F.col("respondent_id").cast("string").alias("respondent_id")]


def _mapped_answers(spark: SparkSession, answers: DataFrame, rows, names, keep) -> DataFrame:
    m = map_frame(spark, rows, names)
    hits = answers.join(F.broadcast(m), on="column_name", how="inner").where(keep)
    return hits.select(
        *_answer_keys(),
        *[F.col(n) for n in names if n != "column_name"],
        F.col("value"), table_name_for_col())


def table_name_for_col():
    from visitlens.functions.text import table_name_for
    return table_name_for(F.col("client_name").cast("string")).alias("source_table")


def comments_from_answers(spark: SparkSession, answers: DataFrame, comment_map=None) -> DataFrame:
    """``comments_view`` over long answers (``plans.master.answers``).

    The mapped columns are picked by a broadcast join with the comment map
    (fixed size), so no wide master is built; ``source_table`` is each
    client's table name.
    """
    rows = comment_map or config.COMMENT_MAP
    out = _mapped_answers(spark, answers, rows, ["section", "comment_type", "column_name"],
                          ~is_null_token(F.col("value")))
    return out.select("visit_id", "client_name", "venue_name", "respondent_id", "section",
                      "comment_type", F.col("value").alias("comment_text"), "source_table")


def staff_words_from_answers(spark: SparkSession, answers: DataFrame, word_map=None) -> DataFrame:
    """``staff_words_view`` over long answers.

    Answers that carry their headers are matched by question and sub-header
    (the word itself), whatever suffix a file's column order gave the name.
    """
    rows = word_map or config.WORD_MAP
    if "header_sub" in answers.columns:
        question = {g: c for g, w, c in reversed(rows)}  # the first word's column has the plain name
        rows = [(g, w, question[g], w) for g, w, _ in rows]
        asked = answers.withColumn("column_name", clean_identifier(F.col("header"), max_len=config.MAX_IDENTIFIER_LEN))
        m = map_frame(spark, rows, ["word_group", "word_label", "column_name", "_word"])
        word = clean_identifier(F.col("header_sub")) == clean_identifier(F.col("_word"))
        hits = asked.join(F.broadcast(m), "column_name").where(word & is_truthy(F.col("value")))
        out = hits.select(*_answer_keys(), "word_group", "word_label", table_name_for_col())
    else:
        out = _mapped_answers(spark, answers, rows, ["word_group", "word_label", "column_name"],
                              is_truthy(F.col("value")))
    return out.select("visit_id", "client_name", "venue_name", "respondent_id", "word_group",
                      "word_label", F.lit(1).alias("selected_flag"), "source_table")


# --- registration ----------------------------------------------------------------

VIEW_NAMES = [
    "vw_total_score_final", "vw_powerbi_master_final", "vw_latest_visit_score_final",
    "vw_previous_visits_score_final", "vw_trend_score_final", "vw_question_scores",
    "vw_question_scores_powerbi", "vw_section_breakdown_final", "vw_staff_behaviour_powerbi",
    "vw_full_survey_comments_powerbi", "vw_comments_powerbi", "vw_staff_service_words_powerbi",
    "vw_report_base_powerbi",
]


def build_views(spark: SparkSession, scores, feedback: DataFrame, tables: dict) -> dict:
    """All report views by name (frames); the visits are ranked once for the three
    views that show them."""
    comments = comments_view(spark, tables)
    master = master_view(scores)
    return {
        "vw_total_score_final": total_score_view(scores),
        "vw_powerbi_master_final": master,
        "vw_latest_visit_score_final": latest_visit_view(scores),
        "vw_previous_visits_score_final": previous_visits_view(scores),
        "vw_trend_score_final": master,
        "vw_question_scores": question_scores_view(scores),
        "vw_question_scores_powerbi": question_ratings_view(scores),
        "vw_section_breakdown_final": section_breakdown_view(scores),
        "vw_staff_behaviour_powerbi": staff_behaviour_view(feedback),
        "vw_full_survey_comments_powerbi": comments,
        "vw_comments_powerbi": comments.select(*COMMENT_SCHEMA.fieldNames()),
        "vw_staff_service_words_powerbi": staff_words_view(spark, tables),
        "vw_report_base_powerbi": master.select(*MASTER_COLUMNS),
    }


def register_views(spark: SparkSession, scores, feedback: DataFrame, tables: dict) -> list[str]:
    """(Re)register every report view as a temp view, in dependency order."""
    views = build_views(spark, scores, feedback, tables)
    for name in VIEW_NAMES:
        views[name].createOrReplaceTempView(name)
    return list(VIEW_NAMES)
