"""Survey-shaped inputs projected from the star tables.

The report views read per-client survey tables and four section score
views. The test and benchmark data only hold the star tables, so these
functions project them into the survey shapes (same rules as the SQL in
``fixture_sql``, which the DuckDB oracle runs). All of them read whole
tables, so their work grows with the data.

Plan notes (scale):
  * ``fx_visit`` joins orders -> customer (shuffle on custkey) and the
    nation/region dimension (AQE broadcasts it from runtime size).
  * ``section_scores_wide`` aggregates lineitem by order key first (partial
    aggregation, one shuffle), then joins the visits 1:1 on the order key, so
    the four section views come from one scan and one aggregate instead of
    four joins of the raw line items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens import config
from visitlens.sources.tables import read_table

VISIT_KEYS = ["client_name", "venue_name", "respondent_id", "assessor_id",
              "visit_type", "visit_date_raw"]


def _pad2(c):
    return F.lpad(c.cast("string"), 2, "0")


def fx_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One survey visit per order (FX1)."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(geo, F.col("c_nationkey") == F.col("n_nationkey")))
    k = F.col("o_orderkey")
    name = F.col("n_name")
    venue = (F.when(k % 97 == 0, F.concat(name, F.lit(" Report")))
              .when(k % 89 == 0, F.concat(F.lit("iShop "), name))
              .when(k % 83 == 0, F.concat(name, F.lit(" iSales")))
              .when(k % 4 == 0, F.concat(name, F.lit(" (1)")))
              .when(k % 4 == 1, F.concat(name, F.lit(" (12)")))
              .otherwise(name))
    d = F.col("o_orderdate")
    year27 = (F.year(d) + 27).cast("string")
    date_raw = (F.when(k % 101 == 0, F.concat(_pad2(F.month(d)), F.lit("/"), _pad2(F.dayofmonth(d)), F.lit("/0018")))
                 .when(k % 103 == 0, F.concat(year27, F.lit("-"), _pad2(F.month(d)), F.lit("-"), _pad2(F.dayofmonth(d))))
                 .when(k % 107 == 0, F.lit(None).cast("string"))
                 .otherwise(F.concat(_pad2(F.dayofmonth(d)), F.lit("/"), _pad2(F.month(d)), F.lit("/"), year27)))
    return j.select(
        k.alias("respondent_id"),
        F.concat(F.lit("client_"), F.lower("r_name")).alias("client_name"),
        venue.alias("venue_name"),
        F.concat((F.col("o_custkey") % 50).cast("string"), F.lit(".0")).alias("assessor_id"),
        F.col("o_orderpriority").alias("visit_type"),
        date_raw.alias("visit_date_raw"),
    )


def section_scores_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four section score views as one wide frame (FX2).

    Columns: the six visit keys, 19 category scores and 4 section scores.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    ln = F.col("l_linenumber")
    service_v = F.col("l_quantity") * 2
    selling_v = F.round(F.col("l_discount") * 100).cast("int") * F.lit(10.0)
    product_v = F.round(F.col("l_tax") * 100).cast("int") * F.lit(12.5)
    env_v = F.lit(100) - F.col("l_quantity")
    aggs = []
    for section, value in (("service", service_v), ("selling", selling_v),
                           ("product", product_v), ("environment", env_v)):
        total_col, cats = config.SECTION_COLUMNS[section]
        for i, cat in enumerate(cats, start=1):
            aggs.append(F.max(F.when(ln == i, value)).alias(cat))
        aggs.append(F.avg(F.when(ln <= len(cats), value)).alias(total_col))
    per_order = li.groupBy("l_orderkey").agg(*aggs)
    v = fx_visit(spark, sf_dir)
    return v.join(per_order, v.respondent_id == per_order.l_orderkey).drop("l_orderkey")


def section_views(spark: SparkSession, sf_dir: str, wide: DataFrame | None = None) -> dict:
    """The four section score views as separate frames over the wide frame."""
    wide = wide if wide is not None else section_scores_wide(spark, sf_dir)
    out = {}
    for section, (total_col, cats) in config.SECTION_COLUMNS.items():
        out[section] = wide.select(*VISIT_KEYS, *cats, total_col)
    return out


def feedback_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staff feedback on a 0-3 scale stored as text (FX3)."""
    v = fx_visit(spark, sf_dir)
    cols = []
    for off, (name, _label) in zip(range(0, 42, 7), config.STAFF_METRICS):
        x = F.col("respondent_id") + off
        cols.append(
            F.when(x % 11 == 0, F.lit("n/a"))
             .when(x % 13 == 0, F.lit("-1"))
             .when(x % 17 == 0, F.lit("NaN"))
             .when(x % 19 == 0, F.lit(None).cast("string"))
             .when(x % 5 == 0, F.concat((x % 4).cast("string"), F.lit(".0")))
             .otherwise((x % 4).cast("string"))
             .alias(name))
    return v.select(*VISIT_KEYS, *cols)


def comment_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client master with free-text comment columns (FX4, whole texts)."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    k = F.col("doc_id")
    text = F.col("text")
    return d.select(
        F.concat(F.lit("client_"), F.col("lang")).alias("client_name"),
        F.concat(F.lit("Venue "), F.col("source"),
                 F.when(k % 3 == 0, F.lit(" (2)")).otherwise(F.lit(""))).alias("venue_name"),
        k.alias("respondent_id"),
        F.when(k % 7 == 0, F.lit(" N/A ")).when(k % 7 == 1, F.lit("   "))
         .when(k % 7 == 2, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("  "), text)).alias("welcome_comments"),
        F.when(k % 5 == 0, F.lit("nan")).when(k % 5 == 1, F.lit("NONE"))
         .otherwise(text).alias("ambiance_comments"),
        F.when(k % 4 == 0, F.lit("Null")).when(k % 4 == 1, F.lit("nothing"))
         .otherwise(F.concat(text, F.lit(" "))).alias("farewell_comments"),
        F.col("n_chars").alias("unmapped_number"),
    )


_WORD_VALUES = ["1", "1.0", "true", "TRUE", " Yes ", "yes", "True", "0", ""]


def _word_value(x):
    expr = None
    for i, val in enumerate(_WORD_VALUES):
        expr = F.when(x % 10 == i, F.lit(val)) if expr is None else expr.when(x % 10 == i, F.lit(val))
    return expr


WORD_FIXTURE_COLUMNS = [
    "thinking_about_the_staff_please_select_the_words_that_best_desc",
    "thinking_about_the_staff_please_select_the_words_that_best_de_1",
    "please_select_the_words_that_best_describe_the_service_that_you",
    "please_select_the_words_that_best_describe_the_service_that_y_1",
]


def word_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client master with checkbox word columns (FX5)."""
    v = fx_visit(spark, sf_dir)
    cols = [_word_value(F.col("respondent_id") + i).alias(name)
            for i, name in enumerate(WORD_FIXTURE_COLUMNS)]
    return v.select("client_name", "venue_name", "respondent_id", *cols)


def survey_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide raw survey answers (FX6)."""
    v = fx_visit(spark, sf_dir)
    r = F.col("respondent_id")

    def case(mod, values, default=None):
        expr = None
        for i, val in enumerate(values):
            if val is None:
                continue
            expr = F.when(r % mod == i, F.lit(val)) if expr is None else expr.when(r % mod == i, F.lit(val))
        if default is not None:
            expr = expr.otherwise(F.lit(default))
        return expr

    return v.select(
        "client_name", "venue_name", "respondent_id",
        case(6, ["Poor", " fair ", "GOOD", "Very Good", "N/A"]).alias("q_clean"),
        case(6, ["Poor", "Fair", "Average"], default="Good").alias("q_mixed"),
        F.when(r % 2 == 0, F.lit("n/a")).alias("q_only_na"),
        F.lit(None).cast("string").alias("q_empty"),
        case(5, ["Very likely", "Quite likely ", "Not very likely", "Unsure"]).alias("q_recommend"),
        case(6, ["Within three minutes", "between three and four minutes",
                 " Between four and five minutes ", "Greater than five minutes", "N/A", "ages"]).alias("q_drinks_speed"),
        case(6, ["F", " female", "M", "MALE ", "other"]).alias("q_gender"),
        case(4, ["Adept", "", "  "]).alias("staff_word_checkbox"),
        F.when(r % 9 == 0, F.lit(float("nan")))
         .when(r % 9 == 1, F.lit(None).cast("double"))
         .otherwise((r % 9).cast("double")).alias("q_number"),
    )


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free-text answers to recode (FX7)."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    k = F.col("o_orderkey")

    def case(mod, values):
        expr = None
        for i, val in enumerate(values):
            if val is None:
                continue
            v = val if not isinstance(val, str) else F.lit(val)
            expr = F.when(k % mod == i, v) if expr is None else expr.when(k % mod == i, v)
        return expr

    return o.select(
        k.alias("respondent_id"),
        case(7, [F.concat(F.lit("$"), k.cast("string"), F.lit(".50")), "1.2.3", "AUD 1,250.00",
                 "", "n/a", "-12"]).alias("total_expenditure"),
        case(8, ["7pm", "7:05 PM", "07.30 am", "12:00:59 pm", "19:30", "13pm", "late"]).alias("time_you_arrived"),
        case(6, ["31/02/2024", "5/9/2024", "2024-09-05", "05-09-2024", "soon"]).alias("date_of_visit"),
        case(8, ["Two", "4", " twenty-three ", "one hundred and five", "many", "2.0",
                 "six guests"]).alias("number_of_guests"),
    )


def load_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untyped master columns, as text (FX9): gaps, mixed dates, codes, single bad cells."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    k = F.col("o_orderkey")
    key = k.cast("string")

    def day(form):
        return F.date_format("o_orderdate", form)

    def case(mod, values, default=None):
        expr = F.when(F.lit(False), F.lit(None).cast("string"))
        for i, val in enumerate(values):
            expr = expr.when(k % mod == i, F.lit(val) if isinstance(val, str) or val is None else val)
        return expr.otherwise(default) if default is not None else expr

    return o.select(
        k.alias("respondent_id"), F.concat(F.lit("client_"), (F.col("o_custkey") % 5).cast("string")).alias("client_name"),
        case(7, [None, " N/A ", F.concat(key, F.lit(".0"))], key).alias("visits"),
        case(5, [F.concat(F.lit("-"), key, F.lit(".25")), "1.5e3", ""], key).alias("amount"),
        case(4, [day("dd/MM/yyyy"), day("yyyy-MM-dd"), F.concat(F.lit(" "), day("d-M-yyyy"), F.lit(" ")), "nan"]).alias("visited"),
        case(3, [F.concat(day("yyyy-MM-dd"), F.lit(" 07:30:00")), F.concat(day("yyyy-MM-dd"), F.lit("T23:05")), day("dd/MM/yyyy")]).alias("stamped"),
        case(4, ["True", " FALSE", "true"]).alias("flag"),
        F.when(k % 4999 == 1, "seven").otherwise((k % 10).cast("string")).alias("one_bad"),
        F.lpad((k % 1000).cast("string"), 4, "0").alias("code"),
        F.concat(F.lit("9223372036854775"), F.lpad((k % 1000).cast("string"), 3, "0")).alias("long_number"),
        case(2, ["null", "  "]).alias("nothing"),
        case(2, ["31/02/2024", "05/09/2024"]).alias("impossible_day"),
    )


_FILE_SUFFIXES = ["_iGUEST-Survey v2.1", " Survey V3 (1)", "--iguest__survey", ""]
FOOTER_TEXT = "IMPORTANT: check for typos before you submit"


def survey_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One survey export path per document (FX8 files)."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    k = F.col("doc_id")
    suffix = None
    for i, s in enumerate(_FILE_SUFFIXES):
        suffix = F.when(k % 4 == i, F.lit(s)) if suffix is None else suffix.when(k % 4 == i, F.lit(s))
    path = F.concat(F.lit("/data/client_"), F.col("lang"), F.lit("/"), F.upper(F.col("source")),
                    F.lit("_"), k.cast("string"), suffix, F.lit(".xlsx"))
    return d.select(k.alias("file_id"), path.alias("path"))


def survey_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-row header cells of each survey file (FX8 headers).

    Every line of a document (the whole text) is one column's top header;
    the sub-header is ``Comments``/``Response`` or an ``Unnamed`` placeholder.
    Files with an even id end with a footer column.
    """
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    footer = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit(FOOTER_TEXT))).otherwise(
        F.array().cast("array<string>"))
    cells = F.concat(F.split(F.col("text"), "\n", -1), footer)
    lines = d.select(F.col("doc_id").alias("file_id"),
                     F.posexplode(cells).alias("col_ord", "header_top"))
    L = F.length("header_top")
    sub = (F.when(F.col("col_ord") == 0, F.lit("Unnamed: 0_level_1"))
            .when(L % 3 == 0, F.lit("Comments"))
            .when(L % 3 == 1, F.lit("Response"))
            .otherwise(F.concat(F.lit("Unnamed: "), F.col("col_ord").cast("string"), F.lit("_level_1"))))
    return lines.select("file_id", F.col("col_ord").cast("int").alias("col_ord"), "header_top",
                        sub.alias("header_sub"))
