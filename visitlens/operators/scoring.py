"""Visit scoring: section union, per-visit section maxima and total score.

Plan shape (scale): one hash aggregate on the six raw visit keys with a
partial (map-side) step, so a key that repeats in many rows is combined
before the shuffle. The date and venue filters only read grouping keys, so
Catalyst pushes them below the aggregate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens import config
from visitlens.functions.recode import guarded_visit_date
from visitlens.functions.text import assessor_key, clean_venue

RAW_KEYS = ["client_name", "venue_name", "respondent_id", "assessor_id", "visit_type",
            "visit_date_raw"]
SECTION_TOTALS = [total for total, _cats in config.SECTION_COLUMNS.values()]

DEC = "decimal(38,6)"


def _keys_as_text(df: DataFrame) -> list[Column]:
    return [F.col("client_name"), F.col("venue_name"),
            F.col("respondent_id").cast("string").alias("respondent_id"),
            F.col("assessor_id").cast("string").alias("assessor_id"),
            F.col("visit_type"), F.col("visit_date_raw")]


def section_union(sections: dict[str, DataFrame]) -> DataFrame:
    """Stack the section views, each with its own score and nulls elsewhere."""
    parts = []
    for section, df in sections.items():
        total_col = config.SECTION_COLUMNS[section][0]
        parts.append(df.select(*_keys_as_text(df), F.col(total_col).cast("double").alias(total_col)))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.select(*RAW_KEYS, *[F.col(c) if c in stacked.columns
                                       else F.lit(None).cast("double").alias(c)
                                       for c in SECTION_TOTALS])


def section_union_wide(wide: DataFrame) -> DataFrame:
    """``section_union`` of the four sections held by one wide frame.

    One scan and one ``Generate``: each input row yields four rows, each
    carrying one section's score and nulls for the other three.
    """
    nul = F.lit(None).cast("double")
    rows = []
    for i, total in enumerate(SECTION_TOTALS):
        rows.append(F.struct(*[(F.col(t).cast("double") if j == i else nul).alias(t)
                               for j, t in enumerate(SECTION_TOTALS)]))
    return wide.select(*_keys_as_text(wide), F.inline(F.array(*rows)))


def wide_scores(wide: DataFrame) -> DataFrame:
    """Visit keys + the four section scores from one wide frame.

    Equal to ``section_union`` when every section comes from the same
    source rows, but reads that source once.
    """
    # keys keep their source types here: grouping on them gives the same groups
    # as grouping on their text (the cast is one-to-one), and a source already
    # hash-partitioned by respondent keeps satisfying the aggregate, so no shuffle
    return wide.select(*RAW_KEYS, *[F.col(c).cast("double").alias(c) for c in SECTION_TOTALS])


def _round_dec(c: Column, scale: int) -> Column:
    return F.round(c.cast(DEC), scale)


def null_skipping_mean(cols: list[Column], scale: int = 1) -> Column:
    """Sum of the present values / number of present values (null if none)."""
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0).cast(DEC)) for c in cols])
    present = reduce(lambda a, b: a + b, [F.when(c.isNotNull(), 1).otherwise(0) for c in cols])
    return F.round((total / F.nullif(present, F.lit(0))).cast(DEC), scale)


def visit_scores(all_scores: DataFrame, keep_raw_assessor: bool = False) -> DataFrame:
    """Per-visit section scores and total score, before report filters.

    Groups on the raw key values (``X (1)`` and ``X (2)`` stay two rows that
    share a ``visit_id``), then derives the cleaned keys from them.
    """
    g = all_scores.groupBy(*RAW_KEYS).agg(
        *[_round_dec(F.max(c), 1).alias(c) for c in SECTION_TOTALS])
    clean_v = clean_venue("venue_name")
    resp = F.col("respondent_id").cast("string")
    cols = [
        F.concat_ws("|", F.col("client_name"), clean_v, resp).alias("visit_id"),
        F.col("client_name"),
        clean_v.alias("venue_name"),
        F.col("venue_name").alias("venue_name_original"),
        resp.alias("respondent_id"),
        assessor_key("assessor_id").alias("assessor_id"),
        F.col("visit_type"),
        F.col("visit_date_raw"),
        guarded_visit_date("visit_date_raw").alias("visit_date"),
        *[F.col(c) for c in SECTION_TOTALS],
        null_skipping_mean([F.col(c) for c in SECTION_TOTALS], 1).alias("total_score"),
    ]
    if keep_raw_assessor:
        cols.append(F.col("assessor_id").cast("string").alias("assessor_id_raw"))
    return g.select(*cols)


def report_filter(scored: DataFrame) -> DataFrame:
    """Visits on or after the date floor whose venue is not a report/shop/sales entry.

    Written on the raw date text and the lower-cased venue, each read once:
    ``visit_date >= floor`` holds exactly when the text has the dd/mm/yyyy
    shape and parses to a day between the floor and the last accepted year
    (the floor is past 2000, so the lower year bound is implied), and the
    three case-insensitive ``LIKE '%word%'`` tests are one search of the
    lower-cased name. Catalyst pushes this filter below the aggregate into
    the source scan, where every extra copy of an input expression costs.
    """
    raw = F.col("visit_date_raw")
    parsed = F.try_to_date(raw, "dd/MM/yyyy")
    date_ok = (raw.rlike(r"\A\d{2}/\d{2}/\d{4}\z")
               & parsed.between(F.lit(config.VISIT_DATE_FLOOR).cast("date"), F.lit("2100-12-31").cast("date")))
    words = "|".join(config.EXCLUDED_VENUE_WORDS)
    venue_ok = ~F.lower(F.col("venue_name")).rlike(words)
    return scored.where(date_ok & venue_ok)


def total_score(all_scores: DataFrame, keep_raw_assessor: bool = False) -> DataFrame:
    """The total score view: filtered visits with section and total scores."""
    out = report_filter(visit_scores(all_scores, keep_raw_assessor))
    score_cols = SECTION_TOTALS + ["total_score"]
    return out.select(*[F.col(c).cast("double").alias(c) if c in score_cols else F.col(c)
                        for c in out.columns])


def performance_band(score: Column) -> Column:
    expr = None
    for threshold, label in config.PERFORMANCE_BANDS:
        expr = (F.when(score >= threshold, F.lit(label)) if expr is None
                else expr.when(score >= threshold, F.lit(label)))
    return expr.otherwise(F.lit(config.PERFORMANCE_BAND_ELSE))


def rating(score: Column) -> Column:
    expr = F.when(score.isNull(), F.lit(None).cast("string"))
    for threshold, label in config.RATING_BANDS:
        expr = expr.when(score >= threshold, F.lit(label))
    return expr.otherwise(F.lit(config.RATING_BAND_ELSE))


def visit_group(rank: Column) -> Column:
    lo, hi = config.PREVIOUS_RANKS
    return (F.when(rank == config.LATEST_RANK, F.lit(config.VISIT_GROUP_LATEST))
             .when(rank.between(lo, hi), F.lit(config.VISIT_GROUP_PREVIOUS))
             .otherwise(F.lit(config.VISIT_GROUP_OLDER)))


def row_mean(cols: list[Column]) -> Column:
    """Mean of the non-null values in a row (null when all are null), as double."""
    total = reduce(lambda a, b: a + b, [F.coalesce(c.cast("double"), F.lit(0.0)) for c in cols])
    present = reduce(lambda a, b: a + b, [F.when(c.isNotNull(), 1).otherwise(0) for c in cols])
    return total / F.nullif(present, F.lit(0))


def build_section_scores(master: DataFrame, spec: dict, keys: list[str] | None = None) -> DataFrame:
    """Section score frame from recoded Likert answers (0-3).

    ``spec`` is ``{section score column: {category column: [Likert columns]}}``.
    A category is the mean of its answered Likert columns rescaled to 0-100;
    a section is the mean of its scored categories. Missing answers are
    skipped, so a visit that skipped a part is scored on the rest. (The
    source reports read such section views but do not define them; this is
    the builder's documented rule.) One projection, no shuffle.
    """
    keys = keys or [k for k in RAW_KEYS if k in master.columns]
    out = [F.col(k) for k in keys]
    for section_col, categories in spec.items():
        cat_cols = []
        for cat_col, likert_cols in categories.items():
            c = (row_mean([F.col(x) for x in likert_cols]) / F.lit(float(config.STAFF_SCALE_MAX)) * 100)
            out.append(c.alias(cat_col))
            cat_cols.append(c)
        section = row_mean(cat_cols) if cat_cols else F.lit(None).cast("double")
        out.append(section.alias(section_col))
    return master.select(*out)
