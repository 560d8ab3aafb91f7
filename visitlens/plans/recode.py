"""The recode chain over a wide survey table.

Columns are chosen by name (raw header text or its canonical identifier) and
replaced in place by their recoded value, all in one ``select``: one
projection, one codegen'd stage, whatever the number of columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens import config
from visitlens.functions import recode as R
from visitlens.functions.text import col_, identifier
from visitlens.operators.profile import likert_columns


def _named(df: DataFrame, raw_names) -> list[str]:
    wanted = set(raw_names) | {identifier(n, config.MAX_IDENTIFIER_LEN) for n in raw_names}
    return [c for c in df.columns if c in wanted]


def checkbox_columns(df: DataFrame) -> list[str]:
    prefixes = list(config.CHECKBOX_PREFIXES) + [identifier(p, config.MAX_IDENTIFIER_LEN) for p in config.CHECKBOX_PREFIXES]
    return [c for c in df.columns if any(c.startswith(p) for p in prefixes)]


def time_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if all(p in c for p in config.TIME_NAME_PARTS)]


def spend_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if any(p in c for p in config.SPEND_NAME_PARTS)]


def replace_columns(df: DataFrame, recoders: dict) -> DataFrame:
    """Apply ``{column: Column -> Column}`` in place, keeping column order."""
    return df.select(*[recoders[c](F.col(c)).alias(c) if c in recoders else F.col(c)
                       for c in df.columns])


def recode_survey(df: DataFrame, likert: list[str] | None = None) -> DataFrame:
    """Every recoder of the survey chain, chosen by column name.

    ``likert`` lists the Likert columns; when omitted they are detected from
    the values (``likert_columns``; only the per-column profile, one row per
    column, reaches the driver).
    """
    rec: dict = {}
    for c in _named(df, config.TEXT_IDENTITY_COLUMNS):
        rec[c] = R.text_identity
    if likert is None:
        prof = likert_columns(df).where("is_likert").select("column_name").collect()
        likert = [r[0] for r in prof]
    for c in likert:
        rec[c] = R.likert_score
    for c in _named(df, config.RECOMMENDATION_COLUMNS):
        rec[c] = R.recommendation_score
    for raw, mapping in config.SPEED_COLUMN_MAPS.items():
        for c in _named(df, [raw]):
            rec[c] = (lambda m: (lambda x: R.speed_score(x, m)))(mapping)
    for c in _named(df, [config.GENDER_COLUMN]):
        rec[c] = R.gender
    for c in checkbox_columns(df):
        rec[c] = R.checkbox_flag
    for c in _named(df, [config.DATE_COLUMN]):
        rec[c] = R.day_first_date
    for c in time_columns(df):
        rec[c] = R.arrival_time
    for c in spend_columns(df):
        rec[c] = R.spend_amount
    for c in _named(df, [config.GUESTS_COLUMN]):
        rec[c] = R.guest_count
    return replace_columns(df, rec)


def apply(df: DataFrame, column: str, fn, keep=("respondent_id",)) -> DataFrame:
    """Keys plus one recoded column (named as the source column)."""
    return df.select(*[col_(k) for k in keep], fn(F.col(column)).alias(column))
