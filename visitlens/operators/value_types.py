"""Column types from the values of a column.

Survey answers arrive as text. A column's type is the least one that holds all
its values, in the lattice

    empty < bool, int < double, date < timestamp, all < text

Every value has one class, a column is the bitwise *or* of its values' classes:
an aggregate that combines map-side, so a column with billions of cells costs
one small shuffle, and files, clients or days can be merged later.

Rules (surrounding white space does not count):

* blank cells and the usual spellings of a missing value have no class; a
  column of nothing else is ``empty`` and loads as text;
* ``true`` / ``false`` in any case are booleans;
* whole numbers are integers, also as ``1.0`` (how whole numbers with gaps are
  exported); other decimals and exponents make a column ``double``;
* numbers with leading zeros and whole numbers beyond 64 bits are text: they
  are codes, and must keep their digits;
* dates are day first (``5/9/2024``, ``05-09-2024``) or ISO, in any mix; with a
  time of day a column becomes ``timestamp``;
* one value of another kind makes the column text. Typed columns have null for
  missing values, text columns keep every value as it is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.functions.recode import day_first_date
from visitlens.functions.text import py_strip

# Spellings of a missing value (lower case).
MISSING = ("", "#n/a", "#n/a n/a", "#na", "-1.#ind", "-1.#qnan", "-nan", "1.#ind", "1.#qnan", "<na>", "n/a", "na", "nan", "none", "null")

BOOL, INT, DOUBLE, DATE, TIMESTAMP, TEXT = (1 << i for i in range(6))
#: Type of a column -> the classes that its values may have, narrowest first.
TYPES = {"empty": 0, "bool": BOOL, "int": INT, "double": INT | DOUBLE, "date": DATE, "timestamp": DATE | TIMESTAMP}
SPARK_TYPES = {"empty": "string", "bool": "boolean", "int": "bigint", "double": "double", "date": "date",
               "timestamp": "timestamp_ntz", "text": "string"}

_WHOLE = r"\A[+-]?(0|[1-9][0-9]*)(\.0+)?\z"
_NUMBER = r"\A[+-]?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
_DAY = r"\A([0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{1,2}([/-])[0-9]{1,2}\2[0-9]{4})\z"
_MOMENT = r"\A([0-9]{4}-[0-9]{2}-[0-9]{2})[ T]([0-9]{2}:[0-9]{2}(:[0-9]{2})?)\z"


def is_missing(value: Column) -> Column:
    """True for nulls, blanks and spellings of a missing value."""
    return value.isNull() | F.lower(py_strip(value)).isin(*MISSING)


def _whole(text: Column) -> Column:
    return F.regexp_replace(text, r"\.0+\z", "").try_cast("bigint")


def _moment(text: Column) -> Column:
    full = F.concat(F.regexp_extract(text, _MOMENT, 1), F.lit(" "), F.regexp_extract(text, _MOMENT, 2),
                    F.when(F.regexp_extract(text, _MOMENT, 3) == "", F.lit(":00")).otherwise(F.lit("")))
    return F.when(text.rlike(_MOMENT), full.try_cast("timestamp_ntz"))


def value_class(value: Column) -> Column:
    """The class bit of one text value; 0 if it is missing."""
    text = py_strip(value)
    whole = text.rlike(_WHOLE)
    return (F.when(is_missing(value), 0)
            .when(F.lower(text).isin("true", "false"), BOOL)
            .when(whole & _whole(text).isNotNull(), INT)
            .when(~whole & text.rlike(_NUMBER), DOUBLE)
            .when(text.rlike(_DAY) & day_first_date(text).isNotNull(), DATE)
            .when(_moment(text).isNotNull(), TIMESTAMP)
            .otherwise(TEXT))


def type_of(classes: Column) -> Column:
    """Name of the least type that holds all of ``classes``."""
    fits = [(name, classes.bitwiseAND(F.lit(63 & ~held)) == 0) for name, held in TYPES.items()]
    return reduce(lambda c, x: c.when(x[1], x[0]), fits[1:], F.when(fits[0][1], fits[0][0])).otherwise("text")


def column_classes(answers: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """keys, n_values, classes: mergeable with ``merge_classes``."""
    found = value_class(F.col(value))
    return (answers.select(*keys, found.alias("_class")).groupBy(*keys)
            .agg(F.count_if(F.col("_class") != 0).alias("n_values"), F.bit_or("_class").alias("classes")))


def merge_classes(classes: DataFrame, keys: list[str]) -> DataFrame:
    """``column_classes`` of the union of their answers, by fewer or equal keys."""
    return classes.groupBy(*keys).agg(F.sum("n_values").alias("n_values"), F.bit_or("classes").alias("classes"))


def column_types(answers: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """keys, n_values, value_type of long answers."""
    found = column_classes(answers, keys, value)
    return found.select(*keys, "n_values", type_of(F.col("classes")).alias("value_type"))


def typed(value: Column, value_type: str) -> Column:
    """A text value as ``value_type``; null where it is missing."""
    if value_type in ("text", "empty"):
        return value.cast("string")
    text = F.when(~is_missing(value), py_strip(value))
    if value_type == "bool":
        return F.lower(text) == "true"
    if value_type == "int":
        return _whole(text)
    if value_type == "double":
        return text.try_cast("double")
    if value_type == "date":
        return day_first_date(text)
    return F.coalesce(_moment(text), day_first_date(text).cast("timestamp_ntz"))


def typed_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """``df`` with the named text columns cast to their types, in one projection."""
    return df.select(*[typed(F.col(f"`{c}`"), types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns])


def infer_types(df: DataFrame) -> dict[str, str]:
    """Type of every text column of a wide frame (one row a column reaches the driver)."""
    names = [c for c, kind in df.dtypes if kind == "string"]
    if not names:
        return {}
    # unpivot by place: names may hold any character
    texts = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    long = texts.unpivot([], list(texts.columns), "column_name", "value")
    found = {r["column_name"]: r["value_type"] for r in column_types(long, ["column_name"]).collect()}
    return {c: found.get(f"c{i}", "empty") for i, c in enumerate(names)}


def with_inferred_types(df: DataFrame) -> DataFrame:
    """A wide text frame with every column in the type of its values."""
    return typed_columns(df, infer_types(df))
