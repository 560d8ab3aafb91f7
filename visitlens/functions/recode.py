"""Recoders: free-text survey answers -> typed values, as Column expressions.

Each recoder is a pure function ``Column -> Column`` built from Spark's
built-in functions (``create_map`` lookups, ``regexp_*``, ``try_*`` parsers,
higher-order ``transform``/``aggregate``), so a recode over billions of cells
is one codegen'd projection with no Python worker.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitlens import config
from visitlens.functions.text import clean_text, col_, py_strip


def _lookup(mapping: dict, key: Column) -> Column:
    """``mapping[key]`` as a literal map; a miss gives null.

    ``try_element_at`` keeps a miss null under ANSI mode.
    """
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(m, key)


def likert_score(c, mapping: dict | None = None) -> Column:
    """poor/fair/good/very good -> 0..3; ``n/a`` and anything else -> null."""
    return _lookup(mapping or config.LIKERT_MAP, clean_text(c)).cast("double")


def in_likert_domain(c, mapping: dict | None = None) -> Column:
    """Cleaned value is a Likert answer or ``n/a`` (null for a null cell)."""
    t = clean_text(c)
    return t.isin(*list(mapping or config.LIKERT_MAP), config.LIKERT_NA)


def recommendation_score(c) -> Column:
    """Contains very / quite / not very likely -> 2 / 1 / 0, else null.

    "not very likely" is tested first, so it scores 0 (it also contains
    "very likely").
    """
    t = clean_text(c)
    expr = None
    for phrase, score in config.RECOMMENDATION_SCORES:
        expr = (F.when(t.contains(phrase), F.lit(score)) if expr is None
                else expr.when(t.contains(phrase), F.lit(score)))
    return expr.cast("double")


def speed_score(c, mapping: dict) -> Column:
    """Speed band answer -> 3..0; n/a, na and unknown answers -> null."""
    t = clean_text(c)
    return F.when(~t.isin(*config.SPEED_NA_TOKENS), _lookup(mapping, t)).cast("double")


def gender(c) -> Column:
    """female/f -> Female, male/m -> Male (any case, stripped); else null."""
    return _lookup(config.GENDER_MAP, clean_text(c))


def checkbox_flag(c) -> Column:
    """1 when the cell holds any non-blank text, else 0 (never null)."""
    s = col_(c).cast("string")
    return F.when(s.isNotNull() & (py_strip(s) != ""), F.lit(1)).otherwise(F.lit(0))


def spend_amount(c) -> Column:
    """Keep digits and dots, read as a number; unreadable -> null (sign lost)."""
    digits = F.regexp_replace(col_(c).cast("string"), r"[^0-9.]", "")
    return digits.try_cast("double")


def arrival_time(c) -> Column:
    """Arrival time text -> ``h.mm am|pm``; unreadable -> null.

    Accepts ``7pm``, ``7:05 PM``, ``07.30 am``, ``12:00:59 pm``; seconds are
    dropped; 24-hour text and hours above 12 give null.
    """
    t = F.lower(py_strip(col_(c).cast("string")))
    t = F.regexp_replace(t, " ", "")
    t = F.regexp_replace(t, ":", ".")
    t = F.regexp_replace(t, r"^(\d{1,2})(am|pm)$", "$1.00$2")
    # one-digit minutes / seconds read as in Python's %M / %S (7.5pm -> 7.05 pm)
    t = F.regexp_replace(t, r"^(\d{1,2})\.(\d)(?=[.ap])", "$1.0$2")
    t = F.regexp_replace(t, r"^(\d{1,2}\.\d{2})\.(\d)(?=[ap])", "$1.0$2")
    t = F.upper(t)
    ts = F.coalesce(F.try_to_timestamp(t, F.lit("h.mma")),
                    F.try_to_timestamp(t, F.lit("h.mm.ssa")))
    return F.lower(F.date_format(ts, "h.mm a"))


def day_first_date(c) -> Column:
    """Day-first date text -> date; unreadable or impossible dates -> null.

    Accepted: day, month (number or English name), year in any of ``/ - .`` or
    spaces, or year first; a two-digit year; and a time after the date, which
    is dropped.
    """
    t = py_strip(col_(c).cast("string"))
    t = F.regexp_replace(t, r"[T\s]+[0-9]{1,2}[:.][0-9]{2}.*$", "")
    t = F.regexp_replace(t, r"[\s./-]+", "-")
    t = F.regexp_replace(t, r"^([0-9]{1,2})(?i:st|nd|rd|th)-", "$1-")
    named = F.initcap(F.lower(F.regexp_replace(t, "-", " ")))
    year_first, short = t.rlike(r"^[0-9]{4}-"), t.rlike(r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{2}$")
    numeric = (F.when(year_first, F.try_to_date(t, "yyyy-M-d")).when(short, F.try_to_date(t, "d-M-yy"))
                .otherwise(F.try_to_date(t, "d-M-yyyy")))
    return F.coalesce(numeric, F.when(named.rlike("[A-Z]"), F.coalesce(
        F.try_to_date(named, "d MMM yyyy"), F.try_to_date(named, "d MMMM yyyy"))))


def guarded_visit_date(c) -> Column:
    """``dd/mm/yyyy`` text -> date, only for years 2000-2100, else null.

    Impossible calendar days (31/02) give null instead of an error. Once the
    text has the ``dd/dd/dddd`` shape its parts sit at fixed positions, so
    they are read with ``substring`` (the guard runs first, inside the CASE).
    """
    s = col_(c).cast("string")
    day = F.substring(s, 1, 2).cast("int")
    month = F.substring(s, 4, 2).cast("int")
    year = F.substring(s, 7, 4).cast("int")
    in_range = F.when(s.rlike(r"\A\d{2}/\d{2}/\d{4}\z"),
                      year.between(2000, 2100) & day.between(1, 31) & month.between(1, 12))
    return F.when(in_range, F.try_to_date(s, "dd/MM/yyyy"))


def guest_count(c) -> Column:
    """Guest count from words or digits; unreadable -> null.

    Number words (``twenty-three``, ``one hundred and five``) are looked up
    and folded left to right: ``hundred`` multiplies the running group,
    ``thousand``/``million``/``billion`` close a group; other words are
    ignored; a decimal part after ``point`` is dropped. Text without number
    words is read as a number and truncated (``2.0`` -> 2), as a numeric
    spreadsheet cell would be.
    """
    t = F.lower(py_strip(F.regexp_replace(col_(c).cast("string"), "-", " ")))
    # a count is whole: words after "point" (a decimal part) are not added
    t = F.regexp_replace(t, r"(^|\s)point(\s.*)?$", "")
    words = F.split(t, r"\s+")
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(config.NUMBER_WORDS.items())])
    values = F.filter(F.transform(words, lambda w: F.try_element_at(m, w).cast("long")),
                      lambda v: v.isNotNull())
    init = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("group"))

    def step(acc, v):
        grp = F.greatest(acc["group"], F.lit(1).cast("long"))
        return (F.when(v == 100, F.struct(acc["total"].alias("total"), (grp * 100).alias("group")))
                .when(v >= 1000, F.struct((acc["total"] + grp * v).alias("total"),
                                          F.lit(0).cast("long").alias("group")))
                .otherwise(F.struct(acc["total"].alias("total"), (acc["group"] + v).alias("group"))))

    folded = F.aggregate(values, init, step, lambda acc: acc["total"] + acc["group"])
    raw = py_strip(col_(c).cast("string"))
    numeric = F.when(raw.rlike(r"^[+-]?[0-9]+(\.[0-9]+)?$"),
                     raw.try_cast("double").try_cast("long"))
    return F.when(F.size(values) > 0, folded).otherwise(numeric)


def nan_to_null(c) -> Column:
    """Floating NaN -> null; other values unchanged."""
    x = col_(c)
    return F.when(~F.isnan(x), x)


def text_identity(c) -> Column:
    """Identity text column kept as text; a missing cell stays null."""
    return col_(c).cast("string")
