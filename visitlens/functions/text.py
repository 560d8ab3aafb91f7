"""Text Column expressions used across the views and the ingest.

All functions take and return ``Column``s, so they stay inside whole-stage
codegen; none of them runs Python per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitlens import config

# Characters Python's ``str.strip()`` removes (those with ``str.isspace()``):
# ASCII whitespace, the separators 0x1c-0x1f, NEL and the Unicode spaces.
# Spark's one-argument ``trim`` only removes the space character, so steps
# that follow Python semantics use ``py_strip``: ``btrim`` with this set, a
# plain character scan at both ends (no regular expression).
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

VENUE_SUFFIX_RE = r"\s*\(\d+\)\z"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()`` on a string column (null stays null)."""
    return F.btrim(col_(c), F.lit(PY_WHITESPACE))


def clean_text(c) -> Column:
    """lower + strip, the normal form answers are matched in."""
    return F.lower(py_strip(col_(c).cast("string")))


def clean_venue(c) -> Column:
    """Drop a trailing ``(N)`` duplicate marker from a venue name, then trim."""
    return F.trim(F.regexp_replace(col_(c), VENUE_SUFFIX_RE, ""))


def assessor_key(c) -> Column:
    """Part of an assessor id before the first dot, trimmed (``12.0`` -> ``12``)."""
    return F.trim(F.split_part(col_(c).cast("string"), F.lit("."), F.lit(1)))


def venue_from_stem(stem) -> Column:
    """Venue name from a survey file stem.

    Removes version tags, the words survey / iGUEST (any case, anywhere),
    turns ``_`` and ``-`` runs into spaces and squeezes whitespace.
    """
    c = col_(stem)
    for pattern in config.VENUE_STEM_PATTERNS:
        c = F.regexp_replace(c, "(?iU)" + pattern, "")
    c = F.regexp_replace(c, r"[_\-]+", " ")
    c = F.regexp_replace(c, r"(?U)\s+", " ")
    return py_strip(c)


def path_basename(path) -> Column:
    return F.regexp_extract(col_(path), r"([^/]*)$", 1)


def path_parent_name(path) -> Column:
    """Name of the folder a file sits in (the client)."""
    return F.regexp_extract(col_(path), r"([^/]*)/[^/]*$", 1)


def path_stem(path) -> Column:
    """File name without its last extension (leading dots do not count)."""
    return F.regexp_replace(path_basename(path), r"^(.*[^.].*)\.[^.]*$", "$1")


def clean_identifier(c, col_prefix: bool = True, keep_underscore: bool = False,
                     max_len: int | None = None) -> Column:
    """Database-safe identifier from a header text.

    lower, every run of characters outside ``[a-z0-9]`` becomes one ``_``
    (runs cannot repeat ``_``, so no second squeeze is needed), outer ``_``
    removed, and ``col_`` put before a leading digit. ``keep_underscore``
    treats ``_`` as a kept character (runs of ``_`` are then squeezed);
    ``max_len`` cuts the result.
    """
    x = F.lower(col_(c).cast("string"))
    if keep_underscore:
        x = F.regexp_replace(F.regexp_replace(x, r"[^a-z0-9_]+", "_"), r"_{2,}", "_")
        x = F.regexp_replace(x, r"^_+|_+$", "")
    else:
        x = F.btrim(F.regexp_replace(x, r"[^a-z0-9]+", "_"), F.lit("_"))
    if col_prefix:
        first = F.substring(x, 1, 1)
        x = F.when((first >= "0") & (first <= "9"), F.concat(F.lit("col_"), x)).otherwise(x)
    if max_len:
        x = F.substring(x, 1, max_len)
    return x


def identifier(name: str, max_len: int | None = None) -> str:
    """``clean_identifier`` for one name on the driver (column lists, headers)."""
    words = "_".join(re.findall("[a-z0-9]+", str(name).lower()))
    return ("col_" + words if words[:1].isdigit() else words)[:max_len]


def header_text(top: str, sub: str) -> str:
    """``flatten_header`` for one header on the driver or in the decoder."""
    return " ".join(part for part in (top, sub) if "Unnamed" not in part).strip()


def table_name_for(client) -> Column:
    """Table name of a client master: ``clean(<client>_master)`` cut to 63."""
    name = clean_identifier(F.concat(col_(client), F.lit("_master")))
    return F.substring(name, 1, config.MAX_IDENTIFIER_LEN)


def flatten_header(top, sub) -> Column:
    """Join the two header rows with a space, skipping ``Unnamed`` parts."""
    parts = [F.when(~col_(p).contains("Unnamed"), col_(p)) for p in (top, sub)]
    return py_strip(F.concat_ws(" ", *parts))


def is_footer_header(header) -> Column:
    """True when a header text marks the survey's footer column."""
    h = F.lower(py_strip(col_(header)))
    cond = F.lit(False)
    for k in config.FOOTER_KEYWORDS:
        cond = cond | h.contains(k)
    return cond


def is_null_token(c) -> Column:
    """True for null, blank and the usual 'nothing here' spellings."""
    t = F.trim(col_(c).cast("string"))
    return (col_(c).isNull() | (t == "") |
            F.lower(t).isin(*config.NULL_TOKENS))


def is_truthy(c) -> Column:
    """Checkbox value counts as selected (exact tokens after trimming spaces)."""
    return F.coalesce(F.trim(col_(c).cast("string")).isin(*config.TRUTHY_TOKENS), F.lit(False))


def is_plain_number(c) -> Column:
    """Unsigned decimal text such as ``3`` or ``3.0`` (no sign, exponent, NaN)."""
    return F.coalesce(col_(c).cast("string").rlike(r"\A\d+(\.\d+)?\z"), F.lit(False))
