"""Header dictionary operators: one row per (file, column).

A survey export has two header rows. Ingest turns them into a header
dictionary ``(file_id, col_ord, header_top, header_sub)``; these operators
flatten, drop the footer column, clean and uniquify the names. Every step is
a DataFrame plan over the dictionary, so a million files are processed as
one distributed job rather than a driver loop.

Size bound: a file's header list is bounded by its column count (an xlsx
sheet holds at most 16,384 columns), so per-file windows never hold more
than that many rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens import config
from visitlens.functions.text import clean_identifier, flatten_header, is_footer_header
from visitlens.session import ensure_checkpoint_dir

FILE = "file_id"
ORD = "col_ord"


def flatten(headers: DataFrame) -> DataFrame:
    """Add ``header``: both header rows joined, ``Unnamed`` placeholders skipped."""
    return headers.withColumn("header", flatten_header("header_top", "header_sub"))


def drop_footer(headers: DataFrame, file_col: str = FILE) -> DataFrame:
    """Remove each file's last column when its header is a submit/review footer.

    The last column and its header come from window aggregates over the
    file (``max`` and ``max_by``), so the dictionary is shuffled once, by file,
    and later per-file steps reuse that partitioning.
    """
    w = Window.partitionBy(file_col)
    last_ord = F.max(ORD).over(w)
    last_header = F.max_by("header", ORD).over(w)
    is_footer = (F.col(ORD) == last_ord) & is_footer_header(last_header)
    return headers.withColumn("_footer", is_footer).where(~F.col("_footer")).drop("_footer")


def with_identifiers(headers: DataFrame) -> DataFrame:
    """Add ``identifier``: the database-safe form of ``header``."""
    return headers.withColumn("identifier", clean_identifier(F.col("header")))


def _closed_form(headers: DataFrame, file_col: str, max_len: int | None, base_len: int | None = None) -> DataFrame:
    """First use keeps the (cut) name; the k-th repeat becomes ``name[:max-len(_k)]_k``.

    With ``base_len`` the base is cut to that length and ``_k`` is appended
    as is; with neither limit the name is never cut.
    """
    cut_to = base_len or max_len
    cand = F.substring("identifier", 1, cut_to) if cut_to else F.col("identifier")
    w = Window.partitionBy(file_col, "_cand").orderBy(ORD)
    k = (F.row_number().over(w) - 1)
    out = headers.withColumn("_cand", cand).withColumn("_k", k)
    suffix = F.concat(F.lit("_"), F.col("_k").cast("string"))
    if max_len and not base_len:
        cut = F.expr(f"substring(identifier, 1, {max_len} - length(concat('_', cast(_k as string))))")
    else:
        cut = F.col("_cand")
    name = F.when(F.col("_k") == 0, F.col("_cand")).otherwise(F.concat(cut, suffix))
    return out.withColumn("unique_name", name)


def simple_unique_names(headers: DataFrame, file_col: str = FILE, base_len: int | None = None) -> DataFrame:
    """Repeats get ``_1``, ``_2``, ... without checking the result is free.

    ``base_len=None``: names are never cut; ``base_len=55``: the base is cut
    to 55 characters before the suffix. Kept for compatibility with older
    table layouts; ``unique_names`` is the safe rule.
    """
    out = _closed_form(headers, file_col, None, base_len)
    return out.drop("_cand", "_k")


def unique_name_list(identifiers: list[str], max_len: int = config.MAX_IDENTIFIER_LEN) -> list[str]:
    """The sequential uniqueness rule over one ordered list of identifiers.

    A name that is free stays (cut to ``max_len``). Otherwise it takes the
    first free ``<base>_<k>``, the base cut so that the whole fits; numbers
    run on per base, because names once taken are never given back.
    """
    taken: set[str] = set()
    numbers: dict[str, Iterator[int]] = defaultdict(lambda: count(1))

    def choose(name: str) -> str:
        base = name[:max_len]
        if base not in taken:
            return base
        tails = (f"_{k}" for k in numbers[base])
        return next(c for c in (name[:max_len - len(t)] + t for t in tails) if c not in taken)

    out = []
    for name in identifiers:
        out.append(choose(name))
        taken.add(out[-1])
    return out


def _name(base: Column, k: Column, max_len: int) -> Column:
    """``base`` itself for k = 0, else the base cut so that ``_k`` fits."""
    tail = F.concat(F.lit("_"), k.cast("string"))
    return F.when(k == 0, base).otherwise(F.concat(F.substring(base, F.lit(1), F.lit(max_len) - F.length(tail)), tail))


def _claims(names: DataFrame, max_len: int) -> DataFrame:
    """(file, base, k, at): names that are a base's k-th candidate, and the places that
    hold them: names of other bases, and a base that reads like its own candidate."""
    digits = F.regexp_extract("name", "_([1-9][0-9]{0,8})$", 1)
    tail = F.when(digits == "", 0).otherwise(F.length(digits) + 1)
    forms = F.array(F.struct(F.lit(0).alias("tail"), F.col("name").alias("stem"), F.lit(0).alias("k")),
                    F.struct(tail.alias("tail"), F.substring(F.col("name"), F.lit(1), F.length("name") - tail).alias("stem"),
                             F.coalesce(digits.try_cast("int"), F.lit(0)).alias("k")))
    held = names.select("file", F.col("base").alias("own"), (F.col("name") == F.col("base")).alias("whole"), "at",
                        F.explode(F.array_distinct(forms)).alias("f")).select("file", "own", "whole", "at", "f.tail", "f.stem", "f.k")
    bases = names.select("file", "base").distinct().select(
        "file", "base", F.explode(F.array(*[F.struct(F.lit(n).alias("tail"), F.substring("base", 1, max_len - n).alias("stem"))
                                            for n in (0, *range(2, 11))])).alias("f")).select("file", "base", "f.tail", "f.stem")
    return held.join(bases, ["file", "tail", "stem"]).where("own <> base or (whole and tail > 0)").select(
        "file", "base", "k", "at")


def _numbered(names: DataFrame, max_len: int) -> DataFrame:
    """One round: every name anew, given the names that the places before it hold."""
    claims = _claims(names, max_len).groupBy("file", "base").agg(F.collect_list(F.struct("k", "at")).alias("claims"))
    places = names.groupBy("file", "base").agg(F.sort_array(F.collect_list("at")).alias("places"))
    both = places.join(claims, ["file", "base"], "left").withColumn(
        "claims", F.coalesce("claims", F.array().cast("array<struct<k:int,at:int>>")))

    def step(state: Column, at: Column) -> Column:
        first = state["last"] + 1
        free = F.filter(F.sequence(first, first + F.size("claims")),
                        lambda k: ~F.exists("claims", lambda c: (c["k"] == k) & (c["at"] < at)))
        return F.struct(free[0].alias("last"), F.concat(state["ks"], F.array(free[0])).alias("ks"))

    start = F.struct(F.lit(-1).alias("last"), F.array().cast("array<int>").alias("ks"))
    ks = F.aggregate("places", start, step, lambda state: state["ks"])
    return both.select("file", "base", F.explode(F.arrays_zip(F.col("places").alias("at"), ks.alias("k"))).alias("p")).select(
        "file", "base", "p.at", _name(F.col("base"), F.col("p.k"), max_len).alias("name"))


def unique_names(headers: DataFrame, file_col: str = FILE,
                 max_len: int = config.MAX_IDENTIFIER_LEN) -> DataFrame:
    """Add ``unique_name``: identifiers made unique within each file, <= max_len.

    Rule, applied in column order: a name not used yet is kept (cut to
    ``max_len``); a repeat gets ``_1``, ``_2``, ... with the base cut so the
    whole fits, skipping any suffixed name already in use (``a, A, a 1`` ->
    ``a, a_1, a_1_1``).

    Plan: the closed form (``row_number`` per file and name) equals the
    sequential rule exactly when its output names are distinct within the
    file (every candidate is the output of its first use, so any collision
    with a generated name shows up as a repeated output). The headers are read
    once, and where all names are distinct that is all. Files with a repeated
    output go through rounds: each finds, by a join on name stems, which
    candidates of a base are held by other bases' earlier columns, and numbers
    the base's columns past them. A name depends on earlier columns only, so
    after some rounds nothing changes, and then it is the sequential rule's.
    All steps are keyed by file, whose columns bound them; none is Python.
    """
    spark = headers.sparkSession
    ensure_checkpoint_dir(spark)
    closed = _closed_form(headers, file_col, max_len)
    dup = F.count(F.lit(1)).over(Window.partitionBy(file_col, "unique_name")) > 1
    closed = closed.withColumn("_dup", dup)
    closed = closed.withColumn("_bad", F.max("_dup").over(Window.partitionBy(file_col))).checkpoint(eager=True)
    columns = [*headers.columns, "unique_name"]
    bad = closed.where("_bad")
    if bad.isEmpty():
        return closed.select(*columns)
    own = F.struct(F.col(file_col))  # equal also where the file is null
    names = bad.select(own.alias("file"), F.coalesce("_cand", F.lit("")).alias("base"), F.col(ORD).cast("int").alias("at"),
                       F.coalesce("unique_name", F.lit("")).alias("name")).checkpoint(eager=True)
    changed = True
    while changed:
        after = _numbered(names, max_len).checkpoint(eager=True)
        changed = not after.join(names.withColumnRenamed("name", "old").drop("base"), ["file", "at"]).where("name <> old").isEmpty()
        names = after
    named = names.select(F.col("file").alias("_file"), F.col("at").alias("_at"), "name")
    fixed = bad.drop("unique_name").join(named, (own == F.col("_file")) & (F.col(ORD) == F.col("_at"))).withColumnRenamed("name", "unique_name")
    return closed.where(~F.col("_bad")).select(*columns).unionByName(fixed.select(*columns))


def header_dictionary(headers: DataFrame, file_col: str = FILE) -> DataFrame:
    """flatten -> drop footer -> identifier -> unique name."""
    return unique_names(with_identifiers(drop_footer(flatten(headers), file_col)), file_col)
