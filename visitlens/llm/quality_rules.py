"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements
and one bit per failed rule; a policy is a versioned mask over those bits, so
applying another policy or asking what a rule alone removes never reads the
texts again.

Repeated 5-word windows are found inside the row: words are hashed, windows of
hashes are compared as 64-bit values (two different windows of one document
share a value with probability below 1e-9 even at a million words), and only
documents whose windows are not all distinct are sorted by window.

Defined results: null text has no words; an empty text fails ``few_words``;
repeated rows are judged alike; only the id and the text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import SPACE_CLASS, SPACES, text_or_empty, without_spaces

WINDOW = 5
#: Rules in bit order: name and failing condition over the measurements.
RULES = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "symbols": "100 * n_symbols > 10 * word_chars",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 15 * n_words",
    "exclamations": "2 * n_exclaim > n_words",
    "capitals": "2 * n_capitals > word_chars",
}
#: Policies by version: the rules that remove a document.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "duplicate_lines"),
    "v2": tuple(RULES),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_exclaim", "n_capitals")


def mask(policy: str) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in POLICIES[policy])


def _covered(positions: Column) -> Column:
    """Words covered by windows that start at these sorted positions."""
    steps = F.transform(positions, lambda p, j: F.least(
        F.lit(WINDOW), F.coalesce(F.get(positions, j + 1) - p, F.lit(WINDOW))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, s: a + s)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, the measurements and ``failed`` (bit i: rule i failed)."""
    text = F.col("_text")
    trimmed = F.btrim(text, F.lit("".join(SPACES)))
    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    split = rows.withColumn("_words", F.when(trimmed == "", F.array().cast("array<string>"))
                            .otherwise(F.split(trimmed, f"{SPACE_CLASS}+")))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS[1:-1]}]"))
    measured = split.select(
        "_id", F.size("_words").cast("long").alias("n_words"),
        F.length(without_spaces(text)).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("!")).cast("long").alias("n_exclaim"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        lines.alias("_lines"), F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"))
    hashes = F.col("_hashes")
    windows = F.transform(F.slice(hashes, 1, F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0))),
                          lambda h, i: F.xxhash64(h, *[F.get(hashes, i + j) for j in range(1, WINDOW)]))
    windowed = measured.select(
        "*", F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("_windows")).drop("_lines", "_hashes")
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    ordered = windowed.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_windows")) == F.size("_windows"), none).otherwise(
        F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    near = F.col("_sorted")
    twice = F.filter(near, lambda x, j: F.coalesce(F.get(near, j - 1)["h"] == x["h"], F.lit(False))
                     | F.coalesce(F.get(near, j + 1)["h"] == x["h"], F.lit(False)))
    placed = ordered.withColumn("_at", F.sort_array(F.transform(twice, lambda x: x["i"])))
    full = placed.withColumn("n_repeat_words", _covered(F.col("_at")))
    failed = sum((F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
                  for i, rule in enumerate(RULES.values())), F.lit(0).cast("long"))
    return full.select(F.col("_id").alias(id_col), *MEASURES).withColumn("failed", failed)


def apply_policy(rows: DataFrame, policy: str) -> DataFrame:
    """Adds ``kept``: no rule of the policy failed."""
    return rows.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask(policy))) == 0)


def ablations(rows: DataFrame, policy: str) -> DataFrame:
    """Per rule of the policy: rows it fails, rows only it removes, rows kept.

    The ledger is reduced to counts per bit pattern (at most ``2^rules`` rows)
    before the rules are crossed in, so this costs one small aggregate.
    """
    names = list(RULES)
    bits = [F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("long").alias("bit")) for r in POLICIES[policy]]
    patterns = (rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask(policy))).alias("bits"))
                .agg(F.count(F.lit(1)).alias("n")))
    each = patterns.select("bits", "n", F.explode(F.array(*bits)).alias("r"))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return each.groupBy("r.rule", "r.bit").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(F.col("bits") == 0, F.col("n")).otherwise(0)).alias("n_kept"))
