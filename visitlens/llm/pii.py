"""Personal data: proposing patterns, checksums, context words.

Each kind's pattern proposes leftmost, non-overlapping spans. Cutting the text
at the same pattern gives the pieces between the matches, so running sums of
the lengths yield code-point offsets without any Python. Checksums
(Luhn for cards, mod-97 for account numbers) and ranges confirm a span; words
in the text just before or after it raise its score, whatever was matched in
between. A kind that counts only with such words keeps them along a list of
numbers parted by punctuation, so long lists stay whole. Patterns start at the beginning of
a run and use possessive repeats, so long runs cost linear time.

Defined results: null text counts as empty; empty texts have no span; digests
of no span are those of the empty string; repeated rows give repeated results;
only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import text_or_empty, with_running

BASE_KINDS = ("email", "ip", "card", "phone")
#: Account number length -> country codes that use it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_of(size: int, codes: str) -> str:
    groups, rest = divmod(size - 4, 4)
    spaced = rf"(?:\x20[A-Z0-9]{{4}}){{{groups}}}" + (rf"\x20[A-Z0-9]{{{rest}}}" if rest else "")
    return rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:[A-Z0-9]{{{size - 4}}}|{spaced})"


#: A number of its country's length; and any other, whose groups are not the
#: start of such a one.
IBAN_KNOWN = "(?:" + "|".join(_iban_of(n, c) for n, c in IBAN_LENGTHS.items()) + ")(?![A-Za-z0-9])"
IBAN_CODES = "^(?:" + "|".join(" ".join(IBAN_LENGTHS.values()).split()) + ")"
IBAN_OTHER = (r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20(?!" + IBAN_KNOWN + r")[A-Z0-9]{4}){2,7}"
              r"(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
#: Kind -> proposing pattern. The first four are fixed by contract; they are
#: written so that a match starts where the plain pattern's leftmost one does.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{IBAN_KNOWN}|{IBAN_OTHER})",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: Least characters of a match: how many neighbours reach CONTEXT_CHARS.
LEAST_CHARS = {"email": 5, "ip": 7, "card": 2, "phone": 4, "iban": 15, "ssn": 11}
#: Score of a confirmed span, and the words near it that raise the score.
BASE_SCORE = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
CONTEXT = {
    "email": "mail|contact|write to", "ip": "ip|host|server|address", "card": "card|visa|credit|pay",
    "phone": "phone|call|tel|mobile|fax", "iban": "iban|account|bank|transfer", "ssn": "ssn|social security",
}
CONTEXT_CHARS, CONTEXT_BONUS = 40, 0.2
#: Least score of a kind that is not one of the base kinds.
LEAST_SCORE = 0.5
KINDS = tuple(PATTERNS)
#: Kinds that their context alone confirms, and what parts the numbers of a list.
LISTED = tuple(k for k in KINDS if k not in BASE_KINDS and BASE_SCORE[k] < LEAST_SCORE)
LIST_GAP = r"^[\s\p{Punct}]*(?:(?:and|or)\s+)?$"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    chars = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    doubled = F.transform(chars, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _mod97(match: Column) -> Column:
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    chars = F.filter(F.split(turned, ""), lambda c: c != "")
    rest = F.aggregate(chars, F.lit(0), lambda a, c: F.when(
        c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))
    return rest == 1


def _account(match: Column) -> Column:
    """The account number that a match starts with, or null. Its length is only
    open for codes without a fixed one: then fewer groups are tried as well."""
    groups = F.split(match, " ")
    least = F.when(match.rlike(IBAN_CODES), F.size(groups)).otherwise(F.lit(1))
    tries = F.transform(F.sequence(F.size(groups), least, F.lit(-1)),
                        lambda k: F.array_join(F.slice(groups, F.lit(1), k), " "))
    return F.get(F.filter(tries, lambda t: F.length(F.replace(t, F.lit(" "), F.lit(""))).between(15, 34) & _mod97(t)), F.lit(0))


def _confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = "0*+(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])?"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        digits = _digits(match)
        return F.length(digits).between(16, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    if kind == "iban":
        return _account(match).isNotNull()
    return F.lit(True)


def _near(kind: str, i: Column) -> Column:
    """Whether a context word is within CONTEXT_CHARS of match ``i``, before or
    after; only so many neighbours are joined as can lie in that window."""
    piece, before, after = (F.col(f"_{x}_{kind}") for x in ("piece", "before", "after"))
    reach = -(-CONTEXT_CHARS // LEAST_CHARS[kind])
    wide = F.lit(CONTEXT_CHARS)
    ahead = F.concat(F.array_join(F.slice(before, F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach))), ""),
                     F.right(F.get(piece, i), wide))
    behind = F.concat(F.left(F.get(piece, i + 1), wide), F.array_join(F.slice(after, i + 2, F.lit(reach)), ""))
    return (F.lower(F.right(ahead, wide)).rlike(CONTEXT[kind])
            | F.lower(F.left(behind, wide)).rlike(CONTEXT[kind]))


def _anchors(near: Column, piece: Column) -> Column:
    """Per match: an odd number if it is near a word, an even one if it starts
    a list, else 0. A running maximum then is odd where the list so far has one."""
    return F.transform(near, lambda x, i: F.when(x | ~F.get(piece, i).rlike(LIST_GAP), 2 * i + x.cast("int"))
                       .otherwise(F.lit(0)).cast("bigint"))


def _spans(kind: str) -> Column:
    """Confirmed spans of one kind from its matches, pieces and match ends."""
    match, stops = F.col(f"_match_{kind}"), F.col(f"_stop_{kind}")

    def near(i: Column) -> Column:
        if kind not in LISTED:
            return _near(kind, i)
        last = F.size(match) - 1
        return (F.get(F.col(f"_fore_{kind}"), i) % 2 == 1) | (F.get(F.col(f"_back_{kind}"), last - i) % 2 == 1)

    def span(m: Column, i: Column) -> Column:
        score = F.lit(BASE_SCORE[kind]) + F.when(near(i), F.lit(CONTEXT_BONUS)).otherwise(F.lit(0.0))
        stop = F.get(stops, i)
        start = stop - F.length(m)
        if kind == "iban":
            stop = start + F.length(_account(m))
        return F.when(_confirmed(kind, m), F.struct(start.alias("start"), stop.alias("stop"), score.alias("score")))

    least = 0.0 if kind in BASE_KINDS else LEAST_SCORE
    return F.filter(F.transform(match, span), lambda s: s.isNotNull() & (s["score"] >= least))


def with_spans(docs: DataFrame, text_col: str = "_text") -> DataFrame:
    """Adds ``_<kind>``: array of (start, stop, score), for every kind."""
    none = F.array().cast("array<string>")
    hint = {"email": "@", "phone": "+"}
    text = F.col(text_col)
    found = docs.withColumns({f"_match_{k}": F.regexp_extract_all(text, F.lit(rx), F.lit(0)) if k not in hint else
                              F.when(F.contains(text, F.lit(hint[k])), F.regexp_extract_all(text, F.lit(rx), F.lit(0)))
                              .otherwise(none) for k, rx in PATTERNS.items()})
    cut = found.withColumns({f"_piece_{k}": F.when(F.size(f"_match_{k}") > 0, F.split(text, rx, -1)).otherwise(none)
                             for k, rx in PATTERNS.items()})

    def steps(kind: str) -> Column:
        return F.transform(F.col(f"_match_{kind}"), lambda m, i: (
            F.length(F.get(F.col(f"_piece_{kind}"), i)) + F.length(m)).cast("bigint"))

    def edge(kind: str, side: str) -> Column:
        # the last characters up to each match's end, or the first from its start
        def text_at(m: Column, i: Column) -> Column:
            if side == "before":
                return F.right(F.concat(F.get(F.col(f"_piece_{kind}"), i), m), F.lit(CONTEXT_CHARS))
            return F.left(F.concat(m, F.get(F.col(f"_piece_{kind}"), i + 1)), F.lit(CONTEXT_CHARS))

        return F.transform(F.col(f"_match_{kind}"), text_at)

    sized = cut.withColumns({f"_size_{k}": steps(k) for k in KINDS} | {
        f"_{side}_{k}": edge(k, side) for side in ("before", "after") for k in KINDS})
    ended = with_running(sized, {f"_stop_{k}": f"_size_{k}" for k in KINDS})
    for k in LISTED:
        ended = ended.withColumn("_near", F.transform(F.col(f"_match_{k}"), lambda _, i: _near(k, i)))
        ended = ended.withColumns({
            "_ahead": _anchors(F.col("_near"), F.col(f"_piece_{k}")),
            "_behind": _anchors(F.reverse("_near"), F.reverse(f"_piece_{k}"))})
        ended = with_running(ended, {f"_fore_{k}": "_ahead", f"_back_{k}": "_behind"}, "max").drop("_near", "_ahead", "_behind")
    spans = ended.withColumns({f"_{k}": _spans(k) for k in KINDS})
    return spans.drop(*[f"_{x}_{k}" for x in ("match", "piece", "size", "stop", "before", "after", "fore", "back") for k in KINDS])


def _listed(kinds: tuple[str, ...]) -> Column:
    def parts(kind: str) -> Column:
        return F.transform(F.col(f"_{kind}"), lambda s: F.concat(
            F.lit(f"{kind}:"), s["start"].cast("string"), F.lit(":"), s["stop"].cast("string")))

    return F.array_join(F.concat(*[parts(k) for k in kinds]), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: counts of the base kinds, their digest, all spans, best score."""
    rows = with_spans(docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text")))
    best = reduce(lambda a, b: F.greatest(a, b), [
        F.coalesce(F.array_max(F.transform(F.col(f"_{k}"), lambda s: s["score"])), F.lit(0.0)) for k in KINDS])
    return rows.select(
        F.col("_id").alias(id_col),
        *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(_listed(BASE_KINDS).cast("binary"), 256).alias("base_sha256"),
        _listed(KINDS).alias("spans"), best.alias("best_score"))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by ``<KIND>``.

    Overlapping spans become one placeholder, that of the first one. All other
    columns stay as they are.
    """
    names = docs.columns
    # names of the caller's columns are put aside so that none can clash
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    at = names.index(text_col)
    rows = with_spans(rows.withColumn("_text", text_or_empty(f"c{at}")))

    def named(kind: str) -> Column:
        return F.transform(F.col(f"_{kind}"), lambda s: F.struct(
            s["start"].alias("start"), s["stop"].alias("stop"), F.lit(kind.upper()).alias("kind")))

    rows = rows.withColumn("_flat", F.sort_array(F.concat(*[named(k) for k in KINDS])))
    rows = rows.withColumn("_stops", F.transform("_flat", lambda s: s["stop"]))
    rows = with_running(rows, {"_reach": "_stops"}, "max")
    reach = F.col("_reach")

    def part(s: Column, i: Column) -> Column:
        # text since the furthest end so far; a span that starts before it adds nothing
        at = F.coalesce(F.get(reach, i - 1), F.lit(0).cast("bigint"))
        before = F.substring(F.col("_text"), (at + 1).cast("int"), (s["start"] - at).cast("int"))
        return F.when(s["start"] >= at, F.concat(before, F.lit("<"), s["kind"], F.lit(">"))).otherwise(F.lit(""))

    whole = F.concat(F.array_join(F.transform("_flat", part), ""),
                     F.substring(F.col("_text"), (F.array_max(reach) + 1).cast("int"), F.lit(2**31 - 1)))
    clean = F.when(F.size("_flat") > 0, whole).otherwise(F.col(f"c{at}"))
    return rows.select(*[(clean if i == at else F.col(f"c{i}")).alias(c) for i, c in enumerate(names)])
