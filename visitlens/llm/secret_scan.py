"""Secret scan: fixed patterns plus a randomness test battery.

Three patterns (assignments, access keys, long hex runs) give the base spans.
Every other long token is a candidate. Its encoding is inferred from its
characters (without the hyphens or underscores that part it), and three tests ask
whether it looks drawn at random from that alphabet: chi-squared uniformity, runs
of character classes, and serial correlation. A candidate that no test rejects
gets a p-value under the natural-text null: the likelihood ratio of random against
natural text is a bet whose chance of reaching r is at most 1 / r, so short tokens
can never score well. Natural text keeps its character class, and within a class
a character follows the one before as in the corpus, whose pairs are counted over
all words too short to be candidates; so random letters of one class differ
from words. The false-discovery rule (Benjamini and Hochberg, in each length class)
then runs over all candidates of the corpus; only a histogram and the pair counts,
both of bounded size, reach the driver.

What holds by encoding: tokens of letters alone, of either case, and identifiers
in hexadecimal with hyphens are judged like others. Digits alone are judged by the
corpus' digit pairs only, so a long number is found where those are far from even.

Defined results: null text counts as empty; a text without spans has the
digest of the empty string; repeated rows give repeated results; an empty
table gives no rows; only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import cut_lineage, text_or_empty

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")  # LEAST characters
#: Alphabets from narrow to wide; the first that holds a token is its encoding.
ALPHABETS = {
    "digits": string.digits, "hex": "0123456789abcdef", "hex_upper": "0123456789ABCDEF", "lower": string.ascii_lowercase,
    "upper": string.ascii_uppercase, "letters": string.ascii_letters, "base32": string.ascii_uppercase + "234567",
    "base32_lower": string.ascii_lowercase + "234567", "lower_digits": string.ascii_lowercase + string.digits,
    "upper_digits": string.ascii_uppercase + string.digits,
    "alnum": string.ascii_letters + string.digits, "base64": string.ascii_letters + string.digits + "+/=",
    "base64url": string.ascii_letters + string.digits + "_-=",
    "mixed": string.ascii_letters + string.digits + "+/_-=",
}
#: A test rejects randomness below ALPHA; STAY is the chance that natural text
#: keeps its character class; RATE bounds the share of false discoveries.
ALPHA, STAY, RATE = 0.001, 0.9, 0.01
#: Lower bounds of the length classes; p-values are binned by tenths of log10.
LENGTHS, BINS = (0, 28, 40, 64), 400
#: Pairs that the natural model assumes beside each seen one's, spread evenly.
PRIOR = 500.0
#: Least characters of a candidate.
LEAST = 20

_SETS = {k: frozenset(v) for k, v in ALPHABETS.items()}
_CLASS = np.full(128, 3)
for _i, _chars in enumerate((string.ascii_lowercase, string.ascii_uppercase, string.digits)):
    _CLASS[[ord(c) for c in _chars]] = _i


def _upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(token: str) -> tuple[str, float, float, float]:
    """Encoding and the p-values of uniformity, runs and serial correlation."""
    chars = set(token)
    encoding = next((k for k, s in _SETS.items() if chars <= s), "mixed")
    alphabet = ALPHABETS[encoding].rstrip("=")
    order = {c: i for i, c in enumerate(alphabet)}
    codes = np.array([order[c] for c in token if c in order], dtype=float)
    n, size = len(codes), len(alphabet)
    if n < 2:
        return encoding, 0.0, 0.0, 0.0
    expected = n / size
    chi = float((((np.bincount(codes.astype(int), minlength=size) - expected) ** 2) / expected).sum())
    # Wilson-Hilferty: the cube root of chi-squared over its mean is near normal
    df = size - 1
    uniform = _upper_tail(((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))
    classes = _CLASS[[ord(c) for c in token if c in order]]
    share = np.bincount(_CLASS[[ord(c) for c in alphabet]], minlength=4) / size
    change = 1 - float((share ** 2).sum())
    if 0 < change < 1:
        seen = int((classes[1:] != classes[:-1]).sum())
        runs = 2 * _upper_tail(abs(seen - (n - 1) * change) / math.sqrt((n - 1) * change * (1 - change)))
    else:
        runs = 1.0
    centred = codes - (size - 1) / 2
    serial = float((centred[1:] * centred[:-1]).sum()) / ((size * size - 1) / 12)
    return encoding, uniform, min(1.0, runs), 2 * _upper_tail(abs(serial) / math.sqrt(n - 1))


def pair_counts(docs: DataFrame) -> np.ndarray:
    """How often an ASCII character follows another of its class (letters of either
    case, digits), over all words of (text) too short to be candidates."""
    follows = np.zeros(256, np.int64)
    follows[:128] = _CLASS
    follows[128:] = 3
    part_of = np.zeros(256, bool)
    part_of[[ord(c) for c in ALPHABETS["mixed"]]] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                texts = batch.column(0).slice(at, 1024).cast(pa.binary()).to_pylist()
                data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
                edge = np.diff(part_of[data].astype(np.int8), prepend=0)
                starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                short = np.repeat(ends - starts < LEAST, ends - starts)
                inside = np.zeros(len(data), bool)
                inside[part_of[data]] = short
                same = inside[1:] & inside[:-1] & (follows[data[1:]] == follows[data[:-1]]) & (follows[data[1:]] < 3)
                pair, n = np.unique(data[:-1][same].astype(np.int64) << 7 | data[1:][same], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], ["pair", "n"])

    out = np.zeros(1 << 14)
    for r in docs.select("text").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[r["pair"]] = r["n"]
    return out.reshape(128, 128)


def natural_model(pairs: np.ndarray | None = None) -> np.ndarray:
    """Log of how much likelier than by an even draw from its class a character
    follows another of that class; zero without counts. Words in capitals have the
    letter pairs of others, so both cases are counted together."""
    out = np.zeros((128, 128))
    if pairs is not None:
        at = {chars: np.ix_([ord(c) for c in chars], [ord(c) for c in chars])
              for chars in (string.ascii_lowercase, string.ascii_uppercase, string.digits)}
        letters = pairs[at[string.ascii_lowercase]] + pairs[at[string.ascii_uppercase]]
        for chars, own in at.items():
            counts = pairs[own] if chars == string.digits else letters
            out[own] = np.log((counts + PRIOR / len(chars)) / (counts.sum(axis=1, keepdims=True) + PRIOR) * len(chars))
    return out


_EVEN = natural_model()


def plain(token: str) -> str:
    """``token`` without the hyphens or underscores that part it."""
    for mark in "-_":
        parts = token.split(mark)
        if len(parts) > 1 and all(p.isalnum() for p in parts):
            return "".join(parts)
    return token


def natural_p(token: str, model: np.ndarray = _EVEN) -> float:
    """p-value under natural text, or 1 where a test rejects randomness."""
    token = plain(token)
    encoding, *tests = battery(token)
    if 3 * min(tests) < ALPHA:
        return 1.0
    alphabet = ALPHABETS[encoding]
    share = np.bincount(_CLASS[[ord(c) for c in alphabet]], minlength=4) / len(alphabet)
    codes = np.array([ord(c) for c in token])
    classes = _CLASS[codes]
    same = classes[1:] == classes[:-1]
    drawn = np.log(np.maximum(share[classes[1:]], 1e-9)).sum()
    # a class that is the whole alphabet cannot be left
    stay = 1.0 if share.max() == 1 else STAY
    natural = np.where(same, math.log(stay), math.log(max(1 - stay, 1e-9) / 3)).sum() + model[codes[:-1], codes[1:]].sum()
    return float(min(1.0, math.exp(min(0.0, natural - drawn))))


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, stop) of the three patterns."""
    found = [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    low = text.lower()
    if any(word in low for word in ("passw", "secret", "token", "api")):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1])))


def _rows(batches: Iterator[pa.RecordBatch], model: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            counts, base, tokens = [], [], []
            for text in part.column(1).to_pylist():
                spans = base_spans(text)
                counts.append([sum(s[1] == k for s in spans) for k in KINDS])
                base.append([{"start": a, "stop": b, "kind": k} for a, k, b in spans])
                own = []
                for m in TOKEN.finditer(text):
                    if not any(a < m.end() and m.start() < b for a, _, b in spans):
                        p = natural_p(m[0], model)
                        own.append({"start": m.start(), "stop": m.end(), "class": sum(len(m[0]) >= x for x in LENGTHS) - 1,
                                    "bin": min(BINS, int(-10 * math.log10(max(p, 1e-60))))})
                tokens.append(own)
            whole = pa.int64()
            span = pa.list_(pa.struct([("start", whole), ("stop", whole), ("kind", pa.string())]))
            token = pa.list_(pa.struct([("start", whole), ("stop", whole), ("class", pa.int32()), ("bin", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *[pa.array([c[i] for c in counts], whole) for i in range(3)],
                 pa.array([hashlib.sha256(",".join(f"{s['kind']}:{s['start']}:{s['stop']}" for s in b).encode()).hexdigest() for b in base]),
                 pa.array(base, span), pa.array(tokens, token)],
                ["id", "n_assign", "n_access", "n_hex", "base_sha256", "base", "tokens"])


def discoveries(histogram: list[tuple[int, int, int]], rate: float = RATE) -> dict[int, int]:
    """Length class -> least bin kept, from (class, bin, count) rows."""
    least = {}
    for kind in {c for c, _, _ in histogram}:
        counts = sorted(((b, n) for c, b, n in histogram if c == kind), reverse=True)
        total, seen = sum(n for _, n in counts), 0
        for b, n in counts:
            seen += n
            if 10 ** (-b / 10) * total <= rate * seen and b > 0:
                least[kind] = b
    return least


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: base counts and digest, and all spans by start."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    model = natural_model(pair_counts(rows))
    found = cut_lineage(rows.mapInArrow(lambda batches: _rows(batches, model), (
        f"id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
        "base array<struct<start:bigint,stop:bigint,kind:string>>, "
        "tokens array<struct<start:bigint,stop:bigint,class:int,bin:int>>")))
    one = found.select(F.explode("tokens").alias("t")).groupBy("t.class", "t.bin").count()
    least = discoveries([tuple(r) for r in one.collect()])  # at most classes x bins rows
    keep = F.lit(False)

    def passes(t):
        out = keep
        for c, b in least.items():
            out = out | ((t["class"] == c) & (t["bin"] >= b))
        return out

    drawn = F.transform(F.filter("tokens", passes), lambda t: F.struct(
        t["start"].alias("start"), F.lit(len(KINDS)).alias("order"), t["stop"].alias("stop"), F.lit("random").alias("kind")))
    order = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    base = F.transform("base", lambda s: F.struct(
        s["start"].alias("start"), order[s["kind"]].alias("order"), s["stop"].alias("stop"), s["kind"].alias("kind")))
    spans = F.transform(F.sort_array(F.concat(base, drawn)), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")))
    return found.select(F.col("id").alias(id_col), "n_assign", "n_access", "n_hex", "base_sha256",
                        F.array_join(spans, ",").alias("spans"), F.size(F.filter("tokens", passes)).cast("long").alias("n_random"))
