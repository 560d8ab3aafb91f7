"""Random tokens of every encoding, and the false-discovery rule."""

import random
import uuid

import numpy as np
import pytest
from rows import SMALL

from visitlens.llm import secret_scan


@pytest.fixture(scope="module")
def model(spark):
    return secret_scan.natural_model(secret_scan.pair_counts(spark.read.parquet(f"{SMALL}/documents.parquet")))


@pytest.mark.parametrize("name", ["lower", "upper", "letters", "hex", "base32", "base32_lower", "lower_digits", "upper_digits", "alnum", "base64"])
@pytest.mark.parametrize("size", [32, 64, 128, 256])
def test_random_tokens_of_every_encoding(model, name, size):
    rng = random.Random(size)
    alphabet = secret_scan.ALPHABETS[name].rstrip("=")
    tokens = ["".join(rng.choices(alphabet, k=size)) for _ in range(300)]
    found = [secret_scan.natural_p(t, model) for t in tokens]
    assert sum(p < 1.0 for p in found) >= 294
    assert np.median(found) < 1e-3


def test_identifiers_with_hyphens(model):
    rng = random.Random(2)
    tokens = [str(uuid.UUID(int=rng.getrandbits(128))) for _ in range(300)]
    assert sum(secret_scan.natural_p(t, model) < 1e-2 for t in tokens) >= 270
    assert secret_scan.plain("ab-cd-ef") == "abcdef" and secret_scan.plain("-ab") == "-ab" and secret_scan.plain("a_b-c") == "a_b-c"


def test_words_and_slugs_are_natural(spark, model):
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect() if r.text]
    words = [w.lower() for t in texts for w in t.split() if w.isascii() and w.isalpha() and len(w) < 20]
    rng = random.Random(3)
    slugs = [sep.join(rng.choices(words, k=n)) for sep in ("-", "_", "") for n in (5, 8, 15) for _ in range(100)]
    slugs = [s for s in slugs if len(s) >= 20]
    assert sum(secret_scan.natural_p(s, model) < 1e-3 for s in slugs) <= 0.01 * len(slugs)
    numbers = ["".join(rng.choices("0123456789", k=n)) for n in (20, 32) for _ in range(100)]
    assert sum(secret_scan.natural_p(s, secret_scan.natural_model()) < 1.0 for s in numbers) == 0


def test_pairs_leave_candidates_out(spark):
    docs = spark.createDataFrame([("abab " + "xy" * 20 + " Zz 12-12", ), (None,), ("", ), ("é ab",)], "text string").na.fill("")
    got = secret_scan.pair_counts(docs)
    held = {chr(a) + chr(b): int(n) for a, row in enumerate(got) for b, n in enumerate(row) if n}
    assert held == {"ab": 3, "ba": 1, "12": 2}


def test_discoveries_follow_the_rule():
    """Against Benjamini and Hochberg over the p-values themselves."""
    rng = random.Random(9)
    for _ in range(50):
        bins = [rng.choice([0, 1, 5, 20, 40, 90]) for _ in range(rng.randrange(1, 200))]
        ranked = sorted(10 ** (-b / 10) for b in bins)
        most = max((p for i, p in enumerate(ranked, 1) if p <= secret_scan.RATE * i / len(ranked)), default=0.0)
        want = sum(p <= most for p in ranked)
        histogram = [(0, b, bins.count(b)) for b in set(bins)]
        least = secret_scan.discoveries(histogram).get(0)
        assert (sum(b >= least for b in bins) if least is not None else 0) == want


def test_letter_keys_are_found_in_a_corpus(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rng = random.Random(8)
    keys = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n)) for n in (40, 64, 128, 256) for _ in range(10)]
    more = spark.createDataFrame([(10_000 + i, f"key {k} end") for i, k in enumerate(keys)], "doc_id bigint, text string")
    got = {r.doc_id: r.spans for r in secret_scan.scan(docs.unionByName(more)).collect()}
    assert sum(got[10_000 + i] == f"random:4:{4 + len(k)}" for i, k in enumerate(keys)) >= 38
