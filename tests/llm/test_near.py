"""Near-dedup: whole links on groups that share much, and few comparisons."""

import random

import brute
import numpy as np
import pytest

from visitlens.llm import near_dedup


def word(rng):
    return "".join(rng.choice("abcdefghij") for _ in range(6))


def boilerplate(n, rng):
    """Texts of 150 common and 30 own words: about 0.71 similar, none linked."""
    common = [word(rng) for _ in range(150)]
    return [(i, " ".join(common + [word(rng) for _ in range(30)])) for i in range(n)]


def star(n, rng, start=0):
    """A text and copies of it that are linked with it, hardly with each other."""
    base = [word(rng) for _ in range(200)]
    rows = []
    for i in range(n):
        own = list(base)
        for at in rng.sample(range(0, 200, 3), 10):
            own[at] = word(rng)
        rows.append((start + i, " ".join(own)))
    return [(start + n, " ".join(base)), *rows]


def run(spark, rows, size=2):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return {r.doc_id: r.component_id for r in near_dedup.near_dedup(docs, size).collect()}


@pytest.fixture
def compared(monkeypatch):
    """Numbers of pairs that were looked at."""
    counts, real = [], near_dedup.verified

    def counted(pairs, sets, percent):
        counts.append(pairs.count())
        return real(pairs, sets, percent)

    monkeypatch.setattr(near_dedup, "verified", counted)
    return counts


def test_boilerplate_is_not_compared_pair_by_pair(spark, compared):
    spent = {}
    for n in (750, 1500):
        compared.clear()
        got = run(spark, boilerplate(n, random.Random(3)))
        assert all(i == c for i, c in got.items())
        spent[n] = sum(compared)
    assert spent[1500] <= 4 * 1500 and spent[1500] <= 2.5 * spent[750]


def test_copies_meet_their_source(spark, compared):
    rows = star(300, random.Random(4)) + boilerplate(20, random.Random(5))[1:]
    rows = [(i if n <= 300 else 1000 + i, t) for n, (i, t) in enumerate(rows)]
    want = {i: w[1] for (i, _), w in zip(sorted(rows), brute.near(sorted(rows), 2, 80))}
    assert len({c for i, c in want.items() if i <= 300}) == 1
    assert run(spark, rows) == want
    assert sum(compared) <= 4 * len(rows)


@pytest.mark.parametrize("turns, small", [(("rest",), 1), (("rest",), 32), (("nearest", "rest"), 2)])
def test_prefixes_lose_no_link(spark, monkeypatch, turns, small):
    """The exact finish alone: all buckets large, or all of one size, without hubs."""
    monkeypatch.setattr(near_dedup, "TURNS", turns)
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", small)
    monkeypatch.setattr(near_dedup, "TILE", 5)
    rng = random.Random(len(turns) + small)
    rows = star(40, rng) + [(100 + i, t) for i, t in boilerplate(30, rng)]
    for k in range(8):
        base = [word(rng) for _ in range(rng.choice([3, 10, 60, 400]))]
        for i in range(8):
            own = [w if rng.random() > 0.05 * rng.random() else word(rng) for w in base][:len(base) - rng.randrange(0, max(len(base) // 8, 1))]
            rows.append((1000 + 10 * k + i, " ".join(own)))
    rows.sort()
    assert run(spark, rows) == {i: w[1] for (i, _), w in zip(rows, brute.near(rows, 2, 80))}


def test_needed_overlap_is_exact():
    for a in range(1, 60):
        for b in range(a, 60):
            least = next(o for o in range(0, 2 * b + 1) if 100 * o >= 80 * (a + b - o))
            assert near_dedup.needed(a, b, 80) == least
    starts = near_dedup._class_starts(5000)
    assert np.all(np.diff(starts) > 0) and starts[0] == 1 and starts[-1] > 5000
    x, y = np.array([1, 4, 9], np.uint64), np.array([2, 4, 9, 10], np.uint64)
    assert near_dedup.overlap(x, y) == near_dedup.overlap(y, x) == 2


@pytest.mark.parametrize("size", [2, 5])
def test_whole_table_equals_brute_force(spark, size):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_dedup(docs, size).collect()}
    assert got == {i: w for (i, _), w in zip(rows, brute.near(rows, size, 80))}
