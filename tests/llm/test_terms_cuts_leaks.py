"""Source divergence, fill-in-the-middle and benchmark decontamination."""

import random

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from rows import EDGE, SMALL

from visitlens.llm import decontamination, fill_in_middle, queries, source_divergence

DOCS = "text string, lang string, source string, term string, n string, part int"


def term_rows(seed=3):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "Ünder", "ünder", "x", "zz9y", "ДОМ", "дом", "été-ne", "rare" * 200]
    rows = [(" ".join(rng.choices(words, range(1, 12), k=rng.randrange(0, 30))), rng.choice(["en", "", None, "de"]),
             rng.choice(["a", "b", "c", "", None, "é"])) for _ in range(120)]
    return rows + [(None, "en", "empty"), ("", "none", "s1"), ("123 .. 9", "none", "s2"), ("lone", "none", "s3"),
                   ("alpha " * 60_000, "en", "a"), *[("same words here", "en", "b")] * 4]


def divergence(spark, rows, **more):
    docs = spark.createDataFrame([(*r, "clash", "n", 1) for r in rows], DOCS).repartition(4)
    return sorted(tuple(r) for r in source_divergence.divergence(docs, **more).collect())


def test_divergence_equals_brute_force(spark):
    rows = term_rows()
    want = brute.divergence(rows, min_docs=3, top=4)
    assert divergence(spark, rows, min_docs=3, top=4) == want
    assert {("none", "s1", "pair", "s2", 0, 1), ("none", "s1", "pair", "s3", 0, 2)} <= set(want)


def test_divergence_splits_digests_that_collide(spark, monkeypatch):
    rows = term_rows(8)
    want = brute.divergence(rows, min_docs=3, top=4)
    for digest in (len, lambda term: 7, lambda term: (len(term) << 27) + 5):
        assert divergence(spark, rows, min_docs=3, top=4, digest=digest) == want
    monkeypatch.setattr(source_divergence, "TILE", 2)
    monkeypatch.setattr(source_divergence, "CELLS", 20)
    monkeypatch.setattr(source_divergence, "PASS_BYTES", 300)
    assert divergence(spark, rows, min_docs=3, top=4, block_bytes=40_000) == want


def test_divergence_counts_without_texts():
    assert not any(kind in source_divergence._BUNDLE.replace("lang string", "") for kind in ("string", "binary"))


def test_divergence_of_nothing(spark):
    assert divergence(spark, []) == []
    assert divergence(spark, [(None, None, None)]) == []
    assert divergence(spark, [(None, None, None), ("", "", "x")]) == [("", "", "pair", "x", 0, 1), ("", "x", "pair", "", 0, 1)]


def test_shares_are_exact():
    rng = random.Random(4)
    counts = [rng.randrange(0, 10 ** 14) for _ in range(200)] + [0, 1]
    whole = [c + rng.randrange(5, 10 ** 15) for c in counts]
    got = source_divergence._shares(np.array(counts), np.array(whole)).tolist()
    assert got == [1 + 10 ** 9 * (c + 5) // w for c, w in zip(counts, whole)]


MORE = [(20, "no end of line"), (21, "\n"), (22, "\n\n\n"), (23, "a\r\nb\rc\n\x85d e"), (24, "half <P"), (25, "<S>"), (26, "x\n<M>\ny"),
        (27, "<<P<S<M\n>>\n<" * 3), (None, "no\nid\n"), (28, "ж\n日本\n🙂" * 50), (28, "ж\n日本\n🙂" * 50), (29, "\0a\n\0")]


def test_fill_in_middle_equals_brute_force(spark, edge):
    more = spark.createDataFrame([(i, t, "c", "c", "c") for i, t in MORE], "doc_id bigint, text string, output string, form string, id string")
    for docs, rows in ((edge, EDGE), (more, MORE)):
        got = fill_in_middle.restore(fill_in_middle.transform(docs)).collect()
        want = [(i, *brute.middle(i, t), t or "") for i, t in rows]
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_fill_in_middle_rates(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("a\nb\nc").alias("text"))
    forms = {r[0]: r[1] for r in fill_in_middle.transform(docs, rate=40, spm_percent=25).groupBy("form").count().collect()}
    assert 1100 < forms["plain"] < 1300 and 130 < forms["spm"] < 270 and 500 < forms["psm"] < 700
    assert fill_in_middle.restore(fill_in_middle.transform(docs.limit(0))).count() == 0


def test_fill_in_middle_keeps_batches_small(spark, monkeypatch):
    monkeypatch.setattr(fill_in_middle, "BATCH_BYTES", 10)
    docs = spark.createDataFrame([(i, f"line {i}\nnext\nlast {i}") for i in range(50)], "doc_id int, text string").coalesce(1)
    got = {r.doc_id: r for r in fill_in_middle.restore(fill_in_middle.transform(docs)).collect()}
    assert all(got[i].output == brute.middle(i, f"line {i}\nnext\nlast {i}")[-1] and got[i].restored == f"line {i}\nnext\nlast {i}" for i in range(50))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab\n<>PSMé🙂"), max_size=40), st.integers(0, 9), st.integers(0, 9), st.sampled_from(["psm", "spm"]))
def test_rotations_are_inverted(text, one, two, form):
    data = text.encode()
    if any(t in data for t in fill_in_middle.SENTINELS):
        return
    at = fill_in_middle.line_starts(data)
    a, b = sorted((int(at[one % len(at)]), int(at[two % len(at)])))
    out = fill_in_middle.formatted(data, a, b, form)
    parts = {"p": b"<P>" + data[:a], "s": b"<S>" + data[b:], "m": b"<M>" + data[a:b]}
    assert out == b"".join(parts[c] for c in ("psm" if form == "psm" else "spm"))
    assert fill_in_middle.restored(out, form) == data


ITEMS = [(1, "One two three four five six seven eight nine ten eleven"), (1, "another text of item one with ten words in it"),
         (2, "tiny item"), (3, "word1, WORD2 word3; word4 word5 a"), (4, None), (5, ""), (6, "?!"), (None, "négative id"), (7, "a"),
         (8, "one-two-three four five six seven eight nine ten"), (9, "tiny item"),
         (10, "seven eight nine ten one two three four five six seven eight")]


def leak_rows():
    rng = random.Random(5)
    words = "one two three four five six seven eight nine ten eleven tiny item".split()
    return [*EDGE, (30, "ONE two\nthree_four five six seven eight nine ten eleven twelve"), (31, "Tiny   ITEM tiny item"), (31, "x tiny. item"),
            (32, "one two three four five six seven eight nine"), (33, "NÉGATIVE id, nÉgative id, négative ID"), (None, "tiny item"),
            *[(40 + i, " ".join(rng.choices(words, k=200)) + " " + " ".join(words[:11])) for i in range(6)]]


def found(df):
    return sorted((repr(r.doc_id), r.n_words, r.n_hit, list(r["items"])) for r in df.collect())


def test_decontamination_equals_brute_force(spark, monkeypatch):
    rows = leak_rows()
    docs = spark.createDataFrame([(i, t, 1, "c") for i, t in rows], "doc_id bigint, text string, hits int, row string").repartition(3)
    bench = spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id bigint, text string, words string")
    want = sorted((repr(i), *rest) for i, *rest in brute.leaks(rows, ITEMS))
    assert found(decontamination.measure(docs, bench)) == want
    # the same from several slices, short pieces and small passes
    monkeypatch.setattr(decontamination, "PIECE", 1)
    monkeypatch.setattr(decontamination, "PASS_BYTES", 50)
    for limit in (120,):
        both = decontamination.scan(docs, bench, limit=limit)
        assert found(both.select("row.doc_id", "n_words", decontamination.n_hit().alias("n_hit"), "items")) == want
    assert len(list(decontamination.slices(decontamination.pieces(bench).checkpoint(), limit=100))) > 2


def test_hash_collisions_are_no_hits(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "grams", lambda words, size: np.zeros(max(len(words) - size + 1, 0), np.uint64))
    rows = [(i, t) for i, t in leak_rows() if len(t or "") < 5000]
    docs, bench = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert found(decontamination.measure(docs, bench)) == sorted((repr(i), *rest) for i, *rest in brute.leaks(rows, ITEMS))


def test_spans_and_documents_are_removed(spark):
    rows = leak_rows()
    docs = spark.createDataFrame([(i, t, "h") for i, t in rows], "doc_id bigint, text string, hits string")
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    want = brute.leaks(rows, ITEMS)
    left = decontamination.remove_documents(docs, bench)
    assert left.columns == docs.columns
    assert sorted(map(repr, [(r[0], r[1]) for r in left.collect()])) == sorted(repr(r) for r, w in zip(rows, want) if not w[2])
    cut = decontamination.remove_spans(docs, bench)
    assert cut.columns == docs.columns
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[1] is None and texts[4] == "Same text here" and texts[32] == rows[[i for i, _ in rows].index(32)][1]
    assert texts[30] == " twelve" and texts[33] == "NÉGATIVE id, nÉgative id, "
    again = brute.leaks([(i, t) for i, t in texts.items()], ITEMS)
    assert sum(w[1] for w in again) <= sum(w[1] - w[2] for w in want)


def test_decontamination_of_nothing(spark):
    docs, bench = spark.createDataFrame(leak_rows(), "doc_id bigint, text string"), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert {r.n_hit for r in decontamination.measure(docs, bench.limit(0)).collect()} == {0}
    assert decontamination.measure(docs.limit(0), bench).count() == 0


def test_queries_equal_brute_force(spark, small):
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in queries.op13_decontamination(spark, SMALL).collect()}
    want = {i: (n, hit, len(names), brute.sha(",".join(names)), hit > 0) for i, n, hit, names in brute.leaks(small, items)}
    assert got == want and any(w[4] for w in want.values())
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_fill_in_middle(spark, SMALL).collect()}
    assert got == {i: (*brute.middle(i, t)[:4], brute.sha(brute.middle(i, t)[4]), brute.sha(t or "")) for i, t in small}
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text", "lang", "source").collect()]
    assert sorted(tuple(r) for r in queries.op11_source_divergence(spark, SMALL).collect()) == brute.divergence(rows)
