"""Classifier, scoring, packing, secrets, byte-pair codes and near-dedup."""

import collections
import math
import random
import tracemalloc
import types
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from rows import EDGE, SMALL
from tokenizers import Tokenizer

from visitlens.llm import bpe, common, hashing, lm_scoring, near_dedup, packing, quality_classifier, queries, secret_scan

BYTES = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
WORDS = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()


def test_classifier_held_out_accuracy(spark):
    got = queries.op2_quality_classifier(spark, SMALL).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    known = [r for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in known]) >= 0.95


def test_classifier_edges(spark, edge):
    labels = spark.createDataFrame([(4, 1), (10, 0), (12, 0), (12, 1), (None, 1), (15, None), (3, 1)], "doc_id bigint, quality int")
    model = quality_classifier.train(quality_classifier.train_sample(edge, labels, "doc_id", "text", 100))
    plain = edge.select("doc_id", "text")
    got = quality_classifier.score(plain, model).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    left = quality_classifier.accepted(edge, model)
    assert left.columns == edge.columns
    none = quality_classifier.fit(edge, labels.limit(0))
    assert {r.score for r in quality_classifier.score(plain, none).collect()} == {0.5}
    assert quality_classifier.score(plain.limit(0), model).count() == 0


def test_classifier_scores_in_small_passes():
    """Many texts at once take little memory, and are scored as each alone."""
    texts = [f"text number {i} with words {i * i} and more ".encode() * 70 for i in range(1024)]
    flat = np.random.default_rng(3).normal(size=quality_classifier.BUCKETS + 1).astype(np.float32)
    tracemalloc.start()
    got = quality_classifier.score_texts(flat, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(map(len, texts)) > 2 << 20 and peak < 64 << 20
    assert all(got[i] == quality_classifier.score_texts(flat, texts[i:i + 1])[0] for i in range(0, 1024, 100))


def test_classifier_sends_a_text_once(spark, edge, monkeypatch):
    flat = np.zeros(quality_classifier.BUCKETS + 1, np.float32)
    flat[::3] = 1
    sent, plain = [], type(edge).mapInArrow
    monkeypatch.setattr(type(edge), "mapInArrow", lambda self, *a, **b: sent.append(len(self.columns)) or plain(self, *a, **b))
    docs = edge.select("doc_id", "text", "kept")
    got = quality_classifier.score(docs, flat).collect()
    assert sent == [3] and len(got) == len(EDGE)
    assert {r.doc_id: r.text for r in got} == dict(EDGE)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    numbers = spark.createDataFrame([(1, 20), (2, None)], "doc_id bigint, text int")
    words = spark.createDataFrame([(1, "20"), (2, None)], "doc_id bigint, text string")
    assert [tuple(r[:2]) for r in quality_classifier.score(numbers, flat).orderBy("doc_id").collect()] == [(1, 20), (2, None)]
    assert len({tuple(r.score for r in quality_classifier.score(d, flat).orderBy("doc_id").collect()) for d in (numbers, words)}) == 1


def test_classifier_ignores_the_order_of_the_table(spark):
    rows = [(i, f"good words {i} again" if i % 2 else f"bad text {i} {i}", i % 2) for i in range(120)]
    models = []
    for order in (rows, rows[::-1], sorted(rows, key=lambda r: r[2])):
        both = spark.createDataFrame(order, "doc_id bigint, text string, quality int").coalesce(1)
        models.append(quality_classifier.train(quality_classifier.train_sample(both.drop("quality"), both, "doc_id", "text", 100)))
    assert all(np.array_equal(models[0], m) for m in models[1:])
    assert quality_classifier.MAX_TRAIN_DOCS == 4000


def test_scoring_edges(spark, edge):
    got = collections.defaultdict(list)
    for r in lm_scoring.score(edge).collect():
        got[r.doc_id].append(r)
    train = [(t or "").encode() for i, t in EDGE if zlib.crc32(str(i).encode()) % 10]
    tree = brute.Tree(lm_scoring.DEPTH, train)
    for (i, t), (tokens, known, n, base) in zip(EDGE, brute.unigram(EDGE)):
        r = got[i][0]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (tokens, known, n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        if len(t or "") < 1000:
            assert math.isclose(r.score, tree.score((t or "").encode()), rel_tol=1e-6)
    assert sum(map(len, got.values())) == len(EDGE)
    assert lm_scoring.score(edge.limit(0)).count() == 0


def test_scoring_without_training_rows(spark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in lm_scoring.score(docs, held_out=F.lit(True)).collect()}
    assert math.isclose(got[1].score, 24 * math.log10(0.5)) and got[1].train_tokens == 0 and got[2].n_known == 0


def test_scoring_tables(spark, small):
    got = {r.doc_id: r for r in queries.op5_lm_scoring(spark, SMALL).collect()}
    for (i, _), (tokens, known, n, base) in zip(small, brute.unigram(small)):
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (tokens, known, n)
        assert math.isclose(got[i].base_score, base, rel_tol=1e-9)
    assert 1 < np.mean([r.bits_per_byte for r in got.values() if r.held_out]) < 4


def check_packed(rows, texts):
    ids_of = packing.WordIds(WORDS)
    sequences, docs = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append(r)
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at and n > 0
            at += n
        assert at == 4096 or at & (at - 1) == 0
    for i, text in texts:
        ids, at = ids_of(text or ""), 0
        for r in sorted(docs[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens * 4 == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[4 * at:4 * (at + r.length)])
            at += r.length
        assert 4 * at == len(ids)


def test_packing(spark, edge, small):
    check_packed(queries.op6_packing(spark, SMALL).collect(), small)
    once = {i: t for i, t in EDGE}
    unique = edge.dropDuplicates(["doc_id"])
    rows = packing.pack(unique, WORDS, with_ids=True).collect()
    check_packed(rows, once.items())
    assert all(len(r.ids) == r.length for r in rows)
    assert packing.pack(edge.limit(0), WORDS).count() == 0


def test_packing_rounds(monkeypatch):
    monkeypatch.setattr(packing, "ROUND", 10_000)
    rng, packer, rows = random.Random(1), packing.Packer(0), []
    sizes = [rng.choice([1, 5, 300, 4096, 9000]) for _ in range(200)]
    for i, n in enumerate(sizes):
        rows += packer.add(i, np.arange(n, dtype="<u4").tobytes())
    rows += packer.pack(last=True)
    covered = collections.Counter()
    for r in rows:
        covered[r[0]] += r[2]
    assert covered == collections.Counter(dict(enumerate(sizes)))
    lengths = collections.Counter()
    for r in rows:
        lengths[r[5]] += r[2]
    assert all(n & (n - 1) == 0 for n in lengths.values()) and sum(n != 4096 for n in lengths.values()) <= 12


def test_word_ids_equal_the_tokenizer(small):
    ids_of, tok = packing.WordIds(WORDS), Tokenizer.from_str(WORDS)
    for text in [t for _, t in small] + [t or "" for _, t in EDGE] + ["A\x1cb\x85c\xa0d e", "é ́a I'LL"]:
        want = tok.encode(text, add_special_tokens=False).ids + [2]
        assert np.frombuffer(ids_of(text), "<u4").tolist() == want


def test_word_ids_remember_a_word_once():
    """Words and stems share one table, and all forms of a word its stem."""
    ids_of, tok = packing.WordIds(WORDS), Tokenizer.from_str(WORDS)
    words = [f"wo{chr(97 + i % 26)}{chr(97 + i // 26)}rd" for i in range(400)]
    ids_of(" ".join(words))
    tables = [t for t in vars(ids_of).values() if isinstance(t, bpe.Remembered)]
    assert sum(len(t.new) + len(t.old) for t in tables) == len(words)
    for w in words[:40]:
        text = f"{w}, {w.title()} {w.upper()}. {w}.. {w}<|x. {w.title()}, é{w}. {w}1."
        assert np.frombuffer(ids_of(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids + [2]


def test_arrow_memory_goes_back_after_a_task(monkeypatch):
    done = []
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: types.SimpleNamespace(release_unused=lambda: done.append(1)))
    run = common.handing_back(lambda batches: (2 * b for b in batches))
    rows = run(iter([1, 2]))
    assert next(rows) == 2 and not done
    assert list(rows) == [4] and done == [1]


def test_secrets(spark, edge, small):
    for docs, rows in ((secret_scan.scan(edge), EDGE), (queries.op7_secret_scan(spark, SMALL), small)):
        texts = dict(rows)
        for r in docs.collect():
            assert ([r.n_assign, r.n_access, r.n_hex], r.base_sha256) == brute.secrets(texts[r.doc_id])
    assert secret_scan.scan(edge.limit(0)).count() == 0


def test_random_tokens_are_found(spark):
    rng = random.Random(4)
    alphabet = secret_scan.ALPHABETS["alnum"]
    keys = ["".join(rng.choice(alphabet) for _ in range(40)) for _ in range(20)]
    words = ["Donaudampfschifffahrtsgesellschaft", "a-very-long-slug-of-plain-words", "/usr/local/share/doc/package", "SomeCamelCaseIdentifierName"]
    docs = spark.createDataFrame([(i, f"see {k} here") for i, k in enumerate(keys)] + [(100 + i, w) for i, w in enumerate(words * 20)],
                                 "doc_id bigint, text string")
    got = {r.doc_id: r for r in secret_scan.scan(docs).collect()}
    assert sum(got[i].spans == "random:4:44" for i in range(20)) >= 18
    assert all(got[i].spans == "" for i in got if i >= 100)


@pytest.mark.parametrize("name", ["base32", "base32_lower", "lower_digits", "upper_digits", "alnum"])
@pytest.mark.parametrize("size", [32, 64, 128])
def test_random_tokens_of_every_alphabet(name, size):
    rng = random.Random(size)
    tokens = ["".join(rng.choices(secret_scan.ALPHABETS[name], k=size)) for _ in range(300)]
    assert sum(secret_scan.natural_p(t) < 1.0 for t in tokens) >= 294


def test_single_case_keys_are_found(spark):
    rng = random.Random(6)
    keys = ["".join(rng.choices(a + "0123456789", k=n)) for a in ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
            for n in (32, 64, 128) for _ in range(10)]
    words = ["international_communication", "thequickbrownfoxjumpsoverthelazydog2024", "WWW_EXAMPLE_COM_INDEX_HTML"]
    rows = [(i, f"key {t} end") for i, t in enumerate(keys)] + [(100 + i, f"key {w} end") for i, w in enumerate(words)]
    got = {r.doc_id: r.spans for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert sum(got[i] == f"random:4:{4 + len(t)}" for i, t in enumerate(keys)) >= 58
    assert not any(got[100 + i] for i in range(len(words)))


def test_bpe_round_trip(spark, edge, small):
    tok = Tokenizer.from_str(BYTES)

    def want(text):
        ids = tok.encode(text or "", add_special_tokens=False).ids
        return len(ids), brute.sha(",".join(map(str, ids))), brute.sha(tok.decode(ids, skip_special_tokens=False))

    for found, rows in ((bpe.round_trip(edge, BYTES), EDGE), (queries.op9_bpe(spark, SMALL), small)):
        texts = dict(rows)
        for r in found.collect():
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want(texts[r.doc_id])
    coded = bpe.encode(edge, BYTES)
    assert {r.doc_id: r.text for r in bpe.decode(coded, BYTES).collect()} == {i: t or "" for i, t in EDGE}
    assert bpe.round_trip(edge.limit(0), BYTES).count() == 0


def test_bpe_long_words_merge_alike():
    coder, rng = bpe.ByteBpe(BYTES), random.Random(2)
    for _ in range(40):
        parts = [coder.first[rng.choice(b"abcdehlo the")] for _ in range(300)]
        assert coder._merge_short(list(parts)) == coder._merge_long(list(parts))


def test_word_hashes_and_shingles():
    words, at = hashing.word_hashes([b"a b  a", b"", b"b", b" \n"])
    assert at.tolist() == [0, 3, 3, 4, 4] and words[0] == words[2] and words[1] == words[3] and words[0] != words[1]
    assert len(hashing.shingles(words[:3], 2)) == 2 and len(hashing.shingles(words[:1], 2)) == 1


def test_register_estimate():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    for shared in (200, 600, 900):
        a, b = pool[:1000], np.concatenate((pool[:shared], pool[1000:2000 - shared]))
        x, y = near_dedup.registers(a), near_dedup.registers(b)
        got = near_dedup.estimate(np.array([(x > y).sum()]), np.array([(x < y).sum()]), np.array([1000.0]), np.array([1000.0]))[0]
        assert abs(got - shared / (2000 - shared)) < 0.12
        both = near_dedup.registers(np.concatenate((a, b)))
        assert (both == np.maximum(x, y)).all()


@pytest.mark.parametrize("size", [2, 5])
def test_near_dedup_tables(spark, small, size):
    docs = spark.createDataFrame(small, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_dedup(docs, size).collect()}
    assert got == {i: want for (i, _), want in zip(small, brute.near(small, size, 80))}


def test_near_dedup_edges(spark, edge):
    rows = sorted({(i, t) for i, t in EDGE}, key=lambda r: r[0])
    want = {i: w for (i, _), w in zip(rows, brute.near(rows, 2, 80))}
    got = near_dedup.near_dedup(edge, 2).collect()
    assert len(got) == len(EDGE)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert near_dedup.drop_near_duplicates(edge).columns == edge.columns
    assert near_dedup.near_dedup(edge.limit(0), 2).count() == 0


def test_near_dedup_chains_and_large_groups(spark):
    """A chain of near copies, a large group of them, and unrelated texts."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, text = [], [word() for _ in range(100)]
    for i in range(12):
        rows.append((100 + i, " ".join(text)))
        text = text[3:] + [word() for _ in range(3)]
    base = [word() for _ in range(120)]
    for i in range(150):
        own = list(base)
        for _ in range(rng.randrange(6)):
            own[rng.randrange(120)] = word()
        rows.append((1000 + i, " ".join(own)))
    rows += [(5000 + i, " ".join(word() for _ in range(30))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_dedup(docs, 2).collect()}
    assert got == {i: w[1] for (i, _), w in zip(rows, brute.near(rows, 2, 80))}
