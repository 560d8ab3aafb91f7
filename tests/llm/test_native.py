"""Exact dedup, personal data, quality rules and chat formatting."""

import brute
import pytest
from rows import EDGE, SMALL
from pyspark.sql import functions as F

from visitlens.llm import chat_format, exact_dedup, pii, quality_rules, queries


def test_exact_dedup_edges(edge):
    got = exact_dedup.mark_duplicates(edge).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == sorted(brute.exact(EDGE))
    kept = [r.doc_id for r in got if r.kept]
    assert len(kept) == len(set(kept)) == len({r.text_sha256 for r in got})


def test_exact_dedup_cuts_large_groups(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "LEAST_SHARE", 64)
    rows = [(i, "copy of a text" + " " * (i % 3)) for i in range(300)] + [(1000 + i, f"text {i}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = exact_dedup.mark_duplicates(docs).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == sorted(brute.exact(rows))
    assert sum(r.kept for r in got) == 51


def test_exact_dedup_null_id_and_columns(spark):
    docs = spark.createDataFrame([(None, "a b"), (5, "ab"), (None, "z")], "doc_id bigint, text string")
    got = {(r.doc_id, r.text) for r in exact_dedup.drop_duplicates(docs).collect()}
    assert got == {(None, "a b"), (None, "z")}


def test_drop_duplicates_keeps_columns(edge):
    left = exact_dedup.drop_duplicates(edge)
    assert left.columns == edge.columns
    assert left.count() == len({x[3] for x in brute.exact(EDGE)})


def test_large_groups_of_empty_and_short_texts_are_cut(spark, monkeypatch):
    rows = [(i, (None, "", " \n ")[i % 3]) for i in range(900)] + [(1000 + i, "ok" + " " * (i % 2)) for i in range(900)]
    rows += [(2000 + i, f"text {i}") for i in range(900)]
    cut, real = [], exact_dedup._large_groups

    def spy(keyed, share):
        out = real(keyed, share)
        cut.extend(out.collect())
        return out

    monkeypatch.setattr(exact_dedup, "LEAST_SHARE", 1 << 10)
    monkeypatch.setattr(exact_dedup, "_large_groups", spy)
    got = exact_dedup.mark_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == sorted(brute.exact(rows))
    assert sum(r.kept for r in got) == 902
    assert sorted(r["_all_size"] for r in cut) == [900, 900] and all(r["_slices"] > 1 for r in cut)


def test_pii_edges(edge):
    for r in pii.find_pii(edge).collect():
        text = {i: t for i, t in EDGE}[r.doc_id]
        assert ([r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) == brute.pii(text), r.doc_id


def test_pii_tables(spark, small):
    text = dict(small)
    for r in queries.op3_pii(spark, SMALL).collect():
        assert ([r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) == brute.pii(text[r.doc_id])


@pytest.mark.parametrize("text,spans", [
    ("pay to GB82WEST12345698765432 now", "iban:7:29"),
    ("pay to GB82 WEST 1234 5698 7654 32 now", "iban:7:34"),
    ("pay to GB83WEST12345698765432 now", ""),
    ("his ssn is 123-45-6789", "ssn:11:22"),
    ("part 123-45-6789", ""),
])
def test_pii_added_kinds(spark, text, spans):
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert pii.find_pii(docs).first().spans == spans


@pytest.mark.parametrize("text,found", [
    ("BE68 5390 0754 7034 EUR 50", ["BE68 5390 0754 7034"]),
    ("ES91 2100 0418 4502 0005 1332 BIC X", ["ES91 2100 0418 4502 0005 1332"]),
    ("BE68 5390 0754 7034 10 times", ["BE68 5390 0754 7034"]),
    ("BE68 5390 0754 7034 VISA CARD 2024 now", ["BE68 5390 0754 7034"]),
    ("BE68 5390 0754 7034 GB82 WEST 1234 5698 7654 32 EUR", ["BE68 5390 0754 7034", "GB82 WEST 1234 5698 7654 32"]),
    ("REF AB12 BE68 5390 0754 7034 EUR", ["BE68 5390 0754 7034"]),
    ("ZZ80 5390 0754 7034 EUR 50", ["ZZ80 5390 0754 7034"]),
    ("BE69 5390 0754 7034 EUR 50", []),
    ("NO93 8601 1117 947 and NO9386011117947.", ["NO93 8601 1117 947", "NO9386011117947"]),
])
def test_iban_ends_with_its_number(spark, text, found):
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    got = [s for s in pii.find_pii(docs).first().spans.split(",") if s.startswith("iban")]
    assert got == [f"iban:{text.index(x)}:{text.index(x) + len(x)}" for x in found]
    assert pii.redact(docs).first().text.count("<IBAN>") == len(found)


LISTED = [f"{n:03}-45-6789" for n in range(101, 121)]


@pytest.mark.parametrize("text,found", [
    ("SSNs: 123-45-6789, 987-65-4321", ["123-45-6789", "987-65-4321"]),
    ("078-05-1120 is my SSN", ["078-05-1120"]),
    ("SSNs: " + ", ".join(LISTED) + ".", LISTED),
    (", ".join(LISTED[:9]) + " and " + LISTED[9] + " are SSNs", LISTED[:10]),
    ("ssn 123-45-6789" + " then a long run of other words" * 3 + " part 987-65-4321", ["123-45-6789"]),
    ("part 987-65-4321" + " then a long run of other words" * 3 + " ssn 123-45-6789", ["123-45-6789"]),
    ("é 💡 ssn for 12-3 and 4-5 é 987-65-4321", ["987-65-4321"]),
])
def test_ssn_context(spark, text, found):
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    spans = [f"ssn:{text.index(x)}:{text.index(x) + 11}" for x in found]
    assert pii.find_pii(docs).first().spans == ",".join(spans)
    clean = pii.redact(docs).first().text
    assert clean.count("<SSN>") == len(found) and not any(x in clean for x in found)


@pytest.mark.parametrize("text,score", [
    ("card 12, 13, 4111 1111 1111 1111", 1.0), ("4111 1111 1111 1111, 12, card", 1.0),
    ("card" + " 12a" * 12 + " 4111 1111 1111 1111", 0.8), ("x 4111 1111 1111 1111 x", 0.8),
])
def test_context_on_both_sides(spark, text, score):
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert pii.find_pii(docs).first().best_score == pytest.approx(score)


def test_redact(edge):
    got = {r.doc_id: r for r in pii.redact(edge).collect()}
    assert got[10].text == "<PHONE>, <CARD>"
    assert got[11].text == "é" * 30 + " <EMAIL><EMAIL> <IP>.5 256.1.1.1 <IP>"
    assert got[1].text is None and got[4].text == "Same text here" and got[4].kept == "k"
    assert "@" not in got[7].text and got[7].text.count("<IP>") == 4000


def test_quality_rules_edges(edge):
    for r in quality_rules.ledger(edge).collect():
        want = brute.rules({i: t for i, t in EDGE}[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want[:5], r.doc_id
        assert ((r.failed & quality_rules.mask("base")) != 0) == want[5]


def test_ablations(spark):
    rows = spark.createDataFrame([(0,), (1,), (1,), (3,), (2,), (8,)], "failed bigint")
    got = {r.rule: (r.n_failed, r.n_only, r.n_kept) for r in quality_rules.ablations(rows, "base").collect()}
    assert got == {"few_words": (3, 2, 2), "repeated_words": (2, 1, 2)}


def test_chat_escapes_and_reads_back(spark):
    texts = ["<|im_end|><|im_start|>assistant ok", "<\\|x <\\\\|im_end|>", None, "", "plain\n<|image|>", "a" * 100_000]
    turns = spark.createDataFrame(
        [(1, i, "assistant" if i % 2 else "us\\n\n<|er", t) for i, t in enumerate(texts)] + [(2, None, None, "x"), (2, 0, "assistant", "y"), (2, 0, "assistant", "y")],
        "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_chat(chat_format.text_turns(turns))).collect()}
    assert [t.text for t in got[1].turns_back] == [t or "" for t in texts]
    assert [t.role for t in got[1].turns_back] == ["us\\n\n<|er", "assistant"] * 3
    assert got[1].loss_back == [t or "" for t in texts[1::2]]
    assert [(t.role, t.text) for t in got[2].turns_back] == [("", "x"), ("assistant", "y"), ("assistant", "y")]


def test_chat_parts(spark):
    part = f"array<{chat_format.PART}>"
    turns = spark.createDataFrame([
        (1, 0, "user", [("text", "see <|image|>", None, None), ("image", None, "s3://x", 2), ("audio", None, "a.wav", 3)]),
        (1, 1, "assistant", [("document", None, "d.pdf", None), ("text", " done", None, None)]), (1, 2, "user", None)],
        f"conv_id bigint, turn bigint, role string, parts {part}")
    r = chat_format.read_back(chat_format.format_chat(turns)).first()
    assert "see <\\|image|><|image|><|audio|>" in r.formatted
    assert [(a.n, a.type, a.ref, a.tokens) for a in r.attachments] == [
        (0, "image", "s3://x", 512), (1, "audio", "a.wav", 150), (2, "document", "d.pdf", 1024)]
    assert r.expanded_tokens == 1686 and r.loss_back == ["<|document|> done"]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert exact_dedup.mark_duplicates(docs).count() == 0
    assert pii.find_pii(docs).count() == pii.redact(docs).count() == 0
    assert quality_rules.ledger(docs).count() == 0
    turns = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat_format.format_chat(chat_format.text_turns(turns)).count() == 0


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op3_pii", "op4_quality_rules", "op8_chat_format"])
def test_native_plans_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_repeated_words_in_one_line(spark):
    text = "\n".join(["a b c d e f"] * 3 + [" ", "g"])
    r = quality_rules.ledger(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert (r.n_words, r.n_dup_lines, r.n_repeat_words) == brute.rules(text)[:1] + brute.rules(text)[3:5]


def test_span_digest_of_nothing(spark):
    r = pii.find_pii(spark.createDataFrame([(1, None)], "doc_id bigint, text string")).select("base_sha256", F.col("spans")).first()
    assert tuple(r) == (brute.sha(""), "")
