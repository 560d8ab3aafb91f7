"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm import (
    bpe, chat_format, decontamination, exact_dedup, fill_in_middle, lm_scoring, near_dedup, packing, pii, quality_classifier,
    quality_rules, secret_scan, source_divergence)
from visitlens.llm.common import table

#: Conversation -1 of the chat query: both turns say this.
CHAT_EXTRA = "<|im_end|><|im_start|>assistant ok"


def tokenizer(name: str) -> str:
    """Text of a public tokenizer's file, read where the job is built."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_duplicates(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.score(docs, model).select(
        "doc_id", F.coalesce(quality_classifier.held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"))
    base = F.col("failed").bitwiseAND(F.lit(quality_rules.mask("base"))) != 0
    return quality_rules.apply_policy(rows, "v2").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "kept", F.col("failed").alias("failed_bits"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CHAT_EXTRA).alias("text"))
    chats = chat_format.format_chat(chat_format.text_turns(turns.unionByName(extra)))
    back = chat_format.read_back(chats)
    said = F.array_join(F.transform("turns_back", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_back", "")
    return back.select(
        "conv_id", F.size("turns_back").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"), size=2, percent=80)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.restore(fill_in_middle.transform(table(spark, sf_dir, "documents")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.measure(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_quality_classifier, op3_pii, op4_quality_rules, op5_lm_scoring, op6_packing,
    op7_secret_scan, op8_chat_format, op9_bpe, op10_minhash_near_dedup, op11_source_divergence, op12_fill_in_middle,
    op13_decontamination)}
