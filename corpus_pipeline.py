"""Corpus pipeline: raw documents to packed training sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, the documents it keeps or, from the last one, the
pieces of packed sequences. ``run`` applies them to ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm import exact_dedup, near_dedup, packing, pii, quality_classifier
from visitlens.llm.common import cut_lineage, table
from visitlens.llm.queries import tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Null text is scored as empty; very long texts are scored whole; equal texts
    get equal scores, so repeated rows stay or go together; a null id is not
    learned from, but scored. Without labels every score is 0.5 and all stay. An
    empty table stays empty; all columns, whatever their names, are carried.
    """
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.accepted(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white space.

    The longest text stays, of equally long ones the smallest id (a null id comes
    last); of rows that are equal in both, one. Null, empty and blank texts are
    one group. Very long texts are compared whole; an empty table stays empty;
    columns are carried.
    """
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at 0.8 on five-word shingles.

    The smallest id of a group stays. Texts without a word (null ones too) and
    rows with a null id are linked with nothing and stay; repeated rows share an
    id and stay together. Very long texts are compared on whole sets; an empty
    table stays empty; columns are carried.
    """
    return near_dedup.drop_near_duplicates(docs, size=5, percent=80)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by placeholders; ``n_chars`` follows the text.

    Null text stays null with a null ``n_chars``; an empty one is not changed; very
    long texts are read whole; repeated rows are changed alike; an empty table stays
    empty. The other columns, whatever their names, are carried.
    """
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(clean.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens, with their ids.

    Null and empty texts are one token, the end; a very long text is cut over
    several sequences; repeated rows are packed each; ties in length keep their
    order; an empty table gives no piece. Only the id and the text are read.
    """
    return packing.pack(docs, tokenizer("word_bpe_49k.json"), with_ids=True)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("private", private), ("packed", packed)]
#: No SQL expresses the classifier, the sketches or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
