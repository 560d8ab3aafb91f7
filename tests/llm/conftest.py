import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rows import EDGE, SMALL  # noqa: E402


@pytest.fixture(scope="session")
def edge(spark):
    """Edge rows with extra columns whose names clash with the operators' own."""
    extra = "keep_id bigint, kept string, score string, id string, n string, c0 string, _norm string, start string"
    rows = [(i, t, "en", "s", len(t or ""), 1, "k", "s", "i", "n", "c", "m", "st") for i, t in EDGE]
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}").repartition(3)


@pytest.fixture(scope="session")
def small(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return [(r["doc_id"], r["text"]) for r in rows]
