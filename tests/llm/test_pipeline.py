"""The corpus pipeline, stage by stage, and the registered queries."""

import brute
import corpus_pipeline as pipeline
import pytest
from rows import SMALL

import __spark_entry__ as entry


def test_stages(spark):
    docs = pipeline.table(spark, SMALL, "documents")
    columns, labels = docs.columns, {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    stage = dict(pipeline.STAGES)
    good = pipeline.cut_lineage(stage["quality"](spark, docs, SMALL))
    left = {r.doc_id for r in good.collect()}
    assert sum(v == 1 and k not in left for k, v in labels.items()) <= 2
    assert sum(v == 0 and k in left for k, v in labels.items()) <= 2
    one = pipeline.cut_lineage(stage["exact"](spark, good, SMALL))
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert {r.doc_id for r in one.collect()} == {x[1] for x in brute.exact(rows)}
    apart = pipeline.cut_lineage(stage["near"](spark, one, SMALL))
    rows = sorted((r.doc_id, r.text) for r in one.collect())
    assert {r.doc_id for r in apart.collect()} == {c for _, c in brute.near(rows, 5, 80)} | {i for i, t in rows if not t.split()}
    clean = pipeline.cut_lineage(stage["private"](spark, apart, SMALL))
    for r in clean.collect():
        assert brute.pii(r.text)[0] == [0, 0, 0, 0] and r.n_chars == len(r.text)
    assert all(d.columns == columns for d in (good, one, apart, clean))
    packed = stage["packed"](spark, clean, SMALL)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in clean.collect()}


def test_stages_on_edge_rows(spark, edge):
    """Nulls, blank and very long texts, repeated rows and clashing columns through all stages."""
    docs = edge.unionByName(edge.limit(0).union(edge.sparkSession.createDataFrame(
        [(None, "no id at all", None, None, None, None, None, None, None, None, None, None, None),
         (99, None, None, None, None, 1, "k", "s", "i", "n", "c", "m", "st")], edge.schema)))
    stage = dict(pipeline.STAGES)
    kept = docs
    for name in ("exact", "near", "private"):
        before = sorted((repr(r.doc_id), repr(r.text)) for r in kept.collect())
        kept = pipeline.cut_lineage(stage[name](spark, kept, SMALL))
        assert kept.columns == docs.columns
        assert {i for i, _ in ((repr(r.doc_id), 0) for r in kept.collect())} <= {i for i, _ in before}
    rows = {r.doc_id: r for r in kept.collect()}
    assert None in rows and rows[None].text == "no id at all"
    assert {4, 5, 6} & rows.keys() == {4}  # 6 equals it without white space, 5 but for a capital
    assert {1, 2, 3, 99} & rows.keys() == {3}  # blank texts are one group
    assert len(rows[7].text) > 50_000 and "a.b@c.de" not in rows[7].text
    packed = stage["packed"](spark, kept, SMALL).collect()
    assert {r.doc_id for r in packed} == set(rows) and max(r.length for r in packed) <= 4096
    scored = stage["quality"](spark, docs, SMALL)
    assert scored.columns == docs.columns and scored.count() <= docs.count()


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_stages_on_an_empty_table(spark, name):
    docs = pipeline.table(spark, SMALL, "documents").limit(0)
    out = dict(pipeline.STAGES)[name](spark, docs, SMALL)
    assert out.count() == 0 and (name == "packed" or out.columns == docs.columns)


def test_queries_are_registered():
    names = entry.queries()
    assert "pipeline" in names and sum(n.startswith("op") and n[2].isdigit() for n in names) == 13
    assert set(entry.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op4_quality_rules", "op8_chat_format", "op10_minhash_near_dedup", "op11_source_divergence",
                                  "op12_fill_in_middle", "op13_decontamination"])
def test_oracles(spark, name):
    from oracle_check import check

    ok, message = check(spark, SMALL, [name])[name]
    assert ok, message
