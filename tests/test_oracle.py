"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import check  # noqa: E402
from visitlens.plans import catalog  # noqa: E402

from paths import SF_SMALL  # noqa: E402


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.oracle_queries())
    assert set(catalog.QUERIES) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "visit_rank" in df.columns


def test_queries_match_oracle(spark):
    res = check(spark, SF_SMALL, list(catalog.QUERIES))
    bad = {k: m for k, (ok, m) in res.items() if not ok}
    assert not bad, bad


def test_column_types_match_oracle(spark):
    import duckdb

    from visitlens.sources.tables import STAR_TABLES
    con = duckdb.connect()
    for t in STAR_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    names = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
             "date": "DATE", "boolean": "BOOLEAN"}
    osql = E.oracle_sql()
    for name, fn in catalog.QUERIES.items():
        s = {f.name: names.get(f.dataType.simpleString(), f.dataType.simpleString())
             for f in fn(spark, SF_SMALL).schema.fields}
        rel = con.sql(osql[name])
        d = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        assert s == d, name
