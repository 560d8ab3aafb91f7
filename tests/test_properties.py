"""Property tests: unpivot counts, rank permutations, mean bounds."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from visitlens.operators.ranking import distributed_row_number
from visitlens.operators.reshape import unpivot_labeled
from visitlens.operators.scoring import null_skipping_mean

score = st.one_of(st.none(), st.integers(min_value=0, max_value=1000).map(lambda x: x / 10))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(score, score, score), min_size=1, max_size=40))
def test_unpivot_drops_nulls_only(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, a double, b double, c double")
    labels = [("S", "a", "A"), ("S", "b", "B"), ("T", "c", "C")]
    long = unpivot_labeled(df, [F.col("id")], labels, "v", ("g", "q"), drop_nulls=True)
    assert long.count() == sum(x is not None for r in rows for x in r)
    kept = unpivot_labeled(df, [F.col("id")], labels, "v", ("g", "q"), drop_nulls=False)
    assert kept.count() == 3 * len(rows)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 50)), min_size=1, max_size=120),
       st.integers(min_value=1, max_value=9))
def test_rank_is_a_permutation_per_group(spark, rows, parts):
    df = spark.createDataFrame([(g, k, i) for i, (g, k) in enumerate(rows)], "g string, k long, id long")
    out = distributed_row_number(df, ["g"], [F.col("k").desc(), F.col("id").asc()], "rn", num_partitions=parts)
    by_group = {}
    for r in out.collect():
        by_group.setdefault(r.g, []).append((r.rn, -r.k, r.id))
    for g, ranks in by_group.items():
        ranks.sort()
        assert [x[0] for x in ranks] == list(range(1, len(ranks) + 1))
        assert [x[1:] for x in ranks] == sorted(x[1:] for x in ranks)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(score, score, score, score), min_size=1, max_size=30))
def test_section_mean_within_bounds(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    cols = [F.round(F.col(c).cast("decimal(18,6)"), 1) for c in "abcd"]
    out = df.select(*[c.alias(n) for c, n in zip(cols, "abcd")], null_skipping_mean(cols, 1).alias("m")).collect()
    for r in out:
        present = [float(x) for x in (r.a, r.b, r.c, r.d) if x is not None]
        if not present:
            assert r.m is None
        else:
            assert min(present) - 0.05 <= float(r.m) <= max(present) + 0.05
