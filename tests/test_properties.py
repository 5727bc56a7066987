"""Property tests on random inputs (Hypothesis): results against plain-Python brute force."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recengine.operators import clean, similarity, topk

SETTINGS = settings(max_examples=12, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_gv = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 30)), min_size=0, max_size=40)


@SETTINGS
@given(rows=rows_gv, k=st.integers(1, 4))
def test_top_k_matches_sorting(spark, rows, k):
    data = [(g, v, i) for i, (g, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "g int, v int, id int")
    got = sorted((r.g, r.id, r.rn) for r in
                 topk.top_k_per_group(df, ["g"], [F.col("v").desc()], k, ties=["id"]).collect())
    want = []
    for g in {d[0] for d in data}:
        grp = sorted((d for d in data if d[0] == g), key=lambda d: (-d[1], d[2]))[:k]
        want += [(g, d[2], n) for n, d in enumerate(grp, 1)]
    assert got == sorted(want)


@SETTINGS
@given(vals=st.lists(st.integers(-5, 5), min_size=0, max_size=60), parts=st.integers(1, 9))
def test_row_ids_follow_order(spark, vals, parts):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "m int, k int")
    out = clean.assign_row_ids(df, ["m", "k"], num_partitions=parts).collect()
    got = [(r.m, r.k) for r in sorted(out, key=lambda r: r.id)]
    assert [r.id for r in sorted(out, key=lambda r: r.id)] == list(range(1, len(vals) + 1))
    assert got == sorted((v, i) for i, v in enumerate(vals))


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 6), st.integers(0, 8), st.integers(1, 9)),
                     min_size=0, max_size=50),
       hot_rows=st.sampled_from([2, 10_000]))
def test_cosine_bag_semantics(spark, rows, hot_rows):
    """Duplicates allowed: every row takes part, as a self-join of the rows would do."""
    r = spark.createDataFrame(rows, "user_id bigint, item_id bigint, x bigint")
    got = {(x.item_id, x.item_v): x.cos
           for x in similarity.cosine_neighbors(r, k=100, hot_rows=hot_rows).collect()}
    norms, dots = {}, {}
    for u, i, x in rows:
        norms[i] = norms.get(i, 0) + x * x
    for u1, i1, x1 in rows:
        for u2, i2, x2 in rows:
            if u1 == u2 and i1 != i2:
                dots[(i1, i2)] = dots.get((i1, i2), 0) + x1 * x2
    want = {p: d / (math.sqrt(norms[p[0]]) * math.sqrt(norms[p[1]])) for p, d in dots.items()}
    assert got.keys() == want.keys()
    assert all(got[p] == want[p] for p in want)
