"""Hand-made and property checks: ratings, cosine neighbours, recommenders, errors, ALS."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recengine.operators import als, evaluate, ratings, recommend, similarity


def _brute_cosine(rows, k):
    """rows: (by, entity, x). Top-k by (cos desc, neighbour asc) per entity."""
    by_key, norms = {}, {}
    for b, e, x in rows:
        by_key.setdefault(b, []).append((e, x))
        norms[e] = norms.get(e, 0) + x * x
    dots = {}
    for items in by_key.values():
        for (e1, x1), (e2, x2) in itertools.product(items, items):
            if e1 != e2:
                dots[(e1, e2)] = dots.get((e1, e2), 0) + x1 * x2
    per = {}
    for (a, b), d in dots.items():
        per.setdefault(a, []).append((-(d / (math.sqrt(norms[a]) * math.sqrt(norms[b]))), b))
    out = {}
    for a, lst in per.items():
        out[a] = [(b, -c) for c, b in sorted(lst)[:k]]
    return out


def _random_ratings(seed, users=40, items=30, hot_user=True):
    rnd = random.Random(seed)
    rows = set()
    for u in range(users):
        for i in rnd.sample(range(items), rnd.randint(1, 6)):
            rows.add((u, i))
    if hot_user:  # one user holding every item
        rows |= {(999, i) for i in range(items)}
    return [(u, i, rnd.randint(100, 450)) for u, i in sorted(rows)]


@pytest.mark.parametrize("hot_rows", [10_000, 3])
def test_cosine_matches_brute_force(spark, hot_rows):
    rows = _random_ratings(1)
    r = spark.createDataFrame(rows, "user_id bigint, item_id bigint, x bigint")
    nb = similarity.cosine_neighbors(r, entity="item_id", by="user_id", value="x", k=5, hot_rows=hot_rows)
    got = {}
    for row in nb.orderBy("item_id", "rank").collect():
        got.setdefault(row.item_id, []).append((row.item_v, row.cos))
    want = _brute_cosine(rows, 5)
    assert set(got) == set(want)
    for e in want:
        assert [b for b, _ in got[e]] == [b for b, _ in want[e]]
        assert np.allclose([c for _, c in got[e]], [c for _, c in want[e]], rtol=0, atol=1e-15)


def test_hot_split_plan_and_equal_results(spark):
    rows = _random_ratings(2)
    r = spark.createDataFrame(rows, "user_id bigint, item_id bigint, x bigint")
    hot = similarity.hot_key_blocks(r.select(F.col("user_id").alias("_by")), "_by", hot_rows=4)
    assert {(x._by, x._s) for x in hot.collect() if x._by == 999} == {(999, 8)}
    a = similarity.cosine_neighbors(r, k=12, hot_rows=4).collect()
    b = similarity.cosine_neighbors(r, k=12).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_cosine_symmetric_and_bounded(spark):
    rows = _random_ratings(3, hot_user=False)
    r = spark.createDataFrame(rows, "user_id bigint, item_id bigint, x bigint")
    nb = similarity.cosine_neighbors(r, k=1000).collect()
    cos = {(x.item_id, x.item_v): x.cos for x in nb}
    assert all(0.0 <= c <= 1.0 + 1e-12 for c in cos.values())
    assert all(cos[(b, a)] == c for (a, b), c in cos.items())


def test_cosine_partition_independent(spark):
    rows = _random_ratings(4)
    r = spark.createDataFrame(rows, "user_id bigint, item_id bigint, x bigint")
    results = [sorted(map(tuple, similarity.cosine_neighbors(r.repartition(p), k=4).collect()))
               for p in (1, 7, 50)]
    assert results[0] == results[1] == results[2]


def _ratings_df(spark, rows):
    """Ratings in steps of 1/100 (unit=100 where a function needs whole parts)."""
    return spark.createDataFrame([(u, i, x / 100.0, x) for u, i, x in rows],
                                 "user_id bigint, item_id bigint, rating double, x bigint")


def test_item_cf_excludes_taken_and_caps(spark):
    rows = _random_ratings(5)
    r = _ratings_df(spark, rows)
    out = recommend.item_cf_recommend(r, k_neighbors=5, n=3).collect()
    taken = {(u, i) for u, i, _ in rows}
    assert out and all((x.user_id, x.course_id) not in taken for x in out)
    per_user = {}
    for x in out:
        per_user.setdefault(x.user_id, []).append(x.ranking)
    assert all(sorted(v) == list(range(1, len(v) + 1)) and len(v) <= 3 for v in per_user.values())


def test_item_cf_scores_brute_force(spark):
    rows = _random_ratings(6, hot_user=False)
    r = _ratings_df(spark, rows)
    nbrs = _brute_cosine(rows, 4)
    taken = {}
    for u, i, x in rows:
        taken.setdefault(u, {})[i] = x / 100.0
    want = {}
    for u, its in taken.items():
        sc = {}
        for i, rv in its.items():
            for j, c in nbrs.get(i, []):
                if j not in its:
                    sc[j] = sc.get(j, 0.0) + c * rv
        best = sorted(sc.items(), key=lambda t: (-round(t[1], 9), t[0]))[:3]
        want.update({(u, j): rank for rank, (j, _) in enumerate(best, 1)})
    got = {(x.user_id, x.course_id): x.ranking
           for x in recommend.item_cf_recommend(r, k_neighbors=4, n=3).collect()}
    assert got == want


def test_user_cf_scores_brute_force(spark):
    rows = _random_ratings(7, hot_user=False)
    r = _ratings_df(spark, rows)
    trunc = [(i, u, x // 100) for u, i, x in rows]   # by item, entity user
    nbrs = _brute_cosine(trunc, 4)
    held = {}
    for u, i, x in rows:
        held.setdefault(u, {})[i] = x / 100.0
    want = {}
    for u in held:
        acc = {}
        for v, c in nbrs.get(u, []):
            for j, rv in held[v].items():
                if j not in held[u]:
                    acc.setdefault(j, []).append(c * rv)
        best = sorted(((j, sum(s) / len(s)) for j, s in acc.items()),
                      key=lambda t: (-round(t[1], 9), t[0]))[:3]
        want.update({(u, j): rank for rank, (j, _) in enumerate(best, 1)})
    got = {(x.user_id, x.course_id): x.ranking
           for x in recommend.user_cf_recommend(r, k_neighbors=4, n=3, unit=100).collect()}
    assert got == want


def test_composite_rating_defaults_and_missing_dims(spark):
    facts = spark.createDataFrame([(1, 10, 3), (1, 11, None), (2, 99, 5)],
                                  "student_id bigint, course_id bigint, rating int")
    items = spark.createDataFrame([(10, "A", "s", "L1", 0.7), (11, "B", "s", "L2", 0.0)],
                                  "id bigint, type string, school string, labels string, grading double")
    users = spark.createDataFrame([(1, "A,C", "s", "L2")],
                                  "id bigint, course_type string, school_names string, labels string")
    got = {(r.user_id, r.item_id): (r.rating, r.x)
           for r in ratings.composite_rating(facts, items, users).collect()}
    assert got[(1, 10)] == (2.31, 23100)   # 1 + 0.6 + 0.21 + 0.5 (type) + 0 (labels)
    assert got[(1, 11)] == (2.3, 23000)    # 1 + 0.8 + 0 + 0 + 0.5 (labels)
    assert got[(2, 99)] == (2.9, 29000)    # missing item and user: 1 + 1.0 + 0.9


def test_rmse_matches_evaluator_and_skips_nulls(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 5.0)], "rating double, prediction double")
    ours = evaluate.rmse(df).first()
    ref = RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction").evaluate(df)
    assert ours.n == 2 and abs(ours.rmse - ref) < 1e-12 and abs(ref - 1.5811388) < 1e-6
    with_null = df.union(spark.createDataFrame([(1.0, None)], "rating double, prediction double"))
    assert evaluate.rmse(with_null).first().n == 2


def test_split_by_hash_repeatable(spark):
    df = spark.range(2000).select(F.col("id").alias("u"), (F.col("id") * 3).alias("i"))
    a, b = als.split_by_hash(df, ["u", "i"], 0.7, seed=1)
    a2, _ = als.split_by_hash(df.repartition(13), ["u", "i"], 0.7, seed=1)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, a2.collect()))
    assert a.count() + b.count() == 2000 and 1200 < a.count() < 1600
    sizes = als.split_sizes(df, ["u", "i"], 0.7, seed=1).first()
    assert (sizes.n_train, sizes.n_test) == (a.count(), b.count())


def test_als_planted_low_rank(spark):
    rnd = np.random.default_rng(0)
    uf, itf = rnd.normal(size=(60, 2)), rnd.normal(size=(40, 2))
    rows = [(u, i, float(uf[u] @ itf[i] + 3)) for u in range(60) for i in range(40) if rnd.random() < 0.6]
    r = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
    res = als.als_rmse(r, reg=0.01, rank=4, iters=15, seed=3).first()
    mean = float(np.mean([x[2] for x in rows]))
    base = math.sqrt(np.mean([(x[2] - mean) ** 2 for x in rows]))
    assert res.n > 0 and res.rmse < 0.5 * base
    again = als.als_rmse(r, reg=0.01, rank=4, iters=15, seed=3).first()
    assert abs(again.rmse - res.rmse) < 1e-9
    recs = als.als_recommend(r, n=5, rank=4, iters=5, seed=3).collect()
    taken = {(u, i) for u, i, _ in rows}
    assert recs and all((x.user_id, x.course_id) not in taken for x in recs)


def test_salted_join_equals_plain_join(spark):
    from recengine.operators.skew import salted_join
    big = spark.createDataFrame([(u, i % 3) for u in range(60) for i in range(u % 5 + 1)] + [(u, 0) for u in range(200)],
                                "u bigint, k bigint")
    small = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c"), (7, "z")], "k bigint, v string")
    for how in ("inner", "left"):
        plain = sorted(map(tuple, big.join(small, "k", how).select("u", "k", "v").collect()), key=str)
        salted = sorted(map(tuple, salted_join(big, small, "k", how=how, hot_rows=10)
                            .select("u", "k", "v").collect()), key=str)
        assert plain == salted


@pytest.mark.parametrize("fn", ["item_cf_recommend", "user_cf_recommend"])
def test_recommenders_unchanged_by_hot_splitting(spark, fn):
    rows = _random_ratings(8)
    r = _ratings_df(spark, rows)
    f = getattr(recommend, fn)
    a = sorted(map(tuple, f(r, k_neighbors=4, n=5, hot_rows=3).collect()))
    b = sorted(map(tuple, f(r, k_neighbors=4, n=5).collect()))
    assert a == b and a


def test_predictions_unchanged_by_hot_splitting(spark):
    rows = _random_ratings(9)
    r = _ratings_df(spark, rows)
    for f, kw in ((evaluate.item_cf_predictions, {}), (evaluate.user_cf_predictions, {"unit": 100})):
        a = {(x[0], x[1]): x[3] for x in f(r, k=4, hot_rows=3, **kw).collect()}
        b = {(x[0], x[1]): x[3] for x in f(r, k=4, **kw).collect()}
        assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_find_hot_keys_many_matches_single(spark):
    rows = _random_ratings(10)
    r = spark.createDataFrame(rows, "user_id bigint, item_id bigint, x bigint")
    many = similarity.find_hot_keys_many(r, ["user_id", "item_id"], hot_rows=5)
    for k in ("user_id", "item_id"):
        one = similarity.find_hot_keys(r, k, hot_rows=5)
        got = sorted(map(tuple, many[k].collect())) if many[k] is not None else []
        want = sorted(map(tuple, one.collect())) if one is not None else []
        assert got == want
    assert (999, 6) in sorted(map(tuple, many["user_id"].collect()))


def test_empty_inputs(spark):
    r = spark.createDataFrame([], "user_id bigint, item_id bigint, rating double, x bigint")
    assert similarity.cosine_neighbors(r, k=3).count() == 0
    assert recommend.item_cf_recommend(r).count() == 0
    assert recommend.user_cf_recommend(r).count() == 0
    assert evaluate.item_cf_rmse(r).first().n == 0
    assert evaluate.user_cf_rmse(r).first().n == 0


def test_single_rater_item_and_one_item_user(spark):
    # item 3 has one rater, user 9 has one item: no pair, so no neighbours for them
    rows = [(1, 1, 300), (1, 2, 200), (2, 1, 100), (2, 2, 400), (9, 3, 250)]
    r = _ratings_df(spark, rows)
    nb = {(x.item_id, x.item_v) for x in similarity.cosine_neighbors(r, k=5).collect()}
    assert nb == {(1, 2), (2, 1)}
    assert recommend.item_cf_recommend(r, n=5).count() == 0


def test_zero_ratings_give_null_cos_not_error(spark):
    r = spark.createDataFrame([(1, 1, 0), (1, 2, 3), (2, 1, 0), (2, 2, 4)], "user_id bigint, item_id bigint, x bigint")
    got = {(x.item_id, x.item_v): x.cos for x in similarity.cosine_neighbors(r, k=3).collect()}
    assert got == {(1, 2): None, (2, 1): None}


@pytest.mark.parametrize("hot_rows", [10_000, 3])
def test_norm_broadcast_and_carried_paths_agree(spark, hot_rows):
    rows = _random_ratings(11)
    r = spark.createDataFrame(rows, "user_id bigint, item_id bigint, x bigint")
    a = sorted(map(tuple, similarity.cosine_neighbors(r, k=6, hot_rows=hot_rows).collect()))
    b = sorted(map(tuple, similarity.cosine_neighbors(r, k=6, hot_rows=hot_rows,
                                                      max_broadcast_entities=0).collect()))
    assert a == b and a


def test_als_maps_wide_ids_to_dense_ints(spark):
    big = 10_000_000_000
    rows = [(big + u, 7 * big + i, float((u * i) % 5 + 1)) for u in range(20) for i in range(15) if (u + i) % 3]
    r = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
    recs = als.als_recommend(r, n=3, rank=3, iters=3, seed=1).collect()
    assert recs and all(x.user_id >= big and x.course_id >= 7 * big for x in recs)
    taken = {(u, i) for u, i, _ in rows}
    assert all((x.user_id, x.course_id) not in taken for x in recs)


@pytest.mark.parametrize("ids", ["small", "wide", "int32", "text"])
def test_packed_and_unpacked_pair_keys_agree(spark, ids):
    rows = _random_ratings(12)
    if ids == "wide":      # beyond 2^31: the unpacked path
        rows = [(u, i + (1 << 40), x) for u, i, x in rows]
        schema = "user_id bigint, item_id bigint, x bigint"
    elif ids == "int32":
        schema = "user_id int, item_id int, x bigint"
    elif ids == "text":
        rows = [(u, f"i{i:03d}", x) for u, i, x in rows]
        schema = "user_id bigint, item_id string, x bigint"
    else:
        schema = "user_id bigint, item_id bigint, x bigint"
    r = spark.createDataFrame(rows, schema)
    got = similarity.cosine_neighbors(r, k=5, hot_rows=3)
    assert dict(got.dtypes)["item_id"] == dict(r.dtypes)["item_id"]
    got = sorted(map(tuple, got.collect()))
    by_e = {}
    for u, i, x in rows:
        by_e.setdefault(i, len(by_e))
    want = _brute_cosine(rows, 5)
    flat = sorted((e, v, c, rank) for e, lst in want.items() for rank, (v, c) in enumerate(lst, 1))
    assert [(a, b, rk) for a, b, _, rk in got] == [(a, b, rk) for a, b, _, rk in flat]
    assert all(g[2] == w[2] for g, w in zip(got, flat))


@pytest.mark.parametrize("fn", ["item_cf_recommend", "user_cf_recommend"])
def test_recommenders_same_with_wide_ids(spark, fn):
    """Ids beyond 2^31 take the unpacked aggregation; results are the same, shifted."""
    rows = _random_ratings(13)
    shift = 1 << 40
    f = getattr(recommend, fn)
    small = sorted(map(tuple, f(_ratings_df(spark, rows), k_neighbors=4, n=4).collect()))
    wide = sorted(map(tuple, f(_ratings_df(spark, [(u + shift, i + shift, x) for u, i, x in rows]),
                               k_neighbors=4, n=4).collect()))
    assert small and wide == [(u + shift, i + shift, rk) for u, i, rk in small]


def test_profile_keys_exact_stats(spark):
    from recengine.operators.skew import profile_keys
    rows = [(1, 10), (1, 11), (1, 12), (2, 10), (3, 10), (3, 11)]
    r = spark.createDataFrame(rows, "u bigint, i bigint")
    prof = profile_keys(r, ["u", "i"], hot_rows=2)
    u, i = prof["u"], prof["i"]
    assert (u.rows, u.distinct, u.sum_sq, u.lo, u.hi) == (6, 3, 9 + 1 + 4, 1, 3)
    assert (i.rows, i.distinct, i.sum_sq, i.lo, i.hi) == (6, 3, 9 + 4 + 1, 10, 12)
    assert u.half_pairs == (14 - 6) / 2
    assert sorted(map(tuple, u.hot.collect())) == [(1, 2)]      # 3 rows > T=2 -> 2 blocks
    assert sorted(map(tuple, i.hot.collect())) == [(10, 2)]
    none = profile_keys(r, ["u", "i"], hot_rows=100)
    assert none["u"].hot is None and none["i"].hot is None


def test_pair_partitions_whole_waves(spark):
    par = spark.sparkContext.defaultParallelism
    assert similarity.pair_partitions(spark, 0) == par
    assert similarity.pair_partitions(spark, 10 * par * 1_000_000) == 10 * par
    assert similarity.pair_partitions(spark, (par + 1) * 1_000_000) == 2 * par
    assert similarity.pair_partitions(spark, 1e12) >= 1e6  # no cap


@pytest.mark.parametrize("fn", ["item_cf_recommend", "user_cf_recommend"])
def test_candidates_are_not_shuffled(spark, fn):
    """Candidates were dealt by (user, candidate) and again by user for the ranking."""
    r = _ratings_df(spark, _random_ratings(8))
    out = getattr(recommend, fn)(r, k_neighbors=4, n=5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    above = plan.split("Generate inline")[0]
    assert "Window" in above and "HashAggregate" in above and "Exchange" not in above


def test_large_tables_are_joined_by_tasks_of_bounded_size(spark, monkeypatch):
    """The tasks of these joins were as many as Spark's setting says, whatever the tables' size."""
    from recengine.plans import registry
    from recengine.sources import fixtures
    sf = "/root/testdata/sf0.001"
    plain = sorted(map(tuple, registry._ratings(spark, sf, persist=False).collect()))
    monkeypatch.setattr(fixtures, "ROWS_PER_TASK", 500)
    wide = registry._ratings(spark, sf, persist=False)
    assert sorted(map(tuple, wide.collect())) == plain and plain
    width = fixtures.task_width(fixtures.Catalog(spark, sf).table("lineitem"))
    assert width > 8 and wide._jdf.queryExecution().toString().count("REPARTITION_BY_NUM") >= 7


def test_models_are_fitted_once_for_the_checks(spark, monkeypatch):
    from recengine.plans import registry
    fits = []
    fit = als.als_fit
    monkeypatch.setattr(als, "als_fit", lambda *a, **kw: fits.append(kw) or fit(*a, iters=2, **kw))
    got = registry.QUERIES["als_rmse_check"](spark, "/root/testdata/sf0.001").collect()
    assert len(fits) == 1 and got[0].rmse_agrees and got[0].solved
