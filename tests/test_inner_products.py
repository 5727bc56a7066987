"""Exact maximum inner products against MLlib and brute force; facts of fitted models."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from recengine.operators import als, inner_products


def factors(spark, rng, n, rank=6, lengths=True):
    v = rng.normal(size=(n, rank)) * (rng.pareto(1.2, size=(n, 1)) if lengths else 1)
    return v.astype(np.float32), spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v.astype(np.float32))], "id int, features array<float>")


def brute(u, v, n):
    out = {}
    for i, x in enumerate(u):
        s = x.astype(np.float64) @ v.T.astype(np.float64)
        out[i] = [s[j] for j in np.argsort(-s, kind="stable")[:n]]
    return out


@pytest.mark.parametrize("round_items,block", [(10 ** 6, 512), (90, 16), (64, 64)])
def test_equal_to_all_products(spark, round_items, block):
    rng = np.random.default_rng(round_items)
    (u, users), (v, items) = factors(spark, rng, 70), factors(spark, rng, 400)
    got = inner_products.top_products(users.repartition(3), items, 5, block=block, round_items=round_items).collect()
    want = brute(u, v, 5)
    by = {}
    for r in sorted(got, key=lambda r: (r.id, r["rank"])):
        assert r.score == pytest.approx(float(u[r.id] @ v[r.item]), rel=1e-4, abs=1e-4)
        by.setdefault(r.id, []).append(r.score)
    assert set(by) == set(want) and all(by[i] == pytest.approx(want[i], rel=1e-4, abs=1e-4) for i in by)


def test_most_blocks_are_left_out(spark):
    rng = np.random.default_rng(3)
    (_, users), (_, items) = factors(spark, rng, 50), factors(spark, rng, 3000)
    out = inner_products.top_products(users, items, 5, block=20)
    visits = [r.visits for r in out.select("id", "visits").distinct().collect()]
    assert len(visits) == 50 and np.mean(visits) < 150 / 4  # of 150 blocks


def test_ties_short_lists_and_empty_tables(spark):
    items = spark.createDataFrame([(i, [1.0, 0.0] if i % 2 else [0.0, 1.0]) for i in range(40)] + [(99, [0.0, 0.0])], "id int, features array<float>")
    users = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [-1.0, -1.0])], "id int, features array<float>")
    got = {}
    for r in inner_products.top_products(users, items, 4, block=3).orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append((r.item, r.score))
    assert got == {1: [(i, 1.0) for i in (1, 3, 5, 7)], 2: [(i, 0.0) for i in (0, 1, 2, 3)], 3: [(99, 0.0), (0, -1.0), (1, -1.0), (2, -1.0)]}
    few = inner_products.top_products(users, items.where("id < 2"), 4)
    assert few.groupBy("id").count().where("count <> 2").isEmpty()
    assert inner_products.top_products(users.limit(0), items, 4).count() == 0
    assert inner_products.top_products(users, items.limit(0), 4).count() == 0


@pytest.fixture(scope="module")
def ratings(spark):
    rng = np.random.default_rng(1)
    u, v = rng.normal(size=(60, 3)), rng.normal(size=(40, 3))
    rows = [(i, j, float(3 + u[i] @ v[j])) for i in range(60) for j in range(40) if rng.random() < 0.4]
    return spark.createDataFrame(rows, "user_id int, item_id int, rating double").persist()


def test_equal_to_the_librarys_recommendations(spark, ratings):
    model = als.als_fit(ratings, rank=5, iters=5, seed=1)
    theirs = model.recommendForAllUsers(8).select("user_id", F.posexplode("recommendations").alias("p", "r"))
    ours = inner_products.top_products(model.userFactors, model.itemFactors, 8, block=4)
    a = {(r.user_id, r.p + 1): (r.r.item_id, r.r.rating) for r in theirs.collect()}
    b = {(r.id, r["rank"]): (r.item, r.score) for r in ours.collect()}
    assert a.keys() == b.keys() and all(a[k][1] == pytest.approx(b[k][1], abs=1e-4) for k in a)
    assert np.mean([a[k][0] == b[k][0] for k in a]) > 0.98  # near ties may change places
    assert ours.agg(F.max("visits")).first()[0] <= 10


@pytest.mark.parametrize("reg", [0.1, 0.001])
def test_fitted_users_solve_their_equations(spark, ratings, reg):
    model = als.als_fit(ratings, rank=5, iters=4, reg=reg, seed=1)
    users, error = als.normal_equation_error(model, ratings, reg).first()
    assert users == 60 and error < 1e-4
    assert als.normal_equation_error(model, ratings, reg * 3 + 0.1).first().error > 1e-3  # another problem


def test_recommendations_for_some_users(spark, ratings):
    some = spark.createDataFrame([(3,), (5,), (3,)], "user_id int")
    whole = als.als_recommend(ratings, n=6, iters=3, rank=4)
    part = als.als_recommend(ratings, n=6, iters=3, rank=4, users=some)
    key = lambda df: sorted((r.user_id, r.course_id, r.ranking) for r in df.collect())
    assert key(part) == key(whole.where("user_id in (3, 5)"))


def test_only_scores_that_reach_a_list_are_sorted(monkeypatch):
    rng = np.random.default_rng(5)
    u, v = (rng.normal(size=(n, 4)).astype(np.float32) for n in (64, 4096))
    v /= np.sqrt((v ** 2).sum(1, keepdims=True))  # of one length: users stay open
    sorted_, lexsort = [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys, axis=-1: sorted_.append(np.size(keys[0])) or lexsort(keys, axis=axis))
    lists, open_ = inner_products.Lists(64, 5), np.ones(64, bool)
    visits = inner_products.scan_blocks(u, lists, open_, np.arange(4096), v, 128)
    assert visits.sum() > 2 * 64
    # the first block sorts its five best; before, each later one sorted as many again for every open user
    assert sum(sorted_) < 0.6 * 2 * 5 * visits.sum()
    for i in range(64):
        assert lists.score[i] == pytest.approx(np.sort(v @ u[i])[::-1][:5], rel=1e-5)


def test_scores_that_are_no_numbers_enter_no_list():
    lists = inner_products.Lists(2, 2)
    lists.add(np.arange(2), np.array([[np.nan, 1, 3, np.nan, 2], [np.nan, np.nan, np.nan, np.nan, 4]], np.float32), np.arange(5))
    assert lists.item[0].tolist() == [2, 4] and lists.item[1, 0] == 4 and lists.score[1, 1] == -np.inf
    lists.add(np.arange(2), np.array([[3, 3, 1], [np.nan, 0, 5]], np.float32), np.array([7, 1, 8]))
    assert lists.item.tolist() == [[1, 2], [8, 4]]


def test_done_users_are_not_carried_through_the_rounds(spark, monkeypatch):
    _, items = factors(spark, np.random.default_rng(7), 300, rank=3)
    users = spark.createDataFrame([(1, [1.0, 0.0, 0.0]), (2, [0.0, 0.0, 0.0]), (3, [0.0, 1.0, 1.0])], "id int, features array<float>")
    carried, checkpoint = [], inner_products.reliable_checkpoint

    def counted(df):
        out = checkpoint(df)
        if "open" in out.columns:
            carried.append(out.count())
        return out

    monkeypatch.setattr(inner_products, "reliable_checkpoint", counted)
    got = inner_products.top_products(users, items, 4, block=10, round_items=100).collect()
    assert sorted(r.id for r in got) == [1] * 4 + [2] * 4 + [3] * 4
    assert carried[0] == 3 and carried[1] < 3  # the zero user stays open: every product ties
