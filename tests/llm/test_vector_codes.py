import numpy as np
import pytest

from recengine.llm import vector_codes as v

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """(codes, codebooks) of (vec_id, vector, label) rows by the definition."""
    kept = [(i, x, y) for i, x, y in rows if x is not None and len(x) and all(c is not None and np.isfinite(c) for c in x)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], []
    data = np.array([np.floor(np.float64(np.array(x, np.float32)) * scale) for _, x, _ in kept]).astype(int)
    out, books, error = [], [], 0
    for p in np.split(data, parts, axis=1):
        book = p[:entries].copy()
        for step in range(rounds + 1):
            d = ((p[:, None] - book[None]) ** 2).sum(-1)
            a = d.argmin(1)
            if step < rounds:
                for e in range(len(book)):
                    if (a == e).any():
                        book[e] = p[a == e].sum(0) // (a == e).sum()
        out.append(a)
        books.append(book)
        error = error + d.min(1)
    codes = ["".join(f"{e:02x}" for e in row) for row in np.array(out).T.tolist()]
    return sorted(((i, y, c, int(e)) for (i, _, y), c, e in zip(kept, codes, error)), key=str), books


def check(spark, rows, **kw):
    codes, books = v.vector_codes(spark.createDataFrame(rows, SCHEMA).repartition(3), **kw)
    want, want_books = brute(rows, **kw)
    assert sorted(((r.vec_id, None if r.label is None else int(r.label), r.code, r.error) for r in codes.collect()), key=str) == want
    assert [b.tolist() for b in books] == [b.tolist() for b in want_books]


def vectors(rng, n, width, spread):
    centres = rng.normal(size=(9, width))
    return [(int(i), [float(x) for x in centres[rng.integers(9)] * 0.2 + rng.normal(size=width) * spread], int(rng.integers(4))) for i in range(n)]


@pytest.mark.parametrize("spread", [0.0, 0.001, 0.05, 0.5])
def test_equal_to_the_definition(spark, spread, monkeypatch):
    monkeypatch.setattr(v, "CHUNK", 300)
    rng = np.random.default_rng(int(spread * 1000))
    check(spark, vectors(rng, 700, 16, spread))


def test_ties_copies_and_unused_entries(spark):
    rng = np.random.default_rng(5)
    grid = [(i, [float(x) / 4096 for x in rng.integers(-2, 3, 16)], None if i % 3 else 1) for i in range(400)]
    same = [(1000 + i, grid[0][1], 2) for i in range(500)]  # a third of all rows are one vector
    check(spark, grid + same + [(None, grid[1][1], 5), (3, grid[2][1], 6), (3, grid[2][1], 6)])
    check(spark, [(i, [0.25] * 8, 1) for i in range(40)])


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [i / 7 - 1.0] * 8, i % 2) for i in range(5)]
    rows = good + [(10, None, 1), (11, [], 1), (12, [1.0] * 7 + [None], 1), (13, [nan] * 8, 1), (14, [1.0] * 7 + [-inf], 1)]
    check(spark, rows)
    more = spark.createDataFrame(rows + [(20, [1.0] * 16, 1)], SCHEMA).selectExpr("*", "'a' as code", "'b' as v", "1 as error", "2 as trees")
    codes, _ = v.vector_codes(more)  # another length fits no codebook
    assert sorted(r.vec_id for r in codes.collect()) == [0, 1, 2, 3, 4]
    codes, books = v.vector_codes(spark.createDataFrame([], SCHEMA))
    assert codes.collect() == [] and books == []
    with pytest.raises(ValueError):
        v.vector_codes(spark.createDataFrame([(1, [1.0] * 7, 1)], SCHEMA))
    with pytest.raises(ValueError):
        v.vector_codes(spark.createDataFrame([(1, [1e9] * 8, 1)], SCHEMA))
    check(spark, [(i, [float(x) for x in np.random.default_rng(i).normal(size=8) * 5000], 0) for i in range(60)])


def test_tree_is_a_hierarchy_of_balls():
    points = np.random.default_rng(1).integers(-500, 500, (1500, 8))
    t = v.Tree.load(v.Tree.build(points).dump())
    assert sorted(t.order.tolist()) == list(range(1500)) and (t.points == points[t.order]).all()
    for b in range(len(t.low)):
        inside = t.points[t.low[b]:t.high[b]]
        assert (inside.sum(0) == t.total[b]).all()
        assert np.sqrt(((inside - t.centre[b]) ** 2).sum(1)).max() <= t.radius[b] + 1e-9
        under = np.flatnonzero(t.parent == b)
        assert len(under) == (0 if t.leaf[b] else 2)
        if len(under):
            assert t.low[under].min() == t.low[b] and t.high[under].max() == t.high[b]


def test_owned_balls_spare_their_points():
    """Well separated entries: most points are never compared."""
    rng = np.random.default_rng(2)
    centres = rng.integers(-4000, 4000, (16, 8))
    points = centres[rng.integers(16, size=4096)] + rng.integers(-40, 41, (4096, 8))
    tree = v.Tree.build(points)
    owned, places, _ = v.Tree.load(tree.dump()).walk(centres)
    assert len(places) < 400 and sum(tree.high[b] - tree.low[b] for b, _ in owned) == 4096 - len(places)
    assert {e for _, e in owned} == set(range(16))
