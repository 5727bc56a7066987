import random

import numpy as np
import pytest

from llm_helpers import documents
from recengine.llm import link_blocks, minhash_join as j
from test_ngram_join import brute, near_copies


def got(df, **kw):
    rows = j.near_dedup(df, **kw).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_near_copies_equal_brute_force(spark, seed, monkeypatch):
    # groups of many blocks, chunks of few documents
    monkeypatch.setattr(link_blocks, "BLOCK", 8)
    monkeypatch.setattr(link_blocks, "SCREEN", 16)
    monkeypatch.setattr(j, "CHUNK_POSTINGS", 600)
    rng = random.Random(seed)
    texts = []
    for size in (4, 5, 6, 9, 12, 19, 21, 40, 60, 100, 250, 700):
        texts += near_copies(rng, size, 14, max(1, size // 60 + 1))
    texts += near_copies(rng, 140, 90, 5)  # a large group in which few pairs link
    base = [f"c{i}" for i in range(200)]
    texts += [" ".join(base[i:]) for i in range(0, 60, 3)]  # a chain: each links with its neighbours only
    passage = " ".join(f"p{i}" for i in range(30))
    texts += [passage + " " + " ".join(f"q{rng.randrange(10 ** 6)}" for _ in range(30)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    assert got(documents(spark, rows)) == brute(rows, 5, 85)


def test_other_parameters(spark):
    rng = random.Random(7)
    texts = [t for size in (8, 30, 90) for t in near_copies(rng, size, 12, max(1, size // 25))]
    rows = [(i, t) for i, t in enumerate(texts)]
    assert got(documents(spark, rows), n=2, percent=70) == brute(rows, 2, 70)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One  two"), (8, "a b c d e f"), (8, "a b c d e f"),
            (None, "a b c d e f"), (None, "alone in the whole wide world"), (9, "a\x0bb\x0cc d e f"), (10, "É b c"), (11, "é b c"),
            (12, "x y z " * 9000), (13, "x y z " * 9001)]
    df = documents(spark, rows).selectExpr("*", "1 as cls", "2 as `key`", "3 as component_id", "4 as kept", "5 as component", "6 as signature")
    rows_got = j.near_dedup(df).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows_got), key=str) == brute(rows, 5, 85)
    assert sum(r.kept for r in rows_got if r.doc_id == 8) == 2
    assert got(documents(spark, [])) == []


def test_a_third_are_copies_of_one_text(spark):
    rng = random.Random(3)
    rows = [(i, "the very same text of ten words and no more") for i in range(300)] + [
        (300 + i, " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(12))) for i in range(600)]
    assert got(documents(spark, rows)) == brute(rows, 5, 85)


@pytest.mark.parametrize("percent", [70, 85, 95])
def test_linked_sets_reach_prefix_and_threshold(percent):
    comparer, rng = j.Matches(percent), np.random.default_rng(percent)
    matches = []
    for _ in range(1500):
        n = int(rng.integers(1, 300))
        a = rng.integers(0, 2 ** 64, n, dtype=np.uint64)
        drop = int(rng.integers(0, n // 6 + 1))
        b = np.concatenate([a[drop:], rng.integers(0, 2 ** 64, int(rng.integers(0, n // 12 + 1)), dtype=np.uint64)])
        a, b = np.unique(a), np.unique(b)
        if len(b) and comparer.links(a, b):
            x, y = j.minima(a), j.minima(b)
            m = comparer.matrix([j.signature(x, comparer.prefix), j.signature(y, comparer.prefix)])
            assert (j.postings(x, comparer.prefix) == j.postings(y, comparer.prefix)).any()
            one, other = (tuple(a[k] for a in m[1:]) for k in (0, 1))
            count = comparer.counts(tuple(a[:1] for a in m[1:]), other)[0]
            assert count >= comparer.threshold and count == np.count_nonzero(x.astype(np.uint8) == y.astype(np.uint8)) and len(one) == 2
            matches.append(np.mean(x == y) - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    assert len(matches) > 200 and abs(np.mean(matches)) < 0.01  # matches estimate the similarity


def test_thresholds():
    assert j.prefix_length(100) == 1 and j.match_threshold(100) == j.COORDINATES
    assert (j.prefix_length(85), j.match_threshold(85)) == (15, 76)
