import random

import numpy as np
import pytest

from llm_helpers import documents
from recengine.llm import link_blocks, ngram_join as j


def brute(rows, n=3, percent=90):
    sets = []
    for doc_id, text, *_ in rows:
        w = (text or "").encode().lower().split()
        k = min(n, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    out = []
    for a in range(len(rows)):
        ids = [rows[b][0] for b in range(len(rows)) if find(b) == find(a) and rows[b][0] is not None]
        out.append((rows[a][0], len(sets[a]), min(ids) if ids else None))
    return sorted(out, key=str)


def got(df, **kw):
    return sorted((tuple(r) for r in j.ngram_join(df, **kw).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def near_copies(rng, n_words, copies, edits):
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(n_words)]
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_random_near_copies_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(link_blocks, "BLOCK", 8)  # groups of many blocks
    monkeypatch.setattr(link_blocks, "SCREEN", 16)
    rng = random.Random(seed)
    texts = []
    for size in (4, 9, 10, 12, 19, 21, 40, 60, 100, 250, 700):
        texts += near_copies(rng, size, 14, max(1, size // 40 + 1))
    texts += near_copies(rng, 120, 60, 3)
    base = [f"c{i}" for i in range(200)]
    texts += [" ".join(base[i:]) for i in range(0, 60, 3)]  # a chain: each links with its neighbours only
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    assert got(documents(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One  two"), (8, "a b c"), (8, "a b c"),
            (None, "a b c"), (None, "alone in the world"), (9, "a\x0bb\x0cc"), (10, "É b c"), (11, "é b c"), (12, "x y z " * 9000)]
    df = documents(spark, rows).selectExpr("*", "1 as cls", "2 as sig", "3 as component_id")
    assert got(df) == brute(rows)
    assert got(documents(spark, [])) == []


@pytest.mark.parametrize("percent", [80, 90, 95])
def test_linked_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    tiles = j.Tiles(percent)
    for _ in range(1500):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2 ** 64, n, dtype=np.uint64))
        drop, add = rng.integers(0, max(1, n // 12) + 1, 2)
        b = np.unique(np.concatenate([a[rng.permutation(len(a))[drop:]], rng.integers(0, 2 ** 64, add, dtype=np.uint64)]))
        if len(b) and j.links(len(np.intersect1d(a, b)), len(a), len(b), percent):
            assert len(np.intersect1d(tiles.signatures(a), tiles.signatures(b)))
            words = min(len(j.bitmap(a)), len(j.bitmap(b)))
            assert j.overlap_bound(len(a), len(b), j.folded(j.bitmap(a), words), j.folded(j.bitmap(b), words)) >= len(np.intersect1d(a, b))
