import hashlib

import numpy as np
import pytest

from llm_helpers import documents
from recengine.llm import decontaminate as d


def brute(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = tuple(d.item_words((text or "").encode()))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(w[i:i + window], set()).add(item)
    out = []
    for doc_id, text in docs:
        w = tuple(d.item_words((text or "").encode()))
        hit, names = set(), set()
        for p, who in windows.items():
            for i in range(len(w) - len(p) + 1):
                if w[i:i + len(p)] == p:
                    hit |= set(range(i, i + len(p)))
                    names |= who
        names.discard(None)
        sha = hashlib.sha256(",".join(sorted(map(str, names))).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(names), sha, bool(hit)))
    return sorted(out, key=str)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def random_case(seed):
    rng = np.random.default_rng(seed)
    words = ["a", "b", "c", "é"]
    some = lambda n: " ".join(rng.choice(words, n))
    items = [(int(i), some(int(n))) for i, n in enumerate(rng.integers(0, 25, 12))] + [(100, "a-B.c"), (101, None), (3, "b b b")]
    docs = []
    for i in range(80):
        parts = [some(int(rng.integers(0, 30)))]
        if i % 3 == 0:
            parts += ["zzz", items[int(rng.integers(0, 12))][1].upper(), "yy"]
        docs.append((i, " ".join(parts)))
    return docs + [(200, None), (201, ""), (202, "?!"), (5, "a b c"), (5, "a b c"), (203, "q " * 3000 + "a b c")], items


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block", [1 << 20, 60])
def test_equals_brute_force_in_one_or_many_blocks(spark, seed, block):
    docs, items = random_case(seed)
    df = documents(spark, docs).selectExpr("*", "1 as item_id", "2 as starts", "3 as n_words")
    got = d.hit_digest(d.benchmark_hits(df, bench(spark, items).selectExpr("*", "1 as doc_id"), block_chars=block))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items)


def test_empty_tables(spark):
    got = d.hit_digest(d.benchmark_hits(documents(spark, [(1, "a b")]), bench(spark, []))).collect()
    assert [tuple(r)[:4] for r in got] == [(1, 2, 0, 0)]
    assert d.benchmark_hits(documents(spark, []), bench(spark, [(1, "a")])).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_every_occurrence(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(0, 4, 600)
    text[-1] = 0
    index = d.FMIndex(text, 4)
    for n in (1, 2, 3, 5, 8):
        p = rng.integers(1, 4, n)
        lo, hi = index.search(p[None, :], np.array([n]))
        want = [i for i in range(len(text) - n + 1) if (text[i:i + n] == p).all()]
        assert sorted(index.locate(np.arange(lo[0], hi[0])).tolist()) == want


def test_spans_are_merged():
    s, e = d.merged(np.array([5, 0, 2, 20]), np.array([9, 3, 5, 21]))
    assert s.tolist() == [0, 20] and e.tolist() == [9, 21]
