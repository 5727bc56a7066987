import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from llm_helpers import SF_SMALL, documents
from recengine.llm import ctw


def spell(text):
    return b" ".join((text or "").encode().lower().split()) + b"\0"


def slow_scores(train, texts, depth):
    """Context-tree weighting node by node, with dictionaries and lgamma."""
    n = defaultdict(lambda: [0, 0])
    for t in train:
        x = bytes(depth) + spell(t)
        for i in range(depth, len(x)):
            for k in range(8):
                for d in range(depth + 1):
                    n[x[i - d:i], (1 << k) | (x[i] >> (8 - k))][(x[i] >> (7 - k)) & 1] += 1
    pe = {s: math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi) for s, (a, b) in n.items()}
    children = defaultdict(list)
    for c, p in n:
        if c:
            children[c[1:], p].append((c, p))
    pw = {}
    for s in sorted(n, key=lambda s: -len(s[0])):
        pw[s] = pe[s] if len(s[0]) == depth else np.logaddexp(math.log(.5) + pe[s], math.log(.5) + sum(pw[c] for c in children[s]))

    def one(context, prefix, d):
        s = (context[depth - d:], prefix)
        kt = (n[s][1] + .5) / (sum(n[s]) + 1)
        if d == depth or (context[depth - d - 1:], prefix) not in pe:
            return kt
        stop = math.exp(min(0, math.log(.5) + pe[s] - pw[s]))
        return stop * kt + (1 - stop) * one(context, prefix, d + 1)

    out = []
    for t in texts:
        x, total = bytes(depth) + spell(t), 0.0
        for i in range(depth, len(x)):
            for k in range(8):
                prefix = (1 << k) | (x[i] >> (8 - k))
                p = one(x[i - depth:i], prefix, 0) if (b"", prefix) in pe else 0.5
                total += math.log10(p if (x[i] >> (7 - k)) & 1 else 1 - p)
        out.append(total)
    return out


TEXTS = ["the cat sat on the mat", "The dog sat", "a b a b a b a b", "é è é", "", None, "  ", "x" * 300, "the the the", "zebra 😀 \x01",
         "the cat sat on the mat", "on the dog"]


def slow_base(rows, train):
    words = lambda t: [*(t or "").encode().lower().split(), None]
    c = Counter(w for t in train for w in words(t))
    n, v = sum(c.values()), len(c)
    return [(len(words(t)), sum(c[w] > 0 for w in words(t)), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t))) for t in rows]


@pytest.mark.parametrize("depth,frequent", [(0, 500), (2, 3), (4, 0)])
def test_equals_slow_weighting(spark, monkeypatch, depth, frequent):
    monkeypatch.setattr(ctw, "MAX_FREQUENT", frequent)
    monkeypatch.setattr(ctw, "COUNT_BYTES", 40)
    monkeypatch.setattr(ctw, "COUNT_KEYS", 30)
    rows = [(i, t) for i, t in enumerate(TEXTS * 2)] + [(None, "no id"), (3, TEXTS[3])]
    out = [zlib.crc32(str(i).encode()) % 7 == 2 if i is not None else False for i, _ in rows]
    train = [t for (_, t), o in zip(rows, out) if not o]
    assert any(out)
    got = sorted(ctw.lm_scores(documents(spark, rows).selectExpr("*", "1 as row", "2 as key", "3 as n"), depth=depth).collect(),
                 key=lambda r: (str(r.doc_id), r.score))
    base, score = slow_base([t for _, t in rows], train), slow_scores(train, [t for _, t in rows], depth)
    want = sorted(zip(rows, out, base, score), key=lambda r: (str(r[0][0]), r[3]))
    for g, ((i, t), o, b, s) in zip(got, want, strict=True):
        assert (g.doc_id, g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (i, o, *b[:3])
        assert math.isclose(g.base_score, b[3], rel_tol=1e-9) and math.isclose(g.score, s, rel_tol=1e-4, abs_tol=1e-5)
        assert g.n_bytes == len(spell(t)) and math.isclose(g.bits_per_byte, -s * math.log2(10) / len(spell(t)), rel_tol=1e-4, abs_tol=1e-5)


@pytest.mark.parametrize("cached", [1, 7])
def test_grams_beyond_the_cache_count(spark, monkeypatch, cached):
    monkeypatch.setattr(ctw, "MAX_GRAMS", cached)
    rows = list(enumerate(TEXTS * 2))
    out = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    want = slow_scores([t for (_, t), o in zip(rows, out) if not o], [t for _, t in rows], 4)
    got = {r.doc_id: r.score for r in ctw.lm_scores(documents(spark, rows), depth=4).collect()}
    assert any(out) and all(math.isclose(got[i], s, rel_tol=1e-4, abs_tol=1e-5) for (i, _), s in zip(rows, want))


def test_bytes_have_probabilities_that_sum_to_one():
    rng = np.random.default_rng(0)
    codes = ctw.grams([bytes(rng.integers(97, 101, 400).astype(np.uint8)) + b"\0"], 3)
    levels = [np.unique(codes & np.uint64((1 << (8 * d + 8)) - 1), return_counts=True) for d in range(4)]
    cut = (levels[3][0][:20], levels[3][1][:20])  # a limited deepest level
    for last in (levels[3], cut):
        tree = ctw.ContextTree([*levels[:3], last])
        for context in (0, 0x616263, 0x7A6162, int(levels[3][0][0] >> np.uint64(8))):
            every = np.array([(context << 8) | x for x in range(256)], np.uint64)
            assert math.isclose((10 ** tree.predict(every)).sum(), 1, rel_tol=1e-9)
            assert np.allclose(tree.score(every), tree.predict(every), atol=1e-5)


def test_whole_table(spark):
    got = ctw.op4_lm_scores(spark, SF_SMALL).collect()
    spark_rows = ctw.lm_scores(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).collect()
    rows = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()
    train = [r["text"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2]
    base = {r["doc_id"]: b for r, b in zip(rows, slow_base([r["text"] for r in rows], train))}
    assert len(got) == len(rows)
    for g in got:
        b = base[g.doc_id]
        assert (g.n_tokens, g.n_known, g.train_tokens) == b[:3] and math.isclose(g.base_score, b[3], rel_tol=1e-9)
    held = [g for g in spark_rows if g.held_out]
    # unseen texts: far below the bits per byte of single bytes, about 4
    bits = lambda rows: -sum(r.score for r in rows) * math.log2(10) / sum(r.n_bytes for r in rows)
    assert bits(held) < 2.6


def test_no_training_rows(spark):
    assert ctw.lm_scores(documents(spark, [])).collect() == []
    from pyspark.sql import functions as F
    r = ctw.lm_scores(documents(spark, [(1, "ab")]), held=F.lit(True)).first()
    assert r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0.0 and math.isclose(r.score, -24 * math.log10(2), rel_tol=1e-6)


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 2, 6.9, 7, 30.5, 1e6])
    assert np.allclose(ctw.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-10, atol=1e-10)
