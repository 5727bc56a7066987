import hashlib

import numpy as np
import pytest

from llm_helpers import documents
from recengine.llm import substring_dedup as s


def brute(rows, window=20):
    """rows: (doc_id, text); equal rows are one document, null ids last."""
    keys = {}
    words = {r: (r[1] or "").encode().split() for r in rows}
    firsts = {}
    for r in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        w = words[r]
        for i in range(len(w) - window + 1):
            firsts.setdefault(tuple(w[i:i + window]), (r, i))
    out = []
    for r in rows:
        w, gone = words[r], set()
        for i in range(len(w) - window + 1):
            if firsts[tuple(w[i:i + window])] != (r, i):
                gone |= set(range(i, i + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((r[0], len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, monkeypatch):
    df = documents(spark, rows).selectExpr("*", "1 as row", "2 as d", "3 as k1", "4 as lead")
    monkeypatch.setattr(s, "table", lambda *a: df)
    return sorted((tuple(r) for r in s.op7_substring_dedup(spark, "").collect()), key=str)


@pytest.mark.parametrize("seed,block", [(1, 10 ** 6), (2, 50)])
def test_equals_brute_force(spark, seed, block, monkeypatch):
    monkeypatch.setattr(s, "BLOCK_WINDOWS", block)
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)] + ["é", "😀"]
    some = lambda n: list(rng.choice(words, int(n)))
    shared = [some(n) for n in (19, 20, 21, 40, 90)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.integers(1, 4)):
            parts += some(rng.integers(0, 60))
            if rng.random() < 0.6:
                p = shared[rng.integers(0, 5)]
                parts += p[rng.integers(0, 3):]
        rows.append((int(i), " ".join(parts)))
    rows += [(200 + i, rows[i * 7][1]) for i in range(10)]  # copies
    rows += [(300, " ".join(["la"] * 70)), (301, " ".join(["la"] * 50 + ["lo"] * 20)), (302, "\n".join([" ".join(shared[2])] * 4)),
             (303, None), (304, ""), (305, " ".join(shared[0])), (306, " ".join(shared[1])), (7, rows[7][1]), (None, rows[8][1])]
    assert got(spark, rows, monkeypatch) == brute(rows)


def test_equal_ids_long_text_and_empty_table(spark, monkeypatch):
    rng = np.random.default_rng(5)
    long = " ".join(f"v{i}" for i in rng.integers(0, 5000, 40000))
    rows = [(1, long), (1, long), (2, long[100000:])]
    assert got(spark, rows, monkeypatch) == brute(rows)
    assert got(spark, [], monkeypatch) == []


def test_factors_name_their_sources(spark):
    base = [f"a{i}" for i in range(100)]
    rows = [(1, " ".join(base)), (2, " ".join(["x"] * 3 + base[10:50] + ["y"] + base[60:95]))]
    _, parses = s.substring_dedup(documents(spark, rows))
    out = parses.collect()
    assert len(out) == 1
    assert [tuple(f) for f in out[0].factors] == [(3, 40, 1, 10), (44, 35, 1, 60)]
    assert out[0].kept == "x x x y"


@pytest.mark.parametrize("window", [1, 5, 20])
def test_equal_windows_have_equal_anchors(window):
    rng = np.random.default_rng(window)
    for _ in range(60):
        core = rng.integers(0, 2 ** 64, window + 30, dtype=np.uint64)
        sides = [np.concatenate([rng.integers(0, 2 ** 64, int(rng.integers(0, 40)), dtype=np.uint64), core]) for _ in range(2)]
        runs = [s.anchors(x, window) for x in sides]
        for i in range(len(core) - window + 1):
            least = {int(r[1][len(x) - len(core) + i]) for x, r in zip(sides, runs)}
            assert len(least) == 1
            for x, (h, _, chosen) in zip(sides, runs):
                at = len(x) - len(core) + i
                assert least & set(h[at:at + window - min(s.ANCHOR, window) + 1][chosen[at:at + window - min(s.ANCHOR, window) + 1]].tolist())


def test_sliding():
    x = np.array([5, 3, 8, 1, 9, 2, 7], np.uint64)
    for w in range(1, 8):
        assert s.sliding(np.minimum, x, w).tolist() == [min(x[i:i + w]) for i in range(len(x) - w + 1)]
