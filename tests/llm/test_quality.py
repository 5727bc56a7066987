import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq

from llm_helpers import SF_SMALL, documents
from recengine.llm import quality as q


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


ODD = [None, "", " \n\t", "a", "a b", "a b c", "a a a a a", "x y z x y z x y z", "a b c d a b c", "é😀 # * a\x1cb c\x0bd\x0c\re",
       "l\nl\n\nl \n \nl", "#*$%&|<>" * 20, "w " * 30000, " ".join(f"u{i}" for i in range(20000))]


def test_base_counts_of_odd_texts(spark):
    df = documents(spark, list(enumerate(ODD)) + [(1, "dup"), (1, "dup")])
    got = sorted((r.doc_id, tuple(r)[1:7]) for r in q.quality_rules(df.selectExpr("*", "1 as w", "2 as lines", "3 as g")).collect())
    want = sorted([(i, brute(x)) for i, x in enumerate(ODD)] + [(1, brute("dup"))] * 2)
    assert got == want


def taken(bucket, weight, share):
    """The weight of each row in the ``share`` with the least buckets, the last one in part."""
    total, out = weight.sum() * share, np.zeros(len(weight))
    below = 0.0
    for b in np.unique(bucket):
        here = bucket == b
        part = min(1.0, (total - below) / weight[here].sum())
        out[here] = weight[here] * part
        below += weight[here].sum()
        if below >= total:
            return out, b


def mcd(x):
    """All starts, each until its determinant falls no more while some other's does."""
    floor, one = np.array(list(q.FLOOR.values())), np.ones(len(x))
    at = lambda values, share: (taken(np.floor(values * q.GRID), one, share)[1] + 0.5) / q.GRID
    quantile = lambda values, share: np.array([at(values[:, i], share) for i in range(4)])
    scale = np.maximum(1.4826 * quantile(np.abs(x - quantile(x, q.STARTS[0])), 0.5), floor)
    state = [(quantile(x, share), np.diag(scale ** 2), np.inf) for share in q.STARTS]
    distance = lambda mean, cov: np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
    while True:
        new = []
        for mean, cov, _ in state:
            w, _ = taken(np.floor(np.log2(distance(mean, cov) + 2.0 ** -20) * q.OCTAVE), one, q.H)
            mean = (w[:, None] * x).sum(0) / w.sum()
            cov = ((w[:, None] * (x - mean)).T @ (x - mean)) / w.sum() * q.consistency(q.H) + np.diag(floor ** 2)
            new.append((mean, cov, np.linalg.slogdet(cov)[1] / 2))
        falls = any(a[2] - b[2] > q.FALL for a, b in zip(state, new))
        state = new
        if not falls:
            break
    best = min(range(len(state)), key=lambda k: (round(state[k][2], 3), k))
    return distance(*state[best][:2])


def test_whole_table_equals_a_plain_computation(spark):
    rows = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()
    rows = [(r["doc_id"], r["text"], "en" if r["doc_id"] % 3 else None, "rare" if r["doc_id"] % 11 == 0 else "a" if r["doc_id"] % 2 else "b")
            for r in rows]
    got = {r.doc_id: r for r in q.quality_rules(documents(spark, rows)).collect()}
    groups, base = {}, {}
    for doc_id, text, lang, source in rows:
        base[doc_id] = b = brute(text)
        assert tuple(got[doc_id])[1:7] == b
        lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        if not b[5]:
            x = (np.log(b[1] / b[0]), np.log1p(b[2] / b[0]), np.log1p(b[3] / len(lines)), np.log1p(b[4] / b[0]))
            groups.setdefault((lang, source), []).append((doc_id, x))
    small = [k for k, v in groups.items() if len(v) < q.MIN_GROUP]
    pool = []
    for k in small:
        members = groups.pop(k)
        middle = np.median([x for _, x in members], axis=0)
        pool += [(i, x - middle) for i, x in members]
    if pool:
        groups["small"] = pool
    for members in groups.values():
        for (doc_id, _), d in zip(members, mcd(np.array([x for _, x in members]))):
            assert np.isclose(got[doc_id].distance, d, rtol=1e-4, atol=1e-6), doc_id
            assert got[doc_id].kept == (d <= q.CUTOFF)
    assert not any(got[i].kept for i in base if base[i][5])


def test_junk_goes_and_prose_stays(spark):
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(800)]
    text = lambda n: " ".join(rng.choice(words, n))
    rows = [(i, text(int(rng.integers(60, 3000)))) for i in range(200)]
    rows += [(1000 + i, " ".join(w + "###" for w in text(200).split())) for i in range(40)]
    rows += [(2000 + i, "\n".join([text(9)] * 4 + [text(12) for _ in range(5)])) for i in range(5)]
    kept = {r.doc_id: r.kept for r in q.quality_rules(documents(spark, rows)).collect()}
    assert all(kept[i] for i in range(200)) and not any(kept[1000 + i] for i in range(40))


def test_a_third_of_junk_copies_is_rejected(spark):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(800)]
    text = lambda n: " ".join(rng.choice(words, n))
    junk = " ".join(w + "##" for w in text(200).split())
    near = [" ".join(w + "##" for w in text(200).split()) for _ in range(35)]
    rows = [(i, text(int(rng.integers(200, 400)))) for i in range(65)]
    rows += [(1000 + i, junk) for i in range(35)]
    rows += [(i, text(int(rng.integers(200, 400))), "de") for i in range(2000, 2065)]
    rows += [(3000 + i, x, "de") for i, x in enumerate(near)]
    kept = {r.doc_id: r.kept for r in q.quality_rules(documents(spark, rows)).collect()}
    assert not any(kept[i] for i in [*range(1000, 1035), *range(3000, 3035)])
    assert all(kept[i] for i in [*range(65), *range(2000, 2065)])



def test_each_kind_of_junk_alone_is_rejected(spark):
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(800)]
    text = lambda n: " ".join(rng.choice(words, n))
    rows = [(i, text(int(rng.integers(60, 3000)))) for i in range(200)]
    rows += [(1000 + i, "\n".join([text(9)] * 4 + [text(12) for _ in range(5)])) for i in range(5)]
    rows += [(2000 + i, text(120).replace(" ", " | ")) for i in range(5)]
    rows += [(3000 + i, " ".join([text(30)] * 2 + [text(70)])) for i in range(5)]
    kept = {r.doc_id: r.kept for r in q.quality_rules(documents(spark, rows)).collect()}
    assert [i for i, k in kept.items() if not k] and {i for i, k in kept.items() if k} == set(range(200))


def test_many_equal_vectors_weigh_as_one_row(spark):
    """A million copies of one vector: no row is repeated, and the other half decides."""
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(1.5, 0.1, 4000), *[np.abs(rng.normal(0, 0.05, 4000)) for _ in range(3)]])
    rows = [("g", *map(float, r), 500) for r in x] + [("g", 1.5, 1.1, 0.0, 0.0, 1_000_000)]
    v = spark.createDataFrame(rows, "g string, x_length double, x_symbols double, x_lines double, x_repeat double, n long")
    p = q.estimates(v, q.Scratch(spark, "t")).first()
    assert abs(p.m_0 - 1.5) < 0.05 and p.m_1 < 0.1  # a third of the rows, far from the others


def test_small_groups_are_judged(spark):
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(800)]
    text = lambda n: " ".join(rng.choice(words, n))
    rows = [(10 * k + i, text(200), f"l{k}", f"s{k}") for k in range(8) for i in range(6)]
    rows += [(1000 + k, " ".join(w + "##" for w in text(200).split()), f"l{k}", f"s{k}") for k in range(4)]
    rows += [(2000, text(300), "alone", None)]
    got = {r.doc_id: r for r in q.quality_rules(documents(spark, rows)).collect()}
    assert all(r.distance is not None for r in got.values()) and got[2000].distance < 0.1
    assert not any(got[1000 + k].kept for k in range(4)) and all(got[10 * k + i].kept for k in range(8) for i in range(6))


def test_empty_table(spark):
    assert q.quality_rules(documents(spark, [])).collect() == []
