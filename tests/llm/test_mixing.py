import hashlib

import pytest

from llm_helpers import documents
from recengine.llm import mixing as m


def brute(rows, weights=m.WEIGHTS, share=m.SHARE):
    """(doc_id, copies, size, source_size, target) of (doc_id, text, lang, source) rows, from the definition."""
    size = [len((r[1] or "").encode().split()) for r in rows]
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(n for n, r in zip(size, rows) if r[3] == s) for s in names}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, list(names), share * sum(size)
    while open_:
        part = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if part[s] > 2 * total[s]]
        if not over:
            target |= part
            break
        for s in over:
            target[s] = 2 * total[s]
            left -= target[s]
            open_.remove(s)
    key = [int(hashlib.md5(f"{m.SEED}:{'null' if r[0] is None else r[0]}".encode()).hexdigest()[:15], 16) for r in rows]
    n = {}
    for s in names:
        base = target[s] >= total[s]
        budget, run, cut = target[s] - total[s] * base, 0, 0
        words = {}
        for k, z, r in zip(key, size, rows):
            if r[3] == s:
                words[k] = words.get(k, 0) + z
        for k in sorted(words):
            if budget <= 0 or run >= budget:
                break
            cut = k + 1 if run + words[k] - budget < budget - run else k
            run += words[k]
        for i, r in enumerate(rows):
            if r[3] == s:
                n[i] = int(base) + (key[i] < cut)
    return [(r[0], n[i], size[i], total[r[3]], target[r[3]]) for i, r in enumerate(rows)]


def case(seed):
    import random
    rng = random.Random(seed)
    rows = [(i, "w " * rng.randint(0, 60), "en", rng.choice(["a", "a", "a", "b", "B", "c", "é", "z", None])) for i in range(300)]
    return rows + [(1000, None, "en", "a"), (3, "x y z", "en", "a"), (3, "x y z", "en", "a"), (None, "no id", "en", "b"), (1001, "", "en", "empty")]


@pytest.mark.parametrize("seed,share", [(1, 1.5), (2, 0.3), (3, 1.99)])
def test_equals_the_definition(spark, seed, share):
    rows = case(seed)
    df = documents(spark, rows).selectExpr("*", "1 as key", "2 as s", "3 as size", "4 as target")
    got = sorted((tuple(r) for r in m.mix_sources(df, share=share).select("doc_id", "copies", "size", "source_size", "target", "taken").collect()), key=str)
    want = sorted(((*r, r[1] * r[2]) for r in brute(rows, share=share)), key=str)
    for g, w in zip(got, want, strict=True):
        assert g[:4] == w[:4] and abs(g[4] - w[4]) < 1e-6 and g[5] == w[5]


def test_sources_come_near_their_targets_and_reruns_agree(spark):
    rows = [(i, "w " * (1 + i % 50), "en", "hot" if i % 3 else f"s{i % 30}") for i in range(4000)]
    df = documents(spark, rows)
    first = sorted(map(tuple, m.mix_sources(df).collect()))
    assert first == sorted(map(tuple, m.mix_sources(df.repartition(7)).collect()))
    taken = {}
    for r in first:
        assert r[6] <= 2 * r[2]
        taken.setdefault(r[1], [r[4], 0])[1] += r[6]
    assert all(abs(a - b) <= 50 for a, b in taken.values())


def test_mixed_documents_repeat_rows(spark):
    rows = case(4)
    n = {r[0]: r[1] for r in brute(rows)}
    got = m.mixed_documents(documents(spark, rows)).collect()
    count = {}
    for r in got:
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert all(count.get(i, 0) == n[i] * (3 if i == 3 else 1) or i == 3 for i in n)


def test_empty_table_and_no_words(spark):
    assert m.mix_sources(documents(spark, [])).collect() == []
    got = m.mix_sources(documents(spark, [(1, "", "en", "a"), (2, None, "en", None)])).collect()
    assert {(r.taken, r.target) for r in got} == {(0, 0.0)}
