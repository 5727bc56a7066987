import math
import zlib

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from llm_helpers import SF_SMALL, documents
from recengine.llm import language_id as g


def test_held_out_accuracy(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    lang = {r["doc_id"]: (r["lang"], r["text"]) for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()}
    got = g.op1_language_id(spark, sf).collect()
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and g.words_of(lang[r.doc_id][1])]
    assert len(held) > 100 and np.mean([r.lang_pred == lang[r.doc_id][0] for r in held]) >= 0.98


ROWS = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, "the house", "en"), (4, "das Haus", "de"),
        (5, "le chat noir", None), (6, None, "fr"), (7, "12 !?", "fr")]


def slow(train, text):
    """Scores straight from the definition."""
    words = [(w, x) for t, x in train for w in g.words_of(t)]
    langs = sorted({x for _, x in words})
    wc = {(w, x): words.count((w, x)) for w, x in words}
    vocab = {w for w, _ in words}
    grams = {}
    for w, x in wc:
        for n in range(1, g.MAX_N + 1):
            for q in g.ngrams(w, n):
                grams[q, x] = grams.get((q, x), 0) + 1
    total = dict.fromkeys(langs, 0.0)
    lf = lambda counts, keys, e, x: math.log((counts.get((e, x), 0) + g.SMOOTH) / sum(counts.get((k, x), 0) + g.SMOOTH for k in keys))
    for w in g.words_of(text):
        for x in langs:
            if w in vocab:
                total[x] += lf(wc, vocab, w, x)
                continue
            for n in range(g.MAX_N, 0, -1):
                every = {q for q, _ in grams if len(q) == n}
                found = [q for q in g.ngrams(w, n) if q in every]
                if found:
                    total[x] += np.mean([lf(grams, every, q, x) for q in found])
                    break
    best = max(langs, key=lambda x: (total[x], [-ord(c) for c in x]))
    return best, 1 / sum(math.exp(total[x] - total[best]) for x in langs)


def test_equals_the_definition(spark):
    texts = ["the", "Hund", "hunde katzen", "doghouse", "ЖЖ", "e", "Haus and dog und", None, "", "42 -", "the " * 20000, "é"]
    rows = ROWS + [(10 + i, t, "xx") for i, t in enumerate(texts)] + [(10, "the", "xx")]
    df = documents(spark, rows).selectExpr("*", "1 as lang_pred", "2 as score", "3 as entry")
    got = {r.doc_id: (r.lang_pred, r.score) for r in g.identify(df, held=F.col("doc_id") >= 10).collect()}
    for i, t in enumerate(texts):
        if g.words_of(t):
            want = slow([(t, x) for _, t, x in ROWS if x], t)
            assert got[10 + i][0] == want[0] and math.isclose(got[10 + i][1], want[1], rel_tol=1e-9), t
        else:
            assert got[10 + i] == ("und", 0.0)
    assert got[7] == ("und", 0.0) and got[1][0] == "en"


def test_nothing_learned_and_empty(spark):
    assert g.identify(documents(spark, [])).collect() == []
    got = g.identify(documents(spark, [(1, "some words", None), (None, "more", None)])).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}


def test_sample_is_bounded(spark):
    rows = [(i, f"word{chr(97 + i % 26)} text", "en") for i in range(2000)]
    model = g.train(documents(spark, rows), max_bytes=3000, max_entries=10)
    assert len(model.words) <= 10 and len(model.grams) <= 10
