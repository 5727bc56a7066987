import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as p
from llm_helpers import SF_SMALL, documents
from recengine.llm import decontaminate as d
from recengine.llm import language_id as g
from recengine.llm import ngram_join as j
from recengine.llm import token_output as t
from test_decontaminate import brute as hits
from test_mixing import brute as mixed
from test_ngram_join import near_copies

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def components(rows, n, percent):
    """Root index of each row's component, by comparing all pairs."""
    sets = []
    for r in rows:
        w = (r[1] or "").encode().lower().split()
        k = min(n, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * len(sets[a] | sets[b]):
                    root[find(a)] = find(b)
    return [find(a) if sets[a] else None for a in range(len(rows))]


def test_one_of_each_group_stays(spark):
    import random
    rng = random.Random(3)
    texts = [t for size in (3, 8, 30, 120) for t in near_copies(rng, size, 12, size // 20 + 1)]
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(texts)]
    rows += [(5, rows[5][1], "en", "s2"), (5, rows[5][1], "en", "s2"), (7, "another text under id seven", "en", "s0"), (None, texts[3], "en", "s0"),
             (900, None, None, None), (901, "", "en", "s0"), (901, "", "en", "s0"), (None, "only without an id", "en", "s0")]
    full = [(r[0], r[1], r[2], r[3], None if r[1] is None else len(r[1])) for r in rows]
    got = rows_of(j.one_of_each(documents(spark, rows).select(*COLUMNS), 5, 80))
    comp = components(rows, 5, 80)
    left = [r for r, c in zip(full, comp) if c is None]
    for c in {c for c in comp if c is not None}:
        members = {r for r, k in zip(full, comp) if k == c}
        ids = [r[0] for r in members if r[0] is not None]
        kept = [r for r in got if r in members]
        assert len(kept) == 1 and kept[0][0] == (min(ids) if ids else None)
        left += kept
    assert sorted(left, key=str) == got


def test_contaminated_documents_go_in_one_or_many_blocks(spark):
    rows = [(i, f"w{i} x y z " * 10) for i in range(30)] + [(50, "a b c"), (51, None), (52, "a b c"), (50, "clean")]
    items = spark.createDataFrame([(1, "a b c"), (2, "w7 x y z " * 4), (3, None)], "item_id long, text string")
    for size in (1 << 20, 8):
        got = rows_of(d.clean_documents(documents(spark, rows), items, block_chars=size))
        bad = {(r[0], r[1]) for r in rows if r[1] and ("a b c" in r[1] or r[0] == 7)}
        assert [r[:2] for r in got] == sorted([r for r in rows if r not in bad], key=lambda r: str((*r, "en", "src0", r[1] and len(r[1]))))


def test_whole_run_equals_stages_by_hand(spark):
    full = [tuple(r[c] for c in COLUMNS) for r in pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()]
    rows = [r for r in full if g.words_of(r[1])]
    comp = components(rows, p.SHINGLE, p.PERCENT)
    rows = [r for r, c in zip(rows, comp) if c is None or r[0] == min(q[0] for q, k in zip(rows, comp) if k == c)]
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF_SMALL}/benchmark.parquet").to_pylist()]
    bad = {h[0] for h in hits([(r[0], r[1]) for r in rows], items) if h[5]}
    rows = [r for r in rows if r[0] not in bad]
    assert bad
    n = {r[0]: r[1] for r in mixed([(r[0], r[1], r[2], r[3]) for r in rows])}
    rows = sorted(r for r in rows for _ in range(n[r[0]]))
    tk = Tokenizer.from_file(t.default_tokenizer())
    want, start = [], 0
    for r in rows:
        ids = np.array(tk.encode(r[1], add_special_tokens=False).ids + [0], "<u4")
        want.append((r[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, p.run(spark, SF_SMALL).collect()), key=lambda r: r[1]) == want


@pytest.mark.parametrize("rows", [[], [(None, None, None, None)], [(1, "12 !", None, "a"), (1, "12 !", None, "a")]])
def test_stages_take_odd_tables(spark, rows):
    docs = documents(spark, rows)
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == COLUMNS, name
        out.collect()
    p.STAGES[-1][1](spark, docs, SF_SMALL).collect()


def test_language_stage(spark):
    rows = [(1, "the cat", "en"), (2, "le chat", "fr"), (3, "le chat", None), (4, "42", "en"), (5, None, "en")]
    got = p.identify_language(spark, documents(spark, rows), SF_SMALL)
    assert {(r.doc_id, r.lang) for r in got.collect()} == {(1, "en"), (2, "fr"), (3, "fr")}
    nothing = p.identify_language(spark, documents(spark, [(1, "a b", None), (2, "3", None)]), SF_SMALL)
    assert [(r.doc_id, r.lang) for r in nothing.collect()] == [(1, None)]


CLASHES = ("score lang_pred row id key g h k rows salt again component component_id cls doc_key text_key n_shingles base threshold s of n size target source_size "
           "words block label hit n_hit n_words contaminated copies taken __id __key __s __n __i `my col` a b node").split(" ")


@pytest.mark.parametrize("stage", [name for name, _ in p.STAGES[:-1]])
def test_extra_columns_may_have_any_name(spark, stage):
    names = " ".join(CLASHES).replace("`my col`", "`my_col`").split()
    rows = [(i, f"This is the {w} number {i} of some plain english words that go on for a while and stop", "en", f"s{i % 2}")
            for i, w in enumerate(("text", "line", "page", "book", "note") * 4)] + [(99, "Das ist ein kurzer Satz auf Deutsch", "de", None)]
    docs = documents(spark, rows).select(*COLUMNS, *[F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")).alias(n.strip("`")) for n in names])
    out = dict(p.STAGES)[stage](spark, docs, SF_SMALL)
    assert out.columns == docs.columns
    got = out.collect()
    assert got and all(r[n.strip("`")] == f"{n}:{r.doc_id}" for r in got for n in names)
