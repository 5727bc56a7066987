"""Substring dedup (operator 7): relative Lempel-Ziv factors of documents against indexed reference blocks.

A window is WINDOW consecutive words; it is a duplicate if the same words also start earlier (smaller doc_id, or earlier in the
document). Words covered by duplicate windows are removed. Each document is parsed into factors, maximal runs of
duplicate windows with consecutive sources, and the words between: since every window is looked up, also those across the
boundary of two factors are.

The reference is all text, indexed by window hashes, in blocks; a document is parsed against every block that can hold a
match, and two reductions find these without loss:
 * Anchors. Of the runs of ANCHOR words inside a window, the one with the least hash is the window's anchor, so equal windows have equal
   anchors; about one word in eight is one. Only anchors that occur in two different texts, or twice in one, are followed.
   Whole copies of a text need no parse: all windows of all but the first are duplicates.
 * Local blocks. The documents that a task reads together are a reference block of their own: repeats inside it are
   resolved there, so that each window leaves a task once. That also bounds hot windows by the number of tasks.
The windows left are dealt by hash; in each resulting block the first occurrence by (doc_id, start) is the source of the rest.

Windows are compared by 96 bits of hash, texts by 128. Null doc_ids come last in the order; rows of equal doc_id and equal text are one
document, rows of equal doc_id and different texts are ordered by a hash of the text. Null, empty and short texts have no windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recengine.llm.common import MIX_B, Scratch, batches_of, finish, list_array, ngram_hashes, signed, table, utf8, word_hashes

WINDOW = 20
ANCHOR = 6
#: Windows that a task resolves together before it passes them on.
BLOCK_WINDOWS = 1_000_000
LAST = 2 ** 63 - 1


def sliding(f, x: np.ndarray, width: int) -> np.ndarray:
    """f (minimum or maximum) of each run of ``width`` values, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x, have = f(x[:-step], x[step:]), have + step
    return x


def anchors(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ANCHOR words, the least one of each window, and which runs are some window's anchor."""
    size = min(ANCHOR, window)
    runs, width = ngram_hashes(words, size), window - size + 1
    least = sliding(np.minimum, runs, width)
    pad = np.zeros(width - 1, np.uint64)
    best = sliding(np.maximum, np.concatenate([pad, least, pad]), width)
    return runs, least, best == runs


def window_keys(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes (64 and 32 bits) of every window."""
    a = ngram_hashes(words, window)
    b = ngram_hashes(finish(words ^ MIX_B), window)
    return a, (b >> np.uint64(32)).astype(np.uint32)


def anchor_rows(docs: DataFrame, window: int) -> DataFrame:
    """(row, d, k1, k2, doc_id, n_words, whole_sha256, a, p, twice): each text's anchors with their places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for b in batches_of(batches, 1000):
            n, sha, a, p, twice = [], [], [], [], []
            for text in utf8(b["text"]):
                words = text.split()
                n.append(len(words))
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
                at, runs = np.empty(0, np.int64), np.empty(0, np.uint64)
                if len(words) >= window:
                    runs, _, chosen = anchors(word_hashes(words), window)
                    at = np.flatnonzero(chosen)
                hashes, inverse, count = np.unique(runs[at], return_inverse=True, return_counts=True)
                a.append(signed(runs[at]))
                p.append(at)
                twice.append(count[inverse] > 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + len(n))), b["d"], b["k1"], b["k2"], b["doc_id"], pa.array(n, pa.int64()), pa.array(sha),
                 list_array(a, pa.int64()), list_array(p, pa.int32()), list_array(twice, pa.bool_())],
                names=["row", "d", "k1", "k2", "doc_id", "n_words", "whole_sha256", "a", "p", "twice"])
            row += len(n)

    return docs.mapInArrow(run, "row long, d long, k1 long, k2 long, doc_id long, n_words long, whole_sha256 string, "
                                "a array<long>, p array<int>, twice array<boolean>")


def candidate_windows(texts: DataFrame, window: int) -> DataFrame:
    """From (row, d, text, p): the windows with a followed anchor, resolved inside the block that the task reads.

    Returns (row, d, text, starts, h, c) of the windows still open, and (at, src_doc, src_start) of those resolved.
    """
    def flush(rows: list[tuple]) -> pa.RecordBatch:
        rows.sort(key=lambda r: (r[1], r[0]))
        size = [len(r[3]) for r in rows]
        doc = np.repeat(np.arange(len(rows)), size)
        start, h, c = (np.concatenate([r[i] for r in rows]) for i in (3, 4, 5))
        order = np.lexsort((start, doc, c, h))
        same = np.concatenate([[False], (h[order][1:] == h[order][:-1]) & (c[order][1:] == c[order][:-1])])
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
        source = np.empty(len(order), np.int64)  # the block's first window with the same words
        source[order] = order[head]
        again = np.zeros(len(order), bool)
        again[order] = same
        d = np.array([r[1] for r in rows], np.int64)
        edge = np.cumsum([0, *size])
        part = lambda x, keep: [x[i:j][keep[i:j]] for i, j in zip(edge[:-1], edge[1:])]
        lists = [list_array(part(x, k), t) for x, k, t in (
            (start, ~again, pa.int32()), (signed(h), ~again, pa.int64()), (c.view(np.int32), ~again, pa.int32()),
            (start, again, pa.int32()), (d[doc[source]], again, pa.int64()), (start[source], again, pa.int32()))]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array(d),
                                           pa.array([r[2] for r in rows], pa.binary()), *lists],
                                          names=["row", "d", "text", "starts", "h", "c", "at", "src_doc", "src_start"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for b in batches_of(batches, 500):
            for row, d, text, p in zip(b["row"].to_pylist(), b["d"].to_pylist(), utf8(b["text"]), b["p"]):
                words = word_hashes(text.split())
                runs, least, _ = anchors(words, window)
                followed = np.full(len(runs), 2 ** 64 - 1, np.uint64)
                at = p.values.to_numpy()
                followed[at] = runs[at]
                start = np.flatnonzero(sliding(np.minimum, followed, window - min(ANCHOR, window) + 1) == least)
                h, c = window_keys(words, window)
                rows.append((row, d, text, start, h[start], c[start]))
                held += len(start)
                if held >= BLOCK_WINDOWS:
                    yield flush(rows)
                    rows, held = [], 0
        if rows:
            yield flush(rows)

    return texts.mapInArrow(run, "row long, d long, text binary, starts array<int>, h array<long>, c array<int>, "
                                 "at array<int>, src_doc array<long>, src_start array<int>")


def parse(found: DataFrame, window: int) -> DataFrame:
    """(row, n_removed, factors, kept): from (row, text, hits), hits being (start, src_doc, src_start) of duplicate windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(batches, 300):
            out = {"row": b["row"], "n_removed": [], "start": [], "words": [], "src_doc": [], "src_start": [], "kept": []}
            for text, hits in zip(b["text"].to_pylist(), b["hits"]):
                words = text.split()
                hit = hits.values
                at, doc, src = (hit.field(k).to_numpy() for k in ("start", "src_doc", "src_start"))
                order = np.argsort(at, kind="stable")
                at, doc, src = at[order].astype(np.int64), doc[order], src[order].astype(np.int64)
                depth = np.zeros(len(words) + 1, np.int64)
                depth[at] += 1
                depth[at + window] -= 1
                gone = np.cumsum(depth[:-1]) > 0
                # a factor goes on while window and source both move by one
                new = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(src) != 1) | (np.diff(doc) != 0)])[:len(at)]
                first = np.flatnonzero(new)
                last = np.concatenate([first[1:], [len(at)]])[:len(first)] - 1
                out["n_removed"].append(int(gone.sum()))
                out["start"].append(at[first])
                out["words"].append(at[last] - at[first] + window)
                out["src_doc"].append(doc[first])
                out["src_start"].append(src[first])
                out["kept"].append(b" ".join(w for w, g in zip(words, gone.tolist()) if not g).decode())
            factors = pa.StructArray.from_arrays(
                [list_array(out[k], pa.int64()).flatten() for k in ("start", "words", "src_doc", "src_start")],
                names=["start", "words", "src_doc", "src_start"])
            offsets = pa.array(np.cumsum([0, *map(len, out["start"])]), pa.int32())
            yield pa.RecordBatch.from_arrays([out["row"], pa.array(out["n_removed"], pa.int64()),
                                              pa.ListArray.from_arrays(offsets, factors), pa.array(out["kept"], pa.string())],
                                             names=["row", "n_removed", "factors", "kept"])

    return found.mapInArrow(run, "row long, n_removed long, factors array<struct<start: long, words: long, src_doc: long, "
                                 "src_start: long>>, kept string")


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(documents, parses): documents is (row, doc_id, n_words, whole_sha256, copy) for every row of ``docs``, copy meaning that an
    earlier document has the same text; parses is (row, n_removed, factors, kept) for the documents that lose words, other
    than copies. Factor positions count words; src_doc is 2^63 - 1 for a null doc_id."""
    scratch = Scratch(docs.sparkSession, "substring")
    d = docs.select("text", F.col("doc_id").cast("long").alias("doc_id")).withColumns({
        "d": F.coalesce("doc_id", F.lit(LAST)), "k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(1), "text")})
    rows = scratch.save(anchor_rows(d, window), "rows")
    firsts = rows.groupBy("k1", "k2").agg(F.min("d").alias("first"))
    head = scratch.save(rows.join(firsts, ["k1", "k2"]).select(
        "row", "d", "k1", "k2", "doc_id", "n_words", "whole_sha256", (F.col("first") < F.col("d")).alias("copy")), "head")
    a = rows.select("k1", F.explode(F.arrays_zip("a", "twice")).alias("x")).select("k1", "x.a", "x.twice")
    followed = a.groupBy("a").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi"), F.max("twice").alias("twice")
                                  ).where("lo < hi or twice").select("a")
    at = rows.select("row", F.explode(F.arrays_zip("a", "p")).alias("x")).select("row", "x.a", "x.p")
    places = at.join(followed, "a", "left_semi").groupBy("row").agg(F.collect_list("p").alias("p"))
    # one row for each distinct text that is the first of its kind
    one = places.join(head.where(~F.col("copy")).select("row", "d", "k1", "k2"), "row")
    one = scratch.save(one.groupBy("d", "k1", "k2").agg(F.min_by(F.struct("row", "p"), "row").alias("x")).select(
        "d", "k1", "k2", "x.row", "x.p"), "places")
    scratch.drop("rows")
    # equal rows count once; the join has already brought them together
    texts = d.select("d", "k1", "k2", "text").join(one, ["d", "k1", "k2"]).dropDuplicates(["d", "k1", "k2"])
    open_ = scratch.save(candidate_windows(texts.select("row", "d", "text", "p"), window), "windows")
    w = open_.select("row", "d", F.explode(F.arrays_zip("h", "c", "starts")).alias("x")).select(
        "row", "d", "x.h", "x.c", F.col("x.starts").alias("start"))
    order = Window.partitionBy("h", "c").orderBy("d", "row", "start")
    w = w.withColumns({"n": F.row_number().over(order), "src_doc": F.first("d").over(order), "src_start": F.first("start").over(order)})
    hits = w.where("n > 1").groupBy("row").agg(F.collect_list(F.struct("start", "src_doc", "src_start")).alias("far"))
    near = F.transform(F.arrays_zip("at", "src_doc", "src_start"), lambda x: F.struct(
        x["at"].alias("start"), x["src_doc"].alias("src_doc"), x["src_start"].alias("src_start")))
    found = open_.select("row", "text", near.alias("near")).join(hits, "row", "left").select(
        "row", "text", F.concat("near", F.coalesce("far", F.filter("near", lambda x: F.lit(False)))).alias("hits"))
    parses = scratch.save(parse(found.where(F.size("hits") > 0), window), "parses")
    scratch.drop("windows")
    # equal rows of one document share its parse
    lead = head.where(~F.col("copy")).join(one.select("d", "k1", "k2", F.col("row").alias("lead")), ["d", "k1", "k2"], "left")
    named = lead.select("row", F.coalesce("lead", "row").alias("lead"))
    documents = head.join(named, "row", "left").select("row", "doc_id", "n_words", "whole_sha256", "copy",
                                                       F.coalesce("lead", "row").alias("lead"))
    return documents, parses.withColumnRenamed("row", "lead")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, parses = substring_dedup(table(spark, sf_dir, "documents"))
    gone = F.col("copy") & (F.col("n_words") >= WINDOW)
    return documents.join(parses.drop("factors"), "lead", "left").select(
        "doc_id", "n_words",
        F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce(F.sha2("kept", 256), "whole_sha256")).alias("kept_sha256"))


OP7_SQL = f"""
with d as (select doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) as w from documents),
 s as (select doc_id, w, unnest(generate_series(1, len(w) - {WINDOW - 1})) as i from d where len(w) >= {WINDOW}),
 h as (select doc_id, i, row_number() over (partition by md5(array_to_string(w[i:i + {WINDOW - 1}], ' ')) order by doc_id, i) as n from s),
 g as (select distinct doc_id, unnest(generate_series(i, i + {WINDOW - 1})) as i from h where n > 1),
 r as (select doc_id, list(i) as gone, count(*) as n from g group by doc_id)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(r.n, 0)::bigint as n_removed,
  sha256(array_to_string([d.w[k] for k in generate_series(1, len(d.w)) if r.gone is null or not list_contains(r.gone, k)], ' ')) as kept_sha256
from d left join r using (doc_id)
"""
