"""Benchmark decontamination (operator 5): an FM-index per training shard, searched for benchmark windows.

Each task reads its documents in shards. A shard's text is the sequence of its words, numbered by the benchmark's
vocabulary. A window can only occur inside a run of vocabulary words at least as long as the shortest phrase, so only
such runs enter the index, each closed by a separator of its own; nothing that could match is left out. Over this text the
shard builds a suffix array, the Burrows-Wheeler transform with its ranks in a wavelet matrix, and suffix positions
sampled every SAMPLE symbols and at run starts. All windows are searched backwards at once; their occurrences are located
by walking back to sampled suffixes, and become removal spans that are merged per document.

The benchmark goes to the tasks in blocks of at most ``block_chars`` characters (items dealt by a hash of the item id, an
item always whole); with several blocks the documents are scanned once per block and the spans merged by document. So
no broadcast grows with the benchmark. Documents are never shuffled in the one-block case.

Words: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A window is 10 consecutive words of an item; a
shorter item that has a word is one window. Null or empty texts, and texts without words, have no words and no windows. Items with
equal item_id count once. Null item ids match and are hit, but are not listed. An empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from xxhash import xxh3_64_intdigest

from recengine.llm.common import Scratch, batches_of, list_array, signed, table, utf8

WINDOW = 10
#: Symbols in one shard's index, and words of text read for it (a longer document is a shard of its own).
SHARD_SYMBOLS = 400_000
SHARD_WORDS = 2_000_000
SAMPLE = 8
BLOCK_CHARS = 1 << 20

_KEEP = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
#: A-Z to a-z, everything that is no word character to a blank.
FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _KEEP else 32 for c in range(256))


def item_words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class WaveletMatrix:
    """Ranks of symbols in a sequence, for many queries at once."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels = max(1, int(n_symbols - 1).bit_length())
        self.ones, self.zeros, s = [], [], symbols
        for level in reversed(range(self.levels)):
            bit = (s >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(len(s) - int(self.ones[-1][-1]))
            s = np.concatenate([s[bit == 0], s[bit == 1]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before position i."""
        start, i = np.zeros(len(i), np.int64), i.astype(np.int64)
        for k, level in enumerate(reversed(range(self.levels))):
            up = (symbol >> level) & 1 == 1
            ones = self.ones[k]
            start = np.where(up, self.zeros[k] + ones[start], start - ones[start])
            i = np.where(up, self.zeros[k] + ones[i], i - ones[i])
        return i - start


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in sorted order, by prefix doubling; equal symbols at the end sort shorter first."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64) + 1
    k = 1
    while True:
        second = np.zeros(n, np.int64)
        second[:n - k] = rank[k:] if k < n else []
        key = rank * (n + 2) + second
        order = np.argsort(key, kind="stable")
        step = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = step + 1
        if n == 0 or step[-1] == n - 1:
            return order
        k *= 2


class FMIndex:
    """Backward search in a text of symbols; 0 is the separator and is never searched.

    Separators sort by position, as if all were different, so no comparison of suffixes passes one.
    """

    def __init__(self, text: np.ndarray, n_symbols: int):
        self.n = len(text)
        gaps = text == 0
        order = suffix_array(np.where(gaps, np.cumsum(gaps) - 1, text + int(gaps.sum()) - 1))
        before = text[order - 1]
        before[order == 0] = 0
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])
        self.bwt, self.ranks = before, WaveletMatrix(before, n_symbols)
        at_start = np.concatenate([[True], gaps[:-1]])
        sampled = at_start | (np.arange(self.n) % SAMPLE == 0)
        self.marked = sampled[order]
        self.mark_rank = np.cumsum(self.marked) - 1
        self.samples = order[self.marked]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals [lo, hi) of patterns, given as rows that end at the last column."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        width = patterns.shape[1]
        for j in range(width):
            live = np.nonzero((lengths > j) & (lo < hi))[0]
            c = patterns[live, width - 1 - j]
            lo[live] = self.below[c] + self.ranks.rank(c, lo[live])
            hi[live] = self.below[c] + self.ranks.rank(c, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, by steps back to a sampled suffix."""
        steps, row = np.zeros(len(rows), np.int64), rows.copy()
        open_ = np.nonzero(~self.marked[row])[0]
        while len(open_):
            c = self.bwt[row[open_]]
            row[open_] = self.below[c] + self.ranks.rank(c, row[open_])
            steps[open_] += 1
            open_ = open_[~self.marked[row[open_]]]
        return self.samples[self.mark_rank[row]] + steps


class Phrases:
    """The windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[int | None]] = {}
        for item, text in items:
            words = item_words((text or "").encode())
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(tuple(ids[i:i + window]), set()).add(item)
        self.items = [sorted(x for x in s if x is not None) for s in found.values()]
        self.lengths = np.array([len(p) for p in found], np.int64)
        self.patterns = np.zeros((len(found), window), np.int64)
        for row, p in zip(self.patterns, found):
            row[window - len(p):] = p
        self.shortest = int(self.lengths.min()) if found else 0


def search_shard(docs: list[np.ndarray], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences (document, first word, phrase) in documents given as vocabulary numbers (0: other words)."""
    none = np.empty(0, np.int64)
    flat = np.concatenate([np.append(d, 0) for d in docs])  # a gap ends each document
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (flat > 0).view(np.int8), [0]])))
    start, end = edge[::2], edge[1::2]
    long = end - start >= phrases.shortest
    start, size = start[long], (end - start)[long]
    if not len(start):
        return none, none, none
    # position in flat of each symbol of the indexed text; a run's closing symbol is the gap behind it
    places = np.repeat(start - (np.cumsum(size + 1) - (size + 1)), size + 1) + np.arange(int((size + 1).sum()))
    index = FMIndex(flat[places].astype(np.int64), len(phrases.vocabulary) + 1)
    lo, hi = index.search(phrases.patterns, phrases.lengths)
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    rows = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    at = places[index.locate(rows)]
    first = np.concatenate([[0], np.cumsum([len(d) + 1 for d in docs])])
    doc = np.searchsorted(first, at, "right") - 1
    return doc, at - first[doc], which


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unions overlapping and touching spans [start, end)."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    return start[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(start) - 1]])]


SPANS = "text_key long, n_words long, starts array<long>, ends array<long>, items array<long>"


def _scan(docs: DataFrame, phrases: Phrases) -> DataFrame:
    """Adds the spans hit by a block of phrases to (doc_id, row) rows."""
    def flush(ids, keys, shard):
        n = np.array([len(d) for d in shard], np.int64)
        doc, start, which = search_shard(shard, phrases) if phrases.shortest else [np.empty(0, np.int64)] * 3
        order = np.argsort(doc, kind="stable")
        doc, start, which = doc[order], start[order], which[order]
        cut = np.searchsorted(doc, np.arange(len(shard) + 1))
        starts, ends, items = [], [], []
        empty = np.empty(0, np.int64)
        for a, b in zip(cut[:-1], cut[1:]):
            s, e = merged(start[a:b], start[a:b] + phrases.lengths[which[a:b]]) if b > a else (empty, empty)
            starts.append(s)
            ends.append(e)
            items.append(np.array(sorted({i for w in set(which[a:b].tolist()) for i in phrases.items[w]}), np.int64))
        lists = [list_array(x, pa.int64()) for x in (starts, ends, items)]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(signed(np.array(keys, np.uint64))),
                                           pa.array(n), *lists],
                                          names=["doc_id", "text_key", "n_words", "starts", "ends", "items"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = phrases.vocabulary.get
        ids, keys, shard, words, symbols = [], [], [], 0, 0
        for b in batches_of(batches, 500):
            for doc_id, text in zip(b["doc_id"].to_pylist(), utf8(b["text"])):
                w = item_words(text)
                d = np.fromiter((number(x, 0) for x in w), np.int32, len(w))
                ids.append(doc_id)
                keys.append(xxh3_64_intdigest(text))
                shard.append(d)
                words += len(w)
                symbols += int(np.count_nonzero(d))
                if words >= SHARD_WORDS or symbols >= SHARD_SYMBOLS:
                    yield flush(ids, keys, shard)
                    ids, keys, shard, words, symbols = [], [], [], 0, 0
        if ids:
            yield flush(ids, keys, shard)

    return docs.mapInArrow(run, "doc_id long, " + SPANS)


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, text_key, n_words, starts, ends, items) per row of ``docs``: merged word spans [start, end) to remove.

    text_key is a hash of the text; rows of equal doc_id are told apart by it.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scans = [_scan(d, phrases) for phrases in benchmark_blocks(benchmark, window, block_chars)]
    return scans[0] if len(scans) == 1 else _merge_blocks(scans)


def benchmark_blocks(benchmark: DataFrame, window: int, block_chars: int) -> Iterator[Phrases]:
    """The windows of the benchmark, about ``block_chars`` characters of items at a time."""
    b = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    chars = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    for k in range(blocks):
        yield Phrases([tuple(r) for r in b.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).collect()], window)


def _merge_blocks(scans: list[DataFrame]) -> DataFrame:
    """Merges the spans of several scans of the same documents; equal rows come back as often as they were."""
    scratch = Scratch(scans[0].sparkSession, "decontaminate")
    rows = scratch.save(scans[0], "block0").withColumn("once", F.lit(1))
    for k, scan in enumerate(scans[1:], 1):
        rows = rows.unionByName(scratch.save(scan.where(F.size("starts") > 0), f"block{k}").withColumn("once", F.lit(0)))
    spans = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.arrays_zip("starts", "ends")))))
    grouped = rows.groupBy("doc_id", "text_key").agg(
        F.max("n_words").alias("n_words"), spans.alias("spans"), F.sum("once").alias("times"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    grouped = grouped.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("time", "times")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = [merged(np.array([x["starts"] for x in r], np.int64), np.array([x["ends"] for x in r], np.int64))
                     for r in b["spans"].to_pylist()]
            lists = [list_array([p[i] for p in pairs], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["text_key"], b["n_words"], *lists, b["items"]],
                                             names=["doc_id", "text_key", "n_words", "starts", "ends", "items"])

    return grouped.mapInArrow(join, "doc_id long, " + SPANS)


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs``, with all columns, in which no benchmark window occurs; nothing is shuffled."""
    for phrases in benchmark_blocks(benchmark, window, block_chars):
        docs = _without_hits(docs, phrases)
    return docs


def _without_hits(docs: DataFrame, phrases: Phrases) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = phrases.vocabulary.get
        held, shard, words, symbols = [], [], 0, 0

        def flush():
            hit = np.zeros(len(shard), bool)
            if phrases.shortest:
                hit[search_shard(shard, phrases)[0]] = True
            at = 0
            for b in held:
                yield b.filter(pa.array(~hit[at:at + b.num_rows]))
                at += b.num_rows

        for b in batches_of(batches, 500):
            held.append(b)
            for text in utf8(b["text"]):
                w = item_words(text)
                shard.append(np.fromiter((number(x, 0) for x in w), np.int32, len(w)))
                words += len(w)
                symbols += int(np.count_nonzero(shard[-1]))
            if words >= SHARD_WORDS or symbols >= SHARD_SYMBOLS:
                yield from flush()
                held, shard, words, symbols = [], [], 0, 0
        if held:
            yield from flush()

    return docs.mapInArrow(run, docs.schema)


def hit_digest(hits: DataFrame) -> DataFrame:
    n_hit = F.aggregate(F.transform(F.arrays_zip("starts", "ends"), lambda s: s["ends"] - s["starts"]),
                        F.lit(0).cast("long"), lambda a, x: a + x)
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                       F.sha2(names, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hit_digest(benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

OP5_SQL = f"""
with d as (select doc_id, coalesce(regexp_extract_all({_LOWER}, '{_WORD}'), []) as w from documents),
 b as (select distinct item_id, coalesce(regexp_extract_all({_LOWER}, '{_WORD}'), []) as w from benchmark),
 p as (select distinct item_id, len(s) as n, array_to_string(s, ' ') as s from
       (select item_id, unnest([w[i:i + {WINDOW - 1}] for i in generate_series(1, greatest(1, len(w) - {WINDOW - 1}))]) as s
        from b where len(w) > 0)),
 n as (select distinct n from p),
 o as (select doc_id, n.n, unnest(generate_series(1, len(w) - n.n + 1)) as i from d, n where len(w) >= n.n),
 f as (select o.doc_id, o.i, o.n, p.item_id from o join d using (doc_id)
       join p on p.n = o.n and p.s = array_to_string(d.w[o.i:o.i + o.n - 1], ' ')),
 h as (select doc_id, count(distinct pos) as n_hit from (select doc_id, unnest(generate_series(i, i + n - 1)) as pos from f) group by doc_id),
 t as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as names from f group by doc_id)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(h.n_hit, 0)::bigint as n_hit, coalesce(t.n_items, 0)::bigint as n_items,
  sha256(coalesce(t.names, '')) as items_sha256, coalesce(h.n_hit, 0) > 0 as contaminated
from d left join h using (doc_id) left join t using (doc_id)
"""
