"""N-gram Jaccard join (operator 2): size-banded tiles, hashed bitmap signatures, exact intersection.

A document's set holds the 64-bit hashes of its distinct n-word shingles. Documents with equal sets form a class, named by
a hash of the set, so copies cost nothing further. Two sets link when 100 * intersection >= percent * union.

Candidates, without loss. Linked sets differ in at most k = (100 - p) / (100 + p) * (|A| + |B|) elements, and their sizes are
at most a factor 100/p apart. Sizes fall into bands of that ratio; a tile holds two neighbouring bands, so each link lies inside a tile. A
tile cuts the hash space into k + 1 ranges, k taken for the largest sizes of its pairs: two linked sets agree in a whole range. The
sums of the elements of each range are the tile's signatures (at 90 %, about one per ten shingles), and only sets that share one
are compared.

Comparisons, without all pairs of a group. Each member of a signature's group is compared with one center of the group: first
inside the chunk of documents that a task reads, whose first holder alone passes the signature on (so that a group reaches
the shuffle as at most one row per chunk, copies not at all), then among these. Groups that the links leave in several
components are resolved in blocks (``link_blocks``). In each step, bit counts of the hashed bitmaps bound
the overlap from above, |A and B| <= |A| - popcount(a & ~b), and only pairs that may still link are confirmed by the exact intersection of the
sorted arrays: pairs of a member and its center by a join with the sets, which are made again from one text of each class, others inside the blocks.
Joins are left to the adaptive skew split, and a group is never held by one task: its blocks are.

What this proves is each document's component: pairs inside one component are not all verified, but no link between
components is missed. (Two different shingles, or sets, with equal 64-bit hashes would count as equal.)

Null texts and texts without words have an empty set and link with nothing. A text of fewer words than n has its whole
sequence as its one shingle. Null doc_ids take part, but are never a component's id (unless the component has no other).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from recengine.llm.common import MIX_A, Scratch, batches_of, finish, list_array, lower_words, ngram_hashes, signed, table, utf8, word_hashes
from recengine.llm.link_blocks import SALTS, Comparer, class_ids, resolve

SHINGLE = 3
PERCENT = 90
#: Bits of a bitmap per shingle, and its least and greatest number of 64-bit words.
BITS_PER_SHINGLE, LEAST_WORDS, MOST_WORDS = 8, 2, 1024
#: Each round of blocks takes one of so many shares of the groups.
ROUNDS = 16
LAST = 2 ** 63 - 1
#: Signatures of the documents that a task resolves together.
CHUNK_SIGNATURES = 500_000
#: Tasks a core that write an intermediate table, at most (see Scratch).
WAVES = 4


def shingle_set(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = word_hashes(lower_words(text))
    if len(words) == 0:
        return words
    return np.unique(ngram_hashes(words, min(n, len(words))))


def set_key(s: np.ndarray) -> int:
    return xxh3_64_intdigest(s.tobytes())


class Tiles:
    """Size bands and the number of hash ranges of each tile, for one threshold."""

    def __init__(self, percent: int):
        self.percent, self.ratio = percent, 100 / percent * (1 + 1e-9)
        self.edges = [1]  # band b holds the sizes edges[b] <= n < edges[b + 1]

    def band(self, n: int) -> int:
        while self.edges[-1] <= n:
            # the next band starts beyond every size that can link with this band's least
            self.edges.append(max(self.edges[-1] + 1, math.floor(self.edges[-1] * self.ratio) + 1))
        return int(np.searchsorted(self.edges, n, "right")) - 1

    def ranges(self, tile: int) -> int:
        """Tile t compares the sets of band t with each other and with band t + 1: one range more than two linked ones of
        these can differ in."""
        while tile + 2 >= len(self.edges):
            self.band(self.edges[-1])
        both = self.edges[tile + 1] + self.edges[tile + 2] - 2
        return (100 - self.percent) * both // (100 + self.percent) + 1

    def signatures(self, s: np.ndarray) -> np.ndarray:
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(finish(s), dtype=np.uint64)])
        band, out = self.band(len(s)), []
        for tile in (band - 1, band):
            p = self.ranges(tile)
            ends = (np.arange(1, p, dtype=np.float64) * (2.0 ** 64 / p)).astype(np.uint64)
            cut = np.concatenate([[0], np.searchsorted(s, ends), [len(s)]])
            place = np.arange(p, dtype=np.uint64) + np.uint64((tile + 2) << 32)
            out.append(finish((sums[cut[1:]] - sums[cut[:-1]]) * MIX_A + finish(place)))
        return np.concatenate(out)


def signature_rows(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, cls, sigs, also, centers, bits) per row of ``docs``.

    cls: the class of the document's set (null when empty). sigs: the class's signatures that no earlier class of the
    chunk has; also: those that an earlier one has, centers: that class; bits: the bitmap. Further rows of a class in the
    chunk have none of these.
    """
    def flush(rows: list[tuple]) -> pa.RecordBatch:
        classes: dict[int, int] = {}
        for i, r in enumerate(rows):
            if r[3] is not None:
                classes.setdefault(r[3], i)
        none = np.empty(0, np.uint64)
        lists = [r[4] if r[3] is not None and classes[r[3]] == i else none for i, r in enumerate(rows)]
        flat = np.concatenate(lists)
        owner = np.repeat(np.arange(len(rows)), [len(x) for x in lists])
        _, first, inverse = np.unique(flat, return_index=True, return_inverse=True)
        holder = owner[first][inverse]
        own = holder == owner
        cls = np.array([0 if r[3] is None else r[3] for r in rows], np.uint64)
        edge = np.cumsum([0, *map(len, lists)])
        part = lambda x, keep: [signed(x[a:b][keep[a:b]]) for a, b in zip(edge[:-1], edge[1:])]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
             pa.array([r[3] for r in rows], pa.uint64()).view(pa.int64()),
             *(list_array(part(x, k), pa.int64()) for x, k in ((flat, own), (flat, ~own), (cls[holder], ~own))),
             pa.array([r[5] if r[3] is not None and classes[r[3]] == i else None for i, r in enumerate(rows)], pa.binary())],
            names=["doc_id", "text_key", "n_shingles", "cls", "sigs", "also", "centers", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles, rows, held = Tiles(percent), [], 0
        for b in batches_of(batches, 1000):
            for doc_id, key, text in zip(b["doc_id"].to_pylist(), b["text_key"].to_pylist(), utf8(b["text"])):
                s = shingle_set(text, n)
                sigs = tiles.signatures(s) if len(s) else np.empty(0, np.uint64)
                rows.append((doc_id, key, len(s), set_key(s) if len(s) else None, sigs, bitmap(s).tobytes() if len(s) else None))
                held += len(sigs)
                if held >= CHUNK_SIGNATURES:
                    yield flush(rows)
                    rows, held = [], 0
        if rows:
            yield flush(rows)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        run, "doc_id long, text_key long, n_shingles long, cls long, sigs array<long>, also array<long>, centers array<long>, "
             "bits binary")


def bitmap(s: np.ndarray) -> np.ndarray:
    """Bits at hash mod size; sizes are powers of two, so that a bitmap folds onto a smaller one."""
    words = min(MOST_WORDS, max(LEAST_WORDS, 1 << max(0, (len(s) * BITS_PER_SHINGLE // 64 - 1)).bit_length()))
    bits = np.zeros(words * 64, np.uint8)
    bits[s % np.uint64(words * 64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    return bits if len(bits) == words else np.bitwise_or.reduce(bits.reshape(-1, words), axis=0)


def overlap_bound(n_a, n_b, a, b):
    """Upper bounds of intersections from sizes and bitmaps of one size (the last axis is the bitmap's)."""
    only_a = np.bitwise_count(a & ~b).sum(-1, dtype=np.int64)
    only_b = np.bitwise_count(b & ~a).sum(-1, dtype=np.int64)
    return np.minimum(n_a - only_a, n_b - only_b)


def links(overlap, n_a, n_b, percent):
    return 100 * overlap >= percent * (n_a + n_b - overlap)


def may_link(pairs: DataFrame, info: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose bit counts allow a link. info: (cls, n, bits)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            keep = []
            for n_a, n_b, a, b in zip(*(rows[c].to_pylist() for c in ("n_a", "n_b", "bits_a", "bits_b"))):
                words = min(len(a), len(b)) // 8
                x, y = (folded(np.frombuffer(v, np.uint64), words) for v in (a, b))
                keep.append(bool(links(overlap_bound(n_a, n_b, x, y), n_a, n_b, percent)))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([rows["a"].filter(keep), rows["b"].filter(keep)], names=["a", "b"])

    side = lambda k: info.select(F.col("cls").alias(k), F.col("n").alias(f"n_{k}"), F.col("bits").alias(f"bits_{k}"))
    # sizes alone rule out some
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(
        (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")))
    return both.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, "a long, b long")


def first_texts(slim: DataFrame, classes: DataFrame) -> DataFrame:
    """(d, text_key, cls): one text of each of ``classes``."""
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("d"), "text_key")).alias("f")
    return slim.join(classes, "cls").groupBy("cls").agg(first).select("f.d", "f.text_key", "cls")


def class_sets(docs: DataFrame, firsts: DataFrame, n: int) -> DataFrame:
    """(cls, members) of classes, from one text of each. firsts: (d, text_key, cls)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(batches, 500):
            yield pa.RecordBatch.from_arrays([b["cls"], pa.array([shingle_set(x, n).tobytes() for x in utf8(b["text"])], pa.binary())],
                                             names=["cls", "members"])

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("d"), F.xxhash64("text").alias("text_key"), "text")
    # equal rows count once; the join has already brought them together
    rows = rows.join(firsts, ["d", "text_key"]).dropDuplicates(["d", "text_key"])
    return rows.select("cls", "text").mapInArrow(run, "cls long, members binary")


def verified(pairs: DataFrame, docs: DataFrame, slim: DataFrame, n: int, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """The pairs (a, b) of classes that link, by the exact intersection of sorted arrays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches_of(batches, 256):
            keep = []
            for x, y in zip(rows["members_a"], rows["members_b"]):
                a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                keep.append(bool(links(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b), percent)))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([rows["a"].filter(keep), rows["b"].filter(keep)], names=["a", "b"])

    classes = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    sets = scratch.save(class_sets(docs, first_texts(slim, classes), n), f"{name}-sets")
    side = lambda k: sets.select(F.col("cls").alias(k), F.col("members").alias(f"members_{k}"))
    out = scratch.save(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "members_a", "members_b")
                       .mapInArrow(run, "a long, b long"), name)
    scratch.drop(f"{name}-sets")
    return out


def coarser(info: DataFrame) -> DataFrame:
    """(cls, n, signature): the bitmaps of (cls, n, bits) folded to an eighth of their size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            maps = (np.frombuffer(x, np.uint64) for x in b["bits"].to_pylist())
            small = [folded(x, max(LEAST_WORDS, len(x) // 8)).tobytes() for x in maps]
            yield pa.RecordBatch.from_arrays([b["cls"], b["n"], pa.array(small, pa.binary())], names=["cls", "n", "signature"])

    return info.select("cls", "n", "bits").mapInArrow(run, "cls long, n long, signature binary")


class Bitmaps(Comparer):
    """Bounds of the overlap from hashed bitmaps."""

    def __init__(self, percent: int):
        self.percent = percent

    def matrix(self, signatures):
        maps = [np.frombuffer(x, np.uint64) for x in signatures]
        words = min(map(len, maps))
        return (np.array([folded(x, words) for x in maps]),)

    def scores(self, key, n_x, x, n, m):
        bound = overlap_bound(n, n_x, m[0], x[0])
        return np.where(links(bound, n, n_x, self.percent), bound, -1)


def ngram_join(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_key, n_shingles, cls, component, component_id) per row of ``docs``.

    text_key is a hash of the text; component a class of the document's component (null for an empty set).
    """
    scratch = Scratch(docs.sparkSession, "ngram", WAVES)
    rows = scratch.save(signature_rows(docs, n, percent), "rows")
    passed = rows.select("cls", F.explode("sigs").alias("sig"))
    order = Window.partitionBy("sig").orderBy("cls")  # at most one row per chunk in a group
    far = passed.withColumns({"i": F.row_number().over(order), "center": F.first("cls").over(order)}).where("i > 1 and cls <> center")
    near = rows.select("cls", F.explode(F.arrays_zip("also", "centers")).alias("x")).select(
        F.col("x.also").alias("sig"), "cls", F.col("x.centers").alias("center"))
    twins = scratch.save(far.select("sig", "cls", "center").unionByName(near), "twins")
    tested = scratch.save(twins.select(F.least("cls", "center").alias("a"), F.greatest("cls", "center").alias("b")).distinct(), "stars")
    classes = scratch.save(tested.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), "classes")
    slim = scratch.save(rows.select("doc_id", "text_key", "n_shingles", "cls"), "slim")
    info = scratch.save(rows.where("bits is not null").select("cls", F.col("n_shingles").alias("n"), "bits")
                        .join(classes, "cls", "left_semi").dropDuplicates(["cls"]), "info")
    scratch.drop("rows", "classes")
    # small bitmaps first: a task holds those of thousands of pairs at once
    coarse = scratch.save(coarser(info), "coarse")
    maybe = scratch.save(may_link(tested, coarse.withColumnRenamed("signature", "bits"), percent), "maybe")
    hopeful = scratch.save(may_link(maybe, info, percent), "hopeful")
    found = verified(hopeful, docs, slim, n, percent, scratch, "links")
    scratch.drop("stars", "maybe", "hopeful")
    # a group's ranges take turns in the rounds
    rounds = [F.pmod(F.xxhash64("key"), F.lit(ROUNDS)) == k for k in range(ROUNDS)]
    parts = resolve(scratch, twins.withColumnRenamed("sig", "key"), info.withColumnRenamed("bits", "signature"), found,
                    lambda c: class_sets(docs, first_texts(slim, c), n), Bitmaps(percent), rounds, coarse)
    ids = scratch.save(class_ids(slim, parts), "ids")
    scratch.drop(*[name for name in scratch.paths if name not in ("slim", "ids")])
    return slim.join(ids, "cls", "left").select(
        "doc_id", "text_key", "n_shingles", "cls", "component", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row of least doc_id (nulls last, then by a hash of
    the text) stays, once. Documents with an empty set all stay."""
    scratch = Scratch(docs.sparkSession, "ngram-keep", WAVES)
    # the row goes along as one value, so that its columns' names don't matter
    d = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = scratch.save(ngram_join(docs, n, percent).where("component is not null").select("component", "doc_id", "text_key"), "joined")
    last = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_key"))
    kept = joined.groupBy("component").agg(F.min_by(F.struct("doc_id", "text_key"), last).alias("k"), F.count("*").alias("rows"))
    # rows of a component meet its kept row in SALTS places
    kept = kept.where("rows > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = joined.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(SALTS)).cast("int"))
    gone = salted.join(kept, ["component", "salt"]).where(
        ~(F.col("doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("text_key") == F.col("k.text_key"))))
    gone = gone.select(F.col("doc_id").alias("g"), F.col("text_key").alias("h")).distinct()
    # ids of repeated rows: equal rows are one document and stay once
    again = joined.groupBy(F.col("doc_id").alias("g"), F.col("text_key").alias("h")).agg(F.count("*").alias("rows")).where("rows > 1").drop("rows")
    same = F.col("id").eqNullSafe(F.col("g")) & (F.col("key") == F.col("h"))
    rest = d.join(gone, same, "left_anti")
    if not again.isEmpty():
        once = rest.join(again, same, "left_semi").dropDuplicates(["id", "key"])
        rest = rest.join(again, same, "left_anti").unionByName(once)
    return rest.select("row.*")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


OP2_SQL = """
with recursive d as (select doc_id, coalesce(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), []) as w from documents),
 s as (select doc_id, list_distinct([array_to_string(w[i:i + 2], ' ') for i in generate_series(1, greatest(1, len(w) - 2))]) as g
       from d where len(w) > 0),
 n as (select doc_id, len(g) as n from s),
 e as (select doc_id, unnest(g) as g from s),
 p as (select a.doc_id as a, b.doc_id as b, count(*) as shared from e a join e b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
 l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * shared >= 90 * (x.n + y.n - shared)),
 u as (select a, b from l union select b, a from l),
 r as (select doc_id as node, doc_id as root from d union select u.b, r.root from r join u on u.a = r.node)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, c.root as component_id
from d left join n using (doc_id) join (select node, min(root) as root from r group by node) c on c.node = d.doc_id
"""
