"""MinHash near-dedup (operator 11): signature-coordinate inverted join, matches counted with prefix and skip, links confirmed on full sets.

A document's set holds the 64-bit hashes of its distinct n-word shingles. Documents with equal sets form a class, so exact copies
cost nothing further. Two sets link when 100 * intersection >= percent * union.

Signatures. COORDINATES hash functions give each class a MinHash signature; two sets of similarity J agree in each coordinate with
probability J. The match threshold is the largest number of coordinates that two sets at the linking similarity miss with probability MISS.

Inverted join. A class is posted under each coordinate-value pair of the PREFIX: the first coordinates, as many as two sets that link miss all of
with probability MISS. Lists of one class end there. Inside the chunk of documents that a task reads, the first holder of a pair alone passes it on, the
others point to it, so that a list reaches the shuffle as at most one row per chunk. Each member is then compared with its list's first
class: matching coordinates are counted, and only pairs at the threshold or above are confirmed by the exact intersection of the sorted sets.

The rest, without all pairs of a list. Lists that lie in several components after that are resolved in blocks (``link_blocks``): signatures are compared
inside units of two blocks; a pair is skipped where an earlier coordinate of the prefix already put both in one list; pairs at the
threshold are confirmed inside the unit, and links that unite components come out, never pairs. What this proves is each
document's component: pairs inside one component are not all compared. A link is missed only if its signatures miss the threshold or the
prefix: less than 3 * MISS for each link, and only where no other path joins its ends.

Null texts and texts without words have an empty set and link with nothing; their component is their own id. A text of fewer words than n has its whole
sequence as its one shingle. Null doc_ids take part, but are never a component's id (unless the component has no other). Rows of
equal id or text are rows of their own. Only doc_id and text are read; other columns don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recengine.llm.common import Scratch, batches_of, finish, table, utf8
from recengine.llm.link_blocks import Comparer, class_ids, resolve
from recengine.llm.ngram_join import class_sets, first_texts, set_key, shingle_set, verified

SHINGLE, PERCENT = 5, 85
COORDINATES, MISS = 128, 1e-12
#: Coordinates, in 64-bit words of eight, that are compared first.
HEAD = 5
#: Postings that a task resolves together, and elements of a set that are hashed at once.
CHUNK_POSTINGS, PIECE = 500_000, 2048

#: Hash function c of an element is (element xor MASKS[c]) * FACTORS[c]; the elements are well-spread hashes already.
MASKS = finish(np.arange(1, COORDINATES + 1, dtype=np.uint64))
FACTORS = finish(np.arange(COORDINATES + 1, 2 * COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)


def prefix_length(percent: int, miss: float = MISS) -> int:
    """Coordinates of which two sets that link agree in one, but for a probability of ``miss``."""
    return next((p for p in range(1, COORDINATES) if (1 - percent / 100) ** p <= miss), COORDINATES)


def match_threshold(percent: int, miss: float = MISS, of: int = COORDINATES) -> int:
    """The largest number of matches among ``of`` coordinates that two sets that link reach, but for a probability of ``miss``."""
    p, below = percent / 100, 0.0
    for t in range(of):
        below += math.comb(of, t) * p ** t * (1 - p) ** (of - t)
        if below > miss:
            return t
    return of


def minima(s: np.ndarray) -> np.ndarray:
    """The least hash of a set under each function."""
    out = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), PIECE):
        np.minimum(out, ((s[i:i + PIECE, None] ^ MASKS) * FACTORS).min(0), out=out)
    return finish(out ^ MASKS)


def signature(values: np.ndarray, prefix: int) -> bytes:
    """32 bits of each coordinate of the prefix (those in the postings), 8 bits of all: equal values never differ there, and
    different ones agree by chance in 1 of 256, which can only add matches."""
    return (values[:prefix] >> np.uint64(32)).astype(np.uint32).tobytes() + values.astype(np.uint8).tobytes()


def postings(values: np.ndarray, prefix: int) -> np.ndarray:
    """Coordinate-value pairs of the prefix: the coordinate above 32 bits of the value."""
    return (np.arange(prefix, dtype=np.uint64) << np.uint64(32)) | (values[:prefix] >> np.uint64(32))


def equal_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal bytes of 64-bit words, added up along the last axis."""
    low = np.uint64(0x7F7F7F7F7F7F7F7F)
    v = a ^ b
    zero = ~(((v & low) + low) | v | low)  # the top bit of each zero byte
    return np.bitwise_count(zero).sum(-1, dtype=np.int64)


class Matches(Comparer):
    """Counts matching coordinates; a pair that shares an earlier coordinate of the prefix is left to that one's list."""

    def __init__(self, percent: int):
        self.percent, self.prefix, self.threshold = percent, prefix_length(percent), match_threshold(percent)
        self.head_threshold = match_threshold(percent, of=8 * HEAD)

    def matrix(self, signatures):
        """(values of the prefix, the first bytes of the coordinates, the others)."""
        rows = np.frombuffer(b"".join(signatures), np.uint8).reshape(len(signatures), -1)
        words = np.ascontiguousarray(rows[:, 4 * self.prefix:]).view(np.uint64)
        return (np.ascontiguousarray(rows[:, :4 * self.prefix]).view(np.uint32), np.ascontiguousarray(words[:, :HEAD]),
                np.ascontiguousarray(words[:, HEAD:]))

    def counts(self, a, b):
        """Matches of signatures (last two arrays of ``matrix``), row by row; -1 below the threshold. Few pairs get beyond the first coordinates."""
        out = equal_bytes(a[0], b[0])
        on = np.flatnonzero(out >= self.head_threshold)
        same = out[on] + equal_bytes(a[1][on], b[1] if b[1].ndim == 1 else b[1][on])
        out[:] = -1
        out[on] = np.where(same >= self.threshold, same, -1)
        return out

    def scores(self, key, n_x, x, n, m):
        score = self.counts(m[1:], x[1:])
        score[100 * np.minimum(n, n_x) < self.percent * np.maximum(n, n_x)] = -1
        on = np.flatnonzero(score >= 0)
        if len(on) and (before := key >> 32):
            score[on[(m[0][on, :before] == x[0][:before]).any(-1)]] = -1
        return score


def posting_rows(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, cls, keys, also, centers, signature) per row of ``docs``.

    keys: the class's coordinate-value pairs that no earlier class of the chunk has; also: those that an earlier one has, centers: that
    class. Further rows of a class in the chunk have neither these nor a signature."""
    prefix = prefix_length(percent)

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        first: dict[int, int] = {}
        parts = []
        for doc_id, key, size, cls, keys, sig in rows:
            keys = [] if keys is None else keys.tolist()
            own = [k for k in keys if first.setdefault(k, cls) == cls]
            also = [k for k in keys if first[k] != cls]
            parts.append((doc_id, key, size, cls, own, also, [first[k] for k in also], sig))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in parts], kind) for k, kind in enumerate(kinds)],
                                          names=["doc_id", "text_key", "n_shingles", "cls", "keys", "also", "centers", "signature"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, known, held = [], set(), 0
        for b in batches_of(batches, 1000):
            for doc_id, key, text in zip(b["doc_id"].to_pylist(), b["text_key"].to_pylist(), utf8(b["text"])):
                s = shingle_set(text, n)
                cls = int(np.uint64(set_key(s)).view(np.int64)) if len(s) else None
                if cls is None or cls in known:
                    rows.append((doc_id, key, len(s), cls, None, None))
                else:
                    known.add(cls)
                    values = minima(s)
                    rows.append((doc_id, key, len(s), cls, postings(values, prefix), signature(values, prefix)))
                held += prefix
                if held >= CHUNK_POSTINGS:
                    yield flush(rows)
                    rows, known, held = [], set(), 0
        if rows:
            yield flush(rows)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        run, "doc_id long, text_key long, n_shingles long, cls long, keys array<long>, also array<long>, centers array<long>, "
             "signature binary")


def at_threshold(pairs: DataFrame, info: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that match in enough coordinates. info: (cls, n, signature)."""
    comparer = Matches(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if rows.num_rows:
                a, b = (comparer.matrix(rows[c].to_pylist()) for c in ("signature_a", "signature_b"))
                keep = pa.array(comparer.counts(a[1:], b[1:]) >= 0)
                yield pa.RecordBatch.from_arrays([rows["a"].filter(keep), rows["b"].filter(keep)], names=["a", "b"])

    side = lambda k: info.select(F.col("cls").alias(k), F.col("n").alias(f"n_{k}"), F.col("signature").alias(f"signature_{k}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return both.select("a", "b", "signature_a", "signature_b").mapInArrow(run, "a long, b long")


def minhash_join(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_key, n_shingles, cls, component_id) per row of ``docs``; text_key is a hash of the text, cls of its set (null when empty)."""
    scratch = Scratch(docs.sparkSession, "minhash")
    comparer = Matches(percent)
    rows = scratch.save(posting_rows(docs, n, percent), "rows")
    order = Window.partitionBy("key").orderBy("cls")  # at most one row per chunk in a list
    far = rows.select("cls", F.explode("keys").alias("key")).withColumns(
        {"i": F.row_number().over(order), "center": F.first("cls").over(order)}).where("i > 1 and cls <> center")
    near = rows.select("cls", F.explode(F.arrays_zip("also", "centers")).alias("x")).select(
        F.col("x.also").alias("key"), "cls", F.col("x.centers").alias("center"))
    twins = scratch.save(far.select("key", "cls", "center").unionByName(near), "twins")
    tested = scratch.save(twins.select(F.least("cls", "center").alias("a"), F.greatest("cls", "center").alias("b")).distinct(), "stars")
    classes = tested.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    slim = scratch.save(rows.select("doc_id", "text_key", "n_shingles", "cls"), "slim")
    info = scratch.save(rows.where("signature is not null").select("cls", F.col("n_shingles").alias("n"), "signature")
                        .join(classes, "cls", "left_semi").dropDuplicates(["cls"]), "info")
    scratch.drop("rows")
    pairs = scratch.save(at_threshold(tested, info, percent), "pairs")
    found = verified(pairs, docs, slim, n, percent, scratch, "links")
    scratch.drop("stars", "pairs")
    sets_of = lambda c: class_sets(docs, first_texts(slim, c), n)
    parts = resolve(scratch, twins, info, found, sets_of, comparer,
                    [F.shiftright("key", 32) == c for c in range(comparer.prefix)])
    ids = scratch.save(class_ids(slim, parts), "ids")
    scratch.drop(*[name for name in scratch.paths if name not in ("slim", "ids")])
    return slim.join(ids, "cls", "left").select(
        "doc_id", "text_key", "n_shingles", "cls", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def near_dedup(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``: kept where the row's id is its component's."""
    return minhash_join(docs, n, percent).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op11_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


OP11_SQL = """
with recursive d as (select doc_id, coalesce(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), []) as w from documents),
 s as (select doc_id, list_distinct([array_to_string(w[i:i + 4], ' ') for i in generate_series(1, greatest(1, len(w) - 4))]) as g
       from d where len(w) > 0),
 n as (select doc_id, len(g) as n from s),
 e as (select doc_id, unnest(g) as g from s),
 p as (select a.doc_id as a, b.doc_id as b, count(*) as shared from e a join e b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
 l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * shared >= 85 * (x.n + y.n - shared)),
 u as (select a, b from l union select b, a from l),
 r as (select doc_id as node, doc_id as root from d union select u.b, r.root from r join u on u.a = r.node)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, c.root as component_id, d.doc_id = c.root as kept
from d left join n using (doc_id) join (select node, min(root) as root from r group by node) c on c.node = d.doc_id
"""
