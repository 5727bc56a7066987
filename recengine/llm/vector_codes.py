"""Vector code compression (operator 13): product quantisation by k-means over anchors-hierarchy metric trees.

Components become integers floor(scale * x); a vector is cut into PARTS equal parts, and each part position has a codebook of at most
ENTRIES entries, improved in ROUNDS rounds of assignment and floored means. All sums and distances are integers, so the codes don't
depend on how the rows are dealt.

Trees. Each task cuts its rows into chunks of CHUNK vectors and builds one metric tree per chunk and part position, middle out: about
sqrt(n) anchors, each new one the farthest point of the widest, take the points that are nearer to them (a point is looked at only if the triangle
inequality leaves it a chance); the anchors are merged two by two, the smallest common ball first, up to the root, and each anchor is
divided in the same way downwards until it has at most LEAF points or no radius. Each ball caches its integer centre, radius, count and sum.
The trees are written once to the shared folder, as one row per chunk.

Rounds. A walk goes down level by level. A ball inherits its parent's list of candidate entries and strikes out those that are too far to be
nearest to any of its points: distance - radius > least distance + radius. A ball with one entry left is wholly owned, and its cached sum and count go to
the entry without looking at its points; the points of undecided leaves are compared with their leaf's candidates. Radii are rounded
up and the comparison has a margin, so that ties and rounding leave an entry in the list; the integer comparison at the leaf decides.
A round returns at most PARTS x ENTRIES partial sums per task, added up by Spark; only the codebooks pass through the driver.

Rows whose vector is null, empty or holds a null or non-finite component are dropped; so are vectors of another length than that of the
first kept one by vec_id (no codebook fits them). The length must be a multiple of PARTS, and components less than 2^26 / scale in size (else
ValueError), so that 64 bits hold every distance. Null vec_ids come last, equal ones in the order of their vectors; repeated rows count
as often as they occur. With fewer rows than ENTRIES the codebooks are shorter. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recengine.llm.common import Scratch, table

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors of a chunk, and points of a ball that is not divided further.
CHUNK, LEAF = 4096, 32
LARGEST = 1 << 26
#: Rows of one label share a join key; so many copies of its sum keep a frequent label from meeting in one task.
SALTS = 32


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances along the last axis, as integers."""
    return ((a - b) ** 2).sum(-1)


def radius(points: np.ndarray, centre: np.ndarray) -> float:
    """Largest distance from the centre, rounded up."""
    return float(np.sqrt(float(squared(points, centre).max()))) * (1 + 1e-12)


class Ball:
    """A set of points (indexes) with its cached statistics, and its two balls unless it is a leaf."""

    __slots__ = ("rows", "total", "centre", "radius", "parts")

    def __init__(self, points: np.ndarray, rows: np.ndarray, parts: tuple = ()):
        self.rows, self.parts = rows, parts
        self.total = parts[0].total + parts[1].total if parts else points[rows].sum(0)
        self.centre = self.total // len(rows)
        self.radius = radius(points[rows], self.centre)


def anchors(points: np.ndarray, rows: np.ndarray, count: int) -> list[np.ndarray]:
    """The rows dealt to at most ``count`` anchors, each point to its nearest."""
    local = points[rows]
    pivots = [0]
    owner, away = np.zeros(len(rows), np.int64), np.sqrt(squared(local, local[0]).astype(float))
    while len(pivots) < count:
        new = int(away.argmax())  # the farthest point of the widest anchor
        if away[new] == 0:
            break
        apart = np.sqrt(squared(local[pivots], local[new]).astype(float))
        # a point nearer to its anchor than half the way from there to the new one stays
        maybe = np.flatnonzero(2 * away >= apart[owner])
        to_new = np.sqrt(squared(local[maybe], local[new]).astype(float))
        taken = to_new < away[maybe]
        owner[maybe[taken]], away[maybe[taken]] = len(pivots), to_new[taken]
        pivots.append(new)
    return [rows[owner == k] for k in range(len(pivots))]


def merged(points: np.ndarray, balls: list[Ball]) -> Ball:
    """One ball over all, joining the two with the smallest common ball again and again."""
    balls = list(balls)
    n = len(balls)
    if n == 1:
        return balls[0]
    centres, radii = np.array([b.centre for b in balls]), np.array([b.radius for b in balls])
    span = np.sqrt(squared(centres[:, None], centres[None]).astype(float)) + radii[:, None] + radii[None]
    span[np.tril_indices(n)] = np.inf
    for _ in range(n - 1):
        i, j = divmod(int(span.argmin()), n)
        both = Ball(points, np.concatenate([balls[i].rows, balls[j].rows]), (balls[i], balls[j]))
        balls[i], balls[j] = both, None
        centres[i], radii[i] = both.centre, both.radius
        span[j, :] = span[:, j] = np.inf
        left = np.array([k for k in range(n) if k != i and balls[k] is not None], np.int64)
        reach = np.sqrt(squared(centres[left], centres[i]).astype(float)) + radii[left] + radii[i]
        span[np.minimum(left, i), np.maximum(left, i)] = reach
    return both


def hierarchy(points: np.ndarray, rows: np.ndarray) -> Ball:
    """The tree over some rows of the points, from the middle outwards."""
    if len(rows) <= LEAF or not (points[rows] != points[rows[0]]).any():
        return Ball(points, rows)
    return merged(points, [hierarchy(points, part) for part in anchors(points, rows, max(2, int(len(rows) ** 0.5)))])


class Tree:
    """A hierarchy as arrays. Balls are listed level by level; ``order`` lists the rows so that each ball covers a range of it."""

    FIELDS = (("order", np.int32), ("low", np.int32), ("high", np.int32), ("parent", np.int32), ("level", np.int32), ("leaf", np.int32),
              ("radius", np.float64), ("centre", np.int64), ("total", np.int64), ("points", np.int32))

    @classmethod
    def build(cls, points: np.ndarray) -> Tree:
        root = hierarchy(points, np.arange(len(points)))
        # a ball over others lists their rows one after the other, so the root's order serves all
        out, level, place = [], [(root, -1, 0)], 0
        depth, tree = 0, cls()
        while level:
            below = []
            for ball, parent, low in level:
                out.append((low, low + len(ball.rows), parent, depth, not ball.parts, ball.radius, ball.centre, ball.total))
                for part in ball.parts:
                    below.append((part, place, low))
                    low += len(part.rows)
                place += 1
            level, depth = below, depth + 1
        tree.order = root.rows.astype(np.int32)
        for (name, kind), values in zip(cls.FIELDS[1:-1], zip(*out)):
            setattr(tree, name, np.array(values, kind))
        tree.points = points[root.rows].astype(np.int32)
        return tree

    def dump(self) -> bytes:
        arrays = [np.ascontiguousarray(getattr(self, name), kind).tobytes() for name, kind in self.FIELDS]
        return np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(arrays)

    @classmethod
    def load(cls, data: bytes) -> Tree:
        sizes, at, tree = np.frombuffer(data, np.int64, len(cls.FIELDS)), 8 * len(cls.FIELDS), cls()
        for (name, kind), size in zip(cls.FIELDS, sizes.tolist()):
            setattr(tree, name, np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
            at += size
        width = len(tree.points) // max(1, len(tree.order))
        tree.points = tree.points.reshape(-1, width).astype(np.int64)
        tree.centre, tree.total = tree.centre.reshape(-1, width), tree.total.reshape(-1, width)
        return tree

    def walk(self, book: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
        """(owned balls as (ball, entry), places of the points that were compared, their entries)."""
        owned, places, entries = [], [], []
        lists = np.ones((len(self.low), len(book)), bool)
        open_ = np.ones(len(self.low), bool)
        for depth in range(int(self.level[-1]) + 1):
            balls = np.flatnonzero(self.level == depth)
            if depth:
                balls = balls[open_[self.parent[balls]]]
                lists[balls] = lists[self.parent[balls]]
            far = np.sqrt(squared(self.centre[balls, None], book[None]).astype(float))
            far[~lists[balls]] = np.inf
            r = self.radius[balls, None]
            limit = far.min(1, keepdims=True) + 2 * r
            lists[balls] &= far <= limit * (1 + 1e-9) + 1e-9
            decided = lists[balls].sum(1) == 1
            owned += [(b, int(lists[b].argmax())) for b in balls[decided].tolist()]
            open_[np.flatnonzero(self.level == depth)] = False
            open_[balls[~decided]] = True
            leaves = balls[~decided & (self.leaf[balls] == 1)]
            if len(leaves):
                at = np.concatenate([np.arange(self.low[b], self.high[b]) for b in leaves.tolist()])
                home = np.repeat(leaves, (self.high - self.low)[leaves])
                d = squared(self.points[at, None], book[None])
                d[~lists[home]] = np.iinfo(np.int64).max
                places.append(at)
                entries.append(d.argmin(1))  # the lowest index among equals
        none = np.empty(0, np.int64)
        return owned, np.concatenate(places) if places else none, np.concatenate(entries) if entries else none

    def sums(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, sum) of the points of each entry."""
        count, total = np.zeros(len(book), np.int64), np.zeros_like(book)
        owned, places, entries = self.walk(book)
        for ball, e in owned:
            count[e] += self.high[ball] - self.low[ball]
            total[e] += self.total[ball]
        np.add.at(count, entries, 1)
        np.add.at(total, entries, self.points[places])
        return count, total

    def codes(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance to it) of each row, in the rows' own order."""
        found = np.empty(len(self.order), np.int64)
        owned, places, entries = self.walk(book)
        for ball, e in owned:
            found[self.low[ball]:self.high[ball]] = e
        found[places] = entries
        back = np.empty(len(self.order), np.int64)
        back[self.order] = np.arange(len(self.order))
        return found[back], squared(self.points, book[found])[back]


def scaled(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, v): the rows with usable vectors, v their integer components."""
    x = F.col("embedding")
    bad = F.exists(x, lambda y: y.isNull() | F.isnan(y) | (F.abs(y) == float("inf")))
    kept = vectors.where(x.isNotNull() & (F.size(x) > 0) & ~F.coalesce(bad, F.lit(True)))
    whole = F.transform(x, lambda y: F.floor(y.cast("double") * scale).cast("double"))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), whole.alias("v"))


def tree_rows(rows: DataFrame, parts: int) -> DataFrame:
    """One row per chunk: (vec_ids, labels, trees), the trees in part order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush(t: pa.Table) -> pa.RecordBatch:
            flat = t["v"].combine_chunks().flatten().to_numpy().astype(np.int64).reshape(t.num_rows, -1)
            trees = [Tree.build(p).dump() for p in np.split(flat, parts, axis=1)]
            return pa.RecordBatch.from_arrays(
                [pa.array([t["vec_id"].to_pylist()], pa.list_(pa.int64())), pa.array([t["label"].to_pylist()], pa.list_(pa.string())),
                 pa.array([trees], pa.list_(pa.binary()))], names=["vec_ids", "labels", "trees"])

        for b in batches:
            while b.num_rows:
                part = b.slice(0, CHUNK - size)
                held.append(part)
                size += part.num_rows
                b = b.slice(part.num_rows)
                if size == CHUNK:
                    yield flush(pa.Table.from_batches(held))
                    held, size = [], 0
        if held:
            yield flush(pa.Table.from_batches(held))

    return rows.mapInArrow(run, "vec_ids array<long>, labels array<string>, trees array<binary>")


def round_sums(trees: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(part, entry, n, total array): counts and sums over all chunks."""
    width = books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = [np.zeros(len(b), np.int64) for b in books]
        total = [np.zeros_like(b) for b in books]
        for batch in batches:
            for row in batch["trees"]:
                for p, data in enumerate(row.as_py()):
                    n, s = Tree.load(data).sums(books[p])
                    count[p] += n
                    total[p] += s
        found = [(p, e, int(n), total[p][e].tolist()) for p in range(len(books)) for e, n in enumerate(count[p].tolist()) if n]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)],
                                         names=["part", "entry", "n", "total"])

    partial = trees.select("trees").mapInArrow(run, "part int, entry int, n long, total array<long>")
    return partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(width)]).alias("total"))


def code_rows(trees: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(vec_id, label, code, error) per vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, data in zip(batch["vec_ids"], batch["labels"], batch["trees"]):
                found = [Tree.load(x).codes(book) for x, book in zip(data.as_py(), books)]
                codes = np.array([c for c, _ in found], np.uint8).T.tobytes().hex()
                width = 2 * len(books)
                yield pa.RecordBatch.from_arrays(
                    [ids.values, labels.values, pa.array([codes[i:i + width] for i in range(0, len(codes), width)], pa.string()),
                     pa.array(sum(d for _, d in found), pa.int64())], names=["vec_id", "label", "code", "error"])

    return trees.mapInArrow(run, "vec_id long, label string, code string, error long")


def books_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def train_books(spark: SparkSession, rows: DataFrame, parts: int, entries: int, rounds: int, scratch: Scratch):
    """(trees, codebooks) of scaled rows; (None, []) without rows. The driver sees ``entries`` rows and the codebooks."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("v").asc()]
    head = rows.select("v").orderBy(*order).limit(1).collect()
    if not head:
        return None, []
    width = len(head[0].v)
    if width % parts:
        raise ValueError(f"vectors of {width} components can't be cut into {parts} equal parts")
    rows = rows.where(F.size("v") == width)
    first = np.array([r.v for r in rows.orderBy(*order).limit(entries).select("v").collect()]).astype(np.int64)
    trees = scratch.save(tree_rows(rows, parts), "trees")
    books = [np.ascontiguousarray(p) for p in np.split(first, parts, axis=1)]
    for _ in range(rounds):
        done = round_sums(trees, books).collect()  # at most parts * entries rows
        books = [b.copy() for b in books]
        for r in done:
            books[r.part][r.entry] = np.array(r.total, np.int64) // r.n
    return trees, books


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE):
    """(codes, codebooks): codes has (vec_id, label, code, error) per usable row of ``vectors`` (vec_id, embedding, label); the codebooks are
    one integer array of (entry, component) per part. label is text. ``entries`` is at most 256 (a code has two hex digits a part)."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "codes")
    rows = scaled(vectors, scale)
    large = rows.where(F.exists("v", lambda y: F.abs(y) >= LARGEST)).select("vec_id").limit(1).collect()
    if large:
        raise ValueError(f"vec_id {large[0].vec_id}: a component of {LARGEST / scale:g} or more in size; give a smaller scale")
    trees, books = train_books(spark, rows, parts, entries, rounds, scratch)
    if trees is None:
        return spark.createDataFrame([], "vec_id long, label string, code string, error long"), []
    return scratch.save(code_rows(trees, books), "rows"), books


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes(table(spark, sf_dir, "embeddings"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    sums = codes.groupBy("label").agg(F.sum("error").alias("label_error")).select(F.col("label").alias("same"), "label_error", salts)
    salted = codes.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    joined = salted.join(sums.withColumnRenamed("salt", "at"), F.col("label").eqNullSafe(F.col("same")) & (F.col("salt") == F.col("at")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def _op13_sql() -> str:
    """The rounds written out: a_k assigns every part by the entries b_k, b_(k+1) are the floored means."""
    steps = []
    for k in range(ROUNDS + 1):
        steps.append(f"""d{k} as (select x.vec_id, x.p, b.e, sum((x.v - b.v) * (x.v - b.v)) as d from x join b{k} b on x.p = b.p and x.i = b.i group by all),
 a{k} as (select vec_id, p, arg_min(e, d * 1000 + e) as e, min(d) as d from d{k} group by vec_id, p)""")
        if k < ROUNDS:
            steps.append(f"""m{k} as (select a.p, a.e, x.i, floor(sum(x.v)::double / count(*))::bigint as v from a{k} a join x on x.vec_id = a.vec_id and x.p = a.p
   group by all),
 b{k + 1} as (select b.p, b.e, b.i, coalesce(m.v, b.v) as v from b{k} b left join m{k} m on m.p = b.p and m.e = b.e and m.i = b.i)""")
    return f"""
with kept as (select vec_id, label, list_transform(embedding, lambda y: floor({SCALE} * y::double)::bigint) as v from embeddings
   where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda y: y is null or not isfinite(y))) = 0),
 pos as (select vec_id, label, v, unnest(generate_series(0, len(v) - 1)) as j, len(v) // {PARTS} as w from kept),
 x as (select vec_id, (j // w)::int as p, (j % w)::int as i, v[j + 1] as v from pos),
 firsts as (select vec_id, (row_number() over (order by vec_id) - 1)::int as e from kept order by vec_id limit {ENTRIES}),
 b0 as (select x.p, f.e, x.i, x.v from x join firsts f using (vec_id)),
 {(','+chr(10)+' ').join(steps)},
 c as (select vec_id, string_agg(format('{{:02x}}', e), '' order by p) as code, sum(d)::bigint as error from a{ROUNDS} group by vec_id),
 s as (select c.*, kept.label from c join kept using (vec_id)),
 l as (select label, sum(error)::bigint as label_error from s group by label),
 h as (select sha256(string_agg(v::varchar, ',' order by p, e, i)) as codebooks_sha256 from b{ROUNDS})
select s.vec_id, s.code, s.error, l.label_error, h.codebooks_sha256 from s join l on l.label is not distinct from s.label, h
"""


OP13_SQL = _op13_sql()
