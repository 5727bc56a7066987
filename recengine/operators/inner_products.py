"""Exact maximum inner products: the n items with the largest u . v for every user u, without scoring all pairs.

Items are ordered by the length of their factors, longest first, and cut into blocks. A user goes through the blocks in this order and keeps the n best
so far; since u . v <= |u| |v|, the user is done at the first block whose longest item can't beat its n-th score. Within a chunk of users a
block is one matrix product, for the users that are still open.

The item table is never assumed small: it goes to the tasks in rounds of at most ``ROUND_ITEMS`` items (a broadcast of known size). Between rounds
the users' lists are written to the shared checkpoint folder; only open users go on, and rounds end when none is open.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recengine.operators.clean import assign_row_ids
from recengine.session import reliable_checkpoint

#: Items of a round (about 48 MB of a rank of 10), items of a block, users that are scored together.
ROUND_ITEMS, BLOCK, CHUNK = 1_000_000, 512, 2048
#: Products in single floats may exceed the bound by rounding.
MARGIN = 1 + 1e-5


def ordered_items(items: DataFrame) -> DataFrame:
    """(item, features, _at): items numbered 1.. by length, longest first."""
    length = F.sqrt(F.aggregate(F.transform("features", lambda x: x.cast("double") * x), F.lit(0.0), lambda a, b: a + b))
    rows = items.select(F.col("id").alias("item"), "features", length.alias("_len"))
    return assign_row_ids(rows, [F.col("_len").desc(), F.col("item")], "_at").select("item", "features", "_at")


class Lists:
    """The best n items of some users: scores descending, ties by item; -inf where a list is not full."""

    def __init__(self, users: int, n: int):
        self.n = n
        self.score = np.full((users, n), -np.inf, np.float32)
        self.item = np.full((users, n), np.iinfo(np.int64).max, np.int64)

    def add(self, rows: np.ndarray, score: np.ndarray, item: np.ndarray) -> None:
        """Merges the scores (rows x items) of some items; only those that reach a list's last place are sorted."""
        floor = self.score[rows, -1]
        short = np.flatnonzero(floor == -np.inf)
        if len(short) and score.shape[1] > self.n:
            # more than n of them can't enter; ties at the n-th place stay for the exact order below
            least = -np.partition(-score[short], self.n - 1, axis=1)[:, self.n - 1]
            floor[short] = np.where(np.isnan(least), -np.inf, least)
        enters = score >= floor[:, None]
        count = np.count_nonzero(enters, axis=1)
        some = np.flatnonzero(count)
        if not len(some):
            return
        at, col = np.nonzero(enters)
        count, rows = count[some], rows[some]
        row = np.repeat(np.arange(len(some)), count)
        place = self.n + np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        s = np.full((len(some), self.n + count.max()), -np.inf, np.float32)
        i = np.full(s.shape, np.iinfo(np.int64).max, np.int64)
        s[:, :self.n], i[:, :self.n] = self.score[rows], self.item[rows]
        s[row, place], i[row, place] = score[at, col], item[col]
        order = np.lexsort((i, -s), axis=1)[:, :self.n]
        self.score[rows], self.item[rows] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)


def scan_blocks(u: np.ndarray, lists: Lists, open_: np.ndarray, items: np.ndarray, v: np.ndarray, block: int) -> np.ndarray:
    """Takes the open users through the blocks of items (longest first); closes those that are done and returns the
    number of blocks that each one visited."""
    length = np.sqrt((u.astype(np.float64) ** 2).sum(1))
    visits = np.zeros(len(u), np.int64)
    for lo in range(0, len(items), block):
        rows = np.flatnonzero(open_)
        longest = np.sqrt((v[lo].astype(np.float64) ** 2).sum())
        done = length[rows] * longest * MARGIN < lists.score[rows, -1]
        open_[rows[done]] = False
        rows = rows[~done]
        if not len(rows):
            break
        visits[rows] += 1
        lists.add(rows, u[rows] @ v[lo:lo + block].T, items[lo:lo + block])
    return visits


def top_products(users: DataFrame, items: DataFrame, n: int, *, block: int = BLOCK, round_items: int = ROUND_ITEMS) -> DataFrame:
    """(id, item, score, rank, visits) for each of ``users`` (id, features): the ``n`` rows of ``items`` (id, features) with the largest
    inner product, ties to the smaller item; visits: the blocks the user went through. Ids are whole numbers."""
    spark = users.sparkSession
    ranked = reliable_checkpoint(ordered_items(items))
    total = ranked.count()
    state = users.select(F.col("id").cast("long").alias("id"), F.col("features").cast("array<float>").alias("features"),
                         F.array().cast("array<long>").alias("items"), F.array().cast("array<float>").alias("scores"),
                         F.lit(0).cast("long").alias("visits"), F.lit(True).alias("open"))
    schema, done = state.schema, []
    for first in range(0, total, round_items):
        part = ranked.where((F.col("_at") > first) & (F.col("_at") <= first + round_items)).orderBy("_at").toArrow()  # at most round_items rows
        sent = spark.sparkContext.broadcast((part["item"].to_numpy().astype(np.int64),
                                             part["features"].combine_chunks().flatten().to_numpy().astype(np.float32).reshape(part.num_rows, -1)))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, v = sent.value
            for whole in batches:
                for b in (whole.slice(i, CHUNK) for i in range(0, whole.num_rows, CHUNK)):
                    yield advance(b, ids, v)

        def advance(b: pa.RecordBatch, ids: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
            u = b["features"].flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(b.num_rows, -1)
            lists, open_ = Lists(b.num_rows, n), b["open"].to_numpy(zero_copy_only=False).copy()
            held = b["items"].value_lengths().to_numpy(zero_copy_only=False)
            filled = np.arange(n) < held[:, None]
            lists.item[filled] = b["items"].flatten().to_numpy(zero_copy_only=False)
            lists.score[filled] = b["scores"].flatten().to_numpy(zero_copy_only=False)
            visits = b["visits"].to_numpy() + scan_blocks(u, lists, open_, ids, v, block)
            filled = lists.score > -np.inf  # from the front: lists are sorted
            ends = pa.array(np.concatenate([[0], np.cumsum(filled.sum(1))]), pa.int32())
            return pa.RecordBatch.from_arrays(
                [b["id"], b["features"], pa.ListArray.from_arrays(ends, pa.array(lists.item[filled], pa.int64())),
                 pa.ListArray.from_arrays(ends, pa.array(lists.score[filled], pa.float32())), pa.array(visits, pa.int64()),
                 pa.array(open_)], names=schema.names)

        state = state.mapInArrow(run, schema)
        if first + round_items < total:
            state = reliable_checkpoint(state)
            sent.unpersist()
            # lists that are done are not carried through the next rounds
            done.append(state.where("not open"))
            state = state.where("open")
            if state.isEmpty():
                break
    for lists in done:
        state = state.unionByName(lists)
    flat = state.select("id", "visits", F.posexplode(F.arrays_zip("items", "scores")).alias("_p", "_x"))
    return flat.select("id", F.col("_x.items").alias("item"), F.col("_x.scores").alias("score"), (F.col("_p") + 1).alias("rank"), "visits")
