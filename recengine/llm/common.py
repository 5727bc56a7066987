"""Helpers shared by the llm operators: inputs, the shared scratch folder, word splitting, components."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

#: Odd 64-bit multipliers for combining hashes (any odd constants would do).
MIX_A = np.uint64(0x9E3779B97F4A7C15)
MIX_B = np.uint64(0xC2B2AE3D27D4EB4F)

_local_dir: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a plain local session may lack the setting (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dir:
        _local_dir[app] = "file://" + tempfile.mkdtemp(prefix="llm-", dir=os.environ.get("TMPDIR", "/tmp"))
    return _local_dir[app]


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


class Scratch:
    """Tables written to the shared folder to cut lineage; ``drop`` deletes one that is no longer read.

    A written table survives the loss of executors. Tables that a returned DataFrame still reads must
    stay; they go with the shared folder.

    ``waves``: tasks and files of a table are at most so many times the cores, or an eighth of the shuffle partitions where that is more.
    Every file that Spark creates on a file system without Hadoop's native code costs processes of its executor; many tables of
    many tiny files cost thousands.
    """

    def __init__(self, spark: SparkSession, tag: str, waves: int | None = None):
        self.spark, self.tag, self.waves, self.paths = spark, tag, waves, {}

    def most_files(self) -> int:
        return max(self.waves * self.spark.sparkContext.defaultParallelism, int(self.spark.conf.get("spark.sql.shuffle.partitions")) // 8)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = new_path(self.spark, f"{self.tag}-{name}")
        (df if self.waves is None else df.coalesce(self.most_files())).write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[name] = path
        return out

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(conf).delete(path, True)


def utf8(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def lower_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z: what bytes.lower and bytes.split do."""
    return text.lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def finish(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes (wrapping arithmetic)."""
    h = (h ^ (h >> np.uint64(31))) * MIX_A
    h = (h ^ (h >> np.uint64(29))) * MIX_B
    return h ^ (h >> np.uint64(32))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n word hashes (wrapping polynomial, then finish)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = words[:m].copy()
    for i in range(1, n):
        out *= MIX_A
        out += words[i:i + m]
    return finish(out)


def signed(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h).view(np.int64)


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one numpy array per row."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def batches_of(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that a task holds few rows at once."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


#: Edges that a task contracts together.
CHUNK_EDGES = 500_000


def contracted(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the same components: in each chunk that a task reads, every node's least node of the chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}
        held = 0

        def find(x):
            while (up := root.setdefault(x, x)) != x:
                root[x] = x = root[up]
            return x

        def stars():
            pairs = [(x, r) for x in root if (r := find(x)) != x]
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["u", "v"])

        for b in batches:
            for u, v in zip(b["u"].to_pylist(), b["v"].to_pylist()):
                low, high = sorted((find(u), find(v)))
                root[high] = low
            held += b.num_rows
            if held >= CHUNK_EDGES:
                yield stars()
                root, held = {}, 0
        if root:
            yield stars()

    return edges.select("u", "v").mapInArrow(run, "u long, v long")


def connected_components(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    """Components of edges (a, b) as (node, component): each node's smallest reachable node.

    Rounds of contraction inside tasks and of alternating large star and small star: every node links its neighbours to the
    smallest of them, by a partial aggregation and a join on the node, until the edges are stars. Nothing is
    collected; hot nodes are split by the adaptive skew join. Each round is written to the shared folder. Edges that one task contracts
    whole (CHUNK_EDGES at most) need no rounds.
    """
    e = scratch.save(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                     .distinct(), f"{name}-0")
    state = lambda d: d.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    last, step = state(e), 0
    if last[0] <= CHUNK_EDGES:
        stars = scratch.save(contracted(e.coalesce(1)), f"{name}-1")
        scratch.drop(f"{name}-0")
        return as_components(stars)
    while True:
        less = contracted(e)
        both = less.unionByName(less.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        step += 1
        e = scratch.save(small, f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
        now = state(e)
        if now == last:
            return as_components(e)
        last = now


def as_components(stars: DataFrame) -> DataFrame:
    """(node, component) from edges (u, v) of every node to its component's least."""
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
