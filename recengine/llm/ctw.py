"""LM scoring (operator 4): context-tree weighting over bytes.

A text is spelled as its lower-cased words with one blank between them and a zero byte at the end. Each byte is decomposed into eight binary
decisions. For every decision (the bits of the byte so far) there is a context tree over the preceding DEPTH bytes; a
node has the counts (zeros, ones) of its context in the training texts, their Krichevsky-Trofimov probability Pe, and
    Pw = 1/2 Pe + 1/2 product of the children's Pw  (a leaf at DEPTH: Pw = Pe).
A bit is predicted by mixing the estimates of all depths with the weights that follow: 1/2 Pe / Pw for stopping at the node, the rest
for its child; where the child's context was never seen, the path ends. A text's score is the log10 of its probability,
and its code length per byte -score * log2(10) / bytes.

What is gathered. All training texts are counted, with partial sums in each task: the (DEPTH + 1)-grams of bytes and the words.
The nodes of each depth are a table in the shared folder: counts and products of children are summed from the deepest depth up by the
parent's key, weights are carried from the root down by joins with the parent, so every context seen in training has its
node, whatever their number. The score of every known gram follows from its eight nodes. Only the MAX_GRAMS most frequent grams' scores and the
counts of the MAX_FREQUENT most frequent words are sent to all tasks; other grams and words of a text are looked up by joins on
their code or hash, and grams never seen in training take the deepest known node of each bit. So both broadcasts have fixed bounds, and what they
leave out changes no result: scores are summed in whole steps of 2^-19.

Words are compared by 64-bit hashes. Null texts are empty: only the end. Without training rows every bit has
probability 1/2, N = V = 0. Null doc_ids count as training rows, not held out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recengine.llm.common import MIX_A, Scratch, batches_of, list_array, lower_words, signed, table, utf8, word_hashes

DEPTH = 5
#: Grams whose scores every task holds.
MAX_GRAMS = 1_000_000
MAX_FREQUENT = 500_000
#: Key of the end token (a word hashes to it with probability 2^-64).
END = 0
#: Bytes of text that a task counts at a time, and distinct keys at which it passes its sums on.
COUNT_BYTES, COUNT_KEYS = 6 << 20, 2_000_000

_HALF = -math.log(2)
#: Scores are whole numbers of steps of 1/STEP.
STEP = 1 << 19
#: An empty place of the gram table: no code has all bits set.
FREE = np.uint64(2 ** 64 - 1)


def spell(words: list[bytes]) -> bytes:
    return b" ".join(words) + b"\0"


def grams(texts: list[bytes], depth: int) -> np.ndarray:
    """Codes of every byte of the spelled texts with the ``depth`` bytes before it (zeros before a start)."""
    pad = bytes(depth)
    x = np.frombuffer(b"".join(pad + t for t in texts), np.uint8)
    code = np.zeros(len(x) - depth, np.uint64)
    for i in range(depth + 1):
        code <<= np.uint64(8)
        code |= x[i:len(x) - depth + i]
    # drop the padding's own places
    size = np.array([len(t) for t in texts])
    keep = np.ones(len(code) + depth, bool)
    start = np.cumsum(size + depth) - (size + depth)
    for i in range(depth):
        keep[start + size + i] = False
    return code[keep[:len(code)]]


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling series, shifted to large arguments."""
    x = np.asarray(x, np.float64)
    shift = np.zeros_like(x)
    for _ in range(7):
        small = x < 7
        shift -= np.where(small, np.log(np.where(small, x, 1.0)), 0)
        x = np.where(small, x + 1, x)
    i = 1 / (x * x)
    return shift + (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + (1 / 12 - i * (1 / 360 - i * (1 / 1260 - i / 1680))) / x


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of any sequence with a zeros and b ones."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - math.log(math.pi)


class ContextTree:
    """All decision trees over byte contexts, as one sorted table of nodes per depth: the model in one process, for few grams.

    A node's key is its context (``d`` bytes) and the bits of the next byte so far behind a leading 1.
    """

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]]):
        """counts[d]: codes of (context of d bytes, byte) and how often they occur."""
        self.depth = len(counts) - 1
        nodes = []
        for code, n in counts:
            keys, a, b = [], [], []
            byte, context = (code & np.uint64(255)).astype(np.int64), code >> np.uint64(8)
            for k in range(8):
                prefix = ((1 << k) | (byte >> (8 - k))).astype(np.uint64)
                one = (byte >> (7 - k)) & 1
                keys.append((context << np.uint64(8)) | prefix)
                a.append(n * (1 - one))
                b.append(n * one)
            key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            nodes.append((key, *(np.bincount(inverse, np.concatenate(x).astype(np.float64), len(key)) for x in (a, b))))
            del keys, a, b, inverse
        self.keys, self.kt, self.stop, below = [], [], [], None
        for d in reversed(range(self.depth + 1)):
            key, a, b = nodes.pop()
            pe = log_kt(a, b)
            pw = pe
            if below is not None and len(key):
                child_key, child_a, child_b, child_pw = below
                # a child's context has one more, earlier byte: drop it to find the parent
                at = np.searchsorted(key, child_key & np.uint64((1 << (8 * d + 8)) - 1)).clip(0, len(key) - 1)
                ok = key[at] == child_key & np.uint64((1 << (8 * d + 8)) - 1)
                total = lambda x: np.bincount(at[ok], x[ok], len(key))
                rest = log_kt(np.maximum(a - total(child_a), 0), np.maximum(b - total(child_b), 0))
                pw = np.logaddexp(_HALF + pe, _HALF + total(child_pw) + rest)
            self.keys.insert(0, key)
            self.kt.insert(0, ((b + 0.5) / (a + b + 1)).astype(np.float32))
            self.stop.insert(0, np.exp(np.minimum(_HALF + pe - pw, 0)).astype(np.float32))
            below = (key, a, b, pw)
        self.seen = []  # of each depth: the contexts, and the scores of known grams by nodes up to that depth
        for d, (code, _) in enumerate(counts):
            self.seen.append((Table(np.unique(code >> np.uint64(8))), Table(code, self.predict(code, d))))

    def predict(self, codes: np.ndarray, limit: int | None = None) -> np.ndarray:
        """log10 of the probability of each code's last byte after the bytes before it, from nodes up to depth ``limit``."""
        step = 1 << 16
        parts = [self._predict(codes[i:i + step], self.depth if limit is None else limit) for i in range(0, len(codes), step)]
        return np.concatenate(parts) if parts else np.empty(0)

    def _predict(self, codes: np.ndarray, limit: int) -> np.ndarray:
        byte, total = (codes & np.uint64(255)).astype(np.int64), np.zeros(len(codes))
        for k in range(8):
            prefix = ((1 << k) | (byte >> (8 - k))).astype(np.uint64)
            found, path = np.ones(len(codes), bool), []
            for d in range(limit + 1):
                context = (codes >> np.uint64(8)) & np.uint64((1 << (8 * d)) - 1)
                key = (context << np.uint64(8)) | prefix
                if len(self.keys[d]):
                    at = np.searchsorted(self.keys[d], key).clip(0, len(self.keys[d]) - 1)
                    found = found & (self.keys[d][at] == key)
                    path.append((found, self.kt[d][at].astype(np.float64), self.stop[d][at].astype(np.float64)))
            p, deeper = np.full(len(codes), 0.5), np.zeros(len(codes), bool)
            for found, kt, stop in reversed(path):
                p = np.where(found, np.where(deeper, stop * kt + (1 - stop) * p, kt), p)
                deeper = found
            total += np.log10(np.where((byte >> (7 - k)) & 1 == 1, p, 1 - p))
        return total

    def score(self, codes: np.ndarray) -> np.ndarray:
        """As predict, by tables: a gram that is unknown at some depth is one of the depth below if its context there is
        unknown too. Only new bytes after known contexts are predicted bit by bit."""
        found, out = self.seen[self.depth][1].find(codes)
        left, slow = np.flatnonzero(~found), []
        for d in reversed(range(self.depth + 1)):
            if d < self.depth:
                found, value = self.seen[d][1].find(codes[left] & np.uint64((1 << (8 * d + 8)) - 1))
                out[left[found]] = value[found]
                left = left[~found]
            context = (codes[left] >> np.uint64(8)) & np.uint64((1 << (8 * d)) - 1)
            known = self.seen[d][0].find(context)[0]
            slow.append(left[known])
            left = left[~known]
        rest = np.concatenate([*slow, left])
        if len(rest):
            new, inverse = np.unique(codes[rest], return_inverse=True)
            out[rest] = self.predict(new)[inverse]
        return out


class Table:
    """A fixed hash table from codes to scores (0 to -32), by open addressing with linear probes.

    An entry is one word: 40 further bits of the code's hash, which is one-to-one, and the score in steps of 2^-19.
    """

    def __init__(self, codes: np.ndarray, scores: np.ndarray | None = None):
        self.bits = min(24, max(4, int(len(codes) * 5 // 2).bit_length()))
        self.entries = np.full(1 << self.bits, FREE, np.uint64)
        slot, mark = self._place(codes)
        steps = np.zeros(len(codes)) if scores is None else np.clip(np.rint(-scores * STEP), 0, (1 << 24) - 2)
        entry, left = (mark << np.uint64(24)) | steps.astype(np.uint64), np.arange(len(codes))
        while len(left):
            free = left[self.entries[slot[left]] == FREE]
            taken, first = np.unique(slot[free], return_index=True)
            self.entries[taken] = entry[free[first]]
            left = left[self.entries[slot[left]] != entry[left]]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _place(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = codes * MIX_A
        return (h >> np.uint64(64 - self.bits)).astype(np.int64), (h << np.uint64(self.bits)) >> np.uint64(24)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, score) of each code."""
        slot, mark = self._place(codes)
        held = self.entries[slot]
        found = (held >> np.uint64(24)) == mark
        left = np.flatnonzero(~found & (held != FREE))
        while len(left):
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            now = self.entries[slot[left]]
            held[left], found[left] = now, (now >> np.uint64(24)) == mark[left]
            left = left[~found[left] & (now != FREE)]
        return found, (held & np.uint64((1 << 24) - 1)).astype(np.float64) * (-1 / STEP)


def merge_counts(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(inverse, np.concatenate(n), len(key)).astype(np.int64)


def held_out(doc_id: Column, remainder: int = 2, of: int = 7) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % of == remainder, F.lit(False))


def training_counts(docs: DataFrame, depth: int) -> DataFrame:
    """(kind, key, n): how often each word hash (kind 0) and each code of depth + 1 bytes (kind 1) occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, texts, held = [(np.empty(0, np.uint64), np.empty(0, np.int64))] * 2, [], 0

        def count():
            words = [lower_words(t) for t in texts]
            ends = np.full(len(texts), END, np.uint64)
            found = (np.concatenate([ends, *map(word_hashes, words)]), grams([spell(w) for w in words], depth))
            for kind, x in enumerate(found):
                new = np.unique(x, return_counts=True)
                sums[kind] = merge_counts([sums[kind][0], new[0]], [sums[kind][1], new[1]])

        def rows():
            for kind, (key, n) in enumerate(sums):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, np.int32)), pa.array(signed(key)), pa.array(n)],
                                                 names=["kind", "key", "n"])

        for b in batches_of(batches, 500):
            for t in utf8(b["text"]):
                texts.append(t)
                held += len(t)
                if held >= COUNT_BYTES:
                    count()
                    texts, held = [], 0
                    if max(len(k) for k, _ in sums) >= COUNT_KEYS:
                        yield from rows()
                        sums = [(np.empty(0, np.uint64), np.empty(0, np.int64))] * 2
        if texts:
            count()
        yield from rows()

    return docs.select("text").mapInArrow(run, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def low_bytes(key: str, n: int) -> Column:
    return F.col(key).bitwiseAND(F.lit((1 << (8 * n)) - 1))


def decisions(grams: DataFrame) -> DataFrame:
    """Eight rows per row of ``grams``: key of the node of each bit of the code's last byte, and the bit."""
    return (grams.withColumn("k", F.explode(F.array(*[F.lit(k) for k in range(8)])))
            .withColumn("key", F.expr("(code - (code & 255)) | shiftleft(1L, k) | shiftright(code & 255, 8 - k)"))
            .withColumn("bit", F.expr("shiftright(code & 255, 7 - k) & 1")).drop("k"))


def weighted(level: DataFrame, leaf: bool) -> DataFrame:
    """(key, a, b, pw, kt, stop) from (key, a, b, below): below is the sum of the children's log Pw."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in batches:
            a, b, below = (r[x].to_numpy().astype(np.float64) for x in ("a", "b", "below"))
            pe = log_kt(a, b)
            pw = pe if leaf else np.logaddexp(_HALF + pe, _HALF + below)
            yield pa.RecordBatch.from_arrays(
                [r["key"], r["a"], r["b"], pa.array(pw), pa.array((b + 0.5) / (a + b + 1)), pa.array(np.exp(np.minimum(_HALF + pe - pw, 0)))],
                names=["key", "a", "b", "pw", "kt", "stop"])

    return level.mapInArrow(run, "key long, a long, b long, pw double, kt double, stop double")


def node_tables(scratch: Scratch, grams: DataFrame, depth: int) -> list[DataFrame]:
    """Of each depth (key, p, ...): the probability of a one at every node whose path ends there, from all grams (code, n)."""
    level = decisions(grams).select("key", (F.col("n") * (1 - F.col("bit"))).alias("a"), (F.col("n") * F.col("bit")).alias("b"),
                                    F.lit(0.0).alias("below"))
    nodes = {}
    for d in reversed(range(depth + 1)):
        # a child's context has one more, earlier byte: drop it to find the parent
        level = level.groupBy(low_bytes("key", d + 1).alias("key")).agg(*[F.sum(x).alias(x) for x in ("a", "b", "below")])
        nodes[d] = scratch.save(weighted(level, d == depth), f"nodes{d}")
        level = nodes[d].select("key", "a", "b", F.col("pw").alias("below"))
    out: list[DataFrame] = []
    for d in range(depth + 1):
        if d:
            up = out[-1].select(F.col("key").alias("up"), "done", "rest")
            node = nodes[d].join(small(up, d - 1), low_bytes("key", d) == F.col("up"))
        else:
            node = nodes[d].withColumns({"done": F.lit(0.0), "rest": F.lit(1.0)})
        # what the nodes above have decided, and the weight that is left for the children
        out.append(scratch.save(node.select(
            "key", F.expr("done + rest * kt").alias("p"), F.expr("done + rest * stop * kt").alias("done"),
            F.expr("rest * (1 - stop)").alias("rest")), f"values{d}"))
        scratch.drop(f"nodes{d}")
    return out


def small(nodes: DataFrame, d: int) -> DataFrame:
    """Nodes of depths 0 and 1 go to all tasks: at most 255 and 65,280 rows, with few keys to deal out by."""
    return F.broadcast(nodes) if d <= 1 else nodes


def gram_steps(found: DataFrame, *more: Column) -> DataFrame:
    """(code, steps, ...) from the rows (code, bit, p) of all decisions."""
    p = F.when(F.col("bit") == 1, F.col("p")).otherwise(1 - F.col("p"))
    return found.groupBy("code").agg(F.round(F.sum(F.log10(p)) * -STEP).cast("long").alias("steps"), *more)


def unseen_steps(codes: DataFrame, values: list[DataFrame]) -> DataFrame:
    """(code, steps) of grams that training texts lack: each bit by its deepest known node, 1/2 without any."""
    rows = decisions(codes).withColumn("p", F.lit(None).cast("double"))
    for d in reversed(range(len(values))):
        node = small(values[d].select(F.col("key").alias("node"), F.col("p").alias("at")), d)
        rows = rows.join(node, low_bytes("key", d + 1) == F.col("node"), "left").withColumn("p", F.coalesce("p", "at")).drop("node", "at")
    return gram_steps(rows.withColumn("p", F.coalesce("p", F.lit(0.5))))


def lm_scores(docs: DataFrame, held: Column | None = None, depth: int = DEPTH) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, n_bytes, base_score, score, bits_per_byte) per row of ``docs``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "ctw")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                    (held_out(F.col("doc_id")) if held is None else held).alias("held_out"))
    counts = scratch.save(training_counts(d.where(~F.col("held_out")), depth), "counts")
    words = counts.where("kind = 0")
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = words.orderBy(F.desc("n"), "key").limit(MAX_FREQUENT).select("key", "n").toArrow()
    order = np.argsort(top["key"].to_numpy().astype(np.int64).view(np.uint64), kind="stable")
    keys = top["key"].to_numpy().astype(np.int64).view(np.uint64)[order]
    gain = np.log10(top["n"].to_numpy()[order] + 1.0)
    grams_n = counts.where("kind = 1").select(F.col("key").alias("code"), "n")
    values = node_tables(scratch, grams_n, depth)
    known_grams = scratch.save(gram_steps(decisions(grams_n).join(values[depth].select("key", "p"), "key"), F.first("n").alias("n")), "grams")
    hot = known_grams.orderBy(F.desc("n"), "code").limit(MAX_GRAMS).select("code", "steps").toArrow()
    cache = Table(hot["code"].to_numpy().astype(np.uint64), hot["steps"].to_numpy() / -STEP)
    model = spark.sparkContext.broadcast((cache, keys, gain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, keys, gain = model.value
        row = TaskContext.get().partitionId() << 33
        for b in batches_of(batches, 200):
            lists = [lower_words(t) for t in utf8(b["text"])]
            texts = [spell(w) for w in lists]
            codes, ends = grams(texts, depth), np.cumsum([len(t) for t in texts])
            cached, score = cache.find(codes)
            score = np.add.reduceat(np.where(cached, score, 0.0), ends - [len(t) for t in texts])
            others = [np.unique(x[~c], return_counts=True) for x, c in zip(np.split(codes, ends[:-1]), np.split(cached, ends[:-1]))]
            h = [np.append(word_hashes(w), np.uint64(END)) for w in lists]
            flat = np.concatenate(h)
            at = np.searchsorted(keys, flat).clip(0, max(0, len(keys) - 1))
            common = keys[at] == flat if len(keys) else np.zeros(len(flat), bool)
            edge = np.cumsum([0, *map(len, h)])
            sums = np.add.reduceat(np.where(common, gain[at] if len(gain) else 0.0, 0.0), edge[:-1])
            known = np.add.reduceat(common.astype(np.int64), edge[:-1])
            rare = [signed(x[~common[i:j]]) for x, i, j in zip(h, edge[:-1], edge[1:])]
            m = b.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + m)), b["doc_id"], b["held_out"], pa.array(np.diff(edge)), pa.array(known),
                 pa.array([len(t) for t in texts], pa.int64()), pa.array(sums), pa.array(score), list_array(rare, pa.int64()),
                 list_array([signed(x) for x, _ in others], pa.int64()), list_array([x for _, x in others], pa.int64())],
                names=["row", "doc_id", "held_out", "n_tokens", "known", "n_bytes", "gain", "cached", "rare", "codes", "times"])
            row += m

    scored = scratch.save(d.mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, known long, n_bytes long, "
                                            "gain double, cached double, rare array<long>, codes array<long>, times array<long>"), "scored")
    rare = (scored.select("row", F.explode("rare").alias("key")).join(words.select("key", "n"), "key")
            .groupBy("row").agg(F.sum(F.log10(F.col("n") + 1.0)).alias("more"), F.count("*").alias("found")))
    others = (scored.select("row", F.explode(F.arrays_zip("codes", "times")).alias("x"))
              .select("row", F.col("x.codes").alias("code"), F.col("x.times").alias("times")))
    new = scratch.save(unseen_steps(others.select("code").distinct().join(known_grams, "code", "left_anti"), values), "new")
    scratch.drop(*[f"values{i}" for i in range(depth + 1)])
    steps = (others.join(known_grams.select("code", "steps").unionByName(new), "code")
             .groupBy("row").agg(F.sum(F.col("times") * F.col("steps")).alias("steps")))
    out = scored.drop("rare", "codes", "times").join(rare, "row", "left").join(steps, "row", "left")
    out = out.withColumn("score", F.col("cached") - F.coalesce("steps", F.lit(0)) / F.lit(float(STEP)))
    base = F.col("gain") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.lit(math.log10(n + v + 1))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("found", F.lit(0))).alias("n_known"),
                      F.lit(n).cast("long").alias("train_tokens"), "n_bytes", base.alias("base_score"), "score",
                      (-F.col("score") * math.log2(10) / F.col("n_bytes")).alias("bits_per_byte"))


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
