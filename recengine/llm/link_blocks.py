"""Links across the components of candidate lists, found inside blocks (a helper of the n-gram and the MinHash join).

A candidate list holds the classes of documents that share a key; every two classes that link share at least one list. When each
member has been compared with one center of its list, most lists lie in one component. For those that don't, ``resolve`` looks at the pairs
whose components differ, and proves that no link between two components is left:

1. Screening. Members of a list's largest component form major blocks, the others minor ones, of at most SCREEN classes. Every minor block
   meets every block of its list in one unit, which compares the classes' signatures (coarse ones first) and returns the members that may link with one of
   another component. Lists without such members (texts that share a passage) are done; lists with the same members count once.
2. Rounds of blocks. The members of some lists are dealt to blocks of at most BLOCK classes with their sets; a unit unites the components of
   one block by exact intersections and returns the links that unite two: fewer than it has members. Rounds go on while they unite many.
3. Crossing. The lists that are still apart are screened again; then their minor blocks meet all blocks, with their sets, as in 1.

So rows are proportional to members (times the blocks of a list in 1 and 3), never to pairs; a unit holds two blocks, whose number follows from the
list's members and from their sets' sizes. A pair that shares several lists is compared in the first one only, where the comparer's
scores can tell.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recengine.llm.common import Scratch, connected_components

#: Classes of a block that is screened, and of one that carries sets; elements of the sets of a block.
SCREEN, BLOCK, ELEMENTS = 1024, 256, 2_000_000
#: Copies of a component's row in a join by component.
SALTS = 16
#: Another round of blocks follows while the last one united at least so large a share of its members.
WORTH = 0.02


class Comparer:
    """What a signature says of two classes; subclasses give ``matrix`` and ``scores``."""

    percent = 100

    def matrix(self, signatures: list[bytes]) -> tuple[np.ndarray, ...]:
        """Signatures of the classes of a unit: arrays with a row for each."""
        raise NotImplementedError

    def scores(self, key: int, n_x: int, x: tuple[np.ndarray, ...], n: np.ndarray, m: tuple[np.ndarray, ...]) -> np.ndarray:
        """A likelihood of a link of a class (set size n_x, signature x) with each of the others (n, m); negative where none is possible."""
        raise NotImplementedError

    def links(self, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether two sets (sorted arrays of distinct elements) link."""
        low, high = sorted((len(a), len(b)))
        if 100 * low < self.percent * high:
            return False
        both = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * both >= self.percent * (len(a) + len(b) - both)


def memberships(twins: DataFrame) -> DataFrame:
    """(key, cls) of the lists, from each member's center (key, cls, center)."""
    return twins.select("key", "cls").unionByName(twins.select("key", F.col("center").alias("cls"))).distinct()


def components(scratch: Scratch, found: DataFrame, name: str) -> DataFrame:
    parts = scratch.save(connected_components(scratch, found, f"{name}-stars"), name)
    scratch.drop(*[k for k in scratch.paths if k.startswith(f"{name}-stars-")])
    return parts


def apart(members: DataFrame, parts: DataFrame, scratch: Scratch, name: str, least: int = 2) -> DataFrame:
    """(key, cls, n, component, major, minors, size, n_minor, n_all) of the lists of ``least`` or more members in several components;
    of lists with the same members, only that of the least key."""
    m = members.join(parts.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    m = scratch.save(m.select("key", "cls", "n", "component"), name)
    per = m.groupBy("key", "component").agg(F.count("*").alias("c"), F.sum("n").alias("s"), F.bit_xor(F.xxhash64("cls")).alias("x"))
    lists = per.groupBy("key").agg(F.max(F.struct("c", "s", "component")).alias("top"), F.sum("c").alias("size"), F.sum("s").alias("n_all"),
                                   F.bit_xor("x").alias("x"), F.count("*").alias("components")).where(f"components > 1 and size >= {least}")
    lists = lists.groupBy("size", "x", "n_all").agg(F.min(F.struct("key", "top")).alias("l")).select(
        F.col("l.key").alias("key"), F.col("l.top.component").alias("most"), "size", "n_all", (F.col("size") - F.col("l.top.c")).alias("minors"),
        (F.col("n_all") - F.col("l.top.s")).alias("n_minor"))
    return m.join(lists, "key").withColumn("major", F.col("component") == F.col("most")).drop("most")


def _blocks(count: str | Column, elements: str | Column, most: int, carried: bool) -> Column:
    by_count = F.ceil((F.col(count) if isinstance(count, str) else count) / most)
    if not carried:
        return F.greatest(by_count, F.lit(1)).cast("int")
    by_size = F.ceil((F.col(elements) if isinstance(elements, str) else elements) / ELEMENTS)
    return F.greatest(by_count, by_size, F.lit(1)).cast("int")


def crossing(m: DataFrame, most: int, carried: bool) -> DataFrame:
    """(key, i, j, block, cls, component): each minor block with every block of its list, i <= j."""
    m = m.withColumns({"p": _blocks("minors", "n_minor", most, carried),
                       "q": _blocks(F.col("size") - F.col("minors"), F.col("n_all") - F.col("n_minor"), most, carried)})
    h = F.xxhash64("cls")
    m = m.withColumn("block", F.when(F.col("major"), F.col("p") + F.pmod(h, F.col("q"))).otherwise(F.pmod(h, F.col("p"))).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("major"), F.col("p")).otherwise(F.col("p") + F.col("q")) - 1))
    return m.withColumn("other", other).select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                                               "block", "cls", "component")


def single(m: DataFrame, seed: int) -> DataFrame:
    """(key, i, j, block, cls, component): each block of a list with itself."""
    block = F.pmod(F.xxhash64("cls", F.lit(seed)), _blocks("size", "n_all", BLOCK, True)).cast("int")
    return m.select("key", block.alias("i"), block.alias("j"), block.alias("block"), "cls", "component")


def hopeful_pairs(t: pa.Table, comparer: Comparer, label: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(x, others) for the pairs of a unit whose labels differ (the caller may unite labels meanwhile) and whose signatures allow
    a link, the likeliest first."""
    block, n = t["block"].to_numpy(), t["n"].to_numpy()
    m = comparer.matrix(t["signature"].to_pylist())
    i, j, key = t["i"][0].as_py(), t["j"][0].as_py(), t["key"][0].as_py()
    right = np.flatnonzero(block == j)
    n_right, m_right = n[right], tuple(a[right] for a in m)
    for x in np.flatnonzero(block == i).tolist():
        open_ = (label[right] != label[x]) & ((right > x) | (i != j))
        places = np.flatnonzero(open_)
        if not len(places):
            continue
        one = tuple(a[x] for a in m)
        if 4 * len(places) < len(right):
            score = comparer.scores(key, n[x], one, n_right[places], tuple(a[places] for a in m_right))
        else:  # all of the block, without copying its signatures
            score = comparer.scores(key, n[x], one, n_right, m_right)[places]
        good = np.flatnonzero(score >= 0)
        yield x, right[places[good[np.argsort(-score[good], kind="stable")]]]


def labels(t: pa.Table) -> np.ndarray:
    return np.unique(t["component"].to_numpy(), return_inverse=True)[1]


def screened(units: DataFrame, info: DataFrame, comparer: Comparer) -> DataFrame:
    """(key, cls) of the members that may link with a member of another component."""
    def compare(t: pa.Table) -> pa.Table:
        hopeful = np.zeros(t.num_rows, bool)
        for x, others in hopeful_pairs(t, comparer, labels(t)):
            hopeful[others] = True
            hopeful[x] |= len(others) > 0
        return t.select(["key", "cls"]).filter(pa.array(hopeful))

    full = units.join(info, "cls").select("key", "i", "j", "block", "cls", "component", "n", "signature")
    return full.groupBy("key", "i", "j").applyInArrow(compare, "key long, cls long").distinct()


def united(units: DataFrame, info: DataFrame, sets: DataFrame, comparer: Comparer) -> DataFrame:
    """(a, b): links that unite components inside the units, at most one fewer than a unit has members."""
    def compare(t: pa.Table) -> pa.Table:
        cls, out = t["cls"].to_numpy(), []
        held, label = [np.frombuffer(x.as_buffer(), np.uint64) for x in t["members"]], labels(t)
        for x, others in hopeful_pairs(t, comparer, label):
            for z in others.tolist():
                if label[z] != label[x] and comparer.links(held[x], held[z]):
                    out.append((int(cls[x]), int(cls[z])))
                    label[label == label[z]] = label[x]
        return pa.table({k: pa.array([p[m] for p in out], pa.int64()) for m, k in enumerate(("a", "b"))})

    full = units.join(info, "cls").join(sets, "cls").select("key", "i", "j", "block", "cls", "component", "n", "signature", "members")
    return full.groupBy("key", "i", "j").applyInArrow(compare, "a long, b long")


def class_ids(slim: DataFrame, parts: DataFrame) -> DataFrame:
    """(cls, component, component_id) of each class: the least doc_id of its component. A component may hold any share of the classes: its
    ids are added up class by class and go back in SALTS copies."""
    own = slim.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("own"))
    c = own.join(parts.withColumnRenamed("node", "cls"), "cls", "left")
    linked = c.where("component is not null").withColumn("salt", F.pmod(F.xxhash64("cls"), F.lit(SALTS)).cast("int"))
    least = linked.groupBy("component").agg(F.min("own").alias("component_id")).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = linked.join(least, ["component", "salt"]).select("cls", "component", "component_id")
    return joined.unionByName(c.where("component is null").select("cls", F.col("cls").alias("component"), F.col("own").alias("component_id")))


def resolve(scratch: Scratch, twins: DataFrame, info: DataFrame, found: DataFrame, sets_of, comparer: Comparer,
            rounds: Sequence[Column], coarse: DataFrame | None = None) -> DataFrame:
    """(node, component) of the linked classes.

    twins: (key, cls, center); info: (cls, n, signature) of their classes; found: the links (a, b) known so far, of which those of
    every member with its list's center are complete. sets_of(classes) gives (cls, members); rounds: for each round of blocks, which
    lists (a condition on key) it takes. coarse: (cls, n, signature) with smaller signatures that are screened first.
    """
    parts = components(scratch, found, "parts")
    members = scratch.save(memberships(twins).join(info.select("cls", "n"), "cls"), "members")
    state = {"members": "members", "least": 3}  # the pair of a list of two is known

    def screen(signatures: DataFrame, name: str) -> bool:
        """Leaves the members that may link with another component; whether there are any."""
        nonlocal members
        lists = apart(members, parts, scratch, f"{name}-apart", state["least"])
        hopeful = scratch.save(screened(crossing(lists, SCREEN, False), signatures, comparer), f"{name}-hopeful")
        members = scratch.save(members.join(hopeful, ["key", "cls"], "left_semi"), name)
        scratch.drop(state["members"], f"{name}-apart", f"{name}-hopeful")
        state.update(members=name, least=2)
        return not members.isEmpty()

    if coarse is not None and not screen(coarse, "screen-0") or not screen(info, "screen-1"):
        return parts
    classes = members.select("cls").distinct()
    sets = scratch.save(sets_of(classes), "sets")
    info = scratch.save(info.join(classes, "cls", "left_semi"), "hopeful-info")

    def step(deal, name: str, condition: Column | None = None):
        nonlocal found, parts
        lists = apart(members if condition is None else members.where(condition), parts, scratch, f"{name}-apart")
        more = scratch.save(united(deal(lists), info, sets, comparer), name)
        new, rows = more.count(), lists.count() if condition is not None else 0
        scratch.drop(f"{name}-apart")
        if new:
            found = found.unionByName(more)
            parts = components(scratch, found, f"{name}-parts")
        return new, rows

    for k, condition in enumerate(rounds):
        new, rows = step(lambda m, k=k: single(m, k), f"round-{k}", condition)
        if new < WORTH * rows or not new:
            break
    if screen(info, "screen-2"):
        step(lambda m: crossing(m, BLOCK, True), "cross")
    return parts
