"""Mixing sources to target weights (operator 10): hash-threshold histograms.

Every document has a fixed pseudo-random key, 60 bits of md5(seed and doc_id). A source's budget is met by taking the
documents whose key lies below a threshold. To find it, the sizes are summed by (source, first 12 bits of the key);
the histogram's running sum shows the bucket where the budget is reached; only the documents in that bucket are
summed again by the next 12 bits, and so on. No documents are sorted, and thresholds for larger budgets contain those
for smaller ones. A hot source is pre-aggregated to at most 4096 rows by each map task.

Sources by code point (null last) have weights 5, 2, 1, repeating; together they share ``share`` times all words; a
source's target stops at ``max_repeat`` times its size and the excess goes to the others by weight until none is above
its limit. That is target = min(limit, level * weight) with one common level, found over one row per source.

Targets of up to one pass take part of the documents once; beyond it, every document is taken once and part of them
twice, so no document exceeds ``max_repeat`` = 2 times its size. Documents without words have size 0 and take nothing.
Rows with equal doc_id have equal keys and are taken or left together. An empty table gives no rows; a source without
words has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recengine.llm.common import Scratch, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
SEED = "mix"
LEVELS = 5
BITS = 12


def count_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def mix_key(doc_id: Column, seed: str = SEED) -> Column:
    """60 pseudo-random bits that depend on the seed and doc_id alone (null counts as the text 'null')."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   max_repeat: int = 2) -> DataFrame:
    """Targets (source, source_size, target) from (source, source_size), one row per source."""
    # one row per source from here on: windows without partitions see a bounded list of names
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1)
                     .cast("int"))
    s = sizes.withColumn("weight", w).withColumn("limit", (F.col("source_size") * max_repeat).cast("double"))
    s = s.withColumn("ratio", F.col("limit") / F.col("weight"))
    up = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    rest = up.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    level = (total * share - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    s = s.withColumn("level", level)
    # the level is that of the first source, by ratio, that stays within its limit
    found = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(Window.partitionBy())
    target = F.coalesce(F.least(F.col("limit"), found["level"] * F.col("weight")), F.col("limit"))
    return s.select("source", "source_size", target.alias("target"))


def key_thresholds(sized: DataFrame, budgets: DataFrame, scratch: Scratch) -> DataFrame:
    """For (source, budget): a ``threshold`` so that documents with a smaller key have about ``budget`` words.

    ``sized``: (source, key, size). The bucket that the budget ends in is refined LEVELS times by BITS bits; of the
    last one the nearer side is taken.
    """
    # at each level: the words below the open bucket, and the open bucket's number among those of its level
    open_, same = budgets.withColumn("below", F.lit(0).cast("long")).withColumn("bucket", F.lit(0).cast("long")), []
    for level in range(1, LEVELS + 1):
        shift = 60 - BITS * level
        inside = sized.join(open_.select(F.col("source").alias("s"), F.col("bucket").alias("parent")),
                            F.col("source").eqNullSafe(F.col("s")) &
                            (F.shiftright("key", shift + BITS) == F.col("parent")))
        sums = inside.groupBy("source", F.shiftright("key", shift).alias("b")).agg(F.sum("size").alias("words"))
        run = Window.partitionBy("source").orderBy("b")
        h = sums.withColumn("upto", F.sum("words").over(run))
        o = open_.select(F.col("source").alias("s"), "budget", "below")
        h = h.join(o, F.col("source").eqNullSafe(F.col("s")))
        # the first bucket whose end reaches the budget
        hit = (h.where(F.col("below") + F.col("upto") >= F.col("budget")).groupBy("source", "budget")
               .agg(F.min_by(F.struct("b", "words", (F.col("below") + F.col("upto") - F.col("words")).alias("below")), "b")
                    .alias("x")))
        open_ = scratch.save(hit.select("source", "budget", F.col("x.below").alias("below"),
                                        F.col("x.b").alias("bucket"), F.col("x.words").alias("words")), f"level{level}")
    nearer = F.when(F.col("below") + F.col("words") - F.col("budget") < F.col("budget") - F.col("below"),
                    F.col("bucket") + 1).otherwise(F.col("bucket"))
    return open_.select("source", nearer.alias("threshold"))


def mix_plan(docs: DataFrame, weights: tuple[int, ...], share: float, seed: str) -> tuple[DataFrame, DataFrame]:
    """(sized, plan): (doc_id, source, size, key) of every row, and per source ``s`` (source_size, target, base, threshold)."""
    scratch = Scratch(docs.sparkSession, "mix")
    sized = scratch.save(docs.select("doc_id", "source", count_words(F.col("text")).alias("size"),
                                     mix_key(F.col("doc_id"), seed).alias("key")), "sized")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = scratch.save(source_targets(totals, weights, share), "targets")
    extra = F.when(F.col("target") >= F.col("source_size"), F.col("target") - F.col("source_size")).otherwise(F.col("target"))
    budgets = targets.select("source", extra.alias("budget")).where("budget > 0")
    cuts = key_thresholds(sized.select("source", "key", "size"), budgets, scratch)
    plan = targets.join(cuts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").select(
        F.col("source").alias("s"), "source_size", "target", (F.col("target") >= F.col("source_size")).cast("int").alias("base"),
        F.coalesce("threshold", F.lit(0)).alias("threshold"))
    return sized, scratch.save(plan, "plan")


def copies(key: Column) -> Column:
    """How often the mix takes a document, beside its source's plan."""
    return F.col("base") + (key < F.col("threshold")).cast("int")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken): a row for each row of ``docs``."""
    sized, plan = mix_plan(docs, weights, share, seed)
    n = copies(F.col("key"))
    return (sized.join(plan, F.col("source").eqNullSafe(F.col("s")))
            .select("doc_id", "source", "size", "source_size", "target", n.alias("copies"), (F.col("size") * n).alias("taken")))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, seed: str = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (0, 1 or 2 times)."""
    _, plan = mix_plan(docs, weights, share, seed)
    # the row goes along as one value, so that its columns' names don't matter
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("source").alias("of"), mix_key(F.col("doc_id"), seed).alias("key"))
    taken = d.join(plan, F.col("of").eqNullSafe(F.col("s"))).withColumn("n", copies(F.col("key"))).where("n > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("n")))).select("row.*")


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


_WORDS = "coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint"

#: The same mix in SQL: here the threshold is found by a running sum over sorted keys, with the nearer side of the
#: last bucket (single keys, as 60 bits separate documents).
OP10_SQL = f"""
with d as (select doc_id, source, {_WORDS} as size,
      ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::varchar, 'null')), 1, 15))::bigint as key from documents),
 t as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as r from d group by source),
 w as (select *, [5, 2, 1][((r - 1) % 3) + 1] as weight, (2 * source_size)::double as lim from t),
 v as (select *, (sum(source_size) over () * {SHARE}
        - coalesce(sum(lim) over (order by lim / weight, source rows between unbounded preceding and 1 preceding), 0))
        / sum(weight) over (order by lim / weight, source rows between current row and unbounded following) as level from w),
 l as (select arg_min(level, lim / weight) filter (level <= lim / weight) as level from v),
 g as (select w.source, w.source_size, coalesce(least(w.lim, l.level * w.weight), w.lim) as target from w, l),
 k as (select d.source, d.key, sum(d.size) as words from d group by d.source, d.key),
 c as (select k.*, sum(words) over (partition by source order by key) as upto from k),
 b as (select c.source, c.key, c.words, c.upto - c.words as below,
        case when g.target >= g.source_size then g.target - g.source_size else g.target end as budget
       from c join g on c.source is not distinct from g.source),
 x as (select source, arg_min(case when below + words - budget < budget - below then key + 1 else key end, key) as threshold
       from b where budget > 0 and below + words >= budget group by source)
select d.doc_id, d.size, g.source_size, g.target,
  (d.size * ((g.target >= g.source_size)::int + coalesce(d.key < x.threshold, false)::int))::bigint as taken
from d join g on d.source is not distinct from g.source left join x on d.source is not distinct from x.source
"""
