"""Quality rules (operator 6, DataFrame functions only): robust multivariate outliers by minimum covariance determinant.

Each text gives the counts n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words, all over the whole text and inside
its row. Their vector, on logarithmic scales: word length, symbols per word, share of repeated lines, share of repeated words. For
each (lang, source) the location and scatter of the vectors come from the ``H`` = half of the rows with the least
covariance determinant: from each of STARTS (quantiles as locations, absolute deviations from the medians as scales), concentration steps take the
half nearest by Mahalanobis distance and estimate mean and covariance from it again, corrected for consistency at the normal
distribution, until no determinant falls any more; the start with the least determinant gives the estimate. A document is rejected beyond ``CUTOFF``.

Equal vectors are one row with a weight. Quantiles and the half are read off histograms (GRID buckets a unit, OCTAVE buckets a doubling of the distance):
of the bucket in which the half ends, each vector counts with the share that fills the half, so copies, whatever their number, weigh no more than
there is room for. All statistics are partial aggregations per group, so a group may hold any share of the rows; a window sees a group's buckets only.

Documents of groups with fewer than MIN_GROUP rows are measured from their own group's medians, with a scatter estimated over all such groups together.
Scatter never falls below FLOOR per coordinate: smaller differences are no deviations
(most texts have no symbols or repeated lines at all). Only documents that pass the base rules enter estimates, and all of them are judged.

Null text has no words and fails the base rules; null lang or source is a group of its own. Windows shorter than three
words don't exist; lines without a word don't count.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recengine.llm.common import Scratch, table

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
H = 0.5
STARTS = (0.5, 0.25, 0.75)
MIN_GROUP = 30
#: Buckets of a histogram of values (a unit) and of distances (a doubling); least fall of a logarithmic determinant that calls for another step.
GRID, OCTAVE, FALL = 4096, 1024, 1e-4
#: Steps after which the search is given up with an error; groups that are broadcast at most (beyond it Spark chooses the join).
STEPS, BROADCAST_GROUPS = 1000, 100_000
FLOOR = {"x_length": 0.05, "x_symbols": 0.05, "x_lines": 0.05, "x_repeat": 0.05}
X = tuple(FLOOR)
#: Chi-square with 4 degrees of freedom: its upper tail is exp(-t/2) * (1 + t/2), 0.001 at 18.467.
CUTOFF = 18.467


def base_counts(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words to (doc_id, lang, source, text)."""
    d = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    d = d.withColumns({"w": F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), ""), "lines": lines,
                       "bare": F.translate("text", SPACE, "")})
    # hash of each three-word window; the last two places have none
    windows = F.slice(F.transform("w", lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2))),
                      F.lit(1), F.greatest(F.size("w") - 2, F.lit(0)))
    d = d.select("doc_id", "lang", "source", F.size("w").cast("long").alias("n_words"),
                 F.char_length("bare").cast("long").alias("word_chars"),
                 (F.char_length("bare") - F.char_length(F.translate("bare", SYMBOLS, ""))).cast("long").alias("n_symbols"),
                 F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), windows.alias("h"))
    d = d.withColumn("s", F.when(F.size(F.array_distinct("h")) < F.size("h"),
                                 F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    twin = lambda e, i: ((F.get("s", i - 1)["x"] == e["x"]) & (i > 0)) | (F.get("s", i + 1)["x"] == e["x"])
    d = d.withColumn("p", F.array_sort(F.transform(F.filter("s", lambda e, i: F.coalesce(twin(e, i), F.lit(False))),
                                                   lambda e: e["i"])))
    # a repeated window adds its three words, less those that the next one also covers
    covered = F.aggregate(F.transform("p", lambda x, i: F.least(F.coalesce(F.get("p", i + 1) - x, F.lit(3)), F.lit(3))),
                          F.lit(0).cast("long"), lambda a, x: a + x)
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("h", "s", "p")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def consistency(h: float, p: int = 4) -> float:
    """h over the share of variance that a normal distribution has within its h nearest (p even: closed forms)."""
    def below(t, dof):  # chi-square distribution function
        return 1 - math.exp(-t / 2) * sum((t / 2) ** k / math.factorial(k) for k in range(dof // 2))
    lo, hi = 0.0, 200.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid, p) < h else (lo, mid)
    return h / below(lo, p + 2)


def distance(x: tuple[str, ...]) -> Column:
    """Squared Mahalanobis distance from the columns m_i (means) and l_i_j (Cholesky factor)."""
    z: list[Column] = []
    for i, name in enumerate(x):
        left = F.col(name) - F.col(f"m_{i}")
        for j in range(i):
            left = left - F.col(f"l_{i}_{j}") * z[j]
        z.append(left / F.col(f"l_{i}_{i}"))
    return sum((c * c for c in z[1:]), z[0] * z[0])


def cholesky(cov: DataFrame, x: tuple[str, ...]) -> DataFrame:
    """Adds l_i_j, the factor of the covariances c_i_j (i >= j), column by column."""
    for j in range(len(x)):
        for i in range(j, len(x)):
            left = F.col(f"c_{i}_{j}")
            for k in range(j):
                left = left - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            cov = cov.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(left, F.lit(1e-12))) if i == j else left / F.col(f"l_{j}_{j}"))
    return cov


def cut(histogram: DataFrame, keys: list[str], share: float) -> DataFrame:
    """(keys, at, part) of a histogram (keys, b, n): the bucket in which ``share`` of a key's rows ends, and the part of it that belongs to
    the share. The window sees the buckets of one key."""
    run = Window.partitionBy(*keys).orderBy("b")
    h = histogram.withColumns({"upto": F.sum("n").over(run), "all": F.sum("n").over(Window.partitionBy(*keys))})
    ends = h.where(F.col("upto") >= F.col("all") * share).groupBy(*keys).agg(F.min_by(F.struct("b", "n", "upto", "all"), "b").alias("x"))
    return ends.select(*keys, F.col("x.b").alias("at"), ((F.col("x.all") * share - F.col("x.upto") + F.col("x.n")) / F.col("x.n")).alias("part"))


def quantiles(values: DataFrame, share: float, name: str) -> DataFrame:
    """(g, <name>_i): quantiles of the coordinates of (g, i, x, n)."""
    h = values.groupBy("g", "i", F.floor(F.col("x") * GRID).alias("b")).agg(F.sum("n").alias("n"))
    at = cut(h, ["g", "i"], share).select("g", "i", ((F.col("at") + 0.5) / GRID).alias("q"))
    return at.groupBy("g").agg(*[F.max(F.when(F.col("i") == k, F.col("q"))).alias(f"{name}_{k}") for k in range(len(X))])


def estimates(v: DataFrame, scratch: Scratch) -> DataFrame:
    """Location and factored scatter of each group ``g`` of the weighted vectors (g, X, n): (g, m_i, l_i_j)."""
    n = len(X)
    pairs = [(i, j) for i in range(n) for j in range(i + 1)]
    long = v.select("g", "n", F.posexplode(F.array(*X)).alias("i", "x"))
    places = [scratch.save(quantiles(long, share, f"q{k}"), f"place{k}") for k, share in enumerate(STARTS)]
    middle = places[0].select("g", F.array(*[f"q0_{i}" for i in range(n)]).alias("mid"))
    away = long.join(middle, "g").select("g", "i", F.abs(F.col("x") - F.get("mid", F.col("i"))).alias("x"), "n")
    scales = scratch.save(quantiles(away, 0.5, "a"), "scales")
    params = None
    for k, place in enumerate(places):
        one = place.join(scales, "g").select("g", F.lit(k).alias("start"), *[F.col(f"q{k}_{i}").alias(f"m_{i}") for i in range(n)], *[
            (F.greatest(F.col(f"a_{i}") * 1.4826, F.lit(FLOOR[X[i]])) if i == j else F.lit(0.0)).alias(f"l_{i}_{j}") for i, j in pairs],
            F.lit(math.inf).alias("log_det"))
        params = one if params is None else params.unionByName(one)
    params = scratch.save(params, "step0")
    scratch.drop("scales", *[f"place{k}" for k in range(len(STARTS))])
    factor = consistency(H, n)
    for step in range(1, STEPS + 1):
        far = v.join(params, "g").withColumn("b", F.floor(F.log2(distance(X) + 2.0 ** -20) * OCTAVE))
        near = scratch.save(cut(far.groupBy("g", "start", "b").agg(F.sum("n").alias("n")), ["g", "start"], H), f"near{step}")
        w = F.col("n") * F.when(F.col("b") < F.col("at"), 1.0).when(F.col("b") == F.col("at"), F.col("part")).otherwise(0.0)
        z = [F.col(X[i]) - F.col(f"m_{i}") for i in range(n)]
        held = far.join(near, ["g", "start"]).where("b <= at").select("g", "start", *[f"m_{i}" for i in range(n)], w.alias("w"), *[
            z[i].alias(f"z_{i}") for i in range(n)])
        sums = held.groupBy("g", "start").agg(F.sum("w").alias("w"), *[F.max(f"m_{i}").alias(f"m_{i}") for i in range(n)],
                                              *[F.sum(F.col("w") * F.col(f"z_{i}")).alias(f"s_{i}") for i in range(n)],
                                              *[F.sum(F.col("w") * F.col(f"z_{i}") * F.col(f"z_{j}")).alias(f"s_{i}_{j}") for i, j in pairs])
        mean = [F.col(f"s_{i}") / F.col("w") for i in range(n)]
        cov = sums.select("g", "start", *[(F.col(f"m_{i}") + mean[i]).alias(f"m_{i}") for i in range(n)], *[
            ((F.col(f"s_{i}_{j}") / F.col("w") - mean[i] * mean[j]) * factor + (FLOOR[X[i]] ** 2 if i == j else 0)).alias(f"c_{i}_{j}")
            for i, j in pairs])
        cov = cholesky(cov, X).drop(*[f"c_{i}_{j}" for i, j in pairs])
        last = params.select("g", "start", F.col("log_det").alias("before"))
        params = scratch.save(cov.withColumn("log_det", sum(F.log(f"l_{i}_{i}") for i in range(n))), f"step{step}")
        falls = not params.join(last, ["g", "start"]).where(F.col("before") - F.col("log_det") > FALL).isEmpty()
        scratch.drop(f"near{step}", f"step{step - 1}")
        if not falls:
            break
    else:
        raise RuntimeError(f"no least determinant after {STEPS} steps")
    # nearly equal determinants: the earlier start
    best = params.groupBy("g").agg(F.min_by("start", F.struct(F.round("log_det", 3), "start")).alias("start"))
    return params.join(best, ["g", "start"]).drop("start", "log_det")


def quality_rules(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """(doc_id, counts, base_failed, distance, kept) per row of ``docs``; distance is null where the base rules fail."""
    scratch = Scratch(docs.sparkSession, "quality")
    d = scratch.save(base_counts(docs).withColumn("base_failed", base_failed()), "counts")
    share = lambda a, b: F.log1p(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    d = d.withColumns({"x_length": F.log(F.greatest("word_chars", F.lit(1)) / F.greatest("n_words", F.lit(1))),
                       "x_symbols": share("n_symbols", "n_words"), "x_lines": share("n_dup_lines", "n_lines"),
                       "x_repeat": share("n_repeat_words", "n_words"), "key": F.to_json(F.struct("lang", "source"))})
    same = scratch.save(d.where(~F.col("base_failed")).groupBy("key", *X).agg(F.count("*").alias("n")), "vectors")
    sizes = same.groupBy("key").agg(F.sum("n").alias("size"))
    few = same.join(sizes.where(F.col("size") < MIN_GROUP).select("key"), "key")  # fewer than MIN_GROUP rows a key
    centres = few.groupBy("key").agg(*[F.expr(f"percentile({x}, 0.5, n)").alias(f"o_{i}") for i, x in enumerate(X)])
    groups = scratch.save(sizes.join(centres, "key", "left").select(
        "key", F.when(F.col("size") < MIN_GROUP, F.lit("")).otherwise(F.col("key")).alias("g"),
        *[F.coalesce(f"o_{i}", F.lit(0.0)).alias(f"o_{i}") for i in range(len(X))]), "groups")
    moved = same.join(groups, "key").select("g", *[(F.col(x) - F.col(f"o_{i}")).alias(x) for i, x in enumerate(X)], "n")
    v = scratch.save(moved.groupBy("g", *X).agg(F.sum("n").alias("n")), "moved")
    found = scratch.save(groups.join(estimates(v, scratch), "g").select("key", *[
        (F.col(f"m_{i}") + F.col(f"o_{i}")).alias(f"m_{i}") for i in range(len(X))], *[f"l_{i}_{j}" for i in range(len(X)) for j in range(i + 1)]), "found")
    scratch.drop(*[name for name in scratch.paths if name not in ("counts", "found")])
    judged = d.join(F.broadcast(found) if found.count() <= BROADCAST_GROUPS else found, "key", "left")
    judged = judged.withColumn("distance", F.when(~F.col("base_failed"), distance(X)))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "distance", (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)).alias("kept"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("distance")
