"""Item-based and user-based collaborative filtering recommendations.

Ratings join neighbours, sum or average by (user, candidate) while dropping candidates the user
already has (marker rows in the same aggregation), rank per user.
What is joined goes to its user once, as short arrays (the neighbours of an item, the rows of a
neighbour); candidates become rows only there, so neither the aggregation nor the ranking shuffles
them. Beyond ``ROUND_ROWS`` candidates the users take turns, so that what one round sends is on disk at a time.
Users with many rows take flat joins and aggregations instead, each partial-aggregated or
partial-limited before its shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recengine.operators.ratings import DEFAULT_UNIT, step_values
from recengine.operators.similarity import cosine_neighbors, pair_partitions
from recengine.operators.skew import DEFAULT_HOT_ROWS, hub_join, profile_keys, salted_join
from recengine.operators.topk import top_k_per_group
from recengine.session import in_rounds, reliable_checkpoint, saved

#: Candidates whose users are served in one round (8 to 12 bytes each on their way to the user).
ROUND_ROWS = 500_000_000
#: Rows of a table that is read several times: more are saved, fewer checkpointed.
SAVED_ROWS = 20_000_000
SCORE_DIGITS = 9  # scores are ranked after rounding, so float summation order cannot reorder them


def truncated(r: DataFrame, value: str = "x", unit: int = DEFAULT_UNIT, name: str = "xt") -> DataFrame:
    """Add the rating truncated to a whole number (toward zero), from its 1/unit steps (doubles: after rounding to 9 digits)."""
    if dict(r.dtypes)[value] == "double":
        whole = F.round(F.col(value) / F.lit(float(unit)), SCORE_DIGITS)
        return r.withColumn(name, whole.cast("bigint"))
    return r.withColumn(name, F.expr(f"`{value}` div {int(unit)}"))


_PACK = 1 << 32


def _fits(p) -> bool:
    """Ids of a key profile are all in [0, 2^31 - 1): with null as 0 and id + 1 otherwise, two pack into one long."""
    return isinstance(p.lo, int) and isinstance(p.hi, int) and p.lo >= 0 and p.hi < (1 << 31) - 1


def _fresh_scores(cand: DataFrame, taken: DataFrame, user: str, item: str, how: str,
                  pack: bool = False) -> DataFrame:
    """Aggregate candidate scores by (user, item), dropping items the user already has.

    The user's own items join the same aggregation as marker rows (null score, flag 1),
    so "not already taken" needs no separate anti join: one hash aggregation, one shuffle,
    partial aggregation before it for candidates and markers alike. With ``pack`` (both
    ids proven to lie in [0, 2^31 - 1)) the aggregation key is one long; null ids are kept
    as ids of their own, as without it.
    """
    marks = taken.select(user, item, F.lit(None).cast("double").alias("_s"), F.lit(1).alias("_t"))
    rows = cand.select(user, item, "_s", F.lit(0).alias("_t")).unionByName(marks)
    agg = F.sum("_s") if how == "sum" else F.avg("_s")
    if not pack:
        return (rows.groupBy(user, item).agg(agg.alias("score"), F.max("_t").alias("_taken"))
                .where(F.col("_taken") == 0).drop("_taken"))
    types = dict(cand.dtypes)
    code = lambda c: F.coalesce(F.col(c).cast("bigint") + 1, F.lit(0))
    back = lambda v, c: F.when(v > 0, v - 1).cast(types[c]).alias(c)
    keyed = rows.select((code(user) * F.lit(_PACK) + code(item)).alias("_k"), "_s", "_t")
    out = keyed.groupBy("_k").agg(agg.alias("score"), F.max("_t").alias("_taken")).where(F.col("_taken") == 0)
    return out.select(back(F.shiftright("_k", 32), user), back(F.col("_k") % F.lit(_PACK), item), "score")


def _local_scores(rows: DataFrame, user: str, item: str, how: str) -> DataFrame:
    """``_fresh_scores`` of ``rows`` (user, item, _s, _t) that are dealt by user: marks have _t 1."""
    agg = F.sum("_s") if how == "sum" else F.avg("_s")
    return (rows.groupBy(user, item).agg(agg.alias("score"), F.max("_t").alias("_taken"))
            .where(F.col("_taken") == 0).drop("_taken"))


def _parts(df: DataFrame, user: str, hot: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """The rows of usual users and those of users with many rows."""
    if hot is None:
        return df, None
    keys = hot.select(user)
    return df.join(keys, user, "left_anti"), df.join(keys, user, "left_semi")


def rounds_of(rows: float) -> int:
    return max(1, math.ceil(rows / ROUND_ROWS))


def _turn(df: DataFrame, user: str, rounds: int, i: int) -> DataFrame:
    """The rows of the users whose turn it is; a null user is one of them."""
    return df if rounds <= 1 else df.where(F.pmod(F.xxhash64(user, F.lit(2)), F.lit(rounds)) == i)


def _kept(df: DataFrame, rows: float) -> DataFrame:
    """``df`` for several readers; ``rows``: a bound of its rows."""
    return saved(df, "kept") if rows > SAVED_ROWS else reliable_checkpoint(df)


def _rank(scores: DataFrame, user: str, item: str, n: int) -> DataFrame:
    ranked = top_k_per_group(scores, [user], [F.round("score", SCORE_DIGITS).desc()], n,
                             ties=[F.col(item).asc()], name="ranking")
    return ranked.select(user, item, "ranking")


def item_cf_recommend(r: DataFrame, *, k_neighbors: int = 12, n: int = 12, user: str = "user_id",
                      item: str = "item_id", value: str = "x", unit: int = DEFAULT_UNIT,
                      out_item: str = "course_id", neighbors: DataFrame | None = None,
                      hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Top-``n`` items per user: score(u, j) = sum over u's items i having j among the
    ``k_neighbors`` most similar items of i, of cos(i, j) * rating(u, i) (not normalised).

    Items u already has are excluded. Output: (user, out_item, ranking).
    """
    r, digits = step_values(r, value, unit=unit)
    prof = profile_keys(r, [item, user], hot_rows=hot_rows)
    hot_items = prof[item].hot
    nb = neighbors if neighbors is not None else cosine_neighbors(
        r, entity=item, by=user, value=value, k=k_neighbors, neighbor="_nb", profile=prof, digits=digits)
    if neighbors is not None:
        nb = nb.select(item, F.col(nb.columns[1]).alias("_nb"), "cos")
    if prof[user].hot is not None:
        nb = _kept(nb, k_neighbors * prof[item].distinct)  # read by both parts
    usual, many = _parts(r.select(user, item, value), user, prof[user].hot)
    # each rating row meets at most k neighbours: the candidates are up to k * rows rows
    width = pair_partitions(r.sparkSession, k_neighbors * prof[item].rows)
    rounds = rounds_of(k_neighbors * prof[item].rows)
    lists = nb.groupBy(item).agg(F.collect_list(F.struct("_nb", "cos")).alias("_l")).select(
        item, F.col("_l._nb").alias("_n"), F.col("_l.cos").alias("_c"))
    lists = lists if rounds <= 1 else saved(lists, "lists")
    kind = dict(r.dtypes)[item]
    theirs = F.transform(F.arrays_zip("_n", "_c"), lambda e: F.struct(
        e["_n"].cast(kind).alias(out_item), (e["_c"] * F.col(value) / F.lit(float(unit))).cast("double").alias("_s"), F.lit(0).alias("_t")))
    mark = F.array(F.struct(F.col(item).alias(out_item), F.lit(None).cast("double").alias("_s"), F.lit(1).alias("_t")))

    def served(i: int) -> DataFrame:
        met = salted_join(_turn(usual, user, rounds, i), lists, item, salt_cols=[user], how="left", hot=hot_items)
        met = met.repartition(max(1, math.ceil(width / rounds)), user)
        rows = met.select(user, F.inline(F.concat(F.coalesce(theirs, F.filter(mark, lambda e: F.lit(False))), mark)))
        return _rank(_local_scores(rows, user, out_item, "sum"), user, out_item, n)

    out = in_rounds(r.sparkSession, rounds, served, "ranked")
    if many is None:
        return out
    cand = (salted_join(many, nb.select(item, "_nb", "cos"), item, salt_cols=[user], hot=hot_items, partitions=width)
            .select(user, F.col("_nb").alias(out_item),
                    (F.col("cos") * F.col(value) / F.lit(float(unit))).alias("_s")))
    taken = many.select(user, F.col(item).alias(out_item))
    pack = _fits(prof[user]) and _fits(prof[item])
    return out.unionByName(_rank(_fresh_scores(cand, taken, user, out_item, "sum", pack), user, out_item, n))


def neighbor_rows(theirs: DataFrame, nb: DataFrame, user: str, item: str, hot_users: DataFrame | None,
                  hot_rows: int) -> DataFrame:
    """Rows of each user's neighbours: ``theirs`` (_nb, item, ...) joined with ``nb`` (user, _nb, cos).

    A user may be in any number of neighbour lists, so both sides of the join are split. The lists
    (k rows per user) are checkpointed once, for the count of the hubs, the exact output size that
    sets the width, and the join.
    """
    nb = reliable_checkpoint(nb)
    size = nb.groupBy("_nb").agg(F.count(F.lit(1)).alias("_d"))
    rows = theirs.groupBy("_nb").agg(F.count(F.lit(1)).alias("_r")).join(size, "_nb")
    out = rows.agg(F.sum(F.col("_d").cast("double") * F.col("_r"))).first()[0] or 0.0
    return hub_join(theirs, nb, "_nb", big_salt=[item], small_salt=[user],
                    hot=None if hot_users is None else hot_users.withColumnRenamed(user, "_nb"),
                    hot_rows=hot_rows, partitions=pair_partitions(nb.sparkSession, out))


def rows_by_user(theirs: DataFrame, nb: DataFrame, user: str, item: str, value: str, hot_users: DataFrame | None,
                 hot_rows: int, then: Callable[[DataFrame], DataFrame], edges: float = 0) -> DataFrame:
    """``then`` of what ``neighbor_rows`` gives, dealt by user, with the user's own rows: (user, cos, _own, item, value), own rows with
    _own 1 and a null cos. ``theirs`` is (_nb, item, value), ``nb`` (user, _nb, cos), ``edges`` a bound of its rows.

    A neighbour's rows are an array (some arrays, for users with many rows) that goes to each user who has the neighbour. ``then``
    gets all rows of a user at once, but not all users: they may take turns.
    """
    spark = nb.sparkSession
    nb = _kept(nb.select(user, "_nb", "cos"), edges)
    degree = nb.groupBy("_nb").agg(F.count(F.lit(1)).alias("_d"))
    rows = theirs.groupBy("_nb").agg(F.count(F.lit(1)).alias("_r")).join(degree, "_nb", "left")
    made = rows.agg(F.sum((F.coalesce("_d", F.lit(0)) + 1).cast("double") * F.col("_r"))).first()[0] or 0.0
    rounds = rounds_of(made)
    width = max(1, math.ceil(pair_partitions(spark, made) / rounds))
    hubs = degree.where(F.col("_d") >= hot_rows).select("_nb", F.ceil((F.col("_d") + 1) / hot_rows).cast("int").alias("_s"))
    hubs = None if hubs.isEmpty() else hubs
    own = nb.select(user).distinct().select(user, F.col(user).alias("_nb"), F.lit(None).cast("double").alias("cos"), F.lit(1).alias("_own"))
    edges = nb.withColumn("_own", F.lit(0)).unionByName(own)
    part = F.lit(0)
    if hot_users is not None:
        theirs = theirs.join(hot_users.withColumnRenamed(hot_users.columns[0], "_nb"), "_nb", "left")
        part = F.pmod(F.xxhash64(item), F.coalesce("_s", F.lit(1)))
    lists = theirs.groupBy("_nb", part.alias("_p")).agg(F.collect_list(F.struct(F.col(item).alias("i"), F.col(value).alias("v"))).alias("_l"))
    lists = lists.select("_nb", F.col("_l.i").alias(item), F.col("_l.v").alias(value))
    lists = lists if rounds <= 1 else saved(lists, "lists")

    def served(i: int) -> DataFrame:
        met = salted_join(_turn(edges, user, rounds, i), lists, "_nb", salt_cols=[user], hot=hubs)
        met = met.select(user, "cos", "_own", item, value).repartition(width, user)
        return then(met.select(user, "cos", "_own", F.inline(F.arrays_zip(item, value))))

    return in_rounds(spark, rounds, served, "served")


def user_cf_recommend(r: DataFrame, *, k_neighbors: int = 12, n: int = 12, user: str = "user_id",
                      item: str = "item_id", value: str = "x", unit: int = DEFAULT_UNIT,
                      out_item: str = "course_id", neighbors: DataFrame | None = None,
                      hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Top-``n`` items per user: score(u, j) = average over u's ``k_neighbors`` most similar
    users v that have j, of cos(u, v) * rating(v, j).

    The user similarity uses ratings truncated to whole numbers; the scores use the full
    ratings. Items u already has are excluded. Output: (user, out_item, ranking).
    """
    r, _ = step_values(r, value, unit=unit)
    prof = profile_keys(r, [user, item], hot_rows=hot_rows)
    hot_users = prof[user].hot
    nb = neighbors if neighbors is not None else cosine_neighbors(
        truncated(r, value, unit), entity=user, by=item, value="xt", k=k_neighbors, neighbor="_nb",
        profile=prof)
    if neighbors is not None:
        nb = nb.select(user, F.col(nb.columns[1]).alias("_nb"), "cos")
    theirs = r.select(F.col(user).alias("_nb"), F.col(item).alias(out_item), value)
    if hot_users is not None:
        nb = _kept(nb, k_neighbors * prof[user].distinct)  # read by both parts
    usual, many = _parts(nb, user, hot_users)
    score = (F.col("cos") * F.col(value) / F.lit(float(unit))).cast("double").alias("_s")

    def ranked(rows: DataFrame) -> DataFrame:
        rows = rows.select(user, out_item, score, F.col("_own").alias("_t"))
        return _rank(_local_scores(rows, user, out_item, "avg"), user, out_item, n)

    out = rows_by_user(theirs, usual, user, out_item, value, hot_users, hot_rows, ranked, k_neighbors * prof[user].distinct)
    if many is None:
        return out
    cand = neighbor_rows(theirs, many.select(user, "_nb", "cos"), user, out_item, hot_users, hot_rows)
    taken = _parts(r.select(user, F.col(item).alias(out_item)), user, hot_users)[1]
    pack = _fits(prof[user]) and _fits(prof[item])
    cand = cand.select(user, out_item, score)
    return out.unionByName(_rank(_fresh_scores(cand, taken, user, out_item, "avg", pack), user, out_item, n))
