"""Top-k per group and the side-by-side placement of several rankings.

``row_number() <= k`` lets Catalyst plan a partial ``WindowGroupLimit`` before the shuffle,
so each map task forwards at most k rows per group: a hot group (say a third of all rows)
reaches the final window as k rows per map task, never as the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cs) -> list[Column]:
    if cs is None:
        return []
    if isinstance(cs, (str, Column)):
        cs = [cs]
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def top_k_per_group(df: DataFrame, by, order, k: int, *, ties=(), name: str = "rn") -> DataFrame:
    """Keep the first ``k`` rows of every ``by`` group under ``order`` (+ ``ties``).

    Exactly ``min(k, group size)`` rows per group (``row_number``); ``ties`` are extra
    ordering columns that make the choice deterministic. Null group keys form a group.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    w = Window.partitionBy(*_cols(by)).orderBy(*_cols(order), *_cols(ties))
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def ranked_entities(df: DataFrame, group: Sequence[str], entities: Sequence[str], measure: str, *,
                    k: int = 10, id_col: str | None = None) -> DataFrame:
    """Top-``k`` entities per group, for several entity columns in one pass.

    For each entity column ``e`` (kind ``i``) rows are summed by (group, [id], e) and ranked
    per group by the sum, descending; ties go to the smaller entity (nulls first), then to
    the smaller id. The input is scanned once: each row is expanded to one row per kind and
    a single aggregation and a single window serve all kinds.

    Returns the long form (_kind, *group, [id], _entity, _value, rn).
    """
    kinds = F.array(*[F.struct(F.lit(i).alias("_kind"), F.col(e).cast("string").alias("_entity"))
                      for i, e in enumerate(entities)])
    keep = [F.col(g) for g in group] + ([F.col(id_col)] if id_col else [])
    long = (df.select(*keep, F.col(measure).cast("bigint").alias("_m"), F.inline(kinds)))
    keys = ["_kind", *group] + ([id_col] if id_col else []) + ["_entity"]
    agg = long.groupBy(*keys).agg(F.sum("_m").alias("_value"))
    ties = [F.col("_entity").asc_nulls_first()] + ([F.col(id_col).asc_nulls_first()] if id_col else [])
    return top_k_per_group(agg, ["_kind", *group], [F.col("_value").desc_nulls_last()], k, ties=ties)


def zip_ranked(ranked: DataFrame, group: Sequence[str], entities: Sequence[str], *,
               value_names: Sequence[str], how: str = "left", rank: str = "rn",
               with_rank: bool = True) -> DataFrame:
    """Place the rankings of ``ranked_entities`` side by side on (group, rank).

    ``how="left"`` keeps every row of the first ranking; the others are matched on equal
    group keys and rank, so a null group key never matches (their columns stay null).
    ``how="inner"`` keeps only positions present in every ranking, with non-null keys.
    The rankings are small (k rows per group and kind), so this is one small aggregation.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    # one element per kind at most: a bounded list, aggregated by hash
    z = ranked.groupBy(*group, rank).agg(F.collect_list(F.struct(
        F.col("_kind").alias("k"), F.col("_entity").alias("e"), F.col("_value").alias("v"))).alias("_l"))
    def of_kind(i):
        return lambda x: x["k"] == F.lit(i)

    z = z.select(*group, rank, *[F.get(F.filter("_l", of_kind(i)), 0).alias(f"_z{i}")
                                 for i in range(len(entities))])
    keys_ok = F.lit(True)
    for g in group:
        keys_ok = keys_ok & F.col(g).isNotNull()
    if how == "left":
        z = z.where(F.col("_z0").isNotNull())
    else:
        cond = keys_ok
        for i in range(len(entities)):
            cond = cond & F.col(f"_z{i}").isNotNull()
        z = z.where(cond)
    out = [F.col(g) for g in group]
    for i, (e, v) in enumerate(zip(entities, value_names)):
        slot = F.col(f"_z{i}")
        if i > 0 and how == "left":
            slot = F.when(keys_ok, slot)
        out += [slot["e"].alias(e), slot["v"].alias(v)]
    if with_rank:
        out.append(F.col(rank))
    return z.select(*out)


def zip_frames(frames: Sequence[DataFrame], keys: Sequence[str], *, how: str = "left", rank: str = "rn") -> DataFrame:
    """Place separately ranked frames side by side on (keys, rank): keys, rank, then the other columns of each frame in turn.

    Each frame has at most one row per (keys, rank), as ``top_k_per_group`` gives it, and its own value columns.
    ``how="left"`` keeps every row of the first frame, ``"inner"`` the positions present in all; a null key matches
    nothing. Joins of frames of k rows per group, dealt by the keys alone where Spark need not broadcast them.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    on = [*keys, rank]
    names = [c for f in frames for c in f.columns if c not in on]
    if len(names) != len(set(names)):
        raise ValueError(f"value columns of the frames repeat: {names}")
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, on, how)
    if how == "inner":
        for k in keys:  # a single frame has its null keys dropped as well
            out = out.where(F.col(k).isNotNull())
    return out.select(*keys, rank, *names)
