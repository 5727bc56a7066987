"""Counts, cardinalities and value counts (catalogue summaries)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recengine.functions.columns import nulls_one
from recengine.operators.bitmaps import WHOLE, distinct_counts, stacked_ids


def group_count(df: DataFrame, keys: Sequence[str], name: str = "cnt", *, sort: bool = False) -> DataFrame:
    """Rows per group of ``keys`` (null is a group); optionally sorted by count desc, keys.

    Partial counts are combined map-side, so a hot key costs one row per map task.
    """
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    if sort:
        out = out.orderBy(F.col(name).desc(), *[F.col(k).asc_nulls_first() for k in keys])
    return out


def cardinality_summary(columns: Mapping[str, tuple[DataFrame, str]], *, approx: bool = False) -> DataFrame:
    """One row with the number of distinct values per named column; null counts as one.

    ``columns`` maps an output name to (frame, column). Columns of the same frame are
    counted from one scan, whole numbers by bitmaps and others by their distinct values (``bitmaps``); the
    one-row results are merged by a union and a global aggregate (no join). Output columns follow the order of ``columns``. ``approx`` trades
    exactness for a single pass without shuffling distinct values (HyperLogLog++).
    """
    by_frame: dict[int, tuple[DataFrame, list[tuple[str, str]]]] = {}
    for out_name, (df, col) in columns.items():
        by_frame.setdefault(id(df), (df, []))[1].append((out_name, col))
    parts = [df.agg(*[nulls_one(c, approx).alias(n) for n, c in cols]) if approx else distinct_counts(dict(cols), df)
             for df, cols in by_frame.values()]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p, allowMissingColumns=True)
    if len(parts) > 1:
        merged = merged.agg(*[F.max(n).alias(n) for n in columns])
    return merged.select(*columns)


def stacked_value_counts(df: DataFrame, cols: Sequence[str], value: str = "value",
                         name: str = "cnt") -> DataFrame:
    """Value counts of several columns stacked (UNION ALL): (value, count) rows.

    A value found in two columns gives two rows. One scan: every row is expanded to one
    (column index, value) pair per column and counted once.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("_src"), F.col(c).cast("string").alias(value))
                      for i, c in enumerate(cols)])
    return (df.select(F.inline(pairs))
            .groupBy("_src", value).agg(F.count(F.lit(1)).alias(name))
            .select(value, name))


def rating_profile(r: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """One row: number of interactions, distinct users, distinct items (null counts as one).

    Whole-number ids are counted by bitmaps from one scan, which counts the rows as well."""
    kinds = dict(r.dtypes)
    if kinds[user] not in WHOLE or kinds[item] not in WHOLE:
        counts = distinct_counts({"n_users": user, "n_items": item}, r)
        n = r.agg(F.count(F.lit(1)).alias("n_ratings"))
        both = n.unionByName(counts, allowMissingColumns=True)
        return both.agg(*[F.max(c).alias(c) for c in ("n_ratings", "n_users", "n_items")])
    b = stacked_ids(r, [user, item])
    of = lambda k, v: F.coalesce(F.sum(F.when(F.col("_k") == k, v)), F.lit(0)).cast("bigint")
    ids = F.bitmap_count("bitmap")
    return b.agg(of(0, F.col("n")).alias("n_ratings"), of(0, ids).alias("n_users"), of(1, ids).alias("n_items"))
