"""Exact distinct counts by bitmaps: mergeable, per day or whole.

A whole-number id belongs to bucket ``bitmap_bucket_number(id)`` at position ``bitmap_bit_position(id)``; the ids of a group are one bitmap of
32,768 bits per bucket that occurs. Bitmaps of days, tables or partitions are merged by OR, and the sum of their bit counts is the exact
number of distinct ids: no distinct rows are shuffled twice and no row is expanded per counted column. A null id has a bucket of its own (null), so
that null counts as one value.

A bitmap takes 4 KB however few of its ids occur, so ids should be dense (``clean.dense_ids`` maps others). Columns of other types are
counted by one aggregation over stacked (column, value) rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WHOLE = ("tinyint", "smallint", "int", "bigint")


def _parts(col) -> tuple:
    """(bucket, position) of an id; a null id is position 0 of the null bucket."""
    return F.bitmap_bucket_number(col).alias("bucket"), F.coalesce(F.bitmap_bit_position(col), F.lit(0))


def id_bitmaps(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., bucket, bitmap): the distinct ids of ``col`` per group."""
    bucket, position = _parts(F.col(col).cast("bigint"))
    return (df.select(*by, bucket, position.alias("_p")).groupBy(*by, "bucket")
            .agg(F.bitmap_construct_agg("_p").alias("bitmap")))


def merged_bitmaps(*bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The bitmaps of several frames (or finer groups) as one per (by..., bucket)."""
    whole = bitmaps[0].select(*by, "bucket", "bitmap")
    for b in bitmaps[1:]:
        whole = whole.unionByName(b.select(*by, "bucket", "bitmap"))
    return whole.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def bitmap_counts(bitmaps: DataFrame, by: Sequence[str] = (), name: str = "distinct") -> DataFrame:
    """Distinct ids per group (null as one) of bitmaps that are merged: one per (by..., bucket)."""
    n = F.sum(F.bitmap_count("bitmap"))
    return bitmaps.groupBy(*by).agg((n if by else F.coalesce(n, F.lit(0))).cast("bigint").alias(name))


def stacked_ids(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(_k, bucket, bitmap, n): bitmaps and row counts of several id columns from one scan; _k is the column's place."""
    pairs = F.array(*[F.struct(F.lit(k).alias("_k"), F.col(c).cast("bigint").alias("_v")) for k, c in enumerate(cols)])
    long = df.select(F.inline(pairs))
    bucket, position = _parts(F.col("_v"))
    return (long.select("_k", bucket, position.alias("_p")).groupBy("_k", "bucket")
            .agg(F.bitmap_construct_agg("_p").alias("bitmap"), F.count(F.lit(1)).alias("n")))


def distinct_counts(columns: Mapping[str, str], df: DataFrame) -> DataFrame:
    """One row with the number of distinct values of each column of ``df``, null as one. columns: output name -> column.

    Whole-number columns are counted by bitmaps, the others by their distinct (column, value) rows."""
    kinds = dict(df.dtypes)
    ids = {n: c for n, c in columns.items() if kinds[c] in WHOLE}
    rest = {n: c for n, c in columns.items() if n not in ids}
    found = []
    if ids:
        found.append(stacked_ids(df, list(ids.values())).groupBy("_k").agg(F.sum(F.bitmap_count("bitmap")).alias("_n"))
                     .select(F.element_at(F.array(*map(F.lit, ids)), F.col("_k") + 1).alias("_name"), "_n"))
    if rest:
        pairs = F.array(*[F.struct(F.lit(n).alias("_name"), F.to_json(F.struct(F.col(c).alias("v"))).alias("_v")) for n, c in rest.items()])
        found.append(df.select(F.inline(pairs)).groupBy("_name", "_v").agg(F.lit(1).alias("_one"))
                     .groupBy("_name").agg(F.count(F.lit(1)).alias("_n")))
    long = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    return long.agg(*[F.coalesce(F.max(F.when(F.col("_name") == n, F.col("_n"))), F.lit(0)).cast("bigint").alias(n) for n in columns])
