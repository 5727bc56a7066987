"""Staged overwrite of file tables: a job may overwrite a table that it reads, and a failed job leaves the old rows.

The new rows are written in full to an attempt folder beside the table; then the old folder is renamed aside, the attempt takes
its name, and the old one is deleted. Only renames happen between the old and the new table, so readers see either one. A crash between
the two renames leaves the table under its aside name; ``recover`` (called before every staged overwrite) puts it back and removes attempts
that were never finished. One writer at a time per table; on stores without an atomic rename use a table format instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

ATTEMPT, ASIDE = ".attempt-", ".aside-"


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, hadoop.Path


def _siblings(spark: SparkSession, path: str, kind: str) -> list[str]:
    """Folders that staged overwrites of this table have left beside it, oldest first. Names start with a dot, so a scan of the
    parent folder doesn't read them."""
    fs, p, _ = _fs(spark, path)
    parent = p.getParent()
    if not fs.exists(parent):
        return []
    found = [s for s in fs.listStatus(parent) if s.getPath().getName().startswith(f"{kind}{p.getName()}-")]
    return [s.getPath().toString() for s in sorted(found, key=lambda s: s.getModificationTime())]


def _beside(spark: SparkSession, path: str, kind: str) -> str:
    _, p, _ = _fs(spark, path)
    return f"{p.getParent().toString()}/{kind}{p.getName()}-{uuid.uuid4().hex}"


def recover(spark: SparkSession, path: str) -> bool:
    """Finishes or undoes what an interrupted staged overwrite has left; whether the old table was put back."""
    fs, p, path_of = _fs(spark, path)
    back = False
    aside = _siblings(spark, path, ASIDE)
    if aside and not fs.exists(p):
        back = fs.rename(path_of(aside.pop()), p)
    for left in aside + _siblings(spark, path, ATTEMPT):
        fs.delete(path_of(left), True)
    return back


def staged_overwrite(df: DataFrame, path: str, fmt: str = "parquet", options: dict[str, str] | None = None,
                     partition_by: Sequence[str] = ()) -> None:
    """Replaces the table at ``path`` by the rows of ``df``, which may read it."""
    spark = df.sparkSession
    recover(spark, path)
    fs, p, path_of = _fs(spark, path)
    attempt, aside = _beside(spark, path, ATTEMPT), _beside(spark, path, ASIDE)
    try:
        df.write.format(fmt).options(**dict(options or {})).partitionBy(*partition_by).save(attempt)
    except BaseException:
        fs.delete(path_of(attempt), True)
        raise
    swap(spark, attempt, path, aside)


def swap(spark: SparkSession, attempt: str, path: str, aside: str) -> None:
    """Puts a finished attempt in the place of the table."""
    fs, p, path_of = _fs(spark, path)
    old = fs.exists(p)
    if old and not fs.rename(p, path_of(aside)):
        raise OSError(f"can't move {path} aside")
    if not fs.rename(path_of(attempt), p):
        if old:
            fs.rename(path_of(aside), p)
        raise OSError(f"can't move {attempt} to {path}")
    if old:
        fs.delete(path_of(aside), True)
    spark.catalog.refreshByPath(path)
