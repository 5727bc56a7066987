"""Incremental monthly rankings: partial sums stored per month, ranked again only where they changed.

The store is a folder with two tables, both partitioned by batch and month (``ym`` = year * 100 + month, 0 for a null date):

* ``sums``: what a batch of rows adds to each (month, kind, entity): (kind, entity, value, rows). Sums are mergeable, so a month's totals are
  the sums over all batches. A batch that is written again replaces its own folder.
* ``ranks``: the top k per (month, kind) after a batch, for the months that the batch touched; a month's ranking is that of its latest batch.

A batch reads only its own rows and the partitions of the months that they touch; the months come from a bounded list (calendar months).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recengine.operators.topk import top_k_per_group, zip_ranked
from recengine.sources.staged import staged_overwrite

SUMS = "ym int, kind int, entity string, value bigint"
RANKS = "ym int, kind int, entity string, value bigint, rn int"


def month_sums(rows: DataFrame, date: str, entities: Sequence[str], measure: str) -> DataFrame:
    """(ym, kind, entity, value): the batch's sums."""
    ym = F.coalesce(F.year(date) * 100 + F.month(date), F.lit(0)).cast("int").alias("ym")
    kinds = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(e).cast("string").alias("entity")) for i, e in enumerate(entities)])
    long = rows.select(ym, F.col(measure).cast("bigint").alias("_m"), F.inline(kinds))
    return long.groupBy("ym", "kind", "entity").agg(F.sum("_m").alias("value"))


def _table(spark: SparkSession, store: str, name: str, schema: str) -> DataFrame:
    """All batches of a store's table; an empty frame before the first."""
    reader = spark.read.option("basePath", f"{store}/{name}").schema(f"{schema}, batch bigint")
    try:
        return reader.parquet(f"{store}/{name}")
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err):
            raise
        return spark.createDataFrame([], f"{schema}, batch bigint")


def _write(df: DataFrame, store: str, name: str, batch: int) -> None:
    # the rows of a month together: one file, or several where they are many
    staged_overwrite(df.hint("rebalance", "ym"), f"{store}/{name}/batch={batch}", partition_by=["ym"])


def changed_sums(spark: SparkSession, store: str, months: Sequence[int], batch: int) -> DataFrame:
    """The stored sums of some months up to a batch: only their partitions are read."""
    return _table(spark, store, "sums", SUMS).where(F.col("ym").isin([int(m) for m in months]) & (F.col("batch") <= batch))


def add_batch(store: str, batch: int, rows: DataFrame, *, date: str = "start_time_date",
              entities: Sequence[str] = ("name", "instructor", "school"), measure: str = "participants_number", k: int = 10) -> list[int]:
    """Adds the rows of a batch (numbered upwards) to the store and ranks the months it touches again; returns these months."""
    spark = rows.sparkSession
    store = store.rstrip("/")
    later = _table(spark, store, "ranks", RANKS).where(F.col("batch") > batch).limit(1).collect()
    if later:
        raise ValueError(f"batch {batch} is older than batch {later[0].batch}, which has been ranked")
    _write(month_sums(rows, date, entities, measure), store, "sums", batch)
    months = [r.ym for r in spark.read.schema(SUMS).parquet(f"{store}/sums/batch={batch}").select("ym").distinct().collect()]
    total = changed_sums(spark, store, months, batch).groupBy("ym", "kind", "entity").agg(F.sum("value").alias("value"))
    ranked = top_k_per_group(total, ["ym", "kind"], [F.col("value").desc_nulls_last()], k, ties=[F.col("entity").asc_nulls_first()])
    _write(ranked, store, "ranks", batch)
    return sorted(months)


def monthly_rankings(spark: SparkSession, store: str, entities: Sequence[str] = ("name", "instructor", "school"), *, how: str = "inner",
                     suffix: str = "_pns", with_rank: bool = True) -> DataFrame:
    """The rankings of all months side by side, as ``analysis.hot_by_month`` gives them for all rows together."""
    r = _table(spark, store.rstrip("/"), "ranks", RANKS)
    last = r.groupBy("ym").agg(F.max("batch").alias("batch"))  # one row per month
    r = r.join(last, ["ym", "batch"])
    known = F.col("ym") > 0
    long = r.select(F.when(known, F.expr("ym div 100").cast("int")).alias("year"), F.when(known, F.col("ym") % 100).cast("int").alias("ymonth"),
                    F.col("kind").alias("_kind"), F.col("entity").alias("_entity"), F.col("value").alias("_value"), "rn")
    return zip_ranked(long, ["year", "ymonth"], list(entities), value_names=[e + suffix for e in entities], how=how, with_rank=with_rank)
