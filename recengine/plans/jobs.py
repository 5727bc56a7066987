"""End-to-end jobs: read tables, run operators, write result tables.

Each job mirrors one batch program of the original application. ``source`` and ``sink``
are keyword arguments for ``read_table`` / ``write_table`` (parquet root or JDBC url and
options). Inputs used by several outputs are persisted once and released at the end.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from recengine.operators import als, analysis, clean, evaluate, ratings, recommend, summary
from recengine.sources.io import read_table, write_table


def of_table(source: Mapping, name: str) -> dict:
    """The read settings of one table: ``source`` without its key "tables", overlaid with
    source["tables"][name] (for JDBC: partition_column, lower_bound, upper_bound, num_partitions)."""
    common = {k: v for k, v in source.items() if k != "tables"}
    return common | dict(source.get("tables", {}).get(name, {}))


def load_catalog_job(spark: SparkSession, *, source: Mapping, sink: Mapping, cutoff: str = "2024-01-01",
                     as_of=None, tie: str | None = None, raw_table: str = "course_infos",
                     out_table: str = "course") -> None:
    """Raw catalogue -> cleaned catalogue with ids and status (overwrite). ``tie``: see clean_catalog."""
    raw = read_table(spark, raw_table, **of_table(source, raw_table))
    write_table(clean.clean_catalog(raw, cutoff=cutoff, as_of=as_of, tie=tie), out_table, mode="overwrite", **sink)


def analysis_job(spark: SparkSession, *, source: Mapping, sink: Mapping, k: int = 10,
                 form: str = "sql") -> None:
    """The six catalogue summaries.

    ``form="sql"``: rankings anchored on the first one (left), the monthly table without
    the rank, totals ordered school, name, instructor, student. ``form="dataframe"``:
    rankings present in all three (inner) with the rank, totals ordered student, name,
    instructor, school. Both forms are available in the original application.
    """
    if form not in ("sql", "dataframe"):
        raise ValueError("form must be 'sql' or 'dataframe'")
    how = "left" if form == "sql" else "inner"
    course = read_table(spark, "course", **of_table(source, "course")).persist(StorageLevel.MEMORY_AND_DISK)
    sc = read_table(spark, "student_course", **of_table(source, "student_course"))
    totals = {"school_cnt": (course, "school"), "name_cnt": (course, "name"),
              "instructor_cnt": (course, "instructor"), "student_cnt": (sc, "student_id")}
    if form == "dataframe":
        totals = {n: totals[n] for n in ("student_cnt", "name_cnt", "instructor_cnt", "school_cnt")}
    try:
        outputs = {
            "school_cnt_analysis": summary.group_count(course, ["type", "school"], "school_cnt",
                                                       sort=form == "sql"),
            "type_cnt_analysis": summary.group_count(course, ["type"], "type_cnt", sort=form == "sql"),
            "hot_analysis": analysis.hot_by_group(course, k=k, how=how),
            "total_analysis": summary.cardinality_summary(totals),
            "total_analysis2": summary.stacked_value_counts(course, ["labels", "status"], "labels", "cnt"),
            "year_month_analysis": analysis.hot_by_month(course, k=k, how=how,
                                                         with_rank=form == "dataframe"),
        }
        for name, df in outputs.items():
            write_table(df, name, mode="overwrite", **sink)
    finally:
        course.unpersist()


def _ratings(spark: SparkSession, source: Mapping, unit: int):
    sc = read_table(spark, "student_course", **of_table(source, "student_course"))
    course = read_table(spark, "course", **of_table(source, "course"))
    users = read_table(spark, "sys_user", **of_table(source, "sys_user"))
    return ratings.composite_rating(sc, course, users, unit=unit), sc


def item_cf_job(spark: SparkSession, *, source: Mapping, sink: Mapping, k_neighbors: int = 12,
                n: int = 12, unit: int = ratings.DEFAULT_UNIT,
                out_table: str = "course_recommend_item_cf") -> None:
    r, _ = _ratings(spark, source, unit)
    r = r.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        out = recommend.item_cf_recommend(r, k_neighbors=k_neighbors, n=n, unit=unit)
        write_table(out, out_table, mode="overwrite", **sink)
    finally:
        r.unpersist()


def user_cf_job(spark: SparkSession, *, source: Mapping, sink: Mapping, k_neighbors: int = 12,
                n: int = 12, unit: int = ratings.DEFAULT_UNIT,
                out_table: str = "course_recommend_user_cf") -> None:
    r, _ = _ratings(spark, source, unit)
    r = r.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        out = recommend.user_cf_recommend(r, k_neighbors=k_neighbors, n=n, unit=unit)
        write_table(out, out_table, mode="overwrite", **sink)
    finally:
        r.unpersist()


def als_job(spark: SparkSession, *, source: Mapping, sink: Mapping, n: int = 50, reg: float = 0.1,
            seed: int = 42, out_table: str = "course_recommend") -> None:
    """ALS on the 70 % hash split; exclusion uses all interactions."""
    r, sc = _ratings(spark, source, ratings.DEFAULT_UNIT)
    r = r.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        taken = sc.select("student_id", "course_id").withColumnRenamed("student_id", "user_id") \
                  .withColumnRenamed("course_id", "item_id")
        out = als.als_recommend(r, taken, n=n, reg=reg, seed=seed)
        write_table(out.select("user_id", "course_id", "ranking"), out_table, mode="overwrite", **sink)
    finally:
        r.unpersist()


def evaluation_job(spark: SparkSession, *, source: Mapping, sink: Mapping, item_k: int = 5,
                   user_k: int = 29, als_reg: float = 0.1, seed: int = 42,
                   unit: int = ratings.DEFAULT_UNIT, out_table: str = "rmse_report") -> None:
    """Fit/hold-out errors of the three recommenders in one report table
    (model, n, rmse): item CF and user CF fit statistics, ALS on the 30 % hash split."""
    r, _ = _ratings(spark, source, unit)
    r = r.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        parts = [
            evaluate.item_cf_rmse(r, k=item_k).select(F.lit("item_cf").alias("model"), "n", "rmse"),
            evaluate.user_cf_rmse(r, k=user_k, unit=unit).select(F.lit("user_cf").alias("model"), "n", "rmse"),
            als.als_rmse(r, reg=als_reg, seed=seed).select(F.lit("als").alias("model"), "n", "rmse"),
        ]
        report = parts[0].unionByName(parts[1]).unionByName(parts[2])
        write_table(report, out_table, mode="overwrite", **sink)
    finally:
        r.unpersist()


def als_tuning_job(spark: SparkSession, *, source: Mapping, sink: Mapping,
                   regs=(0.1, 0.01, 0.001), ranks=(10,), seed: int = 42,
                   out_table: str = "als_tuning") -> None:
    """Hold-out RMSE per (rank, regParam) on one shared split."""
    r, _ = _ratings(spark, source, ratings.DEFAULT_UNIT)
    r = r.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_table(als.als_grid_search(r, regs=regs, ranks=ranks, seed=seed), out_table,
                    mode="overwrite", **sink)
    finally:
        r.unpersist()


def rmse_join_job(spark: SparkSession, *, source: Mapping, sink: Mapping, left_table: str,
                  right_table: str, keys=("user_id", "item_id"), label: str = "rating",
                  prediction: str = "prediction", out_table: str = "rmse_join") -> None:
    """RMSE between a label column of one table and a prediction column of another."""
    left = read_table(spark, left_table, **of_table(source, left_table))
    right = read_table(spark, right_table, **of_table(source, right_table))
    write_table(evaluate.rmse_of(left, right, list(keys), label, prediction), out_table,
                mode="overwrite", **sink)
