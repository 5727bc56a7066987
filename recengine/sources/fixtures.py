"""Input relations of the catalogue/recommendation model, derived from the driver's tables.

The driver ships TPC-H-like parquet tables; the operators work on a course catalogue,
interactions and user profiles. Each builder below derives one input relation with the
DataFrame API. The same relations are written as SQL in ``recengine.sources.fixture_sql``
for the DuckDB oracle; both must give equal rows (checked by the oracle tests).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recengine.functions.columns import parse_cjk_date
from recengine.sources.io import load_tables


def _s(c: Column) -> Column:
    return c.cast("string")


#: Rows that one task joins or groups; smaller tables are dealt as Spark sees fit.
ROWS_PER_TASK = 500_000


def task_width(rows: DataFrame) -> int | None:
    """Tasks of at most ROWS_PER_TASK rows each where there are more of them than task slots, else None."""
    width = math.ceil(rows.count() / ROWS_PER_TASK)
    return width if width > max(1, rows.sparkSession.sparkContext.defaultParallelism) else None


def student_course(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Interactions (student_id, course_id, rating int?): one row per (customer, part)."""
    width = task_width(lineitem)
    if width:
        lineitem, orders = lineitem.repartition(width, "l_orderkey"), orders.repartition(width, "o_orderkey")
    lo = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
    if width:
        # grouped where the rows arrive: no map of all groups before the shuffle
        lo = lo.select("o_custkey", "l_partkey", "l_returnflag", "l_quantity").repartition(width, "o_custkey", "l_partkey")
    flag = F.col("l_returnflag")
    # max(flag) = 'N' <=> some flag is 'N' and none sorts above it; boolean aggregates keep
    # this a hash aggregation (a string max would force a sort-based one)
    agg = (lo.groupBy(F.col("o_custkey").alias("student_id"), F.col("l_partkey").alias("course_id"))
           .agg(F.max(flag == "N").alias("_has_n"), F.max(flag > "N").alias("_above_n"),
                F.max("l_quantity").alias("_q")))
    max_is_n = F.col("_has_n") & ~F.col("_above_n")
    return agg.select("student_id", "course_id",
                      F.when(max_is_n, F.lit(None)).otherwise(F.ceil(F.col("_q") / 10.0))
                      .cast("int").alias("rating"))


def course_infos(part: DataFrame, lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """Raw catalogue rows: text dates (yyyy年M月d日), nullable measure and instructor."""
    g = (lineitem.groupBy("l_partkey")
         .agg(F.count_distinct("l_orderkey").alias("n"), F.min("l_suppkey").alias("sk")))
    p = part.join(g, g.l_partkey == part.p_partkey)
    p = p.join(supplier, supplier.s_suppkey == p.sk, "left")
    key, size = F.col("p_partkey"), F.col("p_size")
    day = _s(1 + key % 28)
    return p.select(
        key.alias("src_id"),
        F.col("p_type").alias("type"),
        F.concat(F.lit("/c/"), _s(key)).alias("link"),
        F.when(size % 11 == 0, F.lit(None)).otherwise(F.col("n")).cast("bigint").alias("participants_number"),
        F.when(size % 13 == 0, F.lit(None)).otherwise(F.col("s_name")).cast("string").alias("instructor"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("school"),
        F.concat(F.lit("L"), _s(F.floor(size / 10.0).cast("int"))).alias("labels"),
        F.concat(_s(1995 + key % 7), F.lit("年"), _s(1 + size % 12), F.lit("月"), day,
                 F.lit("日")).alias("start_time"),
        F.concat(_s(1995 + key % 7 + size % 3), F.lit("年"), _s(1 + (size * 7) % 12), F.lit("月"),
                 day, F.lit("日")).alias("end_time"),
        F.when(size % 7 == 0, F.lit(None)).otherwise(size.cast("double") / 10).alias("grading"),
    )


def course(infos: DataFrame) -> DataFrame:
    """The catalogue without filter or dedup: id, null-filled measures, parsed dates."""
    return infos.select(
        F.col("src_id").alias("id"), "type", "link",
        F.coalesce(F.col("participants_number"), F.lit(0).cast("bigint")).alias("participants_number"),
        "instructor", "name", "school", "labels",
        "start_time", parse_cjk_date(F.col("start_time")).alias("start_time_date"),
        "end_time", parse_cjk_date(F.col("end_time")).alias("end_time_date"),
        F.coalesce(F.col("grading"), F.lit(0.0)).alias("grading"),
    )


def sys_user(customer: DataFrame) -> DataFrame:
    """User profiles: interest lists as comma-separated text (nullable)."""
    k = F.col("c_custkey")
    course_type = (F.when(k % 5 == 0, "ECONOMY,PROMO").when(k % 5 == 1, "STANDARD")
                   .when(k % 5 == 2, "PROMO,SMALL").when(k % 5 == 3, F.lit(None))
                   .otherwise("ECONOMY"))
    return customer.select(
        k.alias("id"), F.col("c_name").alias("name"),
        course_type.cast("string").alias("course_type"),
        F.concat(F.lit("Brand#"), _s(k % 25 + 1)).alias("school_names"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit("L"), _s(k % 5)))
         .cast("string").alias("labels"),
    )


class Catalog:
    """Lazily derived input relations for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._t = load_tables(spark, sf_dir, ("lineitem", "orders", "part", "customer", "supplier"))

    def table(self, name: str) -> DataFrame:
        return self._t[name]

    def student_course(self) -> DataFrame:
        return student_course(self._t["lineitem"], self._t["orders"])

    def course_infos(self) -> DataFrame:
        return course_infos(self._t["part"], self._t["lineitem"], self._t["supplier"])

    def course(self) -> DataFrame:
        return course(self.course_infos())

    def sys_user(self) -> DataFrame:
        return sys_user(self._t["customer"])
