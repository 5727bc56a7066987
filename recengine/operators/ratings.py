"""The composite rating: interactions + catalogue + user interests -> a rating per pair.

rating = 1 + 0.2*coalesce(rating, 4) + 0.3*coalesce(grading, 3)
           + 0.5*[item type in the user's course types] + 0*[school in the user's schools]
           + 0.5*[item labels in the user's labels]

Where every weighted term is a whole number of ``1/unit`` steps the rating is exact: column ``x`` is the integer
number of steps, and the rating the double nearest to ``x / unit``, so that downstream similarity sums
are integer sums: the same bits whatever the partitioning or the engine. A rating with a term between steps (an
average of star ratings, say) is the formula's value in doubles, and its ``x`` is null; ``step_values`` then gives the operators
doubles for all rows. Nothing is rounded to the grid.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recengine.functions.columns import text_contains

# Base, weights and fill values of the composite rating.
BASE = 1
DEFAULT_WEIGHTS = {"rating": 0.2, "grading": 0.3, "type": 0.5, "school": 0.0, "labels": 0.5}
DEFAULT_FILL = {"rating": 4, "grading": 3}

DEFAULT_UNIT = 10_000
#: Digits that cosines of doubles are compared by, as scores are: the order of a sum changes the last ones.
DOUBLE_DIGITS = 9
#: Tasks that a key's rows are dealt to in joins of a fixed number of tasks.
SALTS = 4


def step_values(r: DataFrame, value: str = "x", rating: str = "rating", unit: int = DEFAULT_UNIT) -> tuple[DataFrame, int | None]:
    """``r`` with a ``value`` in every rated row, and the digits that sums of it are compared by: the integer steps (None: exact), or
    ``rating * unit`` in doubles for all rows where some rating lies between steps."""
    if rating not in r.columns or value not in r.columns or r.where(F.col(value).isNull() & F.col(rating).isNotNull()).isEmpty():
        return r, None
    return r.withColumn(value, F.col(rating).cast("double") * F.lit(unit)), DOUBLE_DIGITS


def _left_join(rows: DataFrame, dim: DataFrame, key: str, dim_key: str, other: str, partitions: int | None) -> DataFrame:
    if not partitions:
        return rows.join(dim, F.col(key) == F.col(dim_key), "left")
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(other), F.lit(SALTS)).cast("int")).repartition(partitions, key, "_salt")
    dim = dim.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).repartition(partitions, dim_key, "_copy")
    return rows.join(dim, (F.col(key) == F.col(dim_key)) & (F.col("_salt") == F.col("_copy")), "left").drop("_salt", "_copy")


def composite_rating(facts: DataFrame, items: DataFrame, users: DataFrame, *,
                     weights: Mapping[str, float] | None = None,
                     fill: Mapping[str, float] | None = None, unit: int = DEFAULT_UNIT,
                     dedupe: bool = False,
                     fact_user: str = "student_id", fact_item: str = "course_id",
                     fact_rating: str = "rating", item_id: str = "id", user_id: str = "id",
                     partitions: int | None = None) -> DataFrame:
    """(user_id, item_id, rating double, x bigint = rating in 1/``unit`` steps).

    ``facts`` are interactions (user, item, rating?), ``items`` the catalogue (id, type,
    school, labels, grading), ``users`` the profiles (id, course_type, school_names, labels).
    Both dimension joins are left joins, so an interaction whose item or user is missing
    still gets a rating from the fill values. Duplicate interactions stay (bag semantics)
    unless ``dedupe`` keeps one row per pair (the highest raw rating).

    ``partitions`` fixes the number of tasks of the dimension joins, for tables that would fill the memory of fewer
    tasks; a key's rows then go to ``SALTS`` of them.

    x is null where a term ``value * weight`` is no whole number of steps (with the default weights and unit, gradings of
    three decimals are); the rating is then the sum in doubles.
    """
    w = dict(DEFAULT_WEIGHTS, **(weights or {}))
    f = dict(DEFAULT_FILL, **(fill or {}))
    st = facts.select(F.col(fact_user).alias("user_id"), F.col(fact_item).alias("item_id"),
                      F.col(fact_rating).alias("_r"))
    if dedupe:
        st = st.groupBy("user_id", "item_id").agg(F.max("_r").alias("_r"))
    c = items.select(F.col(item_id).alias("_cid"), F.col("grading").alias("_g"),
                     F.col("type").alias("_ctype"), F.col("school").alias("_cschool"),
                     F.col("labels").alias("_clabels"))
    su = users.select(F.col(user_id).alias("_uid"), F.col("course_type").alias("_utypes"),
                      F.col("school_names").alias("_uschools"), F.col("labels").alias("_ulabels"))
    j = _left_join(_left_join(st, c, "item_id", "_cid", "user_id", partitions), su, "user_id", "_uid", "item_id", partitions)

    def step(amount, key):
        """A weighted amount in steps; null between steps."""
        steps = amount * F.lit(w[key] * unit)
        near = F.round(steps)
        return F.when(F.abs(steps - near) <= F.lit(1e-6), near.cast("bigint"))

    one = lambda cond: F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0))
    amounts = {"rating": F.coalesce(F.col("_r").cast("double"), F.lit(float(f["rating"]))),
               "grading": F.coalesce(F.col("_g").cast("double"), F.lit(float(f["grading"]))),
               "type": one(text_contains("_utypes", "_ctype")), "school": one(text_contains("_uschools", "_cschool")),
               "labels": one(text_contains("_ulabels", "_clabels"))}
    amounts = {k: v for k, v in amounts.items() if w[k]}
    x = sum((step(v, k) for k, v in amounts.items()), F.lit(BASE * unit).cast("bigint"))
    whole = sum((v * F.lit(float(w[k])) for k, v in amounts.items()), F.lit(float(BASE)))
    rated = j.select("user_id", "item_id", whole.alias("_whole"), x.alias("x"))
    return rated.select("user_id", "item_id",
                        F.coalesce(F.col("x").cast("double") / F.lit(float(unit)), F.col("_whole")).alias("rating"), "x")
