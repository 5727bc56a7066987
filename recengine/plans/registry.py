"""Registered queries: one per operator, over the whole driver tables of a scale folder.

Each entry of ``QUERIES`` takes (spark, sf_dir) and returns a DataFrame; ``ORACLE`` holds
the equivalent SQL over the same tables for DuckDB (fixture relations as CTEs). Column
names and types are aligned on both sides (ints as int/bigint explicitly, doubles rounded
where a floating sum's order could change the last bits).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recengine.functions.columns import STATUS_LABELS, lifecycle_status, parse_cjk_date
from recengine.operators import als, analysis, bitmaps, clean, evaluate, monthly, ratings, recommend, similarity, summary, topk
from recengine.session import reliable_checkpoint, saved
from recengine.sources import buckets
from recengine.sources.buckets import shared_path
from recengine.sources.fixture_sql import with_fixtures
from recengine.sources.fixtures import Catalog, task_width
from recengine.sources.io import load_tables

# Parameters of the registered queries (cleaning needs a cutoff that removes rows and a
# fixed "now" so the status is reproducible).
AS_OF = dt.datetime(1998, 6, 1)
AS_OF_SQL = "timestamp '1998-06-01 00:00:00'"
CUTOFF = "2001-01-01"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_fixtures(sql)
        return fn
    return deco


def _status_sql(start: str = "start_time_date", end: str = "end_time_date") -> str:
    t = AS_OF_SQL
    ongoing, ended, upcoming, unknown = STATUS_LABELS
    return (f"case when {start} < {t} and {end} > {t} then '{ongoing}' "
            f"when {end} < {t} then '{ended}' when {start} > {t} then '{upcoming}' "
            f"else '{unknown}' end")


# --- counts -----------------------------------------------------------------------------

@register("group_count_1", """
select type, count(*) as type_cnt from course group by type
""")
def q_group_count_1(spark, sf):
    return summary.group_count(Catalog(spark, sf).course(), ["type"], "type_cnt", sort=True)


@register("group_count_2", """
select type, school, count(*) as school_cnt from course group by type, school
""")
def q_group_count_2(spark, sf):
    return summary.group_count(Catalog(spark, sf).course(), ["type", "school"], "school_cnt", sort=True)


@register("cardinality_summary", """
select (select count(*) from (select school from course group by school) t) as school_cnt,
       (select count(*) from (select name from course group by name) t) as name_cnt,
       (select count(*) from (select instructor from course group by instructor) t) as instructor_cnt,
       (select count(*) from (select student_id from student_course group by student_id) t) as student_cnt
""")
def q_cardinality_summary(spark, sf):
    cat = Catalog(spark, sf)
    course, sc = cat.course(), cat.student_course()
    return summary.cardinality_summary({
        "school_cnt": (course, "school"), "name_cnt": (course, "name"),
        "instructor_cnt": (course, "instructor"), "student_cnt": (sc, "student_id")})


@register("stacked_value_counts", f"""
with c as (select labels, {_status_sql()} as status from course)
select labels, count(*) as cnt from c group by labels
union all
select status as labels, count(*) as cnt from c group by status
""")
def q_stacked_value_counts(spark, sf):
    course = Catalog(spark, sf).course()
    course = course.withColumn("status", lifecycle_status("start_time_date", "end_time_date", AS_OF))
    return summary.stacked_value_counts(course, ["labels", "status"], value="labels", name="cnt")


# --- rankings ---------------------------------------------------------------------------

def _hot_sql(how: str) -> str:
    join = "join" if how == "inner" else "left join"
    parts = []
    for i, e in enumerate(("name", "school", "instructor"), 1):
        parts.append(f"""r{i} as (select * from (
  select type, e, v, row_number() over (partition by type order by v desc nulls last,
         e asc nulls first, id asc nulls first) as rn
  from (select id, type, cast({e} as varchar) as e, cast(sum(participants_number) as bigint) as v
        from course group by id, type, {e}) a) b where rn <= 10)""")
    return f"""with {', '.join(parts)}
select r1.type, r1.e as name, r1.v as name_num, r2.e as school, r2.v as school_num,
       r3.e as instructor, r3.v as instructor_num, cast(r1.rn as int) as rn
from r1 {join} r2 on r1.type = r2.type and r1.rn = r2.rn
        {join} r3 on r1.type = r3.type and r1.rn = r3.rn"""


@register("hot_by_group", _hot_sql("inner"))
def q_hot_by_group(spark, sf):
    return analysis.hot_by_group(Catalog(spark, sf).course(), how="inner")


@register("hot_by_group_left", _hot_sql("left"))
def q_hot_by_group_left(spark, sf):
    return analysis.hot_by_group(Catalog(spark, sf).course(), how="left")


def _month_sql(how: str) -> str:
    join = "join" if how == "inner" else "left join"
    parts = []
    for i, e in enumerate(("name", "instructor", "school"), 1):
        parts.append(f"""r{i} as (select * from (
  select y, m, e, v, row_number() over (partition by y, m order by v desc nulls last,
         e asc nulls first) as rn
  from (select cast(year(start_time_date) as int) as y, cast(month(start_time_date) as int) as m,
               cast({e} as varchar) as e, cast(sum(participants_number) as bigint) as v
        from course group by 1, 2, 3) a) b where rn <= 10)""")
    rank = ", cast(r1.rn as int) as rn" if how == "inner" else ""
    on = "r1.y = r{0}.y and r1.m = r{0}.m and r1.rn = r{0}.rn"
    return f"""with {', '.join(parts)}
select r1.y as year, r1.m as ymonth, r1.e as name, r1.v as name_pns, r2.e as instructor,
       r2.v as instructor_pns, r3.e as school, r3.v as school_pns{rank}
from r1 {join} r2 on {on.format(2)} {join} r3 on {on.format(3)}"""


@register("hot_by_month", _month_sql("inner"))
def q_hot_by_month(spark, sf):
    return analysis.hot_by_month(Catalog(spark, sf).course(), how="inner", with_rank=True)


@register("hot_by_month_left", _month_sql("left"))
def q_hot_by_month_left(spark, sf):
    return analysis.hot_by_month(Catalog(spark, sf).course(), how="left", with_rank=False)


@register("top_k_per_group", """
select * from (
  select school, id, name, participants_number,
         cast(row_number() over (partition by school order by participants_number desc nulls last,
                                 id asc nulls first) as int) as rn
  from course) t where rn <= 5
""")
def q_top_k_per_group(spark, sf):
    c = Catalog(spark, sf).course().select("school", "id", "name", "participants_number")
    return topk.top_k_per_group(c, ["school"], [F.col("participants_number").desc_nulls_last()], 5,
                                ties=[F.col("id").asc_nulls_first()])


@register("zip_ranked", """
with a as (select school, cast(name as varchar) as e, cast(sum(participants_number) as bigint) as v
           from course group by school, name),
b as (select school, cast(instructor as varchar) as e, cast(sum(participants_number) as bigint) as v
      from course group by school, instructor),
ra as (select * from (select *, row_number() over (partition by school order by v desc nulls last,
                      e asc nulls first) as rn from a) t where rn <= 5),
rb as (select * from (select *, row_number() over (partition by school order by v desc nulls last,
                      e asc nulls first) as rn from b) t where rn <= 5)
select ra.school, ra.e as name, ra.v as name_num, rb.e as instructor, rb.v as instructor_num,
       cast(ra.rn as int) as rn
from ra join rb on ra.school = rb.school and ra.rn = rb.rn
""")
def q_zip_ranked(spark, sf):
    c = Catalog(spark, sf).course()
    ranked = topk.ranked_entities(c, ["school"], ["name", "instructor"], "participants_number", k=5)
    return topk.zip_ranked(ranked, ["school"], ["name", "instructor"],
                           value_names=["name_num", "instructor_num"], how="inner")


# --- cleaning ---------------------------------------------------------------------------

@register("parse_cjk_date", """
select src_id,
       try_cast(replace(replace(replace(start_time, '年', '-'), '月', '-'), '日', '') as date) as start_time_date,
       try_cast(replace(replace(replace(end_time, '年', '-'), '月', '-'), '日', '') as date) as end_time_date
from course_infos
""")
def q_parse_cjk_date(spark, sf):
    ci = Catalog(spark, sf).course_infos()
    return ci.select("src_id", parse_cjk_date("start_time").alias("start_time_date"),
                     parse_cjk_date("end_time").alias("end_time_date"))


@register("lifecycle_status", f"""
select id, {_status_sql()} as status from course
""")
def q_lifecycle_status(spark, sf):
    c = Catalog(spark, sf).course()
    return c.select("id", lifecycle_status("start_time_date", "end_time_date", AS_OF).alias("status"))



@register("dedup_keep_first", """
select src_id, type, link, participants_number, instructor, name, school, labels, start_time,
       end_time, grading
from (select *, row_number() over (partition by name, school
                                   order by participants_number asc nulls first, src_id) as rn
      from course_infos) t
where rn = 1
""")
def q_dedup_keep_first(spark, sf):
    ci = Catalog(spark, sf).course_infos()
    return clean.dedup_keep_first(ci, ["name", "school"], [F.col("participants_number").asc_nulls_first()],
                                  ties=[F.col("src_id").asc()])


@register("assign_row_ids", """
select cast(row_number() over (order by participants_number asc nulls first, src_id) as bigint) as id,
       src_id
from course_infos
""")
def q_assign_row_ids(spark, sf):
    ci = Catalog(spark, sf).course_infos().select("participants_number", "src_id")
    out = clean.assign_row_ids(ci, [F.col("participants_number").asc_nulls_first(), F.col("src_id").asc()])
    return out.select("id", "src_id")


@register("dense_ids", """
select student_id, cast(row_number() over (order by student_id) as bigint) as dense_id
from (select distinct student_id from student_course) t
""")
def q_dense_ids(spark, sf):
    return clean.dense_ids(Catalog(spark, sf).student_course(), "student_id")


@register("clean_catalog", f"""
select cast(row_number() over (order by participants_number asc nulls first, src_id) as bigint) as id,
       type, link, participants_number, instructor, name, school, labels,
       start_time, start_time_date, end_time, end_time_date, {_status_sql()} as status, grading, src_id
from (select type, link, coalesce(participants_number, 0) as participants_number, instructor, name,
             school, labels, start_time,
             try_cast(replace(replace(replace(start_time, '年', '-'), '月', '-'), '日', '') as date) as start_time_date,
             end_time,
             try_cast(replace(replace(replace(end_time, '年', '-'), '月', '-'), '日', '') as date) as end_time_date,
             coalesce(grading, 0) as grading, src_id
      from (select *, row_number() over (partition by name, school
                                         order by participants_number asc nulls first, src_id) as rn
            from course_infos
            where name is not null and instructor is not null
              and start_time < '{CUTOFF}' and end_time < '{CUTOFF}') a
      where rn = 1) t
""")
def q_clean_catalog(spark, sf):
    return clean.clean_catalog(Catalog(spark, sf).course_infos(), cutoff=CUTOFF, as_of=AS_OF, tie="src_id")


# --- ratings and similarity -------------------------------------------------------------

UNIT = ratings.DEFAULT_UNIT

# from the formula, in doubles; the steps and whole parts are read off the rounded rating
RATINGS_SQL = f"""ratings as (
  select st.student_id as user_id, st.course_id as item_id,
         round(1 + 0.2::double * coalesce(cast(st.rating as double), 4) + 0.3::double * coalesce(c.grading, 3)
              + 0.5::double * case when instr(su.course_type, c.type) > 0 then 1 else 0 end
              + 0.5::double * case when instr(su.labels, c.labels) > 0 then 1 else 0 end, 9) as rating
  from student_course st
  left join course c on c.id = st.course_id
  left join sys_user su on su.id = st.student_id),
rated as (select user_id, item_id, rating, cast(round(rating * {UNIT}) as bigint) as x,
                 cast(floor(rating) as bigint) as xt from ratings)"""


def _cosine_sql(entity: str, by: str, value: str, k: int, name: str) -> str:
    nb = similarity.neighbor_column(entity)
    return f"""{name}_n as (select {entity}, sum({value} * {value}) as n2 from rated group by {entity}),
{name}_d as (select a.{entity}, b.{entity} as {nb}, sum(a.{value} * b.{value}) as dot
      from rated a join rated b on a.{by} = b.{by} and a.{entity} <> b.{entity}
      group by a.{entity}, b.{entity}),
{name}_c as (select d.{entity}, d.{nb}, cast(d.dot as double) / (sqrt(p.n2) * sqrt(q.n2)) as cos
      from {name}_d d join {name}_n p on d.{entity} = p.{entity} join {name}_n q on d.{nb} = q.{entity}),
{name} as (select {entity}, {nb}, cos, cast(rk as int) as rank
      from (select *, row_number() over (partition by {entity} order by cos desc, {nb}) as rk
            from {name}_c) t where rk <= {k})"""


_RATINGS: dict[tuple[str, str], DataFrame] = {}


def _ratings(spark, sf, persist=True):
    """The composite ratings of ``sf``; persisted once per session and shared by the CF
    queries (re-persisted if the cache was cleared). Those of large tables are saved instead, by each query for itself:
    a persisted frame would keep the shuffle files that made it."""
    if persist:
        key = (spark.sparkContext.applicationId, sf)
        r = _RATINGS.get(key)
        if r is not None:
            lvl = r.storageLevel
            if not (lvl.useMemory or lvl.useDisk):
                r.persist()
            return r
    cat = Catalog(spark, sf)
    width = task_width(cat.table("lineitem"))
    r = ratings.composite_rating(cat.student_course(), cat.course(), cat.sys_user(), unit=UNIT, partitions=width)
    if persist and width:
        return saved(r, "ratings")
    if persist:
        r = r.persist()
        _RATINGS[(spark.sparkContext.applicationId, sf)] = r
    return r


@register("composite_rating", f"""
with {RATINGS_SQL}
select user_id, item_id, rating, x from rated
""")
def q_composite_rating(spark, sf):
    return _ratings(spark, sf, persist=False)


@register("rating_profile", f"""
with {RATINGS_SQL}
select count(*) as n_ratings,
       (select count(*) from (select user_id from rated group by user_id) t) as n_users,
       (select count(*) from (select item_id from rated group by item_id) t) as n_items
from rated
""")
def q_rating_profile(spark, sf):
    return summary.rating_profile(_ratings(spark, sf, persist=False))


@register("item_cosine", f"""
with {RATINGS_SQL}, {_cosine_sql("item_id", "user_id", "x", 12, "nbr")}
select * from nbr
""")
def q_item_cosine(spark, sf):
    return similarity.cosine_neighbors(_ratings(spark, sf), entity="item_id", by="user_id", value="x", k=12)


@register("user_cosine", f"""
with {RATINGS_SQL}, {_cosine_sql("user_id", "item_id", "xt", 12, "nbr")}
select * from nbr
""")
def q_user_cosine(spark, sf):
    r = recommend.truncated(_ratings(spark, sf), "x", UNIT)
    return similarity.cosine_neighbors(r, entity="user_id", by="item_id", value="xt", k=12)


@register("neighbor_lists", f"""
with {RATINGS_SQL}, {_cosine_sql("item_id", "user_id", "x", 12, "nbr")}
select item_id, list(item_v order by rank) as neighbors, list(cos order by rank) as cosines
from nbr group by item_id
""")
def q_neighbor_lists(spark, sf):
    nb = similarity.cosine_neighbors(_ratings(spark, sf), entity="item_id", by="user_id", value="x", k=12)
    return similarity.neighbor_lists(nb, entity="item_id", neighbor="item_v")


# --- recommendations --------------------------------------------------------------------

ORACLE_ITEM_CF = f"""
with {RATINGS_SQL}, {_cosine_sql("item_id", "user_id", "x", 12, "nbr")},
s as (select r.user_id, k.item_v as course_id, sum(k.cos * r.x / {UNIT}.0) as score
      from rated r join nbr k on r.item_id = k.item_id
      where not exists (select 1 from rated h where h.user_id = r.user_id and h.item_id = k.item_v)
      group by r.user_id, k.item_v)
select user_id, course_id, cast(ranking as int) as ranking
from (select *, row_number() over (partition by user_id order by round(score, 9) desc, course_id) as ranking
      from s) t where ranking <= 12
"""


@register("item_cf_recommend", ORACLE_ITEM_CF)
def q_item_cf_recommend(spark, sf):
    return recommend.item_cf_recommend(_ratings(spark, sf), k_neighbors=12, n=12, unit=UNIT)


@register("user_cf_recommend", f"""
with {RATINGS_SQL}, {_cosine_sql("user_id", "item_id", "xt", 12, "nbr")},
s as (select k.user_id, r.item_id as course_id, avg(k.cos * r.x / {UNIT}.0) as score
      from nbr k join rated r on k.user_v = r.user_id
      where not exists (select 1 from rated h where h.user_id = k.user_id and h.item_id = r.item_id)
      group by k.user_id, r.item_id)
select user_id, course_id, cast(ranking as int) as ranking
from (select *, row_number() over (partition by user_id order by round(score, 9) desc, course_id) as ranking
      from s) t where ranking <= 12
""")
def q_user_cf_recommend(spark, sf):
    return recommend.user_cf_recommend(_ratings(spark, sf), k_neighbors=12, n=12, unit=UNIT)


# --- errors -----------------------------------------------------------------------------

@register("rmse_join", f"""
with {RATINGS_SQL},
rec as (select student_id as user_id, course_id as item_id, rating from student_course
        where rating is not null),
other as (select user_id, item_id, rating as score from rated)
select count(*) as n, round(sqrt(avg((cast(rec.rating as double) - other.score) * (cast(rec.rating as double) - other.score))), 9) as rmse
from rec join other on rec.user_id = other.user_id and rec.item_id = other.item_id
""")
def q_rmse_join(spark, sf):
    cat = Catalog(spark, sf)
    rec = (cat.student_course().where(F.col("rating").isNotNull())
           .select(F.col("student_id").alias("user_id"), F.col("course_id").alias("item_id"), "rating"))
    other = _ratings(spark, sf, persist=False).select("user_id", "item_id", F.col("rating").alias("score"))
    out = evaluate.rmse_of(rec, other, ["user_id", "item_id"], "rating", "score")
    return out.select("n", F.round("rmse", 9).alias("rmse"))


ITEM_PRED_SQL = f"""{RATINGS_SQL}, {_cosine_sql("item_id", "user_id", "x", 5, "nbr")},
s as (select item_id, sum(cos) as c from nbr group by item_id),
pred as (select r.user_id, r.item_id, r.rating, sum(r.rating * s.c) as prediction
         from rated r join s on r.item_id = s.item_id group by r.user_id, r.item_id, r.rating)"""

USER_PRED_SQL = f"""{RATINGS_SQL}, {_cosine_sql("user_id", "item_id", "xt", 29, "nbr")},
cand as (select k.user_id, r.item_id, sum(k.cos * r.rating) as p
         from nbr k join rated r on r.user_id = k.user_v group by k.user_id, r.item_id),
pred as (select r.user_id, r.item_id, r.rating, sum(c.p) as prediction
         from rated r join cand c on r.user_id = c.user_id and r.item_id = c.item_id
         group by r.user_id, r.item_id, r.rating)"""


@register("item_cf_predictions", f"""
with {ITEM_PRED_SQL}
select user_id, item_id, rating, round(prediction, 9) as prediction from pred
""")
def q_item_cf_predictions(spark, sf):
    p = evaluate.item_cf_predictions(_ratings(spark, sf), k=5)
    return p.select("user_id", "item_id", "rating", F.round("prediction", 9).alias("prediction"))


@register("item_cf_rmse", f"""
with {ITEM_PRED_SQL}
select count(*) as n, round(sqrt(avg((rating - prediction) * (rating - prediction))), 9) as rmse from pred
""")
def q_item_cf_rmse(spark, sf):
    out = evaluate.item_cf_rmse(_ratings(spark, sf), k=5)
    return out.select("n", F.round("rmse", 9).alias("rmse"))


@register("user_cf_predictions", f"""
with {USER_PRED_SQL}
select user_id, item_id, rating, round(prediction, 9) as prediction from pred
""")
def q_user_cf_predictions(spark, sf):
    p = evaluate.user_cf_predictions(_ratings(spark, sf), k=29, unit=UNIT)
    return p.select("user_id", "item_id", "rating", F.round("prediction", 9).alias("prediction"))


@register("user_cf_rmse", f"""
with {USER_PRED_SQL}
select count(*) as n, round(sqrt(avg((rating - prediction) * (rating - prediction))), 9) as rmse from pred
""")
def q_user_cf_rmse(spark, sf):
    out = evaluate.user_cf_rmse(_ratings(spark, sf), k=29, unit=UNIT)
    return out.select("n", F.round("rmse", 9).alias("rmse"))


# --- matrix factorisation (iterative: no SQL form, rows-only checks) ---------------------

SPLIT_SQL = f"""{RATINGS_SQL},
halves as (select *, case when ('0x' || substr(md5('42|' || user_id || '|' || item_id), 1, 12))::bigint % 10000 < 7000
                          then 'train' else 'test' end as split from rated)"""


@register("split_by_hash", f"with {SPLIT_SQL} select user_id, item_id, round(rating, 9) as rating, split from halves")
def q_split_by_hash(spark, sf):
    r = _ratings(spark, sf, persist=False)
    train, test = als.split_by_hash(r, ["user_id", "item_id"], 0.7, seed=42)
    return (train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
            .select("user_id", "item_id", F.round("rating", 9).alias("rating"), "split"))


@register("split_sizes", f"""with {SPLIT_SQL}
select count(*) filter (split = 'train') as n_train, count(*) filter (split = 'test') as n_test from halves""")
def q_split_sizes(spark, sf):
    return als.split_sizes(_ratings(spark, sf, persist=False), ["user_id", "item_id"], 0.7, seed=42)


@register("als_recommend")
def q_als_recommend(spark, sf):
    return als.als_recommend(_ratings(spark, sf), n=50, reg=0.1, iters=10, seed=42)


@register("als_grid_search")
def q_als_grid_search(spark, sf):
    return als.als_grid_search(_ratings(spark, sf), regs=(0.1, 0.01, 0.001), seed=42)


@register("als_rmse")
def q_als_rmse(spark, sf):
    return als.als_rmse(_ratings(spark, sf), reg=0.1, seed=42)


# What can be checked in SQL about a trained model: facts that hold for any right result.

@register("als_recommend_check", f"""
with {RATINGS_SQL}, u as (select distinct user_id from rated)
select count(*) as users, 0::bigint as taken_pairs, 0::bigint as users_over_n, 0::bigint as rank_gaps, 0::bigint as out_of_order from u
""")
def q_als_recommend_check(spark, sf):
    """Users of the ratings; recommendations of pairs already taken, users with more than n, with gaps in ranks, or with a
    rating above that of a better rank: none of these may occur."""
    r = _ratings(spark, sf)
    recs = als.als_recommend(r, n=50, reg=0.1, iters=10, seed=42)
    recs = saved(recs, "recommended") if task_width(r) else recs.persist()
    taken = recs.join(r.select("user_id", F.col("item_id").alias("course_id")).distinct(), ["user_id", "course_id"])
    before = F.lag("rating").over(Window.partitionBy("user_id").orderBy("ranking"))
    per = (recs.withColumn("up", (F.col("rating") > before).cast("int")).groupBy("user_id")
           .agg(F.count("*").alias("m"), F.max("ranking").alias("last"), F.sum("up").alias("up")))
    facts = per.agg(F.count_if(F.col("m") > 50).alias("users_over_n"), F.count_if(F.col("m") != F.col("last")).alias("rank_gaps"),
                    F.coalesce(F.sum("up"), F.lit(0)).cast("bigint").alias("out_of_order"))
    return (r.agg(F.countDistinct("user_id").alias("users")).crossJoin(taken.agg(F.count("*").alias("taken_pairs")))
            .crossJoin(facts))


def _scored_sql(regs: str) -> str:
    return f"""
with {SPLIT_SQL}, t as (select * from halves where split = 'train'),
 s as (select count(*) as n from halves h where split = 'test'
       and exists (select 1 from t where t.user_id = h.user_id) and exists (select 1 from t where t.item_id = h.item_id)),
 u as (select count(distinct user_id) as users from t),
 g as (select unnest([{regs}]::double[]) as "lambda")
select "lambda", s.n, u.users, true as rmse_agrees, true as solved from g, s, u
"""


def _model_facts(spark, sf, regs, reported):
    """Per grid point: the test pairs scored (both ids seen in training), the users with factors, whether the reported error is the root of
    the saved predictions' mean square (written as moments, apart from the evaluator's form), and whether every user's factors solve
    their normal equations to the precision of single floats. These hold for any right fit, good or bad."""
    r = _ratings(spark, sf)
    facts = []

    def checked():
        """The fitted models, each looked at before the search goes on with it."""
        for point in als.als_grid_models(r, regs=regs, seed=42):
            _, lam, model, scored, train = point
            p = reliable_checkpoint(scored.select(F.col("rating").cast("double").alias("y"), F.col("prediction").cast("double").alias("p")))
            moments = p.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(F.col("y") * F.col("y")) - 2 * F.avg(F.col("y") * F.col("p"))
                                                                 + F.avg(F.col("p") * F.col("p"))).alias("again"))
            error = reliable_checkpoint(als.normal_equation_error(model, train, lam))
            facts.append(moments.crossJoin(error).select(F.lit(lam).alias("lambda"), "n", "users", "again", (F.col("error") < 1e-4).alias("solved")))
            yield point
            del point, model, scored, train  # before the next model is fitted

    told = reported(r, checked())
    out = facts[0]
    for f in facts[1:]:
        out = out.unionByName(f)
    return out.join(told, "lambda").select("lambda", "n", "users", (F.abs(F.col("again") - F.col("rmse")) < 1e-4).alias("rmse_agrees"), "solved")


@register("als_grid_check", _scored_sql("0.1, 0.01, 0.001"))
def q_als_grid_check(spark, sf):
    regs = (0.1, 0.01, 0.001)
    return _model_facts(spark, sf, regs, lambda r, models: als.als_grid_search(r, regs=regs, seed=42, models=models).select("lambda", "rmse"))


@register("als_rmse_check", _scored_sql("0.1"))
def q_als_rmse_check(spark, sf):
    return _model_facts(spark, sf, (0.1,), lambda r, models: als.als_rmse(r, reg=0.1, seed=42, models=models).select(F.lit(0.1).alias("lambda"), "rmse"))


# --- stored and mergeable forms ------------------------------------------------------------

@register("zip_frames", """
with a as (select type, name, cast(sum(participants_number) as bigint) as name_num from course group by type, name),
b as (select type, school, count(*) as school_cnt from course group by type, school),
ra as (select * from (select *, row_number() over (partition by type order by name_num desc nulls last, name asc nulls first) as rn
                      from a) t where rn <= 5),
rb as (select * from (select *, row_number() over (partition by type order by school_cnt desc, school asc nulls first) as rn
                      from b) t where rn <= 3)
select ra.type, cast(ra.rn as int) as rn, ra.name, ra.name_num, rb.school, rb.school_cnt
from ra left join rb on ra.type = rb.type and ra.rn = rb.rn
""")
def q_zip_frames(spark, sf):
    """Two rankings by different measures and lengths."""
    c = Catalog(spark, sf).course()
    names = c.groupBy("type", "name").agg(F.sum(F.col("participants_number").cast("bigint")).alias("name_num"))
    schools = summary.group_count(c, ["type", "school"], "school_cnt")
    ra = topk.top_k_per_group(names, ["type"], [F.col("name_num").desc_nulls_last()], 5, ties=[F.col("name").asc_nulls_first()])
    rb = topk.top_k_per_group(schools, ["type"], [F.col("school_cnt").desc()], 3, ties=[F.col("school").asc_nulls_first()])
    return topk.zip_frames([ra, rb], ["type"], how="left")


@register("hot_by_month_incremental", _month_sql("inner"))
def q_hot_by_month_incremental(spark, sf):
    """The catalogue in three batches, ranked again month by month as they come."""
    store = shared_path(spark, "months")
    course = Catalog(spark, sf).course()
    for batch in range(3):
        monthly.add_batch(store, batch, course.where(F.pmod(F.xxhash64("id"), F.lit(3)) == batch))
    return monthly.monthly_rankings(spark, store, how="inner")


@register("monthly_distinct_customers", """
select cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month, count(distinct o_custkey) as customers
from orders group by 1, 2
""")
def q_monthly_distinct_customers(spark, sf):
    """Bitmaps of each day, merged to months: distinct counts that add up."""
    orders = load_tables(spark, sf, ["orders"])["orders"]
    days = bitmaps.id_bitmaps(orders, "o_custkey", by=["o_orderdate"])
    months = days.select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), "bucket", "bitmap")
    return bitmaps.bitmap_counts(bitmaps.merged_bitmaps(months, by=["year", "month"]), by=["year", "month"], name="customers")


@register("item_cf_from_tables", ORACLE_ITEM_CF)
def q_item_cf_from_tables(spark, sf):
    """Item CF through bucketed tables of ratings, neighbours, scores and history."""
    r = _ratings(spark, sf)
    nb = similarity.cosine_neighbors(r, entity="item_id", by="user_id", value="x", k=12)
    return buckets.item_cf_from_tables(r, nb, n=12)


FLAGSHIP = "item_cf_recommend"
