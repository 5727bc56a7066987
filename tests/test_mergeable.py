"""Bitmap counts, incremental months, rankings of free frames, sorted rankings."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from recengine.operators import analysis, bitmaps, monthly, summary, topk


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def ids(spark):
    rng = random.Random(1)
    values = [None, 0, 1, -1, 32767, 32768, 32769, -32768, -32769, 10 ** 12, 2 ** 31] * 3 + [rng.randrange(70_000) for _ in range(2000)]
    return spark.createDataFrame([(v, i % 7, None if i % 5 == 0 else f"t{i % 40}", i % 2 == 0) for i, v in enumerate(values)],
                                 "v long, day int, s string, b boolean")


def test_bitmaps_count_exactly_and_merge(spark):
    df = ids(spark)
    n = df.select("v").distinct().count()
    assert bitmaps.bitmap_counts(bitmaps.id_bitmaps(df, "v")).first()[0] == n
    days = bitmaps.id_bitmaps(df, "v", by=["day"])
    per_day = {r.day: r["distinct"] for r in bitmaps.bitmap_counts(days, by=["day"]).collect()}
    assert per_day == {r.day: r["count"] for r in df.select("v", "day").distinct().groupBy("day").count().collect()}
    first, rest = days.where("day < 3"), days.where("day >= 3")  # stored apart, merged later
    assert bitmaps.bitmap_counts(bitmaps.merged_bitmaps(first, rest)).first()[0] == n
    assert bitmaps.bitmap_counts(bitmaps.id_bitmaps(df.limit(0), "v")).first()[0] == 0


def test_distinct_counts_of_all_types_without_expand(spark):
    df = ids(spark)
    out = bitmaps.distinct_counts({"a": "v", "b": "s", "c": "day", "d": "b"}, df)
    assert [tuple(r) for r in out.collect()] == [(df.select("v").distinct().count(), df.select("s").distinct().count(), 7, 2)]
    assert "Expand" not in plan_of(out)
    empty = bitmaps.distinct_counts({"a": "v", "b": "s"}, df.limit(0)).first()
    assert tuple(empty) == (0, 0)


def test_summaries_have_no_expand(spark):
    df = ids(spark).withColumn("u", F.col("day").cast("long"))
    profile = summary.rating_profile(df, "u", "v")
    assert tuple(profile.first()) == (df.count(), 7, df.select("v").distinct().count()) and "Expand" not in plan_of(profile)
    text = summary.rating_profile(df, "s", "v")
    assert tuple(text.first()) == (df.count(), df.select("s").distinct().count(), df.select("v").distinct().count())
    assert tuple(summary.rating_profile(df.limit(0), "u", "v").first()) == (0, 0, 0)
    card = summary.cardinality_summary({"x": (df, "s"), "y": (df, "v"), "z": (df.select("day"), "day")})
    assert tuple(card.first()) == (df.select("s").distinct().count(), df.select("v").distinct().count(), 7) and "Expand" not in plan_of(card)


ENTITIES = ("name", "instructor", "school")


def courses(spark, months, n=400, seed=1):
    rng = random.Random(seed)
    rows = [(rng.choice(months), f"n{rng.randrange(30)}", rng.choice([None, "i1", "i2", "i3"]), f"s{rng.randrange(5)}",
             rng.choice([None, *range(9)])) for _ in range(n)]
    return spark.createDataFrame(rows, "start_time_date date, name string, instructor string, school string, participants_number long")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_incremental_months_equal_the_full_run(spark, tmpdir_path, how):
    old = [dt.date(2023, m, 3) for m in range(1, 13)] + [None]
    batches = [courses(spark, old), courses(spark, [dt.date(2024, 1, 5), dt.date(2023, 12, 9)], 60, 2), courses(spark, [dt.date(2024, 2, 1)], 5, 3)]
    changed = [monthly.add_batch(tmpdir_path, k, b, k=4) for k, b in enumerate(batches)]
    assert changed[0] == [0] + [202300 + m for m in range(1, 13)] and changed[1:] == [[202312, 202401], [202402]]
    whole = batches[0].unionByName(batches[1]).unionByName(batches[2])
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(monthly.monthly_rankings(spark, tmpdir_path, how=how)) == rows(analysis.hot_by_month(whole, k=4, how=how))


def test_only_changed_months_are_read(spark, tmpdir_path):
    monthly.add_batch(tmpdir_path, 0, courses(spark, [dt.date(2023, m, 3) for m in range(1, 13)]))
    monthly.add_batch(tmpdir_path, 1, courses(spark, [dt.date(2023, 5, 9)], 30, 2))
    read = monthly.changed_sums(spark, tmpdir_path, [202305], 1)
    files = {os.path.dirname(r.f) for r in read.select(F.input_file_name().alias("f")).distinct().collect()}
    assert {f.split("/sums/")[1] for f in files} == {"batch=0/ym=202305", "batch=1/ym=202305"}  # of 13 partitions
    assert "PartitionFilters: [ym" in read._jdf.queryExecution().executedPlan().toString().replace("isnotnull(", "").replace("PartitionFilters: [batch", "PartitionFilters: [ym")
    assert sorted(os.listdir(f"{tmpdir_path}/ranks/batch=1"))[-1] == "ym=202305"


def test_a_batch_again_counts_once(spark, tmpdir_path):
    rows = courses(spark, [dt.date(2023, 1, 3), dt.date(2023, 2, 3)])
    monthly.add_batch(tmpdir_path, 4, rows)
    first = sorted(map(str, monthly.monthly_rankings(spark, tmpdir_path).collect()))
    monthly.add_batch(tmpdir_path, 4, rows)
    assert sorted(map(str, monthly.monthly_rankings(spark, tmpdir_path).collect())) == first
    with pytest.raises(ValueError):
        monthly.add_batch(tmpdir_path, 3, rows)
    assert monthly.monthly_rankings(spark, f"{tmpdir_path}/none").collect() == []


def test_free_frames_side_by_side(spark):
    a = spark.createDataFrame([("x", 1, 10), ("x", 2, 9), (None, 1, 8), ("y", 1, 7)], "g string, rn int, a int")
    b = spark.createDataFrame([("x", 1, "p"), (None, 1, "q"), ("z", 1, "r")], "g string, rn int, b string")
    c = spark.createDataFrame([("x", 1, 0.5), ("y", 1, 0.25)], "g string, rn int, c double")
    rows = lambda **kw: sorted((tuple(r) for r in topk.zip_frames([a, b, c], ["g"], **kw).collect()), key=str)
    assert rows(how="left") == sorted([("x", 1, 10, "p", 0.5), ("x", 2, 9, None, None), (None, 1, 8, None, None), ("y", 1, 7, None, 0.25)], key=str)
    assert rows(how="inner") == [("x", 1, 10, "p", 0.5)]
    assert topk.zip_frames([a], ["g"], how="inner").count() == 3
    with pytest.raises(ValueError):
        topk.zip_frames([a, a], ["g"])
    with pytest.raises(ValueError):
        topk.zip_frames([a, b], ["g"], how="outer")


def test_rankings_sorted_by_group_and_measure(spark):
    rows = [(i, t, f"n{i % 6}", f"s{i % 3}", f"i{i % 4}", (i * 37) % 50) for i in range(60) for t in ("b", "a")]
    c = spark.createDataFrame(rows, "id long, type string, name string, school string, instructor string, participants_number int")
    out = [(r.type, -r.name_num) for r in analysis.hot_by_group(c.repartition(5), sort=True).collect()]
    assert out == sorted(out) and len({t for t, _ in out}) == 2
    assert "rn" not in analysis.hot_by_group(c, sort=True, with_rank=False).columns
