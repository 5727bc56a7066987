"""Hand-made cases: cleaning, rankings and summaries."""

import datetime as dt

from pyspark.sql import functions as F

from recengine.functions.columns import STATUS_LABELS, lifecycle_status, parse_cjk_date
from recengine.operators import analysis, clean, summary, topk

ONGOING, ENDED, UPCOMING, UNKNOWN = STATUS_LABELS


def test_parse_cjk_date_malformed_is_null(spark):
    df = spark.createDataFrame([("2023年9月1日",), ("2024-1-31",), ("2023年13月1日",), ("junk",), (None,)],
                               "t string")
    got = [r[0] for r in df.select(parse_cjk_date("t")).collect()]
    assert got == [dt.date(2023, 9, 1), dt.date(2024, 1, 31), None, None, None]


def test_lifecycle_status_boundaries(spark):
    t = dt.datetime(2020, 6, 1)
    d = dt.date
    rows = [(d(2020, 1, 1), d(2020, 12, 1)),   # ongoing
            (d(2019, 1, 1), d(2020, 1, 1)),    # ended
            (d(2021, 1, 1), d(2021, 6, 1)),    # upcoming
            (d(2020, 6, 1), d(2020, 12, 1)),   # start = t -> unknown
            (d(2020, 1, 1), d(2020, 6, 1)),    # end = t -> unknown
            (None, None)]
    df = spark.createDataFrame(rows, "s date, e date")
    got = [r[0] for r in df.select(lifecycle_status("s", "e", t)).collect()]
    assert got == [ONGOING, ENDED, UPCOMING, UNKNOWN, UNKNOWN, UNKNOWN]


def test_top_k_ties_and_null_groups(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, 4), (None, 4, 1), (None, 5, 2)],
                               "g string, id int, v int")
    out = topk.top_k_per_group(df, ["g"], [F.col("v").desc()], 2, ties=["id"]).collect()
    got = sorted((r.g or "", r.id, r.rn) for r in out)
    assert got == [("", 4, 2), ("", 5, 1), ("a", 1, 1), ("a", 2, 2)]


def test_top_k_plans_partial_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), F.col("id").alias("v"))
    out = topk.top_k_per_group(df, ["g"], [F.col("v").desc()], 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert out.count() == 21


def test_dedup_keeps_first_and_null_keys_group(spark):
    df = spark.createDataFrame([("x", "s", None, 1), ("x", "s", 3, 2), ("x", None, 5, 3), ("x", None, 4, 4)],
                               "name string, school string, m int, src_id int")
    out = clean.dedup_keep_first(df, ["name", "school"], [F.col("m").asc_nulls_first()], ties=["src_id"])
    assert sorted(r.src_id for r in out.collect()) == [1, 4]


def test_assign_row_ids_gapless_and_partition_independent(spark):
    base = spark.range(0, 5000).select(((F.col("id") * 7919) % 1000).alias("m"), F.col("id").alias("k"))
    expected = None
    for parts in (1, 7, 50):
        out = clean.assign_row_ids(base.repartition(parts), [F.col("m"), F.col("k")], num_partitions=parts)
        rows = sorted((r.id, r.m, r.k) for r in out.collect())
        assert [r[0] for r in rows] == list(range(1, 5001))
        assert [(r[1], r[2]) for r in rows] == sorted((r[1], r[2]) for r in rows)
        expected = expected or rows
        assert rows == expected
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]


def test_clean_catalog_small(spark):
    rows = [
        (1, "T", "/1", None, "i1", "n1", "s1", "L1", "1999年1月1日", "1999年3月1日", None),
        (2, "T", "/2", 10, "i2", "n1", "s1", "L1", "1998年1月1日", "1999年3月1日", 0.5),  # dup of 1
        (3, "T", "/3", 5, None, "n2", "s1", "L1", "1998年1月1日", "1999年3月1日", 0.5),   # no instructor
        (4, "T", "/4", 7, "i4", "n3", "s2", "L2", "2001年1月1日", "2001年3月1日", 0.5),   # after cutoff
        (5, "T", "/5", 2, "i5", "n4", "s2", "L2", "1998年7月1日", "1999年3月1日", 0.4),
    ]
    raw = spark.createDataFrame(rows, "src_id bigint, type string, link string, participants_number bigint, "
                                      "instructor string, name string, school string, labels string, "
                                      "start_time string, end_time string, grading double")
    out = clean.clean_catalog(raw, cutoff="2001-01-01", as_of=dt.datetime(1998, 6, 1), tie="src_id").orderBy("id").collect()
    assert [(r.id, r.src_id, r.participants_number, r.grading, r.status) for r in out] == [
        (1, 1, 0, 0.0, UPCOMING), (2, 5, 2, 0.4, UPCOMING)]


def test_cardinality_counts_null_as_one(spark):
    a = spark.createDataFrame([("a",), (None,), ("a",)], "c string")
    b = spark.createDataFrame([(1,), (2,)], "u int")
    row = summary.cardinality_summary({"c_cnt": (a, "c"), "u_cnt": (b, "u")}).first()
    assert (row.c_cnt, row.u_cnt) == (2, 2)


def test_stacked_value_counts_keeps_both_rows(spark):
    df = spark.createDataFrame([("x", "x"), ("y", "x")], "a string, b string")
    got = sorted(tuple(r) for r in summary.stacked_value_counts(df, ["a", "b"], "v", "cnt").collect())
    assert got == [("x", 1), ("x", 2), ("y", 1)]


def test_group_count_null_is_group(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "t string")
    got = sorted((r.t or "", r.cnt) for r in summary.group_count(df, ["t"]).collect())
    assert got == [("", 2), ("a", 1)]


def test_hot_by_group_left_vs_inner(spark):
    rows = [(1, "A", "n1", "s1", "i1", 10), (2, "A", "n2", "s2", None, 5), (3, None, "n3", "s3", "i3", 7)]
    c = spark.createDataFrame(rows, "id bigint, type string, name string, school string, instructor string, "
                                    "participants_number bigint")
    left = analysis.hot_by_group(c, how="left").collect()
    inner = analysis.hot_by_group(c, how="inner").collect()
    assert len(left) == 3 and len(inner) == 2
    nulls = [r for r in left if r.type is None]
    assert nulls[0].name == "n3" and nulls[0].school is None and nulls[0].instructor is None
    a1 = [r for r in inner if r.rn == 1][0]
    assert (a1.name, a1.name_num, a1.school, a1.instructor) == ("n1", 10, "s1", "i1")
    # the SQL-style and DataFrame-style forms agree on the rows both keep
    assert sorted(tuple(r) for r in inner) == sorted(tuple(r) for r in left if r.type is not None)


def test_assign_row_ids_empty(spark):
    df = spark.createDataFrame([], "m int, k int")
    assert clean.assign_row_ids(df, ["m", "k"]).count() == 0


def test_cardinality_approx_close(spark):
    df = spark.range(20000).select((F.col("id") % 5000).alias("c"))
    exact = summary.cardinality_summary({"n": (df, "c")}).first().n
    approx = summary.cardinality_summary({"n": (df, "c")}, approx=True).first().n
    assert exact == 5000 and abs(approx - exact) / exact < 0.05


def test_status_literal_follows_session_time_zone(spark):
    t = dt.datetime(2020, 6, 1)
    df = spark.createDataFrame([(dt.date(2020, 6, 1), dt.date(2020, 12, 1))], "s date, e date")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "Asia/Shanghai", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert df.select(lifecycle_status("s", "e", t)).first()[0] == UNKNOWN, tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_clean_catalog_on_the_raw_schema(spark):
    """The 13 raw columns, without a source id: ties are broken by the other columns and nothing is added."""
    cols = ("type link participants_number instructor name school labels start_time end_time grading overview "
            "cover_image_url remark").split()
    row = lambda name, n, link: ("T", link, n, "i", name, "s", "L", "1998年7月1日", "1999年3月1日", 4.85, "o", "u", "r")
    kinds = {"participants_number": "bigint", "grading": "double"}
    raw = spark.createDataFrame([row("b", 3, "/2"), row("b", 3, "/1"), row("a", None, "/3"), row("c", 3, "/0")],
                                ", ".join(f"{c} {kinds.get(c, 'string')}" for c in cols))
    for df in (raw, raw.repartition(5)):
        out = clean.clean_catalog(df, as_of=dt.datetime(1998, 6, 1)).orderBy("id").collect()
        assert [(r.id, r.name, r.link, r.participants_number) for r in out] == [
            (1, "a", "/3", 0), (2, "c", "/0", 3), (3, "b", "/1", 3)]
        assert "src_id" not in out[0].asDict() and {"overview", "cover_image_url"} <= set(out[0].asDict())
