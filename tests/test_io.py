"""Sources, sinks, jobs and the streaming append sink (parquet only: no database is started)."""

import os

from recengine.plans import jobs
from recengine.sources import io
from recengine.sources.fixtures import Catalog
from recengine.streaming.ingest import INTERACTION_SCHEMA, append_stream, interaction_stream

from conftest import SF_SMALL


def test_parquet_overwrite_and_append(spark, tmpdir_path):
    df = spark.range(5).toDF("id")
    io.write_table(df, "t", root=tmpdir_path)
    io.write_table(df, "t", root=tmpdir_path, mode="append")
    assert io.read_table(spark, "t", root=tmpdir_path).count() == 10
    io.write_table(df, "t", root=tmpdir_path, mode="overwrite")
    assert io.read_table(spark, "t", root=tmpdir_path, view="t_view").count() == 5
    assert spark.table("t_view").count() == 5


def test_jdbc_options_are_partitioned_and_truncating():
    r = io.jdbc_read_options("jdbc:x://h/db", "course", {"user": "u"}, partition_column="id",
                             lower_bound=1, upper_bound=1000, num_partitions=16)
    assert r["partitionColumn"] == "id" and r["numPartitions"] == "16" and r["user"] == "u"
    w = io.jdbc_write_options("jdbc:x://h/db", "course", num_partitions=8)
    assert w["truncate"] == "true" and w["numPartitions"] == "8"


def test_jobs_end_to_end(spark, tmpdir_path):
    cat = Catalog(spark, SF_SMALL)
    src = os.path.join(tmpdir_path, "src")
    io.write_table(cat.course_infos(), "course_infos", root=src)
    io.write_table(cat.student_course(), "student_course", root=src)
    io.write_table(cat.sys_user(), "sys_user", root=src)
    jobs.load_catalog_job(spark, source={"root": src}, sink={"root": src}, cutoff="2001-01-01")
    out = os.path.join(tmpdir_path, "out")
    jobs.analysis_job(spark, source={"root": src}, sink={"root": out})
    jobs.item_cf_job(spark, source={"root": src}, sink={"root": out})
    jobs.user_cf_job(spark, source={"root": src}, sink={"root": out})
    jobs.evaluation_job(spark, source={"root": src}, sink={"root": out})
    out_df = os.path.join(tmpdir_path, "out_df")
    jobs.analysis_job(spark, source={"root": src}, sink={"root": out_df}, form="dataframe")
    assert io.read_table(spark, "total_analysis", root=out_df).columns == [
        "student_cnt", "name_cnt", "instructor_cnt", "school_cnt"]
    assert "rn" in io.read_table(spark, "year_month_analysis", root=out_df).columns
    assert "rn" not in io.read_table(spark, "year_month_analysis", root=out).columns
    for name in ("school_cnt_analysis", "type_cnt_analysis", "hot_analysis", "total_analysis",
                 "total_analysis2", "year_month_analysis", "course_recommend_item_cf",
                 "course_recommend_user_cf"):
        assert io.read_table(spark, name, root=out).count() > 0, name
    report = {r.model: r for r in io.read_table(spark, "rmse_report", root=out).collect()}
    assert set(report) == {"item_cf", "user_cf", "als"} and all(r.n > 0 for r in report.values())


def test_cli_runs_a_job(spark, tmpdir_path):
    from recengine.plans import cli
    cat = Catalog(spark, SF_SMALL)
    src = os.path.join(tmpdir_path, "src")
    io.write_table(cat.course_infos(), "course_infos", root=src)
    assert cli.main(["load_catalog", "--source-root", src, "--cutoff", "2001-01-01"]) == 0
    assert io.read_table(spark, "course", root=src).count() > 0


def test_streaming_append(spark, tmpdir_path):
    cat = Catalog(spark, SF_SMALL)
    inbox = os.path.join(tmpdir_path, "inbox")
    sc = cat.student_course()
    sc.write.parquet(os.path.join(inbox, "batch1"))
    stream = interaction_stream(spark, os.path.join(inbox, "batch1"), INTERACTION_SCHEMA)
    q = append_stream(stream, "student_course", checkpoint_location=os.path.join(tmpdir_path, "ck"),
                      root=os.path.join(tmpdir_path, "tables"))
    q.awaitTermination(120)
    assert io.read_table(spark, "student_course", root=os.path.join(tmpdir_path, "tables")).count() == sc.count()


def test_read_table_driver_layout(spark):
    df = io.read_table(spark, "part", root=SF_SMALL)
    assert "p_partkey" in df.columns and df.count() > 0
