"""Command-line entry point: one job per run, parquet or JDBC tables.

    spark-submit recengine/plans/cli.py JOB --source-root DIR --sink-root DIR [--cutoff ...]
    spark-submit recengine/plans/cli.py JOB --jdbc-url URL --jdbc-user U --jdbc-password-env VAR

JOB is one of: load_catalog, analysis, item_cf, user_cf, als, evaluation, als_tuning, rmse_join.
Each table read over JDBC can be split: --jdbc-partition TABLE:COLUMN:LOWER:UPPER:COUNT (repeatable).
The session comes from spark-submit (master, memory, spark.checkpoint.dir); nothing here
fixes a master or writes credentials.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

from pyspark.sql import SparkSession

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from recengine.plans import jobs  # noqa: E402

JOBS = {
    "load_catalog": jobs.load_catalog_job,
    "analysis": jobs.analysis_job,
    "item_cf": jobs.item_cf_job,
    "user_cf": jobs.user_cf_job,
    "als": jobs.als_job,
    "evaluation": jobs.evaluation_job,
    "als_tuning": jobs.als_tuning_job,
    "rmse_join": jobs.rmse_join_job,
}

# options that a job takes, beside source and sink; only those given are passed on
OPTIONS = {
    "load_catalog": ("cutoff", "as_of", "tie"),
    "analysis": ("form",),
    "item_cf": ("k_neighbors", "n"),
    "user_cf": ("k_neighbors", "n"),
    "als": ("n", "reg", "seed"),
    "evaluation": ("seed",),
    "als_tuning": ("seed",),
    "rmse_join": ("left_table", "right_table", "label", "prediction"),
}


def _endpoints(args) -> tuple[dict, dict]:
    if args.jdbc_url:
        opts = {"user": args.jdbc_user or "", "password": os.environ.get(args.jdbc_password_env or "", "")}
        if args.jdbc_driver:
            opts["driver"] = args.jdbc_driver
        ep = {"fmt": "jdbc", "url": args.jdbc_url, "options": opts}
        return ep | {"tables": dict(map(_partition, args.jdbc_partition))}, ep
    return {"root": args.source_root}, {"root": args.sink_root or args.source_root}


def _partition(text: str) -> tuple[str, dict]:
    """TABLE:COLUMN:LOWER:UPPER:COUNT -> (table, read settings)."""
    table, column, lower, upper, count = text.split(":")
    return table, {"partition_column": column, "lower_bound": int(lower), "upper_bound": int(upper),
                   "num_partitions": int(count)}


def job_options(args) -> dict:
    return {k: v for k in OPTIONS[args.job] if (v := getattr(args, k)) is not None}


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("--source-root")
    ap.add_argument("--sink-root")
    ap.add_argument("--jdbc-url")
    ap.add_argument("--jdbc-user")
    ap.add_argument("--jdbc-password-env", help="name of the environment variable holding the password")
    ap.add_argument("--jdbc-driver")
    ap.add_argument("--jdbc-partition", action="append", default=[], metavar="TABLE:COLUMN:LOWER:UPPER:COUNT")
    ap.add_argument("--cutoff", help="load_catalog: upper bound of start/end text")
    ap.add_argument("--as-of", type=dt.datetime.fromisoformat, help="load_catalog: time of the status (default: now)")
    ap.add_argument("--tie", help="load_catalog: column that orders equal rows")
    ap.add_argument("--form", choices=["sql", "dataframe"], help="analysis: output form")
    ap.add_argument("--k-neighbors", type=int, help="item_cf, user_cf: neighbours")
    ap.add_argument("--n", type=int, help="item_cf, user_cf, als: items per user")
    ap.add_argument("--reg", type=float, help="als: regularisation")
    ap.add_argument("--seed", type=int, help="als, evaluation, als_tuning: split and fit")
    ap.add_argument("--left-table", help="rmse_join: table with the label")
    ap.add_argument("--right-table", help="rmse_join: table with the prediction")
    ap.add_argument("--label", help="rmse_join: label column")
    ap.add_argument("--prediction", help="rmse_join: prediction column")
    return ap


def main(argv=None) -> int:
    ap = parser()
    args = ap.parse_args(argv)
    if not args.jdbc_url and not args.source_root:
        ap.error("give --source-root (parquet) or --jdbc-url")
    source, sink = _endpoints(args)
    spark = SparkSession.builder.appName(f"recengine-{args.job}").getOrCreate()
    JOBS[args.job](spark, source=source, sink=sink, **job_options(args))
    return 0


if __name__ == "__main__":
    sys.exit(main())
