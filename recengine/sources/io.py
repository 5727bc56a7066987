"""Table sources and sinks: parquet folders and JDBC tables.

``read_table`` / ``write_table`` are the two entry points. Connection settings (url, user,
password, driver) are always caller-supplied options; nothing is hard-wired.

A JDBC read is split into ``num_partitions`` range queries over ``partition_column`` when
bounds are given, or one query per condition of ``predicates`` (key ranges of equal row counts, see
``partitions``), so a large table is not pulled through a single connection. Overwriting a file
table is staged (``staged``): the job may read the table, and the old rows stay until the new ones are complete. A JDBC
overwrite keeps the target's definition (``truncate``), and writes use batched inserts with
at most ``num_partitions`` concurrent connections.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from recengine.sources.staged import staged_overwrite


def jdbc_read_options(url: str, table: str, options: Mapping[str, str] | None = None, *,
                      partition_column: str | None = None, lower_bound: int | None = None,
                      upper_bound: int | None = None, num_partitions: int | None = None,
                      fetch_size: int = 10_000) -> dict[str, str]:
    """Options of a partitioned JDBC scan (a plain dict, so it can be inspected and tested)."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    opts.update({k: str(v) for k, v in (options or {}).items()})
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    return opts


def jdbc_write_options(url: str, table: str, options: Mapping[str, str] | None = None, *,
                       num_partitions: int | None = None, batch_size: int = 10_000) -> dict[str, str]:
    """Options of a JDBC write; overwrite truncates instead of dropping the table."""
    opts = {"url": url, "dbtable": table, "truncate": "true", "batchsize": str(batch_size)}
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    opts.update({k: str(v) for k, v in (options or {}).items()})
    return opts


def read_table(spark: SparkSession, name: str, *, root: str | None = None, fmt: str = "parquet",
               url: str | None = None, options: Mapping[str, str] | None = None,
               partition_column: str | None = None, lower_bound: int | None = None,
               upper_bound: int | None = None, num_partitions: int | None = None,
               predicates: Sequence[str] | None = None, view: str | None = None) -> DataFrame:
    """Read table ``name`` from a parquet folder (``root``) or over JDBC (``url``).

    ``predicates``: one JDBC query per condition, instead of ranges of equal width; every row must meet exactly one.
    ``view`` optionally registers the result as a temporary view of that name.
    """
    if fmt == "jdbc":
        if url is None:
            raise ValueError("a JDBC read needs url=")
        if predicates is not None and partition_column is not None:
            raise ValueError("give either predicates or a partition column")
        opts = jdbc_read_options(url, name, options, partition_column=partition_column, lower_bound=lower_bound,
                                 upper_bound=upper_bound, num_partitions=num_partitions)
        if predicates is not None:
            properties = {k: v for k, v in opts.items() if k not in ("url", "dbtable")}
            df = spark.read.jdbc(url, name, predicates=list(predicates), properties=properties)
        else:
            df = spark.read.format("jdbc").options(**opts).load()
    else:
        if root is None:
            raise ValueError("a file read needs root=")
        path = name if name.startswith("/") else f"{root.rstrip('/')}/{name}"
        reader = spark.read.format(fmt).options(**dict(options or {}))
        try:
            df = reader.load(path)
        except AnalysisException as err:
            # a folder <root>/<name> or, as the driver's tables are laid out, <root>/<name>.<fmt>
            if "PATH_NOT_FOUND" not in str(err):
                raise
            df = reader.load(f"{path}.{fmt}")
    if view:
        df.createOrReplaceTempView(view)
    return df


def write_table(df: DataFrame, name: str, *, mode: str = "overwrite", root: str | None = None,
                fmt: str = "parquet", url: str | None = None,
                options: Mapping[str, str] | None = None,
                num_partitions: int | None = None, staged: bool = True) -> None:
    """Write ``df`` as table ``name``: parquet folder under ``root`` or a JDBC table.

    Overwriting a folder is staged (``staged_overwrite``) unless ``staged`` is false."""
    if mode not in ("overwrite", "append", "ignore", "error", "errorifexists"):
        raise ValueError(f"unknown save mode {mode!r}")
    if fmt == "jdbc":
        if url is None:
            raise ValueError("a JDBC write needs url=")
        # the numPartitions option caps concurrent connections (Spark coalesces to it)
        (df.write.format("jdbc").mode(mode)
            .options(**jdbc_write_options(url, name, options, num_partitions=num_partitions))
            .save())
        return
    if root is None:
        raise ValueError("a file write needs root=")
    path = f"{root.rstrip('/')}/{name}"
    if mode == "overwrite" and staged:
        staged_overwrite(df, path, fmt, dict(options or {}))
        return
    df.write.format(fmt).mode(mode).options(**dict(options or {})).save(path)


def load_tables(spark: SparkSession, sf_dir: str, names: list[str] | tuple[str, ...]) -> dict[str, DataFrame]:
    """The driver's parquet tables (``<sf_dir>/<name>.parquet``) by name."""
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}
