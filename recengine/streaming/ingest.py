"""Streaming form of the append sink: new interactions flow into a table.

The batch application appends simulated interactions to the interaction table. Here new
interaction files are read with Structured Streaming and appended to the same table:
parquet targets use the file sink (exactly once through its commit log); JDBC targets use
``foreachBatch`` with ``write_table(mode="append")`` (at least once: an epoch retried after
a failure may be written again). Progress is kept in ``checkpoint_location``, which must be
a shared folder on a cluster.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from recengine.sources.io import write_table

INTERACTION_SCHEMA = StructType.fromJson({"type": "struct", "fields": [
    {"name": "student_id", "type": "long", "nullable": True, "metadata": {}},
    {"name": "course_id", "type": "long", "nullable": True, "metadata": {}},
    {"name": "rating", "type": "integer", "nullable": True, "metadata": {}},
]})


def interaction_stream(spark: SparkSession, path: str, schema: StructType = INTERACTION_SCHEMA,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """New parquet files under ``path`` as a stream of interactions."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def append_stream(stream: DataFrame, name: str, *, checkpoint_location: str, root: str | None = None,
                  fmt: str = "parquet", url: str | None = None, options: Mapping[str, str] | None = None,
                  available_now: bool = True) -> StreamingQuery:
    """Append every micro-batch of ``stream`` to table ``name``; returns the running query."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    if fmt == "parquet" and url is None:
        if root is None:
            raise ValueError("a parquet sink needs root=")
        return writer.format("parquet").outputMode("append").start(f"{root.rstrip('/')}/{name}")

    def _batch(df: DataFrame, epoch_id: int) -> None:
        write_table(df, name, mode="append", fmt=fmt, url=url, root=root, options=options)

    return writer.foreachBatch(_batch).start()
