"""Incremental staging load as a stream.

The query's checkpoint records which files were taken, so it plays the part of the
watermark table: every run takes what is new and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql import Column

from ..operators.incremental import add_audit_columns


def read_new_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The files of a table, be its path one file or a folder of part files."""
    path = path.rstrip("/")
    # as a pattern that only this path fits: Spark streams from a folder or from what a pattern finds, not from one file
    return spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")


def load_new(batch: DataFrame, target: str, checkpoint: str, run_id: str, ingested_at: Column | None = None
             ) -> None:
    """Append the new rows with audit columns to the staging history and return when done."""
    query = (add_audit_columns(batch, run_id, ingested_at).writeStream
             .format("parquet").outputMode("append")
             .option("path", target).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
