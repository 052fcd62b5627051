"""Parquet, CSV and image files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                 merge_schema: bool = False) -> DataFrame:
    """Parquet with the given schema; with ``merge_schema`` files of an evolving table are united."""
    reader = spark.read.option("mergeSchema", merge_schema)
    return (reader.schema(schema) if schema is not None else reader).parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Write Parquet. Overwriting a partitioned table replaces only the partitions in ``df``."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    """Comma-separated, double-quoted file with a header and LF or CRLF line ends.

    A file whose quoted fields hold line breaks needs ``multi_line``, which reads each file in
    one task; leave it off for large files without such fields.
    """
    return spark.read.schema(schema).options(
        header=True, sep=",", quote='"', escape='"', multiLine=multi_line, mode="FAILFAST").csv(path)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Image files as rows with the ``image`` struct."""
    return spark.read.format("image").load(path)
