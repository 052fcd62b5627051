"""Row-level DML and history over a change log.

A change log is a DataFrame with the table's columns plus ``_op`` (insert, update,
delete), ``_version`` and ``_commit_ts``.  One row per changed key and commit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .incremental import latest_per_key, watermark_literal
from .keys import as_keys

LOG_COLUMNS = ("_op", "_version", "_commit_ts")


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """``UPDATE .. SET .. WHERE``: a condition that is null changes nothing."""
    return df.withColumns({
        c: F.when(condition, v.cast(df.schema[c].dataType)).otherwise(F.col(c)) for c, v in values.items()})


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """``DELETE .. WHERE``: rows for which the condition is null stay."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def add_column(df: DataFrame, name: str, data_type: str | T.DataType, default: Any = None) -> DataFrame:
    """``ADD COLUMN``: existing rows get the default, null unless given."""
    if name in df.columns:
        raise ValueError(f"column {name!r} exists")
    return df.withColumn(name, F.lit(default).cast(data_type))


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Reorder and safely cast to ``schema``; a missing or incompatible column raises."""
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    if extra:
        raise ValueError(f"columns {extra} are not in the schema")
    return df.to(schema)


def commit(changes: DataFrame, op: str, version: int, at: Any) -> DataFrame:
    """Rows of one commit, ready to append to a change log."""
    if op not in ("insert", "update", "delete"):
        raise ValueError(f"unknown operation {op!r}")
    return changes.withColumns({
        "_op": F.lit(op),
        "_version": F.lit(version).cast("long"),
        "_commit_ts": F.lit(at).cast("timestamp_ntz"),
    })


def history(log: DataFrame) -> DataFrame:
    """One row per commit: time, operation, rows by kind."""
    return log.groupBy("_version").agg(
        F.max("_commit_ts").alias("commit_ts"),
        F.count_if(F.col("_op") == "insert").alias("rows_inserted"),
        F.count_if(F.col("_op") == "update").alias("rows_updated"),
        F.count_if(F.col("_op") == "delete").alias("rows_deleted"),
    ).withColumnRenamed("_version", "version")


def _state(log: DataFrame, keys: list[str]) -> DataFrame:
    last = latest_per_key(log, keys, "_version", ties=["_op"])
    return last.where(F.col("_op") != "delete").drop(*LOG_COLUMNS)


def version_as_of(log: DataFrame, keys: str | Sequence[str], version: int) -> DataFrame:
    """Table state after the given version."""
    return _state(log.where(F.col("_version") <= version), as_keys(keys))


def timestamp_as_of(log: DataFrame, keys: str | Sequence[str], at: Any) -> DataFrame:
    """Table state at a point in time."""
    mark = watermark_literal(log, "_commit_ts", at)
    return _state(log.where(F.col("_commit_ts") <= mark), as_keys(keys))
