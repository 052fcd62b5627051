"""Incremental load: high-water marks, staging filter, latest row per key, merge counts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import to_ts
from .keys import as_keys, others, require_columns

# Columns of the watermark store and the "never loaded" mark.
WATERMARK_SCHEMA = T.StructType([
    T.StructField("asset_key", T.StringType(), False),
    T.StructField("watermark_value", T.TimestampType(), True),
    T.StructField("last_updated", T.TimestampType(), True),
])
LOW_WATERMARK = "1900-01-01 00:00:00"


def watermark_literal(df: DataFrame, col: str, value: Any) -> Column:
    """``value`` as a literal of the type of ``df[col]``, so that the comparison pushes down."""
    return F.lit(value).cast(df.schema[col].dataType)


def newer_than(df: DataFrame, col: str, watermark: Any | Column | None) -> DataFrame:
    """Rows above the mark; all rows when there is no mark (full load)."""
    require_columns(df, [col])
    if watermark is None:
        return df
    if not isinstance(watermark, Column):
        watermark = watermark_literal(df, col, watermark)
    return df.where(F.col(col) > watermark)


def extract_newer(df: DataFrame, col: str, watermark: Any | None = None, ordered: bool = False
                  ) -> tuple[DataFrame, str]:
    """High-water-mark extract and its mode. The global sort is made only on request."""
    out = newer_than(df, col, watermark)
    mode = "full" if watermark is None else "incremental"
    return (out.orderBy(col) if ordered else out), mode


def staging_filter(df: DataFrame, col: str, watermark: Any | Column = LOW_WATERMARK) -> DataFrame:
    """Batch rows above the stored mark. A source without the column is loaded in full."""
    if col not in df.columns:
        return df
    if not isinstance(df.schema[col].dataType, (T.TimestampType, T.TimestampNTZType)):
        df = df.withColumn(col, to_ts(F.col(col)))
    return newer_than(df, col, watermark)


def new_watermark(df: DataFrame, col: str, old: Any | None = None) -> DataFrame:
    """One row: the batch maximum, or ``old`` when the batch is empty."""
    top = F.max(col)
    if old is not None:
        top = F.coalesce(top, watermark_literal(df, col, old))
    return df.agg(top.alias("watermark_value"))


def get_watermark(store: DataFrame, asset_key: str, default: Any = LOW_WATERMARK) -> DataFrame:
    """One row with the stored mark of an asset, or the default when there is none."""
    mark = F.max(F.when(F.col("asset_key") == asset_key, F.col("watermark_value")))
    return store.where(F.col("asset_key") == asset_key).agg(
        F.lit(asset_key).alias("asset_key"),
        F.coalesce(mark, watermark_literal(store, "watermark_value", default)).alias("watermark_value"))


def watermark_value(store: DataFrame, asset_key: str, default: Any = LOW_WATERMARK) -> datetime:
    """The stored mark as one Python value, for a literal that pushes down to the source."""
    return get_watermark(store, asset_key, default).first()["watermark_value"]


def add_audit_columns(df: DataFrame, run_id: str, ingested_at: Column | None = None) -> DataFrame:
    """Ingestion time and run id. Pass the time to make a run repeatable."""
    return df.withColumns({
        "_ingested_at": F.current_timestamp() if ingested_at is None else ingested_at,
        "_job_run_id": F.lit(run_id),
    })


def latest_per_key(df: DataFrame, keys: str | Sequence[str], newest_by: str,
                   ties: Sequence[str] | None = None) -> DataFrame:
    """One row per key, the newest; equal marks are settled by the other columns, ascending.

    ``row_number() = 1`` lets Spark keep one row per key inside each map task before the
    shuffle, so a key that holds a large part of the table still sends one row per task.
    """
    keys = as_keys(keys)
    require_columns(df, [*keys, newest_by])
    if ties is None:
        ties = others(df, [*keys, newest_by])
    order = [F.col(newest_by).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in ties]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rn", rank).where(F.col("__rn") == 1).drop("__rn")


def one_per_key(df: DataFrame, keys: str | Sequence[str], order_by: Sequence[str] | None = None
                ) -> DataFrame:
    """Deterministic ``dropDuplicates``: the smallest row per key in the given column order."""
    keys = as_keys(keys)
    order = [F.col(c).asc_nulls_first() for c in (order_by or others(df, keys))] or [F.lit(1)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rn", rank).where(F.col("__rn") == 1).drop("__rn")


def dedup_latest(df: DataFrame, keys: str | Sequence[str], watermark_col: str,
                 watermark: Any | Column | None = None, ties: Sequence[str] | None = None) -> DataFrame:
    """Rows above the mark, reduced to the newest row per key."""
    return latest_per_key(newer_than(df, watermark_col, watermark), keys, watermark_col, ties)


def merge_metrics(source: DataFrame, target: DataFrame | None, keys: str | Sequence[str]) -> DataFrame:
    """One row (inserts, updates) for a merge of ``source`` into ``target``.

    Target keys are counted before the join, so the join never multiplies rows.
    """
    keys = as_keys(keys)
    if target is None:
        return source.agg(F.count(F.lit(1)).alias("inserts"), F.lit(0).cast("bigint").alias("updates"))
    hits = target.groupBy(*keys).agg(F.count(F.lit(1)).alias("__hits"))
    per_key = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    joined = per_key.join(hits, keys, "left")
    updates = F.coalesce(F.sum(F.col("__rows") * F.coalesce("__hits", F.lit(0))), F.lit(0))
    rows = F.coalesce(F.sum("__rows"), F.lit(0))
    return joined.agg((rows - updates).alias("inserts"), updates.alias("updates"))
