"""An incremental run from end to end: stage, dedup, merge, write, then store the mark and register the job.

The order is what makes a failed run harmless: the table is written first, and only a written table advances its
mark, so a run that is repeated stages the same rows again and merges them to the same result.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import (WATERMARK_SCHEMA, add_audit_columns, staging_filter, watermark_value)
from ..operators.merge import register_jobs, upsert
from ..sources.schemas import TABLES
from ..sources.tables import replace_table
from .silver import SILVER, SilverTable, silver_step

# Columns of the job registry, and the column that tells how new a source row is.
JOB_SCHEMA = ("job_id bigint, job_name string, layer string, source string, target_table string, merge_key string, "
              "load_mode string, created_at timestamp, updated_at timestamp")
WATERMARK_COLUMN = "last_update"


def stage(name: str, source: DataFrame, watermark: Any | None, run_id: str, at: Column) -> DataFrame:
    """New rows of a registered source table, with audit columns. Without a mark, or a watermark column, all rows."""
    if name not in TABLES:
        raise ValueError(f"{name} is not registered; there are {sorted(TABLES)}")
    new = source if watermark is None else staging_filter(source, WATERMARK_COLUMN, watermark)
    return add_audit_columns(new, run_id, at)


@dataclass(frozen=True)
class Lake:
    """Catalog schema and storage root of the cleaned tables and their two control tables."""

    schema: str
    root: str

    def table(self, name: str) -> str:
        return f"{self.schema}.clean_{name}"

    @property
    def marks(self) -> str:
        return f"{self.schema}.etl_watermarks"

    @property
    def jobs(self) -> str:
        return f"{self.schema}.etl_job"


def stored_mark(spark: SparkSession, lake: Lake, name: str) -> Any | None:
    """The mark of a table, or None before its first run."""
    if not spark.catalog.tableExists(lake.marks):
        return None
    store = spark.table(lake.marks).where(F.col("asset_key") == name)
    return None if store.isEmpty() else watermark_value(store, name)


def run(lake: Lake, name: str, staging: DataFrame, version: str, at: Column, spec: SilverTable | None = None,
        source_keys: DataFrame | None = None, watermark_col: str = "_ingested_at", ties: list[str] | None = None) -> DataFrame:
    """Bring one table up to date with its staging history; returns the counts of the merge.

    ``version`` names the snapshot written and is new for every run. The batch is computed once, for the table and
    the counts. The new mark is the batch's maximum, or the old one when the batch is empty.
    """
    spark, spec = staging.sparkSession, spec or SILVER[name]
    if spec.prepare:
        staging = spec.prepare(staging)
    mark = stored_mark(spark, lake, name)
    target = spark.table(lake.table(name)) if spark.catalog.tableExists(lake.table(name)) else None
    step = silver_step(staging, target, spec.keys, spec.transform, watermark=mark, watermark_col=watermark_col,
                       source_keys=source_keys if spec.delete_sync else None, deleted_at=at, ties=ties, persist=True)
    try:
        metrics = spark.createDataFrame(step.metrics.collect(), step.metrics.schema)  # one row
        replace_table(step.table, lake.table(name), f"{lake.root}/clean_{name}/{version}")
        top = step.watermark.select(F.lit(name).alias("asset_key"), F.col("watermark_value").cast("timestamp"),
                                    at.cast("timestamp").alias("last_updated")).where("watermark_value IS NOT NULL")
        marks = spark.table(lake.marks) if spark.catalog.tableExists(lake.marks) else spark.createDataFrame([], WATERMARK_SCHEMA)
        replace_table(upsert(marks, top, "asset_key"), lake.marks, f"{lake.root}/etl_watermarks/{name}-{version}")
        jobs = spark.table(lake.jobs) if spark.catalog.tableExists(lake.jobs) else spark.createDataFrame([], JOB_SCHEMA)
        job = spark.createDataFrame([(name, "silver", f"stg_{name}", lake.table(name), ",".join(spec.keys), "merge")],
                                    "job_name string, layer string, source string, target_table string, merge_key string, load_mode string")
        replace_table(register_jobs(jobs, job, at.cast("timestamp")), lake.jobs, f"{lake.root}/etl_job/{name}-{version}")
    finally:
        step.batch.unpersist()
    return metrics
