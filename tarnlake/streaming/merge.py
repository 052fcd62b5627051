"""The cleaned-table step as a stream: each micro-batch is deduplicated, cleaned and merged into a table of buckets.

The number of the batch is stored beside the mark, after the table is written. A batch that comes again, because the job
died before the stream noted it as done, is left alone when its number is stored; when only the table was written,
merging it again gives the same table. Rows older than what the table holds for their key change nothing, so
files may arrive in any order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import latest_per_key
from ..operators.merge import ACTIVE
from ..sources.buckets import BucketedTable


@dataclass(frozen=True)
class StreamMerge:
    """Where a stream merges to: table, folder of its control rows, name, and the column that tells how new a row is."""

    table: BucketedTable
    control: str
    asset: str
    newest_by: str
    transform: Callable[[DataFrame], DataFrame] = lambda df: df
    ties: Sequence[str] | None = None

    def done(self, spark: SparkSession) -> tuple[int, object]:
        """The last batch that was merged and the mark; -1 and None before the first."""
        try:
            rows = spark.read.schema("asset_key string, batch_id long, watermark_value timestamp, last_updated timestamp").parquet(self.control)
        except Exception as e:  # noqa: BLE001  (no control rows have been written)
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return -1, None
        last = rows.where(F.col("asset_key") == self.asset).agg(F.max("batch_id"), F.max("watermark_value")).first()
        return (-1, None) if last[0] is None else (last[0], last[1])

    def apply(self, batch: DataFrame, batch_id: int, at: Column) -> bool:
        """Merge one batch, unless its number is stored already; true if it was merged."""
        spark, keys = batch.sparkSession, list(self.table.keys)
        last, mark = self.done(spark)
        if batch_id <= last:
            return False
        newest = latest_per_key(batch, keys, self.newest_by, self.ties)
        rows = self.transform(newest).withColumn(ACTIVE, F.lit(True)).persist()
        try:
            top = rows.agg(F.max(F.col(self.newest_by).cast("timestamp"))).first()[0]
            if last < 0:
                self.table.create(rows, replace=True)  # a first batch that comes again finds what it wrote
            elif top is not None:
                known = self.table.read(spark, self.table.buckets_of(rows)).select(*keys, F.col(self.newest_by).alias("__known"))
                met = rows.join(known, keys, "left").where(F.col("__known").isNull() | (F.col(self.newest_by) >= F.col("__known")))
                self.table.merge(met.select(rows.columns))
        finally:
            rows.unpersist()
        mark = top if mark is None or (top is not None and top > mark) else mark
        one = spark.createDataFrame([(self.asset, batch_id, mark)], "asset_key string, batch_id long, watermark_value timestamp")
        one.withColumn("last_updated", at.cast("timestamp")).write.mode("append").parquet(self.control)
        return True

    def run(self, stream: DataFrame, checkpoint: str, at: Column | None = None) -> None:
        """Merge what is new and return when done."""
        at = F.current_timestamp() if at is None else at
        query = stream.writeStream.foreachBatch(lambda batch, batch_id: self.apply(batch, batch_id, at) and None) \
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
