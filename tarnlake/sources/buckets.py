"""Tables laid out by key-hash bucket, so that a merge or a delete sync touches only the buckets that it must.

A table is a folder of Parquet files with one sub-folder per bucket. A batch names its buckets; these alone are read,
merged and replaced by dynamic partition overwrite, and files of all others stay as they are. New files are written
beside the old ones and take their place when the job commits, so what is read is there until it is no longer needed. A
run that dies while it commits has replaced some buckets and not others; running the same batch again gives the
whole result, because an upsert repeated changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.digests import bucket_of, changed_buckets
from ..operators.keys import all_set, as_keys, require_columns
from ..operators.merge import ACTIVE, deleted_marks, upsert
from .files import write_parquet

BUCKET = "_bucket"


@dataclass(frozen=True)
class BucketedTable:
    """Folder, key, number of buckets, and files that each bucket is written as.

    Choose buckets of a size that is cheap to rewrite; at most a few ten thousand, for their numbers pass through the driver.
    """

    path: str
    keys: tuple[str, ...]
    buckets: int = 64
    files: int = 1

    def with_bucket(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, bucket_of(self.keys, self.buckets))

    def _write(self, df: DataFrame, mode: str) -> None:
        part = F.pmod(F.xxhash64(F.lit(1), *[F.col(k) for k in self.keys]), F.lit(self.files))
        write_parquet(df.repartition(BUCKET, part), self.path, mode, [BUCKET])

    def create(self, df: DataFrame, replace: bool = False) -> None:
        """Write the whole table; the folder must not exist, unless its buckets are to be replaced."""
        require_columns(df, self.keys)
        self._write(self.with_bucket(df), "overwrite" if replace else "errorifexists")

    def schema(self, spark: SparkSession) -> T.StructType:
        found = spark.read.parquet(self.path).schema
        return T.StructType([f for f in found.fields if f.name != BUCKET])

    def read(self, spark: SparkSession, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table, or some of its buckets: the others' folders are not opened."""
        schema = T.StructType([*self.schema(spark).fields, T.StructField(BUCKET, T.IntegerType())])
        df = spark.read.schema(schema).parquet(self.path)
        return (df if buckets is None else df.where(F.col(BUCKET).isin([int(b) for b in buckets]))).drop(BUCKET)

    def merge(self, batch: DataFrame) -> list[int]:
        """Upsert a batch, one row per key; returns the buckets that were replaced.

        The batch may lack columns of the table, whose values then stay on matched rows, and may not have others.
        """
        spark = batch.sparkSession
        kinds = {f.name: f.dataType for f in self.schema(spark).fields}
        require_columns(batch, self.keys)
        # keys of the table's types, so that equal keys fall into equal buckets
        batch = batch.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in batch.columns]).persist()
        try:
            touched = self.buckets_of(batch)
            if touched:
                current = self.read(spark, touched)
                self._write(self.with_bucket(upsert(current, batch, self.keys)), "overwrite")
        finally:
            batch.unpersist()
        return touched

    def buckets_of(self, batch: DataFrame) -> list[int]:
        """The buckets of a batch's keys, at most as many as there are buckets."""
        return sorted(r[0] for r in batch.select(bucket_of(self.keys, self.buckets)).distinct().collect())

    def changed(self, source_keys: DataFrame) -> list[int]:
        """The buckets whose active keys differ from the source's, by digests."""
        active = _active(self.read(source_keys.sparkSession)).where(ACTIVE)
        return sorted(r[0] for r in changed_buckets(active, source_keys, self.keys, self.buckets).collect())

    def soft_delete(self, source_keys: DataFrame, deleted_at: Column, stamp: str = "_ingested_at",
                    allow_empty_source: bool = False) -> list[int]:
        """Mark the active rows whose key left the source, in the buckets that differ only; returns these."""
        spark = source_keys.sparkSession
        if not allow_empty_source and source_keys.where(all_set(self.keys)).isEmpty():
            raise ValueError("the source key set is empty; pass allow_empty_source=True to delete every row")
        differ = self.changed(source_keys)
        if differ:
            some = source_keys.where(bucket_of(self.keys, self.buckets).isin(differ))
            current = _active(self.read(spark, differ))
            gone = current.where(F.col(ACTIVE) & all_set(self.keys)).select(*self.keys).join(
                some.where(all_set(self.keys)).select(*self.keys), list(self.keys), "left_anti")
            self._write(self.with_bucket(deleted_marks(current, gone, as_keys(self.keys), deleted_at, stamp)), "overwrite")
        return differ


def _active(df: DataFrame) -> DataFrame:
    return df if ACTIVE in df.columns else df.withColumn(ACTIVE, F.lit(True))
