"""Bucket digests: which parts of two key sets differ, without a shuffle of the keys.

Keys are hashed into buckets, and each side makes a digest of each bucket: the number of keys, the exclusive or and
the sum of their hashes. Partial digests are made in the map tasks, so a row per bucket and task is shuffled, however
many keys there are. Buckets of equal digests hold equal keys but for a chance of 2^-64; a side that repeats keys has
other digests, and its buckets are then compared key by key like any that differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import all_set, as_keys

BUCKETS = 4096


def bucket_of(keys: str | Sequence[str], buckets: int) -> Column:
    """The bucket of a key. It depends on the keys' types: give both sides the same."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in as_keys(keys)]), F.lit(buckets)).cast("int")


def bucket_digests(df: DataFrame, keys: str | Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """bucket, n, xored, summed of the complete keys; at most ``buckets`` rows."""
    keys = as_keys(keys)
    # another hash than the bucket's
    h = F.xxhash64(F.lit(0x5851F42D), *[F.col(k) for k in keys])
    rows = df.where(all_set(keys)).select(bucket_of(keys, buckets).alias("bucket"), h.alias("h"))
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("xored"),
                                      F.sum(F.shiftright("h", 24)).alias("summed"))


def changed_buckets(left: DataFrame, right: DataFrame, keys: str | Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """The buckets whose keys differ between the two sides; at most ``buckets`` rows."""
    keys = as_keys(keys)
    marks = ["n", "xored", "summed"]
    a = bucket_digests(left, keys, buckets).select("bucket", F.struct(*marks).alias("a"))
    b = bucket_digests(right, keys, buckets).select("bucket", F.struct(*marks).alias("b"))
    return a.join(b, "bucket", "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select("bucket")


def keys_only_in(left: DataFrame, right: DataFrame, keys: str | Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Complete keys of ``left`` that ``right`` lacks. Only keys of buckets that differ meet in a join."""
    keys = as_keys(keys)
    # at most ``buckets`` numbers: broadcast whatever the size of the sides
    differ = F.broadcast(changed_buckets(left, right, keys, buckets))

    def open_(df: DataFrame) -> DataFrame:
        rows = df.where(all_set(keys)).select(*keys).withColumn("bucket", bucket_of(keys, buckets))
        return rows.join(differ, "bucket", "left_semi").drop("bucket")

    return open_(left).join(open_(right), keys, "left_anti")
