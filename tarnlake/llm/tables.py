"""Input columns, written intermediate tables, size-checked broadcasts and connected components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake.sources.scratch import new_path

#: Bytes of a side that may be broadcast.
BROADCAST_BYTES = 32 << 20


#: Rows of a batch between Spark and Python; whole texts are long, and the default of 10,000 is meant for short rows.
TEXT_ROWS = 500


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table, in a session whose Arrow batches suit whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXT_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends there and lost executors lose nothing."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_bytes(df: DataFrame) -> Column:
    """About the bytes that a row takes in memory: 8 for each number, the length of each string or binary, all of an array."""
    def of(value: Column, kind: T.DataType) -> Column:
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(value), F.lit(0)) + 8
        if isinstance(kind, T.StructType):
            return sum((of(value[f.name], f.dataType) for f in kind.fields), F.lit(8))
        if isinstance(kind, T.ArrayType):
            if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.StructType, T.ArrayType)):
                return F.coalesce(F.aggregate(value, F.lit(16).cast("long"), lambda n, x: n + of(x, kind.elementType)), F.lit(0))
            return F.coalesce(F.size(value), F.lit(0)) * 8 + 16
        return F.lit(8)

    return sum((of(df[f"`{f.name}`"], f.dataType) for f in df.schema.fields), F.lit(16)).cast("long")


def checked_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if the sum of its rows' bytes proves it small; otherwise Spark shuffles both sides.

    The result of the join is the same; give a written or cheap ``df``, for it is measured first.
    """
    size = df.agg(F.sum(row_bytes(df))).first()[0] or 0
    return F.broadcast(df) if size <= limit else df


def with_flag(df: DataFrame, ids: DataFrame, key: str, flag: str) -> DataFrame:
    """``df`` plus a boolean: its ``key`` is among ``ids`` (null keys are not). Rows keep their number."""
    mark = checked_broadcast(ids.select(F.col(key)).where(F.col(key).isNotNull()).distinct()
                             .withColumn("__is", F.lit(True)))
    joined = df.join(mark, key, "left")
    return joined.select(*[joined[c] for c in df.columns], F.coalesce("__is", F.lit(False)).alias(flag))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node id reachable, of every node on an edge (long ids).

    Alternates large-star and small-star passes until the edge set stays the same: each pass is a
    grouped minimum, combined in the map tasks, and one join, so no component is gathered in one place.
    """
    now = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                  .where("u <> v").distinct(), "edges")
    state = _state(now)
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("x"), "m", "u")
        small = small.select(F.explode(F.array(F.struct(F.col("x").alias("u"), F.col("m").alias("v")),
                                               F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        now = written(small.where("u <> v").distinct(), "small-star")
        state, before = _state(now), state
        if state == before:
            break
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(edges: DataFrame) -> Sequence:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v"))).first())
