"""Equi-join that stays balanced when a few keys hold most of the rows.

AQE splits skewed partitions of a join whose two inputs come straight from a
shuffle.  It cannot do so when one input is itself a join on the same key, or
when the result feeds an aggregate on that key.  For those places the rows are
counted per hash bucket of the key, and buckets above a task's fair share are salted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .keys import as_keys, others

_SALT = "__salt"
#: Hash buckets for each shuffle partition, and parts that a task's fair share of rows is cut into; salts fall
#: on tasks by hash, so several small parts even out where one large part could meet another.
BUCKETS_PER_TASK, PARTS_PER_TASK = 64, 8


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _bucket(keys: Sequence[str], tasks: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in keys]), F.lit(tasks * BUCKETS_PER_TASK)).cast("int")


def bucket_ways(df: DataFrame, keys: Sequence[str]) -> Column:
    """Scalar subquery: a map from hash bucket of ``keys`` to the number of salts its rows should get.

    With t shuffle partitions, a bucket with a share s of the rows is cut into s * t * PARTS_PER_TASK parts; buckets
    of one part or less are left out, so the map has at most t * PARTS_PER_TASK entries.  Rows are counted per bucket, with partial
    counts in the map tasks: the pass reads the key columns only.
    """
    tasks = _tasks(df)
    counts = df.groupBy(_bucket(keys, tasks).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    every = counts.agg(F.sum("n").alias("total"), F.collect_list(F.struct("b", "n")).alias("l"))
    ways = F.transform("l", lambda e: F.struct(e["b"], F.ceil(e["n"] * (tasks * PARTS_PER_TASK) / F.col("total")).alias("ways")))
    return every.select(F.map_from_entries(F.filter(ways, lambda e: e["ways"] > 1)).alias("hot")).scalar()


def _hashable(df: DataFrame, cols: Sequence[str]) -> list[str]:
    def has_map(kind: T.DataType) -> bool:
        return "map<" in kind.simpleString() or "variant" in kind.simpleString()
    return [c for c in cols if not has_map(df.schema[c].dataType)]


def skew_join(
    big: DataFrame,
    small: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    *,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join ``big`` to ``small`` on equal keys, spreading hot buckets of ``big`` over as many tasks as they fill.

    Rows of ``small`` are repeated per salt for hot buckets only.  The salt is a hash of the row,
    not a random number, so a task that is run again sends every row to the same place.
    The plan is the same at every size.  ``counted`` is where the keys are counted, by default ``big``; give the
    table that ``big`` is derived from where that saves running its joins for the count.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"skew_join does not support how={how!r}")
    keys = as_keys(on)
    hot = bucket_ways(big if counted is None else counted, keys)
    ways = F.coalesce(hot[_bucket(keys, _tasks(big))], F.lit(1).cast("bigint"))
    spread = _hashable(big, others(big, keys)) or keys
    left = big.withColumn(_SALT, F.pmod(F.xxhash64(*[F.col(c) for c in spread]), ways))
    right = small.withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), ways - 1)))
    return left.join(right, [*keys, _SALT], how).drop(_SALT)
