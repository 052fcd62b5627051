"""Keyed merge and delete sync as DataFrame algebra.

Every function returns the new state of the table; the caller writes it as a new
snapshot.  Keys that contain a null never match, as with ``ON t.k = s.k``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .digests import BUCKETS, keys_only_in
from .keys import all_set, as_keys, others, require_columns

ACTIVE = "is_active"


def _left_join(target: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on the keys. Rows with a null in the key match nothing and go round the join, unshuffled."""
    met = target.where(all_set(keys)).join(right, keys, "left")
    return met.unionByName(target.where(~all_set(keys)), allowMissingColumns=True)


def _source_key_counts(source: DataFrame, keys: list[str]) -> DataFrame:
    return source.where(all_set(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))


def upsert(target: DataFrame, source: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Update all on match, insert all otherwise.

    Columns only the target has keep the target's value on matched rows and are null on
    inserted ones.  A target row matched by more than one source row raises.
    """
    keys = as_keys(keys)
    require_columns(target, keys)
    require_columns(source, keys)
    extra = [c for c in source.columns if c not in target.columns]
    if extra:
        raise ValueError(f"source columns {extra} are not in the target; add them first")
    clash = F.raise_error(F.concat_ws(" ", F.lit("several source rows match one target row, key:"),
                                      *[F.col(c).cast("string") for c in keys]))

    if all(c in source.columns for c in target.columns):
        # Only keys of the source meet the target: a small batch is broadcast, and the
        # target's wide rows then pass through without a shuffle.
        hits = _source_key_counts(source, keys)
        untouched = _left_join(target, hits, keys).where(
            F.when(F.col("__n").isNull(), F.lit(True))
            .when(F.col("__n") == 1, F.lit(False))
            .otherwise(clash.cast("boolean")))
        return untouched.select(target.columns).unionByName(source.select(target.columns))

    payload = [c for c in source.columns if c not in keys]
    batch = source.where(all_set(keys)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), F.first(F.struct(*payload, F.lit(1).alias("__one"))).alias("__s"))
    matched = F.col("__n").isNotNull()
    current = _left_join(target, batch, keys).where(
        F.when(~matched | (F.col("__n") == 1), F.lit(True)).otherwise(clash.cast("boolean")))
    current = current.withColumns(
        {c: F.when(matched, F.col(f"__s.{c}")).otherwise(F.col(c)) for c in payload})
    added = source.where(all_set(keys)).join(target.where(all_set(keys)).select(*keys), keys, "left_anti").unionByName(
        source.where(~all_set(keys)))
    return current.select(target.columns).unionByName(added, allowMissingColumns=True)


def merge_report(target: DataFrame, source: DataFrame, keys: str | Sequence[str],
                 deleted: DataFrame | None = None) -> DataFrame:
    """One row: rows inserted, updated and (soft-)deleted by a merge, plus rows left alone."""
    keys = as_keys(keys)
    t = target.groupBy(*keys).agg(F.count(F.lit(1)).alias("__t"))
    s = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("__s"))
    both = t.join(s, keys, "full_outer")
    n_deleted = F.lit(0).cast("bigint") if deleted is None else deleted.agg(F.count(F.lit(1))).scalar()
    total = lambda cond, col: F.coalesce(F.sum(F.when(cond, F.col(col))), F.lit(0))
    has_t, has_s = F.col("__t").isNotNull(), F.col("__s").isNotNull()
    return both.agg(
        total(~has_t, "__s").alias("rows_inserted"),
        total(has_t & has_s, "__t").alias("rows_updated"),
        total(~has_s, "__t").alias("rows_unchanged"),
    ).withColumn("rows_deleted", n_deleted)


def with_active_flag(df: DataFrame) -> DataFrame:
    """Add ``is_active`` = true when the table does not have it yet."""
    return df if ACTIVE in df.columns else df.withColumn(ACTIVE, F.lit(True))


def _same_types(target: DataFrame, source_keys: DataFrame, keys: list[str]) -> DataFrame:
    """The source's keys in the target's types, so that equal keys hash alike."""
    return source_keys.select(*[F.col(k).cast(target.schema[k].dataType).alias(k) for k in keys])


def deleted_keys(target: DataFrame, source_keys: DataFrame, keys: str | Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Keys that are active in the target but gone from the source. A key with a null is not a key.

    Digests of key buckets tell where the two differ; only there keys are compared one by one.
    """
    keys = as_keys(keys)
    active = with_active_flag(target).where(F.col(ACTIVE)).select(*keys)
    return keys_only_in(active, _same_types(target, source_keys, keys), keys, buckets)


def deleted_marks(target: DataFrame, gone: DataFrame, keys: list[str], deleted_at: Column, stamp: str) -> DataFrame:
    """``target`` with the active rows of the keys ``gone`` marked as inactive and stamped."""
    marks = gone.select(*keys).distinct().withColumn("__gone", F.lit(True))
    hit = F.col(ACTIVE) & F.col("__gone").isNotNull()
    changed = {ACTIVE: F.when(hit, F.lit(False)).otherwise(F.col(ACTIVE))}
    if stamp in target.columns:
        changed[stamp] = F.when(hit, deleted_at.cast(target.schema[stamp].dataType)).otherwise(F.col(stamp))
    return _left_join(target, marks, keys).withColumns(changed).select(target.columns)


def soft_delete(target: DataFrame, source_keys: DataFrame, keys: str | Sequence[str],
                deleted_at: Column | datetime | None = None, stamp: str = "_ingested_at",
                allow_empty_source: bool = False, buckets: int = BUCKETS) -> DataFrame:
    """Mark active rows whose key left the source as inactive and stamp the time.

    The keys that left are found by bucket digests; the table then meets these alone, so a sync that deletes little
    moves little. A source without one complete key would mark every row; unless that is allowed, the plan raises.
    """
    keys = as_keys(keys)
    target = with_active_flag(target)
    gone = deleted_keys(target, source_keys, keys, buckets)
    if not allow_empty_source:
        n_keys = source_keys.where(all_set(keys)).limit(1).agg(F.count(F.lit(1))).scalar()
        refused = F.raise_error("the source key set is empty; pass allow_empty_source=True to delete every row")
        target = target.where(F.when(n_keys == 0, refused.cast("boolean")).otherwise(F.lit(True)))
    if deleted_at is None:
        deleted_at = F.current_timestamp()
    elif not isinstance(deleted_at, Column):
        deleted_at = F.lit(deleted_at)
    return deleted_marks(target, gone, keys, deleted_at, stamp)


def register_jobs(registry: DataFrame, jobs: DataFrame, at: Column) -> DataFrame:
    """Upsert job definitions on (job_name, layer).

    A known job keeps ``job_id`` and ``created_at``; a new one gets the next id, in
    (job_name, layer) order.  The registry is a control table with one row per job definition
    and has one writer at a time, so numbering its new rows in one task is bounded.
    """
    keys = ["job_name", "layer"]
    described = [c for c in others(registry, keys) if c not in ("job_id", "created_at", "updated_at")]
    s = jobs.select(*keys, F.struct(*described).alias("__s"))
    t = registry.select(*keys, F.struct(*described).alias("__t"), "job_id", "created_at", "updated_at")
    top = registry.agg(F.coalesce(F.max("job_id"), F.lit(0)).alias("m")).scalar()
    is_new = F.col("job_id").isNull()
    number = F.row_number().over(Window.partitionBy(is_new).orderBy(*keys))
    known = F.col("__s").isNotNull()
    both = t.join(s, keys, "full_outer").withColumn("__num", number)
    cols = {c: F.col(c) for c in keys}
    cols |= {c: F.when(known, F.col(f"__s.{c}")).otherwise(F.col(f"__t.{c}")) for c in described}
    cols["job_id"] = F.when(is_new, top + F.col("__num")).otherwise(F.col("job_id"))
    cols["created_at"] = F.when(is_new, at).otherwise(F.col("created_at"))
    cols["updated_at"] = F.when(known, at).otherwise(F.col("updated_at"))
    return both.select(*[cols[c].alias(c) for c in registry.columns])
