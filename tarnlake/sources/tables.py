"""Catalog tables: create, append with schema merge, merge of touched buckets or by new snapshot."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import upsert
from .buckets import BUCKET, BucketedTable
from .files import read_parquet


@dataclass(frozen=True)
class TableTarget:
    """Where a table lives: catalog name, storage root, merge key, and buckets that its merges replace (0: none)."""

    name: str
    root: str
    keys: tuple[str, ...] = ()
    buckets: int = 0

    @property
    def kind(self) -> str:
        base = self.name.split(".")[-1]
        return "staging" if base.startswith("stg_") else "clean" if base.startswith("clean_") else "other"


def ensure_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def create_if_absent(df: DataFrame, name: str, path: str) -> bool:
    """Create the table from ``df`` unless it exists; true when it was created."""
    if df.sparkSession.catalog.tableExists(name):
        return False
    if "." in name:
        ensure_schema(df.sparkSession, name.rsplit(".", 1)[0])
    df.write.mode("overwrite").option("path", path).saveAsTable(name)
    return True


def append_merge_schema(df: DataFrame, path: str) -> None:
    """Append to a history whose columns may grow; read it with ``merge_schema=True``."""
    df.write.mode("append").parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, merge_schema=True)


def swap_snapshot(df: DataFrame, name: str, path: str) -> None:
    """Write ``df`` to a fresh path and point the table there.

    The old snapshot is what ``df`` is read from, so it is never overwritten; readers see the
    new one only once it is complete.
    """
    spark = df.sparkSession
    df.write.mode("errorifexists").parquet(path)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)


def replace_table(df: DataFrame, name: str, path: str) -> None:
    """The table's new state: created on the first call, a new snapshot afterwards."""
    if not create_if_absent(df, name, path):
        swap_snapshot(df, name, path)


def _register(spark: SparkSession, name: str, path: str) -> None:
    """A catalog table over a folder of buckets."""
    if "." in name:
        ensure_schema(spark, name.rsplit(".", 1)[0])
    spark.catalog.createTable(name, path=path, source="parquet")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def read_table(spark: SparkSession, target: TableTarget) -> DataFrame:
    """The table without the column of its layout."""
    return spark.table(target.name).drop(BUCKET)


def _write_buckets(df: DataFrame, target: TableTarget) -> str:
    """Create a table of buckets, or replace the buckets that ``df`` has keys in."""
    spark = df.sparkSession
    files = BucketedTable(f"{target.root}/{target.name}/buckets", target.keys, target.buckets)
    if not spark.catalog.tableExists(target.name):
        files.create(df)
        _register(spark, target.name, files.path)
        return "create"
    files.merge(df)
    spark.sql(f"ALTER TABLE {target.name} RECOVER PARTITIONS")  # buckets that had no rows before
    spark.catalog.refreshTable(target.name)
    return "merge"


def write_table(df: DataFrame, target: TableTarget, version: str) -> str:
    """Load by table kind: create when absent, staging appends, clean merges on the key.

    Any other existing table with a key is merged as well; without one the load is refused,
    so that no run ends without writing. A table with buckets is merged in place, the buckets of the batch only; one
    without gets a new snapshot. Returns the mode used.
    """
    spark = df.sparkSession
    if target.buckets and target.kind != "staging":
        if not target.keys:
            raise ValueError(f"{target.name} has buckets and no merge key")
        return _write_buckets(df, target)
    path = f"{target.root}/{target.name}/{version}"
    if create_if_absent(df, target.name, path):
        return "create"
    if target.kind == "staging":
        known = spark.table(target.name)
        added = [f for f in df.schema.fields if f.name not in known.columns]
        if added:
            cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in added)
            spark.sql(f"ALTER TABLE {target.name} ADD COLUMNS ({cols})")
        shaped = spark.table(target.name).limit(0).unionByName(df, allowMissingColumns=True)
        shaped.write.mode("append").insertInto(target.name)
        return "append"
    if not target.keys:
        raise ValueError(f"{target.name} exists and has no merge key")
    swap_snapshot(upsert(spark.table(target.name), df, list(target.keys)), target.name, path)
    return "merge"


def catalog_listing(spark: SparkSession, schemas: Sequence[str] | None = None, like: str = "*") -> DataFrame:
    """Schemas with their tables and views whose name fits the pattern. Reads the catalog only."""
    names = [d.name for d in spark.catalog.listDatabases()] if schemas is None else list(schemas)
    found = [(d, t.name, t.tableType) for d in names for t in spark.catalog.listTables(d, like) if not t.isTemporary]
    return spark.createDataFrame(found, "schema_name string, table_name string, table_type string")


def row_counts(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """Existing tables or views with their column and row counts."""
    parts = [spark.table(t).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(t).alias("table_name"), F.lit(len(spark.table(t).columns)).cast("long").alias("column_count"),
        "row_count") for t in tables if spark.catalog.tableExists(t)]
    if not parts:
        raise ValueError("none of the tables exists")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
