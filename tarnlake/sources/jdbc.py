"""Relational database source and sink over Spark's JDBC connector."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from .schemas import TableSpec

# Rows per fetch and per write batch.
FETCH_SIZE = 10_000
BATCH_SIZE = 1_000


def scan_options(url: str, table: str, *, column: str | None = None, lower: str | int | None = None,
                 upper: str | int | None = None, partitions: int | None = None,
                 connection: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of a table scan, split by ranges of ``column`` when its bounds are given."""
    opts = {**(connection or {}), "url": url, "dbtable": table, "fetchsize": str(FETCH_SIZE)}
    split = (column, lower, upper, partitions)
    if all(x is not None for x in split):
        opts |= {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
                 "numPartitions": str(partitions)}
    elif any(x is not None for x in split):
        raise ValueError("a split read needs column, lower, upper and partitions")
    return opts


def scan(spark: SparkSession, url: str, table: str, **kw) -> DataFrame:
    """Full-table extract. Filters and column selection made on the result run in the database."""
    return spark.read.format("jdbc").options(**scan_options(url, table, **kw)).load()


def extract(spark: SparkSession, url: str, spec: TableSpec, **kw) -> DataFrame:
    """Full extract of a registered source table."""
    return scan(spark, url, spec.source_table, **kw)


def keys_query(table: str, key_sql: str | Sequence[str], target: str | Sequence[str]) -> str:
    """Subquery that projects the key's columns, each possibly computed, under the target's names."""
    exprs, names = ([x] if isinstance(x, str) else list(x) for x in (key_sql, target))
    if len(exprs) != len(names):
        raise ValueError(f"{len(exprs)} key columns for {len(names)} names")
    return f"(SELECT {', '.join(f'{e} AS {n}' for e, n in zip(exprs, names))} FROM {table}) t"


def source_keys(spark: SparkSession, url: str, table: str, key_sql: str | Sequence[str],
                target: str | Sequence[str], **kw) -> DataFrame:
    """Key projection for delete sync; the key expression is evaluated in the database."""
    return scan(spark, url, keys_query(table, key_sql, target), **kw)


def merge_statement(table: str, staging: str, keys: Sequence[str], columns: Sequence[str],
                    dialect: str = "mysql") -> str:
    """One server-side statement that upserts the staging table into the table."""
    cols = ", ".join(columns)
    rest = [c for c in columns if c not in keys]
    if dialect == "mysql":
        if rest:
            sets = ", ".join(f"{c} = VALUES({c})" for c in rest)
        else:
            sets = f"{keys[0]} = VALUES({keys[0]})"
        return f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {staging} ON DUPLICATE KEY UPDATE {sets}"
    if dialect == "ansi":
        on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
        sets = ", ".join(f"{c} = s.{c}" for c in rest)
        matched = f" WHEN MATCHED THEN UPDATE SET {sets}" if rest else ""
        values = ", ".join(f"s.{c}" for c in columns)
        return (f"MERGE INTO {table} t USING {staging} s ON {on}{matched}"
                f" WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({values})")
    raise ValueError(f"unknown dialect {dialect!r}")


def upsert(df: DataFrame, url: str, table: str, keys: Sequence[str], *, staging: str | None = None,
           dialect: str = "mysql", connection: Mapping[str, str] | None = None) -> None:
    """Write ``df`` to a staging table from the executors, then merge it with one statement."""
    staging = staging or f"{table}_staging"
    props = {**(connection or {}), "url": url, "batchsize": str(BATCH_SIZE)}
    df.write.format("jdbc").mode("overwrite").options(**props, dbtable=staging).save()
    jvm = df.sparkSession._jvm
    login = jvm.java.util.Properties()
    for k, v in (connection or {}).items():
        login.setProperty(k, v)
    con = jvm.java.sql.DriverManager.getConnection(url, login)
    try:
        con.createStatement().executeUpdate(merge_statement(table, staging, keys, df.columns, dialect))
    finally:
        con.close()
