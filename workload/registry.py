"""Query registry and the common output form."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Widen numbers and print dates, so that two engines' results compare by value."""
    def as_text(f: T.StructField):
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.FloatType, T.DecimalType)):
            c = c.cast("double")
        return c.alias(f.name)
    return df.select([as_text(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    """Register a query and, where there is one, its SQL counterpart."""
    def add(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(spark, sf_dir))
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return add


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table. Its schema is read from the file once, not with every query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def day(expr: str) -> str:
    """SQL text of a date column in the common output form."""
    return f"strftime({expr}, '%Y-%m-%d')"


def stamp(expr: str) -> str:
    """SQL text of a timestamp column in the common output form."""
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def cents(expr: str) -> str:
    """SQL text of two-digit rounding, half up on the printed decimal value, as Spark rounds doubles."""
    return f"round(cast(cast({expr} as varchar) as decimal(38, 20)), 2)::double"
