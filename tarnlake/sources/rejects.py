"""Lenient loading: good rows and rejects are written in one pass, and counted in that pass.

A row is rejected with a reason; the rest is loaded. Both go to one folder, parted by whether the row was rejected, so
the input is read and parsed once, and an observation counts both kinds while they are written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import to_ts
from .files import read_parquet

CORRUPT, REASON, REJECTED = "_corrupt_record", "_reason", "_rejected"


@dataclass(frozen=True)
class Loaded:
    """Good rows, rejects with their reason, and how many there are of each."""

    good: DataFrame
    rejects: DataFrame
    n_good: int
    n_rejects: int


def load(df: DataFrame, reason: Column, path: str, good: list[str] | None = None) -> Loaded:
    """Write ``df`` to ``path``, rows with a ``reason`` apart. ``good`` are the columns that good rows keep."""
    spark, seen = df.sparkSession, Observation()
    bad = F.col(REASON).isNotNull()
    marked = df.withColumn(REASON, reason).withColumn(REJECTED, bad).observe(
        seen, F.count_if(~bad).alias("n_good"), F.count_if(bad).alias("n_rejects"))
    marked.write.partitionBy(REJECTED).parquet(path)
    counts = seen.get
    written = read_parquet(spark, path, T.StructType([*df.schema.fields, T.StructField(REASON, T.StringType()),
                                                      T.StructField(REJECTED, T.BooleanType())]))
    return Loaded(written.where(~F.col(REJECTED)).select(*(good or df.columns)), written.where(REJECTED).drop(REJECTED),
                  counts["n_good"], counts["n_rejects"])


def read_csv_leniently(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """A CSV file as ``read_csv`` takes it, but a line that does not fit the schema keeps its text in ``_corrupt_record``."""
    with_text = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(with_text).options(
        header=True, sep=",", quote='"', escape='"', multiLine=multi_line, mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT).csv(path)


def load_csv(spark: SparkSession, source: str, schema: T.StructType, path: str, multi_line: bool = False) -> Loaded:
    """Load a CSV file; lines that do not fit the schema become rejects that hold their text."""
    df = read_csv_leniently(spark, source, schema, multi_line)
    reason = F.when(F.col(CORRUPT).isNotNull(), "line does not fit the schema")
    return load(df, reason, path, [f.name for f in schema.fields])


def load_marks(df: DataFrame, col: str, path: str) -> Loaded:
    """Load rows whose mark is text: good rows have it as a timestamp (null stays null), unparsable ones are rejects."""
    parsed = f"__{col}"
    both = df.withColumn(parsed, to_ts(F.col(col)))
    reason = F.when(F.col(col).isNotNull() & F.col(parsed).isNull(), f"{col} is no timestamp")
    found = load(both, reason, path)
    good = found.good.select(*[F.col(parsed).alias(col) if c == col else F.col(c) for c in df.columns])
    return Loaded(good, found.rejects.drop(parsed), found.n_good, found.n_rejects)
