"""Table profiles: summary, histogram, frequencies, contingency tables, box statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .quantiles import exact_quantiles
from .skew import skew_join

QUARTILES = [0.25, 0.5, 0.75]


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with a row count that is collected while another action runs over it."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("row_count")), seen


def output_profile(df: DataFrame) -> DataFrame:
    """One row: row count, column count and column names of an output."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(len(df.columns)).cast("long").alias("column_count"),
        F.lit(",".join(df.columns)).alias("columns"))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, quartiles and max; one row per numeric column.

    One pass over the wide rows gives all but the quartiles, which are selected for all columns at once.
    """
    cols = list(cols)
    v = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols}
    stats = {"count": F.count, "mean": F.avg, "std": F.stddev, "min": F.min, "max": F.max}
    wide = df.select(*[v[c].alias(c) for c in cols]).agg(*[f(F.col(c)).alias(f"{c}.{k}") for c in cols for k, f in stats.items()])
    basic = wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{c}.{k}`").alias(k) for k in stats])
                                            for c in cols])).alias("s")).select("s.*").where(F.col("count") > 0)
    long = df.select(*[v[c].alias(c) for c in cols]).unpivot([], cols, "column_name", "value")
    quart = exact_quantiles(long, "value", QUARTILES, ["column_name"], few_groups=True)
    return F.broadcast(basic).join(quart, "column_name").select(
        "column_name", "count", "mean", "std", "min",
        F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"), "max")


def histogram(df: DataFrame, col: str, bins: int = 36) -> DataFrame:
    """Equal-width density histogram; the last bin holds its right edge, empty bins stay."""
    v = F.col(col).cast("double")
    values = df.select(v.alias("__v")).where(v.isNotNull() & ~F.isnan(v))
    span = values.agg(F.struct(F.min("__v").alias("lo"), F.max("__v").alias("hi"),
                               F.count(F.lit(1)).alias("n")).alias("s")).scalar()
    flat = span["lo"] == span["hi"]
    lo = F.when(flat, span["lo"] - 0.5).otherwise(span["lo"])
    hi = F.when(flat, span["hi"] + 0.5).otherwise(span["hi"])
    slot = F.least(F.floor((F.col("__v") - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
    counts = values.groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (hi - lo) / bins
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    n = F.coalesce(F.col("n"), F.lit(0))
    return every.join(counts, "bin", "left").select(
        "bin", (lo + F.col("bin") * width).alias("left_edge"),
        n.alias("n"), (n / (span["n"] * width)).alias("density"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, col: str, k: int = 40) -> DataFrame:
    """The k most frequent values, ties in value order."""
    return value_counts(df, col).orderBy(F.desc("n"), F.asc(col)).limit(k)


def relative_frequency(df: DataFrame, col: str) -> DataFrame:
    """Share of every value in all rows."""
    counts = value_counts(df, col)
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def crosstab(df: DataFrame, rows: str, cols: str, values: Sequence) -> DataFrame:
    """Contingency table with a column for each of ``values``. Counts per pair are made first, so the pivot sees one row
    per pair; for columns of unknown values count the pairs instead, as rows."""
    pairs = df.groupBy(rows, cols).agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy(rows).pivot(cols, list(values)).agg(F.sum("n")).na.fill(0)


def stack(table: DataFrame, rows: str, name: str, value: str = "value") -> DataFrame:
    """Contingency table to one row per cell, zero cells kept."""
    cells = [c for c in table.columns if c != rows]
    return table.unpivot([rows], cells, name, value)


def box_stats(df: DataFrame, value: str, by: str) -> DataFrame:
    """Quartiles, 1.5 IQR whisker ends and outlier count per group; a null group is one."""
    v = F.col(value).cast("double")
    quart = exact_quantiles(df, value, QUARTILES, [by]).select(
        F.struct(by).alias("__g"), "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    rows = df.where(v.isNotNull() & ~F.isnan(v)).select(F.struct(by).alias("__g"), v.alias("__v"))
    x, reach = F.col("__v"), 1.5 * (F.col("q3") - F.col("q1"))
    within = x.between(F.col("q1") - reach, F.col("q3") + reach)
    # a group is joined in as many parts as its share of the rows fills
    return skew_join(rows, quart, "__g").groupBy("__g").agg(
        F.max("n").alias("n"), F.max("q1").alias("q1"), F.max("median").alias("median"),
        F.max("q3").alias("q3"),
        F.min(F.when(within, x)).alias("whisker_low"), F.max(F.when(within, x)).alias("whisker_high"),
        F.count_if(~within).alias("outliers")).select(F.col("__g")[by].alias(by), "n", "q1", "median", "q3", "whisker_low", "whisker_high", "outliers")
