"""Model evaluation over a table of labels and predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    hit = (F.col(label) == F.col(prediction)).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("support"))


def confusion(df: DataFrame, label: str, prediction: str, classes: Sequence) -> DataFrame:
    """Counts with predicted classes as rows and actual classes as columns; zeros kept."""
    pairs = df.groupBy(prediction, label).agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy(F.col(prediction).alias("predicted")).agg(*[
        F.coalesce(F.sum(F.when(F.col(label) == c, F.col("n"))), F.lit(0)).alias(f"actual_{c}")
        for c in classes])


def _ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where nothing was counted."""
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""
    pairs = df.groupBy(F.col(label).cast("string").alias("a"), F.col(prediction).cast("string").alias("p")
                       ).agg(F.count(F.lit(1)).alias("n"))
    # Every pair counts once for its actual and once for its predicted class.
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("guessed"),
                 F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("guessed"),
                 F.lit(0).cast("long").alias("hit")))).alias("s")).select("s.*")
    per = sides.groupBy("class").agg(F.sum("support").alias("support"), F.sum("guessed").alias("guessed"),
                                     F.sum("hit").alias("hit"))
    precision = _ratio(F.col("hit"), F.col("guessed"))
    recall = _ratio(F.col("hit"), F.col("support"))
    f1 = _ratio(2 * F.col("hit"), F.col("guessed") + F.col("support"))
    scored = per.select("class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
                        "support", "hit")
    names = ("precision", "recall", "f1")
    all_rows = F.sum("support")
    hits = F.sum("hit") / all_rows
    summary = scored.agg(
        F.array(
            F.struct(F.lit("accuracy").alias("class"), *[hits.alias(m) for m in names], all_rows.alias("support")),
            F.struct(F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in names],
                     all_rows.alias("support")),
            F.struct(F.lit("weighted avg").alias("class"),
                     *[(F.sum(F.col(m) * F.col("support")) / all_rows).alias(m) for m in names],
                     all_rows.alias("support"))).alias("rows"))
    return scored.drop("hit").unionByName(summary.select(F.explode("rows").alias("r")).select("r.*"))


def mean_squared_error(df: DataFrame, label: str, prediction: str) -> DataFrame:
    d = F.col(label) - F.col(prediction)
    return df.agg(F.avg(d * d).alias("mse"), F.count(F.lit(1)).alias("support"))
