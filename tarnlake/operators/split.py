"""Exact stratified train/test split, repeatable and free of per-label sorting."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def train_quota(labels: DataFrame, label: str, train_size: float) -> DataFrame:
    """Training rows per label: proportional, the rest to the largest remainders.

    ``labels`` has one row per label with its count ``n``.
    """
    total = labels.agg(F.sum("n").alias("t")).scalar()
    wanted = F.floor(total * F.lit(train_size))
    exact = F.col("n") * wanted / total
    # One row per class label, so one task ranks the remainders.
    parts = labels.withColumns({"base": F.floor(exact), "rest": exact - F.floor(exact), "wanted": wanted})
    order = Window.orderBy(F.desc("rest"), F.asc(label))
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.col("wanted") - F.sum("base").over(every)
    return parts.withColumn("quota", F.col("base") + (F.row_number().over(order) <= left).cast("long")).select(
        label, "n", "quota")


#: Hex digits of the MD5 by which the border is narrowed: after three rounds of 4096 cells each, the rows left
#: to be ranked are a label's number divided by 6.9e10.
ROUNDS, DIGITS = 3, 3


def stratified_split(df: DataFrame, label: str, row_id: str, train_size: float = 0.8, digits: int = DIGITS
                     ) -> DataFrame:
    """``df`` with a column ``split`` ('train' or 'test'), the rows of each label in MD5 order of the id.

    Rows are counted per label and MD5 prefix, which finds the prefix that holds the border of
    each label; the rows of that prefix are counted by a longer one, and so on.  Only the last
    prefix is ranked, to find the last training row.  MD5 is uniform, so a label that holds most of
    the table is still spread over the prefixes.  The rows themselves meet one border row per label.
    """
    if not 0 < train_size < 1 or not math.isfinite(train_size):
        raise ValueError("train_size must be between 0 and 1")
    h = F.md5(F.col(row_id).cast("string"))
    keyed = df.select(label, F.col(row_id).alias("__id"), h.alias("__h"))
    border = None
    for k in range(1, ROUNDS + 1):
        rows = keyed.withColumn("__q", F.substring("__h", 1, digits * k))
        if border is not None:
            rows = rows.withColumn("__p", F.substring("__h", 1, digits * (k - 1))).join(border, [label, "__p"])
            wanted = F.max("__take").alias("__wanted")
        else:
            wanted = F.lit(0).alias("__wanted")
        bins = rows.groupBy(label, "__q").agg(F.count(F.lit(1)).alias("__n"), wanted)
        if border is None:
            quota = train_quota(bins.groupBy(label).agg(F.sum("__n").alias("n")), label, train_size)
            bins = bins.drop("__wanted").join(quota.select(label, F.col("quota").alias("__wanted")), label)
        # at most 4096 cells for each label
        so_far = Window.partitionBy(label).orderBy("__q").rowsBetween(Window.unboundedPreceding, 0)
        before = F.col("__cum") - F.col("__n")
        border = bins.withColumn("__cum", F.sum("__n").over(so_far)).where(
            (before < F.col("__wanted")) & (F.col("__wanted") <= F.col("__cum"))).select(
            label, F.col("__q").alias("__p"), (F.col("__wanted") - before).alias("__take"))
    rank = F.row_number().over(Window.partitionBy(label, "__p").orderBy("__h", "__id"))
    last = keyed.withColumn("__p", F.substring("__h", 1, digits * ROUNDS)).join(border, [label, "__p"])
    cut = last.withColumn("__rn", rank).where(F.col("__rn") == F.col("__take")).select(label, F.struct("__h", "__id").alias("__cut"))
    here = F.struct(h.alias("__h"), F.col(row_id).alias("__id"))
    train = F.col("__cut").isNotNull() & (here <= F.col("__cut"))
    return df.join(cut, label, "left").select(
        *[F.col(c) for c in df.columns], F.when(train, "train").otherwise("test").alias("split"))
