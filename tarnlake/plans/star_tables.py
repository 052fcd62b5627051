"""The star on written tables: order-level tables bucketed by order, and the fact partitioned by month.

Tables bucketed and sorted by the order id are joined on it without an exchange. They are written once, and every
fact that is built from them saves the shuffles of the largest tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import write_parquet
from ..sources.tables import ensure_schema
from .star import FACT_COLUMNS

ORDER, MONTH = "order_id", "month_key"
#: Rows of a bucket: a task joins and sorts one bucket of each table.
BUCKET_ROWS, LEAST_BUCKETS = 1 << 19, 8


def bucket_number(*tables: DataFrame) -> int:
    """Buckets for tables that are joined by bucket: a power of two that follows the rows of the largest, so a task's share does
    not grow with them."""
    most = max(df.count() for df in tables)
    return max(LEAST_BUCKETS, 1 << (max(1, -(-most // BUCKET_ROWS)) - 1).bit_length())


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, key: str = ORDER) -> DataFrame:
    """``df`` as a catalog table of ``buckets`` buckets of the key, one sorted file each."""
    spark = df.sparkSession
    if "." in name:
        ensure_schema(spark, name.rsplit(".", 1)[0])
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return spark.table(name)


@dataclass(frozen=True)
class OrderTables:
    """Items, orders, payments, reviews and the order dimension, all bucketed by order."""

    item: DataFrame
    order: DataFrame
    payment: DataFrame
    review: DataFrame
    order_dim: DataFrame

    @staticmethod
    def write(schema: str, root: str, buckets: int, **tables: DataFrame) -> OrderTables:
        return OrderTables(**{k: write_bucketed(df, f"{schema}.{k}", f"{root}/{k}", buckets) for k, df in tables.items()})


def bucketed_fact(t: OrderTables, product: DataFrame, customer: DataFrame, seller: DataFrame, date: DataFrame,
                  fan_out: bool = True) -> DataFrame:
    """The fact of ``star.fact_table``, or of ``fact_table_clean`` without ``fan_out``, from bucketed tables.

    Everything of an order meets in its bucket first; the dimensions, of which only keys are read, come after. Join
    strategies for these are Spark's own, by size.
    """
    orders = t.order.select(ORDER, "customer_id", F.col("order_purchase_timestamp").alias("full_date"))
    if fan_out:
        # one row per payment of the order dimension and one per payment again; counted within the bucket
        times = t.order_dim.groupBy(ORDER).agg(F.count(F.lit(1)).alias("__n"))
        orders = orders.join(times, ORDER)
    else:
        orders = orders.join(t.order_dim.select(ORDER), ORDER, "left_semi")
    rows = orders.join(t.item.select(ORDER, "order_item_id", "product_id", "seller_id", "price", "freight_value"), ORDER) \
        .join(t.payment.select(ORDER, "payment_value", "payment_installments", "payment_sequential"), ORDER) \
        .join(t.review.select(ORDER, "review_id"), ORDER)
    rows = rows.join(date.select("full_date", "dateKey"), "full_date").join(product.select("product_id"), "product_id") \
        .join(seller.select("seller_id"), "seller_id").join(customer.select("customer_id"), "customer_id")
    if fan_out:  # rows are repeated last, so no join carries the repeats
        rows = rows.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n"))))
    return rows.select(*FACT_COLUMNS)


def write_by_month(fact: DataFrame, path: str) -> None:
    """The fact in a folder per month. Rows of a month are dealt to tasks by order too, so a large month is not one task's."""
    months = fact.withColumn(MONTH, F.expr("CAST(dateKey DIV 100 AS INT)"))
    write_parquet(months.repartition(MONTH, F.pmod(F.xxhash64(ORDER), F.lit(8))), path, partition_by=[MONTH])


def read_by_month(spark: SparkSession, path: str, dates: DataFrame | None = None, cols: Sequence[str] | None = None) -> DataFrame:
    """The fact, or what falls on the given days: folders of other months are pruned when the days are known, at run time."""
    fact = spark.read.parquet(path)
    if dates is not None:
        days = dates.select("dateKey", F.expr("CAST(dateKey DIV 100 AS INT)").alias(MONTH))
        fact = fact.join(days, [MONTH, "dateKey"], "left_semi")
    return fact.select(*(cols or FACT_COLUMNS))
