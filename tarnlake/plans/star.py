"""Star schema over the cleaned tables, and the wide sales mart.

Dimension joins carry no broadcast hints: Spark broadcasts a side only when its size,
estimated or measured at run time, is below the session's threshold, and otherwise splits
skewed shuffle partitions.  Spark cannot split a join with a side that is itself an aggregate,
a window or a join on the same key; those joins go through ``skew_join``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key, date_names, date_parts
from ..operators.incremental import one_per_key
from ..operators.merge import ACTIVE
from ..operators.skew import skew_join

# Output columns of the dimensions and the fact table.
GEO = ["geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state"]
PRODUCT_COLUMNS = [
    "product_id", "product_category_name", "product_category_name_english", "product_name_length",
    "product_description_length", "product_photos_qty", "product_weight_g", "product_length_cm",
    "product_height_cm", "product_width_cm"]
FACT_COLUMNS = [
    "order_id", "order_item_id", "customer_id", "product_id", "review_id", "seller_id", "dateKey", "price",
    "freight_value", "payment_value", "payment_installments", "payment_sequential"]
DATE_COLUMNS = [
    "dateKey", "full_date", "year", "quarter", "month", "week", "day", "day_of_year", "day_name_of_week",
    "month_name_of_week"]


def active_rows(df: DataFrame, active_only: bool) -> DataFrame:
    """Leave out soft-deleted rows on request; the star keeps them by default."""
    return df.where(F.col(ACTIVE)) if active_only and ACTIVE in df.columns else df


def dim_customer(customer: DataFrame, geolocation: DataFrame, active_only: bool = False) -> DataFrame:
    """Customers with the place of their zip code, null where the zip is unknown.

    A zip has many places and a customer keeps one of them, so the place is chosen per zip
    before the join: the smallest by latitude, longitude, city and state.
    """
    zip_code = "customer_zip_code_prefix"
    place = active_rows(geolocation, active_only).groupBy(
        F.col("geolocation_zip_code_prefix").alias(zip_code)).agg(F.min(F.struct(*GEO)).alias("p"))
    one = one_per_key(active_rows(customer, active_only).select("customer_id", "customer_unique_id", zip_code),
                      "customer_id")
    return skew_join(one, place, zip_code, "left", counted=customer).select(
        "customer_id", "customer_unique_id",
        F.col("p.geolocation_city").alias("customer_city"), F.col("p.geolocation_state").alias("customer_state"),
        F.col("p.geolocation_lat").alias("customer_lat"), F.col("p.geolocation_lng").alias("customer_lng"))


def dim_seller(seller: DataFrame, active_only: bool = False) -> DataFrame:
    return active_rows(seller, active_only).select("seller_id", "seller_zip_code_prefix")


def dim_review(review: DataFrame, active_only: bool = False) -> DataFrame:
    return active_rows(review, active_only).select("review_id", "review_score")


def dim_geolocation(geolocation: DataFrame, active_only: bool = False) -> DataFrame:
    return active_rows(geolocation, active_only).select("geolocation_zip_code_prefix", *GEO)


def dim_product(product: DataFrame, category: DataFrame, active_only: bool = False) -> DataFrame:
    """Products with the English category name; products of unknown category drop out."""
    category = active_rows(category, active_only).select("product_category_name", "product_category_name_english")
    return active_rows(product, active_only).join(category, "product_category_name").select(*PRODUCT_COLUMNS)


def dim_order(order: DataFrame, payment: DataFrame, active_only: bool = False) -> DataFrame:
    """One row per order and payment."""
    return active_rows(order, active_only).select("order_id", "order_status").join(
        active_rows(payment, active_only).select("order_id", "payment_type"), "order_id").select("order_id", "order_status", "payment_type")


def dim_date(dates: DataFrame, day: str = "order_purchase_timestamp") -> DataFrame:
    """Every day from the first to the last, with its calendar columns."""
    d = F.col("full_date")
    span = dates.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).where(F.col("lo").isNotNull())
    days = span.select(F.explode(F.sequence(F.col("lo").cast("date"), F.col("hi").cast("date"))).alias("full_date"))
    return days.withColumns({"dateKey": date_key(d), **date_parts(d), **date_names(d)}).select(*DATE_COLUMNS)


def _fact(item, order, payment, review, per_order, product, customer, seller, date) -> DataFrame:
    """Join order-level tables first, then meet the items once.

    Only the keys of the dimensions are read here; their payload is joined in the mart.
    """
    orders = order.select("order_id", "customer_id", F.col("order_purchase_timestamp").alias("full_date")).join(
        date.select("full_date", "dateKey"), "full_date")
    orders = skew_join(orders, customer.select("customer_id"), "customer_id", counted=order)
    orders = per_order(orders).join(
        payment.select("order_id", "payment_value", "payment_installments", "payment_sequential"), "order_id"
    ).join(review.select("order_id", "review_id"), "order_id").drop("full_date")
    items = (item.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")
             .join(product.select("product_id"), "product_id")
             .join(seller.select("seller_id"), "seller_id"))
    return skew_join(items, orders, "order_id", counted=item).select(*FACT_COLUMNS)


def fact_table(item, order, payment, review, order_dim, product, customer, seller, date) -> DataFrame:
    """Fact rows as defined by the full join chain.

    The order dimension already holds one row per payment and payments are joined again, so an
    order with n payments gives n * n rows per item and review.
    """
    times = order_dim.groupBy("order_id").agg(F.count(F.lit(1)).alias("__n"))

    def repeated(orders: DataFrame) -> DataFrame:
        both = orders.join(times, "order_id")
        return both.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n")))).drop("__n", "__i")

    return _fact(item, order, payment, review, repeated, product, customer, seller, date)


def fact_table_clean(item, order, payment, review, order_dim, product, customer, seller, date) -> DataFrame:
    """The same fact at the grain item x payment x review."""
    def present(orders: DataFrame) -> DataFrame:
        return orders.join(order_dim.select("order_id"), "order_id", "left_semi")

    return _fact(item, order, payment, review, present, product, customer, seller, date)


def sales_mart(fact, order_dim, product, customer, seller, date, counted: DataFrame | None = None, joined: bool = False) -> DataFrame:
    """Fact with all dimensions, one row per order and unique customer: the smallest by fact columns.

    Of an order's rows in the order dimension the smallest is joined. Dimensions have one row per key.
    ``counted`` tells how rows spread over orders and customers, by default the fact itself; give the
    orders where the fact is not a written table. ``joined`` says that the fact is an inner join with these very
    dimensions, as ``fact_table`` makes it, so that none of its rows lacks a product, seller or day.

    A customer has one unique customer, so the smallest row per order and customer comes first: the fact is cut
    to about its orders before it is sent anywhere, and no row that would be dropped later can win, because order
    and customer are there or not for all of these rows alike.
    """
    lowest = order_dim.groupBy("order_id").agg(
        F.min(F.struct("order_status", "payment_type")).alias("__o")).select(
        "order_id", F.col("__o.order_status").alias("order_status"), F.col("__o.payment_type").alias("payment_type"))
    counted = fact if counted is None else counted
    keys = ["order_id", "customer_unique_id"]
    order = [c for c in FACT_COLUMNS if c not in keys]
    narrow = fact
    for dim, key in () if joined else ((seller, "seller_id"), (product, "product_id"), (date, "dateKey")):
        narrow = narrow.join(dim.select(key), key, "left_semi")
    one = one_per_key(narrow, ["order_id", "customer_id"], [c for c in order if c != "customer_id"])
    # by order at last, so the smallest row per unique customer is found without another shuffle
    one = skew_join(one, customer, "customer_id", counted=counted).join(lowest, "order_id")
    return one_per_key(one, keys, order).join(seller, "seller_id").join(product, "product_id").join(date, "dateKey")
