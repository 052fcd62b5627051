"""Cleaning operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnlake.functions.values import md5_key, to_ts
from tarnlake.operators import cleaning as ops

from .proxies import ctes, proxy
from .registry import cents, day, query, stamp, table


@query("clean_drop_nulls", f"""
with {ctes("p_product")} select product_id, product_category_name, product_name_length::bigint product_name_length,
  product_description_length, product_photos_qty::bigint product_photos_qty, product_weight_g::bigint product_weight_g,
  product_length_cm, product_height_cm, product_width_cm from p_product
where product_weight_g is not null and product_category_name is not null""")
def clean_drop_nulls(spark, sf_dir):
    return ops.drop_incomplete(proxy(spark, sf_dir, "p_product"))


@query("clean_cast_ints", f"""
with {ctes("p_product")} select product_id, trunc(product_description_length)::bigint product_description_length,
  trunc(product_length_cm)::bigint product_length_cm, trunc(product_height_cm)::bigint product_height_cm,
  trunc(product_width_cm)::bigint product_width_cm from p_product""")
def clean_cast_ints(spark, sf_dir):
    cols = ["product_description_length", "product_length_cm", "product_height_cm", "product_width_cm"]
    return ops.cast_ints(proxy(spark, sf_dir, "p_product").select("product_id", *cols), [*cols, "not_there"])


@query("clean_round_money", f"""
with {ctes("p_order_item")} select order_id, order_item_id::bigint order_item_id, product_id, seller_id,
  {cents("price")} price, {cents("freight_value")} freight_value from p_order_item""")
def clean_round_money(spark, sf_dir):
    items = proxy(spark, sf_dir, "p_order_item").drop("shipping_limit_date")
    return ops.round_money(items, ["price", "freight_value"])


@query("clean_md5_key", f"""
with {ctes("p_payment")} select order_id, payment_sequential::bigint payment_sequential,
  md5(order_id::varchar || payment_sequential::varchar) plain_key,
  md5(order_id::varchar || '|' || payment_sequential::varchar) pk_hash from p_payment""")
def clean_md5_key(spark, sf_dir):
    a, b = F.col("order_id"), F.col("payment_sequential")
    return proxy(spark, sf_dir, "p_payment").select(
        "order_id", "payment_sequential", md5_key(a, b, sep="").alias("plain_key"), md5_key(a, b).alias("pk_hash"))


@query("clean_drop_column", f"""
with {ctes("p_order_review")} select review_id, order_id, review_score::bigint review_score, review_comment_message,
  {day("review_creation_date")} review_creation_date from p_order_review""")
def clean_drop_column(spark, sf_dir):
    return proxy(spark, sf_dir, "p_order_review").drop("review_comment_title", "not_there")


@query("clean_geo_bounds", f"""
with {ctes("p_geolocation")} select geolocation_zip_code_prefix::bigint geolocation_zip_code_prefix, geolocation_lat,
  geolocation_lng, geolocation_city, geolocation_state from p_geolocation
where geolocation_lat <= 5.27438888 and geolocation_lng >= -73.98283055
  and geolocation_lat >= -33.75116944 and geolocation_lng <= -34.79314722""")
def clean_geo_bounds(spark, sf_dir):
    return ops.within_box(proxy(spark, sf_dir, "p_geolocation"), "geolocation_lat", "geolocation_lng")


@query("clean_distinct_dates", f"""
with {ctes("p_order")} select distinct {day("order_purchase_timestamp")} order_purchase_timestamp from p_order
where order_purchase_timestamp is not null""")
def clean_distinct_dates(spark, sf_dir):
    return ops.distinct_present(proxy(spark, sf_dir, "p_order"), "order_purchase_timestamp")


@query("dq_not_null", f"""
with {ctes("p_product")} select count(*) total_rows, count(*) filter (product_weight_g is null) null_rows,
  count(*) filter (product_weight_g is null) = 0 passed from p_product""")
def dq_not_null(spark, sf_dir):
    return ops.not_null_check(proxy(spark, sf_dir, "p_product"), "product_weight_g")


@query("clean_to_timestamp", f"""
select event_id, {stamp("ts")} ts, {stamp("try_cast(strftime(ts, '%Y-%m-%d %H:%M:%S') as timestamp)")} parsed,
  {stamp("try_cast(event_type as timestamp)")} broken from events""")
def clean_to_timestamp(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return e.select("event_id", to_ts(F.col("ts")).alias("ts"), to_ts(text).alias("parsed"),
                    to_ts(F.col("event_type")).alias("broken"))
