"""Cleaned tables: one current row per key, kept in step with the source."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import md5_key
from ..operators.cleaning import cast_ints, distinct_present, drop_incomplete, round_money, within_box
from ..operators.incremental import dedup_latest, merge_metrics, new_watermark, newer_than
from ..operators.keys import as_keys
from ..operators.merge import ACTIVE, soft_delete, upsert

Transform = Callable[[DataFrame], DataFrame]


def with_payment_key(df: DataFrame) -> DataFrame:
    """Payment key; made before the dedup, which partitions by it."""
    return df.withColumn("pk_hash", md5_key(F.col("order_id"), F.col("payment_sequential")))


def clean_customer(df: DataFrame) -> DataFrame:
    return drop_incomplete(df)


clean_seller = clean_order = clean_product_category = clean_customer


def clean_product(df: DataFrame) -> DataFrame:
    return cast_ints(drop_incomplete(df), [
        "product_description_length", "product_photos_qty", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm"])


def clean_order_item(df: DataFrame) -> DataFrame:
    return drop_incomplete(round_money(df, ["price", "freight_value"]))


def clean_payment(df: DataFrame) -> DataFrame:
    df = cast_ints(round_money(df, ["payment_value"]), ["payment_installments"])
    return drop_incomplete(df if "pk_hash" in df.columns else with_payment_key(df))


def clean_order_review(df: DataFrame) -> DataFrame:
    return drop_incomplete(df.drop("review_comment_title"))


def clean_geolocation(df: DataFrame) -> DataFrame:
    return within_box(drop_incomplete(df), "geolocation_lat", "geolocation_lng")


def purchase_dates(df: DataFrame) -> DataFrame:
    return distinct_present(df, "order_purchase_timestamp")


@dataclass(frozen=True)
class SilverTable:
    keys: tuple[str, ...]
    transform: Transform
    delete_sync: bool = True
    prepare: Transform | None = None


SILVER: dict[str, SilverTable] = {
    "customer": SilverTable(("customer_id",), clean_customer),
    "seller": SilverTable(("seller_id",), clean_seller),
    "product": SilverTable(("product_id",), clean_product),
    "order_item": SilverTable(("order_id", "order_item_id"), clean_order_item),
    "payment": SilverTable(("pk_hash",), clean_payment, prepare=with_payment_key),
    "order_review": SilverTable(("review_id",), clean_order_review),
    "order": SilverTable(("order_id",), clean_order),
    "product_category": SilverTable(("product_category_name",), clean_product_category, delete_sync=False),
    "geolocation": SilverTable(("geolocation_zip_code_prefix",), clean_geolocation),
    "date": SilverTable(("order_purchase_timestamp",), purchase_dates, delete_sync=False),
}


@dataclass(frozen=True)
class SilverStep:
    """Lazy results of one step. Write ``table`` first, then store ``watermark``."""

    table: DataFrame
    batch: DataFrame
    metrics: DataFrame
    watermark: DataFrame


def silver_step(staging: DataFrame, target: DataFrame | None, keys: str | Sequence[str], transform: Transform,
                *, watermark: Any = None, watermark_col: str = "_ingested_at",
                source_keys: DataFrame | None = None, deleted_at: Column | None = None,
                allow_empty_source: bool = False, ties: Sequence[str] | None = None, persist: bool = False) -> SilverStep:
    """Newest staged row per key, cleaned and merged into the current table.

    Deletes are synchronised against the table as it was; a row of the batch is active again
    even if its key has just left the source, until the next run.  With ``persist`` the batch is kept for the table
    and the metrics; the caller unpersists it.
    """
    keys = as_keys(keys)
    newest = dedup_latest(staging, keys, watermark_col, watermark, ties)
    batch = transform(newest).withColumn(ACTIVE, F.lit(True))
    if persist:
        batch = batch.persist()
    mark = new_watermark(newer_than(staging, watermark_col, watermark), watermark_col, watermark)
    if target is None:
        return SilverStep(batch, batch, merge_metrics(batch, None, keys), mark)
    metrics = merge_metrics(batch, target, keys)
    synced = target
    if source_keys is not None:
        synced = soft_delete(target, source_keys, keys, deleted_at, watermark_col, allow_empty_source)
    return SilverStep(upsert(synced, batch, keys), batch, metrics, mark)


def silver_table(name: str, staging: DataFrame, target: DataFrame | None, source_keys: DataFrame | None = None,
                 **kw) -> SilverStep:
    """The step for one of the registered tables."""
    spec = SILVER[name]
    if spec.prepare:
        staging = spec.prepare(staging)
    return silver_step(staging, target, spec.keys, spec.transform,
                       source_keys=source_keys if spec.delete_sync else None, **kw)
