"""Explicit schemas of the retail source tables and the table registry."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TableSpec:
    """A source table: schema as DDL, name at the source, key, and the key's SQL there if it is computed."""

    name: str
    schema: str
    source_table: str
    keys: tuple[str, ...]
    key_sql: str | None = None

    @property
    def source_key(self) -> list[str]:
        """The SQL of each key column at the source."""
        return [self.key_sql] if self.key_sql else list(self.keys)


# Names, types and keys of the source tables.
TABLES: dict[str, TableSpec] = {t.name: t for t in (
    TableSpec("customer",
              "customer_id string, customer_unique_id string, customer_zip_code_prefix int, "
              "customer_city string, customer_state string", "customers", ("customer_id",)),
    TableSpec("seller",
              "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string",
              "sellers", ("seller_id",)),
    TableSpec("product",
              "product_id string, product_category_name string, product_name_length int, "
              "product_description_length float, product_photos_qty int, product_weight_g int, "
              "product_length_cm float, product_height_cm float, product_width_cm float",
              "products", ("product_id",)),
    TableSpec("order",
              "order_id string, customer_id string, order_status string, order_purchase_timestamp date, "
              "order_approved_at date, order_delivered_carrier_date date, order_delivered_customer_date date, "
              "order_estimated_delivery_date date", "orders", ("order_id",)),
    TableSpec("order_item",
              "order_id string, order_item_id int, product_id string, seller_id string, "
              "shipping_limit_date date, price float, freight_value float",
              "order_items", ("order_id", "order_item_id")),
    TableSpec("payment",
              "order_id string, payment_sequential int, payment_type string, payment_installments float, "
              "payment_value float", "payments", ("pk_hash",),
              "MD5(CONCAT(order_id, '|', payment_sequential))"),
    TableSpec("order_review",
              "review_id string, order_id string, review_score int, review_comment_title string, "
              "review_comment_message string, review_creation_date date, review_answer_timestamp date",
              "order_reviews", ("review_id",)),
    TableSpec("product_category",
              "product_category_name string, product_category_name_english string",
              "product_category_name_translation", ("product_category_name",)),
    TableSpec("geolocation",
              "geolocation_zip_code_prefix int, geolocation_lat float, geolocation_lng float, "
              "geolocation_city string, geolocation_state string",
              "geolocation", ("geolocation_zip_code_prefix",)),
)}
