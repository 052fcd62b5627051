"""Views that give the supplied tables the shape of the retail source tables.

Every proxy covers its whole table.  Conditions inside expressions make the cases the
operators must handle: nulls, zip codes without a place, orders with two payments.  Each
expression is valid in Spark SQL and in DuckDB, so both sides read the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .registry import table

# name: (table, {column: expression}, condition)
PROXIES: dict[str, tuple[str, dict[str, str], str | None]] = {
    "p_customer": ("customer", {
        "customer_id": "c_custkey",
        "customer_unique_id": "'u' || cast(cast(floor(c_custkey / 2) as bigint) as varchar(20))",
        "customer_zip_code_prefix": "case when c_acctbal < 0 then 99 else c_nationkey end",
        "customer_city": "case when c_acctbal > 9500 then null else c_mktsegment end",
        "customer_state": "'S' || cast(c_nationkey as varchar(20))",
    }, None),
    # Many places per zip code; about half of the zips lie inside the bounding box.
    "p_geolocation": ("supplier", {
        "geolocation_zip_code_prefix": "s_nationkey",
        "geolocation_lat": "cast(s_nationkey as double) * 2 - 40 + s_acctbal / 100000",
        "geolocation_lng": "-20 - cast(s_nationkey as double) * 3 - s_acctbal / 100000",
        "geolocation_city": "s_name",
        "geolocation_state": "'S' || cast(s_nationkey as varchar(20))",
    }, None),
    "p_seller": ("supplier", {
        "seller_id": "s_suppkey",
        "seller_zip_code_prefix": "s_nationkey",
        "seller_city": "case when s_acctbal < 0 then null else s_name end",
        "seller_state": "'S' || cast(s_nationkey as varchar(20))",
    }, None),
    "p_product": ("part", {
        "product_id": "p_partkey",
        "product_category_name": "p_type",
        "product_name_length": "cast(length(p_name) as int)",
        "product_description_length": "p_retailprice",
        "product_photos_qty": "p_size",
        "product_weight_g": "case when p_size = 17 then null else p_size * 10 end",
        "product_length_cm": "p_retailprice / 40",
        "product_height_cm": "cast(p_size as double) * 1.5e0",
        "product_width_cm": "cast(p_size as double) * 0.75e0",
    }, None),
    "p_order": ("orders", {
        "order_id": "o_orderkey",
        "customer_id": "o_custkey",
        "order_status": "o_orderstatus",
        "order_purchase_timestamp": "cast(o_orderdate as date)",
        "order_approved_at": "cast(o_orderdate as date) + 1",
        "order_delivered_carrier_date": "cast(o_orderdate as date) + 3",
        "order_delivered_customer_date":
            "case when o_orderpriority = '5-LOW' then null else cast(o_orderdate as date) + 10 end",
        "order_estimated_delivery_date": "cast(o_orderdate as date) + 20",
    }, None),
    "p_order_item": ("lineitem", {
        "order_id": "l_orderkey",
        "order_item_id": "l_linenumber",
        "product_id": "l_partkey",
        "seller_id": "l_suppkey",
        "shipping_limit_date": "cast(l_shipdate as date)",
        "price": "l_extendedprice",
        "freight_value": "l_extendedprice * l_tax",
    }, None),
    "p_payment_main": ("orders", {
        "order_id": "o_orderkey",
        "payment_sequential": "1",
        "payment_type": "o_orderpriority",
        "payment_installments": "cast(1 + o_orderkey % 3 as double)",
        "payment_value": "o_totalprice",
    }, None),
    # Second payments: urgent orders in status P were paid with a voucher as well.
    "p_payment_voucher": ("orders", {
        "order_id": "o_orderkey",
        "payment_sequential": "2",
        "payment_type": "'VOUCHER'",
        "payment_installments": "cast(1 as double)",
        "payment_value": "o_totalprice * 0.1e0",
    }, "o_orderpriority = '1-URGENT' and o_orderstatus = 'P'"),
    # Orders of three of the five priorities were reviewed, about 60 %.
    "p_order_review": ("orders", {
        "review_id": "o_orderkey",
        "order_id": "o_orderkey",
        "review_score": "cast(1 + o_orderkey % 5 as int)",
        "review_comment_title": "case when o_orderstatus = 'F' then null else o_orderpriority end",
        "review_comment_message":
            "case when o_totalprice < 20000 then null else o_orderpriority || ' ' || o_orderstatus end",
        "review_creation_date": "cast(o_orderdate as date) + 12",
    }, "o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM')"),
    "p_category_rows": ("part", {
        "product_category_name": "p_type",
        "product_category_name_english": "lower(p_type)",
    }, "p_type <> 'ECONOMY'"),
}


def _sql(name: str) -> str:
    src, cols, where = PROXIES[name]
    body = ", ".join(f"{e} as {c}" for c, e in cols.items())
    return f"select {body} from {src}" + (f" where {where}" if where else "")


CTES: dict[str, str] = {n: _sql(n) for n in PROXIES if n not in (
    "p_payment_main", "p_payment_voucher", "p_category_rows")}
CTES["p_payment"] = f"{_sql('p_payment_main')} union all {_sql('p_payment_voucher')}"
CTES["p_category"] = f"select distinct * from ({_sql('p_category_rows')})"


def ctes(*names: str) -> str:
    """SQL text: the named proxies as a comma-separated list of CTEs."""
    return ",\n".join(f"{n} as ({CTES[n]})" for n in names)


def _frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    src, cols, where = PROXIES[name]
    df = table(spark, sf_dir, src)
    if where:
        df = df.where(where)
    return df.selectExpr(*[f"{e} as {c}" for c, e in cols.items()])


def proxy(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "p_payment":
        return _frame(spark, sf_dir, "p_payment_main").unionByName(_frame(spark, sf_dir, "p_payment_voucher"))
    if name == "p_category":
        return _frame(spark, sf_dir, "p_category_rows").distinct()
    return _frame(spark, sf_dir, name)


def columns(name: str) -> list[str]:
    return list(PROXIES[{"p_payment": "p_payment_main", "p_category": "p_category_rows"}.get(name, name)][1])
