"""The ten cleaned tables, each from a staging history with two loads.

Load one holds the whole table, load two the changed rows.  The current table is load one
after cleaning; the watermark lies between the loads; the source has lost some keys.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import functions as F

from tarnlake.operators.incremental import latest_per_key
from tarnlake.plans.silver import SILVER, silver_table

from .proxies import columns, ctes, proxy
from .registry import cents, query

FIRST, BETWEEN, SECOND, NOW = (
    "2024-01-01 00:00:00", "2024-01-15 00:00:00", "2024-02-01 00:00:00", "2024-06-01 12:00:00")
DATES = {"order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
         "order_delivered_customer_date", "order_estimated_delivery_date", "shipping_limit_date",
         "review_creation_date"}
INTS = {"customer_zip_code_prefix", "seller_zip_code_prefix", "geolocation_zip_code_prefix", "product_name_length",
        "product_photos_qty", "product_weight_g", "order_item_id", "payment_sequential", "review_score"}


@dataclass(frozen=True)
class Case:
    """Which rows of a proxy change in load two, how, and which the source has lost."""

    proxy: str
    changed: str
    change: dict[str, str]
    lost: str = ""
    cleaned: dict[str, str] = field(default_factory=dict)
    dropped: tuple[str, ...] = ()
    keep: str = "true"


CASES: dict[str, Case] = {
    "customer": Case("p_customer", "customer_city = 'BUILDING'", {"customer_city": "'MOVED'"},
                     "customer_state in ('S3', 'S11')"),
    "seller": Case("p_seller", "seller_zip_code_prefix < 10", {"seller_city": "'MOVED'"}, "seller_state = 'S12'"),
    "product": Case("p_product", "product_category_name = 'PROMO'", {"product_photos_qty": "product_photos_qty + 1"},
                    "product_category_name in ('LARGE', 'PROMO')",
                    cleaned={c: f"trunc({c})::bigint" for c in (
                        "product_description_length", "product_length_cm", "product_height_cm",
                        "product_width_cm")}),
    "order_item": Case("p_order_item", "price > 80000", {"price": "price * 0.95e0"}, "price < 20000",
                       cleaned={"price": cents("price"), "freight_value": cents("freight_value")}),
    "payment": Case("p_payment", "payment_type = 'VOUCHER' or payment_type = '2-HIGH'",
                    {"payment_value": "payment_value * 1.01e0"}, "payment_type = '5-LOW'",
                    cleaned={"payment_value": cents("payment_value"),
                             "payment_installments": "trunc(payment_installments)::bigint"}),
    "order_review": Case("p_order_review", "review_score = 1", {"review_score": "review_score + 1"},
                         "review_score in (1, 3)", dropped=("review_comment_title",)),
    "order": Case("p_order", "order_status = 'P'", {"order_status": "'DONE'"}, "order_status = 'F'"),
    "product_category": Case("p_category", "product_category_name = 'PROMO'",
                             {"product_category_name_english": "'special'"}),
    "geolocation": Case("p_geolocation", "geolocation_zip_code_prefix > 8",
                        {"geolocation_lat": "geolocation_lat + 0.5e0"}, "geolocation_zip_code_prefix in (6, 10)",
                        keep="geolocation_lat between -33.75116944 and 5.27438888 "
                             "and geolocation_lng between -73.98283055 and -34.79314722"),
    "date": Case("p_order", "order_status = 'P'", {"order_status": "'DONE'"}),
}


def _ntz(text):
    return F.to_timestamp_ntz(F.lit(text))


def _staging(spark, sf_dir, case):
    base = proxy(spark, sf_dir, case.proxy)
    cols = [f"{case.change.get(c, c)} as {c}" for c in base.columns]
    first = base.withColumns({"_ingested_at": _ntz(FIRST), "_job_run_id": F.lit("run1")})
    second = base.where(case.changed).selectExpr(*cols).withColumns(
        {"_ingested_at": _ntz(SECOND), "_job_run_id": F.lit("run2")})
    return base, first, first.unionByName(second)


def _run(name):
    case, spec = CASES[name], SILVER[name]

    def fn(spark, sf_dir):
        base, first, staging = _staging(spark, sf_dir, case)
        if spec.prepare:
            base, first = spec.prepare(base), spec.prepare(first)
        # The current table: load one, cleaned and flagged.
        old = spec.transform(latest_per_key(first, spec.keys, "_ingested_at")).withColumn("is_active", F.lit(True))
        lost = base.where(f"not coalesce({case.lost}, false)") if case.lost else None
        return silver_table(name, staging, old, lost, watermark=BETWEEN, deleted_at=_ntz(NOW)).table
    return fn


def _oracle(name: str) -> str:
    case, keys = CASES[name], list(SILVER[name].keys)
    cols = columns(case.proxy)
    key_col = "md5(order_id::varchar || '|' || payment_sequential::varchar) as pk_hash"
    derived = [key_col] if name == "payment" else []
    base = f"select {', '.join(cols + derived)} from {case.proxy}"
    changed = ", ".join([f"{case.change.get(c, c)} as {c}" for c in cols] + derived)
    names = cols + (["pk_hash"] if derived else [])
    part = ", ".join(keys)
    ties = ", ".join(f"{c} asc nulls first" for c in names if c not in keys)
    out = ["order_purchase_timestamp"] if name == "date" else [
        c for c in names if c not in case.dropped] + ["_ingested_at", "_job_run_id"]
    clean = ", ".join(f"{case.cleaned[c]} as {c}" if c in case.cleaned else c for c in out)
    complete = " and ".join([f"{c} is not null" for c in out] + [case.keep])

    def newest(src: str) -> str:
        distinct = "distinct " if name == "date" else ""
        return (f"select {distinct}{clean}, true as is_active from (select *, row_number() over (partition by {part} "
                f"order by _ingested_at desc{', ' + ties if ties else ''}) as rn from {src}) where rn = 1 and {complete}")

    on = " and ".join(f"s.{k} = t.{k}" for k in keys)
    if case.lost:
        seen = f"exists (select 1 from kept s where {on})"
        synced = (f"select t.* replace (case when {seen} then t._ingested_at else timestamp '{NOW}' end as _ingested_at, "
                  f"{seen} as is_active) from old t")
        kept = f"kept as (select * from base where not coalesce({case.lost}, false)),"
    else:
        synced, kept = "select t.* from old t", ""

    def shown(c: str) -> str:
        if c in DATES:
            return f"strftime(u.{c}, '%Y-%m-%d') as {c}"
        if c == "_ingested_at":
            return f"strftime(u.{c}, '%Y-%m-%d %H:%M:%S.%f') as {c}"
        return f"u.{c}::bigint as {c}" if c in INTS else f"u.{c}"

    return f"""
with {ctes(case.proxy)},
base as ({base}),
first as (select *, timestamp '{FIRST}' as _ingested_at, 'run1' as _job_run_id from base),
second as (select {changed}, timestamp '{SECOND}' as _ingested_at, 'run2' as _job_run_id from {case.proxy}
  where {case.changed}),
staging as (select * from first union all select * from second),
recent as (select * from staging where _ingested_at > timestamp '{BETWEEN}'),
old as ({newest("first")}),
batch as ({newest("recent")}),
{kept}
synced as ({synced})
select {", ".join(shown(c) for c in [*out, "is_active"])} from (
  select t.* from synced t where not exists (select 1 from batch s where {on})
  union all select * from batch) u"""


for _name in CASES:
    query(f"silver_{_name}", _oracle(_name))(_run(_name))
