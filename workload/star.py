"""Star schema and sales mart."""

from __future__ import annotations

from tarnlake.plans import star, star_tables
from tarnlake.sources.scratch import new_path

from .proxies import ctes, proxy
from .registry import day, query

DIM_CUSTOMER = """
place as (select * from (select *, row_number() over (partition by geolocation_zip_code_prefix
    order by geolocation_lat, geolocation_lng, geolocation_city, geolocation_state) rn from p_geolocation) where rn = 1),
dim_customer as (select customer_id, customer_unique_id, geolocation_city customer_city, geolocation_state customer_state,
    geolocation_lat customer_lat, geolocation_lng customer_lng
  from p_customer left join place on customer_zip_code_prefix = geolocation_zip_code_prefix)"""
DIM_PRODUCT = """
dim_product as (select product_id, p.product_category_name, product_category_name_english, product_name_length,
    product_description_length, product_photos_qty, product_weight_g, product_length_cm, product_height_cm,
    product_width_cm
  from p_product p join p_category c on p.product_category_name = c.product_category_name)"""
DIM_ORDER = """
dim_order as (select o.order_id, order_status, payment_type from p_order o join p_payment p on o.order_id = p.order_id)"""
DIM_DATE = """
days as (select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) full_date
  from (select min(order_purchase_timestamp) lo, max(order_purchase_timestamp) hi from p_order)),
dim_date as (select cast(year(full_date) * 10000 + month(full_date) * 100 + day(full_date) as bigint) "dateKey", full_date,
    cast(year(full_date) as bigint) "year", cast(quarter(full_date) as bigint) "quarter",
    cast(month(full_date) as bigint) "month", cast(weekofyear(full_date) as bigint) as "week",
    cast(day(full_date) as bigint) "day", cast(dayofyear(full_date) as bigint) day_of_year,
    dayname(full_date) day_name_of_week, monthname(full_date) month_name_of_week from days)"""
FACT_BODY = """
  from p_order o join p_order_item i on o.order_id = i.order_id
  {order_join}
  join dim_product dp on i.product_id = dp.product_id
  join dim_customer dc on o.customer_id = dc.customer_id
  join p_seller s on i.seller_id = s.seller_id
  join p_payment p on o.order_id = p.order_id
  join p_order_review r on o.order_id = r.order_id
  join dim_date d on o.order_purchase_timestamp = d.full_date
  {where}"""
FACT_SELECT = """select o.order_id, cast(i.order_item_id as bigint) order_item_id, o.customer_id, i.product_id,
    r.review_id, i.seller_id, d."dateKey", i.price, i.freight_value, p.payment_value, p.payment_installments,
    cast(p.payment_sequential as bigint) payment_sequential"""
BASE = ctes("p_customer", "p_geolocation", "p_seller", "p_product", "p_category", "p_order", "p_order_item",
            "p_payment", "p_order_review")
DIMS = ",".join([BASE, DIM_CUSTOMER, DIM_PRODUCT, DIM_ORDER, DIM_DATE])
FACT = FACT_SELECT + FACT_BODY.format(order_join="join dim_order x on o.order_id = x.order_id", where="")
FACT_CLEAN = FACT_SELECT + FACT_BODY.format(
    order_join="", where="where o.order_id in (select order_id from dim_order)")


class _Star:
    """Dimensions and facts over one data directory."""

    def __init__(self, spark, sf_dir):
        def p(name):
            return proxy(spark, sf_dir, name)
        self.order, self.item, self.payment, self.review = (
            p("p_order"), p("p_order_item"), p("p_payment"), p("p_order_review"))
        self.customer = star.dim_customer(p("p_customer"), p("p_geolocation"))
        self.seller = star.dim_seller(p("p_seller"))
        self.product = star.dim_product(p("p_product"), p("p_category"))
        self.order_dim = star.dim_order(self.order, self.payment)
        self.date = star.dim_date(self.order)

    def parts(self):
        return (self.item, self.order, self.payment, self.review, self.order_dim, self.product, self.customer,
                self.seller, self.date)


@query("gold_dim_customer", f"""
with {ctes("p_customer", "p_geolocation")}, {DIM_CUSTOMER}
select customer_id, customer_unique_id, customer_city, customer_state, customer_lat, customer_lng from dim_customer""")
def gold_dim_customer(spark, sf_dir):
    return star.dim_customer(proxy(spark, sf_dir, "p_customer"), proxy(spark, sf_dir, "p_geolocation"))


@query("gold_dim_seller", f"""
with {ctes("p_seller")} select seller_id, cast(seller_zip_code_prefix as bigint) seller_zip_code_prefix from p_seller""")
def gold_dim_seller(spark, sf_dir):
    return star.dim_seller(proxy(spark, sf_dir, "p_seller"))


@query("gold_dim_review", f"""
with {ctes("p_order_review")} select review_id, cast(review_score as bigint) review_score from p_order_review""")
def gold_dim_review(spark, sf_dir):
    return star.dim_review(proxy(spark, sf_dir, "p_order_review"))


@query("gold_dim_geolocation", f"""
with {ctes("p_geolocation")} select cast(geolocation_zip_code_prefix as bigint) geolocation_zip_code_prefix,
  geolocation_lat, geolocation_lng, geolocation_city, geolocation_state from p_geolocation""")
def gold_dim_geolocation(spark, sf_dir):
    return star.dim_geolocation(proxy(spark, sf_dir, "p_geolocation"))


@query("gold_dim_product", f"""
with {ctes("p_product", "p_category")}, {DIM_PRODUCT}
select product_id, product_category_name, product_category_name_english,
  cast(product_name_length as bigint) product_name_length, product_description_length,
  cast(product_photos_qty as bigint) product_photos_qty, cast(product_weight_g as bigint) product_weight_g,
  product_length_cm, product_height_cm, product_width_cm from dim_product""")
def gold_dim_product(spark, sf_dir):
    return star.dim_product(proxy(spark, sf_dir, "p_product"), proxy(spark, sf_dir, "p_category"))


@query("gold_dim_order", f"""
with {ctes("p_order", "p_payment")}, {DIM_ORDER} select order_id, order_status, payment_type from dim_order""")
def gold_dim_order(spark, sf_dir):
    return star.dim_order(proxy(spark, sf_dir, "p_order"), proxy(spark, sf_dir, "p_payment"))


@query("gold_dim_date", f"""
with {ctes("p_order")}, {DIM_DATE} select * replace ({day("full_date")} as full_date) from dim_date""")
def gold_dim_date(spark, sf_dir):
    return star.dim_date(proxy(spark, sf_dir, "p_order"))


@query("gold_fact", f"with {DIMS}\n{FACT}")
def gold_fact(spark, sf_dir):
    return star.fact_table(*_Star(spark, sf_dir).parts())


@query("gold_fact_grain", f"with {DIMS}\n{FACT_CLEAN}")
def gold_fact_grain(spark, sf_dir):
    return star.fact_table_clean(*_Star(spark, sf_dir).parts())


@query("mart_sales", f"""
with {DIMS}, fact as ({FACT}),
wide as (select f.*, customer_unique_id, customer_city, customer_state, customer_lat, customer_lng,
    cast(seller_zip_code_prefix as bigint) seller_zip_code_prefix, dp.product_category_name,
    product_category_name_english, cast(product_name_length as bigint) product_name_length,
    product_description_length, cast(product_photos_qty as bigint) product_photos_qty,
    cast(product_weight_g as bigint) product_weight_g, product_length_cm, product_height_cm, product_width_cm,
    {day("d.full_date")} full_date, d."year", d."quarter", d."month", d."week", d."day", d.day_of_year,
    d.day_name_of_week, d.month_name_of_week, x.order_status, x.payment_type
  from fact f join dim_order x on f.order_id = x.order_id
  join dim_product dp on f.product_id = dp.product_id
  join dim_customer dc on f.customer_id = dc.customer_id
  join p_seller s on f.seller_id = s.seller_id
  join dim_date d on f."dateKey" = d."dateKey")
select * exclude (rn) from (select *, row_number() over (partition by order_id, customer_unique_id
  order by order_item_id, customer_id, product_id, review_id, seller_id, "dateKey", price, freight_value,
    payment_value, payment_installments, payment_sequential, order_status, payment_type) rn from wide)
where rn = 1""")
def mart_sales(spark, sf_dir):
    """From the fact at its own grain: the repeats of the literal one are equal rows, of which the mart keeps one."""
    s = _Star(spark, sf_dir)
    return star.sales_mart(star.fact_table_clean(*s.parts()), s.order_dim, s.product, s.customer, s.seller, s.date,
                           counted=s.order, joined=True)


def _order_tables(spark, s: _Star) -> tuple[star_tables.OrderTables, str]:
    root = new_path(spark, "order-tables")
    buckets = star_tables.bucket_number(s.item, s.order, s.payment)
    made = star_tables.OrderTables.write("orders_" + root.rsplit("-", 1)[1], root, buckets, item=s.item, order=s.order, payment=s.payment,
                                         review=s.review, order_dim=s.order_dim)
    return made, root


@query("gold_fact_bucketed", f"with {DIMS}\n{FACT}")
def gold_fact_bucketed(spark, sf_dir):
    """The literal fact from tables bucketed by order."""
    s = _Star(spark, sf_dir)
    tables, _ = _order_tables(spark, s)
    return star_tables.bucketed_fact(tables, s.product, s.customer, s.seller, s.date)


@query("gold_fact_month", f"""with {DIMS}, fact as ({FACT_CLEAN})
select * from fact where "dateKey" in (select "dateKey" from dim_date where "year" = 1998 and "quarter" = 2)""")
def gold_fact_month(spark, sf_dir):
    """The fact written by month, read through a filter on the calendar: only the months of the quarter are opened."""
    s = _Star(spark, sf_dir)
    path = new_path(spark, "fact-by-month")
    star_tables.write_by_month(star.fact_table_clean(*s.parts()), path)
    return star_tables.read_by_month(spark, path, s.date.where("year = 1998 and quarter = 2"))
