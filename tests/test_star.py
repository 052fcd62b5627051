from datetime import date

import pytest

from tarnlake.plans import star, star_tables

from .conftest import rows


@pytest.fixture
def shop(spark):
    mk = spark.createDataFrame
    t = {
        "customer": mk([("c1", "u1", 10, None, None), ("c2", "u1", 99, "x", "y")],
                       "customer_id string, customer_unique_id string, customer_zip_code_prefix int, "
                       "customer_city string, customer_state string"),
        "geo": mk([(10, 2.0, 1.0, "B", "s"), (10, 1.0, 5.0, "A", "s")],
                  "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, "
                  "geolocation_city string, geolocation_state string"),
        "seller": mk([("s1", 10)], "seller_id string, seller_zip_code_prefix int"),
        "product": mk([("p1", "cat", 1, 1, 1, 1, 1, 1, 1), ("p2", "none", 1, 1, 1, 1, 1, 1, 1)],
                      "product_id string, product_category_name string, product_name_length int, "
                      "product_description_length int, product_photos_qty int, product_weight_g int, "
                      "product_length_cm int, product_height_cm int, product_width_cm int"),
        "category": mk([("cat", "Cat")], "product_category_name string, product_category_name_english string"),
        "order": mk([("o1", "c1", "ok", date(2024, 2, 28)), ("o2", "c2", "ok", date(2024, 3, 2))],
                    "order_id string, customer_id string, order_status string, order_purchase_timestamp date"),
        "item": mk([("o1", 1, "p1", "s1", 5.0, 1.0), ("o1", 2, "p2", "s1", 5.0, 1.0), ("o2", 1, "p1", "s1", 7.0, 2.0)],
                   "order_id string, order_item_id int, product_id string, seller_id string, price double, "
                   "freight_value double"),
        "payment": mk([("o1", 1, "card", 1, 4.0), ("o1", 2, "voucher", 1, 2.0), ("o2", 1, "card", 3, 9.0)],
                      "order_id string, payment_sequential int, payment_type string, payment_installments int, "
                      "payment_value double"),
        "review": mk([("r1", "o1", 5), ("r2", "o2", 1)], "review_id string, order_id string, review_score int"),
    }
    dims = (star.dim_order(t["order"], t["payment"]), star.dim_product(t["product"], t["category"]),
            star.dim_customer(t["customer"], t["geo"]), star.dim_seller(t["seller"]), star.dim_date(t["order"]))
    return t, dims


def facts(shop):
    t, dims = shop
    return t["item"], t["order"], t["payment"], t["review"], *dims


def test_dim_customer_takes_one_place_and_nulls_unknown_zips(shop):
    assert rows(shop[1][2]) == [("c1", "u1", "A", "s", 1.0, 5.0), ("c2", "u1", None, None, None, None)]


def test_dim_date_has_every_day(shop):
    got = rows(shop[1][4], "dateKey", "week", "day_of_year", "day_name_of_week", "month_name_of_week")
    assert [g[0] for g in got] == [20240228, 20240229, 20240301, 20240302]
    assert got[1] == (20240229, 9, 60, "Thursday", "February")


def test_dim_date_of_no_orders_is_empty(shop):
    assert star.dim_date(shop[0]["order"].limit(0)).count() == 0


def test_two_payments_fan_out_squared_or_once(shop):
    assert shop[1][0].count() == 3
    literal = rows(star.fact_table(*facts(shop)), "order_id", "order_item_id", "payment_sequential")
    assert literal == [("o1", 1, 1), ("o1", 1, 1), ("o1", 1, 2), ("o1", 1, 2), ("o2", 1, 1)]
    clean = rows(star.fact_table_clean(*facts(shop)), "order_id", "order_item_id", "payment_sequential")
    assert clean == [("o1", 1, 1), ("o1", 1, 2), ("o2", 1, 1)]


def test_mart_keeps_one_row_per_order_and_customer(shop):
    order_dim, product, customer, seller, day = shop[1]
    mart = star.sales_mart(star.fact_table(*facts(shop)), order_dim, product, customer, seller, day)
    assert rows(mart, "order_id", "customer_unique_id", "payment_sequential", "payment_type", "price") == [
        ("o1", "u1", 2, "card", 5.0), ("o2", "u1", 1, "card", 7.0)]
    assert len(mart.columns) == len(set(mart.columns)) == 38


def test_active_only(spark, shop):
    from pyspark.sql import functions as F
    t, _ = shop
    flagged = t["customer"].withColumn("is_active", F.col("customer_id") == "c1")
    assert star.dim_customer(flagged, t["geo"]).count() == 2
    assert star.dim_customer(flagged, t["geo"], active_only=True).count() == 1


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_are_joined_without_an_exchange_on_the_order(spark, sf):
    import re

    from workload.star import _order_tables, _Star
    s = _Star(spark, sf)
    tables, _ = _order_tables(spark, s)
    orders = tables.order.select("order_id").join(tables.item.select("order_id", "price"), "order_id").join(
        tables.payment.select("order_id", "payment_value"), "order_id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in _plan(orders)
        for fan_out in (True, False):
            fact = star_tables.bucketed_fact(tables, s.product, s.customer, s.seller, s.date, fan_out)
            assert not re.search(r"Exchange hashpartitioning\(order_id", _plan(fact))
            plain = (star.fact_table if fan_out else star.fact_table_clean)(*s.parts())
            assert rows(fact) == rows(plain) and fact.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_months_are_pruned_by_the_calendar(spark, tmp_path):
    from pyspark.sql import functions as F
    fact = spark.range(3000).select(F.expr("cast(19980101 + (id % 12) * 100 + id % 28 as int)").alias("dateKey"), F.col("id").alias("order_id"),
                                    F.lit("x").alias("v"))
    star_tables.write_by_month(fact, str(tmp_path / "f"))
    calendar = fact.select("dateKey").distinct().withColumn("month", F.expr("cast(dateKey div 100 % 100 as int)"))
    some = star_tables.read_by_month(spark, str(tmp_path / "f"), calendar.where("month in (2, 5)"), ["dateKey", "order_id", "v"])
    assert "dynamicpruning" in _plan(some)
    assert rows(some) == rows(fact.where("cast(dateKey div 100 % 100 as int) in (2, 5)"))
    opened = {r[0].split("month_key=")[1][:6] for r in some.select(F.input_file_name()).distinct().collect()}
    assert opened == {"199802", "199805"}
