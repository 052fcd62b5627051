"""Joins, aggregates, sorts, predicates and date functions as retail batch jobs use them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnlake.functions.dates import date_key, date_names, date_parts
from tarnlake.operators.incremental import one_per_key
from tarnlake.operators.profiling import top_values

from .registry import day, query, stamp, table


@query("join_inner_using", """
select o_orderkey, o_orderstatus, l_linenumber::bigint l_linenumber, l_partkey, l_extendedprice
from orders join lineitem on o_orderkey = l_orderkey""")
def join_inner_using(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return table(spark, sf_dir, "orders").join(items, "o_orderkey").select(
        "o_orderkey", "o_orderstatus", "l_linenumber", "l_partkey", "l_extendedprice")


@query("join_inner_expr", """
select c_custkey, c_name, n_name, r_name from customer join nation on c_nationkey = n_nationkey
join region on n_regionkey = r_regionkey""")
def join_inner_expr(spark, sf_dir):
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    return c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(
        "c_custkey", "c_name", "n_name", "r_name")


@query("join_left", """
select c_custkey, o_orderkey is not null has_order, coalesce(o_totalprice, 0) total
from customer left join orders on c_custkey = o_custkey""")
def join_left(spark, sf_dir):
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    return c.join(o, c.c_custkey == o.o_custkey, "left").select(
        "c_custkey", F.col("o_orderkey").isNotNull().alias("has_order"),
        F.coalesce("o_totalprice", F.lit(0.0)).alias("total"))


@query("join_anti", """
select o_orderkey, o_custkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)""")
def join_anti(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(items, "o_orderkey", "left_anti")


@query("agg_count", "select count(*) n, count(o_custkey) n_cust from orders")
def agg_count(spark, sf_dir):
    return table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("n"), F.count("o_custkey").alias("n_cust"))


@query("agg_min_max", f"""
select {day("min(o_orderdate)")} first_day, {day("max(o_orderdate)")} last_day,
  coalesce(max(o_orderkey), 0) max_key from orders""")
def agg_min_max(spark, sf_dir):
    d = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").agg(
        F.min(d).alias("first_day"), F.max(d).alias("last_day"),
        F.coalesce(F.max("o_orderkey"), F.lit(0)).alias("max_key"))


@query("agg_distinct", "select distinct l_returnflag, l_linestatus, l_linenumber::bigint l_linenumber from lineitem")
def agg_distinct(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("agg_drop_duplicates", f"""
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, {day("o_orderdate")} o_orderdate, o_orderpriority
from (select *, row_number() over (partition by o_custkey, o_orderstatus
  order by o_orderkey, o_totalprice, o_orderdate, o_orderpriority) rn from orders) where rn = 1""")
def agg_drop_duplicates(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    return one_per_key(o, ["o_custkey", "o_orderstatus"])


@query("agg_top_k", """
select o_custkey, count(*) n from orders group by o_custkey order by n desc, o_custkey limit 40""")
def agg_top_k(spark, sf_dir):
    return top_values(table(spark, sf_dir, "orders"), "o_custkey", 40)


@query("sort_watermark", f"""
select event_id, {stamp("ts")} ts, user_id from events order by events.ts""")
def sort_watermark(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id").orderBy("ts")


@query("sort_limit", "select c_custkey, c_name, c_acctbal from customer order by c_custkey limit 5")
def sort_limit(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal").orderBy("c_custkey").limit(5)


@query("filter_predicates", """
select l_orderkey, l_linenumber::bigint l_linenumber, l_quantity, l_discount from lineitem
where l_quantity <= 24 and l_quantity >= 5 and l_discount >= 0.05 and l_discount <= 0.07 and l_returnflag = 'R'
  and l_shipdate is not null""")
def filter_predicates(spark, sf_dir):
    q, d = F.col("l_quantity"), F.col("l_discount")
    return table(spark, sf_dir, "lineitem").where(
        (q <= 24) & (q >= 5) & (d >= 0.05) & (d <= 0.07) & (F.col("l_returnflag") == "R")
        & F.col("l_shipdate").isNotNull()).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query("fn_date_parts", """
select o_orderkey, year(o_orderdate)::bigint "year", quarter(o_orderdate)::bigint "quarter",
  month(o_orderdate)::bigint "month", weekofyear(o_orderdate)::bigint as "week", day(o_orderdate)::bigint "day",
  dayofyear(o_orderdate)::bigint day_of_year from orders""")
def fn_date_parts(spark, sf_dir):
    parts = date_parts(F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", *[c.alias(n) for n, c in parts.items()])


@query("fn_date_key", """
select o_orderkey, (year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate))::bigint date_key
from orders""")
def fn_date_key(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", date_key(F.col("o_orderdate")).alias("date_key"))


@query("fn_date_names", """
select o_orderkey, dayname(o_orderdate) day_name_of_week, monthname(o_orderdate) month_name_of_week from orders""")
def fn_date_names(spark, sf_dir):
    names = date_names(F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", *[c.alias(n) for n, c in names.items()])


@query("fn_date_add", f"""
select l_orderkey, l_linenumber::bigint l_linenumber, l_partkey, l_suppkey,
  {day("cast(l_shipdate as date) + cast(l_linenumber as int)")} due
from lineitem""")
def fn_date_add(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.date_add(F.col("l_shipdate").cast("date"), F.col("l_linenumber")).alias("due"))
