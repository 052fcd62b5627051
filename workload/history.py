"""Row-level DML, change log and as-of reads, over the orders table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake.operators import history as ops
from tarnlake.sources.scratch import new_path
from tarnlake.sources.tables import catalog_listing, create_if_absent, row_counts

from .registry import day, query, table

ORDER = f"o_orderkey, o_custkey, o_orderstatus, o_totalprice, {day('o_orderdate')} o_orderdate, o_orderpriority"
V1, V2, V3 = "2024-07-01 10:00:00", "2024-07-01 12:00:00", "2024-07-02 09:00:00"


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def _log(spark, sf_dir):
    """Three commits: insert all, update status P, delete low priority."""
    o = _orders(spark, sf_dir)
    return (ops.commit(o, "insert", 1, V1)
            .unionByName(ops.commit(o.where("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("X")),
                                    "update", 2, V2))
            .unionByName(ops.commit(o.where("o_orderpriority = '5-LOW'"), "delete", 3, V3)))


@query("tbl_update", f"""
select {ORDER} from (select * replace (case when o_totalprice > 400000 then 'BIG' else o_orderstatus end
  as o_orderstatus, case when o_totalprice > 400000 then o_totalprice * 0.5e0 else o_totalprice end as o_totalprice)
  from orders) orders""")
def tbl_update(spark, sf_dir):
    return ops.update_where(_orders(spark, sf_dir), F.col("o_totalprice") > 400000,
                            {"o_orderstatus": F.lit("BIG"), "o_totalprice": F.col("o_totalprice") * 0.5})


@query("tbl_delete", f"select {ORDER} from orders where not coalesce(nullif(o_orderstatus, 'P') = 'F', false)")
def tbl_delete(spark, sf_dir):
    """The condition is null for status P; those rows stay."""
    return ops.delete_where(_orders(spark, sf_dir), F.expr("nullif(o_orderstatus, 'P') = 'F'"))


@query("tbl_add_column", "select c_custkey, c_name, cast(null as varchar) phone, 1::bigint version from customer")
def tbl_add_column(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return ops.add_column(ops.add_column(c, "phone", "string"), "version", "int", 1)


@query("tbl_schema_enforce", """
select c_custkey, c_name, c_nationkey::bigint c_nationkey, c_acctbal from customer""")
def tbl_schema_enforce(spark, sf_dir):
    schema = T.StructType.fromDDL("c_custkey bigint, c_nationkey bigint, c_acctbal double, c_name string")
    return ops.enforce_schema(
        table(spark, sf_dir, "customer").select("c_name", "c_acctbal", "c_nationkey", "c_custkey"), schema)


@query("tbl_history", f"""
select 1::bigint as "version", '{V1}.000000' commit_ts, count(*) rows_inserted, 0::bigint rows_updated,
  0::bigint rows_deleted from orders
union all select 2, '{V2}.000000', 0, count(*), 0 from orders where o_orderstatus = 'P'
union all select 3, '{V3}.000000', 0, 0, count(*) from orders where o_orderpriority = '5-LOW'""")
def tbl_history(spark, sf_dir):
    return ops.history(_log(spark, sf_dir))


@query("tbl_version_as_of", f"""
select {ORDER} from (select * replace (case when o_orderstatus = 'P' then 'X' else o_orderstatus end as o_orderstatus)
  from orders) orders""")
def tbl_version_as_of(spark, sf_dir):
    return ops.version_as_of(_log(spark, sf_dir), "o_orderkey", 2)


@query("tbl_timestamp_as_of", f"""
select {ORDER} from (select * replace (case when o_orderstatus = 'P' then 'X' else o_orderstatus end as o_orderstatus)
  from orders where o_orderpriority <> '5-LOW') orders""")
def tbl_timestamp_as_of(spark, sf_dir):
    return ops.timestamp_as_of(_log(spark, sf_dir), "o_orderkey", "2024-07-02 10:00:00")


@query("tbl_cache", """
select o_orderpriority, count(*) n, round(max(o_totalprice), 2) top from orders group by o_orderpriority""")
def tbl_cache(spark, sf_dir):
    name = f"cached_orders_{uuid.uuid4().hex}"
    table(spark, sf_dir, "orders").select("o_orderpriority", "o_totalprice").createTempView(name)
    spark.sql(f"cache table {name}")
    out = spark.table(name).groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.max("o_totalprice"), 2).alias("top"))
    out = spark.createDataFrame(out.collect(), out.schema)  # one row for each priority
    spark.catalog.uncacheTable(name)
    spark.catalog.dropTempView(name)
    return out


CATALOG = ("orders", "customer", "lineitem")


@query("tbl_catalog", " union all ".join(
    f"select 'cat_{t}' table_name, 'EXTERNAL' table_type, (select count(*) from information_schema.columns where table_name = '{t}') "
    f"column_count, (select count(*) from {t}) row_count" for t in CATALOG))
def tbl_catalog(spark, sf_dir):
    """Tables of a schema of its own, listed from the catalog by a pattern that one of them does not fit, with their counts."""
    root = new_path(spark, "catalog")
    schema = "listed_" + root.rsplit("-", 1)[1]
    for t in CATALOG:
        create_if_absent(table(spark, sf_dir, t), f"{schema}.cat_{t}", f"{root}/{t}")
    create_if_absent(table(spark, sf_dir, "nation"), f"{schema}.other_nation", f"{root}/nation")
    listed = catalog_listing(spark, [schema], "cat_*")
    names = [f"{schema}.{r.table_name}" for r in listed.collect()]  # names of the catalog, not rows
    counted = row_counts(spark, [*names, f"{schema}.cat_absent"]).withColumn("table_name", F.substring_index("table_name", ".", -1))
    return listed.join(counted, "table_name").select("table_name", "table_type", "column_count", "row_count")
