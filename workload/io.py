"""Sources and sinks; written tables go to the shared folder of the session."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake.operators.profiling import observed, output_profile
from tarnlake.sources import files, rejects, tables
from tarnlake.sources.scratch import new_path

from .registry import day, query, stamp, table

ITEM = f"""l_orderkey, l_partkey, l_suppkey, l_linenumber::bigint l_linenumber, l_quantity, l_extendedprice, l_discount,
  l_tax, l_returnflag, l_linestatus, {stamp("l_shipdate")} l_shipdate"""
ORDER = f"o_orderkey, o_custkey, o_orderstatus, o_totalprice, {day('o_orderdate')} o_orderdate, o_orderpriority"


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def _name(prefix: str, path: str) -> str:
    return prefix + path.rsplit("-", 1)[1][:12]


@query("io_parquet_roundtrip", f"""
select {ITEM} from (select * replace (case when l_returnflag = 'R' then 0 else l_tax end as l_tax) from lineitem) l""")
def io_parquet_roundtrip(spark, sf_dir):
    """Partitioned write, then only partition R is replaced."""
    items = table(spark, sf_dir, "lineitem")
    path = new_path(spark, "lineitem")
    files.write_parquet(items, path, partition_by=["l_returnflag"])
    again = items.where("l_returnflag = 'R'").withColumn("l_tax", F.lit(0.0))
    files.write_parquet(again, path, partition_by=["l_returnflag"])
    return files.read_parquet(spark, path, items.schema)


@query("io_csv_load", f"select {ORDER} from orders")
def io_csv_load(spark, sf_dir):
    o = _orders(spark, sf_dir)
    path = new_path(spark, "orders-csv")
    o.write.options(header=True, quoteAll=True, escape='"').csv(path)
    return files.read_csv(spark, path, o.schema)


@query("io_csv_rejects", f"""
with marked as (select *, o_orderstatus = 'P' and o_totalprice > 200000 broken from orders)
select {ORDER}, null reason, count(*) filter (broken) over () n_rejects, count(*) filter (not broken) over () n_good
  from marked orders qualify not broken
union all
select null, null, null, null, null, o_orderkey || ',' || o_custkey || ',P,unknown,' || {day('o_orderdate')} || ',' || o_orderpriority,
  'line does not fit the schema', count(*) filter (broken) over (), count(*) filter (not broken) over () from marked qualify broken""")
def io_csv_rejects(spark, sf_dir):
    """A file whose large pending orders have no number as their price: these lines are kept apart with their text."""
    o = _orders(spark, sf_dir)
    broken = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 200000)
    source = new_path(spark, "orders-csv")
    price = F.when(broken, "unknown").otherwise(F.col("o_totalprice").cast("string"))
    o.withColumn("o_totalprice", price).write.options(header=True, escape='"').csv(source)
    found = rejects.load_csv(spark, source, o.schema, new_path(spark, "orders"))
    # the text of a rejected line stands in the last column here
    bad = found.rejects.select(F.col(rejects.CORRUPT).alias("o_orderpriority"), F.col(rejects.REASON).alias("reason"))
    return found.good.unionByName(bad, allowMissingColumns=True).withColumns(
        {"n_rejects": F.lit(found.n_rejects), "n_good": F.lit(found.n_good)})


@query("io_table_scan", f"select {ORDER} from orders where o_orderstatus = 'F'")
def io_table_scan(spark, sf_dir):
    path = new_path(spark, "scan")
    name = _name("scan_orders_", path)
    tables.create_if_absent(_orders(spark, sf_dir), name, path)
    return spark.table(name).where("o_orderstatus = 'F'")


@query("io_ctas", "select c_custkey, c_name, c_acctbal from customer where c_acctbal > 0")
def io_ctas(spark, sf_dir):
    """Create when absent; the second call finds the table and leaves it alone."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = new_path(spark, "ctas")
    name = "tarnlake_gold." + _name("dim_", path)
    tables.create_if_absent(c.where("c_acctbal > 0"), name, path)
    tables.create_if_absent(c, name, path + "-unused")
    return spark.table(name)


@query("io_append_merge_schema", """
select c_custkey, c_name, null::double c_acctbal from customer where c_mktsegment = 'BUILDING'
union all select c_custkey, c_name, c_acctbal from customer where c_mktsegment <> 'BUILDING'""")
def io_append_merge_schema(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    path = new_path(spark, "stg-customer")
    tables.append_merge_schema(c.where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name"), path)
    tables.append_merge_schema(c.where("c_mktsegment <> 'BUILDING'").select("c_custkey", "c_name", "c_acctbal"), path)
    return tables.read_history(spark, path)


@query("io_load_modes", f"""
with late as (select * replace ('X' as o_orderstatus) from orders where o_orderdate >= timestamp '2000-01-01')
select 'staging' kind, {ORDER}, null source_file from orders
union all select 'staging' kind, {ORDER}, 'late' from late orders
union all select 'clean' kind, {ORDER}, null from (select * from orders where o_orderdate < timestamp '2000-01-01'
  union all select * from late) orders""")
def io_load_modes(spark, sf_dir):
    """First loads create; the second load is appended to staging and merged into the clean table."""
    o = _orders(spark, sf_dir)
    late = o.where("o_orderdate >= date'2000-01-01'").withColumn("o_orderstatus", F.lit("X"))
    root = new_path(spark, "modes")
    stg = tables.TableTarget(_name("stg_orders_", root), root)
    clean = tables.TableTarget(_name("clean_orders_", root), root, ("o_orderkey",), buckets=16)
    tables.write_table(o, stg, "v1")
    tables.write_table(late.withColumn("source_file", F.lit("late")), stg, "v2")
    tables.write_table(o, clean, "v1")
    tables.write_table(late, clean, "v2")
    return spark.table(stg.name).withColumn("kind", F.lit("staging")).unionByName(
        tables.read_table(spark, clean).withColumn("kind", F.lit("clean")), allowMissingColumns=True)


@query("io_output_profile", f"""
select count(*) row_count, 6::bigint column_count,
  'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' as "columns",
  count(*) observed_rows from orders""")
def io_output_profile(spark, sf_dir):
    """The row count is observed while the table is written, and read again from the written table."""
    df, seen = observed(table(spark, sf_dir, "orders"))
    path = new_path(spark, "profile")
    files.write_parquet(df, path)
    rows = seen.get["row_count"]
    return output_profile(files.read_parquet(spark, path)).withColumn("observed_rows", F.lit(rows))
