"""Incremental load, merge and delete sync."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.operators import incremental as inc
from tarnlake.operators import merge
from tarnlake.plans import incremental_run
from tarnlake.plans.incremental_run import Lake
from tarnlake.plans.silver import SilverTable, silver_step
from tarnlake.operators.cleaning import drop_incomplete
from tarnlake.sources.buckets import BucketedTable
from tarnlake.sources.scratch import new_path
from tarnlake.sources import rejects
from tarnlake.streaming.merge import StreamMerge
from tarnlake.streaming.staging import load_new, read_new_files

from .proxies import ctes, proxy
from .registry import day, query, stamp, table

CUT = "2024-01-15 00:00:00"
NOW = "2024-06-01 12:00:00"


def _at(text: str):
    return F.to_timestamp_ntz(F.lit(text))


EVENT = f"event_id, {stamp('ts')} ts, user_id, event_type, value, props"


@query("cdc_high_watermark_extract", f"select {EVENT} from events where events.ts > timestamp '{CUT}'")
def cdc_high_watermark_extract(spark, sf_dir):
    return inc.extract_newer(table(spark, sf_dir, "events"), "ts", CUT)[0]


@query("cdc_staging_filter", f"""
select {EVENT}, 'with' part from events where events.ts > timestamp '{CUT}'
union all select {EVENT}, 'without' part from events""")
def cdc_staging_filter(spark, sf_dir):
    """With the watermark column, given as text, and without it: the second loads everything."""
    e = table(spark, sf_dir, "events")
    text = e.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    some = inc.staging_filter(text, "ts", CUT).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    every = inc.staging_filter(e, "last_update", CUT)
    return some.withColumn("part", F.lit("with")).unionByName(every.withColumn("part", F.lit("without")))


@query("cdc_new_watermark", f"""
select 'batch' part, {stamp("coalesce(max(ts), timestamp '" + CUT + "')")} watermark_value from events
where ts > timestamp '{CUT}'
union all select 'empty', {stamp("coalesce(max(ts), timestamp '2030-01-01')")} from events
where ts > timestamp '2030-01-01'""")
def cdc_new_watermark(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    late = "2030-01-01 00:00:00"
    batch = inc.new_watermark(inc.newer_than(e, "ts", CUT), "ts", CUT)
    empty = inc.new_watermark(inc.newer_than(e, "ts", late), "ts", late)
    return batch.withColumn("part", F.lit("batch")).unionByName(empty.withColumn("part", F.lit("empty")))


def _store(spark, sf_dir):
    """Watermark store with one asset per event type."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("event_type").alias("asset_key")).agg(F.max("ts").alias("watermark_value")).withColumn(
        "last_updated", _at("2024-01-01 00:00:00"))


STORE = """store as (select event_type asset_key, max(ts) watermark_value, timestamp '2024-01-01' last_updated
  from events group by event_type)"""


@query("cdc_watermark_get", f"""
with {STORE} select 'click' asset_key, {stamp("max(store.watermark_value)")} watermark_value from store
  where asset_key = 'click'
union all select 'absent', '1900-01-01 00:00:00.000000'""")
def cdc_watermark_get(spark, sf_dir):
    s = _store(spark, sf_dir)
    return inc.get_watermark(s, "click").unionByName(inc.get_watermark(s, "absent"))


@query("cdc_watermark_upsert", f"""
with {STORE}, fresh as (select case when event_type = 'click' then 'orders' else event_type end asset_key,
    max(ts) + interval 1 day watermark_value, timestamp '{NOW}' last_updated from events
    where event_type in ('click', 'view') group by 1)
select asset_key, {stamp("u.watermark_value")} watermark_value, {stamp("u.last_updated")} last_updated from (
  select * from store where asset_key not in (select asset_key from fresh) union all select * from fresh) u""")
def cdc_watermark_upsert(spark, sf_dir):
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view"))
    name = F.when(F.col("event_type") == "click", "orders").otherwise(F.col("event_type"))
    fresh = e.groupBy(name.alias("asset_key")).agg(
        (F.max("ts") + F.expr("interval 1 day")).alias("watermark_value")).withColumn("last_updated", _at(NOW))
    return merge.upsert(_store(spark, sf_dir), fresh, "asset_key")


@query("cdc_audit_columns", f"select {EVENT}, '{NOW}.000000' _ingested_at, 'run7' _job_run_id from events")
def cdc_audit_columns(spark, sf_dir):
    return inc.add_audit_columns(table(spark, sf_dir, "events"), "run7", _at(NOW))


@query("cdc_dedup_latest", f"""
select {EVENT} from (select *, row_number() over (partition by user_id order by ts desc, event_id, event_type, value,
  props) rn from events where ts > timestamp '{CUT}') e where rn = 1""")
def cdc_dedup_latest(spark, sf_dir):
    return inc.dedup_latest(table(spark, sf_dir, "events"), "user_id", "ts", CUT)


ITEM = f"""l_orderkey, l_partkey, l_suppkey, l_linenumber::bigint l_linenumber, l_quantity, l_extendedprice, l_discount,
  l_tax, l_returnflag, l_linestatus, {stamp("l_shipdate")} l_shipdate"""


@query("cdc_dedup_composite", f"""
select {ITEM} from (select *, row_number() over (partition by l_orderkey, l_linenumber
  order by l_shipdate desc, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
    l_linestatus) rn from lineitem) l where rn = 1""")
def cdc_dedup_composite(spark, sf_dir):
    return inc.dedup_latest(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


# The current table holds the orders before 2000, the batch everything since 1998 with a new status.
ORDER = f"o_orderkey, o_custkey, o_orderstatus, o_totalprice, {day('o_orderdate')} o_orderdate, o_orderpriority"
TARGET = """tgt as (select * replace (cast(o_orderdate as date) as o_orderdate) from orders
  where o_orderdate < timestamp '2000-01-01'),
src as (select * replace (cast(o_orderdate as date) as o_orderdate, 'X' as o_orderstatus) from orders
  where o_orderdate >= timestamp '1998-01-01')"""


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders")


def _dated(df):
    return df.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def _target(spark, sf_dir):
    return _dated(_orders(spark, sf_dir).where(F.col("o_orderdate") < _at("2000-01-01 00:00:00")))


def _source(spark, sf_dir):
    return _dated(_orders(spark, sf_dir).where(F.col("o_orderdate") >= _at("1998-01-01 00:00:00"))).withColumn(
        "o_orderstatus", F.lit("X"))


@query("cdc_merge_metrics", f"""
with {TARGET} select count(*) filter (o_orderkey not in (select o_orderkey from tgt)) inserts,
  count(*) filter (o_orderkey in (select o_orderkey from tgt)) updates from src""")
def cdc_merge_metrics(spark, sf_dir):
    return inc.merge_metrics(_source(spark, sf_dir), _target(spark, sf_dir), "o_orderkey")


@query("cdc_upsert", f"""
with {TARGET} select {ORDER} from (select * from tgt where o_orderkey not in (select o_orderkey from src)
  union all select * from src) orders""")
def cdc_upsert(spark, sf_dir):
    return merge.upsert(_target(spark, sf_dir), _source(spark, sf_dir), "o_orderkey")


@query("cdc_upsert_partial", f"""
with {TARGET}, part as (select o_orderkey, o_orderstatus from src)
select {ORDER} from (
  select t.* replace (coalesce(s.o_orderstatus, t.o_orderstatus) as o_orderstatus)
  from tgt t left join part s on t.o_orderkey = s.o_orderkey
  union all select o_orderkey, null, o_orderstatus, null, null, null from part
  where o_orderkey not in (select o_orderkey from tgt)) orders""")
def cdc_upsert_partial(spark, sf_dir):
    """A source with two columns only: matched rows keep the others, inserted rows get nulls."""
    return merge.upsert(_target(spark, sf_dir), _source(spark, sf_dir).select("o_orderkey", "o_orderstatus"),
                        "o_orderkey")


ITEM_DEDUP = """items as (select * exclude (rn) from (select *, row_number() over (partition by l_orderkey, l_linenumber
  order by l_shipdate desc, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
    l_linestatus) rn from lineitem) where rn = 1),
tgt as (select * from items where l_shipdate < timestamp '2000-01-01'),
src as (select * replace (cast(0 as double) as l_quantity) from items where l_shipdate >= timestamp '1998-01-01')"""


@query("cdc_upsert_composite", f"""
with {ITEM_DEDUP} select {ITEM} from (select t.* from tgt t where not exists (select 1 from src s
    where s.l_orderkey = t.l_orderkey and s.l_linenumber = t.l_linenumber)
  union all select * from src) u""")
def cdc_upsert_composite(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber"]
    items = inc.dedup_latest(table(spark, sf_dir, "lineitem"), keys, "l_shipdate")
    old = items.where(F.col("l_shipdate") < _at("2000-01-01 00:00:00"))
    new = items.where(F.col("l_shipdate") >= _at("1998-01-01 00:00:00")).withColumn("l_quantity", F.lit(0.0))
    return merge.upsert(old, new, keys)


@query("cdc_bucket_merge", f"""
with {TARGET} select {ORDER} from (select * from tgt where o_orderkey not in (select o_orderkey from src)
  union all select * from src) orders""")
def cdc_bucket_merge(spark, sf_dir):
    """The upsert into a table of buckets, in two batches: of large orders, then of the rest."""
    t = BucketedTable(new_path(spark, "orders-buckets"), ("o_orderkey",), 32)
    t.create(_target(spark, sf_dir))
    source = _source(spark, sf_dir)
    t.merge(source.where("o_totalprice > 400000"))
    t.merge(source.where("not coalesce(o_totalprice > 400000, false)"))
    return t.read(spark)


# The source lost its low-priority orders.
REMAINING = "o_orderpriority <> '5-LOW'"


@query("cdc_deleted_keys", f"""
select o_orderkey from orders where o_orderstatus <> 'F' and o_orderkey not in
  (select o_orderkey from orders where {REMAINING})""")
def cdc_deleted_keys(spark, sf_dir):
    o = _orders(spark, sf_dir)
    target = o.withColumn("is_active", F.col("o_orderstatus") != "F")
    return merge.deleted_keys(target, o.where(REMAINING), "o_orderkey")


@query("cdc_soft_delete", f"""
select {ORDER}, {REMAINING} and o_orderstatus <> 'F' is_active,
  case when not ({REMAINING}) and o_orderstatus <> 'F' then '{NOW}.000000' else '2024-01-01 00:00:00.000000' end
    _ingested_at
from orders""")
def cdc_soft_delete(spark, sf_dir):
    o = _orders(spark, sf_dir)
    target = _dated(o).withColumns({"is_active": F.col("o_orderstatus") != "F",
                                    "_ingested_at": _at("2024-01-01 00:00:00")})
    return merge.soft_delete(target, o.where(REMAINING), "o_orderkey", _at(NOW))


@query("cdc_bucket_soft_delete", f"""
with gone as (select max(o_orderkey) k from orders where o_orderstatus <> 'F')
select {ORDER}, o_orderkey <> k and o_orderstatus <> 'F' is_active,
  case when o_orderkey = k then '{NOW}.000000' else '2024-01-01 00:00:00.000000' end _ingested_at, 1::bigint replaced
from orders, gone""")
def cdc_bucket_soft_delete(spark, sf_dir):
    """The source lost one order: its bucket alone is compared key by key and replaced."""
    target = _dated(_orders(spark, sf_dir)).withColumns({"is_active": F.col("o_orderstatus") != "F",
                                                         "_ingested_at": _at("2024-01-01 00:00:00")})
    t = BucketedTable(new_path(spark, "orders-buckets"), ("o_orderkey",), 32)
    t.create(target)
    active = _orders(spark, sf_dir).where("o_orderstatus <> 'F'").select("o_orderkey")
    top = active.agg(F.max("o_orderkey")).scalar()
    replaced = t.soft_delete(active.where(F.col("o_orderkey") != top), _at(NOW))
    return t.read(spark).withColumn("replaced", F.lit(len(replaced)))


@query("cdc_add_active_flag", f"select {ORDER}, true is_active from orders")
def cdc_add_active_flag(spark, sf_dir):
    return merge.with_active_flag(_dated(_orders(spark, sf_dir)))


@query("cdc_merge_report", f"""
with {TARGET} select
  (select count(*) from src where o_orderkey not in (select o_orderkey from tgt)) rows_inserted,
  (select count(*) from tgt where o_orderkey in (select o_orderkey from src)) rows_updated,
  (select count(*) from tgt where o_orderkey not in (select o_orderkey from src)) rows_unchanged,
  (select count(*) from tgt where not ({REMAINING})) rows_deleted""")
def cdc_merge_report(spark, sf_dir):
    target = _target(spark, sf_dir)
    gone = merge.deleted_keys(target, _orders(spark, sf_dir).where(REMAINING), "o_orderkey")
    return merge.merge_report(target, _source(spark, sf_dir), "o_orderkey", gone)


# Job definitions from the customer table: one per market segment and nation.
JOB_COLS = "source, target_table, merge_key, load_mode, schedule, owner, description"


def _jobs(spark, sf_dir, mode):
    c = table(spark, sf_dir, "customer")
    return c.groupBy(F.concat(F.lit("job_"), F.col("c_nationkey").cast("string")).alias("job_name"),
                     F.col("c_mktsegment").alias("layer")).agg(
        F.max("c_name").alias("source"), F.min("c_name").alias("target_table"), F.lit("k").alias("merge_key"),
        F.lit(mode).alias("load_mode"), F.lit("daily").alias("schedule"), F.lit("team").alias("owner"),
        F.count(F.lit(1)).cast("string").alias("description"))


@query("cdc_job_registry", f"""
with jobs as (select 'job_' || c_nationkey job_name, c_mktsegment layer, max(c_name) source, min(c_name) target_table,
    'k' merge_key, 'daily' schedule, 'team' owner, count(*)::varchar description from customer group by 1, 2),
known as (select *, row_number() over (order by job_name, layer) job_id from jobs where layer <> 'BUILDING'),
fresh as (select * from jobs where layer <> 'FURNITURE')
select coalesce(k.job_id, (select max(job_id) from known) + row_number() over (partition by k.job_id is null
    order by f.job_name, f.layer)) job_id,
  coalesce(k.job_name, f.job_name) job_name, coalesce(k.layer, f.layer) layer,
  coalesce(f.source, k.source) source, coalesce(f.target_table, k.target_table) target_table, 'k' merge_key,
  case when f.job_name is null then 'append' else 'upsert' end load_mode, 'daily' schedule, 'team' as "owner",
  coalesce(f.description, k.description) description,
  case when k.job_id is null then '{NOW}.000000' else '2024-01-01 00:00:00.000000' end created_at,
  case when f.job_name is null then '2024-01-01 00:00:00.000000' else '{NOW}.000000' end updated_at
from known k full outer join fresh f on k.job_name = f.job_name and k.layer = f.layer""")
def cdc_job_registry(spark, sf_dir):
    first = _jobs(spark, sf_dir, "append").where(F.col("layer") != "BUILDING")
    empty = first.limit(0).select(F.lit(0).cast("bigint").alias("job_id"), "*",
                                  _at(NOW).alias("created_at"), _at(NOW).alias("updated_at"))
    known = merge.register_jobs(empty, first, _at("2024-01-01 00:00:00"))
    fresh = _jobs(spark, sf_dir, "upsert").where(F.col("layer") != "FURNITURE")
    return merge.register_jobs(known, fresh, _at(NOW))


@query("cdc_silver_step", f"""
with src as (select *, case when value > 90 then null else event_type end kind from events),
batch as (select user_id, event_id, ts, kind, value, true is_active from (
  select *, row_number() over (partition by user_id order by ts desc, event_id, kind, value) rn
  from src where ts > timestamp '{CUT}') where rn = 1 and kind is not null),
tgt as (select user_id, event_id, ts, kind, value, true is_active from (
  select *, row_number() over (partition by user_id order by ts desc, event_id, kind, value) rn
  from src where ts <= timestamp '{CUT}') where rn = 1),
left_over as (select distinct user_id from events where event_type = 'click' and value < 5),
synced as (select t.* replace (case when user_id in (select user_id from left_over) then ts
    else timestamp '{NOW}' end as ts, user_id in (select user_id from left_over) as is_active) from tgt t)
select user_id, event_id, {stamp("u.ts")} ts, kind, value, is_active from (
  select * from synced where user_id not in (select user_id from batch) union all select * from batch) u""")
def cdc_silver_step(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    kind = F.when(F.col("value") > 90, None).otherwise(F.col("event_type")).alias("kind")
    staging = e.select("user_id", "event_id", "ts", kind, "value")
    old = staging.where(F.col("ts") <= _at(CUT))
    target = merge.with_active_flag(inc.latest_per_key(old, "user_id", "ts"))
    left_over = e.where((F.col("event_type") == "click") & (F.col("value") < 5)).select("user_id")
    step = silver_step(staging, target, "user_id", drop_incomplete, watermark=CUT, watermark_col="ts",
                       source_keys=left_over, deleted_at=_at(NOW))
    return step.table


@query("cdc_stream_staging", f"select {EVENT}, '{NOW}.000000' _ingested_at, 'run1' _job_run_id from events")
def cdc_stream_staging(spark, sf_dir):
    """The staging load as a stream; a second run over the same files adds nothing."""
    schema = table(spark, sf_dir, "events").schema
    target, checkpoint = new_path(spark, "stream-staging"), new_path(spark, "stream-checkpoint")
    for _ in range(2):
        new = read_new_files(spark, f"{sf_dir}/events.parquet", schema)
        load_new(new, target, checkpoint, "run1", _at(NOW))
    return spark.read.parquet(target)


@query("cdc_stream_merge", f"""
with latest as (select user_id, event_id, ts, event_type, value, row_number() over (partition by user_id
  order by ts desc, event_id, event_type, value) rn from events where value > 5)
select user_id, event_id, {stamp("ts")} ts, event_type, value, true is_active,
  (select {stamp("max(ts)")} from events where value > 5) mark, false replay_merged
from latest where rn = 1""")
def cdc_stream_merge(spark, sf_dir):
    """Files of events, a micro-batch each, merged as a stream; then the first batch comes again with other rows."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    root = new_path(spark, "stream-merge")
    e.repartitionByRange(4, "ts").write.parquet(f"{root}/events")
    merge_ = StreamMerge(BucketedTable(f"{root}/table", ("user_id",), 8), f"{root}/control", "event", "ts",
                         lambda df: df, ["event_id", "event_type", "value"])
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/events").where("value > 5")
    merge_.run(stream, f"{root}/checkpoint", _at(NOW))
    again = merge_.apply(e.withColumn("value", F.lit(-1.0)), 0, _at(NOW))
    mark = merge_.done(spark)[1]
    return merge_.table.read(spark).withColumns({"mark": F.lit(mark).cast("timestamp_ntz"), "replay_merged": F.lit(again)})


@query("cdc_staging_rejects", f"""
with bad as (select *, event_type = 'click' and value < 5 broken from events)
select {EVENT}, null reason, null mark, count(*) filter (broken) over () n_rejects, count(*) filter (not broken) over () n_good
  from bad events qualify not broken
union all
select {EVENT.replace(stamp('ts') + ' ts', 'null ts')}, 'ts is no timestamp', 'at ' || {stamp('ts')},
  count(*) filter (broken) over () n_rejects, count(*) filter (not broken) over () n_good
  from bad events qualify broken""")
def cdc_staging_rejects(spark, sf_dir):
    """Marks of cheap clicks are no timestamps: these rows are kept apart and counted, the others staged."""
    e = table(spark, sf_dir, "events")
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    broken = (F.col("event_type") == "click") & (F.col("value") < 5)
    marked = e.withColumn("ts", F.when(broken, F.concat(F.lit("at "), text)).otherwise(text))
    found = rejects.load_marks(marked, "ts", new_path(spark, "staged"))
    good = found.good.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    bad = found.rejects.withColumns({"mark": F.col("ts"), "ts": F.lit(None).cast("string")}).withColumnRenamed(rejects.REASON, "reason")
    return good.unionByName(bad, allowMissingColumns=True).withColumns(
        {"n_rejects": F.lit(found.n_rejects), "n_good": F.lit(found.n_good)})


LATEST = """select user_id, event_id, ts, event_type, value, row_number() over (partition by user_id
  order by ts desc, event_id, event_type, value) rn from events"""


def _lake(spark):
    root = new_path(spark, "lake")
    return Lake("lake_" + root.rsplit("-", 1)[1], root)


@query("cdc_incremental_run", f"""
with latest as ({LATEST}), mark as (select {stamp("max(ts)")} mark from events)
select user_id, event_id, {stamp("ts")} ts, event_type, value, mark, 3::bigint runs, true registered_once
from latest, mark where rn = 1""")
def cdc_incremental_run(spark, sf_dir):
    """Three runs: up to a day, everything, and a late batch older than the mark, which changes neither table nor mark."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    lake, spec = _lake(spark), SilverTable(("user_id",), lambda df: df, delete_sync=False)
    early = e.where(F.col("ts") <= _at(CUT))
    old = e.where(F.col("ts") <= _at("2024-01-05 00:00:00")).withColumn("value", F.lit(-1.0))
    seen = []
    for k, staging in enumerate((early, e, old)):
        incremental_run.run(lake, "event", staging, f"v{k}", _at(NOW), spec, watermark_col="ts",
                            ties=["event_id", "event_type", "value"])
        seen.append(incremental_run.stored_mark(spark, lake, "event"))
    if seen != sorted(seen):
        raise AssertionError(f"the mark went back: {seen}")
    marks, jobs = spark.table(lake.marks), spark.table(lake.jobs)
    one = marks.select(F.date_format("watermark_value", "yyyy-MM-dd HH:mm:ss.SSSSSS")).scalar()
    once = (jobs.agg(F.count(F.lit(1))).scalar() == 1)
    return spark.table(lake.table("event")).where("is_active").drop("is_active").withColumns(
        {"mark": one, "runs": F.lit(len(seen)), "registered_once": once})


STAGED = {"customer": "p_customer", "seller": "p_seller", "product": "p_product", "order": "p_order",
          "order_item": "p_order_item", "payment": "p_payment", "order_review": "p_order_review",
          "product_category": "p_category", "geolocation": "p_geolocation"}


#: When a proxy's row was last changed, and a number that all its columns go into; both valid in Spark SQL and DuckDB.
CHANGED = {"customer": "customer_zip_code_prefix % 30", "seller": "seller_zip_code_prefix % 30", "product": "product_photos_qty % 30",
           "order": "length(order_status) + customer_id % 28", "order_item": "order_item_id * 4", "payment": "payment_sequential * 10",
           "order_review": "review_score * 5", "product_category": "length(product_category_name) * 3", "geolocation": "geolocation_zip_code_prefix"}
_LEN = "length(coalesce({}, ''))"
_DAYS = "coalesce(datediff({0}, date '1990-01-01'), 0)"
DIGEST = {
    "customer": ["customer_id", "customer_zip_code_prefix", *map(_LEN.format, ("customer_unique_id", "customer_city", "customer_state"))],
    "seller": ["seller_id", "seller_zip_code_prefix", *map(_LEN.format, ("seller_city", "seller_state"))],
    "product": ["product_id", _LEN.format("product_category_name"), "product_name_length", "product_description_length", "product_photos_qty",
                "coalesce(product_weight_g, 0)", "product_length_cm", "product_height_cm", "product_width_cm"],
    "order": ["order_id", "customer_id", _LEN.format("order_status"), *map(_DAYS.format, (
        "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
        "order_estimated_delivery_date"))],
    "order_item": ["order_id", "order_item_id", "product_id", "seller_id", _DAYS.format("shipping_limit_date"), "price", "freight_value"],
    "payment": ["order_id", "payment_sequential", _LEN.format("payment_type"), "payment_installments", "payment_value"],
    "order_review": ["review_id", "order_id", "review_score", *map(_LEN.format, ("review_comment_title", "review_comment_message")),
                     _DAYS.format("review_creation_date")],
    "product_category": [_LEN.format("product_category_name"), _LEN.format("product_category_name_english")],
    "geolocation": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", *map(_LEN.format, ("geolocation_city", "geolocation_state"))],
}


def _digest(name: str) -> str:
    return "round(sum(cast(" + " + ".join(f"{i + 1} * ({e})" for i, e in enumerate(DIGEST[name])) + " as double)), 2)"


def _sql_digest(name: str) -> str:
    return _digest(name).replace("datediff(", "datediff('day', date '1990-01-01', ").replace(", date '1990-01-01'), 0)", "), 0)")


def _changed(name: str) -> str:
    return f"date '2024-01-01' + cast({CHANGED[name]} as int)"


@query("cdc_stage_tables", f"with {ctes(*STAGED.values())} " + " union all ".join(
    f"select '{name}' table_name, count(*) n_rows, {_sql_digest(name)} digest, {stamp(f'max({_changed(name)})')} newest, 'run9' run, "
    f"'{NOW}.000000' ingested_at from {proxy_name} where {_changed(name)} > timestamp '{CUT}'"
    for name, proxy_name in STAGED.items()))
def cdc_stage_tables(spark, sf_dir):
    """All nine source tables, with a mark that some rows are newer than, staged by the registry; a digest of all their columns."""
    parts = []
    for name, proxy_name in STAGED.items():
        source = proxy(spark, sf_dir, proxy_name).withColumn("last_update", F.expr(_changed(name)).cast("timestamp_ntz"))
        staged = incremental_run.stage(name, source, CUT, "run9", _at(NOW))
        parts.append(staged.groupBy(F.lit(name).alias("table_name"), F.col("_job_run_id").alias("run"),
                                    F.col("_ingested_at").alias("ingested_at")).agg(
            F.count(F.lit(1)).alias("n_rows"), F.expr(_digest(name)).alias("digest"), F.max("last_update").alias("newest")))
    return reduce(DataFrame.unionByName, parts)


@query("cdc_silver_metrics", f"""
with mine as (select *, ts > timestamp '{CUT}' fresh from events),
batch as (select distinct user_id from mine where fresh), tgt as (select distinct user_id from mine where not fresh)
select (select count(*) from batch where user_id not in (select user_id from tgt)) inserts,
  (select count(*) from batch where user_id in (select user_id from tgt)) updates,
  (select {stamp("max(ts)")} from events) watermark_value, '2030-01-01 00:00:00.000000' mark_of_old_rows""")
def cdc_silver_metrics(spark, sf_dir):
    """Counts and mark of a step, and the mark of one whose rows are all older than the stored mark."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    target = inc.latest_per_key(e.where(F.col("ts") <= _at(CUT)), "user_id", "ts")
    step = silver_step(e, merge.with_active_flag(target), "user_id", lambda df: df, watermark=CUT, watermark_col="ts")
    late = silver_step(e, None, "user_id", lambda df: df, watermark="2030-01-01 00:00:00", watermark_col="ts")
    return step.metrics.withColumns({"watermark_value": step.watermark.scalar(),
                                     "mark_of_old_rows": late.watermark.scalar()})
