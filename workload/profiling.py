"""Table profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnlake.operators import profiling as ops

from .registry import query, table

NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
R = 6


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, R) for c in cols})


@query("prof_describe", " union all ".join(f"""
select '{c}' column_name, count({c}) as "count", round(avg({c}), 6) mean, round(stddev_samp({c}), 6) std,
  round(min({c}), 6) as "min", round(quantile_cont({c}, 0.25), 6) q25, round(quantile_cont({c}, 0.5), 6) q50,
  round(quantile_cont({c}, 0.75), 6) q75, round(max({c}), 6) as "max" from lineitem""" for c in NUMERIC))
def prof_describe(spark, sf_dir):
    return _rounded(ops.describe(table(spark, sf_dir, "lineitem"), NUMERIC),
                    "mean", "std", "min", "q25", "q50", "q75", "max")


@query("prof_histogram", """
with s as (select min(l_extendedprice) lo, max(l_extendedprice) hi, count(*) n from lineitem),
slots as (select least(floor((l_extendedprice - lo) / (hi - lo) * 36), 35)::bigint slot from lineitem, s),
filled as (select slot, count(*) n from slots group by slot)
select e.slot bin, round(s.lo + e.slot * ((s.hi - s.lo) / 36), 6) left_edge, coalesce(f.n, 0) n,
  round(coalesce(f.n, 0) / (s.n * ((s.hi - s.lo) / 36)) * 1000000, 6) density
from (select unnest(range(36)) slot) e left join filled f on e.slot = f.slot, s""")
def prof_histogram(spark, sf_dir):
    h = ops.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 36)
    return _rounded(h.withColumn("density", F.col("density") * 1000000), "left_edge", "density")


@query("prof_value_counts", "select p_brand, count(*) n from part group by p_brand")
def prof_value_counts(spark, sf_dir):
    return ops.value_counts(table(spark, sf_dir, "part"), "p_brand")


@query("prof_relative_freq", """
select o_orderpriority, count(*) n, round(count(*) / sum(count(*)) over (), 6) as "share" from orders
group by o_orderpriority""")
def prof_relative_freq(spark, sf_dir):
    return _rounded(ops.relative_frequency(table(spark, sf_dir, "orders"), "o_orderpriority"), "share")


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
CROSS = "select o_orderstatus, " + ", ".join(
    f"count(*) filter (o_orderpriority = '{p}') as \"{p}\"" for p in PRIORITIES) + " from orders group by o_orderstatus"


@query("prof_crosstab", CROSS)
def prof_crosstab(spark, sf_dir):
    return ops.crosstab(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority", PRIORITIES)


# Customers and segments: most pairs of a customer and a priority do not occur, so zero cells matter.
@query("prof_unpivot", """
select c.o_custkey, p.o_orderpriority, count(o.o_orderkey) as "value"
from (select distinct o_custkey from orders) c cross join (select distinct o_orderpriority from orders) p
left join orders o on o.o_custkey = c.o_custkey and o.o_orderpriority = p.o_orderpriority
group by 1, 2""")
def prof_unpivot(spark, sf_dir):
    wide = ops.crosstab(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority", PRIORITIES)
    return ops.stack(wide, "o_custkey", "o_orderpriority")


@query("prof_box_stats", """
with q as (select l_returnflag, count(*) n, quantile_cont(l_extendedprice, 0.25) q1, quantile_cont(l_extendedprice, 0.5) med,
  quantile_cont(l_extendedprice, 0.75) q3 from lineitem group by l_returnflag)
select l.l_returnflag, max(n) n, round(max(q1), 6) q1, round(max(med), 6) as "median", round(max(q3), 6) q3,
  round(min(l_extendedprice) filter (l_extendedprice between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)), 6) whisker_low,
  round(max(l_extendedprice) filter (l_extendedprice between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)), 6) whisker_high,
  count(*) filter (l_extendedprice not between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) outliers
from lineitem l join q on l.l_returnflag = q.l_returnflag group by l.l_returnflag""")
def prof_box_stats(spark, sf_dir):
    return _rounded(ops.box_stats(table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_returnflag"),
                    "q1", "median", "q3", "whisker_low", "whisker_high")
