"""Every registered query against its SQL counterpart, and the plans they run with."""

import pytest

import __spark_entry__ as entry_point
from workload import ORACLES, QUERIES
from workload.check import compare, database


@pytest.fixture(scope="module")
def con(sf):
    return database(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, con, name):
    out = compare(spark, con, name, sf, QUERIES, ORACLES)
    assert out.startswith("ok" if name in ORACLES else "rows-only"), out


def test_entry_points(spark):
    assert entry_point.entry(spark).count() > 0
    assert entry_point.queries().keys() >= entry_point.oracle_sql().keys()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name,filter_text", [
    ("cdc_high_watermark_extract", "GreaterThan(ts,2024-01-15"),
    ("filter_predicates", "EqualTo(l_returnflag,R)"),
    ("cdc_deleted_keys", "Not(EqualTo(o_orderstatus,F))")])
def test_filters_reach_the_scan(spark, sf, name, filter_text):
    assert filter_text in plan(QUERIES[name](spark, sf))


@pytest.mark.parametrize("name", ["cdc_dedup_latest", "cdc_dedup_composite", "tbl_version_as_of", "mart_sales"])
def test_top_row_per_key_is_cut_before_the_shuffle(spark, sf, name):
    assert plan(QUERIES[name](spark, sf)).count("WindowGroupLimit") >= 2


def test_no_cartesian_or_nested_loop_join(spark, sf):
    for name in QUERIES:
        if name.startswith(("gold_", "mart_", "silver_", "cdc_", "prof_", "text_", "tbl_")):
            text = plan(QUERIES[name](spark, sf))
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_only_needed_columns_are_read(spark, sf):
    text = plan(QUERIES["prof_crosstab"](spark, sf))
    assert "ReadSchema: struct<o_orderstatus:string,o_orderpriority:string>" in text
