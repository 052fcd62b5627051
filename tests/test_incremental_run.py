from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tarnlake.plans import incremental_run
from tarnlake.plans.silver import SilverTable
from tarnlake.sources import jdbc, schemas, scratch, tables

from .conftest import rows

SPEC = SilverTable(("k",), lambda df: df)


def at():
    return F.to_timestamp(F.lit("2024-06-01 00:00:00"))


def staging(spark, *day_rows):
    return spark.createDataFrame([(k, datetime(2024, 1, d), v) for k, d, v in day_rows], "k int, _ingested_at timestamp, v string")


@pytest.fixture
def lake(spark):
    root = scratch.new_path(spark, "lake")
    return incremental_run.Lake("lake_" + root.rsplit("-", 1)[1], root)


def test_runs_merge_mark_and_register(spark, lake):
    one = incremental_run.run(lake, "t", staging(spark, (1, 10, "a"), (2, 12, "b"), (2, 15, "c")), "v1", at(), SPEC)
    assert rows(one) == [(2, 0)]
    assert incremental_run.stored_mark(spark, lake, "t") == datetime(2024, 1, 15)
    # newer rows, and one older than the mark, which is left alone; key 1 has left the source
    keys = spark.createDataFrame([(2,), (3,)], "k int")
    two = incremental_run.run(lake, "t", staging(spark, (2, 16, "d"), (3, 16, "e"), (1, 11, "old")), "v2", at(), SPEC, keys)
    assert rows(two) == [(1, 1)]
    assert rows(spark.table(lake.table("t")), "k", "v", "is_active") == [(1, "a", False), (2, "d", True), (3, "e", True)]
    # nothing new: neither the table nor the mark moves
    incremental_run.run(lake, "t", staging(spark, (1, 3, "z")), "v3", at(), SPEC)
    assert incremental_run.stored_mark(spark, lake, "t") == datetime(2024, 1, 16)
    assert spark.table(lake.table("t")).count() == 3
    incremental_run.run(lake, "u", staging(spark, (1, 1, "x")), "v1", at(), SPEC)
    assert rows(spark.table(lake.jobs), "job_id", "job_name") == [(1, "t"), (2, "u")]
    assert rows(spark.table(lake.marks), "asset_key") == [("t",), ("u",)]
    listed = tables.catalog_listing(spark, [lake.schema], "clean_*")
    assert rows(listed, "schema_name", "table_name") == [(lake.schema, "clean_t"), (lake.schema, "clean_u")]


def test_staging_by_registry(spark):
    src = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 2, 1))], "customer_id int, last_update timestamp")
    assert rows(incremental_run.stage("customer", src, "2024-01-15 00:00:00", "r", at()), "customer_id", "_job_run_id") == [(2, "r")]
    assert incremental_run.stage("customer", src, None, "r", at()).count() == 2
    with pytest.raises(ValueError, match="not registered"):
        incremental_run.stage("nothing", src, None, "r", at())


def test_composite_keys_are_projected_column_by_column():
    spec = schemas.TABLES["order_item"]
    assert jdbc.keys_query(spec.source_table, spec.source_key, spec.keys) == (
        "(SELECT order_id AS order_id, order_item_id AS order_item_id FROM order_items) t")
    with pytest.raises(ValueError):
        jdbc.keys_query("t", ["a", "b"], "k")
