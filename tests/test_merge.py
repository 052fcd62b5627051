from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnlake.operators import merge
from tarnlake.plans.silver import silver_step

from .conftest import rows

T = "k int, v string, n int"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "n", 3)], T)


def test_upsert_updates_inserts_and_never_matches_null(spark, target):
    src = spark.createDataFrame([(2, "B", 20), (5, "e", 50), (None, "m", 9)], T)
    assert rows(merge.upsert(target, src, "k")) == [
        (None, "m", 9), (None, "n", 3), (1, "a", 1), (2, "B", 20), (5, "e", 50)]


def test_upsert_composite_key(spark):
    t = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "a int, b int, v string")
    s = spark.createDataFrame([(1, 2, "B"), (2, 1, "c")], "a int, b int, v string")
    assert rows(merge.upsert(t, s, ["a", "b"])) == [(1, 1, "a"), (1, 2, "B"), (2, 1, "c")]


def test_source_without_a_column_keeps_the_target_value(spark, target):
    src = spark.createDataFrame([(2, "B"), (7, "g"), (None, "m")], "k int, v string")
    assert rows(merge.upsert(target, src, "k")) == [
        (None, "m", None), (None, "n", 3), (1, "a", 1), (2, "B", 2), (7, "g", None)]


def test_several_matches_raise_but_several_inserts_do_not(spark, target):
    for cols in (T, "k int, v string"):
        width = len(cols.split(","))
        twice = spark.createDataFrame([(2, "x", 1)[:width], (2, "y", 1)[:width]], cols)
        with pytest.raises(Exception, match="several source rows"):
            merge.upsert(target, twice, "k").collect()
    new = spark.createDataFrame([(9, "x", 1), (9, "y", 1)], T)
    assert merge.upsert(target, new, "k").count() == 5


def test_unknown_source_column_is_refused(spark, target):
    with pytest.raises(ValueError):
        merge.upsert(target, target.withColumn("extra", F.lit(1)), "k")


def test_tables_with_a_map_column_are_merged(spark):
    mk = lambda *r: spark.createDataFrame(list(r), "k int, m map<string,int>")
    out = merge.upsert(mk((1, {"a": 1}), (None, {"b": 2})), mk((1, {"c": 3}), (2, {})), "k")
    assert {(r["k"], str(r["m"])) for r in out.collect()} == {(1, "{'c': 3}"), (2, "{}"), (None, "{'b': 2}")}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(t=st.dictionaries(st.integers(0, 8), st.text("ab", max_size=2), max_size=6),
       s=st.dictionaries(st.integers(0, 8), st.text("cd", max_size=2), max_size=6))
def test_upsert_is_a_dict_update_and_idempotent(spark, t, s):
    td, sd = (spark.createDataFrame(list(d.items()), "k int, v string") for d in (t, s))
    once = merge.upsert(td, sd, "k")
    assert dict(map(tuple, once.collect())) == {**t, **s}
    assert rows(merge.upsert(once, sd, "k")) == rows(once)


def flagged(spark):
    return spark.createDataFrame(
        [(1, True, datetime(2024, 1, 1)), (2, True, datetime(2024, 1, 1)), (3, False, datetime(2024, 1, 1)),
         (None, True, datetime(2024, 1, 1))], "k int, is_active boolean, _ingested_at timestamp")


def test_soft_delete_marks_only_active_known_keys(spark):
    src = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    out = {r["k"]: (r["is_active"], r["_ingested_at"].month)
           for r in merge.soft_delete(flagged(spark), src, "k", datetime(2024, 6, 1)).collect()}
    assert out == {1: (True, 1), 2: (False, 6), 3: (False, 1), None: (True, 1)}
    assert rows(merge.deleted_keys(flagged(spark), src, "k")) == [(2,)]


def test_empty_source_is_refused(spark):
    none = spark.createDataFrame([], "k int")
    for useless in (none, spark.createDataFrame([(None,)], "k int")):
        with pytest.raises(Exception, match="source key set is empty"):
            merge.soft_delete(flagged(spark), useless, "k").collect()
    out = merge.soft_delete(flagged(spark), none, "k", allow_empty_source=True)
    assert out.where("is_active").count() == 1


def test_active_flag_is_added_once(spark, target):
    once = merge.with_active_flag(target)
    assert once.where("is_active").count() == 3 and merge.with_active_flag(once) is once


def test_merge_report(spark, target):
    src = spark.createDataFrame([(2, "B", 20), (5, "e", 50)], T)
    gone = spark.createDataFrame([(1,)], "k int")
    assert merge.merge_report(target, src, "k", gone).first().asDict() == {
        "rows_inserted": 1, "rows_updated": 1, "rows_unchanged": 2, "rows_deleted": 1}


def test_silver_step_reactivates_rows_of_the_batch(spark):
    staging = spark.createDataFrame(
        [(1, "x", datetime(2024, 2, 1)), (4, None, datetime(2024, 2, 1)), (2, "old", datetime(2024, 1, 1))],
        "k int, v string, _ingested_at timestamp")
    target = spark.createDataFrame(
        [(1, "a", datetime(2024, 1, 1), False), (2, "b", datetime(2024, 1, 1), True),
         (3, "c", datetime(2024, 1, 1), True)], "k int, v string, _ingested_at timestamp, is_active boolean")
    source = spark.createDataFrame([(3,)], "k int")
    step = silver_step(staging, target, "k", lambda d: d.na.drop(), watermark="2024-01-15 00:00:00",
                       source_keys=source, deleted_at=F.lit(datetime(2024, 6, 1)))
    assert rows(step.table, "k", "v", "is_active") == [(1, "x", True), (2, "b", False), (3, "c", True)]
    assert tuple(step.metrics.first()) == (0, 1)
    assert step.watermark.first()[0] == datetime(2024, 2, 1)


def test_silver_step_without_target_or_news(spark):
    staging = spark.createDataFrame([(1, "x", datetime(2024, 2, 1))], "k int, v string, _ingested_at timestamp")
    first = silver_step(staging, None, "k", lambda d: d)
    assert first.table.count() == 1 and tuple(first.metrics.first()) == (1, 0)
    again = silver_step(staging, first.table, "k", lambda d: d, watermark="2024-02-01 00:00:00")
    assert rows(again.table) == rows(first.table) and again.watermark.first()[0] == datetime(2024, 2, 1)


def test_job_registry_keeps_id_and_creation_time(spark):
    reg = spark.createDataFrame(
        [(7, "j", "silver", "s0", datetime(2024, 1, 1), datetime(2024, 1, 1)),
         (9, "k", "gold", "s1", datetime(2024, 1, 1), datetime(2024, 1, 1))],
        "job_id bigint, job_name string, layer string, source string, created_at timestamp, updated_at timestamp")
    jobs = spark.createDataFrame([("j", "silver", "S"), ("b", "gold", "n1"), ("a", "gold", "n2")],
                                 "job_name string, layer string, source string")
    got = {r["job_name"]: r for r in merge.register_jobs(reg, jobs, F.lit(datetime(2024, 5, 1))).collect()}
    assert {k: r["job_id"] for k, r in got.items()} == {"j": 7, "k": 9, "a": 10, "b": 11}
    assert got["j"]["source"] == "S" and got["j"]["created_at"].month == 1 and got["j"]["updated_at"].month == 5
    assert got["k"]["updated_at"].month == 1 and got["a"]["created_at"].month == 5
