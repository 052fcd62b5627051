"""Tables of key-hash buckets: merges and delete syncs that touch only what they must."""

import os

import pytest
from pyspark.sql import functions as F

from tarnlake.operators import digests, merge
from tarnlake.sources.buckets import BucketedTable
from tarnlake.sources.tables import TableTarget, read_table, write_table

from .conftest import rows


def files(path):
    out = {}
    for folder, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                out.setdefault(os.path.basename(folder), {})[n] = os.stat(os.path.join(folder, n)).st_mtime_ns
    return out


@pytest.fixture
def table(spark, tmp_path):
    t = BucketedTable(str(tmp_path / "t"), ("k",), 8)
    t.create(spark.range(200).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"), F.lit(1).alias("extra")))
    return t


def test_a_merge_leaves_files_of_other_buckets_alone(spark, table):
    before = files(table.path)
    batch = spark.createDataFrame([(3, "new", 2), (1000, "added", 3)], "k int, v string, extra int")
    touched = table.merge(batch)
    after = files(table.path)
    assert 1 <= len(touched) <= 2
    names = {f"_bucket={b}" for b in touched}
    assert {b: f for b, f in after.items() if b not in names} == {b: f for b, f in before.items() if b not in names}
    assert all(after[b] != before[b] for b in names)
    want = {i: (f"v{i}", 1) for i in range(200)} | {3: ("new", 2), 1000: ("added", 3)}
    assert {r.k: (r.v, r.extra) for r in table.read(spark).collect()} == want


def test_only_the_batch_s_buckets_are_read(spark, table):
    plan = table.read(spark, [2, 5])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_bucket" in plan
    opened = {os.path.basename(os.path.dirname(r[0])) for r in table.read(spark, [2, 5]).select(F.input_file_name()).distinct().collect()}
    assert opened == {"_bucket=2", "_bucket=5"}


def test_merging_twice_changes_nothing_and_nulls_are_inserted(spark, table):
    batch = spark.createDataFrame([(5, "x", 9), (None, "null key", 0)], "k long, v string, extra int")
    table.merge(batch.where("k is not null"))
    once = rows(table.read(spark))
    table.merge(batch.where("k is not null"))
    assert rows(table.read(spark)) == once
    table.merge(batch)
    table.merge(batch)
    assert table.read(spark).where("k is null").count() == 2
    assert table.merge(batch.limit(0)) == []


def test_missing_columns_keep_their_values_and_repeated_keys_raise(spark, table):
    table.merge(spark.createDataFrame([(7, "seven")], "k long, v string"))
    assert rows(table.read(spark).where("k = 7")) == [(7, "seven", 1)]
    with pytest.raises(Exception, match="several source rows"):
        table.merge(spark.createDataFrame([(7, "a"), (7, "b")], "k long, v string"))
    assert rows(table.read(spark).where("k = 7")) == [(7, "seven", 1)]


def test_merge_equals_the_snapshot_merge(spark, tmp_path):
    target = spark.range(300).select(F.col("id").alias("a"), (F.col("id") % 7).cast("string").alias("b"), F.lit(0).alias("v"))
    source = target.where("a % 3 = 0").withColumn("v", F.lit(1)).unionByName(
        spark.createDataFrame([(1, "other", 5), (900, "0", 6)], "a long, b string, v int"))
    t = BucketedTable(str(tmp_path / "t"), ("a", "b"), 16, files=3)
    t.create(target)
    t.merge(source)
    assert rows(t.read(spark)) == rows(merge.upsert(target, source, ["a", "b"]))


def test_delete_sync_by_digests_equals_the_join(spark):
    target = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 5 != 0).alias("is_active")).unionByName(
        spark.createDataFrame([(None, True)], "k long, is_active boolean"))
    for source in (spark.range(500).where("id % 11 <> 0"), spark.range(500), spark.range(100, 900), spark.range(0),
                   spark.range(500).union(spark.range(500)), spark.range(499).union(spark.range(1))):
        source = source.select(F.col("id").cast("int").alias("k"))
        active = target.where("is_active and k is not null").select("k")
        want = rows(active.join(source, "k", "left_anti"))
        for n in (1, 7, 4096):
            assert rows(merge.deleted_keys(target, source, "k", n)) == want


def test_equal_buckets_are_not_compared_key_by_key(spark, tmp_path):
    t = BucketedTable(str(tmp_path / "t"), ("k",), 16)
    t.create(spark.range(400).select(F.col("id").alias("k"), F.lit(True).alias("is_active"), F.lit("2024-01-01").cast("timestamp").alias("_ingested_at")))
    source = spark.range(400).select(F.col("id").alias("k"))
    assert t.changed(source) == [] and t.soft_delete(source, F.lit("2024-06-01").cast("timestamp")) == []
    before = files(t.path)
    left = source.where("k <> 123")
    differ = t.changed(left)
    assert differ == t.buckets_of(source.where("k = 123"))
    assert t.soft_delete(left, F.lit("2024-06-01").cast("timestamp")) == differ
    after = files(t.path)
    assert [b for b in after if after[b] != before[b]] == [f"_bucket={differ[0]}"]
    assert rows(t.read(spark).where("not is_active").select("k")) == [(123,)]
    with pytest.raises(ValueError, match="empty"):
        t.soft_delete(source.limit(0), F.current_timestamp())


def test_digests_tell_equal_from_unequal(spark):
    a = spark.range(1000).select(F.col("id").alias("k"))
    assert digests.changed_buckets(a, a.orderBy(F.desc("k")), "k", 64).count() == 0
    other = a.where("k <> 5").union(spark.createDataFrame([(5000,)], "k long"))
    assert 1 <= digests.changed_buckets(a, other, "k", 64).count() <= 2


def test_catalog_table_of_buckets(spark, tmp_path):
    target = TableTarget("clean_bucket_things", str(tmp_path), ("k",), buckets=4)
    df = spark.range(20).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    assert write_table(df, target, "v1") == "create"
    assert write_table(spark.createDataFrame([(3, "b"), (77, "c")], "k long, v string"), target, "v2") == "merge"
    got = {r.k: r.v for r in read_table(spark, target).collect()}
    assert got == {i: "a" for i in range(20)} | {3: "b", 77: "c"}
    spark.sql("DROP TABLE clean_bucket_things")
