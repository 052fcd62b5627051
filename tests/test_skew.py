import pytest
from pyspark.sql import functions as F

from tarnlake.operators.skew import skew_join

from .conftest import rows


@pytest.fixture
def sides(spark):
    """A third of the big side holds key 0, another part a null key."""
    big = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 997).alias("k"),
        F.col("id").alias("v"))
    small = spark.range(500).select((F.col("id") * 2).alias("k"), (F.col("id") + 1).alias("w"))
    return big, small.unionByName(spark.createDataFrame([(0, -1), (None, -2)], "k bigint, w bigint"))


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_same_rows_as_a_plain_join(spark, sides, how):
    big, small = sides
    got, want = skew_join(big, small, "k", how), big.join(small, "k", how)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_hot_key_is_spread(spark, sides):
    big, small = sides
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per_task = lambda df: max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        unique = small.where("k is not null").groupBy("k").agg(F.max("w").alias("w"))
        assert per_task(skew_join(big, unique, "k")) < 0.6 * per_task(big.join(unique, "k"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_keys_of_several_shares_are_balanced(spark):
    """Keys with 40 %, 5 % and 0.5 % of the rows: no task gets more than twice the mean."""
    share = F.col("id") % 1000
    big = spark.range(80_000).select(F.when(share < 400, 1).when(share < 450, 2).when(share < 455, 3)
                                     .otherwise(10 + F.col("id") % 5000).alias("k"), F.col("id").alias("v"))
    small = spark.range(6000).select(F.col("id").alias("k"), F.lit("x").alias("w"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        per_task = [r["count"] for r in skew_join(big, small, "k").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(per_task) == 80_000 and max(per_task) <= 2 * 80_000 / 8


def test_map_columns_do_not_matter(spark):
    big = spark.createDataFrame([(1, {"a": 1}), (1, {"b": 2}), (2, {})], "k bigint, m map<string,int>")
    assert skew_join(big, spark.range(2).withColumnRenamed("id", "k"), "k").count() == 2


def test_null_keys_stay_out_of_the_join_of_a_merge(spark):
    from tarnlake.operators.merge import upsert
    target = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    out = upsert(target, spark.createDataFrame([(2, -1), (None, -2)], "k bigint, v bigint"), "k")
    assert out.count() == 20_001 and rows(out.where("v < 0")) == [(None, -2), (2, -1)]
    nulls = [r["count"] for r in out.where("k is null").groupBy(F.spark_partition_id()).count().collect()]
    assert max(nulls) < 2 * 10_001 / 8  # eight tasks read the target; none gets more than twice its share of null keys


def test_unsupported_join_type(sides):
    with pytest.raises(ValueError):
        skew_join(*sides, "k", "full_outer")
