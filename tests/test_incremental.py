from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tarnlake.operators import incremental as inc

from .conftest import rows


def ts(day):
    return datetime(2024, 1, day)


@pytest.fixture
def batch(spark):
    return spark.createDataFrame(
        [(1, ts(1), "a"), (1, ts(3), "b"), (1, ts(3), "a"), (2, ts(2), "c"), (None, ts(2), "x"), (None, ts(1), "y"),
         (3, None, "z")], "k int, w timestamp, v string")


def test_newer_than_is_strict_and_none_means_full(batch):
    assert inc.newer_than(batch, "w", ts(2)).count() == 2
    assert inc.newer_than(batch, "w", None).count() == 7
    out, mode = inc.extract_newer(batch, "w", ts(2), ordered=True)
    assert mode == "incremental" and out.count() == 2


def test_missing_watermark_column(batch):
    with pytest.raises(ValueError):
        inc.newer_than(batch, "last_update", ts(1))
    assert inc.staging_filter(batch, "last_update").count() == 7


def test_staging_filter_parses_text_and_drops_what_it_cannot_read(spark):
    df = spark.createDataFrame([("2024-01-05 10:00:00", 1), ("nonsense", 2), ("2023-12-31", 3)], "w string, k int")
    assert rows(inc.staging_filter(df, "w", "2024-01-01 00:00:00"), "k") == [(1,)]


def test_latest_per_key_breaks_ties_by_other_columns(batch):
    got = rows(inc.latest_per_key(batch, "k", "w"))
    assert got == [(None, ts(2), "x"), (1, ts(3), "a"), (2, ts(2), "c"), (3, None, "z")]


def test_latest_per_composite_key(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 1, 7), (1, 2, 1)], "a int, b int, w int")
    assert rows(inc.latest_per_key(df, ["a", "b"], "w")) == [(1, 1, 7), (1, 2, 1)]


def test_new_watermark_of_empty_batch_is_the_old_one(batch):
    assert inc.new_watermark(batch.limit(0), "w", ts(9)).first()[0] == ts(9)
    assert inc.new_watermark(batch, "w", ts(1)).first()[0] == ts(3)
    assert inc.new_watermark(batch.limit(0), "w").first()[0] is None


def test_watermark_store(spark):
    store = spark.createDataFrame([("a", ts(4), ts(5))], inc.WATERMARK_SCHEMA)
    assert inc.watermark_value(store, "a") == ts(4)
    assert inc.watermark_value(store, "b") == datetime(1900, 1, 1)
    assert inc.watermark_value(store.limit(0), "a", "2000-01-01 00:00:00") == datetime(2000, 1, 1)


def test_audit_columns(batch):
    out = inc.add_audit_columns(batch, "r1", F.lit(ts(8)))
    assert out.columns[-2:] == ["_ingested_at", "_job_run_id"]
    assert out.select("_ingested_at").distinct().first()[0] == ts(8)


def test_merge_metrics_counts_join_pairs(spark):
    src = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    tgt = spark.createDataFrame([(2,), (3,), (None,)], "k int")
    assert tuple(inc.merge_metrics(src, tgt, "k").first()) == (2, 2)
    assert tuple(inc.merge_metrics(src, None, "k").first()) == (4, 0)
    assert tuple(inc.merge_metrics(src.limit(0), tgt, "k").first()) == (0, 0)
