import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake.operators import history as h

from .conftest import rows


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")


def test_update_and_delete_ignore_null_conditions(people):
    assert rows(h.update_where(people, F.col("v") == "a", {"v": F.lit("z")})) == [(1, "z"), (2, None), (3, "c")]
    assert rows(h.delete_where(people, F.col("v") == "a")) == [(2, None), (3, "c")]


def test_add_column_and_enforcement(people):
    wide = h.add_column(people, "phone", "string")
    assert wide.where("phone is null").count() == 3
    with pytest.raises(ValueError):
        h.add_column(wide, "phone", "string")
    assert h.enforce_schema(people, T.StructType.fromDDL("v string, k bigint")).columns == ["v", "k"]
    with pytest.raises(Exception):
        h.enforce_schema(people, T.StructType.fromDDL("k int, v int")).collect()
    with pytest.raises(ValueError):
        h.enforce_schema(wide, T.StructType.fromDDL("k int, v string"))


def test_as_of_reads(people):
    log = (h.commit(people, "insert", 1, "2024-01-01 00:00:00")
           .unionByName(h.commit(people.where("k = 1").withColumn("v", F.lit("A")), "update", 2, "2024-01-02 00:00:00"))
           .unionByName(h.commit(people.where("k = 3"), "delete", 3, "2024-01-03 00:00:00"))
           .unionByName(h.commit(people.where("k = 3").withColumn("v", F.lit("back")), "insert", 4,
                                 "2024-01-04 00:00:00")))
    assert h.version_as_of(log, "k", 0).count() == 0
    assert rows(h.version_as_of(log, "k", 2)) == [(1, "A"), (2, None), (3, "c")]
    assert rows(h.version_as_of(log, "k", 3)) == [(1, "A"), (2, None)]
    assert rows(h.timestamp_as_of(log, "k", "2024-01-03 12:00:00")) == [(1, "A"), (2, None)]
    assert rows(h.version_as_of(log, "k", 9))[-1] == (3, "back")
    assert rows(h.history(log), "version", "rows_inserted", "rows_updated", "rows_deleted") == [
        (1, 3, 0, 0), (2, 0, 1, 0), (3, 0, 0, 1), (4, 1, 0, 0)]
    with pytest.raises(ValueError):
        h.commit(people, "upsert", 1, "2024-01-01 00:00:00")
