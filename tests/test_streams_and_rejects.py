"""Merging a stream with replayed batches, and loading that keeps rejects apart."""

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake.sources import rejects
from tarnlake.sources.buckets import BucketedTable
from tarnlake.streaming.merge import StreamMerge

from .conftest import rows

SCHEMA = "k long, ts timestamp, v string"


def batch(spark, *found):
    return spark.createDataFrame([(k, datetime(2024, 1, d), v) for k, d, v in found], SCHEMA)


def at():
    return F.to_timestamp(F.lit("2024-06-01 00:00:00"))


def merge_into(path):
    return StreamMerge(BucketedTable(f"{path}/t", ("k",), 4), f"{path}/control", "things", "ts")


def test_replayed_batches_change_nothing_and_late_rows_do_not_win(spark, tmp_path):
    m = merge_into(tmp_path)
    assert m.done(spark) == (-1, None)
    assert m.apply(batch(spark, (1, 5, "a"), (2, 6, "b"), (2, 7, "c")), 0, at())
    assert not m.apply(batch(spark, (1, 20, "replayed with other rows")), 0, at())
    assert m.apply(batch(spark, (1, 3, "late"), (2, 9, "d"), (3, 1, "new")), 1, at())
    assert rows(m.table.read(spark), "k", "v", "is_active") == [(1, "a", True), (2, "d", True), (3, "new", True)]
    assert m.done(spark) == (1, datetime(2024, 1, 9))
    assert m.apply(batch(spark, (9, 9, "x")).limit(0), 2, at()) and m.done(spark) == (2, datetime(2024, 1, 9))


def test_a_batch_whose_number_was_not_stored_merges_to_the_same_table(spark, tmp_path):
    m, first = merge_into(tmp_path), batch(spark, (1, 5, "a"), (2, 6, "b"))
    m.table.create(first.withColumn("is_active", F.lit(True)))  # written, then the job died
    assert m.apply(first, 0, at())
    assert rows(m.table.read(spark), "k", "v") == [(1, "a"), (2, "b")]


def test_stream_of_files(spark, tmp_path):
    source, m = str(tmp_path / "in"), merge_into(tmp_path)
    stream = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    batch(spark, (1, 5, "a"), (2, 6, "b")).coalesce(1).write.mode("append").parquet(source)
    batch(spark, (1, 8, "c")).coalesce(1).write.mode("append").parquet(source)
    m.run(stream(), str(tmp_path / "checkpoint"), at())
    assert m.done(spark) == (1, datetime(2024, 1, 8))
    batch(spark, (3, 9, "d")).coalesce(1).write.mode("append").parquet(source)
    for _ in range(2):
        m.run(stream(), str(tmp_path / "checkpoint"), at())
    assert rows(m.table.read(spark), "k", "v") == [(1, "c"), (2, "b"), (3, "d")] and m.done(spark)[0] == 2


def test_csv_lines_that_do_not_fit_are_kept_with_their_text(spark, tmp_path):
    schema = T.StructType.fromDDL("id int, price double, day date, note string")
    (tmp_path / "f.csv").write_text('id,price,day,note\r\n1,2.5,2024-01-01,"a, ""quoted"""\r\nx,1,2024-01-01,bad id\r\n2,,2024-01-02,\r\n'
                                    "3,1.0,2024-13-45,bad day\r\n4,1.0\r\n5,1,2024-01-01,more,columns\r\n")
    found = rejects.load_csv(spark, str(tmp_path / "f.csv"), schema, str(tmp_path / "out"))
    assert rows(found.good.select("id", "note")) == [(1, 'a, "quoted"'), (2, None)]
    assert [r.split(",")[0] for r, in rows(found.rejects.select(rejects.CORRUPT))] == ["3", "4", "5", "x"]
    assert (found.n_good, found.n_rejects) == (2, 4) and found.rejects.where(f"{rejects.REASON} is null").count() == 0


def test_unparsable_marks_are_counted_and_kept(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (2, "soon"), (3, None), (4, "2024-02-30 00:00:00")], "k int, ts string")
    found = rejects.load_marks(df, "ts", str(tmp_path / "out"))
    assert rows(found.good) == [(1, datetime(2024, 1, 1, 10)), (3, None)]
    assert rows(found.rejects, "k", "ts") == [(2, "soon"), (4, "2024-02-30 00:00:00")] and (found.n_good, found.n_rejects) == (2, 2)
    empty = rejects.load_marks(df.limit(0), "ts", str(tmp_path / "none"))
    assert (empty.n_good, empty.n_rejects, empty.good.count()) == (0, 0, 0)
