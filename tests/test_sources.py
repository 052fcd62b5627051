import struct
import zlib

import pytest
from pyspark.sql import functions as F

from tarnlake.sources import files, jdbc, scratch, tables
from tarnlake.sources.schemas import TABLES
from tarnlake.streaming.staging import load_new, read_new_files

from .conftest import rows


def test_csv_with_crlf_quotes_and_commas(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_bytes(b'product_category_name,product_category_name_english\r\n"a, b","say ""hi"""\r\nx,\r\n')
    df = files.read_csv(spark, str(p), TABLES["product_category"].schema)
    assert rows(df) == [("a, b", 'say "hi"'), ("x", None)]


def test_csv_with_line_breaks_inside_quotes(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_bytes(b'product_category_name,product_category_name_english\r\n"two\nlines",y\r\n')
    df = files.read_csv(spark, str(p), TABLES["product_category"].schema, multi_line=True)
    assert rows(df) == [("two\nlines", "y")]


def test_bad_csv_row_raises(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,notanumber,a,b\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(p), TABLES["seller"].schema).collect()


def png(width, height):
    """A plain grey PNG."""
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    raw = b"".join(b"\0" + b"\x80" * width for _ in range(height))
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_images(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(png(3, 2))
    df = files.read_images(spark, str(tmp_path))
    assert rows(df, "image.width", "image.height") == [(3, 2)]
    path = scratch.new_path(spark, "images")
    tables.create_if_absent(df, "image_table", path)
    assert spark.table("image_table").count() == 1


def test_parquet_replaces_only_written_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    files.write_parquet(df, path, partition_by=["p"])
    files.write_parquet(df.where("p = 'a'").withColumn("v", F.lit(9)), path, partition_by=["p"])
    assert rows(files.read_parquet(spark, path)) == [(2, "b"), (9, "a")]
    files.write_parquet(df.where("p = 'a'"), path, mode="append", partition_by=["p"])
    assert files.read_parquet(spark, path, df.schema).count() == 3


def test_load_modes(spark):
    root = scratch.new_path(spark, "lm")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    stg, clean, other = (tables.TableTarget(f"lm_layer.{n}", root, ("k",) if n != "dim" else ())
                         for n in ("stg_x", "clean_x", "dim"))
    assert [tables.write_table(df, t, "v1") for t in (stg, clean, other)] == ["create"] * 3
    more = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    assert tables.write_table(more.withColumn("extra", F.lit(1)), stg, "v2") == "append"
    assert spark.table(stg.name).count() == 4 and "extra" in spark.table(stg.name).columns
    assert tables.write_table(more, clean, "v2") == "merge"
    assert rows(spark.table(clean.name)) == [(1, "a"), (2, "B"), (3, "c")]
    assert tables.write_table(more, clean, "v3") == "merge"
    assert rows(spark.table(clean.name)) == [(1, "a"), (2, "B"), (3, "c")]
    with pytest.raises(ValueError):
        tables.write_table(more, other, "v2")


def test_scratch_uses_the_shared_folder(spark):
    assert scratch.new_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch.new_path(spark, "x") != scratch.new_path(spark, "x")


def test_jdbc_options_and_statements():
    o = jdbc.scan_options("jdbc:x", "sellers", column="id", lower=0, upper=100, partitions=8,
                          connection={"user": "u"})
    assert o["dbtable"] == "sellers" and o["numPartitions"] == "8" and o["fetchsize"] == "10000" and o["user"] == "u"
    assert "partitionColumn" not in jdbc.scan_options("jdbc:x", "t")
    with pytest.raises(ValueError):
        jdbc.scan_options("jdbc:x", "t", column="id")
    spec = TABLES["payment"]
    assert jdbc.keys_query(spec.source_table, spec.key_sql, "pk_hash") == (
        "(SELECT MD5(CONCAT(order_id, '|', payment_sequential)) AS pk_hash FROM payments) t")
    assert jdbc.merge_statement("t", "s", ["k"], ["k", "v"]) == (
        "INSERT INTO t (k, v) SELECT k, v FROM s ON DUPLICATE KEY UPDATE v = VALUES(v)")
    assert jdbc.merge_statement("t", "s", ["k"], ["k", "v"], "ansi") == (
        "MERGE INTO t t USING s s ON t.k = s.k WHEN MATCHED THEN UPDATE SET v = s.v"
        " WHEN NOT MATCHED THEN INSERT (k, v) VALUES (s.k, s.v)")
    with pytest.raises(ValueError):
        jdbc.merge_statement("t", "s", ["k"], ["k"], "other")


def test_stream_takes_every_file_once(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    a = spark.createDataFrame([(1,), (2,)], "k int")
    a.write.parquet(src)
    for _ in range(2):
        load_new(read_new_files(spark, src, a.schema), out, ck, "r1")
    assert spark.read.parquet(out).count() == 2
    spark.createDataFrame([(3,)], "k int").write.mode("append").parquet(src)
    load_new(read_new_files(spark, src, a.schema), out, ck, "r2")
    assert rows(spark.read.parquet(out), "k", "_job_run_id") == [(1, "r1"), (2, "r1"), (3, "r2")]


def test_a_local_folder_is_refused_on_a_cluster():
    for master in ("local", "local[8]", "local[*]"):
        scratch.refuse_unless_local(master)
    for master in ("local-cluster[3,2,1024]", "yarn", "spark://host:7077", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch.refuse_unless_local(master)


def test_stream_over_a_table_of_several_files(spark, sf, tmp_path):
    from workload.cdc import cdc_stream_staging
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    assert cdc_stream_staging(spark, str(tmp_path)).count() == events.count()
