"""Training-order materialisation: token sequences in a keyed random order, as fixed-stride binary shards.

Documents are tokenised, joined with an end token and cut into sequences of ``seq_len`` ids in the task that
reads them; the last sequence of a task is filled up with the end token. Sequences get dense numbers from the
counts of the tasks. A Feistel network over the smallest even number of bits that holds all numbers, walked on
while it leaves the range, permutes them: slot s of the training order holds exactly one sequence, and any slot
can be computed alone from the key. Shard k holds the slots from k * per_shard on, in order, as one file of records of
``seq_len`` little-endian ids (16 or 32 bits, as the vocabulary needs) and one newline byte, so record r of a shard
starts at r * stride and reading can go on at any slot. A task writes a range of consecutive shards one after the other:
shards stay small, and tasks follow the bytes.

Files are written by Spark's own text writer and committer to any file system Spark can write, so a lost executor
leaves no half shard. Sequences wait as a table, compressed one by one, between tokenising and the shuffle.

Defined results: null and empty texts are an end token alone; repeated rows are documents of their own; an empty
table gives no sequences and no shards. Other columns are not read. ``first_key`` is null for a null id.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake.sources.scratch import new_path

from . import spans
from .tables import checked_broadcast
from .wordpieces import encoder, turns

SEQ_LEN, PER_SHARD, END_ID, ROUNDS = 2048, 1024, 1, 6
#: Bytes of ids that a writing task takes, where that needs more tasks than shuffles have partitions.
TASK_BYTES = 1 << 30


# ---- the permutation --------------------------------------------------------------------------------------

def permute(index: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """The slot of each number below ``n``, or with ``back`` the number at each slot."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = spans.mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key % 2**64))
    out = np.asarray(index).astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for k in keys[::-1] if back else keys:
            if back:
                left, right = right ^ (spans.mix(left + k) & mask), left
            else:
                left, right = right, left ^ (spans.mix(right + k) & mask)
        out[todo] = left << half | right
        todo = todo[out[todo] >= np.uint64(n)]  # walk on until the value is in range
    return out.astype(np.int64)


def slot_of(index: Column, n: int, key: int) -> Column:
    @F.pandas_udf("long")
    def slots(x: pd.Series) -> pd.Series:
        return pd.Series(permute(x.to_numpy(), n, key))

    return slots(index)


# ---- sequences --------------------------------------------------------------------------------------------

def sequences(docs: DataFrame, definition: str, key: str = "doc_id", text: str = "text", seq_len: int = SEQ_LEN,
              end_id: int = END_ID) -> DataFrame:
    """task, local, first_key, n_tokens and the compressed ids of every sequence."""
    sent = docs.sparkSession.sparkContext.broadcast(definition)
    width = id_width(definition)
    end = np.array([end_id], f"<u{width}")
    id_type = docs.schema[key].dataType
    out = T.StructType([*T.StructType.fromDDL("task int, local long").fields, T.StructField("first_key", id_type),
                        *T.StructType.fromDDL("n_tokens int, packed binary").fields])

    def run(batches):
        codec = pa.Codec("zstd", compression_level=3)
        encode = encoder(sent.value).encode_column
        task, local = TaskContext.get().partitionId(), 0
        rest, owner = np.zeros(0, f"<u{width}"), None  # ids not yet in a full sequence, and whose the first is
        for batch in batches:
            texts = spans.Text(batch.column(1))
            for lo, hi in turns(np.diff(texts.at).tolist(), 2 * spans.BLOCK):
                docs_ids = [x.astype(f"<u{width}") for x in encode(texts.rows(lo, hi))]
                size = np.array([len(rest), *[len(x) + 1 for x in docs_ids]])
                ids = np.concatenate([rest, *[y for x in docs_ids for y in (x, end)]])
                owners = pa.concat_arrays([pa.array([owner], batch.column(0).type), batch.column(0).slice(lo, hi - lo)])
                n = len(ids) // seq_len
                whose = np.searchsorted(np.cumsum(size), np.arange(n + 1) * seq_len, "right")
                if n:
                    yield _rows(task, local, owners.take(pa.array(whose[:n])), [seq_len] * n,
                                [codec.compress(ids[i * seq_len:(i + 1) * seq_len].tobytes()).to_pybytes() for i in range(n)], out)
                local += n
                rest = ids[n * seq_len:]
                owner = owners[int(whose[n])].as_py() if len(rest) else None
        if len(rest):
            full = np.concatenate([rest, np.full(seq_len - len(rest), end_id, f"<u{width}")])
            yield _rows(task, local, pa.array([owner], _arrow_type(id_type)), [len(rest)],
                        [codec.compress(full.tobytes()).to_pybytes()], out)
        spans.release()

    return docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")).mapInArrow(run, out)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _rows(task: int, local: int, first: pa.Array, n_tokens: list[int], packed: list[bytes], out: T.StructType) -> pa.RecordBatch:
    n = len(packed)
    return pa.RecordBatch.from_arrays(
        [pa.array([task] * n, pa.int32()), pa.array(range(local, local + n), pa.int64()), first,
         pa.array(n_tokens, pa.int32()), pa.array(packed, pa.binary())], names=out.names)


def id_width(definition: str) -> int:
    """Bytes of an id."""
    made = json.loads(definition)
    top = max([*made["model"]["vocab"].values(), *[t["id"] for t in made["added_tokens"]]])
    return 2 if top < 1 << 16 else 4


# ---- shards -----------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Shards:
    """Where the shards are, and how to read them."""

    path: str
    n: int
    seq_len: int
    width: int
    per_shard: int

    @property
    def stride(self) -> int:
        return self.seq_len * self.width + 1

    @property
    def count(self) -> int:
        return -(-self.n // self.per_shard)


def materialise(docs: DataFrame, definition: str, key: int, path: str | None = None, id_column: str = "doc_id",
                text: str = "text", seq_len: int = SEQ_LEN, per_shard: int = PER_SHARD, tasks: int | None = None
                ) -> tuple[Shards, DataFrame]:
    """Write the shards; also returns the manifest: slot, shard, byte_offset, first_key, n_tokens.

    ``tasks`` write ranges of consecutive shards each: by default as many as shuffles have partitions, or more, so that
    none takes over TASK_BYTES.
    """
    spark = docs.sparkSession
    width, path = id_width(definition), path or new_path(spark, "shards")
    made = sequences(docs, definition, id_column, text, seq_len)
    held = new_path(spark, "sequences")
    # the ids are compressed already; small row groups keep little in memory
    made.write.option("compression", "uncompressed").option("parquet.block.size", 16 << 20).parquet(held)
    made = spark.read.schema(made.schema).parquet(held)
    # one number for each task that read documents
    counts = sorted(tuple(r) for r in made.groupBy("task").count().collect())
    bases = np.cumsum([0, *[c for _, c in counts]]).tolist()
    n = bases[-1]
    before = spark.createDataFrame([(t, b) for (t, _), b in zip(counts, bases)], "task int, base long")
    placed = made.join(checked_broadcast(before), "task").withColumn("slot", slot_of(F.col("base") + F.col("local"), n, key))
    shard = F.expr(f"CAST(slot DIV {per_shard} AS INT)")
    shards = Shards(path, n, seq_len, width, per_shard)
    if n:
        def unpack(batches):
            size = seq_len * width
            for batch in batches:
                ids = pa.array([pa.decompress(x, size, "zstd").to_pybytes() for x in batch.column(1).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["shard", "ids"])
            spans.release()

        tasks = tasks or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n * shards.stride // TASK_BYTES))
        tasks = min(tasks, shards.count)
        ranges = F.expr(f"CAST(slot DIV {per_shard * -(-shards.count // tasks)} AS INT)")
        ordered = placed.select("slot", "packed").repartitionById(tasks, ranges).withColumn("shard", shard) \
            .sortWithinPartitions("shard", "slot")
        ordered.select("shard", "packed").mapInArrow(unpack, "shard int, ids binary") \
            .select("shard", F.col("ids").cast("string").alias("value")).write.partitionBy("shard").option("lineSep", "\n").text(path)
    manifest = placed.select("slot", shard.cast("long").alias("shard"),
                             F.expr(f"slot % {per_shard} * {shards.stride}L").alias("byte_offset"), "first_key",
                             F.col("n_tokens").cast("long").alias("n_tokens"))
    return shards, manifest


def read_slots(spark: SparkSession, shards: Shards, start: int = 0, stop: int | None = None) -> DataFrame:
    """slot and ids (little-endian binary) of the slots from ``start`` to before ``stop``; opens their shards only."""
    stop = shards.n if stop is None else min(stop, shards.n)
    if stop <= start:
        return spark.createDataFrame([], "slot long, ids binary")
    first, last = start // shards.per_shard, (stop - 1) // shards.per_shard
    files = [f"{shards.path}/shard={k}/part-*" for k in range(first, last + 1)]
    whole = first == 0 and last == shards.count - 1
    content = spark.read.format("binaryFile").load(f"{shards.path}/shard=*/part-*" if whole else files).select(
        F.regexp_extract("path", r"shard=(\d+)/[^/]*$", 1).cast("long").alias("shard"), "content")
    size, stride, per_shard = shards.seq_len * shards.width, shards.stride, shards.per_shard

    def cut(batches):
        for batch in batches:
            for shard, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = data.as_buffer()
                n = raw.size // stride
                for lo in range(0, n, 256):
                    some = range(lo, min(lo + 256, n))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard * per_shard + r for r in some], pa.int64()),
                         pa.array([raw.slice(r * stride, size).to_pybytes() for r in some], pa.binary())],
                        names=["slot", "ids"])
        spans.release()

    return content.mapInArrow(cut, "slot long, ids binary").where(F.col("slot").between(start, stop - 1))
