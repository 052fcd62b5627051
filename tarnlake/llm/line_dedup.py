"""Line dedup across documents by a deletion-neighbourhood join.

Lines are compared by their words, lower-cased (A-Z) and parted by white space; lines without words stay. A line
goes if an equal line, or one within the edit bound, stands earlier, that is at a smaller (id, text hash, line
number). The bound is one word inserted, deleted or replaced for lines of at least ``min_words`` words, and none
for shorter ones.

Two lines are within one edit if they are equal after leaving out the word at the same place of each, or if one
equals the other without one of its words. So each line's variants (the line itself and the line without its
i-th word, each with i) become hashed keys, and grouping equal keys finds every neighbour: for a key only the
earliest line of each i and the line itself are kept, so no pairs are formed however many lines share a key.
The earliest neighbour of a line is then verified word by word.

Before that, two exact reductions: equal lines are combined to one, with its earliest place; and lines that
share neither their first nor their last half with another line have no neighbour, and emit nothing.

Defined results: null stays null and empty stays empty; rows equal in id and text count as one document and lose
the same lines; of rows of one id and several texts the one of the smaller text hash is earlier; null ids are
earliest; empty tables give empty results. Other columns pass through untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import spans
from .tables import checked_broadcast, written

#: Shorter lines of different words often share all but one by chance (README has counts), and are compared for equality.
MIN_WORDS = 5
_SEEDS = [np.uint64(s) for s in (0, 0xA24BAED4963EE407)]
_PLACE = ["__key", "__th", "line"]


def _lines(data: np.ndarray, at: np.ndarray):
    """Row, number in the row, and first and end word of each line with words; hashes of the words."""
    low = spans.LOWER[data]
    starts, ends = spans.runs(~spans.WHITE[low], at)
    words = spans.span_hash(low, starts, ends)
    line_at, line_end = spans.runs(data != 0x0A, at)
    a, b = np.searchsorted(starts, line_at), np.searchsorted(starts, line_end)
    some = b > a
    row, _ = spans.row_of(at, line_at)
    breaks = np.concatenate([[0], np.cumsum(data == 0x0A)])
    number = breaks[line_at] - breaks[at[row]]
    return row[some], number[some], a[some], b[some], words


def _totals(words: np.ndarray) -> list[np.ndarray]:
    return [spans.running(spans.mix(words + s)) for s in _SEEDS]


def _line_rows(min_words: int):
    def found(texts: spans.Text) -> list:
        parts = []
        for _, _, data, at in texts.blocks():
            row, number, a, b, words = _lines(data, at)
            totals = _totals(words)
            h, h2 = (spans.between(t, a, b) for t in totals)
            n = b - a
            halves = []
            for half in (n // 2, (n - 1) // 2):
                halves += [spans.mix(spans.between(totals[0], a, a + half) ^ np.uint64(1)),
                           spans.mix(spans.between(totals[0], b - half, b) ^ np.uint64(2))]
            long = n >= min_words
            keys = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(4 * long)]), pa.int32()),
                                            spans.signed(np.stack(halves, axis=1)[long].ravel()))
            rows = pa.StructArray.from_arrays([pa.array(number.astype(np.int32)), spans.signed(h), spans.signed(h2), keys],
                                              names=["line", "h", "h2", "halves"])
            cuts = pa.array(np.searchsorted(row, np.arange(len(at))), pa.int32())
            parts.append(pa.ListArray.from_arrays(cuts, rows))
        return [pa.concat_arrays(parts) if parts else []]
    return found


def _wanted_lines(schema: T.StructType):
    """Arrow mapper: the words of the wanted lines of each text, with the hashes of all their variants."""
    def run(batches):
        for batch in batches:
            out = [[] for _ in range(6)]
            wanted = batch.column("wanted").to_pylist()
            for r, text in enumerate(batch.column("text").to_pylist()):
                lines = text.split("\n")
                for k in wanted[r]:
                    raw = pa.array([lines[k]], pa.string())
                    data = spans.LOWER[spans.Text(raw).data]
                    starts, ends = spans.runs(~spans.WHITE[data], np.array([0, len(data)]))
                    n, one = len(starts), np.zeros(len(starts), np.int64)
                    h, h2 = (spans.without_one(t, one, one + n, np.arange(n)).view(np.int64).tolist()
                             for t in _totals(spans.span_hash(data, starts, ends)))
                    whole = bytes(data)
                    for column, value in zip(out, (r, k, [whole[a:b].decode() for a, b in zip(starts, ends)], h, h2)):
                        column.append(value)
            take = pa.array(out[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("__key").take(take), batch.column("__th").take(take), pa.array(out[1], pa.int32()),
                 pa.array(out[2], pa.list_(pa.string())), pa.array(out[3], pa.list_(pa.int64())),
                 pa.array(out[4], pa.list_(pa.int64()))], names=schema.names)
    return run


def _within_one_edit(a: Column, b: Column) -> Column:
    """Word arrays differ by at most one word."""
    n, m = F.size(a), F.size(b)
    k = F.least(n, m)
    first = F.array_position(F.zip_with(F.slice(a, F.lit(1), k), F.slice(b, F.lit(1), k), lambda x, y: x != y), True)
    p = F.when(first == 0, k).otherwise(first - 1).cast("int")  # length of the common prefix
    tail = lambda w, size, skip: F.slice(w, p + 1 + skip, F.greatest(size - p - skip, F.lit(0)))
    return F.when(n == m, tail(a, n, 1) == tail(b, m, 1)).when(n == m + 1, tail(a, n, 1) == tail(b, m, 0)) \
        .when(m == n + 1, tail(a, n, 0) == tail(b, m, 1)).otherwise(False)


def _near(every: DataFrame, lines: DataFrame, docs: DataFrame) -> DataFrame:
    """h and h2 of the distinct lines with an earlier line within one edit."""
    halves = every.where(F.size("halves") > 0).select("h", F.explode(F.array_distinct("halves")).alias("k"))
    met = halves.groupBy("k").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a <> b").select("k")
    some = lines.join(checked_broadcast(written(halves.join(met, "k").select("h").distinct(), "half-met")), "h")
    # numbers in corpus order stand for places from here on
    some = written(some.repartitionByRange("first").sortWithinPartitions("first")
                   .select("h", "h2", "first", F.monotonically_increasing_id().alias("no")), "line-candidates")
    places = some.select("first.*").groupBy("__key", "__th").agg(F.collect_list("line").alias("wanted"))
    where = docs.join(
        checked_broadcast(places.withColumnsRenamed({"__key": "k", "__th": "t"})),
        F.col("__key").eqNullSafe(F.col("k")) & (F.col("__th") == F.col("t"))).select("__key", "__th", "text", "wanted")
    kept = T.StructType([docs.schema["__key"], *T.StructType.fromDDL(
        "__th long, line int, words array<string>, v array<long>, v2 array<long>")])
    found = where.mapInArrow(_wanted_lines(kept), kept)
    # rows equal in id and text give equal lines
    found = written(found.select(F.struct(*_PLACE).alias("first"), "words", "v", "v2").join(some, "first").drop("first")
                    .dropDuplicates(["no"]), "line-variants")
    variants = found.select("no", F.posexplode(F.arrays_zip("v", "v2")).alias("i", "z")) \
        .select("no", "i", F.col("z.v").alias("v"), F.col("z.v2").alias("v2"))
    variants = variants.unionByName(found.select("no", F.lit(-1).alias("i"), F.col("h").alias("v"), F.col("h2").alias("v2")))
    met = variants.groupBy("v").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("v")
    shared = written(variants.join(met, "v"), "shared-variants")
    parts, whole = shared.where("i >= 0"), shared.where("i < 0").select("v", "v2", F.col("no").alias("whole"))
    replaced = parts.join(parts.groupBy("v", "v2", "i").agg(F.min("no").alias("other")), ["v", "v2", "i"]).select("no", "other")
    one_less = parts.join(whole, ["v", "v2"]).select("no", "whole")
    longer = one_less.groupBy("whole").agg(F.min("no").alias("other")).withColumnRenamed("whole", "no")
    pairs = replaced.unionByName(longer).unionByName(one_less.withColumnRenamed("whole", "other")) \
        .where("other < no").groupBy("no").agg(F.min("other").alias("other"))
    words = found.select("no", "words", "h", "h2")
    checked = pairs.join(words, "no").join(words.select(F.col("no").alias("other"), F.col("words").alias("others")), "other")
    return checked.where(_within_one_edit(F.col("words"), F.col("others"))).select("h", "h2")


def _without_lines(schema: T.StructType, text: str):
    def run(batches):
        for batch in batches:
            gone = batch.column("__gone").to_pylist()
            texts = batch.column(text).to_pylist()
            left, n_lines = [], []
            for value, drop in zip(texts, gone):
                lines = [] if value is None else value.split("\n")
                n_lines.append(len(lines))
                if drop:
                    drop = set(drop)
                    lines = [x for i, x in enumerate(lines) if i not in drop]
                left.append(None if value is None else "\n".join(lines))
            found = pa.StructArray.from_arrays(
                [pa.array(n_lines, pa.int64()), pa.array([len(x or ()) for x in gone], pa.int64()),
                 pa.array([bool(v and v.strip(" \t\n\v\f\r")) for v in left], pa.bool_()),
                 pa.array([bool(v and v.strip(" \t\n\v\f\r")) for v in texts], pa.bool_())],
                names=["n_lines", "n_removed", "has_words", "had_words"])
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(left, pa.string()) if f.name == text else batch.column(f.name) for f in schema.fields[:-1]],
                 found], names=schema.names)
    return run


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later lines taken out of ``text``, and a struct ``__found``: n_lines, n_removed, has_words
    (whether words are left) and had_words."""
    placed = docs.withColumns({"__key": F.col(key), "__th": F.xxhash64(F.col(text))})
    every = spans.per_text(placed.select("__key", "__th", F.col(text).alias("text")), _line_rows(min_words),
                           "lines array<struct<line: int, h: long, h2: long, halves: array<long>>>", ["__key", "__th"])
    every = written(every.select("__key", "__th", F.explode("__found.lines").alias("l")).select("__key", "__th", "l.*"), "lines")
    lines = written(every.groupBy("h", "h2").agg(F.min(F.struct(*_PLACE)).alias("first"), F.count(F.lit(1)).alias("n")),
                    "distinct-lines")
    near = _near(every, lines, placed.select("__key", "__th", F.col(text).alias("text"))).withColumn("near", F.lit(True))
    # written, so that both sides of the join below are shuffled and a very common line can be split over tasks
    twice = written(lines.join(near, ["h", "h2"], "left").where("n > 1 OR near"), "repeated-lines")
    is_first = F.col("__key").eqNullSafe(F.col("first.__key")) & (F.col("__th") == F.col("first.__th")) \
        & (F.col("line") == F.col("first.line"))
    gone = every.drop("halves").join(twice, ["h", "h2"]).where(F.coalesce("near", F.lit(False)) | ~is_first) \
        .groupBy(F.col("__key").alias("__k"), F.col("__th").alias("__t")).agg(F.collect_set("line").alias("__gone"))
    gone = checked_broadcast(written(gone, "removed-lines"))
    joined = placed.join(gone, F.col("__key").eqNullSafe(F.col("__k")) & (F.col("__th") == F.col("__t")), "left")
    out = T.StructType([*docs.schema.fields, *T.StructType.fromDDL(
        "__found struct<n_lines: long, n_removed: long, has_words: boolean, had_words: boolean>")])
    return joined.select(*docs.columns, "__gone").mapInArrow(_without_lines(out, text), out)


def without_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` after ``dedup_lines``: documents that lost all their words go, and lengths follow the texts."""
    left = dedup_lines(docs, key, text).where("__found.has_words OR NOT __found.had_words")
    if length in docs.columns:
        changed = F.when(F.col("__found.n_removed") > 0, F.length(text)).otherwise(F.col(length))
        left = left.withColumn(length, changed.cast(docs.schema[length].dataType))
    return left.select(docs.columns)
