"""Ranked lexical search over an inverted index with block maxima (Block-Max MaxScore), as one batch of queries.

*Index.* Each task cuts its documents into shards of about ``SHARD`` terms. A shard has one row for its documents
(keys and lengths) and one for each term: its posting list in blocks of ``BLOCK`` postings, compressed as variable-length
gaps and counts, the last document of each block, and the (count, length) pairs of a block that no other posting of
it beats in both. From these pairs the exact maximum score of a block follows for any corpus statistics, so the index
is written in one pass, before those are known.

*Search.* Corpus counts come from the index. Each posting list of a query term gets the queries that use it by a join;
lists of a shard and of a block of queries meet in one task. There, for each query, lists are ordered by their global
bounds. Lists whose bounds together stay below the tenth best score so far are non-essential: documents found in
these alone cannot rank. Postings of essential lists are decompressed for a window of documents at a time; a candidate is
left if its score plus the maxima of its blocks in non-essential lists is too low, before these blocks are decompressed.
The shards' heaps are merged by rank, cut to the best ``k`` within each task first.

Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z is lower-cased. A term
weighs floor(1000 * ln((2N + 2) / (2 df + 1))), and a document's part is (10^9 tf) div (1000 tf + 8 m) with
m = 25 + (75 n N) div L.

Defined results: null and termless texts are no documents for N and never found; repeated rows are documents of their
own and keep a place each; equal scores rank by ascending key, null keys last; repeated items get a list each; items
without a term in the corpus have no rows; empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import spans
from .tables import checked_broadcast, written

#: Terms of a shard, postings of a block, documents of a window, queries of a block.
SHARD, BLOCK, WINDOW, QUERIES = 2_000_000, 128, 1024, 500
TOP = 10


def terms_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of the texts, and the number of terms of each."""
    low = spans.LOWER[data]
    starts, ends = spans.runs(~spans.NOT_ALNUM[low], at)
    _, first = spans.row_of(at, starts)
    return spans.span_hash(low, starts, ends), np.diff(first)


# ---- compression --------------------------------------------------------------------------------------------

def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as bytes of seven bits, the last of each below 128, and where each number ends."""
    values = values.astype(np.uint64)
    width = np.ones(len(values), np.int64)
    for k in range(1, 10):
        width += values >= np.uint64(1) << np.uint64(7 * k)
    ends = np.cumsum(width)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(width.max()) if len(width) else 0):
        here = width > k
        out[(ends - width)[here] + k] = ((values[here] >> np.uint64(7 * k)) & np.uint64(127)) \
            | (np.uint64(128) * (width[here] > k + 1))
    return out, ends


def unpacked(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data < 128) + 1
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    place = np.arange(len(data)) - np.repeat(starts, ends - starts)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), starts) if len(ends) else np.zeros(0, np.int64)


# ---- index ----------------------------------------------------------------------------------------------------

def _schema(key: T.DataType) -> T.StructType:
    return T.StructType([*T.StructType.fromDDL(
        "shard long, term long, df long, total long, last array<int>, ends array<int>, best_tf array<int>, "
        "best_n array<int>, best_ends array<int>, payload binary").fields,
        T.StructField("keys", T.ArrayType(key)), *T.StructType.fromDDL("lengths array<int>").fields])


def _lists(flat: np.ndarray, cuts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat.astype(np.int32)))


def _shard_rows(shard: int, keys: pa.Array, lengths: np.ndarray, hashed: np.ndarray, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    none = lambda name: pa.nulls(1, schema.field(name).type)
    one = np.array([0, len(keys)])
    documents = {"shard": pa.array([shard]), "df": pa.array([int((lengths > 0).sum())]), "total": pa.array([int(lengths.sum())]),
                 "keys": pa.ListArray.from_arrays(pa.array(one, pa.int32()), keys), "lengths": _lists(lengths, one)}
    yield pa.RecordBatch.from_arrays([documents.get(f.name, none(f.name)).cast(f.type) for f in schema], schema=schema)
    if not len(hashed):
        return
    doc = np.repeat(np.arange(len(lengths)), lengths)
    order = np.argsort(hashed, kind="stable")  # by term, then by document
    hashed, doc = hashed[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (hashed[1:] != hashed[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)
    tf = np.diff(np.append(head, len(doc)))
    term, doc = hashed[head], doc[head]
    new_term = np.ones(len(term), bool)
    new_term[1:] = term[1:] != term[:-1]
    first = np.append(np.flatnonzero(new_term), len(term))  # of each term's postings
    df = np.diff(first)
    within = np.arange(len(term)) - np.repeat(first[:-1], df)
    block_start = np.flatnonzero(within % BLOCK == 0)
    block_of = np.cumsum(within % BLOCK == 0) - 1
    blocks = -(-df // BLOCK)
    block_cuts = np.concatenate([[0], np.cumsum(blocks)])
    block_end = np.append(block_start[1:], len(term))
    before = np.where(new_term, -1, np.concatenate([[-1], doc[:-1]]))
    pairs = np.empty(2 * len(doc), np.int64)
    pairs[0::2], pairs[1::2] = doc - before, tf
    data, ends = packed(pairs)
    byte_end = ends[2 * block_end - 1]
    term_byte = np.concatenate([[0], byte_end[block_cuts[1:] - 1]])
    n = lengths[doc]
    by = np.lexsort((n, -tf, block_of))  # in each block: pairs that are beaten by none
    least = np.minimum.accumulate(n[by] + (len(blocks) + len(block_start) - block_of[by]) * (1 << 33))
    best = np.ones(len(by), bool)
    best[1:] = (least[1:] < least[:-1])
    best_ends = np.cumsum(np.bincount(block_of[by][best], minlength=len(block_start)))
    best_cuts = np.concatenate([[0], best_ends[block_cuts[1:] - 1]])
    payload = pa.Array.from_buffers(pa.binary(), len(df), [None, pa.py_buffer(term_byte.astype(np.int32).tobytes()),
                                                           pa.py_buffer(data.tobytes())])
    columns = {"shard": pa.array(np.full(len(df), shard)), "term": spans.signed(term[first[:-1]]), "df": pa.array(df),
               "last": _lists(doc[block_end - 1], block_cuts),
               "ends": _lists(byte_end - np.repeat(term_byte[:-1], blocks), block_cuts),
               "best_tf": _lists(tf[by][best], best_cuts), "best_n": _lists(n[by][best], best_cuts),
               "best_ends": _lists(best_ends - np.repeat(best_cuts[:-1], blocks), block_cuts), "payload": payload}
    yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(len(df), f.type)
                                      for f in schema], schema=schema)


def build(docs: DataFrame, key: str = "doc_id", text: str = "text", shard: int = SHARD) -> DataFrame:
    """The index of all rows of ``docs``, as a written table: a row for each shard, and for each term of each shard."""
    out = _schema(docs.schema[key].dataType)
    schema = to_arrow_schema(out)
    kind = schema.field("keys").type.value_type

    def run(batches):
        task, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def rows():
            keys, counts, hashed = zip(*held)
            return _shard_rows((task << 32) + made, pa.concat_arrays(keys), np.concatenate(counts), np.concatenate(hashed), schema)

        for batch in batches:
            for lo, hi, data, at in spans.Text(batch.column(1)).blocks():
                hashed, counts = terms_of(data, at)
                held.append((batch.column(0)[lo:hi].cast(kind), counts, hashed))
                size += len(hashed) + hi - lo
                if size >= shard:
                    yield from rows()
                    made, held, size = made + 1, [], 0
        if held:
            yield from rows()
        spans.release()

    return written(docs.select(F.col(key), F.col(text)).mapInArrow(run, out), "search-index")


# ---- search -----------------------------------------------------------------------------------------------------

class PostingList:
    """A term's postings in a shard; blocks are decompressed when first needed."""

    def __init__(self, row: dict, lengths: np.ndarray, part) -> None:
        self.df, self.payload = row["df"], np.frombuffer(row["payload"], np.uint8)
        self.last, self.ends = row["last"], row["ends"]
        best_ends = row["best_ends"]
        self.block_bound = np.maximum.reduceat(part(row["best_tf"].astype(np.int64), row["best_n"].astype(np.int64)),
                                               np.concatenate([[0], best_ends[:-1]]))
        self.bound = int(self.block_bound.max())
        self.lengths, self.part_of = lengths, part
        self.done = np.zeros(len(self.last), bool)
        self.doc = np.repeat(self.last, np.diff(np.append(np.arange(len(self.last)) * BLOCK, self.df)))
        self.part = np.zeros(self.df, np.int64)

    def read(self, blocks: np.ndarray) -> None:
        """Decompresses those of ``blocks`` (ascending, distinct) that are still packed."""
        blocks = blocks[~self.done[blocks]]
        if not len(blocks):
            return
        start = np.where(blocks > 0, self.ends[blocks - 1], 0)
        pairs = unpacked(np.concatenate([self.payload[a:b] for a, b in zip(start, self.ends[blocks])]))
        gap, tf = pairs[0::2], pairs[1::2]
        size = np.minimum((blocks + 1) * BLOCK, self.df) - blocks * BLOCK
        head = np.concatenate([[0], np.cumsum(size)[:-1]])
        run = np.cumsum(gap)
        base = np.where(blocks > 0, self.last[blocks - 1], -1) - (run[head] - gap[head])
        doc = run + np.repeat(base, size)
        where = np.arange(len(doc)) - np.repeat(head, size) + np.repeat(blocks * BLOCK, size)
        self.doc[where] = doc
        self.part[where] = self.part_of(tf, self.lengths[doc])
        self.done[blocks] = True

    def window(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from lo to before hi, and their parts."""
        a, b = np.searchsorted(self.last, [lo, hi - 1])
        self.read(np.arange(a, min(b + 1, len(self.last))))
        a, b = np.searchsorted(self.doc, [lo, hi])
        return self.doc[a:b], self.part[a:b]

    def block_of(self, docs: np.ndarray) -> np.ndarray:
        """The block that would hold each document; one past the end for those after the last."""
        return np.searchsorted(self.last, docs)

    def parts(self, docs: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        out = np.zeros(len(docs), np.int64)
        inside = np.flatnonzero(blocks < len(self.last))
        self.read(np.unique(blocks[inside]))
        at = np.searchsorted(self.doc, docs[inside])
        hit = self.doc[at] == docs[inside]
        out[inside[hit]] = self.part[at[hit]]
        return out


def best_of(lists: list[tuple[PostingList, int]], order: np.ndarray, n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (documents, scores) of a query of (list, weight). ``order``: the rank of each document's key."""
    lists = sorted((x for x in lists if x[1] > 0), key=lambda x: x[0].bound * x[1])
    bounds = np.cumsum([0, *[x.bound * w for x, w in lists]])  # bounds[i]: what the i least lists can add
    top_doc, top_score, least = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
    for lo in range(0, n_docs, WINDOW):
        hi = min(lo + WINDOW, n_docs)
        split = int(np.searchsorted(bounds, least, "left")) - 1  # bounds[split] < least: these lists are non-essential
        if split >= len(lists):
            break
        score = np.zeros(hi - lo, np.int64)
        for x, w in lists[split:]:
            doc, part = x.window(lo, hi)
            score[doc - lo] += w * part
        found = np.flatnonzero(score + bounds[split] * (score > 0) >= least)
        docs, score = found + lo, score[found]
        blocks, limit = [], score.copy()
        for x, w in lists[:split]:
            if not len(docs):
                break
            b = x.block_of(docs)
            blocks.append(b)
            limit += w * np.append(x.block_bound, 0)[b]
        stays = limit >= least
        for i in range(split - 1, -1, -1):
            if not stays.any():
                break
            x, w = lists[i]
            here = np.flatnonzero(stays)
            b = blocks[i][here]
            part = w * x.parts(docs[here], b)
            limit[here] += part - w * np.append(x.block_bound, 0)[b]
            score[here] += part
            stays[here] = limit[here] >= least
        top_doc, top_score = np.concatenate([top_doc, docs[stays]]), np.concatenate([top_score, score[stays]])
        first = np.lexsort((order[top_doc], -top_score))[:k]
        top_doc, top_score = top_doc[first], top_score[first]
        if len(first) == k:
            least = max(1, int(top_score[-1]))
    return top_doc, top_score


def _searcher(n: int, total: int, k: int, schema: pa.Schema):
    """Grouped Arrow mapper: the best documents of a shard for each query of a block."""
    def part(tf, length):
        return (1_000_000_000 * tf) // (1000 * tf + 8 * (25 + (75 * length * n) // total))

    def run(table: pa.Table) -> pa.Table:
        of = {name: table.column(name).combine_chunks() for name in table.column_names}
        term = of["term"].to_pylist()
        if len(term) == term.count(None):
            return schema.empty_table()
        home = term.index(None)
        keys, lengths = of["keys"][home].values, of["lengths"][home].values.to_numpy().astype(np.int64)
        order = np.empty(len(keys), np.int64)
        order[pa.compute.sort_indices(keys, null_placement="at_end").to_numpy()] = np.arange(len(keys))
        queries: dict[int, list] = {}
        for i, t in enumerate(term):
            if t is not None:
                row = {c: of[c][i].values.to_numpy() for c in ("last", "ends", "best_tf", "best_n", "best_ends")}
                postings = PostingList(row | {"df": of["df"][i].as_py(), "payload": of["payload"][i].as_buffer()}, lengths, part)
                for u in of["users"][i].as_py():
                    queries.setdefault(u["query"], []).append((postings, u["weight"]))
        found = [(q, *best_of(lists, order, len(keys), k)) for q, lists in sorted(queries.items())]
        docs = np.concatenate([x[1] for x in found])
        return pa.Table.from_arrays([pa.array(np.repeat([x[0] for x in found], [len(x[1]) for x in found])),
                                     keys.take(pa.array(docs)), pa.array(np.concatenate([x[2] for x in found]))], schema=schema)
    return run


def query_terms(items: DataFrame, text: str = "text") -> DataFrame:
    """``query``, ``term`` and how often the item has it. ``items`` has a long column ``query``."""
    def run(batches):
        for batch in batches:
            for lo, hi, data, at in spans.Text(batch.column(1)).blocks():
                hashed, counts = terms_of(data, at)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0)[lo:hi].to_numpy(), counts)), spans.signed(hashed)],
                                                 names=["query", "term"])

    return items.select("query", F.col(text)).mapInArrow(run, "query long, term long").groupBy("query", "term") \
        .agg(F.count(F.lit(1)).alias("times"))


def search(index: DataFrame, items: DataFrame, item: str = "item_id", text: str = "text", k: int = TOP) -> DataFrame:
    """The ``k`` best documents of every item: ``item``, rank, ``found`` (the document's key), score."""
    key = index.schema["keys"].dataType.elementType
    n, total = index.where("term IS NULL").agg(F.coalesce(F.sum("df"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    items = written(items.select(F.col(item).alias("item"), F.col(text).alias("text"))
                    .withColumn("query", F.monotonically_increasing_id()), "search-items")
    wanted = written(query_terms(items), "search-terms")
    n_blocks = max(1, -(-items.count() // QUERIES))
    lists = index.where("term IS NOT NULL")
    vocabulary = checked_broadcast(wanted.select("term").distinct())
    df = lists.select("term", "df").join(vocabulary, "term").groupBy("term").agg(F.sum("df").alias("df_all"))
    weight = F.floor(1000 * F.log((2 * F.lit(n) + 2) / (2 * F.col("df_all") + 1))) * F.col("times")
    users = wanted.join(df, "term").groupBy("term", F.pmod(F.xxhash64("query"), F.lit(n_blocks)).alias("part")) \
        .agg(F.collect_list(F.struct("query", weight.alias("weight"))).alias("users"))
    users = written(users, "search-users")
    columns = ["shard", "part", "term", "df", "last", "ends", "best_tf", "best_n", "best_ends", "payload", "keys", "lengths", "users"]
    asked = lists.join(checked_broadcast(users), "term")
    homes = index.where("term IS NULL").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long")))) \
        .withColumn("users", F.lit(None).cast(users.schema["users"].dataType))
    out = T.StructType([T.StructField("query", T.LongType()), T.StructField("found", key), T.StructField("score", T.LongType())])
    best = asked.select(columns).unionByName(homes.select(columns)).groupBy("shard", "part") \
        .applyInArrow(_searcher(n, total, k, to_arrow_schema(out)), out)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("found"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(items.select("query", "item"), "query").select(F.col("item").alias(item), "rank", "found", "score")
