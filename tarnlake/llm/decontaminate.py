"""Benchmark decontamination with suffix arrays over the training text.

Each block of documents is a shard: its word positions are sorted into a suffix array, and every suffix of the
test items is binary-searched in it. A position can match only if its first words begin some test suffix, so
the others are left out of the array. Suffixes are compared by 64-bit word hashes, 13 words deep, which is as
long as a window is; longer verbatim matches are chains of windows at consecutive positions of item and text, at
all offsets of a window in its item. A match inside a longer one of the same item is not listed.

An item's windows are its runs of 13 words, or all its words if it has fewer. A document word inside an
occurrence of a window is hit. Test items are taken in blocks of at most ``ITEM_BLOCK`` bytes or one item, each passed
over all documents: the driver holds the texts of one block and sends them out, tasks index them, and a pass's result
is written before the next block is fetched. So what the driver and a task hold is bounded for a benchmark of any size,
which costs a pass over the documents for each block.

Defined results: null or empty texts and texts without words have no words and no hits, null or wordless items
no windows; items of the same id count once and items without an id mark words but are not listed; repeated
rows are judged apart; empty tables of documents or items give no rows and no hits. Extra columns pass through.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans
from .tables import written

WINDOW = 13
#: Bytes of benchmark text sent to the tasks and indexed there at a time; the index takes about 40 times as much.
ITEM_BLOCK = 2 << 20
FIELDS = ("n_words long, hits array<struct<start: long, length: long>>, items array<string>, "
          "matches array<struct<item: string, start: long, item_start: long, length: long>>")

#: Pairs of text and item positions chained at once.
PAIRS = 1 << 20

_WIDTH = 8 * WINDOW
_BITS = 20


def _words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and row of each word, and the first word of each row."""
    data = spans.LOWER[data]
    starts, ends = spans.runs(~spans.NOT_ALNUM[data], at)
    row, first = spans.row_of(at, starts)
    return spans.span_hash(data, starts, ends), row, first


def _suffixes(hashed: np.ndarray, at: np.ndarray, length: np.ndarray, fill: int = 0) -> np.ndarray:
    """The first ``length`` words at each position as byte strings that sort like the words' hashes."""
    out = np.full((len(at), WINDOW), fill, np.uint64)
    for k in range(WINDOW):
        there = length > k
        out[there, k] = hashed[at[there] + k]
    return out.astype(">u8").view(f"S{_WIDTH}").ravel()


def _slot(key: np.ndarray) -> np.ndarray:
    return (key >> np.uint64(64 - _BITS)).astype(np.int64)


class TestIndex:
    """The distinct windows of a block of test items, by how many words their first-words key has."""

    def __init__(self, ids: Sequence[str | None], texts: Sequence[str | None]) -> None:
        text = spans.Text(pa.array(texts, pa.string()))
        self.ids = list(ids)
        hashed, _, first = _words(text.data, text.at)
        size = np.diff(first)
        n_windows = np.where(size == 0, 0, np.maximum(size - WINDOW + 1, 1))
        item = np.repeat(np.arange(len(size)), n_windows)
        offset = np.arange(len(item)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        length = np.minimum(size[item], WINDOW)
        low = _suffixes(hashed, first[:-1][item] + offset, length)
        self.low, window = np.unique(low, return_inverse=True)
        one = np.zeros(len(self.low), np.int64)
        one[window] = np.arange(len(item))
        self.length = length[one]
        at = first[:-1][item[one]] + offset[one]
        self.high = _suffixes(hashed, at, self.length, 2**64 - 1)
        # for each window, the items that hold it and where
        order = np.lexsort((offset, item, window))
        w, i, o = window[order], item[order], offset[order]
        new = np.ones(len(w), bool)
        new[1:] = (w[1:] != w[:-1]) | (i[1:] != i[:-1])
        self.item, self.holders = i[new], np.searchsorted(w[new], np.arange(len(self.low) + 1))
        # offsets of each holder, ascending as holder * span + offset
        self.span = int(o.max(initial=0)) + 2
        self.places = (np.cumsum(new) - 1) * self.span + o
        self.heads = []
        for g in (1, 2, 3):
            mine = np.flatnonzero(np.minimum(self.length, 3) == g)
            key = spans.ngram_hash(hashed, first, g)[0][at[mine]]
            bits = np.zeros(1 << _BITS, bool)
            bits[_slot(key)] = True
            self.heads.append((g, mine, key, bits))

    def search(self, hashed: np.ndarray, row: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text position and window of every occurrence in a block of documents."""
        candidate, tests = np.zeros(len(hashed), bool), []
        for g, mine, key, bits in self.heads:
            if len(mine):
                here, whole = spans.ngram_hash(hashed, first, g)
                maybe = np.flatnonzero(whole & bits[_slot(here)])
                real = np.isin(here[maybe], key)
                candidate[maybe[real]] = True
                tests.append(mine[np.isin(key, here[maybe[real]])])
        at = np.flatnonzero(candidate)
        if not len(at):
            return at, at
        array = _suffixes(hashed, at, np.minimum(first[row[at] + 1] - at, WINDOW))
        order = np.argsort(array, kind="stable")
        array, at, tests = array[order], at[order], np.concatenate(tests)
        lo = np.searchsorted(array, self.low[tests], "left")
        n = np.searchsorted(array, self.high[tests], "right") - lo
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return at[np.repeat(lo, n) + nth], np.repeat(tests, n)


def _lists(rows: np.ndarray, n_rows: int, columns: dict[str, pa.Array | np.ndarray]) -> pa.Array:
    """A list of structs for each row; ``rows`` ascends."""
    at = pa.array(np.searchsorted(rows, np.arange(n_rows + 1)), pa.int32())
    return pa.ListArray.from_arrays(at, pa.StructArray.from_arrays([pa.array(c) for c in columns.values()],
                                                                   names=list(columns)))


def _longest(index: TestIndex, q: np.ndarray, holder: np.ndarray, size: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text position, item, offset and length of the chains along item and text that no other of the item contains.

    All offsets of a window count. Chains lie on diagonals, which are taken in ranges of about PAIRS pairs.
    """
    base, parts = holder * index.span, []

    def upto(offset):
        return np.searchsorted(index.places, base + np.clip(offset, 0, index.span - 1))

    pairs = int((upto(np.full(len(q), index.span)) - upto(np.zeros(len(q), np.int64))).sum())
    low, high = -index.span, int(q.max(initial=0)) + 1
    cuts = np.unique(np.linspace(low, high, max(1, -(-pairs // PAIRS)) + 1).astype(np.int64))
    for d, end in zip(cuts[:-1], cuts[1:]):  # d <= q - offset < end
        lo = upto(q - end + 1)
        n = upto(q - d + 1) - lo
        place = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at, h, length = np.repeat(q, n), np.repeat(holder, n), np.repeat(size, n)
        item, offset = index.item[h], index.places[place] - h * index.span
        order = np.lexsort((at, at - offset, item, row[at]))
        at, item, offset, length = at[order], item[order], offset[order], length[order]
        r = row[at]
        new = np.ones(len(at), bool)
        new[1:] = (r[1:] != r[:-1]) | (item[1:] != item[:-1]) | (at[1:] != at[:-1] + 1) | (offset[1:] != offset[:-1] + 1)
        head = np.flatnonzero(new)
        parts.append((at[head], item[head], offset[head], np.diff(np.append(head, len(at))) + length[head] - 1))
    at, item, offset, length = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((offset, -length, at, item, row[at]))
    at, item, offset, length = at[order], item[order], offset[order], length[order]
    r = row[at]
    new = np.ones(len(at), bool)
    new[1:] = (r[1:] != r[:-1]) | (item[1:] != item[:-1])
    far = at + length + np.cumsum(new) * (len(row) + 1)  # furthest end so far in the item
    keep = new.copy()
    keep[1:] |= far[1:] > np.maximum.accumulate(far)[:-1]
    return at[keep], item[keep], offset[keep], length[keep]


def _found(texts: spans.Text, index: TestIndex) -> list:
    parts = []
    for _, _, data, at in texts.blocks():
        n_rows = len(at) - 1
        hashed, row, first = _words(data, at)
        p, window = index.search(hashed, row, first)
        cover = np.zeros(len(hashed) + 1, np.int64)
        np.add.at(cover, p, 1)
        np.add.at(cover, p + index.length[window], -1)
        start, end = spans.runs(np.cumsum(cover[:-1]) > 0, first)
        hits = _lists(row[start], n_rows, {"start": start - first[row[start]], "length": end - start})
        # every (position, item) once for each window
        n = np.diff(index.holders)[window]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        holder = np.repeat(index.holders[window], n) + nth
        q, size = np.repeat(p, n), np.repeat(index.length[window], n)
        item, listed_row = index.item[holder], row[q]
        order = np.lexsort((item, listed_row))
        listed_item, listed_row = item[order], listed_row[order]
        q, item, offset, length = _longest(index, q, holder, size, row)
        r = row[q]
        names = pa.array(index.ids, pa.string())
        matches = _lists(r, n_rows, {"item": names.take(pa.array(item)), "start": q - first[r], "item_start": offset,
                                     "length": length})
        r, item = listed_row, listed_item
        once = np.ones(len(r), bool)
        once[1:] = (r[1:] != r[:-1]) | (item[1:] != item[:-1])
        once &= ~names.is_null().to_numpy(zero_copy_only=False)[item] if len(item) else once
        listed = pa.ListArray.from_arrays(pa.array(np.searchsorted(r[once], np.arange(n_rows + 1)), pa.int32()),
                                          names.take(pa.array(item[once])))
        parts.append([pa.array(np.diff(first)), hits, listed, matches])
    return [pa.concat_arrays(x) for x in zip(*parts)] if parts else [[], [], [], []]


def _item_blocks(items: DataFrame, text: str, block: int) -> list[DataFrame]:
    """The items in blocks of at most about ``block`` bytes of text, a longer item being a block of its own.

    Items are dealt by hash into many cells; neighbouring cells that are small enough together make a block. Only the
    sizes of cells reach the driver, a few for each block.
    """
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    total = items.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    n = 8 * max(1, -(-total // block))
    cell = F.pmod(F.xxhash64("__id", text), F.lit(n))
    if total <= block:
        return [items]
    blocks, held = [[]], 0
    for k, bytes_ in sorted(tuple(r) for r in items.groupBy(cell.alias("cell")).agg(F.sum(size).alias("bytes")).collect()):
        if blocks[-1] and held + bytes_ > block:
            blocks.append([])
            held = 0
        blocks[-1].append(k)
        held += bytes_
    return [items.where(cell.between(b[0], b[-1])) for b in blocks]


def _index_of(sent, name: str) -> TestIndex:
    """The index of the block that was sent out, made once in each process; an earlier block's is dropped."""
    kept = spans.per_process("test-index")
    if name not in kept:
        kept.clear()
        kept[name] = TestIndex(*sent.value)
    return kept[name]


def contamination(docs: DataFrame, items: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", block: int = ITEM_BLOCK) -> DataFrame:
    """``keep`` columns and a struct ``__found``: n_words, n_hit, items, hits, matches, contaminated.

    ``hits`` are the covered runs of words, ``matches`` the longest verbatim matches with their places in text
    and item, ``items`` the sorted distinct ids (as text) of items with an occurring window. A document is
    contaminated if any word is hit and 20 * n_hit >= n_words.
    """
    items = items.select(F.col(item_id).cast("string").alias("__id"), F.col(item_text).alias("__item"))
    kept = [c for c in docs.columns if c in set(keep) | {text}]
    found, names = docs, []
    blocks = _item_blocks(items, "__item", block)
    for k, part in enumerate(blocks):
        rows = part.collect()  # one block
        sent = docs.sparkSession.sparkContext.broadcast(([r[0] for r in rows], [r[1] for r in rows]))
        del rows
        name = uuid.uuid4().hex
        found = spans.per_text(found, lambda t, sent=sent, name=name: _found(t, _index_of(sent, name)), FIELDS, [*kept, *names],
                               f"__found{k}", text)
        names.append(f"__found{k}")
        if len(blocks) > 1:
            found = written(found, "contamination-pass")
            sent.destroy()

    def joined(field: str):
        return F.flatten(F.array(*[F.col(f"{n}.{field}") for n in names]))

    # runs of words covered in any pass, counted once
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def add(acc, hit):
        end = F.greatest(acc["end"], hit["start"] + hit["length"])
        return F.struct(end.alias("end"), (acc["n"] + end - F.greatest(acc["end"], hit["start"])).alias("n"))

    n_words = F.col(f"{names[0]}.n_words")
    done = found.select(*keep, n_words.alias("__n"), F.array_sort(joined("hits")).alias("__hits"),
                        F.array_sort(F.array_distinct(joined("items"))).alias("__items"), joined("matches").alias("__m"))
    done = done.withColumn("__hit", F.aggregate("__hits", start, add, lambda acc: acc["n"]))
    return done.select(*keep, F.struct(
        F.col("__n").alias("n_words"), F.col("__hit").alias("n_hit"), F.col("__items").alias("items"),
        F.col("__hits").alias("hits"), F.col("__m").alias("matches"),
        ((F.col("__hit") > 0) & (20 * F.col("__hit") >= F.col("__n"))).alias("contaminated")).alias("__found"))
