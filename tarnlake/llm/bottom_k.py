"""MinHash near-dedup with bottom-k sketches from one hash function.

A document's set holds its distinct 5-word shingles, hashed by one function; its sketch is the ``K`` smallest hashes,
or the whole set if that is smaller. Documents of equal sets form one class, and everything below runs on classes.

1. *Inverted lists* of the retained values. Two linked sets share at least ``least_shared`` values of their sketches:
   in the union's sketch, a sample of the union without replacement, each value is shared with the similarity's
   probability, so fewer occur in under one of 10^12 linked pairs (Chernoff); a sketch that is a whole set must share
   the threshold's part of it for certain. Values held by one class leave the lists. A class needs ``least_shared`` of its
   values shared, and by the prefix argument it is enough to list the rarest of them: all but ``least_shared - 1``.
2. *Blocks.* Classes that meet in lists, directly or through others, form a block. In a block, lists of all
   retained values are walked class by class; they add up the overlap with every class before it at once.
3. *Union sketches.* Of classes that overlap enough and are not yet connected, the two sketches are merged; the share
   of the K smallest values of the union that both have estimates the similarity, and low estimates are left.
4. *Exact Jaccard* on the full sets confirms what remains. Only links that connect something new are kept, so a group
   of m near copies costs m links.

A block of more than ``PART`` shingles is cut into parts. Parts are first joined alone, and with part 0; after that only
classes outside the block's largest component can still connect anything, and only these meet the other parts.

Defined results: null, empty and wordless texts have no set, link with nothing and are their own component; repeated
rows share a set; a null id is never the smallest, and a component of null ids alone has a null id; repeated ids count
as one document for the component, with a row for each; empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans
from .ngram_join import shingle_sets
from .tables import checked_broadcast, components, with_flag, written

WORDS, THRESHOLD, K = 5, Fraction(17, 20), 64
#: Shingles that one task joins.
PART = 1_000_000
#: Linked pairs lost by an estimate: less than one of so many.
ODDS = 1e12
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def least_shared(k: int, t: float) -> int:
    """The least number of k sampled values that linked sets share, but for one pair of ODDS (Chernoff's bound)."""
    def divergence(q: float) -> float:
        return (q * math.log(q / t) if q else 0.0) + (1 - q) * math.log((1 - q) / (1 - t))

    return next((s + 1 for s in range(int(k * t), -1, -1) if k * divergence(s / k) >= math.log(ODDS)), 0)


def class_of(s: np.ndarray) -> int:
    """Fingerprint of a set, 63 bits; 0 for the empty set."""
    if not len(s):
        return 0
    mixed = spans.mix(s + np.uint64(0x2545F4914F6CDD1D))
    both = np.array([mixed.sum(), np.bitwise_xor.reduce(mixed)])
    return int(spans.mix(spans.mix(both[:1]) ^ (both[1:] + np.uint64(len(s))))[0] >> np.uint64(1)) or 1


def _ranked(s: np.ndarray) -> np.ndarray:
    """A set in the order of the one hash function."""
    return np.sort(spans.mix(s ^ np.uint64(0x9FB21C651E98DF25)))


def _arrays(sets: list[np.ndarray]) -> pa.Array:
    at = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
    return pa.ListArray.from_arrays(at, spans.signed(np.concatenate(sets)) if sets else pa.array([], pa.int64()))


def sketches(docs: DataFrame, keep: Sequence[str], text: str = "text", words: int = WORDS, k: int = K) -> DataFrame:
    """``keep`` and a struct ``__found``: class of the row's set (0: none), its size, and its k smallest hashes."""
    def found(texts: spans.Text) -> list:
        sets = [_ranked(s) for s in shingle_sets(texts, words)]
        return [np.array([class_of(s) for s in sets], np.int64), np.array([len(s) for s in sets], np.int64),
                _arrays([s[:k] for s in sets])]

    return spans.per_text(docs, found, "c long, size long, sketch array<long>", keep, text=text)


# ---- within a block ---------------------------------------------------------------------------------------

class Block:
    """Sets of one task, ascending in the hash order, with the components they are known to be in."""

    def __init__(self, sets: Sequence[np.ndarray], known: Sequence[int], t: Fraction, k: int) -> None:
        self.sets, self.t, self.k = sets, t, k
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.least = least_shared(k, float(t))
        seen: dict[int, int] = {}
        self.group = np.array([seen.setdefault(c, i) for i, c in enumerate(known)], np.int64)
        self.sketch = np.full((len(sets), k), _NONE)
        for i, s in enumerate(sets):
            self.sketch[i, :min(k, len(s))] = s[:k]
        values, owners = self.sketch.ravel(), np.repeat(np.arange(len(sets)), k)
        inside = values != _NONE
        values, owners = values[inside], owners[inside]
        order = np.argsort(values, kind="stable")  # lists of values, owners ascending in each
        self.owner, new = owners[order], np.ones(len(order), bool)
        new[1:] = values[order][1:] != values[order][:-1]
        start = np.flatnonzero(new)
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        self.start, self.end = start, np.append(start[1:], len(order))
        self.first = np.concatenate([[0], np.cumsum(np.minimum(self.sizes, k))])
        self.lists = number
        tokens = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
        _, where = np.unique(tokens, return_inverse=True)
        cuts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.ids = [where[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        self.mark = np.zeros(int(where.max()) + 1 if len(where) else 0, bool)

    def overlaps(self, i: int) -> np.ndarray:
        """How many retained values of set i every set retains, from the inverted lists."""
        mine = self.lists[self.first[i]:self.first[i + 1]]
        start, size = self.start[mine], self.end[mine] - self.start[mine]
        at = np.arange(size.sum()) + np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        return np.bincount(self.owner[at], minlength=len(self.sets))

    def estimates(self, i: int, others: np.ndarray) -> np.ndarray:
        """Whether the union's sketch has as many shared values as linked sets must have."""
        both = np.sort(np.concatenate([np.broadcast_to(self.sketch[i], (len(others), self.k)), self.sketch[others]], axis=1), axis=1)
        again = np.zeros(both.shape, bool)
        again[:, 1:] = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != _NONE)
        rank = np.cumsum(~again, axis=1)
        shared = (again & (rank <= self.k)).sum(axis=1)
        union = np.minimum((~again & (both != _NONE)).sum(axis=1), self.k)
        # where both sketches are whole sets, the estimate is the similarity itself
        whole = (self.sizes[others] <= self.k) & (self.sizes[i] <= self.k) & (union < self.k)
        return np.where(whole, shared * self.t.denominator >= union * self.t.numerator,
                        (shared >= self.least) | (union < self.k))

    def links(self, stored: np.ndarray, probing: np.ndarray, later: bool) -> list[tuple[int, int]]:
        """Links that connect groups. With ``later``, a set only meets those before it."""
        num, den, found = self.t.numerator, self.t.denominator, []
        for i in np.flatnonzero(probing):
            open_ = stored & (self.group != self.group[i])
            if later:
                open_[i:] = False
            if not open_.any():
                continue
            open_ &= (self.sizes * den >= num * self.sizes[i]) & (self.sizes[i] * den >= num * self.sizes)
            need = np.minimum(self.least, -(-num * np.maximum(self.sizes, self.sizes[i]) // den))
            others = np.flatnonzero(open_)
            others = others[self.overlaps(i)[others] >= need[others]] if len(others) else others
            for lo in range(0, len(others), 4096):
                some = others[lo:lo + 4096]
                some = some[self.estimates(i, some)]
                self.mark[self.ids[i]] = True
                for j in some.tolist():
                    if self.group[j] != self.group[i]:
                        shared = int(self.mark[self.ids[j]].sum())
                        if shared * den >= num * (self.sizes[i] + self.sizes[j] - shared):
                            found.append((int(i), j))
                            self.group[self.group == self.group[j]] = self.group[i]
                self.mark[self.ids[i]] = False
        return found


def _joined(t: Fraction, k: int):
    """Grouped Arrow mapper over the sets of one task."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        flat = table.column("shingles").chunk(0)
        values, at = flat.flatten().to_numpy().view(np.uint64), flat.offsets.to_numpy()
        at = at - at[0]
        c = table.column("c").to_pylist()
        block = Block([values[a:b] for a, b in zip(at[:-1], at[1:])], table.column("known").to_pylist(), t, k)
        stored, probing = (table.column(x).to_numpy(zero_copy_only=False) for x in ("stored", "probing"))
        links = block.links(stored, probing, later=bool((stored & probing).any()))
        return pa.table({"a": pa.array([c[i] for i, _ in links], pa.int64()), "b": pa.array([c[j] for _, j in links], pa.int64())})
    return run


def _task_links(rows: DataFrame, t: Fraction, k: int) -> DataFrame:
    columns = ["block", "task", "c", "shingles", "known", "stored", "probing"]
    return rows.select(columns).groupBy("block", "task").applyInArrow(_joined(t, k), "a long, b long")


def _block_links(sets: DataFrame, t: Fraction, k: int, part: int) -> DataFrame:
    """Links that connect the classes of every block. ``sets``: block, c, shingles (written)."""
    size = sets.groupBy("block").agg(F.ceil(F.sum(F.size("shingles")) / part).cast("long").alias("parts"))
    large = written(size.where("parts > 1"), "large-blocks")
    some = sets.join(checked_broadcast(large), "block", "left").withColumns(
        {"part": F.pmod(F.xxhash64("c"), F.coalesce("parts", F.lit(1))), "known": F.col("c"), "stored": F.lit(True), "probing": F.lit(True)})
    # part 0 goes to every other part, which is joined with it and in itself
    task = F.when((F.col("part") > 0) | F.col("parts").isNull(), F.array("part")) \
        .otherwise(F.sequence(F.lit(1).cast("long"), F.col("parts") - 1))
    links = written(_task_links(some.withColumn("task", F.explode(task)), t, k), "links")
    if large.isEmpty():
        return links
    roots = components(links)
    now = some.where("parts IS NOT NULL").join(roots, F.col("c") == F.col("node"), "left").withColumn("known", F.coalesce("root", "c"))
    counts = now.groupBy("block", "known").agg(F.count(F.lit(1)).alias("n"))
    main = counts.groupBy("block").agg(F.max_by("known", F.struct("n", "known")).alias("main"), F.count(F.lit(1)).alias("groups"))
    now = written(now.join(main.where("groups > 1"), "block").select(
        "block", "c", "shingles", "parts", "part", "known", (F.col("known") != F.col("main")).alias("stray")), "open-blocks")
    strays = written(now.where("stray").groupBy("block").agg(F.ceil(F.sum(F.size("shingles")) / part).cast("long").alias("strays")), "strays")
    now = now.join(checked_broadcast(strays), "block").withColumn("own", F.pmod(F.xxhash64("c", F.lit(1)), F.col("strays")))

    def dealt(rows: DataFrame, upto: Column, task, stored: bool) -> DataFrame:
        return rows.withColumn("task", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), upto - 1), task))) \
            .withColumns({"stored": F.lit(stored), "probing": F.lit(not stored)})

    whole = dealt(now, F.col("strays"), lambda s: F.col("part") * F.col("strays") + s, True)
    probe = dealt(now.where("stray"), F.col("parts"), lambda p: p * F.col("strays") + F.col("own"), False)
    return links.union(written(_task_links(whole.unionByName(probe), t, k), "stray-links"))


# ---- the whole --------------------------------------------------------------------------------------------

def class_links(docs: DataFrame, classes: DataFrame, key: str, text: str, words: int, t: Fraction, k: int, part: int) -> DataFrame:
    """Links between classes that connect what the threshold connects. ``classes``, a written table, has c, size, sketch
    and ``sample``, the key of a document of the class."""
    value = classes.select("c", F.explode("sketch").alias("v"))
    lists = written(value.groupBy("v").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "inverted-lists")
    held = value.join(lists, "v").groupBy("c").agg(F.array_sort(F.collect_list(F.struct("n", "v"))).alias("l")) \
        .join(classes.select("c", "size", "sample"), "c")
    need = F.least(F.lit(least_shared(k, float(t))), F.expr(f"({t.numerator} * size + {t.denominator - 1}) DIV {t.denominator}"))
    few = written(held.where(F.size("l") >= need).select(
        "c", "sample", F.slice("l.v", F.lit(1), (F.size("l") - need + 1).cast("int")).alias("prefix")), "listed-classes")
    meet = few.select("c", F.explode("prefix").alias("v"))
    # written, so that both sides of the join are shuffled and a long list can be split
    least = written(meet.groupBy("v").agg(F.min("c").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").select("v", "b"), "list-heads")
    blocks = components(meet.join(least, "v").select(F.col("c").alias("a"), "b").where("a <> b").distinct())
    blocks = written(blocks.select(F.col("node").alias("c"), F.col("root").alias("block")).join(few.select("c", "sample"), "c"), "block-members")

    sampled = with_flag(docs.select(F.col(key).alias("__key"), F.col(text).alias("text")),
                        blocks.select(F.col("sample").alias("__key")), "__key", "__is").where("__is OR __key IS NULL")

    def sets(x: spans.Text) -> list:
        found = [_ranked(s) for s in shingle_sets(x, words)]
        return [pa.array([class_of(s) for s in found], pa.int64()), _arrays(found)]

    full = spans.per_text(sampled, sets, "c long, shingles array<long>", []).select("__found.*")
    full = full.join(checked_broadcast(blocks.select("c", "block")), "c").dropDuplicates(["c"])
    return _block_links(written(full.select("block", "c", "shingles"), "blocks"), t, k, part)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, t: Fraction = THRESHOLD,
                    k: int = K, part: int = PART) -> DataFrame:
    """key, n_shingles, component_id (the smallest key reachable by links) and kept (key = component_id) of every row."""
    named = docs.select(F.col(key).alias("__key"), F.col(text).alias("text"))
    rows = written(sketches(named, ["__key"], words=words, k=k).select("__key", "__found.*"), "sketches")
    classes = written(rows.where("size > 0").groupBy("c").agg(
        F.min("__key").alias("sample"), F.max("size").alias("size"), F.first("sketch").alias("sketch")), "classes")
    linked = components(class_links(named, classes, "__key", "text", words, t, k, part))
    root = classes.join(linked, F.col("c") == F.col("node"), "left").select("c", "sample", F.coalesce("root", "c").alias("root"))
    # one row for each root; a class is joined to its component through the root's smallest key
    smallest = root.groupBy("root").agg(F.min("sample").alias("component"))
    component = root.join(smallest, "root").select("c", "component")
    found = rows.select("__key", "c", "size").join(component, "c", "left")
    smallest_key = F.when(F.col("size") > 0, F.col("component")).otherwise(F.col("__key"))
    return found.select(F.col("__key").alias(key), F.col("size").alias("n_shingles"), smallest_key.alias("component_id"),
                        F.coalesce(F.col("__key") == smallest_key, F.lit(False)).alias("kept"))
