"""N-gram Jaccard self-join with prefix trees, and the classes that its links form.

A document's set holds its distinct 5-word shingles as 64-bit hashes. Documents of equal sets form one class;
everything below runs on classes, so copies cost one row each. For a threshold t, sets of sizes m and n link
when the intersection is at least t of the union, so each misses at most floor((1 - t) * size) of its own.

1. *Candidates by sampled prefixes.* In hash order, the first ``misses + l`` shingles of linked sets share at
   least ``l`` of them (``l`` a tenth of the smaller set, plus one). Each class sends that prefix only; a shingle that
   many documents of a task hold is combined there and sent once for each million. A class stays if enough of its prefix occurs elsewhere.
2. *Global order.* For the classes left, shingles are counted; rarer ones come first. Classes with more
   unshared shingles than they may miss drop out. The others meet by their shared prefix shingles, and
   connected classes form a block: linked sets are always in one block.
3. *Prefix trees.* A block's sets, in one order of its shingles with the most frequent first, are stored in a
   trie with shared paths. Each set walks it, adding up overlap once for all sets below a node, and leaves a
   subtree when the remaining lengths cannot reach the threshold, or when it is linked to all sets there already.
   Every link between sets not yet connected is verified exactly, so classes come out as if all pairs were compared.
4. *Large blocks* are cut into parts of bounded size. Part 0 meets every other part first. Then only sets outside
   the block's largest class, which are the ones that can still join anything, meet all other parts.

Defined results: null, empty and wordless texts have no set, link with nothing and are their own component;
repeated rows share a set; a null id is never the smallest, and a component of null ids alone has a null id;
repeated ids count as one document for the component, with a row for each; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans
from .tables import checked_broadcast, components, with_flag, written

N, THRESHOLD = 5, Fraction(4, 5)
#: Shingles of a block that one task joins, and prefix shingles combined before they are sent.
PART, COMBINED = 4_000_000, 1_000_000


# ---- sets -----------------------------------------------------------------------------------------------

def shingle_sets(texts: spans.Text, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, _, data, at in texts.blocks():
        data = spans.LOWER[data]
        starts, ends = spans.runs(~spans.WHITE[data], at)
        row, first = spans.row_of(at, starts)
        hashed = spans.span_hash(data, starts, ends)
        shingle, whole = spans.ngram_hash(hashed, first, n)
        size = np.diff(first)
        for k in range(1, n):  # texts of fewer words: their whole sequence
            mine = first[:-1][size == k]
            shingle[mine] = spans.ngram_hash(hashed, first, k, seed=k)[0][mine]
            whole[mine] = True
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            yield np.unique(shingle[a:b][whole[a:b]])


def _class_of(s: np.ndarray) -> int:
    """Fingerprint of a set: 63 bits of the mixed sum of its mixed hashes; 0 for the empty set."""
    if not len(s):
        return 0
    total = np.array([spans.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(), len(s)], np.uint64)
    return int(spans.mix(spans.mix(total[:1]) + total[1:])[0] >> np.uint64(1)) or 1


def _misses(size, t: Fraction):
    """How many of its own shingles a linked set may miss, at most."""
    return (t.denominator - t.numerator) * size // t.denominator


def _classes(texts: spans.Text, n: int) -> list:
    sets = [(_class_of(s), len(s)) for s in shingle_sets(texts, n)]
    return [np.array([x[0] for x in sets], np.int64), np.array([x[1] for x in sets], np.int64)]


# ---- 1. candidates ----------------------------------------------------------------------------------------

def _prefix_rows(n: int, t: Fraction):
    """Arrow mapper: (key, class, shared). Each distinct prefix shingle of COMBINED is sent once, with one class.

    shared: 0 or -1 for a shingle of one or of several classes met together; above 0, a class and how many of
    its prefix shingles it shares among those.
    """
    def combined(done: dict[int, np.ndarray]) -> pa.RecordBatch:
        token = np.concatenate(list(done.values()))
        owner = np.repeat(np.fromiter(done, np.int64, len(done)), [len(s) for s in done.values()])
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        new = np.ones(len(token), bool)
        new[1:] = token[1:] != token[:-1]
        head = np.flatnonzero(new)
        several = np.diff(np.append(head, len(token))) > 1
        known, times = np.unique(owner[~new], return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([spans.signed(token[head]), pa.array(known)]),
             pa.array(np.concatenate([owner[head], known])),
             pa.array(np.concatenate([-several.astype(np.int64), times]))], names=["key", "c", "shared"])

    def run(batches):
        done: dict[int, np.ndarray] = {}
        held = 0
        for batch in batches:
            for s in shingle_sets(spans.Text(batch.column(0)), n):
                c = _class_of(s)
                if c and c not in done:
                    done[c] = s[:_misses(len(s), t) + len(s) // 10 + 1].copy()
                    held += len(done[c])
                if held >= COMBINED:
                    yield combined(done)
                    done, held = {}, 0
        if done:
            yield combined(done)

    return run


def _shared_counts(batches):
    """Arrow mapper over rows sorted by key: (class, shingles of it that another row of the key has)."""
    last: tuple[int, int, bool] | None = None  # key, class, counted
    for batch in batches:
        key, c, shared = (x.to_numpy() for x in batch.columns)
        out_c, out_n = [c[shared > 0]], [shared[shared > 0]]
        key, c, alone = key[shared <= 0], c[shared <= 0], shared[shared <= 0] == 0
        if len(key):
            same = np.zeros(len(key), bool)
            equal = key[1:] == key[:-1]
            same[1:] |= equal
            same[:-1] |= equal
            if last is not None and last[0] == key[0]:
                same[0] = True
                if not last[2]:
                    out_c.append(np.array([last[1]]))
                    out_n.append(np.array([1]))
            counted = same | ~alone
            out_c.append(c[counted])
            out_n.append(np.ones(counted.sum(), np.int64))
            last = (int(key[-1]), int(c[-1]), bool(counted[-1]))
        cs, where = np.unique(np.concatenate(out_c), return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cs), pa.array(np.bincount(where, np.concatenate(out_n), len(cs)).astype(np.int64))],
            names=["c", "n"])


# ---- 3. prefix trees --------------------------------------------------------------------------------------

class _Node:
    __slots__ = ("part", "after", "children", "ends", "least", "most", "some", "mixed")

    def __init__(self, part: np.ndarray, after: int) -> None:
        self.part = part  # shingles of this node's path, below its parent's
        self.after = after  # the most shingles that follow below
        self.children: dict[int, _Node] = {}
        self.ends: list[int] = []  # sets that end here
        self.least, self.most = 1 << 62, 0  # sizes of the sets below
        self.some, self.mixed = -1, False  # a set below; whether sets of several classes are


class TrieJoin:
    """Sets as ascending ranks in one order; classes by union and find."""

    def __init__(self, n_ranks: int, sizes: Sequence[int], t: Fraction) -> None:
        self.sizes, self.root, self.up, self.t = sizes, _Node(np.zeros(0, np.int64), 0), list(range(len(sizes))), t
        self.mark = np.zeros(n_ranks, np.int64)

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def insert(self, i: int, s: np.ndarray) -> None:
        node, at, size = self.root, 0, self.sizes[i]
        while True:
            node.least, node.most = min(node.least, size), max(node.most, size)
            node.after = max(node.after, len(s) - at)
            if node.some < 0:
                node.some = i
            elif not node.mixed and self.find(node.some) != self.find(i):
                node.mixed = True
            if at == len(s):
                node.ends.append(i)
                return
            child = node.children.get(int(s[at]))
            if child is None:
                child = node.children[int(s[at])] = _Node(s[at:], 0)
                at = len(s)
            else:
                k = min(len(child.part), len(s) - at)
                differs = np.flatnonzero(child.part[:k] != s[at:at + k])
                k = int(differs[0]) if len(differs) else k
                if k < len(child.part):  # the path forks within the child
                    top = _Node(child.part[:k], child.after + len(child.part) - k)
                    top.least, top.most, top.some, top.mixed = child.least, child.most, child.some, child.mixed
                    child.part = child.part[k:]
                    top.children[int(child.part[0])] = child
                    node.children[int(s[at])] = child = top
                at += k
            node = child

    def probe(self, i: int, s: np.ndarray) -> list[tuple[int, int]]:
        """Links of set i to sets of other classes in the tree, one for each class met."""
        num, den = self.t.numerator, self.t.denominator
        size, mine, links = self.sizes[i], self.find(i), []
        self.mark[s] = 1
        stack = [(self.root, 0, 0)]  # node, overlap above, members of s that are in order before the node
        while stack:
            node, overlap, passed = stack.pop()
            if node.mixed and not node.ends and all(not c.mixed for c in node.children.values()):
                node.mixed = len({self.find(c.some) for c in node.children.values()}) > 1
            if not node.mixed and node.some >= 0 and self.find(node.some) == mine:
                continue
            if node.most * den < num * size or size * den < num * node.least:
                continue
            if len(node.part):
                overlap += int(self.mark[node.part].sum())
                passed = int(np.searchsorted(s, node.part[-1], "right"))
            best = overlap + min(node.after, len(s) - passed)
            # intersection >= t * union: (den + num) * intersection >= num * (sum of sizes)
            if (den + num) * best < num * (size + max(node.least, -(-num * size // den))):
                continue
            for j in node.ends:
                if (den + num) * overlap >= num * (size + self.sizes[j]) and self.find(j) != mine:
                    links.append((i, j))
                    self.up[self.find(j)] = mine
            stack.extend((c, overlap, passed) for c in node.children.values())
        self.mark[s] = 0
        return links


def trie_links(sets: Sequence[np.ndarray], sizes: Sequence[int], t: Fraction, stored: Sequence[bool] | None = None,
               probing: Sequence[bool] | None = None, known: Sequence[int] | None = None) -> list[tuple[int, int]]:
    """Links that connect the sets' classes. ``sizes`` count shingles left out of ``sets`` because no other has them.

    With ``stored`` and ``probing`` only sets of the one kind are put in the tree and only those of the other
    walk it. ``known`` has classes that are connected already.
    """
    token = np.concatenate(sets) if len(sets) else np.zeros(0, np.int64)
    values, where, times = np.unique(token, return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, -times))] = np.arange(len(values))
    cuts = np.cumsum([0, *map(len, sets)])
    ranked = [np.sort(rank[where[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])]
    join = TrieJoin(len(values), sizes, t)
    if known is not None:
        seen: dict[int, int] = {}
        for i, k in enumerate(known):
            join.up[i] = seen.setdefault(k, i)
    links = []
    for i in sorted(range(len(sets)), key=lambda i: (sizes[i], ranked[i].tobytes())):
        if probing is None:
            links += join.probe(i, ranked[i])
        if stored is None or stored[i]:
            join.insert(i, ranked[i])
    if probing is not None:
        for i in range(len(sets)):
            if probing[i]:
                links += join.probe(i, ranked[i])
    return links


def _block_links(t: Fraction):
    """Grouped Arrow mapper over the rows of one task's sets: block, pass, c, size, shingles, known, stored, probing."""
    def run(table: pa.Table) -> pa.Table:
        c = table.column("c").to_pylist()
        flat = table.column("shingles").combine_chunks()
        flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
        values, at = flat.flatten().to_numpy(), flat.offsets.to_numpy() - flat.offsets[0].as_py()
        sets = [values[a:b] for a, b in zip(at[:-1], at[1:])]
        split = table.column("split")[0].as_py()
        kind = lambda name: table.column(name).to_pylist() if split else None
        links = trie_links(sets, table.column("size").to_pylist(), t, kind("stored"), kind("probing"),
                           table.column("known").to_pylist())
        return pa.table({"a": pa.array([c[i] for i, _ in links], pa.int64()),
                         "b": pa.array([c[j] for _, j in links], pa.int64())})
    return run


def _task_links(rows: DataFrame, t: Fraction) -> DataFrame:
    """Links within each (block, task)."""
    columns = ["block", "task", "c", "size", "shingles", "known", "stored", "probing", "split"]
    return rows.select(columns).groupBy("block", "task").applyInArrow(_block_links(t), "a long, b long")


def _links(sets: DataFrame, t: Fraction, part: int) -> DataFrame:
    """Links that connect the classes of every block. ``sets``: block, c, size, shingles (written)."""
    weight = sets.groupBy("block").agg(F.sum(F.size("shingles")).alias("w"), F.count(F.lit(1)).alias("m"))
    parts = F.ceil(F.col("w") / part).cast("long")
    large = written(weight.where(parts > 1).select("block", parts.alias("parts")), "large-blocks")
    spread = sets.join(checked_broadcast(large), "block", "left") \
        .withColumn("part", F.pmod(F.xxhash64("c"), F.coalesce("parts", F.lit(1))))
    base = [F.col(x) for x in ("block", "c", "size", "shingles")]
    small = spread.where("parts IS NULL").select(
        *base, F.lit(0).cast("long").alias("task"), F.col("c").alias("known"), F.lit(True).alias("stored"),
        F.lit(True).alias("probing"), F.lit(False).alias("split"))
    # part 0 meets itself and each other part
    first = spread.where("parts IS NOT NULL").withColumn(
        "task", F.explode(F.when(F.col("part") == 0, F.sequence(F.lit(1).cast("long"), F.col("parts") - 1))
                          .otherwise(F.array("part"))))
    first = first.select(*base, "task", F.col("c").alias("known"), F.lit(True).alias("stored"),
                         F.lit(True).alias("probing"), F.lit(False).alias("split"))
    links = written(_task_links(small.unionByName(first), t), "links")
    if large.isEmpty():
        return links
    roots = components(links)
    now = spread.where("parts IS NOT NULL").join(roots, F.col("c") == F.col("node"), "left") \
        .withColumn("known", F.coalesce("root", "c")).drop("node", "root")
    count = now.groupBy("block", "known").agg(F.count(F.lit(1)).alias("n"))
    main = count.groupBy("block").agg(F.max_by("known", F.struct("n", "known")).alias("main"),
                                      F.count(F.lit(1)).alias("classes"))
    # sets outside the largest class, cut into parts of their own, meet every other part
    now = written(now.join(main.where("classes > 1"), "block").withColumn("stray", F.col("known") != F.col("main")), "open")
    weight = now.where("stray").groupBy("block").agg(F.ceil(F.sum(F.size("shingles")) / part).cast("long").alias("strays"))
    now = now.join(checked_broadcast(weight), "block").withColumn("own", F.pmod(F.xxhash64("known", "c"), F.col("strays")))
    task = lambda p, s: p * F.col("strays") + s
    whole = now.withColumn("task", F.explode(F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("strays") - 1), lambda s: task(F.col("part"), s)))).select(
        *base, "task", "known", F.lit(True).alias("stored"), F.lit(False).alias("probing"), F.lit(True).alias("split"))
    probe = now.where("stray").withColumn("task", F.explode(F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda p: task(p, F.col("own"))))).select(
        *base, "task", "known", F.lit(False).alias("stored"), F.lit(True).alias("probing"), F.lit(True).alias("split"))
    return links.union(written(_task_links(whole.unionByName(probe), t), "stray-links"))


# ---- the join ---------------------------------------------------------------------------------------------

def membership(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", n: int = N) -> DataFrame:
    """``keep`` columns and a struct ``__found``: the class of the row's set (0: none) and the set's size."""
    return spans.per_text(docs, lambda x: _classes(x, n), "c long, size long", keep, text=text)


def class_links(docs: DataFrame, classes: DataFrame, key: str = "doc_id", text: str = "text", n: int = N,
                t: Fraction = THRESHOLD, part: int = PART) -> DataFrame:
    """Links (a, b) between classes that connect what the Jaccard threshold connects.

    ``classes`` has c, size and ``sample``, the id of a document of the class, as written table.
    """
    misses = F.expr(f"{t.denominator - t.numerator} * size DIV {t.denominator}")
    # what the larger of two linked sets shares is bounded by the smaller one's prefix
    least = F.expr(f"{t.numerator} * size DIV {10 * t.denominator} + 1")
    rows = docs.select(text).mapInArrow(_prefix_rows(n, t), "key long, c long, shared long")
    counts = rows.repartition("key").sortWithinPartitions("key").mapInArrow(_shared_counts, "c long, n long")
    counts = counts.groupBy("c").agg(F.sum("n").alias("shared"))
    few = written(classes.join(counts, "c").where(F.col("shared") >= least)
                  .select("c", "size", "sample"), "candidates")

    sampled = with_flag(docs.select(key, text), few.select(F.col("sample").alias(key)), key, "__is") \
        .where(F.col("__is") | F.col(key).isNull())

    def sets(x: spans.Text) -> list:
        found = list(shingle_sets(x, n))
        at = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
        flat = spans.signed(np.concatenate(found)) if found else pa.array([], pa.int64())
        return [pa.array([_class_of(s) for s in found], pa.int64()), pa.ListArray.from_arrays(at, flat)]

    shingles = spans.per_text(sampled, sets, "c long, shingles array<long>", [], text=text)
    shingles = shingles.select("__found.*").join(checked_broadcast(few.select("c", "size")), "c").dropDuplicates(["c"])
    held = written(shingles, "shingles")
    token = held.select("c", F.explode("shingles").alias("s"))
    often = token.groupBy("s").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    common = token.join(often, "s").groupBy("c").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("l"))
    unshared = F.col("size") - F.size("l")
    sets2 = common.join(held.select("c", "size"), "c").where(unshared <= misses) \
        .select("c", "size", F.col("l.s").alias("shingles"),
                F.slice("l.s", F.lit(1), (misses + 1 - unshared).cast("int")).alias("prefix"))
    sets2 = written(sets2, "ordered-sets")
    meet = sets2.select("c", F.explode("prefix").alias("s"))
    least = meet.groupBy("s").agg(F.min("c").alias("b"), F.count(F.lit(1)).alias("k")).where("k > 1")
    blocks = components(meet.join(least, "s").select(F.col("c").alias("a"), "b").where("a <> b").distinct())
    blocked = written(sets2.join(blocks, F.col("c") == F.col("node"))
                      .select(F.col("root").alias("block"), "c", "size", "shingles"), "blocks")
    return _links(blocked, t, part)


def classes_of(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, t: Fraction = THRESHOLD,
               part: int = PART) -> DataFrame:
    """key, n_shingles and component_id (the smallest key reachable by links) of every row of ``docs``."""
    rows = written(membership(docs, [key], text, n).select(F.col(key).alias("__key"), "__found.c", "__found.size"), "sets")
    classes = written(rows.where("size > 0").groupBy("c")
                      .agg(F.min("__key").alias("sample"), F.max("size").alias("size")), "classes")
    linked = components(class_links(docs, classes, key, text, n, t, part))
    root = classes.join(linked, F.col("c") == F.col("node"), "left").select("c", "sample", F.coalesce("root", "c").alias("root"))
    # one row for each root; a class is joined to its component through the root's smallest key
    smallest = root.groupBy("root").agg(F.min("sample").alias("component"))
    component = root.join(smallest, "root").select("c", "component")
    found = rows.join(component, "c", "left")
    return found.select(F.col("__key").alias(key), F.col("size").alias("n_shingles"),
                        F.when(F.col("size") > 0, F.col("component")).otherwise(F.col("__key")).alias("component_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, t: Fraction = THRESHOLD,
                part: int = PART) -> DataFrame:
    """The document of the smallest (key, text hash) of every component; of equal rows one; all documents without a set."""
    row = F.struct(F.col(key).isNull(), F.col(key), F.xxhash64(text))  # null keys are never the smallest
    marked = docs.withColumn("__row", row)
    found = classes_of(marked.select("__row", F.col(text).alias("text")), "__row", "text", n, t, part)
    stays = written(found.where("n_shingles = 0 OR __row = component_id").groupBy("__row")
                    .agg(F.when(F.max("n_shingles") > 0, F.count(F.lit(1))).otherwise(1).alias("__copies")), "stays")
    joined = marked.join(checked_broadcast(stays), "__row")
    again = joined.where("__copies > 1").dropDuplicates(["__row"])
    return joined.where("__copies = 1").select(docs.columns).union(again.select(docs.columns))
