import re
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tarnlake.llm import decontaminate, packing, queries, training_order

from .cases import awkward, empty, frame, words


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_hits(text, items):
    w, hit, found = tokens(text), set(), set()
    for item, t in items:
        b = tokens(t)
        n = min(len(b), 13)
        windows = {tuple(b[i:i + n]) for i in range(len(b) - n + 1)} if n else set()
        for p in range(len(w) - n + 1 if n else 0):
            if tuple(w[p:p + n]) in windows:
                hit.update(range(p, p + n))
                if item is not None:
                    found.add(item)
    return len(w), len(hit), sorted(map(str, found))


def test_contamination_equals_plain_python(spark):
    passages = [words(70 + i, n) for i, n in enumerate((40, 13, 25, 12, 5, 1, 2))]
    items = [(i, " ".join(p).capitalize() + ".") for i, p in enumerate(passages)]
    items += [(2, "again " + items[2][1]), (None, " ".join(words(80, 20))), (30, None), (31, "... --"), (32, "a a a a a a a a a a a a a a a a")]
    rows = list(awkward())
    for i in range(40):
        p = passages[i % len(passages)]
        w = words(200 + i, 60 + 40 * (i % 4))
        a, b = sorted((i * 7 % (len(p) + 1), len(p)))
        w[20:20] = p[a:b] if i % 3 else p
        if i % 5 == 0:
            w += p[:20] + ["a"] * 30
        rows.append((500 + i, ", ".join(w).upper() if i % 2 else " ".join(w)))
    rows.append((600, " ".join(words(80, 20))))
    docs, bench = frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    results = []
    for block in (decontaminate.ITEM_BLOCK, 200):  # one pass, and several
        got = decontaminate.contamination(docs, bench, keep=["doc_id", "text", "n_words"], block=block).collect()
        assert len(got) == len(rows)
        for r in got:
            f = r["__found"]
            n, hits, found = brute_hits(r["text"], items)
            assert (f["n_words"], f["n_hit"], f["items"]) == (n, hits, found), r["doc_id"]
            assert f["contaminated"] == (hits > 0 and 20 * hits >= n)
        results.append(got)
    # matches are verbatim and as long as they can be
    for r in results[0]:
        w = tokens(r["text"])
        for item, start, item_start, length in r["__found"]["matches"]:
            texts = [tokens(t) for i, t in items if str(i) == item or (i is None and item is None)]
            assert any(w[start:start + length] == b[item_start:item_start + length] for b in texts)
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r[1]["n_hit"] for r in decontaminate.contamination(docs, none).collect()} == {0}
    assert decontaminate.contamination(empty(spark), bench).count() == 0


def test_items_are_fetched_in_bounded_blocks(spark):
    r = __import__("random").Random(3)
    items = [(i, " ".join(words(300 + i, r.randrange(0, 40)))) for i in range(60)] + [(60, " ".join(words(1, 3000))), (61, None)]
    frame_ = spark.createDataFrame(items, "__id long, t string")
    blocks = decontaminate._item_blocks(frame_, "t", 2000)
    found = [[tuple(x) for x in b.collect()] for b in blocks]
    assert sorted(x for b in found for x in b) == sorted(items, key=lambda x: x[0])
    size = [sum(len(t or "") for _, t in b) for b in found]
    assert len(blocks) > 5 and all(n <= 2000 for n, b in zip(size, found) if 60 not in dict(b))


def test_matches_of_items_that_repeat_a_window(spark, monkeypatch):
    a, b, c = words(90, 15), words(91, 20), words(92, 20)
    item = a + b + a + c
    docs = frame(spark, [(1, " ".join(["x", *b[-5:], *a, *c[:9]])), (2, " ".join(["y"] * 40))])
    bench = spark.createDataFrame([(7, " ".join(item)), (8, " ".join(["y"] * 20))], "item_id long, text string")
    for pairs in (decontaminate.PAIRS, 7):  # all diagonals at once, and few at a time
        monkeypatch.setattr(decontaminate, "PAIRS", pairs)
        got = {r[0]: [tuple(m) for m in r[1]["matches"]] for r in decontaminate.contamination(docs, bench).collect()}
        assert got[1] == [("7", 1, 30, 29)]
        assert got[2] == [("8", p, 0, 20) for p in range(21)]


def test_pieces_of_every_document(spark, sf):
    encode = queries.tokenizer_json()
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_str(encode)
    # ids that repeat are told apart by their text here
    rows = [(i, t) for i, (_, t) in enumerate(awkward())]
    docs = frame(spark, rows).unionByName(spark.read.parquet(f"{sf}/documents.parquet").withColumn(
        "doc_id", F.col("doc_id") + 1000), allowMissingColumns=True)
    got = packing.pack(docs, encode, group=20_000).select("doc_id", "__found.*").collect()
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(text)
    for k, of in pieces.items():
        of.sort(key=lambda r: r["start"])
        ids = np.array(tokenizer.encode(text[k] or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
        assert b"".join(r["ids"] for r in of) == ids
        assert [r["start"] for r in of] == np.cumsum([0, *[r["length"] for r in of]])[:-1].tolist()
        assert {r["doc_tokens"] for r in of} == {len(ids) // 4}
    not_full = 0
    for of in sequences.values():
        of.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in of] == np.cumsum([0, *[r["length"] for r in of]])[:-1].tolist()
        size = sum(r["length"] for r in of)
        assert size <= 2048 and len({r["tier"] for r in of}) == 1
        not_full += size not in packing.TIERS
    assert not_full <= docs.rdd.getNumPartitions()
    assert packing.pack(empty(spark), encode).count() == 0


def test_step_groups_are_balanced():
    sizes = [2048] * 100 + [1024] * 57 + [256] * 33
    of = packing._steps(sizes, 65_536)
    load = defaultdict(int)
    for size, k in zip(sizes, of):
        load[k] += size
    assert max(load.values()) - min(load.values()) <= 2048


def test_pieces_left_over_are_fewer_than_the_smallest_tier():
    full, rest = packing.pack_pieces([3000, 5, 700, 300, 255, 2048, 0, 1024])
    assert all(sum(n for _, _, n in w) in packing.TIERS for w in full) and sum(n for _, _, n in rest) < 256


# ---- training order

def test_permutation_is_one_to_one_and_reversible():
    for n in (1, 2, 3, 5, 64, 1000, 4097):
        slots = training_order.permute(np.arange(n), n, key=9)
        assert sorted(slots) == list(range(n))
        assert (training_order.permute(slots, n, 9, back=True) == np.arange(n)).all()
    assert (training_order.permute(np.arange(1000), 1000, 1) != training_order.permute(np.arange(1000), 1000, 2)).any()


def test_shards_round_trip(spark):
    definition = queries.tokenizer_json()
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_str(definition)
    docs = frame(spark, awkward()).coalesce(1)
    shards, manifest = training_order.materialise(docs, definition, key=4, seq_len=128, per_shard=100)
    manifest = {r["slot"]: r for r in manifest.collect()}
    back = {r["slot"]: r["ids"] for r in training_order.read_slots(spark, shards).collect()}
    assert sorted(back) == sorted(manifest) == list(range(shards.n)) and shards.count > 3
    ids = []
    for r in docs.collect():
        ids += tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1]
    assert sum(r["n_tokens"] for r in manifest.values()) == len(ids)
    ids += [1] * (-len(ids) % 128)
    for number, slot in enumerate(training_order.permute(np.arange(shards.n), shards.n, 4)):
        assert np.frombuffer(back[slot], "<u2").tolist() == ids[number * 128:(number + 1) * 128]
        assert manifest[slot]["shard"] == slot // 100 and manifest[slot]["byte_offset"] == slot % 100 * shards.stride
    later = training_order.read_slots(spark, shards, 150, 333).collect()
    assert sorted(r["slot"] for r in later) == list(range(150, 333)) and all(r["ids"] == back[r["slot"]] for r in later)
    raw = spark.read.format("binaryFile").load(f"{shards.path}/shard=1/part-*").first()["content"]
    assert len(raw) == 100 * shards.stride and zlib.crc32(raw[:256]) == zlib.crc32(back[100])


def test_no_sequences(spark):
    shards, manifest = training_order.materialise(empty(spark), queries.tokenizer_json(), key=1)
    assert shards.n == 0 and manifest.count() == 0 and training_order.read_slots(spark, shards).count() == 0


def test_tasks_write_many_shards_and_slots_read_back(spark):
    import os
    definition = queries.tokenizer_json()
    docs = frame(spark, awkward()).repartition(3)
    found = {}
    for tasks in (1, 3, 1000):
        shards, manifest = training_order.materialise(docs.orderBy("doc_id", "text"), definition, key=9, seq_len=64, per_shard=37, tasks=tasks)
        assert shards.count >= 20
        files = [(d, n) for d, _, names in os.walk(shards.path) for n in names if n.startswith("part-")]
        assert len(files) == shards.count and len({n.split("-")[1] for _, n in files}) <= tasks
        found[tasks] = [(r.slot, bytes(r.ids)) for r in training_order.read_slots(spark, shards).orderBy("slot").collect()]
        assert [s for s, _ in found[tasks]] == list(range(shards.n)) == sorted(r.slot for r in manifest.select("slot").collect())
        some = training_order.read_slots(spark, shards, 70, 80).orderBy("slot").collect()
        assert [(r.slot, bytes(r.ids)) for r in some] == found[tasks][70:80]
    assert found[1] == found[3] == found[1000]
