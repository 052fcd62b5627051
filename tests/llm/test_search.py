import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tarnlake.llm import ranked_search

from .cases import awkward, empty, frame, words


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k=10):
    parsed = [(key, Counter(terms(t))) for key, t in docs]
    size = [sum(c.values()) for _, c in parsed]
    n, total = sum(s > 0 for s in size), sum(size)
    df = Counter(t for _, c in parsed for t in c)
    out = []
    for item, text in items:
        scored = []
        for (key, c), s in zip(parsed, size):
            score = 0
            for t, times in Counter(terms(text)).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    m = 25 + (75 * s * n) // total
                    score += times * w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, key is None, key or 0))
        out += [(item, rank, None if none else key, -score) for rank, (score, none, key) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, **kw):
    index = ranked_search.build(frame(spark, docs), **kw)
    items = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in items], "item_id long, text string, query string, rank int, found int")
    return sorted(map(tuple, ranked_search.search(index, items).collect()), key=str)


def skewed(n, seed=1, size=120):
    r = random.Random(seed)
    names = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    return [(1000 + i, " ".join(r.choices(names, weights, k=r.randrange(1, size)))) for i in range(n)]


ITEMS = [(1, "w0 w1 w2 w30 w200"), (2, "w5 W5 w5, w399"), (3, None), (4, ""), (5, "nowhere to be found"), (None, "w7 w8"),
         (1, "w0 w1 w2 w30 w200"), (6, " ".join(words(1, 30))), (7, "日本語のテキスト x word")]


@pytest.mark.parametrize("shard", [50, 5000, 10**7])
def test_equals_scoring_every_document(spark, shard):
    docs = awkward() + skewed(400)
    assert found(spark, docs, ITEMS, shard=shard) == brute(docs, ITEMS)


def test_ties_rank_by_key_and_few_documents_are_all_listed(spark):
    docs = [(i, "same words here") for i in (9, 3, 7, None, 3)] + [(100 + i, "other") for i in range(20)]
    got = found(spark, docs, [(1, "words"), (2, "other")])
    assert got == brute(docs, [(1, "words"), (2, "other")])
    assert [r[2] for r in got if r[0] == 1] == [3, 3, 7, 9, None] and sorted(r[2] for r in got if r[0] == 2) == list(range(100, 110))


def test_empty_tables(spark):
    assert found(spark, [], ITEMS) == [] and found(spark, awkward(), []) == []
    assert ranked_search.build(empty(spark)).count() == 0


def test_numbers_survive_compression():
    r = np.random.default_rng(3)
    for top in (2, 127, 128, 129, 20_000, 2**31 - 1, 2**40):
        values = np.append(r.integers(0, top, 500), [0, top])
        assert (ranked_search.unpacked(ranked_search.packed(values)[0]) == values).all()


def lists_of(docs, items):
    """Posting lists of one shard with an item's weights, and the number of documents."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema
    import pyarrow as pa
    schema = to_arrow_schema(ranked_search._schema(T.LongType()))
    text = pa.array([t for _, t in docs])
    from tarnlake.llm import spans
    (_, _, data, at), = spans.Text(text).blocks()
    hashed, counts = ranked_search.terms_of(data, at)
    home, table = ranked_search._shard_rows(0, pa.array([k for k, _ in docs]), counts, hashed, schema)
    n, total = int((counts > 0).sum()), int(counts.sum())
    part = lambda tf, length: (10**9 * tf) // (1000 * tf + 8 * (25 + (75 * length * n) // total))
    rows = {r["term"]: r for r in table.to_pylist()}
    made = {}
    for t, times in Counter(terms(items)).items():
        raw = np.frombuffer(t.encode(), np.uint8)
        key = int(spans.span_hash(raw, np.array([0]), np.array([len(raw)])).view(np.int64)[0])
        if key in rows:
            row = {k: np.array(v) if isinstance(v, list) else v for k, v in rows[key].items()}
            w = math.floor(1000 * math.log((2 * n + 2) / (2 * row["df"] + 1)))
            made[t] = (ranked_search.PostingList(row, counts, part), w * times)
    return made, len(docs)


def test_blocks_are_rejected_before_they_are_unpacked():
    r = random.Random(4)
    docs = [(i, " ".join(["common"] * r.randrange(1, 4) + ["filler"] * r.randrange(3, 9) + ["rare"] * 3 * (i % 997 == 5)))
            for i in range(20_000)]
    lists, n = lists_of(docs, "common rare")
    ranked_search.best_of(list(lists.values()), np.arange(n), n, 10)
    assert lists["rare"][0].done.all() and lists["common"][0].done.mean() < 0.6


def test_block_bounds_are_reached_by_a_posting():
    lists, n = lists_of(skewed(1500, 6), "w0 w1 w9")
    for x, _ in lists.values():
        x.read(np.arange(len(x.last)))
        starts = np.arange(len(x.last)) * ranked_search.BLOCK
        assert (np.maximum.reduceat(x.part, starts) == x.block_bound).all()
