"""The pipeline against plain Python, stage by stage, on awkward rows; and the ratio of the quality rules by its definition."""

import math
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tarnlake.llm import line_dedup, quality_rules, queries

from .cases import DOCS, awkward, words
from .test_contamination_and_packing import brute_hits
from .test_join_and_lines import brute_components, shingles
from .test_rules_and_counts import base_rules


# ---- the ratio

def bucket_of(gram):
    code, = struct.unpack("<I", gram)
    mixed = (code * 0x9E3779B1 & 0xFFFFFFFF) ^ (code >> 15)
    return (mixed * 0x85EBCA77 & 0xFFFFFFFF) >> 16


def grams(text):
    raw = (text or "").encode()
    return [bucket_of(raw[i:i + 4]) for i in range(len(raw) - 3)]


def plain_scores(rows, trusted):
    """(sum of millionths, n-grams) of each text by the definition of the two multinomials."""
    raw, good = Counter(), Counter()
    for key, text in rows:
        found = grams(text)
        raw.update(found)
        if key is not None and key in trusted:
            good.update(found)
    n = quality_rules.BUCKETS
    if not good:
        return [(0, len(grams(t))) for _, t in rows]
    total_raw, total_good = sum(raw.values()) + n, sum(good.values()) + n
    ratio = {b: round(1e6 * math.log(((good[b] + 1) / total_good) / ((raw[b] + 1) / total_raw))) for b in raw}
    return [(sum(ratio[b] for b in grams(t)), len(grams(t))) for _, t in rows]


def test_ratio_equals_its_definition(spark, sf):
    docs = [r for r in awkward() if r[0] != 9] + [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(
        F.col("doc_id") + 1000, "text").collect()]
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1 and toxic = 0")
    trusted = {r[0] + 1000 for r in labels.select("doc_id").collect()} | {1, 14}
    got = quality_rules.rate(spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(docs)], "row int, doc_id long, text string"),
                             spark.createDataFrame([(k,) for k in trusted], "doc_id long"), keep=["row"]).collect()
    want = plain_scores(docs, trusted)
    assert len(got) == len(docs)
    for r in got:
        total, n = want[r["row"]]
        assert abs(r["__found"]["score"] - total / max(n, 1) / 1e6) < 2e-6  # rounding of a millionth may differ at .5
        if abs(total - 1e6 * quality_rules.THRESHOLD * max(n, 1)) > 2 * max(n, 1):
            assert r["__found"]["kept"] == (not base_rules(docs[r["row"]][1])[5] and total >= 1e6 * quality_rules.THRESHOLD * max(n, 1))


# ---- the pipeline

def plain_lines(rows):
    """Texts without lines that stand earlier, equal or within one word; documents that lose all their words go.

    Rows here have ids that differ, so (id, line) is the order."""
    places = sorted(((k is not None, k or 0), i) for i, (k, _) in enumerate(rows))
    kept, seen, out = [], set(), {}
    for _, i in places:
        lines = []
        for line in (rows[i][1] or "").split("\n"):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)
            w = tuple(x for x in low.replace("\t", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if x)
            if not w:
                lines.append(line)
                continue
            if w not in seen and not (len(w) >= line_dedup.MIN_WORDS and any(one_edit(w, v) for v in kept)):
                lines.append(line)
            seen.add(w)
            if len(w) >= line_dedup.MIN_WORDS:
                kept.append(w)  # lines that go count as earlier ones too
        out[i] = None if rows[i][1] is None else "\n".join(lines)
    return [(k, out[i]) for i, (k, t) in enumerate(rows) if not shingles(t) or shingles(out[i])]


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return a == b
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(short == long[:i] + long[i + 1:] for i in range(len(long)))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents with copies, shared lines, benchmark passages, nulls and clashing columns; benchmark; labels."""
    r = random.Random(11)
    passages = [words(900 + i, 30) for i in range(4)]
    base = [words(i, 90, 5000) for i in range(12)]
    docs = [(1, None), (2, ""), (3, " \n\t"), (4, "too short")]
    for i in range(60):
        text = list(base[i % 12])
        for _ in range(r.choice([0, 0, 1, 2, 30])):
            text[r.randrange(len(text))] = f"new{r.randrange(10**6)}"
        if i % 7 == 0:
            text[40:40] = passages[i % 4]
        lines = [" ".join(text[k:k + 15]) for k in range(0, len(text), 15)]
        if i % 3 == 0:
            lines.insert(2, "this line stands in many of the documents")
        if i % 5 == 0:
            lines.insert(1, "###$$$ &&& ||| <<<")
        docs.append((100 + i, "\n".join(lines)))
    docs += [(None, docs[5][1] + " tail"), (500, "word " * 300), (501, " ".join(words(77, 20_000, 10**6)))]
    path = tmp_path_factory.mktemp("tables")
    rows = [(k, t, "en", None if i % 4 else "s", len(t or ""), "a", "b", "c") for i, (k, t) in enumerate(docs)]
    spark.createDataFrame(rows, DOCS).withColumns({"component_id": F.lit("x"), "hits": F.lit(1), "lines": F.lit("l"), "c": F.lit(1), "size": F.lit(2), "place": F.lit(3)}) \
        .write.parquet(f"{path}/documents.parquet")
    items = [(i, " ".join(p)) for i, p in enumerate(passages)] + [(9, None), (None, "some words")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(k, 1, 0) for k, t in docs if k and k % 2 == 0] + [(None, 1, 0)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{path}/labels.parquet")
    return str(path), docs, items


def test_every_stage_equals_plain_python(spark, tables):
    path, docs, items = tables
    now = spark.read.parquet(f"{path}/documents.parquet")
    columns = now.columns
    expected = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        now = stage(spark, now, path)
        assert now.columns == columns
        if name == "quality_rules":
            scores = plain_scores(expected, {k for k, _ in docs if k and k % 2 == 0})
            expected = [x for x, (total, n) in zip(expected, scores)
                        if not base_rules(x[1])[5] and total >= 1e6 * quality_rules.THRESHOLD * max(n, 1)]
        elif name == "line_dedup":
            expected = plain_lines(expected)
        elif name == "ngram_join":
            found = brute_components(expected)
            expected = [x for x, (k, n, c) in zip(expected, found) if not n or k == c]
        else:
            judged = [brute_hits(t, items) for _, t in expected]
            expected = [x for x, (n, hit, _) in zip(expected, judged) if not (hit and 20 * hit >= n)]
        got = [(r["doc_id"], r["text"]) for r in now.select("doc_id", "text").collect()]
        assert sorted(got, key=str) == sorted(expected, key=str), name
        assert 5 < len(got) < len(docs)
    packed = corpus_pipeline.STAGES[4][1](spark, now, path).collect()
    tokenizer = Tokenizer.from_str(queries.tokenizer_json())
    ids = {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for k, t in expected}
    seen = Counter()
    for p in packed:
        raw = np.array(ids[p["doc_id"]][p["start"]:p["start"] + p["length"]], "<u4").tobytes()
        assert zlib.crc32(raw) == p["ids_crc32"] and p["doc_tokens"] == len(ids[p["doc_id"]])
        seen[p["doc_id"]] += p["length"]
    assert seen == {k: len(x) for k, x in ids.items()}
    run = Counter()
    for p in corpus_pipeline.run(spark, path).collect():
        run[p["doc_id"]] += p["length"]
    assert run == seen


def test_empty_tables_run_through(spark, tables, tmp_path):
    path, _, _ = tables
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    for name in ("benchmark", "labels"):  # documents alone
        spark.read.parquet(f"{path}/documents.parquet").limit(30).write.mode("overwrite").parquet(f"{tmp_path}/x/documents.parquet")
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.mode("overwrite").parquet(f"{tmp_path}/x/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/x").count() > 0
