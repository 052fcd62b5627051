import itertools
import random
import re
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from tarnlake.llm import line_dedup, ngram_join
from tarnlake.llm.tables import components

from .cases import awkward, empty, frame, words


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            up[find(i)] = find(j)
    smallest = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            smallest[find(i)] = min(k, smallest.get(find(i), k))
    return [(k, len(sets[i]), smallest.get(find(i)) if sets[i] else k) for i, (k, _) in enumerate(rows)]


def near_copies(n, seed=3):
    """Documents around a few bases, with edits on both sides of the threshold, that share a passage."""
    r = random.Random(seed)
    passage, rows = words(99, 60), []
    for i in range(n):
        text = words(r.randrange(6), 150)
        for _ in range(r.choice([0, 1, 2, 3, 4, 5, 6])):
            text[r.randrange(len(text))] = f"edit{r.randrange(10**6)}"
        if r.random() < 0.5:
            text[70:70] = passage
        rows.append((1000 + i, " ".join(text)))
    return rows


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_components_equal_all_pairs(spark):
    rows = awkward() + near_copies(120)
    assert result(ngram_join.classes_of(frame(spark, rows))) == sorted(brute_components(rows), key=str)


def test_large_blocks_in_parts_give_the_same_components(spark):
    rows = near_copies(90, 8)
    assert result(ngram_join.classes_of(frame(spark, rows), part=1500)) == sorted(brute_components(rows), key=str)


def test_one_document_of_each_group_stays(spark):
    rows = awkward() + near_copies(40)
    left = result(ngram_join.one_of_each(frame(spark, rows)).select("doc_id", "text"))
    want = {(k, c) for k, n, c in brute_components(rows) if n and k == c}
    assert {k for k, t in left if shingles(t)} == {k for k, _ in want}
    assert len([k for k, t in left if shingles(t)]) == len(want)
    assert len([k for k, t in left if not shingles(t)]) == len([1 for _, t in rows if not shingles(t)])


def test_trie_join_connects_what_all_pairs_connect():
    r = random.Random(2)
    t = Fraction(4, 5)
    for _ in range(60):
        base = r.sample(range(60), 40)
        sets = []
        for _ in range(25):
            s = set(base[:r.randint(20, 40)])
            s ^= set(r.sample(range(60), r.randint(0, 6)))
            sets.append(np.array(sorted(s)))
        found = ngram_join.trie_links(sets, [len(s) for s in sets], t)
        pairs = [(i, j) for i, j in itertools.combinations(range(len(sets)), 2)
                 if 9 * len(np.intersect1d(sets[i], sets[j])) >= 4 * (len(sets[i]) + len(sets[j]))]
        assert all((min(p), max(p)) in set(pairs) for p in found)

        def classes(links):
            up = list(range(len(sets)))

            def find(i):
                return i if up[i] == i else find(up[i])
            for i, j in links:
                up[find(i)] = find(j)
            return [min(k for k in range(len(sets)) if find(k) == find(i)) for i in range(len(sets))]
        assert classes(found) == classes(pairs)


def test_join_of_empty_table(spark):
    assert ngram_join.classes_of(empty(spark)).count() == 0
    assert ngram_join.one_of_each(empty(spark)).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200, 260)] + [(900 - i, 5) for i in range(50)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {v for k, v in got.items() if 200 <= k <= 260} == {200} and got[900] == 5 and len(got) == 61 + 51


# ---- lines

def brute_lines(rows):
    """Texts after dedup; rows of one id and text are one document."""
    def norm(line):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)
        return tuple(re.findall(r"[^\x20\x09-\x0D]+", low))

    def near(a, b):
        if a == b:
            return True
        if min(len(a), len(b)) < line_dedup.MIN_WORDS or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) <= 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    seen, out = [], {}
    for key in sorted(set(rows)):
        left = []
        for line in key[1].split("\n"):
            w = norm(line)
            if w and any(near(w, s) for s in seen):
                seen.append(w)
                continue
            if w:
                seen.append(w)
            left.append(line)
        out[key] = "\n".join(left)
    return out


def line_cases():
    r = random.Random(4)
    pool = [words(50 + i, r.randint(2, 14), 30) for i in range(25)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(r.randint(0, 6)):
            w = list(r.choice(pool))
            kind = r.random()
            if kind < 0.3:
                w[r.randrange(len(w))] = f"new{r.randrange(5)}"
            elif kind < 0.5:
                w.insert(r.randrange(len(w) + 1), f"in{r.randrange(3)}")
            elif kind < 0.7 and len(w) > 2:
                del w[r.randrange(len(w))]
            line = "  ".join(w)
            lines.append(line.upper() if r.random() < 0.2 else line)
        rows.append((i, "\n".join(lines + [""] * r.randint(0, 2))))
    return rows + [rows[3], rows[4]]


def test_lines_equal_plain_python(spark):
    rows = line_cases()
    want = brute_lines(rows)
    got = line_dedup.dedup_lines(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    ids = {}
    for k, t in rows:
        ids[k] = t
    for r in got:
        assert r["text"] == want[(r["doc_id"], ids[r["doc_id"]])], r["doc_id"]
        assert r["n_words"] == "a" and r["__found"]["n_lines"] == ids[r["doc_id"]].count("\n") + 1


def test_awkward_lines(spark):
    docs = frame(spark, awkward())
    got = line_dedup.dedup_lines(docs)
    texts = {}
    for r in got.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"])
    assert got.count() == len(awkward()) and got.columns[:-1] == docs.columns
    assert texts[4] == [None] and texts[5] == [""] and texts[6] == [awkward()[6][1]]
    assert texts[11][0].count("\n") == 0 and texts[11][0]  # five equal lines: the first stays
    assert sorted(texts[None], key=str) == sorted([None, dict(awkward())[1]], key=str)  # null ids are earliest
    assert texts[1] == [""] and texts[3] == ["", ""]
    left = line_dedup.without_repeated_lines(docs)
    assert left.columns == docs.columns and left.where("doc_id IN (1, 2, 3)").count() == 0
    assert left.where((F.col("n_chars") != F.length("text"))).count() == 0
    assert line_dedup.dedup_lines(empty(spark)).count() == 0
