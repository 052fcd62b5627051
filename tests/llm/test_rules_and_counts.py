import re

import pytest
from pyspark.sql import functions as F

from tarnlake.llm import quality_rules, queries, token_counts
from tarnlake.llm.wordpieces import Encoder

from .cases import awkward, empty, frame, words


def base_rules(text):
    text = text or ""
    found = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    w = [text[a:b] for a, b in found]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = {}
    for i in range(len(w) - 7):
        windows.setdefault(tuple(w[i:i + 8]), []).append(i)
    repeat = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    failed = len(w) < 20 or 100 * len(repeat) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeat), failed


def test_base_rules_equal_plain_python(spark, sf):
    docs = frame(spark, awkward()).unionByName(
        spark.read.parquet(f"{sf}/documents.parquet"), allowMissingColumns=True)
    trusted = spark.createDataFrame([(1,), (None,)], "doc_id long")
    got = quality_rules.rate(docs, trusted, keep=["doc_id", "text", "kept"]).collect()
    assert len(got) == docs.count()
    for r in got:
        f = r["__found"]
        assert tuple(f)[:6] == base_rules(r["text"]), r["doc_id"]
        assert f["kept"] == (not f["base_failed"] and f["score"] >= quality_rules.THRESHOLD - 1e-9)


def test_ratio_tells_junk_from_prose_and_does_not_depend_on_partitions(spark):
    prose = [(i, " ".join(words(i, 200))) for i in range(60)]
    junk = [(100 + i, " ".join(w + "###" for w in words(i, 200))) for i in range(20)]
    docs, trusted = frame(spark, prose + junk), spark.createDataFrame([(i,) for i in range(0, 60, 2)], "doc_id long")
    one, many = (sorted((r[0], r[1]["score"], r[1]["kept"]) for r in quality_rules.rate(docs.repartition(n), trusted).collect())
                 for n in (1, 7))
    assert one == many
    assert [k for i, _, k in one] == [i < 100 for i, _, _ in one]


def test_no_trusted_documents_and_empty_table(spark):
    nobody = spark.createDataFrame([], "doc_id long")
    assert {r[1]["score"] for r in quality_rules.rate(frame(spark, awkward()), nobody).collect()} == {0.0}
    assert quality_rules.rate(empty(spark), nobody).count() == 0


def test_n_gram_counts_are_whole(spark):
    docs = frame(spark, [(1, "abcdefgh"), (2, "abc"), (3, None), (1, "abcdefgh")])
    total = quality_rules.gram_counts(docs, spark.createDataFrame([(1,)], "doc_id long")).agg(
        F.sum("n_raw"), F.sum("n_trusted")).first()
    assert tuple(total) == (10, 10)


# ---- token counts and ids

def greedy(pieces, word):
    at = n = 0
    longest = max(map(len, pieces))
    while at < len(word):
        end = next((e for e in range(min(len(word), at + longest), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return -1
        at, n = end, n + 1
    return n


def test_automaton_equals_greedy_matching_on_random_vocabularies():
    import random
    r = random.Random(5)
    for _ in range(300):
        pieces = {"".join(r.choice("abc") for _ in range(r.randint(1, 4))) for _ in range(r.randint(1, 10))}
        pieces |= {token_counts.ending(p) for p in pieces if r.random() < 0.5}
        match = token_counts.LongestMatch(sorted(pieces))
        for _ in range(25):
            word = token_counts.ending("".join(r.choice("abc") for _ in range(r.randint(1, 10))))
            assert match.count(word) == greedy(pieces, word)


def test_token_counts_of_awkward_texts(spark):
    definition = queries.tokenizer_json()
    counter = token_counts.Counter(definition)
    docs = frame(spark, awkward())
    got = token_counts.token_counts(docs, definition, keep=["doc_id", "text", "n_words"]).collect()
    assert len(got) == len(awkward())
    pieces = {token_counts.ending(w[:-4]) if w.endswith("</w>") else w
              for w in counter.splitter.tokenizer.get_vocab()}
    for r in got:
        n, tokens, unknown = r["__found"]
        found = [w for part in counter.splitter.words(r["text"] or "") for w in part]
        counts = [greedy(pieces, token_counts.ending("".join(counter.letters[b] for b in w.encode()))) for w in found[:3000]]
        assert n == len(found) and unknown == 0
        if len(found) <= 3000:
            assert tokens == sum(counts)
    assert token_counts.token_counts(empty(spark), definition).count() == 0


@pytest.fixture(scope="module")
def encoder():
    return Encoder(queries.tokenizer_json())


def test_encoder_gives_the_tokenizers_ids(encoder, spark, sf):
    import numpy as np
    texts = [t for _, t in awkward()] + [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    texts += ["it's we'll ''s 's! _a_ 1234 don'T", "<|startoftext|>a b", "a\x1cb \x85 c", "ÀÉÎ öß œ … – —"]
    for text, ids in zip(texts, encoder.encode_all(texts)):
        whole = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == whole


def test_long_texts_are_cut_only_before_white_space():
    from tarnlake.llm.wordpieces import slices
    text = " ".join(words(1, 5000)) + "y" * 3000
    parts = list(slices(text, 1000))
    assert "".join(parts) == text and len(parts) > 20 and all(p[0].isspace() for p in parts[1:])


def test_words_of_whole_batches_are_what_the_pattern_finds():
    import random

    import pyarrow as pa

    from tarnlake.llm import spans, wordpieces
    r = random.Random(9)
    letters = ["a", "s", "t", "re", "ve", "ll", "m", "d", "'", "'", "!", " ", "\n", "1", "é", "É", "×", "÷", "ß", "Œ", "œ", "–", "…", "€", "<"]
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 14))) for _ in range(4000)] + ["x<|y", "日", "a\xa0b"]
    text = spans.Text(pa.array(texts, pa.string()))
    low, starts, ends, other = wordpieces.plain_words(text.data, text.at)
    row, _ = spans.row_of(text.at, starts)
    found = [[] for _ in texts]
    for i, a, b in zip(row.tolist(), starts.tolist(), ends.tolist()):
        found[i].append(low[a:b].tobytes())
    assert set(other.tolist()) == {i for i, t in enumerate(texts) if not wordpieces.plain(t)}
    for i, t in enumerate(texts):
        if wordpieces.plain(t):
            assert found[i] == [w.encode() for w in wordpieces._PIECE.findall(t.lower())], t
