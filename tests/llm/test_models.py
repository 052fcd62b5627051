import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarnlake.llm import chat_format, language_id, quality_classifier, queries

from .cases import awkward, empty, frame, words


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_language_of_held_out_documents(spark, sf):
    got = queries.op6_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = [r for r in got.collect() if r["held_out"]]
    assert len(rows) > 40 and all(held_out(r["doc_id"]) for r in rows)
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95


def brute_language(model, text):
    """The model's score of a text by its definition."""
    letters = [w for w in language_id.words_of(text) if any(map(str.isalpha, w))]
    total = np.array(model.prior)
    for w in letters:
        if w in model.words:
            total = total + model.words[w]
            continue
        marked = f"^{w}$"
        for i in range(len(marked)):
            for k in language_id.ORDERS:
                if i + k <= len(marked) and marked[i:i + k] in model.grams[k]:
                    total = total + model.grams[k][marked[i:i + k]]
                    break
    if not letters:
        return "und", 0.0
    p = np.exp((total - total.max()) / 1e6)
    return model.langs[int(total.argmax())], float(p.max() / p.sum())


def test_language_scores_follow_the_definition(spark):
    rows = [(i, " ".join(words(i, 30, 5))) for i in range(30)] + [(100 + i, " ".join("ö" + w for w in words(i, 30, 5))) for i in range(30)]
    docs = frame(spark, rows).withColumn("lang", F.when(F.col("doc_id") < 100, "aa").otherwise("bb"))
    model = language_id.fit(docs, n_words=40, n_grams=30)
    assert len(model.words) <= 80 and model.langs == ["aa", "bb"]
    asked = frame(spark, awkward() + [(900, "övalmi1 zzz"), (901, "²½ 123"), (902, "bal qqq")])
    for r in language_id.predict(asked, model, keep=["text", "score"]).collect():
        lang, score = brute_language(model, r["text"])
        assert r["__found"]["lang_pred"] == lang and abs(r["__found"]["score"] - score) < 1e-9 and 0 <= score <= 1
    assert language_id.predict(empty(spark), model).count() == 0
    nothing = language_id.fit(empty(spark))
    assert {r[1]["lang_pred"] for r in language_id.predict(asked, nothing).collect()} == {"und"}


def rare_words(n, c):
    """Words that each stand once in the corpus."""
    return ["".join(c + "abdefg"[i // 6**p % 6] for p in range(7)) for i in range(n)]


def test_every_learnt_word_is_known(spark, monkeypatch):
    rare = rare_words(25_000, "o")
    rows = [(i, " ".join(["bal"] * 50 + rare[i::10])) for i in range(10)] + [(100 + i, " ".join(["bal", "dor"] * 30)) for i in range(10)]
    docs = frame(spark, rows).withColumn("lang", F.when(F.col("doc_id") < 100, "aa").otherwise("bb"))
    model = language_id.fit(docs)
    assert set(rare) <= set(model.words)
    asked = frame(spark, awkward() + [(900 + i, f"{w} dor unlearnt{w[:5]}") for i, w in enumerate(rare[::5000])] + [(950, "dor dor " + rare[7])] * 2)
    answers = []
    for hot in (language_id.HOT, 5, 0):  # what is sent to the tasks has no influence
        monkeypatch.setattr(language_id, "HOT", hot)
        got = language_id.predict(asked, model, keep=["text"]).collect()
        assert len(got) == asked.count()
        answers.append(sorted((str(r["text"]), *r["__found"]) for r in got))
        for r in got:
            lang, score = brute_language(model, r["text"])
            assert r["__found"]["lang_pred"] == lang and abs(r["__found"]["score"] - score) < 1e-9
    assert answers[0] == answers[1] == answers[2]


@pytest.mark.parametrize("names,letters", [(200_000, 64_000_000), (3, 64_000_000), (200_000, 10)])
def test_counts_equal_plain_counts(monkeypatch, names, letters):
    monkeypatch.setattr(language_id, "COMBINED", names)
    monkeypatch.setattr(language_id, "READ", letters)
    rows = [("aa" if i % 3 else "bb", " ".join(words(i % 4, 12, 2)) + " ²½ Ünd 7") for i in range(20)] + [("aa", "")]
    batches = [pa.record_batch([pa.array(x) for x in zip(*rows[i:i + 6])], names=["lang", "text"]) for i in range(0, len(rows), 6)]
    plain, got = Counter(), Counter()
    for lang, text in rows:
        plain.update((lang, w) for w in re.findall(r"[^\W\d_]+", text.lower()) if any(c.isalpha() for c in w))
    made = list(language_id._word_counts(iter(batches)))
    for b in made:
        got.update({(r["lang"], r["name"]): r["n"] for r in b.to_pylist()})
    assert got == plain and (len(made) == 1) == ((names, letters) == (200_000, 64_000_000))
    grams = Counter((lang, k, f"^{w}$"[i:i + k]) for lang, w in plain for k in (4, 3, 2, 1) for i in range(len(w) + 3 - k))
    got = Counter()
    for b in language_id._gram_counts(b.select(["lang", "name"]) for b in made):
        for r in b.to_pylist():
            got[r["lang"], r["k"], r["name"]] += r["n"]
    once = Counter({(lang, k, g): n for (lang, k, g), n in grams.items()})
    assert got == once if len(made) == 1 else set(got) == set(once)
    assert not next(language_id._word_counts(iter([]))).num_rows and not next(language_id._gram_counts(iter([]))).num_rows


def test_limits_of_known_words_are_filled(spark):
    often, once = rare_words(3, "i"), rare_words(30, "u")
    docs = frame(spark, [(1, " ".join(often * 2 + once)), (2, " ".join(once))]).withColumn("lang", F.when(F.col("doc_id") == 1, "aa").otherwise("bb"))
    model = language_id.fit(docs.where("doc_id = 1"), n_words=7)
    assert len(model.words) == 7 and set(often) <= set(model.words)
    assert len(language_id.fit(docs.where("doc_id = 2"), n_words=7).words) == 7  # one level above the limit


def test_known_words_have_the_counts_of_every_language(spark):
    rows = [(1, "aa", "bal bal bal dor"), (2, "bb", "mip mip mip bal bal")]
    docs = frame(spark, [(i, text) for i, _, text in rows]).withColumn("lang", F.when(F.col("doc_id") == 1, "aa").otherwise("bb"))
    model = language_id.fit(docs, n_words=1)
    assert set(model.words) == {"bal", "mip"}
    assert model.words["bal"].tolist() == [round(1e6 * np.log(4 / 5)), round(1e6 * np.log(3 / 7))]


def test_quality_classifier_on_documents_left_out(spark):
    good = [(i, " ".join(words(i, 80, 60))) for i in range(150)]
    junk = [(200 + i, " ".join(w + "###" for w in words(i, 80, 60))) for i in range(150)]
    rude = [(400 + i, " ".join(words(i, 60, 60) + ["idiot", "moron"])) for i in range(100)]
    docs = frame(spark, good + junk + rude)
    labels = spark.createDataFrame([(i, int(i < 200)) for i, _ in good[::2] + junk[::2] + rude[::2]] + [(1, None), (None, 1), (3, 0), (3, 1)],
                                   "doc_id long, label int")
    model = quality_classifier.fit(docs, labels)
    got = {r[0]: r[1] for r in quality_classifier.classify(docs, model).collect()}
    unseen = [i for i, _ in good[1::2] + junk[1::2] + rude[1::2]]
    assert np.mean([got[i]["good"] == (i < 200) for i in unseen]) > 0.95
    assert all(0 <= got[i]["score"] <= 1 for i in got)
    asked = frame(spark, awkward())
    assert quality_classifier.classify(asked, model, keep=["doc_id", "score"]).count() == len(awkward())
    quality_classifier.fit(asked, labels)
    nobody = quality_classifier.fit(docs, labels.where("false"))
    assert {r[1]["score"] for r in quality_classifier.classify(asked, nobody).collect()} == {0.5}
    assert quality_classifier.classify(empty(spark), model).count() == 0


def transcripts(n, seed=1):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(r.randint(2, 9)):
            role = "user" if t % 2 == 0 else "assistant"
            text = "\n".join(" ".join(words(r.randrange(10**6), r.randint(3, 8) if role == "user" else r.randint(20, 60)))
                             for _ in range(1 if role == "user" else r.randint(1, 4)))
            rows.append((c, t, role, text + ("?" if role == "user" else ".")))
    return rows


CHAT = "conv_id long, turn long, role string, text string, piece string"


def chat(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], CHAT)


def test_roles_of_conversations_not_learnt_from(spark):
    rows = transcripts(120)
    found = chat_format.parse(chat(spark, rows), learns=F.col("conv") >= 40).collect()
    role = {(c, t): r for c, t, r, _ in rows}
    assert len(found) == len(rows)
    assert np.mean([r["role"] == role[r["conv"], r["turn"]] for r in found if r["conv"] < 40]) > 0.97
    assert all(r["rendered"] == f"<|{r['role']}|>\n{r['text']}" for r in found if r["begins"])


def test_chunks_do_not_change_the_path(spark):
    rows = transcripts(6) + [(50, t, None if t % 7 == 0 else "user" if t % 2 else "assistant", f"line {t}\nmore?") for t in range(300)]
    whole, cut = (sorted(map(str, chat_format.parse(chat(spark, rows), chunk=n).drop("place").collect())) for n in (10**6, 5))
    assert whole == cut


def test_pieces_equal_full_viterbi():
    r = np.random.default_rng(3)
    model = chat_format.Hmm(["a", "b"], r.integers(0, 50, (5, 4 + sum(chat_format.SIZES))).astype(float))
    texts = ["user: hi", "x\ny?\nz", "", None, "Bot: " + " ".join("abcdefghij")]
    emissions = model.emissions(texts)
    import itertools
    best = max(itertools.product(range(4), repeat=len(emissions)), key=lambda p: (
        model.move[4, p[0]] + sum(model.move[a, b] for a, b in zip(p, p[1:])) + sum(e[s] for e, s in zip(emissions, p))))
    m = model.matrix(texts)
    score = model.move[4, best[0]] + sum(model.move[a, b] for a, b in zip(best, best[1:])) + sum(e[s] for e, s in zip(emissions, best))
    assert m[4].max() == score and tuple(model.path(texts, 4, int(m[4].argmax()))) == best


def test_awkward_transcripts(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, "assistant", ""), (None, 1, None, "Human: hi\nAI: yes"),
            (2, 5, "user", "a\n" * 3000), (3, 1, "user", "tie b"), (3, 1, "assistant", "tie a")]
    found = chat_format.parse(chat(spark, rows), chunk=50).collect()
    assert len({(r["conv"], r["turn"], r["place"]) for r in found}) == len(rows)
    assert [r["text"] for r in sorted(found, key=lambda r: r["place"]) if r["conv"] == 3] == ["tie a", "tie b"]
    unknown = chat_format.parse(chat(spark, [(1, 0, None, "x\ny")])).collect()
    assert [(r["role"], r["begins"], r["rendered"]) for r in unknown] == [(None, True, "<|unknown|>\nx\ny")]
    assert chat_format.parse(chat(spark, [])).count() == 0


def test_only_a_marker_of_the_role_is_taken_off():
    made = list(chat_format.pieces(["A: one of two", "Answer: 42 is right", "System: x", "tool: y"], [0, 2, 4, 6],
                                   ["user", "assistant", "system", "tool"]))
    assert [m[4] for m in made] == ["A: one of two", "42 is right", "x", "tool: y"]


def test_markers_are_taken_off():
    made = list(chat_format.pieces(["User:  hello\nthere", "[Assistant]: yes"], [0, 1, 2], ["user", "assistant"]))
    assert [(p[2], p[3], p[4]) for p in made] == [("user", True, "hello\nthere"), ("assistant", True, "yes")]


def test_every_known_role_is_learnt(spark):
    rows = [(c, t, f"role{(c + t) % 12}", "some words.") for c in range(24) for t in range(2)]
    chunks = chat_format._chunks(chat(spark, rows).select(F.col("conv_id").alias("conv"), "turn", "role", "text"), 100)
    assert chat_format.fit(chunks, F.lit(True)).roles == sorted(f"role{k}" for k in range(12))
    with pytest.raises(ValueError, match="known roles"):
        chat_format.fit(chunks, F.lit(True), n_roles=11)
