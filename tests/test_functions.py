import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnlake.functions import text as tx
from tarnlake.functions.values import md5_key, to_ts, truncated_int
from tarnlake.operators import cleaning, textstats

from .conftest import rows


def one(spark, value, make, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(make(F.col("x"))).first()[0]


def plain_clean(s):
    """Row-wise statement of the cleaning rules."""
    s = re.sub("http\\S+", "", s.lower())
    s = re.sub("<.*?>", "", s)
    s = "".join(ch for ch in s if ch not in tx.PUNCTUATION)
    s = " ".join(s.split())
    return "".join(ch for ch in s if not any(lo <= ord(ch) <= hi for lo, hi in tx.EMOJI_RANGES))


CASES = [
    "", "   ", "Hello, World!", "see HTTPS://Example.com/a?b=1 now", "<b>bold</b> text", "a <i>b<u>c</u></i> d",
    "open <a without end", "tag over\nlines <a\nb> stays", "nbsp between words", "smile \U0001F600 end",
    "日本 kept?", "quote\"s and, commas stay", "line\r\nbreak\x1csep\x85next", "under_score's `tick`", "<<a>>",
    "half <a\r> carriage", "tail http", "ÀÉÎ ÕÜ"]


@pytest.mark.parametrize("raw", CASES)
def test_clean_text(spark, raw):
    assert one(spark, raw, tx.clean_text) == plain_clean(raw)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["A", "b ", "<", ">", "http", "/x", " ", "\n", " ", "'", ".", "\U0001F600", "é",
                                 "\t", "_", "日"]), max_size=14).map("".join))
def test_clean_text_random(spark, raw):
    assert one(spark, raw, tx.clean_text) == plain_clean(raw)


def test_strict_emoji_keeps_cjk(spark):
    assert one(spark, "日本 \U0001F600", lambda c: tx.clean_text(c, strict_emoji=True)) == "日本 "


def test_words_and_terms(spark):
    assert one(spark, "  a  bb c ", tx.words) == ["a", "bb", "c"]
    assert one(spark, "", tx.words) == []
    assert one(spark, "A bb c_d 1 22 é éé", tx.terms) == ["bb", "c_d", "22", "éé"]


def test_sentiment_label(spark):
    df = spark.createDataFrame([(i,) for i in range(0, 7)], "x int").select("x", tx.sentiment_label(F.col("x")))
    assert [r[1] for r in sorted(df.collect())] == [None] + ["negative"] * 3 + ["positive"] * 2 + [None]


def test_md5_key_separator_and_null(spark):
    df = spark.createDataFrame([("1", "12"), ("11", "2"), ("1", None)], "a string, b string")
    a, b = F.col("a"), F.col("b")
    assert df.select(md5_key(a, b, sep="")).distinct().count() == 2
    assert df.select(md5_key(a, b)).distinct().count() == 3
    assert df.where(md5_key(a, b).isNull()).count() == 1


def test_casts(spark):
    assert one(spark, 3.9, truncated_int, "x double") == 3
    assert one(spark, -3.9, truncated_int, "x double") == -3
    assert one(spark, 1e18, truncated_int, "x double") is None
    assert one(spark, "nope", to_ts) is None


def test_cleaning(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, float("nan"), "b"), (3, 2.345, None), (4, 2.345, "d")],
                               "k int, x double, s string")
    assert rows(cleaning.drop_incomplete(df), "k") == [(1,), (4,)]
    assert rows(cleaning.drop_incomplete(df, ["s"]), "k") == [(1,), (2,), (4,)]
    assert rows(cleaning.round_money(df.where("k = 4"), ["x"]), "x") == [(2.35,)]
    assert cleaning.not_null_check(df, "s").first().asDict() == {"total_rows": 4, "null_rows": 1, "passed": False}
    box = spark.createDataFrame([(5.27438888, -34.79314722), (5.3, -50.0), (-33.75116944, -73.98283055)],
                                "lat double, lng double")
    assert cleaning.within_box(box, "lat", "lng").count() == 2


def test_lemmas(spark):
    words = ["cats", "cat", "boxes", "wives", "ladies", "men", "boss", "unknowns", "churches", "geese", "glasses"]
    known = ["cat", "box", "wife", "lady", "man", "boss", "church", "glass", "wif"]
    mk = lambda ws: spark.createDataFrame([(w,) for w in ws], "word string")
    odd = spark.createDataFrame([("geese", "goose")], "word string, lemma string")
    got = dict(map(tuple, textstats.lemma_table(mk(words), mk(known), odd).collect()))
    assert got == {"cats": "cat", "boxes": "box", "wives": "wif", "ladies": "lady", "men": "man",
                   "churches": "church", "geese": "goose", "glasses": "glass"}
    docs = spark.createDataFrame([(1, "two cats and a cat"), (2, ""), (3, "geese unknowns geese")], "id int, t string")
    lem = textstats.lemma_table(mk(words), mk(known), odd)
    assert rows(textstats.lemmatize(docs, "id", "t", lem)) == [
        (1, "two cat and a cat"), (2, ""), (3, "goose unknowns goose")]


def test_lemmas_are_stripped_until_no_suffix_fits(spark):
    mk = lambda *ws: spark.createDataFrame([(w,) for w in ws], "word string")
    assert rows(textstats.lemma_table(mk("aseseseses", "xsssss", "s"), mk("as", "x"))) == [("aseseseses", "as"), ("xsssss", "x")]
    docs = spark.createDataFrame([(1, "cats"), (1, "cats"), (1, "cat")], "id int, t string")
    long = {"s" * 30_000: None, "bas" + "s" * 30_000: "bas", "gla" + "ses" * 9_000: "glas", "kni" + "ves" * 2_000: None,
            "ab" + "s" * 9: "abss", "boxes" + "s" * 200: "box", "womens": "woman"}
    known = ["bas", "glas", "knif", "abss", "box", "woman"]
    got = dict(map(tuple, textstats.lemma_table(mk(*long), mk(*known)).collect()))
    assert got == {w: lemma for w, lemma in long.items() if lemma}
    assert textstats.lemma_table(mk("cats"), mk("cat").limit(0)).count() == textstats.lemma_table(mk("cats").limit(0), mk("cat")).count() == 0
    assert rows(textstats.lemmatize(docs, "id", "t", textstats.lemma_table(mk("cats"), mk("cat")))) == [(1, "cat")] * 3


def test_tfidf_matches_the_formula(spark):
    import math
    texts = {1: "aa bb aa", 2: "bb cc", 3: "bb", 4: ""}
    docs = spark.createDataFrame(list(texts.items()), "id int, t string")
    got = {(r["id"], r["term"]): r["tfidf"] for r in textstats.tfidf(docs, "id", "t", 2).collect()}
    idf = {"aa": math.log(5 / 2) + 1, "bb": math.log(5 / 4) + 1}
    n1 = math.hypot(2 * idf["aa"], idf["bb"])
    want = {(1, "aa"): 2 * idf["aa"] / n1, (1, "bb"): idf["bb"] / n1, (2, "bb"): 1.0, (3, "bb"): 1.0}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in want)
