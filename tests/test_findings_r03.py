"""Queries that give every row again, and steps whose cost followed the input too steeply."""

import math
import re

import pytest
from pyspark.sql import functions as F

from tarnlake.functions.text import drop_emoji, strip_markup
from tarnlake.operators.textstats import tfidf
from tarnlake.plans import models, star, star_tables
from workload import QUERIES, ml
from workload.star import _Star

from .conftest import rows


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """300 documents, of which 240 are labelled by one word in them; one label is of no document."""
    at = str(tmp_path_factory.mktemp("lake"))
    docs = spark.range(300).selectExpr("id as doc_id", "concat('item number ', id % 17, ' was ', if(id % 3 = 0, 'awful', 'lovely'), ' thing ', id % 11) as text")
    docs.write.parquet(f"{at}/documents.parquet")
    labels = spark.range(240).union(spark.range(9000, 9001)).selectExpr("id as doc_id", "if(id % 3 = 0, 0, 1) as quality", "0 as toxic")
    labels.write.parquet(f"{at}/labels.parquet")
    return at


@pytest.mark.parametrize("name", ["ml_sentiment_fit", "ml_sentiment_cv"])
def test_every_test_document_is_in_the_result(spark, lake, name):
    split = ml._split(spark, lake).where("split = 'test' and doc_id < 240")
    want = rows(split.withColumn("support", F.count("*").over(ml.Window.partitionBy("label"))), "doc_id", "label", "support")
    out = QUERIES[name](spark, lake)
    assert rows(out, "doc_id", "label", "support") == want and len(want) > 40
    assert out.where("probable and known_class and beats_majority").count() == len(want)


def test_every_document_is_scored_one_by_one(spark, lake):
    out = QUERIES["ml_batch_score"](spark, lake)
    assert sorted(r["doc_id"] for r in out.collect()) == list(range(300))
    assert rows(out.groupBy("label", "labelled", "scored").count()) == [(None, 0, 300, 60), ("negative", 80, 300, 80), ("positive", 160, 300, 160)]
    assert out.where("probable and known_class and more_sure_when_right").count() == 300


def test_a_model_of_constant_guesses_does_not_separate_and_one_below_the_majority_does_not_beat_it(spark):
    scored = spark.createDataFrame([("positive", "positive", 0.8), ("positive", "negative", 0.8), ("positive", "positive", 0.8), ("negative", "positive", 0.8)],
                                   "label string, prediction string, probability double")
    assert rows(ml._reported(scored)) == [("negative", 1, False), ("positive", 3, False)]
    constant = scored.withColumn("prediction", F.lit("positive"))
    assert rows(ml._reported(constant)) == [("negative", 1, True), ("positive", 3, True)]
    assert not ml._separates(constant).first()[0]


def test_texts_are_cleaned_once(spark, lake, monkeypatch):
    for df in ml._train_test(spark, lake):
        assert "regexp_replace" not in plan(df)
    seen = []
    fit, score = models.fit_sentiment, models.score
    monkeypatch.setattr(models, "fit_sentiment", lambda train: seen.append(train) or fit(train))
    monkeypatch.setattr(models, "score", lambda model, docs: seen.append(docs) or score(model, docs))
    QUERIES["ml_batch_score"](spark, lake)
    assert len(seen) == 2 and not any("regexp_replace" in plan(df) for df in seen)


def test_training_rows_come_from_written_counts(spark):
    train = models.prepare(spark.createDataFrame([("aa bb aa", "x"), ("bb cc", "y"), ("bb", "x")], "text string, label string"))
    features, index, got = models._featured(train, "label", "text", 10)
    assert "regexp" not in plan(got) and got.columns == ["label_index", "features"]
    want = index.transform(features.transform(train)).select("label_index", "features")
    assert rows(got) == rows(want)


def test_buckets_follow_the_rows(spark):
    assert [star_tables.bucket_number(spark.range(n), spark.range(1)) for n in (0, 1 << 21, 1 << 24, (1 << 24) + 1)] == [8, 8, 32, 64]


def test_tfidf_counts_only_the_vocabulary_by_its_numbers(spark):
    docs = spark.createDataFrame([(1, "aa bb aa zz"), (1, "bb cc"), (2, "cc bb bb"), (3, ""), (4, None), (None, "bb bb bb bb yy"), (5, "qq")],
                                 "doc_id long, text string")
    out = tfidf(docs, "doc_id", "text", 3)  # cc and aa have two occurrences each, qq and zz one
    assert "Aggregate [doc_id" in plan(out) and not re.search(r"Aggregate \[doc_id#\d+L, term", plan(out))
    idf = {t: math.log(8 / (1 + df)) + 1 for t, df in (("aa", 1), ("bb", 2), ("cc", 2))}
    tf = {1: {"aa": 2, "bb": 2, "cc": 1}, 2: {"bb": 2, "cc": 1}}
    want = []
    for d, counts in tf.items():
        norm = math.sqrt(sum((n * idf[t]) ** 2 for t, n in counts.items()))
        want += [(d, t, n, round(n * idf[t] / norm, 9)) for t, n in counts.items()]
    assert rows(out.withColumn("tfidf", F.round("tfidf", 9))) == sorted(want)


def test_cleaning_deletes_the_same_characters(spark):
    every = [c for c in range(1, 0x20000) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(chr(c),) for c in every], "c string")
    left = {r[0] for r in df.where(drop_emoji(F.col("c")) != "").collect()}
    emoji = ((0x1F600, 0x1F64F), (0x1F300, 0x1F5FF), (0x1F680, 0x1F6FF), (0x1F1E0, 0x1F1FF), (0x2702, 0x27B0), (0x24C2, 0x1F251))
    assert left == {chr(c) for c in every if not any(lo <= c <= hi for lo, hi in emoji)}
    assert {r[0] for r in df.where(strip_markup(F.col("c")) == "").collect()} == set("@#!?+&*[]-%.:/();$=><|{}^'`_")


def test_mart_cuts_the_fact_to_orders_before_it_meets_dimensions(spark, sf):
    s = _Star(spark, sf)
    fact = star.fact_table_clean(*s.parts())
    dims = (s.order_dim, s.product, s.customer, s.seller, s.date)
    mart = star.sales_mart(fact, *dims, counted=s.order, joined=True)
    assert "LeftSemi" not in plan(star.sales_mart(spark.createDataFrame([], fact.schema), *dims, joined=True))
    assert rows(mart) == rows(star.sales_mart(fact, *dims, counted=s.order))


def test_mart_of_repeated_orders_keeps_the_smallest_row_of_a_unique_customer(spark):
    mk = spark.createDataFrame
    columns = ", ".join(f"{c} {'string' if c.endswith('_id') and c != 'order_item_id' else 'long'}" for c in star.FACT_COLUMNS)
    fact = mk([("o1", 2, "c1", "p1", "r", "s", 20240101, 1, 1, 1, 1, 1), ("o1", 1, "c2", "p1", "r", "s", 20240101, 1, 1, 1, 1, 1),
               ("o1", 1, "c3", "p1", "r", "s", 20240101, 1, 1, 1, 1, 1), ("o1", 0, "c1", "gone", "r", "s", 20240101, 1, 1, 1, 1, 1)], columns)
    one = {"product": mk([("p1", 1)], "product_id string, size int"), "seller": mk([("s", 1)], "seller_id string, zip int"),
           "date": mk([(20240101,)], "dateKey long")}
    order_dim = mk([("o1", "ok", "card"), ("o1", "ok", "boat")], "order_id string, order_status string, payment_type string")
    customer = mk([("c1", "u1"), ("c2", "u1"), ("c3", "u2")], "customer_id string, customer_unique_id string")
    mart = star.sales_mart(fact, order_dim, one["product"], customer, one["seller"], one["date"])
    assert rows(mart, "customer_unique_id", "customer_id", "order_item_id", "payment_type") == [("u1", "c2", 1, "boat"), ("u2", "c3", 1, "boat")]
