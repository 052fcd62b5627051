"""Split, models and their evaluation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tarnlake.operators import evaluation as ev
from tarnlake.operators.split import stratified_split
from tarnlake.plans import models
from tarnlake.sources.scratch import new_path, written

from .registry import query, table

QUALITY = "case when quality = 1 then 'positive' else 'negative' end"


def _labels(spark, sf_dir):
    return table(spark, sf_dir, "labels").select("doc_id", F.expr(QUALITY).alias("label"))


@query("ml_stratified_split", f"""
with l as (select doc_id, {QUALITY} label from labels),
per as (select label, count(*) n from l group by label),
q as (select label, n, floor(n * wanted / total) base, n * wanted / total - floor(n * wanted / total) rest, wanted
  from (select per.*, (select sum(n) from per)::double total, floor((select sum(n) from per)::double * 0.8::double) wanted from per)),
quota as (select label, base + case when row_number() over (order by rest desc, label) <=
    wanted - sum(base) over () then 1 else 0 end quota from q)
select doc_id, l.label, case when row_number() over (partition by l.label order by md5(doc_id::varchar), doc_id) <= quota
  then 'train' else 'test' end split from l join quota on l.label = quota.label""")
def ml_stratified_split(spark, sf_dir):
    return stratified_split(_labels(spark, sf_dir), "label", "doc_id", 0.8)


def _predictions(spark, sf_dir):
    """A prediction table: documents judged by toxicity alone."""
    return table(spark, sf_dir, "labels").select(
        "doc_id", F.expr(QUALITY).alias("label"),
        F.expr("case when toxic = 1 then 'negative' else 'positive' end").alias("prediction"))


PRED = f"pred as (select {QUALITY} label, case when toxic = 1 then 'negative' else 'positive' end prediction from labels)"


@query("ml_accuracy", f"""
with {PRED} select round(avg(case when label = prediction then 1.0::double else 0 end), 9) accuracy, count(*) support
from pred""")
def ml_accuracy(spark, sf_dir):
    return ev.accuracy(_predictions(spark, sf_dir), "label", "prediction").withColumn(
        "accuracy", F.round("accuracy", 9))


@query("ml_class_report", f"""
with {PRED}, classes as (select label as "class" from pred union select prediction from pred),
counted as (select c."class", count(*) filter (label = c."class") support, count(*) filter (prediction = c."class") guessed,
  count(*) filter (label = c."class" and prediction = c."class") hit from classes c, pred group by c."class"),
per as (select "class", case when guessed > 0 then hit / guessed else 0 end p, case when support > 0 then hit / support else 0 end r,
  case when guessed + support > 0 then 2 * hit / (guessed + support) else 0 end f, support, hit from counted)
select "class", round(p, 9) as "precision", round(r, 9) recall, round(f, 9) f1, support from per
union all select 'accuracy', round(sum(hit) / sum(support), 9), round(sum(hit) / sum(support), 9), round(sum(hit) / sum(support), 9),
  sum(support)::bigint from per
union all select 'macro avg', round(avg(p), 9), round(avg(r), 9), round(avg(f), 9), sum(support)::bigint from per
union all select 'weighted avg', round(sum(p * support) / sum(support), 9), round(sum(r * support) / sum(support), 9),
  round(sum(f * support) / sum(support), 9), sum(support)::bigint from per""")
def ml_class_report(spark, sf_dir):
    out = ev.class_report(_predictions(spark, sf_dir), "label", "prediction")
    return out.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@query("ml_confusion", f"""
with {PRED} select prediction predicted, count(*) filter (label = 'negative') actual_negative,
  count(*) filter (label = 'positive') actual_positive from pred group by prediction""")
def ml_confusion(spark, sf_dir):
    return ev.confusion(_predictions(spark, sf_dir), "label", "prediction", ["negative", "positive"])


@query("ml_mse", """
select round(avg((l_extendedprice - l_quantity * 2000) * (l_extendedprice - l_quantity * 2000)), 3) mse, count(*) support
from lineitem""")
def ml_mse(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_extendedprice", (F.col("l_quantity") * 2000).alias("guess"))
    return ev.mean_squared_error(items, "l_extendedprice", "guess").withColumn("mse", F.round("mse", 3))


def _texts(spark, sf_dir):
    return models.prepare(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _split(spark, sf_dir):
    return stratified_split(_labels(spark, sf_dir), "label", "doc_id", 0.8)


def _train_test(spark, sf_dir):
    """Labelled documents by split. They meet their labels first and are cleaned once, into a written table: fits and scores read it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").join(_split(spark, sf_dir), "doc_id")
    rows = written(models.prepare(docs), "labelled-texts")
    return rows.where("split = 'train'").drop("split"), rows.where("split = 'test'").drop("split")


#: The training quota of each label, and the test rows, as CTEs.
SPLIT = f"""
l as (select doc_id, {QUALITY} label from labels),
per as (select label, count(*) n from l group by label),
q as (select label, n, floor(n * wanted / total) base, n * wanted / total - floor(n * wanted / total) rest, wanted
  from (select per.*, (select sum(n) from per)::double total, floor((select sum(n) from per)::double * 0.8::double) wanted from per)),
quota as (select label, base + case when row_number() over (order by rest desc, label) <=
    wanted - sum(base) over () then 1 else 0 end quota from q),
test as (select doc_id, label from (select doc_id, l.label, quota, row_number() over (
    partition by l.label order by md5(doc_id::varchar), doc_id) rn from l join quota on l.label = quota.label)
  where rn > quota and doc_id in (select doc_id from documents))"""


def sql_tested(*facts):
    return f"""with {SPLIT} select doc_id, label, count(*) over (partition by label) support, true probable, true known_class,
  {", ".join(f"true {x}" for x in facts)} from test"""


def _each(scored, *columns):
    """A row for every scored document: whether its probability and its class can be so, beside ``columns``."""
    return scored.select("doc_id", "label", *columns, F.col("probability").between(0.5, 1).alias("probable"),
                         F.col("prediction").isin("negative", "positive").alias("known_class"))


def _reported(scored):
    """(label, support, beats_majority) by the class report: whether accuracy reaches the share of the largest label."""
    report = ev.class_report(scored, "label", "prediction")
    every = Window.partitionBy()  # one row for each class, and three of means
    accuracy = F.max(F.when(F.col("class") == "accuracy", F.col("f1"))).over(every)
    n = F.max(F.when(F.col("class") == "accuracy", F.col("support"))).over(every)
    per_class = F.col("class").isin("negative", "positive")
    share = F.max(F.when(per_class, F.col("support"))).over(every) / n
    return report.select(F.col("class").alias("label"), "support", (accuracy >= share).alias("beats_majority")).where(F.col("label").isin("negative", "positive"))


def _separates(scored):
    """One row: whether labelled documents that are positive have a higher mean probability of being so than the others; a
    constant guess does not give them that."""
    positive = F.when(F.col("prediction") == "positive", F.col("probability")).otherwise(1 - F.col("probability"))
    mean = {k: F.avg(F.when(F.col("label") == k, positive)) for k in ("positive", "negative")}
    return scored.agg((mean["positive"] > mean["negative"] + 1e-9).alias("separates"))  # sums of equal numbers differ in the last digit


@query("ml_sentiment_fit", sql_tested("separates", "beats_majority"))
def ml_sentiment_fit(spark, sf_dir):
    """Every test document, scored; the model is judged on them by accuracy, and on all labelled documents by mean probability."""
    train, test = _train_test(spark, sf_dir)
    model = models.fit_sentiment(train).model
    every = train.withColumn("tested", F.lit(False)).unionByName(test.withColumn("tested", F.lit(True)))
    scored = written(models.score(model, every).drop("text"), "scored")
    tested = scored.where("tested")
    return _each(tested.join(F.broadcast(_reported(tested)), "label").crossJoin(F.broadcast(_separates(scored))),
                 "support", "separates", "beats_majority")


@query("ml_sentiment_cv", sql_tested("beats_majority"))
def ml_sentiment_cv(spark, sf_dir):
    """The whole grid on all training rows; every test document, scored by the chosen model, which is judged by accuracy."""
    train, test = _train_test(spark, sf_dir)
    scored = written(models.score(models.fit_sentiment_cv(train, "doc_id").model, test).drop("text"), "scored")
    return _each(scored.join(F.broadcast(_reported(scored)), "label"), "support", "beats_majority")


@query("ml_batch_score", f"""
with l as (select doc_id, {QUALITY} label from labels)
select d.doc_id, l.label, count(l.label) over (partition by l.label) labelled, count(*) over () scored,
  true probable, true known_class, true more_sure_when_right from documents d left join l on d.doc_id = l.doc_id""")
def ml_batch_score(spark, sf_dir):
    """Every document, scored; on the labelled ones the model is surer of its right guesses than of its wrong ones."""
    texts = written(_texts(spark, sf_dir), "texts")
    train = texts.join(_split(spark, sf_dir).where("split = 'train'"), "doc_id").drop("split")
    scored = models.score(models.fit_sentiment(train).model, texts).select("doc_id", "prediction", "probability")
    scored = written(scored.join(_labels(spark, sf_dir), "doc_id", "left"), "scored")
    per = scored.withColumn("right", F.col("prediction") == F.col("label")).groupBy("label").agg(
        F.count("label").alias("labelled"), F.count(F.lit(1)).alias("n"),
        *[F.sum(F.when(F.col("right") == want, x)).alias(name) for want, kind in ((True, "right"), (False, "wrong"))
          for name, x in ((f"{kind}_n", F.lit(1)), (f"{kind}_p", F.col("probability")))])
    every = Window.partitionBy()  # one row for each label, and one for documents without
    mean = {k: F.sum(f"{k}_p").over(every) / F.sum(f"{k}_n").over(every) for k in ("right", "wrong")}
    per = per.select(F.col("label").alias("of"), "labelled", F.sum("n").over(every).alias("scored"),
                     (mean["right"] > F.coalesce(mean["wrong"], F.lit(0.0))).alias("more_sure_when_right"))
    return _each(scored.join(F.broadcast(per), F.col("label").eqNullSafe(F.col("of"))), "labelled", "scored", "more_sure_when_right")


@query("ml_model_roundtrip", f"with {SPLIT} select doc_id, true same from test")
def ml_model_roundtrip(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    fitted = models.fit_sentiment(train)
    path = new_path(spark, "sentiment-model")
    models.save_model(fitted.model, path)
    before = models.score(fitted.model, test).select("doc_id", "prediction", "probability")
    after = models.score(models.load_model(path), test).select(
        "doc_id", F.col("prediction").alias("after"), F.col("probability").alias("p"))
    return before.join(after, "doc_id").select(
        "doc_id", ((F.col("prediction") == F.col("after")) & (F.col("probability") == F.col("p"))).alias("same"))


@query("ml_kmeans", "select vec_id, true own_is_nearest from embeddings")
def ml_kmeans(spark, sf_dir):
    rows, centres = models.kmeans_with_centres(table(spark, sf_dir, "embeddings"), "embedding", 3)
    vector = F.transform("embedding", lambda x: x.cast("double"))

    def distance(centre):
        return F.aggregate(F.zip_with(vector, F.lit(centre), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, x: a + x)

    distances = F.array(*[distance(c) for c in centres])
    own = F.get(distances, F.col("cluster"))
    return rows.select("vec_id", (own <= F.array_min(distances) * (1 + 1e-9)).alias("own_is_nearest"))


@query("ml_rf_regression", """
with r as (select label, row_number() over (order by md5(vec_id::varchar), vec_id) rn,
    floor(count(*) over ()::double * 0.75::double) wanted from embeddings),
t as (select avg(label) as guess from r where rn <= wanted)
select count(*) support, round(avg((label - guess) * (label - guess)), 6) mse_of_mean, true forest_is_close
from r, t where rn > wanted""")
def ml_rf_regression(spark, sf_dir):
    """The labels do not follow from the vectors, so the forest cannot beat the mean of the training labels, but must stay
    within a tenth of its squared error."""
    rows = table(spark, sf_dir, "embeddings").withColumn("one", F.lit("all"))
    split = stratified_split(rows, "one", "vec_id", 0.75)
    train = split.where("split = 'train'")
    model = models.forest(train, "embedding", "label")
    guessed = models.predict_forest(model, split.where("split = 'test'"), "embedding").withColumn("guess", train.agg(F.avg("label")).scalar())
    forest = ev.mean_squared_error(guessed, "label", "prediction").select("mse").withColumn("one", F.lit(1))
    mean = ev.mean_squared_error(guessed, "label", "guess").select("support", F.col("mse").alias("mse_of_mean"), F.lit(1).alias("one"))
    return mean.join(forest, "one").select("support", F.round("mse_of_mean", 6).alias("mse_of_mean"),
                                           (F.col("mse") <= 1.1 * F.col("mse_of_mean")).alias("forest_is_close"))
