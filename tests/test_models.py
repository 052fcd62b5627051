import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnlake.plans import models


@pytest.fixture(scope="module")
def reviews(spark):
    """Texts whose label follows from one word among shared filler words."""
    df = spark.range(240).selectExpr(
        "id", "case when id % 3 = 0 then 'negative' else 'positive' end as label",
        "concat('item number ', cast(id % 17 as string), ' was ', case when id % 3 = 0 then 'awful' else 'lovely' end, "
        "' thing ', cast(id % 11 as string)) as text")
    return models.prepare(df)


def test_features_follow_the_formula(spark):
    df = spark.createDataFrame([("aa bb aa",), ("bb cc",), ("bb",)], "text string")
    m = models.fit_features(df, vocabulary=2)
    vocab = m.stages[1].vocabulary
    first = m.transform(df).first()["features"].toArray()
    idf = {"aa": math.log(4 / 2) + 1, "bb": math.log(4 / 4) + 1}
    want = np.array([{"aa": 2, "bb": 1}[w] * idf[w] for w in vocab])
    assert np.allclose(first, want / np.linalg.norm(want))


def test_sentiment_fit_score_and_roundtrip(spark, reviews, tmp_path):
    train, test = reviews.where("id < 180"), reviews.where("id >= 180")
    fitted = models.fit_sentiment(train, c=10.0)
    out = models.score(fitted.model, test)
    assert out.where("prediction = label").count() == 60
    assert fitted.model.stages[1].numClasses == 2 and fitted.model.stages[1].coefficientMatrix.numRows == 1
    assert out.where("probability < 0.5 or probability > 1").count() == 0
    path = str(tmp_path / "m")
    models.save_model(fitted.model, path)
    again = models.score(models.load_model(path), test)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


def test_models_score_after_an_observed_write(spark, reviews):
    from tarnlake.operators.profiling import observed
    df, _ = observed(spark.range(5))
    df.write.format("noop").mode("overwrite").save()
    assert models.score(models.fit_sentiment(reviews, c=10.0).model, reviews).where("prediction = label").count() == 240


def test_grid_search_picks_the_best(reviews):
    fitted = models.fit_sentiment_cv(reviews, "id", cs=(0.0001, 10.0), penalties=("l1",), folds=3, max_iter=50)
    assert fitted.c == 10.0 and len(fitted.scores) == 2
    assert max(s for _, _, s in fitted.scores) > 0.95


@pytest.fixture(scope="module")
def noisy(spark):
    """Sparse rows whose label follows from a few features, with noise, in five folds."""
    from pyspark.ml.linalg import Vectors
    r = np.random.default_rng(7)
    rows = []
    for i in range(400):
        at = sorted(r.choice(60, 8, replace=False).tolist())
        x = r.random(8)
        z = sum(v * (1.5 if k < 20 else -1.5 if k < 40 else 0) for k, v in zip(at, x)) + r.normal(0, 0.8)
        rows.append((i, Vectors.sparse(60, at, x.tolist()) if i % 9 else Vectors.dense(np.eye(60)[i % 60]), float(z > 0.3), i % 5))
    return spark.createDataFrame(rows, ["id", "features", "label_index", "fold"])


def test_grid_search_scores_equal_one_fit_for_each_point_and_fold(noisy):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    from tarnlake.plans.grid_search import grid_scores, sparse_blocks
    grid = [(reg, p) for reg in (0.05, 0.005, 0.0005) for p in ("l1", "l2")]
    base = models.logistic(1.0, "l2", 400, max_iter=2000)
    base.setTol(1e-10)
    maps = [ParamGridBuilder().baseOn((base.regParam, reg), (base.elasticNetParam, float(p == "l1"))).build()[0] for reg, p in grid]
    search = CrossValidator(estimator=base, estimatorParamMaps=maps, numFolds=5, foldCol="fold", parallelism=4,
                            evaluator=MulticlassClassificationEvaluator(labelCol="label_index", metricName="accuracy"))
    want = search.fit(noisy.coalesce(1)).avgMetrics
    got, weights = grid_scores(sparse_blocks(noisy, "features", "label_index", "fold").persist(), 60, grid, [80] * 5, tolerance=1e-12, max_iter=2000)
    assert np.allclose(got, want, atol=1e-6) and int(np.argmax(got)) == int(np.argmax(want))
    one = base.copy({base.regParam: 0.005, base.elasticNetParam: 1.0}).fit(noisy.where("fold <> 2").coalesce(1))
    mine = weights[grid.index((0.005, "l1")) * 5 + 2]
    assert np.allclose(mine[:-1], one.coefficients.toArray(), atol=1e-3) and abs(mine[-1] - one.intercept) < 1e-3
    assert (mine[:-1] == 0).sum() >= 5


def test_grid_search_takes_models_in_several_passes_and_empty_folds(noisy, monkeypatch):
    from tarnlake.plans import grid_search
    grid = [(0.01, "l1"), (0.01, "l2")]
    blocks = grid_search.sparse_blocks(noisy.withColumn("fold", F.col("fold") % 3), "features", "label_index", "fold").persist()
    sizes = [sum(i % 5 % 3 == k for i in range(400)) for k in range(4)]
    whole, _ = grid_search.grid_scores(blocks, 60, grid, sizes, tolerance=1e-10, max_iter=500)
    monkeypatch.setattr(grid_search, "POINT_BYTES", 8 * 61 * 3)
    parts, _ = grid_search.grid_scores(blocks, 60, grid, sizes, tolerance=1e-10, max_iter=500)
    assert whole == parts


def test_kmeans_separates_distant_groups(spark):
    df = spark.range(60).select("id", F.array(*[(F.col("id") % 3 * 10 + F.col("id") / 100).cast("float")] * 2).alias("v"))
    groups = models.kmeans(df, "v", 3).groupBy(F.col("id") % 3).agg(F.countDistinct("cluster").alias("n")).collect()
    assert [r["n"] for r in groups] == [1, 1, 1]


def test_forest_beats_the_mean(spark):
    df = spark.range(300).select(F.array((F.col("id") % 10).cast("double"), F.lit(1.0), F.lit(2.0)).alias("v"),
                                 (F.col("id") % 10 * 3).cast("double").alias("y"))
    model = models.forest(df, "v", "y", trees=10)
    mse = models.predict_forest(model, df, "v").agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0]
    assert mse < 10 < df.agg(F.var_pop("y")).first()[0]
