"""Spark ML jobs: sentiment classifier over TF-IDF, clustering and regression."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import (IDF, CountVectorizer, ElementwiseProduct, IndexToString, Normalizer, RegexTokenizer,
                                StringIndexer)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_text
from ..sources.scratch import new_path, written
from .grid_search import grid_scores, sparse_blocks

# Vocabulary size, the search grid and the parameters of the fixed fit.
VOCABULARY = 15_000
GRID_C = (0.001, 0.01, 0.1, 1.0, 10.0)
GRID_PENALTY = ("l1", "l2")
FIXED_C, FIXED_PENALTY = 1.5, "l1"
MAX_ITER = 1000
TOLERANCE = 1e-4
FOLDS = 5

TEXT, LABEL, FEATURES, CLASS = "text", "label", "features", "predicted_class"


def prepare(docs: DataFrame, text: str = TEXT) -> DataFrame:
    return docs.withColumn(text, clean_text(F.col(text)))


def _counted(train: DataFrame, text: str, vocabulary: int) -> tuple[list, DataFrame]:
    """Fitted tokeniser and counter, and ``train`` with counts in place of its text, as a written table."""
    tokens = RegexTokenizer(inputCol=text, outputCol="tokens", pattern=r"[\p{L}\p{N}_]{2,}", gaps=False,
                            minTokenLength=2, toLowercase=True)
    counter = CountVectorizer(inputCol="tokens", outputCol="counts", vocabSize=vocabulary)
    # Two passes read the tokens: vocabulary and counts.
    words = tokens.transform(train).drop(text).persist()
    try:
        counts = counter.fit(words)
        rows = written(counts.transform(words).drop("tokens"), "counted-rows")
    finally:
        words.unpersist()
    return [tokens, counts], rows


def _weights(counted: DataFrame) -> list:
    """Stages from counts to features, fitted on these rows."""
    idf = IDF(inputCol="counts", outputCol="idf").fit(counted)
    weights = ElementwiseProduct(scalingVec=Vectors.dense(idf.idf.toArray() + 1.0), inputCol="counts",
                                 outputCol="weighted")
    return [weights, Normalizer(p=2.0, inputCol="weighted", outputCol=FEATURES)]


def fit_features(train: DataFrame, text: str = TEXT, vocabulary: int = VOCABULARY) -> PipelineModel:
    """TF-IDF fitted on the training rows only: counts, smoothed idf + 1, unit length."""
    stages, rows = _counted(train.select(text), text, vocabulary)
    return PipelineModel(stages=[*stages, *_weights(rows)])


def logistic(c: float, penalty: str, rows: int, label: str = "label_index", max_iter: int = MAX_ITER
             ) -> LogisticRegression:
    """Logistic regression whose penalty equals an inverse strength ``c`` over summed losses."""
    return LogisticRegression(
        featuresCol=FEATURES, labelCol=label, maxIter=max_iter, tol=TOLERANCE,
        standardization=False, family="binomial",
        regParam=1.0 / (c * rows), elasticNetParam=1.0 if penalty == "l1" else 0.0)


@dataclass(frozen=True)
class Sentiment:
    """Fitted features, label index and classifier as one pipeline, with the chosen parameters."""

    model: PipelineModel
    c: float
    penalty: str
    scores: tuple[tuple[float, str, float], ...] = ()


def _featured(train: DataFrame, label: str, text: str, vocabulary: int, *columns: Column):
    """Fitted features, label index, and training rows (features, label index, ``columns``) from the written counts."""
    index = StringIndexer(inputCol=label, outputCol="label_index", stringOrderType="alphabetAsc",
                          handleInvalid="error").fit(train)
    if len(index.labels) > 2:
        raise ValueError(f"two classes are expected, not {index.labels}")
    stages, rows = _counted(index.transform(train).select(text, "label_index", *columns), text, vocabulary)
    weights = _weights(rows)
    return PipelineModel(stages=[*stages, *weights]), index, PipelineModel(stages=weights).transform(rows).drop("counts", "weighted")


def _named(features: PipelineModel, index, model) -> PipelineModel:
    """Features, classifier and the names of its classes as one pipeline."""
    names = IndexToString(inputCol="prediction", outputCol=CLASS, labels=list(index.labels))
    return PipelineModel(stages=[features, model, names])


def _read_back(model: LogisticRegressionModel) -> LogisticRegressionModel:
    """The model as written and read: without its training summary, which holds the rows and, through them, the session.

    A model that holds the session cannot be sent to tasks once the session has observed a write.
    """
    path = new_path(SparkSession.active(), "classifier")
    model.write().save(path)
    return LogisticRegressionModel.load(path)


def fit_sentiment(train: DataFrame, label: str = LABEL, text: str = TEXT, c: float = FIXED_C,
                  penalty: str = FIXED_PENALTY, vocabulary: int = VOCABULARY) -> Sentiment:
    """Fit with given parameters. ``train`` holds cleaned text and a label.

    Texts are split into words once; their counts are written, and the fit reads that table, so the tasks of its many
    passes follow the table's bytes and not the shuffle partitions that the rows came from.
    """
    features, index, rows = _featured(train, label, text, vocabulary)
    model = _read_back(logistic(c, penalty, rows.count()).fit(rows))
    return Sentiment(_named(features, index, model), c, penalty)


def fit_sentiment_cv(train: DataFrame, row_id: str, label: str = LABEL, text: str = TEXT,
                     cs: Sequence[float] = GRID_C, penalties: Sequence[str] = GRID_PENALTY, folds: int = FOLDS,
                     vocabulary: int = VOCABULARY, max_iter: int = MAX_ITER, tolerance: float = TOLERANCE) -> Sentiment:
    """Grid search on accuracy with folds assigned by a hash of the id, then one fit on all training rows.

    All grid points and folds are minimised together (``grid_search``); of equal scores the first grid point wins.
    """
    fold = F.pmod(F.xxhash64(row_id), F.lit(folds)).cast("int")
    features, index, rows = _featured(train, label, text, vocabulary, fold.alias("fold"))
    per = {r["fold"]: r["n"] for r in rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    fold_rows = [per.get(k, 0) for k in range(folds)]
    n = sum(fold_rows)
    choices = [(c, p) for c in cs for p in penalties]
    blocks = sparse_blocks(rows, FEATURES, "label_index", "fold").persist()
    try:
        width = len(features.stages[1].vocabulary)
        regs = [(1.0 / (c * n * (folds - 1) / folds), p) for c, p in choices]
        scores, _ = grid_scores(blocks, width, regs, fold_rows, tolerance=tolerance, max_iter=max_iter)
    finally:
        blocks.unpersist()
    best = max(range(len(choices)), key=lambda i: scores[i])
    model = _read_back(logistic(*choices[best], n, max_iter=max_iter).fit(rows))
    return Sentiment(_named(features, index, model), *choices[best],
                     tuple((c, p, s) for (c, p), s in zip(choices, scores)))


def score(model: PipelineModel, docs: DataFrame, text: str = TEXT) -> DataFrame:
    """``docs`` with ``prediction``, the class name, and the probability of that class."""
    out = model.transform(docs)
    top = F.array_max(vector_to_array(F.col("probability")))
    return out.select(*docs.columns, F.col(CLASS).alias("prediction"), top.alias("probability"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def kmeans(df: DataFrame, vector: str, k: int = 3, seed: int = 1) -> DataFrame:
    """``df`` with a ``cluster`` column."""
    return kmeans_with_centres(df, vector, k, seed)[0]


def kmeans_with_centres(df: DataFrame, vector: str, k: int = 3, seed: int = 1) -> tuple[DataFrame, list[list[float]]]:
    """``kmeans`` and the k centres."""
    rows = df.withColumn(FEATURES, array_to_vector(F.col(vector).cast("array<double>")))
    model = KMeans(k=k, seed=seed, featuresCol=FEATURES, predictionCol="cluster").fit(rows)
    return model.transform(rows).drop(FEATURES), [c.tolist() for c in model.clusterCenters()]


def forest(train: DataFrame, vector: str, label: str, trees: int = 100, depth: int = 6,
           features_per_split: str = "3", seed: int = 1) -> PipelineModel:
    """Random-forest regression on an array column of numbers."""
    rows = train.select(array_to_vector(F.col(vector).cast("array<double>")).alias(FEATURES),
                        F.col(label).cast("double").alias("target"))
    model = RandomForestRegressor(numTrees=trees, maxDepth=depth, featureSubsetStrategy=features_per_split,
                                  seed=seed, featuresCol=FEATURES, labelCol="target").fit(rows)
    return Pipeline(stages=[model]).fit(rows)


def predict_forest(model: PipelineModel, df: DataFrame, vector: str) -> DataFrame:
    rows = df.withColumn(FEATURES, array_to_vector(F.col(vector).cast("array<double>")))
    return model.transform(rows).drop(FEATURES)
