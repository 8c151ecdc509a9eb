"""The eight classifiers, each as ``fit_predict(train, test) -> test rows with prediction``.

Input rows have image_id, label and features (array of doubles). The plain
settings are those of the published run, with the stopping tolerances its
learners have by default; where the Spark learner differs, the mapping is noted
at the model.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from furlens.functions.kernel import N_FEATURES
from furlens.operators import bayes, calibration, forest, neighbors
from furlens.operators.scaling import scale, scaler

SEED = 42
ROWS_PER_PARTITION = 20_000
# Fully grown trees are the published setting; MLlib allows 30 levels. The same
# depth holds for every size. The node of each row is kept (cacheNodeIds): else
# every pass ships the trees so far and walks each row down from the root.
FULL_DEPTH = 30
# Up to here MLlib counts all rows for the limits of its bins; beyond it takes a sample.
MLLIB_COUNTS_ALL = 10_000


@dataclass(frozen=True)
class ModelSpec:
    name: str
    needs_scaling: bool
    fit_predict: Callable[[DataFrame, DataFrame], DataFrame]


def compact(df: DataFrame, rows: int) -> DataFrame:
    """Merge partitions that hold too few rows for an iterative learner; never adds a shuffle."""
    return df.coalesce(max(1, math.ceil(rows / ROWS_PER_PARTITION)))


def _vectors(df: DataFrame) -> DataFrame:
    return df.select("image_id", F.col("label").cast("double").alias("label"), array_to_vector("features").alias("features"))


def _plain(predictions: DataFrame) -> DataFrame:
    return predictions.select(
        "image_id", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")
    )


def _without_summary(model):
    """Drop the training summary of a fitted model.

    Spark 4.1 ships the summary, and with it the session, to the tasks that
    predict; once the session has observed a query it cannot be serialised.
    """
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(SparkContext._active_spark_context._jvm.scala.Option.empty())
    return model


def _mllib(estimator, train: DataFrame, test: DataFrame) -> DataFrame:
    model = _without_summary(estimator.fit(_vectors(train)))
    return _plain(model.transform(_vectors(test)))


def _width(train: DataFrame) -> int:
    return train.select(F.size("features")).first()[0]


def _grown(train: DataFrame, test: DataFrame, trees: int, depth: int) -> DataFrame | None:
    """Predictions of trees grown in tasks, where MLlib would choose limits from a sample and the rows fit into a task."""
    rows = train.count()
    if rows <= MLLIB_COUNTS_ALL or not forest.fits(rows, test.count(), _width(train)):
        return None
    return forest.fit_predict(train, test, _width(train), trees, depth, SEED)


def _counted(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame, dict]:
    """Both sets and settings with which MLlib splits between limits that were counted over all rows."""
    rows = train.count()
    if rows <= MLLIB_COUNTS_ALL:
        return train, test, {}
    # it counts maxBins squared rows; the bins themselves stay those of the features
    return *forest.binned(train, test, _width(train)), {"maxBins": math.ceil(math.sqrt(rows)) + 1}


def random_forest(train: DataFrame, test: DataFrame, trees: int = 100, depth: int = FULL_DEPTH) -> DataFrame:
    grown = _grown(train, test, trees, depth)
    if grown is not None:
        return grown
    train, test, counted = _counted(train, test)
    return _mllib(RandomForestClassifier(numTrees=trees, seed=SEED, maxDepth=depth, cacheNodeIds=True, **counted), train, test)


def decision_tree(train: DataFrame, test: DataFrame, depth: int = FULL_DEPTH) -> DataFrame:
    grown = _grown(train, test, 1, depth)
    if grown is not None:
        return grown
    train, test, counted = _counted(train, test)
    return _mllib(DecisionTreeClassifier(seed=SEED, maxDepth=depth, cacheNodeIds=True, **counted), train, test)


def logistic(train: DataFrame, test: DataFrame, max_iter: int = 1000) -> DataFrame:
    """L2 with C = 1: MLlib averages the loss, so its strength is 1/rows. Input is scaled already."""
    est = LogisticRegression(
        maxIter=max_iter, tol=1e-4, regParam=1.0 / max(1, train.count()), standardization=False
    )
    return _mllib(est, train, test)


def boosted_trees(train: DataFrame, test: DataFrame, rounds: int = 100, depth: int = 6) -> DataFrame:
    """First-order boosting with depth 6 and step 0.3, the usual defaults of second-order boosters."""
    train, test, counted = _counted(train, test)
    return _mllib(GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=SEED, **counted), train, test)


def perceptron(train: DataFrame, test: DataFrame, hidden: int = 50, max_iter: int = 1000, dim: int = N_FEATURES) -> DataFrame:
    """One hidden layer, sigmoid units."""
    est = MultilayerPerceptronClassifier(layers=[dim, hidden, 2], maxIter=max_iter, tol=1e-4, seed=SEED)
    return _mllib(est, train, test)


def fourier_features(dim: int = N_FEATURES, out_dim: int = 512, gamma: float | None = None, seed: int = SEED):
    """Arrow UDF for the random Fourier features of a Gaussian kernel (Rahimi and Recht 2007).

    The projection has a fixed size, ``dim`` x ``out_dim``, whatever the data.
    """
    rng = np.random.default_rng(seed)
    gamma = 1.0 / dim if gamma is None else gamma
    weights = rng.normal(0.0, math.sqrt(2.0 * gamma), (dim, out_dim))
    shift = rng.uniform(0.0, 2.0 * math.pi, out_dim)

    @F.arrow_udf(ArrayType(DoubleType()))
    def lift(vectors: pa.Array) -> pa.Array:
        x = np.asarray(vectors.flatten()).reshape(-1, dim)
        z = math.sqrt(2.0 / out_dim) * np.cos(x @ weights + shift)
        offsets = np.arange(len(x) + 1, dtype=np.int32) * out_dim
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(z.ravel()))

    return lift.asNondeterministic()


def _svm_decisions(train: DataFrame, rows: DataFrame, max_iter: int, dim: int, out_dim: int) -> DataFrame:
    """``rows`` with the distance from the separating plane, positive on the side of label 1."""
    lift = fourier_features(dim, out_dim)

    def lifted(df: DataFrame) -> DataFrame:
        return df.withColumn("features", lift(F.col("features")))

    est = LinearSVC(maxIter=max_iter, tol=1e-3, regParam=1.0 / max(1, train.count()), standardization=False)
    model = _without_summary(est.fit(_vectors(lifted(train))))
    raw = vector_to_array("rawPrediction")
    return model.transform(_vectors(lifted(rows))).select(
        "image_id", F.col("label").cast("int").alias("label"), F.get(raw, F.lit(1)).alias("decision"), F.col("prediction").cast("int").alias("prediction")
    )


def kernel_svm(train: DataFrame, test: DataFrame, max_iter: int = 1000, dim: int = N_FEATURES, out_dim: int = 512) -> DataFrame:
    """Gaussian-kernel SVM with C = 1, approximated by a linear one on random Fourier features."""
    return _svm_decisions(train, test, max_iter, dim, out_dim).drop("decision")


def kernel_svm_probability(
    train: DataFrame,
    test: DataFrame,
    max_iter: int = 1000,
    dim: int = N_FEATURES,
    out_dim: int = 512,
    folds: int = calibration.FOLDS,
) -> DataFrame:
    """As ``kernel_svm``, with ``decision`` and the ``probability`` of label 1.

    The sigmoid is fitted on the decisions of ``folds`` models that did not see
    their rows; the prediction stays the side of the plane, so near it the two
    may disagree.
    """

    def decide(fitted_on: DataFrame, rows: DataFrame) -> DataFrame:
        return _svm_decisions(fitted_on, rows, max_iter, dim, out_dim)

    sigmoid = calibration.fit_sigmoid(calibration.cross_decisions(train, decide, folds))
    return decide(train, test).withColumn("probability", sigmoid.of(F.col("decision")))


def naive_bayes(train: DataFrame, test: DataFrame) -> DataFrame:
    return _plain(bayes.predict(test, bayes.fit(train)))


def nearest(train: DataFrame, test: DataFrame, k: int = 5, max_train_rows: int | None = neighbors.MAX_TRAIN_ROWS) -> DataFrame:
    """All train rows count; up to ``max_train_rows`` of them are broadcast, more are joined."""
    return _plain(neighbors.predict(train, test, k, max_train_rows=max_train_rows))


def default_models() -> list[ModelSpec]:
    """In the published order; the order also breaks ties between equally accurate models."""
    return [
        ModelSpec("Random Forest", False, random_forest),
        ModelSpec("Logistic Regression", True, logistic),
        ModelSpec("Decision Tree", False, decision_tree),
        ModelSpec("SVM", True, kernel_svm),
        ModelSpec("Naive Bayes", False, naive_bayes),
        ModelSpec("K-Neighbors", True, nearest),
        ModelSpec("Neural Network", True, perceptron),
        ModelSpec("XGBoost", False, boosted_trees),
    ]


def fit_predict(spec: ModelSpec, train: DataFrame, test: DataFrame) -> DataFrame:
    """Scale where the model needs it (fitted on train only), then fit and predict."""
    if spec.needs_scaling:
        fitted = scaler(train)
        train, test = scale(train, fitted), scale(test, fitted)
    return spec.fit_predict(train, test)
