"""Classifiers on spark.ml.

Regularisation follows the reference's convention: ``C`` multiplies the
summed loss, Spark's ``regParam`` the mean-loss penalty, hence
``regParam = 1 / (C * n)``. The margin classifier re-aims a kernel SVM as
a feature map applied in Arrow batches, a linear machine with squared hinge loss,
and Platt scaling (Platt, 1999) fitted on out-of-fold margins.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.learn import batch
from riskframe.learn.kernels import KernelMap

MAX_TREE_DEPTH = 30  # Spark refuses deeper trees


def _depth(max_depth: int | None) -> int:
    if max_depth is not None and max_depth > MAX_TREE_DEPTH:
        raise ValueError(f"Spark grows trees to depth {MAX_TREE_DEPTH} at most; {max_depth} was asked for")
    return MAX_TREE_DEPTH if max_depth is None else max_depth


def logistic(C: float = 1.0, penalty: str = "l2", l1_ratio: float = 0.5, n_rows: int = 1,
             max_iter: int = 100, label: str = "label", features: str = "features",
             solver: str = "lbfgs") -> LogisticRegression | PenalisedIntercept:
    """E5: none / l1 / l2 / elasticnet logistic regression.

    ``solver="liblinear"`` solves that library's problem: the intercept is the weight of
    a constant feature and is penalised like the others."""
    reg = 0.0 if penalty == "none" else 1.0 / (C * max(1, n_rows))
    mix = {"none": 0.0, "l2": 0.0, "l1": 1.0, "elasticnet": l1_ratio}[penalty]
    est = LogisticRegression(labelCol=label, featuresCol=features, regParam=reg, elasticNetParam=mix,
                             standardization=False, maxIter=max_iter)
    if solver != "liblinear":
        return est
    return PenalisedIntercept(est.setFeaturesCol("_with_one").setFitIntercept(False), features, label)


class PenalisedIntercept(Estimator):
    """``est`` without intercept on the features and a constant one. Spark gives constant
    columns no weight, so each row also comes mirrored, (-x, other label), which has the
    same loss and leaves the mean loss as it is."""

    def __init__(self, est: LogisticRegression, features: str, label: str):
        super().__init__()
        self.est, self.features, self.label = est, features, label

    def _fit(self, train: DataFrame) -> PipelineModel:
        one = [SQLTransformer(statement="SELECT *, 1.0D AS _one FROM __THIS__"),
               VectorAssembler(inputCols=[self.features, "_one"], outputCol="_with_one")]
        z = PipelineModel(stages=one).transform(train).select(F.col(self.label).cast("double").alias(self.label), "_with_one")
        other = array_to_vector(F.transform(vector_to_array("_with_one"), lambda x: -x))
        both = z.unionAll(z.select((1 - F.col(self.label)).alias(self.label), other.alias("_with_one")))
        return PipelineModel(stages=[*one, self.est.fit(both)])


def random_forest(num_trees: int = 100, max_depth: int | None = 10, feature_subset: str = "sqrt",
                  bootstrap: bool = True, min_instances: int = 1, seed: int = 42,
                  label: str = "label", features: str = "features") -> RandomForestClassifier:
    """Random forest. Without ``max_depth`` trees grow to Spark's limit; more is an error."""
    depth = _depth(max_depth)
    return RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=num_trees, maxDepth=depth,
                                  featureSubsetStrategy=feature_subset, bootstrap=bootstrap,
                                  minInstancesPerNode=min_instances, seed=seed)


def gradient_boosting(max_iter: int = 100, step: float = 0.1, max_depth: int = 3, subsample: float = 1.0,
                      min_instances: int = 1, seed: int = 42, label: str = "label",
                      features: str = "features") -> GBTClassifier:
    """Gradient-boosted trees. A depth beyond Spark's limit is an error."""
    return GBTClassifier(labelCol=label, featuresCol=features, maxIter=max_iter, stepSize=step,
                         maxDepth=_depth(max_depth), subsamplingRate=subsample,
                         minInstancesPerNode=min_instances, seed=seed)


def mlp(n_features: int, hidden=(50, 25), max_iter: int = 200, seed: int = 42, label: str = "label",
        features: str = "features") -> MultilayerPerceptronClassifier:
    """Multilayer perceptron with the given hidden layers and 2 outputs."""
    return MultilayerPerceptronClassifier(labelCol=label, featuresCol=features,
                                          layers=[n_features, *hidden, 2], maxIter=max_iter, seed=seed)


# ---------------------------------------------------------------- E8
def kernel_width(value):
    return value if value in ("scale", "auto") else TypeConverters.toFloat(value)


def width(gamma: float | str, spread: float, n_features: int) -> float:
    """``gamma`` itself; "auto" is 1 / features, "scale" 1 / (features * variance of all entries)."""
    if gamma == "auto":
        return 1.0 / n_features
    if gamma != "scale":
        return float(gamma)
    return 1.0 / (n_features * spread) if spread > 0 else 1.0


def landmarks(rows: DataFrame, n: int) -> np.ndarray:
    """The ``n`` rows of a ``batch.table`` with the least hash, equal ones once."""
    found = rows.select("x").distinct().orderBy(F.xxhash64("x"), "x").limit(n).collect()
    return np.array([r["x"] for r in found], float)


class MarginClassifierModel(Model, MLWritable, MLReadable):
    """Fitted E8: feature map, weights (the last is the intercept) and Platt sigmoid."""

    def __init__(self, kernel: KernelMap | None = None, weights: np.ndarray | None = None, a: float = 1.0, b: float = 0.0, features: str = "features"):
        super().__init__()
        self.kernel, self.weights, self.a, self.b, self.features = kernel, weights, a, b, features

    def _transform(self, df: DataFrame) -> DataFrame:
        kernel, weights = self.kernel, self.weights

        @F.pandas_udf(T.DoubleType())
        def margin(xs: pd.Series) -> pd.Series:
            if len(xs) == 0:
                return pd.Series([], dtype=float)
            return pd.Series(kernel.of(np.stack(xs.to_numpy())) @ weights[:-1] + weights[-1])

        prob1 = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(self.a) * F.col("margin") + F.lit(self.b))))
        return (df.withColumn("margin", margin(vector_to_array(F.col(self.features))))
                .withColumn("prob1", prob1)
                .withColumn("probability", array_to_vector(F.array(1 - F.col("prob1"), F.col("prob1"))))
                .withColumn("rawPrediction", array_to_vector(F.array(-F.col("margin"), F.col("margin"))))
                .withColumn("prediction", (F.col("prob1") >= 0.5).cast("double")).drop("prob1"))

    def write(self) -> MLWriter:
        return MarginWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return MarginReader(cls)


class MarginWriter(MLWriter):
    """Spark ML's stage format: all of the model is a few numbers, which go into the metadata."""

    def __init__(self, model: MarginClassifierModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:  # noqa: N802
        m = self.model
        extra = {"kernel": m.kernel.settings(), "weights": m.weights.tolist(), "a": m.a, "b": m.b, "features": m.features}
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata=extra)


class MarginReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> MarginClassifierModel:
        m = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(KernelMap.made(m["kernel"]), np.array(m["weights"], float), m["a"], m["b"], m["features"])
        model._resetUid(m["uid"])
        return model


class MarginClassifier(Estimator):
    """A kernel's feature map (see ``kernels``), a linear machine with squared hinge loss, and Platt
    scaling learned on out-of-fold margins. As an Estimator it fits into pipelines, cross-validation and
    sweeps; ``C``, ``gamma`` and ``kernel`` are parameters of a grid.

    The fits of all folds and of the whole share one pass of the table per iteration. Folds are dealt by
    ``key``, or where there is none by a hash of the features. Spark numbers no rows, so without a key
    equal rows share a fold. ``gamma`` may be "scale" or "auto"."""

    C = Param(Params._dummy(), "C", "weight of the summed loss", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "width of the kernel", kernel_width)
    kernel = Param(Params._dummy(), "kernel", "rbf, poly or sigmoid", TypeConverters.toString)

    def __init__(self, n_features: int | None = None, label: str = "label", features: str = "features", C: float = 1.0, gamma: float | str = 0.1,
                 n_components: int = 256, folds: int = 3, key: str | None = None, seed: int = 42, max_iter: int = 100, kernel: str = "rbf"):
        super().__init__()
        self.label, self.features, self.key = label, features, key
        self.n_features, self.n_components, self.folds, self.seed, self.max_iter = n_features, n_components, folds, seed, max_iter
        self._setDefault(C=1.0, gamma=0.1, kernel="rbf")
        self._set(C=C, gamma=gamma, kernel=kernel)

    def _fit(self, train: DataFrame) -> MarginClassifierModel:
        fold = F.pmod(F.xxhash64(F.col(self.key) if self.key else vector_to_array(self.features), F.lit(self.seed)), F.lit(max(1, self.folds)))
        rows = batch.written(batch.table(train.select(self.features, self.label, fold.alias("_fold")), self.features, self.label, "_fold"))
        split = [None, *(range(self.folds) if self.folds > 1 else ())]
        plain, counts, spread = batch.fold_views(rows, split, scaled=0)
        size = len(plain[0].shift)
        marks = landmarks(rows, self.n_components) if self.getOrDefault("kernel") == "sigmoid" else None
        kernel = KernelMap(self.getOrDefault("kernel"), size, self.n_components, width(self.getOrDefault("gamma"), spread[0], size), self.seed, marks)
        view = batch.View(np.zeros(size), np.ones(size), kernel.of)
        problems = [batch.Problem(1.0 / (self.getOrDefault("C") * max(1, counts[0])), 0, f, "squared_hinge") for f in split]
        views = [view]
        batch.solve(rows, problems, views, counts, max_iter=self.max_iter)
        seen = batch.left_out_scores(rows, problems, views) if self.folds > 1 else batch.left_out_scores(rows.withColumn("fold", F.lit(0)), [batch.Problem(0.0, 0, 0, weights=problems[0].weights)], views)
        platt = batch.Problem(0.0)
        margins = batch.written(seen.select(F.array("score").alias("x"), F.col("label").cast("double").alias("y"), F.lit(-1).alias("fold")))
        batch.solve(margins, [platt], [batch.View(np.zeros(1), np.ones(1))], [max(1, margins.count())])
        a, b = (1.0, 0.0) if platt.weights is None else platt.weights
        return MarginClassifierModel(kernel, problems[0].weights, float(a), float(b), self.features)


def fit_margin_classifier(train: DataFrame, n_features: int, **settings) -> MarginClassifierModel:
    """E8 in one call: :class:`MarginClassifier` with these settings, fitted on ``train``."""
    return MarginClassifier(n_features, **settings).fit(train)
