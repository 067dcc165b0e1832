"""Principal components on spark.ml.

Spark's ``PCA`` does not center, so a ``StandardScaler(withMean, withStd=False)``
over the whole assembled vector comes first. The covariance (Gramian) is a
distributed tree aggregate; only the d x d decomposition runs on the driver,
which suits up to a few thousand features. One full fit serves every k: a
projection to k components slices the full one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def pca_fit(df: DataFrame, features: str, n_features: int, out: str = "pcs") -> PipelineModel:
    """Centered full decomposition (k = number of features)."""
    return Pipeline(stages=[
        StandardScaler(inputCol=features, outputCol="_centered", withMean=True, withStd=False),
        PCA(k=n_features, inputCol="_centered", outputCol=out),
    ]).fit(df)


def pca_project(model: PipelineModel, df: DataFrame, k: int, out: str = "pca_features",
                full: str = "pcs") -> DataFrame:
    """Project (centered) and keep the first k components."""
    p = model.transform(df)
    return p.withColumn(out, array_to_vector(F.slice(vector_to_array(F.col(full)), 1, k))).drop("_centered", full)


def scree(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Ratio and cumulative ratio per component (W1 over at most d rows)."""
    from riskframe.operators.ranking import cumulative_share
    ev = model.stages[-1].explainedVariance.toArray().tolist()
    df = spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(ev)], "component int, ratio double")
    return cumulative_share(df, "component", "ratio")


def loadings(spark: SparkSession, model: PipelineModel, names: Sequence[str]) -> DataFrame:
    """Feature x component table; each component's sign is fixed so its
    largest-magnitude entry is positive."""
    pc = model.stages[-1].pc.toArray()
    rows = []
    for j in range(pc.shape[1]):
        col = pc[:, j]
        sign = 1.0 if col[abs(col).argmax()] >= 0 else -1.0
        rows += [(names[i], j, float(sign * col[i])) for i in range(pc.shape[0])]
    return spark.createDataFrame(rows, "feature string, component int, loading double")


def compare_pca(estimators: dict, train: DataFrame, test: DataFrame, model: PipelineModel, k: int,
                features: str = "features", label: str = "label") -> list[dict]:
    """Accuracy and AUC with and without the k-component projection."""
    from riskframe.learn.evaluate import evaluate_model
    tr_p = pca_project(model, train, k, "pca_features")
    te_p = pca_project(model, test, k, "pca_features")
    rows = []
    for name, make in estimators.items():
        _, a = evaluate_model(name, make(features), train, test, label)
        _, b = evaluate_model(name, make("pca_features"), tr_p, te_p, label)
        rows.append({"model": name, "accuracy_no_pca": a["accuracy"], "accuracy_pca": b["accuracy"],
                     "accuracy_diff": b["accuracy"] - a["accuracy"], "roc_auc_no_pca": a["roc_auc"],
                     "roc_auc_pca": b["roc_auc"], "roc_auc_diff": b["roc_auc"] - a["roc_auc"], "components": k})
    return rows
