"""Model-based and permutation importances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.learn.evaluate import scored
from riskframe.operators.sampling import permute_columns
from riskframe.session import cut_lineage


def feature_importance(spark: SparkSession, stage, names: Sequence[str]) -> DataFrame:
    """Tree importances, or |coefficient| for linear models."""
    if hasattr(stage, "featureImportances"):
        vals = stage.featureImportances.toArray()
    else:
        vals = abs(stage.coefficients.toArray())
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, vals)], "feature string, importance double")


def coefficients(spark: SparkSession, stage, names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, stage.coefficients.toArray())],
                                 "feature string, coefficient double")


def compare_coefficients(spark: SparkSession, models: dict, names: Sequence[str], n: int = 15) -> DataFrame:
    """The n largest |coefficient| per fitted model (no refit), signed."""
    from riskframe.operators.ranking import top_features
    out = None
    for label, stage in models.items():
        top = top_features(coefficients(spark, stage, names), n, "coefficient", "feature", absolute=True)
        top = top.withColumn("model", F.lit(label))
        out = top if out is None else out.unionByName(top)
    return out


def permutation_importance(model, df: DataFrame, columns: Sequence[str], key: str, label: str = "label",
                           repeats: int = 10, seed: int = 42) -> DataFrame:
    """Mean accuracy drop when one raw input column is shuffled (D9),
    per raw column (named correctly, unlike encoded-name indexing). Each repeat
    orders the rows once for all columns, and all repeats of a column are scored in one pass over a union tagged by repeat."""
    spark = df.sparkSession
    base = scored(model.transform(df), label).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    rows = []
    # every repeat's shuffled columns beside the rows, written once and read by each column
    shuffled = cut_lineage(permute_columns(df, columns, key, [seed + r for r in range(repeats)]))
    for c in columns:
        parts = shuffled.withColumn(c, F.col(f"_rf_p_{c}")).drop(*[f"_rf_p_{x}" for x in columns])
        pred = model.transform(parts)
        acc = (pred.groupBy("_rf_rep")
               .agg(F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("acc")))
        st = acc.agg(F.avg("acc").alias("m"), F.stddev_pop("acc").alias("s")).first()
        rows.append((c, float(base - st["m"]), float(st["s"] or 0.0)))
    return spark.createDataFrame(rows, "feature string, importance_mean double, importance_std double")
