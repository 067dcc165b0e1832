"""Model and feature listings from run metadata frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def model_catalog(meta: DataFrame, params: DataFrame | None = None) -> DataFrame:
    """One row per model in ``performance``; absent metrics give 0.0.
    ``params`` (name, parameters map) is left-joined when given."""
    rows = meta.select(F.explode("performance").alias("name", "m"))
    out = rows.select(
        "name", F.col("name").alias("type"),
        F.coalesce(F.col("m.accuracy"), F.lit(0.0)).alias("accuracy"),
        F.coalesce(F.col("m.roc_auc"), F.lit(0.0)).alias("roc_auc"),
        F.coalesce(F.col("m.f1_score"), F.lit(0.0)).alias("f1_score"))
    if params is not None:
        out = out.join(params, "name", "left")
    else:
        out = out.withColumn("parameters", F.create_map().cast("map<string,string>"))
    return out


def feature_catalog(meta: DataFrame) -> DataFrame:
    """One row per feature name with its position, the total count and
    whether its source column is categorical."""
    x = meta.select("feature_names", "categorical_columns",
                    F.posexplode("feature_names").alias("position", "feature"))
    return x.select(
        "position", "feature", F.size("feature_names").alias("total_features"),
        F.exists("categorical_columns", lambda c: F.startswith(F.col("feature"), F.concat(c, F.lit("_"))))
        .alias("from_categorical"))
