"""Preprocessing as spark.ml stages.

Numeric columns are assembled and standard-scaled; categorical columns are
indexed alphabetically and one-hot encoded with every known level kept and
unknown levels encoded as all zeros (indexer ``keep`` adds one last index
for unknowns; the encoder's dropLast removes exactly that slot)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler


def scaler(input_col: str, output_col: str, with_mean: bool = True, with_std: bool = True) -> StandardScaler:
    """Standard scaling. Spark divides by the sample std."""
    return StandardScaler(inputCol=input_col, outputCol=output_col, withMean=with_mean, withStd=with_std)


def encoder_stages(cat_cols: Sequence[str]) -> list:
    """Alphabetical index + one-hot per categorical column."""
    if not cat_cols:
        return []
    idx = [f"{c}__idx" for c in cat_cols]
    return [
        StringIndexer(inputCols=list(cat_cols), outputCols=idx, stringOrderType="alphabetAsc", handleInvalid="keep"),
        # the indexer's extra "unknown" index is the last category; dropLast
        # removes exactly that slot, so unknown levels encode as all zeros
        OneHotEncoder(inputCols=idx, outputCols=[f"{c}__oh" for c in cat_cols], dropLast=True),
    ]


def preprocessor_stages(num_cols: Sequence[str], cat_cols: Sequence[str], out: str = "features",
                        scale: bool = True) -> list:
    """Numeric branch (assemble + scale) and categorical branch joined in
    one vector: numeric features first, then the one-hot blocks."""
    stages = encoder_stages(cat_cols)
    parts = []
    if num_cols:
        stages.append(VectorAssembler(inputCols=list(num_cols), outputCol="_num_raw", handleInvalid="keep"))
        if scale:
            stages.append(scaler("_num_raw", "_num_scaled"))
            parts.append("_num_scaled")
        else:
            parts.append("_num_raw")
    parts += [f"{c}__oh" for c in cat_cols]
    stages.append(VectorAssembler(inputCols=parts, outputCol=out))
    return stages


def pipeline(num_cols, cat_cols, estimator=None, out: str = "features", scale: bool = True) -> Pipeline:
    stages = preprocessor_stages(num_cols, cat_cols, out, scale)
    if estimator is not None:
        stages.append(estimator)
    return Pipeline(stages=stages)


def feature_names(model: PipelineModel, num_cols: Sequence[str], cat_cols: Sequence[str]) -> list[str]:
    """Numeric names, then ``col_level`` per kept level in index order."""
    names = list(num_cols)
    for st in model.stages:
        if hasattr(st, "labelsArray") and cat_cols:
            for c, labels in zip(cat_cols, st.labelsArray):
                names += [f"{c}_{lab}" for lab in labels]
            break
    return names
