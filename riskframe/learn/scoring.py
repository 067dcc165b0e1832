"""Batch scoring: check records, build features, transform once, tier, summarise."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import split_valid
from riskframe.functions.features import risk_tier
from riskframe.functions.records import check_records
from riskframe.operators.metrics import batch_summary
from riskframe.operators.quality import engineer_features
from riskframe.session import cut_lineage


def score_batch(df: DataFrame, model, id_col: str = "record_no") -> DataFrame:
    """Per record: id, prediction, probability and risk tier. Records get the
    scoring-time features (open-ended age bins); one ``transform`` yields
    both the class and the probability."""
    x = engineer_features(df, scoring=True)
    p = model.transform(x)
    prob = vector_to_array("probability")[1]
    return p.select(F.col(id_col).alias("patient_id"), F.col("prediction").cast("int").alias("prediction"),
                    prob.alias("probability"), risk_tier(prob).alias("cancer_risk"))


def score_records(df: DataFrame, model, model_name: str, id_col: str = "record_no") -> dict[str, DataFrame]:
    """The whole batch result: ``scored`` rows of the records that satisfy the record
    rules, ``rejected`` records with their reasons, and the ``summary`` of the scored."""
    checked = cut_lineage(check_records(df))
    ok, rejected = split_valid(checked)
    rows = cut_lineage(score_batch(ok, model, id_col))
    return {"scored": rows, "rejected": rejected, "summary": score_summary(rows, model_name)}


def score_summary(scored: DataFrame, model_name: str) -> DataFrame:
    """Batch summary (A18) with the model name and a timestamp."""
    from riskframe.functions.features import stamp
    return batch_summary(scored).select(F.lit(model_name).alias("model_used"), stamp().alias("timestamp"), "*")
