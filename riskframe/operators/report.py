"""Model analysis and reports over one scored frame.

A scored frame has ``label``, ``prediction`` and ``score`` (positive-class
probability). Everything below is a handful of aggregates over it; the
distinct-score curve table is built once and shared."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.features import format_metric
from riskframe.functions.columns import report_projection, resolve_id_column
from riskframe.operators import metrics as M
from riskframe.operators.ranking import sort_report
from riskframe.operators.relational import threshold_set
from riskframe.session import cut_lineage

# The metric names and formula texts of the summary table.
METRIC_ROWS = (
    ("Accuracy", "accuracy", "(TP+TN)/(TP+TN+FP+FN)"),
    ("Precision", "precision", "TP/(TP+FP)"),
    ("Recall (Sensitivity)", "recall", "TP/(TP+FN)"),
    ("Specificity", "specificity", "TN/(TN+FP)"),
    ("F1-Score", "f1", "2*(P*R)/(P+R)"),
    ("ROC-AUC", "roc_auc", "Area under ROC curve"),
    ("Avg Precision", "average_precision", "Area under PR curve"),
)
FIXED_THRESHOLDS = (0.3, 0.4, 0.5, 0.6, 0.7)


def metrics_report(scored: DataFrame, points: DataFrame | None = None, decimals: int = 4) -> DataFrame:
    """Seven named metrics with value (number and text) and formula."""
    pts = points if points is not None else M.curve_points(scored)
    cm = M.classification_metrics(scored)
    auc = M.roc_auc(scored, points=pts)
    ap = M.average_precision(scored, points=pts)
    wide = cm.select("accuracy", "precision", "recall", "specificity", "f1")
    # three one-row aggregates; combine through a union and max (no join)
    nulls = {c: F.lit(None).cast("double") for c in ("accuracy", "precision", "recall", "specificity", "f1",
                                                     "roc_auc", "average_precision")}
    a = wide.select(*[F.col(c) if c in wide.columns else v.alias(c) for c, v in nulls.items()])
    b = auc.select(*[F.col(c) if c == "roc_auc" else v.alias(c) for c, v in nulls.items()])
    c_ = ap.select(*[F.col(c) if c == "average_precision" else v.alias(c) for c, v in nulls.items()])
    one = a.unionByName(b).unionByName(c_).agg(*[F.max(c).alias(c) for c in nulls])
    rows = F.explode(F.array(*[F.struct(F.lit(i).alias("position"), F.lit(n).alias("Metric"),
                                        F.col(k).alias("metric_value"), F.lit(f).alias("Formula"))
                               for i, (n, k, f) in enumerate(METRIC_ROWS)])).alias("r")
    return one.select(rows).select("r.*").withColumn("Value", format_metric("metric_value", decimals))


def threshold_table(scored: DataFrame, points: DataFrame | None = None,
                    fixed: Sequence[float] = FIXED_THRESHOLDS) -> DataFrame:
    """Metrics at the fixed thresholds plus the best-Youden and best-F1
    thresholds (sorted, distinct: U3), formatted as text."""
    pts = points if points is not None else M.curve_points(scored)
    yj = M.best_youden(scored, points=pts).first()["threshold"]
    bf = M.best_f1(scored, points=pts).first()["threshold"]
    found = [F.lit(t) for t in (yj, bf) if t is not None]
    ts = scored.sparkSession.range(1).select(threshold_set(fixed, *found)).first()[0]
    sw = M.threshold_sweep(scored, ts)
    return sw.select(
        format_metric("threshold", 3).alias("Threshold"),
        format_metric("accuracy", 4).alias("Accuracy"), format_metric("precision", 4).alias("Precision"),
        format_metric("recall", 4).alias("Recall"), format_metric("f1", 4).alias("F1_Score"),
        F.col("positives").alias("Pos_Predictions"),
        format_metric("positive_share", 1, pct=True).alias("Pct_Pos_Pred"))


def analyze_model(scored: DataFrame, bins: int = 20) -> dict:
    """Every analysis table over one scored frame, written once."""
    sc = cut_lineage(scored)
    pts = M.curve_points(sc)
    return {
        "confusion": M.confusion_matrix(sc),
        "confusion_normalized": M.confusion_normalized(sc),
        "metrics": metrics_report(sc, pts),
        "roc_curve": M.youden(M.roc_curve(sc, points=pts)),
        "pr_curve": M.pr_curve(sc, points=pts),
        "best_youden": M.best_youden(sc, points=pts),
        "best_f1": M.best_f1(sc, points=pts),
        "class_stats": M.score_stats_by_class(sc),
        "histogram": M.score_histogram(sc, bins),
        "thresholds": threshold_table(sc, pts),
        "balance": M.label_balance(sc),
    }


def prediction_report(df: DataFrame, model, label: str, id_column: str = "patient_id",
                      candidates: Sequence[str] = ("patient_id", "Patient_ID", "id", "ID", "patientid"),
                      order_cols: Sequence[str] | None = None, start: int = 1000) -> DataFrame:
    """Sorted per-row report (Patient_No, Actual, Predicted, Probability,
    Correct). The id column is the requested one, else the first candidate
    present, else sequential ids. The model reads the columns it was fitted on, so a
    key is an input only if it was one then."""
    from pyspark.ml.functions import vector_to_array
    base, id_col = resolve_id_column(df, id_column, candidates, order_cols or df.columns, start)
    pred = model.transform(base).withColumn("_rf_p", vector_to_array("probability")[1])
    rep = report_projection(pred, id_col, label, "prediction", "_rf_p")
    return sort_report(rep)
