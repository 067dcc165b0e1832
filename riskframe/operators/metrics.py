"""Exact classifier-evaluation aggregates.

Everything is a DataFrame aggregate. The curves are built from the table of
distinct scores (one row per score, however many rows share it), whose
cumulative counts come from :func:`riskframe.operators.prefix.running_sum`,
so no step gathers the data into one task. ROC AUC is summed in integers
(``decimal(38,0)``), so it is exact and independent of summation order.

Column conventions: ``label`` is 0/1, ``score`` a double (higher means more
positive), ``prediction`` 0/1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.prefix import next_values, running_sum
from riskframe.session import cut_lineage

_DEC = "decimal(38,0)"


def _sdiv(a: Column, b: Column) -> Column:
    """a / b with 0 when the denominator is 0 (the library's zero_division=0)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


# ---------------------------------------------------------------- A10-A13
def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """One row: tn, fp, fn, tp (A10)."""
    y, p = F.col(label), F.col(pred)
    return df.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def confusion_normalized(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Each cell over its true-class total (A11); empty class gives null."""
    cm = confusion_matrix(df, label, pred)
    neg, pos = F.col("tn") + F.col("fp"), F.col("fn") + F.col("tp")
    return cm.select(
        F.try_divide(F.col("tn").cast("double"), neg).alias("tn_rate"),
        F.try_divide(F.col("fp").cast("double"), neg).alias("fp_rate"),
        F.try_divide(F.col("fn").cast("double"), pos).alias("fn_rate"),
        F.try_divide(F.col("tp").cast("double"), pos).alias("tp_rate"),
    )


def metrics_from_counts(cm: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, specificity, F1, FPR over a tn/fp/fn/tp row."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    prec = _sdiv(tp, tp + fp)
    rec = _sdiv(tp, tp + fn)
    return cm.select(
        "*",
        _sdiv(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        prec.alias("precision"),
        rec.alias("recall"),
        _sdiv(tn, tn + fp).alias("specificity"),
        _sdiv(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _sdiv(fp, fp + tn).alias("fpr"),
    )


def classification_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """A12 + A13 in one pass."""
    return metrics_from_counts(confusion_matrix(df, label, pred))


# ---------------------------------------------------------------- curves
def curve_points(df: DataFrame, label: str = "label", score: str = "score",
                 buckets: int | None = None) -> DataFrame:
    """One row per distinct score: ``score, pos, neg, tp, fp`` where tp/fp
    count rows with score >= this score. Null scores are dropped. The table is
    written to the checkpoint folder, as every measure of a curve reads it."""
    pts = (df.where(F.col(score).isNotNull())
           .groupBy(F.col(score).cast("double").alias("score"))
           .agg(F.sum(F.col(label).cast("long")).alias("pos"),
                F.sum((1 - F.col(label)).cast("long")).alias("neg"))
           .withColumn("_rf_desc", -F.col("score")))
    # the prefix sum reads its input several times (count, boundaries,
    # bucket totals, window): write the distinct-score table once
    pts = cut_lineage(pts)
    cum = running_sum(pts, ["_rf_desc"], {"tp": "pos", "fp": "neg"}, buckets=buckets)
    return cut_lineage(cum.drop("_rf_desc"))


def class_totals(points: DataFrame) -> tuple[int, int]:
    """(P, N) from a curve-point table: a one-row aggregate brought to the driver."""
    row = points.agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("p"),
                     F.coalesce(F.sum("neg"), F.lit(0)).alias("n")).first()
    return int(row["p"]), int(row["n"])


def roc_curve(df: DataFrame | None, label: str = "label", score: str = "score",
              points: DataFrame | None = None, totals: tuple[int, int] | None = None) -> DataFrame:
    """Threshold, fpr, tpr, tp, fp per distinct score, after the start point
    (0, 0) at threshold infinity. ``totals`` are the classes' sizes, where ``points``
    are only the corners of a curve."""
    pts = points if points is not None else curve_points(df, label, score)
    p, n = totals or class_totals(pts)
    start = pts.sparkSession.range(1).select(
        F.lit(float("inf")).alias("score"), *[F.lit(0).cast("long").alias(c) for c in ("tp", "fp")])
    pts = pts.select("score", "tp", "fp").unionByName(start)
    return pts.select(
        F.col("score").alias("threshold"),
        (F.col("fp") / F.lit(float(n)) if n else F.lit(None).cast("double")).alias("fpr"),
        (F.col("tp") / F.lit(float(p)) if p else F.lit(None).cast("double")).alias("tpr"),
        "tp", "fp")


def corner_points(points: DataFrame, buckets: int | None = None) -> DataFrame:
    """The curve points without those that continue the step before them: a point between
    two others goes where the step from it adds as many positives and negatives as the step to
    it. First and last points stay, so the curve, its area and its best Youden threshold do too.
    Each point needs only the next one, taken across the edges of the buckets."""
    pts = points.withColumn("_rf_desc", -F.col("score"))
    x = next_values(pts, ["_rf_desc"], {"_rf_pos": "pos", "_rf_neg": "neg"}, buckets=buckets)
    first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    same = (F.col("_rf_pos") == F.col("pos")) & (F.col("_rf_neg") == F.col("neg"))
    return x.where(first | F.col("_rf_pos").isNull() | ~same).drop("_rf_desc", "_rf_pos", "_rf_neg")


def pr_curve(df: DataFrame, label: str = "label", score: str = "score",
             points: DataFrame | None = None) -> DataFrame:
    """Threshold, precision, recall per distinct score, and the end point
    (precision 1, recall 0), which has no threshold."""
    pts = points if points is not None else curve_points(df, label, score)
    p, _ = class_totals(pts)
    curve = pts.select(
        F.col("score").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        (F.col("tp") / F.lit(float(p)) if p else F.lit(None).cast("double")).alias("recall"),
        "tp", "fp")
    end = pts.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
        *[F.lit(0).cast("long").alias(c) for c in ("tp", "fp")])
    return curve.unionByName(end)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score",
            points: DataFrame | None = None) -> DataFrame:
    """Exact trapezoid area with ties: 2*AUC*P*N = sum neg_s*(2*tp_s - pos_s)."""
    pts = points if points is not None else curve_points(df, label, score)
    agg = pts.agg(
        F.sum(F.col("neg").cast(_DEC) * (2 * F.col("tp") - F.col("pos")).cast(_DEC)).alias("num"),
        F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    den = F.lit(2.0) * F.col("p").cast("double") * F.col("n").cast("double")
    return agg.select(F.try_divide(F.col("num").cast("double"), den).alias("roc_auc"))


def roc_auc_by(df: DataFrame, group: str, label: str = "label", score: str = "score",
               buckets: int | None = None) -> DataFrame:
    """A15 per group of a stacked (group, label, score) table: every group's curve from one
    scan and one pass of running sums."""
    pts = cut_lineage(df.where(F.col(score).isNotNull()).groupBy(group, (-F.col(score).cast("double")).alias("_rf_desc")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum((1 - F.col(label)).cast("long")).alias("neg")))
    cum = running_sum(pts, ["_rf_desc"], {"tp": "pos"}, partition_cols=[group], buckets=buckets)
    agg = cum.groupBy(group).agg(
        F.sum(F.col("neg").cast(_DEC) * (2 * F.col("tp") - F.col("pos")).cast(_DEC)).alias("num"),
        F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    den = F.lit(2.0) * F.col("p").cast("double") * F.col("n").cast("double")
    return agg.select(group, F.try_divide(F.col("num").cast("double"), den).alias("roc_auc"))


def average_precision(df: DataFrame, label: str = "label", score: str = "score",
                      points: DataFrame | None = None) -> DataFrame:
    """Sum over thresholds of (R_n - R_{n-1}) * P_n."""
    pts = points if points is not None else curve_points(df, label, score)
    agg = pts.agg(
        F.sum(F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))).alias("s"),
        F.sum("pos").alias("p"))
    return agg.select(F.try_divide(F.col("s"), F.col("p").cast("double")).alias("average_precision"))


def youden(curve: DataFrame) -> DataFrame:
    """J = TPR - FPR per curve point."""
    return curve.withColumn("j", F.col("tpr") - F.col("fpr"))


def best_youden(df: DataFrame, label: str = "label", score: str = "score",
                points: DataFrame | None = None) -> DataFrame:
    """First maximum of J (highest threshold among ties). J is compared as
    the integer tp*N - fp*P so true ties stay ties."""
    pts = points if points is not None else curve_points(df, label, score)
    p, n = class_totals(pts)
    jint = (F.col("tp").cast(_DEC) * F.lit(n).cast(_DEC) - F.col("fp").cast(_DEC) * F.lit(p).cast(_DEC))
    best = pts.agg(F.max(F.struct(jint.alias("jint"), F.col("score"), F.col("tp"), F.col("fp"))).alias("b"))
    return best.select(
        F.col("b.score").alias("threshold"),
        (F.col("b.tp") / F.lit(float(p))).alias("tpr") if p else F.lit(None).cast("double").alias("tpr"),
        (F.col("b.fp") / F.lit(float(n))).alias("fpr") if n else F.lit(None).cast("double").alias("fpr"),
        (F.col("b.jint").cast("double") / F.lit(float(p) * float(n))).alias("j") if p and n
        else F.lit(None).cast("double").alias("j"))


def best_f1(df: DataFrame, label: str = "label", score: str = "score",
            points: DataFrame | None = None) -> DataFrame:
    """First maximum of 2PR/(P+R+1e-10) in ascending threshold order, so
    the lowest threshold wins ties."""
    pts = points if points is not None else curve_points(df, label, score)
    p, _ = class_totals(pts)
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    rec = F.col("tp") / F.lit(float(p)) if p else F.lit(0.0)
    f1 = 2 * prec * rec / (prec + rec + F.lit(1e-10))
    best = pts.select(f1.alias("f1"), (-F.col("score")).alias("neg_t"), prec.alias("precision"),
                      rec.alias("recall")).agg(F.max(F.struct("f1", "neg_t", "precision", "recall")).alias("b"))
    return best.select((-F.col("b.neg_t")).alias("threshold"), F.col("b.precision").alias("precision"),
                       F.col("b.recall").alias("recall"), F.col("b.f1").alias("f1"))


# ---------------------------------------------------------------- thresholds
def apply_threshold(score: Column | str, t: float) -> Column:
    """``score >= t`` as 0/1."""
    s = F.col(score) if isinstance(score, str) else score
    return (s >= F.lit(float(t))).cast("int")


def threshold_sweep(df: DataFrame, thresholds: list[float], label: str = "label",
                    score: str = "score") -> DataFrame:
    """Metrics at each threshold in one scan (N conditional counts, the
    threshold list is small and fixed); unpivoted to one row per threshold."""
    ts = sorted(set(float(t) for t in thresholds))
    y, s = F.col(label), F.col(score)
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(y == 1).alias("p")]
    for i, t in enumerate(ts):
        aggs += [F.count_if((s >= t) & (y == 1)).alias(f"tp{i}"),
                 F.count_if((s >= t) & (y == 0)).alias(f"fp{i}")]
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(t).alias("threshold"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"))
        for i, t in enumerate(ts)])).alias("r")
    long = wide.select("n", "p", rows).select("n", "p", "r.*")
    tp, fp, n, p = F.col("tp"), F.col("fp"), F.col("n"), F.col("p")
    fn, tn = p - tp, n - p - fp
    prec, rec = _sdiv(tp, tp + fp), _sdiv(tp, tp + fn)
    return long.select(
        "threshold",
        _sdiv(tp + tn, n).alias("accuracy"),
        prec.alias("precision"), rec.alias("recall"),
        _sdiv(2 * tp, 2 * tp + fp + fn).alias("f1"),
        (tp + fp).alias("positives"),
        _sdiv(tp + fp, n).alias("positive_share"))


# ---------------------------------------------------------------- class stats
def label_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """positive/negative counts and percentages."""
    return df.agg(F.count_if(F.col(label) == 1).alias("positives"),
                  F.count_if(F.col(label) == 0).alias("negatives"),
                  F.count(F.lit(1)).alias("total")).select(
        "positives", "negatives", "total",
        (100 * _sdiv(F.col("positives"), F.col("total"))).alias("positive_pct"),
        (100 * _sdiv(F.col("negatives"), F.col("total"))).alias("negative_pct"))


def score_stats_by_class(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Count, mean, population std, min, max of the score per class."""
    s = F.col(score)
    return df.groupBy(F.col(label).alias("label")).agg(
        F.count(s).alias("count"), F.avg(s).alias("mean"), F.stddev_pop(s).alias("std"),
        F.min(s).alias("min"), F.max(s).alias("max"))


def score_histogram(df: DataFrame, bins: int = 20, label: str = "label", score: str = "score") -> DataFrame:
    """Counts per (bin, class) over equal-width bins spanning both classes;
    the last bin is closed. Range comes from a one-row aggregate."""
    rng = df.agg(F.min(score).alias("lo"), F.max(score).alias("hi")).first()
    lo, hi = rng["lo"], rng["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, label int, count long")
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.lit(bins), F.floor((F.col(score) - F.lit(lo)) / F.lit(width)).cast("int") + 1)
    return (df.where(F.col(score).isNotNull())
            .groupBy(b.alias("bin"), F.col(label).cast("int").alias("label"))
            .agg(F.count(F.lit(1)).alias("count")))


def batch_summary(df: DataFrame, pred: str = "prediction") -> DataFrame:
    """Total, positives, positive percentage (2 decimals, 0 when empty)."""
    agg = df.agg(F.count(F.lit(1)).alias("total_patients"),
                 F.count_if(F.col(pred) == 1).alias("positive_cases"))
    return agg.select("total_patients", "positive_cases",
                      F.bround(100 * _sdiv(F.col("positive_cases"), F.col("total_patients")), 2)
                      .alias("positive_percentage"))


def report_summary(df: DataFrame, actual: str = "Actual", predicted: str = "Predicted",
                   correct: str = "Correct") -> DataFrame:
    """Totals and percentages of actual, predicted, correct, plus the matrix."""
    a, p = F.col(actual), F.col(predicted)
    agg = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(a).alias("actual_pos"), F.sum(p).alias("predicted_pos"), F.sum(correct).alias("correct"),
        F.count_if((a == 0) & (p == 0)).alias("tn"), F.count_if((a == 0) & (p == 1)).alias("fp"),
        F.count_if((a == 1) & (p == 0)).alias("fn"), F.count_if((a == 1) & (p == 1)).alias("tp"))
    t = F.col("total")
    return agg.select("*",
                      (100 * _sdiv(F.col("actual_pos"), t)).alias("actual_pct"),
                      (100 * _sdiv(F.col("predicted_pos"), t)).alias("predicted_pct"),
                      (100 * _sdiv(F.col("correct"), t)).alias("correct_pct"))


def cv_summary(folds: DataFrame, group: str = "model", metrics: list[str] | None = None) -> DataFrame:
    """Mean and population std of each fold metric per model."""
    metrics = metrics or [c for c in folds.columns if c not in (group, "fold")]
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    return folds.groupBy(group).agg(*aggs)


def best_by(df: DataFrame, metric: str, order_col: str) -> DataFrame:
    """The row with the highest ``metric``; first by ``order_col`` on ties."""
    cols = [c for c in df.columns]
    packed = F.struct(F.col(metric).alias("_m"), (-F.col(order_col)).alias("_o"),
                      *[F.col(c) for c in cols])
    return df.agg(F.max(packed).alias("b")).select(*[F.col(f"b.{c}").alias(c) for c in cols])


def coefficient_sparsity(coefs: DataFrame, col: str = "coefficient", eps: float = 1e-5) -> DataFrame:
    """Count of |coef| > eps and percent (near) zero."""
    return coefs.agg(F.count_if(F.abs(F.col(col)) > eps).alias("non_zero"),
                     F.count(F.lit(1)).alias("total")).select(
        "non_zero", "total", (100 * _sdiv(F.col("total") - F.col("non_zero"), F.col("total"))).alias("zero_pct"))


def rank_models(results: DataFrame, metric: str = "roc_auc", name: str = "model") -> DataFrame:
    """T5: models by metric descending with a rank (ties by name). The result
    table has one row per model, so the global window is bounded."""
    w = Window.orderBy(F.col(metric).desc(), F.col(name))
    return results.withColumn("rank", F.row_number().over(w))
