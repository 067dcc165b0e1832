"""Composite stages: deliberate damage, repair, feature building, split.

``inject_anomalies`` = exact hash samples (D1) + set_where (P6), duplicate
rows (D5), outliers (P6 x2), deletions (J2-style filter).
``clean_table`` = median/mode impute (A2, A3, J4), dedup (U2), range filter
(P4), optional resize (D4), renumbering (W5), casts (P5).
``engineer_features`` = F1, F3/F4, F2, F6, F7.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions import features as FX
from riskframe.functions.columns import cast_columns, columns_by_type, filter_ranges, set_where
from riskframe.functions.scorecard import CLINICAL_RULES, scorecard
from riskframe.operators.prefix import sequential_id
from riskframe.operators.profile import column_medians, column_modes
from riskframe.operators.relational import with_constants
from riskframe.operators.sampling import duplicate_rows, mark_smallest, resize_to, stratified_split
from riskframe.session import cut_lineage

# Damage plan (fractions and seeds), repair ranges and casts.
NULL_COLUMNS = ("wbc_count", "hemoglobin_level", "platelet_count")
NULL_FRACTION, NULL_SEED = 0.03, 42
DUP_FRACTION, DUP_SEED = 0.01, 1
AGE_OUTLIER_FRACTION, AGE_OUTLIER_SEED, AGE_OUTLIER_VALUE = 0.005, 3, 150
SIZE_OUTLIER_FRACTION, SIZE_OUTLIER_SEED, SIZE_OUTLIER_VALUE = 0.005, 4, 40.0
DELETE_FRACTION, DELETE_SEED = 0.005, 10
CLEAN_RANGES = {"age": (18, 90), "tumor_size_cm": (0.5, 10)}
INT_COLUMNS = ("age", "family_history_cancer", "wbc_count", "platelet_count",
               "unexplained_weight_loss", "persistent_fatigue", "chronic_pain",
               "abnormal_bleeding", "persistent_cough", "lump_presence",
               "imaging_abnormality", "diabetes", "hypertension", "asthma",
               "cardiac_disease", "prior_radiation_exposure")
FLOAT_COLUMNS = ("hemoglobin_level", "tumor_marker_level", "tumor_size_cm")


def _mark(df, keys, seed, fraction, out, counted):
    return mark_smallest(df, keys, seed, fraction=fraction, out=out, counted=counted)


def inject_anomalies(df: DataFrame, key: str = "patient_id", copy_col: str = "copy_no") -> DataFrame:
    """Damage a clean table: 3% nulls in three columns, 1% copies appended,
    0.5% age=150, 0.5% tumor size=40, 0.5% rows deleted. After the copy step
    rows are keyed by (key, copy_no)."""
    # each exact sample reads its input twice (threshold, then predicate):
    # the input and the grown table are written rather than made again, and
    # their keys apart, so that looking for a threshold reads no other column
    df = cut_lineage(df)
    rows = cut_lineage(df.select(key))
    x = _mark(df, [key], NULL_SEED, NULL_FRACTION, "_rf_m", rows)
    x = set_where(x, F.col("_rf_m"), {c: None for c in NULL_COLUMNS if c in df.columns}).drop("_rf_m")
    x = cut_lineage(duplicate_rows(x, DUP_FRACTION, key, DUP_SEED, copy_col=copy_col, counted=rows))
    keys = [key, copy_col]
    rows = cut_lineage(x.select(*keys))
    x = _mark(x, keys, AGE_OUTLIER_SEED, AGE_OUTLIER_FRACTION, "_rf_m", rows)
    x = set_where(x, F.col("_rf_m"), {"age": AGE_OUTLIER_VALUE}).drop("_rf_m")
    x = _mark(x, keys, SIZE_OUTLIER_SEED, SIZE_OUTLIER_FRACTION, "_rf_m", rows)
    x = set_where(x, F.col("_rf_m"), {"tumor_size_cm": SIZE_OUTLIER_VALUE}).drop("_rf_m")
    x = _mark(x, keys, DELETE_SEED, DELETE_FRACTION, "_rf_m", rows)
    return x.where(~F.col("_rf_m")).drop("_rf_m")


def impute(df: DataFrame, exclude: Sequence[str] = (), exact_median: bool = True) -> DataFrame:
    """Fill numeric nulls with column medians, then the rest with column modes
    (smallest on ties). Only columns that have nulls are looked at; both fills are
    one-row aggregates applied as literals."""
    all_num = columns_by_type(df, "numeric")
    cols = [c for c in df.columns if c not in exclude]
    if not cols:
        return df
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    num = [c for c in cols if c in all_num and nulls[c]]
    other = [c for c in cols if c not in all_num and nulls[c]]
    out = with_constants(df, column_medians(df, num, exact=exact_median)) if num else df
    if other:
        out = with_constants(out, column_modes(df, other))
    return out


def clean_table(df: DataFrame, key: str = "patient_id", copy_col: str = "copy_no",
                target_rows: int | None = None, seed: int = 42, id_start: int = 1000,
                exact_median: bool = True) -> DataFrame:
    """Repair a damaged table: impute, drop full-row copies, keep rows inside
    the fixed ranges, optionally resize to ``target_rows`` (keeping
    ``source_key``), renumber ``key`` from ``id_start``, cast."""
    helpers = [c for c in (copy_col,) if c in df.columns]
    x = impute(df, exclude=[key, *helpers], exact_median=exact_median)
    data_cols = [c for c in x.columns if c not in helpers]
    x = x.dropDuplicates(data_cols).select(*data_cols)
    x = cut_lineage(filter_ranges(x, CLEAN_RANGES))  # read by several passes below
    x = x.withColumn("source_key", F.col(key))
    if target_rows is not None:
        x = resize_to(x.drop("source_key"), target_rows, key, seed)
    else:
        x = x.withColumn("copy_no", F.lit(0).cast("bigint"))
    x = sequential_id(x.drop(key), ["source_key", "copy_no"], out=key, start=id_start)
    x = cast_columns(x, INT_COLUMNS, FLOAT_COLUMNS)
    return x


def engineer_features(df: DataFrame, scoring: bool = False) -> DataFrame:
    """Add bmi, age_category, platelet_lymphocyte_ratio, lifestyle_risk_score,
    clinical_risk_score. ``scoring`` uses the open-ended age bins."""
    age_cat = (FX.cut_open("age", FX.AGE_UPPERS, FX.AGE_LABELS) if scoring
               else FX.cut("age", FX.AGE_BOUNDS, FX.AGE_LABELS))
    x = df.withColumns({
        "bmi": FX.bmi("weight_kg", "height_cm"),
        "age_category": age_cat,
        "platelet_lymphocyte_ratio": FX.safe_ratio("platelet_count", "wbc_count", 0.3, 1e-10),
        "lifestyle_risk_score": FX.lifestyle_score(),
    })
    return x.withColumn("clinical_risk_score", scorecard(CLINICAL_RULES))


def prepare_split(df: DataFrame, label: str = "cancer", key: str = "patient_id",
                  test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Stratified 80/20 split as a ``split`` column (rows stay together)."""
    return stratified_split(df, label, test_fraction, key, seed)
