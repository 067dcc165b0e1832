"""The record rule set (P12): which fields a record must have, the values that choices
allow and the limits of numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskframe.functions.columns import validate_records

# The fields of a record and their types.
RECORD_SCHEMA = (
    "age int, gender string, blood_group string, ethnicity string, height_cm int, weight_kg double, "
    "smoking_status string, alcohol_consumption string, family_history_cancer int, physical_activity_level string, "
    "diet_quality string, diabetes int, hypertension int, asthma int, cardiac_disease int, "
    "prior_radiation_exposure int, unexplained_weight_loss int, persistent_fatigue int, chronic_pain int, "
    "abnormal_bleeding int, persistent_cough int, lump_presence int, hemoglobin_level double, wbc_count int, "
    "platelet_count int, tumor_marker_level double, imaging_abnormality int, tumor_size_cm double")
# What choices allow.
RECORD_CHOICES = {
    "gender": ["Male", "Female"],
    "ethnicity": ["Asian", "African", "Caucasian", "Hispanic"],
    "blood_group": ["A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-"],
    "smoking_status": ["Never", "Former", "Current"],
    "alcohol_consumption": ["Never", "Moderate", "High"],
    "physical_activity_level": ["Low", "Medium", "High"],
    "diet_quality": ["Poor", "Average", "Good"],
}
# Limits of numbers.
RECORD_LIMITS = {"age": (1, 120), "height_cm": (50, 250), "weight_kg": (10, 300)}
RECORD_FLAGS = ("family_history_cancer", "diabetes", "hypertension", "asthma", "cardiac_disease", "prior_radiation_exposure",
                "unexplained_weight_loss", "persistent_fatigue", "chronic_pain", "abnormal_bleeding", "persistent_cough",
                "lump_presence", "imaging_abnormality")
RECORD_FIELDS = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]


def check_records(df: DataFrame, reasons_col: str = "reasons") -> DataFrame:
    """Adds the failed rules of each record: missing fields, values that a choice does not
    allow, flags other than 0 and 1, and numbers outside their limits."""
    allowed = RECORD_CHOICES | {f: [0, 1] for f in RECORD_FLAGS}
    return validate_records(df, RECORD_FIELDS, allowed, RECORD_LIMITS, reasons_col)
