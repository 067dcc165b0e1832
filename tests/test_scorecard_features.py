"""Hand-worked scorecard rows, bins, ratios and formatting."""

import pytest
from pyspark.sql import functions as F

from riskframe.functions import features as FX
from riskframe.functions.scorecard import CLINICAL_RULES, scorecard

BASE = dict(age=30, gender="Male", family_history_cancer=0, unexplained_weight_loss=0, lump_presence=0,
            persistent_fatigue=0, chronic_pain=0, abnormal_bleeding=0, persistent_cough=0, diabetes=0,
            hypertension=0, cardiac_disease=0, lifestyle_risk_score=2, tumor_marker_level=10.0, tumor_size_cm=0.5,
            imaging_abnormality=0, hemoglobin_level=13.5, platelet_count=150000)
SCHEMA = ("age int, gender string, family_history_cancer int, unexplained_weight_loss int, lump_presence int, "
          "persistent_fatigue int, chronic_pain int, abnormal_bleeding int, persistent_cough int, diabetes int, "
          "hypertension int, cardiac_disease int, lifestyle_risk_score int, tumor_marker_level double, "
          "tumor_size_cm double, imaging_abnormality int, hemoglobin_level double, platelet_count int")


def _score(spark, **kw):
    row = dict(BASE, **kw)
    cols = [c.split()[0] for c in SCHEMA.split(", ")]
    df = spark.createDataFrame([tuple(row[c] for c in cols)], SCHEMA)
    return df.select(scorecard(CLINICAL_RULES).alias("s")).first()["s"]


def test_hand_worked_scores(spark):
    assert _score(spark) == 0
    flags = {k: 1 for k in BASE if isinstance(BASE[k], int) and k not in (
        "age", "lifestyle_risk_score", "platelet_count")}
    assert _score(spark, age=90, gender="Female", hemoglobin_level=8.0, platelet_count=450000,
                  tumor_marker_level=100.0, tumor_size_cm=10.0, lifestyle_risk_score=8, **flags) == 43
    assert _score(spark, age=41, gender="Female", hemoglobin_level=12.0, platelet_count=149999,
                  tumor_marker_level=25.01, tumor_size_cm=2.0, lifestyle_risk_score=5) == 8
    assert _score(spark, age=51, gender="Male", hemoglobin_level=13.4, platelet_count=400000,
                  tumor_marker_level=50.0, tumor_size_cm=5.0, lifestyle_risk_score=3) == 10


def test_age_bins(spark):
    df = spark.createDataFrame([(a,) for a in (0, 30, 31, 50, 51, 70, 71, 100, 101, 150, None)], "age int")
    got = {r["age"]: (r["f3"], r["f4"]) for r in df.select(
        "age", FX.cut("age", FX.AGE_BOUNDS, FX.AGE_LABELS).alias("f3"),
        FX.cut_open("age", FX.AGE_UPPERS, FX.AGE_LABELS).alias("f4")).collect()}
    assert got[0] == (None, "Young") and got[30] == ("Young", "Young")
    assert got[31] == ("Middle-aged",) * 2 and got[50] == ("Middle-aged",) * 2
    assert got[51] == ("Senior",) * 2 and got[70] == ("Senior",) * 2
    assert got[71] == ("Elderly",) * 2 and got[100] == ("Elderly",) * 2
    assert got[101] == (None, "Elderly") and got[150] == (None, "Elderly") and got[None] == (None, "Elderly")


def test_ratios(spark):
    df = spark.createDataFrame([(70.0, 175, 250000, 7500), (70.0, 0, 1, 1)], "w double, h int, p int, c int")
    r = df.select(FX.bmi("w", "h").alias("bmi"), FX.safe_ratio("p", "c", 0.3, 1e-10).alias("plr")).collect()
    assert r[0]["bmi"] == pytest.approx(22.857143, abs=1e-6) and r[0]["plr"] == pytest.approx(111.111111, abs=1e-6)
    assert r[1]["bmi"] is None


def test_lifestyle_and_ordinals(spark):
    df = spark.createDataFrame([("Current", "High", "Low", "Poor"), ("Never", "Never", "High", "Good"),
                                ("??", None, "Medium", "Average")],
                               "smoking_status string, alcohol_consumption string, physical_activity_level string, "
                               "diet_quality string")
    assert [r[0] for r in df.select(FX.lifestyle_score()).collect()] == [8, 0, 2]


def test_format_and_rounding(spark):
    df = spark.createDataFrame([(0.2105,), (0.125,), (0.5,)], "x double")
    got = [r[0] for r in df.select(FX.format_metric("x", 3)).collect()]
    assert got == ["0.210", "0.125", "0.500"]
    assert [r[0] for r in df.select(FX.format_metric("x", 2)).collect()] == ["0.21", "0.12", "0.50"]
    assert [r[0] for r in df.select(FX.format_metric("x", 1, pct=True)).collect()] == ["21.1%", "12.5%", "50.0%"]
    assert spark.range(1).select(F.bround(F.lit(2.5), 0)).first()[0] == 2.0


def test_one_hot_unknown_and_standardize(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "c string, v double")
    oh = FX.one_hot(spark.createDataFrame([("z", 1.0)], "c string, v double"), ["c"], levels={"c": ["a", "b"]})
    assert oh.first().asDict() == {"v": 1.0, "c_a": 0, "c_b": 0}
    assert [r["v"] for r in FX.standardize(df, ["v"]).collect()] == [0.0, 0.0]


def test_tiers_and_logspace(spark):
    df = spark.createDataFrame([(0.1,), (0.3,), (0.69,), (0.7,), (None,)], "p double")
    assert [r[0] for r in df.select(FX.risk_tier("p")).collect()] == ["Low", "Medium", "Medium", "High", "High"]
    v = spark.range(1).select(FX.logspace(-3, 3, 10)).first()[0]
    assert len(v) == 10 and v[0] == pytest.approx(1e-3) and v[-1] == pytest.approx(1e3)
