"""Edge cases: empty table, one class only, all-null column, absent id
column, zero denominators, NaN at the source."""

from pyspark.sql import functions as F

from riskframe.functions.columns import resolve_id_column
from riskframe.operators import metrics as M
from riskframe.operators import profile as PR
from riskframe.operators.sampling import sample_n, stratified_split


def test_empty_table(spark):
    df = spark.createDataFrame([], "label int, score double, prediction int")
    assert M.roc_auc(df).first()[0] is None
    assert M.average_precision(df).first()[0] is None
    m = M.classification_metrics(df).first()
    assert m["accuracy"] == 0.0 and m["tp"] == 0
    assert M.batch_summary(df).first()["positive_percentage"] == 0.0
    assert sample_n(df, 5, "score", 1).count() == 0
    assert PR.duplicate_count(df).first()[0] == 0


def test_one_class_only(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.9)], "label int, score double")
    assert M.roc_auc(df).first()[0] is None  # undefined without negatives
    assert M.average_precision(df).first()[0] == 1.0
    s = stratified_split(df.withColumn("k", F.col("score")), "label", 0.5, "k", 3)
    assert s.where("split = 'test'").count() == 1


def test_all_null_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "k int, v double")
    assert PR.column_medians(df, ["v"]).first()["v"] is None
    assert {r[0]: r[1] for r in PR.null_counts(df).collect()}["v"] == 2
    from riskframe.operators.quality import impute
    assert impute(df, exclude=["k"]).where(F.col("v").isNull()).count() == 2  # nothing to fill from


def test_absent_id_column(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "name string")
    out, col = resolve_id_column(df, "patient_id", ["id", "ID"], order_cols=["name"])
    assert col == "patient_id"
    assert {r["name"]: r["patient_id"] for r in out.collect()} == {"a": 1000, "b": 1001, "c": 1002}


def test_zero_denominators_and_nan(spark, tmp_path):
    from riskframe.functions.features import bmi
    from riskframe.sources.io import read_table
    p = str(tmp_path / "n.parquet")
    spark.createDataFrame([(70.0, 0.0), (float("nan"), 170.0)], "w double, h double").write.parquet(p)
    df = read_table(spark, p)
    r = df.select(bmi("w", "h").alias("b")).collect()
    assert r[0]["b"] is None and r[1]["b"] is None
    cm = spark.createDataFrame([(0, 1)], "label int, prediction int")
    m = M.classification_metrics(cm).first()
    assert m["recall"] == 0.0 and m["specificity"] == 0.0 and m["precision"] == 0.0


def test_one_hot_vector_stays_sparse(spark):
    """Places are read from the sparse vector (a dense one has an entry per level and row); nulls and unknown are all 0."""
    from riskframe.functions import features as FX
    rows = [(i, None if i % 7 == 0 else f"k{i % 3000}") for i in range(6000)]
    x = FX.one_hot_vector(spark.createDataFrame(rows, "i int, k string"), ["k"]).withColumn("place", FX.vector_place("k_oh"))
    at = {k: j for j, k in enumerate(sorted({k for _, k in rows if k}))}
    assert {(r["i"], r["k"], r["place"]) for r in x.collect()} == {(i, k, at.get(k, -1)) for i, k in rows}
    assert x.first()["k_oh"].size == len(at)
    none = FX.one_hot_vector(spark.createDataFrame([(None,)], "k string"), ["k"]).select(FX.vector_place("k_oh")).collect()
    assert [r[0] for r in none] == [-1]
