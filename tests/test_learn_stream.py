"""Learning operators on separable data, PCA centering, and stream scoring."""

import os

import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskframe.learn import evaluate as EV
from riskframe.learn import models as MD
from riskframe.learn import pca as PCA_
from riskframe.learn import prep as PP
from riskframe.operators.sampling import stratified_split


def _separable(spark, n=600):
    df = spark.range(n).select(
        F.col("id").alias("k"),
        (F.col("id") % 2).cast("int").alias("label"),
        F.when(F.col("id") % 3 == 0, "x").when(F.col("id") % 3 == 1, "y").otherwise("z").alias("cat"),
        ((F.col("id") % 2) * 2.0 + F.sin(F.col("id"))).alias("a"),
        F.cos(F.col("id")).alias("b"))
    return stratified_split(df, "label", 0.25, "k", 1)


def test_models_beat_chance(spark):
    df = _separable(spark)
    tr, te = df.where("split = 'train'"), df.where("split = 'test'")
    for est in (MD.logistic(1.0, "l2", n_rows=450), MD.random_forest(10, 4), MD.gradient_boosting(10, 0.1, 2)):
        _, m = EV.evaluate_model("m", PP.pipeline(["a", "b"], ["cat"], est), tr, te)
        assert m["roc_auc"] > 0.9 and m["accuracy"] > 0.8


def test_feature_names_and_unknown_level(spark):
    df = _separable(spark)
    model = PP.pipeline(["a", "b"], ["cat"], MD.logistic(1.0, "l2", n_rows=600)).fit(df)
    assert PP.feature_names(model, ["a", "b"], ["cat"]) == ["a", "b", "cat_x", "cat_y", "cat_z"]
    new = spark.createDataFrame([(1.0, 0.0, "never-seen", 0)], "a double, b double, cat string, label int")
    vec = model.transform(new).select(vector_to_array("features")).first()[0]
    assert vec[2:] == [0.0, 0.0, 0.0]


def test_margin_classifier(spark):
    df = _separable(spark)
    feats = df.withColumn("features", array_to_vector(F.array("a", "b")))
    tr, te = feats.where("split = 'train'"), feats.where("split = 'test'")
    m = MD.fit_margin_classifier(tr, 2, C=1.0, gamma=0.5, n_components=64, key="k")
    res = EV.measures(EV.scored(m.transform(te)))
    assert res["roc_auc"] > 0.9


def test_pca_centered(spark):
    df = spark.range(200).select(array_to_vector(F.array((F.col("id") * 1.0), F.sin("id") + 5, F.cos("id") - 3))
                                 .alias("features"))
    model = PCA_.pca_fit(df, "features", 3)
    proj = PCA_.pca_project(model, df, 2)
    means = proj.select(vector_to_array("pca_features").alias("v")).select(
        F.avg(F.col("v")[0]), F.avg(F.col("v")[1])).first()
    assert abs(means[0]) < 1e-6 and abs(means[1]) < 1e-6
    sc = {r["component"]: r for r in PCA_.scree(spark, model).collect()}
    assert sc[3]["cumulative"] == pytest.approx(1.0)


def test_stream_scoring(spark, tmp_path):
    from riskframe.operators.quality import engineer_features
    from riskframe.sources.generate import PATIENT_SPEC, generate_range
    from riskframe.streaming.score_stream import score_stream
    p = engineer_features(generate_range(spark, 400, PATIENT_SPEC, 7)).withColumnRenamed("cancer", "label")
    cats = ["gender", "smoking_status", "age_category"]
    model = PP.pipeline(["age", "bmi", "clinical_risk_score"], cats, MD.logistic(1.0, "l2", n_rows=400)).fit(p)
    raw = generate_range(spark, 50, PATIENT_SPEC, 8).drop("cancer")
    bad = raw.limit(3).withColumn("gender", F.lit("Unknown"))
    src = str(tmp_path / "in")
    raw.write.parquet(src)
    bad.write.mode("append").parquet(src)
    out = str(tmp_path / "out")
    score_stream(spark, src, raw.schema, model, out, allowed={"gender": ["Male", "Female"]})
    scored = spark.read.parquet(os.path.join(out, "scored"))
    assert scored.count() == 50
    assert spark.read.parquet(os.path.join(out, "rejected")).count() == 3
    assert set(r[0] for r in scored.select("cancer_risk").distinct().collect()) <= {"Low", "Medium", "High"}
    assert spark.read.parquet(os.path.join(out, "summary")).agg(F.sum("total_patients")).first()[0] == 50


def test_margin_classifier_is_an_estimator(spark, tmp_path):
    """It separates a ring from its middle, cross-validates over C, and comes back from disk."""
    import math

    from pyspark.ml import Pipeline
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    from riskframe.learn import models as MD
    from riskframe.learn import tuning as TU
    rows = [(i, (1.0 if i % 2 else 0.2) * math.cos(i), (1.0 if i % 2 else 0.2) * math.sin(i), i % 2, i % 4 // 2) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, x double, y double, label int, fold int")
    df = df.withColumn("features", array_to_vector(F.array("x", "y"))).cache()
    est = MD.MarginClassifier(2, gamma=2.0, n_components=32, key="k", folds=1, max_iter=8)
    model, best, score = TU.cross_validate(Pipeline(stages=[est]), est, {"C": [0.1, 10.0]}, df)
    assert set(best) == {"C"} and score > 0.99
    fitted = est.fit(df)
    fitted.save(str(tmp_path / "m"))
    again = MD.MarginClassifierModel.load(str(tmp_path / "m"))
    a, b = (m.transform(df).select("k", "prediction", F.round("margin", 9).alias("margin")).orderBy("k").collect() for m in (fitted, again))
    assert a == b and sum(r["prediction"] == r["k"] % 2 for r in a) >= 297
    df.unpersist()


def test_stream_files_are_bounded(spark, monkeypatch, tmp_path):
    """The three arriving batches are cut into files of at most about ``BATCH_FILE_ROWS`` rows, none lost."""
    from riskframe.plans import checks
    files = []
    one = checks.score_stream
    monkeypatch.setattr(checks, "BATCH_FILE_ROWS", 100)
    monkeypatch.setattr(checks, "score_stream", lambda sp, src, *a, **k: (files.append((len(sp.read.format("binaryFile").load(src).select("path").collect()), k["max_files"])), one(sp, src, *a, **k))[1])
    keys = spark.range(900).withColumnRenamed("id", "o_orderkey")
    monkeypatch.setattr(checks, "tb", lambda sp, d, name: keys)
    got = checks.q_stream_rows_patients(spark, str(tmp_path)).collect()
    assert files == [(9, 3)]
    assert sorted(r["patient_id"] for r in got) == [1000 + i for i in range(900)]
