"""The learning queries run the whole of what they stand for: every model, grid, draw and fold."""

import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from conftest import SF_SMALL
from riskframe.learn import evaluate as EV
from riskframe.learn import models as MD
from riskframe.learn import tuning as TU
from riskframe.operators.quality import engineer_features
from riskframe.plans import learning as L
from riskframe.sources.generate import PATIENT_SPEC, generate_range

FOUR = ["Logistic Regression", "Random Forest", "SVM", "Gradient Boosting"]


@pytest.fixture
def few(spark, monkeypatch):
    """80 patients in place of the table's."""
    p = engineer_features(generate_range(spark, 80, PATIENT_SPEC, 7)).withColumnRenamed("cancer", "label").coalesce(1)
    df = p.withColumn("split", F.when(F.col("patient_id") % 4 == 0, "test").otherwise("train")).cache()
    monkeypatch.setattr(L, "patient_split", lambda spark, d: df)
    yield df
    df.unpersist()


@pytest.fixture
def texts(spark, monkeypatch):
    """60 labelled texts in place of the table's."""
    df = L.labelled_texts(spark, SF_SMALL).limit(60).coalesce(1).cache()
    monkeypatch.setattr(L, "labelled_texts", lambda spark, d: df)
    yield df
    df.unpersist()


def test_four_models_are_evaluated(spark, few):
    """Whole: 200 trees without a limit on depth, 100 rounds, no replaced fit."""
    got = L.q_evaluate_models_patients(spark, SF_SMALL).orderBy("position").collect()
    assert [r["model"] for r in got] == FOUR and sum(r["is_best"] for r in got) == 1
    assert all(0 <= r["accuracy"] <= 1 and 0 <= r["roc_auc"] <= 1 for r in got)
    m = L.four_models(10)
    assert m["Random Forest"].getNumTrees() == 200 and m["Random Forest"].growth.max_depth is None and m["Gradient Boosting"].getMaxIter() == 100


def test_four_models_in_five_folds(spark, few):
    got = L.q_kfold_logistic_patients(spark, SF_SMALL).collect()
    assert sorted(r["model"] for r in got) == sorted(FOUR)


def test_tuning_searches_whole_grids(spark, texts, monkeypatch):
    sizes, draw = [], TU.sample_grid

    def record(grid, n, seed, limit):
        combos = draw(grid, n, seed, limit)
        assert len({str(c) for c in combos}) == len(combos)
        sizes.append(len(combos))
        return combos
    monkeypatch.setattr(TU, "sample_grid", record)
    got = L.q_tuning_documents(spark, SF_SMALL).collect()
    assert [r["model"] for r in got] == FOUR and sizes == [24, 50, 60, 50]
    assert all(0 <= r["cv_score"] <= 1 and r["best_parameters"] for r in got)


def points(spark, n=100):
    rows = [(i, float(i % 7) - 2.0 + i % 2, float(i % 5), i % 2, i // 2 % 2) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, x double, y double, label int, fold int").coalesce(1)
    return df.withColumn("features", array_to_vector(F.array("x", "y"))).cache()


def test_search_keeps_the_best_mean(spark):
    from pyspark.ml import Pipeline
    df = points(spark)
    make = lambda c, n: MD.logistic(c["C"], "l2", n_rows=n, max_iter=c["max_iter"])
    model, best, score = TU.search(make, {"C": [1e-6, 1.0], "max_iter": [1, 5]}, Pipeline(stages=[]), df)
    aucs = []
    for f in range(2):
        tr, te = df.where(F.col("fold") != f), df.where(F.col("fold") == f)
        aucs.append(EV.evaluate_model("m", make(best, tr.count()), tr, te)[1]["roc_auc"])
    assert score == pytest.approx(sum(aucs) / 2) and score > 0.6
    assert model.transform(df).count() == 100
    df.unpersist()


def test_liblinear_penalises_the_intercept(spark):
    df = points(spark)
    m = MD.logistic(0.1, "l2", n_rows=100, max_iter=50, solver="liblinear").fit(df)
    w = m.stages[-1].coefficients.toArray()
    gap = m.transform(df).agg(F.sum(vector_to_array("probability")[1] - F.col("label"))).first()[0]
    assert len(w) == 3 and m.stages[-1].intercept == 0 and gap + w[2] / 0.1 == pytest.approx(0, abs=1e-3)
    df.unpersist()


@pytest.mark.parametrize("gamma,expected", [("auto", 0.5), (0.3, 0.3), ("scale", None)])
def test_kernel_width(spark, gamma, expected):
    import numpy as np
    df = points(spark)
    x = np.array([r[0].toArray() for r in df.select("features").collect()])
    m = MD.MarginClassifier(gamma=gamma, n_components=8, folds=1, max_iter=5).fit(df)
    assert m.kernel.features == 2 and m.kernel.gamma == pytest.approx(expected or 1 / (2 * x.var()))
    df.unpersist()
