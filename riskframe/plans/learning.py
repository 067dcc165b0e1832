"""Model training, tuning, analysis and scoring queries (rows-only checks:
spark.ml fits have no SQL twin). Training tables are derived from the
driver tables: record tables generated from ``orders`` keys, ``documents``
with ``labels``, and ``embeddings`` with a binarised label. Each training
frame is checkpointed once into the shared folder (the fits scan it many
times, and a lost executor then rereads it instead of the whole lineage)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskframe.functions import features as FX
from riskframe.learn import evaluate as EV
from riskframe.learn import importance as IM
from riskframe.learn import models as MD
from riskframe.learn import pca as PCA_
from riskframe.learn import perceptron as PT
from riskframe.learn import prep as PP
from riskframe.learn import trees as TR
from riskframe.learn import tuning as TU
from riskframe.operators import metrics as M
from riskframe.operators import report as RP
from riskframe.operators.quality import engineer_features, prepare_split
from riskframe.operators.ranking import components_for, top_features, top_loadings
from riskframe.operators.sampling import kfold, stratified_kfold, stratified_split
from riskframe.plans.registry import query, tb
from riskframe.session import cut_lineage, scratch_path, small_methods
from riskframe.sources import io as IO
from riskframe.sources.generate import CATEGORICAL, patients_from

# The record table's numeric inputs.
NUMERIC = ["age", "height_cm", "weight_kg", "family_history_cancer", "diabetes", "hypertension", "asthma",
           "cardiac_disease", "prior_radiation_exposure", "unexplained_weight_loss", "persistent_fatigue",
           "chronic_pain", "abnormal_bleeding", "persistent_cough", "lump_presence", "hemoglobin_level",
           "wbc_count", "platelet_count", "tumor_marker_level", "imaging_abnormality", "tumor_size_cm",
           "bmi", "platelet_lymphocyte_ratio", "lifestyle_risk_score", "clinical_risk_score"]
CATS = CATEGORICAL + ["age_category"]


def patient_split(spark, d):
    """Engineered records with label and a stratified split."""
    def build():
        p = engineer_features(patients_from(tb(spark, d, "orders"), "o_orderkey"))
        return prepare_split(p.withColumnRenamed("cancer", "label"), label="label")
    with small_methods(spark):
        return cut_lineage(build())


def _train_test(df):
    return df.where(F.col("split") == "train"), df.where(F.col("split") == "test")


def embeddings_frame(spark, d):
    def build():
        e = tb(spark, d, "embeddings")
        return e.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
                        (F.col("label") >= 5).cast("int").alias("label"))
    return cut_lineage(build())


def documents_frame(spark, d):
    def build():
        docs = tb(spark, d, "documents").select(
            "doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"),
            F.size(F.split("text", r"\s+")).cast("double").alias("n_words"))
        return docs.join(tb(spark, d, "labels"), "doc_id").withColumnRenamed("quality", "label")
    return cut_lineage(build())


def _metrics_df(spark, rows):
    return EV.metrics_table(spark, rows)


#: Iterations that a fit may take, as in the reference; it ends before by tolerance.
MAX_ITER = 1000
# The grids of the comparison. Draws of 50 where a grid has over 100 combinations.
GRIDS = {
    "Logistic Regression": {"C": [0.001, 0.01, 0.1, 1.0, 10.0, 100.0], "penalty": ["l2"], "solver": ["lbfgs", "liblinear"],
                            "max_iter": [1000, 2000]},
    "Random Forest": {"n_estimators": [100, 200, 300, 500], "max_depth": [None, 10, 20, 30, 50],
                      "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4],
                      "max_features": ["sqrt", "log2"], "bootstrap": [True, False]},
    "SVM": {"C": [0.1, 1.0, 10.0, 100.0], "kernel": ["rbf", "poly", "sigmoid"], "gamma": ["scale", "auto", 0.01, 0.1, 1.0]},
    "Gradient Boosting": {"n_estimators": [100, 200, 300], "learning_rate": [0.01, 0.05, 0.1, 0.2], "max_depth": [3, 5, 7, 10],
                          "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4], "subsample": [0.8, 0.9, 1.0]},
}


def forest(trees=200, max_depth=None, min_split=2, min_leaf=1, subset="sqrt", bootstrap=True, features="features"):
    return TR.HistogramForest(trees, TR.Growth(max_depth, min_split, min_leaf, subset), bootstrap, features=features)


def boosting(rounds=100, rate=0.1, max_depth=3, min_split=2, min_leaf=1, subsample=1.0, features="features"):
    return TR.HistogramBoosting(rounds, rate, TR.Growth(max_depth, min_split, min_leaf), subsample, features=features)


def four_models(n):
    """The four models of the comparison, unfitted, for n training rows."""
    return {"Logistic Regression": MD.logistic(1.0, "l2", n_rows=n, max_iter=MAX_ITER),
            "Random Forest": forest(),
            "SVM": MD.MarginClassifier(gamma="scale", max_iter=MAX_ITER),
            "Gradient Boosting": boosting()}


def candidate(name, c, n):
    """The estimator of a combination ``c`` of ``GRIDS[name]``."""
    if name == "Logistic Regression":
        return MD.logistic(c["C"], c["penalty"], n_rows=n, max_iter=c["max_iter"], solver=c["solver"])
    if name == "SVM":
        return MD.MarginClassifier(C=c["C"], gamma=c["gamma"], kernel=c["kernel"], max_iter=MAX_ITER)
    if name == "Random Forest":
        return forest(c["n_estimators"], c["max_depth"], c["min_samples_split"], c["min_samples_leaf"], c["max_features"], c["bootstrap"])
    return boosting(c["n_estimators"], c["learning_rate"], c["max_depth"], c["min_samples_split"], c["min_samples_leaf"], c["subsample"])


@query("evaluate_models_patients")
def q_evaluate_models_patients(spark, d):
    """Four models, one fit and one scoring each."""
    return evaluated(spark, patient_split(spark, d), NUMERIC, CATS)


@query("evaluate_models_documents")
def q_evaluate_models_documents(spark, d):
    """The same on real labels, of the quality of texts."""
    return evaluated(spark, cut_lineage(stratified_split(labelled_texts(spark, d), "label", 0.2, "doc_id", 42)), TEXT_NUMERIC, TEXT_CATS)


def evaluated(spark, df, numeric, cats):
    tr, te = _train_test(df)
    cands = four_models(tr.count())
    # one preprocessor fit and one transform of each side, shared by all models
    _, rows = EV.evaluate_models(cands, Pipeline(stages=PP.preprocessor_stages(numeric, cats)), tr, te)
    res = spark.createDataFrame([(r["model"], r["position"], r["accuracy"], r["f1"], r["roc_auc"]) for r in rows],
                                "model string, position int, accuracy double, f1 double, roc_auc double")
    best = EV.select_best(res).select(F.col("model").alias("best_model"))
    # one-row best table, broadcast: flags the winner
    return res.join(F.broadcast(best), res.model == best.best_model, "left").withColumn(
        "is_best", F.col("best_model").isNotNull()).drop("best_model")


@query("kfold_logistic_patients")
def q_kfold_logistic_patients(spark, d):
    """E11 + A20: four models, five folds, all measures from one fit per fold."""
    df = cut_lineage(kfold(patient_split(spark, d), 5, "patient_id", 7))
    folds = EV.evaluate_kfold_models(four_models, Pipeline(stages=PP.preprocessor_stages(NUMERIC, CATS)), df, "fold", 5)
    return M.cv_summary(folds, "model", ["accuracy", "precision", "recall", "f1", "roc_auc"])


TEXT_NUMERIC, TEXT_CATS = ["n_chars", "n_words", "word_length", "letters", "marks", "digits"], ["lang", "source"]


def labelled_texts(spark, d):
    """Documents with a quality label, their length and the shares of kinds of characters. Labels are
    joined before anything is counted, so that only labelled texts are read character by character."""
    size = F.greatest(F.char_length("text"), F.lit(1))
    share = lambda pattern: F.regexp_count("text", F.lit(pattern)) / size
    # what is left of the text without other characters: no array with an entry per letter
    letters = F.char_length(F.regexp_replace("text", r"\P{L}+", ""))
    docs = tb(spark, d, "documents").where("text IS NOT NULL").select("doc_id", "lang", "source", "text")
    labels = tb(spark, d, "labels").where("quality IS NOT NULL").select("doc_id", F.col("quality").cast("int").alias("label"))
    return cut_lineage(docs.join(labels, "doc_id").select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), F.char_length("text").cast("double").alias("n_chars"),
        F.regexp_count("text", F.lit(r"\S+")).cast("double").alias("n_words"), (F.char_length("text") / F.greatest(F.regexp_count("text", F.lit(r"\S+")), F.lit(1))).alias("word_length"),
        (letters / size).alias("letters"), share(r"\p{Punct}").alias("marks"), share("[0-9]").alias("digits"), "label"))


@query("tuning_documents")
def q_tuning_documents(spark, d):
    """Four models over the whole grids (logistic, margin) or 50 draws (forest,
    boosting) with stratified 5-fold CV on a fold column, then baseline-vs-tuned."""
    tr, te = _train_test(cut_lineage(stratified_split(labelled_texts(spark, d), "label", 0.2, "doc_id", 42)))
    tr = cut_lineage(stratified_kfold(tr, "label", 5, "doc_id", 42))
    raw, pre = Pipeline(stages=PP.preprocessor_stages(TEXT_NUMERIC, TEXT_CATS, scale=False)), PP.preprocessor_stages(TEXT_NUMERIC, TEXT_CATS)
    rows, _ = TU.indexed(raw, tr, "fold", "label", len(TEXT_NUMERIC))
    n = tr.count()
    out = []
    for name, base in four_models(n).items():
        if name == "Logistic Regression":
            best, cv, _ = TU.search_linear(GRIDS[name], rows, len(TEXT_NUMERIC))
        elif name == "SVM":
            best, cv = TU.search_margin(GRIDS[name], rows, len(TEXT_NUMERIC))
        else:
            best, cv = TU.search_trees(lambda c: candidate(name, c, n), GRIDS[name], rows)  # noqa: B023  called here only
        model = Pipeline(stages=[*pre, candidate(name, best, n)]).fit(tr)
        out.append(TU.compare_tuning(name, Pipeline(stages=[*pre, base]), model, cv, best, tr, te))
    return spark.createDataFrame(out)


@query("stored_models_documents", """
WITH m(model) AS (VALUES ('Logistic Regression'), ('Random Forest'), ('SVM'), ('Gradient Boosting'))
SELECT doc_id, model, true AS same FROM documents JOIN labels USING (doc_id), m WHERE text IS NOT NULL AND quality IS NOT NULL""")
def q_stored_models_documents(spark, d):
    """Four fitted pipelines are saved, loaded and score every row as before."""
    df = labelled_texts(spark, d)
    models = {name: PP.pipeline(TEXT_NUMERIC, TEXT_CATS, est).fit(df) for name, est in four_models(df.count()).items()}
    path = scratch_path(spark, "models")
    IO.save_models(models, path, best="SVM")
    out = None
    for name, m in models.items():
        score = lambda fitted, col: fitted.transform(df).select("doc_id", F.round(vector_to_array("probability")[1], 9).alias(col))
        both = score(m, "a").join(score(IO.load_model(path, [name]), "b"), "doc_id")
        part = both.select("doc_id", F.lit(name).alias("model"), (F.col("a") == F.col("b")).alias("same"))
        out = part if out is None else out.unionAll(part)
    return out


@query("regularization_patients")
def q_regularization_patients(spark, d):
    """E20 + A22: four penalties, train/test accuracy, AUC, non-zero coefficients."""
    df = patient_split(spark, d)
    tr, te = _train_test(df)
    n = tr.count()
    variants = {name: MD.logistic(1.0, pen, 0.5, n_rows=n, max_iter=MAX_ITER)
                for name, pen in [("No Regularization", "none"), ("L1 Regularization", "l1"),
                                  ("L2 Regularization", "l2"), ("ElasticNet", "elasticnet")]}
    rows, _ = TU.compare_regularization(variants, tr, te, preprocessor=PP.pipeline(NUMERIC, CATS))
    return spark.createDataFrame(rows)


@query("coefficients_patients")
def q_coefficients_patients(spark, d):
    """Top signed coefficients of L1 and L2 fits (no refit)."""
    df = patient_split(spark, d)
    tr, _ = _train_test(df)
    n = tr.count()
    l1 = PP.pipeline(NUMERIC, CATS, MD.logistic(1.0, "l1", n_rows=n, max_iter=MAX_ITER)).fit(tr)
    l2 = PP.pipeline(NUMERIC, CATS, MD.logistic(1.0, "l2", n_rows=n, max_iter=MAX_ITER)).fit(tr)
    names = PP.feature_names(l2, NUMERIC, CATS)
    return IM.compare_coefficients(spark, {"L1": l1.stages[-1], "L2": l2.stages[-1]}, names, 15)


@query("feature_importance_patients")
def q_feature_importance_patients(spark, d):
    """Tree importances with encoded feature names, top 10."""
    df = patient_split(spark, d)
    tr, _ = _train_test(df)
    model = PP.pipeline(NUMERIC, CATS, boosting()).fit(tr)
    names = PP.feature_names(model, NUMERIC, CATS)
    return top_features(IM.feature_importance(spark, model.stages[-1], names), 10, "importance", "feature")


@query("pca_scree_embeddings")
def q_pca_scree_embeddings(spark, d):
    """Centered PCA, ratio and cumulative per component."""
    e = embeddings_frame(spark, d)
    model = PCA_.pca_fit(e, "features", 64)
    sc = PCA_.scree(spark, model)
    n = components_for(sc, 0.95).first()["n_components"]
    return sc.withColumn("n_components_95", F.lit(n))


@query("pca_loadings_embeddings")
def q_pca_loadings_embeddings(spark, d):
    """Top 15 dimensions by max |loading| over the first 5 components."""
    e = embeddings_frame(spark, d)
    model = PCA_.pca_fit(e, "features", 64)
    ld = PCA_.loadings(spark, model, [f"dim_{i}" for i in range(64)])
    return top_loadings(ld, 15, 5)


@query("compare_pca_embeddings")
def q_compare_pca_embeddings(spark, d):
    """Logistic, forest and boosting with and without the 95% projection."""
    e = stratified_split(embeddings_frame(spark, d), "label", 0.2, "vec_id", 42)
    tr, te = _train_test(e)
    model = PCA_.pca_fit(tr, "features", 64)
    k = components_for(PCA_.scree(spark, model), 0.95).first()["n_components"]
    n = tr.count()
    ests = {"Logistic Regression": lambda f: MD.logistic(1.0, "l2", n_rows=n, max_iter=MAX_ITER, features=f),
            "Random Forest": lambda f: forest(100, features=f),
            "Gradient Boosting": lambda f: boosting(features=f)}
    return spark.createDataFrame(PCA_.compare_pca(ests, tr, te, model, int(k)))


@query("margin_classifier_embeddings")
def q_margin_classifier_embeddings(spark, d):
    """Random Fourier features + linear SVM + Platt scaling."""
    e = stratified_split(embeddings_frame(spark, d), "label", 0.2, "vec_id", 42)
    tr, te = _train_test(e)
    m = MD.fit_margin_classifier(tr, 64, C=1.0, gamma=0.05, n_components=128, key="vec_id", max_iter=MAX_ITER)
    sc = EV.scored(m.transform(te)).cache()
    return _metrics_df(spark, [{"model": "SVM (RFF)"} | EV.measures(sc)])


@query("margin_sweep_embeddings")
def q_margin_sweep_embeddings(spark, d):
    """The margin classifier over seven strengths of regularisation."""
    e = stratified_split(embeddings_frame(spark, d), "label", 0.2, "vec_id", 42)
    tr, te = _train_test(cut_lineage(e))
    make = lambda c: MD.MarginClassifier(64, C=c, gamma=0.05, n_components=128, key="vec_id", max_iter=MAX_ITER)
    return spark.createDataFrame(TU.sweep(make, [0.001, 0.01, 0.1, 1.0, 10.0, 100.0, 1000.0], tr, te))


@query("mlp_embeddings")
def q_mlp_embeddings(spark, d):
    """Perceptron with hidden layers 50 and 25."""
    e = stratified_split(embeddings_frame(spark, d), "label", 0.2, "vec_id", 42)
    tr, te = _train_test(e)
    _, m = EV.evaluate_model("Neural Network", MD.mlp(64, (50, 25), MAX_ITER), tr, te)
    return _metrics_df(spark, [m])


@query("validation_curve_documents")
def q_validation_curve_documents(spark, d):
    """E21 + F14: train/CV accuracy over C = 10^-3 .. 10^3 (10 values)."""
    docs = stratified_kfold(documents_frame(spark, d), "label", 5, "doc_id", 42)
    values = spark.range(1).select(FX.logspace(-3, 3, 10).alias("v")).first()["v"]
    rows, _ = TU.indexed(Pipeline(stages=PP.preprocessor_stages(["n_chars", "n_words"], ["lang", "source"], scale=False)), docs, "fold", "label", 2)
    return spark.createDataFrame(TU.validation_curve(values, rows, 2))


@query("sweep_documents")
def q_sweep_documents(spark, d):
    """train/test accuracy per regularisation strength, all fits in shared passes."""
    docs = stratified_split(documents_frame(spark, d), "label", 0.2, "doc_id", 42).withColumn("fold", (F.col("split") == "train").cast("int"))
    rows, _ = TU.indexed(Pipeline(stages=PP.preprocessor_stages(["n_chars", "n_words"], ["lang", "source"], scale=False)), docs, "fold", "label", 2)
    return spark.createDataFrame(TU.sweep_logistic([0.001, 0.01, 0.1, 1.0, 10.0, 100.0], rows, 2))


@query("perceptron_sweep_documents")
def q_perceptron_sweep_documents(spark, d):
    """Perceptrons with hidden layers 50 and 25 per strength of the L2 term, all fits in shared passes."""
    docs = stratified_split(labelled_texts(spark, d), "label", 0.2, "doc_id", 42).withColumn("fold", (F.col("split") == "train").cast("int"))
    rows, _ = TU.indexed(Pipeline(stages=PP.preprocessor_stages(TEXT_NUMERIC, TEXT_CATS, scale=False)), docs, "fold", "label", len(TEXT_NUMERIC))
    return spark.createDataFrame(PT.sweep_alpha([0.0001, 0.001, 0.01, 0.1, 1.0, 10.0], rows, len(TEXT_NUMERIC), max_iter=MAX_ITER))


@query("permutation_importance_documents")
def q_permutation_importance_documents(spark, d):
    """E25 + D9: accuracy drop per raw input column."""
    docs = stratified_split(documents_frame(spark, d), "label", 0.2, "doc_id", 42)
    tr, te = _train_test(docs)
    model = PP.pipeline(["n_chars", "n_words"], ["lang", "source"], forest()).fit(tr)
    return IM.permutation_importance(model, te, ["n_chars", "n_words", "lang", "source"], "doc_id", repeats=10)


@query("analyze_model_patients")
def q_analyze_model_patients(spark, d):
    """E28 + A14: metric table of a fitted model on the held-out rows."""
    df = patient_split(spark, d)
    tr, te = _train_test(df)
    model = PP.pipeline(NUMERIC, CATS, boosting()).fit(tr)
    a = RP.analyze_model(EV.scored(model.transform(te)))
    return a["metrics"]


@query("threshold_table_patients")
def q_threshold_table_patients(spark, d):
    """Threshold comparison of a fitted model on the held-out rows."""
    df = patient_split(spark, d)
    tr, te = _train_test(df)
    model = PP.pipeline(NUMERIC, CATS, boosting()).fit(tr)
    return RP.threshold_table(EV.scored(model.transform(te)))


@query("prediction_report_patients")
def q_prediction_report_patients(spark, d):
    """E30 + S6/S7: save the model, load it back (fallback order), report on
    every row (training rows included, as the reference's report does)."""
    df = patient_split(spark, d)
    tr, _ = _train_test(df)
    model = PP.pipeline(NUMERIC, CATS, boosting()).fit(tr)
    path = scratch_path(spark, "models")
    IO.save_models({"Gradient Boosting": model}, path, best="Gradient Boosting")
    loaded = IO.load_model(path, ["Gradient Boosting", "best_model"])
    return RP.prediction_report(df.drop("split"), loaded, "label")


@query("score_batch_patients")
def q_score_batch_patients(spark, d):
    """Records (raw inputs only) get scoring-time features, are scored
    once and tiered; plus the batch summary columns."""
    from riskframe.learn.scoring import score_batch
    df = patient_split(spark, d)
    tr, te = _train_test(df)
    model = PP.pipeline(NUMERIC, CATS, MD.logistic(1.0, "l2", n_rows=tr.count(), max_iter=MAX_ITER)).fit(tr)
    raw = [c for c in patients_from(tb(spark, d, "orders").limit(0), "o_orderkey").columns if c != "cancer"]
    return score_batch(te.select(*raw), model, "patient_id")
