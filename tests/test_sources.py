"""Sources and sinks: missing paths, NaN to NULL, JSON arrays, batches,
run metadata round trips and catalogs."""

import json
import os

from pyspark.sql import functions as F

from riskframe.sources import io as IO
from riskframe.sources.catalog import feature_catalog, model_catalog


def test_missing_path_gives_none(spark, tmp_path):
    assert IO.read_table(spark, str(tmp_path / "absent.parquet")) is None


def test_nan_becomes_null(spark, tmp_path):
    p = str(tmp_path / "nan.parquet")
    spark.createDataFrame([(1, float("nan")), (2, 3.0)], "k int, v double").write.parquet(p)
    rows = {r["k"]: r["v"] for r in IO.read_table(spark, p).collect()}
    assert rows == {1: None, 2: 3.0}


def test_csv_round_trip_with_schema(spark, tmp_path):
    p = str(tmp_path / "t.csv")
    df = spark.createDataFrame([(1, "a", 2.5), (2, None, None)], "k long, s string, v double")
    IO.write_table(df, p, fmt="csv")
    back = IO.read_table(spark, p, "k long, s string, v double", fmt="csv")
    assert sorted(map(tuple, back.collect())) == [(1, "a", 2.5), (2, None, None)]


def test_json_object_and_array_files(spark, tmp_path):
    d = tmp_path / "records"
    d.mkdir()
    (d / "one.json").write_text(json.dumps({"age": 40, "gender": "Male"}))
    (d / "many.json").write_text(json.dumps([{"age": 50, "gender": "Female"}, {"age": 60, "gender": "Male"}]))
    df = IO.read_records(spark, str(d), "age int, gender string", fmt="json", multi_line=True)
    assert sorted(r["age"] for r in df.collect()) == [40, 50, 60]


def test_explode_batch_structs(spark):
    body = spark.createDataFrame([([(30, "Male"), (70, "Female")],)], "patients array<struct<age:int,gender:string>>")
    flat = IO.explode_batch(body, "patients")
    assert [(r["record_no"], r["age"], r["gender"]) for r in flat.orderBy("record_no").collect()] == [
        (1, 30, "Male"), (2, 70, "Female")]


def test_metadata_round_trip_and_catalogs(spark, tmp_path):
    meta = {"models_available": ["Gradient Boosting", "Logistic Regression"], "best_model": "Gradient Boosting",
            "feature_names": ["age", "gender_Female", "gender_Male"], "categorical_columns": ["gender"],
            "numerical_columns": ["age"], "training_date": "2024-01-01T00:00:00",
            "performance": {"Gradient Boosting": {"accuracy": 0.85, "roc_auc": 0.7664, "f1_score": 0.55},
                            "Logistic Regression": {"accuracy": 0.775, "roc_auc": None, "f1_score": None}}}
    p = str(tmp_path / "meta")
    IO.write_run_metadata(spark, meta, p)
    m = IO.read_run_metadata(spark, p)
    cat = {r["name"]: r for r in model_catalog(m).collect()}
    assert cat["Gradient Boosting"]["roc_auc"] == 0.7664 and cat["Logistic Regression"]["roc_auc"] == 0.0
    fc = feature_catalog(m).orderBy("position").collect()
    assert [(r["feature"], r["from_categorical"]) for r in fc] == [
        ("age", False), ("gender_Female", True), ("gender_Male", True)]
    assert fc[0]["total_features"] == 3


def test_metrics_frame_drops_non_scalars(spark):
    df = IO.metrics_frame(spark, [{"model": "a", "acc": 0.5, "curve": [1, 2]}])
    assert df.columns == ["acc", "model"] or set(df.columns) == {"model", "acc"}


def test_save_and_load_models(spark, tmp_path):
    from riskframe.learn import models as MD
    from riskframe.learn import prep as PP
    df = spark.range(100).select((F.col("id") % 2).cast("int").alias("label"), F.col("id").cast("double").alias("x"),
                                 F.when(F.col("id") % 3 == 0, "u").otherwise("v").alias("c"))
    model = PP.pipeline(["x"], ["c"], MD.logistic(1.0, "l2", n_rows=100, max_iter=5)).fit(df)
    paths = IO.save_models({"Logistic Regression": model}, str(tmp_path), best="Logistic Regression")
    assert os.path.isdir(paths["best_model"]) and paths["Logistic Regression"].endswith("model_logistic_regression")
    assert IO.load_model(str(tmp_path), ["Gradient Boosting", "Logistic Regression"]) is not None
    assert IO.load_model(str(tmp_path), ["Nothing"]) is None


def test_condition_reaches_the_scan_and_nan_does_not_satisfy_it(spark, tmp_path):
    p = str(tmp_path / "n.parquet")
    spark.createDataFrame([(50.0,), (float("nan"),), (3.0,), (None,)], "v double").write.parquet(p)
    df = IO.read_table(spark, p, where="v > 40")
    assert [r["v"] for r in df.collect()] == [50.0]
    assert "GreaterThan(v,40.0)" in df._jdf.queryExecution().executedPlan().toString()


def test_a_broken_model_is_an_error_and_a_missing_one_is_none(spark, tmp_path):
    import pytest
    assert IO.load_model(str(tmp_path), ["a", "best_model"]) is None
    (tmp_path / "best_model").mkdir()
    with pytest.raises(Exception):
        IO.load_model(str(tmp_path), ["a", "best_model"])


def test_generated_partitions_are_bounded(spark, monkeypatch):
    """Keys beyond ``PART_KEYS`` a partition are spread over more tasks than cores, with the same rows."""
    from riskframe.sources import generate as G
    keys = spark.range(0, 900, 1, 1).withColumnRenamed("id", "k")
    whole = G.patients_from(keys, "k")
    monkeypatch.setattr(G, "PART_KEYS", 50)
    cut = G.patients_from(keys, "k")
    assert cut.rdd.getNumPartitions() == 18
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.collect()))


def test_one_large_partition_among_many_is_spread(spark, monkeypatch):
    """As many partitions as ``PART_KEYS`` asks for on average, but nearly all keys in one of them."""
    from riskframe.sources import generate as G
    monkeypatch.setattr(G, "PART_KEYS", 50)
    one = spark.range(0, 880, 1, 1).withColumnRenamed("id", "k")
    keys = one.unionAll(spark.range(880, 900, 1, 20).withColumnRenamed("id", "k"))
    got = G.patients_from(keys, "k")
    assert max(len(p) for p in got.rdd.glom().collect()) <= 60
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, G.patients_from(keys.coalesce(1), "k").collect()))
    assert G.spread(keys.where("k >= 880"), "k").rdd.getNumPartitions() == 21  # small partitions stay


def test_labelled_texts_count_characters_of_labelled_texts_only(spark, tmp_path, monkeypatch):
    """Shares of kinds of characters of odd texts; what is counted is counted above the join with the labels."""
    from riskframe.plans import learning as L
    texts = ["", "   ", "Ab 12, c!", "é中\U0001d400 x", "no label", None]
    spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in enumerate(texts)],
                          "doc_id long, text string, lang string, source string, n_chars int").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 0 if i % 2 else 1) for i in (0, 1, 2, 3, 3, 5)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    monkeypatch.setattr(L, "cut_lineage", lambda df: df)
    df = L.labelled_texts(spark, str(tmp_path))
    got = sorted((r["doc_id"], r["n_chars"], r["n_words"], r["letters"], r["marks"], r["digits"], r["lang"], r["label"]) for r in df.collect())
    letters_only = (3, 5.0, 2.0, 4 / 5, 0.0, 0.0, "", 0)
    assert got == [(0, 0.0, 0.0, 0.0, 0.0, 0.0, "", 1), (1, 3.0, 0.0, 0.0, 0.0, 0.0, "", 0),
                   (2, 9.0, 3.0, 3 / 9, 2 / 9, 2 / 9, "", 1), letters_only, letters_only]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("regexp") < plan.index("Join") and "regexp" not in plan[plan.index("Join"):]
