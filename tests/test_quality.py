"""Damage and repair on a 1,200-row generated table: the counts of the
reference's damaged form, and the repaired table's invariants."""

from pyspark.sql import functions as F

from riskframe.operators import profile as PR
from riskframe.operators import quality as Q
from riskframe.sources.generate import PATIENT_SPEC, generate_range


def _patients(spark, n=1200):
    return generate_range(spark, n, PATIENT_SPEC, 42)


def test_generated_domains(spark):
    p = _patients(spark)
    r = p.agg(F.min("age"), F.max("age"), F.min("hemoglobin_level"), F.max("hemoglobin_level"),
              F.countDistinct("blood_group"), F.min("patient_id"), F.max("patient_id"), F.avg("cancer")).first()
    assert 18 <= r[0] and r[1] <= 89 and 8.0 <= r[2] and r[3] <= 17.0
    assert r[4] == 8 and (r[5], r[6]) == (1000, 2199) and 0.2 < r[7] < 0.4
    # same rows whatever the partitioning of the keys
    a = sorted(map(tuple, p.collect()))
    b = sorted(map(tuple, generate_range(spark, 1200, PATIENT_SPEC, 42).repartition(7).collect()))
    assert a == b


def test_damaged_form_counts(spark):
    d = Q.inject_anomalies(_patients(spark)).cache()
    assert d.count() == 1206
    r = d.agg(F.count_if(F.col("wbc_count").isNull()).alias("nulls"), F.count_if(F.col("copy_no") == 1).alias("c"),
              F.count_if(F.col("age") == 150).alias("a"), F.count_if(F.col("tumor_size_cm") == 40).alias("t")).first()
    # 36 nulled rows (copies of nulled rows add to it), 12 copies, 6 and 6 outliers, minus deletions
    assert 30 <= r["nulls"] <= 40 and 10 <= r["c"] <= 12 and 4 <= r["a"] <= 6 and 4 <= r["t"] <= 6


def test_clean_table(spark):
    c = Q.clean_table(Q.inject_anomalies(_patients(spark))).cache()
    assert c.where(F.col("wbc_count").isNull()).count() == 0
    assert c.where(~F.col("age").between(18, 90) | ~F.col("tumor_size_cm").between(0.5, 10)).count() == 0
    assert PR.duplicate_count(c.drop("patient_id", "source_key", "copy_no")).first()[0] == 0
    ids = sorted(r[0] for r in c.select("patient_id").collect())
    assert ids == list(range(1000, 1000 + len(ids)))
    sized = Q.clean_table(Q.inject_anomalies(_patients(spark)), target_rows=1200)
    assert sized.count() == 1200 and sized.select("patient_id").distinct().count() == 1200


def test_engineer_and_split(spark):
    fe = Q.engineer_features(_patients(spark))
    assert {"bmi", "age_category", "platelet_lymphocyte_ratio", "lifestyle_risk_score",
            "clinical_risk_score"} <= set(fe.columns)
    s = Q.prepare_split(fe)
    g = {(r[0], r[1]): r[2] for r in s.groupBy("cancer", "split").count().collect()}
    for y in (0, 1):
        n = g[(y, "train")] + g[(y, "test")]
        assert abs(g[(y, "test")] - 0.2 * n) <= 1


def test_profile_ops(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (1, 2.0, "a"), (3, None, "b"), (4, 4.0, "b")], "x int, y double, s string")
    assert PR.duplicate_count(df).first()[0] == 1
    assert {r[0]: r[1] for r in PR.null_counts(df).collect()} == {"x": 0, "y": 1, "s": 0}
    m = PR.column_medians(df, ["x", "y"]).first()
    assert m["x"] == 2.0 and m["y"] == 2.0
    assert PR.column_modes(df, ["s", "x"]).first().asDict() == {"s": "a", "x": 1}
    empty = df.limit(0)
    assert PR.shape(empty).first()["rows"] == 0


def test_damage_looks_for_its_thresholds_in_the_keys_alone(spark, monkeypatch):
    from riskframe.operators import sampling as SA
    seen, plain = [], SA.smallest_thresholds
    monkeypatch.setattr(SA, "smallest_thresholds", lambda df, *a, **k: seen.append(df.columns) or plain(df, *a, **k))
    df = spark.range(400).selectExpr("id AS patient_id", "cast(id % 60 + 20 AS int) AS age", "1.5D AS tumor_size_cm", "id AS wbc_count")
    out = Q.inject_anomalies(df)
    assert seen == [["patient_id"]] * 2 + [["patient_id", "copy_no"]] * 3
    # 400 rows, 4 copies, 2 deleted; no more nulls than the 12 rows and their copies
    assert out.count() == 402
    assert 10 <= out.where("wbc_count IS NULL").count() <= 16
