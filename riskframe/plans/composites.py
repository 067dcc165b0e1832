"""Composite stages over record tables generated from driver-table keys.

Records are generated from the keys of ``orders`` (S2), so their work grows
with the driver tables; then damaged, repaired, feature-engineered and split
exactly as the library's composites do. Oracles spell each stage in DuckDB.
"""

from __future__ import annotations

from riskframe.operators import profile as PR
from riskframe.operators import quality as Q
from riskframe.plans.oracle import mark_sql, patients_sql
from riskframe.plans.registry import query, tb
from riskframe.sources.generate import PATIENT_SPEC, patients_from

COLS = [n for n, _, _ in PATIENT_SPEC]


def patients(spark, d):
    return patients_from(tb(spark, d, "orders"), "o_orderkey")


def damaged(spark, d):
    return Q.inject_anomalies(patients(spark, d))


def cleaned(spark, d):
    return Q.clean_table(damaged(spark, d))


def _sel(cols, repl=None, extra=""):
    repl = repl or {}
    body = ", ".join(f"{repl[c]} AS {c}" if c in repl else c for c in cols)
    return body + (", " + extra if extra else "")


def _damage_sql() -> str:
    nulls = {c: f"CASE WHEN m THEN NULL ELSE {c} END" for c in Q.NULL_COLUMNS}
    ck = ["patient_id", "copy_no"]
    cc = COLS + ["copy_no"]
    return f"""p AS ({patients_sql('orders', 'o_orderkey')}),
s1 AS (SELECT {_sel(COLS, nulls)} FROM (SELECT *, {mark_sql(['patient_id'], Q.NULL_SEED, Q.NULL_FRACTION)} AS m FROM p)),
s2 AS (SELECT *, 0 AS copy_no FROM s1 UNION ALL
  SELECT {_sel(COLS)}, 1 AS copy_no FROM (SELECT *, {mark_sql(['patient_id'], Q.DUP_SEED, Q.DUP_FRACTION)} AS m FROM s1)
  WHERE m),
s3 AS (SELECT {_sel(cc, {'age': 'CASE WHEN m THEN 150 ELSE age END'})}
  FROM (SELECT *, {mark_sql(ck, Q.AGE_OUTLIER_SEED, Q.AGE_OUTLIER_FRACTION)} AS m FROM s2)),
s4 AS (SELECT {_sel(cc, {'tumor_size_cm': 'CASE WHEN m THEN 40.0::DOUBLE ELSE tumor_size_cm END'})}
  FROM (SELECT *, {mark_sql(ck, Q.SIZE_OUTLIER_SEED, Q.SIZE_OUTLIER_FRACTION)} AS m FROM s3)),
dmg AS (SELECT {_sel(cc)} FROM (SELECT *, {mark_sql(ck, Q.DELETE_SEED, Q.DELETE_FRACTION)} AS m FROM s4) WHERE NOT m)"""


def _clean_sql() -> str:
    fill = {
        "wbc_count": "coalesce(wbc_count, CAST(trunc((SELECT median(wbc_count) FROM dmg)) AS INTEGER))",
        "platelet_count": "coalesce(platelet_count, CAST(trunc((SELECT median(platelet_count) FROM dmg)) AS INTEGER))",
        "hemoglobin_level": "coalesce(hemoglobin_level, (SELECT median(hemoglobin_level) FROM dmg))",
    }
    data = [c for c in COLS if c != "patient_id"]
    return f"""{_damage_sql()},
imp AS (SELECT DISTINCT {_sel(COLS, fill)} FROM dmg),
rng AS (SELECT * FROM imp WHERE age BETWEEN 18 AND 90 AND tumor_size_cm BETWEEN 0.5 AND 10),
cln AS (SELECT {_sel(data)}, patient_id AS source_key, CAST(0 AS BIGINT) AS copy_no,
  CAST(row_number() OVER (ORDER BY patient_id) + 999 AS BIGINT) AS patient_id FROM rng)"""


def _engineer_sql() -> str:
    def ordinal(col, m):
        cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in m.items())
        return f"(CASE {col} {cases} ELSE 0 END)"
    from riskframe.functions import features as FX
    life = " + ".join(ordinal(c, m) for c, m in FX.LIFESTYLE_PARTS)
    score = """(CASE WHEN age > 50 THEN 3 WHEN age > 40 THEN 2 WHEN age > 30 THEN 1 ELSE 0 END)
  + (CASE WHEN family_history_cancer = 1 THEN 4 ELSE 0 END)
  + (CASE WHEN unexplained_weight_loss = 1 THEN 3 ELSE 0 END) + (CASE WHEN lump_presence = 1 THEN 4 ELSE 0 END)
  + (CASE WHEN persistent_fatigue = 1 THEN 2 ELSE 0 END) + (CASE WHEN chronic_pain = 1 THEN 2 ELSE 0 END)
  + (CASE WHEN abnormal_bleeding = 1 THEN 3 ELSE 0 END) + (CASE WHEN persistent_cough = 1 THEN 2 ELSE 0 END)
  + (diabetes * 1 + hypertension * 1 + cardiac_disease * 2)
  + (CASE WHEN lifestyle_risk_score > 6 THEN 3 WHEN lifestyle_risk_score > 4 THEN 2
      WHEN lifestyle_risk_score > 2 THEN 1 ELSE 0 END)
  + (CASE WHEN tumor_marker_level > 50 THEN 3 WHEN tumor_marker_level > 25 THEN 2
      WHEN tumor_marker_level > 10 THEN 1 ELSE 0 END)
  + (CASE WHEN tumor_size_cm > 5 THEN 4 WHEN tumor_size_cm > 2 THEN 2 WHEN tumor_size_cm > 0.5 THEN 1 ELSE 0 END)
  + (CASE WHEN imaging_abnormality = 1 THEN 3 ELSE 0 END)
  + (CASE WHEN hemoglobin_level < 12 AND gender = 'Female' THEN 2
      WHEN hemoglobin_level < 13.5 AND gender = 'Male' THEN 2 ELSE 0 END)
  + (CASE WHEN platelet_count > 400000 OR platelet_count < 150000 THEN 1 ELSE 0 END)"""
    return f"""{_clean_sql()},
fe0 AS (SELECT *, weight_kg / pow(height_cm / 100.0::DOUBLE, 2) AS bmi,
  CASE WHEN age > 0 AND age <= 30 THEN 'Young' WHEN age > 30 AND age <= 50 THEN 'Middle-aged'
    WHEN age > 50 AND age <= 70 THEN 'Senior' WHEN age > 70 AND age <= 100 THEN 'Elderly' END AS age_category,
  platelet_count / (wbc_count * 0.3::DOUBLE + 1e-10::DOUBLE) AS platelet_lymphocyte_ratio,
  {life} AS lifestyle_risk_score FROM cln),
fe AS (SELECT *, {score} AS clinical_risk_score FROM fe0)"""


@query("inject_anomalies_patients", f"WITH {_damage_sql()} SELECT * FROM dmg")
def q_inject_anomalies_patients(spark, d):
    return damaged(spark, d)


@query("clean_patients", f"WITH {_clean_sql()} SELECT * FROM cln")
def q_clean_patients(spark, d):
    return cleaned(spark, d)


@query("engineer_patients", f"""WITH {_engineer_sql()}
SELECT patient_id, bmi, age_category, platelet_lymphocyte_ratio, lifestyle_risk_score, clinical_risk_score FROM fe""")
def q_engineer_patients(spark, d):
    # both sides perform the same IEEE operations in the same order, so the
    # ratios are compared unrounded (rounding would only add tie risk)
    fe = Q.engineer_features(cleaned(spark, d))
    return fe.select("patient_id", "bmi", "age_category", "platelet_lymphocyte_ratio",
                     "lifestyle_risk_score", "clinical_risk_score")


@query("scoring_features_patients", f"""WITH {_engineer_sql()}
SELECT patient_id, CASE WHEN age <= 30 THEN 'Young' WHEN age <= 50 THEN 'Middle-aged' WHEN age <= 70 THEN 'Senior'
  ELSE 'Elderly' END AS age_category, clinical_risk_score FROM fe""")
def q_scoring_features_patients(spark, d):
    fe = Q.engineer_features(cleaned(spark, d), scoring=True)
    return fe.select("patient_id", "age_category", "clinical_risk_score")


@query("split_patients", f"""WITH {_clean_sql()}
SELECT patient_id, cancer, CASE WHEN {mark_sql(['patient_id'], 42, 0.2, ['cancer'])} THEN 'test' ELSE 'train' END AS split
FROM cln""")
def q_split_patients(spark, d):
    return Q.prepare_split(cleaned(spark, d)).select("patient_id", "cancer", "split")


def _audit_sql(stage, table, cols):
    nulls = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in Q.NULL_COLUMNS)
    collist = ", ".join(cols)
    return f"""SELECT '{stage}' AS stage, count(*) AS rows, CAST(sum({nulls}) AS BIGINT) AS null_cells,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT {collist} FROM {table})) AS duplicates,
  CAST(count_if(NOT (age BETWEEN 18 AND 90) OR NOT (tumor_size_cm BETWEEN 0.5 AND 10)) AS BIGINT) AS out_of_range
  FROM {table}"""


@query("anomaly_audit_patients", f"""WITH {_clean_sql()}
{_audit_sql('generated', 'p', COLS)} UNION ALL {_audit_sql('damaged', 'dmg', COLS)}
UNION ALL {_audit_sql('cleaned', 'cln', [c for c in COLS if c != 'patient_id'])}""")
def q_anomaly_audit_patients(spark, d):
    stages = {"generated": patients(spark, d), "damaged": damaged(spark, d).drop("copy_no"),
              "cleaned": cleaned(spark, d).drop("patient_id", "source_key", "copy_no")}
    return PR.anomaly_audit(stages, Q.NULL_COLUMNS, Q.CLEAN_RANGES)
