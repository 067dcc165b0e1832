"""Keyed table generation.

Each generated cell is a pure function of (key, seed, column position): 52
bits of an md5 of the key and seed, one md5 per two columns, so a table generated from the
keys of any DataFrame is the same in any partitioning and grows with it.
Decimal columns are drawn on an integer grid and divided once, so every
value is the exact double of a short decimal (no rounding ties).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows that a task generates, but for a few of dealing out; what is fitted on them later reads a partition a task (about 70 MB in boosting).
PART_KEYS = 100_000


def _unit(key: str, seed, slot: int) -> str:
    """Uniform in [0, 1) for generated column number ``slot``: one md5 of
    (key, seed, slot // 2) serves two columns, each reading its own 13 hex
    digits (52 bits). Both columns share the md5 call through Spark's
    common-subexpression elimination."""
    h = f"md5(concat_ws(':', CAST(`{key}` AS STRING), '{seed}/{slot // 2}'))"
    start = 1 + 13 * (slot % 2)
    return f"(CAST(CAST(conv(substring({h}, {start}, 13), 16, 10) AS BIGINT) AS DOUBLE) / {float(1 << 52)!r}D)"


def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else repr(v)


def column_sql(key: str, seed, slot: int, kind: str, **p) -> str:
    """Spark SQL text of generated column number ``slot`` (one parse, no
    per-call round trips when building wide tables)."""
    u = _unit(key, seed, slot)
    if kind == "offset":  # sequence: start + key
        return f"CAST(`{key}` + {p.get('start', 0)} AS {p.get('type', 'bigint')})"
    if kind == "int":  # inclusive lo..hi
        lo, hi = p["lo"], p["hi"]
        return f"CAST({lo} + floor({u} * {float(hi - lo + 1)!r}D) AS {p.get('type', 'int')})"
    if kind == "choice":
        vals = ", ".join(_lit(v) for v in p["values"])
        return f"element_at(array({vals}), CAST(floor({u} * {float(len(p['values']))!r}D) + 1 AS INT))"
    if kind == "weighted":
        parts, acc = [], 0.0
        items = list(p["weights"].items())
        for v, w in items[:-1]:
            acc += w
            parts.append(f"WHEN {u} < {acc!r}D THEN {_lit(v)}")
        return f"CASE {' '.join(parts)} ELSE {_lit(items[-1][0])} END"
    if kind == "grid":  # uniform over lo..hi on a 10^-decimals grid
        scale = 10 ** p["decimals"]
        lo, hi = round(p["lo"] * scale), round(p["hi"] * scale)
        return f"(CAST({lo} + floor({u} * {float(hi - lo + 1)!r}D) AS DOUBLE) / {float(scale)!r}D)"
    raise ValueError(f"unknown column kind {kind!r}")


def column_expr(key: str, seed, slot: int, kind: str, **p) -> Column:
    return F.expr(column_sql(key, seed, slot, kind, **p))


def spread(keys: DataFrame, key: str) -> DataFrame:
    """Generation costs one md5 per cell, far more than scanning a key, and a
    generated row is many times as wide as its key. A key table read as fewer
    partitions than the cluster has cores (one small file is one task), or with
    more than ``PART_KEYS`` keys in any one partition, is spread round-robin first. Only
    the key column is shuffled; a key table that is already split is left as it is."""
    cores = keys.sparkSession.sparkContext.defaultParallelism
    per_part = keys.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    n, largest = per_part.agg(F.sum("n"), F.max("n")).first()
    if keys.rdd.getNumPartitions() >= cores and (largest or 0) <= PART_KEYS:
        return keys
    return keys.select(key).repartition(max(cores, -(-(n or 0) // PART_KEYS)))


def generate_table(keys: DataFrame, key: str, spec: list[tuple], seed, keep_key: bool = False) -> DataFrame:
    """Rows from per-column specs ``(name, kind, params)``, one per key row."""
    exprs = [f"{column_sql(key, seed, i, kind, **params)} AS `{name}`"
             for i, (name, kind, params) in enumerate(spec)]
    return spread(keys, key).selectExpr(*([f"`{key}`"] if keep_key else []), *exprs)


def generate_range(spark: SparkSession, n: int, spec: list[tuple], seed) -> DataFrame:
    """Same as :func:`generate_table` over keys ``0..n-1``."""
    return generate_table(spark.range(n).withColumnRenamed("id", "_rf_key"), "_rf_key", spec, seed)


def _flag(name):
    return (name, "choice", {"values": [0, 1]})


# The record table's column domains, in their natural order.
PATIENT_SPEC = [
    ("patient_id", "offset", {"start": 1000}),
    ("age", "int", {"lo": 18, "hi": 89}),
    ("gender", "choice", {"values": ["Male", "Female"]}),
    ("blood_group", "choice", {"values": ["A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-"]}),
    ("ethnicity", "choice", {"values": ["Asian", "African", "Caucasian", "Hispanic"]}),
    ("height_cm", "int", {"lo": 120, "hi": 199}),
    ("weight_kg", "int", {"lo": 30, "hi": 149, "type": "double"}),
    ("smoking_status", "choice", {"values": ["Never", "Former", "Current"]}),
    ("alcohol_consumption", "choice", {"values": ["Never", "Moderate", "High"]}),
    _flag("family_history_cancer"),
    ("physical_activity_level", "choice", {"values": ["Low", "Medium", "High"]}),
    ("diet_quality", "choice", {"values": ["Poor", "Average", "Good"]}),
    _flag("diabetes"), _flag("hypertension"), _flag("asthma"), _flag("cardiac_disease"),
    _flag("prior_radiation_exposure"),
    _flag("unexplained_weight_loss"), _flag("persistent_fatigue"), _flag("chronic_pain"),
    _flag("abnormal_bleeding"), _flag("persistent_cough"), _flag("lump_presence"),
    ("hemoglobin_level", "grid", {"lo": 8, "hi": 17, "decimals": 1}),
    ("wbc_count", "int", {"lo": 3000, "hi": 11999}),
    ("platelet_count", "int", {"lo": 150000, "hi": 449999}),
    ("tumor_marker_level", "grid", {"lo": 0.5, "hi": 100, "decimals": 2}),
    _flag("imaging_abnormality"),
    ("tumor_size_cm", "grid", {"lo": 0.5, "hi": 10, "decimals": 2}),
    ("cancer", "weighted", {"weights": {1: 0.3, 0: 0.7}}),
]

CATEGORICAL = ["gender", "blood_group", "ethnicity", "smoking_status", "alcohol_consumption",
               "physical_activity_level", "diet_quality"]
LABEL = "cancer"
KEY = "patient_id"


def patients_from(keys: DataFrame, key: str, seed=42) -> DataFrame:
    """Record table (30 columns) with one row per row of ``keys``."""
    return generate_table(keys, key, PATIENT_SPEC, seed)
