"""Sources and sinks (S1, S3-S10): declared schemas, NaN mapped to NULL at
read, Parquet by default. Run metadata and model bundles are tiny and use
Spark's own JSON and ``PipelineModel`` formats."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN compares true in Spark (NaN > 50); the library treats it as missing."""
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    if not fl:
        return df
    return df.withColumns({c: F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c)) for c in fl})


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str = "parquet", null_value: str = "", where: str | None = None,
               **options) -> DataFrame | None:
    """Scan a table; a missing path gives ``None`` (and a message). NaN becomes null.

    A condition in ``where`` is put on the columns as stored, so that it reaches the
    scan, and again on the cleaned ones, where NaN no longer satisfies it."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("nullValue", null_value)
        if schema is None:
            reader = reader.option("inferSchema", True)
    for k, v in options.items():
        reader = reader.option(k, v)
    try:
        df = reader.load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            print(f"read_table: '{path}' not found")
            return None
        raise
    if where is None:
        return nan_to_null(df)
    return nan_to_null(df.where(where)).where(where)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, **options) -> str:
    """S3: persist a stage table, split or report; NaN is stored as null."""
    w = nan_to_null(df).write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)
    return path


# Run metadata: arrays of names plus a map of model name to its metrics.
METRIC_STRUCT = T.StructType([T.StructField(n, T.DoubleType()) for n in ("accuracy", "roc_auc", "f1_score")])
META_SCHEMA = T.StructType([
    T.StructField("models_available", T.ArrayType(T.StringType())),
    T.StructField("best_model", T.StringType()),
    T.StructField("feature_names", T.ArrayType(T.StringType())),
    T.StructField("categorical_columns", T.ArrayType(T.StringType())),
    T.StructField("numerical_columns", T.ArrayType(T.StringType())),
    T.StructField("training_date", T.StringType()),
    T.StructField("performance", T.MapType(T.StringType(), METRIC_STRUCT)),
])


def write_run_metadata(spark: SparkSession, meta: dict, path: str) -> str:
    """One-row JSON file of feature names and run metadata."""
    spark.createDataFrame([meta], META_SCHEMA).coalesce(1).write.mode("overwrite").json(path)
    return path


def read_run_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Load run metadata with its declared schema (object or array files)."""
    return spark.read.schema(META_SCHEMA).option("multiLine", True).json(path)


def model_slug(name: str) -> str:
    return name.lower().replace(" ", "_")


def save_models(models: dict, directory: str, best: str | None = None) -> dict:
    """One ``PipelineModel`` directory per model (slug names) plus 'best_model'."""
    out = {}
    for name, m in models.items():
        p = os.path.join(directory, f"model_{model_slug(name)}")
        m.write().overwrite().save(p)
        out[name] = p
    if best is not None:
        p = os.path.join(directory, "best_model")
        models[best].write().overwrite().save(p)
        out["best_model"] = p
    return out


def load_model(directory: str, names: Sequence[str] = ("best_model",)):
    """The first of ``names`` that is there; ``None`` if none is. A model that
    is there but cannot be read is an error."""
    from pyspark.ml import PipelineModel
    spark = SparkSession.active()
    for n in names:
        p = os.path.join(directory, n if n == "best_model" else f"model_{model_slug(n)}")
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return PipelineModel.load(p)
    return None


def read_records(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str | None = None,
                 multi_line: bool = False) -> DataFrame:
    """CSV (header) or JSON records. JSON Lines by default; with
    ``multi_line`` each file is one document, an object or an array (an array
    yields one row per element)."""
    fmt = fmt or ("csv" if path.endswith(".csv") else "json")
    if fmt == "csv":
        return read_table(spark, path, schema, "csv")
    return nan_to_null(spark.read.schema(schema).option("multiLine", multi_line).json(path))


def explode_batch(df: DataFrame, col: str, number_col: str = "record_no", keep: Sequence[str] = ()) -> DataFrame:
    """One row per element of an array column, numbered from 1; struct
    elements are flattened into columns."""
    x = df.select(*keep, F.posexplode(F.col(col)).alias("_rf_pos", "_rf_el"))
    el_type = [f.dataType for f in x.schema.fields if f.name == "_rf_el"][0]
    items = ["_rf_el.*"] if isinstance(el_type, T.StructType) else [F.col("_rf_el").alias("value")]
    return x.select(*keep, (F.col("_rf_pos") + 1).alias(number_col), *items)


def metrics_frame(spark: SparkSession, rows: list[dict], schema: T.StructType | None = None) -> DataFrame:
    """List of result dicts as a table; non-scalar fields are dropped."""
    scalar = (int, float, str, bool, type(None))
    clean = [{k: v for k, v in r.items() if isinstance(v, scalar)} for r in rows]
    if schema is not None:
        return spark.createDataFrame(clean, schema)
    return spark.createDataFrame(clean)
