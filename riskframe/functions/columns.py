"""Projections, filters and predicates (P1-P14). Schema work reads
``df.schema`` only; row work is Column expressions Catalyst can push down."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop key/label columns (absent names are ignored)."""
    return df.drop(*[c for c in cols if c in df.columns])


def columns_by_type(df: DataFrame, kind: str) -> list[str]:
    """P2: 'categorical' (string) or 'numeric' columns, from the schema only."""
    out = []
    for f in df.schema.fields:
        is_num = isinstance(f.dataType, _NUMERIC)
        if (kind == "numeric" and is_num) or (kind == "categorical" and isinstance(f.dataType, T.StringType)):
            out.append(f.name)
    return out


def discrete_columns(df: DataFrame, max_distinct: int = 5, exact: bool = True) -> DataFrame:
    """Per column, its distinct count and whether it is discrete (string,
    or at most ``max_distinct`` distinct values). One aggregate pass."""
    cols = df.columns
    cnt = F.count_distinct if exact else F.approx_count_distinct
    wide = df.agg(*[cnt(F.col(c)).alias(c) for c in cols])
    strings = set(columns_by_type(df, "categorical"))
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("long").alias("n_distinct"),
                 F.lit(c in strings).alias("is_string")) for c in cols])).alias("r")
    return wide.select(rows).select("r.*").withColumn(
        "is_discrete", F.col("is_string") | (F.col("n_distinct") <= max_distinct))


def filter_ranges(df: DataFrame, ranges: dict) -> DataFrame:
    """Keep rows inside every inclusive [lo, hi]; null fails."""
    cond = None
    for c, (lo, hi) in ranges.items():
        k = F.col(c).between(lo, hi)
        cond = k if cond is None else cond & k
    return df.where(cond) if cond is not None else df


def cast_columns(df: DataFrame, ints: Sequence[str] = (), doubles: Sequence[str] = (),
                 int_type: str = "int") -> DataFrame:
    """P5: casts, skipping absent columns; the integer cast truncates toward 0."""
    new = {c: F.col(c).cast(int_type) for c in ints if c in df.columns}
    new.update({c: F.col(c).cast("double") for c in doubles if c in df.columns})
    return df.withColumns(new) if new else df


def set_where(df: DataFrame, mask: Column, values: dict) -> DataFrame:
    """Overwrite cells on the rows where ``mask`` holds."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({
        c: F.when(mask, F.lit(v).cast(types[c])).otherwise(F.col(c)) for c, v in values.items()})


def add_default_column(df: DataFrame, col: str, value) -> DataFrame:
    """Fill an absent, null or zero field with ``value``."""
    if col not in df.columns:
        return df.withColumn(col, F.lit(value))
    return df.withColumn(col, F.coalesce(F.nullif(F.col(col), F.lit(0)), F.lit(value)))


def resolve_id_column(df: DataFrame, want: str, candidates: Sequence[str], order_cols: Sequence[str],
                      start: int = 1000, out: str = "patient_id") -> tuple[DataFrame, str]:
    """The first existing id column among ``want`` and ``candidates``;
    otherwise sequential ids from ``start`` in ``order_cols`` order (W5)."""
    for c in [want, *candidates]:
        if c in df.columns:
            return df, c
    from riskframe.operators.prefix import sequential_id
    return sequential_id(df, list(order_cols), out=out, start=start), out


def normalize_columns(df: DataFrame) -> DataFrame:
    """Column names lower-cased with spaces turned to underscores."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def coerce_numeric(df: DataFrame, types: dict) -> DataFrame:
    """P10: text to the declared numeric type; unparsable text gives null."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS {t})") for c, t in types.items() if c in df.columns})


# Text accepted as a set flag.
TRUTHY = ("1", "true", "yes")


def parse_flags(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P11: '1'/'true'/'yes' (trimmed, any case) and numbers equal to 1 -> 1,
    anything else -> 0; an absent column is added as 0."""
    new, kinds = {}, dict(df.dtypes)
    for c in cols:
        if kinds.get(c, "").startswith(("int", "bigint", "smallint", "tinyint", "float", "double", "decimal")):
            new[c] = F.coalesce(F.col(c) == 1, F.lit(False)).cast("int")
        elif c in df.columns:
            new[c] = F.coalesce(F.lower(F.trim(F.col(c).cast("string"))).isin(*TRUTHY), F.lit(False)).cast("int")
        else:
            new[c] = F.lit(0)
    return df.withColumns(new)


def validate_records(df: DataFrame, required: Sequence[str] = (), allowed: dict | None = None,
                     ranges: dict | None = None, reasons_col: str = "reasons") -> DataFrame:
    """Adds an array of failed-rule messages; valid rows have an empty
    array. Split with :func:`split_valid`."""
    checks = []
    for c in required:
        checks.append(F.when(F.col(c).isNull(), F.lit(f"{c}: missing")))
    for c, vals in (allowed or {}).items():
        checks.append(F.when(F.col(c).isNotNull() & ~F.col(c).isin(*vals), F.lit(f"{c}: not allowed")))
    for c, (lo, hi) in (ranges or {}).items():
        checks.append(F.when(F.col(c).isNotNull() & ~F.col(c).between(lo, hi), F.lit(f"{c}: out of range")))
    arr = F.filter(F.array(*checks), lambda x: x.isNotNull()) if checks else F.array().cast("array<string>")
    return df.withColumn(reasons_col, arr)


def split_valid(checked: DataFrame, reasons_col: str = "reasons") -> tuple[DataFrame, DataFrame]:
    ok = F.size(F.col(reasons_col)) == 0
    return checked.where(ok).drop(reasons_col), checked.where(~ok)


def report_projection(df: DataFrame, id_col: str = "patient_id", label: str = "label",
                      pred: str = "prediction", prob: str = "probability") -> DataFrame:
    """Patient_No, Actual, Predicted, Probability (4 places, half-even), Correct."""
    return df.select(
        F.col(id_col).alias("Patient_No"), F.col(label).cast("int").alias("Actual"),
        F.col(pred).cast("int").alias("Predicted"), F.bround(F.col(prob), 4).alias("Probability"),
        (F.col(pred) == F.col(label)).cast("int").alias("Correct"))


def with_predictions(df: DataFrame, label: str = "label", pred: str = "prediction",
                     prob: str = "probability") -> DataFrame:
    """Predicted class, probability, correctness and percent (2 places)."""
    return df.withColumns({
        "predicted_cancer": F.col(pred).cast("int"),
        "cancer_probability": F.col(prob),
        "prediction_correct": F.col(pred) == F.col(label),
        "probability_rounded": F.bround(F.col(prob) * 100, 2),
    })
