"""Table profiling aggregates (A1-A9, A23). Each is one aggregate pass with
Spark's partial/final (map-side) aggregation; outputs are small tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.blocks import masked_correlation, radix_medians


def _unpivot(wide: DataFrame, cols: Sequence[str], fields: dict) -> DataFrame:
    """One row per column from a one-row wide aggregate: ``fields`` maps the
    output field to a format string of the wide column name."""
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[F.col(fmt.format(c)).alias(f) for f, fmt in fields.items()])
        for c in cols])).alias("r")
    return wide.select(rows).select("r.*")


def shape(df: DataFrame) -> DataFrame:
    """A1: rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def _value_counts(df: DataFrame, cols: Sequence[str], kind: str) -> DataFrame:
    """(column_name, value, n) of all non-null values, counted per column."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast(kind).alias("value")) for c in cols]))
    long = df.select(cells.alias("c")).select("c.*").where(F.col("value").isNotNull())
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def column_medians(df: DataFrame, cols: Sequence[str], exact: bool = True, accuracy: int = 100000) -> DataFrame:
    """A2: median per column (mean of the middle two), one row. ``exact`` selects by
    radix passes over all columns at once, which send only counts;
    ``exact=False`` uses ``percentile_approx``."""
    if not exact:
        return df.agg(*[F.percentile_approx(F.col(c), 0.5, accuracy).cast("double").alias(c) for c in cols])
    medians = radix_medians(df, cols)
    return df.sparkSession.range(1).select(*[F.lit(m).cast("double").alias(c) for c, m in zip(cols, medians, strict=True)])


def column_modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A3: most frequent non-null value per column, smallest on ties, one row.
    Values are counted per column first; the smallest of the most frequent is then
    an ordinary aggregate over the counts."""
    kinds, rows = dict(df.dtypes), None
    for kind in sorted({kinds[c] for c in cols}):
        own = [c for c in cols if kinds[c] == kind]
        counts = _value_counts(df, own, kind)
        top = counts.groupBy("column_name").agg(F.min(F.struct((-F.col("n")).alias("less"), "value")).alias("top"))
        part = top.agg(*[F.max(F.when(F.col("column_name") == c, F.col("top.value"))).alias(c) for c in own])
        part = part.select(*[F.col(c) if c in own else F.lit(None).cast(kinds[c]).alias(c) for c in cols])
        rows = part if rows is None else rows.unionAll(part)
    return rows.agg(*[F.max(c).alias(c) for c in cols])  # a row per type


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A4: nulls per column (one row per column)."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _unpivot(wide, cols, {"nulls": "{}"})


def duplicate_count(df: DataFrame) -> DataFrame:
    """A5: rows equal to an earlier row in all columns. The group-by uses
    map-side partial counts, so one very common row is not a hot task."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicates"))


def range_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Min and max of each column (one row per column, as double)."""
    wide = df.agg(*[F.min(c).cast("double").alias(f"min_{c}") for c in cols],
                  *[F.max(c).cast("double").alias(f"max_{c}") for c in cols])
    return _unpivot(wide, cols, {"min_value": "min_{}", "max_value": "max_{}"})


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair (pairwise-complete), long form.
    One aggregate of p*(p-1)/2 ``corr`` terms; meant for up to ~50 columns."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}") for a, b in pairs])
    rows = F.explode(F.array(*[
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"{a}__{b}").alias("corr"))
        for a, b in pairs])).alias("r")
    return wide.select(rows).select("r.*")


def correlation_wide(df: DataFrame, values: str, names: Sequence[str]) -> DataFrame:
    """A9 for many columns: Pearson correlation of every pair of entries of an array or
    vector column, pairwise complete, long form (see :func:`blocks.masked_correlation`)."""
    if not df.schema[values].dataType.typeName().startswith("array"):
        df = df.select(vector_to_array(values).alias(values))
    return masked_correlation(df, values, names)


def stage_audit(stage: str, df: DataFrame, null_cols: Sequence[str] = (),
                range_cols: dict | None = None) -> DataFrame:
    """One audit row for one stage: rows, null cells, duplicate rows and
    out-of-range rows. Two passes: one aggregate and :func:`duplicate_count`."""
    outside = None
    for c, (lo, hi) in (range_cols or {}).items():
        k = ~F.col(c).between(lo, hi)
        outside = k if outside is None else outside | k
    null_total = None
    for c in null_cols:
        k = F.col(c).isNull().cast("long")
        null_total = k if null_total is None else null_total + k
    agg = df.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.sum(null_total) if null_total is not None else F.lit(0)).cast("long").alias("null_cells"),
        (F.count_if(outside) if outside is not None else F.lit(0)).cast("long").alias("out_of_range"),
        F.lit(0).cast("long").alias("duplicates"))
    dups = duplicate_count(df).select(
        *[F.lit(0).cast("long").alias(c) for c in ("rows", "null_cells", "out_of_range")], "duplicates")
    # two one-row aggregates combined by a union and a sum (no join needed)
    both = agg.unionByName(dups).agg(*[F.sum(c).alias(c) for c in ("rows", "null_cells", "duplicates",
                                                                    "out_of_range")])
    return both.select(F.lit(stage).alias("stage"), "rows", "null_cells", "duplicates", "out_of_range")


def anomaly_audit(stages: dict, null_cols: Sequence[str] = (), range_cols: dict | None = None) -> DataFrame:
    """Union of per-stage audit rows (stage name -> DataFrame)."""
    out = None
    for name, df in stages.items():
        row = stage_audit(name, df, null_cols, range_cols)
        out = row if out is None else out.unionByName(row)
    return out
