"""Joins, set operations and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach_labels(x: DataFrame, y: DataFrame, key, how: str = "inner") -> DataFrame:
    """Labels (or predictions) attached by key, never by position. The
    planner (with AQE) picks broadcast, shuffle-hash or sort-merge."""
    return x.join(y, key if isinstance(key, (list, tuple)) else [key], how)


def drop_keys(df: DataFrame, keys: DataFrame, key) -> DataFrame:
    """Delete rows whose key is in ``keys`` (left anti join)."""
    return df.join(keys.select(key).distinct(), key, "left_anti")


def lookup_table(df: DataFrame, table: DataFrame, key: str, value: str, default=None,
                 out: str | None = None, table_key: str | None = None) -> DataFrame:
    """J3 (table form): left join a lookup table, unknown keys get ``default``.
    A key that the table repeats has its smallest value, so rows never multiply.
    Whether the table is broadcast is left to the planner, which knows its size."""
    tk = table_key or key
    t = table.groupBy(F.col(tk).alias("_rf_lk")).agg(F.min(value).alias("_rf_lv"))
    j = df.join(t, df[key] == t["_rf_lk"], "left")
    return j.withColumn(out or value, F.coalesce(F.col("_rf_lv"), F.lit(default))).drop("_rf_lk", "_rf_lv")


def with_constants(df: DataFrame, consts: DataFrame, fill: bool = True) -> DataFrame:
    """Apply a one-row aggregate (e.g. medians) to every row. The row is
    read once and applied as literals; with ``fill`` the constants fill nulls
    of the same-named columns, otherwise they are added as ``<name>_const``."""
    rows = consts.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("with_constants needs a one-row frame")
    row = rows[0].asDict()
    types = {f.name: f.dataType for f in df.schema.fields}
    if fill:
        return df.withColumns({
            c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in row.items() if c in types and v is not None})
    return df.withColumns({f"{c}_const": F.lit(v) for c, v in row.items()})


def append(a: DataFrame, b: DataFrame) -> DataFrame:
    """Concatenate rows by column name."""
    return a.unionByName(b, allowMissingColumns=True)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Remove full-row copies."""
    return df.dropDuplicates()


def threshold_set(fixed: Sequence[float], *extra: Column) -> Column:
    """Sorted distinct union of fixed thresholds and found ones."""
    return F.array_sort(F.array_distinct(F.array(*[F.lit(float(t)) for t in fixed],
                                                 *[e.cast("double") for e in extra])))


def dedup_keep_first(df: DataFrame, subset: Sequence[str] | None = None,
                     order: Sequence[str] | None = None) -> DataFrame:
    """One row per ``subset`` group, the first in ``order``. Uses a
    min-of-struct aggregate (map-side partial), not a window, so a group with
    a third of the rows is not one task. Without ``subset``: dropDuplicates."""
    if not subset:
        return df.dropDuplicates()
    order = list(order or [])
    rest = [c for c in df.columns if c not in subset and c not in order]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest]).alias("_rf_first")
    g = df.groupBy(*subset).agg(F.min(packed).alias("_rf_first"))
    return g.select(*subset, *[F.col(f"_rf_first.{c}").alias(c) for c in order + rest]).select(*df.columns)
