"""Sorts, top-k and cumulative shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.prefix import running_sum


def sort_report(df: DataFrame, by: str = "Patient_No") -> DataFrame:
    """Ascending by id (range-partitioned sort)."""
    return df.orderBy(F.col(by).asc())


def head(df: DataFrame, n: int = 10, by: str = "Patient_No") -> DataFrame:
    """First n of the sorted report (TakeOrderedAndProject, no full sort)."""
    return df.orderBy(F.col(by).asc()).limit(n)


def top_features(imp: DataFrame, n: int, value: str = "importance", name: str = "feature",
                 absolute: bool = False) -> DataFrame:
    """The n largest by value (or |value|), ties by name."""
    key = F.abs(F.col(value)) if absolute else F.col(value)
    return imp.orderBy(key.desc(), F.col(name).asc()).limit(n)


def top_loadings(loadings: DataFrame, n: int = 15, components: int = 5) -> DataFrame:
    """T4: features by max |loading| over the first ``components`` components.
    ``loadings`` has feature, component (0-based), loading."""
    g = (loadings.where(F.col("component") < components)
         .groupBy("feature").agg(F.max(F.abs("loading")).alias("max_abs_loading")))
    return g.orderBy(F.col("max_abs_loading").desc(), F.col("feature")).limit(n)


def cumulative_share(df: DataFrame, order: str, value: str, out: str = "cumulative") -> DataFrame:
    """Running sum of ``value`` in ``order`` order (explained-variance
    ratios by component); bucket-parallel via :func:`running_sum`."""
    return running_sum(df, [order], {out: value})


def components_for(cum: DataFrame, threshold: float = 0.95, order: str = "component",
                   cumulative: str = "cumulative") -> DataFrame:
    """The first component count whose cumulative share reaches the
    threshold, else all of them."""
    return cum.agg(F.coalesce(F.min(F.when(F.col(cumulative) >= threshold, F.col(order))),
                              F.max(F.col(order))).alias("n_components"))
