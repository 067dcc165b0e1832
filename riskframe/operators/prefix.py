"""Ordered prefix sums and row numbers without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one task.
Here the ordered key space is cut into contiguous ranges ("buckets"); each
bucket is windowed on its own and the bucket totals, a row per bucket, are
prefix-summed and joined back as offsets. Up to ``TREE_BUCKETS`` buckets are cut
at boundary tuples from a sample, as literals in the plan; beyond that the rows
are range-partitioned and written once to the checkpoint folder, and the
partition is the bucket.

The boundaries only balance the buckets: the result is exact for any
boundaries, so it does not depend on the sample, on partitioning or on
recomputation. The tuple includes the partition columns, so one hot group is
still split over many buckets. Nulls come first, in order columns as in
partition columns, where they are a group of their own. Order tuples must be
unique (add a tie-break column) for the row-based frame to be deterministic.
"""

from __future__ import annotations

import math
from functools import cmp_to_key

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import cut_lineage

# Fixed tuning values (per-bucket size target, buckets cut by literals).
DEFAULT_ROWS_PER_BUCKET = 500_000
TREE_BUCKETS = 1024
SAMPLE_PER_BUCKET = 32
_BUCKET = "_rf_bucket"


def _rows_per_bucket(df: DataFrame) -> int:
    conf = df.sparkSession.conf.get("riskframe.prefix.rowsPerBucket", None)
    return int(conf) if conf else DEFAULT_ROWS_PER_BUCKET


def _cmp_tuple(a, b) -> int:
    for x, y in zip(a, b):
        if x == y:
            continue
        if x is None:
            return -1
        if y is None:
            return 1
        return -1 if x < y else 1
    return 0


def choose_boundaries(df: DataFrame, cols: list[str], buckets: int, rows: int, seed: int = 7) -> list[tuple]:
    """Sorted boundary tuples cutting ``cols`` space into about ``buckets``
    ranges, from a sample of about ``buckets * SAMPLE_PER_BUCKET`` of all rows."""
    if buckets <= 1 or rows == 0:
        return []
    frac = min(1.0, buckets * SAMPLE_PER_BUCKET / rows)
    sample = df.select(*cols)
    if frac < 1.0:
        sample = sample.sample(False, frac, seed)
    got = [tuple(r) for r in sample.collect()]
    if not got:
        return []
    got.sort(key=cmp_to_key(_cmp_tuple))
    step = len(got) / buckets
    out: list[tuple] = []
    for i in range(1, buckets):
        t = got[min(len(got) - 1, int(i * step))]
        if not out or _cmp_tuple(out[-1], t) < 0:
            out.append(t)
    return out


def bucket_expr(df: DataFrame, cols: list[str], bounds: list[tuple]) -> Column:
    """Bucket index = number of boundaries <= the row's tuple, by a balanced
    binary search of CASE expressions (log2(B) comparisons per row). Tuples are
    compared as structs, whose null fields come first."""
    if not bounds:
        return F.lit(0)
    types = {f.name: f.dataType for f in df.schema.fields}
    x = F.struct(*[F.col(c) for c in cols])

    def lit_of(t):
        return F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(cols, t)])

    def build(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(x < lit_of(bounds[mid]), build(lo, mid)).otherwise(build(mid + 1, hi))

    return build(0, len(bounds))


def _with_bucket(df, order_cols, partition_cols, buckets):
    cols = list(partition_cols) + list(order_cols)
    n = df.count()
    if buckets is None:
        buckets = max(1, math.ceil(n / _rows_per_bucket(df)))
    if buckets > TREE_BUCKETS:
        ranged = df.repartitionByRange(buckets, *[F.col(c).asc_nulls_first() for c in cols])
        return cut_lineage(ranged.withColumn(_BUCKET, F.spark_partition_id()))
    return df.withColumn(_BUCKET, bucket_expr(df, cols, choose_boundaries(df, cols, buckets, n)))


def _join_offsets(x: DataFrame, offsets: DataFrame, partition_cols) -> DataFrame:
    """Adds the offset columns by bucket and partition columns, null equal to null."""
    keys = [*partition_cols, _BUCKET]
    right = offsets.withColumnsRenamed({k: f"{k}_rf_key" for k in keys})
    if not partition_cols:
        right = F.broadcast(right)  # a row per bucket
    on = [x[k].eqNullSafe(right[f"{k}_rf_key"]) for k in keys]
    return x.join(right, on, "inner").drop(*[f"{k}_rf_key" for k in keys])


def running_sum(df: DataFrame, order_cols: list[str], values: dict[str, Column | str],
                partition_cols: list[str] | tuple = (), buckets: int | None = None,
                inclusive: bool = True) -> DataFrame:
    """Add ``name = sum(value)`` over rows ordered by ``order_cols`` (within
    ``partition_cols``), inclusive of the current row unless ``inclusive`` is
    false. ``values`` maps output name to a column or column name."""
    vals = {k: (F.col(v) if isinstance(v, str) else v) for k, v in values.items()}
    tmp = {k: f"_rf_v_{i}" for i, k in enumerate(vals)}
    base = df.withColumns({tmp[k]: v for k, v in vals.items()})
    x = _with_bucket(base, order_cols, partition_cols, buckets)
    keys = list(partition_cols) + [_BUCKET]
    totals = x.groupBy(*keys).agg(*[F.sum(tmp[k]).alias(tmp[k]) for k in vals])
    wt = Window.partitionBy(*partition_cols).orderBy(_BUCKET).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, *[
        F.coalesce(F.sum(tmp[k]).over(wt), F.lit(0)).alias(f"{tmp[k]}_off") for k in vals])
    end = Window.currentRow if inclusive else -1
    w = Window.partitionBy(*keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, end)
    out = _join_offsets(x, offsets, partition_cols).withColumns({
        k: F.coalesce(F.sum(tmp[k]).over(w), F.lit(0)) + F.col(f"{tmp[k]}_off") for k in vals})
    drop = [_BUCKET] + list(tmp.values()) + [f"{t}_off" for t in tmp.values()]
    return out.drop(*drop)


def sequential_id(df: DataFrame, order_cols: list[str], out: str = "row_id", start: int = 0,
                  partition_cols: list[str] | tuple = (), buckets: int | None = None) -> DataFrame:
    """Dense consecutive numbering ``start, start+1, ...`` in ``order_cols``
    order (per ``partition_cols`` group), computed bucket-parallel."""
    x = _with_bucket(df, order_cols, partition_cols, buckets)
    keys = list(partition_cols) + [_BUCKET]
    totals = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rf_n"))
    wt = Window.partitionBy(*partition_cols).orderBy(_BUCKET).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, F.coalesce(F.sum("_rf_n").over(wt), F.lit(0)).alias("_rf_off"))
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    res = _join_offsets(x, offsets, partition_cols).withColumn(
        out, (F.row_number().over(w) - 1 + F.col("_rf_off") + F.lit(start)).cast("bigint"))
    return res.drop(_BUCKET, "_rf_off")


def next_values(df: DataFrame, order_cols: list[str], values: dict[str, str], buckets: int | None = None) -> DataFrame:
    """Add ``name = value of the next row`` in ``order_cols`` order (null after the last). A
    bucket's last row takes it from the first row of the next bucket, a row per bucket."""
    vals = F.struct(*[F.col(c).alias(k) for k, c in values.items()])
    x = _with_bucket(df.withColumn("_rf_vals", vals), order_cols, (), buckets)
    heads = x.groupBy(_BUCKET).agg(F.min(F.struct(*order_cols, "_rf_vals")).getField("_rf_vals").alias("_rf_head"))
    after = heads.select(_BUCKET, F.lead("_rf_head").over(Window.orderBy(_BUCKET)).alias("_rf_after"))
    w = Window.partitionBy(_BUCKET).orderBy(*order_cols)
    out = _join_offsets(x.withColumn("_rf_next", F.lead("_rf_vals").over(w)), after, ())
    out = out.withColumn("_rf_next", F.coalesce("_rf_next", "_rf_after"))
    return out.withColumns({k: F.col("_rf_next").getField(k) for k in values}).drop(_BUCKET, "_rf_vals", "_rf_next", "_rf_after")
