"""E12-E15 for wide tables: leading principal components without a d x d matrix.

A random block of directions is multiplied by the covariance, one pass of the table per
product: every task adds up ``x' (x w)`` of its centred rows, which is features times
directions. What the product adds to the directions so far (its residual, made orthogonal by
a tall-skinny QR) is the next block, so the range that is searched grows where the error
lies. The fit ends when every wanted component solves ``C v = variance * v`` within ``tol``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.ranking import cumulative_share
from riskframe.session import cut_lineage

#: Features of a block of sums, and places that the sums of a block are first added up in.
BLOCK, FAN = 512, 32
#: Blocks of directions that are kept before a restart, and after one.
KEPT, AFTER = 6, 2
#: Bytes of directions and their products on the driver. A pass sends a twelfth of it at most.
DRIVER_BYTES = 768 << 20
#: Bytes of rows that are multiplied together.
ROWS_BYTES = 32 << 20


@dataclass(frozen=True)
class WideComponents:
    """Mean (d), components as columns (d x k), their variances (k), the sum of all features' variances, passes read."""

    mean: np.ndarray
    vectors: np.ndarray
    variances: np.ndarray
    total: float
    passes: int

    @property
    def ratios(self) -> np.ndarray:
        """Share of each component in the whole variance; 0 where nothing varies."""
        return self.variances / self.total if self.total > 0 else np.zeros_like(self.variances)


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[tuple[int, int], np.ndarray] = {}
    for b in batches:
        for block, slot, sums in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            new = np.frombuffer(sums)
            total[block, slot] = total[block, slot] + new if (block, slot) in total else new
    for (block, slot), a in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([slot], pa.int32()), pa.array([a.tobytes()], pa.binary())],
                                         ["block", "slot", "sums"])


def _sum_over_rows(rows: DataFrame, d: int, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum of ``work(x)`` (d rows each) over all blocks of rows ``x``; None without rows.

    A task sends one array per block of features. Blocks are added up in ``FAN`` places, then in
    one, a running sum each, so no task holds an array per task of the scan.
    """
    schema = "block int, slot int, sums binary"
    step = max(1, ROWS_BYTES // (8 * d))

    def run(batches):
        total = None
        for b in batches:
            for lo in range(0, b.num_rows, step):
                part = b.slice(lo, step)
                new = work(part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, d))
                total = new if total is None else total + new
        if total is not None:
            slot = TaskContext.get().partitionId() % FAN
            for block, lo in enumerate(range(0, d, BLOCK)):
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([slot], pa.int32()),
                                                  pa.array([total[lo : lo + BLOCK].tobytes()], pa.binary())], ["block", "slot", "sums"])

    spread = rows.mapInArrow(run, schema).repartition("block", "slot").mapInArrow(_add, schema)
    whole = spread.withColumn("slot", F.lit(0)).repartition("block").mapInArrow(_add, schema)
    got = {r["block"]: np.frombuffer(r["sums"]) for r in whole.collect()}  # features times directions
    return np.concatenate([got[i].reshape(min(BLOCK, d - i * BLOCK), -1) for i in sorted(got)]) if got else None


def _orthogonal(new: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span what ``new`` adds to the span of ``basis``; none if it adds nothing."""
    size = np.linalg.norm(new, axis=0)
    new = new[:, size > 0] / size[size > 0]
    for _ in range(2):  # the second time takes away what rounding left
        new = new - basis @ (basis.T @ new)
        q, r = np.linalg.qr(new)
        u, s, _ = np.linalg.svd(r)
        new = (q @ u)[:, : len(s)][:, s > 1e-10]
        if not new.shape[1]:
            break
    return new


def wide_pca_fit(df: DataFrame, values: str, n_features: int, k: int, oversample: int = 10, tol: float = 1e-8,
                 max_passes: int = 300, seed: int = 0) -> WideComponents:
    """The ``k`` leading components (all features, if fewer) of an array column, centred.

    Rows whose array is null, of another length, or holds a null or non-finite entry are left
    out; fewer than two others are an error. Variances divide by rows - 1. A component's sign
    makes its largest entry positive. The driver holds ``KEPT`` blocks of k + ``oversample``
    directions and their products, at most ``DRIVER_BYTES`` (else an error). A fit that isn't
    within ``tol`` (of the largest variance) after ``max_passes`` passes is an error.
    Sums of doubles differ in their last digits from run to run.
    """
    d = n_features
    k = min(k, d)
    width = min(d, k + oversample)
    if 2 * 8 * d * width * KEPT > DRIVER_BYTES:
        raise ValueError(f"{d} features times {width} directions exceed {DRIVER_BYTES} bytes on the driver; ask for fewer components")
    x = F.col(values).cast("array<double>")
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    rows = cut_lineage(df.select(x.alias("x")).where(F.col("x").isNotNull() & (F.size("x") == d) & ~F.exists("x", bad)))
    sc = df.sparkSession.sparkContext

    sums = _sum_over_rows(rows, d, lambda x: np.stack([x.sum(axis=0), np.full(d, float(len(x)))], axis=1))
    n = 0 if sums is None else int(sums[0, 1])
    if n < 2:
        raise ValueError("components need two complete rows at least")
    mean, passes = sums[:, 0] / n, 1

    def product(w: np.ndarray) -> tuple[np.ndarray, float]:
        """Covariance times ``w``, and the sum of the variances, from one pass."""
        sent = sc.broadcast((mean, w))

        def work(x):
            centre, w = sent.value
            z = x - centre
            return np.concatenate([z.T @ (z @ w), (z * z).sum(axis=0)[:, None]], axis=1)

        out = _sum_over_rows(rows, d, work) / (n - 1)
        sent.destroy()
        return out[:, :-1], float(out[:, -1].sum())

    basis, image, total = np.zeros((d, 0)), np.zeros((d, 0)), 0.0
    block = _orthogonal(np.random.default_rng(seed).normal(size=(d, width)), basis)
    while True:
        new, total = product(block)
        passes += 1
        basis, image = np.hstack([basis, block]), np.hstack([image, new])
        h = basis.T @ image
        var, turn = np.linalg.eigh((h + h.T) / 2)
        var, turn = var[::-1], turn[:, ::-1]
        lead, moved = basis @ turn[:, :width], image @ turn[:, :width]
        gap = moved - lead * var[:width]
        error = float(np.linalg.norm(gap[:, :k], axis=0).max())
        if error <= tol * max(var[0], 0) or basis.shape[1] >= d:
            break
        if passes >= max_passes:
            raise RuntimeError(f"components not within {tol} after {passes} passes: {error / var[0]:.1e}")
        if basis.shape[1] + width > KEPT * width:
            basis, image = basis @ turn[:, : AFTER * width], image @ turn[:, : AFTER * width]
        block = _orthogonal(gap, basis)
        if not block.shape[1]:
            break  # the directions hold all that they lead to
    vectors = lead[:, :k]
    sign = np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)] < 0, -1.0, 1.0)
    return WideComponents(mean, vectors * sign, np.maximum(var[:k], 0), total, passes)


def wide_project(model: WideComponents, df: DataFrame, values: str, out: str = "pca_features") -> DataFrame:
    """``df`` with the centred projection of an array column; null where the fit leaves a row out."""
    sent = df.sparkSession.sparkContext.broadcast((model.mean, model.vectors))
    d = len(model.mean)

    @F.pandas_udf("array<double>")
    def project(rows: pd.Series) -> pd.Series:
        mean, vectors = sent.value
        found: list = [None] * len(rows)
        for i, v in enumerate(rows):
            if v is not None and len(v) == d:
                v = np.asarray(v, np.float64)
                if np.isfinite(v).all():
                    found[i] = (v - mean) @ vectors
        return pd.Series(found)

    column: Column = project(F.col(values).cast("array<double>"))
    return df.withColumn(out, column)


def wide_scree(spark: SparkSession, model: WideComponents) -> DataFrame:
    """E14 for the fitted components: share and running share of the whole variance."""
    rows = [(i + 1, float(v)) for i, v in enumerate(model.ratios)]
    return cumulative_share(spark.createDataFrame(rows, "component int, ratio double"), "component", "ratio")


def wide_loadings(spark: SparkSession, model: WideComponents, names: Sequence[str]) -> DataFrame:
    """(feature, component, loading), as ``pca.loadings``."""
    rows = [(f, j, float(v)) for f, row in zip(names, model.vectors, strict=True) for j, v in enumerate(row)]
    return spark.createDataFrame(rows, "feature string, component int, loading double")
