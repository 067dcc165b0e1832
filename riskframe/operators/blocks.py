"""Column statistics from small per-task sums, made in numpy and added up by Spark.

Medians are found by radix selection: the bits of a double, put in an order-preserving
form, are fixed eleven at a time for all columns at once, from counts alone. Correlations
with gaps are masked products of blocks of columns. In both, what is shuffled is a sum per
task and block, never a row per cell.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import cut_lineage

#: Lowest bit that each pass of the radix selection fixes.
SHIFTS = (53, 42, 31, 20, 9, 0)
#: Columns of a block, and bytes of block sums that a task holds in one pass.
BLOCK = 128
HELD_BYTES = 64 << 20
#: Rows that are multiplied together.
ROWS = 2048


def ordered_bits(x: np.ndarray) -> np.ndarray:
    """Doubles as signed integers of the same order; -0.0 equals 0.0, NaN is the largest."""
    bits = np.where(np.isnan(x), np.nan, x + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def double_of(key: int) -> float:
    """The double whose ``ordered_bits`` is ``key``."""
    k = np.array([key], np.int64)
    return float((k ^ ((k >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.float64)[0])


def _digits(rows: DataFrame, slots: list[tuple[int, int | None]], level: int) -> DataFrame:
    """(slot, digit, n, low, high): of each slot (column, prefix), the count, least and greatest key per next digit."""
    shift = SHIFTS[level]
    above = SHIFTS[level - 1] if level else 64
    mask, first = (1 << (above - shift)) - 1, level == 0

    def run(batches):
        size = 1 << (above - shift)
        n = np.zeros((len(slots), size), np.int64)
        low, high = np.full(n.shape, np.iinfo(np.int64).max), np.full(n.shape, np.iinfo(np.int64).min)
        for b in batches:
            keys: dict[int, np.ndarray] = {}
            for s, (c, prefix) in enumerate(slots):
                if c not in keys:
                    keys[c] = ordered_bits(b.column(c).drop_null().to_numpy(zero_copy_only=False).astype(np.float64))
                k = keys[c] if first else keys[c][(keys[c] >> above) == prefix]
                digit = (k >> shift) + (size >> 1) if first else (k >> shift) & mask
                n[s] += np.bincount(digit, minlength=size)
                np.minimum.at(low[s], digit, k)
                np.maximum.at(high[s], digit, k)
        s, d = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(s.astype(np.int32)), pa.array(d.astype(np.int32)), pa.array(n[s, d]), pa.array(low[s, d]), pa.array(high[s, d])],
                                         ["slot", "digit", "n", "low", "high"])

    sums = rows.mapInArrow(run, "slot int, digit int, n long, low long, high long")
    return sums.groupBy("slot", "digit").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


def radix_medians(df: DataFrame, cols: Sequence[str]) -> list[float | None]:
    """The exact median (mean of the middle two) of each column as double, None where all is null.

    The columns are written once and read once per pass, at most six times; a pass sends at most
    2048 counts per task and open slot (two per column), and the driver gets two rows per column.
    A slot ends as soon as all its keys are equal. Nulls are left out; NaN counts as the largest value.
    """
    spark = df.sparkSession
    rows = cut_lineage(df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]))
    found: dict[tuple[int, int], int] = {}  # (column, side): key of the lower and the upper middle
    wanted: dict[tuple[int, int | None], list[tuple[int, int | None]]] = {(c, None): [(0, None), (1, None)] for c in range(len(cols))}
    for level in range(len(SHIFTS)):
        if not wanted:
            break
        slots = list(wanted)
        ranks = [(s, side, rank) for s, key in enumerate(slots) for side, rank in wanted[key]]
        targets = spark.createDataFrame(ranks, "slot int, side int, rank long")  # two rows a column
        w = Window.partitionBy("slot")  # at most 2048 digits
        counts = _digits(rows, slots, level).withColumns({
            "upto": F.sum("n").over(w.orderBy("digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)), "total": F.sum("n").over(w)})
        rank = F.coalesce("rank", F.floor((F.col("total") - 1 + F.col("side")) / 2))
        hit = counts.join(F.broadcast(targets), "slot").withColumn("at", rank - (F.col("upto") - F.col("n"))).where("at >= 0 AND at < n")
        wanted = {}
        for r in hit.select("slot", "side", "at", "low", "high").collect():
            c = slots[r["slot"]][0]
            if r["low"] == r["high"]:
                found[c, r["side"]] = r["low"]
            else:
                wanted.setdefault((c, r["low"] >> SHIFTS[level]), []).append((r["side"], r["at"]))
    return [(double_of(found[c, 0]) + double_of(found[c, 1])) / 2 if (c, 0) in found else None for c in range(len(cols))]


def masked_correlation(df: DataFrame, values: str, names: Sequence[str]) -> DataFrame:
    """(col_a, col_b, corr) of every pair of entries of an array column, over the rows where both are present.

    Null and NaN entries are gaps; rows whose array is null or of another length are left out. A pair
    with a constant side or without two common rows has a null correlation. Values are taken less their column's mean, read in a
    pass before, so that the sums of squares keep their digits. Every task adds up masked products of
    blocks of ``BLOCK`` columns, as many pairs of blocks in a pass as ``HELD_BYTES`` allow; Spark sums
    them and the pairs' rows stay distributed.
    """
    p = len(names)
    rows = cut_lineage(df.select(F.col(values).cast("array<double>").alias("x")).where(F.col("x").isNotNull() & (F.size("x") == p)))
    starts = list(range(0, p, BLOCK))

    def matrix(batch) -> np.ndarray:
        return batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, p)

    def totals(batches):
        n, s = np.zeros(p), np.zeros(p)
        for b in batches:
            x = matrix(b)
            n += (~np.isnan(x)).sum(axis=0)
            s += np.nansum(x, axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(p, dtype=np.int32)), pa.array(n), pa.array(s)], ["i", "n", "s"])

    centre = np.zeros(p)
    for r in rows.mapInArrow(totals, "i int, n double, s double").groupBy("i").agg(F.try_divide(F.sum("s"), F.sum("n")).alias("m")).collect():  # a row per column
        if r["m"] is not None and np.isfinite(r["m"]):
            centre[r["i"]] = r["m"]

    def products(pairs):
        def run(batches):
            sums = {}
            for b in batches:
                for lo in range(0, b.num_rows, ROWS):
                    x = matrix(b.slice(lo, ROWS)) - centre
                    on = ~np.isnan(x)
                    x, m = np.where(on, x, 0), on.astype(float)
                    for i, j in pairs:
                        a, c = slice(i, i + BLOCK), slice(j, j + BLOCK)
                        new = np.stack([m[:, a].T @ m[:, c], x[:, a].T @ m[:, c], m[:, a].T @ x[:, c],
                                        (x[:, a] ** 2).T @ m[:, c], m[:, a].T @ (x[:, c] ** 2), x[:, a].T @ x[:, c]])
                        sums[i, j] = sums[i, j] + new if (i, j) in sums else new
            for (i, j), s in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([s.tobytes()], pa.binary())], ["i", "j", "sums"])
        return run

    names = list(names)

    def finish(batches):
        total: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for i, j, s in zip(*(c.to_pylist() for c in b.columns), strict=True):
                new = np.frombuffer(s)
                total[i, j] = total[i, j] + new if (i, j) in total else new
        for (i, j), s in total.items():
            n, a, b, aa, bb, ab = s.reshape(6, min(BLOCK, p - i), min(BLOCK, p - j))
            with np.errstate(all="ignore"):
                va, vb, cov = aa - a * a / n, bb - b * b / n, ab - a * b / n
                ok = (n > 1) & (va > 1e-13 * aa) & (vb > 1e-13 * bb)
                r = np.where(ok, cov / np.sqrt(va * vb), np.nan)
            left, right = np.nonzero(np.arange(i, i + len(n))[:, None] < np.arange(j, j + n.shape[1]))
            yield pa.RecordBatch.from_arrays([pa.array([names[i + k] for k in left], pa.string()), pa.array([names[j + k] for k in right], pa.string()),
                                              pa.array(r[left, right], pa.float64(), mask=~ok[left, right])], ["col_a", "col_b", "corr"])

    pairs = [(i, j) for k, i in enumerate(starts) for j in starts[k:]]
    held = max(1, HELD_BYTES // (6 * 8 * BLOCK * BLOCK))
    out = None
    for lo in range(0, len(pairs), held):
        sums = rows.mapInArrow(products(pairs[lo : lo + held]), "i int, j int, sums binary")
        part = sums.repartition(min(len(pairs), 64), "i", "j").mapInArrow(finish, "col_a string, col_b string, corr double")
        out = part if out is None else out.unionAll(part)
    return out if out is not None else df.sparkSession.createDataFrame([], "col_a string, col_b string, corr double")
