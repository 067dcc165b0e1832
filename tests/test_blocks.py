"""Radix medians, correlations with gaps and curve corners against plain computations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import blocks
from riskframe.operators import metrics as M
from riskframe.operators import profile as PR
from riskframe.operators.prefix import next_values


def test_ordered_bits_keep_the_order():
    x = np.array([-np.inf, -1e300, -2.5, -1e-310, 0.0, 5e-324, 1.0, 1.0000000000000002, 1e300, np.inf])
    k = blocks.ordered_bits(x)
    assert (np.diff(k) > 0).all() and [blocks.double_of(v) for v in k] == x.tolist()
    a, b = blocks.ordered_bits(np.array([-0.0, np.nan]))
    assert a == k[4] and b > k[-1]


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_medians(spark, n):
    rng = np.random.default_rng(n)
    cols = {"wide": rng.normal(0, 1e6, n), "tiny": rng.normal(0, 1e-9, n), "tied": rng.integers(-2, 3, n).astype(float), "near": 1 + rng.integers(0, 9, n) * 2.0**-52}
    rows = [tuple(None if (i + j) % 3 == 0 and n > 2 else float(c[i]) for j, c in enumerate(cols.values())) + (None,) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols) + ", gone double").repartition(5)
    got = PR.column_medians(df, [*cols, "gone"]).first()
    for j, c in enumerate(cols):
        have = [r[j] for r in rows if r[j] is not None]
        assert got[c] == (np.median(have) if have else None)
    assert got["gone"] is None
    assert PR.column_medians(df.limit(0), ["wide"]).first()["wide"] is None


def test_median_sends_counts_only(spark):
    df = spark.range(0, 20000).select(F.sqrt("id").alias("x"))
    rows = df.select(F.col("x").alias("c0"))
    digits = blocks._digits(rows, [(0, None)], 0)
    assert digits.count() <= 2048 and digits.agg(F.sum("n")).first()[0] == 20000


def test_correlation_with_gaps(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK", 4)
    monkeypatch.setattr(blocks, "HELD_BYTES", 6 * 8 * 16 * 3)  # three pairs of blocks in a pass
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (300, 10)) + 1e6
    x[:, 1] += x[:, 0]
    x[:, 7] = 5.0
    x[rng.random(x.shape) < 0.3] = np.nan
    x[:, 9] = np.nan
    rows = [([None if np.isnan(v) and i % 2 else float(v) for v in r],) for i, r in enumerate(x)] + [(None,), ([1.0],)]
    df = spark.createDataFrame(rows, "v array<double>").repartition(3)
    got = {(r[0], r[1]): r[2] for r in PR.correlation_wide(df, "v", [str(i) for i in range(10)]).collect()}
    assert len(got) == 45
    for a in range(10):
        for b in range(a + 1, 10):
            ok = ~np.isnan(x[:, a]) & ~np.isnan(x[:, b])
            if 7 in (a, b) or 9 in (a, b):
                assert got[str(a), str(b)] is None
            else:
                assert got[str(a), str(b)] == pytest.approx(np.corrcoef(x[ok, a], x[ok, b])[0, 1], abs=1e-8)


@pytest.mark.parametrize("buckets", [1, 2, 9])
def test_corners(spark, buckets):
    rng = np.random.default_rng(buckets)
    rows = [(float(s), int(rng.random() < 0.5)) for s in rng.integers(0, 60, 150)] + [(100.0 + i, 1) for i in range(20)]
    df = spark.createDataFrame(rows, "score double, label int")
    points = M.curve_points(df, buckets=buckets)
    got = sorted((r["score"], r["tp"], r["fp"]) for r in M.corner_points(points, buckets).collect())
    every = sorted(((r["score"], r["pos"], r["neg"], r["tp"], r["fp"]) for r in points.collect()), reverse=True)
    keep = [p for i, p in enumerate(every) if i in (0, len(every) - 1) or every[i + 1][1:3] != p[1:3]]
    assert got == sorted((p[0], p[3], p[4]) for p in keep) and len(keep) < len(every)

    def area(curve):
        x, y = [0, *(c[-1] for c in curve)], [0, *(c[-2] for c in curve)]
        return sum((x[i] - x[i - 1]) * (y[i] + y[i - 1]) for i in range(1, len(x)))
    assert area(keep) == area(every)
    best = lambda pts: M.best_youden(None, points=pts).first()["j"]
    assert best(points) == pytest.approx(M.roc_curve(None, points=M.corner_points(points), totals=M.class_totals(points)).agg(F.max(F.col("tpr") - F.col("fpr"))).first()[0])


def test_next_values_over_empty_and_null(spark):
    df = spark.createDataFrame([(3, "c"), (None, "n"), (1, None)], "k int, v string")
    for buckets in (1, 3):
        got = {r["k"]: r["after"] for r in next_values(df, ["k"], {"after": "v"}, buckets).collect()}
        assert got == {None: None, 1: "c", 3: None}
    assert next_values(df.limit(0), ["k"], {"after": "v"}).count() == 0
