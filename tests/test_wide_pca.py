"""Components of wide tables against numpy's exact decomposition."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.learn import wide_pca as W


def frame(spark, x, parts=4):
    rows = [(i, [None if v is None else float(v) for v in r] if r is not None else None) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, v array<double>").repartition(parts)


def exact(x):
    var, vec = np.linalg.eigh(np.cov(x, rowvar=False))
    return var[::-1], vec[:, ::-1]


@pytest.mark.parametrize("n,d,k", [(60, 700, 3), (200, 40, 5), (50, 3, 9), (2, 6, 2)])
def test_leading_components(spark, n, d, k):
    """More features than rows, fewer, and fewer than components asked for; over one block of sums."""
    rng = np.random.default_rng(d)
    x = rng.normal(size=(n, d)) * (1 + 5 / (1 + np.arange(d))) + rng.normal(size=d)
    m = W.wide_pca_fit(frame(spark, x), "v", d, k)
    var, vec = exact(x)
    k = min(k, d)
    assert m.vectors.shape == (d, k) and m.total == pytest.approx(var.sum())
    np.testing.assert_allclose(m.variances, np.maximum(var[:k], 0), rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose(m.vectors.T @ m.vectors, np.eye(k), atol=1e-9)
    c = np.cov(x, rowvar=False)
    np.testing.assert_allclose(c @ m.vectors, m.vectors * m.variances, atol=1e-6 * var[0])
    assert (m.vectors[np.abs(m.vectors).argmax(axis=0), np.arange(k)] > 0).all()


def test_flat_spectrum_needs_restarts(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 300))
    m = W.wide_pca_fit(frame(spark, x), "v", 300, 2, oversample=2)
    assert m.passes > W.KEPT + 1
    np.testing.assert_allclose(m.variances, exact(x)[0][:2], rtol=1e-9)


def test_rows_left_out(spark):
    x = np.random.default_rng(1).normal(size=(30, 5))
    odd = [None, [1.0] * 4, [None] * 5, [float("nan")] * 5, [float("inf"), 1, 2, 3, 4], []]
    df = frame(spark, [*x.tolist(), *odd])
    m = W.wide_pca_fit(df, "v", 5, 2)
    np.testing.assert_allclose(m.variances, exact(x)[0][:2], rtol=1e-9)
    got = {r["id"]: r["p"] for r in W.wide_project(m, df.withColumn("_p", F.lit(1)), "v", "p").collect()}
    assert all(got[i] is None for i in range(30, 36))
    np.testing.assert_allclose([got[i] for i in range(30)], (x - x.mean(axis=0)) @ m.vectors, atol=1e-9)


def test_nothing_varies_and_too_little(spark):
    m = W.wide_pca_fit(frame(spark, np.ones((9, 4))), "v", 4, 2)
    assert m.total == 0 and m.ratios.tolist() == [0, 0]
    with pytest.raises(ValueError, match="two complete rows"):
        W.wide_pca_fit(frame(spark, np.ones((9, 4))).limit(0), "v", 4, 2)
    with pytest.raises(ValueError, match="fewer components"):
        W.wide_pca_fit(frame(spark, np.ones((9, 4))), "v", 10**8, 50)


def test_tables_of_a_fit(spark):
    x = np.random.default_rng(2).normal(size=(50, 4)) * [4, 3, 2, 1]
    m = W.wide_pca_fit(frame(spark, x), "v", 4, 4)
    sc = W.wide_scree(spark, m).orderBy("component").collect()
    assert sc[-1]["cumulative"] == pytest.approx(1) and [r["component"] for r in sc] == [1, 2, 3, 4]
    ld = W.wide_loadings(spark, m, list("abcd"))
    assert ld.count() == 16 and ld.where("feature = 'a' AND component = 0").first()["loading"] == pytest.approx(m.vectors[0, 0])
