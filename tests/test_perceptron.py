"""Back-propagation against numeric gradients, fits of what no linear model can fit, and the L2 term."""

import numpy as np
import pytest

from riskframe.learn import batch
from riskframe.learn import perceptron as PT


def test_slope_is_the_numeric_one():
    rng = np.random.default_rng(1)
    sizes = (3, 5, 4, 1)
    x, y, w = rng.normal(size=(20, 3)), rng.integers(0, 2, 20).astype(float), PT.started(sizes, 2)
    _, slope = PT.loss_and_slope(w, sizes, x, y)
    for i in range(len(w)):
        e = np.zeros(len(w))
        e[i] = 1e-6
        up, down = (PT.loss_and_slope(w + d, sizes, x, y)[0] for d in (e, -e))
        assert slope[i] == pytest.approx((up - down) / 2e-6, abs=1e-5)


def _xor(spark, parts):
    rng = np.random.default_rng(5)
    x = rng.uniform(-1, 1, (400, 2))
    rows = [([float(a), float(b)], float((a > 0) != (b > 0)), int(i % 5 > 0)) for i, (a, b) in enumerate(x)]
    return spark.createDataFrame(rows, "x array<double>, y double, fold int").repartition(parts)


def test_fits_and_penalty(spark):
    rows = batch.written(_xor(spark, 3))
    (view,), (n,), _ = batch.fold_views(rows, [0])
    assert n == 320
    nets = PT.fit(rows, [PT.Network((2, 12, 1), a) for a in (1e-4, 1000.0)], view, n, 0)
    got = [(r.x, r.y) for r in rows.where("fold = 0").collect()]
    x, y = view.of(np.array([g[0] for g in got])), np.array([g[1] for g in got])
    right = [((PT.margins(net.weights, net.sizes, x)[0] > 0) == (y > 0.5)).mean() for net in nets]
    assert right[0] > 0.9 and right[0] > right[1] + 0.2
    size = [(net.held() * net.weights**2).sum() for net in nets]
    assert size[1] < 0.01 * size[0]
    assert all(b <= a for net in nets for a, b in zip(net.losses, net.losses[1:]))
    # a network fitted by itself, and from other partitions, is the same
    alone = PT.fit(batch.written(_xor(spark, 1)), [PT.Network((2, 12, 1), 1e-4)], view, n, 0, max_iter=8)[0]
    along = PT.fit(rows, [PT.Network((2, 12, 1), 1e-4), PT.Network((2, 12, 1), 1.0)], view, n, 0, max_iter=8)[0]
    assert alone.weights == pytest.approx(along.weights, abs=1e-6)


def test_no_rows_keep_the_first_weights(spark):
    rows = _xor(spark, 1)
    net = PT.fit(rows.limit(0), [PT.Network((2, 3, 1))], batch.View(np.zeros(2), np.ones(2)), 0)[0]
    assert (net.weights == PT.started((2, 3, 1), 42)).all()
