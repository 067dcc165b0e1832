import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import kdtree


def brute(rows, k=10, scale=1024):
    own = []
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            own.append((i, tuple(math.floor(np.float64(np.float32(x)) * scale) for x in v)))
    out = []
    for i, q in sorted({x for x in own if x[0] % 5 == 0}):
        near = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in own if j != i and len(v) == len(q))[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(near)]
    return sorted(out)


def rows_of(seed, n=300, dim=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, dim)).round(int(rng.integers(0, 3)))
    x[: n // 3] = x[0]
    return [(int(i), [float(v) for v in r]) for i, r in zip(rng.permutation(n), x, strict=True)]


ODD = [(1000, None), (1005, []), (None, [1.0] * 4), (1010, [1.0, None, 2.0, 3.0]), (1015, [float("nan")] * 4), (1020, [float("inf")] * 4),
       (1025, [1.0, 2.0]), (1026, [3.0, -1.0]), (7, [1.0, 1.0, 1.0, 1.0])]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_rows(spark, monkeypatch, seed):
    monkeypatch.setattr(kdtree, "SHARD_ROWS", (40, 60))
    monkeypatch.setattr(kdtree, "LEAF_ROWS", 8)
    monkeypatch.setattr(kdtree, "BLOCK_QUERIES", 64)
    rows = rows_of(seed) + ODD
    df = spark.createDataFrame([(*r, 1.0, "x") for r in rows], "vec_id long, embedding array<float>, score double, v string").repartition(3)
    got = kdtree.top_k(df, F.col("vec_id") % 5 == 0).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == brute(rows)


@pytest.mark.parametrize("limits", [{"BLOCK_BYTES": 64}, {"SHARD_BYTES": 64}, {"BLOCK_BYTES": 1, "SHARD_BYTES": 1}])
def test_bytes_bound_blocks_and_shards(spark, monkeypatch, limits):
    """Down to a vector a block and a shard; the plan has one scan however many blocks there are."""
    for name, value in limits.items():
        monkeypatch.setattr(kdtree, name, value)
    rows = rows_of(4, 24)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(2)
    found = kdtree.top_k(df, F.col("vec_id") % 5 == 0)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect()) == brute(rows)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Relation") == 1


def test_nothing_to_search(spark):
    df = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>")
    assert kdtree.top_k(df, F.col("vec_id") == 5).count() == 0
    assert kdtree.top_k(df, F.col("vec_id") == 1).count() == 0
    assert kdtree.top_k(df.limit(0), F.lit(True)).count() == 0


def test_large_components_stay_exact():
    x = np.array([[2**40, 1], [2**40, 0], [2**40 - 1, 5]])
    tree = kdtree.Tree.unpack(kdtree.Tree(x, np.arange(3), 1).pack())
    best = [[]]
    tree.search(np.array([[2**20, 1]]), np.array([-1]), best, np.array([-np.inf]), 2)
    assert sorted(best[0], reverse=True) == [(2**60 + 1, 0), (2**60, -1)]


def test_boxes_are_tight():
    x = np.random.default_rng(1).integers(-50, 50, (200, 3))
    tree = kdtree.Tree(x, np.arange(200), 10)
    for (lo, hi), low, high in zip(tree.span, tree.low, tree.high, strict=True):
        part = tree.x[lo:hi]
        assert (part.min(axis=0) == low).all() and (part.max(axis=0) == high).all()
