"""Bucketed prefix sums and row numbers equal a single ordered pass, for any
bucket count, including a hot order value holding most rows."""

from pyspark.sql import functions as F

import pytest

from riskframe.operators import prefix
from riskframe.operators.prefix import bucket_expr, choose_boundaries, running_sum, sequential_id


def _data(spark, n=2000):
    # value 7 holds ~60% of rows; 'k' breaks ties
    return spark.range(n).select(
        F.when(F.col("id") % 5 < 3, F.lit(7)).otherwise(F.col("id") % 97).alias("v"),
        F.col("id").alias("k"), (F.col("id") % 11).alias("w"), (F.col("id") % 3).alias("g"))


def test_sequential_id_matches_sorted_order(spark):
    df = _data(spark)
    local = sorted(df.collect(), key=lambda r: (r["v"], r["k"]))
    want = {r["k"]: i + 5 for i, r in enumerate(local)}
    for b in (1, 3, 7, 16):
        got = {r["k"]: r["rid"] for r in sequential_id(df, ["v", "k"], "rid", start=5, buckets=b).collect()}
        assert got == want, b


def test_sequential_id_per_partition(spark):
    df = _data(spark, 900)
    got = {r["k"]: r["rid"] for r in sequential_id(df, ["v", "k"], "rid", partition_cols=["g"], buckets=6).collect()}
    for g in range(3):
        local = sorted((r for r in df.collect() if r["g"] == g), key=lambda r: (r["v"], r["k"]))
        assert [got[r["k"]] for r in local] == list(range(len(local)))


def test_running_sum_inclusive_and_exclusive(spark):
    df = _data(spark, 1500)
    local = sorted(df.collect(), key=lambda r: (r["v"], r["k"]))
    acc, inc, exc = 0, {}, {}
    for r in local:
        exc[r["k"]] = acc
        acc += r["w"]
        inc[r["k"]] = acc
    for b in (1, 4, 9):
        a = {r["k"]: r["s"] for r in running_sum(df, ["v", "k"], {"s": "w"}, buckets=b).collect()}
        e = {r["k"]: r["s"] for r in running_sum(df, ["v", "k"], {"s": "w"}, buckets=b, inclusive=False).collect()}
        assert a == inc and e == exc


def test_boundaries_split_hot_value(spark):
    bounds = choose_boundaries(_data(spark, 4000), ["v", "k"], 8, 4000)
    # several boundaries fall inside the hot value 7, so it is not one task
    assert sum(1 for b in bounds if b[0] == 7) >= 3


def _nulls(spark, n=600):
    """Null order keys, null groups, and a tie-break that is never null."""
    return spark.range(n).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 50).alias("v"), F.col("id").alias("k"),
        F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("g"))


@pytest.mark.parametrize("buckets", [1, 4, 16])
@pytest.mark.parametrize("tree", [1024, 1])
def test_null_groups_and_order_keys(spark, monkeypatch, buckets, tree):
    monkeypatch.setattr(prefix, "TREE_BUCKETS", tree)
    df = _nulls(spark)
    local = sorted(df.collect(), key=lambda r: (r["v"] is not None, r["v"] or 0, r["k"]))
    got = {r["k"]: r["rid"] for r in sequential_id(df, ["v", "k"], "rid", buckets=buckets).collect()}
    assert got == {r["k"]: i for i, r in enumerate(local)}
    per = {r["k"]: r["rid"] for r in sequential_id(df, ["v", "k"], "rid", partition_cols=["g"], buckets=buckets).collect()}
    assert len(per) == 600
    for g in (None, 1, 2, 3):
        assert [per[r["k"]] for r in local if r["g"] == g] == list(range(sum(r["g"] == g for r in local)))


@pytest.mark.parametrize("buckets", [1, 4, 16])
def test_a_single_order_column_puts_nulls_first(spark, buckets):
    df = spark.range(100).select(F.when(F.col("id") >= 5, F.col("id")).alias("v"))
    got = sequential_id(df, ["v"], "rid", buckets=buckets).collect()
    assert sorted(r["rid"] for r in got if r["v"] is None) == [0, 1, 2, 3, 4]
    assert all(r["rid"] == r["v"] for r in got if r["v"] is not None)


def test_buckets_of_a_sorted_table_are_even(spark):
    df = spark.range(200_000).withColumnRenamed("id", "k")
    x = df.withColumn("b", bucket_expr(df, ["k"], choose_boundaries(df, ["k"], 32, 200_000)))
    assert max(r["count"] for r in x.groupBy("b").count().collect()) < 3 * 200_000 / 32
