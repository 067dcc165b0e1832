"""Hash sampling, splits and folds: exact sizes, disjoint covers, and the
same result under any partitioning."""

from pyspark.sql import functions as F

from riskframe.operators import sampling as SA


def _orders(spark):
    return spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select("o_orderkey", "o_orderstatus")


def test_exact_sizes_and_partition_independence(spark):
    o = _orders(spark)
    a = {r[0] for r in SA.sample_fraction(o, 0.05, "o_orderkey", 3, exact=True).select("o_orderkey").collect()}
    b = {r[0] for r in SA.sample_fraction(o.repartition(13), 0.05, "o_orderkey", 3, exact=True)
         .select("o_orderkey").collect()}
    assert len(a) == 750 and a == b
    assert SA.sample_n(o, 777, "o_orderkey", 1).count() == 777
    assert SA.sample_n(o, 10 ** 6, "o_orderkey", 1).count() == 15000


def test_refinement_path_matches_direct_rank(spark, monkeypatch):
    o = _orders(spark)
    want = {r[0] for r in SA.sample_n(o, 4321, "o_orderkey", 9).collect()}
    monkeypatch.setattr(SA, "RANK_LIMIT", 2)  # force multi-level refinement
    got = {r[0] for r in SA.sample_n(o, 4321, "o_orderkey", 9).collect()}
    assert got == want and len(got) == 4321


def test_stratified_split_cover_and_shares(spark):
    s = SA.stratified_split(_orders(spark), "o_orderstatus", 0.2, "o_orderkey", 42)
    assert s.count() == 15000 and s.select("o_orderkey").distinct().count() == 15000
    g = {(r[0], r[1]): r[2] for r in s.groupBy("o_orderstatus", "split").count().collect()}
    for st in ("O", "P", "F"):
        n = g[(st, "test")] + g[(st, "train")]
        assert abs(g[(st, "test")] - 0.2 * n) <= 1


def test_folds_equal_sizes(spark):
    f = SA.kfold(_orders(spark), 5, "o_orderkey", 1)
    sizes = sorted(r[1] for r in f.groupBy("fold").count().collect())
    assert sizes == [3000] * 5
    sf = SA.stratified_kfold(_orders(spark), "o_orderstatus", 5, "o_orderkey", 1)
    per = sf.groupBy("o_orderstatus", "fold").count().collect()
    for st in ("O", "P", "F"):
        c = [r[2] for r in per if r[0] == st]
        assert max(c) - min(c) <= 1


def test_with_replacement_and_resize(spark):
    c = spark.read.parquet("/root/testdata/sf0.01/customer.parquet").select("c_custkey", "c_acctbal")
    d = SA.sample_with_replacement(c, 2000, "c_custkey", 14)
    assert d.count() == 2000 and d.select("draw").distinct().count() == 2000
    up = SA.resize_to(c, 1800, "c_custkey", 2)
    assert up.count() == 1800 and up.where("copy_no = 0").count() == 1500
    down = SA.resize_to(c, 1000, "c_custkey", 2)
    assert down.count() == 1000


def test_permute_column_is_permutation(spark):
    c = spark.read.parquet("/root/testdata/sf0.01/customer.parquet").select("c_custkey", "c_acctbal")
    p = SA.permute_column(c, "c_acctbal", "c_custkey", 5)
    assert sorted(r[0] for r in p.select("c_acctbal").collect()) == sorted(r[0] for r in c.select("c_acctbal").collect())
    assert p.join(c, ["c_custkey", "c_acctbal"]).count() < 1500


def test_sample_grid():
    grid = {"a": list(range(10)), "b": list(range(20))}
    assert len(SA.sample_grid(grid, 50, 1)) == 50
    assert len(SA.sample_grid({"a": [1, 2]}, 50, 1)) == 2


def test_many_strata_null_strata_and_repeated_keys(spark):
    df = spark.range(6000).select((F.col("id") % 1500).alias("g"), "id")
    df = df.withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    got = SA.stratified_split(df, "g", 0.25, "id", 3)
    n = {r["g"]: r["n"] for r in got.where("split = 'test'").groupBy("g").agg(F.count("*").alias("n")).collect()}
    assert got.count() == 6000 and set(n.values()) == {1} and len(n) == 1500 and None in n
    same = spark.range(1000).select(F.lit(7).alias("k"), F.col("id").alias("v"))
    assert SA.sample_fraction(same, 0.1, "k", 5, exact=True).count() == 100
    assert SA.sample_n(same, 33, "k", 5).count() == 33


def test_stratified_kfold_keeps_null_labels(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 10 >= 3, F.col("id") % 2).alias("y"), "id")
    got = SA.stratified_kfold(df, "y", 5, "id", 1)
    assert got.count() == 1000
    assert {r["n"] for r in got.groupBy("y", "fold").agg(F.count("*").alias("n")).collect()} == {60, 80}


def test_columns_permuted_together_are_as_permuted_alone(spark):
    df = spark.range(90).selectExpr("id * 3 AS k", "id % 11 AS a", "if(id % 7 = 0, NULL, cast(id AS string)) AS b")
    both = SA.permute_columns(df, ["a", "b"], "k", [5, 6])
    assert both.count() == 180
    for r, seed in enumerate([5, 6]):
        for c in ("a", "b"):
            alone = SA.permute_column(df, c, "k", seed).select("k", c).collect()
            assert sorted(map(tuple, both.where(f"_rf_rep = {r}").select("k", f"_rf_p_{c}").collect())) == sorted(map(tuple, alone))
