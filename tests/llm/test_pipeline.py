"""The pipeline stage by stage against brute force, on the smallest tables with planted cases."""

import inspect

import pytest
import test_decontaminate
import test_parity
import test_substrings

import corpus_pipeline
from riskframe.llm.tokens import default_tokenizer, encoder

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def planted(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    good = [r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").orderBy("doc_id").collect()]
    texts = {r.doc_id: r.text for r in docs.where(docs.doc_id.isin(good)).collect()}
    long = [i for i in good if i in texts and len(texts[i].split()) > 300][:6]
    a, b, c = (texts[i] for i in long[:3])
    more = [(100_000, a), (100_001, a.replace(a.split()[40], "changed", 1)), (100_002, b + " " + " ".join(c.split()[50:120])),
            (100_003, c[: len(c) // 2] + " " + bench[0] + " " + c[len(c) // 2:])]
    return docs.unionByName(spark.createDataFrame([(i, t, "en", "planted", len(t)) for i, t in more], docs.schema)).cache(), long


def test_stages(spark, planted):
    docs, long = planted
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "similar", "substrings", "benchmark", "packing"]
    assert all(list(inspect.signature(f).parameters) == ["spark", "docs", "sf_dir"] for _, f in corpus_pipeline.STAGES)
    quality, similar, substrings, benchmark, packing = (f for _, f in corpus_pipeline.STAGES)

    kept = quality(spark, docs, SF).cache()
    assert kept.columns == docs.columns and set(kept.collect()) <= set(docs.collect())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = {i for i, _ in rows_of(kept)}
    right = [(i in ids) == (q == 1) for i, q in labels.items()]
    assert sum(right) / len(right) > 0.93

    first = similar(spark, kept, SF).cache()
    expected = {i for i, _, c in test_parity.brute(rows_of(kept)) if i == c}
    assert sorted(first.collect()) == sorted(r for r in kept.collect() if r.doc_id in expected)
    assert {100_000, 100_001}.isdisjoint({i for i, _ in rows_of(first)})

    cut = substrings(spark, first, SF).cache()
    expected = {r[0]: r for r in test_substrings.brute(rows_of(first))}
    assert {i: t for i, t in rows_of(cut)} == {i: r[4] for i, r in expected.items() if not r[2] or r[2] < r[1]}
    assert cut.columns == docs.columns and all(r.n_chars == len(r.text) for r in cut.collect() if expected[r.doc_id][2])

    clean = benchmark(spark, cut, SF).cache()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    expected = {r[0] for r in test_decontaminate.brute(rows_of(cut), items) if not r[5]}
    assert sorted(clean.collect()) == sorted(r for r in cut.collect() if r.doc_id in expected)
    assert 100_003 not in {i for i, _ in rows_of(clean)}

    packed = packing(spark, clean, SF).toPandas()
    tokens = {r.doc_id: len(encoder(default_tokenizer()).encode([r.text])[0]) // 4 + 1 for r in clean.collect()}
    assert packed.groupby("doc_id").length.sum().to_dict() == tokens
    assert packed.groupby("sequence_id").length.sum().max() <= 1024
    for df in (kept, first, cut, clean):
        df.unpersist()


def test_run_is_all_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    fill = got.groupBy("sequence_id").agg({"length": "sum"}).toPandas()["sum(length)"]
    assert fill.max() <= 1024 and len(fill) <= fill.sum() / 1024 + 2


@pytest.mark.parametrize("stage", range(5))
def test_empty_documents(spark, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    name, f = corpus_pipeline.STAGES[stage]
    got = f(spark, docs, SF)
    assert got.count() == 0 and (name == "packing" or got.columns == docs.columns)


def test_odd_rows_pass_every_stage(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, " ", None, "s", 1), (3, None, "en", None, None), (4, "some words", "en", "s", 10), (4, "some words", "en", "s", 10)]
    odd = spark.createDataFrame(rows, schema)
    for _, f in corpus_pipeline.STAGES[1:4]:
        assert sorted(map(str, f(spark, odd, SF).collect())) == sorted(map(str, odd.collect()))
    assert corpus_pipeline.STAGES[4][1](spark, odd, SF).count() == 6
