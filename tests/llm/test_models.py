import numpy as np
import pandas as pd
import pytest
from frames import ODD, docs_frame
from pyspark.sql import functions as F

from riskframe.llm import language, quality, queries, toxicity
from riskframe.llm.subwords import WordTable, subword_ids

SF = "/root/testdata/sf0.01"


def truth(spark, column):
    t = spark.read.parquet(f"{SF}/labels.parquet").where(F.col(column).isNotNull()).select("doc_id", F.col(column).alias("label"))
    return t


@pytest.mark.parametrize("name,column,least", [("op1_quality", "quality", 0.93), ("op10_toxicity", "toxic", 0.93)])
def test_held_out_accuracy(spark, name, column, least):
    got = queries.QUERIES[name](spark, SF).join(truth(spark, column), "doc_id").where("held_out").toPandas()
    assert len(got) > 50 and (got.predicted == got.label).mean() >= least
    assert ((got.score >= 0) & (got.score <= 1)).all() and ((got.score >= 0.7) == (got.predicted == 1)).all()


def test_language_accuracy(spark):
    got = queries.QUERIES["op3_language"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.97


def toy(spark):
    rows = [(i, ("fine good words here " if i % 3 else "bad awful nasty stuff ") * (1 + i % 7)) for i in range(300)]
    docs = docs_frame(spark, rows + ODD)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 3 == 0), "z") for i in range(300)] + [(None, 1, 1, "z"), (4000, None, None, "z")], "doc_id long, quality int, toxic int, text string")
    return docs, labels


@pytest.mark.parametrize("fit,score,column", [(quality.fit_quality, quality.score_quality, "quality"), (toxicity.fit_toxicity, toxicity.score_toxicity, "toxic")])
def test_odd_rows_and_clashing_columns(spark, fit, score, column):
    docs, labels = toy(spark)
    model = fit(docs, labels)
    got = score(docs.repartition(3), model)
    assert got.columns == [*[c for c in docs.columns if c != "score"], "score"]
    rows = got.collect()
    assert len(rows) == 300 + len(ODD) and all(0 <= r.score <= 1 for r in rows)
    want = 1 if column == "quality" else 0
    known = [r for r in rows if r.doc_id is not None and r.doc_id < 300]
    assert all((r.score > 0.5) == ((r.doc_id % 3 > 0) == want) for r in known)
    odd = {r.doc_id: r.score for r in rows if r.doc_id in (900, 901, 902)}
    assert odd[900] == odd[901] == odd[902]
    assert score(docs.limit(0), model).count() == 0
    # nothing to learn from: no labels, or a single class
    for few in (labels.limit(0), labels.where(f"{column} = 1")):
        assert all(0 <= r.score <= 1 for r in score(docs, fit(docs, few)).collect())


def test_held_out_rows_and_other_columns_are_never_learned(spark):
    docs, labels = toy(spark)
    lie = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality"))
    a = quality.fit_quality(docs, labels)
    b = quality.fit_quality(docs.withColumn("label", F.lit(9)), labels.withColumn("quality", lie))
    assert (a.table == b.table).all() and a.bias == b.bias


def test_repeats_are_counted_within_a_text(spark):
    model = quality.Quality(np.zeros(quality.BUCKETS, np.float32), 0.0)
    ids, _ = subword_ids([quality.REPEAT], quality.BUCKETS, quality.SIZES)
    model.table[ids] = -5
    got = quality.score_quality(docs_frame(spark, [(1, "a a a b"), (2, "b a"), (3, "a b"), (4, "a"), (5, "a a")], extra=False).coalesce(1), model)
    s = {r.doc_id: r.score for r in got.collect()}
    assert s[2] == s[3] == s[4] == 0.5 and s[1] < 0.5 and abs(s[5] - 1 / (1 + np.exp(5 / 3))) < 1e-6


def test_subword_ids_by_hand():
    ids, owner = subword_ids(["ab", "a", "ab"], 1 << 20, (2, 3))
    rows = [ids[owner == i].tolist() for i in range(3)]
    assert rows[0] == rows[2] and [len(r) for r in rows] == [1 + 3 + 2, 1 + 2 + 1, 6]
    assert len(set(rows[0])) == 6 and not set(rows[0]) & set(rows[1][:1])


def test_word_table_is_bounded():
    table = WordTable(lambda words: np.array([[len(w)] for w in words], np.float32), 1, limit=100)
    for i in range(50):
        words = [f"{'x' * (i % 5)}{j}" for j in range(i, i + 40)]
        place = table.index(words)
        assert table.rows[place][:, 0].tolist() == [len(w) for w in words]
        assert len(table.place) <= 140


# ---------------------------------------------------------------- languages
def slow_viterbi(score, switch):
    v, back = score[0].astype(float), []
    for s in score[1:]:
        top = v.max() - switch
        came = top > v
        back.append((came, int(v.argmax())))
        v = np.maximum(v, top) + s
    now, out = int(v.argmax()), []
    for came, best in reversed(back):
        out.append(now)
        now = best if came[now] else now
    return [now, *reversed(out)]


@pytest.mark.parametrize("seed", range(5))
def test_viterbi(seed):
    rng = np.random.default_rng(seed)
    n = rng.integers(0, 30, 20)
    score = rng.normal(0, 3, (n.sum(), 3)).astype(np.float32)
    got = language.viterbi(score, n, 4.0)
    expected, at = [], 0
    for k in n:
        if k:
            expected += slow_viterbi(score[at:at + k], 4.0)
        at += k
    assert got.tolist() == expected


def test_mixed_scripts_and_odd_texts(spark):
    latin = "the cat sat on a mat and then it ran away from the dog "
    greek = "η γατα καθισε στο χαλι και μετα ετρεξε μακρια απο το σκυλο "
    russian = "кошка сидела на ковре и потом она убежала от собаки "
    rows = [(i, t * 5, lang) for i in range(60) for t, lang in [((latin, "en"), (greek, "el"), (russian, "ru"))[i % 3]]]
    docs = spark.createDataFrame([(*r, 0.1) for r in rows], "doc_id long, text string, lang string, score double")
    model = language.fit_languages(docs)
    assert model.names == ["el", "en", "ru"]
    assert model.writes[language.NAMES.index("greek")].tolist() == [True, False, False]
    odd = docs_frame(spark, [(1, f"{latin * 3}{greek}{russian}"), (2, None), (3, ""), (4, "12 -- !?"), (5, "σκυλο"), (6, "漢字"), (6, "漢字"), (None, latin)])
    got = {(r.doc_id, r.lang_pred): r for r in language.identify(odd, model, spans=True).collect()}
    assert {k for k in got if k[0] != 6} == {(1, "en"), (2, "und"), (3, "und"), (4, "und"), (5, "el"), (None, "en")}
    spans = [(s.lang, s.words) for s in got[(1, "en")].spans]
    assert spans == [("en", 3 * len(latin.split())), ("el", len(greek.split())), ("ru", len(russian.split()))]
    assert got[(2, "und")].score == 0 and got[(2, "und")].n_spans == 0 and got[(4, "und")].spans == []
    assert language.identify(odd.limit(0), model).count() == 0
    none = language.fit_languages(docs.limit(0))
    assert {r.lang_pred for r in language.identify(odd, none, spans=True).collect()} == {"und"}


# ---------------------------------------------------------------- the network
def test_gradients():
    rng = np.random.default_rng(3)
    model = toxicity.fresh(2)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    vectors = rng.normal(0, 1, (12, 2 * toxicity.DIM))
    place, size, y = rng.integers(0, 12, 20), np.array([9, 6, 4, 1]), np.array([1, 0, 1, 0])
    start = np.cumsum(size) - size

    def loss(v):
        rows = v @ model.w["in"] + model.w["in_b"]
        z = model._pool(*model._states(rows, place, start, size, None))[0]
        p = toxicity.sigmoid(z)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    g, dv = toxicity.gradients(model, vectors, place, start, size, y)
    for name in g:
        for at in list(np.ndindex(model.w[name].shape))[:: max(1, model.w[name].size // 5)]:
            keep = model.w[name][at]
            model.w[name][at] = keep + 1e-3
            up = loss(vectors)
            model.w[name][at] = keep - 1e-3
            down = loss(vectors)
            model.w[name][at] = keep
            assert abs((up - down) / 2e-3 - g[name][at]) < 2e-4, name
    v = vectors.copy()
    for at in [(0, 0), (3, 5), (7, 15)]:
        v[at] += 1e-3
        up = loss(v)
        v[at] -= 2e-3
        assert abs((up - loss(v)) / 2e-3 - dv[at]) < 2e-4
        v[at] += 1e-3


def test_windows_cover_every_word():
    n = np.array([0, 1, 31, 32, 33, 48, 49, 500])
    doc, start, size = toxicity.windows(n)
    begin = np.cumsum(n) - n
    for d, k in enumerate(n):
        own = [(s - begin[d], z) for i, s, z in zip(doc, start, size, strict=True) if i == d]
        assert sorted({x for s, z in own for x in range(s, s + z)}) == list(range(k))
        assert all(z <= toxicity.WINDOW for _, z in own) and all(b[0] - a[0] == toxicity.STRIDE for a, b in zip(own, own[1:]))


def test_a_text_scores_as_its_worst_window():
    model = toxicity.fresh(4)
    words = [f"w{i % 37}" for i in range(200)]
    table = model.gates_in(words)
    doc, start, size = toxicity.windows(np.array([200]))
    together = model.window_logits(table, np.arange(200), start, size)
    alone = [model.window_logits(model.gates_in(words[s:s + z]), np.arange(z), np.array([0]), np.array([z]))[0] for s, z in zip(start, size, strict=True)]
    assert np.allclose(together, alone, atol=1e-4)
    assert pd.Series(together).max() == together.max()
