"""Queries whose learned or scored results have a closed form, with SQL twins.

A model on one categorical column must give each level its label rate; components
must add up to each column's variance; a column that a model does not read must not
matter; a stream must score the rows that pass its rules and set the others aside.
"""

from __future__ import annotations

import os

from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskframe.functions import features as FX
from riskframe.functions.records import check_records
from riskframe.learn import evaluate as EV
from riskframe.learn import importance as IM
from riskframe.learn import models as MD
from riskframe.learn import pca as PCA_
from riskframe.learn import prep as PP
from riskframe.learn import wide_pca as WP
from riskframe.learn.scoring import score_records
from riskframe.operators import report as RP
from riskframe.operators.quality import engineer_features
from riskframe.operators import profile as PR
from riskframe.operators.prefix import sequential_id
from riskframe.operators.sampling import sample_grid, stratified_kfold, stratified_split
from riskframe.plans.oracle import mark_sql, patients_sql, sql_hash
from riskframe.operators import metrics as M
from riskframe.plans.registry import CURVE_SQL, ORACLE, R9, SE, query, scored_events, tb
from riskframe.session import cut_lineage, scratch_path
from riskframe.sources import io as IO
from riskframe.sources.generate import patients_from
from riskframe.streaming.score_stream import score_stream

DOCS = "t AS (SELECT doc_id, coalesce(lang, 'none') AS lang, quality AS label FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL)"
RATES = f"{DOCS}, r AS (SELECT lang, avg(label) AS rate FROM t GROUP BY lang)"


def labelled(spark, d):
    """Documents with a quality label: doc_id, lang, label."""
    docs = tb(spark, d, "documents").select("doc_id", F.coalesce("lang", F.lit("none")).alias("lang"))
    y = tb(spark, d, "labels").where(F.col("quality").isNotNull()).select("doc_id", F.col("quality").alias("label"))
    return cut_lineage(docs.join(y, "doc_id"))


def level_rates(df, estimator):
    """Predicted probability of class 1 for each language."""
    model = Pipeline(stages=[*PP.preprocessor_stages([], ["lang"]), estimator]).fit(df)
    p = model.transform(df.select("lang").distinct()).select("lang", vector_to_array("probability")[1].alias("p"))
    return p.select("lang", F.round("p", 3).alias("probability"))


@query("scaler_lineitem", """
SELECT l_orderkey, l_linenumber, round((l_quantity - avg(l_quantity) OVER ()) / stddev_samp(l_quantity) OVER (), 6) AS quantity,
  round((l_discount - avg(l_discount) OVER ()) / stddev_samp(l_discount) OVER (), 6) AS discount FROM lineitem""")
def q_scaler_lineitem(spark, d):
    """Standard scaling, value by value."""
    li = tb(spark, d, "lineitem").select("l_orderkey", "l_linenumber", array_to_vector(F.array("l_quantity", "l_discount")).alias("x"))
    out = PP.scaler("x", "z").fit(li).transform(li).select("l_orderkey", "l_linenumber", vector_to_array("z").alias("z"))
    return out.select("l_orderkey", "l_linenumber", *[F.round(F.col("z")[i], 6).alias(c) for i, c in enumerate(("quantity", "discount"))])


@query("preprocessor_orders", """
WITH o AS (SELECT o_orderkey, round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_samp(o_totalprice) OVER (), 6) AS z,
  o_orderstatus AS s FROM orders)
SELECT o_orderkey, 'o_totalprice' AS feature, z AS value FROM o
UNION ALL SELECT o_orderkey, 'o_orderstatus_' || l.s, CAST(o.s = l.s AS DOUBLE) FROM o, (SELECT DISTINCT s FROM o) l""")
def q_preprocessor_orders(spark, d):
    """Scaled numbers, then a place per level in alphabetical order, by name."""
    o = tb(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    model = PP.pipeline(["o_totalprice"], ["o_orderstatus"]).fit(o)
    names = PP.feature_names(model, ["o_totalprice"], ["o_orderstatus"])
    x = model.transform(o).select("o_orderkey", F.posexplode(vector_to_array("features")).alias("i", "v"))
    name = F.element_at(F.array(*map(F.lit, names)), F.col("i") + 1)
    return x.select("o_orderkey", name.alias("feature"), F.round("v", 6).alias("value"))


@query("logistic_level_rates", f"WITH {RATES} SELECT lang, round(rate, 3) AS probability FROM r")
def q_logistic_level_rates(spark, d):
    """E5: an unpenalised fit on one categorical column gives each level its label rate."""
    return level_rates(labelled(spark, d), MD.logistic(penalty="none", max_iter=500).setTol(1e-12))


@query("forest_levels", f"WITH {DOCS} SELECT DISTINCT lang, CAST(lang = 'en' AS DOUBLE) AS probability FROM t")
def q_forest_levels(spark, d):
    """A tree on all rows learns a label that follows from the level exactly. (Spark
    merges leaves of one class, so it would not give each level its own rate.)"""
    df = labelled(spark, d).withColumn("label", (F.col("lang") == "en").cast("int"))
    return level_rates(df, MD.random_forest(1, 8, "all", bootstrap=False))


@query("boosting_level_rates", f"WITH {RATES} SELECT lang, round(1 / (1 + exp(-2 * (2 * rate - 1))), 3) AS probability FROM r")
def q_boosting_level_rates(spark, d):
    """The first round of boosting fits the mean of -1 and 1, read as half the log odds."""
    return level_rates(labelled(spark, d), MD.gradient_boosting(1, 1.0, 8))


@query("evaluate_level_rates", f"""
WITH {RATES}, s AS (SELECT label, CAST(rate > 0.5 AS INTEGER) AS pred, rate FROM t JOIN r USING (lang)),
c AS (SELECT count_if(label = 1 AND pred = 1) AS tp, count_if(label = 0 AND pred = 1) AS fp,
  count_if(label = 1 AND pred = 0) AS fn, count(*) AS n, count_if(label = pred) AS ok FROM s),
g AS (SELECT rate, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM s GROUP BY rate),
a AS (SELECT sum(x.pos * y.neg * (CASE WHEN x.rate > y.rate THEN 1.0 WHEN x.rate = y.rate THEN 0.5 ELSE 0 END)) /
  (sum(x.pos) / count(DISTINCT y.rate) * (sum(y.neg) / count(DISTINCT x.rate))) AS auc FROM g x, g y)
SELECT 'rates' AS model, round(ok / n, 6) AS accuracy, round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision,
  round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall, round(auc, 6) AS roc_auc FROM c, a""")
def q_evaluate_level_rates(spark, d):
    """Every measure of a model whose scores are known."""
    df = labelled(spark, d)
    est = Pipeline(stages=[*PP.preprocessor_stages([], ["lang"]), MD.gradient_boosting(1, 1.0, 8)])
    _, m = EV.evaluate_model("rates", est, df, df)
    return IO.metrics_frame(spark, [m | {"model_object": est}]).select("model", *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "roc_auc")])


@query("pca_variance_embeddings", """
SELECT i AS dimension, round(var_samp(x), 6) AS variance FROM (
  SELECT unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings WHERE embedding IS NOT NULL) GROUP BY i""")
def q_pca_variance_embeddings(spark, d):
    """Variance shares times squared loadings add up to each dimension's variance."""
    e = tb(spark, d, "embeddings").where(F.col("embedding").isNotNull()).select(F.col("embedding").cast("array<double>").alias("v"))
    n = e.select(F.size("v").alias("n")).first()["n"]
    model = PCA_.pca_fit(cut_lineage(e.select(array_to_vector("v").alias("features"))), "features", n)
    total = e.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.var_samp("x").alias("v")).agg(F.sum("v").alias("total"))
    ld = PCA_.loadings(spark, model, [str(i) for i in range(n)]).join(
        PCA_.scree(spark, model).select((F.col("component") - 1).alias("component"), "ratio"), "component")
    x = ld.groupBy(F.col("feature").cast("long").alias("dimension")).agg(F.sum(F.col("ratio") * F.col("loading") ** 2).alias("share"))
    return x.crossJoin(F.broadcast(total)).select("dimension", F.round(F.col("share") * F.col("total"), 6).alias("variance"))  # one row


@query("wide_components_embeddings", """
WITH v AS (SELECT var_samp(x) AS v FROM (
  SELECT unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings WHERE embedding IS NOT NULL) GROUP BY i)
SELECT c::INT AS component, round((SELECT sum(v) FROM v), 6) AS total_variance, true AS same_share, true AS same_spread FROM range(1, 11) t(c)""")
def q_wide_components_embeddings(spark, d):
    """E12-E14 without a d x d matrix: shares equal those of the whole decomposition to 1e-6, projections
    have the components' variances, and the total is that of all dimensions."""
    e = cut_lineage(tb(spark, d, "embeddings").where(F.col("embedding").isNotNull()).select(F.col("embedding").cast("array<double>").alias("v")))
    n = e.select(F.size("v").alias("n")).first()["n"]
    wide = WP.wide_pca_fit(e, "v", n, 10)
    whole = PCA_.scree(spark, PCA_.pca_fit(e.select(array_to_vector("v").alias("features")), "features", n))
    spread = WP.wide_project(wide, e, "v", "p").select(F.posexplode("p").alias("i", "x")).groupBy((F.col("i") + 1).alias("component")).agg(F.var_samp("x").alias("spread"))
    both = WP.wide_scree(spark, wide).select("component", F.col("ratio").alias("share")).join(whole.select("component", "ratio"), "component").join(spread, "component")
    return both.select(F.col("component").cast("int").alias("component"), F.round(F.lit(wide.total), 6).alias("total_variance"),
                       (F.abs(F.col("share") - F.col("ratio")) < 1e-6).alias("same_share"),
                       (F.abs(F.col("spread") / wide.total - F.col("share")) < 1e-6).alias("same_spread"))


@query("permutation_of_unread_column", """
SELECT 'n_chars' AS feature, 0.0::DOUBLE AS importance_mean, 0.0::DOUBLE AS importance_std""")
def q_permutation_of_unread_column(spark, d):
    """Shuffling a column that the model does not read changes nothing."""
    df = cut_lineage(labelled(spark, d).join(tb(spark, d, "documents").select("doc_id", "n_chars"), "doc_id"))
    model = Pipeline(stages=[*PP.preprocessor_stages([], ["lang"]), MD.random_forest(1, 8, "all", bootstrap=False)]).fit(df)
    return IM.permutation_importance(model, df, ["n_chars"], "doc_id", repeats=10)


@query("permutation_of_read_column", f"""
WITH u AS (SELECT doc_id, coalesce(lang, 'none') = 'en' AS en FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL),
s(seed) AS (VALUES {", ".join(f"({42 + r})" for r in range(10))}),
a AS (SELECT en, row_number() OVER (ORDER BY doc_id) AS i FROM u),
b AS (SELECT seed, en, row_number() OVER (PARTITION BY seed ORDER BY
  ('0x' || substr(md5(concat_ws(':', CAST(doc_id AS VARCHAR), CAST(seed AS VARCHAR))), 1, 15))::BIGINT, doc_id) AS i FROM u, s),
r AS (SELECT seed, avg(CAST(a.en = b.en AS DOUBLE)) AS acc FROM a JOIN b USING (i) GROUP BY seed)
SELECT 'lang' AS feature, round(1 - avg(acc), 6) AS importance_mean, round(stddev_pop(acc), 6) AS importance_std FROM r""")
def q_permutation_of_read_column(spark, d):
    """A model that knows the label from the language loses what each of ten shuffles takes."""
    df = labelled(spark, d).withColumn("label", (F.col("lang") == "en").cast("int"))
    model = Pipeline(stages=[*PP.preprocessor_stages([], ["lang"]), MD.random_forest(1, 8, "all", bootstrap=False)]).fit(df)
    out = IM.permutation_importance(model, df, ["lang"], "doc_id", repeats=10)
    return out.select("feature", *[F.round(c, 6).alias(c) for c in ("importance_mean", "importance_std")])


@query("grid_of_orders", """
SELECT a.o_orderstatus AS status, b.o_orderpriority AS priority
FROM (SELECT DISTINCT o_orderstatus FROM orders) a, (SELECT DISTINCT o_orderpriority FROM orders) b""")
def q_grid_of_orders(spark, d):
    """All combinations of two value lists of the table."""
    o = tb(spark, d, "orders")
    values = lambda c: sorted(r[0] for r in o.select(c).distinct().collect())  # noqa: E731  a few levels
    grid = sample_grid({"status": values("o_orderstatus"), "priority": values("o_orderpriority")})
    return IO.metrics_frame(spark, grid)


@query("logspace_parts", """
SELECT p_size, round(pow(10, -3 + 6.0 * (p_size % 10) / 9), 9) AS value FROM part""")
def q_logspace_parts(spark, d):
    """ten values from 10^-3 to 10^3, one picked by each part's size."""
    v = FX.logspace(-3, 3, 10)
    return tb(spark, d, "part").select("p_size", F.round(F.element_at(v, F.col("p_size") % 10 + 1), 9).alias("value"))


def patient_model(spark, d):
    """Engineered records with label, and a forest fitted on them."""
    df = cut_lineage(engineer_features(patients_from(tb(spark, d, "orders"), "o_orderkey")).withColumnRenamed("cancer", "label"))
    return df, PP.pipeline(["age", "bmi", "clinical_risk_score"], ["gender"], MD.random_forest(5, 4)).fit(df)


@query("report_rows_patients", f"""
WITH p AS ({patients_sql('orders', 'o_orderkey')})
SELECT CAST(patient_id AS BIGINT) AS patient_no, cancer AS actual, true AS consistent FROM p""")
def q_report_rows_patients(spark, d):
    """A row per record with its label; what is predicted follows from the
    probability, and the stored model says the same as the one in memory."""
    df, model = patient_model(spark, d)
    path = scratch_path(spark, "models")
    IO.save_models({"Forest": model}, path, best="Forest")
    rep = RP.prediction_report(df, IO.load_model(path, ["absent", "best_model"]), "label")
    own = model.transform(df).select(F.col("patient_id").alias("id"), F.col("prediction").cast("int").alias("own"))
    ok = (F.col("Predicted") == F.col("own")) & (F.col("Correct") == (F.col("Actual") == F.col("Predicted")).cast("int")) & F.col("Probability").between(0, 1)
    return rep.join(own, rep.Patient_No == own.id).select(F.col("Patient_No").cast("long").alias("patient_no"), F.col("Actual").alias("actual"), ok.alias("consistent"))


@query("batch_rows_patients", f"""
WITH p AS ({patients_sql('orders', 'o_orderkey')})
SELECT CAST(patient_id AS BIGINT) AS patient_id, true AS consistent, count(*) OVER () AS total_patients FROM p""")
def q_batch_rows_patients(spark, d):
    """A scored row per record whose tier follows from its probability, and
    a summary that agrees with the rows."""
    df, model = patient_model(spark, d)
    raw = [c for c in patients_from(tb(spark, d, "orders").limit(0), "o_orderkey").columns if c != "cancer"]
    got = score_records(df.select(*raw), model, "forest", "patient_id")
    rows, s = got["scored"], got["summary"].first()
    positive = rows.where("prediction = 1").count()
    agrees = got["rejected"].count() == 0 and s["positive_cases"] == positive and s["model_used"] == "forest" and s["timestamp"] is not None
    ok = (F.col("cancer_risk") == FX.risk_tier(F.col("probability"))) & (F.col("prediction") == (F.col("probability") > 0.5).cast("int")) & F.lit(agrees)
    return rows.select(F.col("patient_id").cast("long").alias("patient_id"), F.coalesce(ok, F.lit(False)).alias("consistent"), F.lit(s["total_patients"]).cast("long").alias("total_patients"))


#: Records of an arriving file, which one task writes and one reads.
BATCH_FILE_ROWS = 250_000


@query("stream_rows_patients", f"""
WITH p AS ({patients_sql('orders', 'o_orderkey')})
SELECT CAST(patient_id AS BIGINT) AS patient_id, CASE WHEN age BETWEEN 30 AND 70 AND gender = 'Female' THEN 'scored' ELSE 'rejected' END AS sink FROM p""")
def q_stream_rows_patients(spark, d):
    """ST1, P12: JSON files arrive in three batches; each record lands in one of the two sinks,
    and the batch summaries add up to the scored rows."""
    df, model = patient_model(spark, d)
    raw = patients_from(tb(spark, d, "orders"), "o_orderkey").drop("cancer")
    src, out = scratch_path(spark, "stream_json"), scratch_path(spark, "stream_sinks")
    files = 3 * max(1, -(-raw.count() // (3 * BATCH_FILE_ROWS)))  # three batches of files of bounded size
    raw.repartition(files, "patient_id").write.json(src)
    score_stream(spark, src, raw.schema, model, out, fmt="json", required=["age", "gender"], allowed={"gender": ["Female"]},
                 ranges={"age": (30, 70)}, max_files=files // 3)
    read = lambda name: spark.read.parquet(os.path.join(out, name))
    total = read("summary").agg(F.sum("total_patients").alias("n")).first()["n"]
    if total != read("scored").count():
        raise ValueError("the summaries do not add up to the scored rows")
    rows = lambda name: read(name).select(F.col("patient_id").cast("long").alias("patient_id"), F.lit(name).alias("sink"))
    return rows("scored").unionAll(rows("rejected"))


@query("record_rules_patients", f"""
WITH p AS ({patients_sql('orders', 'o_orderkey')})
SELECT CAST(patient_id AS BIGINT) AS patient_id, concat_ws('; ',
  CASE WHEN patient_id % 13 = 0 THEN 'weight_kg: missing' END, CASE WHEN patient_id % 11 = 0 THEN 'gender: not allowed' END,
  CASE WHEN patient_id % 17 = 0 THEN 'asthma: not allowed' END, CASE WHEN patient_id % 7 = 0 THEN 'age: out of range' END) AS reasons FROM p""")
def q_record_rules_patients(spark, d):
    """The record rule set on records with planted faults."""
    p = patients_from(tb(spark, d, "orders"), "o_orderkey")
    every = lambda k, c, v: F.when(F.col("patient_id") % k == 0, F.lit(v)).otherwise(F.col(c))
    p = p.withColumns({"weight_kg": every(13, "weight_kg", None), "gender": every(11, "gender", "X"), "asthma": every(17, "asthma", 2), "age": every(7, "age", 0)})
    return check_records(p).select(F.col("patient_id").cast("long").alias("patient_id"), F.array_join("reasons", "; ").alias("reasons"))


@query("correlation_wide_embeddings", """
WITH x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings WHERE embedding IS NOT NULL)
SELECT CAST(a.i AS VARCHAR) AS col_a, CAST(b.i AS VARCHAR) AS col_b, round(corr(a.v, b.v), 6) AS corr
FROM x a JOIN x b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY a.i, b.i""")
def q_correlation_wide_embeddings(spark, d):
    """Every pair of 64 columns."""
    e = tb(spark, d, "embeddings").where(F.col("embedding").isNotNull()).select(F.col("embedding").cast("array<double>").alias("v"))
    n = e.select(F.size("v").alias("n")).first()["n"]
    c = PR.correlation_wide(e.select(array_to_vector("v").alias("x")), "x", [str(i) for i in range(n)])
    return c.withColumn("corr", F.round("corr", 6))


@query("correlation_gaps_embeddings", """
WITH x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings WHERE embedding IS NOT NULL),
y AS (SELECT vec_id, i, CASE WHEN v < 0.2 THEN v END AS v FROM x)
SELECT CAST(a.i AS VARCHAR) AS col_a, CAST(b.i AS VARCHAR) AS col_b, round(corr(a.v, b.v), 6) AS corr
FROM y a JOIN y b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY a.i, b.i""")
def q_correlation_gaps_embeddings(spark, d):
    """Every pair of 64 columns over the rows where neither is null (here: 0.2 or more)."""
    e = tb(spark, d, "embeddings").where(F.col("embedding").isNotNull()).select(F.col("embedding").cast("array<double>").alias("v"))
    n = e.select(F.size("v").alias("n")).first()["n"]
    e = e.select(F.transform("v", lambda x: F.when(x < 0.2, x)).alias("v"))
    return PR.correlation_wide(e, "v", [str(i) for i in range(n)]).withColumn("corr", F.round("corr", 6))


@query("roc_corners_events", f"""{SE},
{CURVE_SQL.format(src='se')},
s AS (SELECT *, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg, lag(score) OVER w AS before FROM cum WINDOW w AS (ORDER BY score DESC))
SELECT score AS threshold, round(fp / CAST(n AS DOUBLE), 9) AS fpr, round(tp / CAST(p AS DOUBLE), 9) AS tpr, tp, fp FROM s, tot
WHERE before IS NULL OR next_pos IS NULL OR NOT (next_pos = pos AND next_neg = neg)
UNION ALL SELECT 'infinity'::DOUBLE, 0, 0, 0, 0""")
def q_roc_corners_events(spark, d):
    """The curve without the points that continue the step before them."""
    points = M.curve_points(scored_events(spark, d))
    p, n = M.class_totals(points)
    c = M.roc_curve(None, points=M.corner_points(points), totals=(p, n))
    return c.select("threshold", R9(F.col("fpr")).alias("fpr"), R9(F.col("tpr")).alias("tpr"), "tp", "fp")


@query("one_hot_vector_lineitem", """
SELECT l_orderkey, l_linenumber, CAST(dense_rank() OVER (ORDER BY CAST(l_partkey AS VARCHAR)) - 1 AS INTEGER) AS place FROM lineitem""")
def q_one_hot_vector_lineitem(spark, d):
    """F16: thousands of levels as one sparse vector; the 1 is at the level's alphabetical place."""
    li = tb(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"))
    x = FX.one_hot_vector(li, ["part"])
    return x.select("l_orderkey", "l_linenumber", FX.vector_place("part_oh").alias("place"))


@query("stratified_split_many_strata", f"""
SELECT o_orderkey, o_custkey, CASE WHEN {mark_sql(['o_orderkey'], 21, 0.3, ['o_custkey'])} THEN 'test' ELSE 'train' END AS split FROM orders""")
def q_stratified_split_many_strata(spark, d):
    """A stratum for each customer."""
    return stratified_split(tb(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey", 0.3, "o_orderkey", 21)


@query("stratified_kfold_null_strata", f"""
SELECT o_orderkey, s, CAST((row_number() OVER (PARTITION BY s ORDER BY {sql_hash(['o_orderkey'], 23)}, o_orderkey) - 1) % 5 AS INTEGER) AS fold
FROM (SELECT o_orderkey, nullif(o_orderstatus, 'F') AS s FROM orders)""")
def q_stratified_kfold_null_strata(spark, d):
    """Rows whose stratum is null are a stratum of their own."""
    o = tb(spark, d, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("s"))
    return stratified_kfold(o, "s", 5, "o_orderkey", 23)


@query("stratified_kfold_unshuffled", """
SELECT o_orderkey, o_orderstatus, CAST(floor((row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) * 5
  / count(*) OVER (PARTITION BY o_orderstatus)) AS INTEGER) AS fold FROM orders""")
def q_stratified_kfold_unshuffled(spark, d):
    """Each class in five runs of rows."""
    return stratified_kfold(tb(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", 5, "o_orderkey", 0, shuffle=False)


@query("sequential_id_null_keys", """
SELECT o_orderkey, v, CAST(row_number() OVER (ORDER BY v NULLS FIRST, o_orderkey) AS BIGINT) AS row_id
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS v FROM orders)""")
def q_sequential_id_null_keys(spark, d):
    """Rows with a null order key come first, whatever the buckets."""
    o = tb(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_totalprice")).alias("v"))
    return sequential_id(o, ["v", "o_orderkey"], out="row_id", start=1, buckets=7)


# ------------------------------------------------------------------ E28: each table of the analysis of one scored frame
def _rounded(df, *cols):
    return df.withColumns({c: R9(F.col(c)) for c in cols or [n for n, t in df.dtypes if t == "double"]})


def _analysis(table, sql, *cols):
    @query(f"analysis_{table}_events", sql)
    def run(spark, d):
        scored = scored_events(spark, d).withColumn("prediction", M.apply_threshold("score", 0.5))
        return _rounded(RP.analyze_model(scored)[table], *cols)
    return run


for _table, _twin, _cols in (
        ("confusion", "confusion_matrix_events", ()), ("confusion_normalized", "confusion_normalized_events", ()),
        ("metrics", "metrics_report_events", ("metric_value",)), ("roc_curve", "roc_curve_events", ("fpr", "tpr", "j")),
        ("class_stats", "score_stats_events", ("mean", "std")), ("histogram", "score_histogram_events", ()),
        ("thresholds", "threshold_table_events", ()), ("balance", "label_balance_events", ("positive_pct", "negative_pct"))):
    _analysis(_table, ORACLE[_twin], *_cols)

_analysis("pr_curve", f"""{SE},
{CURVE_SQL.format(src='se')}
SELECT score AS threshold, round(tp / (tp + fp), 9) AS precision, round(tp / CAST(p AS DOUBLE), 9) AS recall, tp, fp FROM cum, tot
UNION ALL SELECT NULL, 1, 0, 0, 0""", "precision", "recall")
_analysis("best_youden", f"""{SE},
{CURVE_SQL.format(src='se')}
SELECT score AS threshold, round(tp / CAST(p AS DOUBLE), 9) AS tpr, round(fp / CAST(n AS DOUBLE), 9) AS fpr,
  round((CAST(tp AS HUGEINT) * n - CAST(fp AS HUGEINT) * p) / (CAST(p AS DOUBLE) * n), 9) AS j FROM cum, tot
ORDER BY CAST(tp AS HUGEINT) * n - CAST(fp AS HUGEINT) * p DESC, score DESC LIMIT 1""", "tpr", "fpr", "j")
_analysis("best_f1", f"""{SE},
{CURVE_SQL.format(src='se')},
f AS (SELECT score, tp / (tp + fp) AS pr, tp / CAST(p AS DOUBLE) AS re FROM cum, tot)
SELECT score AS threshold, round(pr, 9) AS precision, round(re, 9) AS recall, round(2 * pr * re / (pr + re + 1e-10), 9) AS f1 FROM f
ORDER BY 2 * pr * re / (pr + re + 1e-10) DESC, score LIMIT 1""", "precision", "recall", "f1")
