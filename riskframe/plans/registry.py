"""Registered queries over the driver tables, each with its DuckDB oracle.

Every query reads whole driver tables (or tables Spark derives from them)
and returns a DataFrame; computed columns carry the same alias in the SQL
twin. Doubles that are sums or ratios are rounded to 9 places on both sides
so that summation order cannot change the comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions import features as FX
from riskframe.functions import columns as PC
from riskframe.functions.hashing import hash_below
from riskframe.functions.scorecard import scorecard
from riskframe.operators import metrics as M
from riskframe.operators import profile as PR
from riskframe.operators import ranking as RK
from riskframe.operators import relational as RL
from riskframe.operators import report as RP
from riskframe.operators import sampling as SA
from riskframe.operators.prefix import sequential_id
from riskframe.plans.oracle import mark_sql, patients_sql, sql_hash
from riskframe.sources import io as IO

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _bigint_counts(sql: str) -> str:
    """DuckDB's count_if is HUGEINT where Spark's is bigint: cast each call."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0 or sql[max(0, j - 5):j] == "CAST(":
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j:k] + " AS BIGINT)")
        i = k


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = _bigint_counts(sql.strip())
        return fn
    return deco


def tb(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def R9(c):
    return F.round(c, 9)


# ------------------------------------------------------------------ shared frames
def scored_events(spark, d) -> DataFrame:
    """events as a scored table: label = purchase, score = value / 500."""
    return tb(spark, d, "events").select(
        F.col("event_id").alias("id"),
        (F.col("event_type") == "purchase").cast("int").alias("label"),
        (F.col("value") / F.lit(500.0)).alias("score"))


SE = ("WITH se AS (SELECT event_id AS id, CAST(event_type = 'purchase' AS INTEGER) AS label, "
      "value / 500.0::DOUBLE AS score FROM events)")


def scored_lines(spark, d) -> DataFrame:
    """lineitem as a scored table with heavy ties: label = returnflag R, score = discount."""
    return tb(spark, d, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"), F.col("l_discount").alias("score"))


SL = ("WITH sl AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label, l_discount AS score FROM lineitem)")


# ------------------------------------------------------------------ flagship (minimum slice)
# An order-priority ordinal and a scorecard over line items.
PRIORITY_POINTS = {"1-URGENT": 4, "2-HIGH": 3, "3-MEDIUM": 2, "4-NOT SPECIFIED": 1}
LINE_RULES = [
    {"kind": "tiers", "col": "l_quantity", "tiers": [(40, 3), (25, 2), (10, 1)]},
    {"kind": "flag", "col": "l_returnflag", "value": "R", "points": 4},
    {"kind": "tiers", "col": "l_discount", "tiers": [(0.08, 2), (0.05, 1)]},
    {"kind": "linear", "terms": [("priority_points", 1)]},
    {"kind": "first_match", "cases": [("o_orderstatus = 'F'", 2), ("o_orderstatus = 'P'", 1)]},
    {"kind": "any_of", "conds": ["o_totalprice > 400000", "l_extendedprice > 90000"], "points": 1},
]


def scored_line_orders(spark, d) -> DataFrame:
    li = PC.filter_ranges(tb(spark, d, "lineitem"), {"l_quantity": (1, 50)})
    o = tb(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    j = j.withColumn("priority_points", FX.ordinal("o_orderpriority", PRIORITY_POINTS))
    return j.withColumn("score", scorecard(LINE_RULES))


@query("scorecard_tiers", f"""
WITH j AS (
  SELECT l.*, o.o_orderstatus, o.o_totalprice,
    CASE o.o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 2
      WHEN '4-NOT SPECIFIED' THEN 1 ELSE 0 END AS pp
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE l.l_quantity BETWEEN 1 AND 50),
s AS (SELECT *,
    (CASE WHEN l_quantity > 40 THEN 3 WHEN l_quantity > 25 THEN 2 WHEN l_quantity > 10 THEN 1 ELSE 0 END)
  + (CASE WHEN l_returnflag = 'R' THEN 4 ELSE 0 END)
  + (CASE WHEN l_discount > 0.08 THEN 2 WHEN l_discount > 0.05 THEN 1 ELSE 0 END)
  + pp
  + (CASE WHEN o_orderstatus = 'F' THEN 2 WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END)
  + (CASE WHEN o_totalprice > 400000 OR l_extendedprice > 90000 THEN 1 ELSE 0 END) AS score
  FROM j)
SELECT CASE WHEN score <= 4 THEN 'Low' WHEN score <= 8 THEN 'Medium' ELSE 'High' END AS tier,
  count(*) AS n_lines, round(avg(score), 9) AS avg_score,
  round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM s GROUP BY 1
""")
def q_scorecard_tiers(spark, d):
    s = scored_line_orders(spark, d)
    tier = FX.cut_open("score", (4, 8), ("Low", "Medium", "High"))
    return (s.groupBy(tier.alias("tier"))
            .agg(F.count(F.lit(1)).alias("n_lines"), R9(F.avg("score")).alias("avg_score"),
                 F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue")))


# ------------------------------------------------------------------ sources
@query("read_table_customer", "SELECT * FROM customer")
def q_read_table_customer(spark, d):
    schema = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return IO.read_table(spark, f"{d}/customer.parquet", schema)


@query("write_read_csv_orders", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def q_write_read_csv_orders(spark, d):
    from riskframe.session import scratch_path
    path = scratch_path(spark, "orders_csv")
    IO.write_table(tb(spark, d, "orders"), path, fmt="csv")
    schema = ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string")  # as stored: no time zone
    return IO.read_table(spark, path, schema, fmt="csv")


@query("read_records_json_events", """
SELECT event_id, user_id, event_type, value FROM events""")
def q_read_records_json_events(spark, d):
    from riskframe.session import scratch_path
    path = scratch_path(spark, "events_json")
    IO.write_table(tb(spark, d, "events").select("event_id", "user_id", "event_type", "value"), path, fmt="json")
    return IO.read_records(spark, path, "event_id long, user_id long, event_type string, value double", fmt="json")


@query("generate_patients", patients_sql("orders", "o_orderkey"))
def q_generate_patients(spark, d):
    from riskframe.sources.generate import patients_from
    return patients_from(tb(spark, d, "orders"), "o_orderkey")


@query("explode_batch_embeddings", """
SELECT vec_id, CAST(i AS INTEGER) AS record_no, CAST(embedding[i] AS DOUBLE) AS value
FROM embeddings, range(1, 65) t(i) WHERE i <= len(embedding)""")
def q_explode_batch_embeddings(spark, d):
    e = IO.explode_batch(tb(spark, d, "embeddings"), "embedding", keep=["vec_id"])
    return e.select("vec_id", "record_no", F.col("value").cast("double").alias("value"))


@query("read_table_pushdown_lineitem", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 40""")
def q_read_table_pushdown_lineitem(spark, d):
    """The condition reaches the Parquet scan although NaN is mapped to null."""
    li = IO.read_table(spark, f"{d}/lineitem.parquet", where="l_quantity > 40")
    return li.select("l_orderkey", "l_linenumber", "l_quantity")


@query("model_catalog_scores", f"""
{SL},
m AS (SELECT 'l_discount' AS name, round(avg(CAST((score >= 0.05) = (label = 1) AS INTEGER)), 9) AS accuracy FROM sl)
SELECT name, name AS type, accuracy, 0.0::DOUBLE AS roc_auc, 0.0::DOUBLE AS f1_score,
  '{{"threshold":"0.05"}}' AS parameters FROM m""")
def q_model_catalog_scores(spark, d):
    """Run metadata computed from data, written as JSON, read back
    with the declared schema and listed one row per model (absent metrics 0)."""
    from riskframe.session import scratch_path
    from riskframe.sources.catalog import model_catalog
    acc = scored_lines(spark, d).agg(
        R9(F.avg(((F.col("score") >= 0.05) == (F.col("label") == 1)).cast("int"))).alias("a")).first()["a"]
    meta = {"models_available": ["l_discount"], "best_model": "l_discount", "feature_names": ["l_discount"],
            "categorical_columns": [], "numerical_columns": ["l_discount"], "training_date": "",
            "performance": {"l_discount": {"accuracy": acc, "roc_auc": None, "f1_score": None}}}
    path = scratch_path(spark, "run_meta")
    IO.write_run_metadata(spark, meta, path)
    params = scored_lines(spark, d).limit(1).select(
        F.lit("l_discount").alias("name"), F.create_map(F.lit("threshold"), F.lit("0.05")).alias("parameters"))
    listed = model_catalog(IO.read_run_metadata(spark, path), params)
    return listed.withColumn("parameters", F.to_json("parameters"))


# ------------------------------------------------------------------ projections / predicates
@query("drop_columns_lineitem", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
  l_shipdate FROM lineitem""")
def q_drop_columns_lineitem(spark, d):
    return PC.drop_columns(tb(spark, d, "lineitem"), ["l_returnflag", "l_linestatus", "no_such_column"])


@query("discrete_columns_part", """
SELECT 'p_partkey' AS column_name, count(DISTINCT p_partkey) AS n_distinct, false AS is_string FROM part
UNION ALL SELECT 'p_name', count(DISTINCT p_name), true FROM part
UNION ALL SELECT 'p_brand', count(DISTINCT p_brand), true FROM part
UNION ALL SELECT 'p_type', count(DISTINCT p_type), true FROM part
UNION ALL SELECT 'p_size', count(DISTINCT p_size), false FROM part
UNION ALL SELECT 'p_retailprice', count(DISTINCT p_retailprice), false FROM part
""".replace("FROM part\nUNION", "FROM part\nUNION") + "")
def q_discrete_columns_part(spark, d):
    return PC.discrete_columns(tb(spark, d, "part"), max_distinct=5).drop("is_discrete")


@query("filter_ranges_lineitem", """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
WHERE l_quantity BETWEEN 5 AND 30 AND l_discount BETWEEN 0.02 AND 0.08""")
def q_filter_ranges_lineitem(spark, d):
    li = tb(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return PC.filter_ranges(li, {"l_quantity": (5, 30), "l_discount": (0.02, 0.08)})


@query("cast_columns_orders", """
SELECT o_orderkey, CAST(trunc(o_totalprice) AS INTEGER) AS o_totalprice,
  CAST(o_custkey AS DOUBLE) AS o_custkey FROM orders""")
def q_cast_columns_orders(spark, d):
    o = tb(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    return PC.cast_columns(o, ints=["o_totalprice", "absent"], doubles=["o_custkey"])


@query("set_where_customer", f"""
SELECT c_custkey, CASE WHEN {sql_hash(['c_custkey'], 7)} < {int(0.05 * (1 << 60))} THEN NULL ELSE c_acctbal END
  AS c_acctbal FROM customer""")
def q_set_where_customer(spark, d):
    c = tb(spark, d, "customer").select("c_custkey", "c_acctbal")
    return PC.set_where(c, hash_below(["c_custkey"], 7, 0.05), {"c_acctbal": None})


@query("add_default_discount", """
SELECT l_orderkey, l_linenumber, coalesce(nullif(l_discount, 0), 1.0::DOUBLE) AS l_discount,
  2.5::DOUBLE AS weight FROM lineitem""")
def q_add_default_discount(spark, d):
    li = tb(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return PC.add_default_column(PC.add_default_column(li, "l_discount", 1.0), "weight", 2.5)


@query("resolve_id_part", """
SELECT p_partkey, p_name FROM part""")
def q_resolve_id_part(spark, d):
    df, col = PC.resolve_id_column(tb(spark, d, "part").select("p_partkey", "p_name"), "patient_id",
                                   ["id", "p_partkey"], order_cols=["p_name"])
    return df


@query("resolve_id_generated", """
SELECT p_name, p_brand, CAST(row_number() OVER (ORDER BY p_name, p_brand, p_partkey) + 999 AS BIGINT) AS patient_id
FROM part""")
def q_resolve_id_generated(spark, d):
    df, col = PC.resolve_id_column(tb(spark, d, "part").select("p_name", "p_brand", "p_partkey"), "patient_id",
                                   ["id"], order_cols=["p_name", "p_brand", "p_partkey"])
    return df.drop("p_partkey")


@query("normalize_coerce_events", """
SELECT event_id AS event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_value,
  TRY_CAST(event_type AS INTEGER) AS event_type FROM events""")
def q_normalize_coerce_events(spark, d):
    e = tb(spark, d, "events").select(F.col("event_id").alias("Event ID"),
                                      F.get_json_object("props", "$.k").alias("K Value"),
                                      F.col("event_type").alias("Event Type"))
    return PC.coerce_numeric(PC.normalize_columns(e), {"k_value": "int", "event_type": "int"})


@query("parse_flags_events", """
SELECT event_id,
  CAST(coalesce(lower(trim(json_extract_string(props, '$.k'))) IN ('1', 'true', 'yes'), false) AS INTEGER) AS k_flag,
  CAST(coalesce(lower(trim(event_type)) IN ('1', 'true', 'yes'), false) AS INTEGER) AS event_type,
  0 AS opted_in FROM events""")
def q_parse_flags_events(spark, d):
    e = tb(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k_flag"), "event_type")
    return PC.parse_flags(e, ["k_flag", "event_type", "opted_in"])


@query("validate_lineitem", """
SELECT l_orderkey, l_linenumber, concat_ws(';',
  CASE WHEN l_orderkey IS NULL THEN 'l_orderkey: missing' END,
  CASE WHEN l_returnflag IS NOT NULL AND l_returnflag NOT IN ('R', 'A') THEN 'l_returnflag: not allowed' END,
  CASE WHEN l_quantity IS NOT NULL AND NOT (l_quantity BETWEEN 1 AND 45) THEN 'l_quantity: out of range' END,
  CASE WHEN l_discount IS NOT NULL AND NOT (l_discount BETWEEN 0.0 AND 0.08) THEN 'l_discount: out of range' END
  ) AS reasons FROM lineitem""")
def q_validate_lineitem(spark, d):
    li = tb(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_discount")
    checked = PC.validate_records(li, required=["l_orderkey"], allowed={"l_returnflag": ["R", "A"]},
                                  ranges={"l_quantity": (1, 45), "l_discount": (0.0, 0.08)})
    return checked.select("l_orderkey", "l_linenumber", F.concat_ws(";", "reasons").alias("reasons"))


@query("valid_rows_lineitem", """
SELECT count(*) AS n_valid FROM lineitem
WHERE l_returnflag IN ('R', 'A') AND l_quantity BETWEEN 1 AND 45 AND l_discount BETWEEN 0.0 AND 0.08""")
def q_valid_rows_lineitem(spark, d):
    li = tb(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity", "l_discount")
    checked = PC.validate_records(li, required=["l_orderkey"], allowed={"l_returnflag": ["R", "A"]},
                                  ranges={"l_quantity": (1, 45), "l_discount": (0.0, 0.08)})
    ok, _ = PC.split_valid(checked)
    return ok.agg(F.count(F.lit(1)).alias("n_valid"))


@query("prediction_report_events", f"""
{SE}
SELECT id AS Patient_No, label AS Actual, CAST(score >= 0.5 AS INTEGER) AS Predicted,
  round_even(score, 4) AS Probability, CAST(CAST(score >= 0.5 AS INTEGER) = label AS INTEGER) AS Correct
FROM se""")
def q_prediction_report_events(spark, d):
    se = scored_events(spark, d).withColumn("prediction", M.apply_threshold("score", 0.5))
    return RK.sort_report(PC.report_projection(se, "id", "label", "prediction", "score"))


@query("report_head_events", f"""
{SE}
SELECT id AS Patient_No, label AS Actual, CAST(score >= 0.5 AS INTEGER) AS Predicted,
  round_even(score, 4) AS Probability, CAST(CAST(score >= 0.5 AS INTEGER) = label AS INTEGER) AS Correct
FROM se ORDER BY id LIMIT 10""")
def q_report_head_events(spark, d):
    se = scored_events(spark, d).withColumn("prediction", M.apply_threshold("score", 0.5))
    return RK.head(PC.report_projection(se, "id", "label", "prediction", "score"), 10)


@query("with_predictions_events", f"""
{SE}
SELECT id, label, score, CAST(score >= 0.5 AS INTEGER) AS prediction,
  CAST(score >= 0.5 AS INTEGER) AS predicted_cancer, score AS cancer_probability,
  CAST(score >= 0.5 AS INTEGER) = label AS prediction_correct, round_even(score * 100, 2) AS probability_rounded
FROM se""")
def q_with_predictions_events(spark, d):
    se = scored_events(spark, d).withColumn("prediction", M.apply_threshold("score", 0.5))
    return PC.with_predictions(se, "label", "prediction", "score")


# ------------------------------------------------------------------ joins
@query("attach_labels_documents", """
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def q_attach_labels_documents(spark, d):
    docs = tb(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return RL.attach_labels(docs, tb(spark, d, "labels"), "doc_id")


@query("drop_keys_orders", f"""
SELECT o_orderkey, o_custkey FROM orders
WHERE NOT ({sql_hash(['o_orderkey'], 3)} < {int(0.1 * (1 << 60))})""")
def q_drop_keys_orders(spark, d):
    o = tb(spark, d, "orders").select("o_orderkey", "o_custkey")
    gone = SA.sample_fraction(o, 0.1, "o_orderkey", 3).select("o_orderkey")
    return RL.drop_keys(o, gone, "o_orderkey")


@query("lookup_nation_customer", """
SELECT c.c_custkey, coalesce(n.n_name, 'UNKNOWN') AS nation,
  CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 ELSE 0 END AS segment_code
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def q_lookup_nation_customer(spark, d):
    c = tb(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    out = RL.lookup_table(c, tb(spark, d, "nation"), "c_nationkey", "n_name", "UNKNOWN", out="nation",
                          table_key="n_nationkey")
    out = out.withColumn("segment_code", FX.map_lookup("c_mktsegment", {"AUTOMOBILE": 1, "BUILDING": 2}, 0))
    return out.select("c_custkey", "nation", "segment_code")


@query("ordinal_priority_orders", """
SELECT o_orderpriority, CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 2
  WHEN '4-NOT SPECIFIED' THEN 1 ELSE 0 END AS points, count(*) AS n FROM orders GROUP BY 1, 2""")
def q_ordinal_priority_orders(spark, d):
    o = tb(spark, d, "orders")
    return (o.groupBy("o_orderpriority", FX.ordinal("o_orderpriority", PRIORITY_POINTS).alias("points"))
            .agg(F.count(F.lit(1)).alias("n")))


def damaged_customer(spark, d) -> DataFrame:
    c = tb(spark, d, "customer")
    return PC.set_where(c, hash_below(["c_custkey"], 7, 0.05), {"c_acctbal": None, "c_nationkey": None})


DAMAGED_CUSTOMER = f"""WITH dc AS (
  SELECT c_custkey, c_name, c_mktsegment,
    CASE WHEN {sql_hash(['c_custkey'], 7)} < {int(0.05 * (1 << 60))} THEN NULL ELSE c_acctbal END AS c_acctbal,
    CASE WHEN {sql_hash(['c_custkey'], 7)} < {int(0.05 * (1 << 60))} THEN NULL ELSE c_nationkey END AS c_nationkey
  FROM customer)"""


@query("impute_customer", f"""
{DAMAGED_CUSTOMER}
SELECT c_custkey, coalesce(c_acctbal, (SELECT median(c_acctbal) FROM dc)) AS c_acctbal,
  coalesce(c_nationkey, CAST(trunc((SELECT median(c_nationkey) FROM dc)) AS INTEGER)) AS c_nationkey
FROM dc""")
def q_impute_customer(spark, d):
    from riskframe.operators.quality import impute
    dc = damaged_customer(spark, d).select("c_custkey", "c_acctbal", "c_nationkey")
    return impute(dc, exclude=["c_custkey"])


@query("null_counts_customer", f"""
{DAMAGED_CUSTOMER}
SELECT 'c_custkey' AS column_name, count_if(c_custkey IS NULL) AS nulls FROM dc
UNION ALL SELECT 'c_acctbal', count_if(c_acctbal IS NULL) FROM dc
UNION ALL SELECT 'c_nationkey', count_if(c_nationkey IS NULL) FROM dc
UNION ALL SELECT 'c_mktsegment', count_if(c_mktsegment IS NULL) FROM dc""")
def q_null_counts_customer(spark, d):
    return PR.null_counts(damaged_customer(spark, d), ["c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment"])


# ------------------------------------------------------------------ aggregates
@query("shape_lineitem", "SELECT count(*) AS rows, 11 AS columns FROM lineitem")
def q_shape_lineitem(spark, d):
    return PR.shape(tb(spark, d, "lineitem"))


@query("column_medians_lineitem", """
SELECT median(l_quantity) AS l_quantity, median(l_extendedprice) AS l_extendedprice,
  median(l_discount) AS l_discount, median(l_tax) AS l_tax, CAST(median(l_linenumber) AS DOUBLE) AS l_linenumber
FROM lineitem""")
def q_column_medians_lineitem(spark, d):
    return PR.column_medians(tb(spark, d, "lineitem"),
                             ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"])


@query("column_modes_part", """
SELECT (SELECT p_brand FROM part GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS p_brand,
  (SELECT p_type FROM part GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS p_type,
  (SELECT p_size FROM part GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS p_size,
  (SELECT p_retailprice FROM part GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS p_retailprice""")
def q_column_modes_part(spark, d):
    return PR.column_modes(tb(spark, d, "part"), ["p_brand", "p_type", "p_size", "p_retailprice"])


@query("duplicate_count_lineitem", """
SELECT CAST(count(*) - count(DISTINCT (l_returnflag, l_linestatus, l_quantity)) AS BIGINT) AS duplicates
FROM lineitem""")
def q_duplicate_count_lineitem(spark, d):
    return PR.duplicate_count(tb(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity"))


@query("range_summary_orders", """
SELECT 'o_totalprice' AS column_name, min(o_totalprice) AS min_value, max(o_totalprice) AS max_value FROM orders
UNION ALL SELECT 'o_custkey', CAST(min(o_custkey) AS DOUBLE), CAST(max(o_custkey) AS DOUBLE) FROM orders""")
def q_range_summary_orders(spark, d):
    return PR.range_summary(tb(spark, d, "orders"), ["o_totalprice", "o_custkey"])


@query("label_balance_events", f"""
{SE}
SELECT count_if(label = 1) AS positives, count_if(label = 0) AS negatives, count(*) AS total,
  round(100 * (count_if(label = 1) / count(*)), 9) AS positive_pct,
  round(100 * (count_if(label = 0) / count(*)), 9) AS negative_pct
FROM se""")
def q_label_balance_events(spark, d):
    b = M.label_balance(scored_events(spark, d))
    return b.withColumns({c: R9(F.col(c)) for c in ("positive_pct", "negative_pct")})


@query("score_stats_events", f"""
{SE}
SELECT label, count(score) AS count, round(avg(score), 9) AS mean, round(stddev_pop(score), 9) AS std,
  min(score) AS min, max(score) AS max FROM se GROUP BY label""")
def q_score_stats_events(spark, d):
    s = M.score_stats_by_class(scored_events(spark, d))
    return s.withColumns({"mean": R9(F.col("mean")), "std": R9(F.col("std"))})


@query("correlation_lineitem", """
SELECT 'l_quantity' AS col_a, 'l_extendedprice' AS col_b, round(corr(l_quantity, l_extendedprice), 9) AS corr FROM lineitem
UNION ALL SELECT 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 9) FROM lineitem
UNION ALL SELECT 'l_quantity', 'l_tax', round(corr(l_quantity, l_tax), 9) FROM lineitem
UNION ALL SELECT 'l_extendedprice', 'l_discount', round(corr(l_extendedprice, l_discount), 9) FROM lineitem
UNION ALL SELECT 'l_extendedprice', 'l_tax', round(corr(l_extendedprice, l_tax), 9) FROM lineitem
UNION ALL SELECT 'l_discount', 'l_tax', round(corr(l_discount, l_tax), 9) FROM lineitem""")
def q_correlation_lineitem(spark, d):
    c = PR.correlation_matrix(tb(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return c.withColumn("corr", R9(F.col("corr")))


CM_SQL = f"""{SE},
cm AS (SELECT count_if(label = 0 AND score < 0.5) AS tn, count_if(label = 0 AND score >= 0.5) AS fp,
  count_if(label = 1 AND score < 0.5) AS fn, count_if(label = 1 AND score >= 0.5) AS tp FROM se)"""


@query("confusion_matrix_events", f"{CM_SQL} SELECT * FROM cm")
def q_confusion_matrix_events(spark, d):
    se = scored_events(spark, d).withColumn("prediction", M.apply_threshold("score", 0.5))
    return M.confusion_matrix(se)


@query("confusion_normalized_events", f"""{CM_SQL}
SELECT round(tn / (tn + fp), 9) AS tn_rate, round(fp / (tn + fp), 9) AS fp_rate,
  round(fn / (fn + tp), 9) AS fn_rate, round(tp / (fn + tp), 9) AS tp_rate FROM cm""")
def q_confusion_normalized_events(spark, d):
    se = scored_events(spark, d).withColumn("prediction", M.apply_threshold("score", 0.5))
    n = M.confusion_normalized(se)
    return n.select(*[R9(F.col(c)).alias(c) for c in n.columns])


def _sdiv_sql(a, b):
    return f"coalesce(CAST({a} AS DOUBLE) / nullif({b}, 0), 0.0)"


@query("classification_metrics_events", f"""{CM_SQL}
SELECT tn, fp, fn, tp,
  round({_sdiv_sql('tp + tn', 'tn + fp + fn + tp')}, 9) AS accuracy,
  round({_sdiv_sql('tp', 'tp + fp')}, 9) AS precision,
  round({_sdiv_sql('tp', 'tp + fn')}, 9) AS recall,
  round({_sdiv_sql('tn', 'tn + fp')}, 9) AS specificity,
  round({_sdiv_sql('2 * tp', '2 * tp + fp + fn')}, 9) AS f1,
  round({_sdiv_sql('fp', 'fp + tn')}, 9) AS fpr FROM cm""")
def q_classification_metrics_events(spark, d):
    se = scored_events(spark, d).withColumn("prediction", M.apply_threshold("score", 0.5))
    m = M.classification_metrics(se)
    return m.select("tn", "fp", "fn", "tp", *[R9(F.col(c)).alias(c) for c in
                                                ("accuracy", "precision", "recall", "specificity", "f1", "fpr")])


CURVE_SQL = """pts AS (SELECT score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
    FROM {src} WHERE score IS NOT NULL GROUP BY score),
  cum AS (SELECT score, pos, neg,
    CAST(sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS tp,
    CAST(sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS fp
    FROM pts),
  tot AS (SELECT sum(pos) AS p, sum(neg) AS n FROM pts)"""


def _curve_summary_sql(prefix: str, src: str) -> str:
    return f"""{prefix},
{CURVE_SQL.format(src=src)},
auc AS (SELECT CAST(sum(CAST(neg AS HUGEINT) * (2 * tp - pos)) AS DOUBLE) / (2.0::DOUBLE * CAST(p AS DOUBLE) * CAST(n AS DOUBLE)) AS roc_auc,
   sum(pos * (tp / (tp + fp))) / CAST(p AS DOUBLE) AS average_precision FROM cum, tot GROUP BY p, n),
yj AS (SELECT score AS youden_threshold FROM cum, tot
   ORDER BY CAST(tp AS HUGEINT) * n - CAST(fp AS HUGEINT) * p DESC, score DESC LIMIT 1),
f1 AS (SELECT score AS f1_threshold,
   2 * (tp / (tp + fp)) * (tp / CAST(p AS DOUBLE)) / ((tp / (tp + fp)) + (tp / CAST(p AS DOUBLE)) + 1e-10) AS best_f1
   FROM cum, tot ORDER BY best_f1 DESC, score ASC LIMIT 1)
SELECT round(roc_auc, 9) AS roc_auc, round(average_precision, 9) AS average_precision,
  youden_threshold, f1_threshold, round(best_f1, 9) AS best_f1 FROM auc, yj, f1"""


def _curve_summary(df):
    pts = M.curve_points(df)
    auc = M.roc_auc(df, points=pts).first()["roc_auc"]
    ap = M.average_precision(df, points=pts).first()["average_precision"]
    yj = M.best_youden(df, points=pts).first()["threshold"]
    bf = M.best_f1(df, points=pts).first()
    spark = df.sparkSession
    return spark.createDataFrame(
        [(auc, ap, yj, bf["threshold"], bf["f1"])],
        "roc_auc double, average_precision double, youden_threshold double, f1_threshold double, best_f1 double"
    ).select(R9(F.col("roc_auc")).alias("roc_auc"), R9(F.col("average_precision")).alias("average_precision"),
             "youden_threshold", "f1_threshold", R9(F.col("best_f1")).alias("best_f1"))


@query("curve_summary_events", _curve_summary_sql(SE, "se"))
def q_curve_summary_events(spark, d):
    return _curve_summary(scored_events(spark, d))


@query("curve_summary_lineitem", _curve_summary_sql(SL, "sl"))
def q_curve_summary_lineitem(spark, d):
    return _curve_summary(scored_lines(spark, d))


@query("roc_auc_lineitem", f"""{SL},
{CURVE_SQL.format(src='sl')}
SELECT round(CAST(sum(CAST(neg AS HUGEINT) * (2 * tp - pos)) AS DOUBLE)
  / (2.0::DOUBLE * CAST(p AS DOUBLE) * CAST(n AS DOUBLE)), 9) AS roc_auc FROM cum, tot GROUP BY p, n""")
def q_roc_auc_lineitem(spark, d):
    return M.roc_auc(scored_lines(spark, d)).select(R9(F.col("roc_auc")).alias("roc_auc"))


@query("average_precision_events", f"""{SE},
{CURVE_SQL.format(src='se')}
SELECT round(sum(pos * (tp / (tp + fp))) / CAST(p AS DOUBLE), 9) AS average_precision FROM cum, tot GROUP BY p""")
def q_average_precision_events(spark, d):
    return M.average_precision(scored_events(spark, d)).select(
        R9(F.col("average_precision")).alias("average_precision"))


@query("roc_curve_events", f"""{SE},
{CURVE_SQL.format(src='se')}
SELECT score AS threshold, round(fp / CAST(n AS DOUBLE), 9) AS fpr, round(tp / CAST(p AS DOUBLE), 9) AS tpr,
  tp, fp, round(tp / CAST(p AS DOUBLE) - fp / CAST(n AS DOUBLE), 9) AS j FROM cum, tot
UNION ALL SELECT 'infinity'::DOUBLE, 0, 0, 0, 0, 0""")
def q_roc_curve_events(spark, d):
    c = M.youden(M.roc_curve(scored_events(spark, d)))
    return c.select("threshold", R9(F.col("fpr")).alias("fpr"), R9(F.col("tpr")).alias("tpr"), "tp", "fp",
                    R9(F.col("j")).alias("j"))


@query("pr_curve_lineitem", f"""{SL},
{CURVE_SQL.format(src='sl')}
SELECT score AS threshold, round(tp / (tp + fp), 9) AS precision, round(tp / CAST(p AS DOUBLE), 9) AS recall,
  tp, fp FROM cum, tot
UNION ALL SELECT NULL, 1, 0, 0, 0""")
def q_pr_curve_lineitem(spark, d):
    c = M.pr_curve(scored_lines(spark, d))
    return c.select("threshold", R9(F.col("precision")).alias("precision"), R9(F.col("recall")).alias("recall"),
                    "tp", "fp")


@query("score_histogram_events", f"""{SE},
r AS (SELECT min(score) AS lo, max(score) AS hi FROM se)
SELECT CAST(least(20, floor((score - lo) / ((hi - lo) / 20)) + 1) AS INTEGER) AS bin, label, count(*) AS count
FROM se, r GROUP BY 1, 2""")
def q_score_histogram_events(spark, d):
    return M.score_histogram(scored_events(spark, d), 20)


@query("batch_summary_events", f"""{SE}
SELECT count(*) AS total_patients, count_if(score >= 0.5) AS positive_cases,
  round_even(100 * {_sdiv_sql('count_if(score >= 0.5)', 'count(*)')}, 2) AS positive_percentage FROM se""")
def q_batch_summary_events(spark, d):
    se = scored_events(spark, d).withColumn("prediction", M.apply_threshold("score", 0.5))
    return M.batch_summary(se)


@query("report_summary_events", f"""{SE},
r AS (SELECT label AS a, CAST(score >= 0.5 AS INTEGER) AS p FROM se)
SELECT count(*) AS total, CAST(sum(a) AS BIGINT) AS actual_pos, CAST(sum(p) AS BIGINT) AS predicted_pos,
  CAST(sum(CAST(a = p AS INTEGER)) AS BIGINT) AS correct,
  count_if(a = 0 AND p = 0) AS tn, count_if(a = 0 AND p = 1) AS fp, count_if(a = 1 AND p = 0) AS fn,
  count_if(a = 1 AND p = 1) AS tp,
  round(100 * sum(a) / count(*), 9) AS actual_pct, round(100 * sum(p) / count(*), 9) AS predicted_pct,
  round(100 * sum(CAST(a = p AS INTEGER)) / count(*), 9) AS correct_pct FROM r""")
def q_report_summary_events(spark, d):
    se = scored_events(spark, d).withColumn("prediction", M.apply_threshold("score", 0.5))
    rep = PC.report_projection(se, "id", "label", "prediction", "score")
    s = M.report_summary(rep)
    return s.withColumns({c: R9(F.col(c)) for c in ("actual_pct", "predicted_pct", "correct_pct")})


KFOLD_EVENTS = f"""folds AS (SELECT event_id, event_type, value,
  CAST((row_number() OVER (ORDER BY {sql_hash(['event_id'], 5)}, event_id) - 1) % 5 AS INTEGER) AS fold FROM events)"""


@query("cv_summary_events", f"""WITH {KFOLD_EVENTS},
per AS (SELECT m.model, fold, avg(CAST((value >= m.t) = (event_type = 'purchase') AS INTEGER)) AS accuracy
  FROM folds, (VALUES ('value_ge_100', 100.0::DOUBLE), ('value_ge_250', 250.0::DOUBLE)) m(model, t)
  GROUP BY 1, 2)
SELECT model, round(avg(accuracy), 9) AS accuracy_mean, round(stddev_pop(accuracy), 9) AS accuracy_std
FROM per GROUP BY model""")
def q_cv_summary_events(spark, d):
    ev = SA.kfold(tb(spark, d, "events"), 5, "event_id", 5)
    y = F.col("event_type") == "purchase"
    per = ev.groupBy("fold").agg(
        F.avg(((F.col("value") >= 100.0) == y).cast("int")).alias("value_ge_100"),
        F.avg(((F.col("value") >= 250.0) == y).cast("int")).alias("value_ge_250"))
    long = per.select("fold", F.explode(F.array(
        F.struct(F.lit("value_ge_100").alias("model"), F.col("value_ge_100").alias("accuracy")),
        F.struct(F.lit("value_ge_250").alias("model"), F.col("value_ge_250").alias("accuracy")))).alias("r")
    ).select("fold", "r.*")
    s = M.cv_summary(long, "model", ["accuracy"])
    return s.select("model", R9(F.col("accuracy_mean")).alias("accuracy_mean"),
                    R9(F.col("accuracy_std")).alias("accuracy_std"))




def _per_model_auc(spark, d) -> DataFrame:
    """Three score columns stacked as models: one scan, one set of curves."""
    models = [F.struct(F.lit(c).alias("model"), F.lit(i).alias("position"), F.col(c).cast("double").alias("score"))
              for i, c in enumerate(["l_discount", "l_tax", "l_quantity"])]
    li = tb(spark, d, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("label"), F.inline(F.array(*models)))
    auc = M.roc_auc_by(li, "model")
    place = F.create_map(*[x for i, c in enumerate(["l_discount", "l_tax", "l_quantity"]) for x in (F.lit(c), F.lit(i))])
    return auc.select("model", place[F.col("model")].alias("position"), R9(F.col("roc_auc")).alias("roc_auc"))


def _auc_sql(col: str, pos: int) -> str:
    return f"""SELECT '{col}' AS model, {pos} AS position, round(CAST(sum(CAST(neg AS HUGEINT) * (2 * tp - pos)) AS DOUBLE)
  / (2.0::DOUBLE * CAST(p AS DOUBLE) * CAST(n AS DOUBLE)), 9) AS roc_auc FROM (
  WITH sl AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label, CAST({col} AS DOUBLE) AS score FROM lineitem),
  {CURVE_SQL.format(src='sl')} SELECT * FROM cum, tot) GROUP BY p, n"""


MODELS_AUC_SQL = " UNION ALL ".join(_auc_sql(c, i) for i, c in enumerate(["l_discount", "l_tax", "l_quantity"]))


@query("rank_models_lineitem", f"""
SELECT *, CAST(row_number() OVER (ORDER BY roc_auc DESC, model) AS INTEGER) AS rank FROM ({MODELS_AUC_SQL})""")
def q_rank_models_lineitem(spark, d):
    return M.rank_models(_per_model_auc(spark, d), "roc_auc", "model")


@query("best_by_models_lineitem", f"""
SELECT * FROM ({MODELS_AUC_SQL}) ORDER BY roc_auc DESC, position ASC LIMIT 1""")
def q_best_by_models_lineitem(spark, d):
    return M.best_by(_per_model_auc(spark, d), "roc_auc", "position")


@query("coefficient_sparsity_embeddings", """
WITH m AS (SELECT i, avg(embedding[i]) AS coefficient FROM embeddings, range(1, 65) t(i) GROUP BY i)
SELECT count_if(abs(coefficient) > 0.01) AS non_zero, count(*) AS total,
  round(100 * (count(*) - count_if(abs(coefficient) > 0.01)) / count(*), 9) AS zero_pct FROM m""")
def q_coefficient_sparsity_embeddings(spark, d):
    e = IO.explode_batch(tb(spark, d, "embeddings"), "embedding", keep=["vec_id"])
    coefs = e.groupBy("record_no").agg(F.avg(F.col("value").cast("double")).alias("coefficient"))
    s = M.coefficient_sparsity(coefs, eps=0.01)
    return s.withColumn("zero_pct", R9(F.col("zero_pct")))


# ------------------------------------------------------------------ windows / sorts
@query("cumulative_variance_embeddings", """
WITH v AS (SELECT i AS dim, var_pop(CAST(embedding[i] AS DOUBLE)) AS variance FROM embeddings, range(1, 65) t(i) GROUP BY i),
r AS (SELECT dim, variance / sum(variance) OVER () AS ratio FROM v),
c AS (SELECT dim, ratio, CAST(row_number() OVER (ORDER BY ratio DESC, dim) AS INTEGER) AS component FROM r),
k AS (SELECT component, ratio, sum(ratio) OVER (ORDER BY component) AS cumulative FROM c)
SELECT component, round(ratio, 9) AS ratio, round(cumulative, 9) AS cumulative,
  (SELECT coalesce(min(component) FILTER (WHERE cumulative >= 0.95), max(component)) FROM k) AS n_components
FROM k""")
def q_cumulative_variance_embeddings(spark, d):
    from pyspark.sql import Window
    e = IO.explode_batch(tb(spark, d, "embeddings"), "embedding", keep=["vec_id"])
    v = e.groupBy(F.col("record_no").alias("dim")).agg(F.var_pop(F.col("value").cast("double")).alias("variance"))
    total = v.agg(F.sum("variance")).first()[0]
    r = v.withColumn("ratio", F.col("variance") / F.lit(total))
    # one row per input dimension: a bounded global ordering
    c = r.withColumn("component", F.row_number().over(Window.orderBy(F.col("ratio").desc(), "dim")))
    k = RK.cumulative_share(c.select("component", "ratio"), "component", "ratio")
    n = RK.components_for(k, 0.95).first()["n_components"]
    return k.select("component", R9(F.col("ratio")).alias("ratio"), R9(F.col("cumulative")).alias("cumulative"),
                    F.lit(n).cast("bigint").alias("n_components"))


@query("dedup_first_lineitem", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
  l_linestatus) AS rn FROM lineitem) WHERE rn = 1""")
def q_dedup_first_lineitem(spark, d):
    return RL.dedup_keep_first(tb(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"],
                               ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                                "l_discount", "l_tax", "l_returnflag", "l_linestatus"])


@query("sequential_id_orders", """
SELECT o_orderkey, o_orderdate, CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) + 999 AS BIGINT) AS row_id
FROM orders""")
def q_sequential_id_orders(spark, d):
    o = tb(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return sequential_id(o, ["o_orderdate", "o_orderkey"], out="row_id", start=1000, buckets=8)


def _fmt_sql(x, d, pct=False):
    # DuckDB's printf rounds the exact binary value, ties to even, like Python
    if pct:
        return f"printf('%.{d}f', ({x}) * 100.0::DOUBLE) || '%'"
    return f"printf('%.{d}f', {x})"


def _threshold_table_sql(prefix, src):
    return f"""{prefix},
{CURVE_SQL.format(src=src)},
yj AS (SELECT score AS t FROM cum, tot ORDER BY CAST(tp AS HUGEINT) * n - CAST(fp AS HUGEINT) * p DESC, score DESC LIMIT 1),
f1 AS (SELECT score AS t FROM cum, tot
   ORDER BY 2 * (tp / (tp + fp)) * (tp / CAST(p AS DOUBLE)) / ((tp / (tp + fp)) + (tp / CAST(p AS DOUBLE)) + 1e-10) DESC,
   score ASC LIMIT 1),
ts AS (SELECT DISTINCT t FROM (SELECT unnest([0.3, 0.4, 0.5, 0.6, 0.7]::DOUBLE[]) AS t UNION ALL SELECT t FROM yj
   UNION ALL SELECT t FROM f1)),
c AS (SELECT t, count(*) AS n, count_if(label = 1) AS p, count_if(score >= t AND label = 1) AS tp,
   count_if(score >= t AND label = 0) AS fp FROM {src}, ts GROUP BY t),
m AS (SELECT t, n, tp, fp, p - tp AS fn, n - p - fp AS tn FROM c)
SELECT {_fmt_sql('t', 3)} AS Threshold,
  {_fmt_sql(_sdiv_sql('tp + tn', 'n'), 4)} AS Accuracy,
  {_fmt_sql(_sdiv_sql('tp', 'tp + fp'), 4)} AS Precision,
  {_fmt_sql(_sdiv_sql('tp', 'tp + fn'), 4)} AS Recall,
  {_fmt_sql(_sdiv_sql('2 * tp', '2 * tp + fp + fn'), 4)} AS F1_Score,
  tp + fp AS Pos_Predictions,
  {_fmt_sql(_sdiv_sql('tp + fp', 'n'), 1, pct=True)} AS Pct_Pos_Pred FROM m"""


@query("threshold_table_events", _threshold_table_sql(SE, "se"))
def q_threshold_table_events(spark, d):
    return RP.threshold_table(scored_events(spark, d))


@query("threshold_table_lineitem", _threshold_table_sql(SL, "sl"))
def q_threshold_table_lineitem(spark, d):
    return RP.threshold_table(scored_lines(spark, d))


@query("top_features_part", """
SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10""")
def q_top_features_part(spark, d):
    return RK.top_features(tb(spark, d, "part").select("p_partkey", "p_retailprice"), 10, "p_retailprice",
                           "p_partkey")


# ------------------------------------------------------------------ set operations
@query("append_orders", """
SELECT o_orderkey, o_orderstatus, NULL::VARCHAR AS o_orderpriority FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F'""")
def q_append_orders(spark, d):
    o = tb(spark, d, "orders")
    a = o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderstatus")
    b = o.where(~F.col("o_orderstatus").eqNullSafe(F.lit("F"))).select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return RL.append(a, b)


@query("distinct_rows_lineitem", "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem")
def q_distinct_rows_lineitem(spark, d):
    return RL.distinct_rows(tb(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity"))


# ------------------------------------------------------------------ sampling
@query("sample_approx_orders", f"""
SELECT o_orderkey FROM orders WHERE {sql_hash(['o_orderkey'], 11)} < {int(0.1 * (1 << 60))}""")
def q_sample_approx_orders(spark, d):
    return SA.sample_fraction(tb(spark, d, "orders").select("o_orderkey"), 0.1, "o_orderkey", 11)


@query("sample_exact_orders", f"""
SELECT o_orderkey, o_orderstatus FROM (SELECT o_orderkey, o_orderstatus,
  {mark_sql(['o_orderkey'], 12, 0.05)} AS sel FROM orders) WHERE sel""")
def q_sample_exact_orders(spark, d):
    return SA.sample_fraction(tb(spark, d, "orders").select("o_orderkey", "o_orderstatus"), 0.05, "o_orderkey", 12,
                              exact=True)


@query("sample_n_events", f"""
SELECT event_id, event_type FROM (SELECT event_id, event_type,
  row_number() OVER (ORDER BY {sql_hash(['event_id'], 13)}, event_id) AS rn FROM events) WHERE rn <= 777""")
def q_sample_n_events(spark, d):
    return SA.sample_n(tb(spark, d, "events").select("event_id", "event_type"), 777, "event_id", 13)


CUST_NUMBERED = "cn AS (SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_custkey) - 1 AS rowno FROM customer)"


def _draws_sql(n_sql: str, seed) -> str:
    return (f"draws AS (SELECT i AS draw, {sql_hash(['i'], seed)} % (SELECT count(*) FROM customer) AS rowno "
            f"FROM range(0, {n_sql}) t(i))")


@query("sample_with_replacement_customer", f"""
WITH {CUST_NUMBERED}, {_draws_sql('2000', 14)}
SELECT cn.c_custkey, cn.c_acctbal, draws.draw FROM draws JOIN cn ON draws.rowno = cn.rowno""")
def q_sample_with_replacement_customer(spark, d):
    c = tb(spark, d, "customer").select("c_custkey", "c_acctbal")
    return SA.sample_with_replacement(c, 2000, "c_custkey", 14)


@query("resize_up_customer", f"""
WITH {CUST_NUMBERED}, {_draws_sql('(SELECT count(*) FROM customer)', 15)}
SELECT c_custkey, c_acctbal, c_custkey AS source_key, CAST(0 AS BIGINT) AS copy_no FROM customer
UNION ALL SELECT cn.c_custkey, cn.c_acctbal, cn.c_custkey, draws.draw + 1 FROM draws JOIN cn ON draws.rowno = cn.rowno""")
def q_resize_up_customer(spark, d):
    c = tb(spark, d, "customer").select("c_custkey", "c_acctbal")
    n = c.count()
    return SA.resize_to(c, 2 * n, "c_custkey", 15)


@query("resize_down_customer", f"""
SELECT c_custkey, c_acctbal, c_custkey AS source_key, CAST(0 AS BIGINT) AS copy_no FROM (
  SELECT *, row_number() OVER (ORDER BY {sql_hash(['c_custkey'], 16)}, c_custkey) AS rn FROM customer)
WHERE rn <= (SELECT count(*) * 2 / 3 FROM customer)""")
def q_resize_down_customer(spark, d):
    c = tb(spark, d, "customer").select("c_custkey", "c_acctbal")
    n = c.count()
    return SA.resize_to(c, n * 2 // 3, "c_custkey", 16)


@query("duplicate_rows_orders", f"""
SELECT o_orderkey, 0 AS copy_no FROM orders
UNION ALL SELECT o_orderkey, 1 FROM (SELECT o_orderkey, {mark_sql(['o_orderkey'], 17, 0.01)} AS sel FROM orders)
WHERE sel""")
def q_duplicate_rows_orders(spark, d):
    return SA.duplicate_rows(tb(spark, d, "orders").select("o_orderkey"), 0.01, "o_orderkey", 17)


@query("stratified_split_orders", f"""
SELECT o_orderkey, o_orderstatus, CASE WHEN {mark_sql(['o_orderkey'], 42, 0.2, ['o_orderstatus'])}
  THEN 'test' ELSE 'train' END AS split FROM orders""")
def q_stratified_split_orders(spark, d):
    o = tb(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return SA.stratified_split(o, "o_orderstatus", 0.2, "o_orderkey", 42)


@query("kfold_events", f"""
SELECT event_id, CAST((row_number() OVER (ORDER BY {sql_hash(['event_id'], 18)}, event_id) - 1) % 5 AS INTEGER) AS fold
FROM events""")
def q_kfold_events(spark, d):
    return SA.kfold(tb(spark, d, "events").select("event_id"), 5, "event_id", 18)


@query("stratified_kfold_orders", f"""
SELECT o_orderkey, o_orderstatus, CAST((row_number() OVER (PARTITION BY o_orderstatus
  ORDER BY {sql_hash(['o_orderkey'], 19)}, o_orderkey) - 1) % 5 AS INTEGER) AS fold FROM orders""")
def q_stratified_kfold_orders(spark, d):
    return SA.stratified_kfold(tb(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", 5,
                               "o_orderkey", 19)


@query("permute_column_customer", f"""
WITH a AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS i FROM customer),
b AS (SELECT c_acctbal, row_number() OVER (ORDER BY {sql_hash(['c_custkey'], 20)}, c_custkey) AS i FROM customer)
SELECT a.c_custkey, b.c_acctbal FROM a JOIN b ON a.i = b.i""")
def q_permute_column_customer(spark, d):
    return SA.permute_column(tb(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", "c_custkey", 20)


# ------------------------------------------------------------------ scalar features
@query("cut_part_size", """
SELECT p_partkey, p_size,
  CASE WHEN p_size > 0 AND p_size <= 10 THEN 'XS' WHEN p_size > 10 AND p_size <= 20 THEN 'S'
    WHEN p_size > 20 AND p_size <= 30 THEN 'M' WHEN p_size > 30 AND p_size <= 40 THEN 'L' ELSE NULL END AS size_bin,
  CASE WHEN p_size <= 10 THEN 'XS' WHEN p_size <= 20 THEN 'S' WHEN p_size <= 30 THEN 'M' WHEN p_size <= 40 THEN 'L'
    ELSE 'XL' END AS size_open FROM part""")
def q_cut_part_size(spark, d):
    p = tb(spark, d, "part").select("p_partkey", "p_size")
    return p.withColumns({"size_bin": FX.cut("p_size", (0, 10, 20, 30, 40), ("XS", "S", "M", "L")),
                          "size_open": FX.cut_open("p_size", (10, 20, 30, 40), ("XS", "S", "M", "L", "XL"))})


@query("ratios_lineitem", """
SELECT l_orderkey, l_linenumber,
  round(l_extendedprice / pow(l_quantity / 100.0::DOUBLE, 2), 6) AS price_per_sq,
  round(l_extendedprice / (l_quantity * 0.3::DOUBLE + 1e-10::DOUBLE), 6) AS price_ratio,
  round_even(l_extendedprice / 7.0::DOUBLE, 2) AS price_7th,
  round(l_extendedprice - l_quantity * 1000.0::DOUBLE, 6) AS gap FROM lineitem""")
def q_ratios_lineitem(spark, d):
    li = tb(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.round(FX.bmi("l_extendedprice", "l_quantity"), 6).alias("price_per_sq"),
                     F.round(FX.safe_ratio("l_extendedprice", "l_quantity", 0.3, 1e-10), 6).alias("price_ratio"),
                     FX.round_half_even(F.col("l_extendedprice") / F.lit(7.0), 2).alias("price_7th"),
                     F.round(FX.signed_diff("l_extendedprice", F.col("l_quantity") * F.lit(1000.0)), 6).alias("gap"))


@query("risk_tier_events", f"""{SE}
SELECT CASE WHEN score < 0.3 THEN 'Low' WHEN score < 0.7 THEN 'Medium' ELSE 'High' END AS tier,
  CASE WHEN score < 0.3 THEN 'Routine screening is recommended based on this profile.'
    WHEN score < 0.7 THEN 'Further clinical investigation is advised.'
    ELSE 'Urgent specialist consultation and diagnostic testing required.' END AS advice,
  count(*) AS n FROM se GROUP BY 1, 2""")
def q_risk_tier_events(spark, d):
    se = scored_events(spark, d)
    return se.groupBy(FX.risk_tier("score").alias("tier"), FX.recommendation("score").alias("advice")).agg(
        F.count(F.lit(1)).alias("n"))


@query("format_metric_lineitem", f"""
SELECT {_fmt_sql('l_discount', 4)} AS discount_text, {_fmt_sql('l_tax', 1, pct=True)} AS tax_pct,
  count(*) AS n FROM lineitem GROUP BY 1, 2""")
def q_format_metric_lineitem(spark, d):
    li = tb(spark, d, "lineitem")
    return li.groupBy(FX.format_metric("l_discount", 4).alias("discount_text"),
                      FX.format_metric("l_tax", 1, pct=True).alias("tax_pct")).agg(F.count(F.lit(1)).alias("n"))


@query("slug_part_names", "SELECT DISTINCT lower(replace(p_name, ' ', '_')) AS slug FROM part")
def q_slug_part_names(spark, d):
    return tb(spark, d, "part").select(FX.slug("p_name").alias("slug")).distinct()


@query("one_hot_customer", """
SELECT c_custkey, CAST(c_mktsegment = 'AUTOMOBILE' AS INTEGER) AS c_mktsegment_AUTOMOBILE,
  CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS c_mktsegment_BUILDING,
  CAST(c_mktsegment = 'FURNITURE' AS INTEGER) AS c_mktsegment_FURNITURE,
  CAST(c_mktsegment = 'HOUSEHOLD' AS INTEGER) AS c_mktsegment_HOUSEHOLD,
  CAST(c_mktsegment = 'MACHINERY' AS INTEGER) AS c_mktsegment_MACHINERY FROM customer""")
def q_one_hot_customer(spark, d):
    return FX.one_hot(tb(spark, d, "customer").select("c_custkey", "c_mktsegment"), ["c_mktsegment"])


@query("standardize_customer", """
SELECT c_custkey, round((c_acctbal - (SELECT avg(c_acctbal) FROM customer))
  / (SELECT stddev_pop(c_acctbal) FROM customer), 6) AS c_acctbal FROM customer""")
def q_standardize_customer(spark, d):
    s = FX.standardize(tb(spark, d, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])
    return s.withColumn("c_acctbal", F.round("c_acctbal", 6))


@query("revenue_gap_orders", """
SELECT o.o_orderkey, round(o.o_totalprice - coalesce(s.rev, 0), 4) AS gap
FROM orders o LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice) AS rev FROM lineitem GROUP BY 1) s
  ON o.o_orderkey = s.l_orderkey""")
def q_revenue_gap_orders(spark, d):
    rev = tb(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("rev"))
    o = tb(spark, d, "orders").select("o_orderkey", "o_totalprice")
    j = o.join(rev, o.o_orderkey == rev.l_orderkey, "left")
    return j.select("o_orderkey", F.round(FX.signed_diff("o_totalprice", F.coalesce("rev", F.lit(0.0))), 4)
                    .alias("gap"))


# ------------------------------------------------------------------ reports and catalogs
def _metric_rows_sql() -> str:
    from riskframe.operators.report import METRIC_ROWS
    exprs = {
        "accuracy": _sdiv_sql("tp + tn", "tn + fp + fn + tp"), "precision": _sdiv_sql("tp", "tp + fp"),
        "recall": _sdiv_sql("tp", "tp + fn"), "specificity": _sdiv_sql("tn", "tn + fp"),
        "f1": _sdiv_sql("2 * tp", "2 * tp + fp + fn"), "roc_auc": "roc_auc", "average_precision": "average_precision"}
    parts = [f"SELECT {i} AS position, '{n}' AS Metric, {exprs[k]} AS v, '{f}' AS Formula FROM cm, auc"
             for i, (n, k, f) in enumerate(METRIC_ROWS)]
    return " UNION ALL ".join(parts)


@query("metrics_report_events", f"""{CM_SQL},
{CURVE_SQL.format(src='se')},
auc AS (SELECT CAST(sum(CAST(neg AS HUGEINT) * (2 * tp - pos)) AS DOUBLE) / (2.0::DOUBLE * CAST(p AS DOUBLE) * CAST(n AS DOUBLE)) AS roc_auc,
   sum(pos * (tp / (tp + fp))) / CAST(p AS DOUBLE) AS average_precision FROM cum, tot GROUP BY p, n),
r AS ({_metric_rows_sql()})
SELECT position, Metric, round(v, 9) AS metric_value, Formula, {_fmt_sql('v', 4)} AS Value FROM r""")
def q_metrics_report_events(spark, d):
    from riskframe.operators.report import metrics_report
    se = scored_events(spark, d).withColumn("prediction", M.apply_threshold("score", 0.5))
    rep = metrics_report(se)
    return rep.withColumn("metric_value", R9(F.col("metric_value")))


@query("feature_catalog_customer", """
WITH lv AS (SELECT DISTINCT c_mktsegment AS lev FROM customer),
f AS (SELECT 0 AS position, 'c_acctbal' AS feature, false AS from_categorical
  UNION ALL SELECT CAST(row_number() OVER (ORDER BY lev) AS INTEGER), 'c_mktsegment_' || lev, true FROM lv)
SELECT position, feature, CAST((SELECT count(*) FROM f) AS INTEGER) AS total_features, from_categorical FROM f""")
def q_feature_catalog_customer(spark, d):
    """Feature names of a preprocessor fitted on customers,
    written as run metadata, read back and listed."""
    from riskframe.learn.prep import feature_names, pipeline
    from riskframe.session import scratch_path
    from riskframe.sources.catalog import feature_catalog
    c = tb(spark, d, "customer")
    model = pipeline(["c_acctbal"], ["c_mktsegment"]).fit(c)
    names = feature_names(model, ["c_acctbal"], ["c_mktsegment"])
    meta = {"models_available": [], "best_model": None, "feature_names": names,
            "categorical_columns": ["c_mktsegment"], "numerical_columns": ["c_acctbal"],
            "training_date": "", "performance": {}}
    path = scratch_path(spark, "features_meta")
    IO.write_run_metadata(spark, meta, path)
    return feature_catalog(IO.read_run_metadata(spark, path))
