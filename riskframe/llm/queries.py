"""The queries of the text operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import archives, codes, conversations, decontaminate, kdtree, language, packing, parity, pii, quality, substrings, token_counts, toxicity
from riskframe.llm.common import checkpointed, held_out, table
from riskframe.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


@query("op1_quality")
def op1(spark, d):
    docs = table(spark, d, "documents")
    model = quality.fit_quality(docs, table(spark, d, "labels"))
    held = held_out("doc_id", quality.FOLDS, quality.FOLD).alias("held_out")
    return quality.score_quality(docs.select("doc_id", "text"), model).select(
        "doc_id", held, "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query("op2_topk", """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT DISTINCT vec_id, v FROM e WHERE vec_id % 100 = 0),
s AS (SELECT q.vec_id AS query_id, q.v, e.vec_id, CAST(list_dot_product(q.v, e.v) AS BIGINT) AS score
  FROM q JOIN e ON e.vec_id <> q.vec_id AND len(e.v) = len(q.v))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id, v ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
""")
def op2(spark, d):
    return kdtree.top_k(table(spark, d, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op3_language")
def op3(spark, d):
    docs = table(spark, d, "documents")
    model = language.fit_languages(docs)
    held = held_out("doc_id", language.FOLDS, language.FOLD).alias("held_out")
    return language.identify(docs, model).select("doc_id", held, "lang_pred", "score", "n_spans")


@query("op4_archives", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id) AS k,
    min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM s)
SELECT page_id, payload_bytes, payload_digest, true AS digest_ok,
  CASE WHEN payload_bytes >= 100 AND k > 1 THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND k > 1 THEN first_page END AS refers_to
FROM r
""")
def op4(spark, d):
    path = scratch_path(spark, "warc")
    archives.write_warc(archives.mark_revisits(archives.arc_to_warc(archives.pages_to_arc(table(spark, d, "pages")))), path)
    back = archives.read_warc(spark, path).where(F.col("record_type").isin("response", "revisit"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


@query("op5_token_counts")
def op5(spark, d):
    return token_counts.length_histogram(token_counts.token_lengths(table(spark, d, "documents")))


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query("op6_substrings", f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
win AS (SELECT r, doc_id, unnest(range(1, len(w) - 11)) AS p,
    unnest([array_to_string(w[i:i + 12], ' ') FOR i IN range(1, len(w) - 11)]) AS s
  FROM d WHERE len(w) >= 13),
least AS (SELECT s, min(doc_id) AS first_doc FROM win GROUP BY s),
gone AS (SELECT DISTINCT r, p + k AS i FROM win JOIN least USING (s), range(13) AS t(k) WHERE first_doc < doc_id),
words AS (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
""")
def op6(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


_LOWER_WORDS = _WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")


@query("op7_similar", f"""
WITH RECURSIVE d AS (SELECT doc_id, {_LOWER_WORDS} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN '=' ELSE '' END ||
    unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, greatest(len(w) - 4, 1) + 1)]) AS g
  FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS MATERIALIZED (SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * shared >= 75 * (na.n + nb.n - shared)),
reach AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN reach USING (doc_id) GROUP BY d.doc_id, n.n
""")
def op7(spark, d):
    return parity.similar_documents(table(spark, d, "documents")).select("doc_id", "n_shingles", "component_id")


_ITEM_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op8_decontaminate", f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce({_ITEM_WORDS}, []) AS w FROM documents),
b AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS size,
    unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ') FOR i IN range(1, greatest(len(w) - 9, 1) + 1)]) AS win
  FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT r, size, unnest(range(1, len(w) - size + 2)) AS p,
    unnest([array_to_string(w[i:i + size - 1], ' ') FOR i IN range(1, len(w) - size + 2)]) AS win
  FROM d, sizes WHERE len(w) >= size),
hits AS (SELECT r, p, size, item_id FROM dw JOIN bw USING (size, win)),
words AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(p, p + size)) AS x FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
""")
def op8(spark, d):
    found = decontaminate.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.drop("text_hash", "spans")


@query("op9_packing")
def op9(spark, d):
    return packing.pack(packing.token_pieces(table(spark, d, "documents")))


@query("op10_toxicity")
def op10(spark, d):
    docs = table(spark, d, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, d, "labels"))
    held = held_out("doc_id", toxicity.FOLDS, toxicity.FOLD).alias("held_out")
    return toxicity.score_toxicity(docs.select("doc_id", "text"), model).select(
        "doc_id", held, "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def _codes_sql() -> str:
    """Codebooks round by round; squared distances of integer vectors are exact in doubles."""
    part = "list_transform(range(4), lambda p: v[CAST(p * len(v) / 4 AS BIGINT) + 1:CAST((p + 1) * len(v) / 4 AS BIGINT)])"
    ctes = [f"""e AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT r, unnest(range(4)) AS part, unnest({part}) AS v FROM e),
c0 AS MATERIALIZED (SELECT part, r - 1 AS entry, v FROM x WHERE r <= 256)"""]
    for i in range(5):
        ctes.append(f"""a{i} AS MATERIALIZED (SELECT r, x.part, min(CAST(list_dot_product(x.v, x.v) - 2 * list_dot_product(x.v, c.v) + list_dot_product(c.v, c.v) AS BIGINT) * 256 + entry) AS k
  FROM x JOIN c{i} c USING (part) GROUP BY r, x.part)""")
        if i < 4:
            ctes.append(f"""m{i} AS (SELECT part, entry, list(s ORDER BY d) AS v FROM (
    SELECT part, k % 256 AS entry, d, floor(sum(y) / count(*)) AS s FROM (
      SELECT a.part, k, unnest(v) AS y, unnest(range(len(v))) AS d FROM a{i} a JOIN x USING (r, part)) GROUP BY ALL) GROUP BY part, entry),
c{i + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m USING (part, entry))""")
    return "WITH " + ",\n".join(ctes) + """,
h AS (SELECT sha256(string_agg(CAST(CAST(y AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, d)) AS h FROM (
  SELECT part, entry, unnest(v) AS y, unnest(range(len(v))) AS d FROM c4)),
t AS (SELECT r, string_agg(printf('%02x', k % 256), '' ORDER BY part) AS code, CAST(sum(k // 256) AS BIGINT) AS error FROM a4 GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM e JOIN t USING (r), h"""


@query("op11_codes", _codes_sql())
def op11(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", "embedding", "label")
    books = codes.fit_codebooks(e)
    found = checkpointed(codes.encode(e, books).drop("embedding"))
    text = F.concat(*[F.lower(F.lpad(F.hex(F.col("codes")[p]), 2, "0")) for p in range(codes.PARTS)])
    return codes.error_by_label(found).select("vec_id", text.alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


@query("op12_conversations", r"""
WITH t AS (SELECT conv_id, said, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, said) AS i FROM (
  SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL)),
n AS (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id),
c AS (SELECT n.conv_id, n.conv_id - n.conv_id % 20 AS base, xor(4294967295, list_reduce(
    flatten([[CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1] FOR x IN string_split(CAST(n.conv_id AS VARCHAR), '')]),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, 4294967295)) % 4 AS h FROM n),
k AS (SELECT c.*, least(h, coalesce(n.n, 0)) AS k FROM c LEFT JOIN n ON n.conv_id = c.base),
r AS (SELECT k.conv_id, t.i AS depth, said, words FROM k JOIN t ON t.conv_id = k.base AND t.i <= k.h
  UNION ALL SELECT k.conv_id, k.k + t.i - k.h, said, words FROM k JOIN t ON t.conv_id = k.conv_id AND t.i > k.h),
p AS MATERIALIZED (SELECT conv_id, depth, words, string_agg(said, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
l AS (SELECT conv_id, max(depth) AS last FROM p GROUP BY conv_id),
v AS MATERIALIZED (SELECT path, depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words, max(l.last) AS deepest,
    sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (WHERE l.last = depth), '')) AS ends_sha256
  FROM p JOIN l USING (conv_id) GROUP BY path, depth),
below AS (SELECT p.path, sum((v.n_convs - 1) * v.words) AS saved, count(*) FILTER (WHERE v.deepest = v.depth) AS leaves,
    count(*) FILTER (WHERE v.depth = p.depth + 1) AS children
  FROM v JOIN p ON p.conv_id = v.conv_id AND p.depth <= v.depth GROUP BY p.path)
SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n_convs, children AS n_children, leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, v.ends_sha256
FROM v JOIN below USING (path) LEFT JOIN v u ON u.depth = v.depth - 1 AND u.path = left(v.path, CAST(32 * (v.depth - 1) AS BIGINT))
""")
def op12(spark, d):
    return conversations.prefix_trie(table(spark, d, "conversations"))


@query("op13_personal")
def op13(spark, d):
    docs = table(spark, d, "documents")
    found = pii.find_personal(docs.select("doc_id", "text"), pii.fit_personal(docs))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    number = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(number, pii.KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))
