"""Exact token-length histogram of a corpus and what it answers.

Documents are encoded whole and counted by length; suffix sums over the
histogram then answer totals, quantiles and truncated totals for every context
limit without touching the texts again.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import checkpointed, chunks
from riskframe.llm.tokens import TEXT_BYTES, default_tokenizer, encoder

#: Lengths a block of the two-level sums spans.
BLOCK = 4096


def token_lengths(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """One row (length) per document; a null or empty text has length 0.

    Only the text is read, so other columns and their names do not matter.
    """
    path = tokenizer or default_tokenizer()

    def run(batches):
        enc = encoder(path)
        for b in batches:
            for lo, hi in chunks(b, 0, TEXT_BYTES):
                ids = enc.encode(b.column(0).slice(lo, hi - lo).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array([len(x) // 4 for x in ids], pa.int64())], ["length"])

    return docs.select(F.col(text_col).alias("t")).mapInArrow(run, "length long")


def length_histogram(lengths: DataFrame, length_col: str = "length") -> DataFrame:
    """Rows per different length with sums over all lengths at least and at most as large.

    Returns length, n_docs, docs_at_least, tokens_at_least, docs_at_most,
    truncated_tokens (the corpus when every document is cut to ``length``),
    total_docs and total_tokens. Repeated rows count each time, null lengths not at
    all; an empty table gives no rows. Sums run in blocks of lengths: within each
    block in its own task, and over the few block totals.
    """
    x = F.col(length_col).cast("long")
    # a row per different length, written once: it is read for the blocks and for the rows
    h = checkpointed(lengths.where(x.isNotNull()).groupBy(x.alias("length")).agg(F.count(F.lit(1)).alias("n_docs")))
    h = h.withColumns({"tokens": F.col("length") * F.col("n_docs"), "block": F.floor(F.col("length") / BLOCK)})
    b = h.groupBy("block").agg(F.sum("n_docs").alias("bd"), F.sum("tokens").alias("bt"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy("block")
    b = b.select("block", *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}_later") for c in ("bd", "bt")],
                 F.sum("bd").over(every).alias("total_docs"), F.sum("bt").over(every).alias("total_tokens"))
    own = Window.partitionBy("block").orderBy(F.desc("length"))
    h = h.join(b, "block").select(
        "length", "n_docs", (F.sum("n_docs").over(own) + F.col("bd_later")).alias("docs_at_least"),
        (F.sum("tokens").over(own) + F.col("bt_later")).alias("tokens_at_least"), "total_docs", "total_tokens")
    return h.select(
        "length", "n_docs", "docs_at_least", "tokens_at_least",
        (F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")).alias("docs_at_most"),
        (F.col("total_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias("truncated_tokens"),
        "total_docs", "total_tokens")


def truncated_total(histogram: DataFrame, limit: int) -> DataFrame:
    """One row (tokens): the corpus when each document keeps at most ``limit`` tokens."""
    kept = F.least(F.col("length"), F.lit(limit)) * F.col("n_docs")
    return histogram.agg(F.coalesce(F.sum(kept), F.lit(0)).alias("tokens"))


def length_quantile(histogram: DataFrame, q: float) -> DataFrame:
    """One row (length): the least length that at least the share ``q`` of documents do not exceed."""
    return histogram.where(F.col("docs_at_most") >= F.lit(q) * F.col("total_docs")).agg(F.min("length").alias("length"))
