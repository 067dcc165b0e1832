"""From raw documents to packed sequences, in stages that each keep their work.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps, with the
columns of ``documents``; the last returns packed pieces. What a stage returns is
written as Parquet in the shared folder and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import decontaminate, packing, parity, quality, substrings
from riskframe.llm.common import table
from riskframe.session import scratch_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, scores 0.7 or more."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model, score_col="_quality").where(F.col("_quality") >= quality.THRESHOLD).drop("_quality")


def keep_first_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each component of similar ones."""
    return parity.keep_one(docs)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that documents with smaller ids have; texts that lose all their words go."""
    cut = substrings.remove_repeats(docs).where("n_removed = 0 OR n_removed < n_words")
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of any benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, packed into sequences."""
    return packing.pack(packing.token_pieces(docs))


STAGES = [
    ("quality", keep_quality),
    ("similar", keep_first_similar),
    ("substrings", remove_repeats),
    ("benchmark", remove_contaminated),
    ("packing", pack),
]
#: Training and packing have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
