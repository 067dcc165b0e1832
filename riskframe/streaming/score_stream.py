"""ST1: stream scoring with Structured Streaming.

Records arrive as files (JSON or Parquet) with a fixed schema; each
micro-batch is validated (P12), feature-engineered, scored by a fitted
``PipelineModel`` and tiered. Valid rows and rejects go to their own sinks
and a per-batch summary (A18) is written through ``foreachBatch``, each
batch into its own ``batch_id=N`` directory with overwrite, so a replayed
batch is idempotent. The query is stateless, so the checkpoint holds only
offsets; it lives in the shared folder so a restarted driver resumes."""

from __future__ import annotations

import os

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.columns import validate_records
from riskframe.functions.features import risk_tier
from riskframe.operators.metrics import batch_summary
from riskframe.operators.quality import engineer_features


def score_stream(spark: SparkSession, source: str, schema: T.StructType, model, out_dir: str,
                 fmt: str = "parquet", id_col: str = "patient_id", required=(), allowed=None, ranges=None,
                 available_now: bool = True, checkpoint: str | None = None,
                 max_files: int = 1000, interval: str = "10 seconds"):
    """Start (and, with ``available_now``, finish) the scoring stream.
    Writes ``scored/``, ``rejected/`` and ``summary/`` under ``out_dir``.

    A batch takes at most ``max_files`` new files, so a backlog comes in several;
    without ``available_now`` a batch starts every ``interval``. The model runs once
    per batch: the summary is made from the rows just written."""
    stream = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", max_files).load(source)
    checked = validate_records(stream, required, allowed, ranges)

    def per_batch(batch: DataFrame, epoch: int):
        batch = batch.persist()
        ok = batch.where(F.size("reasons") == 0).drop("reasons")
        bad = batch.where(F.size("reasons") > 0)
        pred = model.transform(engineer_features(ok, scoring=True))
        prob = vector_to_array("probability")[1]
        scored = pred.select(F.col(id_col), F.col("prediction").cast("int").alias("prediction"),
                             prob.alias("probability"), risk_tier(prob).alias("cancer_risk"))
        # one directory per batch, overwritten: a batch replayed after a
        # failure replaces its own output instead of appending it twice
        part = f"batch_id={epoch}"
        to = os.path.join(out_dir, "scored", part)
        scored.write.mode("overwrite").parquet(to)
        bad.write.mode("overwrite").parquet(os.path.join(out_dir, "rejected", part))
        batch_summary(spark.read.schema(scored.schema).parquet(to)).write.mode("overwrite").parquet(os.path.join(out_dir, "summary", part))
        batch.unpersist()

    writer = (checked.writeStream.foreachBatch(per_batch)
              .option("checkpointLocation", checkpoint or os.path.join(out_dir, "_checkpoint")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q
