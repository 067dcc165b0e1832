"""ST1 as a registered query: held-out records are written as files, a
fitted model scores them with Structured Streaming (availableNow), and the
scored sink is read back."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from riskframe.learn import models as MD
from riskframe.learn import prep as PP
from riskframe.plans.learning import CATS, NUMERIC, _train_test, patient_split
from riskframe.plans.registry import query, tb
from riskframe.session import scratch_path
from riskframe.sources.generate import patients_from
from riskframe.streaming.score_stream import score_stream


@query("score_stream_patients")
def q_score_stream_patients(spark, d):
    df = patient_split(spark, d)
    tr, te = _train_test(df)
    model = PP.pipeline(NUMERIC, CATS, MD.logistic(1.0, "l2", n_rows=tr.count(), max_iter=1000)).fit(tr)
    raw = [c for c in patients_from(tb(spark, d, "orders").limit(0), "o_orderkey").columns if c != "cancer"]
    src = scratch_path(spark, "stream_in")
    records = te.select(*raw)
    schema = records.schema
    # two arrival files: records go to a file by the parity of their id
    for part in (0, 1):
        records.where(F.pmod("patient_id", F.lit(2)) == part).write.mode("append").parquet(src)
    out = scratch_path(spark, "stream_out")
    score_stream(spark, src, schema, model, out, required=["age", "gender"],
                 allowed={"gender": ["Male", "Female"]}, ranges={"age": (1, 120)})
    return spark.read.parquet(os.path.join(out, "scored")).drop("batch_id")
