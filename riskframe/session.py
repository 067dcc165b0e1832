"""Session helpers: building a local session for tests/bench and finding the
shared scratch folder (``spark.checkpoint.dir``) that lineage cuts go to."""

from __future__ import annotations

import gc
import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "riskframe", extra: dict | None = None) -> SparkSession:
    """Local session used by tests and bench. On a cluster, callers pass their
    own session; nothing in the library depends on these settings."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder. A session without one gets a
    fresh temporary folder if all of it runs on this machine (tests, bench);
    on a cluster, where executors could not see it, that is an error."""
    sc = spark.sparkContext
    path = sc.getCheckpointDir()
    if path:
        return path
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="riskframe-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a written table (of ``scratch_path``) that is not read any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def drop_shuffles(spark: SparkSession) -> None:
    """Spark deletes the files of a shuffle once the driver's garbage collection meets it, which may be long after its
    last reader is done. Where one large shuffle follows another, this is the time to look."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """While a wide frame is written, each operator has code of its own. Dozens of long column expressions in the one
    method of a whole stage pass the size up to which the JVM compiles methods, and are interpreted row by row."""
    name = "spark.sql.codegen.wholeStage"
    with _LOCK:
        # threads may be in here together: the first one sets, the last one sets back
        _BEFORE.append(_BEFORE[0] if _BEFORE else spark.conf.get(name))
        spark.conf.set(name, "false")
    try:
        yield
    finally:
        with _LOCK:
            was = _BEFORE.pop()
            if not _BEFORE:
                spark.conf.set(name, was)


_LOCK, _BEFORE = threading.Lock(), []


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
