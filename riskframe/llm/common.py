"""Shared helpers of the text operators: tables, batches of text, word caches
and keys shipped between tasks as packed blobs."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.session import cut_lineage

#: Text held as Python words at one time, in bytes. Bounds a task's memory.
CHUNK_BYTES = 2 << 20
#: Words whose ids, and whose hashes, a task keeps before it starts afresh.
CACHE_WORDS = 300_000
HASH_WORDS = 300_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts_for(n: int, per: int, least: int = 64) -> int:
    """How many parts ``n`` items need at ``per`` items a part."""
    return max(least, math.ceil(n / per))


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame written to the cluster's shared checkpoint folder."""
    return cut_lineage(df)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """While a frame is written, Python gets batches of ``rows`` rows; for rows with several texts each."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def held_out(id_col: str, folds: int, rest: int) -> Column:
    """True for rows that a fit must not see: crc32 of the id as text, mod ``folds``."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == rest, F.lit(False))


def chunks(batch: pa.RecordBatch, text: int, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch with about ``limit`` bytes of text each (one row at least)."""
    n = batch.num_rows
    if not n:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    block = np.cumsum(sizes.astype(np.int64)) // limit
    edges = np.flatnonzero(np.diff(block)) + 1
    start = 0
    for e in [*edges.tolist(), n]:
        if e > start:
            yield start, e
            start = e


class Words(dict):
    """Word -> value, computed once for each word a task meets; bounded by ``trim``."""

    def __init__(self, value: Callable):
        super().__init__()
        self.value = value

    def __missing__(self, word):
        self[word] = v = self.value(word)
        return v

    def trim(self) -> None:
        if len(self) > HASH_WORDS:
            self.clear()

    def of(self, words: list, dtype) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values (the finishing steps of a public-domain generator)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_starts(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each k consecutive values; order matters."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    g = h[:n].copy()
    for i in range(1, k):
        g = mix(g * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    return mix(g)
