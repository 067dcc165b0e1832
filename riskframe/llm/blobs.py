"""Shuffling many small keyed values as packed blobs.

A task packs what it has for each part into one row; a part's rows meet in one task
of the next stage, where numpy sorts them. Tasks pre-aggregate before they pack, so
a key that most rows share is sent once per batch and not once per row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOB = "part int, kind int, data binary"
NAMES = ["part", "kind", "data"]


def blob_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())], NAMES)


def split_parts(part: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, indices) of each part that has any."""
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    for p in range(parts):
        if edges[p] < edges[p + 1]:
            yield p, order[edges[p] : edges[p + 1]]


def meet(packed: DataFrame, parts: int, work: Callable[[list[tuple[int, bytes]]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Brings the rows of each part together and hands each part's (kind, data) to ``work``."""

    def run(batches):
        held: dict[int, list[tuple[int, bytes]]] = {}
        for b in batches:
            for p, kind, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                held.setdefault(p, []).append((kind, data))
        for p in list(held):
            yield from work(held.pop(p))

    return packed.repartition(parts, "part").mapInArrow(run, schema)
