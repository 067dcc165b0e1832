"""Vector code compression: product codes with exact assignment by slice-and-intersect bitmasks.

A codebook keeps, for each of its dimensions, the entries' coordinates in order, and
with each place in that order a bitmask of the entries before it. A radius around a part
cuts one range out of every dimension; the mask of a range is the exclusive or of the two
masks at its ends, and the AND over all dimensions leaves exactly the entries in the box.
The initial radius is the codebook's usual gap; a box whose best entry lies within its radius
has the nearest one, others are searched again with the distance found, or twice the radius.

All arithmetic is on integers, so codes don't depend on partitioning or order.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import run_starts
from riskframe.llm.hot import join_hot

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Largest component after scaling: squared distances over 64 components still fit 64 bits.
LARGEST = 1 << 27
#: Candidates whose distances a task works out at one time.
PAIRS = 1 << 13
ROWS = 2048


class Slices:
    """Nearest entries of one codebook, ``entries`` (entries x width), ties to the lower index."""

    def __init__(self, entries: np.ndarray):
        self.entries = e = np.ascontiguousarray(entries, np.int64)
        k, width = e.shape
        order = np.argsort(e, axis=0, kind="stable")
        self.coords = np.take_along_axis(e, order, axis=0).T.copy()
        own = np.zeros((k, -(-k // 64)), np.uint64)
        own[np.arange(k), np.arange(k) >> 6] = np.uint64(1) << (np.arange(k) & 63).astype(np.uint64)
        # before[d, i]: the entries at the first i places of dimension d
        self.before = np.zeros((width, k + 1, own.shape[1]), np.uint64)
        self.before[:, 1:] = np.bitwise_or.accumulate(own[order.T], axis=1)
        gaps = [np.sort(np.abs(e - row).max(axis=1))[1 if k > 1 else 0] for row in e]
        self.radius = max(1, int(np.median(gaps)))

    def box(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Mask of the entries within ``radius`` of each row in every dimension."""
        mask = np.full((len(x), self.before.shape[2]), np.uint64(0xFFFFFFFFFFFFFFFF))
        for d, coords in enumerate(self.coords):
            low = np.searchsorted(coords, x[:, d] - radius, side="left")
            high = np.searchsorted(coords, x[:, d] + radius, side="right")
            mask &= self.before[d, high] ^ self.before[d, low]
        return mask

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row of ``x``."""
        entry, best = np.zeros(len(x), np.int64), np.full(len(x), np.iinfo(np.int64).max)
        left, radius = np.arange(len(x)), np.full(len(x), self.radius, np.int64)
        while len(left):
            mask = self.box(x[left], radius)
            bits = np.unpackbits(mask.view(np.uint8), axis=1, bitorder="little")[:, : len(self.entries)]
            row, e = np.nonzero(bits)
            apart = np.empty(len(row), np.int64)
            for i in range(0, len(row), PAIRS):
                gap = x[left[row[i : i + PAIRS]]] - self.entries[e[i : i + PAIRS]]
                apart[i : i + PAIRS] = np.einsum("ij,ij->i", gap, gap)
            first = run_starts(row)
            if len(first):
                least = np.minimum.reduceat(apart, first)
                hit = np.flatnonzero(apart == np.repeat(least, np.diff(np.append(first, len(row)))))
                hit = hit[run_starts(row[hit])]  # entries ascend within a row
                found = left[row[hit]]
                entry[found], best[found] = e[hit], least
            seen = best[left]
            done = seen <= radius * radius
            wider = np.where(seen < np.iinfo(np.int64).max, np.ceil(np.sqrt(seen.astype(np.float64))).astype(np.int64) + 1, 2 * radius)
            left, radius = left[~done], wider[~done]
        return entry, best


@dataclass
class Codebooks:
    """``entries[part]`` (entries x width); ``width`` is that of whole vectors, None if there were none."""

    entries: list[np.ndarray]
    width: int | None

    def sha256(self) -> str:
        """Of all entries' decimal components by part, entry and place, comma-joined."""
        return hashlib.sha256(",".join(str(v) for part in self.entries for v in part.ravel().tolist()).encode()).hexdigest()

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The scaled vectors that rows of codes (vectors x parts) stand for."""
        return np.concatenate([e[codes[:, p]] for p, e in enumerate(self.entries)], axis=1)


def clean_vectors(df: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Rows whose vector is neither null nor empty and has only finite components, as doubles."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(v.isNotNull() & (F.size(v) > 0) & finite).withColumn(vector_col, v)


def scaled(column: pa.Array, width: int, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of a list column of vectors of equal width."""
    size = np.diff(column.offsets.to_numpy())
    if (size != width).any():
        raise ValueError(f"vectors of {width} and of {int(size[size != width][0])} components in one table")
    x = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False))
    if len(x) and np.abs(x).max() > LARGEST:
        raise ValueError(f"a component beyond {LARGEST // scale} in magnitude has no exact squared distance in 64 bits")
    return x.astype(np.int64).reshape(-1, width)


def sums(df: DataFrame, vector_col: str, books: Codebooks, scale: int) -> DataFrame:
    """(part, entry, place, s): componentwise sums of the parts nearest to each entry; place -1 counts them."""

    def run(batches):
        tables = [Slices(e) for e in books.entries]
        total = [np.zeros((len(t.entries), t.entries.shape[1] + 1), np.int64) for t in tables]
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                x = scaled(b.column(0).slice(lo, ROWS), books.width, scale)
                for t, out, part in zip(tables, total, np.split(x, len(tables), axis=1), strict=True):
                    entry, _ = t.nearest(part)
                    order = np.argsort(entry, kind="stable")
                    first = run_starts(entry[order])
                    if len(first):
                        used = entry[order][first]
                        out[used, 1:] += np.add.reduceat(part[order], first, axis=0)
                        out[used, 0] += np.diff(np.append(first, len(order)))
        for p, out in enumerate(total):
            e, d = np.nonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(e), p, np.int32)), pa.array(e.astype(np.int32)), pa.array((d - 1).astype(np.int32)), pa.array(out[e, d])],
                                             ["part", "entry", "place", "s"])

    each = df.select(vector_col).mapInArrow(run, "part int, entry int, place int, s long")
    return each.groupBy("part", "entry", "place").agg(F.sum("s").alias("s"))


def fit_codebooks(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
                  rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """``rounds`` of assigning every part of every vector and moving the entries to floor(sum / count).

    Starts at the ``entries`` smallest non-null ids (equal ids by their components; fewer rows
    give fewer entries); an unused entry stays. Vectors that are null, empty or hold null or
    non-finite components take no part; one of another width, or a width that ``parts``
    doesn't divide, is an error. Each round reads the table once and sends the driver one
    codebook of sums. An empty table, or one without an id, gives no entries.
    """
    clean = clean_vectors(df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")), "v")
    start = clean.where("id IS NOT NULL").orderBy("id", "v").limit(entries).collect()
    if not start:
        return Codebooks([], None)
    width = len(start[0]["v"])
    if width % parts:
        raise ValueError(f"{width} components can't be cut into {parts} equal parts")
    first = scaled(pa.array([r["v"] for r in start], pa.list_(pa.float64())), width, scale)
    books = Codebooks([np.ascontiguousarray(x) for x in np.split(first, parts, axis=1)], width)
    for _ in range(rounds):
        total = [np.zeros((len(start), width // parts + 1), np.int64) for _ in range(parts)]
        for r in sums(clean, "v", books, scale).collect():  # at most parts x entries x (width / parts + 1) rows
            total[r["part"]][r["entry"], r["place"] + 1] = r["s"]
        books = Codebooks([np.where(t[:, :1] > 0, t[:, 1:] // np.maximum(t[:, :1], 1), old) for t, old in zip(total, books.entries, strict=True)], width)
    return books


def encode(df: DataFrame, books: Codebooks, vector_col: str = "embedding", code_col: str = "codes", error_col: str = "error", scale: int = SCALE) -> DataFrame:
    """Rows with a clean vector (see ``fit_codebooks``), with ``codes`` (an entry a part) and ``error``.

    ``error`` is the sum over parts of the squared distance of the scaled part to its entry.
    Columns of these names are replaced, others pass through (vectors as doubles); repeated rows get equal codes. Without
    entries (nothing to fit on) there are no codes and no rows.
    """
    kept = clean_vectors(df.drop(code_col, error_col), vector_col)
    schema = kept.withColumn(code_col, F.array(F.lit(0))).withColumn(error_col, F.lit(0).cast("long")).schema
    if books.width is None:
        kept = kept.limit(0)
    at, names = kept.columns.index(vector_col), schema.names

    def run(batches):
        tables = [Slices(e) for e in books.entries]
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                b = batch.slice(lo, ROWS)
                x = scaled(b.column(at), books.width, scale)
                codes, error = np.zeros((len(x), len(tables)), np.int32), np.zeros(len(x), np.int64)
                for p, (t, part) in enumerate(zip(tables, np.split(x, len(tables), axis=1), strict=True)):
                    codes[:, p], apart = t.nearest(part)
                    error += apart
                lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(tables), codes.ravel())
                yield pa.RecordBatch.from_arrays([*b.columns, lists, pa.array(error)], names)

    return kept.mapInArrow(run, schema)


def error_by_label(encoded: DataFrame, label_col: str = "label", error_col: str = "error", out: str = "label_error") -> DataFrame:
    """Adds the error summed over all rows with an equal label, nulls together.

    Summed before the shuffle; a label with many rows meets its sum by broadcast (``join_hot``). A column
    named ``out`` is replaced; an empty table stays empty.
    """
    kept = encoded.drop(out)
    by = kept.groupBy(F.col(label_col).alias("_label")).agg(F.sum(error_col).alias(out), F.count(F.lit(1)).alias("_label_rows"))
    total = by.agg(F.sum("_label_rows").alias("n")).first()["n"] or 0
    return join_hot(kept.withColumn("_row_label", F.col(label_col)), by.withColumnRenamed("_label", "_row_label"), "_row_label", "_label_rows", total).drop("_label_rows", "_row_label")
