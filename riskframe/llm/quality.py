"""Quality classifier: subword embeddings averaged per document, softmax output.

A word's vector is the mean of learned vectors of its hashed form and its hashed
character n-grams; a document's is the mean over its words. A word that repeats
the one before it adds one more word, the mark ``REPEAT``. Both layers are
trained together by stochastic gradient descent on a bounded labelled sample.
Because all is linear up to the softmax, a trained model scores a word by one
number, which each task works out once per different word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import chunks, held_out
from riskframe.llm.subwords import WordTable, mean_by_owner, subword_ids, words_of

BUCKETS = 1 << 17
SIZES = (2, 3)
DIM = 12
#: Labelled rows of each class that a fit may take, least hash of the id first.
FIT_ROWS = 2000
EPOCHS = 6
#: Fold of crc32(doc_id) that no fit sees: 2 of 4.
FOLDS, FOLD = 4, 2
THRESHOLD = 0.7
#: Stands for a repetition among the words; as it holds a space, no text has it.
REPEAT = "= ="


@dataclass
class Quality:
    """``table``: a bucket's part of the log odds of class 1; ``bias``: the rest."""

    table: np.ndarray
    bias: float

    def word_values(self, words: list[str]) -> np.ndarray:
        ids, owner = subword_ids(words, len(self.table), SIZES)
        return mean_by_owner(self.table[ids], owner, len(words))[:, None]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, rows: int = FIT_ROWS) -> tuple[DataFrame, dict[int, int]]:
    """Texts of up to ``rows`` labelled documents of each class outside the held-out fold.

    Returns (label, text) rows, and how many labelled rows each class has in all.
    Labels with a null id or a value other than 0 and 1 are not used.
    """
    own = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("label"))
    own = own.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("id", folds, fold))
    total = {r["label"]: r["n"] for r in own.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    some = None
    for v in sorted(total):  # two classes at most
        part = own.where(F.col("label") == v).orderBy(F.xxhash64("id"), "id").limit(rows)
        some = part if some is None else some.unionAll(part)
    if some is None:
        some = own.limit(0)
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text"))
    # the sample holds two times ``rows`` ids at most
    return texts.join(F.broadcast(some), "id").select("label", "text"), total


def sample_features(sample: DataFrame) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(label, bucket ids, weights that sum to 1) of each sampled document."""

    def run(batches):
        for b in batches:
            for lo, hi in chunks(b, 1):
                out = []
                for t in b.column(1).slice(lo, hi - lo).to_pylist():
                    own = (t or "").split()
                    if not own:
                        out.append((b"", b""))
                        continue
                    own += [REPEAT] * sum(map(str.__eq__, own, own[1:]))
                    words, times = np.unique(np.array(own, dtype=object), return_counts=True)
                    ids, owner = subword_ids(list(words), BUCKETS, SIZES)
                    w = (times / times.sum() / np.bincount(owner, minlength=len(words)))[owner]
                    u, inv = np.unique(ids, return_inverse=True)
                    out.append((u.astype("<i4").tobytes(), np.bincount(inv, w).astype("<f4").tobytes()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array([x for x, _ in out], pa.binary()), pa.array([x for _, x in out], pa.binary())], ["label", "ids", "weights"])

    rows = sample.select("label", "text").mapInArrow(run, "label int, ids binary, weights binary").collect()
    return [(r["label"], np.frombuffer(r["ids"], "<i4"), np.frombuffer(r["weights"], "<f4")) for r in rows]


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], total: dict[int, int], epochs: int = EPOCHS, seed: int = 7) -> Quality:
    """Softmax over averaged vectors by gradient descent with per-row step sizes.

    Each class weighs as much as it has labelled rows in all. With one class or
    none the model is its base rate.
    """
    n1, n0 = total.get(1, 0), total.get(0, 0)
    base = float(np.log((n1 + 0.5) / (n0 + 0.5)))
    if not n0 or not n1:
        return Quality(np.zeros(BUCKETS, np.float32), base)
    rows = sorted(rows, key=lambda r: (r[0], r[1].tobytes()))  # the same order however they were collected
    have = {v: max(1, sum(r[0] == v for r in rows)) for v in (0, 1)}
    weight = {v: total[v] / have[v] / max(total[u] / have[u] for u in (0, 1)) for v in (0, 1)}
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32)
    bias = np.array([0, base], np.float32)
    seen, seen_out, seen_bias = np.full(BUCKETS, 1e-8, np.float32), np.full(out.shape, 1e-8, np.float32), np.full(2, 1e-8, np.float32)
    for epoch in range(epochs):
        rate = 0.3 * (1 - epoch / epochs)
        for i in rng.permutation(len(rows)):
            y, ids, w = rows[i]
            e = emb[ids]
            doc = w @ e if len(ids) else np.zeros(DIM, np.float32)
            z = doc @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            p *= weight[y]
            back = out @ p
            g = np.outer(doc, p)
            seen_out += g * g
            out -= 0.1 * rate * g / np.sqrt(seen_out)
            seen_bias += p * p
            bias -= 0.1 * rate * p / np.sqrt(seen_bias)
            if len(ids):
                gg = (w * w) * (back @ back) / DIM
                seen[ids] += gg
                emb[ids] = e - (rate * w / np.sqrt(seen[ids]))[:, None] * back
    return Quality((emb @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, fold: int = FOLD, rows: int = FIT_ROWS) -> Quality:
    """Fits on at most ``rows`` labelled documents of each class outside the held-out fold."""
    sample, total = labelled_sample(docs, labels, label, folds, fold, rows)
    return train(sample_features(sample), total)


def score_quality(docs: DataFrame, model: Quality, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Every input row and column plus ``score_col``, the probability of class 1 of the whole text.

    A column of that name is replaced. Null and empty texts score the model's bias
    alone; repeated rows score alike; an empty table stays empty.
    """
    kept = docs.drop(score_col)
    at, names = kept.columns.index(text_col), [*kept.columns, score_col]

    def run(batches):
        table = WordTable(model.word_values, 1)
        for b in batches:
            score = np.zeros(b.num_rows)
            for lo, hi in chunks(b, at):
                words, n = words_of(b.column(at).slice(lo, hi - lo).to_pylist())
                place = table.index([REPEAT, *words])
                mark, place = table.rows[place[0], 0], place[1:]
                s = np.concatenate(([0.0], np.cumsum(table.rows[place, 0].astype(np.float64))))
                same = np.zeros(len(place) + 1, np.int64)
                same[1:-1] = np.cumsum(place[1:] == place[:-1])[: max(len(place) - 1, 0)]
                if len(place):
                    same[-1] = same[-2]  # same[i]: repeats among the pairs that begin before word i
                ends = np.cumsum(n)
                # pairs within a document begin before its last word
                again = np.where(n > 0, same[np.maximum(ends - 1, 0)] - same[ends - n], 0)
                score[lo:hi] = (s[ends] - s[ends - n] + again * mark) / np.maximum(n + again, 1) + model.bias
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(1 / (1 + np.exp(-score)))], names)

    return kept.mapInArrow(run, kept.withColumn(score_col, F.lit(0.0)).schema)
