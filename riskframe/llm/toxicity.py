"""Toxicity: a bidirectional gated recurrent network with attention pooling.

Each word enters as a learned vector of its hashed form next to the mean of learned
vectors of its character n-grams. The network reads overlapping windows of words in
both directions, attention pools its states, and a text scores as its most toxic
window. Training, in numpy, runs on windows mined from a bounded labelled sample:
first those whose words tell the classes apart most, then those that the network
itself finds most toxic. The input part of the gates depends on the word alone, so
a task works it out once per different word.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import chunks
from riskframe.llm.quality import labelled_sample
from riskframe.llm.subwords import WordTable, mean_by_owner, subword_ids, words_of

WORD_BUCKETS, CHAR_BUCKETS, SIZES = 1 << 14, 1 << 13, (3, 4)
DIM, HIDDEN, POOL = 8, 8, 8
WINDOW, STRIDE = 32, 16
#: Labelled rows of each class that a fit may take, least hash of the id first.
FIT_ROWS = 2000
FOLDS, FOLD = 3, 1
THRESHOLD = 0.7
EDGES = ".,;:!?\"'()[]{}<>|*_-"
BATCH = 2048
#: Words whose inputs are worked out at one time.
PART = 20_000


def normal(word: str) -> str:
    return word.strip(EDGES).lower() or word


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Toxic:
    """Weights by name, and the line from a text's highest window logit to its log odds."""

    w: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0
    base: float | None = field(default=None)  # log odds of every text, where there was nothing to learn from

    def word_vectors(self, words: list[str]) -> np.ndarray:
        own = [normal(x) for x in words]
        whole, _ = subword_ids(own, WORD_BUCKETS, ())
        ids, owner = subword_ids(own, CHAR_BUCKETS, SIZES, whole=False)
        return np.concatenate([self.w["word"][whole], mean_by_owner(self.w["char"][ids], owner, len(own))], axis=1)

    def gates_in(self, words: list[str]) -> np.ndarray:
        return self.word_vectors(words) @ self.w["in"] + self.w["in_b"]

    def window_logits(self, rows: np.ndarray, place: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Logit of each window: words ``start`` to ``start + size`` of ``place``, with their gate rows."""
        out = np.empty(len(start), np.float32)
        order = np.argsort(-size, kind="stable")
        for lo in range(0, len(order), BATCH):
            w = order[lo : lo + BATCH]
            states, size_w = self._states(rows, place, start[w], size[w], None)
            out[w] = self._pool(states, size_w)[0]
        return out

    def _states(self, rows, place, start, size, memo):
        """States of windows sorted by size, longest first: (steps, windows, 2 x HIDDEN)."""
        n, steps = len(start), int(size[0])
        states = np.zeros((steps, n, 2 * HIDDEN), np.float32)
        live = np.searchsorted(-size, -np.arange(steps), side="left")
        for side in (0, 1):
            u, un, bn = self.w["rec"][side], self.w["rec_n"][side], self.w["rec_b"][side]
            cols = slice(3 * HIDDEN * side, 3 * HIDDEN * (side + 1))
            h = np.zeros((n, HIDDEN), np.float32)
            for t in range(steps):
                m = live[t]
                at = np.full(m, t) if side == 0 else size[:m] - 1 - t
                x = rows[place[start[:m] + at], cols]
                old = h[:m]
                g = 1 / (1 + np.exp(-(x[:, : 2 * HIDDEN] + old @ u)))
                z, r = g[:, :HIDDEN], g[:, HIDDEN:]
                q = old @ un + bn
                c = np.tanh(x[:, 2 * HIDDEN :] + r * q)
                new = c + z * (old - c)
                if memo is not None:
                    memo.append((side, t, m, at, old.copy(), z, r, q, c))
                h[:m] = new
                states[at, np.arange(m), HIDDEN * side : HIDDEN * (side + 1)] = new
        return states, size

    def _pool(self, states, size):
        a = np.tanh(states @ self.w["att"] + self.w["att_b"])
        e = a @ self.w["att_v"]
        e = np.where(np.arange(len(states))[:, None] < size[None, :], e, -1e9)
        p = np.exp(e - e.max(axis=0))
        p /= p.sum(axis=0)
        context = np.einsum("tb,tbh->bh", p, states)
        return context @ self.w["out"] + self.w["out_b"][0], (a, p, context)


def fresh(seed: int) -> Toxic:
    rng = np.random.default_rng(seed)
    r = lambda *s, k=0.3: rng.normal(0, k, s).astype(np.float32)
    z = lambda *s: np.zeros(s, np.float32)
    return Toxic({
        "word": r(WORD_BUCKETS, DIM, k=0.1), "char": r(CHAR_BUCKETS, DIM, k=0.1), "in": r(2 * DIM, 6 * HIDDEN), "in_b": z(6 * HIDDEN),
        "rec": r(2, HIDDEN, 2 * HIDDEN), "rec_n": r(2, HIDDEN, HIDDEN), "rec_b": z(2, HIDDEN),
        "att": r(2 * HIDDEN, POOL), "att_b": z(POOL), "att_v": r(POOL), "out": r(2 * HIDDEN), "out_b": z(1)})


def gradients(model: Toxic, vectors: np.ndarray, place: np.ndarray, start: np.ndarray, size: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Of the mean cross entropy of windows sorted by size: by weight name, and by row of ``vectors``."""
    w = model.w
    rows = vectors @ w["in"] + w["in_b"]
    memo: list = []
    states, size = model._states(rows, place, start, size, memo)
    logit, (a, p, context) = model._pool(states, size)
    d = (sigmoid(logit) - y).astype(np.float32) / len(y)
    g = {"out": context.T @ d, "out_b": np.array([d.sum()], np.float32)}
    dc = d[:, None] * w["out"]
    dp = np.einsum("bh,tbh->tb", dc, states)
    ds = p[:, :, None] * dc[None]
    de = p * (dp - (p * dp).sum(axis=0))
    g["att_v"] = np.einsum("tb,tba->a", de, a)
    da = de[:, :, None] * w["att_v"] * (1 - a * a)
    g["att"], g["att_b"] = np.einsum("tbh,tba->ha", states, da), da.sum(axis=(0, 1))
    ds += da @ w["att"].T
    drows = np.zeros_like(rows)
    for k in ("rec", "rec_n", "rec_b"):
        g[k] = np.zeros_like(w[k])
    dh = np.zeros((len(start), HIDDEN), np.float32)
    last = None
    for side, _, m, at, old, z, r, q, c in reversed(memo):
        if side != last:
            dh[:], last = 0, side
        d = dh[:m] + ds[at, np.arange(m), HIDDEN * side : HIDDEN * (side + 1)]
        dz = d * (old - c) * z * (1 - z)
        dc = d * (1 - z) * (1 - c * c)
        dq = dc * r
        dr = dc * q * r * (1 - r)
        gates = np.concatenate([dz, dr], axis=1)
        g["rec"][side] += old.T @ gates
        g["rec_n"][side] += old.T @ dq
        g["rec_b"][side] += dq.sum(axis=0)
        dh[:m] = d * z + gates @ w["rec"][side].T + dq @ w["rec_n"][side].T
        np.add.at(drows, (place[start[:m] + at], slice(3 * HIDDEN * side, 3 * HIDDEN * (side + 1))), np.concatenate([gates, dc], axis=1))
    g["in"], g["in_b"] = vectors.T @ drows, drows.sum(axis=0)
    return g, drows @ w["in"].T


def windows(n: np.ndarray, window: int = WINDOW, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start among all words, size) of every window; each two neighbours share ``window - stride`` words."""
    count = np.where(n > 0, np.maximum(0, -(-(n - window) // stride)) + 1, 0)
    doc = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    begin = np.cumsum(n) - n
    return doc, begin[doc] + k * stride, np.minimum(window, n[doc] - k * stride)


def numbered(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The different words of all texts, normalised, each word's number, and each text's word count."""
    raw: dict[str, int] = {}
    names: dict[str, int] = {}
    place, n = [], []
    for t in texts:
        words = t.split()
        for w in words:
            if w not in raw:
                raw[w] = names.setdefault(normal(w), len(names))
        place.append(np.fromiter(map(raw.__getitem__, words), np.int32, len(words)))
        n.append(len(words))
    return list(names), np.concatenate(place), np.array(n, np.int64)


def word_inputs(names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word, the bucket of its form, and the buckets of its n-grams from ``first[i]`` to ``first[i + 1]``."""
    whole, ids, count = [], [], []
    for i in range(0, len(names), PART):
        part = names[i : i + PART]
        whole.append(subword_ids(part, WORD_BUCKETS, ())[0].astype(np.int32))
        flat, owner = subword_ids(part, CHAR_BUCKETS, SIZES, whole=False)
        ids.append(flat.astype(np.int32))
        count.append(np.bincount(owner, minlength=len(part)))
    return np.concatenate(whole), np.concatenate(ids), np.append(0, np.cumsum(np.concatenate(count)))


def train(rows: list[tuple[int, str]], total: dict[int, int], seed: int = 5, epochs: tuple[int, ...] = (6, 4)) -> Toxic:
    """Fits the network and, on a quarter of the texts it hasn't seen, the line to log odds."""
    n1, n0 = total.get(1, 0), total.get(0, 0)
    base = float(np.log((n1 + 0.5) / (n0 + 0.5)))
    rows = sorted((y, t) for y, t in rows if t and t.split())
    if len({y for y, _ in rows}) < 2:
        return Toxic({}, base=base)
    rng = np.random.default_rng(seed)
    rows = [rows[i] for i in rng.permutation(len(rows))]
    y = np.array([v for v, _ in rows])
    names, place, n = numbered([t for _, t in rows])
    doc, start, size = windows(n)
    fit = np.arange(len(rows)) % 4 != 0
    if len(set(y[fit])) < 2 or len(set(y[~fit])) < 2:
        fit[:] = True

    # how much each word tells the classes apart, by the fitted documents that hold it
    df = np.zeros((2, len(names)))
    at = np.cumsum(n) - n
    for i in np.flatnonzero(fit):
        df[y[i], np.unique(place[at[i] : at[i] + n[i]])] += 1
    odds = np.log((df[1] + 0.5) / ((y[fit] == 1).sum() + 1)) - np.log((df[0] + 0.5) / ((y[fit] == 0).sum() + 1))
    rank = np.maximum.reduceat(np.append(odds[place], -99), np.stack([start, start + size], axis=1).ravel())[::2]

    model = fresh(seed)
    w = model.w
    whole, ids, first = word_inputs(names)
    step, m1, m2 = 0, {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
    for phase, rounds in enumerate(epochs):
        if phase:
            table = np.concatenate([model.gates_in(names[i : i + PART]) for i in range(0, len(names), PART)])
            rank = model.window_logits(table, place, start, size)
        order = np.lexsort((-rank, doc))
        top = np.flatnonzero(np.concatenate(([True], doc[order][1:] != doc[order][:-1])))
        for epoch in range(rounds):
            lead = order[top]
            any_ = rng.permutation(len(doc))[: len(top)]
            chosen = np.unique(np.concatenate([lead, any_[y[doc[any_]] == 0]]))
            chosen = chosen[fit[doc[chosen]]]
            for part in np.array_split(rng.permutation(chosen), max(1, len(chosen) // 128, min(len(chosen) // 8, 24))):
                part = part[np.argsort(-size[part], kind="stable")]
                spots = np.concatenate([np.arange(s, s + k) for s, k in zip(start[part], size[part], strict=True)])
                used, inv = np.unique(place[spots], return_inverse=True)
                many = first[used + 1] - first[used]
                flat = np.concatenate([ids[first[u] : first[u + 1]] for u in used])
                own = np.repeat(np.arange(len(used)), many)
                vectors = np.concatenate([w["word"][whole[used]], mean_by_owner(w["char"][flat], own, len(used))], axis=1)
                at = np.cumsum(size[part]) - size[part]
                g, dv = gradients(model, vectors, inv, at, size[part], y[doc[part]])
                g["word"], g["char"] = np.zeros_like(w["word"]), np.zeros_like(w["char"])
                np.add.at(g["word"], whole[used], dv[:, :DIM])
                np.add.at(g["char"], flat, (dv[:, DIM:] / many[:, None])[own])
                step += 1
                rate = 0.01 * (1 - 0.8 * epoch / rounds)
                for k, x in g.items():
                    m1[k] += 0.1 * (x - m1[k])
                    m2[k] += 0.001 * (x * x - m2[k])
                    w[k] -= rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    table = np.concatenate([model.gates_in(names[i : i + PART]) for i in range(0, len(names), PART)])
    logit = np.full(len(rows), -np.inf)
    np.maximum.at(logit, doc, model.window_logits(table, place, start, size))
    some = ~fit if (~fit).any() else fit
    x, t = logit[some], y[some]
    weight = np.where(t == 1, n1 / max(1, (t == 1).sum()), n0 / max(1, (t == 0).sum()))
    weight /= weight.sum()
    a, b = 1.0, 0.0
    for _ in range(200):  # Newton's method with a little shrinkage
        p = sigmoid(a * x + b)
        gr = np.array([(weight * (p - t) * x).sum() + 1e-3 * (a - 1), (weight * (p - t)).sum() + 1e-4 * b])
        v = weight * p * (1 - p)
        hess = np.array([[(v * x * x).sum() + 1e-3, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-4]])
        move = np.clip(np.linalg.solve(hess, gr), -0.5, 0.5)
        a, b = a - move[0], b - move[1]
        if abs(move).max() < 1e-6:
            break
    model.scale, model.shift = float(max(a, 0.05)), float(b)
    return model


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, fold: int = FOLD, rows: int = FIT_ROWS) -> Toxic:
    """Fits on at most ``rows`` labelled documents of each class outside the held-out fold."""
    sample, total = labelled_sample(docs, labels, label, folds, fold, rows)
    return train([(r["label"], r["text"]) for r in sample.collect()], total)


def score_toxicity(docs: DataFrame, model: Toxic, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Every input row and column plus ``score_col``, the probability of class 1 of the
    whole text, from the highest logit of all its overlapping windows.

    A column of that name is replaced. Null and empty texts have no window and score
    0; repeated rows score alike; an empty table stays empty.
    """
    kept = docs.drop(score_col)
    at, names = kept.columns.index(text_col), [*kept.columns, score_col]

    def run(batches):
        table = WordTable(model.gates_in, 6 * HIDDEN, 250_000)
        for b in batches:
            score = np.zeros(b.num_rows)
            for lo, hi in chunks(b, at):
                words, n = words_of(b.column(at).slice(lo, hi - lo).to_pylist())
                if model.base is not None:
                    score[lo:hi] = np.where(n > 0, sigmoid(np.float64(model.base)), 0.0)
                    continue
                place = table.index(words)
                doc, start, size = windows(n)
                top = np.full(len(n), -np.inf)
                np.maximum.at(top, doc, model.window_logits(table.rows, place, start, size))
                score[lo:hi] = np.where(n > 0, sigmoid(model.scale * np.maximum(top, -1e3) + model.shift), 0.0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score)], names)

    return kept.mapInArrow(run, kept.withColumn(score_col, F.lit(0.0)).schema)
