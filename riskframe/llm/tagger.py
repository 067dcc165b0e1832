"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Arrays are laid out feature by feature (directions x features x windows), so every step of
a batch is a few whole-array operations for both directions at once. The backward direction
reads each window reversed; what it reads beyond a short window's end is never used. Gates
and states are bent by x / (1 + |x|), which costs a fraction of a tanh.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from riskframe.llm.common import run_starts

#: ASCII characters are themselves; all others are one class.
CLASSES = 129
DIM, HIDDEN = 12, 8
BATCH = 1024


def char_classes(text: str) -> np.ndarray:
    """Class of each code point."""
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), CLASSES - 1).astype(np.uint8)


def bend(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|) in place; its slope is (1 - |result|) squared."""
    size = np.abs(x)
    size += 1
    x /= size
    return x


@dataclass
class Tagger:
    """Weights: ``char`` (classes x DIM), per direction ``inp``, ``rec`` and ``bias`` of the gates
    in the order input, forget, output, new; ``out`` (labels x 2 HIDDEN) and ``out_b``; ``trans``
    (from x to), ``begin`` and ``end`` of the CRF."""

    w: dict[str, np.ndarray]

    @property
    def labels(self) -> int:
        return len(self.w["out_b"])

    def states(self, codes: np.ndarray, size: np.ndarray, keep: bool = False):
        """Hidden states (steps, 2, HIDDEN, windows) of a batch ``codes`` (windows x steps), the backward
        ones still in reading order; with ``keep`` also what back-propagation needs."""
        n, steps = codes.shape
        w = self.w
        table = np.einsum("vd,sdg->sgv", w["char"], w["inp"]) + w["bias"][:, :, None]
        # a gate is (1 + bend(x / 2)) / 2, as a sigmoid is of tanh: one call serves all four
        half = np.repeat(np.array([0.5, 0.5, 0.5, 1.0], np.float32), HIDDEN)[None, :, None]
        table, rec = (table * half).astype(np.float32), (w["rec"] * half).astype(np.float32)
        back = np.take_along_axis(codes, np.maximum(size[:, None] - 1 - np.arange(steps), 0), axis=1)
        read = np.ascontiguousarray(np.stack([codes, back]).transpose(2, 0, 1))  # steps, 2, windows
        h, c = np.zeros((2, HIDDEN, n), np.float32), np.zeros((2, HIDDEN, n), np.float32)
        out = np.empty((steps, 2, HIDDEN, n), np.float32)
        memo = []
        for t in range(steps):
            a = np.matmul(rec, h)
            a[0] += table[0][:, read[t, 0]]
            a[1] += table[1][:, read[t, 1]]
            bend(a)
            a[:, : 3 * HIDDEN] *= 0.5
            a[:, : 3 * HIDDEN] += 0.5
            i, f, o, g = (a[:, k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
            old = c
            c = f * c + i * g
            tc = bend(c.copy())
            if keep:
                memo.append((h, old, a, tc))
            h = np.multiply(o, tc, out=out[t])
        return out, (read, memo)

    def emissions(self, states: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Score of each label at each place: (steps, labels, windows)."""
        steps, _, _, n = states.shape
        w = self.w
        fore = np.matmul(w["out"][:, :HIDDEN], states[:, 0])
        back = np.matmul(w["out"][:, HIDDEN:], states[:, 1])
        if (size == steps).all():
            back = back[::-1]
        else:
            place = np.maximum(size[None] - 1 - np.arange(steps)[:, None], 0)
            back = np.take_along_axis(back, place[:, None, :], axis=0)
        return fore + back + w["out_b"][:, None]

    def decode(self, codes: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Best label sequence (Viterbi) of each window of a batch: (windows x steps), 0 beyond its size."""
        emit = self.emissions(self.states(codes, size)[0], size)
        steps, labels, n = emit.shape
        w = self.w
        score = np.empty((steps, labels, n), np.float32)
        score[0] = emit[0] + w["begin"][:, None]
        plain = score[0, 0]  # of label 0 all the way, added in the same order
        for t in range(1, steps):
            best = score[t - 1][0] + w["trans"][0][:, None]
            for k in range(1, labels):
                np.maximum(best, score[t - 1][k] + w["trans"][k][:, None], out=best)
            np.add(best, emit[t], out=score[t])
            plain = (plain + w["trans"][0, 0]) + emit[t, 0]
        out = np.zeros((n, steps), np.uint8)
        if (size == steps).all():
            # only windows with something better than label 0 throughout have a path to trace
            some = np.flatnonzero((score[-1] + w["end"][:, None]).max(axis=0) > plain + w["end"][0])
        else:
            some = np.arange(n)
        out[some] = self._trace(score[:, :, some], size[some])
        return out

    def _trace(self, score: np.ndarray, size: np.ndarray) -> np.ndarray:
        (steps, _, n), w = score.shape, self.w
        path, y = np.zeros((steps, n), np.uint8), np.zeros(n, np.int64)
        for t in range(steps - 1, -1, -1):
            last = size - 1 == t
            follow = np.argmax(score[t] + w["trans"][:, y], axis=0)
            y = np.where(last, np.argmax(score[t] + w["end"][:, None], axis=0), follow) if last.any() else follow
            path[t] = y
        path[np.arange(steps)[:, None] >= size[None]] = 0
        return path.T


def fresh(labels: int, seed: int = 7) -> Tagger:
    rng = np.random.default_rng(seed)
    r = lambda *s, k=0.3: rng.normal(0, k, s).astype(np.float32)
    z = lambda *s: np.zeros(s, np.float32)
    bias = z(2, 4 * HIDDEN)
    bias[:, HIDDEN : 2 * HIDDEN] = 1  # remember at first
    return Tagger({"char": r(CLASSES, DIM), "inp": r(2, DIM, 4 * HIDDEN), "rec": r(2, 4 * HIDDEN, HIDDEN), "bias": bias,
                   "out": r(labels, 2 * HIDDEN), "out_b": z(labels), "trans": z(labels, labels), "begin": z(labels), "end": z(labels)})


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


def loss_and_gradients(model: Tagger, codes: np.ndarray, size: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log likelihood of label sequences ``y`` (windows x steps), and its gradients."""
    w, (n, steps) = model.w, codes.shape
    states, (read, memo) = model.states(codes, size, keep=True)
    emit = model.emissions(states, size).astype(np.float64)
    labels = model.labels
    trans, begin, end = (w[k].astype(np.float64) for k in ("trans", "begin", "end"))
    live = np.arange(steps)[:, None] < size[None]  # steps x windows
    alpha, beta = np.empty_like(emit), np.empty_like(emit)
    alpha[0] = emit[0] + begin[:, None]
    for t in range(1, steps):
        alpha[t] = _log_sum(alpha[t - 1][:, None, :] + trans[:, :, None], 0) + emit[t]
    for t in range(steps - 1, -1, -1):
        stop = np.repeat(end[:, None], n, axis=1)
        on = _log_sum(trans[:, :, None] + (emit[t + 1] + beta[t + 1])[None], 1) if t + 1 < steps else stop
        beta[t] = np.where(size - 1 == t, stop, on)
    total = _log_sum(alpha[0] + beta[0], 0)
    at = np.arange(n)
    gold = begin[y[:, 0]] + end[y[at, size - 1]]
    g = {k: np.zeros_like(w[k], np.float64) for k in w}
    de = np.exp(np.where(live[:, None], alpha + beta - total, -np.inf))
    np.add.at(g["end"], y[at, size - 1], -1)
    np.add.at(g["begin"], y[:, 0], -1)
    g["begin"] += de[0].sum(axis=1)
    g["end"] += de[size - 1, :, at].sum(axis=0)
    for t in range(steps):
        k = live[t]
        gold = gold + np.where(k, emit[t][y[:, t], at], 0)
        de[t][y[k, t], at[k]] -= 1
        if t:
            pair = np.exp(np.where(k, alpha[t - 1][:, None] + trans[:, :, None] + (emit[t] + beta[t])[None] - total, -np.inf))
            g["trans"] += pair.sum(axis=2)
            np.add.at(g["trans"], (y[k, t - 1], y[k, t]), -1)
            gold = gold + np.where(k, trans[y[:, t - 1], y[:, t]], 0)
    loss = float((total - gold).mean())
    for k in ("trans", "begin", "end"):
        g[k] /= n
    de = (de / n).astype(np.float32)
    place = np.maximum(size[None] - 1 - np.arange(steps)[:, None], 0)
    back = np.where(live[:, None], np.take_along_axis(de, place[:, None, :], axis=0), 0)  # in reading order
    g["out_b"] = de.sum(axis=(0, 2))
    g["out"] = np.concatenate([np.einsum("tln,thn->lh", de, states[:, 0]), np.einsum("tln,thn->lh", back, states[:, 1])], axis=1)
    dh_out = np.stack([np.einsum("lh,tln->thn", w["out"][:, :HIDDEN], de), np.einsum("lh,tln->thn", w["out"][:, HIDDEN:], back)], axis=1)
    das = np.empty((steps, 2, 4 * HIDDEN, n), np.float32)
    dh, dc = np.zeros((2, HIDDEN, n), np.float32), np.zeros((2, HIDDEN, n), np.float32)
    rec_t = w["rec"].transpose(0, 2, 1)
    for t in range(steps - 1, -1, -1):
        h, old, a, tc = memo[t]
        i, f, o, new = (a[:, k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
        dh = dh + dh_out[t]
        dc = dc + dh * o * (1 - np.abs(tc)) ** 2
        gate = lambda x: (1 - np.abs(2 * x - 1)) ** 2 / 4  # noqa: E731  the slope of (1 + bend(x / 2)) / 2
        da = das[t]
        np.concatenate([dc * new * gate(i), dc * old * gate(f), dh * tc * gate(o), dc * i * (1 - np.abs(new)) ** 2], axis=1, out=da)
        g["rec"] += np.matmul(da, h.transpose(0, 2, 1))
        dh, dc = np.matmul(rec_t, da), dc * f
    dtable = np.zeros((2, CLASSES, 4 * HIDDEN), np.float32)
    for s in (0, 1):
        chars = read[:, s].ravel()
        order = np.argsort(chars, kind="stable")
        first = run_starts(chars[order])
        dtable[s, chars[order][first]] = np.add.reduceat(das[:, s].transpose(0, 2, 1).reshape(-1, 4 * HIDDEN)[order], first, axis=0)
    g["bias"] = dtable.sum(axis=1)
    g["inp"] = np.einsum("vd,svg->sdg", w["char"], dtable)
    g["char"] = np.einsum("svg,sdg->vd", dtable, w["inp"])
    return loss, g


def train(codes: np.ndarray, size: np.ndarray, y: np.ndarray, labels: int, seed: int = 7, epochs: int = 20, batch: int = 128, rate: float = 0.02) -> Tagger:
    """Fits by Adam on windows ``codes`` with label sequences ``y`` (both windows x steps)."""
    rng = np.random.default_rng(seed)
    model = fresh(labels, seed)
    w = model.w
    m1, m2, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    for epoch in range(epochs):
        for part in np.array_split(rng.permutation(len(codes)), max(1, len(codes) // batch, min(16, len(codes) // 16))):
            _, g = loss_and_gradients(model, codes[part].astype(np.int64), size[part], y[part].astype(np.int64))
            norm = np.sqrt(sum((x * x).sum() for x in g.values()))
            step += 1
            for k, x in g.items():
                x = (x * min(1, 5 / max(norm, 1e-9))).astype(np.float32)
                m1[k] += 0.1 * (x - m1[k])
                m2[k] += 0.001 * (x * x - m2[k])
                w[k] -= rate * (1 - 0.9 * epoch / epochs) * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    return model
