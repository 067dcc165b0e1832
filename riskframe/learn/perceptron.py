"""E9 with an L2 term: multilayer perceptrons fitted by back-propagation over whole tables.

Each pass reads the rows once; every task adds up loss and gradient of all networks that
still move, and Spark sums them, an array per network. The driver holds the weights, which
don't grow with the rows, and takes L-BFGS steps. Strengths of the L2 term share the passes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame

from riskframe.learn import batch

#: Steps that L-BFGS remembers.
MEMORY = 10
#: A network ends when its loss fell by less than this over ``PATIENCE`` steps.
TOLERANCE, PATIENCE = 1e-4, 10


def unpacked(w: np.ndarray, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(weights, intercepts) of each layer from one flat array."""
    out, at = [], 0
    for a, b in zip(sizes[:-1], sizes[1:], strict=True):
        out.append((w[at : at + a * b].reshape(a, b), w[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def started(sizes: Sequence[int], seed: int) -> np.ndarray:
    """First weights: uniform within sqrt(6 / (fan in + fan out)), sqrt(2 / ...) for the output layer."""
    rng = np.random.default_rng(seed)
    layers = list(zip(sizes[:-1], sizes[1:], strict=True))
    return np.concatenate([rng.uniform(-1, 1, a * b + b) * np.sqrt((2 if i == len(layers) - 1 else 6) / (a + b)) for i, (a, b) in enumerate(layers)])


def margins(w: np.ndarray, sizes: Sequence[int], x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The log odds of each row, and the inputs of each layer (rectified in between)."""
    seen, layers = [x], unpacked(w, sizes)
    for i, (m, b) in enumerate(layers):
        z = seen[-1] @ m + b
        if i == len(layers) - 1:
            return z[:, 0], seen
        seen.append(np.maximum(z, 0))
    raise ValueError("a network has an output layer")


def loss_and_slope(w: np.ndarray, sizes: Sequence[int], x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Sum over rows of the log loss, and its gradient by back-propagation."""
    z, seen = margins(w, sizes, x)
    delta = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y)[:, None]
    parts = []
    for (m, _), a in zip(reversed(unpacked(w, sizes)), reversed(seen), strict=True):
        parts.append(np.concatenate([(a.T @ delta).ravel(), delta.sum(axis=0)]))
        delta = (delta @ m.T) * (a > 0)  # unused before the first layer
    return float((np.logaddexp(0, z) - y * z).sum()), np.concatenate(parts[::-1])


@dataclass
class Network:
    """A perceptron with one output; ``alpha`` weighs half the squared weights (not intercepts), divided by the rows."""

    sizes: tuple[int, ...]
    alpha: float = 1e-4
    weights: np.ndarray | None = None
    loss: float = np.inf
    done: bool = False
    slope: np.ndarray | None = None
    steps: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    def held(self) -> np.ndarray:
        """1 where the L2 term applies."""
        return np.concatenate([np.concatenate([np.ones(a * b), np.zeros(b)]) for a, b in zip(self.sizes[:-1], self.sizes[1:], strict=True)])

    def direction(self) -> np.ndarray:
        """L-BFGS: the remembered steps' estimate of the Newton step."""
        q, marks = self.slope.copy(), []
        for s, v in reversed(self.steps):
            a = s @ q / (s @ v)
            q -= a * v
            marks.append(a)
        if self.steps:
            s, v = self.steps[-1]
            q *= (s @ v) / (v @ v)
        for (s, v), a in zip(self.steps, reversed(marks), strict=True):
            q += s * (a - v @ q / (s @ v))
        return -q


def fit(rows: DataFrame, networks: list[Network], view: batch.View, n: int, leave_out: int | None = None, seed: int = 42, max_iter: int = 1000) -> list[Network]:
    """Fits all networks on the ``n`` rows of a written ``batch.table`` outside fold ``leave_out``; one pass of
    the rows per step tried. A step that doesn't lower a network's loss enough is halved in the next pass.
    Without rows the first weights stay."""
    at, step, length = {}, {}, {}
    for i, net in enumerate(networks):
        net.weights = started(net.sizes, seed) if net.weights is None else net.weights
        net.loss, net.done, net.slope, net.steps, net.losses = np.inf, n == 0, None, [], []
        at[i] = net.weights
    for _ in range(max_iter):
        live = [i for i, net in enumerate(networks) if not net.done]
        if not live:
            break
        plan = [(i, at[i], networks[i].sizes) for i in live]

        def work(batches, plan=plan):
            out: dict[int, np.ndarray] = {}
            for b in batches:
                for lo in range(0, b.num_rows, batch.ROWS):
                    x, y, fold = batch.rows_of(b.slice(lo, batch.ROWS))
                    use = np.ones(len(y), bool) if leave_out is None else fold != leave_out
                    z = view.of(x[use])
                    for i, w, sizes in plan:
                        cost, slope = loss_and_slope(w, sizes, z, y[use])
                        new = np.concatenate([[cost], slope])
                        out[i] = out[i] + new if i in out else new
            return out

        got = batch.added_up(rows, work, live)
        for i in live:
            net = networks[i]
            reg = net.alpha * net.held()
            loss = (got[i][0] + 0.5 * (reg * at[i] ** 2).sum()) / n
            slope = (got[i][1:] + reg * at[i]) / n
            if net.slope is not None and not loss <= net.loss + 1e-4 * length[i] * (net.slope @ step[i]):
                length[i] /= 2
                if length[i] < 1e-8:
                    net.done = True
                at[i] = net.weights + length[i] * step[i]
                continue
            if net.slope is not None:
                s, v = at[i] - net.weights, slope - net.slope
                if s @ v > 1e-12 * (v @ v):
                    net.steps = [*net.steps, (s, v)][-MEMORY:]
            net.weights, net.loss, net.slope = at[i], loss, slope
            net.losses.append(loss)
            if len(net.losses) > PATIENCE and net.losses[-1 - PATIENCE] - loss < TOLERANCE or np.abs(slope).max() < 1e-8:
                net.done = True
                continue
            step[i] = net.direction()
            if step[i] @ slope >= 0:
                net.steps, step[i] = [], -slope
            length[i] = 1.0 if net.steps else min(1.0, 1.0 / max(np.abs(slope).sum(), 1e-12))
            at[i] = net.weights + length[i] * step[i]
    return networks


def sweep_alpha(values: Sequence[float], rows: DataFrame, numeric: int, hidden: Sequence[int] = (50, 25), seed: int = 42, max_iter: int = 1000) -> list[dict]:
    """E22 for perceptrons: train and test accuracy per strength of the L2 term. Rows as in
    ``tuning.sweep_logistic``: fold 0 is the test side. A side without rows has accuracy 0."""
    x = batch.written(batch.table(rows, "features", "label", "fold"))
    (view,), (n,), _ = batch.fold_views(x, [0], numeric)
    nets = [Network((len(view.shift), *hidden, 1), float(v)) for v in values]
    fit(x, nets, view, n, 0, seed, max_iter)
    held = [(net.weights, net.sizes) for net in nets]

    def work(batches):
        out = np.zeros((len(held), 4))
        for b in batches:
            for lo in range(0, b.num_rows, batch.ROWS):
                x, y, fold = batch.rows_of(b.slice(lo, batch.ROWS))
                z, test = view.of(x), fold == 0
                for j, (w, sizes) in enumerate(held):
                    right = (margins(w, sizes, z)[0] > 0) == (y > 0.5)
                    out[j] += [right[~test].sum(), (~test).sum(), right[test].sum(), test.sum()]
        return {0: out.ravel()}

    got = batch.added_up(x, work, [0]).get(0, np.zeros(4 * len(held))).reshape(-1, 4)
    return [{"value": float(v), "train_accuracy": float(a / c) if c else 0.0, "test_accuracy": float(b / d) if d else 0.0}
            for v, (a, c, b, d) in zip(values, got, strict=True)]
