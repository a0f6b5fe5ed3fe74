"""Feed-forward classifiers by distributed back-propagation.

A step is one scan: every task runs the batch's rows through the nets and
back, and hands on the sums of its gradients; the driver holds the weights
and the solver's state (adam moments, velocity, rate) and takes the step.
All nets of a comparison - solvers, schedules - share the scans.  A
mini-batch is the share of rows whose hash falls to it in that epoch, so it
does not depend on the layout and nothing is shuffled to draw it.

Nets have ReLU layers and a softmax, cross-entropy with an L2 penalty, and
the customary defaults (adam 0.001, 0.9, 0.999; sgd with Nesterov momentum
0.9; stop after ten epochs without an improvement of ``tol``).  Rates:
``constant``, ``invscaling`` (rate / t^0.5) and ``adaptive`` (a fifth after
ten epochs without improvement).  Rows without a vector or label take no part.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.operators import many

SOLVERS, SCHEDULES = ("adam", "sgd"), ("constant", "invscaling", "adaptive")
RATE, ALPHA, TOL, PATIENCE, MOMENTUM, POWER = 0.001, 1e-4, 1e-4, 10, 0.9, 0.5
BETA1, BETA2, EPS = 0.9, 0.999, 1e-8


def layer_shapes(sizes: Sequence[int]) -> list[tuple[int, int]]:
    return list(zip(sizes[:-1], sizes[1:]))


def glorot(sizes: Sequence[int], seed: int) -> np.ndarray:
    """All weights and biases as one vector: per layer the (in x out) weights, then the biases."""
    rng = np.random.RandomState(seed)
    parts = []
    for a, b in layer_shapes(sizes):
        bound = np.sqrt(6.0 / (a + b))
        parts += [rng.uniform(-bound, bound, a * b), rng.uniform(-bound, bound, b)]
    return np.concatenate(parts)


def unpack(flat: np.ndarray, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for a, b in layer_shapes(sizes):
        out.append((flat[at:at + a * b].reshape(a, b), flat[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


def is_weight(sizes: Sequence[int]) -> np.ndarray:
    """Marks the penalised places (weights, not biases)."""
    return np.concatenate([np.r_[np.ones(a * b, bool), np.zeros(b, bool)] for a, b in layer_shapes(sizes)])


def forward(flat: np.ndarray, sizes: Sequence[int], x: np.ndarray) -> list[np.ndarray]:
    """Values of every layer; the last one holds class probabilities."""
    layers = unpack(flat, sizes)
    values = [x]
    for i, (w, b) in enumerate(layers):
        z = values[-1] @ w + b
        if i < len(layers) - 1:
            values.append(np.maximum(z, 0.0))
        else:
            e = np.exp(z - z.max(1, keepdims=True))
            values.append(e / e.sum(1, keepdims=True))
    return values


def gradient(flat: np.ndarray, sizes: Sequence[int], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(loss, rows, gradient...) summed over the rows."""
    values = forward(flat, sizes, x)
    p = values[-1]
    loss = -np.log(np.maximum(p[np.arange(len(y)), y], np.finfo(float).tiny)).sum()
    back = p.copy()
    back[np.arange(len(y)), y] -= 1.0
    parts = []
    for (w, _), below in zip(reversed(unpack(flat, sizes)), reversed(values[:-1])):
        parts = [(below.T @ back).ravel(), back.sum(0), *parts]
        back = (back @ w.T) * (below > 0)
    return np.concatenate([[loss, len(y)], *parts])


@dataclass
class Net:
    """A net in training; ``stages`` holds the weights after the asked numbers of epochs."""

    sizes: tuple[int, ...]
    solver: str = "adam"
    schedule: str = "constant"
    rate: float = RATE
    seed: int = 1
    weights: np.ndarray = None
    trace: list[float] = field(default_factory=list)
    stages: dict[int, np.ndarray] = field(default_factory=dict)
    steps: int = 0
    idle: int = 0
    settled: bool = False

    def __post_init__(self):
        if self.solver not in SOLVERS or self.schedule not in SCHEDULES:
            raise ValueError(f"unknown solver {self.solver!r} or schedule {self.schedule!r}")
        if self.weights is None:
            self.weights = glorot(self.sizes, self.seed)
        self.now, self.least = self.rate, np.inf
        self.first, self.second = np.zeros_like(self.weights), np.zeros_like(self.weights)

    def step(self, sums: np.ndarray, alpha: float = ALPHA) -> float:
        """One update from summed gradients; returns the loss of the batch (its sum, with the penalty)."""
        n = sums[1]
        penalised = np.where(is_weight(self.sizes), self.weights, 0.0)
        g = (sums[2:] + alpha * penalised) / n
        self.steps += 1
        if self.solver == "adam":
            self.first = BETA1 * self.first + (1 - BETA1) * g
            self.second = BETA2 * self.second + (1 - BETA2) * g * g
            size = self.now * np.sqrt(1 - BETA2 ** self.steps) / (1 - BETA1 ** self.steps)
            self.weights = self.weights - size * self.first / (np.sqrt(self.second) + EPS)
        else:
            self.first = MOMENTUM * self.first - self.now * g
            self.weights = self.weights + MOMENTUM * self.first - self.now * g
        return float(sums[0] + 0.5 * alpha * (penalised ** 2).sum())

    def end_epoch(self, loss: float, epoch: int, rows: int) -> None:
        """Book-keeping after an epoch of mean loss ``loss``; ``rows`` seen so far set the ``invscaling`` time."""
        self.trace.append(loss)
        self.idle = self.idle + 1 if loss > self.least - TOL else 0
        self.least = min(self.least, loss)
        if self.solver == "sgd" and self.schedule == "invscaling":
            self.now = self.rate / (rows + 1) ** POWER
        if self.idle > PATIENCE:
            if self.solver == "sgd" and self.schedule == "adaptive" and self.now > 1e-6:
                self.now, self.idle = self.now / 5.0, 0
            else:
                self.settled = True


def points(df: DataFrame, features: str, label: str) -> DataFrame:
    """``(_x, _y, _h)``: vector, class number and row hash."""
    return many.vectors(df.where(F.col(label).isNotNull()), features, F.col(label).cast("int").alias("_y"),
                        F.xxhash64(F.col(features).cast("array<double>"), F.col(label)).alias("_h"))


def gradients(pts: DataFrame, nets: dict[int, tuple[np.ndarray, Sequence[int]]], epoch: int = 0, batch: int = 0, batches: int = 1,
              seed: int = 0) -> dict[int, np.ndarray]:
    """(loss, rows, gradient...) of every net over one hash batch, from one scan; a net is missing when the batch is empty."""
    def step(x, rows):
        y = rows.column("_y").to_numpy(zero_copy_only=False)
        if batches > 1:
            mine = (many.uniform(rows.column("_h").to_numpy(), seed, epoch) * batches).astype(int) == batch
            x, y = x[mine], y[mine]
        if len(y):
            for i, (flat, sizes) in nets.items():
                yield (i, 0), gradient(flat, sizes, x, y)
    return {i: v for (i, _), v in many.scan_sums(pts, step).items()}


def train(pts: DataFrame, nets: Sequence[Net], max_iter: int = 200, batches: int = 1, stages: Sequence[int] = (), alpha: float = ALPHA,
          seed: int = 0) -> None:
    """Train all nets to the end, in place: ``max_iter`` epochs of ``batches`` hash batches.

    Every net keeps its weights after each number of epochs in ``stages``
    (those at its end when it settles before), so one run serves a sweep
    over the number of iterations.
    """
    rows = 0
    for epoch in range(1, max_iter + 1):
        live = {i: n for i, n in enumerate(nets) if not n.settled}
        if not live:
            break
        loss, seen = dict.fromkeys(live, 0.0), 0
        for b in range(batches):
            got = gradients(pts, {i: (n.weights, n.sizes) for i, n in live.items()}, epoch, b, batches, seed)
            for i, sums in got.items():
                loss[i] += live[i].step(sums, alpha)
            seen += max((int(s[1]) for s in got.values()), default=0)
        rows += seen
        if not seen:
            break
        for i, n in live.items():
            n.end_epoch(loss[i] / seen, epoch, rows)
            if epoch in stages:
                n.stages[epoch] = n.weights.copy()
    for n in nets:
        for s in stages:
            if s <= max_iter:
                n.stages.setdefault(s, n.weights.copy())


def predictor(flat: np.ndarray, sizes: Sequence[int]) -> Callable:
    """Column function: the most likely class of a vector (null without one), as a double."""
    @F.pandas_udf("double")
    def classify(col: pd.Series) -> pd.Series:
        got = pd.Series(np.nan, index=col.index, dtype="Float64")
        have = col.notna().to_numpy()
        got[:] = pd.NA
        if have.any():
            got[have] = forward(flat, sizes, np.vstack(col[have].to_numpy()).astype(float))[-1].argmax(1).astype(float)
        return got
    return classify


def shape_of(df: DataFrame, features: str, label: str) -> tuple[int, int]:
    """(vector length, number of classes)."""
    d, top = df.where(F.col(features).isNotNull()).agg(F.max(F.size(features)), F.max(label)).first()
    return int(d or 0), max(int(top or 0) + 1, 2)


def mlp_solvers(train_df: DataFrame, test_df: DataFrame, variants: Sequence[tuple[str, str]] = (("adam", "constant"),), hidden: Sequence[int] = (100,),
                max_iter: int = 200, batches: int = 1, stages: Sequence[int] | None = None, features: str = "features",
                label: str = "label", seed: int = 1, rate: float = RATE) -> tuple[DataFrame, list[Net], float]:
    """Nets of all ``variants`` (solver, schedule) trained in shared scans and scored together.

    Returns the test rows ``(label, prediction, solver, schedule, iterations)``
    - one per row, variant and stage -, the nets and the fit seconds of all.
    """
    d, k = shape_of(train_df, features, label)
    stages = tuple(s for s in (stages or (max_iter,)) if s <= max_iter)
    nets = [Net((d, *hidden, k), s, r, rate, seed) for s, r in variants]
    pts = many.held(points(train_df, features, label))
    t0 = time.time()
    try:
        train(pts, nets, max_iter, batches, stages)
    finally:
        pts.unpersist()
    seconds = time.time() - t0
    fits = [F.struct(predictor(n.stages[s], n.sizes)(F.col(features).cast("array<double>")).alias("prediction"), F.lit(n.solver).alias("solver"),
                     F.lit(n.schedule).alias("schedule"), F.lit(s).alias("iterations")) for n in nets for s in stages]
    return test_df.select(label, F.explode(F.array(*fits)).alias("f")).select(label, "f.*"), nets, seconds
