"""Many clusterings fitted in the same scans (the core of G1, G4, G6, G7).

A sweep over numbers of clusters and starts is one set of models.  Every pass
over the table serves all models that have not settled: a task measures its
rows against the centres (or mixture components) of all of them - one matrix
product per number of centres - and hands on its sums, which meet in a shuffle
when there are many tasks.  Only those sums - the size of the models - reach the
driver, where the new centres or components are formed.  The number of
passes is that of the slowest model, not the sum over models.

Rows without a vector take no part.  Results do not depend on the layout of
the table but for the order of floating-point sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from weakref import WeakKeyDictionary

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that a task measures at a time.
CHUNK = 1024


@dataclass
class Centres:
    """One k-means fit: ``cost`` and ``sizes`` belong to the assignment to ``centres``."""

    centres: np.ndarray
    k: int
    seed: int = 0
    cost: float = float("inf")
    n_iter: int = 0
    sizes: np.ndarray | None = None
    settled: bool = False


@dataclass
class Mixture:
    """One full-covariance Gaussian mixture; ``trace`` holds the mean log-likelihood before every step."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    seed: int = 0
    trace: list[float] = field(default_factory=list)
    n_iter: int = 0
    settled: bool = False

    @property
    def k(self) -> int:
        return len(self.weights)

    def log_likelihood(self) -> float:
        return self.trace[-1]


# ------------------------------------------------------------------ scans
def vectors(df: DataFrame, features: str, *keep) -> DataFrame:
    """``(_x, *keep)`` of the rows that have a vector."""
    return df.where(F.col(features).isNotNull()).select(F.col(features).cast("array<double>").alias("_x"), *keep)


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    col = batch.column("_x")
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    for batch in batches:
        for a in range(0, batch.num_rows, CHUNK):
            part = batch.slice(a, CHUNK)
            yield matrix(part), part


#: Numbers of a sum that travel in one row; longer sums spread over several keys of the shuffle.
PIECE = 1024
SUMS = "model int, part int, piece int, v array<double>"


def _rows(found: dict[tuple[int, int, int], np.ndarray]) -> pa.RecordBatch:
    keys = list(found)
    ends = np.cumsum([0, *[len(v) for v in found.values()]])
    flat = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(list(found.values()))))
    return pa.RecordBatch.from_arrays([*[pa.array([k[i] for k in keys], pa.int32()) for i in range(3)], flat], names=["model", "part", "piece", "v"])


def _add(total: dict, key, v: np.ndarray) -> None:
    total[key] = total[key] + v if key in total else v


def _sum_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[tuple[int, int, int], np.ndarray] = {}
    for batch in batches:
        keys = zip(*(batch.column(i).to_pylist() for i in range(3)))
        ends = batch.column(3).offsets.to_numpy()
        flat = batch.column(3).values.to_numpy()
        for key, a, b in zip(keys, ends[:-1], ends[1:]):
            _add(total, key, flat[a:b])
    if total:
        yield _rows(total)


#: Up to this many tasks hand their sums to the driver as they are; the sums of more tasks meet in a shuffle first.
DIRECT_TASKS = 32
_TASKS: WeakKeyDictionary = WeakKeyDictionary()


def tasks_of(points: DataFrame) -> int:
    """Partitions of a frame, asked once per frame: a fit scans the same one over and over."""
    if points not in _TASKS:
        _TASKS[points] = points.rdd.getNumPartitions()
    return _TASKS[points]


def scan_sums(points: DataFrame, step: Callable[[np.ndarray, pa.RecordBatch], Iterator[tuple[tuple[int, int], np.ndarray]]],
              columns: Sequence[str] | None = None) -> dict:
    """Sum over all rows of what ``step(vectors, rows)`` yields by (model, part); ``rows`` has ``columns`` (None: all).

    A task sums its rows.  The sums of a few tasks are added on the driver,
    those of many meet by (model, part, piece) as whole arrays first, one row
    per task and piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for x, rows in chunks(batches):
            for key, v in step(x, rows):
                _add(total, key, v)
        cut = {(*k, i // PIECE): v.ravel()[i:i + PIECE] for k, v in total.items() for i in range(0, v.size, PIECE)}
        if cut:
            yield _rows(cut)

    each = (points.select(*columns) if columns else points).mapInArrow(run, SUMS)
    if tasks_of(points) > DIRECT_TASKS:
        each = each.repartition("model", "part", "piece").mapInArrow(_sum_pieces, SUMS)
    found = each.toArrow().combine_chunks().to_batches()
    sums: dict[tuple[int, int], list[np.ndarray]] = {}
    for batch in _sum_pieces(iter(found)):
        flat, ends = batch.column(3).values.to_numpy(), batch.column(3).offsets.to_numpy()
        keys = [*zip(*(batch.column(i).to_pylist() for i in range(3)))]
        for at in sorted(range(len(keys)), key=keys.__getitem__):
            sums.setdefault(keys[at][:2], []).append(flat[ends[at]:ends[at + 1]])
    return {k: np.concatenate(v) for k, v in sums.items()}


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Index of the nearest centre of every row, ties to the lower index.

    Distances come from one matrix product; rows whose two best are closer
    than its rounding error are measured directly.
    """
    if len(centres) == 1:
        return np.zeros(len(x), np.int64)
    x2, c2 = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", centres, centres)
    d = c2[None, :] - 2.0 * (x @ centres.T)
    best = d.argmin(1)
    slack = 8.0 * (x.shape[1] + 4) * np.finfo(float).eps * (x2 + c2.max())
    close = np.flatnonzero((d <= (d[np.arange(len(x)), best] + 2 * slack)[:, None]).sum(1) > 1)
    if len(close):
        exact = ((x[close][:, None, :] - centres[None]) ** 2).sum(2)
        best[close] = exact.argmin(1)
    return best


# ------------------------------------------------------------------ k-means
def uniform(h: np.ndarray, seed: int, draw: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on the row's hash, the seed and the draw only."""
    with np.errstate(over="ignore"):
        z = h.view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + (draw + 1) * 0xD1342543DE82EF95) & (2**64 - 1))
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(by)
        z ^= z >> np.uint64(31)
    return ((z >> np.uint64(11)).astype(float) + 0.5) / 2.0**53


def starts(points: DataFrame, k: int, seeds: Sequence[int], init: str = "k-means++") -> dict[int, np.ndarray]:
    """``k`` starting centres per seed; the first j of them are a start for j centres.

    ``points`` has ``_x`` and a row hash ``_h``.  A row is drawn with
    probability in proportion to its squared distance to the centres drawn
    so far (``random``: to one) by keeping the least -ln(u) / weight, so a
    draw is a minimum and all seeds are drawn in one scan.
    """
    chosen: dict[int, list] = {s: [] for s in seeds}
    for draw in range(k):
        now = {s: np.array(c) for s, c in chosen.items()}

        def race(batches: Iterator[pa.RecordBatch], now=now, draw=draw) -> Iterator[pa.RecordBatch]:
            best: dict[int, tuple] = {}
            for x, part in chunks(batches):
                h = part.column("_h").to_numpy()
                for s, c in now.items():
                    weight = np.ones(len(x))
                    if len(c):
                        near = ((x - c[nearest(x, c)]) ** 2).sum(1)
                        weight = near if init == "k-means++" else (near > 0).astype(float)
                    with np.errstate(divide="ignore"):
                        key = np.minimum(-np.log(uniform(h, s, draw)) / weight, np.finfo(float).max)
                    i = int(np.lexsort((h, key))[0])
                    if s not in best or (key[i], h[i]) < best[s][:2]:
                        best[s] = (float(key[i]), int(h[i]), x[i].tolist())
            if best:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(best), pa.int64()), *[pa.array([b[j] for b in best.values()], kind) for j, kind in
                                                         enumerate((pa.float64(), pa.int64(), pa.list_(pa.float64())))]],
                    names=["seed", "key", "h", "x"])

        won = points.mapInArrow(race, "seed long, key double, h long, x array<double>")
        for r in won.groupBy("seed").agg(F.min_by("x", F.struct("key", "h")).alias("x")).collect():
            chosen[r["seed"]].append(r["x"])
    return {s: np.array(c) for s, c in chosen.items()}


def lloyd_sums(models: dict[int, np.ndarray]) -> Callable:
    """Step of a Lloyd sweep: rows, cost, central squares and sums by (model, centre)."""
    def step(x: np.ndarray, _):
        for m, c in models.items():
            near = nearest(x, c)
            one = (near[:, None] == np.arange(len(c))[None, :]).astype(float)
            gap = x - c[near]
            cost = one.T @ np.einsum("ij,ij->i", gap, gap)
            shift = one.T @ gap
            for j in np.flatnonzero(one.any(0)):
                yield (m, int(j)), np.concatenate([[one[:, j].sum(), cost[j]], shift[j]])
    return step


def by_size(ks: dict[int, int]) -> dict[int, list[int]]:
    """The models of each number of centres or components: their matrices have one shape and are measured at once."""
    out: dict[int, list[int]] = {}
    for i, k in ks.items():
        out.setdefault(k, []).append(i)
    return out


def nearest_of_all(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """``nearest`` for ``m`` models of ``k`` centres (k x m x d) at once: (m x rows) indices."""
    k, m, d = centres.shape
    at = np.zeros((m, len(x)), np.int64)
    if k == 1:
        return at
    x2, c2 = np.einsum("ij,ij->i", x, x), np.einsum("kmd,kmd->km", centres, centres)
    far = (centres.reshape(k * m, d) @ x.T).reshape(k, m, len(x))
    far *= -2.0
    far += c2[:, :, None]
    best, second = far[0].copy(), np.full(at.shape, np.inf)
    for j in range(1, k):
        at[far[j] < best] = j
        np.minimum(second, np.maximum(best, far[j]), out=second)
        np.minimum(best, far[j], out=best)
    slack = 8.0 * (d + 4) * np.finfo(float).eps * (x2[None, :] + c2.max(0)[:, None])
    close = second <= best + 2 * slack
    for i in np.flatnonzero(close.any(1)):
        rows = np.flatnonzero(close[i])
        at[i, rows] = ((x[rows][:, None, :] - centres[None, :, i]) ** 2).sum(2).argmin(1)
    return at


def move_sums(models: dict[int, np.ndarray], groups: dict[int, list[int]], origin: np.ndarray) -> Callable:
    """Step of a Lloyd sweep without costs: rows and sums about ``origin`` of all centres, by number of centres."""
    stacks = {k: np.stack([models[i] for i in own], axis=1) for k, own in groups.items()}

    def step(x: np.ndarray, _):
        wide = np.hstack([np.ones((len(x), 1)), x - origin])
        for k, c in stacks.items():
            at = nearest_of_all(x, c)
            one = (at[None] == np.arange(k)[:, None, None]).astype(float)
            yield (k, 0), (one.reshape(-1, len(x)) @ wide).ravel()
    return step


def moved_centres(points: DataFrame, models: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """The new centres of ``lloyd_once`` alone, measured for all models of a size at once."""
    groups = by_size({i: len(c) for i, c in models.items()})
    origin = np.concatenate(list(models.values())).mean(0)
    sums = scan_sums(points, move_sums(models, groups, origin), ["_x"])
    out = {}
    for k, own in groups.items():
        v = sums[k, 0].reshape(k, len(own), -1) if (k, 0) in sums else np.zeros((k, len(own), len(origin) + 1))
        for place, i in enumerate(own):
            n = v[:, place, :1]
            out[i] = np.where(n > 0, origin + v[:, place, 1:] / np.maximum(n, 1), models[i])
    return out


def lloyd_once(points: DataFrame, models: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """One sweep of all models: (new centres, sizes, cost per centre).  A centre without rows stays."""
    sums = scan_sums(points, lloyd_sums(models), ["_x"])
    out = {}
    for m, c in models.items():
        new, n, cost = c.copy(), np.zeros(len(c)), np.zeros(len(c))
        for j in range(len(c)):
            if (m, j) in sums:
                v = sums[m, j]
                n[j], cost[j], new[j] = v[0], v[1], c[j] + v[2:] / v[0]       # sums of gaps to the old centre: no cancelling
        out[m] = (new, n, cost)
    return out


def lloyd(points: DataFrame, models: Sequence[Centres], max_iter: int = 100, tol: float = 1e-4) -> None:
    """Run all models to the end, in place.

    A model settles when its centres move (summed squares) by at most ``tol``
    times the mean variance of the columns.  Its cost and sizes are of the
    last centres, from one more scan over all models.
    """
    live = {i: m for i, m in enumerate(models) if not m.settled}
    whole = lloyd_once(points, {0: models[0].centres.mean(0)[None]})[0]
    if whole[1][0] == 0:
        return
    spread = whole[2][0] / whole[1][0] - ((whole[0] - models[0].centres.mean(0)) ** 2).sum()
    limit = tol * max(spread, 0.0) / models[0].centres.shape[1]
    while live:
        for i, new in moved_centres(points, {i: m.centres for i, m in live.items()}).items():
            m = models[i]
            moved = ((new - m.centres) ** 2).sum()
            m.centres, m.n_iter = new, m.n_iter + 1
            m.settled = moved <= limit or m.n_iter >= max_iter
        live = {i: m for i, m in live.items() if not m.settled}
    for i, (_, n, cost) in lloyd_once(points, {i: m.centres for i, m in enumerate(models)}).items():
        models[i].sizes, models[i].cost = n, float(cost.sum())


# ------------------------------------------------------------------ Gaussian mixtures
def _factors(m: Mixture) -> tuple[np.ndarray, np.ndarray]:
    """Per component the inverse Cholesky factor and the log weight with its constant."""
    low = np.linalg.cholesky(m.covariances)
    inv = np.stack([np.linalg.solve(c, np.eye(c.shape[0])) for c in low])
    d = m.means.shape[1]
    log_det = np.log(np.diagonal(low, axis1=1, axis2=2)).sum(1)
    with np.errstate(divide="ignore"):
        return inv, np.log(m.weights) - 0.5 * d * np.log(2 * np.pi) - log_det


def _log_joint(x: np.ndarray, means: np.ndarray, inv: np.ndarray, const: np.ndarray) -> np.ndarray:
    out = np.empty((len(x), len(const)))
    for j in range(len(const)):
        y = (x - means[j]) @ inv[j].T
        out[:, j] = const[j] - 0.5 * np.einsum("ij,ij->i", y, y)
    return out


def _moments(model: int, j: int, r: np.ndarray, gap: np.ndarray):
    return (model, j), np.concatenate([[r.sum()], r @ gap, ((gap * r[:, None]).T @ gap).ravel()])


def em_sums(models: dict[int, Mixture]) -> Callable:
    """Step of an EM sweep: soft counts and moments about the old means; part -1 holds (log-likelihood, rows)."""
    ready = {i: (m.means, *_factors(m)) for i, m in models.items()}

    def step(x: np.ndarray, _):
        for i, (means, inv, const) in ready.items():
            joint = _log_joint(x, means, inv, const)
            top = joint.max(1)
            norm = top + np.log(np.exp(joint - top[:, None]).sum(1))          # log-sum-exp
            yield (i, -1), np.array([norm.sum(), len(x)])
            resp = np.exp(joint - norm[:, None])
            for j in range(len(const)):
                yield _moments(i, j, resp[:, j], x - means[j])
    return step


#: Models whose densities lose more than this when squares are multiplied out are measured directly.
EXPAND_LOSS = 1e-9


def squares(x: np.ndarray) -> np.ndarray:
    """(rows x 1 + d + d (d + 1) / 2): one, the components and their products."""
    i, j = np.triu_indices(x.shape[1])
    return np.hstack([np.ones((len(x), 1)), x, x[:, i] * x[:, j]])


def em_group_sums(models: dict[int, Mixture]) -> tuple[Callable, Callable]:
    """Step of an EM sweep for all models at once, and the reader of its sums.

    The log densities of a row are linear in its components and their
    products, so those of all components of all models of a size are one
    matrix product, and so are the soft moments.  Both are about one origin;
    a model so narrow that rounding would show there (rows far out, a tiny
    covariance) takes the direct way of ``em_sums`` for that chunk.
    """
    groups = by_size({i: m.k for i, m in models.items()})
    origin = np.concatenate([m.means for m in models.values()]).mean(0)
    d = len(origin)
    iu, ju = np.triu_indices(d)
    stacks, sharp = {}, {}
    for k, own in groups.items():
        rows = []
        for i in own:
            m = models[i]
            inv, const = _factors(m)
            prec = np.einsum("kab,kac->kbc", inv, inv)
            mean = m.means - origin
            pull = np.einsum("kab,kb->ka", prec, mean)
            sharp[i] = (float(np.abs(prec).sum(2).max()), float((mean ** 2).sum(1).max()))
            half = np.where(iu == ju, -0.5, -1.0)
            rows.append(np.hstack([(const - 0.5 * np.einsum("ka,ka->k", pull, mean))[:, None], pull, prec[:, iu, ju] * half]))
        stacks[k] = np.stack(rows, axis=1)
    direct = {i: em_sums({i: m}) for i, m in models.items()}

    def step(x: np.ndarray, rows):
        if not len(x):
            return
        gap = x - origin
        reach = float((gap ** 2).sum(1).max())
        phi = squares(gap)
        for k, own in groups.items():
            good = [place for place, i in enumerate(own) if np.finfo(float).eps * sharp[i][0] * (reach + sharp[i][1]) <= EXPAND_LOSS]
            for place in sorted({*range(len(own))} - {*good}):
                yield from direct[own[place]](x, rows)
            if not good:
                continue
            theta = stacks[k][:, good]
            joint = (theta.reshape(k * len(good), -1) @ phi.T).reshape(k, len(good), len(x))
            top = joint.max(0)
            joint -= top
            np.exp(joint, out=joint)
            total = joint.sum(0)
            joint /= total
            level = (top + np.log(total)).sum(1)
            moments = (joint.reshape(k * len(good), -1) @ phi).reshape(k, len(good), -1)
            if len(good) < len(own):
                whole, some = np.zeros((k, len(own), phi.shape[1])), np.zeros((len(own), 2))
                whole[:, good], some[good] = moments, np.stack([level, np.full(len(good), float(len(x)))], axis=1)
            else:
                whole, some = moments, np.stack([level, np.full(len(good), float(len(x)))], axis=1)
            yield (-k, 0), np.concatenate([some.ravel(), whole.ravel()])

    def read(sums: dict) -> dict:
        """The sums as ``em_sums`` gives them: (log-likelihood, rows) and moments about the old means."""
        out = {key: v for key, v in sums.items() if key[0] >= 0}
        for k, own in groups.items():
            if (-k, 0) not in sums:
                continue
            flat = sums[-k, 0]
            levels, whole = flat[:2 * len(own)].reshape(-1, 2), flat[2 * len(own):].reshape(k, len(own), -1)
            for place, i in enumerate(own):
                _add(out, (i, -1), levels[place])
                for j in range(k):
                    v, at = whole[j, place], models[i].means[j] - origin
                    n, first = v[0], v[1:d + 1]
                    second = np.zeros((d, d))
                    second[iu, ju] = second[ju, iu] = v[d + 1:]
                    second += n * np.outer(at, at) - np.outer(first, at) - np.outer(at, first)
                    _add(out, (i, j), np.concatenate([[n], first - n * at, second.ravel()]))
        return out
    return step, read


def hard_sums(models: dict[int, np.ndarray]) -> Callable:
    """The same moments for rows that belong to their nearest centre alone."""
    def step(x: np.ndarray, _):
        for i, c in models.items():
            near = nearest(x, c)
            for j in range(len(c)):
                mine = x[near == j] - c[j]
                yield _moments(i, j, np.ones(len(mine)), mine)
    return step


def _maximise(old: np.ndarray, sums: dict, i: int, reg: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    k, d = old.shape
    v = np.stack([sums[i, j] for j in range(k)])
    n = v[:, 0] + 10 * np.finfo(float).eps
    shift = v[:, 1:d + 1] / n[:, None]
    second = v[:, d + 1:].reshape(k, d, d) / n[:, None, None]
    cov = second - shift[:, :, None] * shift[:, None, :]
    return n / n.sum(), old + shift, cov + reg * np.eye(d)


def em_once(points: DataFrame, models: dict[int, Mixture], reg: float = 1e-6) -> dict[int, tuple]:
    """One EM step of all models: (weights, means, covariances, mean log-likelihood before the step)."""
    step, read = em_group_sums(models)
    sums = read(scan_sums(points, step, ["_x"]))
    out = {}
    for i, m in models.items():
        total, n = sums[i, -1]
        out[i] = (*_maximise(m.means, sums, i, reg), float(total / n))
    return out


def mixtures_from(points: DataFrame, fits: Sequence[Centres], reg: float = 1e-6) -> list[Mixture]:
    """Mixtures that start from the clusters of k-means fits, one scan for all."""
    sums = scan_sums(points, hard_sums({i: f.centres for i, f in enumerate(fits)}), ["_x"])
    return [Mixture(*_maximise(f.centres, sums, i, reg), seed=f.seed) for i, f in enumerate(fits)]


def em(points: DataFrame, models: Sequence[Mixture], max_iter: int = 100, tol: float = 1e-3, reg: float = 1e-6) -> None:
    """Run all mixtures to the end, in place; one settles when its mean log-likelihood changes by less than ``tol``."""
    live = {i: m for i, m in enumerate(models) if not m.settled}
    while live:
        for i, (w, mu, cov, level) in em_once(points, live, reg).items():
            m = models[i]
            m.trace.append(level)
            m.settled = len(m.trace) > 1 and abs(level - m.trace[-2]) < tol
            if not m.settled:
                m.weights, m.means, m.covariances, m.n_iter = w, mu, cov, m.n_iter + 1
                m.settled = m.n_iter >= max_iter
        live = {i: m for i, m in live.items() if not m.settled}
    late = {i: m for i, m in enumerate(models) if m.n_iter == len(m.trace)}       # stopped by max_iter: level after the last step
    if late:
        for i, (*_, level) in em_once(points, late, reg).items():
            models[i].trace.append(level)


# ------------------------------------------------------------------ labels and scores of many models
def labeller(model: Centres | Mixture) -> Callable[[np.ndarray], np.ndarray]:
    if isinstance(model, Centres):
        return lambda x: nearest(x, model.centres)
    inv, const = _factors(model)
    return lambda x: _log_joint(x, model.means, inv, const).argmax(1)


def assign(df: DataFrame, model: Centres | Mixture, features: str = "features", out: str = "cluster") -> DataFrame:
    """``df`` with the model's cluster of every row (null without a vector)."""
    @F.pandas_udf("int")
    def place(col: pd.Series) -> pd.Series:
        got = pd.Series([None] * len(col), dtype="Int32")
        have = col.notna().to_numpy()
        if have.any():
            got[have] = labeller(model)(np.vstack(col[have].to_numpy()).astype(float))
        return got

    return df.withColumn(out, place(F.col(features).cast("array<double>")))


def counts_and_moments(points: DataFrame, label: str, models: Sequence[Centres | Mixture]) -> tuple[DataFrame, dict]:
    """From one scan each: the contingency table ``(model, truth, pred, n)`` and, per (model, cluster), rows, cost and sums."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = [labeller(m) for m in models]
        for x, part in chunks(batches):
            coded = part.column(label).dictionary_encode(null_encoding="encode")
            codes, names = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
            for i, f in enumerate(find):
                pair, n = np.unique(codes * models[i].k + f(x), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), i), pa.int32()), names.take(pa.array(pair // models[i].k)),
                                                  pa.array(pair % models[i].k, pa.int32()), pa.array(n, pa.int64())],
                                                 names=["model", "truth", "pred", "n"])

    kind = points.schema[label].dataType.simpleString()
    table = (points.select("_x", label).mapInArrow(count, f"model int, truth {kind}, pred int, n long")
                   .groupBy("model", "truth", "pred").agg(F.sum("n").cast("bigint").alias("n")))

    find = [labeller(m) for m in models]

    def step(x: np.ndarray, _):
        for i, m in enumerate(models):
            c = m.centres if isinstance(m, Centres) else m.means
            at = find[i](x)
            one = (at[:, None] == np.arange(m.k)[None, :]).astype(float)
            gap = x - c[at]
            cost, shift = one.T @ np.einsum("ij,ij->i", gap, gap), one.T @ gap
            for j in np.flatnonzero(one.any(0)):
                yield (i, int(j)), np.concatenate([[one[:, j].sum(), cost[j]], shift[j]])
    return table, scan_sums(points, step, ["_x"])


def calinski_harabasz_from(model: Centres | Mixture, sums: dict, i: int) -> float | None:
    """CH of model ``i`` from its clusters' rows, costs and sums; null below two clusters, 1.0 without inner scatter."""
    c = model.centres if isinstance(model, Centres) else model.means
    own = [(c[j], sums[i, j]) for j in range(model.k) if (i, j) in sums]
    n = np.array([v[0] for _, v in own])
    if len(own) < 2:
        return None
    mean = np.stack([cj + v[2:] / v[0] for cj, v in own])
    within = sum(v[1] - (v[2:] ** 2).sum() / v[0] for _, v in own)
    centre = (n[:, None] * mean).sum(0) / n.sum()
    between = (n * ((mean - centre) ** 2).sum(1)).sum()
    return 1.0 if within <= 0 else float(between * (n.sum() - len(own)) / (within * (len(own) - 1)))


def silhouettes(sample: DataFrame, models: Sequence[Centres | Mixture]) -> dict[int, float | None]:
    """Mean Euclidean silhouette of every model over a bounded sample (``_x``); null with fewer than two clusters in it.

    The sample goes to the tasks once; a task measures its slice of it
    against the whole sample and sums distances by cluster for all models.
    """
    X = np.array([r["_x"] for r in sample.select("_x").collect()])               # the sample's size is a parameter
    if len(X) == 0:
        return {i: None for i in range(len(models))}
    spark = sample.sparkSession
    shared = spark.sparkContext.broadcast((X, [labeller(m)(X) for m in models], [m.k for m in models]))
    ids = spark.range(len(X)).repartition(max(1, min(64, len(X) // 200 + 1)), "id")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, labels, ks = shared.value
        sq = np.einsum("ij,ij->i", x, x)
        for batch in batches:
            idx = batch.column("id").to_numpy()
            for a in range(0, len(idx), 256):
                at = idx[a:a + 256]
                d = np.sqrt(np.maximum(sq[at][:, None] + sq[None, :] - 2.0 * (x[at] @ x.T), 0.0))
                d[np.arange(len(at)), at] = 0.0
                found = []
                for lab, k in zip(labels, ks):
                    size = np.bincount(lab, minlength=k)
                    near = (d @ (lab[:, None] == np.arange(k)[None, :])) / np.maximum(size, 1)
                    own = size[lab[at]]
                    inner = near[np.arange(len(at)), lab[at]] * own / np.maximum(own - 1, 1)
                    near[:, size == 0] = np.inf
                    near[np.arange(len(at)), lab[at]] = np.inf
                    outer = near.min(1)
                    with np.errstate(invalid="ignore"):
                        s = np.where((own > 1) & np.isfinite(outer), (outer - inner) / np.maximum(np.maximum(outer, inner), 1e-300), 0.0)
                    found.append(s.sum())
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(ks)), pa.int32()), pa.array(found, pa.float64())], names=["model", "s"])

    got = {r["model"]: r["s"] for r in ids.mapInArrow(score, "model int, s double").groupBy("model").agg(F.sum("s").alias("s")).collect()}
    some = shared.value[1]
    shared.unpersist()
    return {i: float(got[i] / len(X)) if len(np.unique(some[i])) > 1 else None for i in range(len(models))}


def dealt(df: DataFrame) -> DataFrame:
    """``df`` in as many partitions as there are cores, when it has fewer: a table that comes as one file would be one task."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def held(points: DataFrame) -> DataFrame:
    """Points kept for the scans of a fit, dealt over the cores; the caller releases them."""
    return dealt(points).persist(StorageLevel.MEMORY_AND_DISK)
