"""Dimension reduction.

Everything that touches rows is a Spark plan; only d x d / k x d matrices
(bounded by the number of features, never by the number of rows) are
solved on the driver with numpy - the same split ``pyspark.ml`` makes.

* D3 truncated SVD (uncentred): triangular factor by a tree of QRs, project X V.
* D4 PCA (centred, optionally whitened): covariance (D2) -> eigen-decomposition.
* D5 FastICA: whiten (D4), then symmetric fixed-point iterations; each
  iteration is one distributed aggregate of E[z g(w'z)] and E[g'(w'z)].
* D6 Gaussian random projection: seeded matrix inlined as literals.
* D7 2-D projection for plots, D8 cluster id prepended as a feature.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.functions.vectors import dot, vector_literal
from orchard.operators import many
from orchard.operators.scale import co_moments, first_vector
from orchard.session import cut_lineage


def _fix_signs(V: np.ndarray) -> np.ndarray:
    """Make the largest-magnitude entry of every column positive."""
    idx = np.argmax(np.abs(V), axis=0)
    signs = np.sign(V[idx, np.arange(V.shape[1])])
    signs[signs == 0] = 1.0
    return V * signs


def project(df: DataFrame, W: np.ndarray, features: str = "features", out: str = "reduced",
            mean: Sequence[float] | None = None, scale: Sequence[float] | None = None) -> DataFrame:
    """Rows times a (d x k) matrix as k dot products with literal columns of
    W (k x d values inlined; a projection, no join)."""
    x = F.col(features).cast("array<double>")
    if mean is not None:
        m = vector_literal(mean)
        x = F.zip_with(x, m, lambda a, b: a - b)
    comps = [dot(x, vector_literal(W[:, j])) for j in range(W.shape[1])]
    if scale is not None:
        comps = [c / F.lit(float(s)) for c, s in zip(comps, scale)]
    return df.withColumn(out, F.array(*comps))


# ----------------------------------------------------------------------- D6
def random_projection_matrix(d: int, k: int, seed: int) -> np.ndarray:
    """Gaussian matrix (k x d), entries N(0, 1/k), from a seeded generator."""
    return np.random.RandomState(seed).normal(0.0, 1.0 / np.sqrt(k), size=(k, d))


def gaussian_random_projection(df: DataFrame, k: int, seed: int, d: int | None = None,
                               features: str = "features", out: str = "reduced") -> DataFrame:
    """X R^T with the seeded Gaussian R."""
    if d is None:
        d = len(df.select(features).first()[0])
    R = random_projection_matrix(d, k, seed)
    return project(df, R.T, features, out)


# ----------------------------------------------------------------------- D3
def triangular_factor(df: DataFrame, features: str = "features") -> np.ndarray:
    """R (d x d) of a QR factorisation of all rows, by a tree of QRs.

    Every task factorises its rows chunk by chunk and hands on d rows; about
    sqrt(tasks) tasks join those, and one joins theirs, so no task holds more
    than sqrt(tasks) factors.  Unlike a Gram matrix it does not square the
    condition of the table.  Rows without a vector take no part.
    """
    def factor(batches):
        r = None
        for x, _ in many.chunks(batches):
            r = np.linalg.qr(x if r is None else np.vstack([r, x]), mode="r")
        if r is not None:
            place = int(np.abs(r).sum() * 1e6) & 0x7FFFFFFF                 # any spread over the next tasks
            yield pa.RecordBatch.from_arrays([pa.array(r.tolist(), pa.list_(pa.float64())), pa.array(np.full(len(r), place), pa.int64())],
                                             names=["_x", "_at"])

    schema = "_x array<double>, _at long"
    points = many.vectors(df, features)
    level = cut_lineage(points.mapInArrow(factor, schema))
    tasks = level.select("_at").distinct().count()
    if tasks > 16:
        level = level.repartition(math.ceil(math.sqrt(tasks)), "_at").mapInArrow(factor, schema)
    rows = level.select("_x").repartition(1).mapInArrow(lambda it: (b.select(["_x"]) for b in factor(it)), "_x array<double>").collect()
    r = np.array([x["_x"] for x in rows], float)                            # at most d rows
    if r.size == 0:
        return np.zeros((0, 0))
    return np.vstack([r, np.zeros((r.shape[1] - len(r), r.shape[1]))])


def truncated_svd(df: DataFrame, k: int, features: str = "features", out: str = "reduced"):
    """D3: uncentred truncated SVD: singular values and right singular
    vectors are those of the table's triangular factor (one scan, d x d
    numbers); rows are projected on V (= U Sigma).  Signs fixed (largest
    |entry| positive).  Returns (projected DataFrame, singular values, V)."""
    _, s, vt = np.linalg.svd(triangular_factor(df, features))
    V = _fix_signs(vt[:k].T)
    return project(df, V, features, out), s[:k], V


# ----------------------------------------------------------------------- D4
def pca_fit(df: DataFrame, k: int, features: str = "features"):
    """Mean, top-k eigenvectors (d x k) and eigenvalues of the sample
    covariance (the covariance is a d x d aggregate, D2)."""
    shift = np.array(first_vector(df, features))
    d = len(shift)
    C, mean = np.zeros((d, d)), np.zeros(d)
    for r in co_moments(df, features, shift.tolist()).collect():        # d (d + 1) / 2 rows
        i, j, n = r["i"], r["j"], r["n"]
        C[i, j] = C[j, i] = (r["sxy"] - r["sx"] * r["sy"] / n) / (n - 1)
        if i == j:
            mean[i] = shift[i] + r["sx"] / n
    vals, vecs = np.linalg.eigh(C)
    order = np.argsort(vals)[::-1][:k]
    return mean, _fix_signs(vecs[:, order]), vals[order]


def pca(df: DataFrame, k: int, whiten: bool = True, features: str = "features", out: str = "reduced"):
    """Centred PCA; with ``whiten`` every component is divided by its
    standard deviation (sqrt of the eigenvalue), so the result has unit
    variance and no correlation."""
    mean, W, vals = pca_fit(df, k, features)
    scale = np.sqrt(np.maximum(vals, 1e-300)) if whiten else None
    return project(df, W, features, out, mean=mean, scale=scale), W, vals


# ----------------------------------------------------------------------- D5
def fast_ica(df: DataFrame, k: int, features: str = "features", out: str = "reduced", max_iter: int = 200,
             tol: float = 1e-4, seed: int = 1):
    """FastICA (logcosh contrast, symmetric decorrelation) on whitened
    data, dealt over the cores and kept.  Each iteration is one scan: per task,
    numpy sums of z g(W z) (k x k) and g'(W z) (k); the k x k update runs on
    the driver."""
    z, _, _ = pca(df, k, whiten=True, features=features, out="_z")
    z = cut_lineage(many.dealt(z))
    rng = np.random.RandomState(seed)
    W = _sym_decorrelate(rng.normal(size=(k, k)))
    points = many.held(many.vectors(z, "_z"))
    it = 0
    try:
        for it in range(1, max_iter + 1):
            def step(x, _, W=W):
                G = np.tanh(x @ W.T)
                yield (0, 0), np.concatenate([[len(x)], (G.T @ x).ravel(), (1 - G * G).sum(axis=0)])

            sums = many.scan_sums(points, step).get((0, 0), np.concatenate([[1.0], np.zeros(k * k + k)]))
            n, acc, slope = sums[0], sums[1:1 + k * k].reshape(k, k), sums[1 + k * k:]
            W1 = acc / n - (slope / n)[:, None] * W
            W1 = _sym_decorrelate(W1)
            lim = np.max(np.abs(np.abs(np.einsum("ij,ij->i", W1, W)) - 1))
            W = W1
            if lim < tol:
                break
    finally:
        points.unpersist()
    res = z.withColumn(out, F.array(*[dot(F.col("_z"), vector_literal(W[i])) for i in range(k)]))
    return res.drop("_z"), W, it


def _sym_decorrelate(W: np.ndarray) -> np.ndarray:
    s, u = np.linalg.eigh(W @ W.T)
    s = np.clip(s, 1e-300, None)
    return (u * (1.0 / np.sqrt(s))) @ u.T @ W


# ----------------------------------------------------------------------- D7 / D8
def project_2d(df: DataFrame, method: str = "grp", seed: int = 12, features: str = "features",
               out: str = "xy") -> DataFrame:
    """2-D coordinates for plots: Gaussian random projection (seed 12)
    or whitened PCA."""
    if method == "grp":
        return gaussian_random_projection(df, 2, seed, features=features, out=out)
    if method == "pca":
        return pca(df, 2, True, features, out)[0]
    raise ValueError(method)


def augment_with_cluster(df: DataFrame, cluster: str = "cluster", features: str = "features",
                         out: str | None = None) -> DataFrame:
    """The cluster id becomes the first feature."""
    return df.withColumn(out or features, F.concat(F.array(F.col(cluster).cast("double")),
                                                   F.col(features).cast("array<double>")))
