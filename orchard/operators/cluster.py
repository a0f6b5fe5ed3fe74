"""Clustering (G1-G7): Lloyd steps and inertia as plain DataFrame plans,
k-means and Gaussian mixtures whose starts and sizes share their scans
(``many``), and sweeps that score every fit with the contingency-based
metrics of ``evaluate``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.operators import many
from orchard.operators.evaluate import scores_from_counts
from orchard.operators.many import Centres, Mixture
from orchard.operators.neighbours import nearest_centre
from orchard.session import cut_lineage


def lloyd_step(points: DataFrame, centres: Sequence[Sequence[float]], features: str = "features") -> DataFrame:
    """Assign every point to its nearest centre (J1), then the new
    centre of each cluster = mean per dimension.  ``(cluster, dim, centre,
    n)``; the average is a partial aggregation (k x d values per task)."""
    a = nearest_centre(points, centres, features, "cluster")
    e = a.select("cluster", F.posexplode(F.col(features).cast("array<double>")).alias("dim", "x"))
    return e.groupBy("cluster", "dim").agg(F.avg("x").alias("centre"), F.count(F.lit(1)).alias("n"))


def centres_table_to_list(ct: DataFrame, k: int) -> list[list[float]]:
    """Collect a (cluster, dim, centre) table (k x d values) to lists."""
    rows = ct.select("cluster", "dim", "centre").collect()
    d = 1 + max(r["dim"] for r in rows)
    out = [[0.0] * d for _ in range(k)]
    for r in rows:
        out[r["cluster"]][r["dim"]] = float(r["centre"])
    return out


def inertia(points: DataFrame, centres: Sequence[Sequence[float]], features: str = "features") -> DataFrame:
    """Sum of squared distances to the nearest centre, one row."""
    a = nearest_centre(points, centres, features, "cluster", with_distance=True)
    return a.agg(F.sum("cluster_sqdist").alias("inertia"), F.count(F.lit(1)).cast("bigint").alias("n"))


def _fits(points: DataFrame, ks: Sequence[int], n_init: int, init: str, max_iter: int, seed: int) -> dict[int, list[Centres]]:
    """``n_init`` settled k-means fits for every k, all from the same scans."""
    begin = many.starts(points, max(ks), range(seed, seed + n_init), init)
    fits = {k: [Centres(c[:k].copy(), k, s) for s, c in begin.items() if len(c) >= 1] for k in ks}
    flat = [m for k in ks for m in fits[k]]
    if flat:
        many.lloyd(points, flat, max_iter)
    return fits


def _hashed(df: DataFrame, features: str) -> DataFrame:
    """Points with a row hash for the draws (equal vectors share it)."""
    return many.vectors(df, features, F.xxhash64(F.col(features).cast("array<double>")).alias("_h"))


def kmeans(df: DataFrame, k: int, features: str = "features", init: str = "k-means++", max_iter: int = 100,
           n_init: int = 1, seed: int = 1, out: str = "cluster"):
    """G1: Lloyd from ``n_init`` seeded starts (``k-means++`` or ``random``) in the same scans; the lowest cost wins,
    ties to the first seed.  Returns (assigned DataFrame, :class:`Centres`, cost, iterations)."""
    points = many.held(_hashed(df, features))
    try:
        best = min(_fits(points, [k], n_init, init, max_iter, seed)[k], key=lambda m: m.cost)
    finally:
        points.unpersist()
    return many.assign(df, best, features, out), best, best.cost, best.n_iter


def gmm_fits(points: DataFrame, ks: Sequence[int], n_init: int = 13, max_iter: int = 100, seed: int = 1,
             fits: dict[int, list[Centres]] | None = None) -> dict[int, list[Mixture]]:
    """``n_init`` settled mixtures for every k, each started from a k-means fit, all from the same scans."""
    fits = fits or _fits(points, ks, n_init, "k-means++", max_iter, seed)
    flat = many.mixtures_from(points, [f for k in ks for f in fits[k]])
    many.em(points, flat, max_iter)
    left = iter(flat)
    return {k: [next(left) for _ in fits[k]] for k in ks}


def gmm(df: DataFrame, k: int, features: str = "features", n_init: int = 13, max_iter: int = 100, seed: int = 1,
        out: str = "cluster"):
    """Full-covariance Gaussian mixture by EM, hard labels, ``n_init`` starts in the same scans, highest
    log-likelihood wins.  A task holds d x d sums per component, so reduce first when d is large.
    Returns (assigned DataFrame, :class:`Mixture`, mean log-likelihood)."""
    points = many.held(_hashed(df, features))
    try:
        best = max(gmm_fits(points, [k], n_init, max_iter, seed)[k], key=lambda m: m.log_likelihood())
    finally:
        points.unpersist()
    return many.assign(df, best, features, out), best, best.log_likelihood()


def gmm_centres(spark: SparkSession, model: Mixture, dims: int = 2) -> DataFrame:
    """Component id, weight and the first ``dims`` coordinates of every component mean."""
    rows = [(j, float(model.weights[j]), *map(float, model.means[j][:dims])) for j in range(model.k)]
    return spark.createDataFrame(rows, "component INT, weight DOUBLE, " + ", ".join(f"c{i} DOUBLE" for i in range(dims)))


def cluster_sweep(df: DataFrame, ks: Sequence[int], features: str = "features", label: str = "label",
                  methods: Sequence[str] = ("kmeans", "em"), n_inits: Sequence[int] = (1,), em_init: int = 13,
                  seed: int = 1, sample: int = 4800, max_iter: int = 100) -> DataFrame:
    """One row per (method, k, n_init): raw accuracy, purity, homogeneity, completeness, V-measure, ARI, AMI,
    Calinski-Harabasz, silhouette (over a hash sample of ``sample`` rows), cost or mean log-likelihood, iterations.

    k-means runs max(n_inits) seeds for every k; its row for n_init = i is the best of the first i.  ``em`` rows
    take the best of ``em_init`` mixtures.  All fits share their scans, and so do all scores.
    """
    points = many.held(many.vectors(df, features, F.xxhash64(F.col(features).cast("array<double>")).alias("_h"), F.col(label).alias("_l")))
    try:
        seeds = max([*(n_inits if "kmeans" in methods else []), *([em_init] if "em" in methods else [])])
        fits = _fits(points, ks, seeds, "k-means++", max_iter, seed)
        rows = []
        if "kmeans" in methods:
            rows += [("kmeans", k, n, min(fits[k][:n], key=lambda m: m.cost)) for k in ks for n in n_inits]
        if "em" in methods:
            mixed = gmm_fits(points, ks, em_init, max_iter, seed, {k: f[:em_init] for k, f in fits.items()})
            rows += [("em", k, em_init, max(mixed[k], key=lambda m: m.log_likelihood())) for k in ks]
        models = list({id(r[3]): r[3] for r in rows}.values())
        place = {id(m): i for i, m in enumerate(models)}
        table, sums = many.counts_and_moments(points, "_l", models)
        taken = many.vectors(points.orderBy("_h").limit(sample), "_x")
        sil = many.silhouettes(taken, models)
        scores = cut_lineage(scores_from_counts(table, ["model"]))
    finally:
        points.unpersist()
    extra = [(place[id(m)], name, k, n, many.calinski_harabasz_from(m, sums, place[id(m)]), sil[place[id(m)]],
              m.cost if name == "kmeans" else None, m.log_likelihood() if name == "em" else None, m.n_iter)
             for name, k, n, m in rows]
    side = df.sparkSession.createDataFrame(extra, "model INT, method STRING, k INT, n_init INT, calinski_harabasz DOUBLE, silhouette DOUBLE, "
                                                  "cost DOUBLE, log_likelihood DOUBLE, n_iter INT")
    return side.join(scores, "model").drop("model")
