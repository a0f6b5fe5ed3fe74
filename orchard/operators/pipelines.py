"""Classifier comparisons over transformed features (C11, C12): reductions
or cluster features in front, the nets of all solvers behind."""

from __future__ import annotations

import functools
import time
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.operators import classify as C
from orchard.operators import many
from orchard.operators import reduce as R
from orchard.operators.cluster import gmm, kmeans
from orchard.operators.evaluate import classification_scores
from orchard.operators.mlp import mlp_solvers

METHODS, SOLVERS = ("base", "svd", "pca", "ica", "grp"), ("adam", "lbfgs", "sgd")


def reduced(df: DataFrame, method: str, k: int, features: str = "features") -> DataFrame:
    """``df`` with ``features`` replaced by ``k`` components (``base``: as they are)."""
    if method == "base":
        return df
    run = {"svd": lambda: R.truncated_svd(df, k, features)[0], "pca": lambda: R.pca(df, k, True, features)[0],
           "ica": lambda: R.fast_ica(df, k, features, max_iter=500)[0],
           "grp": lambda: R.gaussian_random_projection(df, k, 1, features=features)}
    return run[method]().withColumn(features, F.col("reduced")).drop("reduced")


def solver_scores(train: DataFrame, test: DataFrame, solvers: Sequence[str] = SOLVERS, schedule: str = "constant", max_iter: int = 200,
                  hidden: Sequence[int] = (100,), batches: int = 1, features: str = "features", label: str = "label") -> DataFrame:
    """One row per solver: ``n, correct, accuracy, precision, recall`` (micro) and the fit seconds.

    The stochastic solvers share their scans (and so their seconds).
    """
    parts = []
    own = [(s, schedule) for s in solvers if s != "lbfgs"]
    if own:
        scored, _, seconds = mlp_solvers(train, test, own, hidden, max_iter, batches, None, features, label)
        parts.append(classification_scores(scored, label, "prediction", by=["solver"]).withColumn("fit_seconds", F.lit(seconds)))
    if "lbfgs" in solvers:
        scored, _, seconds = C.mlp_classify(train, test, hidden, max_iter, "l-bfgs", features=features, label=label)
        parts.append(classification_scores(scored, label, "prediction").withColumns({"solver": F.lit("lbfgs"), "fit_seconds": F.lit(seconds)}))
    names = ["solver", "n", "correct", "accuracy", F.col("precision_micro").alias("precision"), F.col("recall_micro").alias("recall"), "fit_seconds"]
    return functools.reduce(DataFrame.unionByName, [p.select(*names) for p in parts])


def _materialised(scores: DataFrame) -> DataFrame:
    """A handful of score rows, computed."""
    return scores.sparkSession.createDataFrame(scores.collect(), scores.schema)


def base_vs_reduced(df: DataFrame, k: int, methods: Sequence[str] = METHODS, solvers: Sequence[str] = SOLVERS, test: str = "is_test",
                    features: str = "features", label: str = "label", parallelism: int = 5, **options) -> DataFrame:
    """C11: every solver on the raw and on the reduced features: ``(method, n_features, solver, ..., fit_seconds)``.

    The reductions see features only.  Independent fits run side by side.
    """
    def one(method):
        red = many.held(reduced(df, method, k, features))
        try:
            size = red.select(F.size(features)).first()[0]
            got = solver_scores(red.where(~F.col(test)), red.where(F.col(test)), solvers, features=features, label=label, **options)
            return _materialised(got.withColumns({"method": F.lit(method), "n_features": F.lit(size)}))
        finally:
            red.unpersist()
    df = many.held(df)
    try:
        with ThreadPool(parallelism) as pool:
            return functools.reduce(DataFrame.unionByName, pool.map(one, methods))
    finally:
        df.unpersist()


def cluster_augmented(df: DataFrame, ks: Sequence[int], solvers: Sequence[str] = SOLVERS, em_components: int | None = 5, test: str = "is_test",
                      features: str = "features", label: str = "label", parallelism: int = 4, **options) -> DataFrame:
    """Every solver on features with the row's cluster behind them, for k-means and mixtures of every k.

    Mixtures are fitted over ``em_components`` whitened components (None: the
    features themselves).
    """
    wide = df if em_components is None else R.pca(df, em_components, True, features)[0]
    source = features if em_components is None else "reduced"

    def one(job):
        method, k = job
        a = kmeans(df, k, features)[0] if method == "kmeans" else gmm(wide, k, source, n_init=13)[0]
        aug = many.held(R.augment_with_cluster(a, "cluster", features))
        try:
            got = solver_scores(aug.where(~F.col(test)), aug.where(F.col(test)), solvers, features=features, label=label, **options)
            return _materialised(got.withColumns({"method": F.lit(method), "k": F.lit(k)}))
        finally:
            aug.unpersist()
    with ThreadPool(parallelism) as pool:
        return functools.reduce(DataFrame.unionByName, pool.map(one, [(m, k) for k in ks for m in ("kmeans", "em")]))
