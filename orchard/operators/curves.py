"""Learning curves from additive statistics.

A nearest-mean classifier is made of class sums, and sums add up.  One scan
therefore sums the rows by (round, size bucket, class), running sums over the
buckets give the models of all sizes of all rounds, and a second scan scores
all of them: two passes over the table instead of three jobs per model.  Only
rounds x sizes x classes sums reach the driver.

``sizes`` are nested prefixes of one hash order per round (T5), so a row's
bucket is the first size that holds it.  Rows without a vector, label, key
or fold take no part; ties go to the smaller label; a class without rows
among a prefix is not a candidate.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.operators import many
from orchard.operators.split import nested_prefix_ranks


def _bucketed(df: DataFrame, key: str, rounds: int, sizes: Sequence[int], features: str, label: str, fold: str, seed: int) -> DataFrame:
    """``(_x, _y, _f, _b)``: vector, label, fold and, per round, the first size that holds the row (``len(sizes)``: none or own fold)."""
    rows = df.where(F.col(features).isNotNull() & F.col(label).isNotNull() & F.col(key).isNotNull() & F.col(fold).isNotNull())
    edges = F.array(*[F.lit(int(m)) for m in sizes])
    ranks = nested_prefix_ranks(rows, key, rounds, seed, fold)
    bucket = F.size(F.filter(edges, lambda m: m <= F.col("prank")))
    per = ranks.select(F.col(key).alias("_k"), "cv_round", bucket.alias("b")).groupBy("_k").agg(
        F.array(*[F.coalesce(F.max(F.when(F.col("cv_round") == f, F.col("b"))), F.lit(len(sizes))) for f in range(rounds)]).alias("_b"))
    return rows.join(per, F.col(key) == F.col("_k")).select(F.col(features).cast("array<double>").alias("_x"), F.col(label).cast("double").alias("_y"),
                                                            F.col(fold).cast("int").alias("_f"), "_b")


def class_means(points: DataFrame, rounds: int, sizes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(classes, means [round, size, class, dim], rows [round, size, class]) from one scan."""
    classes = np.array(sorted(r[0] for r in points.select("_y").distinct().collect()))

    def step(x, rows):
        y = np.searchsorted(classes, rows.column("_y").to_numpy())
        b = rows.column("_b").flatten().to_numpy().reshape(-1, rounds)
        for f in range(rounds):
            cell = b[:, f] * len(classes) + y
            for c in np.unique(cell[b[:, f] < sizes]):
                mine = x[cell == c]
                yield (f, int(c)), np.concatenate([[len(mine)], mine.sum(0)])

    sums = many.scan_sums(points, step)
    width = len(next(iter(sums.values()))) if sums else 1
    total = np.zeros((rounds, sizes, len(classes), width))
    for (f, c), v in sums.items():
        total[f, c // len(classes), c % len(classes)] = v
    total = total.cumsum(1)
    n = total[..., 0]
    return classes, total[..., 1:] / np.maximum(n, 1)[..., None], n


def _hits(x: np.ndarray, y: np.ndarray, means: np.ndarray, n: np.ndarray) -> np.ndarray:
    have = np.flatnonzero(n > 0)
    return have[many.nearest(x, means[have])] == y


def nearest_mean_curve(df_folds: DataFrame, key: str, rounds: int, sizes: Sequence[int], features: str = "features", label: str = "label",
                       fold: str = "fold", seed: int = 17, error: bool = False) -> DataFrame:
    """E6 for the nearest-mean classifier: ``(train_size, train_score, test_score)``, means over the rounds."""
    sizes = sorted(set(int(m) for m in sizes))
    points = many.held(_bucketed(df_folds, key, rounds, sizes, features, label, fold, seed))
    try:
        classes, means, n = class_means(points, rounds, len(sizes))

        def score(x, rows):
            y = np.searchsorted(classes, rows.column("_y").to_numpy())
            own, b = rows.column("_f").to_numpy(), rows.column("_b").flatten().to_numpy().reshape(-1, rounds)
            for f in range(rounds):
                test = own == f
                for s in range(len(sizes)):
                    train = ~test & (b[:, f] <= s)
                    if n[f, s].any():
                        out = [(_hits(x[m], y[m], means[f, s], n[f, s]).sum() if m.any() else 0, m.sum()) for m in (train, test)]
                        yield (f, s), np.array([out[0][0], out[0][1], out[1][0], out[1][1]], float)

        got = many.scan_sums(points, score)
    finally:
        points.unpersist()
    rows = []
    for s, m in enumerate(sizes):
        parts = [got.get((f, s), np.zeros(4)) for f in range(rounds)]
        a, b = (sum(p[i] / p[i + 1] if p[i + 1] else 0.0 for p in parts) / rounds for i in (0, 2))
        rows.append((m, float(1 - a if error else a), float(1 - b if error else b)))
    return df_folds.sparkSession.createDataFrame(rows, "train_size BIGINT, train_score DOUBLE, test_score DOUBLE")


def nearest_mean_cv(df_folds: DataFrame, folds: int, features: str = "features", label: str = "label", fold: str = "fold") -> DataFrame:
    """E5 for the nearest-mean classifier: ``(fold, accuracy)`` in percent and the mean (fold = -1); sums by (fold, class) give
    every round's model as the total without its fold."""
    rows = df_folds.where(F.col(features).isNotNull() & F.col(label).isNotNull() & F.col(fold).isNotNull())
    out = F.transform(F.sequence(F.lit(0), F.lit(folds - 1)), lambda f: (f == F.col("_f")).cast("int"))
    points = many.held(rows.select(F.col(features).cast("array<double>").alias("_x"), F.col(label).cast("double").alias("_y"),
                                   F.col(fold).cast("int").alias("_f")).withColumn("_b", out))
    try:
        classes, means, n = class_means(points, folds, 1)

        def score(x, batch):
            y, own = np.searchsorted(classes, batch.column("_y").to_numpy()), batch.column("_f").to_numpy()
            for f in range(folds):
                m = own == f
                if m.any() and n[f, 0].any():
                    yield (f, 0), np.array([_hits(x[m], y[m], means[f, 0], n[f, 0]).sum(), m.sum()], float)

        got = many.scan_sums(points, score)
    finally:
        points.unpersist()
    scores = [100.0 * got[f, 0][0] / got[f, 0][1] if (f, 0) in got else 0.0 for f in range(folds)]
    return df_folds.sparkSession.createDataFrame([*((f, float(s)) for f, s in enumerate(scores)), (-1, float(sum(scores) / folds))],
                                                 "fold INT, accuracy DOUBLE")
