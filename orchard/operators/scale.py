"""Preprocessing: standard scaling (D1) and covariance / Gram.

Scaling statistics are one global aggregate (partial per task, k doubles
shuffled per task) and are applied as literals in a projection - the table
is read twice and never shuffled.  Covariance is accumulated per partition
as a d x d block (numpy, inside the task) and summed by a ``groupBy(i, j)``
whose input is ``#partitions x d^2`` rows, so the shuffle does not grow with
the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def standard_scale_fit(train: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation of each column (sigma 0 -> 1)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    row = train.agg(*aggs).first()
    out = {}
    for c in cols:
        sd = row[f"s_{c}"]
        out[c] = (float(row[f"m_{c}"]), 1.0 if (sd is None or sd == 0.0) else float(sd))
    return out


def standard_scale_apply(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    cols = []
    for c in df.columns:
        if c in stats:
            m, s = stats[c]
            cols.append(((F.col(c) - F.lit(m)) / F.lit(s)).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def standard_scale(train: DataFrame, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Zero mean, unit (population) variance, fit on ``train`` only."""
    return standard_scale_apply(df, standard_scale_fit(train, cols))


def standard_scale_vectors_fit(train: DataFrame, features: str = "features") -> tuple[list, list]:
    """Per-dimension mean / population sd of an array column (one pass)."""
    d = len(train.select(features).first()[0])
    x = F.col(features).cast("array<double>")
    aggs = []
    for i in range(d):
        aggs += [F.avg(x[i]).alias(f"m{i}"), F.stddev_pop(x[i]).alias(f"s{i}")]
    row = train.agg(*aggs).first()
    means = [float(row[f"m{i}"]) for i in range(d)]
    sds = [1.0 if not row[f"s{i}"] else float(row[f"s{i}"]) for i in range(d)]
    return means, sds


def co_moments(df: DataFrame, features: str = "features", shift: Sequence[float] | None = None) -> DataFrame:
    """``(i, j, sxy, sx, sy, n)`` for i <= j: sums of products and sums of
    ``x - shift`` over all rows, in one scan.

    Every task adds up its rows in numpy and hands on d(d+1)/2 rows, which a
    ``groupBy`` sums.  With a shift near the data (any row will do) the
    difference of the sums does not cancel, however large the means are.
    """
    schema = "i int, j int, sxy double, sx double, sy double, n double"

    def part(it):
        G = sx = None
        n = 0
        for pdf in it:
            if len(pdf) == 0:
                continue
            X = np.vstack(pdf["x"].to_numpy()).astype(np.float64)
            if shift is not None:
                X = X - np.asarray(shift)
            if G is None:
                G, sx = np.zeros((X.shape[1], X.shape[1])), np.zeros(X.shape[1])
            G += X.T @ X
            sx += X.sum(axis=0)
            n += X.shape[0]
        if G is None:
            return
        i, j = np.triu_indices(G.shape[0])
        yield pd.DataFrame({"i": i.astype(np.int32), "j": j.astype(np.int32), "sxy": G[i, j], "sx": sx[i], "sy": sx[j],
                            "n": np.full(len(i), float(n))})

    x = df.select(F.col(features).cast("array<double>").alias("x")).where("x IS NOT NULL")
    return x.mapInPandas(part, schema).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("sxy", "sx", "sy", "n")])


def first_vector(df: DataFrame, features: str = "features") -> list[float]:
    r = df.select(F.col(features).cast("array<double>").alias("x")).where("x IS NOT NULL").first()
    return list(r["x"]) if r else []


def covariance(df: DataFrame, features: str = "features", sample: bool = True) -> DataFrame:
    """``(i, j, cov)`` for i <= j (sample covariance by default)."""
    m = co_moments(df, features, first_vector(df, features))
    cov = (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")) / (F.col("n") - F.lit(1.0 if sample else 0.0))
    return m.select("i", "j", cov.alias("cov"))


def gram(df: DataFrame, features: str = "features") -> DataFrame:
    """Uncentred ``X^T X`` as ``(i, j, g)`` for i <= j."""
    return co_moments(df, features).select("i", "j", F.col("sxy").alias("g"))


def standard_scale_vectors(df: DataFrame, means: Sequence[float], sds: Sequence[float], features: str = "features") -> DataFrame:
    """D1 for vector columns: every component minus its mean, by its standard deviation (1 where that is 0)."""
    scale = F.array(*[F.struct(F.lit(float(m)).alias("m"), F.lit(float(s) or 1.0).alias("s")) for m, s in zip(means, sds)])
    return df.withColumn(features, F.zip_with(F.col(features).cast("array<double>"), scale, lambda x, p: (x - p["m"]) / p["s"]))
