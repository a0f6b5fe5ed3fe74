"""Projection, filters and predicates."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.operators.ordering import row_index


def features_label(df: DataFrame, label: str | int = -1, keep: Sequence[str] = (),
                   features: Sequence[str] | None = None) -> DataFrame:
    """Split a wide numeric table into ``features ARRAY<DOUBLE>`` and
    ``label``.  ``label`` is a column name or a position (0 first, -1 last);
    every other column (minus ``keep``) is a feature - none is dropped."""
    cols = [c for c in df.columns if c not in keep]
    if isinstance(label, int):
        label = cols[label]
    feats = list(features) if features is not None else [c for c in cols if c != label]
    return df.select(*keep, F.array(*[F.col(c).cast("double") for c in feats]).alias("features"),
                     F.col(label).alias("label"))


def positional_split(df: DataFrame, key: str | Sequence[str], frac: float = 0.3,
                     flag: str = "is_test") -> DataFrame:
    """First ``n - int(n*frac)`` rows in key order are train, the rest
    test (disjoint, unlike the overlapping slices of the reference)."""
    keys = [key] if isinstance(key, str) else list(key)
    n = df.count()
    cut = n - int(n * frac)
    return (row_index(df, keys, name="_ri")
            .withColumn(flag, F.col("_ri") >= F.lit(cut)).drop("_ri"))


def every_nth(df: DataFrame, key: str | Sequence[str], pct: float) -> DataFrame:
    """Systematic sample, every ``int(100/pct)``-th row in key order."""
    keys = [key] if isinstance(key, str) else list(key)
    gap = max(int(100 / pct), 1)
    return row_index(df, keys, name="_ri").where(F.col("_ri") % gap == 0).drop("_ri")


def filter_class(df: DataFrame, c: int | None = None, label: str = "label",
                 n_class: int | None = None) -> DataFrame:
    """Rows of class ``c``; with ``n_class`` labels outside 0..n-1 go."""
    cond = F.lit(True)
    if c is not None:
        cond = cond & (F.col(label) == F.lit(c))
    if n_class is not None:
        cond = cond & F.col(label).between(0, n_class - 1)
    return df.where(cond)


def threshold(score, cut: float = 0.5) -> Column:
    """P5: score >= cut -> 1.0 else 0.0."""
    s = F.col(score) if isinstance(score, str) else score
    return F.when(s >= F.lit(cut), F.lit(1.0)).otherwise(F.lit(0.0))


def head(df: DataFrame, n: int, key: str | Sequence[str]) -> DataFrame:
    """First n rows in key order (TakeOrderedAndProject, no full sort)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(*keys).limit(n)


def bounds(df: DataFrame, axes: Sequence[str], pad: float = 1.0) -> DataFrame:
    """``min - pad`` / ``max + pad`` per axis, one row."""
    aggs = []
    for a in axes:
        aggs += [(F.min(a) - F.lit(pad)).alias(f"{a}_min"), (F.max(a) + F.lit(pad)).alias(f"{a}_max")]
    return df.agg(*aggs)


def mesh_grid(spark: SparkSession, xmin: float, xmax: float, ymin: float, ymax: float,
              h: float) -> DataFrame:
    """Lattice ``(ix, iy, x, y)`` with step h over [min, max)."""
    nx = max(math.ceil((xmax - xmin) / h), 1)
    ny = max(math.ceil((ymax - ymin) / h), 1)
    xs = spark.range(nx).withColumnRenamed("id", "ix")
    return (xs.withColumn("iy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(ny - 1).cast("bigint"))))
              .withColumn("x", F.lit(float(xmin)) + F.col("ix").cast("double") * F.lit(float(h)))
              .withColumn("y", F.lit(float(ymin)) + F.col("iy").cast("double") * F.lit(float(h))))
