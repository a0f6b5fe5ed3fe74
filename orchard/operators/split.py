"""Splitting and sampling.

All of them are pure functions of ``(seed, key)``: the same rows land in the
same split on any cluster, with any partitioning, and a DuckDB twin can
reproduce them with ``md5``.  None needs more than one scan, except the ones
that number rows (``row_index``), which use a range-partitioned sort.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.functions.hashing import hash_bucket, hash_rank_key
from orchard.operators.ordering import row_index


def train_test_split(df: DataFrame, key: str, frac: float = 0.3, seed: int = 100,
                     flag: str = "is_test") -> DataFrame:
    """Hash holdout; a row is test when its md5 bucket < 100*frac."""
    pct = int(round(frac * 100))
    return df.withColumn(flag, hash_bucket(key, seed) < F.lit(pct))


def sample_n(df: DataFrame, key: str, n: int, seed: int = 100) -> DataFrame:
    """Exactly ``n`` rows (all when fewer) chosen by seeded hash order.

    Numbered by a distributed sort, so no task holds n rows.
    """
    order = [hash_rank_key(key, seed), F.col(key)]
    return row_index(df, order, name="_ri").where(F.col("_ri") < n).drop("_ri")


def stratified_kfold(df: DataFrame, label: str, key: str, k: int = 5, seed: int | None = None,
                     fold_col: str = "fold") -> DataFrame:
    """Fold id per row; rows of each class are dealt round-robin in key
    (or seeded hash) order, so per-class fold sizes differ by at most one."""
    order = [F.col(key)] if seed is None else [hash_rank_key(key, seed), F.col(key)]
    return (row_index(df, order, by=[label], name="_ri")
            .withColumn(fold_col, (F.col("_ri") % k).cast("int")).drop("_ri"))


def learning_sizes_list(n_max: int, samples: int = 11, lo: float = 0.1, hi: float = 1.0) -> list[int]:
    """Absolute learning-curve sizes: linspace fractions times the train
    size, floored, clipped to [1, n_max], de-duplicated (driver-side list of
    ``samples`` numbers)."""
    rel = np.linspace(lo, hi, samples)
    return sorted(set(int(v) for v in np.clip((rel * n_max).astype(int), 1, n_max)))


def learning_sizes(df_folds: DataFrame, fold_col: str = "fold", samples: int = 11,
                   lo: float = 0.1, hi: float = 1.0) -> DataFrame:
    """T4: ``(tick, train_size)``: fractions ``linspace(lo, hi, samples)`` of
    the largest train fold (all rows minus fold 0), floored and clipped."""
    n_max = (df_folds.agg(F.count(F.lit(1)).alias("n"),
                          F.sum(F.when(F.col(fold_col) == 0, 1).otherwise(0)).alias("f0"))
             .select((F.col("n") - F.col("f0")).alias("n_max")))
    step = (hi - lo) / (samples - 1) if samples > 1 else 0.0
    ticks = F.sequence(F.lit(0), F.lit(samples - 1))
    out = n_max.select("n_max", F.posexplode(ticks).alias("_p", "tick"))
    frac = F.when(F.col("tick") == samples - 1, F.lit(float(hi))).otherwise(
        F.col("tick").cast("double") * F.lit(step) + F.lit(float(lo)))
    size = F.greatest(F.least(F.floor(frac * F.col("n_max")), F.col("n_max")), F.lit(1))
    out = out.select(F.col("tick").cast("int").alias("tick"), size.cast("bigint").alias("train_size"))
    # np.unique: keep the first tick of equal sizes
    return out.groupBy("train_size").agg(F.min("tick").alias("tick")).select("tick", "train_size")


def nested_prefix_ranks(df_folds: DataFrame, key: str, k: int, seed: int = 17,
                        fold_col: str = "fold") -> DataFrame:
    """T5: for every CV round ``f`` the training rows (fold != f) in seeded
    shuffle order; the sample of size m is ``prank < m``, so all sizes of a
    learning curve are nested prefixes of one ranking (no resampling)."""
    rounds = df_folds.select(key, fold_col, F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("cv_round"))
    train = rounds.where(F.col("cv_round") != F.col(fold_col)).drop(fold_col)
    return row_index(train, [hash_rank_key(key, seed), F.col(key)], by=["cv_round"], name="prank")

