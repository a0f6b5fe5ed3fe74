"""Exact row numbering without a single-partition window.

``row_number().over(Window.orderBy(..))`` with no partitioning moves the
whole table into one task.  ``row_index`` gives the same numbers with a
range-partitioned sort: each task numbers its own slice, a tiny table of
per-(task, group) counts turns those into global offsets, and one join puts
the offsets back.  A hot group (one label holding a third of the rows) is
spread over many range partitions because the order key continues inside it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def spread(df: DataFrame, key: str | None = None, partitions: int | None = None) -> DataFrame:
    """Hash-repartition narrow rows before CPU-heavy per-row work.

    A table that arrives as one file split is one task; operators that
    expand every row (candidate arrays, neighbourhoods) would then run on
    one core.  The rows are dealt by a hash of ``key`` (deterministic on
    retry, unlike round-robin); they are ids and a few numbers, so the
    shuffle is small beside the work that follows.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, key) if key else df.repartition(n, *[F.col(c) for c in df.columns[:1]])


def _join_slices(rows: DataFrame, per_slice: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach the one row per (slice, group) of ``per_slice``; null group keys match each other."""
    right = per_slice.select(F.col("_pid").alias("_spid"), *[F.col(b).alias(f"_s_{i}") for i, b in enumerate(by)],
                             *[c for c in per_slice.columns if c != "_pid" and c not in by])
    cond = F.col("_pid") == F.col("_spid")
    for i, b in enumerate(by):
        cond = cond & F.col(b).eqNullSafe(F.col(f"_s_{i}"))
    return rows.join(right, cond, "inner").drop("_spid", *[f"_s_{i}" for i in range(len(by))])


def _materialise(df: DataFrame) -> DataFrame:
    """Persist and compute once; a lost block is rebuilt from the same
    shuffle dependency, so it comes back with the same partition ids."""
    from pyspark import StorageLevel
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    df.count()
    return df


def row_index(df: DataFrame, order: Sequence, by: Sequence[str] = (), name: str = "row_idx",
              num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 0-based position of the row in ``order`` within ``by``.

    ``order`` must be a total order (end it with a unique key) so the result
    does not depend on partitioning.  Equals
    ``row_number() over (partition by by order by order) - 1``.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = list(by)
    order_cols = _cols(order)
    keys = [F.col(b) for b in by] + order_cols
    ranged = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    # the counts and the rows must come from the *same* range partitioning
    # (its sampled bounds are not reproducible across two plans), so the
    # numbered slices are materialised once and both branches read them
    ranged = _materialise(ranged)
    # rows of one group are contiguous inside a partition, so the first id of
    # the group in that partition anchors the local position
    stats = ranged.groupBy("_pid", *by).agg(F.min("_mid").alias("_first"),
                                           F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*by).orderBy("_pid") if by else Window.orderBy("_pid")
    offsets = stats.select("_pid", *by, "_first",
                           (F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)))
                           .alias("_off"))
    offsets = offsets.fillna(0, subset=["_off"])
    out = _join_slices(ranged, offsets.select("_pid", *by, "_first", "_off"), by)
    return (out.withColumn(name, (F.col("_off") + F.col("_mid") - F.col("_first")).cast("bigint"))
               .drop("_pid", "_mid", "_first", "_off"))


def running_extreme(df: DataFrame, order: Sequence, by: Sequence[str], value: str,
                    out: str = "best_so_far", kind: str = "max",
                    num_partitions: int | None = None) -> DataFrame:
    """Running max (or min) of ``value`` within ``by`` in ``order``.

    Equals ``max(value) over (partition by by order by order rows between
    unbounded preceding and current row)`` but a hot group is not sent to
    one task: the table is range-partitioned on (by, order), every task scans
    its slice (vectorised cumulative max in pandas), and the extreme of all
    earlier slices of the same group - a table of #partitions rows - is
    joined back.
    """
    import pandas as pd  # local: only executors need it

    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = list(by)
    keys = [F.col(b) for b in by] + _cols(order)
    ranged = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                .withColumn("_pid", F.spark_partition_id()))
    schema = T.StructType(list(ranged.schema.fields) + [T.StructField("_local", T.DoubleType())])
    is_max = kind == "max"

    def scan(it):
        import numpy as np
        gkeys = [*by, "_pid"]
        carry_key, carry_val = None, np.nan
        for pdf in it:
            if len(pdf) == 0:
                continue
            v = pdf[gkeys].assign(_v=pdf[value].astype("float64"))
            g = v.groupby(gkeys, sort=False, dropna=False)["_v"]
            loc = (g.cummax() if is_max else g.cummin())
            # a null value keeps the extreme seen so far, as SQL max() does
            loc = loc.groupby([v[k] for k in gkeys], sort=False, dropna=False).ffill()
            # groups are contiguous (sorted slice): only the first group of a
            # batch can continue the last group of the previous batch
            first = tuple(None if pd.isna(x_) else x_ for x_ in v.iloc[0][gkeys])
            if carry_key == first and not np.isnan(carry_val):
                same = np.ones(len(v), dtype=bool)
                for k_, x_ in zip(gkeys, first):
                    same &= (v[k_].isna() if x_ is None else v[k_] == x_).to_numpy()
                cur = loc.to_numpy(dtype="float64", na_value=np.nan)
                comb = np.where(np.isnan(cur), carry_val,
                                np.maximum(cur, carry_val) if is_max else np.minimum(cur, carry_val))
                loc = pd.Series(np.where(same, comb, cur), index=loc.index)
            carry_key = tuple(None if pd.isna(x_) else x_ for x_ in v.iloc[-1][gkeys])
            carry_val = float(loc.iloc[-1]) if pd.notna(loc.iloc[-1]) else np.nan
            yield pdf.assign(_local=loc.astype("float64"))

    local = _materialise(ranged.mapInPandas(scan, schema))
    agg = F.max if is_max else F.min
    part = local.groupBy("_pid", *by).agg(agg(value).alias("_pe"))
    w = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy("_pid")
    prefix = part.select("_pid", *by, agg("_pe").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("_prev"))
    pick = F.greatest if is_max else F.least
    res = _join_slices(local, prefix, by)
    return (res.withColumn(out, F.coalesce(pick(F.col("_local"), F.col("_prev")), F.col("_local"), F.col("_prev")))
               .drop("_pid", "_local", "_prev"))
