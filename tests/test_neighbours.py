"""Pivot-pruned exact nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orchard.operators import neighbours as N
from orchard.session import ship_package


def frame(spark, x, first=0):
    return spark.createDataFrame([(first + i, [float(v) for v in r], i % 3) for i, r in enumerate(x)], "id long, features array<double>, label int")


def brute(x, q, k):
    d = ((q[:, None] - x[None]) ** 2).sum(2)
    return {i: sorted(zip(r.round(12), range(len(x))))[:k] for i, r in enumerate(d)}


@pytest.fixture(scope="module")
def clumps(spark):
    ship_package(spark)
    rng = np.random.default_rng(1)
    centres = rng.uniform(-50, 50, (12, 4))
    x = np.concatenate([c + rng.normal(0, 1, (60, 4)) for c in centres] + [np.repeat(centres[:1], 40, 0)])     # 40 equal rows: ties
    q = np.concatenate([c + rng.normal(0, 1, (15, 4)) for c in centres] + [centres[:1], rng.uniform(-60, 60, (20, 4))])
    return x, q


@pytest.mark.parametrize("cell_rows, block_rows", [(40, 4096), (40, 16), (10_000, 4096)])
def test_same_rows_as_brute_force(spark, clumps, cell_rows, block_rows):
    x, q = clumps
    for k in (1, 7, 90):
        got = {}
        for r in N.knn_join(frame(spark, x), frame(spark, q), k, block_rows=block_rows, cell_rows=cell_rows).collect():
            got.setdefault(r.qid, []).append((round(r.sqdist, 12), r.nid, r["rank"]))
        want = brute(x, q, k)
        for i in want:
            assert [(pytest.approx(d, abs=1e-9), n) for d, n, _ in sorted(got[i], key=lambda t: t[2])] == want[i]
        if k > 1 and block_rows == 16:
            break


def test_shuffled_copies_are_few(spark, clumps):
    """Queries go to the cells that can win, train rows are not copied per query block."""
    x, q = clumps
    tr = frame(spark, x).select(F.col("id").alias("nid"), F.col("features").alias("v"), F.col("label").cast("long").alias("nlabel"))
    qs = frame(spark, q).select(F.col("id").alias("qid"), F.col("features").alias("qv"))
    pivots = N._pivots(tr, 24)
    tr, qs = N._cells_of(tr, "v", pivots).cache(), N._cells_of(qs, "qv", pivots).cache()
    first = N._score_cells(tr, qs, 3, 4096)
    others = N.other_cells(tr, qs, first, pivots, 3).cache()
    copies = [d.count() for pair in (N.dealt_cells(tr, qs, 4096), N.dealt_cells(tr, others, 4096)) for d in pair]
    assert copies[0] <= len(x) and copies[2] <= len(x)                         # a train row at most once a pass
    assert copies[1] + copies[3] < 0.35 * len(q) * len(pivots)                 # of all (query, cell) pairs
    hot = N.dealt_cells(tr, qs, 8)
    assert max(r["count"] for d in hot for r in d.groupBy("_cell", "_tb", "_qb").count().collect()) < 40      # a hot cell is many groups


def test_bounds_never_cut_a_winner():
    rng = np.random.default_rng(3)
    for dim in (1, 2, 16):
        x, q = rng.normal(size=(300, dim)), rng.normal(size=(60, dim)) * 2
        pivots = x[:15]
        cell = N.nearest(x, pivots)
        reach = np.sqrt(((x - pivots[cell]) ** 2).sum(1))
        n = np.bincount(cell, minlength=15).astype(float)
        low, high = (np.array([f(reach[cell == j]) if n[j] else 0 for j in range(15)]) for f in (np.min, np.max))
        for k in (1, 5, 299):
            can = N.reachable_cells(q, np.full(60, np.inf), pivots, n, low, high, k)
            d = ((q[:, None] - x[None]) ** 2).sum(2)
            for i in range(60):
                assert can[i, cell[np.argsort(d[i], kind="stable")[:k]]].all()


def test_null_rows_and_empty_tables(spark, clumps):
    x, q = clumps
    tr, qs = frame(spark, x), frame(spark, q)
    odd = spark.createDataFrame([(None, [0.0] * 4, 1), (5000, None, 1)], tr.schema)
    assert N.knn_join(tr.union(odd), qs.union(odd), 2, cell_rows=50).count() == 2 * len(q)
    assert N.knn_join(tr.limit(0), qs, 3).count() == 0 and N.knn_join(tr, qs.limit(0), 3, cell_rows=50).count() == 0
