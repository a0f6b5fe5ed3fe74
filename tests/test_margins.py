"""Expected mutual information from the margin histogram."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orchard.operators.evaluate import cluster_scores, expected_term


def plain_term(a, b, total):
    out = 0.0
    for n in range(max(1, a + b - total), min(a, b) + 1):
        p = math.comb(a, n) * math.comb(total - a, b - n) / math.comb(total, b)
        out += n / total * math.log(total * n / (a * b)) * p
    return out


def test_terms_equal_exact_fractions():
    for total in (1, 2, 7, 60, 400):
        for a in sorted({1, min(2, total), total // 3 or 1, total - 1 or 1, total}):
            for b in sorted({1, total // 2 or 1, total - 1 or 1, total}):
                assert expected_term(a, b, total) == pytest.approx(plain_term(a, b, total), rel=1e-9, abs=1e-13)


def test_large_margins_are_whole():
    """E[MI] of two halves of N is about 1 / (2 N) a cell: no cancelling, no cut."""
    for total in (10**6, 10**9):
        cells = sum(expected_term(total // 2, total // 2, total) for _ in range(4))
        assert cells == pytest.approx(1 / (2 * total), rel=1e-3)


def test_hundred_thousand_labels(spark):
    n = 300_000
    df = spark.range(n).select((F.col("id") % 100_000).alias("label"), F.pmod(F.xxhash64("id"), F.lit(90_000)).alias("cluster"))
    s = cluster_scores(df, "label", "cluster").first()
    assert s.homogeneity > 0.5 and abs(s.adjusted_mutual_info) < 0.01                  # many labels, no relation


def test_groups_nulls_and_ties(spark):
    rng = np.random.default_rng(1)
    rows = [(["x", None, "y"][g], int(rng.integers(0, 4)), int(rng.integers(0, 3))) for g in range(3) for _ in range(50 + 30 * g)]
    df = spark.createDataFrame(rows, "g string, label int, cluster int")
    got = {r.g: r for r in cluster_scores(df, "label", "cluster", by=["g"]).collect()}
    for g in ("x", "y", None):
        one = cluster_scores(df.where(F.col("g").eqNullSafe(F.lit(g))), "label", "cluster").first()
        assert got[g].adjusted_mutual_info == pytest.approx(one.adjusted_mutual_info) and got[g].n == one.n
    for g in ("x", "y", None):
        a, b, c = ({}, {}, {})
        for k, y, p in rows:
            if k == g:
                a[y], b[p], c[y, p] = a.get(y, 0) + 1, b.get(p, 0) + 1, c.get((y, p), 0) + 1
        total = sum(a.values())
        emi = sum(plain_term(i, j, total) for i in a.values() for j in b.values())
        mi = sum(n / total * math.log(total * n / (a[y] * b[p])) for (y, p), n in c.items())
        half = sum(-n / total * math.log(n / total) for n in [*a.values(), *b.values()]) / 2
        assert got[g].adjusted_mutual_info == pytest.approx((mi - emi) / (half - emi))
    assert cluster_scores(df.limit(0), "label", "cluster").count() == 0
