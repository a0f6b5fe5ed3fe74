"""Reductions against numpy: ill-conditioned tables, planted sources."""

import numpy as np
import pytest

from orchard.operators import reduce as R


def frame(spark, x, parts=5):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, features array<double>").repartition(parts, "id")


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_singular_values_of_an_ill_conditioned_table(spark, parts):
    rng = np.random.default_rng(1)
    u, _ = np.linalg.qr(rng.normal(size=(600, 6)))
    v, _ = np.linalg.qr(rng.normal(size=(6, 6)))
    s = np.array([1e3, 50.0, 1.0, 0.1, 1e-2, 1e-3])                      # squared, the last is lost in rounding
    x = (u * s) @ v.T
    red, got, V = R.truncated_svd(frame(spark, x, parts), 6)
    assert got == pytest.approx(np.linalg.svd(x, compute_uv=False), rel=1e-9)
    assert np.abs(V.T @ V - np.eye(6)).max() < 1e-12 and np.abs(np.abs((V * v).sum(0)) - 1).max() < 1e-6
    assert red.count() == 600


def test_few_rows_nulls_and_an_empty_table(spark):
    x = np.random.default_rng(2).normal(size=(3, 5))
    df = frame(spark, x).union(spark.createDataFrame([(9, None)], "id long, features array<double>"))
    _, got, _ = R.truncated_svd(df, 5)
    assert got == pytest.approx([*np.linalg.svd(x, compute_uv=False), 0, 0], abs=1e-12)
    assert R.triangular_factor(df.where("id > 99")).size == 0


def test_ica_finds_planted_sources(spark):
    """A rotation of the whitened rows is not enough: each component is one source, up to sign."""
    rng = np.random.default_rng(3)
    s = np.column_stack([rng.uniform(-1, 1, 3000), rng.laplace(size=3000), np.sign(rng.normal(size=3000)) + 0.1 * rng.normal(size=3000)])
    x = s @ rng.normal(size=(3, 3)).T + 5
    red, W, _ = R.fast_ica(frame(spark, x), 3, max_iter=200)
    got = np.array([r.reduced for r in red.orderBy("id").select("reduced").collect()])
    corr = np.abs(np.corrcoef(got.T, s.T)[:3, 3:])
    assert (corr.max(0) > 0.98).all() and sorted(corr.argmax(0)) == [0, 1, 2]
    white = R.pca(frame(spark, x), 3, whiten=True)[0]
    turned = np.array([r.reduced for r in white.orderBy("id").select("reduced").collect()])
    assert (np.abs(np.corrcoef(turned.T, s.T)[:3, 3:]).max(0) < 0.98).any()       # whitening alone fails the same test
