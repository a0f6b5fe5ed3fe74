"""Nystrom kernel maps against the kernels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orchard.operators import classify as C


@pytest.fixture(scope="module")
def rings(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 40)) * np.r_[np.ones(2), np.full(38, 0.05)]
    y = (np.hypot(x[:, 0], x[:, 1]) > 1.2).astype(float)
    rows = [(i, [float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, features array<double>, label double").repartition(3, "id").cache(), x


def test_map_reproduces_the_kernel(spark, rings):
    df, x = rings
    marks = C.landmarks_of(df, 120)
    assert len(marks) == 120 and (C.landmarks_of(df.repartition(7), 120) == marks).all()
    for kernel, coef in (("rbf", 0.0), ("poly", 1.0)):
        z = np.array([r.nystrom for r in C.nystrom_map(df, marks, kernel, 0.5, 3, coef).orderBy("id").select("nystrom").collect()])
        assert z.shape == (500, 120)
        where = [int(np.flatnonzero((x == m).all(1))[0]) for m in marks]
        want = C.kernel_matrix(x, x, kernel, 0.5, 3, coef)
        assert np.abs((z @ z.T)[np.ix_(where, where)] - want[np.ix_(where, where)]).max() < 1e-5 * np.abs(want).max()
        cross = C.kernel_matrix(x, marks, kernel, 0.5, 3, coef)
        exact = cross @ np.linalg.pinv(C.kernel_matrix(marks, marks, kernel, 0.5, 3, coef), rcond=1e-10, hermitian=True) @ cross.T
        assert np.abs(z @ z.T - exact).max() < 1e-4 * np.abs(want).max()


def test_wide_tables_with_landmarks_learn(rings):
    df, _ = rings
    tr, te = df.where("id % 4 <> 0"), df.where("id % 4 = 0")
    acc = {k: C.svm_classify(tr, te, k, landmarks=m).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
           for k, m in (("rbf", 80), ("linear", None))}
    assert acc["rbf"] > 0.8 > acc["linear"]


def test_nulls_and_repeated_landmarks(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0, 2.0],), (None,), ([0.5, 0.0],)], "features array<double>")
    marks = C.landmarks_of(df, 5)
    assert len(marks) == 2
    got = C.nystrom_map(df, np.vstack([marks, marks]), "rbf", 1.0).collect()          # a singular kernel matrix
    assert sum(r.nystrom is None for r in got) == 1 and all(len(r.nystrom) == 4 for r in got if r.nystrom)
    with pytest.raises(ValueError):
        C.kernel_matrix(marks, marks, "sigmoid", 1.0)
