"""Curves from additive statistics against one fit per model."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orchard.operators import classify as C
from orchard.operators.curves import nearest_mean_curve, nearest_mean_cv
from orchard.session import ship_package


@pytest.fixture(scope="module")
def folds(spark):
    ship_package(spark)
    rng = np.random.default_rng(4)
    rows = []
    for i in range(240):
        y = [0.0, 3.0, 7.0, 9.0][0 if i % 3 == 0 else 1 + i % 3 if i % 40 else 3]       # a third in one class, one rare class
        rows.append((i, [float(v) for v in rng.normal(y / 4, 1.0, 2)], y, i % 4))
    rows += [(900 + i, None if i == 0 else [0.0, 0.0], None if i == 1 else 0.0, None if i == 2 else 1) for i in range(3)]
    return spark.createDataFrame(rows, "id long, features array<double>, label double, fold int").repartition(3, "id")


def test_curve_equals_one_fit_per_model(folds):
    whole = folds.where("features is not null and label is not null and fold is not null").cache()
    sizes = [1, 2, 17, 90, 180]
    want = C.learning_curve(C.nearest_mean_fit(), whole, "id", 4, sizes).orderBy("train_size").collect()
    got = nearest_mean_curve(folds, "id", 4, sizes).orderBy("train_size").collect()
    for g, w in zip(got, want, strict=True):
        assert g.train_size == w.train_size and g.train_score == pytest.approx(w.train_score) and g.test_score == pytest.approx(w.test_score)
    errors = nearest_mean_curve(folds, "id", 4, sizes, error=True).orderBy("train_size").collect()
    assert [round(e.test_score + g.test_score, 9) for e, g in zip(errors, got)] == [1.0] * 5


def test_cv_equals_one_fit_per_fold(folds):
    whole = folds.where("features is not null and label is not null and fold is not null").cache()
    want = {r.fold: r.accuracy for r in C.cross_val_score(C.nearest_mean_fit(), whole, 4).collect()}
    got = {r.fold: r.accuracy for r in nearest_mean_cv(folds, 4).collect()}
    assert got == pytest.approx(want)


def test_empty_table(folds):
    assert [tuple(r)[1:] for r in nearest_mean_curve(folds.limit(0), "id", 4, [5]).collect()] == [(0.0, 0.0)]


def test_estimator_as_a_fit_function(spark, folds):
    """A pyspark.ml estimator in the same cross-validation as a closure."""
    from pyspark.ml.classification import LogisticRegression
    d = folds.where("features is not null and label is not null and fold is not null").withColumn("label", (F.col("label") > 3).cast("double")).cache()
    fit = C.estimator_fit(LogisticRegression(featuresCol="_vec", maxIter=20))
    rows = {r.fold: r.accuracy for r in C.cross_val_score(fit, d, 4).collect()}
    assert set(rows) == {-1, 0, 1, 2, 3} and rows[-1] > 70 and rows[-1] == pytest.approx(sum(rows[f] for f in range(4)) / 4)


def test_samples_of_a_curve_are_filters_of_one_table(folds):
    """No fit reads a join; every sample has its size and none of the held-out rows."""
    whole = folds.where("features is not null and label is not null and fold is not null").cache()
    seen = []

    def fit(train):
        plan = train._jdf.queryExecution().optimizedPlan().toString()
        ids = {r.id for r in train.select("id").collect()}
        seen.append(("Join" in plan, len(ids), {r.fold for r in train.select("fold").distinct().collect()}))
        return lambda df: df.withColumn("prediction", F.lit(0.0))

    rows = {r.train_size: r for r in C.learning_curve(fit, whole, "id", 4, [5, 180], parallelism=1).collect()}
    assert not any(j for j, _, _ in seen) and sorted(n for _, n, _ in seen) == [5] * 4 + [180] * 4
    assert all(len(f) <= 3 for _, _, f in seen) and set(rows) == {5, 180}
    zeros = whole.groupBy("fold").agg(F.avg((F.col("label") == 0).cast("double")).alias("a")).agg(F.avg("a")).first()[0]
    assert rows[5].test_score == pytest.approx(zeros)
