"""Back-propagation, solvers and schedules against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orchard.operators import mlp
from orchard.operators.pipelines import base_vs_reduced, cluster_augmented
from orchard.session import ship_package


@pytest.fixture(scope="module")
def ring(spark):
    """Two classes that no plane separates."""
    ship_package(spark)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 3))
    y = (np.hypot(x[:, 0], x[:, 1]) > 1.1).astype(int)
    rows = [(i, [float(v) for v in r], float(t), i % 4 == 0) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, features array<double>, label double, is_test boolean").repartition(4, "id").cache(), x, y


def test_gradient_equals_differences():
    rng = np.random.default_rng(1)
    sizes, x, y = (3, 5, 4, 3), rng.normal(size=(20, 3)), rng.integers(0, 3, 20)
    w = mlp.glorot(sizes, 3) + 0.01
    g = mlp.gradient(w, sizes, x, y)[2:]
    for i in range(0, len(w), 3):
        e = np.zeros_like(w)
        e[i] = 1e-6
        want = (mlp.gradient(w + e, sizes, x, y)[0] - mlp.gradient(w - e, sizes, x, y)[0]) / 2e-6
        assert g[i] == pytest.approx(want, abs=1e-5)


def test_distributed_steps_equal_plain_ones(ring):
    df, x, y = ring
    pts = mlp.points(df, "features", "label")
    for solver in mlp.SOLVERS:
        sizes = (3, 8, 2)
        nets = [mlp.Net(sizes, solver)]
        mlp.train(pts, nets, max_iter=5)
        plain = mlp.Net(sizes, solver)
        for _ in range(5):
            plain.step(mlp.gradient(plain.weights, sizes, x, y))
        assert np.allclose(nets[0].weights, plain.weights, atol=1e-12)


def test_adam_and_nesterov_updates():
    g = np.array([0.5, -2.0, 0.25])
    net = mlp.Net((1, 1), "adam", weights=np.zeros(2))
    net.step(np.r_[1.0, 1.0, g[:2]], alpha=0.0)
    assert np.allclose(net.weights, -mlp.RATE * np.sign(g[:2]), rtol=1e-6)          # first adam step: rate times sign
    net = mlp.Net((1, 1), "sgd", weights=np.zeros(2))
    net.step(np.r_[1.0, 2.0, g[:2]], alpha=0.0)
    assert np.allclose(net.weights, -mlp.RATE * 1.9 * g[:2] / 2)
    penal = mlp.Net((1, 1), "sgd", weights=np.ones(2))
    penal.step(np.r_[1.0, 1.0, 0.0, 0.0], alpha=0.5)
    assert penal.weights[0] < 1 and penal.weights[1] == 1                           # biases are not penalised


def test_schedules():
    down = mlp.Net((1, 1), "sgd", "invscaling")
    down.end_epoch(1.0, 1, 99)
    assert down.now == pytest.approx(mlp.RATE / 10)
    slow = mlp.Net((1, 1), "sgd", "adaptive")
    fixed = mlp.Net((1, 1), "sgd", "constant")
    for i in range(13):
        slow.end_epoch(1.0, i, i)
        if not fixed.settled:
            fixed.end_epoch(1.0, i, i)
    assert slow.now == pytest.approx(mlp.RATE / 5) and not slow.settled and fixed.settled and fixed.now == mlp.RATE
    with pytest.raises(ValueError):
        mlp.Net((1, 1), "newton")


def test_hash_batches_cover_the_table_once(ring):
    df, x, y = ring
    pts = mlp.points(df, "features", "label")
    w, sizes = mlp.glorot((3, 4, 2), 1), (3, 4, 2)
    parts = [mlp.gradients(pts, {0: (w, sizes)}, 3, b, 5)[0] for b in range(5)]
    again = [mlp.gradients(pts.repartition(2), {0: (w, sizes)}, 3, b, 5)[0] for b in range(5)]
    other = [mlp.gradients(pts, {0: (w, sizes)}, 4, b, 5)[0] for b in range(5)]
    assert np.allclose(sum(parts), mlp.gradient(w, sizes, x, y)) and np.allclose(parts, again)
    assert [p[1] for p in parts] != [p[1] for p in other] and min(p[1] for p in parts) > 40


def test_nets_learn_and_stages_are_shorter_runs(ring):
    df, x, y = ring
    tr, te = df.where(~F.col("is_test")), df.where(F.col("is_test"))
    scored, nets, _ = mlp.mlp_solvers(tr, te, [("adam", "constant"), ("sgd", "constant")], (30,), 40, 4, (5, 40))
    acc = {(r.solver, r.iterations): r.a for r in scored.groupBy("solver", "iterations").agg(
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("a")).collect()}
    assert acc["adam", 40] > 0.8 and len(acc) == 4
    short = [mlp.Net(nets[0].sizes, "adam")]
    mlp.train(mlp.points(tr, "features", "label"), short, 5, 4)
    assert np.allclose(short[0].weights, nets[0].stages[5], atol=1e-12)


def test_null_rows_and_an_empty_table(spark, ring):
    df, *_ = ring
    odd = df.unionByName(spark.createDataFrame([(-1, None, 1.0, False), (-2, [0.0, 0.0, 0.0], None, False), (-3, None, None, True)], df.schema))
    scored, _, _ = mlp.mlp_solvers(odd.where(~F.col("is_test")), odd.where(F.col("is_test")), max_iter=2)
    assert scored.where("prediction is null").count() == 1
    net = mlp.Net((3, 4, 2))
    mlp.train(mlp.points(df.limit(0), "features", "label"), [net], 3)
    assert net.trace == []


def test_pipelines_have_a_row_per_solver(ring):
    df, *_ = ring
    got = base_vs_reduced(df, 2, ("base", "pca", "grp"), max_iter=5, parallelism=2).collect()
    assert {(r.method, r.solver) for r in got} == {(m, s) for m in ("base", "pca", "grp") for s in ("adam", "lbfgs", "sgd")}
    assert {r.n_features for r in got if r.method == "base"} == {3} and all(r.n == 100 for r in got)
    got = cluster_augmented(df, [2], ("adam",), em_components=2, max_iter=3).collect()
    assert {(r.method, r.k, r.solver) for r in got} == {("kmeans", 2, "adam"), ("em", 2, "adam")}
