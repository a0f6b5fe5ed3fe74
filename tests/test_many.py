"""Many-model k-means and mixtures against plain numpy, and the checks of their queries on broken models."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orchard.operators import many
from orchard.operators.cluster import cluster_sweep, gmm, gmm_centres, kmeans
from orchard.operators.evaluate import calinski_harabasz, cluster_scores, silhouette
from orchard.session import ship_package


@pytest.fixture(scope="module")
def blobs(spark):
    ship_package(spark)
    rng = np.random.default_rng(3)
    centres = np.array([[0, 0, 0], [6, 0, 1], [0, 7, -2], [5, 5, 5]])
    x = np.concatenate([c + rng.normal(0, 0.7, (n, 3)) for c, n in zip(centres, (200, 60, 90, 50))])
    y = np.repeat(np.arange(4), (200, 60, 90, 50))
    df = spark.createDataFrame([(i, [float(v) for v in r], int(t)) for i, (r, t) in enumerate(zip(x, y))],
                               "id long, features array<double>, label int").repartition(5, "id").cache()
    return df, x, y


def plain_lloyd(x, c, tol):
    for n in range(1, 101):
        at = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
        new = np.array([x[at == j].mean(0) if (at == j).any() else c[j] for j in range(len(c))])
        moved, c = ((new - c) ** 2).sum(), new
        if moved <= tol:
            break
    return c, ((x[:, None] - c[None]) ** 2).sum(2).min(1).sum(), n


def test_lloyd_of_many_models_equals_one_at_a_time(blobs):
    df, x, _ = blobs
    models = [many.Centres(x[s:s + k].copy(), k) for k in (1, 2, 4, 7) for s in (0, 230)]
    begin = [m.centres.copy() for m in models]
    many.lloyd(many.vectors(df, "features"), models)
    for m, c in zip(models, begin):
        want, cost, n = plain_lloyd(x, c, 1e-4 * x.var(0).mean())
        assert np.allclose(m.centres, want) and m.cost == pytest.approx(cost) and m.n_iter == n and m.sizes.sum() == len(x)


def test_starts_are_drawn_by_squared_distance(blobs):
    df, x, _ = blobs
    pts = many.vectors(df, "features", F.xxhash64("id").alias("_h"))
    got = many.starts(pts, 4, range(40))
    again = many.starts(pts.repartition(3), 4, range(40))
    assert all((got[s] == again[s]).all() for s in got)                      # not by layout
    true = np.array([[0, 0, 0], [6, 0, 1], [0, 7, -2], [5, 5, 5]])
    hit = [len({int(((c - true) ** 2).sum(1).argmin()) for c in got[s]}) for s in got]
    rand = many.starts(pts, 4, range(40), init="random")
    hit_random = [len({int(((c - true) ** 2).sum(1).argmin()) for c in rand[s]}) for s in rand]
    assert np.mean(hit) > 3.5 > np.mean(hit_random)                          # spread out; the random ones follow the sizes


def test_kmeans_finds_the_blobs_and_repeated_points_do_not_fail(spark, blobs):
    df, x, y = blobs
    a, model, cost, _ = kmeans(df, 4, n_init=3)
    assert cluster_scores(a, "label", "cluster").first()["adjusted_rand"] > 0.95
    same = spark.createDataFrame([([1.0, 2.0],)] * 9 + [(None,)], "features array<double>")
    a, _, cost, _ = kmeans(same, 3)
    assert cost == 0 and a.where("cluster is null").count() == 1


def plain_em(x, w, mu, cov, reg=1e-6):
    from math import log, pi
    lj = np.stack([np.log(w[j]) - 0.5 * (np.log(np.linalg.det(cov[j])) + x.shape[1] * log(2 * pi)
                   + np.einsum("ij,jk,ik->i", x - mu[j], np.linalg.inv(cov[j]), x - mu[j])) for j in range(len(w))], 1)
    z = np.log(np.exp(lj - lj.max(1, keepdims=True)).sum(1)) + lj.max(1)
    r = np.exp(lj - z[:, None])
    n = r.sum(0)
    new = (r.T @ x) / n[:, None]
    c = np.stack([(r[:, j, None] * (x - new[j])).T @ (x - new[j]) / n[j] + reg * np.eye(x.shape[1]) for j in range(len(w))])
    return n / len(x), new, c, z.mean()


def test_em_steps_equal_plain_numpy(blobs):
    df, x, _ = blobs
    pts = many.vectors(df, "features")
    fit = many.Centres(x[[0, 210, 300]].copy(), 3)
    m = many.mixtures_from(pts, [fit])[0]
    for _ in range(3):
        w, mu, cov, level = many.em_once(pts, {0: m})[0]
        for got, want in zip((w, mu, cov, level), plain_em(x, m.weights, m.means, m.covariances)):
            assert np.allclose(got, want, atol=1e-9)
        m = many.Mixture(w, mu, cov)


def test_gmm_level_never_falls_and_centres_have_ids(spark, blobs):
    df, x, _ = blobs
    a, model, level = gmm(df, 4, n_init=3)
    assert all(b >= a - 1e-6 for a, b in zip(model.trace, model.trace[1:])) and level == model.trace[-1]
    assert cluster_scores(a, "label", "cluster").first()["adjusted_rand"] > 0.95
    rows = gmm_centres(spark, model).collect()
    assert [r.component for r in rows] == [0, 1, 2, 3] and sum(r.weight for r in rows) == pytest.approx(1)


def test_sweep_rows_equal_the_operators(blobs):
    df, x, _ = blobs
    got = {(r.method, r.k, r.n_init): r for r in cluster_sweep(df, range(1, 5), n_inits=(1, 3), em_init=2).collect()}
    assert len(got) == 12 and got["kmeans", 1, 1].calinski_harabasz is None and got["kmeans", 1, 1].silhouette is None
    a, _, cost, _ = kmeans(df, 4, n_init=3)
    row = got["kmeans", 4, 3]
    assert row.cost == pytest.approx(cost) and row.n == len(x)
    assert row.calinski_harabasz == pytest.approx(calinski_harabasz(a, "features", "cluster").first()["calinski_harabasz"])
    assert row.silhouette == pytest.approx(silhouette(a, "id", "features", "cluster", len(x)).first()["silhouette"])
    assert row.adjusted_mutual_info == pytest.approx(cluster_scores(a, "label", "cluster").first()["adjusted_mutual_info"])
    assert all(got["kmeans", k, 3].cost <= got["kmeans", k, 1].cost for k in range(1, 5))


def test_checks_fail_on_broken_models(blobs):
    """The rows of the green checks change when the model is wrong."""
    from orchard.plans.catalog_checks import kmeans_holds, mixture_holds
    df, x, _ = blobs
    a, model, cost, _ = kmeans(df, 4, n_init=3)
    right = kmeans_holds(df, a, model, cost).first()
    assert (right.misplaced, right.cost_agrees, right.settled) == (0, True, True)
    assert not kmeans_holds(df, a, model, cost * 1.01).first().cost_agrees
    off = many.Centres(model.centres + [0.5, 0, 0], 4)
    assert not kmeans_holds(df, a, off, cost).first().settled
    assert kmeans_holds(df, a.withColumn("cluster", (F.col("cluster") + 1) % 4), model, cost).first().misplaced == len(x)
    single, four = gmm(df, 1, n_init=1)[1], gmm(df, 4, n_init=2)[1]
    right = mixture_holds(df, "features", single, four).first()
    assert (right.falls, right.settled, right.better_than_one) == (0, True, True)
    broken = many.Mixture(four.weights, four.means + 0.5, four.covariances, trace=[-1.0, *four.trace])
    wrong = mixture_holds(df, "features", four, broken).first()
    assert wrong.falls == 1 and not wrong.settled and not wrong.better_than_one


def test_sums_longer_than_a_row_meet_as_whole_arrays(spark):
    """Sums of any length come back whole, for every (model, part) that a task has seen."""
    rng = np.random.RandomState(3)
    x = rng.normal(size=(300, 3))
    pts = many.vectors(spark.createDataFrame([(list(map(float, v)),) for v in x], "features array<double>").repartition(5), "features")

    def step(v, _):
        yield (0, -1), np.array([len(v), v.sum()])
        yield (7, 2), np.tile(v.sum(0), many.PIECE)
        if (v[:, 0] > 2.4).any():
            yield (8, 0), np.array([(v[:, 0] > 2.4).sum()], float)

    got = many.scan_sums(pts, step)
    assert set(got) == {(0, -1), (7, 2), (8, 0)} and got[8, 0] == [(x[:, 0] > 2.4).sum()]
    assert got[0, -1] == pytest.approx([300, x.sum()]) and got[7, 2] == pytest.approx(np.tile(x.sum(0), many.PIECE))
    assert many.scan_sums(pts.where("false"), step) == {}


def test_a_table_in_one_piece_is_dealt_over_the_cores(spark):
    """Equal rows too: a group of copies is not one task."""
    one = spark.createDataFrame([([1.0, 2.0],)] * 400, "features array<double>").coalesce(1)
    pts = many.held(many.vectors(one, "features"))
    try:
        sizes = pts.rdd.glom().map(len).collect()
        assert len(sizes) == spark.sparkContext.defaultParallelism and sum(sizes) == 400 and min(sizes) > 0
    finally:
        pts.unpersist()


def test_all_models_are_measured_as_each_alone(spark, blobs):
    """Lloyd moves and EM sums of many models at once are those of one model at a time; equal centres and a mixture that
    is too narrow to multiply out are among them."""
    df, x, _ = blobs
    points = many.held(many.vectors(df, "features"))
    rng = np.random.default_rng(5)
    centres = {i: x[rng.choice(len(x), k, replace=False)].copy() for i, k in enumerate((1, 2, 4, 4, 4, 2))}
    centres[3][1] = centres[3][0]
    moved, alone = many.moved_centres(points, centres), many.lloyd_once(points, centres)
    assert all(moved[i] == pytest.approx(alone[i][0], abs=1e-12) for i in centres)
    for k, own in many.by_size({i: len(c) for i, c in centres.items()}).items():
        at = many.nearest_of_all(x, np.stack([centres[i] for i in own], axis=1))
        assert all((at[place] == many.nearest(x, centres[i])).all() for place, i in enumerate(own))
    mixtures = {i: many.Mixture(np.full(len(c), 1 / len(c)), c, np.stack([np.eye(3) * (1e-7 if i == 2 else 1 + j) for j in range(len(c))]))
                for i, c in centres.items()}
    step, read = many.em_group_sums(mixtures)
    got, plain = read(many.scan_sums(points, step)), many.scan_sums(points, many.em_sums(mixtures))
    points.unpersist()
    assert set(got) == set(plain) and all(got[key] == pytest.approx(plain[key], rel=1e-9, abs=1e-8) for key in plain)


def test_sums_of_few_tasks_need_no_shuffle(spark, blobs, monkeypatch):
    """The same sums with and without the shuffle; few tasks go without."""
    df, x, _ = blobs
    points = many.vectors(df, "features")

    def step(v, _):
        yield (0, 0), np.tile(v.sum(0), many.PIECE)
    asked = []
    whole = type(points).repartition
    monkeypatch.setattr(type(points), "repartition", lambda self, *a: asked.append(a) or whole(self, *a))
    few = many.scan_sums(points, step)
    assert not asked and few[0, 0] == pytest.approx(np.tile(x.sum(0), many.PIECE))
    monkeypatch.setattr(many, "DIRECT_TASKS", 1)
    met = many.scan_sums(points, step)
    assert asked and met[0, 0] == pytest.approx(few[0, 0])
