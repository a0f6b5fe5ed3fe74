"""Level-wise trees and boosting against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orchard.operators import classify as C
from orchard.operators import trees
from orchard.session import ship_package


@pytest.fixture(scope="module")
def data(spark):
    ship_package(spark)
    rng = np.random.default_rng(6)
    x = np.column_stack([rng.integers(0, 40, 500), rng.integers(0, 5, 500), rng.integers(0, 60, 500) / 8]).astype(float)
    y = ((x[:, 0] > 20) ^ (x[:, 1] >= 3)).astype(int) + (x[:, 2] > 5)
    y[rng.random(500) < 0.1] = 0
    rows = [(i, [float(v) for v in r], float(t), i % 4 != 0) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, features array<double>, label double, train boolean").repartition(4, "id").cache(), x, y


def imp(y, w, kind):
    p = np.array([w[y == c].sum() for c in range(3)]) / w.sum()
    p = p[p > 0]
    return 1 - (p * p).sum() if kind == "gini" else -(p * np.log2(p)).sum()


def plain(x, y, w, kind, depth, min_leaf, min_split):
    """Nested (feature, threshold, left, right) or class weights, trying every cut."""
    leaf = [w[y == c].sum() for c in range(3)]
    if depth == 0 or len(y) < min_split or sum(v > 0 for v in leaf) < 2:
        return leaf
    best = (1e-12, None, None)
    for f in range(x.shape[1]):
        v = ALL[f]
        for thr in (v[1:] + v[:-1]) / 2:
            m = x[:, f] <= thr
            if min(m.sum(), (~m).sum()) < max(1, min_leaf):
                continue
            gain = round(imp(y, w, kind) - (w[m].sum() * imp(y[m], w[m], kind) + w[~m].sum() * imp(y[~m], w[~m], kind)) / w.sum(), 12)
            if gain > best[0]:
                best = (gain, f, thr)
    if best[1] is None:
        return leaf
    m = x[:, best[1]] <= best[2]
    return (best[1], best[2], *(plain(x[k], y[k], w[k], kind, depth - 1, min_leaf, min_split) for k in (m, ~m)))


def nested(t, i=0):
    if t.feature[i] < 0:
        return list(t.weight[i])
    return (t.feature[i], t.cuts[t.feature[i]][t.cut[i]], nested(t, t.left[i]), nested(t, t.right[i]))


def same(a, b):
    if isinstance(b, list):
        assert isinstance(a, list) and np.allclose(a, b)
    else:
        assert a[0] == b[0] and a[1] == pytest.approx(b[1])
        same(a[2], b[2])
        same(a[3], b[3])


def test_trees_equal_trying_every_cut(data):
    global ALL
    df, x, y = data
    ALL = [np.unique(x[:, f]) for f in range(3)]
    for kind, leaf, split in (("gini", 1, 2), ("entropy", 10, 40)):
        t = trees.decision_tree(df, kind, 4, leaf, split)
        same(nested(t), plain(x, y, np.ones(len(y)), kind, 4, leaf, split))
        for depth in (1, 2, 3):
            same(nested(t.cut_off(depth)), plain(x, y, np.ones(len(y)), kind, depth, leaf, split))
    assert trees.decision_tree(df, "gini", 5, min_leaf=1, min_split=600).feature == [-1]      # min_split of its own


def test_node_records_score_and_prune(data):
    df, x, y = data
    t = trees.decision_tree(df, "gini", 5, 5, 10)
    nodes = t.nodes()
    got = df.select("id", C.tree_expr(nodes).alias("p")).orderBy("id").toPandas()["p"].to_numpy()
    at = t.route(trees.binned(x, t.cuts))
    assert (got == np.array([n["prediction"] for n in nodes])[at]).all()
    assert C.prune_reduced_error(nodes, df.where("not train")) <= {n["id"] for n in nodes}
    assert sum(n["count"] for n in nodes if n["left"] < 0) == len(y)


def plain_boost(x, y, train, rounds):
    from math import log
    w, k = np.ones(train.sum()) / train.sum(), 3
    f, out = np.zeros((len(y), k)), []
    for _ in range(rounds):
        t = plain(x[train], y[train], w, "gini", 1, 1, 2)

        def leaf(r, t=t):
            while not isinstance(t, list):
                t = t[2] if r[t[0]] <= t[1] else t[3]
            return [log(max(v / sum(t), trees.EPS)) for v in t]
        lp = np.array([leaf(r) for r in x])
        code = np.where(np.arange(k)[None] == y[:, None], 1.0, -1.0 / (k - 1))
        w = w * np.exp(-(k - 1) / k * (code * lp).sum(1)[train])
        w /= w.sum()
        f += (k - 1) * (lp - lp.mean(1, keepdims=True))
        out.append(f.argmax(1))
    return out


def test_boosting_equals_plain_rounds_across_checkpoints(data):
    global ALL
    df, x, y = data
    train = np.arange(len(y)) % 4 != 0
    ALL = [np.unique(x[train, f]) for f in range(3)]
    want = plain_boost(x, y, train, 7)
    scored, rounds, staged = trees.adaboost_samme_r(df, 7, train_col="train", pool=[1, 3, 7, 50], checkpoint_every=3)
    assert rounds == 7 and [s[:2] for s in staged] == [(p, t) for p in (1, 3, 7) for t in (False, True)]
    for p, side, acc in staged:
        assert acc == pytest.approx((want[p - 1] == y)[train == side].mean())
    assert (scored.orderBy("id").toPandas()["prediction"].to_numpy(float) == want[-1]).all()


def test_many_distinct_values_nulls_and_empty_tables(spark, data):
    rng = np.random.default_rng(1)
    v = rng.normal(size=4000)
    rows = [([float(a)], float(a > 0.3)) for a in v] + [(None, 1.0), ([0.0], None)]
    df = spark.createDataFrame(rows, "features array<double>, label double")
    t = trees.decision_tree(df, "gini", 1, 1, 2, max_bins=32)
    assert len(t.cuts[0]) <= 31 and abs(t.cuts[0][t.cut[0]] - 0.3) < 0.15 and t.rows[0] == 4000
    empty = trees.decision_tree(df.limit(0))
    assert empty.feature == [-1]
    assert trees.adaboost_samme_r(df.limit(0), 3)[1] == 0
    scored, rounds, _ = trees.adaboost_samme_r(df.where("label is null or features[0] > 0.3"), 3)
    assert rounds == 1 and scored.where("prediction = 1").count() == scored.where("features is not null").count()     # a perfect tree ends it
