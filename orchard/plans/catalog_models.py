"""Registered queries for fitted models (rows-only checks).

Fits are iterative or randomly initialised, so there is no SQL twin; the
tests hold metric floors and invariants instead (see tests/).
"""

from __future__ import annotations

import functools
import time
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.operators import classify as C
from orchard.operators import many
from orchard.operators import mdp as M
from orchard.operators import reduce as R
from orchard.operators import trees
from orchard.operators.cluster import cluster_sweep, gmm, gmm_centres, kmeans
from orchard.operators.evaluate import classification_scores, cluster_scores
from orchard.operators.mlp import mlp_solvers
from orchard.operators.pipelines import base_vs_reduced, cluster_augmented, reduced
from orchard.operators.scale import standard_scale_vectors, standard_scale_vectors_fit
from orchard.operators.split import learning_sizes_list, stratified_kfold, train_test_split
from orchard.plans.catalog_mdp import GAMMA, on_grid
from orchard.plans.common import SPLIT_SEED, embeddings, r6, t
from orchard.plans.registry import register


def doc_features(spark, sf) -> DataFrame:
    """Binary task (the adult-like set): labelled documents with numeric
    features computed from the whole text: length, words, lines, digit and
    upper-case shares, mean word length.  ``(doc_id, features, label)``."""
    lab = t(spark, sf, "labels")
    docs = t(spark, sf, "documents").select("doc_id", "text", "n_chars")
    d = lab.join(docs, "doc_id")
    txt = F.col("text")
    n = F.greatest(F.length(txt), F.lit(1)).cast("double")
    words = F.size(F.split(txt, r"\s+")).cast("double")
    feats = F.array(
        F.log1p(F.col("n_chars").cast("double")),
        F.log1p(words),
        F.log1p(F.size(F.split(txt, "\n")).cast("double")),
        (F.length(F.regexp_replace(txt, r"[^0-9]", "")) / n),
        (F.length(F.regexp_replace(txt, r"[^A-Z]", "")) / n),
        (F.length(F.regexp_replace(txt, r"\s", "")) / F.greatest(words, F.lit(1.0))),
    )
    out = d.select("doc_id", feats.alias("features"), F.col("quality").cast("double").alias("label"))
    return train_test_split(out, "doc_id", 0.3, SPLIT_SEED)


def _scores(pred: DataFrame, avg: str = "binary", by=()) -> DataFrame:
    s = classification_scores(pred, "label", "prediction", by=list(by))
    return s.select(*by, "n", "correct", "accuracy", F.col(f"precision_{avg}").alias("precision"),
                    F.col(f"recall_{avg}").alias("recall"))


# ------------------------------------------------------------------ trees
@register("c1_decision_tree")
def q_c1(spark, sf):
    """Accuracies of trees of depth 3 to 6, whole and pruned; one growth serves all depths."""
    d = doc_features(spark, sf).persist()
    try:
        train, test = d.where(~F.col("is_test")), d.where(F.col("is_test"))
        grown = trees.decision_tree(train, "entropy", 6, min_leaf=10, min_split=10)
        rows = []
        for depth in range(3, 7):
            nodes = grown.cut_off(depth).nodes()
            cut = C.prune_reduced_error(nodes, test)
            hits = [F.avg((F.col("label") == C.tree_expr(nodes, collapsed=c)).cast("double")) for c in (frozenset(), cut)]
            a0, a1 = test.agg(*[h.alias(f"a{i}") for i, h in enumerate(hits)]).first()
            rows.append((depth, len(nodes), len(cut), float(a0) * 100, float(a1) * 100))
    finally:
        d.unpersist()
    return spark.createDataFrame(rows, "max_depth INT, n_nodes INT, n_collapsed INT, accuracy DOUBLE, "
                                       "pruned_accuracy DOUBLE")


@register("c2_tree_nodes")
def q_c2(spark, sf):
    d = doc_features(spark, sf)
    return C.tree_nodes_df(C.decision_tree(d.where(~F.col("is_test")), "entropy", 4, 10))


@register("c3_prune_reduced_error")
def q_c3(spark, sf):
    d = doc_features(spark, sf).persist()
    train, test = d.where(~F.col("is_test")), d.where(F.col("is_test"))
    nodes = C.tree_nodes(C.decision_tree(train, "gini", 6, 10))
    out = []
    for tree, cut in (("whole", set()), ("pruned", C.prune_reduced_error(nodes, test))):
        p = test.withColumn("prediction", C.tree_expr(nodes, collapsed=cut))
        s = _scores(p).withColumn("tree", F.lit(tree)).withColumn("n_collapsed", F.lit(len(cut)))
        out.append(s)
    return out[0].unionByName(out[1])


@register("c4_tree_to_sql")
def q_c4(spark, sf):
    d = doc_features(spark, sf).persist()
    model = C.decision_tree(d.where(~F.col("is_test")), "entropy", 5, 10)
    nodes = C.tree_nodes(model)
    test = d.where(F.col("is_test"))
    ours = test.select("doc_id", C.tree_expr(nodes).alias("prediction"))
    theirs = model.transform(C.to_vector(test)).select("doc_id", F.col("prediction").alias("ml_prediction"))
    return ours.join(theirs, "doc_id")


@register("c5_adaboost_samme_r")
def q_c5(spark, sf):
    """Accuracy after 1 to 200 boosted trees, from one run."""
    d = doc_features(spark, sf).withColumn("is_train", ~F.col("is_test"))
    _, rounds, staged = trees.adaboost_samme_r(d, max(C.ESTIMATOR_POOL), max_depth=1, train_col="is_train", pool=C.ESTIMATOR_POOL, min_leaf=10)
    return spark.createDataFrame([(*s, rounds) for s in staged], "estimators INT, train BOOLEAN, accuracy DOUBLE, rounds INT")


# ------------------------------------------------------------------ networks / SVM / pipelines
def _emb_split(spark, sf):
    e = many.held(embeddings(spark, sf).withColumn("label", F.col("label").cast("double")))
    return e.where(~F.col("is_test")), e.where(F.col("is_test"))


@register("c7_mlp_classify")
def q_c7(spark, sf):
    tr, te = _emb_split(spark, sf)
    out = []
    for solver, iters in (("l-bfgs", 100), ("gd", 200)):
        scored, _, fit_s = C.mlp_classify(tr, te, hidden=(100,), max_iter=iters, solver=solver)
        s = _scores(scored, "micro").withColumn("solver", F.lit(solver)).withColumn("fit_seconds", F.lit(fit_s))
        out.append(s)
    return out[0].unionByName(out[1])


@register("c8_svm_classify")
def q_c8(spark, sf):
    tr, te = _emb_split(spark, sf)
    d = doc_features(spark, sf).persist()
    dtr, dte = d.where(~F.col("is_test")), d.where(F.col("is_test"))
    out = []
    for name, a, b in (("linear", tr, te), ("rbf", dtr, dte), ("poly", dtr, dte)):
        s = C.svm_classify(a, b, name, max_iter=100)
        out.append(_scores(s, "micro").withColumn("kernel", F.lit(name)))
    return out[0].unionByName(out[1]).unionByName(out[2])


#: Numbers of iterations of the sweep, and the compared (solver, rate schedule) pairs (fixed values).
ITERATIONS = (10, 50, 100, 200, 400)
VARIANTS = (("adam", "constant"), ("sgd", "constant"), ("sgd", "invscaling"), ("sgd", "adaptive"))


@register("c7_mlp_solvers")
def q_c7_solvers(spark, sf):
    """Stochastic solvers on scaled features, with the accuracy after every number of epochs, from one run."""
    tr, te = _emb_split(spark, sf)
    means, sds = standard_scale_vectors_fit(tr)
    scaled = [standard_scale_vectors(d, means, sds) for d in (tr, te)]
    scored, nets, _ = mlp_solvers(*scaled, VARIANTS, max_iter=max(ITERATIONS), stages=ITERATIONS)
    return _scores(scored, "micro", by=("solver", "schedule", "iterations"))


REDUCE_K = 10


@register("c11_base_vs_reduced")
def q_c11(spark, sf):
    """Three solvers on the raw features and on four reductions."""
    e = embeddings(spark, sf).withColumn("label", F.col("label").cast("double"))
    return base_vs_reduced(e, REDUCE_K)


@register("c12_cluster_augmented")
def q_c12(spark, sf):
    """Three solvers on features with the row's cluster (k-means, mixture) in front."""
    e = embeddings(spark, sf).withColumn("label", F.col("label").cast("double"))
    return cluster_augmented(e, [2, 5, 10])


# ------------------------------------------------------------------ clustering fits
@register("g1_kmeans")
def q_g1(spark, sf):
    a, model, cost, iters = kmeans(embeddings(spark, sf), 10, n_init=3, seed=1)
    return (cluster_scores(a, "label", "cluster").withColumn("cost", F.lit(cost))
            .withColumn("n_iter", F.lit(iters)))


def whitened(spark, sf, k=5):
    """``vec_id``, ``label`` and ``k`` whitened components as ``features``."""
    red = R.pca(embeddings(spark, sf), k, whiten=True)[0]
    return red.select("vec_id", "label", F.col("reduced").alias("features"))


@register("g4_gmm")
def q_g4(spark, sf):
    a, model, ll = gmm(whitened(spark, sf), 10, n_init=13)
    return cluster_scores(a, "label", "cluster").withColumn("log_likelihood", F.lit(ll))


@register("g5_gmm_centres")
def q_g5(spark, sf):
    return gmm_centres(spark, gmm(whitened(spark, sf), 4, n_init=13)[1], 2)


#: Numbers of clusters of the sweeps, k-means starts per row, mixture starts (fixed values).
SWEEP_K, SWEEP_STARTS, EM_STARTS = range(1, 13), range(1, 11), 13


@register("g6_cluster_sweep")
def q_g6(spark, sf):
    """k-means over the whole vectors for every (k, number of starts); mixtures over five whitened components."""
    def one(method):
        if method == "kmeans":
            return cluster_sweep(embeddings(spark, sf), SWEEP_K, methods=("kmeans",), n_inits=SWEEP_STARTS, seed=1)
        return cluster_sweep(whitened(spark, sf), SWEEP_K, methods=("em",), em_init=EM_STARTS, seed=1)
    with ThreadPool(2) as pool:                    # independent fits: their jobs interleave
        km, em = pool.map(one, ("kmeans", "em"))
    return km.unionByName(em)


@register("g7_reduce_then_cluster")
def q_g7(spark, sf):
    """Four reductions, each swept over every k with one k-means start and with mixtures."""
    e = many.held(embeddings(spark, sf).where(~F.col("is_test")))

    def one(method):
        red = reduced(e, method, REDUCE_K).select("vec_id", "label", "features")
        return cluster_sweep(red, SWEEP_K, em_init=EM_STARTS, seed=1).withColumn("reduction", F.lit(method))
    try:
        with ThreadPool(4) as pool:                # independent fits: their jobs interleave
            parts = pool.map(one, ("svd", "pca", "ica", "grp"))
    finally:
        e.unpersist()
    return functools.reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------ reductions
@register("d3_truncated_svd")
def q_d3(spark, sf):
    red, s, V = R.truncated_svd(embeddings(spark, sf), 5)
    return red.select("vec_id", *[r6(F.col("reduced")[i]).alias(f"c{i}") for i in range(5)])


@register("d4_pca_whiten")
def q_d4(spark, sf):
    red = R.pca(embeddings(spark, sf), 5, whiten=True)[0]
    return red.select("vec_id", *[r6(F.col("reduced")[i]).alias(f"c{i}") for i in range(5)])


@register("d5_fast_ica")
def q_d5(spark, sf):
    e = embeddings(spark, sf)
    red, W, iters = R.fast_ica(e, 4, max_iter=100)
    return red.select(*[r6(F.col("reduced")[i]).alias(f"c{i}") for i in range(4)]).withColumn(
        "iterations", F.lit(iters))


@register("d7_project_2d_pca")
def q_d7(spark, sf):
    p = R.project_2d(embeddings(spark, sf), "pca", out="xy")
    return p.select("vec_id", r6(F.col("xy")[0]).alias("x"), r6(F.col("xy")[1]).alias("y"))


# ------------------------------------------------------------------ model selection
def _tree_fit(depth):
    def fit(train):
        model = C.decision_tree(train, "entropy", depth, 10)
        expr = C.tree_expr(C.tree_nodes(model))
        return lambda df: df.withColumn("prediction", expr)
    return fit


@register("e5_cross_val_score")
def q_e5(spark, sf):
    d = stratified_kfold(doc_features(spark, sf), "label", "doc_id", 5).persist()
    return C.cross_val_score(_tree_fit(4), d, 5)


@register("e6_learning_curve")
def q_e6(spark, sf):
    d = stratified_kfold(doc_features(spark, sf), "label", "doc_id", 5).persist()
    n_max = d.where(F.col("fold") != 0).count()
    sizes = learning_sizes_list(n_max, 11)
    return C.learning_curve(_tree_fit(3), d, "doc_id", 5, sizes)


@register("e8_elapsed")
def q_e8(spark, sf):
    tr, te = _emb_split(spark, sf)
    t0 = time.time()
    model = C.decision_tree(tr, "gini", 5, 10)
    fit_s = time.time() - t0
    t0 = time.time()
    n = model.transform(C.to_vector(te)).count()
    pred_s = time.time() - t0
    return spark.createDataFrame([(fit_s, pred_s, n)], "fit_seconds DOUBLE, predict_seconds DOUBLE, n BIGINT")


# ------------------------------------------------------------------ MDP
@register("m10_policy_iteration")
@on_grid
def q_m10(cells, states, tp):
    v, policy, rounds = M.policy_iteration(tp, states, GAMMA, e_iters=20, p_iters=100, cells=cells)
    return v.join(policy, ["x", "y"]).select("x", "y", r6("v").alias("v"), "a").withColumn("rounds", F.lit(rounds))
