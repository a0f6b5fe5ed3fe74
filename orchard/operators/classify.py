"""Classifiers (C1-C5, C7-C12) and model-selection loops.

Fitting uses ``pyspark.ml`` estimators (distributed training); what the
library adds is the reference's experiment logic around them:
reduced-error pruning from holdout leaf counts (one aggregate), the SAMME.R
weight update as an expression (boosting itself and exact trees: ``trees``;
stochastic solvers: ``mlp``), a feed-forward scorer for given weights, feature maps for polynomial /
RBF SVMs, and CV / learning-curve loops built on the hash folds.
"""

from __future__ import annotations

import math
import time
from collections import Counter
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.functions.vectors import dot, vector_literal
from orchard.session import checkpoint_dir, cut_lineage


#: Products (rows times weights) of an evaluation that are worth a task.
TASK_WORK = 500_000


def even(df: DataFrame, weights: int, *columns: str) -> DataFrame:
    """``columns`` of a training table in parts that fit the work of an evaluation with ``weights`` weights, one per core at most.

    An iterative fit runs a job or two per evaluation, hundreds of times: a
    table in one part leaves the cores idle, one in many small parts (of a
    join, say) costs more to schedule than to compute.
    """
    rows, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    return df.select(*columns).repartition(max(1, min(cores, math.ceil(rows * weights / TASK_WORK))))


def to_vector(df: DataFrame, features: str = "features", out: str = "_vec") -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    return df.withColumn(out, array_to_vector(F.col(features).cast("array<double>")))


# ----------------------------------------------------------------------- C1
def decision_tree(df: DataFrame, impurity: str = "entropy", max_depth: int = 5, min_leaf: int = 10,
                  features: str = "features", label: str = "label", max_bins: int = 32, seed: int = 19,
                  weight_col: str | None = None):
    """``DecisionTreeClassifier``; min_leaf=10 implies the reference's
    min_split=10 (a split needs two leaves of >= 10 rows)."""
    from pyspark.ml.classification import DecisionTreeClassifier
    kw = dict(featuresCol="_vec", labelCol=label, impurity=impurity, maxDepth=min(max_depth, 30),
              minInstancesPerNode=min_leaf, maxBins=max_bins, seed=seed)
    if weight_col:
        kw["weightCol"] = weight_col
    return DecisionTreeClassifier(**kw).fit(to_vector(df, features))


# ----------------------------------------------------------------------- C2
def tree_nodes(model, spark: SparkSession | None = None) -> list[dict]:
    """The fitted tree as node records (id, prediction, left, right,
    feature, threshold), read from the model's own saved node table.  The
    model is written under the shared checkpoint folder."""
    ss = spark or SparkSession.active()
    path = f"{checkpoint_dir(ss)}/tree-{model.uid}-{time.time_ns()}"
    model.write().overwrite().save(path)
    rows = ss.read.parquet(f"{path}/data").collect()        # one row per node (tree-sized)
    out = []
    for r in rows:
        nd = r["nodeData"] if "nodeData" in r.asDict() else r
        sp = nd["split"]
        internal = nd["leftChild"] >= 0 and sp is not None
        thr = sp["leftCategoriesOrThreshold"] if internal else None
        if internal and sp["numCategories"] >= 0:
            raise ValueError("categorical splits are not supported (features are continuous)")
        out.append({"id": nd["id"], "prediction": float(nd["prediction"]), "left": nd["leftChild"],
                    "right": nd["rightChild"], "feature": sp["featureIndex"] if internal else -1,
                    "threshold": float(thr[0]) if internal else None,
                    "count": float(nd["rawCount"]) if "rawCount" in nd.asDict() else None})
    return out


def tree_nodes_df(model, spark: SparkSession | None = None) -> DataFrame:
    ss = spark or SparkSession.active()
    return ss.createDataFrame(tree_nodes(model, ss),
                              "id INT, prediction DOUBLE, left INT, right INT, feature INT, threshold DOUBLE, "
                              "count DOUBLE")


# ----------------------------------------------------------------------- C4
def tree_expr(nodes: list[dict], features: str = "features", output: str = "prediction",
              collapsed: set[int] | frozenset = frozenset()) -> Column:
    """C4: the tree as one nested CASE expression (JVM, codegen) returning
    the leaf's prediction or the leaf's node id; ``collapsed`` nodes act as
    leaves (pruning)."""
    by_id = {n["id"]: n for n in nodes}
    x = F.col(features).cast("array<double>")
    root = min(by_id)

    def build(i):
        n = by_id[i]
        if n["left"] < 0 or i in collapsed:
            return F.lit(float(n["prediction"])) if output == "prediction" else F.lit(int(i))
        return F.when(x[n["feature"]] <= F.lit(float(n["threshold"])), build(n["left"])).otherwise(build(n["right"]))
    return build(root)


# ----------------------------------------------------------------------- C3
def prune_reduced_error(nodes: list[dict], holdout: DataFrame, features: str = "features",
                        label: str = "label") -> set[int]:
    """Reduced-error pruning on a holdout table.

    A node becomes a leaf when it then classifies at least as many of the
    holdout rows that reach it as its pruned subtree does.  The rows are
    routed once and counted per (leaf, label) - one aggregate of #leaves x
    #classes rows; the rest is one bottom-up pass over the node table.
    Returns the nodes that become leaves (the topmost ones).
    """
    reached = {n["id"]: Counter() for n in nodes}
    leaf = tree_expr(nodes, features, output="leaf")
    for r in (holdout.select(leaf.alias("leaf"), F.col(label).cast("double").alias("y"))
                     .groupBy("leaf", "y").count().collect()):
        reached[r["leaf"]][r["y"]] += r["count"]
    hits, cut = {}, set()
    for n in sorted(nodes, key=lambda n: -n["id"]):        # children carry larger ids than their parent
        i, sides = n["id"], (n["left"], n["right"])
        if n["left"] < 0:
            hits[i] = reached[i][n["prediction"]]
            continue
        reached[i] = reached[sides[0]] + reached[sides[1]]
        hits[i] = max(reached[i][n["prediction"]], hits[sides[0]] + hits[sides[1]])
        if hits[i] == reached[i][n["prediction"]]:
            cut.add(i)
    by_id = {n["id"]: n for n in nodes}
    top, walk = set(), [min(by_id)]
    while walk:
        i = walk.pop()
        if i in cut:
            top.add(i)
        elif by_id[i]["left"] >= 0:
            walk += [by_id[i]["left"], by_id[i]["right"]]
    return top


# ----------------------------------------------------------------------- C5
ESTIMATOR_POOL = [1, 2, 5, 10, 20, 40, 80, 100, 150, 200]   # fixed values of the reference's sweep


def samme_r_step(s: DataFrame, k: int, learning_rate: float = 1.0, label: str = "label", log_probs: str = "_lp",
                 weight: str = "_w", decision: str = "_f") -> DataFrame:
    """C5, one round of SAMME.R (Zhu et al., 2009) from the log class
    probabilities of a fitted tree: the weight of a row is multiplied by
    exp(-rate (k-1)/k y.log p), with y = 1 for its class and -1/(k-1) for the
    others, and the decision function gains rate (k-1)(log p - mean log p)."""
    mean_lp = F.aggregate(log_probs, F.lit(0.0), lambda a, x: a + x) / k
    h = F.transform(log_probs, lambda lp: F.lit(k - 1.0) * (lp - mean_lp))
    ylp = F.aggregate(F.transform(log_probs, lambda lp, i: F.when(i == F.col(label).cast("int"), lp)
                                  .otherwise(-lp / (k - 1))), F.lit(0.0), lambda a, x: a + x)
    s = s.withColumn(weight, F.col(weight) * F.exp(F.lit(-learning_rate * (k - 1.0) / k) * ylp))
    return s.withColumn(decision, F.zip_with(decision, h, lambda a, b: a + F.lit(learning_rate) * b))


# ----------------------------------------------------------------------- C7
def mlp_classify(train: DataFrame, test: DataFrame, hidden: Sequence[int] = (100,), max_iter: int = 200,
                 solver: str = "l-bfgs", step_size: float = 0.03, features: str = "features", label: str = "label",
                 seed: int = 1):
    """``MultilayerPerceptronClassifier`` (sigmoid hidden layers,
    softmax output); solvers ``l-bfgs`` or ``gd`` (``sgd`` maps to gd).
    Returns (scored test, model, fit seconds)."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    solver = "gd" if solver in ("sgd", "gd") else "l-bfgs"
    d = len(train.select(features).first()[0])
    k = int(train.agg(F.max(label)).first()[0]) + 1
    t0 = time.time()
    model = MultilayerPerceptronClassifier(layers=[d, *hidden, max(k, 2)], maxIter=max_iter, solver=solver,
                                           stepSize=step_size, seed=seed, featuresCol="_vec",
                                           labelCol=label).fit(to_vector(train, features))
    fit_s = time.time() - t0
    scored = model.transform(to_vector(test, features)).drop("_vec", "rawPrediction", "probability")
    return scored, model, fit_s


# ----------------------------------------------------------------------- C8
def rff_matrix(d: int, n_components: int, gamma: float, seed: int):
    """Random Fourier features for exp(-gamma |x-y|^2): W ~ N(0, 2 gamma),
    b ~ U(0, 2 pi) from a seeded generator."""
    rng = np.random.RandomState(seed)
    W = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_components, d))
    b = rng.uniform(0.0, 2 * math.pi, size=n_components)
    return W, b


def rff_map(df: DataFrame, n_components: int, gamma: float | None = None, seed: int = 1,
            features: str = "features", out: str = "rff") -> DataFrame:
    """C8 (feature map): sqrt(2/D) cos(W x + b), a matrix product per batch of rows.  A null vector maps to null."""
    d = len(df.where(F.col(features).isNotNull()).select(features).first()[0])
    W, b = rff_matrix(d, n_components, gamma if gamma is not None else 1.0 / d, seed)
    sc = math.sqrt(2.0 / n_components)

    @F.pandas_udf("array<double>")
    def mapped(col: pd.Series) -> pd.Series:
        got = pd.Series([None] * len(col), index=col.index, dtype=object)
        have = np.flatnonzero(col.notna().to_numpy())
        for a in range(0, len(have), 1024):
            x = np.vstack(col.iloc[have[a:a + 1024]].to_numpy()).astype(float)
            got.iloc[have[a:a + 1024]] = list(sc * np.cos(x @ W.T + b))
        return got
    return df.withColumn(out, mapped(F.col(features).cast("array<double>")))


def kernel_matrix(x: np.ndarray, y: np.ndarray, kernel: str, gamma: float, degree: int = 3, coef0: float = 0.0) -> np.ndarray:
    """``rbf``: exp(-gamma |x - y|^2); ``poly``: (gamma x.y + coef0)^degree."""
    if kernel == "poly":
        return (gamma * (x @ y.T) + coef0) ** degree
    if kernel == "rbf":
        return np.exp(-gamma * ((x[:, None, :] - y[None]) ** 2).sum(2))
    raise ValueError(f"unknown kernel {kernel!r}")


def landmarks_of(df: DataFrame, n: int, features: str = "features") -> np.ndarray:
    """``n`` distinct vectors in hash order (``n`` is the bound of the map's size)."""
    v = df.where(F.col(features).isNotNull()).select(F.col(features).cast("array<double>").alias("x")).distinct()
    return np.array([r["x"] for r in v.orderBy(F.xxhash64("x"), "x").limit(n).collect()], float)


def nystrom_map(df: DataFrame, landmarks: np.ndarray, kernel: str, gamma: float, degree: int = 3, coef0: float = 0.0,
                features: str = "features", out: str = "nystrom", rank_tol: float = 1e-10) -> DataFrame:
    """C8 (feature map): k(x, landmarks) K^(-1/2), whose dot products are the kernel projected on the landmarks
    (exact between landmarks).  One column per landmark whatever the degree; directions of K below ``rank_tol`` of the
    largest are 0.  A null vector maps to null."""
    vals, vecs = np.linalg.eigh(kernel_matrix(landmarks, landmarks, kernel, gamma, degree, coef0))
    keep = vals > rank_tol * max(vals.max(), 0.0)
    back = vecs[:, keep] / np.sqrt(vals[keep])

    @F.pandas_udf("array<double>")
    def mapped(col: pd.Series) -> pd.Series:
        got = pd.Series([None] * len(col), index=col.index, dtype=object)
        have = np.flatnonzero(col.notna().to_numpy())
        for a in range(0, len(have), 1024):
            x = np.vstack(col.iloc[have[a:a + 1024]].to_numpy()).astype(float)
            z = kernel_matrix(x, landmarks, kernel, gamma, degree, coef0) @ back
            got.iloc[have[a:a + 1024]] = list(np.hstack([z, np.zeros((len(x), len(landmarks) - z.shape[1]))]))
        return got
    return df.withColumn(out, mapped(F.col(features).cast("array<double>")))


def svm_classify(train: DataFrame, test: DataFrame, kernel: str = "linear", features: str = "features",
                 label: str = "label", max_iter: int = 100, reg: float = 0.0, rff_components: int = 256,
                 seed: int = 1, landmarks: int | None = None):
    """``LinearSVC`` (one-vs-rest for more than two classes) on the raw
    features, a degree-3 polynomial expansion (``poly``) or random Fourier
    features (``rbf``, gamma = 1/d) - documented approximations of the
    kernel machines.  With ``landmarks`` both kernels (gamma = 1/d, degree 3)
    go through a Nystrom map of so many training rows instead, which stays
    small for wide tables.  Returns the scored test table."""
    from pyspark.ml.classification import LinearSVC, OneVsRest
    from pyspark.ml.feature import PolynomialExpansion
    d = len(train.where(F.col(features).isNotNull()).select(features).first()[0])
    width = landmarks or rff_components if kernel == "rbf" or landmarks and kernel != "linear" else math.comb(d + 3, 3) if kernel == "poly" else d
    tr, te, col = even(train, width, features, label), test, features
    if landmarks and kernel != "linear":
        marks = landmarks_of(train, landmarks, features)
        tr, te = (nystrom_map(d, marks, kernel, 1.0 / marks.shape[1], features=features, out="_rff") for d in (tr, te))
        col, kernel = "_rff", "linear"
    elif kernel == "rbf":
        tr = rff_map(tr, rff_components, seed=seed, features=features, out="_rff")
        te = rff_map(te, rff_components, seed=seed, features=features, out="_rff")
        col = "_rff"
    tr, te = to_vector(tr, col), to_vector(te, col)
    fcol = "_vec"
    if kernel == "poly":
        pe = PolynomialExpansion(degree=3, inputCol="_vec", outputCol="_poly")
        tr, te, fcol = pe.transform(tr), pe.transform(te), "_poly"
    k = int(train.agg(F.max(label)).first()[0]) + 1
    svc = LinearSVC(featuresCol=fcol, labelCol=label, maxIter=max_iter, regParam=reg)
    est = svc if k <= 2 else OneVsRest(classifier=svc, featuresCol=fcol, labelCol=label, parallelism=4)
    model = est.fit(tr)
    return model.transform(te).drop("_vec", "_poly", "_rff", "rawPrediction")


# ----------------------------------------------------------------------- C9 / C10
def nn_weights(layers: Sequence[int], seed: int) -> list[np.ndarray]:
    """Seeded weights (with a bias column) for a feed-forward net."""
    rng = np.random.RandomState(seed)
    return [rng.uniform(-1.0, 1.0, size=(layers[i + 1], layers[i] + 1)) for i in range(len(layers) - 1)]


def nn_forward(df: DataFrame, weights: Sequence[np.ndarray], features: str = "features", out: str = "score",
               hidden_activation: str = "tanh") -> DataFrame:
    """Feed-forward scoring with given weights (bias first in every
    row): hidden layers ``tanh`` (or logistic), logistic output.  The
    weights are literals, so scoring is a projection."""
    x = F.col(features).cast("array<double>")
    layer = [x[i] for i in range(weights[0].shape[1] - 1)]
    for li, W in enumerate(weights):
        last = li == len(weights) - 1
        nxt = []
        for row in W:
            z = F.lit(float(row[0]))
            for wi, xi in zip(row[1:], layer):
                z = z + F.lit(float(wi)) * xi
            if last or hidden_activation == "logistic":
                nxt.append(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))
            else:
                nxt.append(F.tanh(z))
        layer = nxt
    return df.withColumn(out, layer[0] if len(layer) == 1 else F.array(*layer))


def sum_squares_error(df: DataFrame, label: str = "label", score: str = "score", half: bool = False,
                      extra: Sequence[Column] = ()) -> DataFrame:
    """Sum of squared errors (times 1/2 with ``half``), one row;
    ``extra`` aggregates are computed in the same pass."""
    e = F.pow(F.col(label).cast("double") - F.col(score), 2)
    return df.agg((F.sum(e) * (0.5 if half else 1.0)).alias("sse"), F.count(F.lit(1)).cast("bigint").alias("n"), *extra)


def estimator_fit(estimator, features: str = "features") -> Callable:
    """A ``pyspark.ml`` estimator as the ``fit`` function of E5 and E6 (its features column is ``_vec``)."""
    def fit(train):
        model = estimator.fit(to_vector(train, features))
        return lambda df: model.transform(to_vector(df, features))
    return fit


def nearest_mean_fit(features: str = "features", label: str = "label") -> Callable:
    """A deterministic classifier for E5 and E6: the class with the nearest mean, ties to the smaller label."""
    from orchard.operators.neighbours import nearest_centre

    def fit(train):
        m = (train.select(F.col(label).cast("double").alias("y"), F.posexplode(F.col(features).cast("array<double>"))
                          .alias("dim", "x")).groupBy("y", "dim").agg(F.avg("x").alias("c")).orderBy("y", "dim").collect())
        means: dict = {}
        for r in m:                                            # #classes x d numbers
            means.setdefault(r["y"], []).append(r["c"])
        names = F.array(*[F.lit(y) for y in means])

        def predict(df):
            near = nearest_centre(df, list(means.values()), features, "_centre")
            return near.withColumn("prediction", F.get(names, F.col("_centre"))).drop("_centre")
        return predict
    return fit


# ----------------------------------------------------------------------- E5 / E6 / E8
def cross_val_score(fit: Callable[[DataFrame], Callable[[DataFrame], DataFrame]], df_folds: DataFrame,
                    k: int, label: str = "label", fold_col: str = "fold", parallelism: int = 4) -> DataFrame:
    """E5: for every fold, fit on the others and score on it; returns
    ``(fold, accuracy)`` rows plus the mean (fold = -1), as percentages.
    ``fit(train)`` returns a ``predict(df)`` function adding ``prediction``."""
    def one(f):
        pred = fit(df_folds.where(F.col(fold_col) != f))(df_folds.where(F.col(fold_col) == f))
        acc = pred.agg(F.avg((F.col(label) == F.col("prediction")).cast("double"))).first()[0]
        return f, float(acc or 0.0) * 100
    with ThreadPool(parallelism) as pool:
        rows = pool.map(one, range(k))
    rows.append((-1, sum(r[1] for r in rows) / k))
    return df_folds.sparkSession.createDataFrame(rows, "fold INT, accuracy DOUBLE")


def learning_curve(fit: Callable[[DataFrame], Callable[[DataFrame], DataFrame]], df_folds: DataFrame, key: str,
                   k: int, sizes: Sequence[int], label: str = "label", fold_col: str = "fold",
                   seed: int = 17, error: bool = False, parallelism: int = 4) -> DataFrame:
    """Mean train and test accuracy per train size over the k CV
    rounds; the train sample of size m is the nested prefix ``prank < m``
    of one seeded ranking per round (T5).  ``error`` gives 1 - score."""
    from orchard.operators.many import dealt
    from orchard.operators.split import nested_prefix_ranks
    ranks = nested_prefix_ranks(df_folds, key, k, seed, fold_col).select(key, "cv_round", "prank")
    first = ranks.groupBy(key).agg(*[F.min(F.when(F.col("cv_round") == f, F.col("prank"))).alias(f"_p{f}") for f in range(k)])
    placed = dealt(cut_lineage(df_folds.join(first, key, "left"))).persist()      # every sample of the curve is a filter of this table
    hit = (F.col(label) == F.col("prediction")).cast("double")

    def one(job):
        m, f = job
        mine, held_out = F.col(f"_p{f}") < m, F.col(fold_col) == f
        predict = fit(placed.where(mine).drop(*[f"_p{i}" for i in range(k)]))
        got = predict(placed.where(mine | held_out)).agg(F.avg(F.when(mine, hit)), F.avg(F.when(held_out, hit))).first()
        return [float(x or 0.0) for x in got]
    jobs = [(int(m), f) for m in sizes for f in range(k)]
    try:
        with ThreadPool(parallelism) as pool:
            scores = pool.map(one, jobs)
    finally:
        placed.unpersist()
    rows = []
    for m in sizes:
        got = [s for s, (size, _) in zip(scores, jobs) if size == int(m)]
        a, b = (sum(x[i] for x in got) / k for i in (0, 1))
        rows.append((int(m), 1 - a if error else a, 1 - b if error else b))
    return df_folds.sparkSession.createDataFrame(rows, "train_size BIGINT, train_score DOUBLE, test_score DOUBLE")
