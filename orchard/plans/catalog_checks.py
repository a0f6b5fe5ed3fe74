"""Registered queries that hold fitted models and their building blocks
against exact SQL: invariants of a fit, single steps from given values, and
deterministic classifiers."""

from __future__ import annotations

import functools
import uuid

import numpy as np
from pyspark.sql import functions as F

from orchard.functions.vectors import euclidean
from orchard.operators import classify as C
from orchard.operators import fitness as FT
from orchard.operators import halo
from orchard.operators import mdp as M
from orchard.operators import mlp as MLP
from orchard.operators import reduce as R
from orchard.operators import trees
from orchard.operators import many
from orchard.operators.cluster import gmm, gmm_centres, inertia, kmeans, lloyd_step
from orchard.operators.curves import nearest_mean_curve
from orchard.operators.neighbours import nearest_centre
from orchard.operators.split import learning_sizes_list, stratified_kfold
from orchard.plans.catalog_mdp import GAMMA, SQL_MDP, on_grid
from orchard.plans.catalog_models import doc_features
from orchard.plans.catalog_unsupervised import SQL_E, _sql_grp
from orchard.plans.common import SPLIT_SEED, TEST_FRAC, embeddings, r6, t
from orchard.plans.registry import register
from orchard.functions.hashing import sql_hash_u32
from orchard.session import checkpoint_dir
from orchard.sources.tables import param_grid, read_labelled_csv

LI = "l_quantity", "l_extendedprice", "l_discount", "l_tax"
LEAF = {"left": -1, "right": -1, "feature": -1, "threshold": None}
#: A given tree over (quantity, price, discount, tax).
TREE = [{"id": 0, "prediction": 0.0, "left": 1, "right": 4, "feature": 0, "threshold": 25.0},
        {"id": 1, "prediction": 0.0, "left": 2, "right": 3, "feature": 2, "threshold": 0.05},
        {"id": 2, "prediction": 1.0, **LEAF}, {"id": 3, "prediction": 0.0, **LEAF},
        {"id": 4, "prediction": 0.0, "left": 5, "right": 6, "feature": 1, "threshold": 50000.0},
        {"id": 5, "prediction": 0.0, **LEAF}, {"id": 6, "prediction": 1.0, **LEAF}]


def _line_items(spark, sf):
    return t(spark, sf, "lineitem").select(F.array(*LI).alias("features"),
                                           F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"))


SQL_LEAVES = """lf AS (SELECT CASE WHEN l_quantity <= 25 THEN CASE WHEN l_discount <= 0.05 THEN 2 ELSE 3 END
                    ELSE CASE WHEN l_extendedprice <= 50000 THEN 5 ELSE 6 END END AS leaf,
               CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS label FROM lineitem)"""


@register("c3_leaf_counts", f"WITH {SQL_LEAVES} SELECT CAST(leaf AS INTEGER) AS leaf, CAST(label AS DOUBLE) AS label, "
          "CAST(count(*) AS BIGINT) AS n FROM lf GROUP BY ALL")
def q_c3_leaves(spark, sf):
    d = _line_items(spark, sf).select(C.tree_expr(TREE, output="leaf").alias("leaf"), "label")
    return d.groupBy("leaf", "label").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@register("c3_pruned_tree", f"""WITH {SQL_LEAVES},
h AS (SELECT count(*) FILTER (WHERE leaf = 2 AND label = 1) AS h2, count(*) FILTER (WHERE leaf = 3 AND label = 0) AS h3,
             count(*) FILTER (WHERE leaf = 5 AND label = 0) AS h5, count(*) FILTER (WHERE leaf = 6 AND label = 1) AS h6,
             count(*) FILTER (WHERE leaf IN (2, 3) AND label = 0) AS o1, count(*) FILTER (WHERE leaf IN (5, 6) AND label = 0) AS o4,
             count(*) FILTER (WHERE label = 0) AS o0 FROM lf),
c AS (SELECT *, o1 >= h2 + h3 AS c1, o4 >= h5 + h6 AS c4, o0 >= greatest(o1, h2 + h3) + greatest(o4, h5 + h6) AS c0 FROM h)
SELECT unnest([0, 1, 4])::INTEGER AS node, unnest([c0, c1 AND NOT c0, c4 AND NOT c0]) AS becomes_leaf FROM c""")
def q_c3_pruned(spark, sf):
    cut = C.prune_reduced_error(TREE, _line_items(spark, sf))
    return spark.createDataFrame([(i, i in cut) for i in (0, 1, 4)], "node INT, becomes_leaf BOOLEAN")


SPLIT_COLS = ("l_quantity", "l_discount", "l_tax")
MIN_LEAF = 10


def _sql_gain(kind: str) -> str:
    imp = {"gini": "(1 - ({r} / {n}) * ({r} / {n}) - (({n} - {r}) / {n}) * (({n} - {r}) / {n}))",
           "entropy": "-(CASE WHEN {r} > 0 THEN {r} / {n} * log2({r} / {n}) ELSE 0 END + CASE WHEN {n} > {r} THEN ({n} - {r}) / {n} * log2(({n} - {r}) / {n}) ELSE 0 END)"}[kind]
    of = lambda n, r: imp.format(n=n, r=r)      # noqa: E731
    return f"""SELECT '{kind}' AS impurity, node, f, thr, nl, nr, {of('(nl + nr)', '(rl + rr)')}
       - (nl * {of('nl', 'rl')} + nr * {of('nr', 'rr')}) / (nl + nr) AS gain FROM c"""


@register("c1_best_splits", f"""WITH r AS (SELECT CASE WHEN l_quantity <= 25 THEN 1 ELSE 2 END AS node, (l_returnflag = 'R')::INT AS y,
       unnest([{', '.join(f'{c}::DOUBLE' for c in SPLIT_COLS)}]) AS x, unnest([0, 1, 2]) AS f FROM lineitem),
v AS (SELECT f, x, lead(x) OVER (PARTITION BY f ORDER BY x) AS nx FROM (SELECT DISTINCT f, x FROM r)),
t AS (SELECT f, x AS last, (x + nx) / 2 AS thr FROM v WHERE nx IS NOT NULL),
h AS (SELECT node, f, x, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS r FROM r GROUP BY ALL),
c AS (SELECT node, t.f, thr, sum(n) FILTER (x <= last) AS nl, coalesce(sum(r) FILTER (x <= last), 0) AS rl,
             sum(n) FILTER (x > last) AS nr, coalesce(sum(r) FILTER (x > last), 0) AS rr FROM h JOIN t USING (f) GROUP BY node, t.f, thr
      HAVING coalesce(sum(n) FILTER (x <= last), 0) >= {MIN_LEAF} AND coalesce(sum(n) FILTER (x > last), 0) >= {MIN_LEAF}),
g AS ({_sql_gain('gini')} UNION ALL {_sql_gain('entropy')}),
b AS (SELECT *, row_number() OVER (PARTITION BY impurity, node ORDER BY round(gain, 12) DESC, f, thr) AS rn FROM g)
SELECT impurity, node::INTEGER AS node, f::INTEGER AS feature, round(thr, 9) AS threshold, nl::BIGINT AS n_left, nr::BIGINT AS n_right,
       round(gain, 9) AS gain FROM b WHERE rn = 1""")
def q_c1_splits(spark, sf):
    """Best cut of both nodes of a level below a given root, by gini and by entropy."""
    li = t(spark, sf, "lineitem").select(F.array(*[F.col(c).cast("double") for c in SPLIT_COLS]).alias("features"),
                                         (F.col("l_returnflag") == "R").cast("int").alias("label"))
    pts = trees.points(li, "features", "label")
    tree = trees.Tree(trees.find_cuts(pts, 64))
    for i, (left, right) in enumerate(((1, 2), (-1, -1), (-1, -1))):
        tree.add(np.ones(2), 0.0, min(i, 1))
        tree.left[i], tree.right[i] = left, right
    tree.feature[0], tree.cut[0] = 0, int(np.searchsorted(tree.cuts[0], 25.0, side="left"))       # quantity <= 25
    rows = []
    for node, (w, n) in trees.level_histograms(pts, tree, [1, 2], 2).items():
        for kind in trees.IMPURITIES:
            f, b, gain = trees.best_split(w, n, kind, MIN_LEAF)
            left = int(n[f, :b + 1].sum())
            rows.append((kind, node, f, round(float(tree.cuts[f][b]), 9), left, int(n[f].sum()) - left, round(gain, 9)))
    return spark.createDataFrame(rows, "impurity STRING, node INT, feature INT, threshold DOUBLE, n_left BIGINT, n_right BIGINT, gain DOUBLE")


SQL_TEST_DOCS = (f"SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS mismatches FROM labels JOIN documents USING (doc_id) "
                 f"WHERE ({sql_hash_u32('doc_id', SPLIT_SEED)} % 100) < {int(TEST_FRAC * 100)}")


@register("c4_tree_expression_agrees", SQL_TEST_DOCS)
def q_c4_agrees(spark, sf):
    d = doc_features(spark, sf).persist()
    model = C.decision_tree(d.where(~F.col("is_test")), "entropy", 5, 10)
    both = model.transform(C.to_vector(d.where(F.col("is_test")))).withColumn("ours", C.tree_expr(C.tree_nodes(model, spark)))
    return both.agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                    F.coalesce(F.sum((F.col("ours") != F.col("prediction")).cast("int")), F.lit(0)).cast("bigint").alias("mismatches"))


@register("c5_samme_r_step", """WITH r AS (SELECT l_quantity <= 25 AS side, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem),
s AS (SELECT side, y, CASE WHEN side THEN 0.6 ELSE 0.3 END AS p0 FROM r),
w AS (SELECT side, y, exp(-0.5 * CASE WHEN y = 0 THEN ln(p0) - ln(1 - p0) ELSE ln(1 - p0) - ln(p0) END) AS w,
             ln(p0) - (ln(p0) + ln(1 - p0)) / 2 AS f0 FROM s)
SELECT side, CAST(y AS INTEGER) AS y, CAST(count(*) AS BIGINT) AS n, round(avg(w), 9) AS weight, round(avg(f0), 9) AS decision0
FROM w GROUP BY side, y""")
def q_c5_step(spark, sf):
    d = t(spark, sf, "lineitem").select((F.col("l_quantity") <= 25).alias("side"),
                                        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"))
    p0 = F.when(F.col("side"), 0.6).otherwise(0.3)
    s = d.withColumn("_lp", F.array(F.log(p0), F.log(1 - p0))).withColumn("_w", F.lit(1.0)).withColumn("_f", F.array(F.lit(0.0), F.lit(0.0)))
    s = C.samme_r_step(s, 2)
    return s.groupBy("side", F.col("label").alias("y")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.round(F.avg("_w"), 9).alias("weight"),
        F.round(F.avg(F.col("_f")[0]), 9).alias("decision0"))


# ------------------------------------------------------------------ model selection with a deterministic classifier
CV = 5
SQL_FOLDS = f"""{SQL_E},
fo AS (SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1) % {CV} AS INTEGER) AS fold FROM e)"""


def _sql_accuracy(train: str, keys: str) -> str:
    """Accuracy of the nearest class mean; ``train`` has the round's keys, label and v."""
    return f"""mu AS (SELECT {keys}, label, dim, avg(x) AS c FROM (SELECT {keys}, label, unnest(v) AS x, unnest(range(0, len(v))) AS dim
       FROM {train}) GROUP BY ALL),
mv AS (SELECT {keys}, label AS cl, list(c ORDER BY dim) AS c FROM mu GROUP BY ALL)"""


_DIST = "list_sum(list_transform(list_zip({}, {}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"


@register("e5_nearest_mean_cv", f"""WITH {SQL_FOLDS},
tr AS (SELECT r.f, fo.* FROM fo JOIN (SELECT unnest(range(0, {CV})) AS f) r ON fo.fold <> r.f),
{_sql_accuracy('tr', 'f')},
pr AS (SELECT fo.fold, fo.vec_id, fo.label, arg_min(mv.cl, ({_DIST.format('fo.v', 'mv.c')}, mv.cl)) AS p
       FROM fo JOIN mv ON mv.f = fo.fold GROUP BY ALL),
ac AS (SELECT fold, avg(CASE WHEN label = p THEN 1.0 ELSE 0.0 END) * 100 AS accuracy FROM pr GROUP BY fold)
SELECT fold, round(accuracy, 6) AS accuracy FROM ac UNION ALL SELECT -1, round(avg(accuracy), 6) FROM ac""")
def q_e5_mean(spark, sf):
    d = stratified_kfold(embeddings(spark, sf), "label", "vec_id", CV).withColumn("label", F.col("label").cast("double")).persist()
    return C.cross_val_score(C.nearest_mean_fit(), d, CV).select("fold", r6("accuracy").alias("accuracy"))


@register("e6_nearest_mean_curve", f"""WITH {SQL_FOLDS},
tr AS (SELECT r.f, fo.*, row_number() OVER (PARTITION BY r.f ORDER BY md5(concat('17:', CAST(vec_id AS VARCHAR))), vec_id) - 1 AS prank
       FROM fo JOIN (SELECT unnest(range(0, {CV})) AS f) r ON fo.fold <> r.f),
n AS (SELECT count(*) AS n FROM fo WHERE fold <> 0),
sz AS (SELECT DISTINCT greatest(1, least(n, CAST(floor(CASE WHEN i = 10 THEN 1.0 ELSE i * 0.09 + 0.1 END * n) AS BIGINT))) AS m
       FROM n, (SELECT unnest(range(0, 11)) AS i)),
ts AS (SELECT sz.m, tr.* FROM tr JOIN sz ON tr.prank < sz.m),
{_sql_accuracy('ts', 'm, f')},
both_ AS (SELECT m, f, 'train' AS part, vec_id, label, v FROM ts
          UNION ALL SELECT sz.m, fo.fold, 'test', vec_id, label, v FROM fo, sz),
pr AS (SELECT b.m, b.f, b.part, b.vec_id, b.label, arg_min(mv.cl, ({_DIST.format('b.v', 'mv.c')}, mv.cl)) AS p
       FROM both_ b JOIN mv ON mv.f = b.f AND mv.m = b.m GROUP BY ALL),
ac AS (SELECT m, f, part, avg(CASE WHEN label = p THEN 1.0 ELSE 0.0 END) AS a FROM pr GROUP BY ALL)
SELECT m AS train_size, round(avg(a) FILTER (WHERE part = 'train'), 6) AS train_score,
       round(avg(a) FILTER (WHERE part = 'test'), 6) AS test_score FROM ac GROUP BY m""")
def q_e6_mean(spark, sf):
    d = stratified_kfold(embeddings(spark, sf), "label", "vec_id", CV).withColumn("label", F.col("label").cast("double")).persist()
    n_max = d.where(F.col("fold") != 0).count()
    got = nearest_mean_curve(d, "vec_id", CV, learning_sizes_list(n_max, 11))
    return got.select("train_size", r6("train_score").alias("train_score"), r6("test_score").alias("test_score"))


# ------------------------------------------------------------------ reductions
SQL_DIMS = f"{SQL_E}, x AS (SELECT unnest(v) AS x, unnest(range(0, len(v))) AS dim FROM e)"


@register("d3_svd_energy", f"WITH {SQL_DIMS} SELECT round(sum(x * x), 6) AS energy, CAST(0.0 AS DOUBLE) AS norm_gap FROM x")
def q_d3_energy(spark, sf):
    """All squared singular values add up to the table's; a projected column's norm is its singular value."""
    red, s, _ = R.truncated_svd(embeddings(spark, sf), 64)
    gap = F.greatest(*[F.abs(F.sqrt(F.sum(F.pow(F.col("reduced")[i], 2))) - F.lit(float(s[i]))) for i in range(5)])
    return red.agg(F.lit(round(float((s ** 2).sum()), 6)).alias("energy"), F.round(F.abs(gap), 6).alias("norm_gap"))


@register("d4_pca_invariants", f"""WITH {SQL_DIMS}, v AS (SELECT dim, var_samp(x) AS s FROM x GROUP BY dim)
SELECT CAST(c AS INTEGER) AS component, (SELECT round(sum(s), 6) FROM v) AS total_variance, CAST(0.0 AS DOUBLE) AS mean,
       CAST(1.0 AS DOUBLE) AS variance, CAST(0.0 AS DOUBLE) AS covariance_with_first FROM (SELECT unnest(range(1, 5)) AS c)""")
def q_d4_invariants(spark, sf):
    e = embeddings(spark, sf)
    red, _, vals = R.pca(e, 64, whiten=True)
    return _whitened(red, 5, total_variance=F.lit(round(float(vals.sum()), 6)))


@register("d5_ica_invariants", """SELECT CAST(c AS INTEGER) AS component, (SELECT CAST(count(*) AS BIGINT) FROM embeddings) AS n,
       CAST(0.0 AS DOUBLE) AS mean, CAST(1.0 AS DOUBLE) AS variance, CAST(0.0 AS DOUBLE) AS covariance_with_first
FROM (SELECT unnest(range(1, 4)) AS c)""")
def q_d5_invariants(spark, sf):
    red, _, _ = R.fast_ica(embeddings(spark, sf), 4, max_iter=500)
    return _whitened(red, 4, n=F.count(F.lit(1)).cast("bigint"))


def _whitened(red, k, **extra):
    """(component 1..k-1, mean, variance, covariance with component 0) rounded, and extra aggregates."""
    c = [F.col("reduced")[i] for i in range(k)]
    tidy = lambda x: F.round(x, 5) + F.lit(0.0)                                         # noqa: E731  (no -0.0)
    per = F.array(*[F.struct(F.lit(i).cast("int").alias("component"), tidy(F.abs(F.avg(c[i]))).alias("mean"),
                             tidy(F.var_samp(c[i])).alias("variance"),
                             tidy(F.abs(F.covar_samp(c[i], c[0]))).alias("covariance_with_first")) for i in range(1, k)])
    one = red.agg(per.alias("p"), *[v.alias(n) for n, v in extra.items()])
    return one.select(F.inline("p"), *extra)


@register("d7_project_2d_grp", lambda: _sql_grp().replace(" AS p0", " AS x").replace(" AS p1", " AS y"))
def q_d7_grp(spark, sf):
    p = R.project_2d(embeddings(spark, sf), "grp", out="xy")
    return p.select("vec_id", r6(F.col("xy")[0]).alias("x"), r6(F.col("xy")[1]).alias("y"))


# ------------------------------------------------------------------ clustering
KS = 12


@register("g1_lloyd_step_every_k", f"""WITH {SQL_E},
k AS (SELECT unnest(range(1, {KS + 1})) AS k), s AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cluster, v AS cv FROM e QUALIFY cluster < {KS}),
d AS (SELECT k, vec_id, v, cluster, {_DIST.format('v', 'cv')} AS d FROM e, k JOIN s ON cluster < k),
a AS (SELECT k, vec_id, any_value(v) AS v, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d FROM d GROUP BY k, vec_id),
x AS (SELECT k, cluster, unnest(v) AS x, unnest(range(0, len(v))) AS dim FROM a)
SELECT k::INTEGER AS k, x.cluster::INTEGER AS cluster, dim::INTEGER AS dim, count(*)::BIGINT AS n, round(avg(x), 9) AS centre,
       round((SELECT sum(d) FROM a WHERE a.k = x.k), 6) AS cost FROM x GROUP BY k, x.cluster, dim""")
def q_g1_steps(spark, sf):
    """One Lloyd sweep of twelve models (k = 1..12, started from the first k vectors) in one scan."""
    e = embeddings(spark, sf)
    first = np.array([r["features"] for r in e.orderBy("vec_id").limit(KS).collect()])
    got = many.lloyd_once(many.vectors(e, "features"), {k: first[:k] for k in range(1, KS + 1)})
    rows = [(k, j, i, int(n[j]), round(float(c[j][i]), 9), round(float(cost.sum()), 6)) for k, (c, n, cost) in got.items()
            for j in range(k) if n[j] for i in range(c.shape[1])]
    return spark.createDataFrame(rows, "k INT, cluster INT, dim INT, n BIGINT, centre DOUBLE, cost DOUBLE")


@register("g1_kmeans_invariants", "SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS misplaced, true AS cost_agrees, true AS settled FROM embeddings")
def q_g1_invariants(spark, sf):
    """Every row is with its nearest centre; the cost of the fit is the inertia (G3) of its centres; the centres are means."""
    return kmeans_holds(embeddings(spark, sf), *kmeans(embeddings(spark, sf), 10, n_init=13, seed=1)[:3])


def kmeans_holds(e, assigned, model, cost):
    centres = model.centres.tolist()
    whole = inertia(e, centres).first()["inertia"]
    moved = {(r["cluster"], r["dim"]): r["centre"] for r in lloyd_step(e, centres).collect()}
    gap = sum((c - centres[j][i]) ** 2 for (j, i), c in moved.items())
    placed = nearest_centre(assigned, centres, "features", "own")
    return placed.agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                      F.sum((F.col("own") != F.col("cluster")).cast("int")).cast("bigint").alias("misplaced"),
                      F.lit(bool(abs(whole - cost) < 1e-6 * max(1.0, whole))).alias("cost_agrees"),
                      F.lit(bool(gap < 1e-4)).alias("settled"))


#: Given mixtures of the first two components: (weight, mean, mean, variance, covariance, variance).
MIXTURE = [(0.5, 0.0, 0.0, 0.02, 0.005, 0.03), (0.3, 0.1, -0.1, 0.015, -0.004, 0.01), (0.2, -0.1, 0.1, 0.03, 0.0, 0.02)]
REG = 1e-6


@register("g4_em_step", f"""WITH {SQL_E}, x AS (SELECT vec_id, v[1] AS x, v[2] AS y FROM e),
g(j, w, m, n, a, b, c) AS (VALUES {', '.join(f"({j}, {', '.join(f'{v}::DOUBLE' for v in g)})" for j, g in enumerate(MIXTURE))}),
l AS (SELECT *, ln(w) - ln(2 * pi()) - 0.5 * ln(a * c - b * b)
                - 0.5 * (c * (x - m) * (x - m) - 2 * b * (x - m) * (y - n) + a * (y - n) * (y - n)) / (a * c - b * b) AS l FROM x, g),
t AS (SELECT *, max(l) OVER (PARTITION BY vec_id) AS top FROM l),
z AS (SELECT *, top + ln(sum(exp(l - top)) OVER (PARTITION BY vec_id)) AS z FROM t),
r AS (SELECT *, exp(l - z) AS r FROM z),
s AS (SELECT j, sum(r) AS n, sum(r * x) / sum(r) AS mx, sum(r * y) / sum(r) AS my, sum(r * x * x) / sum(r) AS xx, sum(r * x * y) / sum(r) AS xy,
             sum(r * y * y) / sum(r) AS yy, avg(z) AS level FROM r GROUP BY j)
SELECT j::INTEGER AS component, round(n / (SELECT count(*) FROM x), 8) AS weight, round(mx, 8) AS mean0, round(my, 8) AS mean1,
       round(xx - mx * mx + {REG}, 8) AS var0, round(xy - mx * my, 8) AS covar, round(yy - my * my + {REG}, 8) AS var1, round(level, 8) AS level FROM s""")
def q_g4_step(spark, sf):
    """One EM step of a full-covariance mixture from given parameters."""
    pts = many.vectors(embeddings(spark, sf).withColumn("two", F.slice("features", 1, 2)), "two")
    given = many.Mixture(np.array([g[0] for g in MIXTURE]), np.array([g[1:3] for g in MIXTURE]),
                         np.array([[[g[3], g[4]], [g[4], g[5]]] for g in MIXTURE]))
    w, mu, cov, level = many.em_once(pts, {0: given}, REG)[0]
    rows = [(j, *(round(float(v), 8) for v in (w[j], *mu[j], cov[j][0, 0], cov[j][0, 1], cov[j][1, 1], level))) for j in range(len(w))]
    return spark.createDataFrame(rows, "component INT, weight DOUBLE, mean0 DOUBLE, mean1 DOUBLE, var0 DOUBLE, covar DOUBLE, var1 DOUBLE, level DOUBLE")


@register("g4_gmm_invariants", """SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS falls, true AS settled, true AS better_than_one,
  round(-0.5 * (5 * ln(2 * pi()) + 5 * ln((count(*) - 1) / count(*) + 1e-6) + 5 * ((count(*) - 1) / count(*)) / ((count(*) - 1) / count(*) + 1e-6)), 6)
  AS one_component_level FROM embeddings""")
def q_g4_invariants(spark, sf):
    """The level never falls, a further step hardly raises it, one component has the closed form's level and four have more."""
    red = R.pca(embeddings(spark, sf), 5, whiten=True)[0]
    single, model = (gmm(red, k, "reduced", n_init=13)[1] for k in (1, 4))
    return mixture_holds(red, "reduced", single, model)


def mixture_holds(df, features, single, model):
    points = many.vectors(df, features)
    *_, level = many.em_once(points, {0: model})[0]
    falls = sum(b < a - 1e-6 for a, b in zip(model.trace, model.trace[1:]))
    return points.agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.lit(falls).cast("bigint").alias("falls"),
                      F.lit(bool(abs(level - model.log_likelihood()) < 1e-2)).alias("settled"),
                      F.lit(bool(model.log_likelihood() > single.log_likelihood())).alias("better_than_one"),
                      F.lit(round(single.log_likelihood(), 6)).alias("one_component_level"))


@register("g5_weighted_centres", f"""WITH {SQL_E} SELECT CAST(3 AS BIGINT) AS components, round(avg(v[1]), 8) AS c0, round(avg(v[2]), 8) AS c1,
       CAST(1.0 AS DOUBLE) AS weight FROM e""")
def q_g5_weighted(spark, sf):
    """Weighted by component, the centres of a mixture are the mean of the table."""
    two = embeddings(spark, sf).select(F.slice("features", 1, 2).alias("features"))
    g = gmm_centres(spark, gmm(two, 3, n_init=2)[1], 2)
    return g.agg(F.count_distinct("component").alias("components"), *[F.round(F.sum(F.col("weight") * F.col(c)), 8).alias(c) for c in ("c0", "c1")],
                 F.round(F.sum("weight"), 8).alias("weight"))


# ------------------------------------------------------------------ fitted networks and kernels on learnable labels
NET = (2, 3, 2)                              # layers of the given net
NET_WEIGHTS = np.round(MLP.glorot(NET, 4), 3)


def _sql_gradient() -> str:
    """The gradient of the given net written out: one sum per weight."""
    (w1, b1), (w2, b2) = [(w.tolist(), b.tolist()) for w, b in MLP.unpack(NET_WEIGHTS, NET)]
    h = [f"greatest({b1[j]!r}::DOUBLE + {w1[0][j]!r}::DOUBLE * x0 + {w1[1][j]!r}::DOUBLE * x1, 0)" for j in range(3)]
    z = [f"({b2[c]!r}::DOUBLE + " + " + ".join(f"{w2[j][c]!r}::DOUBLE * h{j}" for j in range(3)) + ")" for c in range(2)]
    dh = [f"CASE WHEN h{j} > 0 THEN " + " + ".join(f"{w2[j][c]!r}::DOUBLE * d{c}" for c in range(2)) + " ELSE 0 END" for j in range(3)]
    sums = ([f"sum(x{i} * g{j})" for i in range(2) for j in range(3)] + [f"sum(g{j})" for j in range(3)]
            + [f"sum(h{j} * d{c})" for j in range(3) for c in range(2)] + [f"sum(d{c})" for c in range(2)])
    return f"""WITH {SQL_E}, x AS (SELECT v[1] AS x0, v[2] AS x1, label % 2 AS y FROM e),
h AS (SELECT *, {', '.join(f'{x} AS h{j}' for j, x in enumerate(h))} FROM x), z AS (SELECT *, {z[0]} AS z0, {z[1]} AS z1 FROM h),
p AS (SELECT *, 1 / (1 + exp(z1 - z0)) AS p0 FROM z), d AS (SELECT *, p0 - (y = 0)::INT AS d0, (1 - p0) - (y = 1)::INT AS d1 FROM p),
g AS (SELECT *, {', '.join(f'{x} AS g{j}' for j, x in enumerate(dh))} FROM d),
s AS (SELECT [{', '.join(sums)}] AS v, sum(-ln(CASE WHEN y = 0 THEN p0 ELSE 1 - p0 END)) AS loss FROM g)
SELECT (place - 1)::INTEGER AS place, round(v[place], 8) AS gradient, round(loss, 8) AS loss FROM s, range(1, {len(sums) + 1}) r(place)"""


@register("c7_gradient", _sql_gradient)
def q_c7_gradient(spark, sf):
    """Back-propagated gradient of a given net, summed over the table."""
    two = embeddings(spark, sf).select(F.slice("features", 1, 2).alias("features"), (F.col("label") % 2).alias("label"))
    v = MLP.gradients(MLP.points(two, "features", "label"), {0: (NET_WEIGHTS, NET)})[0]
    return spark.createDataFrame([(i, round(float(g), 8), round(float(v[0]), 8)) for i, g in enumerate(v[2:])], "place INT, gradient DOUBLE, loss DOUBLE")


N_LANDMARKS = 8


@register("c8_nystrom_kernel", f"""WITH {SQL_E}, l AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS i, v FROM e QUALIFY i < {N_LANDMARKS}),
p AS (SELECT a.i, b.i AS j, {_DIST.format('a.v', 'b.v')} AS d, list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS s FROM l a, l b)
SELECT i::INTEGER AS i, j::INTEGER AS j, round(exp(-0.5 * d), 6) AS rbf, round((0.5 * s + 1) ** 3, 6) AS poly FROM p""")
def q_c8_nystrom(spark, sf):
    """Between given landmarks the dot products of the mapped rows are the kernels themselves."""
    e = embeddings(spark, sf)
    marks = np.array([r["features"] for r in e.orderBy("vec_id").limit(N_LANDMARKS).collect()])
    z = C.nystrom_map(e, marks, "rbf", 0.5, out="rbf")
    z = C.nystrom_map(z, marks, "poly", 0.5, 3, 1.0, out="poly").select("vec_id", "rbf", "poly").orderBy("vec_id").limit(N_LANDMARKS).collect()
    k = {c: (m := np.array([r[c] for r in z])) @ m.T for c in ("rbf", "poly")}
    rows = [(i, j, round(float(k["rbf"][i, j]), 6), round(float(k["poly"][i, j]), 6)) for i in range(len(z)) for j in range(len(z))]
    return spark.createDataFrame(rows, "i INT, j INT, rbf DOUBLE, poly DOUBLE")


MODELS = ("mlp", "mlp_adam", "mlp_sgd", "svm_linear", "svm_rbf", "svm_poly")


@register("c7_c8_floors", f"""SELECT m AS model, (SELECT CAST(count(*) AS BIGINT) FROM embeddings
       WHERE ({sql_hash_u32('vec_id', SPLIT_SEED)} % 100) < {int(TEST_FRAC * 100)}) AS n, true AS above_floor
FROM (SELECT unnest({list(MODELS)}) AS m)""")
def q_floors(spark, sf):
    """Labels that depend on the features (which side of a fixed plane; for ``poly`` the sign of a product, which no
    plane separates): chance is near one half, the floor 0.7."""
    plane = np.random.RandomState(5).normal(size=64)
    side = F.aggregate(F.zip_with("features", F.array(*[F.lit(float(v)) for v in plane]), lambda a, b: a * b), F.lit(0.0),
                       lambda a, x: a + x)
    e = many.held(embeddings(spark, sf).withColumn("label", (side > 0).cast("double")))
    four = F.transform(F.slice("features", 1, 4), lambda x: x * 8)
    p = e.withColumn("features", four).withColumn("label", (F.col("features")[0] * F.col("features")[1] > 0).cast("double"))
    try:
        (tr, te), (ptr, pte) = ((d.where(~F.col("is_test")), d.where(F.col("is_test"))) for d in (e, p))
        scaled = [d.withColumn("features", F.transform("features", lambda x: x * 8)) for d in (tr, te)]      # unit variance
        own = MLP.mlp_solvers(*scaled, (("adam", "constant"), ("sgd", "adaptive")), max_iter=60, batches=2, rate=0.01)[0].persist()
        out = [own.where(F.col("solver") == s).withColumn("model", F.lit(f"mlp_{s}")) for s in ("adam", "sgd")]
        for name, scored in (("mlp", C.mlp_classify(tr, te, hidden=(100,), max_iter=200)[0]), ("svm_linear", C.svm_classify(tr, te, "linear")),
                             ("svm_rbf", C.svm_classify(tr, te, "rbf")), ("svm_poly", C.svm_classify(ptr, pte, "poly"))):
            out.append(scored.withColumn("model", F.lit(name)))
        both = functools.reduce(lambda a, b: a.unionByName(b), [d.select("model", "label", "prediction") for d in out])
        got = both.groupBy("model").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                        (F.avg((F.col("label") == F.col("prediction")).cast("double")) >= 0.7).alias("above_floor"))
        return spark.createDataFrame(got.collect(), got.schema)                  # six rows
    finally:
        e.unpersist()


# ------------------------------------------------------------------ MDP
@register("m10_policy_is_greedy", f"""WITH {SQL_MDP} SELECT CAST(count(*) AS BIGINT) AS states, CAST(0 AS BIGINT) AS improvable,
       true AS values_settled, true AS optimal FROM st WHERE NOT terminal""")
@on_grid
def q_m10_greedy(cells, states, tp):
    """Policy iteration run until nothing changes: the policy is greedy for its values, a sweep moves them little, and
    400 sweeps under the policy give the values of 400 sweeps of value iteration (0.005 apart at most; 20 with each action turned)."""
    v, policy, _ = M.policy_iteration(tp, states, GAMMA, e_iters=20, p_iters=100, cells=cells)
    new = M.greedy_policy(tp, v, GAMMA).select("x", "y", F.col("a").alias("b"))
    diff = M.values_diff(v, M.bellman_backup(tp, v, GAMMA)).agg(F.max("diff")).first()[0] or 0.0
    own, best = (halo.values(halo.run_sweeps(halo.start(cells, p), 400, GAMMA)[0]) for p in (policy, None))
    gap = M.values_diff(own, best).agg(F.max("diff")).first()[0] or 0.0
    return policy.join(new, ["x", "y"]).agg(
        F.count(F.lit(1)).cast("bigint").alias("states"),
        F.coalesce(F.sum((F.col("a") != F.col("b")).cast("int")), F.lit(0)).cast("bigint").alias("improvable"),
        F.lit(diff <= 0.05).alias("values_settled"), F.lit(gap <= 0.05).alias("optimal"))


# ------------------------------------------------------------------ sources, callbacks, scalar functions
@register("s1_read_labelled_csv", """SELECT CAST(l_orderkey AS DOUBLE) AS f0, CAST(l_linenumber AS DOUBLE) AS f1, l_quantity AS f2,
       CAST(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS label FROM lineitem""")
def q_s1(spark, sf):
    """The table goes to CSV in the shared folder and comes back through the reader."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    (t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                     F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"))
        .write.option("header", "true").csv(path))
    d = read_labelled_csv(spark, path, "label")
    return d.select(*[F.col("features")[i].alias(f"f{i}") for i in range(3)], "label")


@register("s9_param_grid", """SELECT k, c AS kernel FROM (SELECT DISTINCT label AS k FROM embeddings), (SELECT unnest(['linear', 'rbf']) AS c)""")
def q_s9(spark, sf):
    ks = [r[0] for r in t(spark, sf, "embeddings").select("label").distinct().collect()]      # the classes
    return param_grid(spark, k=sorted(ks), kernel=["linear", "rbf"]).select(F.col("k").cast("int").alias("k"), "kernel")


@register("n1_euclidean", f"""WITH {SQL_E}, f AS (SELECT v AS fv FROM e ORDER BY vec_id LIMIT 1)
SELECT vec_id, round(sqrt({_DIST.format('v', 'fv')}), 6) AS distance FROM e, f""")
def q_n1(spark, sf):
    e = embeddings(spark, sf)
    first = e.orderBy("vec_id").first()["features"]
    return e.select("vec_id", r6(euclidean("features", F.array(*[F.lit(float(x)) for x in first]))).alias("distance"))


@register("u1_fitness_callback", """SELECT event_id, CAST(bit_count(event_id) AS INTEGER) AS ones, CAST(bit_count(event_id) AS DOUBLE) AS ones_python FROM events""")
def q_u1(spark, sf):
    """One fitness as a Column function and as a numpy function."""
    ev = t(spark, sf, "events").select("event_id").withColumn(
        "bits", F.transform(F.sequence(F.lit(0), F.lit(62)), lambda i: F.get(F.split(F.lpad(F.bin("event_id"), 63, "0"), ""), i).cast("int")))
    a = FT.score_candidates(ev, lambda b: F.aggregate(b, F.lit(0), lambda s, x: s + x), out="ones")
    return FT.score_candidates(a, lambda x: float(x.sum()), out="ones_python", python=True).drop("bits")
