"""Fitted models: metric floors and structural checks (rows-only queries)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orchard.operators import classify as C
from orchard.operators import trees
from orchard.operators.cluster import kmeans
from orchard.plans.catalog_models import doc_features
from orchard.plans.common import embeddings
from orchard.session import ship_package
from tests.conftest import SF_CHECK, SF_SMALL


def test_tree_expression_equals_model(spark):
    d = doc_features(spark, SF_CHECK).cache()
    model = C.decision_tree(d, "gini", 5, 5)
    nodes = C.tree_nodes(model)
    ours = d.select("doc_id", C.tree_expr(nodes).alias("p"))
    ml = model.transform(C.to_vector(d)).select("doc_id", "prediction")
    assert ours.join(ml, "doc_id").where(F.col("p") != F.col("prediction")).count() == 0


def test_pruning_never_lowers_holdout_accuracy(spark):
    d = doc_features(spark, SF_CHECK).cache()
    train, test = d.where(~F.col("is_test")), d.where(F.col("is_test"))
    nodes = C.tree_nodes(C.decision_tree(train, "gini", 8, 2))
    cut = C.prune_reduced_error(nodes, test)

    def acc(collapsed):
        p = test.withColumn("prediction", C.tree_expr(nodes, collapsed=collapsed))
        return p.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert acc(cut) >= acc(set()) - 1e-12


def test_adaboost_predicts_known_labels(spark):
    ship_package(spark)
    d = doc_features(spark, SF_SMALL)
    scored, rounds, staged = trees.adaboost_samme_r(d, n_estimators=3, max_depth=1, pool=[1, 3])
    assert [r[0] for r in staged] == [1, 3]
    labels = {r[0] for r in d.select("label").distinct().collect()}
    preds = {r[0] for r in scored.select("prediction").distinct().collect()}
    assert rounds == 3 and preds <= labels | {0.0, 1.0}


def test_kmeans_single_cluster_cost_is_total_variance(spark):
    e = embeddings(spark, SF_SMALL)
    a, _, cost, _ = kmeans(e, 1)
    assert a.select("cluster").distinct().count() == 1 and cost > 0


def test_nn_forward_range(spark):
    import numpy as np
    df = spark.createDataFrame([([0.1, -0.2, 0.3],), ([1.0, 2.0, -3.0],)], "features array<double>")
    W = C.nn_weights([3, 4, 1], 1)
    s = [r[0] for r in C.nn_forward(df, W).select("score").collect()]
    x = np.array([0.1, -0.2, 0.3])
    h = np.tanh(W[0][:, 0] + W[0][:, 1:] @ x)
    want = 1 / (1 + np.exp(-(W[1][0, 0] + W[1][0, 1:] @ h)))
    assert abs(s[0] - want) < 1e-12 and all(0 < v < 1 for v in s)


def test_training_rows_are_dealt_by_the_work_of_an_evaluation(spark):
    """One part for little work, one per core for much, whatever the parts of the table; Fourier features are no lambdas."""
    from orchard.operators import classify as C
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(2000).selectExpr("array(cast(id as double), 1d) AS features", "cast(id % 2 as double) AS label")
    for parts in (1, 50):
        d = df.repartition(parts)
        assert C.even(d, 3, "features", "label").rdd.getNumPartitions() == 1
        assert C.even(d, 100_000, "features", "label").rdd.getNumPartitions() == cores
        assert C.even(d, 100_000, "features").count() == 2000
    z = C.rff_map(df, 4, seed=3).limit(5)
    assert "lambda" not in z._jdf.queryExecution().optimizedPlan().toString()
    W, b = C.rff_matrix(2, 4, 0.5, 3)
    for r in z.collect():
        want = [(2 / 4) ** 0.5 * np.cos(W[i] @ np.array(r["features"]) + b[i]) for i in range(4)]
        assert r["rff"] == pytest.approx(want, abs=1e-9)
