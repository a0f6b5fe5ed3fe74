"""Null keys, ties, large ids and plan shapes that the driver tables do not contain."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orchard.operators.classify import prune_reduced_error
from orchard.operators.evaluate import calinski_harabasz, classification_scores, cluster_scores
from orchard.operators.mdp import connected_components
from orchard.operators.neighbours import knn_join
from orchard.operators.ordering import row_index, running_extreme
from orchard.operators.reduce import pca_fit, truncated_svd
from orchard.operators.scale import covariance
from orchard.operators.split import stratified_kfold
import orchard.plans.catalog  # noqa: F401  (registers the queries)
from orchard.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_null_groups_keep_their_rows(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else i % 3, float(i * 7 % 11)) for i in range(40)], "id long, g int, v double")
    got = {r.id: r.p for r in row_index(df, ["id"], by=["g"], name="p").collect()}
    w = Window.partitionBy("g").orderBy("id")
    assert got == {r.id: r.p for r in df.withColumn("p", F.row_number().over(w) - 1).collect()}
    assert stratified_kfold(df, "g", "id", 5).count() == 40
    best = {r.id: r.best_so_far for r in running_extreme(df, ["id"], ["g"], "v").collect()}
    assert best == {r.id: r.m for r in df.withColumn("m", F.max("v").over(w.rowsBetween(Window.unboundedPreceding, 0))).collect()}


@pytest.mark.parametrize("block", [4096, 37])
def test_knn_ties_go_to_the_smallest_id(spark, block):
    rows = [(1000 + i, [1.0, 2.0, 3.0], i % 2) for i in range(200)] + [(5, [9.0, 9.0, 9.0], 0), (6, None, 1)]
    tr = spark.createDataFrame(rows, "id long, features array<double>, label long")
    q = spark.createDataFrame([(1, [1.0, 2.0, 3.5]), (2, [1e8, 2.0, 3.0]), (3, None)], "id long, features array<double>")
    got = knn_join(tr, q, 5, block_rows=block).orderBy("qid", "rank").collect()
    assert [r.nid for r in got if r.qid == 1] == [1000, 1001, 1002, 1003, 1004]
    assert [r.nid for r in got if r.qid == 2] == [5, 1000, 1001, 1002, 1003] and len(got) == 10


def test_components_of_large_ids(spark):
    big = 1 << 31
    nodes = spark.createDataFrame([(big,), (big + 1,), (1,), (2,), (-(1 << 62),)], "id long")
    edges = spark.createDataFrame([(1, 2), (-(1 << 62), big + 1)], "src long, dst long")
    assert dict(map(tuple, connected_components(nodes, edges).collect())) == {
        big: big, big + 1: -(1 << 62), 1: 1, 2: 1, -(1 << 62): -(1 << 62)}


def test_metrics_scan_once_and_never_multiply(spark):
    lab = spark.read.parquet(f"{SF}/labels.parquet")
    emb = spark.read.parquet(f"{SF}/embeddings.parquet").withColumnRenamed("embedding", "features")
    for df in (classification_scores(lab, "quality", "toxic"), cluster_scores(lab, "quality", "toxic"),
               calinski_harabasz(emb, "features", "label")):
        text = plan(df)
        assert "CartesianProduct" not in text and "NestedLoop" not in text and "Join" not in text
        assert text.split("== Initial Plan ==")[0].count("FileScan") == 1
    assert plan(covariance(emb)).split("== Initial Plan ==")[0].count("FileScan") == 1


def test_covariance_survives_large_means(spark):
    r = np.random.default_rng(0)
    x = r.standard_normal((300, 4)) + 1e9
    df = spark.createDataFrame([(v.tolist(),) for v in x], "features array<double>")
    want = np.cov(x, rowvar=False)
    for c in covariance(df).collect():
        assert abs(c["cov"] - want[c["i"], c["j"]]) < 1e-6
    mean, _, vals = pca_fit(df, 4)
    assert np.allclose(mean, x.mean(axis=0)) and np.allclose(sorted(vals), sorted(np.linalg.eigvalsh(want)))


def test_svd_matches_numpy(spark):
    x = np.random.default_rng(1).standard_normal((50, 6))
    df = spark.createDataFrame([(v.tolist(),) for v in x], "features array<double>")
    red, s, _ = truncated_svd(df, 3)
    assert np.allclose(s, np.linalg.svd(x, compute_uv=False)[:3])
    got = np.array([r.reduced for r in red.select("reduced").collect()])
    assert np.allclose(np.linalg.norm(got, axis=0), s)


def test_pruning_by_hand(spark):
    leaf = {"left": -1, "right": -1, "feature": -1, "threshold": None}
    nodes = [{"id": 0, "prediction": 0.0, "left": 1, "right": 4, "feature": 0, "threshold": 5.0},
             {"id": 1, "prediction": 0.0, "left": 2, "right": 3, "feature": 0, "threshold": 2.0},
             {"id": 2, "prediction": 0.0, **leaf}, {"id": 3, "prediction": 1.0, **leaf}, {"id": 4, "prediction": 1.0, **leaf}]
    rows = [([1.0], 0.0), ([3.0], 0.0), ([3.0], 1.0), ([9.0], 1.0), ([9.0], 1.0)]
    hold = spark.createDataFrame(rows, "features array<double>, label double")
    assert prune_reduced_error(nodes, hold) == {1}          # a tie at node 1 cuts, the root is worth its split
    assert prune_reduced_error(nodes, hold.where("label = 0")) == {0}


def test_knn_flagship_moves_no_train_rows_through_the_driver(spark):
    text = plan(QUERIES["c6_knn_sweep"](spark, SF))
    assert "FlatMapCoGroupsInPandas" in text and "LocalTableScan" not in text
