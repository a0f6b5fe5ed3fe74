"""Invariants of the operators (the reference has no tests; these are the
properties its experiments rely on)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orchard.operators import mdp as M
from orchard.operators.evaluate import accuracy, cluster_scores, precision_recall
from orchard.operators.ordering import row_index, running_extreme
from orchard.operators.reduce import fast_ica, pca
from orchard.operators.scale import covariance, standard_scale
from orchard.operators.split import stratified_kfold, train_test_split, sample_n
from orchard.plans.common import embeddings
from orchard.sources.grids import DEFAULT_MAP, EASY_MAP, grid_cells
from tests.conftest import SF_CHECK, SF_SMALL


def test_transition_probabilities_sum_to_one(spark):
    tr = M.grid_transitions(grid_cells(spark, DEFAULT_MAP))
    sums = tr.groupBy("x", "y", "a").agg(F.sum("p").alias("s")).collect()
    assert sums and all(abs(r["s"] - 1.0) < 1e-12 for r in sums)


def test_terminal_states_have_no_transitions(spark):
    cells = grid_cells(spark, EASY_MAP)
    tr = M.grid_transitions(cells)
    assert tr.where((F.col("x") == 3) & (F.col("y") == 5)).count() == 0


def test_split_disjoint_complete_and_stable(spark):
    o = spark.read.parquet(f"{SF_CHECK}/orders.parquet").select("o_orderkey")
    a = train_test_split(o, "o_orderkey", 0.3, 100)
    b = train_test_split(o.repartition(1), "o_orderkey", 0.3, 100)
    ra = {r[0]: r[1] for r in a.collect()}
    rb = {r[0]: r[1] for r in b.collect()}
    assert ra == rb and len(ra) == o.count()
    share = sum(ra.values()) / len(ra)
    assert 0.25 < share < 0.35


def test_fold_sizes_per_class_differ_by_at_most_one(spark):
    lab = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    f = stratified_kfold(lab, "quality", "doc_id", 5)
    sizes = f.groupBy("quality", "fold").count().collect()
    for q in {r["quality"] for r in sizes}:
        c = [r["count"] for r in sizes if r["quality"] == q]
        assert max(c) - min(c) <= 1


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_row_index_partition_invariant(spark, parts):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    got = row_index(ev.repartition(parts), ["ts", "event_id"], by=["user_id"], num_partitions=parts)
    pdf = ev.toPandas().sort_values(["user_id", "ts", "event_id"])
    pdf["want"] = pdf.groupby("user_id").cumcount()
    g = dict((r["event_id"], r["row_idx"]) for r in got.select("event_id", "row_idx").collect())
    assert all(g[e] == w for e, w in zip(pdf["event_id"], pdf["want"]))


def test_running_best_matches_pandas(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    got = running_extreme(ev, ["ts", "event_id"], ["user_id"], "value", num_partitions=5)
    pdf = ev.toPandas().sort_values(["user_id", "ts", "event_id"])
    pdf["want"] = pdf.groupby("user_id")["value"].cummax()
    g = dict((r["event_id"], r["best_so_far"]) for r in got.collect())
    assert all(abs(g[e] - w) < 1e-12 for e, w in zip(pdf["event_id"], pdf["want"]))


def test_sample_n_exact_size(spark):
    d = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    assert sample_n(d, "doc_id", 37, 5).count() == 37
    assert sample_n(d, "doc_id", 37, 5).count() == 37


def test_scaled_columns_mean_zero_variance_one(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    s = standard_scale(li, li, ["l_quantity", "l_tax"])
    r = s.agg(F.avg("l_quantity"), F.stddev_pop("l_quantity"), F.avg("l_tax"), F.stddev_pop("l_tax")).first()
    assert abs(r[0]) < 1e-9 and abs(r[1] - 1) < 1e-9 and abs(r[2]) < 1e-9 and abs(r[3] - 1) < 1e-9


def test_whitened_pca_has_identity_covariance(spark):
    red, W, vals = pca(embeddings(spark, SF_SMALL), 4, whiten=True)
    cov = covariance(red, "reduced").collect()
    for r in cov:
        want = 1.0 if r["i"] == r["j"] else 0.0
        assert abs(r["cov"] - want) < 1e-6


def test_covariance_matches_numpy(spark):
    e = embeddings(spark, SF_SMALL)
    X = np.vstack([np.array(r[0]) for r in e.select("features").collect()])
    C = np.cov(X, rowvar=False)
    for r in covariance(e).collect():
        assert abs(r["cov"] - C[r["i"], r["j"]]) < 1e-10


def test_ica_components_are_white(spark):
    red, W, it = fast_ica(embeddings(spark, SF_SMALL), 3, max_iter=30)
    cov = covariance(red, "reduced").collect()
    for r in cov:
        want = 1.0 if r["i"] == r["j"] else 0.0
        assert abs(r["cov"] - want) < 1e-6


def test_identical_partitions_score_one(spark):
    lab = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    s = cluster_scores(lab, "quality", "quality").first()
    for c in ("homogeneity", "completeness", "v_measure", "adjusted_rand", "adjusted_mutual_info", "purity"):
        assert abs(s[c] - 1.0) < 1e-9, c


def test_homogeneity_completeness_swap(spark):
    lab = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    a = cluster_scores(lab, "quality", "toxic").first()
    b = cluster_scores(lab, "toxic", "quality").first()
    assert abs(a["homogeneity"] - b["completeness"]) < 1e-12
    assert abs(a["adjusted_rand"] - b["adjusted_rand"]) < 1e-12
    assert abs(a["adjusted_mutual_info"] - b["adjusted_mutual_info"]) < 1e-9


def test_micro_precision_equals_recall_equals_accuracy(spark):
    lab = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    acc = accuracy(lab, "quality", "toxic").first()["accuracy"]
    pr = precision_recall(lab, "quality", "toxic", average="micro").first()
    assert abs(pr["precision"] - acc) < 1e-12 and abs(pr["recall"] - acc) < 1e-12


def test_lloyd_inertia_never_rises(spark):
    from orchard.operators.cluster import centres_table_to_list, inertia, lloyd_step
    from orchard.operators.neighbours import centres_from
    e = embeddings(spark, SF_SMALL)
    cents = centres_from(e, "features", key="vec_id", k=5)
    prev = inertia(e, cents).first()["inertia"]
    for _ in range(3):
        cents = centres_table_to_list(lloyd_step(e, cents), 5)
        cur = inertia(e, cents).first()["inertia"]
        assert cur <= prev + 1e-9
        prev = cur


def test_value_iteration_and_policy_iteration_agree(spark):
    cells = grid_cells(spark, DEFAULT_MAP)
    states = M.grid_states(cells).cache()
    with M.prepared_transitions(M.grid_transitions(cells), states) as tp:
        vi = M.value_iteration(tp, states, 0.9, 150)
        v_pi, pol, rounds = M.policy_iteration(tp, states, 0.9, e_iters=150, p_iters=30)
        m = M.values_match(vi, v_pi, 0.05).first()
    assert m["match"], m


def test_easy_map_goal_reachable_both_ways(spark):
    cells = grid_cells(spark, EASY_MAP)
    states = M.grid_states(cells)
    tr = M.grid_transitions(cells)
    a = {(r["x"], r["y"]) for r in M.reachable(tr, (0, 0)).collect()}
    b = {(r["x"], r["y"]) for r in M.grid_reachable(states, tr, (0, 0)).collect()}
    assert a == b and (3, 5) in a and len(a) == 20


def test_convergence_sweep_finds_first_small_delta(spark):
    cells = grid_cells(spark, EASY_MAP)
    states = M.grid_states(cells).cache()
    with M.prepared_transitions(M.grid_transitions(cells), states) as tp:
        rows, first = M.convergence_sweep(tp, states, 0.5, 60, tol=0.05)
    d = [r["max_delta"] for r in rows.orderBy("iter").collect()]
    assert first is not None and d[first - 1] <= 0.05 and all(x > 0.05 for x in d[:first - 1])


def test_connected_components_match_union_find(spark):
    rng = np.random.RandomState(3)
    n = 300
    edges = [(int(a), int(b)) for a, b in rng.randint(0, n, size=(260, 2))]
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a
    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    want = {}
    for v in range(n):
        want.setdefault(find(v), []).append(v)
    want_comp = {v: min(members) for members in want.values() for v in members}
    nodes = spark.range(n).select(F.col("id"))
    e = spark.createDataFrame(edges, "src BIGINT, dst BIGINT")
    got = {r["id"]: r["comp"] for r in M.connected_components(nodes, e).collect()}
    assert got == want_comp


def test_event_grid_reachability_bfs_equals_components(spark):
    from orchard.sources.grids import grid_from_events
    cells = grid_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    states = M.grid_states(cells).cache()
    tr = M.grid_transitions(cells).cache()
    start = states.where(~F.col("terminal")).orderBy("x", "y").first()
    s = (start["x"], start["y"])
    a = {(r["x"], r["y"]) for r in M.reachable(tr, s).collect()}
    b = {(r["x"], r["y"]) for r in M.grid_reachable(states, tr, s).collect()}
    assert a == b and len(a) > 1


def test_knn_join_blocks_give_the_same_neighbours(spark):
    from orchard.operators.neighbours import knn_join
    e = embeddings(spark, SF_SMALL)
    tr, q = e.where(~F.col("is_test")), e.where(F.col("is_test"))
    one = {(r["qid"], r["rank"]): r["nid"] for r in knn_join(tr, q, 5, "vec_id", "vec_id").collect()}
    many = {(r["qid"], r["rank"]): r["nid"]
            for r in knn_join(tr, q, 5, "vec_id", "vec_id", block_rows=60).collect()}
    assert one == many and len(one) == 5 * q.count()


def test_transitions_are_not_shuffled_in_a_sweep(spark):
    cells = grid_cells(spark, DEFAULT_MAP)
    states = M.grid_states(cells).cache()
    tr = M.grid_transitions(cells)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with M.prepared_transitions(tr, states) as tp:
            name = tp.inputFiles()[0].split("/")[-2]
            sweep = M.bellman_backup(tp, M.zero_values(states), 0.9)
            plan = sweep._jdf.queryExecution().executedPlan().toString()
            assert "orchard_transitions_" in plan and "Bucketed: true" in plan
            bucketed = M.value_iteration(tp, states, 0.9, 6).collect()
        assert not spark.catalog.tableExists(name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    with M.prepared_transitions(tr, states) as tp:
        again = sorted(map(tuple, M.value_iteration(tp, states, 0.9, 6).collect()))
    assert np.allclose(np.array(again), np.array(sorted(map(tuple, bucketed))))
