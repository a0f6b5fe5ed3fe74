"""Nearest-centre assignment (J1), exact k-nearest-neighbour join (J2) and
the kNN classifier sweep (C6).

J2 never forms the query x train product as rows.  Train rows lie in the
cells of pivots, and a query goes only to cells that can hold a winner by the
triangle inequality; cells are cut into blocks of bounded size, a pair of
blocks is one group, scored with numpy, and hands on only the best k per
query, which a per-query top-k merges.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orchard.functions.vectors import sq_distance, vector_literal
from orchard.operators.many import nearest
from orchard.session import cut_lineage

BLOCK_ROWS = 4096                  # vectors per block of either side
CELL_ROWS, MOST_CELLS = 1024, 1024  # train rows a cell (about), and cells at most (their pivots are on the driver)


# ----------------------------------------------------------------------- J1
def nearest_centre(points: DataFrame, centres: Sequence[Sequence[float]],
                   features: str = "features", out: str = "cluster",
                   with_distance: bool = False) -> DataFrame:
    """Index of the closest centre (squared Euclidean), ties to the
    lowest index.  The centres are a list in the driver's program (k x d
    numbers) and are inlined as literals, so this is a projection: no join,
    no shuffle."""
    cs = [list(map(float, c)) for c in centres]
    if not cs:
        raise ValueError("no centres")
    x = F.col(features).cast("array<double>")
    dists = F.array(*[F.struct(sq_distance(x, vector_literal(c)).alias("d"), F.lit(i).alias("c"))
                      for i, c in enumerate(cs)])
    best = F.array_min(dists)          # struct order: distance, then index
    df = points.withColumn(out, best["c"])
    if with_distance:
        df = df.withColumn(f"{out}_sqdist", best["d"])
    return df


def centres_from(df: DataFrame, features: str = "features", key: str | None = None,
                 k: int | None = None) -> list[list[float]]:
    """Collect centre vectors: the first k by key (all rows of a centre table when k is not given)."""
    q = df.select(key, features).orderBy(key) if key else df.select(features)
    rows = (q if k is None else q.limit(k)).collect()
    return [list(map(float, r[features])) for r in rows]


# ----------------------------------------------------------------------- J2
def _topk_block(ids: np.ndarray, X: np.ndarray, labels: np.ndarray, k: int,
                q_ids: np.ndarray, Q: np.ndarray) -> pd.DataFrame:
    """Best k rows of X for every row of Q by (squared distance, id).

    The Gram expansion ranks roughly; every row whose approximate distance
    is within the rounding error of the k-th best is measured exactly, so
    any number of ties is resolved by id.
    """
    x2, q2 = np.einsum("ij,ij->i", X, X), np.einsum("ij,ij->i", Q, Q)
    approx = q2[:, None] + x2[None, :] - 2.0 * (Q @ X.T)
    kk = min(k, len(X))
    kth = np.partition(approx, kk - 1, axis=1)[:, kk - 1]
    slack = 8.0 * (X.shape[1] + 4) * np.finfo(np.float64).eps * (q2 + x2.max())
    rows, cols = np.nonzero(approx <= (kth + 2 * slack)[:, None])
    d = np.empty(len(rows))
    for s in range(0, len(rows), 1 << 16):
        diff = X[cols[s:s + (1 << 16)]] - Q[rows[s:s + (1 << 16)]]
        d[s:s + (1 << 16)] = np.sum(diff * diff, axis=1)
    order = np.lexsort((ids[cols], d, rows))
    rows, cols, d = rows[order], cols[order], d[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
    keep = place < kk
    rows, cols = rows[keep], cols[keep]
    return pd.DataFrame({"qid": q_ids[rows], "nid": ids[cols], "nlabel": labels[cols], "sqdist": d[keep]})


def _pivots(train: DataFrame, n: int) -> np.ndarray:
    """Vectors of ``n`` rows in hash order (``n`` is bounded by ``MOST_CELLS``)."""
    return np.array([r["v"] for r in train.orderBy(F.xxhash64("nid"), "nid").select("v").limit(n).collect()], float)


def _cells_of(df: DataFrame, vector: str, pivots: np.ndarray) -> DataFrame:
    """``df`` with ``_cell``, the nearest pivot, and ``_reach``, the distance to it."""
    names = df.columns

    def locate(batches):
        for batch in batches:
            col = batch.column(vector)
            x = col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1) if len(col) else np.zeros((0, pivots.shape[1]))
            cell = nearest(x, pivots) if len(x) else np.zeros(0, np.int64)
            reach = np.sqrt(((x - pivots[cell]) ** 2).sum(1)) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(reach, pa.float64())],
                                             names=[*names, "_cell", "_reach"])
    schema = T.StructType([*df.schema.fields, T.StructField("_cell", T.IntegerType()), T.StructField("_reach", T.DoubleType())])
    return df.mapInArrow(locate, schema)


def reachable_cells(q: np.ndarray, bound: np.ndarray, pivots: np.ndarray, n: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> np.ndarray:
    """(queries, cells): whether a cell can hold one of the query's k nearest rows.

    ``bound`` is a known upper bound of the k-th distance (inf: none).  By
    the triangle inequality a cell's rows are at most d(q, pivot) + high away
    - enough nearest cells bound the k-th distance as well - and at least
    max(d(q, pivot) - high, low - d(q, pivot)); rows of another cell also lie
    beyond the plane half way between the pivots.
    """
    to = np.sqrt(np.maximum(((q[:, None, :] - pivots[None]) ** 2).sum(2), 0.0))
    far = np.where(n > 0, to + high, np.inf)
    order = far.argsort(1, kind="stable")
    enough = (np.cumsum(n[order], 1) >= min(k, int(n.sum()))).argmax(1)
    rows = np.arange(len(q))
    bound = np.minimum(bound, far[rows, order[rows, enough]])
    own = to.argmin(1)
    apart = np.sqrt(np.maximum(((pivots[own][:, None, :] - pivots[None]) ** 2).sum(2), 0.0))
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = np.where(apart > 0, (to ** 2 - (to[rows, own] ** 2)[:, None]) / (2 * apart), 0.0)
    least = np.maximum(np.maximum(to - high, low - to), plane)
    slack = 1e-9 * (1.0 + to.max(initial=0.0) + high.max(initial=0.0))
    return (n > 0)[None, :] & (least <= bound[:, None] + slack)


def dealt_cells(train: DataFrame, wanted: DataFrame, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of the cell pairs, ``(..., _cell, _tb, _qb)``.

    ``train`` has a ``_cell`` per row, ``wanted`` one row per query and cell
    that can hold a winner.  Cells are split into blocks of ``block_rows`` on
    both sides, so a hot cell is many groups; a train row is copied once per
    block of the queries that want its cell, and to no other.
    """
    size = (train.groupBy("_cell").agg(F.count(F.lit(1)).alias("nt"))
                 .join(wanted.groupBy("_cell").agg(F.count(F.lit(1)).alias("nq")), "_cell"))
    size = F.broadcast(size.select("_cell", F.ceil(F.col("nt") / block_rows).cast("int").alias("nt"),       # at most MOST_CELLS rows
                                   F.ceil(F.col("nq") / block_rows).cast("int").alias("nq")))

    def deal(df, key, mine, own, other, others):
        d = df.join(size, "_cell").withColumn(own, F.pmod(F.xxhash64(key), F.col(mine)).cast("int"))
        return d.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(others) - 1))).drop("nt", "nq")

    return deal(train, "nid", "nt", "_tb", "_qb", "nq"), deal(wanted, "qid", "nq", "_qb", "_tb", "nt")


def _score_cells(train: DataFrame, wanted: DataFrame, k: int, block_rows: int) -> DataFrame:
    """The best k of every (query, cell block): ``(qid, nid, nlabel, sqdist)``."""
    tr, q = dealt_cells(train, wanted, block_rows)

    def score(t: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if len(t) == 0 or len(p) == 0:
            return pd.DataFrame({"qid": [], "nid": [], "nlabel": [], "sqdist": []})
        X = np.vstack(t["v"].to_numpy())
        parts = [_topk_block(t["nid"].to_numpy(np.int64), X, t["nlabel"].astype("Int64").to_numpy(dtype=object), k,
                             c["qid"].to_numpy(np.int64), np.vstack(c["qv"].to_numpy()))
                 for c in (p.iloc[s:s + 512] for s in range(0, len(p), 512))]
        out = pd.concat(parts, ignore_index=True)
        return out.assign(nlabel=pd.array(out["nlabel"], dtype="Int64"))

    keys = ("_cell", "_tb", "_qb")
    return (tr.select("nid", "v", "nlabel", *keys).groupBy(*keys)
              .cogroup(q.select("qid", "qv", *keys).groupBy(*keys)).applyInPandas(score, "qid long, nid long, nlabel long, sqdist double"))


def knn_join(train: DataFrame, query: DataFrame, k: int, train_key: str = "id",
             query_key: str = "id", features: str = "features", label: str = "label",
             block_rows: int = BLOCK_ROWS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Exact k nearest train rows of every query row.

    Train rows belong to the cell of their nearest pivot (hash-sampled rows,
    about ``cell_rows`` rows a cell, ``MOST_CELLS`` cells at most).  Queries
    first meet their own cell; the k-th distance found there and the cells'
    radii say, by the triangle inequality, which other cells can hold a
    winner, and queries are sent to those only.  Train rows are not copied
    but for cells that more than a block of queries wants.

    Returns ``(qid, nid, nlabel, sqdist, rank)`` with rank 1..k (distance,
    then neighbour id).  Rows without a vector or key take no part; a null
    label stays null.
    """
    def side(df, key, names):
        out = df.select(F.col(key).cast("long").alias(names[0]), F.col(features).cast("array<double>").alias(names[1]),
                        *([F.col(label).cast("long").alias("nlabel")] if len(names) > 2 else []))
        return out.where(F.col(names[0]).isNotNull() & F.col(names[1]).isNotNull())

    tr, q = side(train, train_key, ("nid", "v", "nlabel")), side(query, query_key, ("qid", "qv"))
    pivots = _pivots(tr, min(MOST_CELLS, max(1, math.ceil(tr.count() / cell_rows))))
    if len(pivots) == 0:
        return tr.sparkSession.createDataFrame([], "qid long, nid long, nlabel long, sqdist double, rank int")
    tr, q = cut_lineage(_cells_of(tr, "v", pivots)), cut_lineage(_cells_of(q, "qv", pivots))
    best = _score_cells(tr, q, k, block_rows)
    if len(pivots) > 1:
        first = cut_lineage(best)
        best = first.unionByName(_score_cells(tr, other_cells(tr, q, first, pivots, k), k, block_rows))
    w = Window.partitionBy("qid").orderBy("sqdist", "nid")
    return best.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k)


def other_cells(tr: DataFrame, q: DataFrame, first: DataFrame, pivots: np.ndarray, k: int) -> DataFrame:
    """``(qid, qv, _cell)``: the cells but its own that can hold a winner of a query, given its own cell's best rows."""
    n, low, high = np.zeros(len(pivots)), np.zeros(len(pivots)), np.zeros(len(pivots))
    for r in tr.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"), F.min("_reach").alias("a"), F.max("_reach").alias("b")).collect():
        n[r["_cell"]], low[r["_cell"]], high[r["_cell"]] = r["n"], r["a"], r["b"]
    known = first.groupBy(F.col("qid").alias("_q")).agg(F.when(F.count(F.lit(1)) >= k, F.sqrt(F.max("sqdist"))).alias("_bound"))
    asked = q.join(known, F.col("qid") == F.col("_q"), "left").select("qid", "qv", "_cell", F.coalesce("_bound", F.lit(float("inf"))).alias("_bound"))

    def choose(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                x = part.column("qv").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                can = reachable_cells(x, part.column("_bound").to_numpy(), pivots, n, low, high, k)
                can[np.arange(len(x)), part.column("_cell").to_numpy()] = False
                at, cell = np.nonzero(can)
                yield pa.RecordBatch.from_arrays([part.column("qid").take(pa.array(at)), part.column("qv").take(pa.array(at)),
                                                  pa.array(cell, pa.int32())], names=["qid", "qv", "_cell"])
    return asked.mapInArrow(choose, "qid long, qv array<double>, _cell int")


# ----------------------------------------------------------------------- C6
def knn_vote(neigh: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Majority vote of the ``k`` nearest for every k in ``ks`` from one
    max-k neighbour table; ties go to the smallest label.
    Returns ``(k, qid, prediction)``."""
    ks = sorted(set(int(k) for k in ks))
    arr = F.array(*[F.lit(k) for k in ks])
    sweep = neigh.select("qid", "nlabel", "rank",
                         F.explode(F.filter(arr, lambda kk: kk >= F.col("rank"))).alias("k"))
    votes = sweep.groupBy("k", "qid", "nlabel").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("k", "qid").agg(
        F.max_by("nlabel", F.struct(F.col("votes"), -F.col("nlabel"))).alias("prediction"))
    return best


def knn_classify(train: DataFrame, query: DataFrame, ks: Sequence[int], train_key: str,
                 query_key: str, features: str = "features", label: str = "label") -> DataFrame:
    """Predictions for every k in ``ks`` joined to the query's truth:
    ``(k, qid, label, prediction)``."""
    neigh = knn_join(train, query, max(ks), train_key, query_key, features, label)
    pred = knn_vote(neigh, ks)
    truth = query.select(F.col(query_key).cast("long").alias("qid"), F.col(label).cast("long").alias("label"))
    return pred.join(truth, "qid")
