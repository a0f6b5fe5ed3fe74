"""Decision trees by level-wise split search (C1) and their boosting.

One scan serves a whole level: a task routes its rows down the tree so far
and adds them to class histograms by (node, feature, bin); the histograms,
summed before and after the shuffle, are all that reaches the driver, where
the running sums over the bins give the impurity gain of every cut of every
open node.  Cuts are exact for a feature with up to ``max_bins`` distinct
values (half way between neighbours, as usual) and lie at quantiles beyond.

A shallower tree is the deeper one cut off (splits do not depend on the
depth), so one growth serves a sweep over depths.  Boosting keeps no weight
column: a row's weight follows from the trees so far, of which only those
since the last checkpoint are recomputed, so a round costs one histogram
scan a level and nothing else.

Ties of gains go to the lower feature, then the lower cut.  Rows without a
vector or label take no part; an empty table gives a tree of one leaf.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.operators import many
from orchard.session import cut_lineage

IMPURITIES = ("gini", "entropy")
EPS = float(np.finfo(float).eps)


@dataclass
class Tree:
    """Parallel lists by node: ``feature`` -1 marks a leaf; ``weight`` holds the class weights, ``rows`` the plain count."""

    cuts: list[np.ndarray]
    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    weight: list[np.ndarray] = field(default_factory=list)
    rows: list[float] = field(default_factory=list)

    def add(self, weight: np.ndarray, rows: float, depth: int) -> int:
        for values, v in ((self.feature, -1), (self.cut, -1), (self.left, -1), (self.right, -1), (self.depth, depth),
                          (self.weight, weight), (self.rows, rows)):
            values.append(v)
        return len(self.feature) - 1

    def route(self, bins: np.ndarray) -> np.ndarray:
        """The node that every row of bin numbers ends in."""
        at = np.zeros(len(bins), np.int64)
        feature, cut, left, right = map(np.asarray, (self.feature, self.cut, self.left, self.right))
        for _ in range(max(self.depth, default=0)):
            inner = feature[at] >= 0
            goes = bins[np.arange(len(bins)), np.maximum(feature[at], 0)] <= cut[at]
            at = np.where(inner, np.where(goes, left[at], right[at]), at)
        return at

    def probabilities(self) -> np.ndarray:
        w = np.stack(self.weight)
        return w / np.maximum(w.sum(1, keepdims=True), np.finfo(float).tiny)

    def cut_off(self, depth: int) -> Tree:
        """The tree that a growth to ``depth`` gives."""
        out = Tree(self.cuts)
        place = {}
        for i, d in enumerate(self.depth):
            if d <= depth:
                place[i] = out.add(self.weight[i], self.rows[i], d)
        for i, j in place.items():
            if self.feature[i] >= 0 and self.depth[i] < depth:
                out.feature[j], out.cut[j] = self.feature[i], self.cut[i]
                out.left[j], out.right[j] = place[self.left[i]], place[self.right[i]]
        return out

    def nodes(self) -> list[dict]:
        """Node records for :func:`classify.tree_expr` and :func:`classify.prune_reduced_error`."""
        return [{"id": i, "prediction": float(np.argmax(self.weight[i])), "left": self.left[i], "right": self.right[i], "feature": f,
                 "threshold": float(self.cuts[f][self.cut[i]]) if f >= 0 else None, "count": float(self.rows[i])}
                for i, f in enumerate(self.feature)]


def points(df: DataFrame, features: str, label: str, *keep) -> DataFrame:
    return many.vectors(df.where(F.col(label).isNotNull()), features, F.col(label).cast("int").alias("_y"), *keep)


def find_cuts(pts: DataFrame, max_bins: int = 64) -> list[np.ndarray]:
    """Ascending cuts per feature (a row goes left when its value is at most the cut)."""
    each = pts.select(F.posexplode("_x").alias("f", "x"))
    about = each.groupBy("f").agg(F.approx_count_distinct("x", 0.02).alias("n"), F.percentile_approx(
        "x", F.array(*[F.lit(i / max_bins) for i in range(1, max_bins)]), F.lit(10_000)).alias("q")).collect()
    few = [r["f"] for r in about if r["n"] <= 1.1 * max_bins]
    exact = {r["f"]: r["v"] for r in each.where(F.col("f").isin(few)).groupBy("f").agg(F.sort_array(F.collect_set("x")).alias("v")).collect()} if few else {}
    out = []
    for r in sorted(about, key=lambda r: r["f"]):
        v = np.array(exact.get(r["f"], []))
        out.append((v[1:] + v[:-1]) / 2 if r["f"] in exact and len(v) <= max_bins else np.unique(np.array(r["q"], float)))
    return out


def binned(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], 1) if cuts else np.zeros((len(x), 0), int)


def level_histograms(pts: DataFrame, tree: Tree, open_nodes: Sequence[int], classes: int,
                     weigh: Callable | None = None) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per open node: class weights (features x bins x classes) and row counts (features x bins), from one scan."""
    cuts, wide = tree.cuts, max((len(c) for c in tree.cuts), default=0) + 1

    def step(x, rows):
        bins, y = binned(x, cuts), rows.column("_y").to_numpy()
        w = weigh(bins, rows) if weigh else np.ones(len(x))
        at = tree.route(bins)
        for node in open_nodes:
            m = at == node
            if m.any():
                sums = [np.bincount(bins[m, f] * classes + y[m], w[m], wide * classes) for f in range(len(cuts))]
                number = [np.bincount(bins[m, f], minlength=wide) for f in range(len(cuts))]
                yield (0, node), np.concatenate([*sums, *number])

    size = len(cuts) * wide
    return {node: (v[:size * classes].reshape(len(cuts), wide, classes), v[size * classes:].reshape(len(cuts), wide))
            for (_, node), v in many.scan_sums(pts, step).items()}


def impurity_of(w: np.ndarray, kind: str) -> np.ndarray:
    """Gini or entropy (bits) of class weights along the last axis; 0 without weight."""
    total = w.sum(-1, keepdims=True)
    p = np.divide(w, total, out=np.zeros_like(w), where=total > 0)
    if kind == "gini":
        return np.where(total[..., 0] > 0, 1.0 - (p * p).sum(-1), 0.0)
    return -(p * np.log2(np.where(p > 0, p, 1.0))).sum(-1)


def best_split(weights: np.ndarray, counts: np.ndarray, kind: str = "entropy", min_leaf: int = 1) -> tuple[int, int, float] | None:
    """(feature, cut, gain) of the largest impurity gain over all cuts that leave ``min_leaf`` rows on either side."""
    if kind not in IMPURITIES:
        raise ValueError(f"unknown impurity {kind!r}")
    left, n_left = weights.cumsum(1)[:, :-1], counts.cumsum(1)[:, :-1]
    total = weights[0].sum(0)
    right, n_right = total - left, counts.sum(1, keepdims=True) - n_left
    whole = total.sum()
    if whole <= 0 or left.size == 0:
        return None
    right = np.maximum(right, 0.0)
    inside = (left.sum(-1) * impurity_of(left, kind) + right.sum(-1) * impurity_of(right, kind)) / whole
    gain = np.round(impurity_of(total, kind) - inside, 12)
    gain[(n_left < max(1, min_leaf)) | (n_right < max(1, min_leaf))] = -1.0
    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
    return (int(f), int(b), float(gain[f, b])) if gain[f, b] > 0 else None


def grow(pts: DataFrame, classes: int, impurity: str = "entropy", max_depth: int = 5, min_leaf: int = 1, min_split: int = 2,
         cuts: list[np.ndarray] | None = None, max_bins: int = 64, weigh: Callable | None = None) -> Tree:
    """One histogram scan a level, all open nodes together."""
    cuts = find_cuts(pts, max_bins) if cuts is None else cuts
    tree = Tree(cuts)
    tree.add(np.zeros(classes), 0.0, 0)
    level = [0]
    for depth in range(max_depth):
        found = level_histograms(pts, tree, level, classes, weigh)
        nxt = []
        for node in level:
            if node not in found:
                continue
            w, n = found[node]
            if depth == 0 and len(w):
                tree.weight[0], tree.rows[0] = w[0].sum(0), float(n[0].sum())
            cut = best_split(w, n, impurity, min_leaf) if len(w) and n[0].sum() >= min_split else None
            if cut is None:
                continue
            f, b, _ = cut
            tree.feature[node], tree.cut[node] = f, b
            tree.left[node] = tree.add(w[f, :b + 1].sum(0), float(n[f, :b + 1].sum()), depth + 1)
            tree.right[node] = tree.add(w[f, b + 1:].sum(0), float(n[f, b + 1:].sum()), depth + 1)
            nxt += [i for i in (tree.left[node], tree.right[node]) if (tree.weight[i] > 0).sum() > 1]
        level = nxt
        if not level:
            break
    return tree


def decision_tree(df: DataFrame, impurity: str = "entropy", max_depth: int = 5, min_leaf: int = 10, min_split: int = 10, features: str = "features",
                  label: str = "label", max_bins: int = 64) -> Tree:
    """C1 over a table with class numbers in ``label``."""
    pts = many.held(points(df, features, label))
    try:
        top = pts.agg(F.max("_y")).first()[0]
        return grow(pts, int(top or 0) + 1, impurity, max_depth, min_leaf, min_split, max_bins=max_bins)
    finally:
        pts.unpersist()


# ------------------------------------------------------------------ C5
def _terms(trees: Sequence[Tree], bins: np.ndarray) -> np.ndarray:
    """log class probabilities of every row by every tree, (trees, rows, classes)."""
    return np.stack([np.log(np.maximum(t.probabilities(), EPS))[t.route(bins)] for t in trees])


def _coded(y: np.ndarray, classes: int) -> np.ndarray:
    """1 for the row's class, -1 / (classes - 1) for the others."""
    code = np.full((len(y), classes), -1.0 / (classes - 1))
    code[np.arange(len(y)), y] = 1.0
    return code


def _state(rows, trees: Sequence[Tree], bins: np.ndarray, classes: int, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """(log weight, decision function) of the rows: the stored ones and the trees since."""
    log_w = rows.column("_lw").to_numpy().copy()
    f = rows.column("_f").flatten().to_numpy().reshape(-1, classes).copy()
    if trees:
        lp = _terms(trees, bins)
        y = rows.column("_y").to_numpy()
        log_w -= rate * (classes - 1) / classes * np.einsum("trk,rk->r", lp, _coded(y, classes))
        f += rate * (classes - 1) * (lp - lp.mean(2, keepdims=True)).sum(0)
    return log_w, f


def adaboost_samme_r(df: DataFrame, n_estimators: int = 50, learning_rate: float = 1.0, max_depth: int = 1, features: str = "features",
                     label: str = "label", impurity: str = "gini", train_col: str | None = None, pool: Sequence[int] | None = None,
                     min_leaf: int = 1, max_bins: int = 64, checkpoint_every: int = 25):
    """SAMME.R boosting (Zhu et al., 2009), one histogram scan a level and round.

    With ``train_col`` (a boolean) only those rows are fitted, the others are
    scored.  ``pool``: accuracies after these numbers of trees, from one scan
    at the end (a shorter run is the start of a longer one).  Boosting stops
    when a tree fits all weight.  Returns (scored DataFrame with
    ``prediction``, rounds, rows (trees, train, accuracy)).
    """
    flag = F.coalesce(F.col(train_col), F.lit(False)) if train_col else F.lit(True)
    pts = points(df, features, label, flag.alias("_t"))
    classes = max(int(pts.agg(F.max("_y")).first()[0] or 0) + 1, 2)
    pts = many.held(pts.withColumns({"_lw": F.lit(0.0), "_f": F.array(*[F.lit(0.0)] * classes)}))
    first = pts
    cuts = find_cuts(pts.where("_t"), max_bins)
    trees, since, shift = [], [], 0.0
    try:
        for m in range(1, n_estimators + 1):
            def weigh(bins, rows, since=tuple(since), shift=shift):
                return np.exp(_state(rows, since, bins, classes, learning_rate)[0] - shift)
            tree = grow(pts.where("_t"), classes, impurity, max_depth, min_leaf, cuts=cuts, weigh=weigh)
            total = tree.weight[0].sum()
            if total <= 0:
                break
            shift += float(np.log(total))
            trees.append(tree)
            since.append(tree)
            wrong = sum(w.sum() - w.max() for f, w in zip(tree.feature, tree.weight) if f < 0)
            if wrong <= 0:
                break
            if m % checkpoint_every == 0 and m < n_estimators:
                pts = cut_lineage(_advanced(pts, since, cuts, classes, learning_rate))
                since = []
        staged = _staged(first, trees, cuts, classes, [p for p in pool or [] if p <= len(trees)])
    finally:
        first.unpersist()
    fitted = tuple(trees)

    @F.pandas_udf("double")
    def predict(col: pd.Series) -> pd.Series:
        got = pd.Series(pd.NA, index=col.index, dtype="Float64")
        have = col.notna().to_numpy()
        if have.any() and fitted:
            lp = _terms(fitted, binned(np.vstack(col[have].to_numpy()).astype(float), cuts))
            got[have] = (lp - lp.mean(2, keepdims=True)).sum(0).argmax(1).astype(float)
        return got

    return df.withColumn("prediction", predict(F.col(features).cast("array<double>"))), len(trees), staged


def _advanced(pts: DataFrame, trees: Sequence[Tree], cuts, classes: int, rate: float) -> DataFrame:
    import pyarrow as pa
    trees, names = tuple(trees), pts.columns

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                log_w, f = _state(batch, trees, binned(many.matrix(batch), cuts), classes, rate)
                new = {"_lw": pa.array(log_w), "_f": pa.array(f.tolist(), pa.list_(pa.float64()))}
                yield pa.RecordBatch.from_arrays([new.get(n, batch.column(n)) for n in names], names=names)
    return pts.mapInArrow(run, pts.schema)


def _staged(pts: DataFrame, trees: Sequence[Tree], cuts, classes: int, pool: Sequence[int]) -> list[tuple[int, bool, float]]:
    trees = tuple(trees)

    def step(x, rows):
        lp = _terms(trees, binned(x, cuts))
        f = (lp - lp.mean(2, keepdims=True)).cumsum(0)
        y, t = rows.column("_y").to_numpy(), rows.column("_t").to_numpy(zero_copy_only=False)
        for p in pool:
            hit = f[p - 1].argmax(1) == y
            for side in (False, True):
                if (t == side).any():
                    yield (p, int(side)), np.array([hit[t == side].sum(), (t == side).sum()], float)

    got = many.scan_sums(pts.select("_x", "_y", "_t"), step) if pool and trees else {}
    return [(p, bool(side), float(v[0] / v[1])) for (p, side), v in sorted(got.items())]
