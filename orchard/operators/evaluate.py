"""Aggregation and evaluation.

Every score is computed from the contingency table ``(truth, pred, n)``,
which one partial-aggregated ``groupBy`` produces; the table has at most
#classes x #clusters rows per group, so everything after it is tiny no matter
how large the scored table is.  ``by`` columns evaluate many models / sweep
steps in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPS = float(2.220446049250313e-16)  # float64 machine epsilon (fixed value)


def confusion(df: DataFrame, truth: str = "label", pred: str = "prediction",
              by: Sequence[str] = ()) -> DataFrame:
    """``(by..., truth, pred, n)`` counts."""
    return (df.groupBy(*by, F.col(truth).alias("truth"), F.col(pred).alias("pred"))
              .agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def accuracy(df: DataFrame, truth: str = "label", pred: str = "prediction",
             by: Sequence[str] = ()) -> DataFrame:
    """``n``, ``correct`` and ``accuracy`` (share, not percent)."""
    hit = (F.col(truth) == F.col(pred)).cast("int")
    return (df.groupBy(*by).agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                F.sum(hit).cast("bigint").alias("correct"))
              .withColumn("accuracy", F.col("correct") / F.col("n")))


AVERAGES = ("binary", "micro", "macro", "weighted")


def classification_scores(df: DataFrame, truth: str = "label", pred: str = "prediction", pos_label=1,
                          by: Sequence[str] = ()) -> DataFrame:
    """E2-E4 in one pass: ``n``, ``correct``, ``accuracy`` and
    ``precision_<average>`` / ``recall_<average>`` for ``binary`` (class
    ``pos_label``), ``micro``, ``macro`` and ``weighted``; a zero denominator
    gives 0.  One scan: the contingency table is turned into a row per class,
    and those rows are aggregated - no join."""
    cm = confusion(df, truth, pred, by)
    hit = F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    sides = F.array(F.struct(F.col("truth").alias("cls"), F.col("n").alias("actual"), zero.alias("predicted"),
                             hit.cast("bigint").alias("tp")),
                    F.struct(F.col("pred").alias("cls"), zero.alias("actual"), F.col("n").alias("predicted"),
                             zero.alias("tp")))
    pc = (cm.select(*by, F.explode(sides).alias("s")).groupBy(*by, F.col("s.cls").alias("cls"))
            .agg(*[F.sum(f"s.{c}").alias(c) for c in ("actual", "predicted", "tp")]))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("actual") > 0, F.col("tp") / F.col("actual")).otherwise(F.lit(0.0))
    pos = F.col("cls") == F.lit(pos_label)
    out = pc.groupBy(*by).agg(
        F.sum("actual").cast("bigint").alias("n"), F.sum("tp").cast("bigint").alias("correct"),
        F.coalesce(F.sum(F.when(pos, prec)), F.lit(0.0)).alias("precision_binary"),
        F.coalesce(F.sum(F.when(pos, rec)), F.lit(0.0)).alias("recall_binary"),
        F.avg(prec).alias("precision_macro"), F.avg(rec).alias("recall_macro"),
        (F.sum(prec * F.col("actual")) / F.sum("actual")).alias("precision_weighted"),
        (F.sum(rec * F.col("actual")) / F.sum("actual")).alias("recall_weighted"))
    share = F.col("correct") / F.col("n")
    return out.withColumns({"accuracy": share, "precision_micro": share, "recall_micro": share})


def precision_recall(df: DataFrame, truth: str = "label", pred: str = "prediction",
                     average: str = "binary", pos_label=1, by: Sequence[str] = ()) -> DataFrame:
    """``precision`` and ``recall`` for one kind of average."""
    if average not in AVERAGES:
        raise ValueError(f"unknown average {average!r}")
    s = classification_scores(df, truth, pred, pos_label, by)
    return s.select(*by, F.col(f"precision_{average}").alias("precision"), F.col(f"recall_{average}").alias("recall"))


def best_by_score(df: DataFrame, score: str, order_key: str, by: Sequence[str] = ()) -> DataFrame:
    """The row with the highest score; on ties the first (smallest
    numeric ``order_key``) wins, as with a strict ``>`` scan.  One
    aggregate (``max_by``), so it combines map-side even for a hot group."""
    cols = [c for c in df.columns if c not in by]
    best = F.max_by(F.struct(*cols), F.struct(F.col(score), -F.col(order_key))).alias("_b")
    return df.groupBy(*by).agg(best).select(*by, *[F.col("_b")[c].alias(c) for c in cols])


# ------------------------------------------------------------ clustering scores
def cluster_scores(df: DataFrame, truth: str = "label", pred: str = "cluster",
                   by: Sequence[str] = (), with_ami: bool = True) -> DataFrame:
    """E2 (raw), purity, E9 homogeneity, E10 completeness, E11 V-measure,
    E12 adjusted Rand, E13 adjusted mutual information (arithmetic mean),
    natural logarithms, from one contingency table per ``by`` group."""
    return scores_from_counts(confusion(df, truth, pred, by), by, with_ami)


def scores_from_counts(cm: DataFrame, by: Sequence[str] = (), with_ami: bool = True) -> DataFrame:
    """:func:`cluster_scores` from a contingency table ``(by..., truth, pred, n)``.

    Margins are window sums over the contingency table (#classes x #clusters
    rows), and a single aggregate turns its rows into every sum that the
    scores need; E[MI] comes from the histogram of the margins."""
    by = list(by)
    wg, wt, wp = (Window.partitionBy(*by, *extra) for extra in ((), ("truth",), ("pred",)))
    cm = cm.select("*", F.sum("n").over(wt).alias("a"), F.sum("n").over(wp).alias("b"),
                   F.sum("n").over(wg).cast("double").alias("ntot"), F.max("n").over(wp).alias("most"),
                   (F.row_number().over(wt.orderBy("pred")) == 1).alias("ft"),
                   (F.row_number().over(wp.orderBy("truth")) == 1).alias("fp"))
    a, b, n, N = (F.col(c) for c in ("a", "b", "n", "ntot"))

    def once(flag, x):
        return F.when(F.col(flag), x)

    # what every row of the table adds to the sums of its group
    part = {"hits": F.when(F.col("truth") == F.col("pred"), n).otherwise(0), "sum_nij2": n.cast("double") * n,
            # mutual information: sum n_ij/N * ln(N n_ij / (a_i b_j)), clipped at 0
            "mi_raw": n / N * (F.log(n) + F.log(N) - F.log(a) - F.log(b)),
            "sa_log": once("ft", a * F.log(a)), "sum_a2": once("ft", a.cast("double") * a), "n_true": once("ft", F.lit(1)),
            "sb_log": once("fp", b * F.log(b)), "sum_b2": once("fp", b.cast("double") * b), "n_pred": once("fp", F.lit(1)),
            "maj": once("fp", F.col("most"))}
    if with_ami:
        s = _sums_with_expected(cm, by, part)
    else:
        s = cm.groupBy(*by).agg(F.max(N).alias("ntot"), *[F.sum(x.cast("double")).alias(c) for c, x in part.items()])
    s = s.where(N > 0)
    s = s.withColumn("h_true", F.greatest(F.log(N) - F.col("sa_log") / N, F.lit(0.0)))
    s = s.withColumn("h_pred", F.greatest(F.log(N) - F.col("sb_log") / N, F.lit(0.0)))
    s = s.withColumn("mi", F.greatest(F.col("mi_raw"), F.lit(0.0)))
    hom = F.when(F.col("h_true") == 0, F.lit(1.0)).otherwise(F.col("mi") / F.col("h_true"))
    com = F.when(F.col("h_pred") == 0, F.lit(1.0)).otherwise(F.col("mi") / F.col("h_pred"))
    s = s.withColumn("homogeneity", hom).withColumn("completeness", com)
    s = s.withColumn("v_measure", F.when(F.col("homogeneity") + F.col("completeness") == 0, F.lit(0.0))
                     .otherwise(2 * F.col("homogeneity") * F.col("completeness")
                                / (F.col("homogeneity") + F.col("completeness"))))
    # adjusted Rand from the pair confusion matrix
    tp = F.col("sum_nij2") - N
    fp = F.col("sum_b2") - F.col("sum_nij2")
    fn = F.col("sum_a2") - F.col("sum_nij2")
    tn = N * N - fp - fn - F.col("sum_nij2")
    ari = F.when((fn == 0) & (fp == 0), F.lit(1.0)).otherwise(
        F.lit(2.0) * (tp * tn - fn * fp) / ((tp + fn) * (fn + tn) + (tp + fp) * (fp + tn)))
    s = s.withColumn("adjusted_rand", ari)
    s = s.withColumn("raw_accuracy", F.col("hits") / N).withColumn("purity", F.col("maj") / N)
    cols = [*by, N.cast("bigint").alias("n"), "raw_accuracy", "purity", "homogeneity", "completeness",
            "v_measure", "adjusted_rand"]
    if with_ami:
        norm = (F.col("h_true") + F.col("h_pred")) / 2
        den = norm - F.col("emi")
        den = F.when(den < 0, F.least(den, F.lit(-EPS))).otherwise(F.greatest(den, F.lit(EPS)))
        ami = F.when(((F.col("n_true") == 1) & (F.col("n_pred") == 1)), F.lit(1.0)).otherwise(
            (F.col("mi") - F.col("emi")) / den)
        s = s.withColumn("adjusted_mutual_info", ami)
        cols.append("adjusted_mutual_info")
    return s.select(*cols)


#: Distinct margin sizes of either side that a task pairs at a time.
MARGIN_BLOCK = 512


def _sums_with_expected(cm: DataFrame, by: Sequence[str], part: dict[str, Column]) -> DataFrame:
    """``(by..., ntot, the sums of part, emi)``, ``emi`` being E[MI] under the hypergeometric model of random labelings.

    A term of E[MI] depends on the sizes of a class and a cluster alone, so
    margins are counted as (size, number of labels) - at most sqrt(2 N) sizes -
    and pairs of distinct sizes are weighted by their numbers.  Sizes are
    dealt into blocks and a pair of blocks is one group, so no pair is ever a
    row.  The sums travel as one more record per group: one scan, no join.
    """
    empty = {c: F.lit(None).cast("double") for c in part}

    def record(kind, size, keep, fields):
        return F.struct(F.lit(kind).alias("kind"), size.cast("bigint").alias("size"), keep.alias("keep"),
                        *[x.cast("double").alias(c) for c, x in fields.items()])

    recs = cm.select(*by, "ntot", F.explode(F.array(record(0, F.lit(0), F.lit(True), part), record(1, F.col("a"), F.col("ft"), empty),
                                                    record(2, F.col("b"), F.col("fp"), empty))).alias("r")).where("r.keep")
    m = recs.groupBy(*by, F.col("r.kind").alias("kind"), F.col("r.size").alias("size")).agg(
        F.max("ntot").alias("ntot"), F.count(F.lit(1)).alias("labels"), *[F.sum(f"r.{c}").alias(c) for c in part])
    w = Window.partitionBy(*(by or [F.lit(0)]))
    blocks = [F.greatest(F.ceil(F.count_if(F.col("kind") == k).over(w) / MARGIN_BLOCK), F.lit(1)).cast("int") for k in (1, 2)]
    m = m.select("*", *[x.alias(c) for x, c in zip(blocks, ("na", "nb"))])

    def place(own, kind):
        """Its block for the own side, every block for the other side, the first one for the sums."""
        return (F.when(F.col("kind") == kind, F.array(F.pmod(F.xxhash64("size"), F.col(own)).cast("int")))
                 .when(F.col("kind") == 0, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col(own) - 1)))

    dealt = m.select("*", F.explode(place("na", 1)).alias("_a")).select("*", F.explode(place("nb", 2)).alias("_b"))
    fields = ["ntot", *part]
    schema = T.StructType([*[cm.schema[c] for c in by], *[T.StructField(c, T.DoubleType()) for c in (*fields, "emi")]])

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = pdf[pdf["kind"] == 1], pdf[pdf["kind"] == 2]
        total = int(pdf["ntot"].iloc[0])
        emi = sum(i * j * expected_term(x, y, total) for x, i in zip(a["size"].tolist(), a["labels"].tolist())
                  for y, j in zip(b["size"].tolist(), b["labels"].tolist()))
        return pdf.sort_values("kind")[[*by, *fields]].head(1).assign(emi=float(emi))

    return (dealt.groupBy(*by, "_a", "_b").applyInPandas(score, schema)
                 .groupBy(*by).agg(*[F.max(c).alias(c) for c in fields], F.sum("emi").alias("emi")))


def expected_term(a: int, b: int, total: int) -> float:
    """E[n/N ln(N n / (a b))] for the overlap n of random sets of sizes a and b among ``total``.

    The probabilities follow from the mode by the ratio of neighbours, out to
    where they are 0 in double arithmetic, and are divided by their sum, so
    no term that counts is left out and no large factorial is formed.
    """
    low, high = max(0, a + b - total), min(a, b)
    mode = min(max((a + 1) * (b + 1) // (total + 2), low), high)
    weight, value = 0.0, 0.0
    for up in (True, False):
        at, log_p, width = mode if up else mode - 1, 0.0, 64
        if not up:
            log_p = -_log_ratio(np.array([at], float), a, b, total)[0] if at >= low else 0.0
        while low <= at <= high:
            n = np.arange(at, min(at + width, high + 1) if up else max(at - width, low - 1), 1 if up else -1, dtype=float)
            step = _log_ratio(n if up else n - 1, a, b, total)
            logs = log_p + np.concatenate([[0.0], np.cumsum(step[:-1] if up else -step[:-1])])
            p = np.exp(logs)
            weight += p.sum()
            some = n >= 1
            value += (p[some] * n[some] / total * (np.log(total * n[some]) - np.log(float(a) * b))).sum()
            at = int(n[-1]) + (1 if up else -1)
            log_p, width = logs[-1] + (step[-1] if up else -step[-1]), min(width * 4, 1 << 20)
            if not log_p > -746.0:                 # exp() is 0 from here on
                break
    return value / weight


def _log_ratio(n: np.ndarray, a: int, b: int, total: int) -> np.ndarray:
    """ln of P(n + 1) / P(n); out of range it is -inf."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.log(np.maximum(a - n, 0)) + np.log(np.maximum(b - n, 0)) - np.log(n + 1) - np.log(np.maximum(total - a - b + n + 1, 0))


def calinski_harabasz(df: DataFrame, features: str = "features", cluster: str = "cluster",
                      by: Sequence[str] = ()) -> DataFrame:
    """[B/(k-1)] / [W/(n-k)]; null when k < 2, 1.0 when W = 0.

    One scan: count, mean and central second moment per (cluster, dimension)
    are one partial aggregation; the rest works on those k x d rows.
    """
    by = list(by)
    d = df.select(*by, F.col(cluster).alias("_c"), F.posexplode(F.col(features).cast("array<double>")).alias("dim", "x"))
    m = d.groupBy(*by, "_c", "dim").agg(F.count("x").alias("nk"), F.avg("x").alias("c"), F.var_pop("x").alias("v"))
    w = Window.partitionBy(*by, "dim")
    g = F.sum(F.col("nk") * F.col("c")).over(w) / F.sum("nk").over(w)
    m = m.withColumn("gap", F.col("c") - g)
    one = F.col("dim") == 0
    s = m.groupBy(*by).agg(F.sum(F.col("nk") * F.col("gap") * F.col("gap")).alias("B"),
                           F.sum(F.col("nk") * F.col("v")).alias("W"),
                           F.sum(F.when(one, F.col("nk"))).alias("n"),
                           F.sum(F.when(one, 1)).alias("k"))
    ch = (F.when(F.col("k") < 2, F.lit(None).cast("double"))
           .when(F.col("W") == 0, F.lit(1.0))
           .otherwise(F.col("B") * (F.col("n") - F.col("k")) / (F.col("W") * (F.col("k") - 1))))
    return s.select(*by, F.col("k").cast("bigint").alias("k"), ch.alias("calinski_harabasz"))


def cluster_sizes(df: DataFrame, cluster: str = "cluster", by: Sequence[str] = ()) -> DataFrame:
    """Count and percentage per cluster."""
    g = df.groupBy(*by, cluster).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    w = Window.partitionBy(*by)
    return g.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(w))


def silhouette(df: DataFrame, key: str, features: str = "features", cluster: str = "cluster",
               sample: int = 4800, seed: int = 100) -> DataFrame:
    """Mean Euclidean silhouette over a seeded sample of at most
    ``sample`` rows (the reference's sample size).

    The sample is bounded, so it is broadcast once; every task takes a
    slice of the sample and scores its points against the whole sample in
    numpy (mean distance to each cluster), so no pair is ever a row.
    A point alone in its cluster scores 0.  One row: ``(n, silhouette)``.
    """
    from orchard.operators.split import sample_n

    s = sample_n(df.select(key, features, cluster), key, sample, seed)
    pdf = s.toPandas()                                   # <= sample rows by construction
    if len(pdf) == 0:
        return df.sparkSession.createDataFrame([], "n BIGINT, silhouette DOUBLE")
    X = np.vstack(pdf[features].to_numpy()).astype(np.float64)
    labs = pdf[cluster].to_numpy()
    uniq, inv = np.unique(labs, return_inverse=True)
    counts = np.bincount(inv, minlength=len(uniq)).astype(np.float64)
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast((X, inv, counts))
    ids = spark.createDataFrame(pd.DataFrame({"i": np.arange(len(pdf), dtype=np.int64)}))

    def score(it):
        Xb, invb, cnt = bc.value
        k = len(cnt)
        for part in it:
            idx = part["i"].to_numpy()
            if len(idx) == 0:
                continue
            sq = np.einsum("ij,ij->i", Xb, Xb)
            d = np.sqrt(np.maximum(sq[idx][:, None] + sq[None, :] - 2.0 * (Xb[idx] @ Xb.T), 0.0))
            d[np.arange(len(idx)), idx] = 0.0
            sums = np.zeros((len(idx), k))
            for c in range(k):
                sums[:, c] = d[:, invb == c].sum(axis=1)
            own = invb[idx]
            own_n = cnt[own]
            a = np.where(own_n > 1, sums[np.arange(len(idx)), own] / np.maximum(own_n - 1, 1), 0.0)
            means = sums / cnt[None, :]
            means[np.arange(len(idx)), own] = np.inf
            b = means.min(axis=1) if k > 1 else np.zeros(len(idx))
            sv = np.where((own_n > 1) & (k > 1), (b - a) / np.maximum(np.maximum(a, b), 1e-300), 0.0)
            yield pd.DataFrame({"s": sv})

    per_point = ids.repartition(max(1, min(64, len(pdf) // 200 + 1))).mapInPandas(
        score, T.StructType([T.StructField("s", T.DoubleType())]))
    return per_point.agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.avg("s").alias("silhouette"))
