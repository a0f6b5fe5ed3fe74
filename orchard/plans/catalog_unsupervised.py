"""Registered queries: centres, clustering scores, projections, fitness
scoring and feed-forward scoring (all exact, with DuckDB twins)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from orchard.functions.hashing import hash_u32
from orchard.operators import fitness as FT
from orchard.operators.classify import nn_forward, nn_weights, rff_matrix, rff_map, sum_squares_error
from orchard.operators.cluster import inertia, lloyd_step
from orchard.operators.evaluate import calinski_harabasz, cluster_scores, cluster_sizes, silhouette
from orchard.operators.neighbours import centres_from, nearest_centre
from orchard.operators.projection import threshold
from orchard.operators.reduce import augment_with_cluster, gaussian_random_projection, random_projection_matrix
from orchard.operators.scale import standard_scale
from orchard.plans.common import embeddings, r6, t
from orchard.plans.registry import register

K_CENTRES = 10        # centres = first 10 vectors by id (fixed value of the checks)

SQL_E = "e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
SQL_ASSIGN = f"""{SQL_E},
c AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS c, v AS cv FROM e ORDER BY vec_id LIMIT {K_CENTRES}),
d AS (SELECT e.vec_id, e.label, e.v, c.c,
             list_sum(list_transform(list_zip(e.v, c.cv), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM e, c),
a AS (SELECT vec_id, label, v, CAST(c AS INTEGER) AS cluster, d FROM (
        SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, c) AS rn FROM d) WHERE rn = 1)"""


def _assigned(spark, sf, with_distance=False):
    e = embeddings(spark, sf)
    cents = centres_from(e, "features", key="vec_id", k=K_CENTRES)
    return e, cents, nearest_centre(e, cents, "features", "cluster", with_distance=with_distance)


@register("j1_nearest_centre", f"WITH {SQL_ASSIGN} SELECT vec_id, cluster FROM a")
def q_j1(spark, sf):
    return _assigned(spark, sf)[2].select("vec_id", "cluster")


@register("g2_lloyd_step", f"""WITH {SQL_ASSIGN},
x AS (SELECT cluster, unnest(v) AS xv, unnest(range(0, len(v))) AS dim FROM a)
SELECT cluster, CAST(dim AS INTEGER) AS dim, round(avg(xv), 9) AS centre, CAST(count(*) AS BIGINT) AS n
FROM x GROUP BY cluster, dim""")
def q_g2(spark, sf):
    e, cents, _ = _assigned(spark, sf)
    st = lloyd_step(e, cents)
    return st.select("cluster", F.col("dim").cast("int").alias("dim"), F.round("centre", 9).alias("centre"),
                     F.col("n").cast("bigint").alias("n"))


@register("g3_inertia", f"WITH {SQL_ASSIGN} SELECT round(sum(d), 6) AS inertia, CAST(count(*) AS BIGINT) AS n FROM a")
def q_g3(spark, sf):
    e, cents, _ = _assigned(spark, sf)
    return inertia(e, cents).select(r6("inertia").alias("inertia"), "n")


def _sql_scores(src: str, truth: str, pred: str) -> str:
    """Contingency-based scores in SQL (natural logs, DuckDB lgamma)."""
    return f"""cm AS (SELECT {truth} AS t, {pred} AS p, count(*) AS nij FROM {src} GROUP BY 1, 2),
tot AS (SELECT CAST(sum(nij) AS DOUBLE) AS n FROM cm),
ai AS (SELECT t, CAST(sum(nij) AS BIGINT) AS a FROM cm GROUP BY t),
bj AS (SELECT p, CAST(sum(nij) AS BIGINT) AS b FROM cm GROUP BY p),
mi AS (SELECT greatest(sum(nij / n * (ln(nij) + ln(n) - ln(a) - ln(b))), 0.0) AS mi
       FROM cm JOIN ai USING (t) JOIN bj USING (p), tot),
h AS (SELECT greatest(ln(n) - (SELECT sum(a * ln(a)) FROM ai) / n, 0.0) AS ht,
             greatest(ln(n) - (SELECT sum(b * ln(b)) FROM bj) / n, 0.0) AS hp,
             (SELECT count(*) FROM ai) AS kt, (SELECT count(*) FROM bj) AS kp FROM tot),
pc AS (SELECT (SELECT sum(CAST(nij AS DOUBLE) * nij) FROM cm) AS s2,
              (SELECT sum(CAST(a AS DOUBLE) * a) FROM ai) AS sa2,
              (SELECT sum(CAST(b AS DOUBLE) * b) FROM bj) AS sb2),
emi AS (SELECT sum(nn / n * (ln(n * nn) - ln(CAST(a AS DOUBLE) * b)) *
                   exp(lgamma(a + 1) + lgamma(b + 1) + lgamma(n - a + 1) + lgamma(n - b + 1) - lgamma(n + 1)
                       - lgamma(nn + 1) - lgamma(a - nn + 1) - lgamma(b - nn + 1) - lgamma(n - a - b + nn + 1))) AS emi
        FROM (SELECT a, b, n, unnest(range(greatest(1, CAST(a + b - n AS BIGINT)), least(a, b) + 1)) AS nn
              FROM ai, bj, tot)),
pur AS (SELECT sum(m) AS maj FROM (SELECT p, max(nij) AS m FROM cm GROUP BY p)),
hits AS (SELECT coalesce(sum(nij) FILTER (WHERE t = p), 0) AS hit FROM cm),
sc AS (SELECT n, hit / n AS raw_accuracy, maj / n AS purity,
              CASE WHEN ht = 0 THEN 1.0 ELSE mi / ht END AS hom, CASE WHEN hp = 0 THEN 1.0 ELSE mi / hp END AS com,
              s2 - n AS tp, sb2 - s2 AS fp, sa2 - s2 AS fn, n * n - (sb2 - s2) - (sa2 - s2) - s2 AS tn,
              mi, emi, ht, hp, kt, kp
       FROM tot, mi, h, pc, emi, pur, hits)
SELECT CAST(n AS BIGINT) AS n, round(raw_accuracy, 6) AS raw_accuracy, round(purity, 6) AS purity,
       round(hom, 6) AS homogeneity, round(com, 6) AS completeness,
       round(CASE WHEN hom + com = 0 THEN 0.0 ELSE 2 * hom * com / (hom + com) END, 6) AS v_measure,
       round(CASE WHEN fn = 0 AND fp = 0 THEN 1.0
                  ELSE 2.0 * (tp * tn - fn * fp) / ((tp + fn) * (fn + tn) + (tp + fp) * (fp + tn)) END, 6) AS adjusted_rand,
       round(CASE WHEN kt = 1 AND kp = 1 THEN 1.0
                  ELSE (mi - emi) / (CASE WHEN (ht + hp) / 2 - emi < 0 THEN least((ht + hp) / 2 - emi, -2.220446049250313e-16)
                                          ELSE greatest((ht + hp) / 2 - emi, 2.220446049250313e-16) END) END, 6)
         AS adjusted_mutual_info
FROM sc"""


def _round_scores(df):
    return df.select("n", *[r6(c).alias(c) for c in df.columns if c != "n"])


@register("e9_cluster_scores", lambda: f"WITH {SQL_ASSIGN},\n{_sql_scores('a', 'label', 'cluster')}")
def q_e9(spark, sf):
    return _round_scores(cluster_scores(_assigned(spark, sf)[2], "label", "cluster"))


@register("e13_cluster_scores_labels", lambda: f"WITH {_sql_scores('labels', 'quality', 'toxic')}")
def q_e13(spark, sf):
    return _round_scores(cluster_scores(t(spark, sf, "labels"), "quality", "toxic"))


@register("e14_silhouette", f"""WITH {SQL_E},
s AS (SELECT * FROM e ORDER BY md5(concat('100:', CAST(vec_id AS VARCHAR))), vec_id LIMIT 4800),
cn AS (SELECT label, count(*) AS cnt FROM s GROUP BY label),
pd AS (SELECT x.vec_id, x.label AS own, y.label AS other,
              sqrt(list_sum(list_transform(list_zip(x.v, y.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS d
       FROM s x, s y WHERE x.vec_id <> y.vec_id),
m AS (SELECT vec_id, own, other, sum(d) AS sd FROM pd GROUP BY ALL),
ab AS (SELECT m.vec_id, m.own,
              max(CASE WHEN m.other = m.own THEN m.sd / (cn.cnt - 1) END) AS a,
              min(CASE WHEN m.other <> m.own THEN m.sd / cn.cnt END) AS b
       FROM m JOIN cn ON cn.label = m.other GROUP BY m.vec_id, m.own),
pts AS (SELECT s.vec_id, CASE WHEN c.cnt > 1 AND (SELECT count(*) FROM cn) > 1
                              THEN (ab.b - ab.a) / greatest(ab.a, ab.b) ELSE 0.0 END AS sv
        FROM s JOIN cn c ON c.label = s.label LEFT JOIN ab ON ab.vec_id = s.vec_id)
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(sv), 6) AS silhouette FROM pts""")
def q_e14(spark, sf):
    e = embeddings(spark, sf).withColumnRenamed("label", "cluster")
    return silhouette(e, "vec_id", "features", "cluster", 4800, 100).select("n", r6("silhouette").alias("silhouette"))


@register("e15_calinski_harabasz", f"""WITH {SQL_E},
x AS (SELECT label, unnest(v) AS xv, unnest(range(0, len(v))) AS dim FROM e),
c AS (SELECT label, dim, avg(xv) AS c, count(*) AS nk FROM x GROUP BY ALL),
g AS (SELECT dim, avg(xv) AS g FROM x GROUP BY dim),
b AS (SELECT sum(nk * (c - g) * (c - g)) AS bb FROM c JOIN g USING (dim)),
w AS (SELECT sum((xv - c) * (xv - c)) AS ww FROM x JOIN c USING (label, dim)),
s AS (SELECT count(*) AS n, count(DISTINCT label) AS k FROM e)
SELECT CAST(k AS BIGINT) AS k,
       round(CASE WHEN k < 2 THEN NULL WHEN ww = 0 THEN 1.0 ELSE bb * (n - k) / (ww * (k - 1)) END, 6) AS calinski_harabasz
FROM b, w, s""")
def q_e15(spark, sf):
    ch = calinski_harabasz(embeddings(spark, sf), "features", "label")
    return ch.select("k", r6("calinski_harabasz").alias("calinski_harabasz"))


@register("e16_cluster_sizes", f"""WITH {SQL_ASSIGN}
SELECT cluster, CAST(count(*) AS BIGINT) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct
FROM a GROUP BY cluster""")
def q_e16(spark, sf):
    s = cluster_sizes(_assigned(spark, sf)[2], "cluster")
    return s.select("cluster", "n", r6("pct").alias("pct"))


@register("d8_augment_with_cluster", f"""WITH {SQL_ASSIGN}
SELECT vec_id, CAST(len(v) + 1 AS INTEGER) AS n_features, CAST(cluster AS DOUBLE) AS f0, md5(array_to_string(v, ',')) AS rest
FROM (SELECT vec_id, cluster, list_transform(v, lambda x: CAST(round(x * 1000000) AS BIGINT)) AS v FROM a)""")
def q_d8(spark, sf):
    aug = augment_with_cluster(_assigned(spark, sf)[2], "cluster", "features")
    return aug.select("vec_id", F.size("features").alias("n_features"), F.col("features")[0].alias("f0"),
                      F.md5(F.array_join(F.transform(F.slice("features", 2, 1 << 20), lambda x: F.round(x * 1000000).cast("bigint")
                                                     .cast("string")), ",")).alias("rest"))


GRP_SEED = 12         # seed of the plot projection (fixed value)


def _sql_grp():
    R = random_projection_matrix(64, 2, GRP_SEED)
    cols = []
    for j in range(2):
        lst = ", ".join(repr(float(v)) for v in R[j])
        cols.append(f"round(list_sum(list_transform(list_zip(v, [{lst}]::DOUBLE[]), lambda p: p[1] * p[2])), 6) AS p{j}")
    return f"WITH {SQL_E} SELECT vec_id, {', '.join(cols)} FROM e"


@register("d6_random_projection", _sql_grp)
def q_d6(spark, sf):
    p = gaussian_random_projection(embeddings(spark, sf), 2, GRP_SEED, d=64)
    return p.select("vec_id", r6(F.col("reduced")[0]).alias("p0"), r6(F.col("reduced")[1]).alias("p1"))


RFF_SEED, RFF_D = 3, 8


def _sql_rff():
    W, b = rff_matrix(64, RFF_D, 1.0 / 64, RFF_SEED)
    sc = (2.0 / RFF_D) ** 0.5
    cols = []
    for i in range(RFF_D):
        lst = ", ".join(repr(float(v)) for v in W[i])
        cols.append(f"round({sc!r} * cos(list_sum(list_transform(list_zip(v, [{lst}]::DOUBLE[]), lambda p: p[1] * p[2]))"
                    f" + {float(b[i])!r}), 6) AS z{i}")
    return f"WITH {SQL_E} SELECT vec_id, {', '.join(cols)} FROM e"


@register("c8_rff_map", _sql_rff)
def q_c8_rff(spark, sf):
    z = rff_map(embeddings(spark, sf), RFF_D, 1.0 / 64, RFF_SEED, out="z")
    return z.select("vec_id", *[r6(F.col("z")[i]).alias(f"z{i}") for i in range(RFF_D)])


# ------------------------------------------------------------------ fitness
BITS_N, BITS_SEED = 100, 5
COL_N, COL_K, COL_SEED = 20, 10, 11


def _sql_bits(n, rng, seed, name="bits"):
    return (f"list_transform(range(0, {n}), lambda i: CAST((('0x' || substr(md5(concat('{seed}:', "
            f"CAST(event_id AS VARCHAR), ':', CAST(i AS VARCHAR))), 1, 8))::BIGINT % {rng}) AS INTEGER)) AS {name}")


def _bits(spark, sf, n=BITS_N, rng=2, seed=BITS_SEED):
    ev = t(spark, sf, "events").select("event_id")
    return FT.uniform_candidates(ev, "event_id", n, rng, seed)


@register("f5_uniform_candidates", f"""SELECT event_id, array_to_string({_sql_bits(BITS_N, 2, BITS_SEED, 'b')[:-5]}, '') AS bits
FROM events""")
def q_f5(spark, sf):
    return _bits(spark, sf).select("event_id", F.array_join(F.col("bits").cast("array<string>"), "").alias("bits"))


SQL_ALT = ("list_sum(list_transform(range(0, len(bits)), lambda i: CASE WHEN bits[i + 1] = "
           "CASE WHEN i % 2 = 0 THEN (CASE WHEN bits[1] = 0 THEN 0 ELSE 1 END) "
           "ELSE 1 - (CASE WHEN bits[1] = 0 THEN 0 ELSE 1 END) END THEN 1 ELSE 0 END))")


@register("f1_alternating_bits", f"""WITH c AS (SELECT event_id, {_sql_bits(BITS_N, 2, BITS_SEED)} FROM events)
SELECT event_id, CAST({SQL_ALT} AS INTEGER) AS fitness FROM c""")
def q_f1(spark, sf):
    return _bits(spark, sf).select("event_id", FT.alternating_bits("bits").cast("int").alias("fitness"))


@register("f2_four_peaks", f"""WITH c AS (SELECT event_id, {_sql_bits(BITS_N, 2, BITS_SEED)} FROM events),
h AS (SELECT event_id, len(bits) AS n,
             CASE WHEN coalesce(list_position(bits, 0), 0) = 0 THEN len(bits) ELSE list_position(bits, 0) - 1 END AS head,
             CASE WHEN coalesce(list_position(list_reverse(bits), 1), 0) = 0 THEN len(bits)
                  ELSE list_position(list_reverse(bits), 1) - 1 END AS tail FROM c)
SELECT event_id, CAST(greatest(head, tail) + CASE WHEN head > n // 10 AND tail > n // 10 THEN n ELSE 0 END AS INTEGER)
       AS fitness FROM h""")
def q_f2(spark, sf):
    return _bits(spark, sf).select("event_id", FT.four_peaks("bits").alias("fitness"))


@register("f3_kcolour_graph", """WITH n AS (SELECT count(DISTINCT user_id) AS n FROM events)
SELECT CAST(src AS INTEGER) AS src, CAST(unnest(range(src + 2, greatest(n, 3), 2)) AS INTEGER) AS dst
FROM n, range(0, greatest(n, 3) - 1) AS s(src) WHERE src + 2 <= greatest(n, 3) - 1""")
def q_f3(spark, sf):
    n = t(spark, sf, "events").agg(F.countDistinct("user_id")).first()[0]
    return FT.kcolour_graph(spark, int(n))


def _colours(spark, sf):
    return _bits(spark, sf, COL_N, COL_K, COL_SEED).withColumnRenamed("bits", "colours")


SQL_COLOUR_FIT = f"""c AS (SELECT event_id AS cand_id, CAST(i AS INTEGER) AS node,
              CAST((('0x' || substr(md5(concat('{COL_SEED}:', CAST(event_id AS VARCHAR), ':', CAST(i AS VARCHAR))), 1, 8))::BIGINT
                    % {COL_K}) AS INTEGER) AS colour
       FROM events, range(0, {COL_N}) AS r(i)),
e AS (SELECT src, unnest(range(src + 2, {COL_N}, 2)) AS dst FROM range(0, {COL_N - 1}) AS s(src) WHERE src + 2 <= {COL_N - 1}),
bad AS (SELECT DISTINCT a.cand_id, a.node FROM c a JOIN e ON e.src = a.node
        JOIN c b ON b.cand_id = a.cand_id AND b.node = e.dst AND b.colour = a.colour),
fit AS (SELECT k.cand_id, CAST({COL_N} - count(bad.node) AS INTEGER) AS fitness
        FROM (SELECT DISTINCT cand_id FROM c) k LEFT JOIN bad ON bad.cand_id = k.cand_id GROUP BY k.cand_id)"""


@register("f4_kcolour_fitness", f"WITH {SQL_COLOUR_FIT} SELECT cand_id AS event_id, fitness FROM fit")
def q_f4(spark, sf):
    return _colours(spark, sf).select("event_id", FT.kcolour_fitness("colours", COL_N).alias("fitness"))


@register("j4_conflict_join", f"WITH {SQL_COLOUR_FIT} SELECT cand_id, fitness FROM fit")
def q_j4(spark, sf):
    cols = _colours(spark, sf).select(F.col("event_id").alias("cand_id"),
                                      F.posexplode("colours").alias("node", "colour"))          # 90 edges a candidate, 58 pairs of one colour
    return FT.conflict_join(FT.kcolour_graph(spark, COL_N), cols.select("cand_id", F.col("node").cast("int"), "colour"), by_colour=True)


NB_N, NB_SEED = 20, 7


@register("f6_one_element_neighbours", f"""WITH c AS (SELECT event_id, {_sql_bits(NB_N, 2, NB_SEED)} FROM events),
nb AS (SELECT c.event_id, p.pos, v.val,
              list_transform(range(0, {NB_N}), lambda i: CASE WHEN i = p.pos THEN v.val ELSE c.bits[i + 1] END) AS nb
       FROM c, range(0, {NB_N}) AS p(pos), range(0, 2) AS v(val) WHERE c.bits[p.pos + 1] <> v.val)
SELECT event_id, CAST(pos AS INTEGER) AS pos, CAST(val AS INTEGER) AS val,
       CAST(list_sum(nb) AS INTEGER) AS ones FROM nb""")
def q_f6(spark, sf):
    c = _bits(spark, sf, NB_N, 2, NB_SEED)
    nb = FT.one_element_neighbours(c, "bits", 2, out="nb", n=NB_N)
    ones = F.aggregate("nb", F.lit(0), lambda a, x: a + x)
    return nb.select("event_id", F.col("pos").cast("int").alias("pos"), F.col("val").cast("int").alias("val"),
                     ones.cast("int").alias("ones"))


@register("f7_top_k_neighbours", f"""WITH c AS (SELECT event_id, {_sql_bits(NB_N, 2, NB_SEED)} FROM events),
nb AS (SELECT event_id, pos, val,
              list_transform(range(0, len(bits)), lambda i: CASE WHEN i = pos THEN val ELSE bits[i + 1] END) AS bits
       FROM (SELECT c.*, p.pos, v.val FROM c, range(0, {NB_N}) AS p(pos), range(0, 2) AS v(val)
             WHERE c.bits[p.pos + 1] <> v.val)),
s AS (SELECT event_id, CAST(pos AS INTEGER) AS pos, CAST(val AS INTEGER) AS val, CAST({SQL_ALT} AS INTEGER) AS score FROM nb),
r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY score DESC, pos, val) AS rank FROM s)
SELECT event_id, pos, val, score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3""")
def q_f7(spark, sf):
    c = _bits(spark, sf, NB_N, 2, NB_SEED)
    nb = FT.one_element_neighbours(c, "bits", 2, out="nb", n=NB_N)
    s = nb.select("event_id", F.col("pos").cast("int").alias("pos"), F.col("val").cast("int").alias("val"),
                  FT.alternating_bits("nb").cast("int").alias("score"))
    top = FT.top_k(s, 3, ["event_id"], [F.col("score").desc(), F.col("pos"), F.col("val")])
    return top.select("event_id", "pos", "val", "score", F.col("rank").cast("int").alias("rank"))


# ------------------------------------------------------------------ feed-forward scoring
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
NET_LAYERS, NET_SEED = [4, 5, 1], 42


def _sql_net():
    Ws = nn_weights(NET_LAYERS, NET_SEED)
    stats = ", ".join(f"avg({c}) AS m{i}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s{i}"
                      for i, c in enumerate(LI_NUM))
    xs = ", ".join(f"({c} - m{i}) / s{i} AS x{i}" for i, c in enumerate(LI_NUM))
    hid = []
    for j, row in enumerate(Ws[0]):
        z = f"{float(row[0])!r}" + "".join(f" + {float(w)!r} * x{i}" for i, w in enumerate(row[1:]))
        hid.append(f"tanh({z}) AS h{j}")
    out = Ws[1][0]
    zo = f"{float(out[0])!r}" + "".join(f" + {float(w)!r} * h{i}" for i, w in enumerate(out[1:]))
    return f"""st AS (SELECT {stats} FROM lineitem),
x AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
             CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS y, {xs} FROM lineitem, st),
h AS (SELECT *, {', '.join(hid)} FROM x),
o AS (SELECT *, 1.0 / (1.0 + exp(-({zo}))) AS score FROM h)"""


def _net_scores(spark, sf):
    li = t(spark, sf, "lineitem")
    sc = standard_scale(li, li, LI_NUM)
    feats = sc.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                      F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("y"),
                      F.array(*LI_NUM).alias("features"))
    return nn_forward(feats, nn_weights(NET_LAYERS, NET_SEED), "features", "score")


@register("c9_nn_forward", lambda: f"""WITH {_sql_net()}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(score, 6) AS score,
       CAST(CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS pred FROM o""")
def q_c9(spark, sf):
    s = _net_scores(spark, sf)
    return s.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", r6("score").alias("score"),
                    threshold("score", 0.5).alias("pred"))


@register("c10_sum_squares_error", lambda: f"""WITH {_sql_net()}
SELECT round(sum((y - score) * (y - score)), 4) AS sse, CAST(count(*) AS BIGINT) AS n,
       CAST(sum(CASE WHEN (CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END) = y THEN 1 ELSE 0 END) AS BIGINT) AS correct
FROM o""")
def q_c10(spark, sf):
    s = _net_scores(spark, sf)
    hit = F.sum((threshold("score", 0.5) == F.col("y")).cast("int")).cast("bigint").alias("correct")
    return sum_squares_error(s, "y", "score", extra=[hit]).select(F.round("sse", 4).alias("sse"), "n", "correct")
