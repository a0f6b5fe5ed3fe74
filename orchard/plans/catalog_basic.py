"""Registered queries: sources, projections, splits, scaling, scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from orchard.functions import scalar as N
from orchard.functions.hashing import sql_hash_u32
from orchard.operators import projection as P
from orchard.operators import split as S
from orchard.operators.evaluate import confusion, precision_recall, best_by_score
from orchard.operators.neighbours import centres_from, nearest_centre
from orchard.operators.ordering import running_extreme
from orchard.operators.reduce import project_2d, random_projection_matrix
from orchard.operators.scale import covariance, standard_scale
from orchard.plans.common import SPLIT_SEED, embeddings, r6, t
from orchard.plans.registry import register
from orchard.sources import tables as SRC

LI_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _li_key():
    return F.concat_ws(":", *[F.col(c).cast("string") for c in LI_KEYS])


SQL_LI_KEY = "concat_ws(':', l_orderkey, l_partkey, l_suppkey, l_linenumber)"


# ------------------------------------------------------------------ sources
@register("s2_read_headerless", """
SELECT CAST(l_orderkey AS DOUBLE) AS f0, CAST(l_partkey AS DOUBLE) AS f1, CAST(l_suppkey AS DOUBLE) AS f2,
       CAST(l_linenumber AS DOUBLE) AS f3, l_quantity AS f4, l_extendedprice AS f5, l_discount AS f6,
       l_tax AS label
FROM lineitem""")
def q_s2(spark, sf):
    li = t(spark, sf, "lineitem")
    text = li.select(F.concat_ws(",", *[F.col(c).cast("string") for c in LI_KEYS + LI_NUM]).alias("value"))
    n = len(text.first()["value"].split(",")) - 1        # arity from the first record
    return SRC.parse_delimited(text, "value", n)


@register("s3_row_count", "\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, CAST(count(*) AS BIGINT) AS n_rows FROM {n}" for n in SRC.TABLES))
def q_s3(spark, sf):
    return SRC.table_counts(spark, sf)


@register("s4_shape", f"""
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum(CASE WHEN ({sql_hash_u32('o_orderkey', SPLIT_SEED)} % 100) < 30 THEN 0 ELSE 1 END) AS BIGINT) AS n_train,
       CAST(6 AS BIGINT) AS n_cols,
       round(sum(CASE WHEN ({sql_hash_u32('o_orderkey', SPLIT_SEED)} % 100) < 30 THEN 0 ELSE 1 END) / count(*), 6) AS train_share
FROM orders""")
def q_s4(spark, sf):
    o = S.train_test_split(t(spark, sf, "orders"), "o_orderkey", 0.3, SPLIT_SEED)
    return SRC.shape(o, test_flag="is_test")


@register("s5_zip_columns", """
WITH z AS (SELECT page_id, string_split(url, '/') AS a, string_split(url, '.') AS b FROM pages),
e AS (SELECT page_id, a, b, unnest(range(1, least(len(a), len(b)) + 1)) AS i FROM z)
SELECT page_id, CAST(i AS BIGINT) AS idx, a[i] AS a, b[i] AS b FROM e""")
def q_s5(spark, sf):
    p = t(spark, sf, "pages").select("page_id", F.split("url", "/").alias("a"), F.split("url", "\\.").alias("b"))
    return SRC.zip_columns(p, ["a", "b"], keep=["page_id"], index_offset=1)


# ------------------------------------------------------------------ projection
@register("p1_features_label", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity AS f0, l_extendedprice AS f1,
       l_discount AS f2, l_tax AS f3, l_returnflag AS label
FROM lineitem""")
def q_p1(spark, sf):
    fl = P.features_label(t(spark, sf, "lineitem"), "l_returnflag", keep=LI_KEYS, features=LI_NUM)
    return fl.select(*LI_KEYS, *[F.col("features")[i].alias(f"f{i}") for i in range(4)], "label")


@register("p2_positional_split", """
SELECT o_orderkey,
       (row_number() OVER (ORDER BY o_orderkey) - 1) >=
       (SELECT count(*) - CAST(floor(count(*) * CAST(0.3 AS DOUBLE)) AS BIGINT) FROM orders) AS is_test
FROM orders""")
def q_p2(spark, sf):
    return P.positional_split(t(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.3)


@register("p3_every_nth", """
SELECT vec_id, label FROM (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS ri FROM embeddings)
WHERE ri % 10 = 0""")
def q_p3(spark, sf):
    return P.every_nth(t(spark, sf, "embeddings").select("vec_id", "label"), "vec_id", 10)


@register("p4_filter_class", "SELECT vec_id, label FROM embeddings WHERE label = 3 AND label BETWEEN 0 AND 9")
def q_p4(spark, sf):
    return P.filter_class(t(spark, sf, "embeddings").select("vec_id", "label"), 3, n_class=10)


@register("p5_threshold", """
SELECT CAST(CASE WHEN l_discount * 10 >= 0.5 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS pred, CAST(count(*) AS BIGINT) AS n
FROM lineitem GROUP BY 1""")
def q_p5(spark, sf):
    li = t(spark, sf, "lineitem")
    return (li.select(P.threshold(F.col("l_discount") * 10, 0.5).alias("pred"))
              .groupBy("pred").agg(F.count(F.lit(1)).cast("bigint").alias("n")))


@register("p6_head", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def q_p6(spark, sf):
    return P.head(t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), 10, "o_orderkey")


PLOT_SEED = 12        # seed of the plot projection (fixed value)


def _sql_plane() -> str:
    """plane(vec_id, x, y): the 2-D random projection (D7) of whole vectors."""
    R = random_projection_matrix(64, 2, PLOT_SEED)
    xy = ", ".join(f"list_sum(list_transform(list_zip(CAST(embedding AS DOUBLE[]), [{', '.join(repr(float(v)) for v in R[j])}]::DOUBLE[]), "
                   f"lambda p: p[1] * p[2])) AS {'xy'[j]}" for j in range(2))
    return f"plane AS (SELECT vec_id, {xy} FROM embeddings)"


def _plane(spark, sf):
    p = project_2d(embeddings(spark, sf), "grp", PLOT_SEED, out="xy")
    return p.select("vec_id", F.col("xy")[0].alias("x"), F.col("xy")[1].alias("y"))


@register("p7_bounds", lambda: f"""WITH {_sql_plane()}
SELECT round(min(x) - 1, 6) AS x_min, round(max(x) + 1, 6) AS x_max, round(min(y) - 1, 6) AS y_min, round(max(y) + 1, 6) AS y_max
FROM plane""")
def q_p7(spark, sf):
    b = P.bounds(_plane(spark, sf), ["x", "y"])
    return b.select(*[r6(c).alias(c) for c in b.columns])


MESH_H = 0.05      # lattice step of the decision-region grid (fixed value)


def _sql_mesh():
    return f"""
WITH {_sql_plane()},
b AS (SELECT min(x) - 1.0 AS x0, max(x) + 1.0 AS x1, min(y) - 1.0 AS y0, max(y) + 1.0 AS y1 FROM plane),
g AS (SELECT ix, iy, b.x0 + CAST(ix AS DOUBLE) * {MESH_H!r} AS x, b.y0 + CAST(iy AS DOUBLE) * {MESH_H!r} AS y
      FROM b, range(0, CAST(ceil((b.x1 - b.x0) / {MESH_H!r}) AS BIGINT)) AS rx(ix),
              range(0, CAST(ceil((b.y1 - b.y0) / {MESH_H!r}) AS BIGINT)) AS ry(iy)),
c AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS c, x AS cx, y AS cy FROM plane ORDER BY vec_id LIMIT 3),
d AS (SELECT ix, iy, c, (x - cx) * (x - cx) + (y - cy) * (y - cy) AS d FROM g, c),
r AS (SELECT ix, iy, c, row_number() OVER (PARTITION BY ix, iy ORDER BY d, c) AS rn FROM d)
SELECT ix, iy, CAST(c AS INTEGER) AS cluster FROM r WHERE rn = 1"""


@register("p8_mesh_grid", _sql_mesh)
def q_p8(spark, sf):
    plane = _plane(spark, sf).persist()
    bd = P.bounds(plane, ["x", "y"]).first()
    mesh = P.mesh_grid(spark, bd["x_min"], bd["x_max"], bd["y_min"], bd["y_max"], MESH_H)
    cents = centres_from(plane.select("vec_id", F.array("x", "y").alias("xy")), "xy", key="vec_id", k=3)
    plane.unpersist()
    lab = nearest_centre(mesh.select("ix", "iy", F.array("x", "y").alias("p")), cents, "p", "cluster")
    return lab.select("ix", "iy", "cluster")


# ------------------------------------------------------------------ splits
@register("t1_train_test_split", f"""
SELECT o_orderkey, ({sql_hash_u32('o_orderkey', SPLIT_SEED)} % 100) < 30 AS is_test FROM orders""")
def q_t1(spark, sf):
    return S.train_test_split(t(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.3, SPLIT_SEED)


@register("t2_sample_n", """
SELECT doc_id FROM documents ORDER BY md5(concat('100:', CAST(doc_id AS VARCHAR))), doc_id LIMIT 100""")
def q_t2(spark, sf):
    return S.sample_n(t(spark, sf, "documents").select("doc_id"), "doc_id", 100, SPLIT_SEED)


def _labelled_docs(spark, sf):
    lab = t(spark, sf, "labels")
    docs = t(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return lab.join(docs, "doc_id")


SQL_FOLDS = """folds AS (
  SELECT l.doc_id, l.quality,
         CAST((row_number() OVER (PARTITION BY l.quality ORDER BY l.doc_id) - 1) % 5 AS INTEGER) AS fold
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


@register("t3_stratified_kfold", f"WITH {SQL_FOLDS} SELECT doc_id, quality, fold FROM folds")
def q_t3(spark, sf):
    return S.stratified_kfold(_labelled_docs(spark, sf).select("doc_id", "quality"), "quality", "doc_id", 5)


def _sql_t4():
    step = (1.0 - 0.1) / 10
    return f"""WITH {SQL_FOLDS},
nm AS (SELECT count(*) - sum(CASE WHEN fold = 0 THEN 1 ELSE 0 END) AS n_max FROM folds),
ticks AS (SELECT tick, CASE WHEN tick = 10 THEN CAST(1.0 AS DOUBLE)
                            ELSE CAST(tick AS DOUBLE) * CAST('{step!r}' AS DOUBLE) + CAST(0.1 AS DOUBLE) END AS frac
          FROM range(0, 11) AS r(tick)),
s AS (SELECT CAST(tick AS INTEGER) AS tick,
             CAST(greatest(least(floor(frac * n_max), n_max), 1) AS BIGINT) AS train_size FROM ticks, nm)
SELECT CAST(min(tick) AS INTEGER) AS tick, train_size FROM s GROUP BY train_size"""


@register("t4_learning_sizes", _sql_t4)
def q_t4(spark, sf):
    folds = S.stratified_kfold(_labelled_docs(spark, sf).select("doc_id", "quality"), "quality", "doc_id", 5)
    return S.learning_sizes(folds, samples=11)


@register("t5_nested_prefix", f"""WITH {SQL_FOLDS},
r AS (SELECT doc_id, fold, cv_round FROM folds, range(0, 5) AS t(cv_round) WHERE cv_round <> fold)
SELECT doc_id, CAST(cv_round AS INTEGER) AS cv_round,
       CAST(row_number() OVER (PARTITION BY cv_round ORDER BY md5(concat('17:', CAST(doc_id AS VARCHAR))), doc_id) - 1
            AS BIGINT) AS prank
FROM r""")
def q_t5(spark, sf):
    folds = S.stratified_kfold(_labelled_docs(spark, sf).select("doc_id", "quality"), "quality", "doc_id", 5)
    return S.nested_prefix_ranks(folds, "doc_id", 5, seed=17).select("doc_id", "cv_round", "prank")


# ------------------------------------------------------------------ scaling
def _sql_d1():
    h = sql_hash_u32(SQL_LI_KEY, SPLIT_SEED)
    stats = ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}"
                      for c in LI_NUM)
    cols = ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in LI_NUM)
    return f"""WITH li AS (SELECT *, ({h} % 100) < 30 AS is_test FROM lineitem),
st AS (SELECT {stats} FROM li WHERE NOT is_test)
SELECT {', '.join(LI_KEYS)}, {cols} FROM li, st"""


@register("d1_standard_scale", _sql_d1)
def q_d1(spark, sf):
    li = t(spark, sf, "lineitem").select(*LI_KEYS, *LI_NUM)
    li = S.train_test_split(li.withColumn("_k", _li_key()), "_k", 0.3, SPLIT_SEED).drop("_k")
    sc = standard_scale(li.where(~F.col("is_test")), li, LI_NUM)
    return sc.select(*LI_KEYS, *[r6(c).alias(c) for c in LI_NUM])


@register("d2_covariance", """
WITH x AS (SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS v,
                  unnest(range(0, len(embedding))) AS i FROM embeddings)
SELECT CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, round(covar_samp(a.v, b.v), 9) AS cov
FROM x a JOIN x b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY a.i, b.i""")
def q_d2(spark, sf):
    cov = covariance(embeddings(spark, sf), "features")
    return cov.select("i", "j", F.round("cov", 9).alias("cov"))


# ------------------------------------------------------------------ scalars
@register("n_scalar_functions", """
SELECT event_id,
       coalesce(TRY_CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER), 0) AS n3_int,
       coalesce(TRY_CAST(props AS INTEGER), 0) AS n3_bad,
       coalesce(TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE), 0.0) AS n3_double,
       array_to_string(list_transform(string_split(concat(CAST(user_id - 75 AS VARCHAR), ',', event_type, ',',
                       CAST(event_id % 7 AS VARCHAR)), ','),
                       lambda x: CASE WHEN TRY_CAST(x AS INTEGER) > 0 THEN TRY_CAST(x AS INTEGER) ELSE 5 END), ',') AS n4_list,
       CASE WHEN value / 100 >= 1.0 THEN 0.99 WHEN value / 100 < 0.0 THEN 0.0 ELSE value / 100 END AS n5_gamma,
       greatest(value / 1000, 0.01) AS n5_epsilon,
       printf('%6.3f', value / 500 * 100.0) AS n7_pct,
       round(CAST(0 AS DOUBLE) + CAST(1 AS DOUBLE) * CAST(value AS DOUBLE) / CAST(2 AS DOUBLE), 6) AS n8_mid,
       CAST(CASE WHEN user_id % 2 = 0 THEN event_id % 2 ELSE 1 - event_id % 2 END AS BIGINT) AS n9_expect
FROM events""")
def q_n(spark, sf):
    ev = t(spark, sf, "events")
    lst = N.int_list(F.concat(F.col("user_id") - 75, F.lit(","), F.col("event_type"), F.lit(","),
                              F.col("event_id") % 7), 5)
    return ev.select(
        "event_id",
        N.parse_int_or_zero(F.regexp_extract("props", r"(\d+)", 1)).alias("n3_int"),
        N.parse_int_or_zero("props").alias("n3_bad"),
        N.parse_double_or_zero(F.col("value").cast("string")).alias("n3_double"),
        F.array_join(F.transform(lst, lambda x: x.cast("string")), ",").alias("n4_list"),
        N.clamp_gamma(F.col("value") / 100).alias("n5_gamma"),
        N.floor_epsilon(F.col("value") / 1000).alias("n5_epsilon"),
        N.format_pct(F.col("value") / 500).alias("n7_pct"),
        r6(F.element_at(N.linspace(F.lit(0.0), F.col("value"), F.lit(3)), 2)).alias("n8_mid"),
        N.parity_expected(F.col("event_id") % 2, F.col("user_id")).cast("bigint").alias("n9_expect"),
    )


@register("n6_dataset_id", "SELECT page_id, split_part(string_split(url, '/')[-1], '_', 1) AS dataset FROM pages")
def q_n6(spark, sf):
    return t(spark, sf, "pages").select("page_id", N.dataset_id("url").alias("dataset"))


# ------------------------------------------------------------------ joins / metrics on labels
@register("j3_align", """
SELECT l.doc_id, l.quality, l.toxic, d.lang, d.n_chars FROM labels l JOIN documents d ON l.doc_id = d.doc_id""")
def q_j3(spark, sf):
    return _labelled_docs(spark, sf).select("doc_id", "quality", "toxic", "lang", "n_chars")


@register("e1_confusion", """
SELECT quality AS truth, toxic AS pred, CAST(count(*) AS BIGINT) AS n FROM labels GROUP BY 1, 2""")
def q_e1(spark, sf):
    return confusion(t(spark, sf, "labels"), "quality", "toxic")


@register("e3_precision_recall", """
WITH c AS (SELECT quality AS t, toxic AS p FROM labels),
b AS (SELECT sum(CASE WHEN t = 1 AND p = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN p = 1 THEN 1 ELSE 0 END) AS pp,
             sum(CASE WHEN t = 1 THEN 1 ELSE 0 END) AS ap, count(*) AS n,
             sum(CASE WHEN t = p THEN 1 ELSE 0 END) AS hit FROM c),
cls AS (SELECT t AS k FROM c UNION SELECT p FROM c),
pc AS (SELECT k, (SELECT count(*) FROM c WHERE t = k AND p = k) AS tp, (SELECT count(*) FROM c WHERE p = k) AS pp,
              (SELECT count(*) FROM c WHERE t = k) AS ap FROM cls),
m AS (SELECT avg(CASE WHEN pp > 0 THEN tp / pp ELSE 0.0 END) AS pm, avg(CASE WHEN ap > 0 THEN tp / ap ELSE 0.0 END) AS rm,
             sum(CASE WHEN pp > 0 THEN tp / pp ELSE 0.0 END * ap) / sum(ap) AS pw,
             sum(CASE WHEN ap > 0 THEN tp / ap ELSE 0.0 END * ap) / sum(ap) AS rw FROM pc)
SELECT round(hit / n, 6) AS accuracy,
       round(CASE WHEN pp > 0 THEN tp / pp ELSE 0.0 END, 6) AS precision_binary,
       round(CASE WHEN ap > 0 THEN tp / ap ELSE 0.0 END, 6) AS recall_binary,
       round(hit / n, 6) AS precision_micro, round(hit / n, 6) AS recall_micro,
       round(pm, 6) AS precision_macro, round(rm, 6) AS recall_macro,
       round(pw, 6) AS precision_weighted, round(rw, 6) AS recall_weighted
FROM b, m""")
def q_e3(spark, sf):
    from orchard.operators.evaluate import AVERAGES, classification_scores
    s = classification_scores(t(spark, sf, "labels"), "quality", "toxic")
    return s.select(r6("accuracy").alias("accuracy"),
                    *[r6(f"{m}_{a}").alias(f"{m}_{a}") for a in AVERAGES for m in ("precision", "recall")])


# ------------------------------------------------------------------ windows / run tables
@register("w1_running_best", """
SELECT event_id, user_id,
       max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS best_so_far
FROM events""")
def q_w1(spark, sf):
    ev = t(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    return running_extreme(ev, ["ts", "event_id"], ["user_id"], "value").select("event_id", "user_id", "best_so_far")


@register("e17_optimum_summary", """
WITH r AS (SELECT event_type AS algo, event_id, value,
                  row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rn FROM events)
SELECT algo, CAST(count(*) AS BIGINT) AS n_runs, max(value) AS best_fitness,
       max(CASE WHEN rn = 1 THEN event_id END) AS best_run, round(avg(value), 6) AS mean_fitness
FROM r GROUP BY algo""")
def q_e17(spark, sf):
    from orchard.operators.fitness import optimum_summary
    ev = t(spark, sf, "events").select(F.col("event_type").alias("algo"), F.col("event_id").alias("run_id"),
                                       F.col("value").alias("fitness"))
    s = optimum_summary(ev, ["algo"], "fitness", "run_id")
    return s.select("algo", "n_runs", "best_fitness", "best_run", r6("mean_fitness").alias("mean_fitness"))


@register("e7_best_by_cv", """
WITH s AS (SELECT event_type, user_id, avg(value) AS score FROM events GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY score DESC, user_id) AS rn FROM s)
SELECT event_type, user_id, round(score, 6) AS score FROM r WHERE rn = 1""")
def q_e7(spark, sf):
    s = t(spark, sf, "events").groupBy("event_type", "user_id").agg(F.avg("value").alias("score"))
    b = best_by_score(s, "score", "user_id", by=["event_type"])
    return b.select("event_type", "user_id", r6("score").alias("score"))


@register("s6_report", f"""WITH {SQL_FOLDS},
f AS (SELECT fold, count(*) AS n, avg(CAST(quality AS DOUBLE)) AS share FROM folds GROUP BY fold)
SELECT fold, CAST(n AS BIGINT) AS n, round(share * 100.0, 6) AS share,
       CAST(floor(n / (SELECT count(*) FROM folds) * 100) AS BIGINT) AS pct FROM f""")
def q_s6(spark, sf):
    folds = S.stratified_kfold(_labelled_docs(spark, sf).select("doc_id", "quality"), "quality", "doc_id", 5)
    per = folds.groupBy("fold").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                    F.avg(F.col("quality").cast("double")).alias("share"))
    total = folds.count()
    return SRC.report(per, 100.0, score_cols=["share"], size_col="n", total=total)
