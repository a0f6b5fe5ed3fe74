"""Registered queries: splits, neighbours, classifier scoring, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from orchard.operators.evaluate import classification_scores
from orchard.operators.neighbours import knn_classify, knn_join
from orchard.plans.common import SQL_EMB, embeddings, r6
from orchard.plans.registry import register

KNN_KS = list(range(1, 11))   # k = 1..10 (fixed sweep of the kNN experiment)


def _sql_neigh(k_max: int) -> str:
    return f"""WITH {SQL_EMB},
tr AS (SELECT * FROM emb WHERE NOT is_test),
q AS (SELECT * FROM emb WHERE is_test),
d AS (SELECT q.vec_id AS qid, tr.vec_id AS nid, tr.label AS nlabel,
             list_sum(list_transform(list_zip(q.v, tr.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS sqdist
      FROM q, tr),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY sqdist, nid) AS rank FROM d)
"""


SQL_J2 = _sql_neigh(5) + """SELECT qid, nid, CAST(nlabel AS BIGINT) AS nlabel, CAST(rank AS INTEGER) AS rank,
       round(sqdist, 6) AS sqdist
FROM r WHERE rank <= 5"""


@register("j2_knn_join", SQL_J2)
def q_knn_join(spark, sf):
    e = embeddings(spark, sf)
    nb = knn_join(e.where(~F.col("is_test")), e.where(F.col("is_test")), 5, "vec_id", "vec_id")
    return nb.select("qid", "nid", "nlabel", "rank", r6("sqdist").alias("sqdist"))


SQL_C6 = _sql_neigh(10) + """,
ks AS (SELECT unnest(range(1, 11)) AS k),
v AS (SELECT ks.k, r.qid, r.nlabel, count(*) AS votes FROM r JOIN ks ON r.rank <= ks.k GROUP BY ALL),
p AS (SELECT k, qid, nlabel AS prediction,
             row_number() OVER (PARTITION BY k, qid ORDER BY votes DESC, nlabel) AS rn FROM v),
s AS (SELECT p.k, p.qid, p.prediction, emb.label FROM p JOIN emb ON emb.vec_id = p.qid WHERE rn = 1),
acc AS (SELECT k, count(*) AS n, sum(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS correct FROM s GROUP BY k),
cls AS (SELECT k, label AS c FROM s UNION SELECT k, prediction AS c FROM s),
pc AS (SELECT cls.k, cls.c,
              (SELECT count(*) FROM s WHERE s.k = cls.k AND s.label = cls.c AND s.prediction = cls.c) AS tp,
              (SELECT count(*) FROM s WHERE s.k = cls.k AND s.prediction = cls.c) AS pp,
              (SELECT count(*) FROM s WHERE s.k = cls.k AND s.label = cls.c) AS ap
       FROM cls),
m AS (SELECT k, avg(CASE WHEN pp > 0 THEN tp / pp ELSE 0.0 END) AS precision_macro,
             avg(CASE WHEN ap > 0 THEN tp / ap ELSE 0.0 END) AS recall_macro FROM pc GROUP BY k)
SELECT CAST(acc.k AS INTEGER) AS k, CAST(n AS BIGINT) AS n, CAST(correct AS BIGINT) AS correct,
       round(correct / n, 6) AS accuracy, round(precision_macro, 6) AS precision_macro,
       round(recall_macro, 6) AS recall_macro
FROM acc JOIN m ON acc.k = m.k"""


@register("c6_knn_sweep", SQL_C6)
def q_knn_sweep(spark, sf):
    e = embeddings(spark, sf)
    pred = knn_classify(e.where(~F.col("is_test")), e.where(F.col("is_test")), KNN_KS, "vec_id", "vec_id")
    s = classification_scores(pred, "label", "prediction", by=["k"])
    return (s
               .select(F.col("k").cast("int").alias("k"), "n", "correct", r6("accuracy").alias("accuracy"),
                       r6("precision_macro").alias("precision_macro"), r6("recall_macro").alias("recall_macro")))
