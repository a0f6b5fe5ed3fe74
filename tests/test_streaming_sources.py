"""Streaming aggregates and file sources."""

import tempfile

from pyspark.sql import functions as F

from orchard.operators import mdp as M
from orchard.operators.fitness import alternating_bits, score_candidates
from orchard.sources.tables import param_grid, read_headerless, read_labelled_csv
from orchard.streaming.episodes import read_events_stream, run_to_table, stream_episode_summary
from tests.conftest import SF_SMALL


def test_streaming_episode_summary_equals_batch(spark):
    ck = tempfile.mkdtemp(prefix="orchard-stream-", dir="/tmp")
    src = tempfile.mkdtemp(prefix="orchard-src-", dir="/tmp")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ev.repartition(3).write.mode("overwrite").parquet(src)
    run_to_table(stream_episode_summary(read_events_stream(spark, src)), "episodes_s", ck, "complete")
    got = {r["episode"]: (r["n_steps"], round(r["total_reward"], 6)) for r in spark.table("episodes_s").collect()}
    want = {r["episode"]: (r["n_steps"], round(r["total_reward"], 6))
            for r in M.episode_summary(ev).collect()}
    assert got == want


def test_labelled_csv_and_headerless_readers(spark):
    d = tempfile.mkdtemp(prefix="orchard-csv-", dir="/tmp")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_quantity", "l_discount", "l_tax")
    li.coalesce(1).write.mode("overwrite").option("header", "true").csv(f"{d}/h")
    li.coalesce(1).write.mode("overwrite").option("header", "false").csv(f"{d}/n")
    a = read_labelled_csv(spark, f"{d}/h", label=-1)
    assert a.count() == li.count() and len(a.first()["features"]) == 2
    b = read_headerless(spark, f"{d}/n")
    assert b.columns == ["f0", "f1", "label"] and b.count() == li.count()
    assert abs(b.agg(F.sum("label")).first()[0] - li.agg(F.sum("l_tax")).first()[0]) < 1e-6


def test_param_grid_is_cross_product(spark):
    g = param_grid(spark, depth=[3, 4, 5], k=[1, 5], kernel=["linear", "rbf"])
    assert g.count() == 12 and g.distinct().count() == 12


def test_score_candidates_column_and_pandas(spark):
    df = spark.createDataFrame([([0, 1, 0, 1],), ([1, 1, 1, 1],)], "bits array<int>")
    a = [r[0] for r in score_candidates(df, alternating_bits, out="f").select("f").collect()]
    b = [r[0] for r in score_candidates(df, lambda x: float(x.sum()), out="f", python=True).select("f").collect()]
    assert a == [4, 2] and b == [2.0, 4.0]
