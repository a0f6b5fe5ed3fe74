"""Plan shapes: the scalability properties the operators rely on."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from orchard.operators.fitness import top_k
from orchard.operators.split import train_test_split
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hash_split_needs_no_shuffle(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    p = _plan(train_test_split(o, "o_orderkey", 0.3, 100).select("o_orderkey", "is_test"))
    assert "Exchange" not in p


def test_filters_and_columns_reach_the_scan(spark):
    df = E.queries()["p4_filter_class"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(label), EqualTo(label,3)" in p
    assert "ReadSchema: struct<vec_id:bigint,label:int>" in p


def test_top_k_limits_before_the_shuffle(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    p = _plan(top_k(ev, 3, ["event_type"], [F.col("value").desc(), F.col("event_id")]))
    assert "WindowGroupLimit" in p
    head, _, tail = p.partition("Exchange hashpartitioning(event_type")
    assert "Partial" in tail                      # the partial limit runs below the exchange


def test_aggregates_combine_map_side(spark):
    df = E.queries()["e17_optimum_summary"](spark, SF_SMALL)
    p = _plan(df)
    assert "partial_max_by" in p and "partial_count" in p
