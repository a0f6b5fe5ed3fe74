"""Streaming episode summaries (M17) and confusion counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def read_events_stream(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """Parquet files of logged events arriving in ``path``."""
    return (spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", max_files)
                 .parquet(path))


def stream_episode_summary(events: DataFrame) -> DataFrame:
    """M17 on a stream: per episode (user) the number of logged steps and
    the total reward of steps after the first.  Stateful aggregation keyed
    by user; emit with output mode ``update`` (or ``complete``).

    The first step of an episode is the event with the smallest
    (ts, event_id); its reward is subtracted with ``min_by``, which is an
    aggregate and therefore streamable.
    """
    g = events.groupBy(F.col("user_id").alias("episode")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_steps"),
        F.sum("value").alias("_all"),
        F.min_by("value", F.struct("ts", "event_id")).alias("_first"))
    return g.select("episode", "n_steps", (F.col("_all") - F.col("_first")).alias("total_reward"))


def stream_confusion(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """E1 on a stream: running (truth, pred) counts."""
    return df.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


def run_to_table(df: DataFrame, query_name: str, checkpoint: str, mode: str = "update"):
    """Drive a streaming aggregate into an in-memory table until the input
    is exhausted (for batch-style checks); returns the finished query."""
    q = (df.writeStream.outputMode(mode).format("memory").queryName(query_name)
           .option("checkpointLocation", checkpoint).start())
    q.processAllAvailable()
    q.stop()
    return q
