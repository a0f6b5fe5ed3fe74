"""Shared inputs of the registered queries (views over the driver tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.functions.hashing import sql_hash_u32
from orchard.operators.split import train_test_split
from orchard.sources.tables import read_table

SPLIT_SEED = 100      # holdout seed of the supervised experiments (fixed value)
TEST_FRAC = 0.3       # default holdout share (fixed value)


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """``(vec_id, features ARRAY<DOUBLE>, label, is_test)``."""
    e = t(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("features"),
                                          "label")
    return train_test_split(e, "vec_id", TEST_FRAC, SPLIT_SEED)


SQL_EMB = f"""emb AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label,
         ({sql_hash_u32('vec_id', SPLIT_SEED)} % 100) < {int(TEST_FRAC * 100)} AS is_test
  FROM embeddings)"""


def r6(c):
    return F.round(c if not isinstance(c, str) else F.col(c), 6)
