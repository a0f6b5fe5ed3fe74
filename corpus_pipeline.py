"""Training-corpus pipeline over ``documents``: five stages of the operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's input.  All stages but
the last return the columns of ``documents``; the last returns the packing
plan, one row per document piece.  Every stage works on all rows that its
predecessor kept.

Order: quality classifier (rejected documents go), n-gram Jaccard join (the
document with the smallest id of each group of linked documents stays),
substring dedup (repeated passages go, ``n_chars`` follows the text),
benchmark decontamination (documents that hold a test item go), best-fit
packing.

Defined cases: rows whose doc_id is null cannot be named and pass the
filters; rows that repeat a doc_id are judged each by its text, of equal rows
the join keeps one; null texts stay (the classifier judges them as empty texts).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.llm import decontaminate, jaccard_join, packing, quality, substring_dedup
from orchard.llm.common import prepare, table
from orchard.llm.queries import tokenizer_file
from orchard.session import checkpoint_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccard_join.keep_one(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    cut = substring_dedup.remove_repeats(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long"))
                             .otherwise(F.col("n_chars")))
    return cut


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(docs, tokenizer_file())


STAGES = [("quality", quality_stage), ("jaccard_join", jaccard_stage), ("substring_dedup", substring_stage),
          ("decontaminate", decontaminate_stage), ("packing", packing_stage)]

#: A trained classifier and a tokenizer are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder and read again."""
    prepare(spark)
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
