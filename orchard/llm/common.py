"""Small Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.session import checkpoint_dir, ship_package

#: A side is broadcast explicitly only when its counted rows times its row
#: width stay below this; otherwise the join shuffles (AQE splits hot keys).
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows go to Python workers in batches of at most this many bytes, whatever their lengths.
BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Ship the package to the Python workers, set the checkpoint folder and the size of their batches."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    checkpoint_dir(spark)


def saved(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder (survives lost executors;
    removed by Spark's cleaner when the frame is no longer referenced)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_side(df: DataFrame, row_bytes: int, rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint when its counted size is small, else as it is."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n * row_bytes <= BROADCAST_BYTES else df


def fold(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets`` (a null id falls in bucket 0)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(buckets)), F.lit(0))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def without_ids(df: DataFrame, id_col: str, ids: DataFrame, row_bytes: int | None = None) -> DataFrame:
    """Rows of ``df`` whose id is not in the one column of ``ids``; a null id stays."""
    key, = fresh(df, "_drop_id")
    ids = ids.toDF(key)
    if row_bytes:
        ids = small_side(ids, row_bytes)
    return df.join(ids, df[id_col] == ids[key], "left_anti")
