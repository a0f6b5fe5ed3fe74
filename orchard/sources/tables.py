"""Sources and sinks.

Readers always declare what they read: parquet tables come with their own
schema and CSV readers take an explicit ``StructType`` or build one from the
first record, never ``inferSchema`` (a full extra pass at scale).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables; pruning/pushdown happen in the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- S1 / P1
def read_labelled_csv(spark: SparkSession, path: str, label: str | int = -1,
                      schema: T.StructType | None = None, header: bool = True,
                      id_col: str = "row_id") -> DataFrame:
    """Comma CSV with a header -> ``(row_id, features ARRAY<DOUBLE>, label)``.

    ``label`` is a column name, or a position (0 = first, -1 = last) for the
    two layouts of the reference data sets.  All other columns are features
    (none is dropped).  ``row_id`` is stable for a given file layout.
    """
    reader = spark.read.option("header", str(header).lower()).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    if schema is None:  # all-numeric files: cast every column to double
        df = df.select([F.col(c).cast("double").alias(c) for c in df.columns])
    from orchard.operators.projection import features_label
    out = features_label(df, label)
    return out.withColumn(id_col, F.monotonically_increasing_id()).select(id_col, "features", "label")


# ---------------------------------------------------------------- S2
def parse_delimited(df: DataFrame, text_col: str, n_features: int, delim: str = ",",
                    lenient: bool = False) -> DataFrame:
    """Tokenise ``text_col``: first ``n_features`` tokens are features, the
    next one the label.  Short rows are dropped, extra tokens ignored.  A
    non-numeric token fails the job (ANSI cast) unless ``lenient``."""
    toks = F.split(F.col(text_col), delim if delim != "," else ",")
    cast = (lambda c: c.try_cast("double")) if lenient else (lambda c: c.cast("double"))
    keep = [c for c in df.columns if c != text_col]
    return (df.withColumn("_tok", toks)
              .where(F.size("_tok") > n_features)
              .select(*keep,
                      *[cast(F.col("_tok")[i]).alias(f"f{i}") for i in range(n_features)],
                      cast(F.col("_tok")[n_features]).alias("label")))


def read_headerless(spark: SparkSession, path: str, delim: str = ",",
                    lenient: bool = False) -> DataFrame:
    """Headerless numeric text; arity comes from the first record (one
    bounded ``take(1)``), label is the token after the features."""
    raw = spark.read.text(path)
    first = raw.take(1)
    if not first:
        raise ValueError(f"empty input: {path}")
    n = len(first[0][0].split(delim)) - 1
    if n < 1:
        raise ValueError("first record has no feature columns")
    return parse_delimited(raw, "value", n, delim, lenient)


# ---------------------------------------------------------------- S3 / S4
def row_count(df: DataFrame) -> int:
    n = df.count()
    if n == 0:
        raise ValueError("empty input")
    return n


def table_counts(spark: SparkSession, sf_dir: str, names: Sequence[str] = TABLES) -> DataFrame:
    """Row count of every table as one DataFrame (one global agg per table,
    partial counts per file split, no data shuffled)."""
    parts = [read_table(spark, sf_dir, t).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
             .select(F.lit(t).alias("table_name"), "n_rows") for t in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def shape(df: DataFrame, test_flag: str | None = None) -> DataFrame:
    """Rows x columns and, when ``test_flag`` names a boolean split column,
    the train share of all rows."""
    n_cols = len([c for c in df.columns if c != test_flag])
    aggs = [F.count(F.lit(1)).cast("bigint").alias("n_rows")]
    if test_flag:
        aggs.append(F.sum(F.when(F.col(test_flag), 0).otherwise(1)).cast("bigint").alias("n_train"))
    out = df.agg(*aggs).withColumn("n_cols", F.lit(n_cols).cast("bigint"))
    if test_flag:
        out = out.withColumn("train_share", F.round(F.col("n_train") / F.col("n_rows"), 6))
    return out


# ---------------------------------------------------------------- S5
def zip_columns(df: DataFrame, arrays: Sequence[str], keep: Sequence[str] = (),
                index_offset: int = 0, index_col: str = "idx") -> DataFrame:
    """Transpose k array columns into rows; the shortest array gates the
    length; ``idx`` is the position plus ``index_offset``."""
    shortest = F.least(*[F.size(a) for a in arrays])
    sliced = [F.slice(F.col(a), 1, shortest).alias(a) for a in arrays]
    z = df.select(*keep, F.arrays_zip(*sliced).alias("_z"))
    z = z.select(*keep, F.posexplode("_z").alias("_pos", "_e"))
    return z.select(*keep, (F.col("_pos") + F.lit(index_offset)).cast("bigint").alias(index_col),
                    *[F.col("_e")[a].alias(a) for a in arrays])


# ---------------------------------------------------------------- S6
def report(df: DataFrame, scale: float = 100.0, score_cols: Sequence[str] = (),
           size_col: str | None = None, total: Column | int | None = None,
           path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Result table for printing/writing: scores times ``scale`` and, with a
    ``size_col`` and ``total``, the percentage of instances used."""
    cols = [F.col(c) for c in df.columns if c not in score_cols]
    cols += [F.round(F.col(c) * F.lit(scale), 6).alias(c) for c in score_cols]
    if size_col is not None and total is not None:
        tot = total if isinstance(total, Column) else F.lit(total)
        cols.append(F.floor(F.col(size_col) / tot * 100).cast("bigint").alias("pct"))
    out = df.select(*cols)
    if path:
        out.write.mode("overwrite").format(fmt).option("header", "true").save(path)
    return out


# ---------------------------------------------------------------- S9
def param_grid(spark: SparkSession, **axes: Sequence) -> DataFrame:
    """Cross product of parameter axes (depth, k, kernel ...) as rows.

    Built from one row with ``explode`` per axis, so no join is planned; the
    size is the product of the axis lengths the caller passed.
    """
    df = spark.range(1).select()
    for name, values in axes.items():
        vals = list(values)
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in vals])))
    return df
