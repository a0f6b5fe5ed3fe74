"""Mixing sources to target weights by hash-threshold histograms.

Every document has a size (its words) and a 60-bit hash.  A source's budget
is met by the documents below a threshold of that hash, so the mix is a
filter: nothing is sorted, and a larger budget always holds the documents of
a smaller one.  The threshold is found by histograms: sizes are summed by
(source, hash bucket), the running sum over the 4,096 buckets of a source
names the bucket in which the budget ends, and only that bucket is cut into
4,096 finer ones, until a single hash is left (five levels at most).

A source whose target is above its size is taken whole as often as it fits;
the rest of the target picks the documents that go once more.  Copies are
thus nested, and a document is taken at most one time more than another of
its source.  The document at the threshold goes when that brings the source
nearer to its target, so a source misses its target by half a document at
most.

Targets: sources in code-point order (null last) weigh ``WEIGHTS`` in turn
and share ``share`` times all words; a target stops at ``most`` times its
source's words, and the excess goes to the others by weight until none is
above.

All work is DataFrame functions.  Only sums and flags reach the driver; a hot
source is spread over hash buckets and summed before any shuffle.

Defined cases: a null or empty text has size 0 and is taken 0 words (its
copies follow its hash); a null source is a source of its own, after all
others; a null id hashes as an empty one.  Rows that share id and size share
a hash and are taken in any order until the budget is met, so the result is
the same multiset in every run.  Very long texts count whole.  An empty table
gives an empty mix; other columns are ignored by ``mix`` and kept by ``draw``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orchard.llm.common import fresh, saved, small_side
from orchard.operators.ordering import row_index

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
HASH_BITS, LEVEL_BITS = 60, 12
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def hash60(doc_id: Column, size: Column) -> Column:
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), size.cast("string"))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sources`` (source, source_size) with ``target``.

    Every round is one aggregate over the sources: those whose share of the
    rest is above their bound are set to the bound, until none is added.
    """
    s = row_index(sources, [F.col("source").asc_nulls_last()], name="place")
    s = saved(s.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                                                  (F.col("place") % len(weights) + 1).cast("int")))
               .withColumn("bound", F.col("source_size") * F.lit(float(most))))
    total = (s.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = None, -1
    while True:
        above = F.lit(False) if level is None else F.col("weight") * F.lit(level) > F.col("bound")
        n, size, weight = s.agg(F.count_if(above), F.sum(F.when(above, F.col("bound"))),
                                F.sum(F.when(~above, F.col("weight")))).first()
        if n == capped:
            break
        capped, level = n, (total - (size or 0.0)) / weight if weight else float("inf")
    return s.select("source", "source_size", F.least(F.col("weight") * F.lit(level), F.col("bound")).alias("target"))


def _with(rows: DataFrame, small: DataFrame, source: str, how: str = "inner") -> DataFrame:
    """Join one row per source (null matches null); broadcast only when counted small."""
    right = small.withColumnRenamed("source", "_mix_source")
    return rows.join(small_side(right, 128), rows[source].eqNullSafe(right["_mix_source"]), how).drop("_mix_source")


def thresholds(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` (source, source_size, target) with, per source: ``whole`` (copies of every
    document), ``rest`` (words still to take), the boundary hash ``at``, the words ``below`` it
    and the number ``tied`` of rows on it (null when no rest is left)."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = (plan.withColumn("whole", whole)
                .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))
    edge = plan.where("rest > 0").select("source", "rest", F.lit(0.0).alias("below"), F.lit(0).cast("long").alias("bucket"))
    w = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        inside = _with(sized, edge, "source").where(F.shiftright("hash", shift + LEVEL_BITS) == F.col("bucket"))
        parts = (inside.groupBy("source", F.shiftright("hash", shift).alias("part"))
                       .agg(F.first("rest").alias("rest"), F.first("below").alias("below"), F.sum("size").alias("size"),
                            F.count(F.lit(1)).alias("tied"), F.min("hash").alias("at"), F.max("hash").alias("to")))
        run = parts.withColumn("below", F.col("below") + F.coalesce(F.sum("size").over(w), F.lit(0)))
        edge = saved(run.where((F.col("below") <= F.col("rest")) & (F.col("below") + F.col("size") > F.col("rest")))
                        .select("source", "rest", "below", F.col("part").alias("bucket"), "tied", "at", "to"))
        if not edge.where("at < to").take(1):
            break
    found = edge.select(F.col("source").alias("_edge_source"), "below", "tied", "at")
    return saved(plan.join(found, F.col("source").eqNullSafe(F.col("_edge_source")), "left").drop("_edge_source"))


def _copies(rows: DataFrame, plan: DataFrame, source: str, size: str, key: str) -> DataFrame:
    """``rows`` with the columns of ``plan`` and ``copies``."""
    both = _with(rows, plan.select("source", *[F.col(c).alias(f"_mix_{c}") for c in plan.columns if c != "source"]), source)
    at, rest, below, tied = (F.col(f"_mix_{c}") for c in ("at", "rest", "below", "tied"))
    on = F.coalesce((F.col(key) == at) & (tied > 1), F.lit(False))
    once = F.when(F.col(key) < at, 1).when((F.col(key) == at) & (below + F.col(size) / 2 <= rest), 1).otherwise(0)
    out = both.where(~on).withColumn("_mix_copies", F.col("_mix_whole") + once)
    if plan.where("tied > 1").take(1):
        t = row_index(both.where(on), [F.col(key), F.col(size)], by=[source], name="_mix_i")
        out = out.unionByName(t.withColumn("_mix_copies", F.col("_mix_whole") + F.when(
            below + F.col("_mix_i") * F.col(size) + F.col(size) / 2 <= rest, 1).otherwise(0)).drop("_mix_i"))
    return out


def _plan(docs: DataFrame, id_col: str, text_col: str, source_col: str, options: dict) -> tuple[DataFrame, DataFrame]:
    size = words(F.col(text_col))
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"))
    sized = saved(sized.withColumn("hash", hash60(F.col("doc_id"), F.col("size"))))
    plan = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), **options)
    return sized, thresholds(sized, plan)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken)`` of every row."""
    sized, plan = _plan(docs, id_col, text_col, source_col, options)
    return _copies(sized, plan, "source", "size", "hash").select(
        "doc_id", "source", "size", F.col("_mix_source_size").alias("source_size"), F.col("_mix_target").alias("target"),
        F.col("_mix_copies").cast("long").alias("copies"), (F.col("size") * F.col("_mix_copies")).cast("long").alias("taken"))


def draw(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with all its columns."""
    _, plan = _plan(docs, id_col, text_col, source_col, options)
    size, key = fresh(docs, "_mix_size", "_mix_hash")
    rows = docs.withColumn(size, words(F.col(text_col))).withColumn(key, hash60(F.col(id_col), F.col(size)))
    out = _copies(rows, plan, source_col, size, key).where("_mix_copies > 0")
    return out.withColumn("_mix_n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mix_copies")))).select(*docs.columns)
