"""Benchmark decontamination by size-partitioned MinHash containment search.

Finds the documents that hold a short test item: the containment of the
item's five-word shingles in the document's shingles is at least
``threshold``.  Everything runs as DataFrame functions.

Plain MinHash compares a 30-shingle item badly with a 20,000-word document,
so documents are partitioned by the size of their shingle set: a partition
holds sizes up to 2^p and uses a one-permutation MinHash of 2^p bins (the bin
is the top p bits of a shingle's hash; a bin keeps its smallest hash).  A
sketch is thus as long as the set it stands for, and a shared shingle
survives in it with probability (1 - e^-x) / x for x = size / bins <= 1, at
least 0.63, whatever the document's length.  Every item is sketched with the
bins of each partition that occurs, and a document is a candidate for an
item when they agree in a bin; an item with q shared shingles is missed with
probability 0.37^q at most.  Items that can match with fewer than
``LEAST_SHARED`` shared shingles (under 12 shingles at 0.8) are not left to
the bins: every shingle of every document is probed against theirs, so none
of them is missed, and for the others the bound is 0.37^10 = 5e-5.
Candidates are verified by the exact containment of their shingles as texts.

Sketches never leave the row of their document: the only shuffles carry
candidate pairs and the texts of candidate documents.

Words are runs of letters, digits and non-ASCII characters of the lower-cased
text.  Defined cases: texts of fewer than five words (null and empty ones
too) have no shingles and match nothing; a repeated doc_id or item_id counts
with its best row; a null id is reported as null; extra columns are ignored
by ``find_leaks`` and kept by ``remove_leaks``; empty tables give no leaks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orchard.llm.common import saved, small_side, without_ids

THRESHOLD, SHINGLE = 0.8, 5
#: Items that match with fewer shared shingles than this are found by all their shingles.
LEAST_SHARED = 10
#: In the place of a partition: the mark is any shingle, not a bin minimum.
WHOLE = -1


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once (a lambda variable is never recomputed)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    parts = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    return F.array_remove(parts, "")


def shingle_hashes(ws: Column) -> Column:
    """Sorted distinct 64-bit hashes of the five-word runs."""
    runs = let(F.transform(ws, lambda w: F.xxhash64(w)), lambda h: F.transform(
        F.slice(h, F.lit(1), F.greatest(F.size(h) - (SHINGLE - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, SHINGLE)])))
    return F.sort_array(F.array_distinct(runs))


def shingle_texts(ws: Column) -> Column:
    return let(ws, lambda w: F.array_distinct(F.transform(
        F.slice(w, F.lit(1), F.greatest(F.size(w) - (SHINGLE - 1), F.lit(0))),
        lambda x, i: F.array_join(F.slice(w, i + 1, F.lit(SHINGLE)), " "))))


def partition_bits(size: Column) -> Column:
    """p with size <= 2^p."""
    return F.ceil(F.log2(F.greatest(size, F.lit(1)).cast("double"))).cast("int")


def sketch(df: DataFrame, keep: list[str], bits: str, whole: bool = False) -> DataFrame:
    """``keep``, ``bits`` and one row ``h`` per bin minimum of the sorted hashes ``s``.

    ``whole``: also a row of every hash, with ``WHOLE`` for ``bits``.
    """
    pairs = F.arrays_zip(F.col("s").alias("h"),
                         F.concat(F.array(F.lit(None).cast("long")), F.slice("s", 1, F.greatest(F.size("s") - 1, F.lit(0))))
                         .alias("before"))
    rows = df.select(*keep, bits, F.inline(pairs).alias("h", "before"))
    shift = F.lit(64) - F.col(bits)
    first = F.col("before").isNull() | ((F.col(bits) > 0) & (_shifted("h", shift) != _shifted("before", shift)))
    if whole:
        both = F.when(first, F.array(F.col(bits), F.lit(WHOLE))).otherwise(F.array(F.lit(WHOLE)))
        return rows.select(*keep, F.explode(both).alias(bits), "h")
    return rows.where(first).drop("before")


def _shifted(c: str, shift: Column) -> Column:
    return F.call_function("shiftright", F.col(c), shift)


def candidates(docs: DataFrame, items: DataFrame, doc_key: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """Distinct (doc key, item_id) that agree in a bin, or in any shingle of a short item."""
    d = (docs.select(*doc_key, shingle_hashes(words(F.col("text"))).alias("s"))
             .withColumn("p", partition_bits(F.size("s"))))
    i = items.select("item_id", shingle_hashes(words(F.col("text"))).alias("s"))
    short = F.ceil(F.size("s") * F.lit(float(threshold)) - F.lit(1e-9)) < LEAST_SHARED
    # every partition that a document can be in: sizes up to 2^30
    long = i.where(~short).withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(30))))
    every = i.where(short).select("item_id", F.lit(WHOLE).alias("p"), F.explode("s").alias("h"))
    marks = saved(sketch(long, ["item_id"], "p").unionByName(every).distinct())
    probe = sketch(d, doc_key, "p", whole=bool(marks.where(F.col("p") == WHOLE).take(1)))
    # item marks: at most 31 rows a shingle of the benchmark; beyond the bound the join shuffles
    return probe.join(small_side(marks, 28), ["p", "h"]).select(*doc_key, "item_id").distinct()


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, containment) of every document that holds an item."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    items = items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text"))
    cand = saved(candidates(docs, items, ["doc_id"], threshold))
    want = cand.select("doc_id").distinct()
    hit = docs.join(small_side(want, 16), docs["doc_id"].eqNullSafe(want["doc_id"]), "left_semi")
    hit = hit.select("doc_id", shingle_texts(words(F.col("text"))).alias("d"))
    item_sets = items.select("item_id", shingle_texts(words(F.col("text"))).alias("i"))
    both = (hit.join(cand.select(F.col("doc_id").alias("c_doc"), F.col("item_id").alias("c_item")),
                     F.col("doc_id").eqNullSafe(F.col("c_doc")))
               .join(item_sets, F.col("c_item").eqNullSafe(F.col("item_id"))))
    share = F.size(F.array_intersect("i", "d")) / F.size("i")
    return (both.select("doc_id", "item_id", share.alias("containment")).where(F.col("containment") >= threshold - 1e-9)
                .groupBy("doc_id", "item_id").agg(F.max("containment").alias("containment")))


def remove_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 **options) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns (a null id stays)."""
    bad = find_leaks(docs, items, id_col, text_col, **options).select("doc_id").distinct()
    return without_ids(docs, id_col, bad)
