"""N-gram Jaccard self-join of documents by chosen paths.

Texts are sets of five-word shingles (words: runs of lower-cased letters,
digits and non-ASCII characters).  Documents with equal shingle bags are one
*node*, so copies cost one row and are never compared.

Chosen-path join: the sets are embedded as ``t`` MinHash tokens.  A run
starts with all nodes in one bucket and recursively splits a bucket on one
sampled token position, chosen from the bucket's own path: only nodes that
share the sampled token go on together.  A bucket of at most ``limit`` nodes
is brute-forced, as is one whose nodes are mostly alike (splitting would only
repeat it) and one at depth ``depth``; larger ones are brute-forced in
blocks.  A pair of similarity s stays together over a run with probability
s^depth at least, so the number of runs is set to reach the target recall
for s = threshold.  Inside a bucket signatures rule out clearly different
pairs (false drop below 1e-4) and the survivors are verified by the exact
Jaccard similarity of their shingle sets (64-bit shingle hashes).

Links are summed per node and handed on as spanning stars; pairs are never
listed, so a group of n near copies costs n rows a run, not n squared.

Defined cases: null and wordless texts link with nothing; texts of one to
four words are one shingle; repeated rows and repeated ids count as copies;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.llm import pairs
from orchard.llm.common import fresh, saved, small_side, without_ids
from orchard.llm.graph import components
from orchard.llm.text import ALNUM, Words, lists, lowered, minhash, mix, set_ids, shingles, slices, unique_sets, tidy
from orchard.operators.ordering import row_index

THRESHOLD, RECALL, DEPTH, LIMIT, TOKENS = 0.8, 0.999, 3, 1024, 64


def runs_for(recall: float, threshold: float, depth: int) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** depth))


def least_agreeing(t: int, threshold: float, drop: float = 1e-4) -> int:
    """Largest m with P(Bin(t, threshold) < m) <= drop."""
    p, m = 0.0, 0
    while True:
        p += math.comb(t, m) * threshold ** m * (1 - threshold) ** (t - m)
        if p > drop:
            return m
        m += 1


def paths(sig: np.ndarray, runs: int, depth: int) -> np.ndarray:
    """Bucket keys [row, run, level]: the path's hash after each split."""
    n, t = sig.shape
    order = np.random.default_rng(7).permutation(t)
    out = np.empty((n, runs, depth), np.uint64)
    rows = np.arange(n)
    for r in range(runs):
        path = np.full(n, r + 1, np.uint64)
        for d in range(depth):
            # the token position is sampled by the bucket: its path so far
            at = np.full(n, order[r % t]) if d == 0 else (mix(path) % np.uint64(t)).astype(np.int64)
            token = sig[rows, at].astype(np.uint64) + (at.astype(np.uint64) << np.uint64(32))
            path = mix(path ^ mix(token)) | np.uint64(1)
            out[:, r, d] = path
    return out.view(np.int64)


def sketches(docs: DataFrame, runs: int, depth: int, tokens: int) -> DataFrame:
    """(doc_id, id, sig, keys) of every text with words."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                w = Words(lowered(part.column("text")), ALNUM)
                s, row = shingles(w.hash, w.row, w.rows)
                rows, sig = minhash(s, row, tokens)
                if len(rows) == 0:
                    continue
                keys = paths(sig, runs, depth).reshape(len(rows), -1)
                low = np.ascontiguousarray(sig.astype(np.uint8))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(rows)), pa.array(set_ids(s, row)),
                    pa.array([x.tobytes() for x in low], pa.binary()),
                    lists(keys.ravel(), np.repeat(np.arange(len(rows)), keys.shape[1]), len(rows), pa.int64()),
                ], ["doc_id", "id", "sig", "keys"])
    return docs.mapInArrow(tidy(run), "doc_id long, id long, sig binary, keys array<long>")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(id, items): every text's distinct shingles."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                w = Words(lowered(part.column("text")), ALNUM)
                s, row = shingles(w.hash, w.row, w.rows)
                if len(s) == 0:
                    continue
                ids = set_ids(s, row)
                u, r = unique_sets(s, row)
                _, dense = np.unique(r, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids), lists(u.view(np.int64), dense, len(ids), pa.int64())],
                                                 ["id", "items"])
    return docs.select("text").mapInArrow(tidy(run), "id long, items array<long>")


def leaf_members(nodes: DataFrame, runs: int, depth: int, limit: int) -> DataFrame:
    """(id, slot, key, size): the bucket in which each run leaves a node with company."""
    keys = nodes.select("id", "keys")
    here = nodes.select("id", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(runs - 1)),
                        lambda r: F.get("keys", r * depth))).alias("slot", "key"))
    found = []
    for d in range(depth):
        sizes = saved(pairs.bucket_sizes(here))
        rows = saved(here.join(sizes, ["slot", "key"]).select("id", "slot", "key", "size"))
        large = rows.where(F.col("size") > limit)
        if d == depth - 1 or not large.take(1):
            found.append(rows)
            break
        # mostly alike: two random nodes of the bucket agree in more than half of the other runs
        probe = (large.join(keys, "id").select("slot", "key", "size", F.posexplode("keys").alias("i", "v"))
                      .where((F.col("i") % depth == 0) & (F.col("i") != F.col("slot") * depth))
                      .groupBy("slot", "key", "size", "i", "v").agg(F.count(F.lit(1)).alias("c")))
        split = saved(probe.groupBy("slot", "key", "size")
                           .agg((F.sum(F.col("c").cast("double") * F.col("c")) / (runs - 1)).alias("agree"))
                           .where(F.col("agree") <= 0.5 * F.col("size") * F.col("size"))
                           .select("slot", "key", F.lit(True).alias("go")))
        marked = rows.join(split, ["slot", "key"], "left")
        found.append(marked.where("go IS NULL").drop("go"))
        here = (marked.where("go").select("id", "slot").join(keys, "id")
                      .select("id", "slot", F.get("keys", F.col("slot") * depth + (d + 1)).alias("key")))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def verified_links(members: DataFrame, nodes: DataFrame, sets, slots: int, similar, exact) -> DataFrame:
    """Link rows (id, root, links, linked_rows) of the verified pairs of all buckets.

    ``nodes``: id, weight, sig.  ``sets``: a function that, given the flagged
    ids, returns (id, items).
    """
    dealt = pairs.deal(pairs.gather(members, nodes))
    flagged = saved(dealt.mapInArrow(tidy(pairs.flagging(similar, slots)), dealt.schema))
    ids = saved(flagged.select("id").distinct())
    rows = pairs.regroup(flagged.join(sets(ids), "id"))
    return saved(rows.mapInArrow(tidy(pairs.linking(similar, exact, slots)), pairs.LINK_SCHEMA))


def only_flagged(items: DataFrame, ids: DataFrame) -> DataFrame:
    """The sets of the flagged nodes, one row a node."""
    return items.join(small_side(ids, 16), "id", "left_semi").groupBy("id").agg(F.first("items").alias("items"))


def classes(nodes: DataFrame, links: DataFrame, first: str) -> DataFrame:
    """Node table with ``class`` (smallest ``first`` of the component), ``links`` and ``linked_rows``."""
    roots = saved(components(links.select(F.col("id").alias("a"), F.col("root").alias("b"))))
    sums = links.groupBy("id").agg(F.sum("links").alias("links"), F.sum("linked_rows").alias("linked_rows"))
    with_root = saved(nodes.join(roots.select(F.col("node").alias("id"), "root"), "id", "left")
                           .join(sums, "id", "left")
                           .withColumn("root", F.coalesce("root", "id"))
                           .fillna(0, ["links", "linked_rows"]))
    least = saved(with_root.groupBy("root").agg(F.min(first).alias("class")))
    return with_root.join(least, "root")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                 recall: float = RECALL, depth: int = DEPTH, limit: int = LIMIT, tokens: int = TOKENS) -> DataFrame:
    """One row per input row: ``doc_id``, ``class_id``, ``copy_id``, ``n_links``, ``n_text_links``.

    ``class_id``: smallest doc_id reachable over links; ``copy_id``: smallest
    doc_id with the same shingles; ``n_links``: other rows linked directly
    (copies included); ``n_text_links``: other shingle sets linked directly.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    runs = runs_for(recall, threshold, depth)
    sk = saved(sketches(docs, runs, depth, tokens))
    nodes = saved(sk.groupBy("id").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("weight"),
                                       F.first("sig").alias("sig"), F.first("keys").alias("keys")))
    members = leaf_members(nodes, runs, depth, limit)
    links = verified_links(members, nodes.select("id", "weight", "sig"),
                           lambda ids: only_flagged(shingle_sets(docs), ids), runs,
                           pairs.signature_filter(tokens, least_agreeing(tokens, threshold)),
                           pairs.jaccard_check(threshold))
    cls = saved(classes(nodes.select("id", "first", "weight"), links, "first"))
    out = sk.select("doc_id", "id").join(cls, "id").select(
        "doc_id", F.col("class").alias("class_id"), F.col("first").alias("copy_id"),
        (F.col("linked_rows") + F.col("weight") - 1).alias("n_links"), F.col("links").alias("n_text_links"))
    empty = docs.where(~F.coalesce("text", F.lit("")).rlike(r"[A-Za-z0-9]|[^\x00-\x7F]"))
    zero = F.lit(0).cast("long")
    return out.unionByName(empty.select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_id"),
                                        zero.alias("n_links"), zero.alias("n_text_links")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its class, with all their columns.

    Decided by (id, text): a row stays when it has the smallest id (then the
    smallest text digest) of its class, so rows that share an id but not
    their text are judged each on its own, and of equal rows one stays.  Rows
    with a null id cannot be named and stay.
    """
    named = docs.where(F.col(id_col).isNotNull())
    if named.groupBy(id_col).count().where("count > 1").take(1):
        return _keep_one_version(docs, id_col, text_col, options)
    classes_ = saved(jaccard_join(docs, id_col, text_col, **options).where("class_id <> doc_id").select("doc_id"))
    return without_ids(docs, id_col, classes_, 16)


def _keep_one_version(docs: DataFrame, id_col: str, text_col: str, options: dict) -> DataFrame:
    """:func:`keep_one` where ids repeat: distinct (id, text) pairs are numbered in order and joined in their place."""
    key, number, digest = fresh(docs, "_id", "_version", "_digest")
    named = docs.where(F.col(id_col).isNotNull()).withColumn(digest, F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))
    versions = saved(row_index(named.select(F.col(id_col).alias(key), digest).distinct(), [key, digest], name=number))
    versions = versions.withColumnRenamed(digest, "_d_" + digest)
    rows = named.join(versions, (named[id_col] == versions[key]) & (named[digest] == versions["_d_" + digest])).drop(key, digest, "_d_" + digest)
    rows = saved(rows.dropDuplicates([number]))
    gone = saved(jaccard_join(rows, number, text_col, **options).where("class_id <> doc_id").select("doc_id"))
    left = without_ids(rows, number, gone, 16).drop(number)
    return left.unionByName(docs.where(F.col(id_col).isNull()))
