"""Embedding near-duplicates by collision-counting projections.

Vectors are compared only within a label (and equal length); vectors that are
null, empty, zero or hold null or non-finite components, and rows without a
label, link with nothing.  Equal vectors of a label are one node.

Candidate search: unit vectors are projected on many Gaussian directions.
In a bucket the nodes are sorted along each projection and each node opens a
window around its own value; a pair that lies at cosine ``threshold`` falls
into one window with a known probability p, so its number of collisions over
m projections is Bin(m, p) at least, and the count that a pair must reach is
the largest one that loses at most ``loss`` of such pairs.  A first stage of
projections counts all pairs of the bucket's sorted windows; the pairs that
pass go on over the remaining projections, and the pairs that pass both are
verified by the cosine in double precision.

Buckets: a label of n nodes is cut by the signs of log2(n / bucket)
projections, in as many independent tables as the target recall needs (a
label that fits one bucket needs one table), so the pairs looked at grow
like n^1.1, not n^2.  Buckets that stay large are scanned in pairs of
blocks; a pair met in several tables is counted in the first one only.

Repeated rows are separate vectors with equal content; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.llm import pairs
from orchard.llm.common import saved
from orchard.llm.jaccard_join import classes
from orchard.llm.text import mix

THRESHOLD, LOSS, BUCKET = 0.98, 1e-4, 1024
FIRST, MORE, WIDTH = 16, 48, 2.0
MAX_BITS = 40


def directions(dim: int, k: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, k))


def least_collisions(m: int, width: float, loss: float) -> int:
    """Largest count that a pair at the threshold misses with probability <= loss."""
    p = math.erf(width / math.sqrt(2))
    got = 0.0
    for c in range(m + 1):
        got += math.comb(m, c) * p ** c * (1 - p) ** (m - c)
        if got > loss:
            return c
    return m


def tables_for(bits: int, threshold: float, loss: float) -> int:
    if bits == 0:
        return 1
    together = (1 - math.acos(threshold) / math.pi) ** bits
    return max(1, math.ceil(math.log(loss) / math.log1p(-together)))


def unit(tab: pa.Table, name: str = "vec") -> tuple[np.ndarray, np.ndarray]:
    """(flat components, offsets) of the vectors."""
    flat, off = pairs.flat_lists(tab, name)
    x = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    return x, off


def _bucket_keys(nodes: DataFrame, threshold: float, loss: float) -> DataFrame:
    """(id, slot, key): the sign pattern of every node in each table of its label."""
    def run(batches):
        for b in batches:
            if b.num_rows == 0:
                continue
            t = pa.Table.from_batches([b])
            x, off = unit(t)
            bits, group = pairs.column(t, "bits"), pairs.column(t, "grp")
            ids, dims = pairs.column(t, "id"), np.diff(off)
            for dim, k in set(zip(dims.tolist(), bits.tolist())):
                rows = np.flatnonzero((dims == dim) & (bits == k))
                v = x[(off[rows][:, None] + np.arange(dim)).ravel()].reshape(len(rows), dim)
                n = tables_for(k, threshold, loss)
                key = np.empty((len(rows), n), np.uint64)
                for s in range(n):
                    side = (v @ directions(dim, k, 1000 + s) > 0) if k else np.zeros((len(rows), 0), bool)
                    code = side @ (np.uint64(1) << np.arange(k, dtype=np.uint64)) if k else np.zeros(len(rows), np.uint64)
                    key[:, s] = mix(mix(group[rows].view(np.uint64)) ^ (code.astype(np.uint64) * np.uint64(64)
                                                                       + np.uint64(s))) | np.uint64(1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(ids[rows], n)), pa.array(np.tile(np.arange(n, dtype=np.int32), len(rows))),
                    pa.array(key.view(np.int64).ravel())], ["id", "slot", "key"])
    return nodes.select("id", "grp", "bits", "vec").mapInArrow(run, "id long, slot int, key long")


def _collide(tab: pa.Table, threshold: float, loss: float, slots: int):
    """Verified link rows of a table of whole groups."""
    p = pairs.Pairs(tab, slots)
    x, off = unit(tab)
    n = tab.num_rows
    bound = WIDTH * math.sqrt(2 - 2 * threshold)
    need_first, need_all = least_collisions(FIRST, WIDTH, loss), least_collisions(FIRST + MORE, WIDTH, loss)
    ends = np.append(p.head[1:], n)
    lo, hi, blk = pairs.column(tab, "lo"), pairs.column(tab, "hi"), pairs.column(tab, "blk")
    fa, fb = [], []
    for g0, g1 in zip(p.head.tolist(), ends.tolist()):
        dim = int(off[g0 + 1] - off[g0])
        v = x[off[g0]:off[g1]].reshape(g1 - g0, dim)
        u = v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]
        proj = u @ directions(dim, FIRST + MORE, 1)
        if lo[g0] == hi[g0]:
            q = t = np.arange(g1 - g0)
        else:
            q, t = np.flatnonzero(blk[g0:g1] == lo[g0]), np.flatnonzero(blk[g0:g1] == hi[g0])
        if not len(q) or not len(t):
            continue
        # sorted projections: every query's window is a run of the order
        hits = np.zeros((len(q), len(t)), np.uint8)
        for j in range(FIRST):
            order = np.argsort(proj[t, j], kind="stable")
            line = proj[t[order], j]
            a = np.searchsorted(line, proj[q, j] - bound, side="left")
            b = np.searchsorted(line, proj[q, j] + bound, side="right")
            place = np.empty(len(t), np.int32)
            place[order] = np.arange(len(t), dtype=np.int32)
            hits += (place >= a[:, None]) & (place < b[:, None])
        i, j = np.nonzero(hits >= need_first)
        if lo[g0] == hi[g0]:
            i, j = i[i < j], j[i < j]
        if not len(i):
            continue
        a, b, count = q[i], t[j], hits[i, j].astype(np.int64)
        for s in range(0, len(a), 1 << 16):
            e = slice(s, s + (1 << 16))
            more = (np.abs(proj[a[e], FIRST:] - proj[b[e], FIRST:]) <= bound).sum(axis=1)
            ok = count[e] + more >= need_all
            ca, cb = a[e][ok], b[e][ok]
            cos = np.einsum("ij,ij->i", v[ca], v[cb]) / (np.sqrt(np.einsum("ij,ij->i", v[ca], v[ca]))
                                                        * np.sqrt(np.einsum("ij,ij->i", v[cb], v[cb])))
            ok = cos >= threshold
            ca, cb = ca[ok] + g0, cb[ok] + g0
            ok = p.counted_here(ca, cb)
            fa.append(ca[ok])
            fb.append(cb[ok])
    if fa:
        return pairs.link_rows(pairs.column(tab, "id"), pairs.column(tab, "weight"), np.concatenate(fa),
                               np.concatenate(fb))
    return None


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
                    threshold: float = THRESHOLD, loss: float = LOSS, bucket: int = BUCKET) -> DataFrame:
    """One row per input row: ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
    v = F.col("vec")
    base = df.select(F.col(id_col).alias("vec_id"), F.col(vector).cast("array<double>").alias("vec"),
                     F.col(label).alias("lab"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists(v, lambda x: x != 0)
    usable = F.col("lab").isNotNull() & v.isNotNull() & ~F.coalesce(bad | zero, F.lit(True))
    base = base.withColumn("usable", F.coalesce(usable, F.lit(False)))
    # -0.0 and 0.0 are one value; a vector too small or large to square is scaled by its largest component
    top = F.array_max(F.transform(v, lambda x: F.abs(x)))
    good = (base.where("usable").withColumn("vec", F.transform(v, lambda x: x / top + F.lit(0.0)))
                .withColumn("grp", F.xxhash64("lab", F.size("vec")))
                .withColumn("id", F.xxhash64("grp", "vec")))
    rows = saved(good.select("vec_id", "id", "grp", "vec"))
    nodes = rows.groupBy("id").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("weight"),
                                   F.first("grp").alias("grp"), F.first("vec").alias("vec"))
    nodes = saved(nodes)
    sizes = nodes.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    bits = F.least(F.lit(MAX_BITS), F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / F.lit(bucket))))).cast("int")
    nodes = saved(nodes.join(saved(sizes.select("grp", bits.alias("bits"))), "grp"))
    slots = tables_for(nodes.agg(F.max("bits")).first()[0] or 0, threshold, loss)
    here = _bucket_keys(nodes, threshold, loss)
    members = here.join(saved(pairs.bucket_sizes(here)), ["slot", "key"])
    dealt = pairs.deal(pairs.gather(members, nodes.select("id", "weight", "vec")))

    def run(batches):
        for t in pairs.whole_groups(batches):
            out = _collide(t, threshold, loss, slots)
            if out is not None:
                yield out
    links = saved(dealt.mapInArrow(run, pairs.LINK_SCHEMA))
    cls = saved(classes(nodes.select("id", "first", "weight"), links, "first"))
    out = rows.select("vec_id", "id").join(cls, "id").select(
        "vec_id", (F.col("linked_rows") + F.col("weight") - 1).alias("n_links"), F.col("class").alias("component_id"))
    alone = base.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                            F.col("vec_id").alias("component_id"))
    out = out.unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
