"""Blocked pair scans over buckets, counting every pair once.

A *member* is a node in a bucket ``(slot, key)``; a node is in at most one
bucket of a slot.  A bucket is cut into blocks of about ``BLOCK`` nodes and
every pair of blocks is one group, so no task ever holds a whole hot bucket
and a pair is looked at in exactly one group of each bucket it shares.  Of
the buckets that two nodes share, only the one with the lowest slot counts
the pair: groups therefore return sums per node and a spanning forest, never
lists of pairs, and the sums of different groups add up without repeats.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.llm.common import shuffle_partitions

BLOCK = 1024
#: Pairs compared at a time inside a task.
CHUNK = 100_000
#: Pairs whose keys or signatures lie side by side in memory at a time.
STEP = 8192
#: Rows and bytes after which whole groups are handed on.
GROUP_ROWS, GROUP_BYTES = 8192, 16 << 20
GROUP = ("slot", "key", "lo", "hi")


def bucket_sizes(members: DataFrame) -> DataFrame:
    """``(slot, key, size)`` of the buckets with two nodes or more."""
    return members.groupBy("slot", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")


def gather(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Give every node (``id`` and payload columns) its list ``slots`` of (slot, key, size)."""
    per = members.groupBy("id").agg(F.collect_list(F.struct("slot", "key", "size")).alias("slots"))
    return per.join(nodes, "id")


def deal(gathered: DataFrame, block: int | None = None) -> DataFrame:
    """One row per node and block pair, dealt by group and sorted inside the partitions."""
    block = block or BLOCK
    rows = gathered.select("*", F.explode("slots").alias("_s"))
    rows = (rows.withColumns({"slot": F.col("_s.slot"), "key": F.col("_s.key"),
                              "_n": F.ceil(F.col("_s.size") / F.lit(block)).cast("int")})
                .withColumn("blk", F.pmod(F.xxhash64("id", "key"), F.col("_n")).cast("int"))
                .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
                .withColumns({"lo": F.least("blk", "_o"), "hi": F.greatest("blk", "_o")}))
    return regroup(rows.drop("_s", "_n", "_o"))


def regroup(rows: DataFrame) -> DataFrame:
    n = shuffle_partitions(rows.sparkSession)
    return rows.repartition(n, *GROUP).sortWithinPartitions(*GROUP, "blk", "id")


def whole_groups(batches: Iterator[pa.RecordBatch], rows: int = GROUP_ROWS, most: int = GROUP_BYTES) -> Iterator[pa.Table]:
    """Tables of whole groups, of about ``rows`` rows or ``most`` bytes, from a sorted partition."""
    held: list[pa.RecordBatch] = []
    have = size = 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            have += b.num_rows
            size += b.nbytes
        if have < rows and size < most:
            continue
        t = pa.Table.from_batches(held)
        at = int(heads(t)[-1])
        if at:
            yield t.slice(0, at)
            t = t.slice(at).combine_chunks()
            held, have, size = t.to_batches(), t.num_rows, t.nbytes
    if have:
        yield pa.Table.from_batches(held)


def column(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def heads(t: pa.Table) -> np.ndarray:
    """Index of each group's first row."""
    new = np.zeros(t.num_rows, bool)
    new[0] = True
    for c in GROUP:
        v = column(t, c)
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def flat_lists(t: pa.Table, name: str) -> tuple[pa.Array, np.ndarray]:
    """(flat values, offsets from 0) of a list column."""
    a = t.column(name).combine_chunks()
    if isinstance(a, pa.ChunkedArray):
        a = a.chunk(0)
    return a.flatten(), np.concatenate([[0], np.cumsum(a.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])


def slot_matrix(t: pa.Table, slots: int) -> np.ndarray:
    """keys[row, slot]; 0 where the node is in no shared bucket of the slot."""
    flat, off = flat_lists(t, "slots")
    row = np.repeat(np.arange(t.num_rows), np.diff(off))
    m = np.zeros((t.num_rows, slots), np.int64)
    m[row, flat.field("slot").to_numpy()] = flat.field("key").to_numpy()
    return m


class Pairs:
    """The pairs of a table of whole groups, in chunks of bounded size."""

    def __init__(self, t: pa.Table, slots: int):
        n = t.num_rows
        self.head = heads(t)
        size = np.diff(np.append(self.head, n))
        lo, hi, blk = column(t, "lo"), column(t, "hi"), column(t, "blk")
        end = np.repeat(self.head + size, size)
        same = lo == hi
        left = np.repeat(np.add.reduceat((blk == lo).astype(np.int64), self.head), size)
        first = np.where(same, np.arange(n) + 1, np.repeat(self.head, size) + left)
        self.first = first
        self.count = np.where(same, end - first, np.where(blk == lo, end - first, 0))
        self.slot = column(t, "slot").astype(np.int64)
        self.keys = slot_matrix(t, slots)
        self.columns = np.arange(slots)

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        upto = np.cumsum(self.count)
        at, n = 0, len(upto)
        while at < n:
            base = upto[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(upto, base + CHUNK, side="right")))
            c = self.count[at:to]
            total = int(c.sum())
            if total:
                a = np.repeat(np.arange(at, to), c)
                yield a, np.arange(total) - np.repeat(np.cumsum(c) - c, c) + np.repeat(self.first[at:to], c)
            at = to

    def counted_here(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """True where no lower slot holds the pair as well."""
        here = np.empty(len(a), bool)
        for i in range(0, len(a), STEP):
            x, y = a[i:i + STEP], b[i:i + STEP]
            ka = self.keys[x]
            both = (ka == self.keys[y]) & (ka != 0) & (self.columns < self.slot[x][:, None])
            here[i:i + STEP] = ~both.any(axis=1)
        return here


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over links (a, b)."""
    lab = np.arange(n)
    while True:
        m = np.minimum(lab[a], lab[b])
        new = lab.copy()
        np.minimum.at(new, a, m)
        np.minimum.at(new, b, m)
        new = new[new]
        if (new == lab).all():
            return lab
        lab = new


LINK_SCHEMA = "id long, root long, links long, linked_rows long"


class Links:
    """Sums and a spanning forest of the verified pairs of a table, a chunk of pairs at a time."""

    def __init__(self, weight: np.ndarray):
        self.weight, self.nodes = weight, np.arange(len(weight))
        self.root = self.nodes
        self.links, self.rows = np.zeros(len(weight), np.int64), np.zeros(len(weight), np.int64)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            n = len(self.nodes)
            self.links += np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
            np.add.at(self.rows, a, self.weight[b])
            np.add.at(self.rows, b, self.weight[a])
            self.root = forest(n, np.concatenate([self.nodes, a]), np.concatenate([self.root, b]))

    def batch(self, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Spanning stars; none without links."""
        has = self.links > 0
        if has.any():
            yield pa.RecordBatch.from_arrays([pa.array(ids[has]), pa.array(ids[self.root[has]]), pa.array(self.links[has]),
                                              pa.array(self.rows[has])], ["id", "root", "links", "linked_rows"])


def link_rows(ids: np.ndarray, weight: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch | None:
    """Sums and spanning stars for verified pairs (row numbers a, b)."""
    out = Links(weight)
    out.add(a, b)
    return next(out.batch(ids), None)


def flagging(similar: Callable[[pa.Table], Callable], slots: int):
    """Task that keeps the rows with at least one similar pair counted in their group."""
    def run(batches):
        for t in whole_groups(batches):
            p, near = Pairs(t, slots), similar(t)
            flag = np.zeros(t.num_rows, bool)
            for a, b in p:
                ok = near(a, b)
                a, b = a[ok], b[ok]
                ok = p.counted_here(a, b)
                flag[a[ok]] = True
                flag[b[ok]] = True
            yield from t.filter(pa.array(flag)).to_batches()
    return run


def shared_counts(values: np.ndarray, off: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets of rows a and b.

    Elements held by two rows or more become bit columns, 8192 at a time;
    a pair costs an AND and a bit count over them.
    """
    out = np.zeros(len(a), np.int64)
    used = np.unique(np.concatenate([a, b]))
    at = np.full(len(off) - 1, -1)
    at[used] = np.arange(len(used))
    ln = np.diff(off)[used]
    idx = np.arange(ln.sum()) + np.repeat(off[used] - (np.cumsum(ln) - ln), ln)
    row = np.repeat(np.arange(len(used)), ln)
    _, inv, cnt = np.unique(values[idx], return_inverse=True, return_counts=True)
    keep = cnt > 1
    col = (np.cumsum(keep) - 1)[inv]
    ok = keep[inv]
    row, col = row[ok], col[ok]
    o = np.argsort(col, kind="stable")
    row, col = row[o], col[o]
    la, lb = at[a], at[b]
    width = 8192
    for c0 in range(0, int(keep.sum()), width):
        i, j = np.searchsorted(col, [c0, c0 + width])
        bits = np.zeros((len(used), width), bool)
        bits[row[i:j], col[i:j] - c0] = True
        top = int(col[j - 1] - c0) // 64 + 1
        packed = np.packbits(bits[:, :top * 64], axis=1).view(np.uint64)
        step = max(1, (1 << 21) // top)
        for s in range(0, len(a), step):
            out[s:s + step] += np.bitwise_count(packed[la[s:s + step]] & packed[lb[s:s + step]]).sum(axis=1, dtype=np.int64)
    return out


def linking(similar: Callable[[pa.Table], Callable], exact: Callable[[pa.Table], Callable], slots: int):
    """Task that verifies the similar pairs of each group and returns link rows."""
    def run(batches):
        for t in whole_groups(batches):
            p, near, check = Pairs(t, slots), similar(t), exact(t)
            ids, out = column(t, "id"), Links(column(t, "weight"))
            ends = np.append(p.head[1:], t.num_rows)
            for a, b in p:
                ok = near(a, b)
                a, b = a[ok], b[ok]
                ok = p.counted_here(a, b)
                a, b = a[ok], b[ok]
                # verify group by group: the sets of a group share their columns
                cut = np.flatnonzero(np.diff(np.searchsorted(ends, a, side="right"))) + 1
                ok = [check(x, y) for x, y in zip(np.split(a, cut), np.split(b, cut)) if len(x)]
                if ok:
                    ok = np.concatenate(ok)
                    out.add(a[ok], b[ok])
            yield from out.batch(ids)
    return run


def signature_filter(t: int, least: int):
    """Pairs whose byte signatures (column ``sig``) agree in ``least`` of ``t`` places."""
    def similar(tab: pa.Table):
        sig = np.frombuffer(b"".join(tab.column("sig").to_pylist()), np.uint8).reshape(-1, t)

        def agree(a, b):
            parts = [(sig[a[i:i + STEP]] == sig[b[i:i + STEP]]).sum(axis=1) >= least for i in range(0, len(a), STEP)]
            return np.concatenate(parts) if parts else np.zeros(0, bool)
        return agree
    return similar


def jaccard_check(least: float):
    """Exact Jaccard of the sets in column ``items``."""
    def exact(tab: pa.Table):
        flat, off = flat_lists(tab, "items")
        values, size = flat.to_numpy(zero_copy_only=False), np.diff(off)

        def check(a, b):
            both = shared_counts(values, off, a, b)
            return both >= least * (size[a] + size[b] - both) - 1e-9
        return check
    return exact
