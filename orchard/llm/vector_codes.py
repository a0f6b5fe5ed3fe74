"""Vector code compression: part codebooks with memoised grid cells.

A vector of whole numbers is cut into equal parts, and every part is coded by
the nearest entry of its position's codebook.  Instead of measuring all
entries, a part is hashed to the coarse grid cell that it lies in.  Over the
box of a cell every entry has a least and a greatest distance; an entry whose
least distance is above the smallest greatest distance is dominated and can
never be nearest inside the box.  The entries that are left are memoised per
cell, and only those are measured exactly.  Codes are therefore the same as
by measuring all entries, ties included (lower index).

Training is Lloyd's: entries start as the parts of the vectors of smallest
ids, tasks send sums and counts by (part, entry), and the new entry is the
floor of the mean.  Only the codebooks (parts x entries x part length whole
numbers) are on the driver and in the task closures.  Assignment is a scan
without a shuffle; every round reads the vectors once.

Defined cases: rows whose vector is null, empty or holds a null or
non-finite component are dropped, and so are vectors of another length than
the vector of the smallest id has, and all rows when that length is no
multiple of ``parts``.  Components are clamped to +-2^26 after scaling
(|x| >= 262,144), so that distances are exact in 64 bits; sums of errors that
pass a long are the largest long.  Repeated ids and repeated rows are all
coded; seeds are the first rows by (id, vector), null ids last.  An empty
table gives no rows.  Other columns are ignored by ``encode_table`` unless named.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orchard.llm.common import saved, small_side
from orchard.llm.text import mix

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LIMIT = 1 << 26
#: Most remembered cells of a part position in a task; the memo starts anew beyond it (results stay the same).
CELLS = 1 << 16
#: Most (part, entry) distances that a task measures at a time.
PAIRS = 1 << 20
_LONGEST = (1 << 63) - 1


def whole_numbers(vector: Column) -> Column:
    """floor(256 x) of every component, clamped to +-2^26."""
    return F.transform(vector, lambda x: F.floor(F.least(F.greatest(
        x.cast("double") * F.lit(float(SCALE)), F.lit(float(-LIMIT))), F.lit(float(LIMIT)))).cast("long"))


def usable(vector: Column) -> Column:
    """Not null, not empty, and every component finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


@dataclass
class Codebooks:
    """``book[p, e, c]``: component c of entry e of part p."""

    book: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.book.reshape(-1).tolist())).encode()).hexdigest()


class Cells:
    """The memo of one part position: cell hash -> (cell, entries not dominated in it)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        gap = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(2).astype(float)
        gap[gap == 0] = np.inf
        least = gap.min(1)
        near = np.sqrt(least[np.isfinite(least)].mean()) if np.isfinite(least).any() else 1.0
        self.width = max(1, int(near / 2))          # half the usual distance of an entry to the next one
        self.memo: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def survivors(self, cells: np.ndarray) -> Iterator[np.ndarray]:
        """Entries not dominated over each cell's box, by least and greatest distance."""
        for a in range(0, len(cells), 4096):
            lo = cells[a:a + 4096, None, :] * self.width
            hi = lo + (self.width - 1)
            e = self.entries[None, :, :]
            near = (np.maximum(np.maximum(lo - e, e - hi), 0) ** 2).sum(2)
            far = (np.maximum(np.abs(e - lo), np.abs(e - hi)) ** 2).sum(2)
            keep = near <= far.min(1)[:, None]
            yield from (np.flatnonzero(k) for k in keep)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of every row of ``x``."""
        code, dist = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        if len(x) == 0:
            return code, dist
        cell = x // self.width
        key = np.zeros(len(x), np.uint64)
        for c in range(x.shape[1]):
            key = mix(key * np.uint64(31) + cell[:, c].astype(np.uint64) + np.uint64(c + 1))
        keys, first, inv = np.unique(key, return_index=True, return_inverse=True)
        if len(self.memo) > CELLS:
            self.memo.clear()
        new = [i for i, k in enumerate(keys.tolist()) if k not in self.memo]
        for i, left in zip(new, self.survivors(cell[first[new]])):
            self.memo[int(keys[i])] = (cell[first[i]], left)
        kept = [self.memo[k] for k in keys.tolist()]
        same = (np.stack([c for c, _ in kept])[inv] == cell).all(1)      # a hash shared by two cells
        count = np.array([len(e) for _, e in kept])
        flat, start = np.concatenate([e for _, e in kept]), np.cumsum(count) - count
        for rows, counts, starts, pool in ((np.flatnonzero(same), count[inv[same]], start[inv[same]], flat),
                                           (np.flatnonzero(~same), np.full((~same).sum(), len(self.entries)),
                                            np.zeros((~same).sum(), int), np.arange(len(self.entries)))):
            cut = np.flatnonzero(np.diff(np.cumsum(counts) // PAIRS)) + 1
            for r, n, s in zip(np.split(rows, cut), np.split(counts, cut), np.split(starts, cut)):
                if len(r) == 0:
                    continue
                at = np.cumsum(n) - n
                entry = pool[np.arange(n.sum()) + np.repeat(s - at, n)]
                d = ((np.repeat(x[r], n, axis=0) - self.entries[entry]) ** 2).sum(1)
                low = np.minimum.reduceat(d, at)
                code[r] = np.minimum.reduceat(np.where(d == np.repeat(low, n), entry, len(self.entries)), at)
                dist[r] = low
        return code, dist


def _vectors(batch: pa.RecordBatch, length: int) -> np.ndarray:
    col = batch.column("_q")
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.int64).reshape(-1, length)


def _assign(x: np.ndarray, cells: list[Cells]) -> tuple[np.ndarray, np.ndarray]:
    parts = np.split(x, len(cells), axis=1)
    got = [c.nearest(np.ascontiguousarray(p)) for c, p in zip(cells, parts)]
    return np.stack([g[0] for g in got], 1), sum(g[1] for g in got)


def _kept(df: DataFrame, vector_col: str, id_col: str, parts: int) -> tuple[DataFrame, int]:
    """Rows of usable vectors of the table's length, with ``_q``; and the length (0: none)."""
    rows = df.where(usable(F.col(vector_col))).withColumn("_q", whole_numbers(F.col(vector_col)))
    first = rows.orderBy(F.col(id_col).asc_nulls_last(), "_q").select(F.size("_q")).first()
    length = first[0] if first and first[0] % parts == 0 else 0
    return rows.where(F.size("_q") == length), length


def train(df: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id", parts: int = PARTS,
          entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks after ``rounds`` rounds of Lloyd over all rows; None when no vector is usable."""
    rows, length = _kept(df, vector_col, id_col, parts)
    if not length:
        return None
    seeds = rows.orderBy(F.col(id_col).asc_nulls_last(), "_q").select("_q").limit(entries).collect()
    book = np.array([r[0] for r in seeds], np.int64).reshape(len(seeds), parts, -1).swapaxes(0, 1)
    width, k = length // parts, len(seeds)
    q = rows.select("_q")
    for _ in range(rounds):
        def sums(batches: Iterator[pa.RecordBatch], book=book) -> Iterator[pa.RecordBatch]:
            cells = [Cells(b) for b in book]
            total, count = np.zeros(book.shape, np.int64), np.zeros(book.shape[:2], np.int64)
            for batch in batches:
                x = _vectors(batch, length)
                code, _ = _assign(x, cells)
                for p, part in enumerate(np.split(x, parts, axis=1)):
                    np.add.at(total[p], code[:, p], part)
                    count[p] += np.bincount(code[:, p], minlength=k)
            p, e = np.nonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e], pa.int64())]
                                             + [pa.array(total[p, e, c], pa.int64()) for c in range(width)],
                                             names=["p", "e", "n", *[f"s{c}" for c in range(width)]])

        schema = "p int, e int, n long, " + ", ".join(f"s{c} long" for c in range(width))
        got = (q.mapInArrow(sums, schema).groupBy("p", "e")
                .agg(F.sum("n").alias("n"), *[F.sum(F.col(f"s{c}").cast("decimal(38,0)")).alias(f"s{c}") for c in range(width)]))
        book = book.copy()
        for r in got.collect():                                    # parts x entries rows
            book[r["p"], r["e"]] = [int(r[f"s{c}"]) // r["n"] for c in range(width)]
    return Codebooks(book)


def encode_table(df: DataFrame, books: Codebooks | None, vector_col: str = "embedding", id_col: str = "vec_id",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id, *keep, code, error)`` of every usable vector."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(id_col, *keep).schema)
    schema = f"{fields}, code string, error long"
    if books is None:
        return df.sparkSession.createDataFrame([], schema)
    parts, _, width = books.book.shape
    length = parts * width
    rows = df.where(usable(F.col(vector_col)) & (F.size(vector_col) == length)).select(
        id_col, *keep, whole_numbers(F.col(vector_col)).alias("_q"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(b) for b in books.book]
        for batch in batches:
            code, error = _assign(_vectors(batch, length), cells)
            hexes = [row.tobytes().hex() for row in code.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(batch.num_columns - 1)]
                                             + [pa.array(hexes, pa.string()), pa.array(error, pa.int64())],
                                             names=[*batch.schema.names[:-1], "code", "error"])

    return rows.mapInArrow(encode, schema)


def decode(code: Column, books: Codebooks) -> Column:
    """The vector that a code stands for (components scaled back)."""
    parts, entries, width = books.book.shape
    flat = F.lit((books.book / SCALE).reshape(-1).tolist())
    at = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda c: (p * entries + F.conv(F.substring(code, p * 2 + 1, F.lit(2)), 16, 10).cast("int")) * width + c)))
    return F.transform(at, lambda i: F.get(flat, i))


def compress(df: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id", label_col: str = "label",
             **options) -> DataFrame:
    """``(id, code, error, label_error, codebooks_sha256)``: train, then code every usable vector."""
    df = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"), F.col(label_col).alias("label"))
    books = train(df, **options)
    coded = saved(encode_table(df, books, keep=("label",)))
    by = coded.groupBy(F.col("label").alias("_l")).agg(
        F.coalesce(F.try_sum("error"), F.lit(_LONGEST)).alias("label_error"))
    out = coded.join(small_side(by, 32), F.col("label").eqNullSafe(F.col("_l")))
    return out.select("vec_id", "code", "error", "label_error",
                      F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256"))
