"""Vectorised words, shingles and MinHash over Arrow string columns.

Used inside ``mapInArrow`` tasks.  A batch's UTF-8 buffer is handled as one
byte array: a lookup table lower-cases and separates, prefix sums of a
polynomial hash give every word's 64-bit hash, and five neighbouring word
hashes are mixed to a shingle hash, so no Python object exists per word.
Work runs in slices of about ``SLICE`` bytes (a longer text is a slice of
its own), which bounds memory.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 18
SHINGLE = 5
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_POSITION = np.array([0xD6E8FEB86659FD93, 0xA5A3564E27F8862B, 0xC2B2AE3D27D4EB4F,
                      0x9FB21C651E98DF25, 0xFF51AFD7ED558CCD], dtype=np.uint64)
_POW: dict[str, np.ndarray] = {}


def alnum_table() -> np.ndarray:
    """Letters and digits (lower-cased) and all non-ASCII bytes make words."""
    t = np.zeros(256, np.uint8)
    for c in range(256):
        if c >= 128 or chr(c).isalnum():
            t[c] = ord(chr(c).lower()) if c < 128 else c
    return t


def space_table(lower: bool = True) -> np.ndarray:
    """Everything but space, tab, LF, VT, FF and CR makes words; A-Z lower-cased on request."""
    t = np.arange(256).astype(np.uint8)
    if lower:
        t[65:91] += 32
    t[[9, 10, 11, 12, 13, 32]] = 0
    t[0] = 1        # a NUL byte is text; 0 marks separators
    return t


ALNUM = alnum_table()


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64."""
    x = x ^ (x >> _U(30))
    x = x * _MIX1
    x ^= x >> _U(27)
    x = x * _MIX2
    x ^= x >> _U(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POW.get("p")
    if have is None or len(have) < n + 1:
        size = max(n + 1, SLICE + 4096)
        inv = pow(int(_BASE), -1, 1 << 64)
        for k, base in (("p", int(_BASE)), ("i", inv)):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _POW[k] = np.cumprod(a, dtype=np.uint64)
        if size > 4 * SLICE:                     # do not keep a giant's tables
            p, i = _POW.pop("p"), _POW.pop("i")
            return p, i
    return _POW["p"], _POW["i"]


def buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string array without nulls."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    big = pa.types.is_large_string(arr.type)
    off = np.frombuffer(arr.buffers()[1], np.int64 if big else np.int32,
                        count=len(arr) + 1, offset=arr.offset * (8 if big else 4)).astype(np.int64)
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about SLICE bytes of ``column``."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // SLICE
    cuts = np.flatnonzero(np.diff(part)) + 1
    at = 0
    for c in [*cuts.tolist(), batch.num_rows]:
        if c > at:
            yield batch.slice(at, c - at)
        at = c


def lowered(arr: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(arr, ""))


def give_back() -> None:
    """Return freed memory to the system: a worker is kept for the next tasks and would hold the peak of the largest one."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)          # glibc only
    if trim is not None:
        trim(0)


def tidy(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``, followed by ``give_back`` when its task ends."""
    @functools.wraps(run)
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return tidied


class Words:
    """Spans, row numbers and 64-bit hashes of the words of a string array."""

    def __init__(self, arr: pa.Array, lut: np.ndarray):
        data, off = buffers(arr)
        self.rows, self.data, self.off = len(arr), data, off
        n = len(data)
        if n == 0:
            z = np.zeros(0, np.int64)
            self.start = self.end = self.row = z
            self.hash = np.zeros(0, np.uint64)
            return
        b = lut[data]
        w = b != 0
        before = np.empty(n, bool)
        before[0], before[1:] = False, w[:-1]
        heads = off[:-1]
        before[heads[heads < n]] = False
        after = np.empty(n, bool)
        after[-1], after[:-1] = False, w[1:]
        tails = off[1:]
        after[tails[tails > 0] - 1] = False
        self.start = np.flatnonzero(w & ~before)
        self.end = np.flatnonzero(w & ~after) + 1
        self.row = np.searchsorted(off, self.start, side="right") - 1
        p, inv = _powers(n)
        acc = np.empty(n + 1, np.uint64)
        acc[0] = 0
        np.cumsum(b * p[:n], dtype=np.uint64, out=acc[1:])
        self.hash = mix((acc[self.end] - acc[self.start]) * inv[self.start])

    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)

    def text(self, i: np.ndarray) -> pa.Array:
        """The words numbered ``i``, as they are in the bytes, as a string array."""
        ln = self.end[i] - self.start[i]
        off = np.zeros(len(i) + 1, np.int64)
        np.cumsum(ln, out=off[1:])
        idx = np.arange(off[-1]) + np.repeat(self.start[i] - off[:-1], ln)
        return pa.Array.from_buffers(pa.large_string(), len(i),
                                     [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(self.data[idx]))])


def shingles(hashes: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hash, row), in row order, of all runs of five words.

    A text of one to four words makes one shingle of all its words; an
    empty one makes none.
    """
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = max(0, n - SHINGLE + 1)
    s, r = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if m:
        ok = row[SHINGLE - 1:] == row[:m]
        s = hashes[:m] * _POSITION[0]
        for k in range(1, SHINGLE):
            s = s + hashes[k:m + k] * _POSITION[k]
        s, r = mix(s[ok]), row[:m][ok]
    cnt = np.bincount(row, minlength=rows)
    short = np.flatnonzero((cnt > 0) & (cnt < SHINGLE))
    if len(short):
        first = np.cumsum(cnt) - cnt
        extra = np.zeros(len(short), np.uint64)
        for k in range(SHINGLE - 1):
            has = cnt[short] > k
            extra[has] += hashes[first[short[has]] + k] * _POSITION[k]
        s, r = np.concatenate([s, mix(extra)]), np.concatenate([r, short])
        o = np.argsort(r, kind="stable")
        s, r = s[o], r[o]
    return s, r


def runs_of(hashes: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the first word, 64-bit hash) of all runs of ``k`` words of one text."""
    n, m = len(hashes), len(hashes) - k + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    p, inv = _powers(n)
    acc = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * p[:n], dtype=np.uint64, out=acc[1:])
    at = np.flatnonzero(row[k - 1:] == row[:m])
    return at, mix((acc[at + k] - acc[at]) * inv[at])


def minhash_seeds(t: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20250611)
    return (rng.integers(0, 1 << 31, t).astype(np.uint32) * np.uint32(2) + np.uint32(1),
            rng.integers(0, 1 << 31, t).astype(np.uint32) * np.uint32(2) + np.uint32(1))


def minhash(s: np.ndarray, row: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that have shingles, their t 32-bit MinHash values)."""
    rows, first = np.unique(row, return_index=True)
    sig = np.empty((len(rows), t), np.uint32)
    if len(rows) == 0:
        return rows, sig
    x = (s >> _U(32)).astype(np.uint32)
    a, b = minhash_seeds(t)
    for i in range(t):
        v = x * a[i]
        v ^= v >> np.uint32(15)
        v *= b[i]
        sig[:, i] = np.minimum.reduceat(v, first)
    return rows, sig


def set_ids(s: np.ndarray, row: np.ndarray) -> np.ndarray:
    """A 64-bit id of each row's bag of shingles (rows in order of appearance)."""
    _, first = np.unique(row, return_index=True)
    if len(first) == 0:
        return np.zeros(0, np.int64)
    a = np.add.reduceat(s, first)
    x = np.bitwise_xor.reduceat(mix(s), first)
    n = np.diff(np.append(first, len(s))).astype(np.uint64)
    return mix(a + mix(x ^ (n * _BASE))).view(np.int64)


def unique_sets(s: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row, rows in order."""
    o = np.lexsort((s, row))
    s, row = s[o], row[o]
    if len(s) == 0:
        return s, row
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (row[1:] != row[:-1])
    return s[new], row[new]


def lists(values: np.ndarray, row: np.ndarray, rows: int, kind: pa.DataType) -> pa.Array:
    """A list array of ``rows`` rows from values in row order."""
    off = np.zeros(rows + 1, np.int32)
    np.cumsum(np.bincount(row, minlength=rows), out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values, type=kind))
