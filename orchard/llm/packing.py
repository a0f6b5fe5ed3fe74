"""Best-fit packing of tokenised documents into fixed-length sequences.

Tokens: the ids of an existing tokenizer file, then the end id.  A tokenizer
of this kind never joins characters across white space, so each distinct
white-space word of a batch is encoded once (per worker, words stay in a
bounded cache) and the ids of a document are put together from those of its
words.  New words are encoded ``LINE`` at a time, side by side with a space
between, and told apart by where their tokens begin.  Only documents longer
than a sequence are cut.

Packing is bulk-synchronous best fit.  Pieces are range-sorted by length, so
a piece is known by its length and its rank within the length.  Lengths and
gaps are whole numbers up to the capacity, so the sorted lists of pieces and
gaps are runs of equal values, and a run is one entry of a sweep.  A round
takes all pieces of the longest length left and sweeps the gaps upwards from
it: the pieces take the smallest gap that holds them, rank by rank where many
want the same one; the gaps then shrink by what they took and are swept again
until no gap holds the length, and what is left of it opens new sequences.
Rounds repeat down the lengths, so there are at most ``capacity`` of them at
any size of the corpus.  The resulting runs (length, first rank -> first
sequence, place) are applied to the pieces where they lie.

Defined cases: a null or empty text is the end id alone; repeated rows are
packed each; extra columns are ignored; an empty table packs nothing.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orchard.llm.common import saved, shuffle_partitions
from orchard.llm.text import Words, slices, space_table, tidy

CAPACITY, END_ID = 4096, 1
CACHE_WORDS = 1_500_000
HASHED = 255
#: Words encoded in one call's string; words kept apart before they are merged with the rest.
LINE, RECENT = 64, 1 << 15
_KEEP_CASE = space_table(lower=False)


class WordIds:
    """Token ids of white-space words by 64-bit word hash, kept per worker.

    Words of more than ``HASHED`` bytes are told apart by their bytes and not
    kept: sums of powers modulo 2^64 give some pairs of words of 1,024 bytes
    and more one hash, whatever the base.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self._clear()

    def _clear(self) -> None:
        none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.kept, self.recent = none, none               # (hash, place in flat, number of ids), by hash
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def _look(self, uniq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in flat, number of ids) of word hashes; place -1 where a word is not kept."""
        at, ln = np.full(len(uniq), -1), np.zeros(len(uniq), np.int64)
        for key, start, size in (self.kept, self.recent):
            if len(key):
                i = np.minimum(np.searchsorted(key, uniq), len(key) - 1)
                hit = key[i] == uniq
                at[hit], ln[hit] = start[i[hit]], size[i[hit]]
        return at, ln

    def _keep(self, key: np.ndarray, flat: np.ndarray, ln: np.ndarray) -> np.ndarray:
        """Keep new words; their places in flat.  What is kept is copied only when it has grown by an eighth."""
        upto = self.used + len(flat)
        if upto > len(self.flat):
            grown = np.zeros(max(upto, len(self.flat) * 3 // 2), np.uint32)
            grown[:self.used] = self.flat[:self.used]
            self.flat = grown
        self.flat[self.used:upto] = flat
        at = self.used + np.cumsum(ln) - ln
        self.used = upto
        self.recent = merged(self.recent, (key, at, ln))
        if len(self.recent[0]) > max(RECENT, len(self.kept[0]) // 8):
            self.kept, self.recent = merged(self.kept, self.recent), tuple(x[:0] for x in self.recent)
        return at

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, number of ids of each word); no word has a space."""
        enc = self.tok.encode_batch([" ".join(words[i:i + LINE]) for i in range(0, len(words), LINE)], add_special_tokens=False)
        count = np.fromiter(map(len, enc), np.int64, len(enc))
        flat = np.fromiter(chain.from_iterable(e.ids for e in enc), np.uint32, int(count.sum()))
        begin = np.fromiter(chain.from_iterable(chain.from_iterable(e.offsets for e in enc)), np.int64, 2 * len(flat))[::2]
        width = np.fromiter(map(len, words), np.int64, len(words)) + 1
        line = np.add.reduceat(width, np.arange(0, len(words), LINE))
        begin = begin + np.repeat(np.cumsum(line) - line, count)
        return flat, np.bincount(np.searchsorted(np.cumsum(width), begin, side="right"), minlength=len(words))

    def ids(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids in text order, number of ids of each word)."""
        if len(w.hash) == 0:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        long = np.flatnonzero(w.end - w.start > HASHED)
        if len(long):
            return self._with_long(w, long)
        return self._hashed(w, np.arange(len(w.hash)))

    def _with_long(self, w: Words, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        short = np.setdiff1d(np.arange(len(w.hash)), long)
        flat, ln = self._hashed(w, short) if len(short) else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        enc = [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast(w.text(long).to_pylist(), add_special_tokens=False)]
        size = np.zeros(len(w.hash), np.int64)
        size[short], size[long] = ln, [len(e) for e in enc]
        out = np.zeros(int(size.sum()), np.uint32)
        is_long = np.zeros(len(size), bool)
        is_long[long] = True
        mine = np.repeat(is_long, size)
        out[~mine], out[mine] = flat, np.concatenate(enc)
        return out, size

    def _hashed(self, w: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for the words numbered ``which`` (ascending), through the cache."""
        uniq, first, inv = np.unique(w.hash[which], return_index=True, return_inverse=True)
        first = which[first]
        if len(self.kept[0]) + len(self.recent[0]) > CACHE_WORDS:
            self._clear()
        at, size = self._look(uniq)
        new = np.flatnonzero(at < 0)
        if len(new):
            flat, size[new] = self._encode(w.text(first[new]).to_pylist())
            at[new] = self._keep(uniq[new], flat, size[new])
        ln, begin = size[inv], at[inv]
        upto = np.cumsum(ln)
        return self.flat[np.arange(upto[-1]) + np.repeat(begin - (upto - ln), ln)], ln


def merged(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """The rows of both, by their first column."""
    out = [np.concatenate(x) for x in zip(a, b)]
    o = np.argsort(out[0], kind="stable")
    return tuple(x[o] for x in out)


_TOKENIZERS: dict[str, WordIds] = {}


def tokenizer(path: str) -> WordIds:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordIds(path)
    return _TOKENIZERS[path]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           with_ids: bool = False) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, on request, ``ids`` of every piece."""
    def run(batches):
        words = tokenizer(path)
        for batch in batches:
            for part in slices(batch, "text"):
                w = Words(pc.fill_null(part.column("text"), ""), _KEEP_CASE)
                flat, ln = words.ids(w)
                n = part.num_rows
                size = np.bincount(w.row, weights=ln, minlength=n).astype(np.int64) + 1 if len(ln) else np.ones(n, np.int64)
                ends = np.cumsum(size)
                ids = np.full(int(ends[-1]), end_id, np.uint32)
                text = np.ones(len(ids), bool)
                text[ends - 1] = False
                ids[text] = flat
                count = -(-size // capacity)
                doc = np.repeat(np.arange(n), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(size[doc] - start, capacity)
                at = (ends - size)[doc] + start
                raw = ids.astype("<u4")
                crc = [zlib.crc32(raw[a:a + k]) for a, k in zip(at.tolist(), length.tolist())]
                cols = [part.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start),
                        pa.array(length), pa.array(np.array(crc, np.int64))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    off = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)   # pieces cover ids in order
                    cols.append(pa.ListArray.from_arrays(pa.array(off), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.mapInArrow(tidy(run), schema)


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Place ``counts[s]`` pieces of each length s: runs (size, rank, sequence, place) as arrays."""
    gaps: dict[int, list[tuple[int, int]]] = {}       # runs of sequences (first, count) by free room
    rooms: list[int] = []                              # the rooms that have runs, sorted
    out: list[tuple[int, int, int, int]] = []
    opened = 0

    def free(room: int, first: int, n: int) -> None:
        if room:
            if room not in gaps:
                insort(rooms, room)
                gaps[room] = []
            gaps[room].append((first, n))

    for size in np.flatnonzero(counts)[::-1].tolist():
        rank, left = 0, int(counts[size])
        while left:
            at = bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                first, n = gaps[room].pop()
                if not gaps[room]:
                    del gaps[room], rooms[at]
                take = min(n, left)
                if take < n:
                    free(room, first + take, n - take)
            else:                                      # as many sequences as this length fills
                room, first, take = capacity, opened, -(-left // (capacity // size))
                opened += take
            out.append((size, rank, first, capacity - room))
            free(room - size, first, take)
            rank += take
            left -= take
    a = np.array(out, dtype=np.int64).reshape(-1, 4)
    a = a[np.lexsort((a[:, 1], a[:, 0]))]
    return {"size": a[:, 0], "rank": a[:, 1], "sequence": a[:, 2], "place": a[:, 3]}


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: the columns of ``pieces``, ``sequence_id`` and ``offset``."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cut = saved(pieces(docs, path, capacity, end_id, with_ids))
    n = shuffle_partitions(docs.sparkSession)
    keys = [F.col("length"), F.xxhash64("doc_id", "piece", "ids_crc32")]
    ranged = saved(cut.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                      .withColumns({"pid": F.spark_partition_id(), "mid": F.monotonically_increasing_id()}))
    # at most one row per length and partition border: capacity + n rows
    runs = (ranged.groupBy("length", "pid").agg(F.min("mid").alias("first"), F.count(F.lit(1)).alias("n"))
                  .orderBy("length", "pid").toPandas())
    length, count = runs["length"].to_numpy(), runs["n"].to_numpy()
    total = np.bincount(length, count, capacity + 1).astype(np.int64)
    begin = np.cumsum(count) - count - (np.cumsum(total) - total)[length] if len(runs) else count
    run_key = length * (1 << 24) + runs["pid"].to_numpy()
    first = runs["first"].to_numpy()
    to = plan(total, capacity)
    flow_key = to["size"] * (1 << 48) + to["rank"]

    names = cut.columns

    def run(batches):
        for b in batches:
            if b.num_rows == 0:
                continue
            ln, pid, mid = (b.column(c).to_numpy().astype(np.int64) for c in ("length", "pid", "mid"))
            r = np.searchsorted(run_key, ln * (1 << 24) + pid)
            rank = begin[r] + mid - first[r]
            f = np.searchsorted(flow_key, ln * (1 << 48) + rank, side="right") - 1
            cols = [b.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(to["sequence"][f] + rank - to["rank"][f]),
                                                     pa.array(to["place"][f])], [*names, "sequence_id", "offset"])
    schema = T.StructType([*cut.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    return ranged.mapInArrow(tidy(run), schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): whole sequences of pieces packed ``with_ids``."""
    return (packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
                  .select("sequence_id", F.flatten(F.col("p.ids")).alias("ids")))
