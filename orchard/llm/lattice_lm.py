"""Language-model scores from a subword lattice.

The vocabulary is that of an existing tokenizer file: its pieces (words start
with the piece mark) and its single-byte fallbacks, with their existing
scores as the starting weights.  Piece probabilities are then learned from
the corpus by expectation maximisation over all distinct training words: the
E step sums over every segmentation of a word with forward and backward
recursions in log space, each word type counting once, because it is new
words that the lattice has to predict.  A text's probability is the product
over its words and its end; a word's probability is marginal over all ways
to write it: as one unit counted in the corpus, with absolute discounting,
or as any segmentation into pieces, with the discounted mass,

    p(w) = max(c(w) - D, 0) / N + D * types / N * sum over segmentations of w.

Counts may be kept for several components of the corpus (languages, say); the
text's probability then is the sum over the components of their share times
the text's probability in each, so a scored text needs no label.

Corpus counts cover every training document.  The most frequent words (at
most ``head`` of them) travel to the tasks with their lattice scores; all
other words of a text are counted by a shuffle join on the word's hash, so
nothing that grows with the corpus is broadcast.

Defined cases: a null text is empty and consists of its end; repeated rows
are scored each, and each counts in training; a word over 256 bytes is a
chain of parts of 256 bytes (segmentations across a cut are left out); with
no training text every count is 0 and the starting weights score; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orchard.llm.common import fold, saved
from orchard.llm.text import Words, lists, slices, space_table

FOLDS = 10
HEAD, EM_ROUNDS, LONGEST_PIECE, PART, COMPONENTS = 1 << 18, 2, 16, 256, 7
MARK = "▁".encode()
_LOWER = space_table()
_P = np.uint64(0x9E3779B97F4A7C15)
_POW = np.cumprod(np.concatenate([[np.uint64(1)], np.full(PART + 8, _P, np.uint64)]), dtype=np.uint64)
_INV = np.cumprod(np.concatenate([[np.uint64(1)], np.full(PART + 8, np.uint64(pow(int(_P), -1, 1 << 64)), np.uint64)]),
                  dtype=np.uint64)
#: Short strings have small prefix hashes; an odd factor spreads them over the table.
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
LN10 = math.log(10)


def vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """(pieces as bytes, starting log weights) of a sentencepiece file; byte fallbacks come as single bytes."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces: dict[bytes, float] = {}
    for i in range(sp.vocab_size()):
        if sp.is_control(i) or sp.is_unknown(i):
            continue
        text = sp.id_to_piece(i)
        # scores are minus the rank of the piece: the starting weight is Zipf's
        rank = max(1.0, -sp.get_score(i))
        if sp.is_byte(i):
            pieces.setdefault(bytes([int(text[3:5], 16)]), -math.log(sp.vocab_size()))
        elif len(text.encode()) <= LONGEST_PIECE and rank < 1e8:
            pieces[text.encode()] = -math.log(rank)
    names = sorted(pieces)
    w = np.array([pieces[x] for x in names])
    return names, w - np.logaddexp.reduce(w)


def _hash_places(b: np.ndarray) -> np.ndarray:
    """Prefix hashes [place, word] of a byte matrix [place, word]."""
    acc = np.zeros((b.shape[0] + 1, b.shape[1]), np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * _POW[:b.shape[0], None], axis=0, dtype=np.uint64, out=acc[1:])
    return acc


class Lattice:
    """Piece lookup and the forward and backward recursions over many words at once.

    ``logp`` holds one row of piece log probabilities per component.
    """

    BITS = 20
    CELLS = 1 << 18

    def __init__(self, names: list[bytes], logp: np.ndarray):
        key = np.array([int(_hash_places(np.frombuffer(x, np.uint8)[:, None])[-1, 0]) for x in names], np.uint64)
        key = key * _SPREAD
        self.order = np.argsort(key)
        self.key = key[self.order]
        top = (self.key >> np.uint64(64 - self.BITS)).astype(np.int64)
        self.first = np.searchsorted(top, np.arange(1 << self.BITS)).astype(np.int32)
        self.held = np.bincount(top, minlength=1 << self.BITS).astype(np.int32)
        self.pieces = len(names)
        self.logp = np.atleast_2d(logp)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``h`` that are pieces, their piece numbers)."""
        h = h * _SPREAD
        cell = (h >> np.uint64(64 - self.BITS)).astype(np.int64)
        some = np.flatnonzero(self.held[cell])
        cell, h = cell[some], h[some]
        at, n = self.first[cell], self.held[cell]
        found, piece = [], []
        for k in range(int(n.max()) if len(n) else 0):
            i = np.flatnonzero(n > k)
            i = i[self.key[at[i] + k] == h[i]]
            found.append(some[i])
            piece.append(self.order[at[i] + k])
        if not found:
            return some, some
        return np.concatenate(found), np.concatenate(piece)

    def arcs(self, b: np.ndarray, size: np.ndarray):
        """(start, end, words, pieces) of all arcs by end; words come longest first."""
        acc = _hash_places(b)
        for e in range(1, b.shape[0] + 1):
            n = int(np.searchsorted(-size, -e, side="right"))        # words with at least e bytes
            for s in range(max(0, e - LONGEST_PIECE), e):
                words, piece = self.find((acc[e, :n] - acc[s, :n]) * _INV[s])
                if len(words):
                    yield s, e, words, piece

    def forward(self, shape, arcs, z: int) -> np.ndarray:
        f = np.full((shape[0] + 1, shape[1]), -np.inf)
        f[0] = 0
        p = self.logp[z]
        for s, e, words, piece in arcs:
            f[e, words] = np.logaddexp(f[e, words], f[s, words] + p[piece])
        return f

    def expected(self, b: np.ndarray, size: np.ndarray, weight: np.ndarray, z: int) -> np.ndarray:
        """Expected number of uses of each piece over the words."""
        arcs = list(self.arcs(b, size))
        f = self.forward(b.shape, arcs, z)
        col = np.arange(b.shape[1])
        total = f[size, col]
        back = np.full(f.shape, -np.inf)
        back[size, col] = 0
        out = np.zeros(self.pieces)
        p = self.logp[z]
        total[~np.isfinite(total)] = np.inf
        for s, e, words, piece in sorted(arcs, key=lambda x: (-x[1], -x[0])):
            through = back[e, words] + p[piece]
            back[s, words] = np.logaddexp(back[s, words], through)
            out += np.bincount(piece, np.exp(f[s, words] + through - total[words]) * weight[words], self.pieces)
        return out

    def tables(self, data: np.ndarray, start: np.ndarray, size: np.ndarray):
        """(words, byte matrix [place, word], sizes) of marked words, longest first, in tables of bounded size;
        a word over PART bytes comes as several parts."""
        head = np.frombuffer(MARK, np.uint8)
        whole = size + len(head)
        word = np.repeat(np.arange(len(size)), -(-whole // PART))
        part = np.arange(len(word)) - np.searchsorted(word, word, side="left")
        n = np.minimum(whole[word] - part * PART, PART)
        order = np.argsort(-n, kind="stable")
        at = 0
        while at < len(order):
            top = int(n[order[at]])
            i = order[at:at + max(1, self.CELLS // (top + 1))]
            at += len(i)
            place = part[i] * PART + np.arange(top)[:, None] - len(head)      # place in the word
            inside = (np.arange(top)[:, None] < n[i]) & (place >= 0)
            b = np.zeros((top, len(i)), np.uint8)
            b[inside] = data[(start[word[i]] + place)[inside]]
            marks = part[i] == 0
            k = min(len(head), top)
            b[:k, marks] = head[:k, None]
            yield word[i], b, n[i]

    def score(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Natural log of the marginal probability [component, word]."""
        out = np.zeros((len(self.logp), len(start)))
        for word, b, n in self.tables(data, start, size):
            arcs = list(self.arcs(b, n))
            for z in range(len(self.logp)):
                np.add.at(out[z], word, self.forward(b.shape, arcs, z)[n, np.arange(len(n))])
        return out


def _spans(col) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start, size) of a binary column."""
    off = np.frombuffer(col.buffers()[1], np.int32, count=len(col) + 1, offset=col.offset * 4).astype(np.int64)
    raw = col.buffers()[2]
    return (np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)), off[:-1], np.diff(off)


def component_numbers(train: DataFrame, most: int) -> tuple[list, list[float]]:
    """(values of ``component``, their shares): the most frequent ones, the rest pooled at the end."""
    got = (train.groupBy("component").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.col("component"))
                .limit(most + 1).collect())
    total = train.count()
    values = [r["component"] for r in got if r["component"] is not None][:most]
    counts = [r["n"] for r in got if r["component"] in values]
    rest = total - sum(counts)
    if rest or not values:
        return values, [c / max(total, 1) for c in counts] + [rest / max(total, 1) if total else 1.0]
    return values, [c / total for c in counts]


def word_counts(docs: DataFrame, k: int) -> DataFrame:
    """(h, word, c0 .. c{k-1}): how often each word occurs in the texts of each component ``z``.

    A task adds up its slices before anything is shuffled.
    """
    def merged(hs, zs, cs, ws):
        h, z, c = np.concatenate(hs), np.concatenate(zs), np.concatenate(cs)
        _, first, inv = np.unique(h + z.astype(np.uint64) * _P, return_index=True, return_inverse=True)
        return h[first], z[first], np.bincount(inv, c).astype(np.int64), pa.concat_arrays(ws).take(pa.array(first))

    def out(h, z, c, t):
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(z.astype(np.int32)),
                                           t.cast(pa.binary()), pa.array(c)], ["h", "z", "word", "c"])

    def run(batches):
        held, n = ([], [], [], []), 0
        for batch in batches:
            for part in slices(batch, "text"):
                w = Words(pc.fill_null(part.column("text"), ""), _LOWER)
                if not len(w.hash):
                    continue
                w.data = lower_bytes(w.data)
                z = part.column("z").to_numpy(zero_copy_only=False)[w.row]
                _, first, c = np.unique(w.hash + z.astype(np.uint64) * _P, return_index=True, return_counts=True)
                for x, v in zip(held, (w.hash[first], z[first], c, w.text(first).cast(pa.large_binary()))):
                    x.append(v)
                n += len(first)
                if n > 600_000:
                    got = merged(*held)
                    held, n = tuple([v] for v in got), len(got[0])
                    if n > 400_000:
                        yield out(*got)
                        held, n = ([], [], [], []), 0
        if n:
            yield out(*merged(*held))
    rows = docs.select("text", "z").mapInArrow(run, "h long, z int, word binary, c long")
    return rows.groupBy("h", "word").agg(*[F.sum(F.when(F.col("z") == i, F.col("c")).otherwise(0)).alias(f"c{i}")
                                           for i in range(k)])


def lower_bytes(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def learn(counts: DataFrame, names: list[bytes], logp: np.ndarray, rounds: int) -> np.ndarray:
    """Piece log probabilities after EM over the distinct words."""
    for _ in range(rounds):
        start = logp

        def run(batches):
            lat = Lattice(names, start)
            total = np.zeros(len(names))

            def add(held):
                data, at, size = _spans(pa.concat_arrays(held))
                for _, b, n in lat.tables(data, at, size):
                    total[:] += lat.expected(b, n, np.ones(len(n)), 0)
            held, n = [], 0
            for b in batches:
                if b.num_rows:
                    held.append(b.column("word"))
                    n += b.num_rows
                if n > 60_000:
                    add(held)
                    held, n = [], 0
            if n:
                add(held)
            i = np.flatnonzero(total > 0)
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(total[i])], ["piece", "n"])
        got = (counts.select("word").mapInArrow(run, "piece int, n double")
               .groupBy("piece").agg(F.sum("n").alias("n")).toPandas())      # one row per vocabulary piece
        use = np.full(len(names), 0.01)          # every piece stays possible
        use[got["piece"].to_numpy(dtype=int)] += got["n"].to_numpy(dtype=float)
        logp = np.log(use / use.sum())
    return logp


def score_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                component_col: str | None = None, folds: int = FOLDS, head: int = HEAD, rounds: int = EM_ROUNDS,
                components: int = COMPONENTS) -> DataFrame:
    """One row per document: ids, counts, ``base_score`` and ``score`` (log10 probabilities).

    ``component_col`` names a column of the training texts (a language, say)
    whose values are the components; it is not read for the texts scored.
    """
    comp = F.col(component_col).cast("string") if component_col else F.lit(None).cast("string")
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       comp.alias("component"))
    train = docs.where(fold(F.col("doc_id"), folds) != 0)
    values, share = component_numbers(train, components)
    k = len(share)
    z = F.lit(k - 1)
    for i, v in enumerate(values):
        z = F.when(F.col("component") == v, F.lit(i)).otherwise(z)
    counts = saved(word_counts(train.withColumn("z", z), k))
    ends_of = {r["z"]: r["n"] for r in train.groupBy(z.alias("z")).agg(F.count(F.lit(1)).alias("n")).collect()}
    ends_z = np.array([ends_of.get(i, 0) for i in range(k)], float)
    stat = counts.agg(*[f(F.col(f"c{i}")).alias(f"{n}{i}") for i in range(k) for n, f in (
        ("sum", lambda c: F.coalesce(F.sum(c), F.lit(0))), ("types", lambda c: F.count_if(c > 0)),
        ("one", lambda c: F.count_if(c == 1)), ("two", lambda c: F.count_if(c == 2)))]).first()
    n_z = np.array([stat[f"sum{i}"] for i in range(k)], float) + ends_z
    types_z = np.array([stat[f"types{i}"] for i in range(k)], float)
    one, two = (np.array([stat[f"{n}{i}"] for i in range(k)], float) for n in ("one", "two"))
    d_z = np.where((one > 0) & (two > 0), one / np.maximum(one + 2 * two, 1), 0.5)
    n_z = np.maximum(n_z, 1)
    spread_z = np.where(types_z > 0, d_z * types_z / n_z, 1.0)
    whole = sum((F.col(f"c{i}") for i in range(1, k)), F.col("c0"))
    # a word count takes few distinct values: the table of counts of counts is short
    cc = counts.groupBy(whole.alias("c")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).toPandas()
    c, n = cc["c"].to_numpy(dtype=np.int64), cc["n"].to_numpy(dtype=np.int64)
    ends = int(ends_z.sum())
    total, types = int((c * n).sum()) + ends, int(n.sum())
    fits = np.cumsum(n) <= head
    least = int(c[fits][-1]) if fits.any() else (int(c[0]) + 1 if len(c) else 1)
    denom = total + 0.1 * (types + (ends > 0) + 1)
    names, logp = vocabulary(path)
    logp = learn(counts, names, logp, rounds)
    cols = [f"c{i}" for i in range(k)]
    top = counts.where(whole >= least).select("h", "word", *cols).toArrow().combine_chunks()     # <= head rows
    top_h, top_base, top_score = np.zeros(0, np.uint64), np.zeros(0), np.zeros((k, 0))
    if top.num_rows:
        data, at, size = _spans(top.column("word").chunk(0).cast(pa.binary()))
        ln = Lattice(names, logp).score(data, at, size)[0]
        h = top.column("h").to_numpy().view(np.uint64)
        o = np.argsort(h)
        cnt = np.array([top.column(x).to_numpy() for x in cols], float)
        top_h, top_base = h[o], np.log10((cnt.sum(axis=0)[o] + 0.1) / denom)
        own = np.maximum(cnt - d_z[:, None], 0) / n_z[:, None]
        with np.errstate(divide="ignore"):
            top_score = (np.logaddexp(np.log(own), np.log(spread_z)[:, None] + ln) / LN10)[:, o]
    end_base = math.log10((ends + 0.1) / denom)
    end_score = np.log10(np.maximum(ends_z, 0.1) / n_z)

    def run(batches):
        lat = Lattice(names, logp)
        for batch in batches:
            for part in slices(batch, "text"):
                w = Words(pc.fill_null(part.column("text"), ""), _LOWER)
                rows = part.num_rows
                sums = np.zeros((3 + k, rows))
                r, u, tf, ln = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0)
                if len(w.hash):
                    u, first, inv = np.unique(w.hash, return_index=True, return_inverse=True)
                    at = np.minimum(np.searchsorted(top_h, u), max(len(top_h) - 1, 0))
                    known = top_h[at] == u if len(top_h) else np.zeros(len(u), bool)
                    at = at[known]
                    here = known[inv]
                    row, i = w.row[here], (np.cumsum(known) - 1)[inv[here]]
                    sums[0] = np.bincount(w.row, minlength=rows)
                    sums[1] = np.bincount(row, minlength=rows)
                    sums[2] = np.bincount(row, weights=top_base[at][i], minlength=rows)
                    for q in range(k):
                        sums[3 + q] = np.bincount(row, weights=top_score[q, at][i], minlength=rows)
                    rare = np.flatnonzero(~known)
                    f = first[rare]
                    rare_ln = lat.score(lower_bytes(w.data), w.start[f], w.end[f] - w.start[f])[0]
                    there = ~here
                    j = (np.cumsum(~known) - 1)[inv[there]]
                    pair, tf = np.unique(w.row[there] * max(len(rare), 1) + j, return_counts=True)
                    r, j = pair // max(len(rare), 1), pair % max(len(rare), 1)
                    u, ln = u[rare][j], rare_ln[j]
                # one row per text, then one per rare word of a text
                m, doc, key = len(r), part.column("doc_id"), part.column("row").to_numpy()
                no = np.arange(rows + m)
                score = lists((sums[3:] + end_score[:, None]).T.ravel(), np.repeat(np.arange(rows), k), rows, pa.float64())
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([doc, doc.take(pa.array(r))]), pa.array(np.concatenate([key, key[r]])),
                    pa.array(np.concatenate([np.zeros(rows, np.int64), u.view(np.int64)]), mask=no < rows),
                    pa.array(np.concatenate([sums[0] + 1, tf]).astype(np.int32)),
                    pa.array(np.concatenate([sums[1] + (ends > 0), np.zeros(m)]).astype(np.int32), mask=no >= rows),
                    pa.array(np.concatenate([sums[2] + end_base, ln])),
                    pa.concat_arrays([score, pa.nulls(m, pa.list_(pa.float64()))]),
                ], ["doc_id", "row", "h", "n", "n_known", "value", "scores"])
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))
    parts = saved(keyed.mapInArrow(run, "doc_id long, row long, h long, n int, n_known int, value double, "
                                        "scores array<double>"))
    tail = counts.where(whole < least).select(F.col("h").alias("ch"), *cols)
    words = (parts.where("h IS NOT NULL").select("doc_id", "row", "h", "n", "value")
                  .join(tail, F.col("h") == F.col("ch"), "left").fillna(0, cols))
    cnt = whole.cast("double")
    sums = [F.sum(F.when(cnt > 0, F.col("n")).otherwise(0)).alias("r_known"),
            F.sum(F.col("n") * F.log10((cnt + 0.1) / denom)).alias("r_base")]
    for i in range(k):
        p = (F.greatest(F.col(f"c{i}") - float(d_z[i]), F.lit(0.0)) / float(n_z[i])
             + F.exp(F.col("value") + math.log(spread_z[i])))
        # the lattice term underflows for very long words: then its logarithm counts alone
        lg = F.when(p > 0, F.log10(p)).otherwise((F.col("value") + math.log(spread_z[i])) / LN10)
        sums.append(F.sum(F.col("n") * lg).alias(f"r_{i}"))
    rare = words.groupBy(F.col("doc_id").alias("r_doc"), F.col("row").alias("r_row")).agg(*sums)
    texts = parts.where("h IS NULL")
    # rows that repeat an id and its text bring their rare words each: share them out
    texts = texts.withColumn("times", F.count(F.lit(1)).over(Window.partitionBy("doc_id", "row")))
    out = texts.join(rare, F.col("doc_id").eqNullSafe(F.col("r_doc")) & (F.col("row") == F.col("r_row")), "left")
    part = lambda x: F.coalesce(F.col(x) / F.col("times"), F.lit(0.0))                         # noqa: E731
    each = F.array(*[F.get("scores", F.lit(i)) + part(f"r_{i}") + math.log10(max(share[i], 1e-12)) for i in range(k)])
    top_s = F.array_max("each")
    mixed = top_s + F.log10(F.aggregate("each", F.lit(0.0), lambda a, x: a + F.pow(F.lit(10.0), x - F.array_max("each"))))
    return (out.withColumn("each", each)
               .select("doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"),
                       F.col("n").cast("long").alias("n_tokens"),
                       (F.col("n_known") + F.round(part("r_known"))).cast("long").alias("n_known"),
                       F.lit(total).cast("long").alias("train_tokens"),
                       (F.col("value") + part("r_base")).alias("base_score"), mixed.alias("score")))
