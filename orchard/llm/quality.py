"""Quality classifier: a generalised additive model with pairwise interactions.

Every text becomes a short vector of whole-text features (lengths, character
classes, repetition of words, five-word runs and lines).  The model adds one
lookup table per feature and one per chosen feature pair: features are cut
into quantile bins, and cyclic gradient boosting visits the features in turn
and adds a shallow tree (two levels over the bins) with a small learning
rate to the feature's table; the pairs with the largest residual gain are
boosted the same way over coarse two-dimensional bins.  Scoring looks up and
adds the bins of a whole column batch at once.

The fit uses a bounded sample of labelled rows (``max_rows``, taken by a hash
of the id) because the tables stop changing beyond some ten thousand rows;
every document is scored.

Defined cases: a null or empty text has all features 0 and gets the score
that the tables give them; labels that are null or whose document is absent
are ignored, of repeated labels the larger one counts; without two classes
among the labels the score is the share of ones (0.5 without labels); extra
columns are kept by ``keep_good`` and ignored by ``score_quality``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.llm.common import fold, saved, without_ids
from orchard.llm.text import Words, buffers, lists, shingles, slices, space_table, tidy

MAX_ROWS, BINS, PAIR_BINS, ROUNDS, PAIR_ROUNDS, RATE, PAIRS = 20_000, 48, 12, 200, 60, 0.1, 8
CUT = 0.3
FOLDS = 5

FEATURES = ("log_words", "chars_per_word", "upper", "digits", "exclaim", "pipes", "symbols", "stops", "commas",
            "lines_per_word", "non_ascii", "unique_words", "top_word", "same_as_before", "repeated_runs",
            "repeated_lines", "short_words")


def _per_row(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    c = np.zeros(len(mask) + 1, np.int32)
    np.cumsum(mask, out=c[1:])
    return (c[off[1:]] - c[off[:-1]]).astype(np.float64)


def _repeats(h: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(count, distinct, most of one kind) of hashes per row; 44 bits of a hash tell two apart."""
    n = np.bincount(row, minlength=rows).astype(np.float64)
    if len(h) == 0:
        return n, np.zeros(rows), np.zeros(rows)
    key = np.sort((row.astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20)))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    run = np.diff(np.append(first, len(key)))
    r = (key[first] >> np.uint64(44)).astype(np.int64)
    top = np.zeros(rows)
    np.maximum.at(top, r, run)
    return n, np.bincount(r, minlength=rows).astype(np.float64), top


_SPACE = space_table()
_LINE = np.arange(256).astype(np.uint8)
_LINE[0], _LINE[10] = 1, 0
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*@^~_=+<>{}[]\\/"]] = True


def text_features(arr: pa.Array) -> np.ndarray:
    """Feature matrix of a string array without nulls."""
    data, off = buffers(arr)
    rows = len(arr)
    w = Words(arr, _SPACE)
    words, distinct, top = _repeats(w.hash, w.row, rows)
    s, sr = shingles(w.hash, w.row, rows)
    runs, run_kinds, _ = _repeats(s, sr, rows)
    ln = Words(arr, _LINE)
    lines, line_kinds, _ = _repeats(ln.hash, ln.row, rows)
    same = np.zeros(rows)
    if len(w.hash) > 1:
        eq = (w.hash[1:] == w.hash[:-1]) & (w.row[1:] == w.row[:-1])
        same = np.bincount(w.row[1:][eq], minlength=rows).astype(np.float64)
    size = np.diff(off).astype(np.float64)
    letters = _per_row(((data >= 65) & (data <= 90)) | ((data >= 97) & (data <= 122)) | (data >= 128), off)
    short = np.bincount(w.row[(w.end - w.start) <= 3], minlength=rows).astype(np.float64)
    per_word, per_char = np.maximum(words, 1), np.maximum(size, 1)
    cols = [
        np.log1p(words), (w_len := np.bincount(w.row, weights=(w.end - w.start), minlength=rows)) / per_word,
        _per_row((data >= 65) & (data <= 90), off) / np.maximum(letters, 1),
        _per_row((data >= 48) & (data <= 57), off) / per_char,
        _per_row(data == 33, off) / per_word, _per_row(data == 124, off) / per_word,
        _per_row(_SYMBOL[data], off) / per_word, _per_row(data == 46, off) / per_word,
        _per_row(data == 44, off) / per_word, _per_row(data == 10, off) / per_word,
        _per_row(data >= 128, off) / per_char, distinct / per_word, top / per_word, same / per_word,
        1 - run_kinds / np.maximum(runs, 1), 1 - line_kinds / np.maximum(lines, 1), short / per_word,
    ]
    out = np.stack(cols, axis=1)
    out[w_len == 0] = 0
    return out


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the features of every row of (doc_id, text)."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                x = text_features(pc.fill_null(part.column("text"), ""))
                n, k = x.shape
                yield pa.RecordBatch.from_arrays([part.column("doc_id"),
                                                  lists(x.astype(np.float32).ravel(), np.repeat(np.arange(n), k), n,
                                                        pa.float32())], ["doc_id", "x"])
    return docs.mapInArrow(tidy(run), "doc_id long, x array<float>")


@dataclass
class Additive:
    """Intercept, bin edges, one table per feature, and tables of pairs."""

    base: float = 0.0
    edges: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    pair_edges: list = field(default_factory=list)
    pairs: list = field(default_factory=list)          # (i, j, table)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        if not self.edges:
            return out
        for k, (e, t) in enumerate(zip(self.edges, self.tables)):
            out += t[np.searchsorted(e, x[:, k], side="right")]
        coarse = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.pair_edges)]
        for i, j, t in self.pairs:
            out += t[coarse[i], coarse[j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _cuts(v: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(v, np.linspace(0, 1, bins + 1)[1:-1]))


def _split(g: np.ndarray, h: np.ndarray, lam: float = 1.0):
    """(gain, place) of the best cut of a run of bins."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gt, ht = g.sum(), h.sum()
    gain = gl ** 2 / (hl + lam) + (gt - gl) ** 2 / (ht - hl + lam) - gt ** 2 / (ht + lam)
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def _shallow_tree(g: np.ndarray, h: np.ndarray, lam: float = 1.0) -> np.ndarray:
    """Leaf values over the bins of a tree of two levels."""
    out = np.zeros(len(g))
    _, mid = _split(g, h)
    for a, b in ((0, mid), (mid, len(g))):
        if b <= a:
            continue
        _, cut = _split(g[a:b], h[a:b])
        for s, e in ((a, a + cut), (a + cut, b)):
            if e > s:
                out[s:e] = -g[s:e].sum() / (h[s:e].sum() + lam)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, lam: float = 1.0) -> tuple[float, np.ndarray]:
    """Best crossing of one cut per axis of a two-dimensional histogram: (gain, values)."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    gt, ht = cg[-1, -1], ch[-1, -1]
    a, b = cg[:-1, :-1], ch[:-1, :-1]
    r, rh = cg[:-1, -1:], ch[:-1, -1:]
    c, chh = cg[-1:, :-1], ch[-1:, :-1]
    if a.size == 0:
        return 0.0, np.zeros_like(g)
    parts = [(a, b), (r - a, rh - b), (c - a, chh - b), (gt - r - c + a, ht - rh - chh + b)]
    gain = sum(x ** 2 / (y + lam) for x, y in parts) - gt ** 2 / (ht + lam)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.empty_like(g)
    v = [-(x[i, j]) / (y[i, j] + lam) for x, y in parts]
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = v
    return float(gain[i, j]), out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pair_rounds: int = PAIR_ROUNDS, rate: float = RATE,
        bins: int = BINS, pair_bins: int = PAIR_BINS, pairs: int = PAIRS) -> Additive:
    m = Additive()
    share = float(y.mean()) if len(y) else 0.5
    m.base = float(np.log((share * len(y) + 0.5) / ((1 - share) * len(y) + 0.5)))
    if len(np.unique(y)) < 2:
        return m
    k = x.shape[1]
    m.edges = [_cuts(x[:, i], bins) for i in range(k)]
    code = [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(m.edges)]
    m.tables = [np.zeros(len(e) + 1) for e in m.edges]
    f = np.full(len(y), m.base)
    for _ in range(rounds):
        for i in range(k):
            p = 1 / (1 + np.exp(-f))
            n = len(m.tables[i])
            step = rate * _shallow_tree(np.bincount(code[i], p - y, n), np.bincount(code[i], p * (1 - p), n))
            m.tables[i] += step
            f += step[code[i]]
    m.pair_edges = [_cuts(x[:, i], pair_bins) for i in range(k)]
    coarse = [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(m.pair_edges)]
    size = [len(e) + 1 for e in m.pair_edges]

    def square(i, j, v):
        return np.bincount(coarse[i] * size[j] + coarse[j], v, size[i] * size[j]).reshape(size[i], size[j])
    p = 1 / (1 + np.exp(-f))
    gains = sorted(((_quadrants(square(i, j, p - y), square(i, j, p * (1 - p)))[0], i, j)
                    for i in range(k) for j in range(i + 1, k)), reverse=True)
    m.pairs = [(i, j, np.zeros((size[i], size[j]))) for _, i, j in gains[:pairs]]
    for _ in range(pair_rounds):
        for i, j, t in m.pairs:
            p = 1 / (1 + np.exp(-f))
            step = rate * _quadrants(square(i, j, p - y), square(i, j, p * (1 - p)))[1]
            t += step
            f += step[coarse[i], coarse[j]]
    return m


def labelled(rows: DataFrame, labels: DataFrame, label: str, max_rows: int, folds: int = FOLDS) -> DataFrame:
    """``rows`` joined with the labels of a bounded hash sample of the training fold (column ``y``)."""
    known = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
                   .where(fold(F.col("doc_id"), folds) != 0)
                   .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
                   .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    return rows.join(F.broadcast(known), "doc_id")      # at most max_rows rows of 12 bytes


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label: str = "quality", max_rows: int = MAX_ROWS, cut: float = CUT) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score``, ``predicted``."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    x = saved(features(docs))
    sample = (labelled(x, labels, label, max_rows).orderBy(F.xxhash64("doc_id"), "doc_id", "x")
              .limit(max_rows).toPandas())
    rows = np.array(sample["x"].tolist(), dtype=np.float32).reshape(len(sample), len(FEATURES)).astype(np.float64)
    model = fit(rows, sample["y"].to_numpy(dtype=np.float64))

    def run(batches):
        for b in batches:
            if b.num_rows:
                v = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).astype(np.float64)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.score(v))], ["doc_id", "score"])
    out = x.mapInArrow(tidy(run), "doc_id long, score double")
    return out.select("doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
                      (F.col("score") >= cut).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              **options) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns.

    A row whose id is null cannot be named and stays; rows that repeat an id
    stay when one of them is accepted.
    """
    scored = score_quality(docs, labels, id_col, text_col, **options)
    good = scored.groupBy("doc_id").agg(F.max("predicted").alias("p"))
    return without_ids(docs, id_col, good.where("p = 0").select("doc_id"))
