"""Toxicity from the nearest labelled examples by exact cosine of TF-IDF vectors.

A bounded sample of labelled rows gives the examples.  Texts and examples are
TF-IDF vectors of unit length over the words of the examples (a word that no
example has is in no vector); document frequencies are counted over all
documents.  A word's weight is its inverse document frequency, or that times
1 + its chi square against the label in the examples (label dependence weighs
words, it leaves none out): the one whose calibrated votes have the smaller
log loss on the calibration rows, each half judged with the steps of the
other half; plain weights if they tie.

Search: like examples are put side by side and cut into blocks.  The
inverted index holds the postings of every word, and of every widespread word
and block the largest value.  All postings of a text's other words are added
up once, text by text.  Their largest sum in a block and the sum of the maxima
of the text's widespread words bound its cosine with all examples of the
block.  The blocks with the highest bounds are
scored in full first; after that only blocks whose bound reaches the k-th best
cosine so far are, so the k nearest are exact (ties go to the example with
the smaller id).

The k neighbours vote with weight 1 / (distance + 0.1) against a prior vote;
votes are calibrated by isotonic regression on labelled rows that are neither
in the index nor held out, with straight lines between the middles of its
steps.  A text without a word of any example has no
neighbours and gets the calibrated prior vote.

Defined cases: null and empty texts have no terms; null labels and labels
without a document are ignored, of repeated labels the larger counts; with
no labels every score is 0.5; very long texts are searched whole, their words in
chunks; an empty table gives an empty result; repeated rows are scored alike;
extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.llm.common import fold, saved, shuffle_partitions
from orchard.llm.quality import FOLDS, labelled
from orchard.llm.text import ALNUM, Words, lists, lowered, slices

MAX_ROWS, NEIGHBOURS, CUT = 12_000, 15, 0.5
#: Examples in a block; blocks scored before any is skipped; texts searched at a time.
BLOCK, FIRST, QUERIES = 64, 2, 64
#: The words with the longest postings, which are kept as whole rows; those of them that order the examples.
WIDE, ORDERING = 512, 64
#: Index entries expanded at a time.
CHUNK = 1 << 20
PRIOR_VOTES = 0.5


def text_terms(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(term hash, row) of all words of a string array."""
    w = Words(lowered(arr), ALNUM)
    return w.hash, w.row


def term_lists(rows: DataFrame, keep: str = "") -> DataFrame:
    """(doc_id, terms, tf) and the columns ``keep``: the distinct words of every text, by hash, and their counts."""
    more = [c.split()[0] for c in keep.split(", ") if c]

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                i, row, tf = counted(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), lists(i.view(np.int64), row, part.num_rows, pa.int64()),
                     lists(tf, row, part.num_rows, pa.int32()), *[part.column(c) for c in more]],
                    ["doc_id", "terms", "tf", *more])
    return (rows.select("doc_id", "text", *more)
                .mapInArrow(run, ", ".join(["doc_id long, terms array<long>, tf array<int>", *([keep] if keep else [])])))


def counted(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term hash, row, count) of the distinct words of each text, rows in order."""
    h, row = text_terms(arr)
    o = np.lexsort((h, row))
    h, row = h[o], row[o]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return h[at], row[at], np.diff(np.append(at, len(h))).astype(np.int32)


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(term, df) over all texts; summed in the tasks first."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                h, n = np.unique(counted(part.column("text"))[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["term", "df"])
    return docs.select("text").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


@dataclass
class Vectors:
    """Sparse rows: row (in order), column and value of the entries."""

    rows: int
    row: np.ndarray
    col: np.ndarray
    val: np.ndarray

    @classmethod
    def of(cls, x) -> Vectors:
        if isinstance(x, cls):
            return x
        row, col = np.nonzero(x)
        return cls(len(x), row, col, x[row, col])

    def take(self, keep: np.ndarray) -> Vectors:
        """The rows where ``keep`` is true."""
        on = keep[self.row]
        return Vectors(int(keep.sum()), (np.cumsum(keep) - 1)[self.row[on]], self.col[on], self.val[on])


@dataclass
class Weights:
    """Words of the examples (sorted hashes) with their weights; a word's place is its column."""

    terms: np.ndarray
    weight: np.ndarray

    def vectors(self, h: np.ndarray, row: np.ndarray, tf: np.ndarray, rows: int) -> Vectors:
        """Rows of (1 + log tf) * weight, scaled to length 1."""
        at = np.searchsorted(self.terms, h)
        on = np.flatnonzero(at < len(self.terms))
        on = on[self.terms[at[on]] == h[on]]
        row, col = row[on], at[on]
        val = (1 + np.log(tf[on])) * self.weight[col]
        norm = np.sqrt(np.bincount(row, val ** 2, minlength=rows))
        return Vectors(rows, row, col, val / norm[row])


def flat(terms: pa.ListArray, tf: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term hash, row, count) of the entries of collected lists."""
    terms, tf = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (terms, tf))
    n = terms.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return (terms.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64),
            np.repeat(np.arange(len(n)), n), tf.flatten().to_numpy(zero_copy_only=False))


def label_dependence(n: int, n1: int, d: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Chi square of words in ``d`` examples, ``a`` of them toxic, of ``n`` examples, ``n1`` of them toxic."""
    b, c, e = d - a, n1 - a, (n - n1) - (d - a)
    den = d * (c + e) * (a + c) * (b + e)
    return np.divide(n * (a * e - b * c) ** 2, den, out=np.zeros(len(d)), where=den > 0)


@dataclass
class BlockMaxIndex:
    """Postings of every word, like examples side by side, and maxima of the longest by block of examples.

    Examples are ordered by label, then by which of the most widespread words they hold (so texts of one language are
    neighbours), then by id.  The longest postings are laid out as rows over all examples: a block's share of them is
    scored by a matrix product; all other words are added up from their lists, of one query at a time.
    """

    ids: np.ndarray
    labels: np.ndarray
    start: np.ndarray       # word -> first posting
    example: np.ndarray
    value: np.ndarray
    block: int

    @classmethod
    def build(cls, ids: np.ndarray, labels: np.ndarray, x, block: int = BLOCK, terms: int | None = None) -> BlockMaxIndex:
        terms = x.shape[1] if terms is None else terms
        x, n = Vectors.of(x), len(ids)
        common = np.full(terms, -1)
        common[np.argsort(-np.bincount(x.col, minlength=terms), kind="stable")[:ORDERING]] = np.arange(min(ORDERING, terms))
        holds = np.zeros((n, ORDERING), bool)
        on = common[x.col] >= 0
        holds[x.row[on], common[x.col[on]]] = True
        o = np.lexsort((ids, *holds.T[::-1], labels))
        to = np.empty(n, np.int64)
        to[o] = np.arange(n)
        by = np.lexsort((to[x.row], x.col))
        start = np.concatenate([[0], np.cumsum(np.bincount(x.col, minlength=terms))])
        return cls(ids[o], labels[o], start, to[x.row[by]].astype(np.uint16 if n <= 1 << 16 else np.int64), x.val[by], block)

    def __post_init__(self):
        size = np.diff(self.start)
        wide = np.argsort(-size, kind="stable")[:WIDE]
        self.blocks = -(-len(self.ids) // self.block)
        self.wide = np.full(len(size), -1)
        self.wide[wide] = np.arange(len(wide))
        self.rows = np.zeros((self.blocks, len(wide), self.block))
        at = within(self.start[wide], size[wide])
        blk, place = np.divmod(self.example[at].astype(np.int64), self.block)
        self.rows[blk, np.repeat(np.arange(len(wide)), size[wide]), place] = self.value[at]
        self.row_max = self.rows.max(axis=2, initial=0).T

    def nearest(self, q, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(similarity, example) of the k nearest of each query, best first; -1 where there is none."""
        q = Vectors.of(q)
        best, who = np.zeros((q.rows, k)), np.full((q.rows, k), -1)
        if len(self.ids) == 0:
            return best, who
        edge = np.searchsorted(q.row, np.arange(0, q.rows + QUERIES, QUERIES))
        for j, s in enumerate(range(0, q.rows, QUERIES)):
            on = slice(edge[j], edge[j + 1])
            m = min(QUERIES, q.rows - s)
            score = self.pruned(m, q.row[on] - s, q.col[on], q.val[on], k)
            row, ex = np.nonzero((score >= kth(score, k)[:, None]) & (score > 0))
            got = score[row, ex]
            o = np.lexsort((self.ids[ex], -got, row))
            row, ex, got = row[o], ex[o], got[o]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            top = rank < k
            best[s + row[top], rank[top]], who[s + row[top], rank[top]] = got[top], ex[top]
        return best, who

    def pruned(self, rows: int, row: np.ndarray, col: np.ndarray, val: np.ndarray, k: int) -> np.ndarray:
        """Cosines of the queries and all examples that can be among the k nearest; 0 elsewhere."""
        dense, listed = self.split(rows, row, col, val)
        bound = dense @ self.row_max + listed.max(axis=2)      # no cosine with an example of the block is above
        first = np.zeros(bound.shape, bool)
        lead = min(self.blocks, FIRST + k // self.block)
        np.put_along_axis(first, np.argpartition(-bound, lead - 1, axis=1)[:, :lead], True, axis=1)
        score = self.scores(dense, listed, first)
        more = (bound > 0) & (bound >= kth(score, k)[:, None] - 1e-9) & ~first
        return score + self.scores(dense, listed, more) if more.any() else score

    def split(self, rows: int, row: np.ndarray, col: np.ndarray, val: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The queries' values of wide words as a matrix; what all other words add to (query, block, place)."""
        dense = np.zeros((rows, len(self.row_max)))
        on = self.wide[col] >= 0
        dense[row[on], self.wide[col[on]]] = val[on]
        row, col, val = row[~on], col[~on], val[~on]
        start, count = self.start[col], self.start[col + 1] - self.start[col]
        listed = np.zeros((rows, self.blocks * self.block))
        edge = np.searchsorted(row, np.arange(rows + 1))
        for i in range(rows):
            st, ct, v = (x[edge[i]:edge[i + 1]] for x in (start, count, val))
            for a, b in chunks(ct):
                at = within(st[a:b], ct[a:b])
                listed[i] += np.bincount(self.example[at], np.repeat(v[a:b], ct[a:b]) * self.value[at],
                                         minlength=listed.shape[1])
        return dense, listed.reshape(rows, self.blocks, self.block)

    def scores(self, dense: np.ndarray, listed: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Cosines with the examples of the blocks ``wanted``, to 12 digits (so equal examples tie); 0 elsewhere."""
        out = np.zeros(listed.shape)
        for b in np.flatnonzero(wanted.any(axis=0)):
            q = np.flatnonzero(wanted[:, b])
            out[q, b] = np.round(dense[q] @ self.rows[b] + listed[q, b], 12)
        return out.reshape(len(out), -1)[:, :len(self.ids)]


@dataclass
class Examples:
    """What the tasks get once, by broadcast: the examples' words and counts, at most ``max_rows`` examples.

    A worker makes the vectors and the index of them, and keeps the last one.
    """

    ids: np.ndarray
    labels: np.ndarray
    terms: np.ndarray       # sorted hashes
    idf: np.ndarray
    dependence: np.ndarray
    count: np.ndarray       # examples that hold the term
    example: np.ndarray     # by term
    tf: np.ndarray

    @classmethod
    def build(cls, ids: np.ndarray, labels: np.ndarray, terms: np.ndarray, df: np.ndarray, documents: int,
              h: np.ndarray, row: np.ndarray, tf: np.ndarray) -> Examples:
        at = np.searchsorted(terms, h)
        o = np.argsort(at, kind="stable")
        count = np.bincount(at, minlength=len(terms))
        chi = label_dependence(len(labels), labels.sum(), count.astype(np.float64),
                               np.bincount(at, labels[row], minlength=len(terms)))
        return cls(ids, labels, terms, np.log((documents + 1) / (df + 1)) + 1, 1 + chi, least_kind(count),
                   least_kind(row[o]), least_kind(tf[o]))

    def model(self, dependent: bool) -> tuple[Weights, BlockMaxIndex]:
        made = self.__dict__.get("made")
        if made is None or made[0] != dependent:
            weights = Weights(self.terms, self.idf * self.dependence if dependent else self.idf)
            n, row = len(self.ids), self.example.astype(np.int64)
            col = np.repeat(np.arange(len(self.terms)), self.count)
            val = (1 + np.log(self.tf.astype(np.float64))) * weights.weight[col]
            norm = np.sqrt(np.bincount(row, val ** 2, minlength=n))
            x = Vectors(n, row, col, val / norm[row])
            made = self.made = dependent, weights, BlockMaxIndex.build(self.ids, self.labels, x, terms=len(self.terms))
        return made[1:]


def least_kind(x: np.ndarray) -> np.ndarray:
    """Counts in the smallest unsigned type that holds them."""
    return x.astype(np.min_scalar_type(int(x.max())) if len(x) else np.uint8)


def kth(score: np.ndarray, k: int) -> np.ndarray:
    """The k-th best of each row; 0 where there are fewer."""
    if k > score.shape[1]:
        return np.zeros(len(score))
    return -np.partition(-score, k - 1, axis=1)[:, k - 1]


def within(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... (count[i] of them) for every i."""
    return np.arange(count.sum()) + np.repeat(start - (np.cumsum(count) - count), count)


def chunks(count: np.ndarray):
    """(from, to) of neighbours whose counts add up to about CHUNK."""
    if len(count):
        cut = np.flatnonzero(np.diff(np.cumsum(count) // CHUNK)) + 1
        yield from zip([0, *cut], [*cut, len(count)])


def votes(index: BlockMaxIndex, q: Vectors, k: int, prior: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sim, who = index.nearest(q, k)
    w = np.where(who >= 0, 1 / (1 - np.minimum(sim, 1) + 0.1), 0.0)
    y = index.labels[who] if len(index.ids) else np.zeros(who.shape)
    return ((w * y).sum(axis=1) + PRIOR_VOTES * prior) / (w.sum(axis=1) + PRIOR_VOTES), sim, who


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the increasing step fit (pool adjacent violators), with half a count of either class a step."""
    o = np.argsort(x, kind="stable")
    ux, start, cnt = np.unique(x[o], return_index=True, return_counts=True)
    stack: list[list[float]] = []
    for v, s, c in zip(ux, np.add.reduceat(y[o], start), cnt):
        stack.append([v, float(s), float(c)])
        while len(stack) > 1 and stack[-2][1] / stack[-2][2] >= stack[-1][1] / stack[-1][2]:
            v2, s2, c2 = stack.pop()
            stack[-1][1] += s2
            stack[-1][2] += c2
    return np.array([v for v, _, _ in stack]), np.array([(s + 0.5) / (c + 1) for _, s, c in stack])


def levels(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mean vote, level) of the steps of the isotonic fit; votes between two means are set in proportion."""
    knots, level = isotonic(x, y)
    step = np.searchsorted(knots, x, side="right") - 1
    return np.bincount(step, x) / np.bincount(step) if len(x) else knots, level


def crossed_loss(x: np.ndarray, y: np.ndarray) -> float:
    """Log loss of the calibrated votes, every other row judged with the steps of the rest; 0 with under two rows."""
    loss, odd = 0.0, np.arange(len(x)) % 2 == 1
    for half in (odd, ~odd):
        knots, level = levels(x[half], y[half])
        if len(level):
            p = np.interp(x[~half], knots, level)
            loss -= (np.log(np.where(y[~half] == 1, p, 1 - p))).sum()
    return round(loss, 9)


def calibration_votes(kept: DataFrame, shared, dependent: bool, k: int, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """(vote, label) of the rows of ``term_lists``, in the order of their hash; searched in the tasks."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                weights, index = shared.value.model(dependent)
                q = weights.vectors(*flat(b.column("terms"), b.column("tf")), b.num_rows)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(votes(index, q, k, prior)[0]), b.column("y")],
                                                 ["doc_id", "vote", "y"])
    spread = kept.select("doc_id", "terms", "tf", "y").repartition(shuffle_partitions(kept.sparkSession), "doc_id")
    got = (spread.mapInArrow(run, "doc_id long, vote double, y int")
                 .orderBy(F.xxhash64("doc_id"), "vote").select("vote", "y").toArrow())
    return got.column("vote").to_numpy(), got.column("y").to_numpy().astype(np.float64)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label: str = "toxic", max_rows: int = MAX_ROWS, k: int = NEIGHBOURS, cut: float = CUT) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score``, ``predicted`` and ``evidence``.

    ``evidence``: the three nearest examples as (doc_id, similarity, label).
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    in_index = fold(F.col("doc_id"), FOLDS) != FOLDS - 1        # the last fold calibrates
    rows = (labelled(docs, labels, label, max_rows).withColumn("idx", in_index)
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    kept = saved(term_lists(rows, "y int, idx boolean"))
    if not kept.where("NOT idx").take(1):
        kept = kept.withColumn("idx", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) != 0)
    n = docs.count()
    size, ones = kept.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    prior = (ones + 0.5) / (size + 1)
    words = kept.where("idx").select(F.explode("terms").alias("term")).distinct()
    known = document_frequencies(docs).join(words, "term").toArrow()
    terms = known.column("term").to_numpy().astype(np.int64).view(np.uint64)
    o = np.argsort(terms)
    terms, df = terms[o], known.column("df").to_numpy()[o]
    sample = kept.where("idx").select("doc_id", "y", "terms", "tf").toArrow()
    ids, y = sample.column("doc_id").to_numpy(), sample.column("y").to_numpy().astype(np.float64)
    h, row, tf = flat(sample.column("terms"), sample.column("tf"))
    del sample, known
    shared = docs.sparkSession.sparkContext.broadcast(Examples.build(ids, y, terms, df, n, h, row, tf))
    del h, row, tf
    best = None
    for kind in (False, True):
        got = calibration_votes(kept.where("NOT idx"), shared, kind, k, prior)
        loss = crossed_loss(*got)
        if best is None or loss < best[0]:
            best = loss, kind, levels(*got)
    _, dependent, (knots, level) = best

    def run(batches):
        for b in batches:
            for part in slices(b, "text"):
                weights, index = shared.value.model(dependent)
                q = weights.vectors(*counted(part.column("text")), part.num_rows)
                v, sim, who = votes(index, q, k, prior)
                score = np.interp(v, knots, level) if len(level) else np.full(len(v), 0.5)
                near = [[{"doc_id": int(index.ids[e]), "similarity": float(c), "label": int(index.labels[e])}
                         for c, e in zip(cs, es) if e >= 0] if es[0] >= 0 else []
                        for cs, es in zip(sim[:, :3], who[:, :3])]
                kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("label", pa.int32())]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score), pa.array(near, kind)],
                                                 ["doc_id", "score", "evidence"])
    out = docs.mapInArrow(run, "doc_id long, score double, "
                                 "evidence array<struct<doc_id: long, similarity: double, label: int>>")
    return out.select("doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
                      (F.col("score") >= cut).cast("int").alias("predicted"), "evidence")
