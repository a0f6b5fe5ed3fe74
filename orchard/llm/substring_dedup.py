"""Removal of passages that repeat across documents, by paragraph MinHash banding.

A paragraph is a line of a text.  Paragraphs of at least ``min_words`` words
are compared as sets of five-word shingles; equal shingle bags are one node,
so a passage shared by millions of documents is one row in the comparison.
Bands are tuned: the cheapest number of bands whose chance of colliding at
the similarity threshold reaches the target recall, with the most rows per
band that a probe row budget allows.  Paragraphs that collide in a band are
joined; signatures rule out clearly different pairs (false drop below 1e-4)
and the survivors are verified exactly: Jaccard similarity of the shingle
sets, or word edit similarity, at the threshold or above.  Verified links
are clustered by components; of each cluster the occurrence with the
smallest (doc_id, paragraph) stays and all others are removals.

What is left without the removed paragraphs is then compared as a whole, whatever
its line breaks: every run of ``min_words`` words that stands at two places or more
stays at the smallest (doc_id, version, word number), and the words of its
other occurrences are cut by span, but for words that a kept occurrence
covers.  Runs are found by their seeds, the shorter runs of words with the
smallest hash of a window: every run of ``min_words`` words holds one, and it
is the same one wherever the run stands, so only runs over a seed that
repeats are compared (by 64-bit hashes, no seed is sampled or capped).
Passages with changed words that are not whole lines lose the unchanged
stretches of at least ``min_words`` words, not the shorter ones.

``passages`` lists all of this by word span, ``remove_repeats`` applies it.

Defined cases: null texts have no paragraphs; shorter paragraphs are not
compared as paragraphs, only as parts of runs of words; rows that repeat a doc_id and its text are one document
(they keep and lose the same paragraphs); a null doc_id sorts first; extra
columns are kept by ``remove_repeats`` and ignored by the others; very long texts
are read whole, each as a slice of its own; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orchard.llm import pairs
from orchard.llm.common import fresh, saved, small_side
from orchard.llm.jaccard_join import classes, least_agreeing, only_flagged, verified_links
from orchard.llm.text import ALNUM, Words, lists, lowered, minhash, mix, runs_of, set_ids, shingles, slices, unique_sets, tidy

#: Passages from this many words on count as repeats.
MIN_WORDS = 40
THRESHOLD, RECALL, MAX_HASHES = 0.8, 0.999, 32


def tune_bands(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): most rows a band with bands * rows <= hashes and recall reached at the threshold."""
    best = None
    for rows in range(1, hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-threshold ** rows))
        if bands * rows <= hashes:
            best = bands, rows
    if best is None:
        raise ValueError("the recall needs more hashes")
    return best


def _paragraphs(part: pa.RecordBatch, min_words: int):
    """Words of the long paragraphs of a batch: (row, paragraph number, word hashes, dense number, number, words before
    the paragraph in its text, words in it)."""
    lines = pc.split_pattern(pc.fill_null(part.column("text"), ""), "\n")
    flat = lines.flatten()
    count = lines.value_lengths().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(count)), count)
    number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    w = Words(lowered(flat), ALNUM)
    words = w.counts()
    before = np.cumsum(words) - words
    long = words >= min_words
    keep = long[w.row]
    dense = (np.cumsum(long) - 1)[w.row[keep]]
    first = (before - before[np.arange(len(row)) - number])[long]
    return row[long], number[long], w.hash[keep], dense, int(long.sum()), first, words[long]


def sketches(docs: DataFrame, min_words: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, version, para, first_word, words, id, sig, keys) of every long paragraph."""
    t = bands * rows

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                row, number, h, dense, n, first, words = _paragraphs(part, min_words)
                if n == 0:
                    continue
                s, r = shingles(h, dense, n)
                _, sig = minhash(s, r, t)
                keys = np.empty((n, bands), np.uint64)
                for b in range(bands):
                    key = np.full(n, b + 1, np.uint64)
                    for i in range(b * rows, b * rows + rows):
                        key = mix(key ^ mix(sig[:, i].astype(np.uint64) + np.uint64(i << 32)))
                    keys[:, b] = key | np.uint64(1)
                low = np.ascontiguousarray(sig.astype(np.uint8))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(row)), part.column("version").take(pa.array(row)),
                    pa.array(number.astype(np.int32)), pa.array(first.astype(np.int64)), pa.array(words.astype(np.int64)),
                    pa.array(set_ids(s, r)),
                    pa.array([x.tobytes() for x in low], pa.binary()),
                    lists(keys.view(np.int64).ravel(), np.repeat(np.arange(n), bands), n, pa.int64()),
                ], ["doc_id", "version", "para", "first_word", "words", "id", "sig", "keys"])
    return docs.mapInArrow(tidy(run), "doc_id long, version long, para int, first_word long, words long, id long, sig binary, "
                                "keys array<long>")


def paragraph_sets(docs: DataFrame, min_words: int) -> DataFrame:
    """(id, items) of every long paragraph: its distinct shingles."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                _, _, h, dense, n, _, _ = _paragraphs(part, min_words)
                if n == 0:
                    continue
                s, r = shingles(h, dense, n)
                u, ur = unique_sets(s, r)
                yield pa.RecordBatch.from_arrays([pa.array(set_ids(s, r)), lists(u.view(np.int64), ur, n, pa.int64())],
                                                 ["id", "items"])
    return docs.select("text").mapInArrow(tidy(run), "id long, items array<long>")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
            threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per occurrence of a repeated paragraph.

    ``doc_id``, ``version`` (hash of the text), ``para`` (line number from
    0), ``first_word`` (words of the text before it), ``words`` in it,
    ``cluster_doc_id``/``cluster_para`` (the occurrence that stays),
    ``occurrences`` in the cluster and ``removed``.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumn("version", F.xxhash64("text"))
    bands, rows = tune_bands(threshold, recall)
    occ = saved(sketches(docs, min_words, bands, rows))
    nodes = saved(occ.groupBy("id").agg(F.min(F.struct("doc_id", "para", "version")).alias("first"),
                                        F.count(F.lit(1)).alias("weight"), F.first("sig").alias("sig"),
                                        F.first("keys").alias("keys")))
    here = nodes.select("id", F.posexplode("keys").alias("slot", "key"))
    members = here.join(saved(pairs.bucket_sizes(here)), ["slot", "key"])
    links = verified_links(members, nodes.select("id", "weight", "sig"),
                           lambda ids: only_flagged(paragraph_sets(docs, min_words), ids), bands,
                           pairs.signature_filter(bands * rows, least_agreeing(bands * rows, threshold)),
                           pairs.jaccard_check(threshold))
    cls = classes(nodes.select("id", "first", "weight"), links, "first")
    total = cls.groupBy("root").agg(F.sum("weight").alias("occurrences"))
    cls = saved(cls.join(total, "root").where("occurrences > 1").select("id", "class", "occurrences"))
    out = occ.select("doc_id", "version", "para", "first_word", "words", "id").join(cls, "id")
    return out.select("doc_id", "version", "para", "first_word", "words", F.col("class.doc_id").alias("cluster_doc_id"),
                      F.col("class.para").alias("cluster_para"), "occurrences",
                      (~(F.col("doc_id").eqNullSafe(F.col("class.doc_id")) & (F.col("para") == F.col("class.para"))
                         & (F.col("version") == F.col("class.version")))).alias("removed"))


def chosen(h: np.ndarray, row: np.ndarray, w: int) -> np.ndarray:
    """True where a hash is the smallest of some window of ``w`` neighbours of its row."""
    n, m = len(h), len(h) - w + 1
    if m <= 0:
        return np.zeros(n, bool)

    def sliding(x: np.ndarray, take) -> np.ndarray:
        width, size = 1, len(x) - w + 1
        while width * 2 <= w:
            x, width = take(x[:-width], x[width:]), width * 2
        return take(x[:size], x[w - width:w - width + size])
    low = np.where(row[w - 1:] == row[:m], sliding(h, np.minimum), np.uint64(0))
    wide = np.zeros(n + w - 1, np.uint64)
    wide[w - 1:w - 1 + m] = low
    return h == sliding(wide, np.maximum)


def seeds(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, version, at, h): word numbers and hashes of the seeds of every text."""
    k = (min_words + 1) // 2

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                w = Words(lowered(part.column("text")), ALNUM)
                at, h = runs_of(w.hash, w.row, k)
                h |= np.uint64(1)
                pick = chosen(h, w.row[at], min_words - k + 1)
                at, h = at[pick], h[pick]
                row = w.row[at]
                first = np.searchsorted(w.row, row)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("version"),
                    lists((at - first).astype(np.int32), row, part.num_rows, pa.int32()),
                    lists(h.view(np.int64), row, part.num_rows, pa.int64())], ["doc_id", "version", "at", "h"])
    return docs.mapInArrow(tidy(run), "doc_id long, version long, at array<int>, h array<long>")


def seeded_runs(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, version, pos, gram) of the runs of ``min_words`` words over the seeds in ``hits``."""
    k = (min_words + 1) // 2

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                w = Words(lowered(part.column("text")), ALNUM)
                hits = part.column("hits")
                row = np.repeat(np.arange(part.num_rows), hits.value_lengths().to_numpy(zero_copy_only=False))
                last = np.searchsorted(w.row, row) + hits.flatten().to_numpy(zero_copy_only=False)
                over = np.zeros(len(w.row) + 1, np.int64)
                np.add.at(over, np.maximum(last - (min_words - k), 0), 1)
                np.add.at(over, last + 1, -1)
                at, h = runs_of(w.hash, w.row, min_words)
                ok = np.cumsum(over)[at] > 0
                at, h = at[ok], h[ok]
                row = w.row[at]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(row)), part.column("version").take(pa.array(row)),
                    pa.array((at - np.searchsorted(w.row, row)).astype(np.int32)), pa.array(h.view(np.int64))],
                    ["doc_id", "version", "pos", "gram"])
    return docs.mapInArrow(tidy(run), "doc_id long, version long, pos int, gram long")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, version, again, stay) of every text with a run of words that stands at two places or more.

    ``docs``: doc_id, version, text.  ``again``: word numbers at which runs
    start that stay elsewhere; ``stay``: starts of those that stay here.
    """
    own = docs.select("doc_id", "version")
    found = saved(seeds(docs, min_words))
    flat = found.select("doc_id", "version", F.inline(F.arrays_zip("at", "h")))
    twice = saved(flat.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"))
    hits = saved(flat.join(small_side(twice, 16), "h", "left_semi")
                     .groupBy(*[F.col(c).alias(f"_{c}") for c in own.columns]).agg(F.collect_set("at").alias("hits")))
    size = hits.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("hits")), F.lit(0))).first()
    same = docs["doc_id"].eqNullSafe(F.col("_doc_id")) & (docs["version"] == F.col("_version"))
    texts = docs.join(small_side(hits, 1, size[0] * 48 + size[1] * 4), same)
    occ = saved(seeded_runs(texts.select("doc_id", "version", "text", "hits"), min_words))
    here = F.struct("doc_id", "version", "pos")
    first = saved(occ.groupBy("gram").agg(F.min(here).alias("first"), F.max(here).alias("last"))
                     .where(~F.col("first").eqNullSafe(F.col("last"))).select("gram", "first"))
    marked = occ.join(first, "gram").select("doc_id", "version", "pos", here.eqNullSafe(F.col("first")).alias("stays"))
    return (marked.groupBy("doc_id", "version")
                  .agg(F.collect_set(F.when(~F.col("stays"), F.col("pos"))).alias("again"),
                       F.collect_set(F.when(F.col("stays"), F.col("pos"))).alias("stay")))


def covered(n: int, starts, min_words: int) -> np.ndarray:
    """True for those of ``n`` words that a run of ``min_words`` words from one of ``starts`` holds."""
    d = np.zeros(n + 1, np.int64)
    s = np.unique(np.asarray(starts, np.int64))
    d[s] += 1
    np.add.at(d, s + min_words, -1)
    return np.cumsum(d)[:n] > 0


def run_spans(runs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, version, first_word, words, removed): the stretches of words in repeated runs.

    ``runs``: a row of ``repeated_runs`` and ``cut``, the spans (first_word,
    words) taken out of the text before; word numbers of the result count them.
    """
    def run(batches):
        for batch in batches:
            for part in batch.to_pylist():
                n = max([*part["again"], *part["stay"]]) + min_words
                at = np.arange(n)
                for x in sorted(part["cut"] or [], key=lambda x: x["first_word"]):
                    at[at >= x["first_word"]] += x["words"]
                kept = covered(n, part["stay"], min_words)
                first, words, removed = [], [], []
                for on, gone in ((covered(n, part["again"], min_words) & ~kept, True), (kept, False)):
                    here = at[on]
                    if len(here):
                        edge = np.flatnonzero(np.diff(here) != 1) + 1
                        size = np.diff([0, *edge, len(here)])
                        first += here[[0, *edge]].tolist()
                        words += size.tolist()
                        removed += [gone] * len(size)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": pa.array([part["doc_id"]] * len(first), pa.int64()),
                     "version": pa.array([part["version"]] * len(first), pa.int64()),
                     "first_word": pa.array(first, pa.int64()), "words": pa.array(words, pa.int64()),
                     "removed": pa.array(removed, pa.bool_())})
    return runs.mapInArrow(tidy(run), "doc_id long, version long, first_word long, words long, removed boolean")


def without_lines(text: Column, lines: Column) -> Column:
    """``text`` without the lines whose numbers are in ``lines``; null numbers leave it as it is."""
    kept = F.array_join(F.filter(F.split(text, "\n", -1), lambda x, at: ~F.array_contains(lines, at)), "\n")
    return F.when(lines.isNull(), text).otherwise(kept)


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
             **options) -> DataFrame:
    """One row per stretch of words that repeats, over the whole texts.

    ``doc_id``, ``version`` (hash of the text), ``kind`` (``paragraph`` or
    ``run``), ``first_word`` (words of the text before it), ``words`` and
    ``removed``; for paragraphs the columns of ``repeats`` as well (null for
    runs).  Runs are looked for without the removed paragraphs.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumn("version", F.xxhash64("text"))
    lines = saved(repeats(docs, min_words=min_words, **options))
    span = F.struct("first_word", "words")
    cut = saved(lines.where("removed").groupBy(F.col("doc_id").alias("_d"), F.col("version").alias("_v"))
                     .agg(F.collect_set("para").alias("lines"), F.collect_set(span).alias("cut")))
    rows, size = cut.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("cut")), F.lit(0))).first()
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("version") == F.col("_v"))
    left = (docs.join(small_side(cut.select("_d", "_v", "lines"), 1, rows * 48 + size * 8), same, "left")
                .select("doc_id", "version", without_lines(F.col("text"), F.col("lines")).alias("text")))
    runs = repeated_runs(left, min_words).join(cut.select("_d", "_v", "cut"), same, "left")
    spans = run_spans(runs.select("doc_id", "version", "again", "stay", "cut"), min_words)
    return lines.withColumn("kind", F.lit("paragraph")).unionByName(spans.withColumn("kind", F.lit("run")),
                                                                    allowMissingColumns=True)


def without_runs(text: str, again, stay, min_words: int) -> str:
    """``text`` without the words of the runs that start at ``again``, but for those of the runs at ``stay``."""
    w = Words(pa.array([text], pa.large_string()), ALNUM)
    n = len(w.start)
    gone = covered(n, again, min_words) & ~covered(n, stay, min_words)
    if gone.all():
        return ""
    raw, out, at = w.data.tobytes(), [], 0
    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    for a, b in edge.reshape(-1, 2):
        out.append(raw[at:w.start[a]])
        at = re.compile(rb"\S*\s*").match(raw, w.end[b - 1], w.start[b] if b < n else len(raw)).end()
    return b"".join([*out, raw[at:]]).decode()


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                   **options) -> DataFrame:
    """``docs`` without the repeated paragraphs and runs of words; a document that loses all its text goes.

    Columns stay as they are, but for the text.
    """
    own, i, v, lines, again, stay = fresh(docs, "_version", "_id", "_v", "_lines", "_again", "_stay")
    drop = saved(repeats(docs, id_col, text_col, min_words, **options).where("removed")
                 .groupBy(F.col("doc_id").alias(i), F.col("version").alias(v))
                 .agg(F.collect_set("para").alias(lines)))
    marked = docs.withColumn(own, F.xxhash64(F.col(text_col).cast("string")))
    joined = marked.join(small_side(drop, 64), F.col(id_col).eqNullSafe(F.col(i)) & (F.col(own) == F.col(v)), "left")
    left = joined.withColumn(text_col, without_lines(F.col(text_col), F.col(lines)))
    left = (left.where(F.col(lines).isNull() | (F.trim(F.col(text_col)) != "")).select(*[f"`{c}`" for c in docs.columns])
                .withColumn(own, F.xxhash64(F.col(text_col).cast("string"))))
    spans = saved(repeated_runs(left.select(F.col(id_col).alias("doc_id"), F.col(own).alias("version"),
                                            F.col(text_col).cast("string").alias("text")), min_words)
                  .toDF(i, v, again, stay).where(F.size(again) > 0))
    rows, starts = spans.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size(again) + F.size(stay)), F.lit(0))).first()

    @F.pandas_udf("string")
    def cut(text: pd.Series, more: pd.Series, keep: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else without_runs(t, m, k, min_words) for t, m, k in zip(text, more, keep)],
                         dtype=object)
    joined = left.join(small_side(spans, 1, rows * 48 + starts * 4),
                       F.col(id_col).eqNullSafe(F.col(i)) & (F.col(own) == F.col(v)), "left")
    out = joined.withColumn(lines, cut(F.when(F.col(again).isNotNull(), F.col(text_col).cast("string")), again, stay))
    out = out.withColumn(text_col, F.when(F.col(again).isNull(), F.col(text_col)).otherwise(F.col(lines)))
    return out.where(F.col(again).isNull() | (F.trim(F.col(text_col)) != "")).select(*[f"`{c}`" for c in docs.columns])
