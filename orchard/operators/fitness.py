"""Fitness scoring of candidate tables.

The reference's randomised optimisers evaluate one candidate at a time in a
single JVM.  Here a *table* of candidates ``(cand_id, bits ARRAY<INT>)`` is
scored as a projection (higher-order array functions, no Python), so a
population or a whole neighbourhood is one Spark stage.  The solvers
themselves are not rebuilt (see README).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orchard.functions.hashing import hash_u32


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------------------- F1
def alternating_bits(bits, n: int | None = None) -> Column:
    """positions matching the alternating pattern whose first element
    is set by bit 0 (0 -> 0101..., anything else -> 1010...); max = n.
    With the length ``n`` known the sum is n plain terms (whole-stage
    code generation); otherwise a higher-order ``aggregate``."""
    b = _col(bits)
    first = F.when(b[0].cast("int") == 0, F.lit(0)).otherwise(F.lit(1))
    if n is not None:
        terms = [F.when(b[i].cast("int") == (first if i % 2 == 0 else F.lit(1) - first), 1).otherwise(0)
                 for i in range(n)]
        total = terms[0]
        for x in terms[1:]:
            total = total + x
        return F.when(F.size(b) == n, total).otherwise(alternating_bits(b))
    hits = F.transform(b, lambda x, i: F.when(
        x.cast("int") == F.when(i % 2 == 0, first).otherwise(F.lit(1) - first), 1).otherwise(0))
    return F.aggregate(hits, F.lit(0), lambda acc, h: acc + h)


# ----------------------------------------------------------------------- F2
def four_peaks(bits, t: int | Column | None = None) -> Column:
    """max(leading ones, trailing zeros), plus n when both exceed T
    (T = n // 10 by default, as the reference's driver sets it)."""
    b = _col(bits).cast("array<int>")
    n = F.size(b)
    p0 = F.array_position(b, 0)
    head = F.when(p0 == 0, n).otherwise(p0 - 1)
    p1 = F.array_position(F.reverse(b), 1)
    tail = F.when(p1 == 0, n).otherwise(p1 - 1)
    tt = (F.floor(n / 10).cast("int") if t is None else (t if isinstance(t, Column) else F.lit(t)))
    bonus = F.when((head > tt) & (tail > tt), n).otherwise(0)
    return (F.greatest(head, tail) + bonus).cast("int")


# ----------------------------------------------------------------------- F3
#: Nodes of a block (even): a tile of the graph is the edges between two blocks.
BLOCK = 1024


def kcolour_graph(spark: SparkSession, n: int, block: int = BLOCK) -> DataFrame:
    """forward edges i -> i+2, i+4, ... < n (n < 3 is raised to 3).

    There are about n^2 / 4 of them, so what counts is their size when
    written: they come by tiles (pairs of blocks, an even number of them a
    task), in which a source is a run and the targets of one source repeat
    those of the source before.  Columns of such rows compress to a small
    part of the same rows by source."""
    nn, step = max(n, 3), F.lit(2).cast("long")
    blocks = -(-nn // block)
    blocks += blocks % 2                                  # rows r and blocks - 1 - r of the triangle make one row of blocks + 1 tiles
    tiles = blocks // 2 * (blocks + 1)
    at = spark.range(0, tiles, 1, max(spark.sparkContext.defaultParallelism, tiles // 64))
    r, c = F.floor(F.col("id") / (blocks + 1)), F.col("id") % (blocks + 1)
    upper = c < blocks - r
    a = F.when(upper, r).otherwise(blocks - 1 - r)
    at = at.select(a.alias("a"), F.when(upper, r + c).otherwise(c - 1).alias("b"))
    top = lambda k: F.least((F.col(k) + 1) * block - 1, F.lit(nn - 1).cast("long"))      # noqa: E731
    at = at.select("a", "b", top("a").alias("a1"), top("b").alias("b1"), F.explode(F.array(F.lit(0), F.lit(1))).alias("odd"))
    at = at.where(F.col("a") * block + F.col("odd") <= F.col("a1"))
    at = at.select("a", "b", "b1", "odd", F.explode(F.sequence(F.col("a") * block + F.col("odd"), F.col("a1"), step)).alias("src"))
    first = F.when(F.col("a") == F.col("b"), F.col("src") + 2).otherwise(F.col("b") * block + F.col("odd"))
    at = at.select("src", first.alias("first"), "b1").where(F.col("first") <= F.col("b1"))
    ends = [F.col(x).cast("int") for x in ("first", "b1")]
    return at.select(F.col("src").cast("int").alias("src"), F.explode(F.sequence(*ends, F.lit(2))).alias("dst"))


def forward_neighbours(n: int) -> list[list[int]]:
    nn = max(n, 3)
    return [list(range(i + 2, nn, 2)) for i in range(nn)]


# ----------------------------------------------------------------------- F4
def kcolour_fitness(colours, n: int) -> Column:
    """F4 on an array of colours: nodes with no same-coloured forward
    neighbour (only the source node of a conflicting edge is penalised).
    The graph is the fixed forward graph of :func:`kcolour_graph`, inlined."""
    c = _col(colours)
    nb = forward_neighbours(n)
    ok = []

    def same_as(i):
        return lambda j: c[j] == c[i]

    for i in range(len(nb)):
        if nb[i]:
            clash = F.exists(F.array(*[F.lit(j) for j in nb[i]]), same_as(i))
            ok.append(F.when(clash, 0).otherwise(1))
        else:
            ok.append(F.lit(1))
    return F.aggregate(F.array(*ok), F.lit(0), lambda a, x: a + x)


def conflict_join(edges: DataFrame, colours: DataFrame, cand: str = "cand_id", by_colour: bool = False) -> DataFrame:
    """Equi joins edges x colours(src) x colours(dst) with equal colour,
    then ``nodes - conflicting sources`` per candidate (any graph).
    ``colours`` is ``(cand_id, node, colour)``.

    The edges of a candidate's nodes meet the colours of their ends; with
    ``by_colour`` its nodes of one colour meet first and the edges between
    them stay, which is less to move when a node has more edges than a colour
    has nodes.  The candidates' tables meet in sort-merge joins: exploded
    arrays look small to the planner, which would broadcast them through the
    driver."""
    colours = colours.repartition(cand, "colour") if by_colour else colours       # one exchange for both sides
    src = colours.select(cand, F.col("node").alias("src"), F.col("colour").alias("c"))
    dst = colours.select(cand, F.col("node").alias("dst"), F.col("colour").alias("c"))
    if by_colour:
        clash = src.join(dst.hint("merge"), [cand, "c"]).join(edges, ["src", "dst"])
    else:
        clash = src.join(edges, "src").join(dst.hint("merge"), [cand, "dst", "c"])
    marked = colours.select(cand, "node", F.lit(0).alias("bad")).unionByName(
        clash.select(cand, F.col("src").alias("node"), F.lit(1).alias("bad")))
    nodes = marked.groupBy(cand, "node").agg(F.max("bad").alias("bad"))
    return nodes.groupBy(cand).agg(F.count_if(F.col("node").isNotNull() & (F.col("bad") == 0)).cast("int").alias("fitness"))


# ----------------------------------------------------------------------- F5
def uniform_candidates(df: DataFrame, key: str, n: int, value_range: int | Sequence[int],
                       seed: int, out: str = "bits") -> DataFrame:
    """one candidate per row of ``df``: element i is
    ``md5(seed:key:i) mod range_i`` (deterministic, partition-independent)."""
    from orchard.operators.ordering import spread
    ranges = [value_range] * n if isinstance(value_range, int) else list(value_range)
    rng = F.array(*[F.lit(int(r)) for r in ranges])

    def elem(i):
        h = hash_u32(F.concat(F.col(key).cast("string"), F.lit(":"), i.cast("string")), seed)
        return (h % F.element_at(rng, i + 1)).cast("int")
    return spread(df, key).withColumn(out, F.transform(F.sequence(F.lit(0), F.lit(n - 1)), elem))


# ----------------------------------------------------------------------- F6
def one_element_neighbours(df: DataFrame, bits: str = "bits", value_range: int = 2,
                           out: str = "neighbour", n: int | None = None) -> DataFrame:
    """every candidate with exactly one element changed to every other
    value in ``[0, value_range)``: adds ``pos``, ``val`` and the new array
    (n plain expressions when the length ``n`` is known)."""
    size = F.size(F.col(bits)) if n is None else F.lit(n)
    e = df.withColumn("pos", F.explode(F.sequence(F.lit(0), size - 1)))
    e = e.withColumn("val", F.explode(F.sequence(F.lit(0), F.lit(value_range - 1))))
    e = e.where(F.col(bits)[F.col("pos")] != F.col("val"))
    b = F.col(bits)
    if n is not None:
        return e.withColumn(out, F.array(*[F.when(F.col("pos") == i, F.col("val")).otherwise(b[i])
                                           for i in range(n)]))
    return e.withColumn(out, F.transform(b, lambda x, i: F.when(i == F.col("pos"), F.col("val")).otherwise(x)))


# ----------------------------------------------------------------------- F7
def top_k(df: DataFrame, k: int, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """best ``k`` rows per group in ``order`` (a total order), with a
    ``rank`` column.

    Written as ``row_number() <= k``; Catalyst turns it into a partial
    ``WindowGroupLimit`` before the shuffle and a final one after, so every
    task ships at most k rows per group and a hot group reaches its final
    task as at most k rows per upstream task.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# ----------------------------------------------------------------------- E17
def optimum_summary(runs: DataFrame, by: Sequence[str], fitness: str, run_id: str) -> DataFrame:
    """Per algorithm/parameters: runs, best fitness, the run that
    reached it (first id on ties) and mean fitness - pure aggregates, so a
    hot algorithm is combined map-side."""
    return runs.groupBy(*by).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_runs"),
        F.max(fitness).alias("best_fitness"),
        F.max_by(F.col(run_id), F.struct(F.col(fitness), -F.col(run_id))).alias("best_run"),
        F.avg(fitness).alias("mean_fitness"))


# ----------------------------------------------------------------------- U1
def score_candidates(df: DataFrame, fn, bits: str = "bits", out: str = "fitness",
                     return_type: str = "double", python: bool = False) -> DataFrame:
    """Apply a fitness function to every candidate.

    ``fn`` is a Column -> Column function (stays in the JVM:
    :func:`alternating_bits`, :func:`four_peaks` ...) or, with ``python``, a
    function of one numpy array, run as an Arrow-batched pandas UDF for
    fitness functions Spark SQL cannot express.
    """
    if not python:
        return df.withColumn(out, fn(F.col(bits)))

    @F.pandas_udf(return_type)
    def _score(s: pd.Series) -> pd.Series:
        return s.map(lambda a: fn(np.asarray(a)))

    return df.withColumn(out, _score(F.col(bits)))
