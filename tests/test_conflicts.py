"""The candidates' tables meet in sort-merge joins, in either order of the joins."""

import pytest
from pyspark.sql import functions as F

from orchard.operators import fitness as FT


def _table(spark, rows):
    """As the query builds it: a small table whose arrays are exploded after the planner has sized it."""
    d = spark.createDataFrame(rows, "cand_id long, colours array<int>")
    return d.select("cand_id", F.posexplode("colours").alias("node", "colour"))


@pytest.mark.parametrize("by_colour", [True, False])
def test_conflicts_equal_plain_loops_and_no_candidate_is_broadcast(spark, by_colour):
    rows = [(i, [(i * 7 + j * j) % 3 for j in range(6)]) for i in range(40)] + [(100, [0] * 6), (101, [0, None, 0, 0, None, 1]), (102, [])]
    rows += [(100, [1] * 6), (None, [0] * 6)]                       # a key that comes twice, a null key
    links = [(0, 1), (0, 2), (1, 4), (2, 5), (3, 4), (5, 0), (8, 9)]
    got = FT.conflict_join(spark.createDataFrame(links, "src int, dst int"), _table(spark, rows), by_colour=by_colour)
    of = {}
    for k, c in rows:
        for n, x in enumerate(c):
            of.setdefault(k, set()).add((n, x))
    want = {}
    for k, pairs in of.items():
        bad = {s for s, d in links for c in range(3) if k is not None and (s, c) in pairs and (d, c) in pairs}
        want[k] = len({n for n, _ in pairs}) - len(bad)
    assert {r.cand_id: r.fitness for r in got.collect()} == want


@pytest.mark.parametrize("options", [{}, {"by_colour": True}])
def test_no_table_of_candidates_is_broadcast(spark, options):
    """The planner knows the size of a range, not that of the arrays made of it."""
    ids = spark.range(50).withColumnRenamed("id", "cand_id")
    cols = ids.select("cand_id", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda j: (F.col("cand_id") + j * j) % 3)).alias("node", "colour"))
    got = FT.conflict_join(FT.kcolour_graph(spark, 10), cols, **options)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [cand_id" not in plan and "SortMergeJoin [cand_id" in plan


@pytest.mark.parametrize("n, block", [(0, 4), (3, 4), (4, 4), (5, 4), (8, 2), (23, 4), (64, 8), (65, 8), (100, 1024)])
def test_tiles_hold_every_edge_once(spark, n, block):
    got = [tuple(r) for r in FT.kcolour_graph(spark, n, block).collect()]
    want = [(i, j) for i in range(max(n, 3)) for j in range(i + 2, max(n, 3), 2)]
    assert sorted(got) == want


def test_a_written_graph_is_small(spark, tmp_path):
    FT.kcolour_graph(spark, 6000).write.parquet(f"{tmp_path}/g")
    size = sum(f.stat().st_size for f in (tmp_path / "g").glob("*.parquet"))
    assert size < 0.25 * 8_997_000                                       # edges; by source about 1.9 bytes each
