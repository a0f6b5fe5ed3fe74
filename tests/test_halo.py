"""Blocks with halos against plain synchronous sweeps."""

import random

import pytest
from pyspark.sql import functions as F

from orchard.operators import halo
from orchard.operators import mdp as M
from orchard.sources.grids import COSTLY, GOAL, NEG_EXIT, WALL

GAMMA = 0.95


def world(n, m, seed, x0=0, y0=0):
    r = random.Random(seed)
    return [(x0 + x, y0 + y, r.choice([0] * 14 + [WALL] * 4 + [COSTLY] * 2 + [GOAL, NEG_EXIT])) for x in range(n) for y in range(m)]


def plain(cells, sweeps, policy=None):
    code = {(x, y): c for x, y, c in cells if c != WALL}
    v, deltas = dict.fromkeys(code, 0.0), []
    for _ in range(sweeps):
        new = {}
        for (x, y), c in code.items():
            if c in (GOAL, NEG_EXIT):
                new[x, y] = 0.0
                continue
            to = [v[x + dx, y + dy] if (x + dx, y + dy) in code else v[x, y] for _, dx, dy in M.DIRS]
            q = [sum((M.P_INTENDED if a == d else M.P_OTHER) * (M.REWARDS.get(c, M.REWARD_DEFAULT) + GAMMA * u) for d, u in enumerate(to)) for a in range(4)]
            new[x, y] = max(q) if policy is None else q[policy[x, y]]
        deltas.append(max((abs(new[k] - v[k]) for k in new), default=0.0))
        v = new
    return {k: w for k, w in v.items() if code[k] not in (GOAL, NEG_EXIT)}, deltas


def table(spark, cells):
    return spark.createDataFrame(cells, "x long, y long, code int")


@pytest.mark.parametrize("side, wide, sweeps, at", [(8, 3, 10, (0, 0)), (5, 5, 12, (-7, 3)), (64, 25, 30, (2**62, -2**62 - 5))])
def test_values_and_changes_equal_plain_sweeps(spark, side, wide, sweeps, at):
    cells = world(23, 11, 4, *at)
    state, deltas = halo.run_sweeps(halo.start(table(spark, cells)), sweeps, GAMMA, side, wide)
    want, changes = plain(cells, sweeps)
    got = {(r.x, r.y): r.v for r in halo.values(state).collect()}
    assert got == pytest.approx(want) and deltas == pytest.approx(changes)


def test_a_fixed_policy(spark):
    cells = world(12, 9, 5)
    policy = {(x, y): (x + y) % 4 for x, y, _ in cells}
    pol = spark.createDataFrame([(x, y, a) for (x, y), a in policy.items()], "x long, y long, a int")
    state, _ = halo.run_sweeps(halo.start(table(spark, cells), pol), 7, GAMMA, 4, 3)
    assert {(r.x, r.y): r.v for r in halo.values(state).collect()} == pytest.approx(plain(cells, 7, policy)[0])


def test_first_converged_sweep(spark):
    cells = world(9, 9, 6)
    _, changes = plain(cells, 149)
    first = next(i for i, d in enumerate(changes, 1) if i > 1 and d <= 0.05)
    rows, got = halo.convergence(table(spark, cells), GAMMA, 149, 0.05, side=16, halo=10)
    assert got == first and rows.count() == first and {r.first_converged for r in rows.collect()} == {first}
    rows, got = halo.convergence(table(spark, cells), GAMMA, 4, 1e-12)
    assert got is None and [r.first_converged for r in rows.collect()] == [None] * 4


def test_far_apart_cells_nulls_and_empty_grids(spark):
    big = 2**63 - 1
    cells = [(big, -big - 1, 0), (big, -big, GOAL), (-big - 1, big, 0), (0, 0, 0), (1, 0, GOAL)]
    state, _ = halo.run_sweeps(halo.start(table(spark, [*cells, (None, 1, 0)])), 3, GAMMA, 8, 3)
    got = {(r.x, r.y): r.v for r in halo.values(state).collect()}
    assert got == pytest.approx(plain(cells, 3)[0])
    rows, first = halo.convergence(table(spark, []), GAMMA, 5)
    assert first == 2 and [r.max_delta for r in rows.collect()] == [0.0, 0.0]
    walls = table(spark, [(0, 0, WALL)])
    assert halo.values(halo.run_sweeps(halo.start(walls), 2, GAMMA)[0]).count() == 0
    with pytest.raises(ValueError):
        halo.sweep(halo.start(walls).withColumn("v", F.lit(0.0)), 9, GAMMA, 8, 4)


def plain_policy(cells, e, p):
    code = {(x, y): c for x, y, c in cells if c != WALL}
    v, pol = dict.fromkeys(code, 0.0), dict.fromkeys(code, 0)
    rounds = 0

    def q(k, a):
        x, y = k
        to = [v[x + dx, y + dy] if (x + dx, y + dy) in code else v[k] for _, dx, dy in M.DIRS]
        return sum((M.P_INTENDED if a == d else M.P_OTHER) * (M.REWARDS.get(code[k], M.REWARD_DEFAULT) + GAMMA * u) for d, u in enumerate(to))

    live = [k for k, c in code.items() if c not in (GOAL, NEG_EXIT)]
    while rounds < p:
        rounds += 1
        for _ in range(e):
            v = {**dict.fromkeys(code, 0.0), **{k: q(k, pol[k]) for k in live}}
        new = {k: max(range(4), key=lambda a: (round(q(k, a), 9), -a)) for k in live}
        if all(new[k] == pol[k] for k in live):
            break
        pol.update(new)
    return {k: v[k] for k in live}, rounds


@pytest.mark.parametrize("e, p, wide", [(3, 9, 5), (8, 4, 4), (1, 30, 4)])
def test_policy_iteration_equals_plain_rounds(spark, e, p, wide):
    cells = world(13, 9, 8)
    state, rounds = halo.policy_iteration(table(spark, cells), GAMMA, e, p, 6, wide)
    want, n = plain_policy(cells, e, p)
    assert rounds == n and {(r.x, r.y): r.v for r in halo.values(state).collect()} == pytest.approx(want)


def test_policy_convergence(spark):
    cells = world(8, 8, 9)
    runs = [plain_policy(cells, i, i)[0] for i in range(1, 40)]
    gaps = [max(abs(b[k] - a[k]) for k in a) for a, b in zip(runs, runs[1:])]
    first = next(i for i, d in enumerate(gaps, 2) if d <= 0.5)
    rows, got = halo.policy_convergence(table(spark, cells), GAMMA, 39, 0.5, side=16, halo=16)
    assert got == first and rows.count() == first


@pytest.mark.parametrize("side, at", [(4, (0, 0)), (7, (-9, 4)), (64, (0, 0)), (5, (2**63 - 24, -2**63))])
def test_reachable_cells_equal_a_walk(spark, side, at):
    cells = world(24, 17, 11, *at)
    code = {(x, y): c for x, y, c in cells if c != WALL}
    states = M.grid_states(table(spark, cells)).cache()
    some = [k for k, c in code.items() if c not in (GOAL, NEG_EXIT)][::90] + [next(k for k, c in code.items() if c == GOAL), (at[0], -77)]
    for start in some:
        seen, walk = set(), [start] if start in code else []
        while walk:
            k = walk.pop()
            if k in seen:
                continue
            seen.add(k)
            if code[k] not in (GOAL, NEG_EXIT):
                walk += [n for _, dx, dy in M.DIRS if (n := (k[0] + dx, k[1] + dy)) in code]
        got = [tuple(r) for r in M.grid_reachable(states, None, start, side).collect()]
        assert len(got) == len(seen) and set(got) == seen


def test_policy_iteration_on_a_grid_runs_in_blocks(spark, monkeypatch):
    """The rounds of a grid go through the blocks, one exchange a round, with the values, actions and rounds of plain ones."""
    cells = world(7, 6, 12)
    grid = table(spark, cells).cache()
    states = M.grid_states(grid)
    tp = M.with_reward(M.grid_transitions(grid), states)
    calls = []
    sweep = halo.sweep
    monkeypatch.setattr(halo, "sweep", lambda *a, **k: calls.append(1) or sweep(*a, **k))
    monkeypatch.setattr(M, "policy_evaluation", None)
    v, policy, rounds = M.policy_iteration(tp, states, GAMMA, 4, 9, cells=grid)
    want, n = plain_policy(cells, 4, 9)
    assert rounds == n == len(calls) and {(r.x, r.y): r.v for r in v.collect()} == pytest.approx(want)
    greedy = {(r.x, r.y): r.a for r in M.greedy_policy(tp, v, GAMMA).collect()}
    assert {(r.x, r.y): r.a for r in policy.collect()} == greedy


def test_exchanges_carry_one_row_per_block(spark, monkeypatch):
    """What is written between exchanges is a row per block, and 400 sweeps need few exchanges."""
    cells = world(23, 11, 4)
    rows = []
    cut = halo.cut_lineage

    def counted(df):
        out = cut(df)
        rows.append(out.count())
        return out

    monkeypatch.setattr(halo, "cut_lineage", counted)
    state, deltas = halo.run_sweeps(halo.start(table(spark, cells)), 7, GAMMA, 8, 4)
    assert {(r.x, r.y): r.v for r in halo.values(state).collect()} == pytest.approx(plain(cells, 7)[0]) and len(deltas) == 7
    assert len(rows) == 3 and max(rows) <= 3 * 2
    rows.clear()
    state, deltas = halo.run_sweeps(halo.start(table(spark, cells)), 400, GAMMA)
    assert len(rows) <= 9 and set(rows) == {1} and deltas == pytest.approx(plain(cells, 400)[1])


@pytest.mark.parametrize("chunk", [1, 1 << 14])
def test_scattered_blocks_are_swept_together(spark, monkeypatch, chunk):
    """Blocks far apart, and next to each other, whether a task takes them one by one or many at once; repeated cells stay."""
    monkeypatch.setattr(halo, "CHUNK", chunk)
    parts = [world(5, 4, s, x0, y0) for s, (x0, y0) in enumerate([(0, 0), (5, 0), (-40, 9), (2**60, -2**61), (2**60 + 6, -2**61 + 1)])]
    cells = list({(x, y): (x, y, c) for part in parts for x, y, c in part}.values())
    twice = [k for k in cells if k[2] == 0][::5]
    policy = {(x, y): (x + 2 * y) % 4 for x, y, _ in cells}
    pol = spark.createDataFrame([(x, y, a) for (x, y), a in policy.items()], "x long, y long, a int")
    for p, want in ((None, plain(cells, 7)), (policy, plain(cells, 7, policy))):
        state, deltas = halo.run_sweeps(halo.start(table(spark, cells + twice), pol if p else None), 7, GAMMA, 4, 3)
        got = halo.values(state).collect()
        assert {(r.x, r.y): r.v for r in got} == pytest.approx(want[0]) and len(got) == len(want[0]) + len(twice)
        assert deltas == pytest.approx(want[1])


def test_transitions_are_the_merged_moves(spark):
    """The rows that follow from the counts are those of the four moves under each action, repeated and null cells included."""
    cells = [*world(9, 7, 13), *world(3, 7, 13), (None, 2, 0), (2, None, 0), (2**63 - 1, -2**63, 0)]
    grid = table(spark, cells)
    states = M.grid_states(grid).where(~F.col("terminal")).select("x", "y")
    moves = [tuple(r) for r in M.grid_moves(grid.where("x < 100")).join(states, ["x", "y"], "left_semi").collect()]
    moves += [(2**63 - 1, -2**63, d, 2**63 - 1, -2**63) for d in range(4)]
    want = {}
    for x, y, d, x2, y2 in moves:
        for a in range(4):
            want[x, y, a, x2, y2] = want.get((x, y, a, x2, y2), 0.0) + (0.7 if a == d else 0.1)
    got = M.grid_transitions(grid, 0.7).collect()
    assert len(got) == len(want) and {tuple(r)[:5]: r.p for r in got} == pytest.approx(want)
