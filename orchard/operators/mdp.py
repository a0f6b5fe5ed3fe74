"""Markov-decision-process operators over tables.

States are grid cells ``(x, y)``; an MDP is three tables:

* ``states(x, y, code, r, terminal)`` - reward keyed on the current state,
* ``transitions(x, y, a, x2, y2, p)`` - only for non-terminal states,
* ``values(x, y, v)``.

A Bellman sweep is one join (transitions x values on the successor) and
one aggregation per state; the four action values are conditional sums in
that same aggregation, so a sweep costs two shuffles of small tables, and
the transition table is hash-partitioned on the successor once and cached
so the join never reshuffles it.  Iterative loops write reliable
checkpoints (``spark.checkpoint.dir``) every few sweeps so the plan stays
short and a lost executor recomputes from the last checkpoint.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orchard.operators.ordering import row_index
from orchard.session import checkpoint_dir, cut_lineage
from orchard.sources.grids import COSTLY, GOAL, NEG_EXIT, WALL

# Fixed values of the reference's grid world.
NORTH, SOUTH, EAST, WEST = 0, 1, 2, 3
ACTIONS = [NORTH, SOUTH, EAST, WEST]
ACTION_NAMES = ["north", "south", "east", "west"]
DIRS = [(NORTH, 0, 1), (SOUTH, 0, -1), (EAST, 1, 0), (WEST, -1, 0)]
P_INTENDED = 0.8
P_OTHER = 0.2 / 3
REWARDS = {GOAL: 100.0, NEG_EXIT: -100.0, COSTLY: -0.75}
REWARD_DEFAULT = -0.5


# ----------------------------------------------------------------------- M3 / M4
def grid_reward(code) -> Column:
    """M3 (U2): reward of being in a cell, keyed on the current state."""
    c = F.col(code) if isinstance(code, str) else code
    return (F.when(c == GOAL, F.lit(REWARDS[GOAL])).when(c == NEG_EXIT, F.lit(REWARDS[NEG_EXIT]))
             .when(c == COSTLY, F.lit(REWARDS[COSTLY])).otherwise(F.lit(REWARD_DEFAULT)))


def grid_terminal(code) -> Column:
    """M4 (U3): goal and negative-exit cells end an episode."""
    c = F.col(code) if isinstance(code, str) else code
    return c.isin(GOAL, NEG_EXIT)


def grid_states(cells: DataFrame) -> DataFrame:
    """Open cells with reward and terminal flag."""
    return (cells.where(F.col("code") != WALL)
                 .select("x", "y", "code", grid_reward("code").alias("r"), grid_terminal("code").alias("terminal")))


# ----------------------------------------------------------------------- M1 / J7
def grid_moves(cells: DataFrame) -> DataFrame:
    """Where each direction leads from every open cell; leaving the
    map or hitting a wall means staying.  ``(x, y, d, x2, y2)``.
    The four directions are an exploded literal (no join); the target is
    found by one left equi-join on the open cells."""
    open_ = cells.where(F.col("code") != WALL).select("x", "y")
    dirs = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
                     for d, dx, dy in DIRS])
    m = open_.select("x", "y", F.explode(dirs).alias("dd")).select(
        "x", "y", F.col("dd.d").alias("d"), (F.col("x") + F.col("dd.dx")).alias("tx"),
        (F.col("y") + F.col("dd.dy")).alias("ty"))
    tgt = open_.select(F.col("x").alias("tx"), F.col("y").alias("ty"), F.lit(True).alias("ok"))
    j = m.join(tgt, ["tx", "ty"], "left")
    return j.select("x", "y", "d",
                    F.when(F.col("ok"), F.col("tx")).otherwise(F.col("x")).alias("x2"),
                    F.when(F.col("ok"), F.col("ty")).otherwise(F.col("y")).alias("y2"))


# ----------------------------------------------------------------------- M2
def grid_transitions(cells: DataFrame, p_intended: float = P_INTENDED) -> DataFrame:
    """M2 (U4): ``(x, y, a, x2, y2, p)``: the intended direction with
    ``p_intended``, each other one with the rest / 3; equal outcomes merged
    by summing.  Terminal states have no outgoing rows.

    One aggregate: every open cell counts the open cells its directions lead
    to (as in :func:`grid_moves`), and the rows of a state follow from its counts."""
    p_other = (1.0 - p_intended) / 3 if p_intended != P_INTENDED else P_OTHER
    open_ = cells.where((F.col("code") != WALL) & F.col("x").isNotNull() & F.col("y").isNotNull())
    # every open cell tells itself (direction -1) and the cells it is a target of that it is there
    told = F.array(*[F.struct(F.try_add(F.col("x"), F.lit(-dx)).alias("x"), F.try_add(F.col("y"), F.lit(-dy)).alias("y"), F.lit(d).alias("d"))
                     for d, dx, dy in [(-1, 0, 0), *DIRS]])
    here = F.col("d") == -1
    near = (open_.select(F.inline(told), (~grid_terminal("code")).alias("live"))
                 .groupBy("x", "y").agg(F.count_if(here & F.col("live")).alias("live"), F.count_if(here).alias("n"),
                                        *[F.count_if(F.col("d") == d).alias(f"k{d}") for d, _, _ in DIRS])
                 .where("live > 0"))                                      # no neighbour off the map, cell there and not terminal
    outcomes = []
    for a in ACTIONS:
        p = {d: F.lit(p_intended if a == d else p_other) for d, _, _ in DIRS}
        to = [(F.col(f"k{d}") > 0, F.try_add(F.col("x"), F.lit(dx)), F.try_add(F.col("y"), F.lit(dy)), F.col(f"k{d}") * p[d]) for d, dx, dy in DIRS]
        shut = [F.when(F.col(f"k{d}") == 0, p[d]).otherwise(0.0) for d, _, _ in DIRS]
        to.append((F.least(*[F.col(f"k{d}") for d, _, _ in DIRS]) == 0, F.col("x"), F.col("y"), sum(shut[1:], shut[0])))
        outcomes += [F.when(some, F.struct(F.lit(a).alias("a"), x2.alias("x2"), y2.alias("y2"), (F.col("n") * q).alias("p"))) for some, x2, y2, q in to]
    return near.select("x", "y", F.inline(F.array(*outcomes))).where(F.col("a").isNotNull())


def with_reward(transitions: DataFrame, states: DataFrame, reward_on: str = "s") -> DataFrame:
    """M3: the transitions with the reward ``r`` of the state left ("s") or entered ("s2")."""
    if reward_on == "s":
        return transitions.join(states.select("x", "y", "r"), ["x", "y"])
    if reward_on == "s2":
        return transitions.join(states.select(F.col("x").alias("x2"), F.col("y").alias("y2"), "r"), ["x2", "y2"])
    raise ValueError(reward_on)


@contextmanager
def prepared_transitions(transitions: DataFrame, states: DataFrame, partitions: int | None = None, reward_on: str = "s"):
    """The transitions with the reward of s (``reward_on="s"``) or of the
    state entered (``"s2"``), as a table bucketed on the
    successor (x2, y2) under the shared checkpoint folder; dropped at the end
    of the block, so results must be checkpointed inside it.

    Every sweep joins this table with the current values on the successor;
    a bucketed scan reports its hash partitioning, so only the values
    (#states rows) are shuffled per sweep and the transition table (about
    16 x #states rows) never is.
    """
    spark = transitions.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"orchard_transitions_{uuid.uuid4().hex}"
    (with_reward(transitions, states, reward_on).repartition(n, "x2", "y2")
        .write.bucketBy(n, "x2", "y2").sortBy("x2", "y2")
        .option("path", f"{checkpoint_dir(spark).rstrip('/')}/{name}").saveAsTable(name))
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


# ----------------------------------------------------------------------- M6 / J6
def q_values(tp: DataFrame, values: DataFrame, gamma: float,
             actions: Sequence[int] = ACTIONS) -> DataFrame:
    """Q(s, a) = sum p (r(s) + gamma V(s2)) as columns ``q<a>`` per state;
    V of a state missing from ``values`` (terminal) is 0."""
    v2 = values.select(F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("v").alias("v2"))
    j = tp.join(v2, ["x2", "y2"], "left")
    term = F.col("p") * (F.col("r") + F.lit(gamma) * F.coalesce(F.col("v2"), F.lit(0.0)))
    return j.groupBy("x", "y").agg(*[F.sum(F.when(F.col("a") == a, term)).alias(f"q{a}") for a in actions])


def bellman_backup(tp: DataFrame, values: DataFrame, gamma: float,
                   actions: Sequence[int] = ACTIONS) -> DataFrame:
    """M6: one synchronous sweep, V(s) = max_a Q(s, a)."""
    q = q_values(tp, values, gamma, actions)
    return q.select("x", "y", F.greatest(*[F.col(f"q{a}") for a in actions]).alias("v"))


def zero_values(states: DataFrame) -> DataFrame:
    return states.where(~F.col("terminal")).select("x", "y", F.lit(0.0).alias("v"))


def value_iteration(tp: DataFrame, states: DataFrame, gamma: float, iters: int,
                    checkpoint_every: int = 5, actions: Sequence[int] = ACTIONS) -> DataFrame:
    """M7: exactly ``iters`` synchronous sweeps from V = 0."""
    v = zero_values(states)
    for i in range(1, iters + 1):
        v = bellman_backup(tp, v, gamma, actions)
        if i % checkpoint_every == 0 and i < iters:
            v = cut_lineage(v)
    return v


# ----------------------------------------------------------------------- M8 / M9
def policy_evaluation(tp: DataFrame, policy: DataFrame, states: DataFrame, gamma: float, iters: int,
                      checkpoint_every: int = 5, init: DataFrame | None = None) -> DataFrame:
    """M8: ``iters`` sweeps of V(s) = sum p (r + gamma V(s2)) under the
    fixed action ``policy(x, y, a)``."""
    tpol = tp.join(policy.select("x", "y", "a"), ["x", "y", "a"], "left_semi")
    v = init if init is not None else zero_values(states)
    for i in range(1, iters + 1):
        v2 = v.select(F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("v").alias("v2"))
        term = F.col("p") * (F.col("r") + F.lit(gamma) * F.coalesce(F.col("v2"), F.lit(0.0)))
        v = tpol.join(v2, ["x2", "y2"], "left").groupBy("x", "y").agg(F.sum(term).alias("v"))
        if i % checkpoint_every == 0 and i < iters:
            v = cut_lineage(v)
    return v


def greedy_policy(tp: DataFrame, values: DataFrame, gamma: float, actions: Sequence[int] = ACTIONS,
                  tie_decimals: int = 9) -> DataFrame:
    """M9: argmax_a Q(s, a); Q values equal to ``tie_decimals`` places count
    as ties and go to the first action in ``actions``."""
    q = q_values(tp, values, gamma, actions)
    cand = F.array(*[F.struct(F.round(F.col(f"q{a}"), tie_decimals).alias("q"), F.lit(-i).alias("neg_i"),
                              F.lit(a).alias("a")) for i, a in enumerate(actions)])
    best = F.array_max(F.filter(cand, lambda s: s["q"].isNotNull()))
    return q.select("x", "y", best["a"].alias("a"), best["q"].alias("q"))


# ----------------------------------------------------------------------- M10
def policy_iteration(tp: DataFrame, states: DataFrame, gamma: float, e_iters: int = 100, p_iters: int = 100,
                     actions: Sequence[int] = ACTIONS, cells: DataFrame | None = None) -> tuple[DataFrame, DataFrame, int]:
    """Evaluate (``e_iters`` sweeps) / improve until the policy stops
    changing or ``p_iters`` rounds.  Returns (values, policy, rounds).

    With ``cells``, the grid whose :func:`grid_transitions` ``tp`` holds, the
    same rounds run in blocks with halos: one exchange serves the sweeps and
    the greedy step of a round (a join and an aggregate per sweep otherwise)."""
    if cells is not None and tuple(actions) == tuple(ACTIONS):
        from orchard.operators import halo
        state, rounds = halo.policy_iteration(cells, gamma, e_iters, p_iters)
        return halo.values(state), state.where(~F.col("terminal")).select("x", "y", "a"), rounds
    v = zero_values(states)
    policy = greedy_policy(tp, v, gamma, actions).select("x", "y", "a")
    policy = cut_lineage(policy)
    rounds = 0
    for rounds in range(1, p_iters + 1):
        v = cut_lineage(policy_evaluation(tp, policy, states, gamma, e_iters, init=v))
        new = cut_lineage(greedy_policy(tp, v, gamma, actions).select("x", "y", "a"))
        changed = (new.alias("n").join(policy.alias("o"), ["x", "y"])
                   .where(F.col("n.a") != F.col("o.a")).limit(1).count())
        policy = new
        if changed == 0:
            break
    return v, policy, rounds


# ----------------------------------------------------------------------- M11 / J5
def values_diff(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """Full outer join on the state, a missing value counts as 0."""
    a = v1.select("x", "y", F.col("v").alias("v1"))
    b = v2.select("x", "y", F.col("v").alias("v2"))
    return (a.join(b, ["x", "y"], "full_outer")
             .select("x", "y", F.coalesce("v1", F.lit(0.0)).alias("v1"), F.coalesce("v2", F.lit(0.0)).alias("v2"),
                     F.abs(F.coalesce("v1", F.lit(0.0)) - F.coalesce("v2", F.lit(0.0))).alias("diff")))


def values_match(v1: DataFrame, v2: DataFrame, tol: float = 0.05) -> DataFrame:
    """One row ``(max_diff, match)``; no states at all -> -99999 / false."""
    d = values_diff(v1, v2).agg(F.max("diff").alias("max_diff"), F.count(F.lit(1)).alias("n"))
    return d.select(F.when(F.col("n") == 0, F.lit(-99999.0)).otherwise(F.col("max_diff")).alias("max_diff"),
                    ((F.col("n") > 0) & (F.col("max_diff") <= F.lit(tol))).alias("match"))


# ----------------------------------------------------------------------- M12
def convergence_sweep(tp: DataFrame, states: DataFrame, gamma: float, max_iters: int, tol: float = 0.05,
                      stop: bool = True, actions: Sequence[int] = ACTIONS) -> tuple[DataFrame, int | None]:
    """One running sweep (not a restart per i as in the reference);
    after each, the largest change from the previous sweep.  Returns
    ``(iter, max_delta)`` rows and the first iteration whose delta is
    within ``tol`` (None if none).  V is checkpointed every sweep (it is
    #states rows), so the plan never grows with the iteration count."""
    spark = tp.sparkSession
    v = cut_lineage(zero_values(states))
    rows = []
    first = None
    for i in range(1, max_iters + 1):
        nv = bellman_backup(tp, v, gamma, actions)
        nv = (nv.join(v.select("x", "y", F.col("v").alias("_old")), ["x", "y"], "full_outer")
                .select("x", "y", "v", F.abs(F.coalesce(F.col("v"), F.lit(0.0))
                                            - F.coalesce(F.col("_old"), F.lit(0.0))).alias("_d")))
        nv = cut_lineage(nv)
        delta = nv.agg(F.max("_d")).first()[0]
        rows.append((i, float(delta if delta is not None else 0.0)))
        v = nv.drop("_d")
        if first is None and delta is not None and delta <= tol:
            first = i
            if stop:
                break
    return spark.createDataFrame(rows, "iter INT, max_delta DOUBLE"), first


# ----------------------------------------------------------------------- M5
def reachable(transitions: DataFrame, start: tuple[int, int]) -> DataFrame:
    """M5, any MDP: breadth-first closure from ``start`` over transitions
    with p > 0 - one frontier join and anti-join per level.  The visited set
    and the frontier are checkpointed every level (the plan of a level
    refers to both earlier tables, so it would otherwise grow
    exponentially).  For grid worlds :func:`grid_reachable` needs far
    fewer rounds."""
    spark = transitions.sparkSession
    edges = cut_lineage(transitions.where(F.col("p") > 0).select("x", "y", "x2", "y2").distinct())
    kind = dict(edges.dtypes)
    seen = cut_lineage(spark.createDataFrame([start], f"x {kind['x']}, y {kind['y']}"))
    frontier = seen
    while True:
        nxt = (frontier.join(edges, ["x", "y"]).select(F.col("x2").alias("x"), F.col("y2").alias("y"))
                       .distinct().join(seen, ["x", "y"], "left_anti"))
        nxt = cut_lineage(nxt)
        if nxt.limit(1).count() == 0:
            return seen
        seen = cut_lineage(seen.unionByName(nxt))
        frontier = nxt


def mixed_id(c) -> Column:
    """A bijection of the 64-bit integers (shifts and exclusive ors only, so
    nothing overflows) that scatters neighbouring ids."""
    x = (F.col(c) if isinstance(c, str) else c).cast("bigint")
    for left, right, last in ((13, 7, 17), (21, 35, 4)):
        x = x.bitwiseXOR(F.shiftleft(x, left))
        x = x.bitwiseXOR(F.shiftrightunsigned(x, right))
        x = x.bitwiseXOR(F.shiftleft(x, last))
    return x


def component_roots(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of the undirected components of ``edges(src, dst)``,
    both as ``mixed_id``: ``root`` is one member, the same for the whole
    component (it is not listed itself); any 64-bit ids.

    Alternating large-star / small-star rounds (Kiveris et al., 2014): each
    round is a few joins and aggregates over the edge list, and the number of
    rounds grows with log^2 of the node count.  Nodes are ordered by a
    bijection of their ids, so spatially ordered ids, as on a grid, do not
    form long chains and different ids never meet.  Every round's edge list is
    checkpointed; a round that leaves its count and checksum unchanged left
    the edges unchanged, which ends the loop.
    """
    def ordered(df):
        return (df.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
                  .where(F.col("u") != F.col("v")).distinct())

    def both(df):
        return df.unionByName(df.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def large_star(df):
        d = both(df)
        m = d.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return d.where(F.col("v") > F.col("u")).join(m, "u").select(F.col("m").alias("u"), "v")

    def small_star(df):
        m = df.groupBy("v").agg(F.min("u").alias("m"))       # the smallest of v's smaller neighbours
        moved = df.join(m, "v").select(F.col("u").alias("a"), F.col("m").alias("b"))
        return ordered(moved.unionByName(m.select(F.col("v").alias("a"), F.col("m").alias("b"))))

    def checksum(df):
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    e = cut_lineage(ordered(edges.select(mixed_id("src").alias("a"), mixed_id("dst").alias("b"))))
    seen = checksum(e)
    while seen[0]:
        e = cut_lineage(small_star(large_star(e)))
        now = checksum(e)
        if now == seen:
            break
        seen = now
    # every edge joins a node to its component's root
    return e.select(F.col("v").alias("node"), F.col("u").alias("root"))


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Undirected components of ``nodes(id)`` / ``edges(src, dst)``:
    ``(id, comp)`` with comp = smallest id of the component."""
    root = component_roots(edges)
    lab = (nodes.select(F.col("id").cast("bigint").alias("id"), mixed_id("id").alias("node")).join(root, "node", "left")
                .select("id", F.coalesce("root", "node").alias("root")))
    # report the smallest original id of each component (an aggregate, so a
    # giant component is combined map-side; the join back is skew-handled by AQE)
    smallest = lab.groupBy("root").agg(F.min("id").alias("comp"))
    return lab.join(smallest, "root").select("id", "comp")


def grid_reachable(states: DataFrame, transitions: DataFrame | None, start: tuple[int, int], side: int = 64) -> DataFrame:
    """M5 for grid worlds, whose moves are symmetric between open cells: the
    component of ``start`` among non-terminal states plus the terminal states
    one move away.  Same set as :func:`reachable` on these MDPs.

    The grid is cut into square blocks whose components are found inside the
    tasks; only pairs of block components that touch across a border go
    through the star rounds of :func:`connected_components`, so those work on
    a table the size of the borders.  Any 64-bit coordinates.  The moves
    follow from the cells; ``transitions`` is not read.
    """
    from orchard.operators.halo import block_components
    st = states.select("x", "y", "terminal")
    here = st.where((F.col("x") == start[0]) & (F.col("y") == start[1]))
    first = here.first()
    if first is None or first["terminal"]:
        return here.select("x", "y")
    cells, touching = block_components(st.where(~F.col("terminal")).select("x", "y"), side)
    root = cells.where((F.col("x") == start[0]) & (F.col("y") == start[1])).select("rx", "ry").first()
    ends = touching.select("rx", "ry").unionByName(touching.select(F.col("sx").alias("rx"), F.col("sy").alias("ry"))).distinct()
    ids = cut_lineage(row_index(ends, ["rx", "ry"], name="id"))
    other = ids.select(F.col("rx").alias("sx"), F.col("ry").alias("sy"), F.col("id").alias("dst"))
    edges = touching.join(ids, ["rx", "ry"]).join(other, ["sx", "sy"]).select(F.col("id").alias("src"), "dst")
    comp = connected_components(ids, edges).join(ids, "id").select("comp", "rx", "ry")
    mine = cut_lineage(comp).where((F.col("rx") == root["rx"]) & (F.col("ry") == root["ry"])).select("comp").first()
    if mine is None:                                                        # touches nothing beyond its block
        inside = cells.where((F.col("rx") == root["rx"]) & (F.col("ry") == root["ry"]))
    else:
        inside = cells.join(comp.where(F.col("comp") == mine["comp"]).select("rx", "ry"), ["rx", "ry"], "left_semi")
    inside = inside.select("x", "y")
    steps = F.array(*[F.struct(F.try_add(F.col("x"), F.lit(dx)).alias("x"), F.try_add(F.col("y"), F.lit(dy)).alias("y")) for _, dx, dy in DIRS])
    beside = inside.select(F.inline(steps)).distinct()
    return inside.unionByName(st.where(F.col("terminal")).select("x", "y").join(beside, ["x", "y"], "left_semi"))


# ----------------------------------------------------------------------- M13
def value_grid(values: DataFrame, cells: DataFrame, reachable_states: DataFrame | None = None,
               pivot: bool = False) -> DataFrame:
    """Every cell of the map with its value, 0 where there is none
    (walls, unreachable states).  ``pivot=True`` gives the dense matrix:
    one row per y (descending), one column per x."""
    v = values
    if reachable_states is not None:
        v = v.join(reachable_states, ["x", "y"], "left_semi")
    dense = cells.select("x", "y").join(v.select("x", "y", "v"), ["x", "y"], "left").select(
        "x", "y", F.coalesce(F.col("v"), F.lit(0.0)).alias("v"))
    if not pivot:
        return dense
    return dense.groupBy("y").pivot("x").agg(F.first("v")).orderBy(F.col("y").desc())


# ----------------------------------------------------------------------- M14-M19 (logged steps)
def next_in_order(df: DataFrame, by: Sequence[str], order: Sequence, cols: Sequence[str],
                  prefix: str = "next_") -> DataFrame:
    """``lead`` of ``cols`` within ``by`` in ``order`` without sending a
    hot group to one task: rows are numbered by a range-partitioned sort
    (:func:`row_index`) and joined to their successor on (by, index + 1)."""
    from orchard.operators.ordering import row_index
    idx = row_index(df, order, by=by, name="_t")
    nxt = idx.select(*by, (F.col("_t") - 1).alias("_t"), *[F.col(c).alias(prefix + c) for c in cols])
    return idx.join(nxt, [*by, "_t"], "left")


def steps_from_events(events: DataFrame, episode=None) -> DataFrame:
    """Logged experience as episode steps: episode = user, t = position in
    (ts, event_id) order, state = (day index, hour), action = event type,
    reward = value.  ``(episode, t, x, y, action, reward, event_id)``;
    days count from the first event of the whole log.  ``episode`` keeps the
    steps of one user only."""
    from orchard.operators.ordering import row_index
    day0 = events.agg(F.min(F.to_date("ts")).alias("d0")).first()["d0"]
    if episode is not None:
        events = events.where(F.col("user_id") == F.lit(episode))
    e = events.select(F.col("user_id").alias("episode"), "event_id", "ts",
                      F.datediff(F.to_date("ts"), F.lit(day0)).cast("int").alias("x"),
                      F.hour("ts").cast("int").alias("y"),
                      F.col("event_type").alias("action"), F.col("value").alias("reward"))
    return row_index(e, ["ts", "event_id"], by=["episode"], name="t").drop("ts")


def transitions_from_log(events: DataFrame, state: str = "event_type", action: Column | None = None,
                         reward: str = "value", by: str = "user_id", order: Sequence[str] = ("ts", "event_id"),
                         reward_scale: int | None = None) -> DataFrame:
    """Estimated p(s2 | s, a) = n(s, a, s2) / n(s, a) and mean reward
    r(s, a) from consecutive events of each user.  ``(s, a, s2, n, p, r)``.

    With ``reward_scale`` (e.g. 100 for rewards in cents) the mean is
    computed from exact integer sums and rounded half-up to 6 decimals, so
    it does not depend on the order in which partial sums are combined.
    """
    a = action if action is not None else F.lit("log")
    ev = events.select(by, *order, F.col(state).alias("s"), a.alias("a"), F.col(reward).alias("rw"))
    pairs = next_in_order(ev, [by], list(order), ["s"]).where(F.col("next_s").isNotNull())
    rsum = (F.sum(F.round(F.col("rw") * reward_scale).cast("bigint")) if reward_scale
            else F.sum("rw"))
    cnt = pairs.groupBy("s", "a", F.col("next_s").alias("s2")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), rsum.alias("rsum"))
    w = Window.partitionBy("s", "a")
    tot, rs = F.sum("n").over(w), F.sum("rsum").over(w)
    if reward_scale:
        micro = 1_000_000 // reward_scale
        units = (F.lit(2) * rs * F.lit(micro) + tot).cast("bigint")
        r = F.floor(units / (F.lit(2) * tot)).cast("double") / F.lit(1e6)
    else:
        r = rs / tot
    return cnt.select("s", "a", "s2", "n", (F.col("n") / tot).alias("p"), r.alias("r"))


def q_update_batch(steps: DataFrame, q: DataFrame | None, gamma: float, lr: float = 1.0) -> DataFrame:
    """Q(s,a) <- (1-lr) Q(s,a) + lr * mean(r + gamma max_a' Q(s2,a'))
    over the logged steps ``(s, a, r, s2)``; Q starts at 0."""
    if q is None:
        q = steps.select("s", "a").distinct().withColumn("q", F.lit(0.0))
    vmax = q.groupBy(F.col("s").alias("s2")).agg(F.max("q").alias("v2"))
    tgt = (steps.join(vmax, "s2", "left")
                .groupBy("s", "a").agg(F.avg(F.col("r") + F.lit(gamma) * F.coalesce(F.col("v2"), F.lit(0.0)))
                                       .alias("target")))
    j = q.join(tgt, ["s", "a"], "full_outer")
    return j.select("s", "a", ((1 - lr) * F.coalesce(F.col("q"), F.lit(0.0))
                               + lr * F.coalesce(F.col("target"), F.lit(0.0))).alias("q"))


def action_probs(q: DataFrame, policy: str = "epsilon", param: float = 0.1, tie_decimals: int = 9) -> DataFrame:
    """Action probabilities per state from ``q(s, a, q)``:
    ``epsilon`` (eps/n + (1-eps) on the greedy action), ``greedy``, or
    ``boltzmann`` with temperature ``param`` (max subtracted first).
    Greedy ties (to ``tie_decimals``) go to the smallest action."""
    w = Window.partitionBy("s")
    qr = F.round(F.col("q"), tie_decimals)
    best = F.min(F.when(qr == F.max(qr).over(w), F.col("a"))).over(w)
    df = q.withColumn("_best", best).withColumn("_n", F.count(F.lit(1)).over(w))
    is_best = (F.col("a") == F.col("_best")).cast("double")
    if policy == "greedy":
        p = is_best
    elif policy == "epsilon":
        eps = max(float(param), 0.01)
        p = F.lit(eps) / F.col("_n") + F.lit(1 - eps) * is_best
    elif policy == "boltzmann":
        z = F.exp((F.col("q") - F.max("q").over(w)) / F.lit(float(param)))
        df = df.withColumn("_z", z)
        p = F.col("_z") / F.sum("_z").over(w)
    else:
        raise ValueError(policy)
    return df.select("s", "a", "q", p.alias("prob"))


def episode_summary(events: DataFrame, episode: str = "user_id", reward: str = "value",
                    order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """Time steps and total reward per episode; the first step (in
    ``order``) earns nothing.  One partial aggregate, no sort."""
    first = F.min_by(F.coalesce(F.col(reward), F.lit(0.0)), F.struct(*order))
    return events.groupBy(F.col(episode).alias("episode")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_steps"),
        (F.coalesce(F.sum(reward), F.lit(0.0)) - first).alias("total_reward"))


def best_episode(summary: DataFrame) -> DataFrame:
    """Fewest steps (first episode on ties) and, separately, the top
    total reward, one row - aggregates only."""
    return summary.agg(
        F.min_by("episode", F.struct("n_steps", "episode")).alias("fewest_steps_episode"),
        F.min("n_steps").alias("fewest_steps"),
        F.max_by("episode", F.struct(F.col("total_reward"), -F.col("episode"))).alias("top_reward_episode"),
        F.max("total_reward").alias("top_reward"))


def episode_path(steps: DataFrame, episode: int | Column, per_line: int = 10) -> DataFrame:
    """The states of one episode that took an action (all but the
    last), ``per_line`` "x,y" points to a line: ``(line, path)``.  A line
    holds at most ``per_line`` points, so no group grows with the data."""
    ep = steps.where(F.col("episode") == (episode if isinstance(episode, Column) else F.lit(episode)))
    tmax = ep.agg(F.max("t")).first()[0]
    ep = ep.where(F.col("t") < F.lit(tmax if tmax is not None else -1))
    pts = ep.select((F.floor(F.col("t") / per_line)).cast("bigint").alias("line"), "t",
                    F.concat_ws(",", F.col("x").cast("string"), F.col("y").cast("string")).alias("pt"))
    g = pts.groupBy("line").agg(F.array_sort(F.collect_list(F.struct("t", "pt"))).alias("ps"))
    return g.select("line", F.array_join(F.transform("ps", lambda s: s["pt"]), " ").alias("path"))
